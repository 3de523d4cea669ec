"""alertfold: consolidate folders of overlapping CSV alert exports into monthly datasets on Spark.

Every public function takes and returns DataFrames or Columns and stays lazy;
only the sinks and a few driver-side planning helpers (file listing, header
reads) run Spark actions.
"""

from alertfold.session import get_session, prepare, scratch_dir

__all__ = ["get_session", "prepare", "scratch_dir"]
