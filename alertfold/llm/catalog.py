"""The queries of this subpackage, for ``__spark_entry__.py``."""

from __future__ import annotations

import corpus_pipeline
from alertfold.llm.queries import QUERIES
from alertfold.plans.registry import Query


def all_queries() -> dict[str, Query]:
    pipeline = Query("pipeline", corpus_pipeline.run, corpus_pipeline.ORACLE_SQL, "corpus pipeline")
    return QUERIES | {"pipeline": pipeline}
