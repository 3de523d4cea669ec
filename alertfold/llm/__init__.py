"""Operations of a training-data pipeline (mixing, deduplication, tokenising, scoring,
search, redaction, filtering).  Nothing outside this folder imports it, except the guarded
registration in ``__spark_entry__.py`` and ``corpus_pipeline.py``."""
