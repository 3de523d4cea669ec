"""A corpus pipeline over ``documents``: each stage reads what its predecessor wrote.

``run(spark, sf_dir)`` writes every stage's result as Parquet under the shared checkpoint
folder and reads it back for the next stage.

Rows are documents of their own all the way.  A NULL text has no words: it is not toxic,
equals an empty text, is near nothing, has size 0 and is mixed by the whole part of its
source's rate, and encodes to no tokens.  A NULL id loses against any other in the exact and
near stages and is mixed like a document; a NULL source is a source.  Rows that repeat an id
are told apart by their texts, rows that repeat both are one from the exact stage on.  Labels
without a document teach nothing; without labels of both classes no document is dropped, unless
all labels are toxic.  An empty table gives no rows at every stage.  Further columns go along
up to the last stage, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from alertfold.llm import exact_dedup, mixing, ngram_join, piece_bpe, toxicity
from alertfold.llm.common import table
from alertfold.session import scratch_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network finds toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal after lower-casing A-Z, the document with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles, over
    any chain, the one with the smallest id stays."""
    return ngram_join.drop_near_copies(docs, n=5, num=4, den=5)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 5, 2, 1 in turn; documents are repeated or left out accordingly."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    return piece_bpe.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", encoding_stage),
]

#: Random rounding, learned scores and subword encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = scratch_dir(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
