"""Registered queries of the operators in this folder, and their DuckDB texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from alertfold.llm import (
    ann, chat_format, exact_dedup, line_dedup, mixing, ngram_join, pii, piece_bpe, quality_rules, spelling, toxicity,
    url_filter, va_cluster,
)
from alertfold.llm.common import table
from alertfold.plans.registry import Query

QUERIES: dict[str, Query] = {}


def query(name: str, operator: str, oracle: str | None = None):
    def add(build):
        QUERIES[name] = Query(name, build, oracle, operator)
        return build
    return add


@query("op1_source_mix", "mixing sources to target weights")
def op1(spark, sf_dir):
    """All documents mixed 5:2:1 by source; not SQL: the rounding is random by hash."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query("op4_exact_dedup", "exact dedup", """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size
      FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents))
""")
def op4(spark, sf_dir):
    """Exact copies of all documents; the largest doc_id of equal texts stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op5_piece_bpe", "SentencePiece encoding and decoding")
def op5(spark, sf_dir):
    """Ids and round trip of every text; not SQL: subword merges."""
    return piece_bpe.encode_documents(table(spark, sf_dir, "documents"),
                                      public_tokenizers.path("piece_bpe_32k.model"), digests=True)


@query("op2_ngram_jaccard", "n-gram Jaccard join")
def op2(spark, sf_dir):
    """Near copies of all documents: 4-word shingles, Jaccard 0.85.  Not SQL: components."""
    return ngram_join.near_groups(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


@query("op6_toxicity", "toxicity")
def op6(spark, sf_dir):
    """Toxicity of every document.  Not SQL: a trained network."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_cross_polytope", "approximate nearest neighbours")
def op8(spark, sf_dir):
    """The 10 nearest vectors of every hundredth id among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


@query("op9_pii", "PII")
def op9(spark, sf_dir):
    """Personal data in every document.  Not SQL: learned spans."""
    return pii.detect(table(spark, sf_dir, "documents"))


@query("op10_url_filter", "URL filters")
def op10(spark, sf_dir):
    """Verdict on every page's URL.  Not SQL: language models."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@query("op3_line_templates", "line dedup", line_dedup.ORACLE)
def op3(spark, sf_dir):
    """All documents without the lines whose template recurs across documents."""
    clean = line_dedup.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("clean", 256).alias("clean_sha256"))


@query("op7_chat_repair", "chat formatting")
def op7(spark, sf_dir):
    """All conversations in legal turn order.  Not SQL: a dynamic program."""
    return chat_format.repair_conversations(table(spark, sf_dir, "conversations"))


@query("op13_rule_ledger", "quality rules", quality_rules.ORACLE)
def op13(spark, sf_dir):
    """Measurements, failure bits and the current policy's verdict on every document."""
    entries = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(entries, quality_rules.POLICIES[quality_rules.CURRENT])


@query("op12_spelling_variants", "spelling variant grouping")
def op12(spark, sf_dir):
    """Words of all documents with their form and root.  Not SQL: CRC-32 and chains."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op11_va_clusters", "centroid clustering")
def op11(spark, sf_dir):
    """16 centroids over all vectors, three rounds.  Not SQL: whole-number means in rounds of
    approximations."""
    return va_cluster.va_clusters(table(spark, sf_dir, "embeddings"))
