"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups.

Texts are equal when they agree after lower-casing A-Z; a NULL text counts as empty.  Of
equal texts the row with the largest id stays.

1. One pass hashes every text and aggregates to one short row per (hash, id).
2. Groups are counted with map-side partial aggregation, so a hash shared by a third of
   all rows costs one partial row per task.  The group's keeper goes back to the members
   through a salted join.
3. Only members of groups of two or more fetch their text.  Each is compared byte by byte
   with its keeper's text; a big group is cut into blocks of ``BLOCK`` members, each with
   its own copy of the keeper's text.
4. Members that differ from the keeper (two texts under one hash) are grouped again by
   their bytes.

Rows that repeat an id and its text are one document: each is returned, and only the first
is kept.  A NULL id loses against any other; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import ascii_lower, cut, fresh

SALTS = 32
BLOCK = 256


def content_hash(norm: Column) -> Column:
    """128-bit hash of the normalised text."""
    return F.unhex(F.md5(norm))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    norm = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    texts = docs.select("doc_id", norm.alias("norm"))
    members = cut(
        texts.select("doc_id", hash_of(F.col("norm")).alias("h"), F.sha2("norm", 256).alias("sha"))
        .groupBy("h", "sha", "doc_id").agg(F.count("*").alias("n")))

    groups = (members.groupBy("h").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("size"),
                                       F.count("*").alias("parts"))
              .filter("parts > 1")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salt = F.pmod(F.xxhash64("doc_id", "sha"), F.lit(SALTS)).cast("int")
    tagged = cut(members.withColumn("salt", salt).join(groups, ["h", "salt"], "left").drop("salt"))

    single = tagged.filter("parts IS NULL").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.col("n").alias("size"), "n", "sha")
    multi = tagged.filter("parts IS NOT NULL")
    checked = cut(_compare(docs, norm, multi, hash_of))

    cols = ["doc_id", "keep_id", "size", "n", "sha"]
    odd, same = checked.filter("NOT same"), checked.filter("same")
    out = single.select(cols)
    if not odd.isEmpty():
        # texts that share a hash with others but not their bytes: grouped again by the bytes
        odd_keep = odd.groupBy("norm").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("size"))
        out = out.unionByName(odd.select("doc_id", "n", "sha", "norm").join(odd_keep, "norm").select(cols))
        lost = odd.groupBy("h").agg(F.sum("n").alias("lost"))
        same = (same.join(lost, "h", "left")
                .withColumn("size", F.col("size") - F.coalesce("lost", F.lit(0))))
    out = out.unionByName(same.select(cols))
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
            .select("doc_id", "keep_id", F.col("size").alias("group_size"),
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def _compare(docs: DataFrame, norm: Column, multi: DataFrame, hash_of) -> DataFrame:
    """Members with ``same``: whether their bytes are their keeper's.  Only differing rows
    carry their text on."""
    wanted = multi.hint("shuffle_hash")
    # the one pass that moves texts; what it computes, it computes for members alone
    found = (docs.alias("t").join(wanted.alias("m"), F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")))
             .select("m.doc_id", "h", "sha", "n", "keep_id", "size", norm.alias("norm"))
             .filter((hash_of(F.col("norm")) == F.col("h")) & (F.sha2("norm", 256) == F.col("sha"))))
    found = cut(found)
    # a repeated row fetches its text as often as it is repeated; one is enough
    one = found.filter("n = 1").unionByName(
        found.filter("n > 1").dropDuplicates(["doc_id", "h", "sha"]))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    is_keeper = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # of several texts under the keeper's id and hash, the smallest digest stands for it
    keepers = (one.filter(is_keeper).groupBy("h").agg(
        F.min_by("norm", "sha").alias("keeper_norm"), F.max(blocks).alias("blocks"))
        .select("h", "keeper_norm", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    block = F.pmod(F.xxhash64("doc_id", "sha"), blocks).cast("int")
    return (one.withColumn("block", block).join(keepers, ["h", "block"])
            .withColumn("same", F.col("norm") == F.col("keeper_norm"))
            .select("doc_id", "h", "sha", "n", "keep_id", "size", "same",
                    F.when(~F.col("same"), F.col("norm")).alias("norm")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of ``docs`` that stay, with all their columns; of rows that repeat a kept
    id and its text, NULL ids among them, one stays.  Columns may have any names."""
    row_sha, keep_id, keep_sha, keep_n, key_id, whole = fresh(
        docs, "_row_sha", "_keep_id", "_keep_sha", "_keep_n", "_key_id", "_whole_row")
    kept = cut(exact_groups(docs, id_col, text_col).filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
               .groupBy(F.col("doc_id").alias(keep_id), F.col("text_sha256").alias(keep_sha))
               .agg(F.count("*").alias(keep_n)))
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))

    def hit(keys: DataFrame) -> DataFrame:
        return docs.withColumn(row_sha, F.sha2(norm, 256)).join(
            keys.hint("shuffle_hash"),
            F.col(id_col).eqNullSafe(F.col(keep_id)) & (F.col(row_sha) == F.col(keep_sha)), "left_semi")

    repeated = kept.filter(F.col(keep_n) > 1)
    out = hit(kept.filter(F.col(keep_n) == 1)).drop(row_sha)
    if repeated.isEmpty():
        return out
    return out.unionByName(one_of_each(hit(repeated), [F.col(id_col).alias(key_id), F.col(row_sha)], docs.columns, whole))


def one_of_each(rows: DataFrame, key: list[Column], columns: list[str], whole: str) -> DataFrame:
    """One row for each key, with ``columns``: map-side sums of one row per task and key; the
    smallest hash of a row decides, so reruns agree."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    return rows.groupBy(*key).agg(F.min_by(row, F.md5(F.to_json(row))).alias(whole)).select(f"{whole}.*")
