"""Line deduplication by a log-template tree; DataFrame functions only.

Every line of ``MIN_TOKENS`` tokens or more (white space apart) goes down a tree of fixed
depth: by its number of tokens, then by its first ``DEPTH`` tokens, tokens with a digit
read as ``<*>``.  In a leaf that lines of at least ``min_docs`` documents reach, the rest
is generalised: a token at a position that fewer than ``min_docs`` (document, line) pairs
of the leaf have there is variable and becomes ``<*>``.  What is left is the line's
template.  A template found in ``min_docs`` documents or more, with at least ``share`` of
its tokens fixed, recurs; its lines are dropped from every document.

Documents are counted once per template.  Equal lines are generalised once, however many
documents hold them; leaves count by map-side sums of one row per document and leaf,
and go to the lines as a broadcast up to ``BROADCAST_LEAVES``.  Joins on a leaf or line have a plain shuffle on both sides, which AQE splits when skewed.

NULL texts have no lines and stay NULL; empty texts have one empty line.  Rows without an
id count as one document.  Rows that repeat an id share their lines' counts, each row is
returned.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import cut
from alertfold.operators.small import bounded_broadcast

DEPTH = 3
MIN_TOKENS = 4
MIN_DOCS = 5
SHARE = 0.5
WILD = "<*>"
BROADCAST_LEAVES = 200_000


def masked(line: Column) -> Column:
    """The line's tokens, separated by single spaces, those with a digit as ``<*>``."""
    # most lines have single spaces only and need no pattern
    uneven = line.contains("  ")
    for c in "\t\x0b\x0c\r":
        uneven = uneven | line.contains(c)
    flat = F.trim(F.when(uneven, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))
    return F.when(F.regexp_like(flat, F.lit("[0-9]")), F.regexp_replace(flat, "[^ ]*[0-9][^ ]*", WILD)).otherwise(flat)


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def n_tokens(flat: Column) -> Column:
    return F.when(flat == "", 0).otherwise(F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n, lead, line``: each document's distinct masked lines of enough tokens."""
    return (docs.select("doc_id", F.explode(F.array_distinct(
                F.transform(F.split("text", "\n"), masked))).alias("line"))
            .withColumn("n", n_tokens(F.col("line"))).filter(F.col("n") >= MIN_TOKENS)
            .withColumn("lead", F.substring_index("line", " ", DEPTH)))


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``doc_id, key`` for the lines that are dropped; ``key`` is the masked line's 128-bit hash."""
    leaf = ["n", "lead"]
    lines = _lines(docs)
    leaves = (lines.select("doc_id", *leaf).distinct().groupBy(*leaf).agg(F.count("*").alias("docs"))
              .filter(F.col("docs") >= min_docs).select(*leaf))
    # few leaves spare the other lines a shuffle; beyond the bound both sides are shuffled
    near = cut(lines.select("doc_id", *leaf, "line").join(bounded_broadcast(leaves, BROADCAST_LEAVES), leaf).distinct()
               .withColumn("key", line_key(F.col("line"))))
    once = near.groupBy(*leaf, "key").agg(F.count("*").alias("pairs"), F.any_value("line").alias("line"))
    tokens = cut(once.select(*leaf, "key", "pairs", F.posexplode(F.split("line", " ")).alias("pos", "token")))
    fixed = (tokens.groupBy(*leaf, "pos", "token").agg(F.sum("pairs").alias("support"))
             .filter(F.col("support") >= min_docs))
    told = tokens.join(fixed, [*leaf, "pos", "token"], "left")
    is_fixed = F.col("support").isNotNull() & (F.col("token") != WILD)
    templates = (told.groupBy("key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.when(is_fixed, F.col("token"))
                                                                      .otherwise(WILD).alias("token")))),
                                 lambda x: x["token"]), " ").alias("template"),
        F.avg(is_fixed.cast("double")).alias("fixed"))
        .filter(F.col("fixed") >= share).select("key", "template"))
    of_doc = cut(near.select("doc_id", "key").join(templates, "key"))
    often = (of_doc.select("doc_id", "template").distinct().groupBy("template").agg(F.count("*").alias("docs"))
             .filter(F.col("docs") >= min_docs).select("template"))
    return of_doc.join(often, "template").select("doc_id", "key")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``doc_id, n_lines, n_dropped, clean``: the text without its recurring lines."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    drop = (recurring_lines(docs.filter("text IS NOT NULL"), min_docs, share)
            .groupBy(F.col("doc_id").alias("of")).agg(F.collect_set("key").alias("gone")))
    lines = F.split("text", "\n")
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("gone", line_key(masked(x)))))
    return (docs.join(drop.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("of")), "left")
            .withColumn("lines", lines).withColumn("kept", kept)
            .select("doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.array_join("kept", "\n").alias("clean")))


#: DuckDB: the same rules over ``documents``.
ORACLE = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
flat AS (
  SELECT doc_id, regexp_replace(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')),
                                '[^ ]*[0-9][^ ]*', '<*>', 'g') AS line FROM raw),
lines AS (
  SELECT DISTINCT doc_id, line, len(string_split(line, ' ')) AS n,
         array_to_string(string_split(line, ' ')[1:3], ' ') AS lead
  FROM flat WHERE line <> '' AND len(string_split(line, ' ')) >= 4),
near AS (
  SELECT l.* FROM lines l JOIN (
    SELECT n, lead FROM lines GROUP BY n, lead HAVING count(DISTINCT doc_id) >= 5) USING (n, lead)),
tokens AS (
  SELECT n, lead, line, pairs, unnest(string_split(line, ' ')) AS token,
         generate_subscripts(string_split(line, ' '), 1) AS pos
  FROM (SELECT n, lead, line, count(*) AS pairs FROM near GROUP BY n, lead, line)),
told AS (
  SELECT *, sum(pairs) OVER (PARTITION BY n, lead, pos, token) >= 5 AND token <> '<*>' AS fixed FROM tokens),
templates AS (
  SELECT n, lead, line, string_agg(CASE WHEN fixed THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS template
  FROM told GROUP BY n, lead, line HAVING avg(CASE WHEN fixed THEN 1.0 ELSE 0.0 END) >= 0.5),
gone AS (
  SELECT DISTINCT doc_id, line FROM near JOIN templates USING (n, lead, line)
  WHERE template IN (SELECT template FROM near JOIN templates USING (n, lead, line)
                     GROUP BY template HAVING count(DISTINCT doc_id) >= 5)),
placed AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents WHERE text IS NOT NULL),
marked AS (
  SELECT p.doc_id, p.line, p.place, g.line IS NOT NULL AS dropped FROM placed p LEFT JOIN gone g
  ON p.doc_id = g.doc_id AND g.line = regexp_replace(trim(regexp_replace(p.line, '[\x20\x09-\x0D]+', ' ', 'g')),
                                                    '[^ ]*[0-9][^ ]*', '<*>', 'g'))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS clean_sha256
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""
