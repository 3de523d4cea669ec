"""Quality rules as a bitmask ledger; DataFrame functions only.

Every rule looks at every document once.  The ledger stores, per document, the measurements
the rules read and one number whose bit i says that rule i failed.  Policies come
afterwards and never touch a text again: a policy is a version, a mask of rules that must
hold, and a mask of softer rules of which it forgives a few; its verdict is two ANDs and a
bit count.  What each rule costs under a policy (``ablations``) follows from the number of
documents per failure pattern, which are counted on the map side and are at most
2 ** rules, however many documents there are.

Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage
return.  A window is eight words in a row; windows of one document are told apart by 128
bits of hash.  A document is one row through the whole pass: no shuffle, and no state beyond
its own words.

NULL and empty texts have no words and fail ``few_words`` alone.  Rows with a NULL id and
rows that repeat an id are measured each, an empty table gives no rows, other columns are
ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``failed`` reads the measurements; it is never NULL."""
    name: str
    failed: Callable[[], Column]


def _c(name: str) -> Column:
    return F.col(name)


#: The rules by bit, the first one bit 0.  New rules go to the end: stored ledgers keep their meaning.
RULES = (
    Rule("few_words", lambda: _c("n_words") < 20),
    Rule("repeated_windows", lambda: 100 * _c("n_repeat_words") > 30 * _c("n_words")),
    Rule("symbols", lambda: 10 * _c("n_symbols") > _c("n_words")),
    Rule("repeated_lines", lambda: 100 * _c("n_dup_lines") > 40 * _c("n_lines")),
    Rule("word_length", lambda: (_c("n_words") > 0) & ((_c("word_chars") < 2 * _c("n_words"))
                                                       | (_c("word_chars") > 20 * _c("n_words")))),
    Rule("digits", lambda: 100 * _c("n_digits") > 50 * _c("word_chars")),
    Rule("capitals", lambda: 100 * _c("n_capitals") > 60 * _c("word_chars")),
)


def bits(*names: str) -> int:
    """The mask of the named rules."""
    at = {rule.name: i for i, rule in enumerate(RULES)}
    return sum(1 << at[name] for name in set(names))


@dataclass(frozen=True)
class Policy:
    """Keeps a document that fails none of ``hard`` and at most ``forgiven`` of ``soft``."""
    version: str
    hard: int
    soft: int = 0
    forgiven: int = 0

    def keeps(self, fails: Column) -> Column:
        held = fails.bitwiseAND(F.lit(self.hard)) == 0
        return held & (F.bit_count(fails.bitwiseAND(F.lit(self.soft))) <= self.forgiven)

    def without(self, bit: int) -> Policy:
        return Policy(f"{self.version}-{bit}", self.hard & ~bit, self.soft & ~bit, self.forgiven)


BASE = bits("few_words", "repeated_windows")
POLICIES = {p.version: p for p in (
    Policy("base", BASE),
    Policy("2", BASE | bits("symbols", "capitals"), bits("repeated_lines", "word_length", "digits"), 0),
    Policy("2-lenient", BASE | bits("symbols"), bits("repeated_lines", "word_length", "digits", "capitals"), 1),
)}
CURRENT = "2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_capitals")


def _spaced(text: Column) -> Column:
    """Every white-space character as one space (byte searches, no pattern)."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements, one row per row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    flat = _spaced(F.col("text"))
    has_word = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    first = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id",
        F.array_remove(F.split(flat, " "), "").alias("words"),
        F.length(F.replace(flat, F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        has_word.alias("lines"))
    # each step's arrays are columns of the step below: a lambda never computes them again
    size = F.size("words")
    hashes = F.when(size >= WINDOW, F.transform(
        F.sequence(F.lit(1), size - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
    second = first.withColumn("hashes", hashes)
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = F.when(repeats, F.array_sort(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("h"), F.xxhash64(F.lit(1), F.slice("words", i + 1, WINDOW)).alias("g"),
                                        i.alias("i")))))
    third = second.withColumn("placed", placed)

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (a["g"] == b["g"]), F.lit(False))

    again = F.filter("placed", lambda x, k: same(F.get("placed", k - 1), x) | same(F.get("placed", k + 1), x))
    starts = F.array_sort(F.transform(again, lambda x: x["i"]))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(starts, zero, lambda acc, s: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), s - acc["last"])).alias("n"), s.alias("last")), lambda acc: acc["n"])
    return third.select(
        "doc_id", size.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("placed").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), "n_digits", "n_capitals")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements, and ``fails``: bit i is set where rule i failed."""
    fails = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        fails = fails + F.when(rule.failed(), F.lit(1 << i)).otherwise(F.lit(0))
    return measure(docs, id_col, text_col).withColumn("fails", fails.cast("long"))


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``policy`` (its version), ``base_failed`` and ``kept``."""
    return (entries.withColumn("policy", F.lit(policy.version))
            .withColumn("base_failed", F.col("fails").bitwiseAND(F.lit(BASE)) != 0)
            .withColumn("kept", ~F.col("base_failed") & policy.keeps(F.col("fails"))))


def failed_rules(fails: Column) -> Column:
    """The names of the rules whose bits are set."""
    return F.array_compact(F.array(*[F.when(fails.bitwiseAND(F.lit(1 << i)) != 0, F.lit(rule.name))
                                     for i, rule in enumerate(RULES)]))


def ablations(entries: DataFrame, policies: Iterable[Policy]) -> DataFrame:
    """Per policy and rule: ``docs``, ``kept`` (by the policy), ``failed`` (documents that fail
    the rule), ``failed_alone`` (no other rule of the policy), ``kept_without`` (by the policy
    without the rule).  One pass over the ledger's ``fails``; no rows for an empty ledger."""
    patterns = entries.groupBy("fails").agg(F.count("*").alias("docs"))
    out = None
    fails, docs = F.col("fails"), F.col("docs")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, docs)), F.lit(0)).cast("long")

    for policy in policies:
        mask = policy.hard | policy.soft
        each = F.array(*[F.struct(
            F.lit(rule.name).alias("rule"), (fails.bitwiseAND(F.lit(1 << i)) != 0).alias("failed"),
            (fails.bitwiseAND(F.lit(mask | 1 << i)) == 1 << i).alias("alone"),
            policy.without(1 << i).keeps(fails).alias("without")) for i, rule in enumerate(RULES)])
        part = (patterns.select("docs", policy.keeps(fails).alias("kept"), F.explode(each).alias("r"))
                .groupBy(F.lit(policy.version).alias("policy"), F.col("r.rule").alias("rule"))
                .agg(F.sum("docs").alias("docs"), total(F.col("kept")).alias("kept"),
                     total(F.col("r.failed")).alias("failed"), total(F.col("r.alone")).alias("failed_alone"),
                     total(F.col("r.without")).alias("kept_without")))
        out = part if out is None else out.unionByName(part)
    return out


#: DuckDB: the ledger and the current policy over ``documents``.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
counted AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
places AS (
  SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM counted WHERE len(words) >= 8),
windows AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i:i + 7]) AS times FROM places),
repeated AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM windows, range(8) AS r(k) WHERE times > 1 GROUP BY rid),
measured AS (
  SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM counted LEFT JOIN repeated USING (rid)),
judged AS (
  SELECT *, n_words < 20 AS r0, 100 * n_repeat_words > 30 * n_words AS r1, 10 * n_symbols > n_words AS r2,
         100 * n_dup_lines > 40 * n_lines AS r3,
         n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) AS r4,
         100 * n_digits > 50 * word_chars AS r5, 100 * n_capitals > 60 * word_chars AS r6 FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_digits, n_capitals,
       (r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT)::BIGINT AS fails,
       '2' AS policy, r0 OR r1 AS base_failed, NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5 OR r6) AS kept
FROM judged
"""
