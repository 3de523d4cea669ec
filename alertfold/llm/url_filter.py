"""URL filter: rules by host and path, and a character language-model ratio for the rest.

The longest rule that fits decides.  URLs without a rule are judged by two smoothed Markov
models of their characters, one of accepted and one of rejected URLs: the difference of
the two log-likelihoods per character is held against a threshold.  The models mix the
orders 0 to ``ORDER``: each order's estimate falls back to the next shorter one by
Witten-Bell weights, so a context counts as far as it has been seen.

The models learn from all distinct URLs that a rule decides; a fifth of these, by hash, is
held out and sets the threshold, where both verdicts are got right equally often (all of
them, should a verdict have none held out).  A character and the ``ORDER`` before it are one
number, its window.  Windows are counted per verdict by map-side sums into a table that
follows the data; shorter orders are sums of it, and a window's log-likelihood ratio is
joined up from order to order.  A URL's score is the mean over its windows: by a broadcast
of up to ``BROADCAST_WINDOWS`` windows, by a join beyond.  Ratios add up as whole numbers,
so both ways and reruns agree.  With fewer than ``LEAST`` URLs of a verdict the models know
nothing and every URL without a rule is accepted.

The host stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path from there to ``?``, ``#`` or the end.  For NULL, and without
``://``, both are empty, no rule fits, and an empty text scores 0.  Repeated rows are
judged each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertfold.llm.arrow import slices
from alertfold.llm.common import ascii_lower, cut

HELD_OUT = 5                    # every fifth
LEAST = 5
ORDER = 5
BITS = 9                        # of a character in a window; ``ALPHABET`` stands before the URL's start
UNIT = 1 << 32                  # log-likelihood ratios are whole numbers of 1 / UNIT
BROADCAST_WINDOWS = 1_000_000
BINS = 4096
CUTS = 100_000                  # distinct scores that the driver looks through for the threshold
ALPHABET = 256

# Fixed values: (rule, verdict)
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    # (?s): a line feed inside a URL is a character like any other
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else NULL."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        of, start = text[:text.index("/")], text[text.index("/"):]
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def flatten(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters in one array (code points folded to the alphabet), each with its
    URL's start, and the URLs' lengths."""
    sizes = np.array([len(u) for u in urls], np.int64)
    codes = np.frombuffer("".join(urls).encode("utf-32-le"), np.uint32).astype(np.uint64)
    codes = np.where(codes < 128, codes, np.uint64(128) + codes % np.uint64(ALPHABET - 128))
    starts = np.cumsum(sizes) - sizes
    return codes, np.repeat(starts, sizes), sizes


def windows(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per character its window, the character itself in the lowest bits, and the URLs' lengths."""
    codes, start, sizes = flatten(urls)
    at, out = np.arange(len(codes)), codes.copy()
    for back in range(1, ORDER + 1):
        there = at - back
        before = np.where(there >= start, codes[np.maximum(there, 0)], np.uint64(ALPHABET))
        out |= before << np.uint64(BITS * back)
    return out.astype(np.int64), sizes


def _count_windows(batches):
    """``w, a, b``: windows of (url, allow, block) rows and how often each verdict has them."""
    for batch in (part for whole in batches for part in slices(whole, 0)):
        own, sizes = windows(batch.column(0).to_pylist())
        w, at = np.unique(own, return_inverse=True)
        sums = [np.bincount(at, np.repeat(batch.column(c).to_numpy(), sizes), minlength=len(w)).astype(np.int64)
                for c in (1, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(w), *map(pa.array, sums)], names=["w", "a", "b"])


def _mask(order: int):
    return F.lit((1 << BITS * (order + 1)) - 1).cast("long")


def window_ratios(urls: DataFrame) -> DataFrame:
    """``w, f`` for every window of ``url, verdict, held`` rows: the ratio, learned from those with
    a verdict that are not held out."""
    learn = [F.coalesce((F.col("verdict") == says) & ~F.col("held"), F.lit(False)).cast("long") for says in ("allow", "block")]
    counted = urls.select("url", learn[0].alias("a"), learn[1].alias("b")).mapInArrow(
        _count_windows, "w bigint, a bigint, b bigint")
    grams = {ORDER: cut(counted.groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))}
    for order in reversed(range(ORDER)):
        grams[order] = cut(grams[order + 1].groupBy(F.col("w").bitwiseAND(_mask(order)).alias("w"))
                           .agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    below = None
    for order in range(ORDER + 1):
        own = grams[order].withColumn("context", F.shiftright("w", BITS))
        contexts = own.groupBy("context").agg(
            *[F.sum(c).alias(f"seen_{c}") for c in "ab"], *[F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}") for c in "ab"])
        told = own.join(contexts, "context")
        if below is None:
            told = told.withColumn("p_a", F.lit(1.0 / ALPHABET)).withColumn("p_b", F.lit(1.0 / ALPHABET))
        else:
            told = told.withColumn("shorter", F.col("w").bitwiseAND(_mask(order - 1))).join(
                below.withColumnRenamed("w", "shorter"), "shorter")
        p = [F.when(F.col(f"seen_{c}") > 0, (F.col(c) + F.col(f"kinds_{c}") * F.col(f"p_{c}"))
                    / (F.col(f"seen_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"p_{c}")).alias(f"p_{c}") for c in "ab"]
        below = told.select("w", *p)
    return cut(below.select("w", F.round((F.log("p_a") - F.log("p_b")) * UNIT).cast("long").alias("f")))


def _spread_windows(batches):
    """``key, w, times`` of (key, url) rows."""
    for batch in (part for whole in batches for part in slices(whole, 1)):
        own, sizes = windows(batch.column(1).to_pylist())
        pairs = np.stack([np.repeat(np.arange(len(sizes)), sizes), own], 1)
        (at, w), times = (lambda u, n: (u.T, n))(*np.unique(pairs, axis=0, return_counts=True))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(w), pa.array(times.astype(np.int64))],
                                         names=["key", "w", "times"])


def scorer(urls: DataFrame, ratios: DataFrame):
    """A function that adds ``score`` to rows whose ``url`` is among ``urls``, NULL or empty."""
    if ratios.count() > BROADCAST_WINDOWS:
        key = F.unhex(F.md5("url"))
        spread = urls.select(key.alias("key"), "url").mapInArrow(_spread_windows, "key binary, w bigint, times bigint")
        scores = cut(spread.join(ratios, "w").groupBy("key").agg(
            (F.sum(F.col("f") * F.col("times")) / F.sum("times") / UNIT).alias("of_url")))
        return lambda rows: (rows.withColumn("key", key).join(scores, "key", "left")
                             .withColumn("score", F.coalesce("of_url", F.lit(0.0))).drop("key", "of_url"))
    local = ratios.toPandas().sort_values("w")
    shared = urls.sparkSession.sparkContext.broadcast((local["w"].to_numpy(), local["f"].to_numpy()))

    def score(rows: DataFrame) -> DataFrame:
        place = rows.columns.index("url")

        def run(batches):
            w, f = shared.value
            for batch in (part for whole in batches for part in slices(whole, place)):
                own, sizes = windows([u or "" for u in batch.column(place).to_pylist()])
                sums, ends = np.r_[0, np.cumsum(f[np.searchsorted(w, own)])], np.cumsum(sizes)
                total = sums[ends] - sums[ends - sizes]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(total / np.maximum(sizes, 1) / UNIT)],
                                                 names=[*batch.schema.names, "score"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", score double"
        return rows.mapInArrow(run, schema)
    return score


def threshold(scores: DataFrame) -> float:
    """Where both verdicts of ``verdict, score`` rows are got right equally often.  Accepted ones
    below a cut rise with it and rejected ones above it fall, so histograms of all scores
    close in on where they cross until the driver can look at each score."""
    each = [F.sum((F.col("verdict") == says).cast("long")).alias(c) for says, c in (("allow", "good"), ("block", "bad"))]
    scores = cut(scores.groupBy("score").agg(*each))
    whole = scores.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("score").alias("lo"),
                       F.max("score").alias("hi"), F.count("*").alias("n")).first()
    lo, hi, n = whole["lo"], whole["hi"], whole["n"]
    under = np.zeros(2)                   # accepted and rejected ones below lo
    lower, upper = lo, []                 # the next score below lo, and what comes after hi

    def faults(at):
        """Shares missed and passed by a cut at each row."""
        count = np.cumsum(at[["good", "bad"]].to_numpy(float), axis=0) - at[["good", "bad"]].to_numpy(float) + under
        return count[:, 0] / whole["good"], 1 - count[:, 1] / whole["bad"]

    while n > CUTS:
        place = F.least(F.floor((F.col("score") - lo) / F.lit((hi - lo) / BINS)), F.lit(BINS - 1))
        bins = (scores.filter(F.col("score").between(lo, hi)).groupBy(place.alias("bin"))
                .agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("score").alias("lo"),
                     F.max("score").alias("hi"), F.count("*").alias("n")).toPandas().sort_values("lo"))
        missed, passed = faults(bins)
        over = np.flatnonzero(missed >= passed)
        i = max(0, int(over[0]) - 1) if len(over) else len(bins) - 1
        if i + 1 < len(bins):
            upper = [(float(bins["lo"].iloc[i + 1]), float(missed[i + 1]), float(passed[i + 1]))]
        lower = float(bins["hi"].iloc[i - 1]) if i else lower
        under = under + bins[["good", "bad"]].to_numpy(float)[:i].sum(0)
        lo, hi, n = (bins[c].iloc[i].item() for c in ("lo", "hi", "n"))
    rows = scores.filter(F.col("score").between(lo, hi)).toPandas().sort_values("score")
    missed, passed = faults(rows)
    cuts = np.r_[rows["score"].to_numpy(float), [u[0] for u in upper]]
    missed, passed = np.r_[missed, [u[1] for u in upper]], np.r_[passed, [u[2] for u in upper]]
    best = int(np.argmin(np.maximum(missed, passed)))
    return float((cuts[best] + (cuts[best - 1] if best else lower)) / 2)


def fit(parts: DataFrame):
    """A function that adds ``score`` to the rows, and the threshold, from ``url, by_rule`` rows;
    or None."""
    urls = cut(parts.filter("url <> ''").select("url", F.col("by_rule").alias("verdict")).distinct()
               .withColumn("held", F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0))
    known = {r["verdict"]: r for r in urls.filter("verdict IS NOT NULL").groupBy("verdict").agg(
        F.count("*").alias("n"), F.sum(F.col("held").cast("long")).alias("held")).collect()}
    if any(says not in known or known[says]["n"] < LEAST or known[says]["held"] == known[says]["n"]
           for says in ("allow", "block")):
        return None
    score = scorer(urls, window_ratios(urls))
    judged = urls.filter("verdict IS NOT NULL")
    if all(r["held"] for r in known.values()):
        judged = judged.filter("held")
    return score, threshold(score(judged.select("url", "verdict")).select("verdict", "score"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every URL."""
    host, path = host_and_path(F.col("url"))
    parts = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
             .withColumn("host", host).withColumn("path", path))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    parts = parts.withColumn("rule", rule).withColumn("by_rule", verdict)
    model = fit(parts)
    if model is None:
        return parts.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit("allow")).alias("verdict"),
                            F.lit(0.0).alias("score"))
    score, least = model
    by_model = F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return score(parts).select("page_id", "host", "path", "rule",
                               F.coalesce("by_rule", by_model).alias("verdict"), "score")
