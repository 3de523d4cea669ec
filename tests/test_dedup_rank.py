"""Keep-first dedup and exact positions (FIXTURES C9-C11), checked against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertfold.operators import dedup, rank


def test_c9_null_keys(spark):
    df = spark.createDataFrame([(1, "R1", "a"), (2, "R1", "b"), (3, None, "c"), (4, None, "d"), (5, "R2", "e")],
                               "o long, k string, v string")
    collapse = sorted(tuple(r) for r in dedup.dedup_first(df, ["k"], "o").collect())
    keep = sorted(tuple(r) for r in dedup.dedup_first(df, ["k"], "o", null_key="keep").collect())
    assert collapse == [(1, "R1", "a"), (3, None, "c"), (5, "R2", "e")]
    assert keep == [(1, "R1", "a"), (3, None, "c"), (4, None, "d"), (5, "R2", "e")]
    win = sorted(tuple(r) for r in dedup.dedup_first_window(df, ["k"], "o").collect())
    assert win == collapse


def test_c10_global_vs_month(spark):
    df = spark.createDataFrame([(1, "R1", "2025_01"), (2, "R1", "2025_02")], "o long, k string, ym string")
    assert dedup.dedup_first(df, ["k"], "o").count() == 1
    assert dedup.dedup_first(df, ["ym", "k"], "o").count() == 2


def test_content_dedup_null_equals_nan_text_and_survivor_keeps_its_values(spark):
    # NULL and 'nan' are the same content; the first row is kept exactly as it was
    rows = [(1, None, "x", 5), (2, "nan", "x", 5), (3, "nan", None, 6), (4, None, "nan", 6),
            (5, "a", "b", 7), (6, "a", "b", 8), (7, "", "b", 7)]
    df = spark.createDataFrame(rows, "o long, v string, w string, n int").repartition(3)
    got = sorted(tuple(r) for r in dedup.dedup_content(df, ["v", "w", "n"], "o").collect())
    assert got == [(1, None, "x", 5), (3, "nan", None, 6), (5, "a", "b", 7), (6, "a", "b", 8), (7, "", "b", 7)]
    assert dedup.dedup_content(df, ["v", "w", "n"], "o").columns == ["o", "v", "w", "n"]


def test_c11_content_first_file_wins(spark):
    df = spark.createDataFrame([("b.csv", 1, "x", None), ("a.csv", 7, "x", None), ("a.csv", 8, "y", "1")],
                               "f string, pos long, v string, w string")
    df = df.withColumn("o", F.struct("f", "pos"))
    got = sorted((r["f"], r["v"]) for r in dedup.dedup_content(df, ["v", "w"], "o").collect())
    assert got == [("a.csv", "x"), ("a.csv", "y")]


def test_dedup_matches_brute_force(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice(["A", "B", "C", None]), rnd.randint(0, 3)) for i in rnd.sample(range(1000), 300)]
    df = spark.createDataFrame(data, "o long, k string, g int").repartition(7)
    got = sorted(tuple(r) for r in dedup.dedup_first(df, ["k", "g"], "o").collect())
    best = {}
    for o, k, g in data:
        if (k, g) not in best or o < best[(k, g)][0]:
            best[(k, g)] = (o, k, g)
    assert got == sorted(best.values(), key=lambda t: (t[0],)) or got == sorted(best.values())


def test_rank_within_matches_row_number(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice(["hot"] * 8 + ["a", "b"]), rnd.random()) for i in range(500)]
    df = spark.createDataFrame(data, "id long, g string, v double").repartition(5)
    got = {r["id"]: r["pos"] for r in rank.rank_within(df, ["g"], ["v", "id"]).collect()}
    for g in {"hot", "a", "b"}:
        ids = [i for i, gg, v in sorted((d for d in data if d[1] == g), key=lambda t: (t[2], t[0]))]
        assert [got[i] for i in ids] == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("n", [0, 1, 2, 5, 6, 101])
def test_exact_median(spark, n):
    rnd = random.Random(n)
    vals = [float(rnd.randint(0, 20)) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    got = rank.exact_median(df, "x").first()["median"]
    assert got == (float(np.median(vals)) if vals else None)


@pytest.mark.parametrize("case", ["spread", "ties", "one_value", "hot_block", "even"])
def test_exact_median_by_narrowing(spark, case):
    # small accuracy and collect limit force several narrowing rounds (and the fallbacks)
    rnd = random.Random(11)
    if case == "spread":
        vals = [rnd.random() * 1e6 for _ in range(3001)]
    elif case == "ties":
        vals = [float(rnd.randint(0, 20)) for _ in range(3000)]
    elif case == "one_value":
        vals = [7.0] * 2000
    elif case == "hot_block":     # a third of the values in one tie block just off the middle
        vals = [5.0] * 1000 + [rnd.uniform(5.5, 10) for _ in range(1100)] + [rnd.uniform(0, 4.5) for _ in range(900)]
    else:
        vals = [float(i) for i in range(4000)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double").repartition(4)
    for kw in ({"accuracy": 50, "max_collect": 10}, {"accuracy": 1000, "max_collect": 200}, {}):
        got = rank.exact_median(df, "x", **kw).first()["median"]
        assert got == float(np.median(vals)), (case, kw)
    assert rank.exact_median_sorted(df, "x").first()["median"] == float(np.median(vals))


def test_positions_joined_back_to_wide_rows(spark):
    import random
    from collections import defaultdict

    from alertfold.operators.rank import rank_within
    rng = random.Random(6)
    rows = [(i, None if rng.random() < 0.3 else rng.randint(0, 4), rng.random(), "payload" * 20) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, g int, o double, wide string")
    got = rank_within(df, ["g"], ["o", "i"], join_back=True)
    assert got.columns == [*df.columns, "pos"]
    want, groups = {}, defaultdict(list)
    for i, g, o, _ in rows:
        groups[g].append((o, i))
    for members in groups.values():
        want.update({i: k for k, (_, i) in enumerate(sorted(members), 1)})
    assert {r.i: r.pos for r in got.collect()} == want
