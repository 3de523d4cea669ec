"""Toxicity and nearest neighbours: gradients, held-out accuracy, recall against brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertfold.llm import ann, gru, toxicity


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = gru.Gru.fresh(rng)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) * 3
    windows = [["ab", "cde", "x", "hello", "ab"], ["cde", "world"], ["x"]]
    names = list(dict.fromkeys(w for win in windows for w in win))
    length = np.array([len(w) for w in windows])
    index = np.zeros((3, 5), int)
    for k, win in enumerate(windows):
        index[k, :len(win)] = [names.index(w) for w in win]
    of, bucket = gru.char_grams(names)
    order = np.argsort(of, kind="stable")
    args = (index, (of[order], bucket[order]), np.array([gru.word_bucket(w) for w in names]), length,
            np.array([1.0, 0.0, 1.0]), np.ones(3))
    _, grad = net.gradients(*args)
    for name in ("hf", "hb", "xf", "xb", "cf", "cb", "att", "out", "bias"):
        for at in [tuple(rng.integers(0, d) for d in net.p[name].shape) for _ in range(3)]:
            sides = []
            for step in (1e-4, -2e-4):
                net.p[name][at] += step
                sides.append(net.gradients(*args)[0])
            net.p[name][at] += 1e-4
            assert (sides[0] - sides[1]) / 2e-4 == pytest.approx(float(grad[name][at]), abs=2e-3)
    logits = gru.Gru(net.p)
    rows = [logits.rows(w) for w in windows]
    padded = np.zeros((3, 5), np.int32)
    for k, r in enumerate(rows):
        padded[k, :len(r)] = r
    got = logits.logits(padded, length)
    y = args[4]
    assert float(np.mean(np.logaddexp(0, got) - y * got)) == pytest.approx(net.gradients(*args)[0], abs=1e-3)


def test_windows_cover_whole_texts():
    for n in (1, 127, 128, 129, 500, 5000):
        at = toxicity.starts(n)
        seen = np.zeros(n, bool)
        for s in at:
            seen[s:s + toxicity.WINDOW] = True
        assert seen.all() and len(set(at)) == len(at)


def test_pieces_of_long_tokens_cover_the_whole_text():
    rng = random.Random(2)
    for n in (1, 64, 65, 68, 124, 125, 300, 5000):
        token = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n))
        words = gru.words_of(f"a {token} b")
        assert words[0] == "a" and words[-1] == "b" and max(map(len, words)) <= 64
        grams = {w[i:i + k] for w in words for k in (3, 4, 5) for i in range(len(w) - k + 1)}
        assert all(token[i:i + k] in grams for k in (3, 4, 5) for i in range(n - k + 1))
        joined = words[1] + "".join(w[4:] for w in words[2:-1])
        assert joined == token


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    plain = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    bad = ["scumbag", "idiotic", "worthless"]
    docs, labels = [], []
    for i in range(500):
        toxic = int(i % 4 == 0)
        words = [rng.choice(plain) for _ in range(rng.randint(20, 400))]
        for _ in range(len(words) // 30 + 1 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(bad)
        docs.append((i, " ".join(words), 0.5))
        labels.append((i, 1, toxic))
    docs += [(1000, None, 0.5), (1001, "", 0.5), (1002, "!!! ...", 0.5), (1003, "then " * 30_000, 0.5), (3, docs[3][1], 0.5)]
    labels += [(1000, None, None), (None, 1, 1), (99999, 0, 1)]
    return docs, labels


def test_toxicity_on_held_out_documents(spark, corpus):
    docs = spark.createDataFrame(corpus[0], "doc_id long, text string, score double")
    labels = spark.createDataFrame(corpus[1], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == len(corpus[0])
    truth = {i: t for i, _, t in corpus[1]}
    right = [r.predicted == truth[r.doc_id] for r in rows if r.doc_id < 500 and r.held_out]
    assert sum(right) / len(right) > 0.9
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
    by = {r.doc_id: r.score for r in rows}
    assert by[1000] == by[1001] == by[1002] == 0 and by[1003] < 0.7
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if not r.predicted)


def test_toxicity_without_labels_or_documents(spark, corpus):
    docs = spark.createDataFrame(corpus[0][:5], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    labels = spark.createDataFrame(corpus[1], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs.limit(0), labels).collect() == []


def brute_nearest(rows, k=10):
    out = {}
    for i, v in rows:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), j) for j, w in rows if j != i)
            out[i] = near[:k]
    return out


def test_nearest_recall_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    vecs = rng.normal(size=(1500, 24)).astype(np.float32)
    vecs[200:800] = vecs[200]  # one vector fills a good part of the table
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    odd = [(3000, None), (3100, [0.0] * 24), (3200, [float("nan")] + [1.0] * 23), (3300, [float("inf")] * 24),
           (3400, [1.0, 2.0]), (3500, [None] + [1.0] * 23), (None, [1.0] * 24)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows + odd + rows[:1]], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in ann.nearest(table, table.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    want = brute_nearest(rows)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = [got[q][k] for k in range(1, 11)]
        assert mine == sorted(mine)
        hits += len({j for _, j in near} & {j for _, j in mine})
        if 200 <= q < 800:
            assert [j for _, j in mine] == [j for _, j in near]  # ten equal vectors, smallest ids
    assert hits >= 0.9 * 10 * len(want)


def test_nearest_of_few_vectors(spark):
    table = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in (0, 1, 2, 100)], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(table, table.filter("vec_id % 100 = 0")).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (100, 1, 2), (100, 2, 1), (100, 3, 0)]
    assert ann.nearest(table.limit(0), table.limit(0)).collect() == []


@pytest.mark.parametrize("most,exact", [(1, True), (2, False)])
def test_nearest_recall_holds_where_the_probes_do_not_suffice(spark, monkeypatch, most, exact):
    monkeypatch.setattr(ann, "MAX_PROBES", most)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(6000, 24)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(table, table.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest(rows)
    recall = sum(len({j for _, j in near} & got[q]) for q, near in want.items()) / (10 * len(want))
    assert recall == 1 if exact else recall >= 0.93


def test_looks_grow_with_the_rows_and_hot_buckets_are_split(spark, monkeypatch):
    """Blocks of few vectors stand for many: twice the entries make no look go to more blocks than
    it probes, and a bucket with a third of all entries is split by id."""
    monkeypatch.setattr(ann, "BLOCK", 32)
    rng = np.random.default_rng(1)

    def tables(n):
        # 8 families; a third of the entries under one code, the others over n // 8 codes
        rest = np.where(np.arange(n) % 3 == 0, 7, rng.integers(0, n // 8, n))
        entries = spark.createDataFrame([(0, int(i % 8), int(r), int(i)) for i, r in enumerate(rest)],
                                        "t int, h long, rest long, rep long")
        looks = spark.createDataFrame([(0, q % 8, [int(x) for x in rng.integers(8, n // 8, 5)], q) for q in range(n // 100)],
                                      "t int, h long, rests array<long>, q long")
        return entries, looks

    sizes = []
    for n in (4000, 8000):
        entries, looks = tables(n)
        dealt, asked = ann._dealt(entries, looks)
        sizes.append(asked.count())
        key = ["t", "h", "block", "part"]
        assert dealt.count() == n
        assert dealt.groupBy(*key).count().agg(F.max("count")).first()[0] <= 4 * 32
        # every probed bucket's entries meet the look
        want = looks.select("t", "h", "q", F.explode("rests").alias("rest")).distinct().join(entries, ["t", "h", "rest"])
        met = asked.select(*key, "q", F.explode("rests").alias("rest")).distinct().join(dealt, [*key, "rest"])
        assert want.select("q", "rep").exceptAll(met.select("q", "rep").distinct()).isEmpty()
        assert met.count() == want.count()
    assert sizes[1] <= 2.6 * sizes[0] and sizes[1] <= 5 * 80 * 2


def test_nearest_with_small_blocks_and_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "CHUNK", 3)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16))
    x[::3] = x[0]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    x = x.astype(np.float32).astype(np.float64)
    hits = total = 0
    got = {}
    for r in ann.nearest(table, table.filter("vec_id % 30 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, 900, 30):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        hits += len(set(order) & {v for _, v, _ in got[q]})
        total += 10
        assert all(s == d[v] for _, v, s in got[q]) and [k for k, _, _ in sorted(got[q])] == list(range(1, 11))
    assert hits / total >= 0.9
