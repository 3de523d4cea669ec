"""Exact dedup, n-gram join, line dedup, components: small fixtures against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from alertfold.llm import exact_dedup, line_dedup, ngram_join
from alertfold.llm.components import components

SCHEMA = "doc_id long, text string, keep_id string, component_id int, size string"


def docs(spark, rows):
    """Documents with further columns whose names clash with results."""
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)


def lower(text):
    return (text or "").encode().lower().decode()


ROWS = [(1, "Same text"), (2, "same TEXT"), (3, None), (4, ""), (5, "Éa"), (6, "éa"), (7, "éA"), (8, "other"),
        (8, "other"), (9, "x" * 50_000), (10, "X" * 50_000), (None, "same text"), (11, " same text")]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_match_brute_force_even_when_hashes_collide(spark, weak):
    hash_of = (lambda c: F.lit(b"one")) if weak else exact_dedup.content_hash
    got = exact_dedup.exact_groups(docs(spark, ROWS), hash_of=hash_of).collect()
    groups = defaultdict(list)
    for i, t in ROWS:
        groups[lower(t)].append(i)
    assert len(got) == len(ROWS)
    want = sorted((str(i), max(x for x in groups[lower(t)] if x is not None), len(groups[lower(t)]),
                   hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in ROWS)
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r.doc_id for r in got if r.kept]
    assert sorted(kept) == sorted(max(x for x in g if x is not None) for g in groups.values())


def test_drop_exact_copies_keeps_columns_and_one_of_each(spark):
    left = exact_dedup.drop_exact_copies(docs(spark, [r for r in ROWS if r[0] != 8]))
    assert left.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 7, 10, 11]


def test_drop_exact_copies_keeps_one_of_repeated_rows_and_null_ids(spark):
    rows = ROWS * 2 + [(None, "No id"), (None, "no ID"), (None, "no id"), (8, "another text")]
    left = exact_dedup.drop_exact_copies(docs(spark, rows))
    assert left.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["2", "4", "5", "7", "8", "8", "10", "11", "None"])


def test_exact_groups_of_an_empty_table(spark):
    assert exact_dedup.exact_groups(docs(spark, [])).collect() == []


def brute_groups(rows, n, num, den):
    sets = {}
    for k, (_, t) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[k] = frozenset() if not w else frozenset([tuple(w)]) if len(w) < n else frozenset(zip(*(w[j:] for j in range(n))))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * common >= num * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("n,num,den", [(4, 85, 100), (5, 4, 5), (2, 1, 2)])
def test_near_groups_match_brute_force(spark, monkeypatch, n, num, den):
    rng = random.Random(n)
    monkeypatch.setattr(ngram_join, "FRAGMENT_GRAMS", 700)  # several fragments
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, base = [], []
    for i in range(120):
        if i % 4 == 0 or not base:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
            if i % 3 == 0:
                words += passage
        else:
            words = list(rng.choice(base[-6:]))
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        base.append(words)
        rows.append((1000 - i, rng.choice([" ", "\n", "\t "]).join(words).upper()))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "é b"),
             (2007, "É b"), (2008, " ".join(vocabulary * 40)), (2009, " ".join(vocabulary * 40) + " end")]
    got = ngram_join.near_groups(docs(spark, rows), n, num, den).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_groups(rows, n, num, den)


def test_near_groups_nulls_repeats_and_empty(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f g"), (9, None)]
    got = ngram_join.near_groups(docs(spark, rows), 2, 1, 2).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == [
        ("5", 5, 5), ("5", 5, 5), ("7", 6, 5), ("9", 0, 9), ("None", 5, None)]
    assert ngram_join.near_groups(docs(spark, [])).collect() == []
    # a row without an id loses against its near copy with one
    left = ngram_join.drop_near_copies(docs(spark, rows[2:]), 2, 1, 2)
    assert sorted(str(r.doc_id) for r in left.collect()) == ["7", "9"]


def test_drop_near_copies_goes_by_row(spark):
    """Rows of one id or of none are documents of their own; columns may have any names."""
    base = "one two three four five six seven eight nine ten"
    rows = [(3, base), (3, base + " x"), (3, "quite another text here"), (None, base + " y"), (8, base), (None, "alone in the world"),
            (None, "alone in the world"), (9, "z z z z"), (9, "z z z z"), (10, None), (10, None), (None, None), (11, "")]
    table = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in rows],
                                  "doc_id long, text string, _near_id string, _digest string, _ident int")
    left = ngram_join.drop_near_copies(table, 2, 1, 2)
    assert left.columns == table.columns
    first = min([base, base + " x"], key=lambda t: hashlib.md5(t.encode()).hexdigest())
    want = [("3", first), ("3", "quite another text here"), ("None", "alone in the world"), ("9", "z z z z"), ("10", None),
            ("None", None), ("11", "")]
    assert sorted(((str(r.doc_id), r.text) for r in left.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("hot", [256, 3])
def test_many_fragments_and_a_common_n_gram(spark, monkeypatch, hot):
    """More fragments than 16 bits count, and n-grams that all sets share."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    assert len({int(f) for f in ngram_join._fragment(np.linspace(0, 2 ** 64 - 1, 200_000).astype(np.uint64), 40_000)}) == 40_000
    rng = random.Random(5)
    rows = []
    for i in range(90):
        words = [f"w{rng.randint(0, 30)}" for _ in range(12)]
        rows.append((i, "all sets share this " * 2 + " ".join(words)))
        if i % 3 == 0:
            rows.append((1000 + i, "all sets share this " * 2 + " ".join(words[:-1])))
    from alertfold.llm.ngram_join import gram_set
    sets = {i: set(gram_set(t, 2).tolist()) for i, t in rows}
    best = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and best[b] < best[a]:
                    best[a], changed = best[b], True
    monkeypatch.setattr(ngram_join, "FRAGMENT_GRAMS", 20)
    got = {r.doc_id: r.component_id for r in ngram_join.near_groups(docs(spark, rows), 2, 4, 5).collect()}
    assert got == best and len(set(best.values())) < len(best)


@pytest.mark.parametrize("bits", [0, 1, 7, 8, 9, 16, 20])
def test_hashes_are_whole_again_in_their_fragments(bits):
    grams = np.random.default_rng(bits).integers(0, 2 ** 64, 5000, dtype=np.uint64)
    grams[:2] = 0, 2 ** 64 - 1
    fragment = ngram_join._fragment(grams, 1 << bits)
    for f in np.unique(fragment)[:300]:
        own = grams[fragment == f]
        assert (ngram_join._whole(ngram_join._low(own, 1 << bits).tobytes(), int(f), 1 << bits) == own).all()


def test_n_grams_are_told_apart_by_all_their_bits(monkeypatch):
    """Two hashes that differ in their highest bit alone, in one fragment."""
    a, b = 5, 5 + (1 << 63)
    sets = {"p": [a, 7], "q": [b, 8]}
    monkeypatch.setattr(ngram_join, "gram_set", lambda text, n: np.array(sorted(sets[text]), np.uint64))
    packs = pa.Table.from_batches(list(ngram_join._deal(2, 1)([pa.RecordBatch.from_pydict({"text": ["p", "q"]})])))
    grams = packs.filter(pa.compute.equal(packs["grp"], 0))
    assert ngram_join._count(1)((pa.scalar(0),), grams).num_rows == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (300, 299)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 130))
    assert got[300] == got[299] == 299 and 200 not in got


def test_line_templates_drop_recurring_lines_only(spark):
    shared = [(i, f"Page {i} of our site was made in {1990 + i} by us\nown line number {'abcdefgh'[i]} that stays here ok")
              for i in range(8)]
    rows = shared + [(20, None), (21, ""), (22, "Page 3 of our site was made in 2001 by us"), (23, "a b\n\nPage"),
                     (24, "word " * 30_000)]
    got = {r.doc_id: r for r in line_dedup.drop_recurring_lines(docs(spark, rows), min_docs=9).collect()}
    assert len(got) == len(rows)
    for i in range(8):
        assert (got[i].n_lines, got[i].n_dropped) == (2, 1) and got[i].clean == rows[i][1].split("\n")[1]
    assert got[20].clean is None and got[20].n_lines == 0
    assert got[21].clean == "" and got[22].clean == "" and got[22].n_dropped == 1
    assert got[23].clean == "a b\n\nPage" and got[24].n_dropped == 0
    assert line_dedup.drop_recurring_lines(docs(spark, [])).collect() == []
