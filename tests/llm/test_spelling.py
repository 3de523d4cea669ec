"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from alertfold.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SCHEMA = "doc_id long, text string, word int, n string, block long"


def words_of(rows):
    count = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows):
    n = words_of(rows)
    beside = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(beside[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def corpus():
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcdeÀéÿß×÷") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    stems += ["aaaaa", "aaaab", "aaaa", "listen", "silent", "enlist", "x" * 3000, "x" * 2999 + "y", "x" * 3001, "étéétéé"]
    rows = []
    for i in range(260):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = stems[min(len(stems) - 1, int(rng.expovariate(0.08)))]
            k, c = rng.randrange(len(w)), rng.choice("abcÀz")
            w = rng.choice([w, w, w, w.upper(), w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])
            words.append(w)
        rows.append((i, rng.choice([" ", "\n", "1", "-", "中"]).join(words)))
    rows.append((1000, "chainaa " * 3 + "chainab " * 8 + "chainbb " * 20 + "chainbbé " * 50 + "chaonbbé " * 25))
    return rows + [(None, "listen listen listens " * 4), (3, None), (4, ""), (5, rows[5][1]), (5, rows[5][1])]


@pytest.mark.parametrize("tile, classes", [(S.TILE, None), (5, 1), (3, 4)])
def test_variants_match_brute_force(spark, tile, classes):
    rows = corpus()
    given = spark.createDataFrame([(i, t, 1, "n", 2) for i, t in rows], SCHEMA)
    got = S.variants(given, tile=tile, classes=classes).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = brute(rows)
    assert any(r[1] and r[1] != r[2] for r in want) and len(want) > 100
    assert sorted(map(tuple, got)) == want


def test_an_empty_table(spark):
    assert S.variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert S.variants(spark.createDataFrame([(1, None, 1, "", 1), (2, "ab cd", 1, "", 1)], SCHEMA)).collect() == []


def test_every_near_pair_lies_in_compared_blocks():
    rng = random.Random(9)
    of = S.letter_classes({c: 300 - c for c in range(97, 123)}, 4)
    for _ in range(300):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 9)))
        k, c = rng.randrange(len(a)), rng.choice("abcdefghé")
        b = rng.choice([a[:k] + a[k + 1:], a[:k] + c + a[k:], a[:k] + c + a[k + 1:]])
        x, y = S.block_keys([a, b], of, 4)
        assert (y in S.later_blocks(x)) + (x in S.later_blocks(y)) >= 1
        if x != y:
            assert (y in S.later_blocks(x)) + (x in S.later_blocks(y)) == 1


def test_long_words_stay_exact():
    a = np.full((1, 5000), 97, np.uint8)
    b = a.copy()
    b[0, 17] = 98
    assert [x.tolist() for x in S.near_pairs(a, b, False)] == [[0], [0]]
    assert [x.tolist() for x in S.near_pairs(a, a, False)] == [[], []]


def test_the_number_of_classes_follows_the_words():
    got = [S.n_classes(10 ** k) for k in range(2, 13)]
    assert got == sorted(got) and got[0] == 1 and got[-1] == S.MAX_CLASSES
