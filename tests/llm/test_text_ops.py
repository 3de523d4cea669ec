"""Mixing, subword encoding, personal data, URL filter, chat repair: against brute force."""

import collections
import hashlib
import itertools
import os
import random
import re
import sys
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from alertfold.llm import chat_format, mixing, pii, piece_bpe, url_filter
from alertfold.llm.boosting import Boosted, fit_table

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import url_models  # noqa: E402
from url_models import Markov, ratio  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# -- mixing ----------------------------------------------------------------------------

def targets_by_hand(sizes, weights=(5, 2, 1), cap=3):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / open_ > cap * sizes[s]} if open_ else set()
        if not over:
            return {s: cap * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        full |= over


@pytest.mark.parametrize("block", [4096, 3])
def test_mix_hits_targets_and_repeats_itself(spark, block):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a", "b", "b", "b", "c", "Z", None]), 7)
            for i in range(400)]
    rows += [(400, None, "a", 7), (401, "w " * 5, "tiny", 7), (5, rows[5][1], rows[5][2], 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(docs, block=block).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = targets_by_hand(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= 30 for s in sizes)
    again = mixing.mix(docs.repartition(7), block=block).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mixing.mixed_documents(docs, block=block)
    assert mixed.columns == docs.columns
    once = {r.doc_id: r.copies for r in got if r.doc_id != 5}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert {i: c for i, c in once.items() if c} == {i: c for i, c in counts.items() if i != 5}


def test_rows_of_no_id_and_of_one_id_are_mixed_by_row(spark):
    rows = [(None, "w " * (i % 20 + 1), "a") for i in range(150)] + [(7, "w " * (i % 9 + 1), "b") for i in range(150)]
    rows += [(i, "v " * 10, "c") for i in range(100, 200)]
    docs = spark.createDataFrame([(i, t, s, 1, 2, 3) for i, t, s in rows],
                                 "doc_id long, text string, source string, _mix_id int, _mix_copies int, copies int")
    got = mixing.mix(docs, block=16).collect()
    want = targets_by_hand({s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "abc"})
    mixed = mixing.mixed_documents(docs, block=16)
    assert mixed.columns == docs.columns
    words = {s: 0 for s in "abc"}
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    taken = {s: sum(r.taken for r in got if r.source == s) for s in "abc"}
    assert words == taken and all(abs(taken[s] - want[s]) <= 20 for s in "abc")
    keys = mixing._keyed(docs.select("doc_id", "source", F.xxhash64("text").alias("digest"), F.lit(1).alias("size")), 17)
    assert keys.select("key").distinct().count() == len(rows)


def test_pivot_keeps_mass_and_expectation():
    rng = np.random.default_rng(0)
    size, p = rng.integers(1, 50, 60).astype(float), rng.uniform(0.05, 0.95, 60)
    kept = np.zeros(60)
    for seed in range(400):
        out = mixing.pivot(np.arange(60), size, p, seed, last=False)
        assert abs((out * size).sum() - (p * size).sum()) < 1e-6
        assert ((out > 0) & (out < 1)).sum() <= 1
        kept += out
    assert np.abs(kept / 400 - p).max() < 0.12


def test_mix_of_empty_and_wordless_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


# -- subwords --------------------------------------------------------------------------

def texts_for_encoding():
    rng = random.Random(2)
    parts = ["a", "the", "ing", " ", "  ", "    ", "\n", "é", "ß", "😀", "の", "▁", "\0", "Ａ", "ﬁ", "\t", "00", "==", "http://", "́"]
    yield from ["", " ", "\n", "a", "  a  b ", "▁▁x", " " * 70 + "x", "x" + " " * 400, "<s></s><unk><0x0A>", "⁇", "ab" * 9000]
    for _ in range(800):
        yield "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
    for _ in range(200):
        yield "".join(chr(rng.choice([rng.randint(1, 0x24F), rng.randint(0x370, 0x9FFF), rng.randint(0x1F300, 0x1F6FF)]))
                      for _ in range(rng.randint(1, 15)))


def test_encoding_equals_the_library():
    bpe, library = piece_bpe.PieceBpe(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    cache = piece_bpe._Cache(bpe)
    for text in texts_for_encoding():
        ids = library.encode(text)
        assert bpe.encode(text) == ids, text
        assert bpe.decode(ids) == library.decode(ids)
        assert piece_bpe.encode_text(cache, text) == (",".join(map(str, ids)), library.decode(ids))


def test_encoding_with_small_caches(monkeypatch):
    monkeypatch.setattr(piece_bpe, "CACHE_BYTES", 1000)
    monkeypatch.setattr(piece_bpe, "PAIR_ENTRIES", 4)
    monkeypatch.setattr(piece_bpe, "ODD_ENTRIES", 1)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    cache = piece_bpe._Cache(piece_bpe.PieceBpe(MODEL))
    odd = "".join(map(chr, (0x1F9FF, 0x3042, 0x10FFFF)))
    for text in ["one two three four five six one two", "again one more, two", f"{odd}. x{odd}! {odd} {odd}.", "one,", odd] * 2:
        ids = library.encode(text)
        assert piece_bpe.encode_text(cache, text) == (",".join(map(str, ids)), library.decode(ids))
        assert len(cache) <= 4


def test_boundaries_of_token_pairs_agree_with_whole_merges():
    bpe, rng = piece_bpe.PieceBpe(MODEL), random.Random(6)
    tokens = sorted(t for t in bpe.usable if not t.startswith(piece_bpe.SPACE))
    short = [t for t in tokens if len(t) <= 2]
    for left, right in zip(rng.choices(tokens, k=3000) + rng.choices(short, k=3000), rng.choices(tokens, k=6000)):
        assert bpe.boundary_holds(left, right) == (bpe.merge(left + right) == [left, right])


def test_encode_documents_rows(spark):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (None, "x"), (3, None), (4, "")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id int, text string, ids int")
    got = piece_bpe.encode_documents(docs, MODEL).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert sorted((str(r.doc_id), list(r.ids), r.decoded, r.n_tokens) for r in got) == sorted(
        (str(i), library.encode(t or ""), t or "", len(library.encode(t or ""))) for i, t in rows)
    assert piece_bpe.encode_documents(docs.limit(0), MODEL, digests=True).collect() == []


# -- personal data ---------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            odd = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1]))
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(d) <= 19 and odd % 10 == 0, "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@@", "x-y", ".", "..", "+", "+1", " ", "(", ")", "-", "1.2.3.4", "256.1.1.1", "4111111111111111",
             "4111 1111 1111 1111", "0255", "555", "1234", "é", "%", "mail.example.com", "\n", "٣"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = Boosted().fit(x[:400], y[:400])
    assert ((model.probability(x[400:]) > 0.5) == y[400:]).mean() > 0.95


def test_detect_adds_other_spellings_and_leaves_clean_text(spark):
    rng = random.Random(4)

    def card():
        head = "".join(rng.choice("123456789") for _ in range(15))
        return next(head + str(d) for d in range(10) if pii.luhn(head + str(d)))

    rows = []
    for i in range(600):
        words = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(12))
        data = [f"user{i}@mail{i % 9}.example.com", f"{i % 250}.{i % 77}.3.{i % 99}", card(),
                f"+1 (0{i % 90 + 10}) 555-{1000 + i}", "".join(rng.choice("0123456789") for _ in range(16))][i % 5]
        rows.append((i, f"{words} {data} {words}"))
    clean = "Version 3.14 of 2020-01-02, order 12345, look at the dot and go."
    respelled = "alpha beta user77 at mail3 dot example dot com gamma delta"
    rows += [(1000, None), (1001, ""), (1002, clean), (1003, respelled), (1004, "x" * 100_000)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.detect(docs).collect()}
    for i, t in rows:
        base = plain_spans(t or "")
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(",".join(f"{k}:{a}:{b}" for k, a, b in base).split(",")) <= set(got[i].spans.split(",")) | {""}
    assert got[1002].spans == "" and got[1000].spans == ""
    assert got[1003].spans.startswith("email:")
    assert sum(bool(got[i].spans) for i, t in rows[:600] if not plain_spans(t)) <= 10
    assert pii.redact(respelled, got[1003].spans).count("[email]") == 1
    assert pii.detect(docs.limit(0)).collect() == []


def test_wide_proposals_stand_beside_base_spans():
    text = "call 555 123 4567 10.0.0.1 now"
    base = pii.base_spans(text)
    assert [s[0] for s in base] == ["ip"]
    assert any(k == "phone" and text[a:b].startswith("555 123 4567") for k, a, b in pii.propose(text, base))
    assert all(b <= x or y <= a for _, a, b in pii.propose(text, base) for _, x, y in base)


def test_long_addresses_are_proposed_whole():
    name, labels = "n" * 200, "sub dot " * 40
    for spelled in (f"{name} at host dot com", f"ann at {labels}example dot org", f"{'n' * 5000} [at] host[dot]com"):
        text = f"write, {spelled}, today"
        assert [(k, text[a:b]) for k, a, b in pii.propose(text, [])] == [("email", spelled)]
    text = "x at a dot b at c dot d @ e . f"
    assert [text[a:b] for _, a, b in pii.propose(text, [])] == ["x at a dot b", "d @ e . f"]


class Always:
    def probability(self, x):
        return np.linspace(0.9, 1, len(x))


def test_spans_of_a_long_text_with_very_many_proposals():
    model = Always(), dict.fromkeys(pii.KINDS, 0.5)
    text = "call 555 123 4567 or ann at mail dot example dot com 10 . 0 . 0 . 1 " * 5400
    began = time.process_time()
    (base, added), = pii.find_spans([text], model)
    assert time.process_time() - began < 6 and len(text) > 360_000 and len(added) > 10_000
    added.sort(key=lambda s: s[1])
    assert all(x[2] <= y[1] for x, y in zip(added, added[1:]))
    (_, few), = pii.find_spans([text[:700]], model)
    left = [s for s in pii.propose(text[:700], []) if not any(s[1] < y and x < s[2] for _, x, y in few)]
    assert not left


def test_long_runs_are_read_once():
    model = Always(), dict.fromkeys(pii.KINDS, 0.5)
    for text in ("@" * 200_000, "a" * 200_000 + "@", "@" + "a" * 200_000, "a at " * 40_000, "a@a" * 60_000, ".@" * 100_000):
        began = time.process_time()
        pii.find_spans([text + " dot "], model)
        assert time.process_time() - began < 3, text[:5]


def test_plausible_spellings_are_no_negatives():
    respelled = "write to user at mail dot example dot com or call 555-123-4567, thanks"
    assert pii.propose(respelled, []) and all(label for _, label, _ in pii.examples("1", respelled))
    assert any(k == "ip" and not label for k, label, _ in pii.examples("1", "see 999.300.400.500 there"))


def test_a_rare_kind_is_sampled(spark, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE", 40)
    rows = [(i, f"nothing here but words {'and words ' * (i % 3)}") for i in range(3000)]
    rows += [(5000 + i, f"write to user{i}@mail{i % 9}.example.com today") for i in range(30)]
    rows += [(6000 + i, f"the host 10.{i}.3.4 is up") for i in range(30)]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert model is not None and model[1]["email"] <= 1


def test_trees_of_a_table_equal_those_of_arrays(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, size=(900, 3)).astype(float)
    x[:, 2] = rng.integers(0, 200, size=900) ** 2
    kind = np.array(["a", "b", "none"])[rng.integers(0, 3, size=900)]
    y = ((x[:, 0] > 4) ^ (x[:, 2] > 9000) ^ (rng.uniform(size=900) < 0.1)).astype(float) * (kind != "none")
    n = rng.integers(1, 4, size=900)
    rows = spark.createDataFrame([(k, float(a), [float(v) for v in b], int(c)) for k, a, b, c in zip(kind, y, x, n)],
                                 "kind string, label double, x array<double>, n bigint")
    got = fit_table(rows.repartition(7))
    assert sorted(got) == ["a", "b"]
    for k in got:
        own = np.repeat(np.flatnonzero(kind == k), n[kind == k])
        want = Boosted().fit(x[own], y[own])
        assert len(want.trees) == len(got[k].trees) > 5
        assert np.allclose(want.probability(x[own]), got[k].probability(x[own]), atol=1e-12, rtol=0)


def test_every_document_teaches(spark, monkeypatch):
    rows = [(i, f"write to user{i}@mail{i % 9}.example.com or +1 (0{i % 90 + 10}) 555-{1000 + i}") for i in range(5500)]
    rows += [(None, f"the host 10.{i}.3.4 is up, not 300.400.500.{i}") for i in range(200)]
    seen = []
    monkeypatch.setattr(pii, "fit_table", lambda table: seen.append(table) or {})
    assert pii.fit(spark.createDataFrame(rows, "doc_id long, text string")) is None
    got = {r.kind: r.n for r in seen[0].groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    want, held = collections.Counter(), 0
    for i, text in rows:
        key = str(i) if i is not None else hashlib.sha256(text.encode()).hexdigest()
        if zlib.crc32(key.encode()) % 3:
            want.update(k for k, _, _ in pii.examples(key, text))
        else:
            held += 1
    assert got == want and min(got.values()) > 200 and 0.3 < held / len(rows) < 0.37


def test_documents_without_an_id_teach(spark):
    rows = [(None, f"write to user{i}@mail{i % 9}.example.com today, the host 10.{i % 250}.3.4 is up") for i in range(150)]
    trees, limits = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert limits["email"] <= 1 and limits["ip"] <= 1 and limits["card"] == limits["phone"] == 2.0


def test_examples_of_long_and_dense_texts():
    for text, least in (("a" * 200_000 + "@b.com", 1), ("a@" + "b." * 100_000 + "com", 1), ("ann@mail.example.com " * 5000, 10_000)):
        began = time.process_time()
        batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
        sizes = [b.num_rows for b in pii._example_rows([batch])]
        assert time.process_time() - began < 6 and sum(sizes) >= least and max(sizes) <= 5000, text[:5]
    text = "to ann@mail.example.com, bob@host.zzz"
    assert [pii.features(text, *s)[-1] for s in pii.base_spans(text)] == [1.0, 0.0]


def test_threshold_by_counts():
    p, n, yes = np.array([0.9, 0.8, 0.7, 0.6]), np.array([50, 49, 1, 900]), np.array([50.0, 48, 0, 0])
    assert pii._threshold(p, n, yes) == 0.7 and pii._threshold(p[1:], n[1:], yes[1:]) == 2.0
    assert pii._threshold(p[:0], n[:0], yes[:0]) == 2.0 and pii._threshold(p / 10, n, yes) == 0.5


# -- URLs ------------------------------------------------------------------------------

def test_url_parts_and_rules(spark):
    urls = ["http://A.Example.ORG/en/1?x#y", "https://example.org/es/", "https://notexample.org/es/1", "x.com/fr/1", None, "",
            "http://com/fr/", "ftp://a.com/de/x://y", "http://b.com?/fr/", "http://b.com#f", "http://É.org/", "://", "a://org/\n",
            "http://example.org/en/2"] * 2
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            host, path = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S).groups()
            host = host.encode().lower().decode()
        best = None
        for rule, says in url_filter.RULES:
            at, start = rule[:rule.index("/")], rule[rule.index("/"):]
            if (host == at or host.endswith("." + at)) and path.startswith(start) and (best is None or len(rule) > len(best[0])):
                best = (rule, says)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best[0])
        assert got[i].verdict == (best[1] if best else got[i].verdict) and got[i].verdict in ("allow", "block")
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_markov_ratio_separates_held_out_urls():
    rng = random.Random(5)
    good = [f"http://news{rng.randint(1, 99)}.example/story/{rng.randint(1, 10 ** 6)}" for _ in range(300)]
    bad = [f"http://win-{rng.choice(['cash', 'pills'])}{rng.randint(1, 99)}.example/?ref={rng.randint(1, 10 ** 6)}" for _ in range(300)]
    models = Markov().fit(good[:200]), Markov().fit(bad[:200])
    assert (ratio(models, good[200:]) > 0).mean() > 0.98 and (ratio(models, bad[200:]) < 0).mean() > 0.98
    assert ratio(models, ["", "a"])[0] == 0


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(8)
    rows = [f"http://{rng.choice('abc')}.com/{side}/{word}{rng.randint(1, 10 ** 6)}" for _ in range(300)
            for side, word in (("fr", rng.choice(["story", "news"])), ("de", rng.choice(["cash", "pills"])))]
    rows += [f"http://x.net/{w}{i}" for w in ("story", "pills") for i in range(40)] + ["", None, rows[0], "http://é.net/𝒳"]
    return spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")


def test_url_models_count_all_ruled_urls_and_agree_in_both_ways(spark, pages, monkeypatch):
    ruled = [r.url for r in pages.collect() if r.url and ".com/" in r.url]
    urls = spark.createDataFrame([(u, "allow" if "/fr/" in u else "block", False) for u in set(ruled)],
                                 "url string, verdict string, held boolean")
    ratios = url_filter.window_ratios(urls)
    local = {r.w: r.f / url_filter.UNIT for r in ratios.collect()}
    monkeypatch.setattr(url_models, "BUCKETS", 1 << 22)  # hashed arrays nearly free of collisions
    models = [Markov().fit([u for u in set(ruled) if side in u]) for side in ("/fr/", "/de/")]
    some = sorted(set(ruled))[:50]
    for u, want in zip(some, ratio(models, some)):
        assert np.mean([local[w] for w in url_filter.windows([u])[0].tolist()]) == pytest.approx(want, abs=0.02)
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(got) == pages.count()
    assert sum(r.verdict == ("allow" if r.path.startswith("/story") else "block")
               for r in got.values() if r.host == "x.net") >= 72
    assert [r.score for r in got.values() if not r.host] == [0.0, 0.0]
    monkeypatch.setattr(url_filter, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr(url_filter, "CUTS", 5)
    monkeypatch.setattr(url_filter, "BINS", 8)
    assert {r.page_id: r for r in url_filter.judge(pages).collect()} == got


def test_url_models_use_urls_beyond_any_sample(spark, monkeypatch):
    """One rejected spelling among thousands of accepted and rejected URLs counts."""
    monkeypatch.setattr(url_filter, "SAMPLE", 20, raising=False)
    rng = random.Random(3)
    rows = [f"http://a.com/{side}/{rng.randint(1, 10 ** 9)}" for _ in range(2000) for side in ("fr", "de")]
    rows += [f"http://a.com/de/{i}-zqzq" for i in range(8)] + ["http://b.net/7-zqzq", "http://b.net/7"]
    got = {r.page_id: r.score for r in url_filter.judge(
        spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")).collect()}
    assert got[len(rows) - 2] < got[len(rows) - 1] - 0.1


def test_threshold_of_histograms_is_that_of_all_scores(spark, monkeypatch):
    rng = np.random.default_rng(6)
    good, bad = rng.normal(1, 1, 400), np.r_[rng.normal(-1, 1, 300), [-1e9, 1e9]]
    scores = spark.createDataFrame([("allow", float(x)) for x in good] + [("block", float(x)) for x in bad], "verdict string, score double")
    whole = url_filter.threshold(scores)
    assert abs((good < whole).mean() - (bad >= whole).mean()) < 0.01
    monkeypatch.setattr(url_filter, "CUTS", 5)
    monkeypatch.setattr(url_filter, "BINS", 8)
    assert url_filter.threshold(scores) == pytest.approx(whole, abs=1e-12)


# -- chat ------------------------------------------------------------------------------

def brute_cost(roles):
    """Cheapest repair of a short conversation, over all states of all turns."""
    best = None
    for path in itertools.product((1, 2, 3), repeat=len(roles)):
        for merges in itertools.product((False, True), repeat=len(roles)):
            cost, at = 0, 0
            for role, to, merge in zip(roles, path, merges):
                change = 0 if to == role else chat_format.RELABEL_UNKNOWN if role == 0 else chat_format.RELABEL
                if merge and at == to:
                    cost += change + chat_format.MERGE
                elif not merge and (at, to) in chat_format.BETWEEN:
                    cost += change + chat_format.INSERT * len(chat_format.BETWEEN[at, to])
                else:
                    break
                at = to
            else:
                cost += chat_format.INSERT * len(chat_format.CLOSING[at])
                best = cost if best is None else min(best, cost)
    return best


def cost_of(roles, path):
    total = 0
    for role, (s, t, action) in zip(roles, path):
        total += 0 if t == role else chat_format.RELABEL_UNKNOWN if role == 0 else chat_format.RELABEL
        total += chat_format.MERGE if action == "merge" else chat_format.INSERT * len(chat_format.BETWEEN[s, t])
    return total + chat_format.INSERT * len(chat_format.CLOSING[path[-1][1]])


def test_repair_is_cheapest_on_all_short_conversations():
    for n in range(1, 5):
        for roles in itertools.product(range(4), repeat=n):
            turns = [(k, chat_format.ROLES[r] or None, f"t{k}") for k, r in enumerate(roles)]
            assert cost_of(roles, chat_format.repair(turns)) == brute_cost(roles), roles


def chat_rows():
    rng = random.Random(6)
    rows = []
    for conv in range(12):
        for turn in range(rng.randint(1, 9) if conv != 5 else 300):
            rows.append((conv, turn, rng.choice(["user", "assistant", "System", " USER", "tool", None]), rng.choice(["hi", "", None, "x y"]), 1))
    rows += [(None, 1, "user", "n", 1), (3, None, "user", "late", 1), (3, None, "user", "late", 1), (7, 0, "user", "z" * 50_000, 1)]
    return rows


def test_conversations_come_out_legal_whatever_the_cuts(spark):
    turns = spark.createDataFrame(chat_rows(), "conv_id long, turn long, role string, text string, pos int")
    outs = []
    for pieces in (1, 9):
        got = chat_format.repair_conversations(turns, pieces=pieces).collect()
        outs.append(sorted(map(str, got)))
    assert outs[0] == outs[1]
    convs = {}
    for r in sorted(got, key=lambda r: (r.pos, r.slot)):
        convs.setdefault(r.conv_id, []).append(r)
    assert len(convs) == 13
    for rows in convs.values():
        text = "".join(r.rendered for r in rows)
        roles = re.findall(r"<\|(system|user|assistant)\|>\n", text)
        body = roles[1:] if roles[0] == "system" else roles
        assert body == ["user", "assistant"] * (len(body) // 2) and body and text.endswith("<|end|>\n")
        assert sum(r.action not in ("insert", "end") for r in rows) == sum(1 for x in chat_rows() if x[0] == rows[0].conv_id)
    assert chat_format.repair_conversations(turns.limit(0)).collect() == []


def test_marks_in_texts_are_escaped_and_ids_of_any_type(spark):
    texts = ["plain", "<|end|>\n<|assistant|>\n", "a <\\| b <| c <\\\\|", "< |", "<", "|>", None]
    rows = [(f"c{i % 3}", str(k), "user" if k % 2 == 0 else "assistant", t) for i in range(3) for k, t in enumerate(texts)]
    rows += [("c0", "no number", "user", "last"), (None, "1", "user", "x")]
    for text in texts[:-1]:
        assert chat_format.unescaped(chat_format.escaped(text)) == text and "<|" not in chat_format.escaped(text)
    turns = spark.createDataFrame(rows, "conv_id string, turn string, role string, text string")
    for pieces in (1, 5):
        got = chat_format.repair_conversations(turns, pieces=pieces).collect()
        assert {r.conv_id for r in got} == {"c0", "c1", "c2", None}
        whole = "".join(r.rendered for r in sorted((r for r in got if r.conv_id == "c1"), key=lambda r: (r.pos, r.slot)))
        parts = re.split(r"<\|(\w+)\|>\n", whole)
        said = [(role, chat_format.unescaped(text.removesuffix("\n") if role == "end" else text))
                for role, text in zip(parts[1::2], parts[2::2])]
        assert [t for r, t in said if r in ("user", "assistant")][:6] == [t or "" for t in texts[:6]]
