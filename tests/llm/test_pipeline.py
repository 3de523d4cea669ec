"""The pipeline on a small corpus: each stage's decisions take effect, clean rows stay."""

import corpus_pipeline
from alertfold.llm.catalog import all_queries


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights",
        "SentencePiece encoding and decoding"]
    names = set(all_queries())
    assert "pipeline" in names and all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 14))


def test_run_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf)
        assert left.columns == docs.columns, name
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = out.collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows and all(r.decoded == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in rows)
    assert len({r.decoded.lower() for r in rows}) == len({r.doc_id for r in rows})


def _brute(rows, kept):
    """What exact and near stages leave of the given rows, by plain loops."""
    best = {}
    for i, text in rows:
        norm = (text or "").encode().lower().decode()
        if norm not in best or (i is not None and (best[norm][0] is None or i > best[norm][0])):
            best[norm] = (i, text)
    left = list(best.values())
    words = [(t or "").encode().lower().split() for _, t in left]
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    comp = list(range(len(left)))
    for _ in left:
        for a in range(len(left)):
            for b in range(len(left)):
                if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    groups = {}
    for k, c in enumerate(comp):
        groups.setdefault(c, []).append(k)
    out = [min((left[k] for k in g), key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    return sorted(((str(i), (t or "").lower()) for i, t in out))


def test_stages_on_null_repeated_and_odd_rows(spark, tmp_path):
    import random

    import corpus_pipeline as P
    rng = random.Random(3)
    words = [f"word{k}" for k in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.upper()) for i, t in enumerate(base[:6])]                 # exact copies after lower-casing
    rows += [(200 + i, t + " and more") for i, t in enumerate(base[4:9])]          # near copies
    rows += [(3, base[3]), (3, "another text under the same id"), (None, base[5] + " x"), (None, "only here, without an id"),
             (None, None), (300, None), (301, ""), (302, " \n "), (303, "w" * 20_000)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, _mix_id string, _row_sha string, _digest int"
    docs = spark.createDataFrame([(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "m", "r", 1)
                                  for k, (i, t) in enumerate(rows)], columns)
    folder = str(tmp_path / "sf")
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (9999, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        folder + "/labels.parquet")
    read = spark.read.parquet(folder + "/documents.parquet")
    left = P.toxicity_stage(spark, read, folder)
    assert left.columns == docs.columns and left.count() == len(rows)
    left = P.near_stage(spark, P.exact_stage(spark, left, folder), folder)
    assert left.columns == docs.columns
    got = sorted((str(r.doc_id), (r.text or "").lower()) for r in left.collect())
    assert got == _brute(rows, None)
    left.write.parquet(folder + "/near")
    near = spark.read.parquet(folder + "/near")
    mixed = P.mixing_stage(spark, near, folder)
    assert mixed.columns == docs.columns
    known = {(str(r.doc_id), r.text) for r in near.collect()}
    out = mixed.collect()
    assert {(str(r.doc_id), r.text) for r in out} <= known
    encoded = P.encoding_stage(spark, mixed, folder).collect()
    assert sorted(str((r.doc_id, r.decoded)) for r in encoded) == sorted(str((r.doc_id, r.text or "")) for r in out)


def test_every_stage_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as P
    folder = str(tmp_path / "sf")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        folder + "/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    assert P.run(spark, folder).collect() == []
