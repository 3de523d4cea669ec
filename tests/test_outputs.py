"""Aligned routing, named outputs of the capped variant, month files, names beside a listing."""

import os
import random

from pyspark.sql import functions as F

from alertfold.operators.names import allocate_names
from alertfold.plans import pipelines as P
from alertfold.sinks.files import publish_month_files, write_partitioned
from alertfold.sources import csv as C
from conftest import write_text


def test_aligned_router_puts_cells_in_their_columns(spark, tmp_path):
    a = write_text(str(tmp_path / "a.csv"), "Référence;Date;Lieu\nR1;02/01/2025 10:00;\"Orléans; gare\"\nbad;x;y\n", encoding="latin-1")
    b = write_text(str(tmp_path / "b.csv"), " Lieu ;Référence;Date;Canal\n\nPau;R2;03/01/2025 11:00;web\nPau;R3\n", encoding="latin-1")
    c = write_text(str(tmp_path / "c.csv"), "Référence;Lieu\nR4;02/01/2025 10:00\n", encoding="latin-1")
    routed, header = P.route_aligned(spark, [a, b, c], encoding="ISO-8859-1")
    assert header == "Référence;Date;Lieu;Canal"
    got = sorted((r["_src"], r["ok"], r["ym"], r["value"]) for r in routed.collect())
    assert got == [("a.csv", False, None, "bad;x;y"), ("a.csv", True, "2025_01", 'R1;02/01/2025 10:00;"Orléans; gare";'),
                   ("b.csv", False, None, ""), ("b.csv", False, None, "Pau;R3"),
                   ("b.csv", True, "2025_01", "R2;03/01/2025 11:00;Pau;web"), ("c.csv", False, None, "R4;02/01/2025 10:00")]


def test_router_decodes_and_scans_once(spark, tmp_path):
    a = write_text(str(tmp_path / "a.csv"), "Date;Lieu\n02/01/2025 10:00;\n02/01/2025 10:00\n02/01/2025 11:00;Orléans\n", encoding="latin-1")
    routed = P.route(spark, [a], date_index=0, encoding="ISO-8859-1")
    assert sorted((r["value"], r["ok"]) for r in routed.collect()) == [
        ("02/01/2025 10:00", False), ("02/01/2025 10:00;", True), ("02/01/2025 11:00;Orléans", True)]
    assert routed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_first_lines_go_whatever_the_splits(spark, tmp_path):
    rng = random.Random(2)
    files, want = [], []
    for k in range(7):
        lines = [f"R{k}-{i};0{k + 1}/01/2025 10:00" for i in range(rng.choice([0, 1, 3000]))]
        head = "Ref;Date" if k % 2 else "R0;01/01/2025 10:00"   # a first line goes even if it reads as data
        files.append(write_text(str(tmp_path / f"f{k}.csv"), "\n".join([head, head, *lines]) + "\n"))
        want += [head, *lines]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2000", "20000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert sorted(r["value"] for r in C.read_raw_lines(spark, files).collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_capped_outputs_under_their_names(spark, tmp_path):
    head = "Référence;Date;Lieu\n"
    write_text(str(tmp_path / "in" / "a.csv"), head + "R1;02/02/2025 10:00:00;\"a;b\"\nR2;;x\nR3;01/02/2025 09:00:00;\n"
               "R4;01/03/2025 00:00:00;y\nR5;not a date;\"say \"\"hi\"\"\"\nR6;05/01/2025 00:00:00;z\n")
    df = P.capped(spark, str(tmp_path / "in"), "2025-02-28 23:59:59")
    target = str(tmp_path / "t")
    assert P.write_capped_named(df, target) == {"ok": 3, "undated": 2, "over_cap": 1}
    texts = {n: open(f"{target}/{n}", encoding="utf-8").read() for n in os.listdir(target) if n.endswith(".csv")}
    assert texts.pop("lignes_invalides.csv").splitlines()[0] == "Référence;Date;Source"
    full = texts.pop("alertes_lignes_invalides.csv").splitlines()
    assert full[0] == "Référence;Date;Lieu;Date_parsed;Source"
    assert sorted(full[1:]) == ["R2;;x;;a.csv", 'R5;not a date;"say ""hi""";;a.csv']
    assert texts == {"alertes_2025_01.csv": head + "R6;2025-01-05 00:00:00;z\n",
                     "alertes_2025_02.csv": head + 'R3;2025-02-01 09:00:00;\nR1;2025-02-02 10:00:00;"a;b"\n',
                     "lignes_filtrees.csv": "Référence;Date;Source\nR4;2025-03-01 00:00:00;a.csv\n"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_ordinary_months_are_one_file_each(spark, tmp_path):
    df = spark.range(6000).select(F.col("id").alias("o"), F.format_string("2025_%02d", F.when(F.col("id") < 3000, 1)
                                                                       .otherwise(F.col("id") % 11 + 2)).alias("ym"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_partitioned(df.orderBy(F.rand(3)), str(tmp_path / "m"), ["ym"], order=["o"], bom=False, ordered_parts=True,
                          month_rows=1000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = publish_month_files(spark, str(tmp_path / "m"), str(tmp_path / "t"))
    assert [n for n in names if "_p" not in n] == [f"alertes_2025_{m:02d}.csv" for m in range(1, 13)]
    assert {n[:15] for n in names if "_p" in n} == {"alertes_2025_01"}
    hot = [int(x) for n in names if "2025_01" in n for x in open(tmp_path / "t" / n).read().split()[1:]]
    assert hot == list(range(3000))


def test_names_beside_a_listing(spark):
    rng = random.Random(1)
    bases = ["x", "x_1", "x_1_2", "y", "y_07", "z_3", None]
    requests = [(i, rng.choice(bases)) for i in range(300)]
    listing = ["x.csv", "x_2.csv", "x_3.csv", "y_5.csv", "y_07.csv", "x_1_1.csv", "x_9.txt", "z.csv", None, "x_2.csv"]
    r = spark.createDataFrame(requests, "i int, b string")
    got = {row.i: row["name"] for row in allocate_names(r, "b", ["i"], spark.createDataFrame([(n,) for n in listing], "name string")).collect()}
    taken = {n for n in listing if n} | {f"{b}.csv" for b in bases if b}
    want, used = {}, {n for n in listing if n}
    for i, b in requests:
        if b is None:
            want[i] = None
            continue
        name, k = f"{b}.csv", 0
        while name in used or (k and name in taken):
            k += 1
            name = f"{b}_{k}.csv"
        used.add(name)
        want[i] = name
    assert got == want
    made = [n for n in got.values() if n]
    assert len(set(made)) == len(made) and not set(made) & {n for n in listing if n}


def test_date_columns_from_the_beginnings_of_files(spark, tmp_path):
    texts = {
        "plain.csv": "id,when,x\n1,31/01/2025,p\n2,bad,q\n",
        "late.csv": "id,when\n" + "7,\n" * 400 + "8,2025-01-31\n",           # the value lies beyond a short beginning
        "left.csv": "a,b\n" + ",31/01/2025\n" * 400 + "01/02/2025,x\n",      # a column to the left is still open
        "none.csv": "id,x\n1,y\n" + "2,z\n" * 400,
        "short.csv": "id,x\n1,y\n", "header.csv": "id,when\n", "empty.csv": "",
        "quoted.csv": 'x,"the, date"\n"a ""b""","5 May 2025"\n', "na.csv": "x,when\nNaN,NULL\nv,05/05/2025\n"}
    for name, text in texts.items():
        write_text(str(tmp_path / name), text)
    csv = C.CsvOptions(sep=",", exclude=())
    files = C.discover(spark, str(tmp_path), csv)
    df = C.read_by_name(spark, files, csv)
    columns = [c for c in df.columns if not c.startswith("_")]
    want = {os.path.basename(r[0]): r[1] for r in P.detect_date_columns(df, columns, file_col=C.PATH).collect()}
    for size in (100, 1 << 16):
        detected, undecided = P.detect_from_heads(spark, files, csv, columns, size)
        got = {os.path.basename(r[0]): r[1] for r in detected.collect()}
        assert {k: got[k] for k in want if k in got} == {k: want[k] for k in want if k in got}
        names = {os.path.basename(p) for p in undecided}
        assert names == ({"late.csv", "left.csv", "none.csv"} if size == 100 else set())
    kept, detected = P.merge(spark, [str(tmp_path)], csv)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == len(
        {text.split("\n")[0] for text in texts.values() if text})
    assert kept.count() == 1 + 1 + 1 + 1 + 1


def test_many_headers_are_one_scan(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    names = ["Référence", "Date", "Lieu", "Canal", "x y", "Etat"]
    for k in range(14):
        own = rng.sample(names, rng.randint(1, 6))
        if k % 5 == 0:
            own = [n.upper() if n == "Date" else n for n in own]
        body = "".join(";".join(rng.choice(["", "v", '"a;b"', "NaN", f"c{k}"]) for _ in own) + rng.choice(["\n", ";more\n"]) for _ in range(6))
        write_text(str(tmp_path / f"d{k % 3}" / f"f{k}.csv"), ";".join(f" {n} " for n in own) + "\n" + body + "short\n")
    for opts in (C.CsvOptions(), C.CsvOptions(na_tokens=False)):
        files = C.discover(spark, str(tmp_path), opts)
        monkeypatch.setattr(C, "MAX_HEADER_SCANS", 100)
        want = C.read_by_name(spark, files, opts)
        monkeypatch.setattr(C, "MAX_HEADER_SCANS", 1)
        for roots in (None, [str(tmp_path)]):
            got = C.read_by_name(spark, files, opts, roots=roots)
            columns = [c for c in want.columns if c != "_ord"]
            assert [c for c in got.columns if not c.startswith("_")] == [c for c in columns if not c.startswith("_")]
            assert sorted(map(str, got.select(*columns, "_ord.path", "_ord.block").collect())) == sorted(
                map(str, want.select(*columns, "_ord.path", "_ord.block").collect()))
            assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_prefer_dated_and_epoch_zone(spark, tmp_path):
    write_text(str(tmp_path / "Alertes_-2025-01.csv"), "Référence;Date;Timestamp;v\nA;junk;;1\nA;02/01/2025 10:00:00;;2\n"
               "A;01/01/2025 10:00:00;;3\nB;;;4\nB;;;5\nC;;1751360400;6\nD;;1735725600;7\n")
    df, _ = P.recompose(spark, str(tmp_path))
    assert sorted((r["v"], r["status"]) for r in df.collect()) == [("1", "undated"), ("4", "undated"), ("6", "ok"), ("7", "ok")]
    df, _ = P.recompose(spark, str(tmp_path), P.RecomposeOptions(prefer_dated=True, epoch_tz="Europe/Paris"))
    assert sorted((r["v"], str(r["dt"])) for r in df.collect()) == [
        ("2", "2025-01-02 10:00:00"), ("4", "None"), ("6", "2025-07-01 11:00:00"), ("7", "2025-01-01 11:00:00")]


def test_month_scope_keeps_every_undated_row(spark, tmp_path):
    write_text(str(tmp_path / "Alertes_-2025-01.csv"), "Référence;Date;v\nA;01/01/2025 10:00:00;1\nA;02/01/2025 10:00:00;2\n"
               "A;01/02/2025 10:00:00;3\nA;;4\nA;;5\n;;6\n;03/01/2025 10:00:00;7\n;04/01/2025 10:00:00;8\n")
    for null_key, want in (("collapse", "134567"), ("keep", "1345678")):
        df, _ = P.recompose(spark, str(tmp_path), P.RecomposeOptions(dedup_scope="month", null_key=null_key))
        assert "".join(sorted(r["v"] for r in df.collect())) == want


def test_merger_compares_by_name_or_by_position(spark, tmp_path):
    write_text(str(tmp_path / "a.csv"), "id,when,x\n1,31/01/2025,p\n2,01/02/2025,q\n")
    write_text(str(tmp_path / "b.csv"), "x,when,id\n1,31/01/2025,p\nq,01/02/2025,2\n")
    csv = C.CsvOptions(sep=",", exclude=())
    by_name, _ = P.merge(spark, [str(tmp_path)], csv)
    by_place, _ = P.merge(spark, [str(tmp_path)], csv, compare="position")
    assert sorted((r["_src"], r["id"], r["x"]) for r in by_name.collect()) == [("a.csv", "1", "p"), ("a.csv", "2", "q"), ("b.csv", "p", "1")]
    assert sorted((r["_src"], r["id"], r["x"]) for r in by_place.collect()) == [("a.csv", "1", "p"), ("a.csv", "2", "q"), ("b.csv", "2", "q")]
