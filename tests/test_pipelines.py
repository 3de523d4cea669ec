"""End-to-end pipelines on small hand-written folders, invariants, and the driver contract."""

import datetime as dt
import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from alertfold.plans import pipelines as P
from alertfold.streaming import files as ST
from conftest import write_text

BOM = "﻿"
HEADER = "Référence;Date;Timestamp;Lieu\n"


@pytest.fixture()
def folder(tmp_path):
    write_text(str(tmp_path / "in" / "Alertes_-2025-01.csv"), BOM + HEADER +
               "R1;03/01/2025 10:00:00;;Gare\n"
               "R2;;1735776000;Port\n"          # 2025-01-02 by epoch (seconds)
               "R3;inconnue;;Quai\n"            # undated
               ";05/01/2025 08:00;;Nord\n")
    write_text(str(tmp_path / "in" / "Alertes_-2025-02.csv"), BOM + HEADER +
               "R1;01/02/2025 09:00:00;;Gare\n"  # duplicate key: the January row wins
               "R4;2025/02/03 07:30;;Sud\n"
               ";06/02/2025 08:00:00;;Est\n")    # second missing key: collapses with the first
    write_text(str(tmp_path / "in" / "alertes_2024_12.csv"), BOM + HEADER + "R9;01/12/2024 00:00:00;;Old\n")
    return tmp_path


def test_recompose_end_to_end(spark, folder):
    df, header = P.recompose(spark, str(folder / "in"))
    assert header == ["Référence", "Date", "Timestamp", "Lieu"]
    got = sorted((r["Référence"] or "", r["status"], r["ym"] or "") for r in df.collect())
    assert got == [("", "ok", "2025_01"), ("R1", "ok", "2025_01"), ("R2", "ok", "2025_01"),
                   ("R3", "undated", ""), ("R4", "ok", "2025_02")]
    # conservation: rows in = kept + removed duplicates
    rows_in = 7
    assert df.count() + 2 == rows_in
    out = str(folder / "out")
    P.write_recomposed(df, header, out)
    back = P.read_written(spark, out, header)
    assert sorted((r["status"], r["ym"] or "", r["Lieu"]) for r in back.collect()) == [
        ("ok", "2025_01", "Gare"), ("ok", "2025_01", "Nord"), ("ok", "2025_01", "Port"),
        ("ok", "2025_02", "Sud"), ("undated", "", "Quai")]
    first = glob.glob(out + "/status=ok/ym=2025_01/*.csv")[0]
    assert open(first, "rb").read().startswith(b"\xef\xbb\xbf")
    # input order kept inside a month file
    assert [line.split(";")[3] for line in open(first, encoding="utf-8-sig").read().splitlines()[1:]] == ["Gare", "Port", "Nord"]


def test_recompose_month_scope_and_keep_nulls(spark, folder):
    opts = P.RecomposeOptions(dedup_scope="month", null_key="keep")
    df, _ = P.recompose(spark, str(folder / "in"), opts)
    got = sorted((r["Référence"] or "", r["ym"] or "") for r in df.collect())
    assert got == [("", "2025_01"), ("", "2025_02"), ("R1", "2025_01"), ("R1", "2025_02"), ("R2", "2025_01"),
                   ("R3", ""), ("R4", "2025_02")]


def test_c19_capped_status(spark, tmp_path):
    write_text(str(tmp_path / "c" / "a.csv"), "Référence;Date;Timestamp\n"
               "A;16/11/2025 23:59:59;\nB;17/11/2025 00:00:00;\nC;;\nD;;1763337600000\n")
    df = P.capped(spark, str(tmp_path / "c"), "2025-11-16 23:59:59")
    got = sorted((r["Référence"], r["status"]) for r in df.collect())
    assert got == [("A", "ok"), ("B", "over_cap"), ("C", "undated"), ("D", "over_cap")]


def test_merge_detects_and_dedups(spark, tmp_path):
    write_text(str(tmp_path / "m1" / "a.csv"), "id,when,x\n1,02/01/2025 10:00,a\n2,03/01/2025 10:00,b\n")
    write_text(str(tmp_path / "m2" / "a.csv"), "id,when,x\n1,02/01/2025 10:00,a\n3,,c\n")
    write_text(str(tmp_path / "m2" / "b.csv"), "id,x\n9,z\n")
    kept, det = P.merge(spark, [str(tmp_path / "m1"), str(tmp_path / "m2")])
    assert sorted((r["id"], r["ym"]) for r in kept.collect()) == [("1", "2025-01"), ("2", "2025-01")]
    assert sorted((os.path.basename(r["file_name"]), r["date_column"]) for r in det.collect()) == \
        [("a.csv", "when"), ("a.csv", "when"), ("b.csv", None)]


def test_stream_equals_batch(spark, tmp_path):
    from alertfold.streaming import files as ST
    src = tmp_path / "s"
    for d in range(1, 4):
        write_text(str(src / f"e_{d}.csv"), "id;Date\n" + "".join(f"{d}{i};0{d}/01/2025 10:00:0{i}\n" for i in range(3))
                   + f"11;01/01/2025 10:00:01\n")
    s = ST.read_exports(spark, str(src), ["id", "Date"], max_files_per_trigger=1)
    from alertfold.functions import dates as D
    s = s.withColumn("dt", D.parse_strict(F.col("Date")))
    out, ck = str(tmp_path / "o"), str(tmp_path / "ck")
    ST.run_monthly(s, out, ck, key="id")
    back = spark.read.option("sep", ";").option("header", True).csv(out)
    assert sorted(r["id"] for r in back.collect()) == sorted({f"{d}{i}" for d in range(1, 4) for i in range(3)})
    ST.run_monthly(s, out, ck, key="id")   # restart: nothing new, nothing repeated
    assert spark.read.option("sep", ";").option("header", True).csv(out).count() == 9


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["ym", "n_rows"] and df.count() == 81
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs) and len(qs) >= 70


@pytest.mark.parametrize("name", ["monthly_counts", "dedup_key_first", "epoch_length_unit", "scan_delimited",
                                  "align_by_name", "rename_collisions", "sorted_months"])
def test_oracle_at_smallest_scale(spark, name):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in ("orders", "events", "documents", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    got = E.queries()[name](spark, sf)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(got.columns) == sorted(cols)
    key = lambda t: repr(t)
    spark_rows = sorted((tuple(r[c] for c in sorted(cols)) for r in got.collect()), key=key)
    duck = [dict(zip(cols, r)) for r in res.fetchall()]
    duck_rows = sorted((tuple(r[c] for c in sorted(cols)) for r in duck), key=key)
    assert spark_rows == duck_rows


def test_same_file_name_in_two_folders_is_two_files(spark, tmp_path):
    # per-file epoch unit: seconds in one a.csv, milliseconds in the other
    write_text(str(tmp_path / "c" / "x" / "a.csv"), "Référence;Date;Timestamp\nS;;1735776000\n")
    write_text(str(tmp_path / "c" / "y" / "a.csv"), "Référence;Date;Timestamp\nM;;1735776000000\n")
    df = P.capped(spark, str(tmp_path / "c"), "2030-01-01 00:00:00")
    got = sorted((r["Référence"], str(r["dt"])) for r in df.collect())
    assert got == [("M", "2025-01-02 00:00:00"), ("S", "2025-01-02 00:00:00")]
    # row router: each file's own header line is dropped
    a = write_text(str(tmp_path / "r" / "x" / "a.csv"), "Référence;Date\nR1;02/01/2025 10:00\n")
    b = write_text(str(tmp_path / "r" / "y" / "a.csv"), "Référence;Date\nR2;03/01/2025 11:00\n")
    routed = P.route(spark, [a, b], date_index=1)
    assert sorted((r["value"], r["ok"]) for r in routed.collect()) == [
        ("R1;02/01/2025 10:00", True), ("R2;03/01/2025 11:00", True)]


def test_checkpoint_root_refuses_a_local_folder_on_a_cluster():
    from alertfold.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Ctx:
        master = "spark://cluster:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


@pytest.mark.parametrize("na_tokens", [True, False])
def test_merge_missing_column_equals_nan_text(spark, tmp_path, na_tokens):
    # a missing column and the text 'nan' are the same content (both read as missing)
    write_text(str(tmp_path / "m" / "a.csv"), "id,when,x\n1,02/01/2025 10:00,nan\n")
    write_text(str(tmp_path / "m" / "b.csv"), "id,when\n1,2025-01-02 10:00:00\n2,2025-01-03 10:00:00\n")
    from alertfold.sources.csv import CsvOptions
    kept, _ = P.merge(spark, [str(tmp_path / "m")], CsvOptions(sep=",", exclude=(), na_tokens=na_tokens))
    got = sorted((r["id"], r["when"], r["_src"]) for r in kept.collect())
    assert got == [("1", "2025-01-02 10:00:00", "a.csv"), ("2", "2025-01-03 10:00:00", "b.csv")]


@pytest.mark.parametrize("broadcast_limit", [None, 0])   # batch keys broadcast, or a shuffle anti-join
def test_month_router_replay_is_exactly_once(spark, tmp_path, monkeypatch, broadcast_limit):
    if broadcast_limit is not None:
        monkeypatch.setattr("alertfold.operators.small.MAX_BROADCAST_ROWS", broadcast_limit)
    from alertfold.functions import dates as D
    from alertfold.sinks.files import delete_dir
    from alertfold.streaming import files as ST
    out = str(tmp_path / "o")
    handle = ST.monthly_router(out, "id")

    def batch(rows):
        return (spark.createDataFrame(rows, "id string, Date string, _src string")
                .withColumn("dt", D.parse_strict(F.col("Date"))))

    handle(batch([("1", "02/01/2025 10:00:00", "a.csv"), ("2", "03/02/2025 10:00:00", "a.csv")]), 0)
    b1 = batch([("1", "05/01/2025 10:00:00", "b.csv"), ("3", "04/01/2025 10:00:00", "b.csv"),
                ("3", "06/01/2025 10:00:00", "b.csv")])
    handle(b1, 1)
    delete_dir(spark, out + "/_keys/_done/1")   # as if the run died before the marker
    handle(b1, 1)
    handle(b1, 1)                                # marker present: nothing happens
    back = spark.read.option("sep", ";").option("header", True).csv(out)
    assert sorted((r["id"], r["Date"], str(r["ym"])) for r in back.collect()) == [
        ("1", "02/01/2025 10:00:00", "2025_01"), ("2", "03/02/2025 10:00:00", "2025_02"),
        ("3", "04/01/2025 10:00:00", "2025_01")]
    assert not os.path.exists(tmp_path / "o" / "_staging" / "1")


def test_key_index_compaction(spark, tmp_path):
    from alertfold.functions import dates as D
    from alertfold.streaming import files as ST
    out = str(tmp_path / "o")
    handle = ST.monthly_router(out, "id")

    def batch(rows):
        return (spark.createDataFrame(rows, "id string, Date string, _src string")
                .withColumn("dt", D.parse_strict(F.col("Date"))))

    b0 = batch([("1", "02/01/2025 10:00:00", "a.csv"), ("2", "03/02/2025 10:00:00", "a.csv")])
    handle(b0, 0)
    handle(batch([("3", "04/01/2025 10:00:00", "b.csv")]), 1)
    assert ST.compact_key_index(spark, out) == 2
    parts = sorted(os.path.relpath(p, out + "/_keys") for p in glob.glob(out + "/_keys/ym=*/batch=*"))
    assert parts == ["ym=2025_01/batch=-1", "ym=2025_02/batch=-1"]
    assert ST.compact_key_index(spark, out) == 2          # repeatable: same keys, same layout
    handle(batch([("1", "09/01/2025 10:00:00", "c.csv"), ("4", "05/01/2025 10:00:00", "c.csv")]), 2)
    handle(b0, 0)                                         # committed before: still skipped
    back = spark.read.option("sep", ";").option("header", True).csv(out)
    assert sorted((r["id"], r["ym"]) for r in back.collect()) == [
        ("1", "2025_01"), ("2", "2025_02"), ("3", "2025_01"), ("4", "2025_01")]
    keys = spark.read.parquet(out + "/_keys")
    assert sorted(r["k"] for r in keys.collect()) == ["1", "2", "3", "4"]


def test_router_reads_quoted_cells_and_takes_the_separator_literally(spark, tmp_path):
    a = write_text(str(tmp_path / "a.csv"), 'Lieu;Date\n"Gare; quai 2";31/12/2024 21:59\nPort;31/12/2024 22:00;v\nx\n\n')
    b = write_text(str(tmp_path / "b.csv"), "Lieu|Date\nGare|31/12/2024 21:59\n")
    routed = P.route(spark, [a])
    assert sorted((r["value"][:5], r["ok"]) for r in routed.collect()) == [("", False), ('"Gare', True), ("Port;", True), ("x", False)]
    assert [r["ok"] for r in P.route(spark, [b], sep="|").collect()] == [True]
    out = str(tmp_path / "out")
    P.write_routed(routed, "Lieu;Date", out)
    lines = [r.value for r in spark.read.text(out + "/ym=2024_12").collect()]
    assert sorted(lines) == sorted(["Lieu;Date", '"Gare; quai 2";31/12/2024 21:59', "Port;31/12/2024 22:00;v"])


def test_merged_output_moves_the_date_column(spark, tmp_path):
    write_text(str(tmp_path / "in" / "a.csv"), "id,Date,x\n1,31/01/2025 10:00,p\n2,01/02/2025,q\n")
    kept, detected = P.merge(spark, [str(tmp_path / "in")])
    P.write_merged(kept, str(tmp_path / "out"), detected)
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["Date", "id", "x", "ym"]
    assert sorted(tuple(r) for r in back.select("Date", "id").collect()) == [("2025-01-31 10:00:00", "1"), ("2025-02-01 00:00:00", "2")]


def test_capped_output_replaces_the_date_and_finds_the_key_after_accent_repair(spark, tmp_path):
    write_text(str(tmp_path / "in" / "a.csv"), "Référence;Date;Timestamp\nR1;03/01/2025 10:00:00;\nR2;03/01/2099 10:00:00;\nR3;?;\n")
    df = P.capped(spark, str(tmp_path / "in"), "2025-11-16 23:59:59", P.C.CsvOptions(header_fix="accents"))
    out = str(tmp_path / "out")
    P.write_capped(df, out, header_fix="accents")
    month = spark.read.option("sep", ";").option("header", True).csv(out + "/status=ok")
    assert "Date_iso" not in month.columns and [r["Date"] for r in month.collect()] == ["2025-01-03 10:00:00"]
    audit = spark.read.option("sep", ";").option("header", True).csv(out + "/_audit")
    assert sorted(r["Reference"] for r in audit.collect()) == ["R2", "R3"]


def test_month_router_does_not_depend_on_batches(spark, tmp_path):
    rows = [("a", 1, "1", dt.datetime(2025, 1, 1)), ("a", 2, "2", dt.datetime(2025, 1, 2)), ("b", 3, "1", dt.datetime(2025, 2, 1)),
            ("b", 4, None, dt.datetime(2025, 1, 5)), ("c", 5, None, dt.datetime(2025, 2, 5)), ("c", 6, "1", dt.datetime(2025, 1, 9))]
    for scope, want in (("month", 5), ("global", 3)):
        counts = []
        for k, cuts in enumerate(([[0, 1, 2, 3, 4, 5]], [[0, 1], [2, 3], [4, 5]], [[0], [1], [2], [3], [4], [5]])):
            out = str(tmp_path / f"{scope}{k}")
            handle = ST.monthly_router(out, "id", scope=scope)
            for n, part in enumerate(cuts):
                handle(spark.createDataFrame([rows[i] for i in part], "_src string, n int, id string, dt timestamp_ntz"), n)
            counts.append(spark.read.option("sep", ";").option("header", True).csv(out).where("n is not null").count())
        assert counts == [want] * 3


def test_ts_name_prefers_the_exact_name():
    assert P.detect_ts_name(["a (timestamp)", " TimeStamp "]) == " TimeStamp "
    assert P.detect_ts_name(["x", "Epoch (Timestamp) "]) == "Epoch (Timestamp) " and P.detect_ts_name(["x"]) is None
