"""File-name rules (F14, F18-F22, C25) and writers (W1, W4, W5; C21-C23)."""

import glob
import os

from pyspark.sql import functions as F

from alertfold.functions import names as N
from alertfold.plans import pipelines as P
from alertfold.sinks import files as W
from conftest import write_text

RULES = [
    ("2025-10-24_au_2025-10-30.csv", "alertes_2025_24-10_au_30-10.csv", None),
    ("Alertes_2024.csv", "alertes_2024_complet.csv", None),
    ("Alertes-2024-01à03.csv", "alertes_2024_01-03_complet.csv", None),
    ("Alertes_2024-01 à 03.csv", "alertes_2024_01-03_complet.csv", None),
    ("Alertes_2025-01_05au12.csv", "alertes_2025_05-01_au_12-01.csv", None),
    ("Alertes_2025-01-05.csv", "alertes_2025_05-01.csv", None),
    ("24-10-2025_au_30-10-2025.csv", None, "alertes_2025_24-10_au_30-10.csv"),
    ("foo.csv", None, None),
]


def test_rename_rules(spark):
    df = spark.createDataFrame([(n,) for n, _, _ in RULES], "name string")
    got = [tuple(r) for r in df.select(N.rewrite_name(F.col("name"), "en"), N.rewrite_name(F.col("name"), "fr")).collect()]
    assert got == [(en, fr) for _, en, fr in RULES]


def test_range_and_month_names(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2025, 12, 1), dt.date(2025, 12, 7))], "s date, e date")
    got = df.select(*[N.range_file_base(F.col("s"), F.col("e"), st) for st in ("dash", "au", "du_au", "daymonth")],
                    N.month_file_name(F.col("s")), N.month_file_name(F.col("s"), "dash"),
                    N.month_file_name(F.col("s"), "bare")).first()
    assert tuple(got) == ("alertes_2025-12-01_2025-12-07", "alertes_2025-12-01_au_2025-12-07",
                          "alertes_2025_12_du_01_au_07-12", "alertes_2025_01-12_au_07-12",
                          "alertes_2025_12.csv", "alertes_2025-12.csv", "2025_12.csv")


def test_c25_collision_suffix(spark):
    from alertfold.operators import rank
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "y")], "o long, base string")
    r = rank.rank_within(df, ["base"], ["o"])
    got = sorted(r[0] for r in r.select(N.with_suffix(F.col("base"), F.col("pos") - 1)).collect())
    assert got == ["x.csv", "x_1.csv", "x_2.csv", "y.csv"]


def test_c21_c23_writer_keeps_values_and_bom(spark, tmp_path):
    df = spark.createDataFrame([("  a  ", "", None, "ym1")], "v string, e string, n string, ym string")
    out = str(tmp_path / "o")
    W.write_partitioned(df, out, ["ym"], bom=True)
    f = glob.glob(out + "/ym=ym1/*.csv")[0]
    data = open(f, "rb").read()
    assert data.startswith(b"\xef\xbb\xbf")
    assert data.decode("utf-8-sig").splitlines() == ["v;e;n", "  a  ;;"]
    W.write_partitioned(df, str(tmp_path / "nobom"), ["ym"], bom=False)
    assert not open(glob.glob(str(tmp_path / "nobom") + "/ym=ym1/*.csv")[0], "rb").read().startswith(b"\xef")


def test_c22_dynamic_overwrite_keeps_other_months(spark, tmp_path):
    out = str(tmp_path / "m")
    first = spark.createDataFrame([("a", "2025_01"), ("b", "2025_02")], "v string, ym string")
    W.write_partitioned(first, out, ["ym"], bom=False)
    second = spark.createDataFrame([("c", "2025_02")], "v string, ym string")
    W.write_partitioned(second, out, ["ym"], bom=False)
    back = spark.read.option("header", True).option("sep", ";").csv(out)
    assert sorted(tuple(r) for r in back.select("v", "ym").collect()) == [("a", "2025_01"), ("c", "2025_02")]


def test_exact_month_names(spark, tmp_path):
    df = spark.createDataFrame([(str(i), "2025_01" if i < 5 else "2025_02") for i in range(8)], "v string, ym string")
    out = str(tmp_path / "m")
    W.write_partitioned(df.repartition(4), out, ["ym"], bom=True)
    names = W.publish_month_files(spark, out, str(tmp_path / "named"))
    assert names[0] == "alertes_2025_01.csv" and "alertes_2025_02.csv" in names
    got = []
    for n in names:
        if n.startswith("alertes_2025_01"):
            text = open(tmp_path / "named" / n, encoding="utf-8-sig").read().splitlines()
            assert text[0] == "v"
            got += text[1:]
    assert sorted(got) == ["0", "1", "2", "3", "4"]
    # published outputs (exact names and extra parts) are never read back as sources
    import pytest
    from alertfold.sources import csv as C
    with pytest.raises(C.NoSourceFiles):
        C.discover(spark, str(tmp_path / "named"))


def test_write_named_csv(spark, tmp_path):
    df = spark.createDataFrame([("d1/a.csv", 2, "x"), ("d1/a.csv", 1, "y"), ("b.csv", 3, "z")], "f string, o long, v string")
    W.write_named_csv(df, str(tmp_path), "f", order=["o"], bom=False)
    assert open(tmp_path / "d1" / "a.csv").read().splitlines() == ["o;v", "1;y", "2;x"]
    assert os.path.exists(tmp_path / "b.csv")


def test_c24_router_counts(spark, tmp_path):
    write_text(str(tmp_path / "r.csv"), "Ref;Date;X\nonlyone\n\nR2;99/99/2025 10:00;a\nR3;31/12/2024 21:59;b\n")
    routed = P.route(spark, [str(tmp_path / "r.csv")], date_index=1)
    from alertfold.operators import quality
    st = quality.file_stats(routed, "_src", F.col("ok")).first()
    assert (st["total"], st["ok"], st["errors"]) == (4, 1, 3)
    assert [r[0] for r in routed.where("ok").select("ym").collect()] == ["2024_12"]


def test_split_month_parts_keep_order(spark, tmp_path):
    # one month over several writer tasks: the parts, in name order, hold the rows in order
    df = spark.createDataFrame([(i, "2025_01") for i in range(400)], "o int, ym string").orderBy(F.rand(7))
    out = str(tmp_path / "m")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                             "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.write_partitioned(df, out, ["ym"], order=["o"], bom=False, ordered_parts=True, month_rows=100)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = W.publish_month_files(spark, out, str(tmp_path / "named"))
    assert len(names) > 1 and names[0] == "alertes_2025_01.csv"
    got = []
    for n in names:   # exact name first, then _p001, _p002 ...
        got += [int(x) for x in open(tmp_path / "named" / n).read().splitlines()[1:]]
    assert got == list(range(400))


def test_free_numbers_skip_existing_files(spark):
    taken = [0, 1, 3, 7, 8]
    df = spark.range(8).select(F.col("id").alias("n"), F.array(*[F.lit(x) for x in taken]).alias("t"))
    got = [r[0] for r in df.select(N.free_number(F.col("n"), F.col("t"))).collect()]
    free = [x for x in range(40) if x not in taken]
    assert got == free[:8]
    assert [r[0] for r in df.limit(2).select(N.free_number(F.col("n"), F.lit(None).cast("array<int>"))).collect()] == [0, 1]
    names = spark.createDataFrame([("x.csv",), ("x_1.csv",), ("x_1_1.csv",), ("x_a.csv",), ("x_12.csv",), ("x.txt",), ("y.csv",)], "f string")
    assert [r[0] for r in names.select(N.taken_number(F.col("f"), F.lit("x"))).collect()] == [0, 1, None, None, 12, None, None]


def test_publishing_again_removes_stale_parts(spark, tmp_path):
    from alertfold.sinks import files as S
    target = tmp_path / "final"
    for parts in (3, 1):
        out = str(tmp_path / f"out{parts}")
        spark.range(30).selectExpr("id", "'2025_01' as ym").repartition(parts).write.partitionBy("ym").option("header", True).csv(out)
        S.publish_month_files(spark, out, str(target))
    assert sorted(p.name for p in target.glob("*.csv")) == ["alertes_2025_01.csv"]
