"""CSV discovery, headers, alignment, malformed rows, encodings (FIXTURES C12-C14, C17, C20)."""

import os

import pytest

from alertfold.functions.names import INCLUDE_SOURCES
from alertfold.sources import csv as C
from conftest import write_text

BOM = "﻿"


def test_c17_exclusion_and_inclusion(spark, tmp_path):
    names = ["alertes_2025_01.csv", "ALERTES_2025_02.CSV", "alertes_sans_date.csv", "Alertes_-2025-01.csv",
             "Alertes_-2024.csv", "alertes_2025-12-01_2025-12-07.csv", "notes.txt"]
    for n in names:
        write_text(str(tmp_path / "sub" / n), "a;b\n1;2\n")
    got = sorted(os.path.basename(p) for p in C.discover(spark, str(tmp_path)))
    assert got == ["Alertes_-2024.csv", "Alertes_-2025-01.csv", "alertes_2025-12-01_2025-12-07.csv"]
    inc = sorted(os.path.basename(p) for p in C.discover(spark, str(tmp_path), C.CsvOptions(include=INCLUDE_SOURCES)))
    assert inc == ["Alertes_-2024.csv", "Alertes_-2025-01.csv"]


def test_s17_empty_inputs(spark, tmp_path):
    with pytest.raises(C.NoSourceFiles):
        C.discover(spark, str(tmp_path / "nothing_here"))
    write_text(str(tmp_path / "e" / "empty.csv"), "")
    with pytest.raises(C.NoSourceFiles):
        C.read_aligned(spark, str(tmp_path / "e"))


def test_c12_positional_alignment(spark, tmp_path):
    write_text(str(tmp_path / "a_old.csv"), BOM + "x;y;z;u;v\n1;2;3;4;5\n")
    write_text(str(tmp_path / "b_short.csv"), BOM + "x;y\n6;7\n")
    write_text(str(tmp_path / "c_ref.csv"), BOM + " p ;q;r\n8;9;10\n")
    df, header = C.read_aligned(spark, str(tmp_path))
    assert header == ["p", "q", "r"]
    got = sorted((tuple(r) for r in df.select("p", "q", "r", "_src", "_cells").collect()), key=repr)
    assert got == [("1", "2", "3", "a_old.csv", 5), ("6", "7", None, "b_short.csv", 2), ("8", "9", "10", "c_ref.csv", None)]


def test_c13_by_name(spark, tmp_path):
    write_text(str(tmp_path / "1.csv"), "a;b\n1;2\n")
    write_text(str(tmp_path / "2.csv"), "b;c\n3;4\n")
    df = C.read_by_name(spark, C.discover(spark, str(tmp_path)))
    got = sorted((tuple(r) for r in df.select("a", "b", "c").collect()), key=repr)
    assert got == [("1", "2", None), (None, "3", "4")]


@pytest.mark.parametrize("limit", [10_000, 1])
def test_by_name_from_roots_predicate_or_file_index(spark, tmp_path, monkeypatch, limit):
    # small groups: root scan + path predicate; large groups: paths given to the file index
    monkeypatch.setattr(C, "MAX_PATH_PREDICATE", limit)
    write_text(str(tmp_path / "x" / "1.csv"), "a;b\n1;2\n")
    write_text(str(tmp_path / "x" / "2.csv"), "a;b\n5;6\n")
    write_text(str(tmp_path / "y" / "3.csv"), "b;c\n3;4\n")
    write_text(str(tmp_path / "y" / "alertes_2025_01.csv"), "a;b\n9;9\n")   # own output: excluded
    root = str(tmp_path)
    df = C.read_by_name(spark, C.discover(spark, root), roots=[root])
    got = sorted((tuple(r) for r in df.select("a", "b", "c", C.SOURCE).collect()), key=repr)
    assert got == [("1", "2", None, "1.csv"), ("5", "6", None, "2.csv"), (None, "3", "4", "3.csv")]


def test_c14_long_row_kept_or_file_dropped(spark, tmp_path):
    write_text(str(tmp_path / "a.csv"), "k;d\n1;x\n2;y;extra\n")
    write_text(str(tmp_path / "b.csv"), "k;d\n3;z\n")
    keep, _ = C.read_aligned(spark, str(tmp_path))
    assert sorted((tuple(r) for r in keep.select("k", "d", "_cells").collect()), key=repr) == [("1", "x", None), ("2", "y", 3), ("3", "z", None)]
    drop, _ = C.read_aligned(spark, str(tmp_path), bad_files="drop")
    assert [tuple(r) for r in drop.select("k").collect()] == [("3",)]


def test_c20_quotes_and_multiline(spark, tmp_path):
    write_text(str(tmp_path / "q.csv"), 'k;v\n1;"a ""q"" b"\n2;"line1\nline2"\n')
    one, _ = C.read_aligned(spark, str(tmp_path), C.CsvOptions(multiline=True))
    assert sorted(tuple(r) for r in one.select("k", "v").collect()) == [("1", 'a "q" b'), ("2", "line1\nline2")]


def test_na_tokens_and_value_preserving(spark, tmp_path):
    write_text(str(tmp_path / "n.csv"), 'k;v\n1;NA\n2;\n3;nan\n4;ok\n')
    na, _ = C.read_aligned(spark, str(tmp_path))
    raw, _ = C.read_aligned(spark, str(tmp_path), C.CsvOptions(na_tokens=False))
    assert [r[0] for r in na.orderBy("k").select("v").collect()] == [None, None, None, "ok"]
    assert [r[0] for r in raw.orderBy("k").select("v").collect()] == ["NA", "", "nan", "ok"]


def test_latin1_and_header_repairs(spark, tmp_path):
    write_text(str(tmp_path / "l.csv"), "Référence;Année\nRé1;2025\n", encoding="latin-1")
    df, header = C.read_aligned(spark, str(tmp_path), C.CsvOptions(encoding="ISO-8859-1"))
    assert header == ["Référence", "Année"] and df.first()["Référence"] == "Ré1"
    write_text(str(tmp_path / "u" / "u.csv"), "Référence;Année\nRé1;2025\n")
    df, header = C.read_aligned(spark, str(tmp_path / "u"),
                                C.CsvOptions(encoding="ISO-8859-1", header_fix="mojibake", repair_values=True))
    assert header == ["Référence", "Année"] and df.first()["Référence"] == "Ré1"
    _, header = C.read_aligned(spark, str(tmp_path / "u"), C.CsvOptions(header_fix="accents"))
    assert header == ["Reference", "Annee"]


def test_duplicate_header_names_are_mangled():
    assert C.mangle(["a", "b", "a", "a", "a.1"]) == ["a", "b", "a.1", "a.2", "a.1.1"]


def test_file_order_across_blocks(spark, tmp_path):
    lines = "".join(f"{i};v{i}\n" for i in range(20000))
    write_text(str(tmp_path / "big.csv"), "k;v\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df, _ = C.read_aligned(spark, str(tmp_path))
        ordered = [int(r[0]) for r in df.orderBy("_ord").select("k").collect()]
        assert df.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ordered == list(range(20000))


def test_file_names_with_spaces_accents_and_brackets(spark, tmp_path):
    # discovered paths are URI-escaped ('%20'): every read must still find the files, and
    # the provenance column shows the name as on disk
    names = {"Alertes_2024-01 à 03.csv": "a;b\n1;2\n", "x y.csv": "b;c\n5;6\n", "br[1]+.csv": "a;b\n7;8\n"}
    for n, body in names.items():
        write_text(str(tmp_path / n), body)
    files = C.discover(spark, str(tmp_path))
    assert len(files) == 3
    for method in ("arrow", "scan"):
        got = sorted(r["line"] for r in C.header_lines(spark, files, C.CsvOptions(), method=method).collect())
        assert got == ["a;b", "a;b", "b;c"], method
    assert sorted(line for _, line in C.collect_header_lines(spark, files, C.CsvOptions())) == ["a;b", "a;b", "b;c"]
    want = [("1", "2", None, "Alertes_2024-01 à 03.csv"), ("7", "8", None, "br[1]+.csv"), (None, "5", "6", "x y.csv")]
    for roots in ([str(tmp_path)], None):
        df = C.read_by_name(spark, files, roots=roots)
        assert sorted((tuple(r) for r in df.select("a", "b", "c", C.SOURCE).collect()), key=repr) == sorted(want, key=repr)
    assert sorted(r["value"] for r in C.read_raw_lines(spark, files).collect()) == ["1;2", "5;6", "7;8"]
    aligned, header = C.read_aligned(spark, str(tmp_path))
    assert sorted(r[C.SOURCE] for r in aligned.collect()) == sorted(names)
    # name rules see the decoded name
    opts = C.CsvOptions(include=r"^Alertes_\d{4}-\d{2} à \d{2}\.csv$")
    assert [p.rsplit("/", 1)[-1] for p in C.discover(spark, str(tmp_path), opts)] == ["Alertes_2024-01%20à%2003.csv"]
    only, _ = C.read_aligned(spark, str(tmp_path), opts)
    assert [r[C.SOURCE] for r in only.collect()] == ["Alertes_2024-01 à 03.csv"]


def test_reader_path_and_arrow_uri():
    assert C.reader_path("file:/d/x%20y%5B1%5D.csv") == "file:/d/x y\\[1\\].csv"
    assert C._arrow_uri("file:/d/a%20à.csv") == "file:///d/a%20%C3%A0.csv"
    assert C._arrow_uri("s3a://bucket/k%20e y.csv") == "s3://bucket/k%20e%20y.csv"


def test_files_are_ordered_by_path_components(spark, tmp_path):
    for name in ("2025/x.csv", "2025-b/x.csv", "2025.csv"):
        write_text(str(tmp_path / name), f"k;v\nsame;{name}\n")
    files = C.discover(spark, str(tmp_path), C.CsvOptions())
    assert [f[f.index("2025"):] for f in files] == ["2025/x.csv", "2025-b/x.csv", "2025.csv"]
    from alertfold.operators.dedup import dedup_first
    from alertfold.operators.order import ORDER_COL
    df, header = C.read_aligned(spark, str(tmp_path), C.CsvOptions())
    assert [r.v for r in dedup_first(df, ["k"], ORDER_COL).collect()] == ["2025/x.csv"]
