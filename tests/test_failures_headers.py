"""Failure ledger of unreadable files, and headers whose names differ only in case."""

import os

import pytest

from alertfold.plans import pipelines as P
from alertfold.sinks.files import publish_month_files
from alertfold.sources import csv as C
from conftest import write_text

HEAD = "Référence;Date;Timestamp\n"


def folder(tmp_path):
    root = str(tmp_path / "in")
    write_text(f"{root}/a/Alertes_-2025-01.csv", HEAD + "R1;01/01/2025 10:00:00;\nR2;02/01/2025 10:00:00;\n")
    write_text(f"{root}/Alertes_-2025-02.csv", HEAD + "R3;01/02/2025 10:00:00;\n")
    write_text(f"{root}/latin.csv", HEAD + "R4;01/02/2025 10:00:00;\n", encoding="latin-1")
    write_text(f"{root}/late.csv", "Ref;Date;Timestamp\n" + "R5;01/02/2025 10:00:00;\n" * 60_000)
    with open(f"{root}/late.csv", "ab") as f:
        f.write(b"R\xe9;;\n")
    write_text(f"{root}/empty.csv", "")
    write_text(f"{root}/blank.csv", " \n\t\n")
    write_text(f"{root}/with space é.csv", "")
    write_text(f"{root}/Z.csv", HEAD + "R9;03/01/2025 10:00:00;\n")
    return root


def names(ledger):
    return {os.path.basename(C.reader_path(p)): e for p, e in ledger.items()}


def test_ledger_names_the_files_and_the_others_are_read(spark, tmp_path):
    root = folder(tmp_path)
    files = C.discover(spark, root)
    kept, ledger = C.split_failed(spark, files)
    want = {"latin.csv": C.UNDECODABLE, "empty.csv": C.EMPTY, "blank.csv": C.EMPTY, "with space é.csv": C.EMPTY}
    assert names(ledger) == want and len(kept) == len(files) - 4
    _, whole = C.split_failed(spark, files, whole=True)
    assert names(whole) == want | {"late.csv": C.UNDECODABLE}
    df, header = C.read_aligned(spark, root, failed="skip_whole")
    assert header == ["Référence", "Date", "Timestamp"]
    assert sorted(r["Référence"] for r in df.collect()) == ["R1", "R2", "R3", "R9"]
    gone = files[0].rsplit("/", 1)[0] + "/not-there.csv"
    assert C.split_failed(spark, [gone, files[0]])[1] == {gone: C.UNREADABLE}


def test_many_failed_files_and_no_good_one(spark, tmp_path, monkeypatch):
    root = folder(tmp_path)
    monkeypatch.setattr(C, "MAX_PATH_PREDICATE", 1)
    df, _ = C.read_aligned(spark, root, failed="skip_whole")
    assert sorted(r["Référence"] for r in df.collect()) == ["R1", "R2", "R3", "R9"]
    write_text(str(tmp_path / "bad" / "x.csv"), "")
    with pytest.raises(C.NoSourceFiles):
        C.read_aligned(spark, str(tmp_path / "bad"), failed="skip")


def test_ledger_by_scan(spark, tmp_path, monkeypatch):
    """File systems Arrow cannot open."""
    monkeypatch.setattr(C, "_arrow_can_open", lambda path: False)
    root = folder(tmp_path)
    got = names(C.split_failed(spark, C.discover(spark, root))[1])
    assert got == {"latin.csv": C.UNDECODABLE, "empty.csv": C.UNREADABLE, "blank.csv": C.UNREADABLE,
                   "with space é.csv": C.UNREADABLE}


def test_recompose_skips_failed_files(spark, tmp_path):
    df, _ = P.recompose(spark, folder(tmp_path), P.RecomposeOptions(failed="skip_whole"))
    assert sorted(r["Référence"] for r in df.collect()) == ["R1", "R2", "R3", "R9"]


def test_headers_that_differ_in_case(spark, tmp_path):
    assert C.distinct_names(["Date", "date", "DATE", "x"]) == ["Date", "date" + C.CASE_MARK, "DATE" + C.CASE_MARK * 2, "x"]
    head = "Référence;Date;date;DATE\n"
    root = str(tmp_path / "in")
    write_text(f"{root}/Alertes_-2025-01.csv", head + "R1;01/01/2025 10:00:00;b;c\nR2;;e;f\n")
    write_text(f"{root}/Alertes_-2025-02.csv", head + "R1;01/01/2025 10:00:00;x;y\nR3;03/02/2025 10:00:00;h;i\n")
    df, header = P.recompose(spark, root)
    assert [C.display_name(c) for c in header] == ["Référence", "Date", "date", "DATE"]
    out, exact = str(tmp_path / "out"), str(tmp_path / "exact")
    P.write_recomposed(df, header, out, bom=False)
    back = P.read_written(spark, out, header).select(*header, "status").collect()
    assert sorted(tuple(r) for r in back) == [("R1", "01/01/2025 10:00:00", "b", "c", "ok"), ("R2", None, "e", "f", "undated"),
                                              ("R3", "03/02/2025 10:00:00", "h", "i", "ok")]
    publish_month_files(spark, out + "/status=ok", exact)
    with open(f"{exact}/alertes_2025_02.csv", encoding="utf-8") as f:
        assert f.read() == head + "R3;03/02/2025 10:00:00;h;i\n"
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    by_name = C.read_by_name(spark, C.discover(spark, root))
    assert sorted(r[2] for r in by_name.select(*header).collect()) == ["b", "e", "h", "x"]
