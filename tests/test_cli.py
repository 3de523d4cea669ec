"""Command line (the reference's only user-facing surface: -i / -o / --dry-run), run in-process."""

import glob
import os

from alertfold.plans import cli
from conftest import write_text

BOM = "﻿"
HEADER = "Référence;Date;Timestamp;Lieu\n"


def _exports(root):
    write_text(str(root / "Alertes_-2025-01.csv"), BOM + HEADER + "R1;03/01/2025 10:00:00;;Gare\n"
               "R2;;1735776000;Port\nR3;inconnue;;Quai\n")
    write_text(str(root / "Alertes_-2025-02.csv"), BOM + HEADER + "R1;01/02/2025 09:00:00;;Gare\n"
               "R4;03/02/2025 07:30:00;;Sud\n")


def test_week(spark, capsys):
    assert cli.main(["week", "--today", "2025-12-08"]) == 0
    assert capsys.readouterr().out.strip() == "2025-12-01\t2025-12-07\talertes_2025-12-01_2025-12-07.csv"


def test_recompose_dry_run_then_write_with_exact_names(spark, tmp_path, capsys):
    _exports(tmp_path / "in")
    out, named = str(tmp_path / "out"), str(tmp_path / "named")
    assert cli.main(["recompose", "-i", str(tmp_path / "in"), "-o", out, "--dry-run"]) == 0
    counts = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert counts == {"None": "1", "2025_01": "2", "2025_02": "1"}
    assert not os.path.exists(out)
    assert cli.main(["recompose", "-i", str(tmp_path / "in"), "-o", out, "--exact-names", named]) == 0
    assert sorted(os.path.basename(p) for p in glob.glob(named + "/*.csv")) == ["alertes_2025_01.csv", "alertes_2025_02.csv"]
    jan = open(named + "/alertes_2025_01.csv", encoding="utf-8-sig").read().splitlines()
    assert jan == ["Référence;Date;Timestamp;Lieu", "R1;03/01/2025 10:00:00;;Gare", "R2;;1735776000;Port"]
    assert glob.glob(out + "/status=undated/ym=*/*.csv")   # undated rows: NULL month partition


def test_capped_merge_and_route(spark, tmp_path, capsys):
    _exports(tmp_path / "in")
    assert cli.main(["capped", "-i", str(tmp_path / "in"), "-o", str(tmp_path / "c"), "--cap",
                     "2025-01-31 23:59:59", "--dry-run"]) == 0
    assert dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines()) == \
        {"ok": "2", "over_cap": "2", "undated": "1"}
    write_text(str(tmp_path / "m" / "a.csv"), "id,when\n1,02/01/2025 10:00\n2,03/02/2025 10:00\n")
    write_text(str(tmp_path / "m" / "b.csv"), "id,when\n1,2025-01-02 10:00:00\n")
    assert cli.main(["merge", "-i", str(tmp_path / "m"), "-o", str(tmp_path / "mo"), "--dry-run"]) == 0
    assert dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines()) == \
        {"2025-01": "1", "2025-02": "1"}
    write_text(str(tmp_path / "r" / "f.csv"), "Référence;Date\nR1;02/01/2025 10:00\nR2;bad\n\n")
    assert cli.main(["route", "-i", str(tmp_path / "r"), "-o", str(tmp_path / "ro")]) == 0
    assert '"total": 3, "ok": 1, "errors": 2' in capsys.readouterr().out
    assert glob.glob(str(tmp_path / "ro" / "ym=2025_01" / "*.csv"))


def test_rename_plan_reads_names_as_on_disk(spark, tmp_path, capsys):
    for n in ("Alertes_2024-01 à 03.csv", "2025-10-24_au_2025-10-30.csv", "foo.csv"):
        write_text(str(tmp_path / n), "x\n")
    assert cli.main(["rename", "-i", str(tmp_path)]) == 0
    plan = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert plan == {"Alertes_2024-01 à 03.csv": "alertes_2024_01-03_complet.csv",
                    "2025-10-24_au_2025-10-30.csv": "alertes_2025_24-10_au_30-10.csv",
                    "foo.csv": "UNRECOGNISED"}
