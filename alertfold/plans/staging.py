"""Export folders derived from the tables, written once per (scale, variant) into the
shared checkpoint folder and reused: the inputs of the file-based queries.

base:    one ';' CSV per ``src`` (BOM header ``ord;Référence;Date;Timestamp;Priorité``)
         in year sub-folders, plus files the pipeline must treat specially: earlier
         month outputs and an audit file (excluded by name) and one weekly export
         named by the scraper (``alertes_1995-01-02_1995-01-08.csv``), which the
         current pipeline ingests and the include-pattern variant does not.
drift:   same rows, headers drifting by year (extra column, reordered columns,
         blanks around names, a ``(timestamp)``-suffixed epoch column).
drift_latin1: the same in Latin-1.
undated: ',' sources of 1996, those of odd months without any date.
comma:   ',' separated copy of base sources.
shifted_comma: ',' sources named 7 days later (exports overlapping month ends).
events:  ``events`` as one export per day, dates as ``dd/MM/yyyy HH:mm:ss`` text.
events_overlap: every event in the export of its day and of the next day.
faulty:  base sources, those of 1997 in Latin-1 (which UTF-8 cannot decode), and an empty file.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertfold.plans.alerts import alerts, read_table
from alertfold.session import stable_dir
from alertfold.sinks.files import _fs, delete_dir, exists, rename_dir, touch, write_named_csv

BASE_HEADER = ("ord", "Référence", "Date", "Timestamp", "Priorité")
EMPTY_FILE = "Alertes_-1990-01.csv"
SCRAPER_DECOY = "alertes_1995-01-02_1995-01-08.csv"


def _tag(spark: SparkSession, sf_dir: str) -> str:
    """Names the tables' state: path, and every file's name, size and modification time (a
    metadata listing), so that replaced tables are staged anew."""
    fs, jvm = _fs(spark, sf_dir)
    files, found = fs.listFiles(jvm.org.apache.hadoop.fs.Path(sf_dir), True), []
    while files.hasNext():
        st = files.next()
        found.append(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.sha1("|".join([sf_dir.rstrip("/"), *sorted(found)]).encode()).hexdigest()[:10]


def _base_cols(a: DataFrame) -> list:
    return [F.col("ord").alias("__o"), F.col("ord").cast("string").alias("ord"), F.col("ref").alias("Référence"),
            F.col("date_raw").alias("Date"), F.col("ts_raw").alias("Timestamp"),
            F.col("body").alias("Priorité")]


def _year_path(src: str = "src"):
    return F.concat(F.substring(F.col(src), 10, 4), F.lit("/"), F.col(src))


# bump when the staged layout changes, so that folders of older layouts are not reused
STAGING_VERSION = "v5"


def stage(spark: SparkSession, sf_dir: str, variant: str) -> str:
    """Folder of the staged exports, built on first use.

    It is built in a private folder and published with one directory rename, so a
    concurrent caller either sees the complete folder or builds its own copy and
    discards it."""
    final = stable_dir(spark, "exports", STAGING_VERSION, _tag(spark, sf_dir), variant)
    if exists(spark, final + "/_READY"):
        return final
    import uuid
    root = f"{final}.building-{uuid.uuid4().hex}"
    _build(spark, sf_dir, variant, root)
    touch(spark, root + "/_READY")
    if not rename_dir(spark, root, final):
        delete_dir(spark, root)          # another caller published first
        if not exists(spark, final + "/_READY"):
            raise RuntimeError(f"could not publish staged folder {final}")
    return final


def _build(spark: SparkSession, sf_dir: str, variant: str, root: str) -> None:
    if variant == "base":
        a = alerts(spark, sf_dir)
        write_named_csv(a.select(_year_path().alias("__file"), *_base_cols(a)), root, "__file",
                        order=["__o"], drop=["__o"])
        # files written by earlier runs and a scraper-named weekly export
        d = F.to_date(F.substring(F.col("src"), 10, 7), "yyyy-MM")
        outputs = (a.where(F.year(d) == 1995)
                   .select(F.concat(F.lit("outputs/alertes_"), F.date_format(d, "yyyy_MM"), F.lit(".csv")).alias("__file"),
                           *_base_cols(a)))
        write_named_csv(outputs, root, "__file", order=["__o"], drop=["__o"])
        audit = a.where(F.col("date_raw") == "inconnue").select(F.lit("outputs/ALERTES_SANS_DATE.CSV").alias("__file"),
                                                               *_base_cols(a))
        write_named_csv(audit, root, "__file", order=["__o"], drop=["__o"])
        wk = a.where(F.col("src") == "Alertes_-1995-01.csv").where(
            F.to_date(F.coalesce(F.try_to_timestamp(F.col("date_raw"), F.lit("dd/MM/yyyy HH:mm:ss")),
                                 F.lit("1900-01-01 00:00:00").cast("timestamp")))
            .between(F.lit("1995-01-02").cast("date"), F.lit("1995-01-08").cast("date")))
        write_named_csv(wk.select(F.lit("weekly/" + SCRAPER_DECOY).alias("__file"), *_base_cols(a)), root, "__file",
                        order=["__o"], drop=["__o"])
    elif variant == "faulty":
        a = alerts(spark, sf_dir)
        year = F.substring(F.col("src"), 10, 4).cast("int")
        for cond, encoding in ((year != 1997, "UTF-8"), (year == 1997, "ISO-8859-1")):
            write_named_csv(a.where(cond).select(_year_path().alias("__file"), *_base_cols(a)), root, "__file",
                            order=["__o"], drop=["__o"], bom=encoding == "UTF-8", encoding=encoding)
        touch(spark, root + "/" + EMPTY_FILE)
    elif variant == "comma":
        a = alerts(spark, sf_dir)
        write_named_csv(a.select(F.col("src").alias("__file"), *_base_cols(a)), root, "__file",
                        order=["__o"], drop=["__o"], sep=",", bom=False)
    elif variant == "shifted_comma":
        a = alerts(spark, sf_dir, src_shift_days=7)
        write_named_csv(a.select(F.col("src").alias("__file"), *_base_cols(a)), root, "__file",
                        order=["__o"], drop=["__o"], sep=",", bom=False)
    elif variant == "undated":
        a = alerts(spark, sf_dir).where(F.substring("src", 10, 4) == "1996")
        odd = F.substring("src", 15, 2).cast("int") % 2 == 1
        cols = [F.when(odd, F.lit(None)).otherwise(F.col("date_raw")).alias("Date") if c == "Date" else x
                for c, x in zip(("__o", *BASE_HEADER), _base_cols(a)) if c != "Timestamp"]
        write_named_csv(a.select(F.col("src").alias("__file"), *cols), root, "__file", order=["__o"], drop=["__o"],
                        sep=",", bom=False)
    elif variant in ("drift", "drift_latin1"):
        a = alerts(spark, sf_dir)
        year = F.substring(F.col("src"), 10, 4).cast("int")
        groups = {
            "old": (year <= 1996, [*_base_cols(a), F.lit("web").alias("Canal")]),
            "reordered": (year == 1997, [F.col("ord").alias("__o"), F.col("ref").alias("Référence"), F.col("ord").cast("string").alias("ord"),
                                         F.col("ts_raw").alias("Timestamp"), F.col("date_raw").alias("Date")]),
            "spaced": (year == 1998, [F.col("ord").alias("__o"), F.col("ord").cast("string").alias("ord"), F.col("ref").alias(" Référence "),
                                      F.col("date_raw").alias("Date"), F.col("ts_raw").alias("Epoch (timestamp)"),
                                      F.col("body").alias("Priorité")]),
            "current": (year >= 1999, _base_cols(a)),
        }
        for cond, cols in groups.values():
            write_named_csv(a.where(cond).select(_year_path().alias("__file"), *cols), root, "__file", order=["__o"], drop=["__o"],
                            bom=variant == "drift", encoding="UTF-8" if variant == "drift" else "ISO-8859-1")
    elif variant == "events":
        e = read_table(spark, sf_dir, "events")
        write_named_csv(e.select(
            F.concat(F.lit("events_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".csv")).alias("__file"),
            F.col("event_id").alias("__o"), F.col("event_id").cast("string").alias("event_id"),
            F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("Date"),
            F.col("user_id").cast("string").alias("user_id"), "event_type",
            F.col("value").cast("string").alias("value")), root, "__file", order=["__o"], drop=["__o"], bom=False)
    elif variant == "events_overlap":
        # every event in the export of its day and in the export of the next day
        e = read_table(spark, sf_dir, "events")
        cols = [F.col("event_id").cast("string").alias("event_id"),
                F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("Date"),
                F.col("user_id").cast("string").alias("user_id"), "event_type",
                F.col("value").cast("string").alias("value")]
        both = e.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("__shift"), "*").select(
            F.concat(F.lit("events_"), F.date_format(F.date_add(F.to_date("ts"), F.col("__shift")), "yyyy-MM-dd"),
                     F.lit(".csv")).alias("__file"), *cols)
        write_named_csv(both, root, "__file", order=[F.col("event_id").cast("long")], bom=False)
    else:
        raise ValueError(f"unknown staging variant {variant!r}")
