"""Writing CSV outputs.

Month outputs are one dataset partitioned by ``ym`` (and ``status`` for audits), so a
run is one pass over the data and replaces only the months it carries (dynamic
partition overwrite: stale months of earlier runs stay).  Ordered outputs are
laid out by a count of their months: ordinary months go whole to one task and one
file, a hot month is cut into contiguous ranges written by several tasks, and its part
files in part-number order keep the row order.  Other outputs are rebalanced (one pass), and AQE splits large months.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertfold.sources.csv import display_name

BOM = "\ufeff"
MONTH_ROWS = 2_000_000   # rows above which an output month is cut into several ordered files


def csv_writer(df: DataFrame, sep: str = ";", header: bool = True):
    """Writer options that keep values as they are: no trimming, empty text as empty
    cell, doubled quotes inside quoted cells."""
    return (df.write.option("sep", sep).option("header", header).option("escape", '"')
            .option("quoteAll", False).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).option("emptyValue", "")
            .option("encoding", "UTF-8"))


def with_bom_header(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Prefix the first written column name with a byte-order mark: the header line is
    the first thing written, so each file starts with EF BB BF (Excel-friendly UTF-8)."""
    first = next(c for c in df.columns if c not in skip)
    return df.withColumnRenamed(first, BOM + first)


def write_partitioned(df: DataFrame, out: str, partition_cols: Sequence[str], order: Sequence[str] = (),
                      sep: str = ";", bom: bool = True, mode: str = "overwrite",
                      drop: Sequence[str] = (), ordered_parts: bool = False, raw: bool = False,
                      month_rows: int = MONTH_ROWS) -> None:
    """Spread rows over tasks by the partition columns, sort each task's rows by
    (partition columns, ``order``), write CSV partitioned by those columns (dynamic
    overwrite).

    ordered_parts=False: a rebalance; AQE splits a large month at any point, so each part
    file is in order but the parts of a split month are not ordered among themselves.
    ordered_parts=True: the sizes of the output partitions are counted first (one short row
    each, over the columns that tell them).  Those of up to ``month_rows`` rows are written
    whole, one file each; larger ones are range-partitioned by (partition columns, order):
    cut into contiguous ranges, whose files in part-number order hold the rows in order."""
    parts = [F.col(c) for c in partition_cols]
    if order and ordered_parts:
        data = _whole_or_cut(df, partition_cols, order, month_rows)
    elif _aqe(df.sparkSession):
        data = df.hint("rebalance", *partition_cols)
    else:
        data = df.repartition(*parts)
    data = data.sortWithinPartitions(*parts, *[F.col(c) for c in order])
    if drop:
        data = data.drop(*drop)
    if bom:
        data = with_bom_header(data, skip=partition_cols)
    writer = csv_writer(data, sep)
    if raw:   # one column of whole lines, header line included: no separator, no quoting
        writer = writer.option("sep", "\x01").option("quote", "\u0000").option("escapeQuotes", False)
    with _display_names(data) as (named, write_as):
        if write_as:
            writer = csv_writer(named, sep)
        writer.mode(mode).partitionBy(*partition_cols).csv(out)


def _whole_or_cut(df: DataFrame, partition_cols: Sequence[str], order: Sequence[str], month_rows: int) -> DataFrame:
    parts = [F.col(c) for c in partition_cols]
    sizes = df.groupBy(*parts).count().where(F.col("count") > month_rows).collect()   # of the months, the large ones
    if not sizes:
        return df.repartition(*parts)
    large = F.lit(False)
    for r in sizes:
        one = F.lit(True)
        for c in partition_cols:
            one = one & F.col(c).eqNullSafe(F.lit(r[c]))
        large = large | one
    cut = df.where(large).repartitionByRange(*parts, *[F.col(c) for c in order])
    return df.where(~large).repartition(*parts).unionByName(cut)


@contextmanager
def _display_names(df: DataFrame):
    """The data under the names the headers show.  Where they differ only in case, this one
    write tells case apart."""
    shown = [display_name(c) for c in df.columns]
    if shown == df.columns:
        yield df, False
        return
    key = "spark.sql.caseSensitive"
    before = df.sparkSession.conf.get(key)
    df.sparkSession.conf.set(key, "true")
    try:
        yield df.toDF(*shown), True
    finally:
        df.sparkSession.conf.set(key, before)


def _aqe(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true") == "true"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def write_named_csv(df: DataFrame, root: str, name_col: str, order: Sequence[str] = (),
                    sep: str = ";", bom: bool = True, drop: Sequence[str] = (), encoding: str = "UTF-8") -> list[str]:
    """Write one CSV per distinct value of ``name_col`` (a relative file path), named
    exactly.  Spark names its part files itself, so each single-part directory is
    renamed afterwards on the driver (one metadata call per output file).

    One file has one writer, so all rows of a name go to one task: meant for files of
    export size (the staged inputs).  Month outputs use ``write_partitioned``, which
    splits a large month over tasks."""
    spark = df.sparkSession
    tmp = root.rstrip("/") + "/_tmp_named"
    data = df.repartition(F.col(name_col)).sortWithinPartitions(name_col, *order)
    if drop:
        data = data.drop(*drop)
    if bom:
        data = with_bom_header(data, skip=[name_col])
    csv_writer(data, sep).option("encoding", encoding).mode("overwrite").partitionBy(name_col).csv(tmp)
    fs, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    written = []
    parts = sorted(fs.globStatus(Path(f"{tmp}/{name_col}=*/part-*")), key=lambda s: s.getPath().toString())
    for st in parts:  # renamed in name order, so modification times follow names
        src = st.getPath()
        rel = unquote(src.getParent().getName().split("=", 1)[1])
        dst = Path(f"{root.rstrip('/')}/{rel}")
        fs.mkdirs(dst.getParent())
        if fs.exists(dst):
            fs.delete(dst, False)
        fs.rename(src, dst)
        written.append(dst.toString())
    fs.delete(Path(tmp), True)
    return sorted(written)


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm = _fs(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path))


def rename_dir(spark: SparkSession, src: str, dst: str) -> bool:
    """Atomic directory rename; False when ``dst`` already exists."""
    fs, jvm = _fs(spark, src)
    Path = jvm.org.apache.hadoop.fs.Path
    if fs.exists(Path(dst)):
        return False
    fs.mkdirs(Path(dst).getParent())
    return bool(fs.rename(Path(src), Path(dst)))


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, jvm = _fs(spark, path)
    fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)


def replace_folders(spark: SparkSession, src: str, dst: str) -> None:
    """Move each sub-folder of ``src`` to ``dst``, in place of one of its name (metadata only, one
    rename per folder)."""
    fs, jvm = _fs(spark, dst)
    Path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(Path(dst))
    for st in fs.listStatus(Path(src)):
        if st.isDirectory():
            to = Path(dst, st.getPath().getName())
            fs.delete(to, True)
            fs.rename(st.getPath(), to)


def touch(spark: SparkSession, path: str) -> None:
    fs, jvm = _fs(spark, path)
    fs.create(jvm.org.apache.hadoop.fs.Path(path), True).close()


def publish_month_files(spark: SparkSession, out: str, target: str, partition_col: str = "ym",
                        pattern: str = "alertes_{ym}.csv", part_pattern: str = "alertes_{ym}_p{n:03d}.csv") -> list[str]:
    """Optional exact names: move each month's part files to ``target/alertes_YYYY_MM.csv``.

    Metadata only (one rename per file, bounded by the number of output files; no
    byte goes through the driver).  A month written by several tasks (a hot month)
    keeps one file per part: the first gets the exact name, the others
    ``alertes_YYYY_MM_pNNN.csv``; every file has its own header.  Written with
    ``ordered_parts``, the files in name order hold the month's rows in order.  The
    partitioned dataset under ``out`` is consumed by the move.

    The new files arrive under temporary names; only then do the month's earlier files
    go, all its parts included, and the new ones get their names."""
    fs, jvm = _fs(spark, out)
    Path = jvm.org.apache.hadoop.fs.Path
    root, names = target.rstrip("/"), []
    fs.mkdirs(Path(target))
    for d in fs.globStatus(Path(f"{out.rstrip('/')}/{partition_col}=*")):
        ym = unquote(d.getPath().getName().split("=", 1)[1])
        parts = sorted(fs.globStatus(Path(d.getPath().toString() + "/part-*")), key=lambda st: st.getPath().getName())
        arrived = []
        for n, st in enumerate(parts):
            name = pattern.format(ym=ym) if n == 0 else part_pattern.format(ym=ym, n=n)
            fs.rename(st.getPath(), Path(f"{root}/_new_{name}"))
            arrived.append(name)
        old = re.compile(re.escape(part_pattern).replace(re.escape("{ym}"), re.escape(ym))
                         .replace(re.escape("{n:03d}"), "[0-9]{3,}"))
        for st in fs.listStatus(Path(target)):
            name = st.getPath().getName()
            if name == pattern.format(ym=ym) or old.fullmatch(name):
                fs.delete(st.getPath(), False)
        for name in arrived:
            fs.rename(Path(f"{root}/_new_{name}"), Path(f"{root}/{name}"))
        names += arrived
    return sorted(names)
