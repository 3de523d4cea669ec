"""The consolidation pipelines, end to end.

recompose  (current pipeline)  discover -> reference header -> positional read ->
           key dedup (first wins, whole input) -> [full-row dedup when no key] ->
           date cascade + epoch fallback (median unit) -> one pass writing
           ``status=ok/ym=YYYY_MM`` and ``status=undated`` partitions.
capped     (audit variant)     read by name -> strict date + per-file epoch unit ->
           status ok / undated / over_cap -> months sorted by date + audit sets.
merge      (generic merger)    per-file date-column detection -> lenient parse ->
           undated rows and undetected files dropped -> content dedup across files
           (first file wins) -> months.
route      (row router)        raw lines -> cell-count and date checks -> per-file
           counters -> months.

Each returns DataFrames; headers are read and, for ``capped`` and ``merge``, per-file
statistics are computed before.  ``write_*`` helpers write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from alertfold.functions import dates as D
from alertfold.functions.names import AUDIT_FILTERED, AUDIT_INVALID, AUDIT_INVALID_FULL
from alertfold.functions.text import normalize_ws, strip_accents_name, strip_ws
from alertfold.operators import dedup, quality
from alertfold.operators.order import ORDER_COL
from alertfold.operators.resolve import resolve_date
from alertfold.operators.small import per_file_broadcast
from alertfold.session import prepare, scratch_dir
from alertfold.sinks.files import publish_month_files, replace_folders, write_partitioned
from alertfold.sources import csv as C

KEY = "Référence"
DATE = "Date"
STATUSES = (quality.OK, quality.UNDATED, quality.OVER_CAP)


TS_NAME, TS_SUFFIX = "timestamp", "(timestamp)"   # fixed values: names of the epoch column


def ts_column(names: Column) -> Column:
    """Of an array of column names the epoch column's: a name that is ``TS_NAME`` (trimmed,
    any case) ranks before one that ends in ``TS_SUFFIX``, then the leftmost."""
    def candidate(name: Column, at: Column) -> Column:
        plain = F.lower(strip_ws(name))
        rank = F.when(plain == TS_NAME, 0).when(plain.endswith(TS_SUFFIX), 1)
        return F.when(rank.isNotNull(), F.struct(rank.alias("rank"), at.alias("at"), name.alias("name")))
    return F.array_min(F.transform(names, candidate))["name"]


def detect_ts_name(columns: Sequence[str]) -> str | None:
    """``ts_column`` for the names of one header."""
    ranked = ((0 if n == TS_NAME else 1, at) for at, n in enumerate(c.strip().lower() for c in columns)
              if n == TS_NAME or n.endswith(TS_SUFFIX))
    best = min(ranked, default=None)
    return None if best is None else columns[best[1]]


@dataclass(frozen=True)
class RecomposeOptions:
    csv: C.CsvOptions = C.CsvOptions()
    key: str = KEY
    date: str = DATE
    null_key: str = "collapse"        # missing keys collapse into one survivor
    dedup_scope: str = "global"       # 'global' (before dates) | 'month' (after, per month)
    cascade: str = "dmy"
    unit: str = "median"
    bad_files: str = "keep"
    failed: str = "raise"             # 'skip': files of the failure ledger are left out
    epoch_tz: str | None = None       # zone of the date texts, for the epochs too
    prefer_dated: bool = False        # of rows with one key the first dated one stays, not the first


def recompose(spark: SparkSession, source: str | Sequence[str],
              opts: RecomposeOptions = RecomposeOptions()) -> tuple[DataFrame, list[str]]:
    """Resolved rows (header columns + ``dt``, ``ym``, ``status``, ``_src``, ``_ord``)."""
    prepare(spark)
    df, header = C.read_aligned(spark, source, opts.csv, bad_files=opts.bad_files, failed=opts.failed)
    has_key = opts.key in header
    # a whole-table statistic (median unit) follows: the aggregate form shares its exchange
    method = "agg" if opts.unit == "median" else "window"
    # dates come first where they decide which row stays; the median is then that of all rows
    prefer = opts.prefer_dated and opts.dedup_scope == "global" and has_key
    if opts.dedup_scope == "global" and not prefer:
        if has_key:
            df = dedup.dedup_first(df, [opts.key], ORDER_COL, opts.null_key, method)
        else:
            df = dedup.dedup_first(df, header, ORDER_COL, "collapse", method)   # whole-row dedup, first wins
    ts = detect_ts_name(header)
    df = resolve_date(df, opts.date if opts.date in header else None, ts,
                      cascade=opts.cascade, unit=opts.unit, file_col=C.PATH, order_col=ORDER_COL, epoch_tz=opts.epoch_tz)
    if prefer:
        df = df.withColumn("__first", F.struct(F.col("dt").isNull().alias("undated"), F.col(ORDER_COL)))
        df = dedup.dedup_first(df, [opts.key], "__first", opts.null_key).drop("__first")
    df = df.withColumn("ym", D.month_key(F.col("dt")))
    if opts.dedup_scope == "month" and has_key:
        # undated rows all stay: each is a group of its own, so that one pass does for both
        own = F.when(F.col("dt").isNull(), F.concat_ws("|", f"{ORDER_COL}.path", f"{ORDER_COL}.block", f"{ORDER_COL}.pos"))
        df = df.withColumn("__ym", F.coalesce("ym", F.lit(""))).withColumn("__own", F.coalesce(own, F.lit("")))
        df = dedup.dedup_first(df, ["__ym", opts.key, "__own"], ORDER_COL, opts.null_key).drop("__ym", "__own")
    df = quality.classify(df, "dt")
    return df, header


def write_recomposed(df: DataFrame, header: Sequence[str], out: str, bom: bool = True) -> None:
    """One write: months under ``status=ok/ym=...``, undated rows under ``status=undated``;
    rows keep input order inside each file."""
    cols = [F.col(f"`{c}`") for c in header]
    data = df.select(*cols, "status", "ym", F.col(ORDER_COL))
    # rows come out of the dedup shuffle: ordered parts cost no extra pass
    write_partitioned(data, out, ["status", "ym"], order=[ORDER_COL], bom=bom, drop=[ORDER_COL],
                      ordered_parts=True)


def read_written(spark: SparkSession, out: str, header: Sequence[str], sep: str = ";") -> DataFrame:
    """Read a written month dataset back (partition columns as text)."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header]
                          + [T.StructField("status", T.StringType()), T.StructField("ym", T.StringType())])
    return (spark.read.schema(schema).option("sep", sep).option("header", True).option("escape", '"')
            .csv(out))


# ---------------------------------------------------------------- capped variant
def capped(spark: SparkSession, source: str | Sequence[str], cap: str,
           csv: C.CsvOptions = C.CsvOptions()) -> DataFrame:
    """Strict ``dd/mm/yyyy HH:MM:SS`` dates, per-file epoch unit by text length, status
    ok / undated / over_cap against ``cap``."""
    prepare(spark)
    files = C.discover(spark, source, csv)
    df = C.read_by_name(spark, files, csv, roots=[source] if isinstance(source, str) else list(source))
    ts = "Timestamp" if "Timestamp" in df.columns else None
    date = DATE if DATE in df.columns else None
    df = resolve_date(df, date, ts, cascade="strict", unit="length", file_col=C.PATH, order_col=ORDER_COL)
    return quality.classify(df, "dt", cap)


# ---------------------------------------------------------------- generic merger
def detect_date_columns(df: DataFrame, columns: Sequence[str], file_col: str = C.SOURCE,
                        order_col: str = ORDER_COL, absent_ok: bool = False) -> DataFrame:
    """Per file, the leftmost column whose first non-missing value parses as a date
    (day-first lenient list); NULL when none does.  One aggregate over the rows."""
    if absent_ok:
        columns = [c for c in columns if c in df.columns]
    samples = df.groupBy(F.col(file_col).alias("file_name")).agg(*[
        F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(order_col))).alias(f"__s{i}")
        for i, c in enumerate(columns)])
    pick = None
    for i, c in reversed(list(enumerate(columns))):
        hit = D.parse_lenient(normalize_ws(F.col(f"__s{i}"))).isNotNull()
        pick = F.when(hit, F.lit(c)) if pick is None else F.when(hit, F.lit(c)).otherwise(pick)
    return samples.select("file_name", pick.alias("date_column"))


def detect_from_heads(spark: SparkSession, files: Sequence[str], csv: C.CsvOptions, columns: Sequence[str],
                      size: int = C.HEAD_BYTES) -> tuple[DataFrame | None, list[str]]:
    """``detect_date_columns`` for the files whose beginnings decide it, and the other files.  A
    beginning decides when a column's first value in it is a date and no column to its left is
    without a value there, or when it is the whole file.  Columns are taken in the order of
    ``columns``, the merged table's."""
    heads = C.first_values(spark, files, csv, size)
    at = [F.array_position("names", F.lit(c)).cast("int") for c in columns]
    cells = F.array(*[F.struct(F.lit(c).alias("name"), (i > 0).alias("has"),
                               F.when(i > 0, F.get("first", i - 1)).alias("value")) for c, i in zip(columns, at)])
    told = F.filter(cells, lambda x: x["has"])
    # the leftmost column that is a date, or whose value is not known yet
    is_date = F.transform(told, lambda x: F.struct(
        x["name"].alias("name"), x["value"].isNull().alias("open"), D.parse_lenient(normalize_ws(x["value"])).isNotNull().alias("hit")))
    stop = F.get(F.filter(is_date, lambda x: x["hit"] | (x["open"] & ~F.col("whole"))), 0)
    found = heads.select("path", (F.col("names").isNotNull() & F.coalesce(stop["hit"], F.col("whole"))).alias("decided"),
                         F.when(stop["hit"], stop["name"]).alias("date_column")).collect()   # one short row per file
    decided = [(r["path"], r["date_column"]) for r in found if r["decided"]]
    table = spark.createDataFrame(decided, "file_name string, date_column string") if decided else None
    return table, [r["path"] for r in found if not r["decided"]]


def merge(spark: SparkSession, sources: Sequence[str], csv: C.CsvOptions = C.CsvOptions(sep=",", exclude=()),
          compare: str = "name"):
    """Generic merger: returns (kept rows with ``dt`` and ``ym``, per-file detection table).

    Rows are equal when they are so column by column, by the columns' names (``compare='name'``),
    or cell by cell in the order of each file's own header, whatever the names
    (``'position'``)."""
    if compare not in ("name", "position"):
        raise ValueError(f"compare must be 'name' or 'position', not {compare!r}")
    prepare(spark)
    files = C.discover(spark, list(sources), csv)
    df = C.read_by_name(spark, files, csv, roots=list(sources))
    cols = [c for c in df.columns if not c.startswith("_")]
    detected, undecided = (None, files) if csv.multiline else detect_from_heads(spark, files, csv, cols)
    if undecided:   # only these are scanned for their first values
        rest = detect_date_columns(C.read_by_name(spark, undecided, csv), cols, file_col=C.PATH, absent_ok=True)
        detected = rest if detected is None else detected.unionByName(rest)
    # the text of the file's detected column, then one parse (a parse per candidate
    # column would multiply the generated code for no benefit)
    raw = None
    for c in cols:
        cond = F.col("date_column") == c
        raw = F.when(cond, F.col(f"`{c}`")) if raw is None else raw.when(cond, F.col(f"`{c}`"))
    rows = (df.join(per_file_broadcast(detected, len(files)),
                    df[C.PATH] == detected["file_name"], "inner")
            .withColumn("__text", normalize_ws(raw))   # named once: the parser uses it many times
            .withColumn("dt", D.parse_lenient(F.col("__text"))).where(F.col("dt").isNotNull()).drop("__text"))
    # the detected column holds the normalised date (ISO text) from here on, as the
    # reference overwrites it; the row content is then the columns themselves, so the
    # dedup exchange carries each row once instead of a row plus a copy of its text
    iso = F.date_format("dt", "yyyy-MM-dd HH:mm:ss")
    rows = rows.select(*[F.when(F.col("date_column") == c, iso).otherwise(F.col(f"`{c}`")).alias(c) for c in cols],
                       *[x for x in rows.columns if x not in cols])
    if compare == "position":
        own = [(p, C.split_header(line, csv)) for p, line in C.collect_header_lines(spark, files, csv)]
        own = per_file_broadcast(spark.createDataFrame(own, "__p string, __names array<string>"), len(files))
        by_name = F.create_map(*[x for c in cols for x in (F.lit(c), F.coalesce(F.col(f"`{c}`"), F.lit("nan")))])
        rows = rows.withColumn("__values", by_name).join(own, F.col(C.PATH) == F.col("__p"))
        rows = rows.withColumn("__cells", F.transform("__names", lambda n: F.get(F.map_values(F.map_filter(
            "__values", lambda k, v: F.lower(k) == F.lower(n))), 0)))
        kept = dedup.dedup_first(rows.withColumn("__h", F.xxhash64("__cells")), ["__h", "__cells"], ORDER_COL)
        kept = kept.drop("__h", "__cells", "__names", "__p", "__values", "file_name")
        return kept.withColumn("ym", F.format_string("%04d-%02d", F.year("dt"), F.month("dt"))), detected
    if csv.na_tokens:
        # 'nan' text is already NULL, and grouping treats NULLs as equal: exact as is
        key = [F.col(f"`{c}`") for c in cols]
    else:
        key = [F.coalesce(F.col(f"`{c}`"), F.lit("nan")) for c in cols]
    rows = rows.select("*", *[k.alias(f"__k{i}") for i, k in enumerate(key) if not csv.na_tokens],
                       F.xxhash64(*key).alias("__h"))   # fixed-width sort prefix, exact key kept
    knames = cols if csv.na_tokens else [f"__k{i}" for i in range(len(key))]
    kept = dedup.dedup_first(rows, ["__h", *knames], ORDER_COL)
    kept = kept.drop("__h", "file_name", *[f"__k{i}" for i in range(len(key))])
    return kept.withColumn("ym", F.format_string("%04d-%02d", F.year("dt"), F.month("dt"))), detected


# ---------------------------------------------------------------- row router
def route(spark: SparkSession, files: Sequence[str], date_index: int = 1, sep: str = ";",
          encoding: str = "UTF-8") -> DataFrame:
    """Raw data lines with ``ok`` (two cells or more, and a ``dd/mm/yyyy HH:MM`` date in cell
    ``date_index``) and ``ym``.  Cells are read as CSV: the separator is taken literally,
    quoted cells may hold it."""
    lines = C.read_raw_lines(spark, files, C.CsvOptions(sep=sep, encoding=encoding))
    parsed = _parsed(date_index + 1, sep)
    return _routed(lines, parsed[f"c{date_index}"], parsed, sep)


def route_aligned(spark: SparkSession, files: Sequence[str], date_index: int = 1, sep: str = ";",
                  encoding: str = "UTF-8") -> tuple[DataFrame, str]:
    """``route`` over files with different headers: every row's cells are put in the places of
    the common header (``sources.csv.cell_places``), one permutation per file.  The date is the
    column that has ``date_index`` in the common header.  Returns the rows, ``value`` being the
    aligned line, and the header line."""
    opts = C.CsvOptions(sep=sep, encoding=encoding)
    header, places = C.cell_places(spark, files, opts)
    lines = C.read_raw_lines(spark, files, opts)
    parsed = _parsed(len(header), sep)
    row = lines.join(places, F.col(C.PATH) == F.col("__p"), "left").withColumn("__row", parsed)
    cells = F.array(*[F.col(f"__row.c{i}") for i in range(len(header))])
    aligned = [F.when(F.get("__places", j) >= 0, F.get(F.col("__cells"), F.get("__places", j))).alias(f"a{j}")
               for j in range(len(header))]
    row = row.withColumn("__cells", cells)
    line = F.to_csv(F.struct(*aligned), {"sep": sep, "quote": '"', "escape": '"', "emptyValue": ""})
    routed = _routed(row, F.get("__cells", F.get("__places", date_index)), F.col("__row"), sep)
    # the text of a row that is not routed stays as it was read
    routed = routed.withColumn("value", F.when(F.col("ok"), line).otherwise(F.col("value")))
    shown = spark.range(1).select(F.to_csv(F.struct(*[F.lit(C.display_name(n)).alias(f"a{j}") for j, n in enumerate(header)]),
                                           {"sep": sep, "quote": '"', "escape": '"'})).first()[0]
    return routed.drop("__p", "__places", "__row", "__cells"), shown


def _parsed(cells: int, sep: str) -> Column:
    """A line's cells c0, c1, ... (two at least)."""
    schema = ", ".join(f"c{i} string" for i in range(max(2, cells)))
    return F.from_csv(F.col("value"), schema, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})


def _routed(lines: DataFrame, date: Column, parsed: Column, sep: str) -> DataFrame:
    dt = D.parse_minutes(date)
    # an empty second cell reads as a missing one: then the separators are counted
    two_cells = parsed["c1"].isNotNull() | (C.cell_count(F.col("value"), sep) >= 2)
    ok = F.coalesce(two_cells & dt.isNotNull(), F.lit(False))
    return lines.withColumn("ok", ok).withColumn("ym", F.when(F.col("ok"), D.month_key(dt)))


def write_routed(routed: DataFrame, header: str, out: str) -> None:
    """The accepted lines per month, as they were read, under the original header line."""
    data = routed.where("ok").select(F.col("value").alias(header), "ym", ORDER_COL)
    write_partitioned(data, out, ["ym"], order=[ORDER_COL], bom=False, drop=[ORDER_COL], raw=True)


# ---------------------------------------------------------------- writers of the other variants
def _capped_once(df: DataFrame, keep: Sequence[str], bom: bool) -> tuple[str, dict[str, int], DataFrame | None]:
    """The one write of the capped variant: whole lines under ``status=.../ym=...`` of a scratch
    folder.  Returns the folder, the rows by status counted on the way, and the rejected rows
    read back: the cells of ``keep``, the date as ISO text, the source file, ``status``, ``ym``."""
    spark, sep = df.sparkSession, ";"
    iso = F.date_format("dt", "yyyy-MM-dd HH:mm:ss")
    ok = F.col("status") == quality.OK

    def line(*cells: Column) -> Column:
        return F.to_csv(F.struct(*[c.alias(f"a{i}") for i, c in enumerate(cells)]),
                        {"sep": sep, "quote": '"', "escape": '"', "emptyValue": ""})

    month_line = line(*[iso if c == DATE else F.col(f"`{c}`") for c in keep])
    audit_line = line(*[F.col(f"`{c}`") for c in keep], iso, F.col(C.SOURCE))
    shown = spark.range(1).select(line(*[F.lit(C.display_name(c)) for c in keep])).first()[0]
    counts = Observation()
    data = (df.select(F.when(ok, month_line).otherwise(audit_line).alias(shown), "status",
                      F.when(ok, D.month_key(F.col("dt"))).alias("ym"), "dt", ORDER_COL)
            .observe(counts, *[F.count_if(F.col("status") == x).alias(x) for x in STATUSES]))
    work = scratch_dir(spark, "capped")
    write_partitioned(data, work, ["status", "ym"], order=["dt", ORDER_COL], bom=bom, drop=["dt", ORDER_COL], raw=True)
    found = {x: int(counts.get[x]) for x in STATUSES}
    rejected = [f"{work}/status={x}" for x in STATUSES[1:] if found[x]]
    if not rejected:
        return work, found, None
    schema = ", ".join(f"a{i} string" for i in range(len(keep) + 2))
    rows = (spark.read.schema(schema).option("sep", sep).option("escape", '"').option("header", True)
            .option("basePath", work).csv(rejected).toDF(*[f"a{i}" for i in range(len(keep) + 2)], "status", "ym"))
    return work, found, rows


def _capped_columns(df: DataFrame, drop: Sequence[str], header_fix: str | None) -> tuple[list[str], str]:
    keep = [c for c in df.columns if not c.startswith("_") and c not in ("status", "dt", *drop)]
    return keep, strip_accents_name(KEY) if header_fix == "accents" else KEY


def write_capped(df: DataFrame, out: str, drop: Sequence[str] = ("dt",), bom: bool = False,
                 header_fix: str | None = None) -> None:
    """Months sorted by date (then input order) under ``status=ok/ym=...``, the date column
    as ISO text in its own place; audits of undated and over-cap rows (key, parsed date,
    source file) under ``_audit/status=...``.  The key is looked up under the name that the
    header repair gives it.  The input is read once (``_capped_once``); earlier months that
    this run does not carry stay."""
    keep, key = _capped_columns(df, drop, header_fix)
    work, found, rows = _capped_once(df, keep, bom)
    if found[quality.OK]:
        replace_folders(df.sparkSession, f"{work}/status={quality.OK}", f"{out.rstrip('/')}/status={quality.OK}")
    if rows is None:
        return
    undated = F.col("status") == quality.UNDATED
    cells = [F.col(f"a{keep.index(key)}").alias(key)] if key in keep else []
    audit = rows.select(*cells, F.col(f"a{len(keep)}").alias(DATE), F.col(f"a{len(keep) + 1}").alias("Source"),
                        F.when(undated, F.lit(quality.UNDATED)).otherwise(F.lit(quality.OVER_CAP)).alias("status"))
    write_partitioned(audit, out + "/_audit", ["status"], bom=bom)


def write_capped_named(df: DataFrame, target: str, bom: bool = False, header_fix: str | None = None) -> dict[str, int]:
    """The capped variant's files under their names in ``target``: months
    (``alertes_YYYY_MM.csv``, by date, then input order), ``lignes_invalides.csv`` (key, date and
    source of undated rows), ``lignes_filtrees.csv`` (of rows beyond the cap) and
    ``alertes_lignes_invalides.csv`` (undated rows with all columns).  Returns the rows by status.

    One write, partitioned by status and month, reads the input and counts it on the way; its
    rows are whole lines, so that rejected rows can hold more cells than months do.  The audits
    are then made from the rejected rows' own part of that output, which is all that is read
    again."""
    keep, key = _capped_columns(df, (), header_fix)
    work, found, rows = _capped_once(df, keep, bom)
    if found[quality.OK]:
        publish_month_files(df.sparkSession, f"{work}/status={quality.OK}", target)
    if rows is not None:
        undated, date, source = F.col("status") == quality.UNDATED, F.col(f"a{len(keep)}"), F.col(f"a{len(keep) + 1}")
        of = F.when(undated, F.lit(AUDIT_INVALID)).otherwise(F.lit(AUDIT_FILTERED))
        key_cell = [F.col(f"a{keep.index(key)}").alias(key)] if key in keep else []
        _publish_audit(rows.select(*key_cell, date.alias(DATE), source.alias("Source"), of.alias("name")), target, bom)
        full = [F.col(f"a{i}").alias(c) for i, c in enumerate(keep)]
        _publish_audit(rows.where(undated).select(*full, date.alias("Date_parsed"), source.alias("Source"),
                                                  F.lit(AUDIT_INVALID_FULL).alias("name")), target, bom)
    return found


def _publish_audit(rows: DataFrame, target: str, bom: bool) -> None:
    """Rows under the file names of their column ``name``; a large audit keeps ``_pNNN`` parts."""
    work = scratch_dir(rows.sparkSession, "audit")
    write_partitioned(rows, work, ["name"], bom=bom)
    publish_month_files(rows.sparkSession, work, target, partition_col="name", pattern="{ym}", part_pattern="{ym}_p{n:03d}.csv")


def write_merged(kept: DataFrame, out: str, detected: DataFrame | None = None) -> None:
    """Merger output: one dataset per ``ym`` (YYYY-MM).  The detected date column moves to the
    front as ISO text, under its own name; where files differ in that column the front one
    is ``date``, and a detected column keeps its place only for the files in which it is an
    ordinary one."""
    source = kept if detected is None else detected
    # at most one row per column name
    names = sorted(r[0] for r in source.select("date_column").distinct().collect() if r[0] is not None)
    cols = [c for c in kept.columns if not c.startswith("_") and c not in ("dt", "ym", "date_column")]
    first = names[0] if len(names) == 1 else "date"
    others = []
    for c in cols:
        if len(names) == 1 and c == first:
            continue
        value = F.when(F.col("date_column") != c, F.col(f"`{c}`")) if c in names else F.col(f"`{c}`")
        others.append(value.alias(f"{c}_1" if c.lower() == first.lower() else c))
    data = kept.select(F.date_format("dt", "yyyy-MM-dd HH:mm:ss").alias(first), *others, "ym", ORDER_COL)
    write_partitioned(data, out, ["ym"], order=[ORDER_COL], sep=",", bom=False, drop=[ORDER_COL],
                      ordered_parts=True)   # after the content-dedup shuffle
