"""Registered queries over export folders staged from the tables (sources, sinks, pipelines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertfold.functions import dates as D
from alertfold.functions import names as N
from alertfold.operators import quality, rank
from alertfold.plans import pipelines as P
from alertfold.plans import sqlfrag as S
from alertfold.plans.alerts import alerts_sql, read_table
from alertfold.plans.registry import query
from alertfold.plans.staging import EMPTY_FILE, SCRAPER_DECOY, stage
from alertfold.session import prepare, scratch_dir
from alertfold.sources import csv as C

INCLUDE = C.CsvOptions(include=N.INCLUDE_SOURCES)
def base_as() -> list:
    """Staged export columns under the view's names."""
    return [F.col("ord").cast("long").alias("ord"), F.col("`Référence`").alias("ref"),
            F.col("Date").alias("date_raw"), F.col("Timestamp").alias("ts_raw"),
            F.col(C.SOURCE).alias("src"), F.col("`Priorité`").alias("body")]

_DECOY = f"""
weekly as (select * replace ('{SCRAPER_DECOY}' as src) from alerts
  where src = 'Alertes_-1995-01.csv'
    and cast(coalesce(try_strptime(date_raw, '%d/%m/%Y %H:%M:%S'), timestamp '1900-01-01') as date)
        between date '1995-01-02' and date '1995-01-08'),
srcs as (select *, 0 as w from alerts union all select *, 1 as w from weekly)"""


def _with(body: str, shift: int = 0) -> str:
    return f"with alerts as ({alerts_sql(1, shift)}),{_DECOY}\n{body}"


def base_read(spark, sf, opts: C.CsvOptions = C.CsvOptions()) -> DataFrame:
    prepare(spark)
    root = stage(spark, sf, "base")
    df, _ = C.read_aligned(spark, root, opts)
    return df


# ------------------------------------------------------------------ scans
@query("scan_delimited", "S1 S4 S5 S6 S8 S9 S11 S17", _with("select ord, ref, date_raw, ts_raw, src, body from srcs"))
def q_scan_delimited(spark, sf):
    return base_read(spark, sf).select(*base_as())


@query("scan_comma", "S2", "with alerts as (" + alerts_sql() + ") select ord, ref, date_raw, ts_raw, src, body from alerts")
def q_scan_comma(spark, sf):
    prepare(spark)
    root = stage(spark, sf, "comma")
    df, _ = C.read_aligned(spark, root, C.CsvOptions(sep=","))
    return df.select(*base_as())


@query("scan_raw_preserve", "S3", "with alerts as (" + alerts_sql() + """)
select cast(ord as varchar) as ord, coalesce(ref, '') as ref, coalesce(date_raw, '') as date_raw,
       coalesce(ts_raw, '') as ts_raw, src, coalesce(body, '') as body from alerts""")
def q_scan_raw_preserve(spark, sf):
    df = base_read(spark, sf, C.CsvOptions(include=N.INCLUDE_SOURCES, na_tokens=False))
    return df.select(F.col("ord"), F.col("`Référence`").alias("ref"), F.col("Date").alias("date_raw"),
                     F.col("Timestamp").alias("ts_raw"), F.col(C.SOURCE).alias("src"), F.col("`Priorité`").alias("body"))


@query("na_tokens", "S4", "with alerts as (" + alerts_sql() + ") select ord, ref, date_raw, ts_raw, src, body from alerts")
def q_na_tokens(spark, sf):
    raw = base_read(spark, sf, C.CsvOptions(include=N.INCLUDE_SOURCES, na_tokens=False))
    cols = [C.na_to_null(F.col(f"`{c}`")).alias(c) for c in ("Référence", "Date", "Timestamp", "Priorité")]
    return raw.select("ord", C.SOURCE, *cols).select(*base_as())


@query("scan_latin1", "S12 S13", "with alerts as (" + alerts_sql() + ") select ord, ref, date_raw, ts_raw, src, body from alerts")
def q_scan_latin1(spark, sf):
    opts = C.CsvOptions(include=N.INCLUDE_SOURCES, encoding="ISO-8859-1", header_fix="mojibake", repair_values=True)
    return base_read(spark, sf, opts).select(*base_as())


@query("failed_files", "S16", "with alerts as (" + alerts_sql() + f""")
select src as file_name, case when substr(src, 10, 4) = '1997' then '{C.UNDECODABLE}' end as error,
       case when substr(src, 10, 4) = '1997' then 0 else count(*) end as n_rows from alerts group by src
union all select '{EMPTY_FILE}', '{C.EMPTY}', 0""")
def q_failed_files(spark, sf):
    """The failure ledger of a folder with undecodable files and an empty one, beside the rows
    read from the others."""
    prepare(spark)
    root = stage(spark, sf, "faulty")
    files = C.discover(spark, root, INCLUDE)
    ledger = C.failed_files(spark, files, INCLUDE).select(
        C.unescape(F.element_at(F.split("path", "/"), -1)).alias("file_name"), "error", F.lit(0).cast("long").alias("n_rows"))
    df, _ = C.read_aligned(spark, root, INCLUDE, failed="skip")
    read = df.groupBy(F.col(C.SOURCE).alias("file_name")).agg(F.lit(None).cast("string").alias("error"),
                                                             F.count(F.lit(1)).alias("n_rows"))
    return ledger.unionByName(read)


@query("source_column", "S15", "with alerts as (" + alerts_sql() + ") select ord, src from alerts")
def q_source_column(spark, sf):
    return base_read(spark, sf, INCLUDE).select(F.col("ord").cast("long").alias("ord"), F.col(C.SOURCE).alias("src"))


@query("discover_files", "S5 S6", _with("select distinct src as file_name from srcs"))
def q_discover_files(spark, sf):
    prepare(spark)
    paths = C.discover(spark, stage(spark, sf, "base"))
    return C._paths_frame(spark, paths).select(C.unescape(F.element_at(F.split("path", "/"), -1)).alias("file_name"))


@query("exclude_outputs", "S6", _with("select src as file_name, count(*) as n_rows from srcs group by src"))
def q_exclude_outputs(spark, sf):
    prepare(spark)
    root = stage(spark, sf, "base")
    opts = C.CsvOptions(exclude=())
    files = C.discover(spark, root, opts)
    df = C.read_positional(spark, files, C.reference_header(spark, files, opts), opts)
    excl = "|".join(f"({p})" for p in N.EXCLUDE_OUTPUTS)
    # the predicate on the file-name metadata prunes whole files before they are opened
    kept = df.where(~C.file_name().rlike(f"(?i){excl}"))
    return kept.groupBy(F.col(C.SOURCE).alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("include_sources", "S7", "with alerts as (" + alerts_sql() + ") select src as file_name, count(*) as n_rows from alerts group by src")
def q_include_sources(spark, sf):
    df = base_read(spark, sf, INCLUDE)
    return df.groupBy(F.col(C.SOURCE).alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("union_all", "U1", "with alerts as (" + alerts_sql() + ") select ord, src from alerts")
def q_union_all(spark, sf):
    prepare(spark)
    root = stage(spark, sf, "base")
    files = C.discover(spark, root, INCLUDE)
    header = C.reference_header(spark, files, INCLUDE)
    half = len(files) // 2
    a = C.read_positional(spark, files[:half], header, INCLUDE)
    b = C.read_positional(spark, files[half:], header, INCLUDE)
    return a.unionByName(b).select(F.col("ord").cast("long").alias("ord"), F.col(C.SOURCE).alias("src"))


@query("new_files", "U3", _with("""
select distinct 'outputs/alertes_' || substr(src, 10, 4) || '_' || substr(src, 15, 2) || '.csv' as rel_path
from alerts where substr(src, 10, 4) = '1995'
union all select 'outputs/ALERTES_SANS_DATE.CSV' where exists (select 1 from alerts where date_raw = 'inconnue')
union all select 'weekly/' || src from (select distinct src from weekly)"""))
def q_new_files(spark, sf):
    """Files present in the later snapshot of the export folder and not in the earlier one
    (same sources in both; the later one also holds outputs and a weekly export)."""
    prepare(spark)
    before, after = stage(spark, sf, "drift"), stage(spark, sf, "base")
    rel = F.concat_ws("/", F.element_at(F.split("path", "/"), -2), F.element_at(F.split("path", "/"), -1))
    opts = C.CsvOptions(exclude=())
    b = C.listing(spark, before, opts).select(rel.alias("rel_path"))
    a = C.listing(spark, after, opts).select(rel.alias("rel_path"))
    return a.join(b, "rel_path", "left_anti")


# ------------------------------------------------------------------ header drift
_DRIFT = """with alerts as (""" + alerts_sql() + """),
g as (select *, cast(substr(src, 10, 4) as integer) as y from alerts)"""


@query("reference_header", "S8 S11 O4", """
select * from (values (1, 'ord'), (2, 'Référence'), (3, 'Date'), (4, 'Timestamp'), (5, 'Priorité')) t(pos, name)
where exists (select 1 from orders)""")
def q_reference_header(spark, sf):
    prepare(spark)
    root = stage(spark, sf, "drift")
    files = C.discover(spark, root)
    names = C.reference_header(spark, files)
    lines = C.header_lines(spark, [max(files)], C.CsvOptions())
    # the names come from the header line; explode them back as rows
    return (lines.select(F.posexplode(F.array(*[F.lit(n) for n in names])).alias("p", "name"))
            .select((F.col("p") + 1).cast("int").alias("pos"), "name"))


@query("align_positional", "S9", _DRIFT + """
select case when y = 1997 then ref else cast(ord as varchar) end as ord,
       case when y = 1997 then cast(ord as varchar) else ref end as ref,
       case when y = 1997 then ts_raw else date_raw end as date_raw,
       case when y = 1997 then date_raw else ts_raw end as ts_raw,
       case when y = 1997 then null else body end as body, src from g""")
def q_align_positional(spark, sf):
    prepare(spark)
    df, header = C.read_aligned(spark, stage(spark, sf, "drift"))
    return df.select(F.col("ord"), F.col("`Référence`").alias("ref"), F.col("Date").alias("date_raw"),
                     F.col("Timestamp").alias("ts_raw"), F.col("`Priorité`").alias("body"), F.col(C.SOURCE).alias("src"))


@query("align_by_name", "S10 S11", _DRIFT + """
select cast(ord as varchar) as ord, ref, date_raw, case when y = 1998 then null else ts_raw end as ts_raw,
       case when y = 1997 then null else body end as body, case when y <= 1996 then 'web' end as canal,
       case when y = 1998 then ts_raw end as epoch_ts, src from g""")
def q_align_by_name(spark, sf):
    prepare(spark)
    files = C.discover(spark, stage(spark, sf, "drift"))
    df = C.read_by_name(spark, files)
    return df.select(F.col("ord"), F.col("`Référence`").alias("ref"), F.col("Date").alias("date_raw"),
                     F.col("Timestamp").alias("ts_raw"), F.col("`Priorité`").alias("body"),
                     F.col("Canal").alias("canal"), F.col("`Epoch (timestamp)`").alias("epoch_ts"),
                     F.col(C.SOURCE).alias("src"))


@query("bad_rows_by_file", "S16", _DRIFT + """
select src as file_name, count(*) as n_rows, count(*) filter (where y <= 1996) as long_rows,
       count(*) filter (where y = 1997) as short_rows from g group by src""")
def q_bad_rows_by_file(spark, sf):
    prepare(spark)
    df, header = C.read_aligned(spark, stage(spark, sf, "drift"))
    n = len(header)
    return df.groupBy(F.col(C.SOURCE).alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_cells") > n).alias("long_rows"),
        F.count_if(F.col("_cells") < n).alias("short_rows"))


@query("detect_ts_column", "F11", _DRIFT + """
select distinct src as file_name, case when y = 1998 then 'Epoch (timestamp)' else 'Timestamp' end as ts_column from g""")
def q_detect_ts_column(spark, sf):
    prepare(spark)
    files = C.discover(spark, stage(spark, sf, "drift"))
    lines = C.header_lines(spark, files, C.CsvOptions())
    names = F.transform(F.split(F.regexp_replace("line", "^\ufeff", ""), ";"), lambda x: F.trim(x))
    return lines.select(C.unescape(F.element_at(F.split("path", "/"), -1)).alias("file_name"),
                        P.ts_column(names).alias("ts_column"))


# ------------------------------------------------------------------ generic merger
_FIRSTDATE = """
f as (select src, arg_min(date_raw, ord) filter (where date_raw is not null) as s from alerts group by src),
det as (select src, case when {lenient} is not null then 'Date' end as date_column from f)"""


@query("detect_date_column", "F12 O4", "with alerts as (" + alerts_sql() + ")," +
       _FIRSTDATE.format(lenient=S.lenient(S.norm("s"))) + "\nselect src as file_name, date_column from det")
def q_detect_date_column(spark, sf):
    df = base_read(spark, sf, INCLUDE)
    return P.detect_date_columns(df, ["ord", "Référence", "Date", "Timestamp", "Priorité"])


@query("skip_undated_files", "P11 A9", "with alerts as (" + alerts_sql() + ")," +
       _FIRSTDATE.format(lenient=S.lenient(S.norm("s"))) + """
select src as file_name, date_column is null as skipped from det""")
def q_skip_undated_files(spark, sf):
    df = base_read(spark, sf, INCLUDE)
    det = P.detect_date_columns(df, ["ord", "Référence", "Date", "Timestamp", "Priorité"])
    return det.select("file_name", F.col("date_column").isNull().alias("skipped"))


def _merge_sql() -> str:
    len_ = S.lenient(S.norm("date_raw"))
    return f"""
with a0 as ({alerts_sql(1, 0)}), a7 as ({alerts_sql(1, 7)}),
u as (select 0 as r, * from a0 union all select 1 as r, * from a7),
f as (select r, src, arg_min(date_raw, ord) filter (where date_raw is not null) as s from u group by r, src),
det as (select r, src from f where {S.lenient(S.norm('s'))} is not null),
rows_ as (select u.*, {len_} as dt from u join det using (r, src)),
k as (select *, row_number() over (partition by ord, coalesce(ref, 'nan'), {S.ts_text('dt')}, coalesce(ts_raw, 'nan'), coalesce(body, 'nan')
                                   order by r, src, ord) as rn from rows_ where dt is not null)
select strftime(dt, '%Y-%m') as ym, ord, {S.ts_text('dt')} as dt, ref, ts_raw, body from k where rn = 1"""


@query("merge_by_month", "D4 P4 P5 P11 F12 W7", _merge_sql())
def q_merge_by_month(spark, sf):
    prepare(spark)
    roots = [stage(spark, sf, "comma"), stage(spark, sf, "shifted_comma")]
    kept, _ = P.merge(spark, roots)
    # date column first, rendered as ISO text
    return kept.select("ym", F.col("ord").cast("long").alias("ord"), F.date_format("dt", "yyyy-MM-dd HH:mm:ss").alias("dt"),
                       F.col("`Référence`").alias("ref"), F.col("Timestamp").alias("ts_raw"), F.col("`Priorité`").alias("body"))


# ------------------------------------------------------------------ row router
_ROUTE_OK = f"try_strptime({S.py_strip('date_raw')}, '{S.D_DMY_HM}')"


@query("file_stats", "A4 P10", "with alerts as (" + alerts_sql() + f""")
select src as file_name, count(*) as total, count(*) filter (where {_ROUTE_OK} is not null) as ok,
       count(*) filter (where {_ROUTE_OK} is null) as errors from alerts group by src""")
def q_file_stats(spark, sf):
    prepare(spark)
    files = C.discover(spark, stage(spark, sf, "base"), INCLUDE)
    routed = P.route(spark, files, date_index=2)
    return quality.file_stats(routed, C.SOURCE, F.col("ok"))


@query("router_months", "W2 P10", "with alerts as (" + alerts_sql() + f""")
select strftime({_ROUTE_OK}, '%Y_%m') as ym, count(*) as n_rows from alerts where {_ROUTE_OK} is not null group by 1""")
def q_router_months(spark, sf):
    prepare(spark)
    files = C.discover(spark, stage(spark, sf, "base"), INCLUDE)
    routed = P.route(spark, files, date_index=2)
    return routed.where("ok").groupBy("ym").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ sinks
_FILE_DEDUP = """,
d1 as (select * exclude (rn, w) from (select *, row_number() over (partition by ref order by w, src, ord) as rn from srcs) where rn = 1)"""


@query("sink_monthly_roundtrip", "W1 W3 W4 W5 W6 P6 S1 D1", _with(_FILE_DEDUP + S.resolved_cte() + f"""
select case when dt is null then 'undated' else 'ok' end as status, {S.month('dt')} as ym,
       ord, ref, date_raw, ts_raw, body from r"""))
def q_sink_monthly_roundtrip(spark, sf):
    prepare(spark)
    df, header = P.recompose(spark, stage(spark, sf, "base"))
    out = scratch_dir(spark, "monthly")
    P.write_recomposed(df, header, out)
    back = P.read_written(spark, out, header)
    return back.select("status", "ym", F.col("ord").cast("long").alias("ord"), F.col("`Référence`").alias("ref"),
                       F.col("Date").alias("date_raw"), F.col("Timestamp").alias("ts_raw"),
                       F.col("`Priorité`").alias("body"))


# ------------------------------------------------------------------ file-name rules over names derived from orders
_WS = "(cast(o_orderdate as date) - cast(isodow(o_orderdate) + 6 as integer))"
_NAMES_SQL = f"""
names as (select o_orderkey, case o_orderkey % 8
  when 0 then strftime({_WS}, '%Y-%m-%d') || '_au_' || strftime({_WS} + 6, '%Y-%m-%d') || '.csv'
  when 1 then 'Alertes_' || strftime(o_orderdate, '%Y') || '.csv'
  when 2 then 'Alertes-' || strftime(o_orderdate, '%Y-%m') || 'à' || strftime(o_orderdate, '%d') || '.csv'
  when 3 then 'Alertes_' || strftime(o_orderdate, '%Y-%m') || ' à ' || strftime(o_orderdate, '%d') || '.csv'
  when 4 then 'Alertes_' || strftime(o_orderdate, '%Y-%m') || '_' || strftime({_WS}, '%d') || 'au' || strftime({_WS} + 6, '%d') || '.csv'
  when 5 then 'Alertes_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv'
  when 6 then strftime({_WS}, '%d-%m-%Y') || '_au_' || strftime({_WS} + 6, '%d-%m-%Y') || '.csv'
  else 'export_' || cast(o_orderkey as varchar) || '.txt.csv' end as name from orders)"""


def export_names(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    o = read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    ws, we = D.previous_week_start(d), D.previous_week_end(d)
    k = F.col("o_orderkey") % 8
    fmt = F.date_format
    name = (F.when(k == 0, F.concat(fmt(ws, "yyyy-MM-dd"), F.lit("_au_"), fmt(we, "yyyy-MM-dd"), F.lit(".csv")))
            .when(k == 1, F.concat(F.lit("Alertes_"), fmt(d, "yyyy"), F.lit(".csv")))
            .when(k == 2, F.concat(F.lit("Alertes-"), fmt(d, "yyyy-MM"), F.lit("à"), fmt(d, "dd"), F.lit(".csv")))
            .when(k == 3, F.concat(F.lit("Alertes_"), fmt(d, "yyyy-MM"), F.lit(" à "), fmt(d, "dd"), F.lit(".csv")))
            .when(k == 4, F.concat(F.lit("Alertes_"), fmt(d, "yyyy-MM"), F.lit("_"), fmt(ws, "dd"), F.lit("au"),
                                   fmt(we, "dd"), F.lit(".csv")))
            .when(k == 5, F.concat(F.lit("Alertes_"), fmt(d, "yyyy-MM-dd"), F.lit(".csv")))
            .when(k == 6, F.concat(fmt(ws, "dd-MM-yyyy"), F.lit("_au_"), fmt(we, "dd-MM-yyyy"), F.lit(".csv")))
            .otherwise(F.concat(F.lit("export_"), F.col("o_orderkey").cast("string"), F.lit(".txt.csv"))))
    return o.select("o_orderkey", name.alias("name"))


@query("rewrite_names_en", "F20", f"with {_NAMES_SQL}\nselect o_orderkey, name, {N.rewrite_name_sql('name', 'en')} as new_name from names")
def q_rewrite_names_en(spark, sf):
    n = export_names(spark, sf)
    return n.select("o_orderkey", "name", N.rewrite_name(F.col("name"), "en").alias("new_name"))


@query("rewrite_names_fr", "F21", f"with {_NAMES_SQL}\nselect o_orderkey, name, {N.rewrite_name_sql('name', 'fr')} as new_name from names")
def q_rewrite_names_fr(spark, sf):
    n = export_names(spark, sf)
    return n.select("o_orderkey", "name", N.rewrite_name(F.col("name"), "fr").alias("new_name"))


@query("rename_collisions", "F22", f"""with {_NAMES_SQL},
t as (select o_orderkey, name, {N.rewrite_name_sql('name', 'en')} as target from names),
r as (select *, row_number() over (partition by target order by o_orderkey) as pos from t)
select o_orderkey, name, target,
  case when target is null then 'unrecognised'
       when pos > 1 or target in (select name from names) then 'skipped' else 'renamed' end as status from r""")
def q_rename_collisions(spark, sf):
    n = export_names(spark, sf)
    # bound by a lambda: the rules stay out of the generated code, which holds them twice else
    target = F.get(F.transform(F.array("name"), lambda x: N.rewrite_name(x, "en")), 0)
    t = n.select("o_orderkey", "name", target.alias("target"))
    # names no rule knows take no part in the positions, however many they are
    ranked = rank.rank_within(t.where(F.col("target").isNotNull()), ["target"], ["o_orderkey"], out="pos")
    existing = n.select(F.col("name").alias("__existing")).distinct()
    j = ranked.join(existing, ranked["target"] == existing["__existing"], "left")
    status = (F.when((F.col("pos") > 1) | F.col("__existing").isNotNull(), F.lit("skipped"))
              .otherwise(F.lit("renamed")))
    unknown = t.where(F.col("target").isNull()).select("o_orderkey", "name", "target", F.lit("unrecognised").alias("status"))
    return j.select("o_orderkey", "name", "target", status.alias("status")).unionByName(unknown)
