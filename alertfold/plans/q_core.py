"""Registered queries over the derived alert view: dates, dedup, grouping, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertfold.functions import dates as D
from alertfold.functions import names as N
from alertfold.functions import text as T
from alertfold.operators import dedup, quality, rank
from alertfold.operators.resolve import resolve_date
from alertfold.plans import sqlfrag as S
from alertfold.plans.alerts import alerts, read_table
from alertfold.plans.registry import query
from alertfold.session import prepare

CAP = "2000-11-16 23:59:59"


def _ts(c: str):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def deduped(spark, sf, null_key="collapse", method="window") -> DataFrame:
    return dedup.dedup_first(alerts(spark, sf), ["ref"], "ord", null_key, method)


def recomposed(spark, sf) -> DataFrame:
    """Current pipeline up to the month split: key dedup, cascade, median-unit epoch.
    The aggregate dedup lets the median statistics reuse its exchange (one scan)."""
    return resolve_date(deduped(spark, sf, method="agg"), "date_raw", "ts_raw", cascade="dmy", unit="median")


# ------------------------------------------------------------------ flagship
@query("monthly_counts", "A1 A2 W6 D1 F4 F8 F10 F13", S.with_alerts(f"""
select {S.month('dt')} as ym, count(*) as n_rows from r group by 1""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_monthly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.monthly_counts(recomposed(spark, sf))


@query("periods", "A3 O3", S.with_alerts(f"""
select distinct {S.month('dt')} as ym from r where dt is not null""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_periods(spark, sf):
    return quality.periods(recomposed(spark, sf))


@query("date_validity", "A7", S.with_alerts("""
select count(dt) as valid, count(*) - count(dt) as missing from r""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_date_validity(spark, sf):
    return quality.date_validity(recomposed(spark, sf))


@query("resolve_date", "F10 F4 F8", S.with_alerts(f"""
select ord, {S.ts_text('dt')} as dt from r""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_resolve_date(spark, sf):
    return recomposed(spark, sf).select("ord", _ts("dt").alias("dt"))


@query("audit_undated", "P6 W3", S.with_alerts("""
select ord, ref, date_raw, ts_raw, src, body from r where dt is null""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_audit_undated(spark, sf):
    return quality.undated(recomposed(spark, sf)).drop("dt")


@query("keep_dated", "P5", S.with_alerts(f"""
select ord, {S.ts_text('dt')} as dt from r where dt is not null""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_keep_dated(spark, sf):
    return quality.keep_dated(recomposed(spark, sf)).select("ord", _ts("dt").alias("dt"))


# ------------------------------------------------------------------ scalar date functions
@query("parse_strict", "F2", S.with_alerts(f"""
select ord, {S.ts_text(S.strict('date_raw'))} as dt from alerts"""))
def q_parse_strict(spark, sf):
    return alerts(spark, sf).select("ord", F.date_format(D.parse_strict(F.col("date_raw")), "yyyy-MM-dd HH:mm:ss").alias("dt"))


@query("parse_minutes", "F3", S.with_alerts(f"""
select ord, {S.ts_text(f"try_strptime({S.py_strip('date_raw')}, '{S.D_DMY_HM}')")} as dt from alerts"""))
def q_parse_minutes(spark, sf):
    return alerts(spark, sf).select("ord", F.date_format(D.parse_minutes(F.col("date_raw")), "yyyy-MM-dd HH:mm:ss").alias("dt"))


@query("parse_cascade", "F4", S.with_alerts(f"""
select ord, {S.ts_text(S.cascade('date_raw'))} as dt from alerts"""))
def q_parse_cascade(spark, sf):
    return alerts(spark, sf).select("ord", F.date_format(D.parse_cascade(F.col("date_raw")), "yyyy-MM-dd HH:mm:ss").alias("dt"))


@query("parse_cascade_ymd", "F5", S.with_alerts(f"""
select ord, {S.ts_text(S.cascade_ymd('date_raw'))} as dt from alerts"""))
def q_parse_cascade_ymd(spark, sf):
    return alerts(spark, sf).select("ord", F.date_format(D.parse_cascade_ymd(F.col("date_raw")), "yyyy-MM-dd HH:mm:ss").alias("dt"))


@query("parse_lenient", "F6", S.with_alerts(f"""
select ord, {S.ts_text(S.lenient(S.norm('date_raw')))} as dt from alerts"""))
def q_parse_lenient(spark, sf):
    return alerts(spark, sf).select("ord", F.date_format(D.parse_lenient(T.normalize_ws(F.col("date_raw"))), "yyyy-MM-dd HH:mm:ss").alias("dt"))


# Layouts by key; the last is no date
_SHAPES = ("d/M/yyyy h:mm a", "MMM d, yyyy h:mm:ss a", "EEEE, d MMMM yyyy", "yyyyMMdd'T'HHmmss", "yyyyMMdd HHmm",
           "dd-MMM-yyyy", "d MMM yy", "dd/MM/yyyy'T'HH:mm", "yyyy-M-d H:m:s.SSS'Z'", "'31 Marxism' yyyy")


@query("parse_lenient_shapes", "F6", """
with o as (select o_orderkey as ord, o_orderkey % 10 as k,
                  cast(o_orderdate as timestamp) + to_seconds(o_orderkey % 86400) as d from orders)
select ord, strftime(case when k in (0, 4, 7) then date_trunc('minute', d) when k in (2, 5, 6) then date_trunc('day', d)
                          when k in (1, 3, 8) then d end, '%Y-%m-%d %H:%M:%S') as dt from o""")
def q_parse_lenient_shapes(spark, sf):
    """Every order's moment written in one of ten layouts and parsed back; the expected moment
    comes from the order, not from a text."""
    prepare(spark)
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    d = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate").cast("timestamp_ntz"))
    text = F.coalesce(*[F.when(F.col("o_orderkey") % 10 == k, F.date_format(d, layout))
                        for k, layout in enumerate(_SHAPES)])
    return o.select(F.col("o_orderkey").alias("ord"),
                    F.date_format(D.parse_lenient(T.normalize_ws(text)), "yyyy-MM-dd HH:mm:ss").alias("dt"))


@query("to_numeric", "F7", S.with_alerts(f"""
select ord, {S.to_numeric('ts_raw')} as ts_num, {S.to_numeric('date_raw')} as date_num from alerts"""))
def q_to_numeric(spark, sf):
    return alerts(spark, sf).select("ord", T.to_numeric(F.col("ts_raw")).alias("ts_num"),
                                    T.to_numeric(F.col("date_raw")).alias("date_num"))


@query("epoch_median_unit", "F8 A8", f"""
with alerts as ({S.alerts_sql(1000)}),
p as (select ord, {S.to_numeric('ts_raw')} as x from alerts),
u as (select coalesce(median(x) > {D.MS_THRESHOLD}, false) as ms from p)
select ord, {S.ts_text(S.epoch('x', 'u.ms'))} as ts_dt from p, u""")
def q_epoch_median_unit(spark, sf):
    a = alerts(spark, sf, ts_scale=1000)
    return (D.with_epoch_by_median(a, "ts_raw", "ts_dt")
            .select("ord", _ts("ts_dt").alias("ts_dt")))


@query("epoch_median", "A8", f"""
with alerts as ({S.alerts_sql(1)})
select median({S.to_numeric('ts_raw')}) as median from alerts""")
def q_epoch_median(spark, sf):
    a = alerts(spark, sf).select(T.to_numeric(F.col("ts_raw")).alias("x"))
    return rank.exact_median(a, "x")


_LEN_SQL = f"""
with alerts as ({S.alerts_sql(1000)}),
p as (select *, {S.strict('date_raw')} as d, {S.to_numeric('ts_raw')} as x from alerts),
f as (select src, arg_min(ts_raw, ord) as sample from p where d is null and ts_raw is not null and ts_raw <> '' group by src),
u as (select src, length(regexp_extract(trim(sample), '^[+-]?([0-9]*)', 1)) > 10 as ms from f),
r as (select p.*, coalesce(d, {S.epoch('x', 'coalesce(u.ms, false)')}) as dt from p left join u using (src))
"""


@query("epoch_length_unit", "F9", _LEN_SQL + f"select ord, {S.ts_text('dt')} as dt from r")
def q_epoch_length_unit(spark, sf):
    a = alerts(spark, sf, ts_scale=1000)
    r = resolve_date(a, "date_raw", "ts_raw", cascade="strict", unit="length", file_col="src", order_col="ord")
    return r.select("ord", _ts("dt").alias("dt"))


def capped(spark, sf) -> DataFrame:
    """Capped pipeline: strict date, per-file epoch unit by text length (millisecond exports)."""
    a = alerts(spark, sf, ts_scale=1000)
    return resolve_date(a, "date_raw", "ts_raw", cascade="strict", unit="length", file_col="src", order_col="ord")


@query("file_date_range", "A5", _LEN_SQL + f"""
select src as file_name, {S.ts_text('min(dt)')} as min_date, {S.ts_text('max(dt)')} as max_date from r group by src""")
def q_file_date_range(spark, sf):
    return quality.file_date_range(capped(spark, sf), "src")


@query("date_cap", "P7", _LEN_SQL + f"select ord, {S.ts_text('dt')} as dt from r where dt <= timestamp '{CAP}'")
def q_date_cap(spark, sf):
    return quality.date_cap(capped(spark, sf), CAP).select("ord", _ts("dt").alias("dt"))


@query("audit_over_cap", "P8 P3 W3", _LEN_SQL + f"""
select ref, {S.ts_text('dt')} as Date, src as Source from r where dt > timestamp '{CAP}'""")
def q_audit_over_cap(spark, sf):
    c = quality.over_cap(capped(spark, sf), CAP).withColumnRenamed("ref", "Référence")
    out = quality.audit_rows(c, ["Référence", "Date"], F.col("src"))
    return out.withColumnRenamed("Référence", "ref")


@query("audit_invalid", "P9 P3 W3 U2", _LEN_SQL + """
select ref, cast(null as varchar) as Date, src as Source from r where dt is null""")
def q_audit_invalid(spark, sf):
    c = quality.undated(capped(spark, sf)).withColumnRenamed("ref", "Référence")
    out = quality.audit_rows(c, ["Référence", "Date"], F.col("src"))
    return out.withColumnRenamed("Référence", "ref")


@query("global_stats", "A6", _LEN_SQL + f"""
select count(*) as total_initial, count(*) filter (where dt <= timestamp '{CAP}') as total_final,
       count(*) - count(*) filter (where dt <= timestamp '{CAP}') as difference from r""")
def q_global_stats(spark, sf):
    c = capped(spark, sf)
    kept = F.col("dt") <= F.lit(CAP).cast("timestamp_ntz")
    return c.agg(F.count(F.lit(1)).alias("total_initial"), F.count_if(kept).alias("total_final"),
                 (F.count(F.lit(1)) - F.count_if(kept)).alias("difference"))


@query("status_counts", "P6 P7 P8 W3", _LEN_SQL + f"""
select case when dt is null then 'undated' when dt > timestamp '{CAP}' then 'over_cap' else 'ok' end as status,
       count(*) as n_rows from r group by 1""")
def q_status_counts(spark, sf):
    c = quality.classify(capped(spark, sf), "dt", CAP)
    return c.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


@query("all_missing_by_file", "A9", _LEN_SQL + """
select src as file_name, bool_and(dt is null) as all_missing, bool_or(dt is not null) as any_valid from r group by src""")
def q_all_missing_by_file(spark, sf):
    return quality.all_missing_by_file(capped(spark, sf), "src")


@query("drop_technical", "P2", _LEN_SQL + f"""
select ord, ref, date_raw, ts_raw, src, body from r where dt is not null and dt <= timestamp '{CAP}'""")
def q_drop_technical(spark, sf):
    c = quality.date_cap(capped(spark, sf), CAP)
    c = c.withColumn("Année", F.year("dt")).withColumn("Mois", F.month("dt"))
    return c.drop("Année", "Mois", "dt")


# ------------------------------------------------------------------ dedup
@query("dedup_key_first", "D1", S.with_alerts("select * from d1", extra=S.DEDUP_CTE))
def q_dedup_key_first(spark, sf):
    return deduped(spark, sf)


@query("dedup_key_first_window", "D1", S.with_alerts("select * from d1", extra=S.DEDUP_CTE))
def q_dedup_key_first_window(spark, sf):
    return dedup.dedup_first_window(alerts(spark, sf), ["ref"], "ord")


@query("dedup_key_first_agg", "D1", S.with_alerts("select * from d1", extra=S.DEDUP_CTE))
def q_dedup_key_first_agg(spark, sf):
    return dedup.dedup_first_agg(alerts(spark, sf), ["ref"], "ord")


@query("dedup_key_keep_null", "D1", S.with_alerts("""
select * exclude (rn) from (select *, row_number() over (partition by ref, case when ref is null then ord end order by ord) as rn
from alerts) where rn = 1"""))
def q_dedup_key_keep_null(spark, sf):
    return deduped(spark, sf, null_key="keep")


@query("dedup_full_row", "D2 F23", S.with_alerts("select distinct date_raw, ts_raw, src, body from alerts"))
def q_dedup_full_row(spark, sf):
    return dedup.dedup_full_row(alerts(spark, sf).select("date_raw", "ts_raw", "src", "body"))


@query("dedup_key_month", "D3", S.with_alerts(f"""
select ord, ref, {S.month('dt')} as ym from (
  select *, row_number() over (partition by {S.month('dt')}, ref order by ord) as rn from r where dt is not null) where rn = 1""",
    extra=S.resolved_cte("alerts", S.cascade_ymd)))
def q_dedup_key_month(spark, sf):
    r = resolve_date(alerts(spark, sf), "date_raw", "ts_raw", cascade="ymd", unit="median")
    r = quality.keep_dated(r).withColumn("ym", D.month_key(F.col("dt")))
    return dedup.dedup_first(r, ["ym", "ref"], "ord").select("ord", "ref", "ym")


@query("dedup_content", "D4", f"""
with a0 as ({S.alerts_sql(1, 0)}), a7 as ({S.alerts_sql(1, 7)}),
u as (select * from a0 union all select * from a7)
select src, ord, ref, date_raw, ts_raw, body from (
  select *, row_number() over (partition by ord, coalesce(ref, 'nan'), coalesce(date_raw, 'nan'), coalesce(ts_raw, 'nan'), coalesce(body, 'nan')
                               order by src, ord) as rn from u) where rn = 1""")
def q_dedup_content(spark, sf):
    u = alerts(spark, sf).unionByName(alerts(spark, sf, src_shift_days=7))
    u = u.withColumn("__order", F.struct("src", "ord"))
    out = dedup.dedup_content(u, ["ord", "ref", "date_raw", "ts_raw", "body"], "__order")
    return out.select("src", "ord", "ref", "date_raw", "ts_raw", "body")


@query("dedup_stats", "D5", S.with_alerts("""
select (select count(*) from alerts) as rows_before, (select count(*) from d1) as rows_after,
       (select count(*) from alerts) - (select count(*) from d1) as removed""", extra=S.DEDUP_CTE))
def q_dedup_stats(spark, sf):
    return dedup.dedup_stats(alerts(spark, sf), deduped(spark, sf))


# ------------------------------------------------------------------ grouping / ordering
@query("first_in_group", "A10", S.with_alerts(f"""
select {S.month('dt')} as grp, arg_min(src, ord) as first_src, min(ord) as first_ord from r group by 1""",
    extra=S.DEDUP_CTE + S.resolved_cte()))
def q_first_in_group(spark, sf):
    return quality.first_in_group(recomposed(spark, sf), D.month_key(F.col("dt")), "ord", "src", "first_src")


@query("sorted_months", "O1", S.with_alerts(f"""
select ord, {S.month('dt')} as ym, row_number() over (partition by {S.month('dt')} order by dt, ord) as pos
from r where dt is not null""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_sorted_months(spark, sf):
    r = quality.keep_dated(recomposed(spark, sf)).withColumn("ym", D.month_key(F.col("dt")))
    return rank.rank_within(r.select("ord", "ym", "dt"), ["ym"], ["dt", "ord"]).select("ord", "ym", "pos")


@query("input_order", "O2", S.with_alerts(f"""
select ord, {S.month('dt')} as ym, row_number() over (partition by {S.month('dt')} order by ord) as pos
from r where dt is not null""", extra=S.DEDUP_CTE + S.resolved_cte()))
def q_input_order(spark, sf):
    r = quality.keep_dated(recomposed(spark, sf)).withColumn("ym", D.month_key(F.col("dt")))
    return rank.rank_within(r.select("ord", "ym"), ["ym"], ["ord"]).select("ord", "ym", "pos")


@query("project_header", "P1", S.with_alerts("select ref, date_raw, ts_raw, body from d1", extra=S.DEDUP_CTE))
def q_project_header(spark, sf):
    return deduped(spark, sf).select("ref", "date_raw", "ts_raw", "body")


@query("render_iso", "W7", S.with_alerts(f"""
select ord, ref, {S.ts_text('dt')} as Date, ts_raw, src, body from r""", extra=S.resolved_cte("alerts")))
def q_render_iso(spark, sf):
    r = resolve_date(alerts(spark, sf), "date_raw", "ts_raw", cascade="dmy", unit="median")
    return r.select("ord", "ref", _ts("dt").alias("Date"), "ts_raw", "src", "body")


@query("week_filter", "P12 F15 F16", S.with_alerts(f"""
, t as (select cast(max(dt) as date) - cast(isodow(max(dt)) + 6 as integer) as lo from r)
select ord, {S.ts_text('dt')} as dt from r, t
where dt >= cast(t.lo as timestamp) and dt < cast(t.lo as timestamp) + interval 7 day""",
    extra=S.DEDUP_CTE + S.resolved_cte()))
def q_week_filter(spark, sf):
    r = recomposed(spark, sf)
    lo = r.agg(D.previous_week_start(F.max("dt")).alias("lo")).scalar()   # one-row scalar subquery
    start = D.day_start(lo)
    return (r.where((F.col("dt") >= start) & (F.col("dt") < F.timestamp_add("DAY", F.lit(7), start)))
            .select("ord", _ts("dt").alias("dt")))


# ------------------------------------------------------------------ calendar functions on orders / lineitem
@query("month_key", "F13", """
select o_orderkey, strftime(o_orderdate, '%Y_%m') as ym, cast(year(o_orderdate) as bigint) as y,
       cast(month(o_orderdate) as bigint) as m from orders""")
def q_month_key(spark, sf):
    prepare(spark)
    o = read_table(spark, sf, "orders")
    return o.select("o_orderkey", D.month_key(F.col("o_orderdate")).alias("ym"),
                    F.year("o_orderdate").cast("long").alias("y"), F.month("o_orderdate").cast("long").alias("m"))


@query("month_key_lineitem", "F13 A1", """
select strftime(l_shipdate, '%Y_%m') as ym, count(*) as n_rows from lineitem group by 1""")
def q_month_key_lineitem(spark, sf):
    prepare(spark)
    li = read_table(spark, sf, "lineitem")
    return li.groupBy(D.month_key(F.col("l_shipdate")).alias("ym")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("month_file_name", "F14", """
select distinct strftime(o_orderdate, '%Y_%m') as ym,
  'alertes_' || strftime(o_orderdate, '%Y_%m') || '.csv' as name_underscore,
  'alertes_' || strftime(o_orderdate, '%Y-%m') || '.csv' as name_dash,
  strftime(o_orderdate, '%Y_%m') || '.csv' as name_bare from orders""")
def q_month_file_name(spark, sf):
    prepare(spark)
    d = F.col("o_orderdate")
    return read_table(spark, sf, "orders").select(
        D.month_key(d).alias("ym"), N.month_file_name(d, "underscore").alias("name_underscore"),
        N.month_file_name(d, "dash").alias("name_dash"), N.month_file_name(d, "bare").alias("name_bare")).distinct()


_WEEK = "(cast(o_orderdate as date) - cast(isodow(o_orderdate) + 6 as integer))"


@query("previous_week", "F15", f"""
select o_orderkey, strftime({_WEEK}, '%Y-%m-%d') as week_start,
       strftime({_WEEK} + 6, '%Y-%m-%d') as week_end from orders""")
def q_previous_week(spark, sf):
    prepare(spark)
    d = F.col("o_orderdate")
    return read_table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(D.previous_week_start(d), "yyyy-MM-dd").alias("week_start"),
        F.date_format(D.previous_week_end(d), "yyyy-MM-dd").alias("week_end"))


@query("day_bounds", "F16", f"""
select o_orderkey, strftime(cast({_WEEK} as timestamp), '%Y-%m-%d %H:%M:%S') as start_ts,
       strftime(cast({_WEEK} + 6 as timestamp) + interval 86399 second, '%Y-%m-%d %H:%M:%S') as end_ts,
       strftime(cast({_WEEK} + 6 as timestamp), '%Y-%m-%d %H:%M:%S') as end_ts_midnight from orders""")
def q_day_bounds(spark, sf):
    prepare(spark)
    d = F.col("o_orderdate")
    s, e = D.previous_week_start(d), D.previous_week_end(d)
    f = "yyyy-MM-dd HH:mm:ss"
    return read_table(spark, sf, "orders").select(
        "o_orderkey", F.date_format(D.day_start(s), f).alias("start_ts"),
        F.date_format(D.day_end(e), f).alias("end_ts"),
        F.date_format(D.day_end(e, inclusive_seconds=False), f).alias("end_ts_midnight"))


@query("date_formats", "F17", f"""
select o_orderkey, strftime(o_orderdate, '%m/%d/%Y') as us_date,
       strftime(o_orderdate, '%d') || '-' || {S.fr_abbr('o_orderdate')} || '-' || strftime(o_orderdate, '%Y') as fr_date,
       cast(year(o_orderdate) as varchar) as year_txt, upper(strftime(o_orderdate, '%b')) as month_abbr,
       cast(day(o_orderdate) as varchar) as day_txt from orders""")
def q_date_formats(spark, sf):
    prepare(spark)
    d = F.col("o_orderdate")
    return read_table(spark, sf, "orders").select(
        "o_orderkey", D.us_date(d).alias("us_date"), D.french_day_month_year(d).alias("fr_date"),
        F.year(d).cast("string").alias("year_txt"), F.upper(F.date_format(d, "MMM")).alias("month_abbr"),
        F.dayofmonth(d).cast("string").alias("day_txt"))


@query("range_file_name", "F18", f"""
select o_orderkey,
  'alertes_' || strftime({_WEEK}, '%Y-%m-%d') || '_' || strftime({_WEEK} + 6, '%Y-%m-%d') as name_dash,
  'alertes_' || strftime({_WEEK}, '%Y-%m-%d') || '_au_' || strftime({_WEEK} + 6, '%Y-%m-%d') as name_au,
  'alertes_' || strftime({_WEEK}, '%Y_%m') || '_du_' || strftime({_WEEK}, '%d') || '_au_' || strftime({_WEEK} + 6, '%d-%m') as name_du_au,
  'alertes_' || strftime({_WEEK}, '%Y_%d-%m') || '_au_' || strftime({_WEEK} + 6, '%d-%m') as name_daymonth
from orders""")
def q_range_file_name(spark, sf):
    prepare(spark)
    d = F.col("o_orderdate")
    s, e = D.previous_week_start(d), D.previous_week_end(d)
    return read_table(spark, sf, "orders").select(
        "o_orderkey", *[N.range_file_base(s, e, st).alias(f"name_{st}") for st in ("dash", "au", "du_au", "daymonth")])


@query("unique_names", "F19", f"""
select o_orderkey, base || case when rn > 0 then '_' || cast(rn as varchar) else '' end || '.csv' as name from (
  select o_orderkey, base, row_number() over (partition by base order by o_orderkey) - 1 as rn from (
    select o_orderkey, 'alertes_' || strftime({_WEEK}, '%Y-%m-%d') || '_' || strftime({_WEEK} + 6, '%Y-%m-%d') as base from orders))""")
def q_unique_names(spark, sf):
    prepare(spark)
    d = F.col("o_orderdate")
    o = read_table(spark, sf, "orders").select(
        "o_orderkey", N.range_file_base(D.previous_week_start(d), D.previous_week_end(d)).alias("base"))
    r = rank.rank_within(o, ["base"], ["o_orderkey"], out="pos")
    return r.select("o_orderkey", N.with_suffix(F.col("base"), F.col("pos") - 1).alias("name"))


# ------------------------------------------------------------------ text functions on documents
@query("normalize_ws", "F1", f"select doc_id, {S.norm('text')} as text from documents")
def q_normalize_ws(spark, sf):
    prepare(spark)
    return read_table(spark, sf, "documents").select("doc_id", T.normalize_ws(F.col("text")).alias("text"))


@query("strip_accents", "S14", r"""
select doc_id, regexp_replace(strip_accents(text), '[^\x{0000}-\x{007F}]', '', 'g') as text from documents""")
def q_strip_accents(spark, sf):
    prepare(spark)
    return read_table(spark, sf, "documents").select("doc_id", T.strip_accents(F.col("text")).alias("text"))


@query("mojibake_repair", "S12", "select doc_id, text as repaired, text as kept from documents")
def q_mojibake_repair(spark, sf):
    prepare(spark)
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", T.repair_mojibake(T.make_mojibake(F.col("text"))).alias("repaired"),
                       T.repair_mojibake(F.col("text")).alias("kept"))
