"""The ``alerts`` view derived from ``orders`` (one alert per order).

Columns: ``ord`` (input order), ``ref`` (key, planted duplicates and NULLs),
``date_raw`` (date text in the export layouts, with blanks, NULLs and junk),
``ts_raw`` (epoch seconds as text, on some rows), ``src`` (export file name),
``body`` (opaque payload).  The same derivation is spelled in DuckDB SQL in
:data:`ALERTS_SQL` for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertfold.session import prepare


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fmt(d: Column, p: str) -> Column:
    return F.date_format(d, p)


def alerts(spark: SparkSession, sf_dir: str, ts_scale: int = 1, src_shift_days: int = 0) -> DataFrame:
    """Derived alert rows.  ``ts_scale=1000`` gives millisecond epochs; ``src_shift_days``
    moves the export file name so that exports overlap months."""
    prepare(spark)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    m = k % 8
    d = F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate").cast("timestamp_ntz"))
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), d)
    date_raw = (
        F.when(m.isin(0, 1, 2), _fmt(d, "dd/MM/yyyy HH:mm:ss"))
        .when(m == 3, _fmt(d, "dd/MM/yyyy HH:mm"))
        .when(m == 4, _fmt(d, "yyyy/MM/dd HH:mm"))
        .when(m == 6, F.concat(F.lit("\u00a0"), _fmt(d, "dd/MM/yyyy"), F.lit("  "),
                               _fmt(d, "HH:mm:ss"), F.lit(" ")))
        .when(m == 7, F.lit("inconnue"))
    )
    src_day = d if not src_shift_days else F.timestamp_add("DAY", F.lit(src_shift_days), d)
    return o.select(
        k.alias("ord"),
        F.when(k % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("R"), F.when(k % 10 == 1, k - 1).otherwise(k).cast("string")))
        .alias("ref"),
        date_raw.alias("date_raw"),
        F.when((m == 5) | (k % 16 == 15), (epoch * ts_scale).cast("string")).alias("ts_raw"),
        F.concat(F.lit("Alertes_-"), _fmt(src_day, "yyyy-MM"), F.lit(".csv")).alias("src"),
        F.col("o_orderpriority").alias("body"),
    )


ALERT_COLUMNS = ("ord", "ref", "date_raw", "ts_raw", "src", "body")


def alerts_sql(ts_scale: int = 1, src_shift_days: int = 0) -> str:
    """DuckDB text of the same derivation (a sub-query usable in a WITH clause)."""
    src_d = "d" if not src_shift_days else f"d + to_days({src_shift_days})"
    return f"""
select o_orderkey as ord,
  case when k%50=0 then null else 'R'||cast(case when k%10=1 then k-1 else k end as varchar) end as ref,
  case when m in (0,1,2) then strftime(d,'%d/%m/%Y %H:%M:%S') when m=3 then strftime(d,'%d/%m/%Y %H:%M')
       when m=4 then strftime(d,'%Y/%m/%d %H:%M')
       when m=6 then chr(160)||strftime(d,'%d/%m/%Y')||'  '||strftime(d,'%H:%M:%S')||' '
       when m=7 then 'inconnue' end as date_raw,
  case when m=5 or k%16=15 then cast(cast(epoch(d) as bigint)*{ts_scale} as varchar) end as ts_raw,
  'Alertes_-'||strftime({src_d},'%Y-%m')||'.csv' as src, o_orderpriority as body
from (select *, o_orderkey as k, o_orderkey%8 as m, o_orderdate + to_seconds(o_orderkey%86400) as d from orders)
"""
