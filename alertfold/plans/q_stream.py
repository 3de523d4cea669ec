"""Registered streaming queries over ``events`` staged as one export per day."""

from __future__ import annotations

from pyspark.sql import functions as F

from alertfold.functions import dates as D
from alertfold.plans.registry import query
from alertfold.plans.staging import stage
from alertfold.session import prepare, scratch_dir
from alertfold.streaming import files as ST

EVENT_COLUMNS = ("event_id", "Date", "user_id", "event_type", "value")


@query("stream_new_files", "T1 U3", """
select event_id, 'events_' || strftime(ts, '%Y-%m-%d') || '.csv' as file_name from events""")
def q_stream_new_files(spark, sf):
    prepare(spark)
    src = stage(spark, sf, "events")
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ck")
    s = ST.read_exports(spark, src, EVENT_COLUMNS, max_files_per_trigger=8)
    ST.run_available(s.select(F.col("event_id").cast("long").alias("event_id"), F.col("_src").alias("file_name")),
                     out, ck)
    return spark.read.parquet(out)


@query("stream_monthly", "T2 W1 W4", """
select strftime(ts, '%Y_%m') as ym, count(*) as n_rows from events group by 1""")
def q_stream_monthly(spark, sf):
    prepare(spark)
    src = stage(spark, sf, "events")
    out, ck = scratch_dir(spark, "stream-monthly"), scratch_dir(spark, "stream-monthly-ck")
    s = ST.read_exports(spark, src, EVENT_COLUMNS, max_files_per_trigger=16)
    s = s.withColumn("dt", D.parse_strict(F.col("Date")))
    ST.run_monthly(s, out, ck, key="event_id")
    back = spark.read.option("sep", ";").option("header", True).csv(out)
    return back.groupBy("ym").agg(F.count(F.lit(1)).alias("n_rows"))


SLICINGS = (16, 64)


@query("stream_monthly_global", "T2", """
select n as files_per_batch, strftime(ts, '%Y_%m') as ym, count(*) as n_rows, sum(event_id) as id_sum
from events, (values (16), (64)) as s(n) group by 1, 2""")
def q_stream_monthly_global(spark, sf):
    """Exports that overlap (every event comes in two of them), each key once in all months, cut
    into batches of 16 and of 64 files: the months hold every event once either way."""
    prepare(spark)
    src, parts = stage(spark, sf, "events_overlap"), None
    for n in SLICINGS:
        out, ck = scratch_dir(spark, "stream-global"), scratch_dir(spark, "stream-global-ck")
        s = ST.read_exports(spark, src, EVENT_COLUMNS, max_files_per_trigger=n)
        ST.run_monthly(s.withColumn("dt", D.parse_strict(F.col("Date"))), out, ck, key="event_id", scope="global")
        back = (spark.read.option("sep", ";").option("header", True).csv(out).groupBy("ym")
                .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("event_id").cast("long")).alias("id_sum"))
                .select(F.lit(n).alias("files_per_batch"), "ym", "n_rows", "id_sum"))
        parts = back if parts is None else parts.unionByName(back)
    return parts


@query("stream_dedup", "T3 D1", """
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as dt from events""")
def q_stream_dedup(spark, sf):
    prepare(spark)
    src = stage(spark, sf, "events_overlap")
    out, ck = scratch_dir(spark, "stream-dedup"), scratch_dir(spark, "stream-dedup-ck")
    s = ST.read_exports(spark, src, EVENT_COLUMNS, max_files_per_trigger=4)
    s = s.withColumn("dt", D.parse_strict(F.col("Date"))).withColumn("event_id", F.col("event_id").cast("long"))
    d = ST.dedup_stream(s, ["event_id"], "dt", "35 days")
    ST.run_available(d.select("event_id", "dt"), out, ck)
    return spark.read.parquet(out).select("event_id", F.date_format("dt", "yyyy-MM-dd HH:mm:ss").alias("dt"))
