"""Skew experiment: a third of the rows share one key (NULL) and one month.

Compares keep-first by ``min_by`` aggregate vs ``row_number`` window, and exact
positions by ``rank_within`` vs a ``row_number`` window per month.  Reports wall time
and the longest task of the slowest stage, read from Spark's event log (written to a
fresh scratch folder).  usage: python tools/skew_probe.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    logdir = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.sql.shuffle.partitions", "32").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from alertfold.operators import dedup, rank
    from alertfold.plans.alerts import alerts
    from alertfold.session import prepare
    prepare(spark)
    a = alerts(spark, sf)
    big = a.crossJoin(spark.range(copies).withColumnRenamed("id", "copy")) if copies > 1 else a.withColumn("copy", F.lit(0))
    hot = (F.col("ord") % 3 == 0)
    big = big.select((F.col("ord") * copies + F.col("copy")).alias("ord"),
                     F.when(hot, F.lit(None)).otherwise(F.concat(F.col("ref"), F.lit("-"), F.col("copy").cast("string"))).alias("ref"),
                     F.when(hot, F.lit("1999_01")).otherwise(F.substring("src", 10, 7)).alias("ym"), "body")
    # a many-file input: spread rows over 32 partitions before the operators
    big = big.repartition(32).cache()
    big.count()
    runs = {
        "dedup_min_by": lambda: dedup.dedup_first(big, ["ref"], "ord", "collapse"),
        "dedup_row_number": lambda: dedup.dedup_first_window(big, ["ref"], "ord", "collapse"),
        "rank_within": lambda: rank.rank_within(big, ["ym"], ["ord"]),
        "window_row_number": lambda: big.withColumn("pos", F.row_number().over(Window.partitionBy("ym").orderBy("ord"))),
    }
    results = {}
    for name, build in runs.items():
        build().write.format("noop").mode("overwrite").save()        # warm-up
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        results[name] = {"wall_sec": round(time.perf_counter() - t0, 2)}
    spark.stop()
    import zstandard
    tasks: dict[int, list[float]] = {}
    stage_group: dict[int, str] = {}
    job_group: dict[int, str] = {}
    for f in glob.glob(f"{logdir}/*/events_*"):
        with open(f, "rb") as fh:
            stream = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif e["Event"] == "SparkListenerTaskEnd":
                    ti = e["Task Info"]
                    tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
    for sid, durs in tasks.items():
        g = stage_group.get(sid)
        if g in results:
            r = results[g]
            if max(durs) > r.get("longest_task_sec", 0):
                r["longest_task_sec"] = round(max(durs), 2)
                r["median_task_sec_that_stage"] = round(sorted(durs)[len(durs) // 2], 2)
                r["tasks_that_stage"] = len(durs)
    print(json.dumps({"rows": "orders x %d" % copies, "hot_share": "1/3", "results": results}))


if __name__ == "__main__":
    main()
