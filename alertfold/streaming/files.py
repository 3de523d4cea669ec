"""Exports arriving in a folder, processed incrementally.

The file source's checkpoint remembers which files were consumed, so a restarted
query (or a lost executor) neither skips nor repeats an export.  Exports must be
moved into the folder atomically; names not matching the glob (for instance
in-progress downloads) are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertfold.functions import dates as D
from alertfold.session import prepare
from alertfold.sources.csv import NA_TOKENS, file_name


def read_exports(spark: SparkSession, folder: str, columns: Sequence[str], sep: str = ";",
                 max_files_per_trigger: int = 16, glob: str = "*.[cC][sS][vV]") -> DataFrame:
    """Streaming scan of CSV exports (all columns text) with the file name as ``_src``."""
    prepare(spark)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = (spark.readStream.schema(schema).option("sep", sep).option("header", True)
          .option("escape", '"').option("pathGlobFilter", glob)
          .option("maxFilesPerTrigger", max_files_per_trigger).csv(folder))
    df = df.withColumn("_src", file_name())
    return df.select(*[F.when(F.col(f"`{c}`").isin(*NA_TOKENS), None).otherwise(F.col(f"`{c}`")).alias(c)
                       for c in columns], "_src")


def run_available(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: Sequence[str] = ()) -> None:
    """Process everything available now (in ``maxFilesPerTrigger`` slices) and stop."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(out)
    q.awaitTermination()


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival of each key wins; state is kept for ``delay`` of event time (a
    duplicate arriving later than that is treated as new)."""
    # watermarks need TIMESTAMP (zoned); the wall-clock NTZ value is read in the session
    # zone (UTC), so the instant keeps the same digits
    timed = df.withColumn("__event_time", F.col(event_time).cast("timestamp"))
    return (timed.withWatermark("__event_time", delay).dropDuplicatesWithinWatermark(list(keys))
            .drop("__event_time"))


KEYS = "_keys"        # parquet key index of the month output: ym=/batch=/ (key text only)
KEY_BUCKETS = 256     # with the global scope, where the index holds hash buckets in place of months
STAGING = "_staging"  # a batch's CSV before it is published into the month folders


def monthly_router(out: str, key: str, dt: str = "dt", sep: str = ";", scope: str = "month",
                   null_key: str = "collapse"):
    """``foreachBatch`` function: add each batch's rows under ``out/ym=YYYY_MM/``, minus
    the keys already written (a key re-exported later is not duplicated).

    ``scope`` says where a key counts as written: ``month``, in the row's own month (so
    which rows stay does not depend on how the input is cut into batches), or ``global``,
    in any month.  ``null_key``: missing keys ``collapse`` into one row per scope, or all
    rows without a key are kept (``keep``).

    The keys written so far are kept in a parquet index next to the months, so a batch
    reads one narrow column of the touched months (partition-pruned) instead of
    re-parsing all their CSV text.  With the global scope any month can hold a key, and the
    index is laid out by the key's hash instead (``KEY_BUCKETS`` buckets, missing keys in one
    of their own): a batch reads the buckets of its keys.  A batch commits in steps that are each
    safe to repeat: stage its CSV (overwrite), write its keys (dynamic overwrite of its
    own ``batch=`` partitions), move the staged files to names derived from the batch
    id (earlier copies of that batch removed first), then write a marker.  A replayed
    batch either finds its marker and stops, or redoes every step with the same result
    (its own keys are excluded from the anti-join)."""
    root = out.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        from pyspark import StorageLevel

        from alertfold.operators.dedup import dedup_first
        from alertfold.operators.small import MAX_BROADCAST_ROWS
        from alertfold.sinks.files import csv_writer, delete_dir, exists, touch
        spark = batch.sparkSession
        done = f"{root}/{KEYS}/_done/{batch_id}"
        if exists(spark, done):
            return
        rows = batch.withColumn("ym", D.month_key(F.col(dt)))
        # first occurrence inside the batch
        rows = dedup_first(rows.withColumn("__o", F.struct("_src", F.monotonically_increasing_id())),
                           ["ym", key] if scope == "month" else [key], "__o").drop("__o") \
            if null_key == "collapse" else _dedup_keyed(rows, key, scope)
        # a micro-batch is bounded by maxFilesPerTrigger: keep it for the uses below
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        keys_root = f"{root}/{KEYS}"
        kcol = F.col(f"`{key}`").cast("string")
        # where the index keeps a key: its month, or its bucket
        place = F.col("ym") if scope == "month" else key_bucket(kcol)
        new = rows
        if exists(spark, keys_root):
            # one small aggregate: the batch size and the months it touches
            st = rows.agg(F.count(F.lit(1)).alias("n"), F.collect_set(place).alias("places"),
                          F.bool_or(F.col("ym").isNull()).alias("undated")).first()
            seen = (spark.read.schema("k string, ym string, batch long").parquet(keys_root)
                    .where(F.col("batch") != batch_id).select(F.col("k").alias("__k"), F.col("ym").alias("__ym")))
            # other months, or buckets, cannot match: only the touched ones are read
            touched = F.col("__ym").isin(list(st["places"]))
            seen = seen.where(touched | F.col("__ym").isNull() if scope == "month" and st["undated"] else touched)
            if null_key == "keep":
                seen = seen.where("__k IS NOT NULL")
            same = kcol.eqNullSafe(F.col("__k")) & place.eqNullSafe(F.col("__ym"))
            # a key is in the index once per place (twice after an interrupted compaction), so
            # the hits are bounded by 2 x batch rows
            if 2 * st["n"] <= MAX_BROADCAST_ROWS:
                # the batch's keys are the small side: the index is filtered against them
                # map-side (no shuffle of it); the hits go to the anti-join
                mine = rows.select(kcol.alias("__bk"), place.alias("__bym")).distinct()
                hits = seen.join(F.broadcast(mine), F.col("__k").eqNullSafe(F.col("__bk"))
                                 & F.col("__ym").eqNullSafe(F.col("__bym")), "left_semi")
                new = rows.join(F.broadcast(hits), same, "left_anti")
            else:
                new = rows.join(seen, same, "left_anti")
            new = new.persist(StorageLevel.MEMORY_AND_DISK)   # the two writes share the anti-join
        staged = f"{root}/{STAGING}/{batch_id}"
        csv_writer(new.drop(dt).hint("rebalance", "ym"), sep).mode("overwrite").partitionBy("ym").csv(staged)
        # rebalanced by month: a few files per month and batch, not one per shuffle partition
        (new.select(kcol.alias("k"), place.alias("ym"), F.lit(batch_id).cast("long").alias("batch"))
         .hint("rebalance", "ym").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("ym", "batch").parquet(keys_root))
        new.unpersist()
        rows.unpersist()
        _publish_batch(spark, staged, root, batch_id)
        delete_dir(spark, staged)
        touch(spark, done)

    return handle


def key_bucket(key: Column) -> Column:
    """The bucket of the global key index a key lies in, as the text of its partition."""
    return F.when(key.isNull(), F.lit("none")).otherwise(F.format_string("b%03d", F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))))


def _dedup_keyed(rows: DataFrame, key: str, scope: str) -> DataFrame:
    """First row per key and scope; rows without a key all stay."""
    from alertfold.operators.dedup import dedup_first
    keyed = rows.where(F.col(f"`{key}`").isNotNull()).withColumn(
        "__o", F.struct("_src", F.monotonically_increasing_id()))
    kept = dedup_first(keyed, ["ym", key] if scope == "month" else [key], "__o").drop("__o")
    return kept.unionByName(rows.where(F.col(f"`{key}`").isNull()))


def _publish_batch(spark: SparkSession, staged: str, root: str, batch_id: int) -> None:
    """Move a staged batch's part files to ``root/ym=.../b<batch>-<n>.csv`` (metadata
    only; the file count is bounded by the batch's tasks and months)."""
    from alertfold.sinks.files import _fs
    fs, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    prefix = f"b{batch_id:012d}-"
    for old in fs.globStatus(Path(f"{root}/ym=*/{prefix}*")) or []:   # a replay's earlier copies
        fs.delete(old.getPath(), False)
    parts = sorted(fs.globStatus(Path(f"{staged}/ym=*/part-*")) or [], key=lambda st: st.getPath().toString())
    for n, st in enumerate(parts):
        month_dir = Path(f"{root}/{st.getPath().getParent().getName()}")
        fs.mkdirs(month_dir)
        fs.rename(st.getPath(), Path(month_dir, f"{prefix}{n:05d}.csv"))


def compact_key_index(spark: SparkSession, out: str) -> int:
    """Merge the key files of every committed batch (one with a marker) into one
    ``batch=-1`` partition per month; returns the number of batches merged.

    A long-running stream adds a ``batch=`` partition per month and batch, which every
    later batch lists; run this between triggers or with the stream stopped.  The merged
    files are written first, moved in under names of their own, and only then are the
    batches they replace deleted: an interruption leaves some keys present twice, which
    the anti-join does not mind, and a rerun finishes the work.  Batches without a
    marker are left alone (they may still be replayed)."""
    import uuid

    from alertfold.sinks.files import _fs, delete_dir, exists
    root = out.rstrip("/")
    keys_root = f"{root}/{KEYS}"
    if not exists(spark, f"{keys_root}/_done"):
        return 0
    fs, jvm = _fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    done = sorted(int(st.getPath().getName()) for st in fs.listStatus(Path(f"{keys_root}/_done")))
    if not done:
        return 0
    tag = uuid.uuid4().hex[:12]
    staged = f"{keys_root}/_compact/{tag}"
    (spark.read.schema("k string, ym string, batch long").parquet(keys_root)
     .where(F.col("batch").isin(done + [-1])).select("k", "ym").distinct()
     .withColumn("batch", F.lit(-1).cast("long")).hint("rebalance", "ym")
     .write.partitionBy("ym", "batch").parquet(staged))
    old = [st.getPath() for st in fs.globStatus(Path(f"{keys_root}/ym=*/batch=-1/*.parquet")) or []]
    for n, st in enumerate(sorted(fs.globStatus(Path(f"{staged}/ym=*/batch=-1/*.parquet")) or [],
                                  key=lambda st: st.getPath().toString())):
        month = st.getPath().getParent().getParent().getName()
        target = Path(f"{keys_root}/{month}/batch=-1")
        fs.mkdirs(target)
        fs.rename(st.getPath(), Path(target, f"c{tag}-{n:05d}.parquet"))
    for p in old:
        fs.delete(p, False)
    for b in done:
        for st in fs.globStatus(Path(f"{keys_root}/ym=*/batch={b}")) or []:
            fs.delete(st.getPath(), True)
    delete_dir(spark, f"{keys_root}/_compact")
    return len(done)


def run_monthly(df: DataFrame, out: str, checkpoint: str, key: str, scope: str = "month",
                null_key: str = "collapse") -> None:
    q = (df.writeStream.foreachBatch(monthly_router(out, key, scope=scope, null_key=null_key))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
