"""Resolve one timestamp per row: the date text first, the epoch column as fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.functions.dates import (CASCADES, MS_THRESHOLD, epoch_to_ts, median_above,
                                       unit_ms_by_length, unit_ms_by_magnitude)
from alertfold.functions.text import to_numeric
from alertfold.operators.small import bounded_broadcast


def resolve_date(df: DataFrame, date_col: str | None, ts_col: str | None, *,
                 cascade: str = "dmy", unit: str = "median", file_col: str | None = None,
                 order_col: str | None = None, out: str = "dt",
                 threshold: float = MS_THRESHOLD, epoch_tz: str | None = None) -> DataFrame:
    """Add ``out`` (TIMESTAMP_NTZ): parsed ``date_col``, else the converted ``ts_col``.

    unit='median'    seconds vs milliseconds by the exact median of the whole column
                     (one aggregate row, used as a scalar subquery);
    unit='length'    by the text length of the first row of each file whose date is
                     missing and whose epoch is present (per-file table, size-checked join);
    unit='magnitude' per row (no global statistic; the streaming form).

    Date texts are local wall-clock times and epochs are UTC; ``epoch_tz`` ('Europe/Paris')
    gives the epochs' times of that zone instead, so that both columns tell the same clock.
    """
    parse = CASCADES[cascade]
    dated = df.withColumn("__d", parse(F.col(f"`{date_col}`")) if date_col else F.lit(None).cast("timestamp_ntz"))
    if not ts_col:
        return dated.withColumnRenamed("__d", out)
    text = F.col(f"`{ts_col}`")
    dated = dated.withColumn("__x", to_numeric(text))
    if unit == "median":
        flag = median_above(dated, "__x", threshold).select("unit_ms").scalar()   # one-row scalar subquery
        dated = dated.withColumn("__ms", flag)
    elif unit == "magnitude":
        dated = dated.withColumn("__ms", unit_ms_by_magnitude(F.col("__x"), threshold))
    elif unit == "length":
        if not file_col or not order_col:
            raise ValueError("unit='length' needs file_col and order_col")
        sample_ok = F.col("__d").isNull() & text.isNotNull() & (text != "")
        per_file = (dated.where(sample_ok)
                    .groupBy(F.col(f"`{file_col}`").alias("__f"))
                    .agg(F.min_by(text, F.col(f"`{order_col}`")).alias("__sample"))
                    .select("__f", unit_ms_by_length(F.col("__sample")).alias("__ms")))
        per_file = bounded_broadcast(per_file)
        dated = dated.join(per_file, dated[f"`{file_col}`"].eqNullSafe(per_file["__f"]), "left").drop("__f")
    else:
        raise ValueError(f"unknown unit mode {unit!r}")
    at = epoch_to_ts(F.col("__x"), F.coalesce(F.col("__ms"), F.lit(False)))
    if epoch_tz:
        at = F.convert_timezone(F.lit("UTC"), F.lit(epoch_tz), at)
    return (dated.withColumn(out, F.coalesce(F.col("__d"), at))
            .drop("__d", "__x", "__ms"))
