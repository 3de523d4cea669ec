"""Row status, audits and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertfold.functions.dates import month_key

OK, UNDATED, OVER_CAP = "ok", "undated", "over_cap"


def classify(df: DataFrame, dt: str = "dt", cap: str | None = None, out: str = "status") -> DataFrame:
    """One status per row: 'undated' (no date), 'over_cap' (after the cap), 'ok'."""
    d = F.col(dt)
    status = F.when(d.isNull(), F.lit(UNDATED))
    if cap is not None:
        status = status.when(d > F.lit(cap).cast("timestamp_ntz"), F.lit(OVER_CAP))
    return df.withColumn(out, status.otherwise(F.lit(OK)))


def keep_dated(df: DataFrame, dt: str = "dt") -> DataFrame:
    return df.where(F.col(dt).isNotNull())


def undated(df: DataFrame, dt: str = "dt") -> DataFrame:
    return df.where(F.col(dt).isNull())


def date_cap(df: DataFrame, cap: str, dt: str = "dt") -> DataFrame:
    return df.where(F.col(dt) <= F.lit(cap).cast("timestamp_ntz"))


def over_cap(df: DataFrame, cap: str, dt: str = "dt") -> DataFrame:
    return df.where(F.col(dt) > F.lit(cap).cast("timestamp_ntz"))


def present(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def audit_rows(df: DataFrame, keep: Sequence[str], source: Column, dt: str = "dt",
               date_col: str | None = "Date") -> DataFrame:
    """Audit projection: key/date columns that exist, the parsed date as 'Date', and 'Source'."""
    cols = [F.col(f"`{c}`") for c in present(df, keep) if c != date_col]
    if date_col:
        cols.append(F.date_format(F.col(dt), "yyyy-MM-dd HH:mm:ss").alias(date_col))
    return df.select(*cols, source.alias("Source"))


def monthly_counts(df: DataFrame, dt: str = "dt") -> DataFrame:
    """Rows per month (``ym`` = yyyy_MM, NULL for undated rows)."""
    return df.groupBy(month_key(F.col(dt)).alias("ym")).agg(F.count(F.lit(1)).alias("n_rows"))


def periods(df: DataFrame, dt: str = "dt") -> DataFrame:
    return (df.where(F.col(dt).isNotNull()).select(month_key(F.col(dt)).alias("ym"))
            .distinct().orderBy("ym"))


def file_stats(df: DataFrame, file_col: str, ok: Column) -> DataFrame:
    """Per file: total rows, ok rows, error rows."""
    return df.groupBy(F.col(file_col).alias("file_name")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("ok"),
        F.count_if(~ok).alias("errors"),
    )


def file_date_range(df: DataFrame, file_col: str, dt: str = "dt") -> DataFrame:
    return df.groupBy(F.col(file_col).alias("file_name")).agg(
        F.date_format(F.min(dt), "yyyy-MM-dd HH:mm:ss").alias("min_date"),
        F.date_format(F.max(dt), "yyyy-MM-dd HH:mm:ss").alias("max_date"),
    )


def date_validity(df: DataFrame, dt: str = "dt") -> DataFrame:
    return df.agg(F.count_if(F.col(dt).isNotNull()).alias("valid"),
                  F.count_if(F.col(dt).isNull()).alias("missing"))


def all_missing_by_file(df: DataFrame, file_col: str, dt: str = "dt") -> DataFrame:
    return df.groupBy(F.col(file_col).alias("file_name")).agg(
        F.bool_and(F.col(dt).isNull()).alias("all_missing"),
        F.bool_or(F.col(dt).isNotNull()).alias("any_valid"),
    )


def first_in_group(df: DataFrame, group: Column, order: str, value: str, out: str) -> DataFrame:
    return df.groupBy(group.alias("grp")).agg(F.min_by(F.col(value), F.col(order)).alias(out),
                                              F.min(order).alias("first_" + order))
