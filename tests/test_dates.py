"""Date parsing, epoch units and calendar helpers (FIXTURES C1-C7, C18)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertfold.functions import dates as D
from conftest import rows

T = dt.datetime


def parse(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_c1_strict_and_minutes(spark):
    vals = ["01/02/2025 03:04:05", "1/2/2025 3:4:5", "01/02/2025 03:04", "31/02/2025 00:00:00", "x", "", None]
    assert parse(spark, vals, D.parse_strict) == [T(2025, 2, 1, 3, 4, 5), T(2025, 2, 1, 3, 4, 5), None, None, None, None, None]
    assert parse(spark, vals, D.parse_cascade) == [T(2025, 2, 1, 3, 4, 5), T(2025, 2, 1, 3, 4, 5), T(2025, 2, 1, 3, 4),
                                                   None, None, None, None]
    assert parse(spark, [" 01/02/2025 03:04 "], D.parse_minutes) == [T(2025, 2, 1, 3, 4)]


def test_c2_ymd_in_both_cascades(spark):
    assert parse(spark, ["2025/01/31 21:00"], D.parse_cascade) == [T(2025, 1, 31, 21, 0)]
    assert parse(spark, ["2025/01/31 21:00"], D.parse_cascade_ymd) == [T(2025, 1, 31, 21, 0)]


def test_c3_c4_lenient_is_row_independent(spark):
    # ISO text is always year-month-day; every layout parses whatever its neighbours are
    vals = ["2025/01/31", "2025-02-01 10:00", "31-12-2024", "2025-01-02 03:04:05", "1.2.2025", "2024"]
    want = [T(2025, 1, 31), T(2025, 2, 1, 10, 0), T(2024, 12, 31), T(2025, 1, 2, 3, 4, 5), T(2025, 2, 1), None]
    assert parse(spark, vals, D.parse_cascade) == want
    assert parse(spark, list(reversed(vals)), D.parse_cascade) == list(reversed(want))


def test_c5_blanks_around_dates(spark):
    vals = [" 01/02/2025  03:04:05 ", "​01/02/2025\t03:04:05", "01/02/2025 03:04:05"]
    assert parse(spark, vals, D.parse_cascade) == [T(2025, 2, 1, 3, 4, 5)] * 3


def test_c6_epoch_units(spark):
    df = spark.createDataFrame([(1735689600.0, False), (1735689601.0, False), (1735689600000.0, True)], "x double, ms boolean")
    got = [r[0] for r in df.select(D.epoch_to_ts(F.col("x"), F.col("ms"))).collect()]
    assert got == [T(2025, 1, 1), T(2025, 1, 1, 0, 0, 1), T(2025, 1, 1)]
    huge = spark.createDataFrame([(1e20,)], "x double")
    assert huge.select(D.epoch_to_ts(F.col("x"), False)).first()[0] is None


def test_c7_median_decides_for_everyone(spark):
    df = spark.createDataFrame([("1735689600000",), ("1735689601000",), ("1735689602000",), ("1735689600",)], "t string")
    out = D.with_epoch_by_median(df, "t", "d")
    got = sorted(r[0] for r in out.select("d").collect())
    assert got[0] == T(1970, 1, 21, 2, 8, 9, 600000)   # the seconds value read as milliseconds
    assert got[1:] == [T(2025, 1, 1), T(2025, 1, 1, 0, 0, 1), T(2025, 1, 1, 0, 0, 2)]


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0], [1e12, 1e12 + 2], [1e12 - 1, 1e12 + 2], [1e12 - 3, 1e12 + 2], [5e12], [],
    [1e9, 1e9, 2e12, 3e12], [1e9, 2e12, 3e12], [2e12, 1e9, 1e9, 1e9, 4e12, 5e12],
])
def test_median_threshold_is_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] or [(None,)], "x double")
    got = D.median_above(df, "x").first()["unit_ms"]
    want = bool(values) and float(np.median(values)) > 1e12
    assert got == want


def test_c18_previous_week(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 8),), (dt.date(2025, 12, 7),), (dt.date(2026, 1, 1),)], "d date")
    got = rows(df, D.previous_week_start(F.col("d")), D.previous_week_end(F.col("d")))
    assert got == [(dt.date(2025, 12, 1), dt.date(2025, 12, 7)), (dt.date(2025, 11, 24), dt.date(2025, 11, 30)),
                   (dt.date(2025, 12, 22), dt.date(2025, 12, 28))]


def test_day_bounds_and_formats(spark):
    df = spark.createDataFrame([(dt.date(2025, 9, 18),)], "d date")
    r = df.select(D.day_start(F.col("d")), D.day_end(F.col("d")), D.day_end(F.col("d"), False),
                  D.us_date(F.col("d")), D.french_day_month_year(F.col("d")),
                  F.upper(F.date_format("d", "MMM"))).first()
    assert tuple(r) == (T(2025, 9, 18), T(2025, 9, 18, 23, 59, 59), T(2025, 9, 18), "09/18/2025", "18-sept.-2025", "SEP")


def test_unit_by_length(spark):
    df = spark.createDataFrame([("1735689600",), ("1735689600000",), (" 1735689600.0",)], "t string")
    assert [r[0] for r in df.select(D.unit_ms_by_length(F.col("t"))).collect()] == [False, True, False]


def test_lenient_accepts_fractions_zones_names_and_short_years(spark):
    forms = {"2025-01-31 10:00:00.123": "2025-01-31 10:00:00.123", "2025-01-31T10:00:00Z": "2025-01-31 10:00:00",
             "2025-01-31T10:00:00+01:00": "2025-01-31 09:00:00", "31/01/2025 10:00:00.5": "2025-01-31 10:00:00.5",
             "31/01/25 10:00": "2025-01-31 10:00:00", "31.01.99": "1999-01-31 00:00:00", "31 Jan 2025 10:00": "2025-01-31 10:00:00",
             "31 january 2025": "2025-01-31 00:00:00", "Jan 31, 2025 10:00:05": "2025-01-31 10:00:05",
             "20250131": "2025-01-31 00:00:00", "12345678": None, "2025-13-01": None, "31/01/2025 10": None}
    df = spark.createDataFrame([(x,) for x in forms], "x string")
    got = {r.x: r.d for r in df.select("x", D.parse_lenient(F.col("x")).cast("string").alias("d")).collect()}
    assert got == forms


def test_minutes_strips_like_python(spark):
    df = spark.createDataFrame([("\xa031/12/2024 21:59 \t",), ("\n31/12/2024 21:59",)], "x string")
    assert {str(r[0]) for r in df.select(D.parse_minutes(F.col("x"))).collect()} == {"2024-12-31 21:59:00"}


# texts of every shape, and some of none; what pandas reads differently is named below
SHAPES = ["1/31/2025", "Jan 31, 2025 10:00 PM", "31/01/2025 10:00 PM", "20250131T100000", "20250131 1000", "31-Jan-2025",
          "31 Jan 25", "Friday, 31 January 2025", "2025-1", "31/01/2025T10:00", "31 Marxism 2025", "31 janvier 2025",
          "5 juin 2025", "5 mai 2025", "12/11/2025 12:30 AM", "12/11/2025 12 PM", "12/11/2025 13:00 PM", "5 May, 2025",
          "May 5 2025 3:04:05.5", "2025.01.31", "31.01.2025 10:00:00+0100", "2025-01-31 10:00 UTC", "Sept 5, 2025",
          "September 5, 2025", "5-sep-25", "Fri 31 Jan 2025", "2025-02-30", "29/02/2024", "29/02/2023", "31/12/69",
          "2025-01-31T10:00:00.123456789Z", "", "x", "2025-01-31 24:00", "2025-01-31 23:59:60", "Jan 2025", "31 12 2025",
          "31/01/2025,10:00", "31/01/2025 10:00:00 -05:30", "13/13/2025", "1-Mar-99 9:05 am", "mayor 5 2025", "5 marchand 2025",
          "Tue 5 Feb 2030 1 AM", "Junes 5 2025", "2025-01-31T10"]


def test_lenient_shapes_agree_with_pandas(spark):
    pd = pytest.importorskip("pandas")
    got = parse(spark, SHAPES, lambda c: D.parse_lenient(c).cast("string"))
    for text, mine in zip(SHAPES, got):
        want = pd.to_datetime(text, dayfirst=True, errors="coerce")
        if text == "2025-01-31T10":   # an hour alone only with AM or PM
            want = pd.NaT
        if want is pd.NaT:
            assert mine is None, text
        else:
            want = want.tz_convert("UTC").tz_localize(None) if want.tzinfo else want
            assert pd.Timestamp(mine) == want.floor("us"), text


def test_lenient_decisions_of_its_own(spark):
    # ISO order whatever dayfirst says, a fixed century, no date without one
    texts = ["2025/1/5", "31/12/70", "10:00", "2025", "1|2|2025", "20251301"]
    want = [T(2025, 1, 5), T(1970, 12, 31), None, None, None, None]
    assert parse(spark, texts, D.parse_lenient) == want


def test_a_lenient_parse_does_not_depend_on_other_rows(spark):
    texts = SHAPES * 3
    by_text = dict(zip(texts, parse(spark, texts, D.parse_lenient)))
    for text in SHAPES[::7]:
        assert parse(spark, [text], D.parse_lenient) == [by_text[text]]
