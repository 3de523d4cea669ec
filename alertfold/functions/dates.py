"""Date and epoch helpers. Every parse is a ``try_`` form: bad text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertfold.functions.text import normalize_ws, strip_ws, to_numeric

# The date layouts of the exports.  Single-letter fields because the
# strict layouts of the exports accept one-digit days, months, hours and minutes.
DMY_HMS = "d/M/yyyy H:m:s"      # 31/12/2024 21:59:03
DMY_HM = "d/M/yyyy H:m"         # 31/12/2024 21:59
YMD_HM = "yyyy/M/d H:m"         # 2024/12/31 21:59

# Lenient day-first parse.  A text is classified once: one pattern tells its shape (numeric
# with the year first or last, compact, month name in the middle or in front) and takes its
# parts out, so that the result of a row never depends on other rows or on which layout is
# tried first.  ISO forms are always year-month-day; with the year last, the day comes
# first, unless only the other order is a date (1/31/2025).  A missing day is the first.  A
# time may have a fraction, AM or PM, and a zone; with a zone, the result is the UTC wall
# clock.  Two-digit years are 1970 to 2069.

# English names of months (by month) and weekdays, whole or short, in any case
MONTH_NAMES = ("jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?",
               "sep(?:t(?:ember)?)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?")
WEEKDAY_NAMES = ("mon(?:day)?", "tue(?:sday)?", "wed(?:nesday)?", "thu(?:rsday)?", "fri(?:day)?", "sat(?:urday)?",
                 "sun(?:day)?")

_NAME = "(" + "|".join(MONTH_NAMES) + ")"
_YEAR = r"([0-9]{4}|[0-9]{2})"
_SHAPE = (
    r"^(?:(?:" + "|".join(WEEKDAY_NAMES) + r")\.?,? +)?(?:"
    r"([0-9]{4})([-/.])([0-9]{1,2})(?:\2([0-9]{1,2}))?"                      # year first: 1 - 3 - 4
    r"|([0-9]{1,2})([-/. ])([0-9]{1,2})\6" + _YEAR                          # year last: 5 - 7 - 8
    + r"|([0-9]{4})([0-9]{2})([0-9]{2})"                                     # compact: 9 10 11
    r"|([0-9]{1,2})[-/. ]" + _NAME + r"\.?,?[-/ ]" + _YEAR                   # name in the middle: 12 13 14
    + "|" + _NAME + r"\.?[- ](?:([0-9]{1,2})(?:, ?|[- ])" + _YEAR + "|([0-9]{4}))"  # name in front: 15 16 17, 18
    + r")(?:(?:t| |, )?(?:([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2})(?:\.([0-9]{1,9}))?)?"   # time: 19 20 21 22
    r"|([0-9]{2})([0-9]{2})([0-9]{2})?|([0-9]{1,2})(?= ?[ap]m))"             # compact: 23 24 25, hour alone: 26
    r"(?: ?([ap]m))?(?: ?(z|utc|gmt|[+-][0-9]{2}(?::?[0-9]{2})?))?|[t ])?$")  # AM or PM, zone: 27 28
_PARTS = 28
_MARK = "\x01"   # between the parts


def epoch0() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
# Range of a nanosecond-precision timestamp (about 1677..2262), in microseconds.
_MAX_MICROS = 9_223_372_036_854_775
MS_THRESHOLD = 1e12


# Anchored shape of the texts each layout can accept (a superset: the formatter still
# validates).  A failed parse costs a Java exception, so texts of another shape are
# sent to NULL without calling the formatter.  Years are exactly four digits.
GUARDS = {
    DMY_HMS: r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$",
    DMY_HM: r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$",
    YMD_HM: r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$",
}


def parse_with(c: Column, pattern: str) -> Column:
    """Text -> TIMESTAMP_NTZ with one pattern, NULL when it does not fit."""
    parsed = F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")
    guard = GUARDS.get(pattern)
    return F.when(c.rlike(guard), parsed) if guard else parsed


def parse_strict(c: Column) -> Column:
    """``dd/mm/yyyy HH:MM:SS`` on the raw text."""
    return parse_with(c, DMY_HMS)


def parse_minutes(c: Column) -> Column:
    """``dd/mm/yyyy HH:MM`` after trimming all white space, as Python's ``strip`` does."""
    return parse_with(strip_ws(c), DMY_HM)


def parse_lenient(c: Column) -> Column:
    """Text of any of the lenient shapes -> TIMESTAMP_NTZ, NULL for others."""
    # bound step by step: the text, its parts and its numbers are each computed once per row
    return F.get(F.transform(F.transform(F.array(F.lower(c)), _shape_parts), _from_parts), 0)


def _shape_parts(text: Column) -> Column:
    """The parts of a text by number, '' where its shape has none; a text of no shape is one part."""
    taken = _MARK.join(f"${i}" for i in range(1, _PARTS + 1))
    return F.split(F.regexp_replace(text, _SHAPE, taken), _MARK)


def _from_parts(parts: Column) -> Column:
    def part(*numbers: int) -> Column:
        """The text of the first of the numbered parts that the shape has, else NULL."""
        return F.coalesce(*[F.nullif(F.get(parts, i - 1), F.lit("")) for i in numbers])

    def number(*numbers: int) -> Column:
        return part(*numbers).try_cast("int")

    name = part(13, 15)
    named = F.coalesce(*[F.when(name.startswith(full[:3]), F.lit(k)) for k, full in enumerate(MONTH_NAMES, 1)])
    short = part(8, 14, 17, 18)
    year = F.coalesce(number(1, 9), F.when(F.length(short) == 2, F.pmod(short.try_cast("int") - 70, F.lit(100)) + 1970)
                      .otherwise(short.try_cast("int")))
    first, second = number(5), number(7)
    swapped = (second > 12) & (first <= 12)
    month = F.coalesce(number(3, 10), F.when(swapped, first).otherwise(second), named)
    day = F.coalesce(number(4, 11), F.when(swapped, second).otherwise(first), number(12, 16), F.lit(1))
    half = part(27)
    hour = F.coalesce(number(19, 23, 26), F.lit(0))
    hour = (F.when(half.isNull(), hour)
            .when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0)))
    minute, second_of = F.coalesce(number(20, 24), F.lit(0)), F.coalesce(number(21, 25), F.lit(0))
    micros = F.rpad(F.substring(F.coalesce(part(22), F.lit("0")), 1, 6), 6, "0").cast("int")
    zone = F.regexp_replace(part(28), ":", "")
    offset = F.when(zone.rlike("^[+-]"), F.concat(F.substring(zone, 1, 1), F.lit("1")).cast("int") * (
        F.substring(zone, 2, 2).cast("int") * 60 + F.coalesce(F.nullif(F.substring(zone, 4, 2), F.lit("")).cast("int"), F.lit(0))))
    at = F.try_make_timestamp_ntz(year, month, day, hour, minute, F.lit(0).cast("decimal(16,6)"))
    at = F.timestamp_add("MICROSECOND", second_of * F.lit(1_000_000).cast("long") + micros, at)
    at = F.when(offset.isNull(), at).otherwise(F.timestamp_add("MINUTE", -offset, at))
    return F.when((F.size(parts) == _PARTS) & (year >= 1) & (second_of < 60), at)


def parse_cascade(c: Column) -> Column:
    """Current cascade: normalise blanks, then d/m/Y H:M:S, d/m/Y H:M, lenient list."""
    s = normalize_ws(c)
    return F.coalesce(parse_with(s, DMY_HMS), parse_with(s, DMY_HM), parse_lenient(s))


def parse_cascade_ymd(c: Column) -> Column:
    """Older cascade: normalise blanks, then Y/m/d H:M, d/m/Y H:M, lenient list."""
    s = normalize_ws(c)
    return F.coalesce(parse_with(s, YMD_HM), parse_with(s, DMY_HM), parse_lenient(s))


CASCADES = {"dmy": parse_cascade, "ymd": parse_cascade_ymd, "strict": parse_strict,
            "minutes": parse_minutes, "lenient": lambda c: parse_lenient(normalize_ws(c))}


# ---------------------------------------------------------------- epochs
def epoch_to_ts(x: Column, unit_ms: Column | bool) -> Column:
    """Numeric epoch (seconds, or milliseconds when ``unit_ms``) -> TIMESTAMP_NTZ.

    Pure wall-clock arithmetic from 1970-01-01 (no session zone involved); values
    outside the nanosecond timestamp range give NULL, like a coercing conversion.
    """
    unit = unit_ms if isinstance(unit_ms, Column) else F.lit(bool(unit_ms))
    micros = x * F.when(unit, F.lit(1000.0)).otherwise(F.lit(1_000_000.0))
    ok = micros.isNotNull() & (F.abs(micros) <= F.lit(float(_MAX_MICROS)))
    return F.when(ok, F.timestamp_add("MICROSECOND", micros.cast("long"), epoch0()))


def median_above(df: DataFrame, x: str, threshold: float = MS_THRESHOLD) -> DataFrame:
    """One row ``{n, unit_ms}``: is the exact median of ``x`` (NULLs ignored) above ``threshold``?

    Exact, with O(1) aggregation state instead of gathering every value for a
    percentile: with ``a`` values above the threshold out of ``n``, the median is
    above it when ``a`` exceeds half of ``n``; on an exact tie (``n`` even, ``a = n/2``)
    it is the mean of the largest value at or below and the smallest value above.
    """
    v = F.col(x)
    stats = df.agg(
        F.count(v).alias("n"),
        F.count_if(v > threshold).alias("a"),
        F.max(F.when(v <= threshold, v)).alias("lo"),
        F.min(F.when(v > threshold, v)).alias("hi"),
    )
    n, a = F.col("n"), F.col("a")
    tie = ((n % 2) == 0) & (a * 2 == n) & ((F.col("lo") + F.col("hi")) > 2 * threshold)
    unit_ms = (n > 0) & ((a * 2 > n) | tie)
    return stats.select("n", F.coalesce(unit_ms, F.lit(False)).alias("unit_ms"))


def with_epoch_by_median(df: DataFrame, ts_col: str, out: str = "ts_dt",
                         threshold: float = MS_THRESHOLD) -> DataFrame:
    """Add ``out`` = epoch text of ``ts_col`` converted with a unit chosen by the global median.

    The unit is a scalar subquery over one aggregate row (computed once per query).
    """
    num = df.withColumn("__ts_num", to_numeric(F.col(ts_col)))
    unit = median_above(num, "__ts_num", threshold).select("unit_ms").scalar()
    return num.withColumn(out, epoch_to_ts(F.col("__ts_num"), unit)).drop("__ts_num")


def unit_ms_by_length(sample_text: Column) -> Column:
    """Unit guess from the text of one sample: more than 10 characters of integer part -> ms."""
    int_part = F.regexp_extract(F.trim(sample_text), r"^[+-]?([0-9]*)", 1)
    return F.length(int_part) > 10


def unit_ms_by_magnitude(x: Column, threshold: float = MS_THRESHOLD) -> Column:
    """Per-row unit test (used in streaming, where no global statistic exists)."""
    return F.abs(x) > threshold


# ---------------------------------------------------------------- calendar
def month_key(dt: Column) -> Column:
    return F.date_format(dt, "yyyy_MM")


def previous_week_start(d: Column) -> Column:
    """Monday of the week before the week of ``d``."""
    d = d.cast("date")
    return F.date_sub(d, F.weekday(d) + 7)


def previous_week_end(d: Column) -> Column:
    return F.date_add(previous_week_start(d), 6)


def day_start(d: Column) -> Column:
    return d.cast("date").cast("timestamp_ntz")


def day_end(d: Column, inclusive_seconds: bool = True) -> Column:
    """23:59:59 of the day (or 00:00:00 of it, the variant that loses the last day)."""
    start = day_start(d)
    if not inclusive_seconds:
        return start
    return F.timestamp_add("SECOND", F.lit(86399), start)


# French abbreviated month names as printed by a fr_FR locale.
FRENCH_MONTH_ABBR = ("janv.", "févr.", "mars", "avr.", "mai", "juin",
                     "juil.", "août", "sept.", "oct.", "nov.", "déc.")


def french_month_abbr(d: Column) -> Column:
    arr = F.array(*[F.lit(m) for m in FRENCH_MONTH_ABBR])
    return F.element_at(arr, F.month(d))


def us_date(d: Column) -> Column:
    """``MM/DD/YYYY``, the layout the export filter expects."""
    return F.date_format(d, "MM/dd/yyyy")


def french_day_month_year(d: Column) -> Column:
    """``DD-<abbr>-YYYY`` with French month abbreviations."""
    return F.concat_ws("-", F.date_format(d, "dd"), french_month_abbr(d), F.date_format(d, "yyyy"))
