"""DuckDB spellings of the column helpers, used only to write the oracle SQL."""

from __future__ import annotations

from alertfold.functions.dates import FRENCH_MONTH_ABBR, MS_THRESHOLD
from alertfold.functions.text import NUMERIC_RE, WS_RUN
from alertfold.plans.alerts import alerts_sql

D_DMY_HMS = "%d/%m/%Y %H:%M:%S"
D_DMY_HM = "%d/%m/%Y %H:%M"
D_YMD_HM = "%Y/%m/%d %H:%M"
_TIMES = ("", " %H:%M", " %H:%M:%S")
D_LENIENT = ([f"%Y-%m-%d{t}" for t in _TIMES] + ["%Y-%m-%dT%H:%M", "%Y-%m-%dT%H:%M:%S"]
             + [f"%Y/%m/%d{t}" for t in _TIMES] + [f"%d/%m/%Y{t}" for t in _TIMES]
             + [f"%d-%m-%Y{t}" for t in _TIMES] + [f"%d.%m.%Y{t}" for t in _TIMES])
MAX_MICROS = 9_223_372_036_854_775


def lst(fmts) -> str:
    return "[" + ", ".join(f"'{f}'" for f in fmts) + "]"


def norm(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS_RUN}', ' ', 'g'))"


def py_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS_RUN}|{WS_RUN}$', '', 'g')"


def lenient(e: str) -> str:
    return f"try_strptime({e}, {lst(D_LENIENT)})"


def cascade(e: str) -> str:
    s = norm(e)
    return f"coalesce(try_strptime({s}, '{D_DMY_HMS}'), try_strptime({s}, '{D_DMY_HM}'), {lenient(s)})"


def cascade_ymd(e: str) -> str:
    s = norm(e)
    return f"coalesce(try_strptime({s}, '{D_YMD_HM}'), try_strptime({s}, '{D_DMY_HM}'), {lenient(s)})"


def strict(e: str) -> str:
    return f"try_strptime({e}, '{D_DMY_HMS}')"


def to_numeric(e: str) -> str:
    return f"case when regexp_matches({e}, '{NUMERIC_RE}') then try_cast(trim({e}) as double) end"


def epoch(x: str, ms: str) -> str:
    mult = f"(case when {ms} then 1000.0 else 1000000.0 end)"
    return (f"case when {x} is not null and abs({x}*{mult}) <= {MAX_MICROS} "
            f"then make_timestamp(cast(trunc({x}*{mult}) as bigint)) end")


def ts_text(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S')"


def month(e: str) -> str:
    return f"strftime({e}, '%Y_%m')"


def fr_abbr(e: str) -> str:
    arr = "[" + ", ".join(f"'{m}'" for m in FRENCH_MONTH_ABBR) + "]"
    return f"{arr}[month({e})]"


def with_alerts(body: str, ts_scale: int = 1, src_shift_days: int = 0, extra: str = "") -> str:
    return f"with alerts as ({alerts_sql(ts_scale, src_shift_days)}){extra}\n{body}"


def resolved_cte(source: str = "d1", cascade_fn=cascade) -> str:
    """CTEs p (parsed) and r (resolved with the median unit) over relation ``source``."""
    return f""",
p as (select *, {cascade_fn('date_raw')} as d, {to_numeric('ts_raw')} as x from {source}),
u as (select coalesce(median(x) > {MS_THRESHOLD}, false) as ms from p),
r as (select p.*, coalesce(d, {epoch('x', 'u.ms')}) as dt from p, u)"""


DEDUP_CTE = """,
d1 as (select * exclude (rn) from (select *, row_number() over (partition by ref order by ord) as rn from alerts) where rn = 1)"""
