"""File-name rules: month outputs, weekly export names, collision suffixes, rename rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output naming styles.
MONTH_NAME_STYLES = {
    "underscore": "alertes_%04d_%02d.csv",   # monthly recomposition
    "dash": "alertes_%04d-%02d.csv",         # generic merger
    "bare": "%04d_%02d.csv",                 # row router
}

AUDIT_UNDATED = "alertes_sans_date.csv"
AUDIT_INVALID = "lignes_invalides.csv"
AUDIT_FILTERED = "lignes_filtrees.csv"
AUDIT_INVALID_FULL = "alertes_lignes_invalides.csv"

# Own outputs never read back as sources (case-insensitive).
EXCLUDE_OUTPUTS = (r"^alertes_\d{4}_\d{2}\.csv$", r"^alertes_sans_date\.csv$")
# Extra parts of a month split over several files by this library.
EXCLUDE_PARTS = r"^alertes_\d{4}_\d{2}_p\d{3}\.csv$"
INCLUDE_SOURCES = r"^Alertes_-\d{4}(?:-\d{2})?.*\.csv$"


def month_file_name(dt: Column, style: str = "underscore") -> Column:
    return F.format_string(MONTH_NAME_STYLES[style], F.year(dt), F.month(dt))


def range_file_base(start: Column, end: Column, style: str = "dash") -> Column:
    """Export name (without extension) for a date range.

    dash:     alertes_2025-12-01_2025-12-07
    au:       alertes_2025-12-01_au_2025-12-07
    du_au:    alertes_2025_12_du_01_au_07-12
    daymonth: alertes_2025_01-12_au_07-12   (the layout the rename rules produce)
    """
    if style == "dash":
        return F.concat(F.lit("alertes_"), F.date_format(start, "yyyy-MM-dd"), F.lit("_"),
                        F.date_format(end, "yyyy-MM-dd"))
    if style == "au":
        return F.concat(F.lit("alertes_"), F.date_format(start, "yyyy-MM-dd"), F.lit("_au_"),
                        F.date_format(end, "yyyy-MM-dd"))
    if style == "du_au":
        return F.concat(F.lit("alertes_"), F.date_format(start, "yyyy_MM"), F.lit("_du_"),
                        F.date_format(start, "dd"), F.lit("_au_"), F.date_format(end, "dd-MM"))
    if style == "daymonth":
        return F.concat(F.lit("alertes_"), F.date_format(start, "yyyy_dd-MM"), F.lit("_au_"),
                        F.date_format(end, "dd-MM"))
    raise ValueError(f"unknown range style {style!r}")


def with_suffix(base: Column, n: Column, ext: str = ".csv") -> Column:
    """``base.csv`` for n = 0, ``base_n.csv`` otherwise."""
    return F.concat(base, F.when(n > 0, F.concat(F.lit("_"), n.cast("string"))).otherwise(F.lit("")),
                    F.lit(ext))


def free_number(n: Column, taken: Column) -> Column:
    """The n-th (from 0) suffix number that is not among ``taken``, the numbers of files that
    exist for the base already (0: the bare name).

    With the taken numbers in order, the i-th of them pushes the result on by one when its
    value less i is at most n, so no row walks through the numbers before it."""
    order = F.array_sort(F.array_distinct(F.coalesce(taken.cast("array<long>"), F.array().cast("array<long>"))))
    pushes = F.filter(F.transform(order, lambda x, i: x - i), lambda x: x <= n)
    return n + F.size(pushes)


def taken_number(name: Column, base: Column, ext: str = ".csv") -> Column:
    """The suffix number under which an existing file uses ``base``; NULL when it does not."""
    stem = F.when(F.endswith(name, F.lit(ext)), F.substring(name, F.lit(1), F.length(name) - len(ext)))
    rest = F.when(F.startswith(stem, base), F.substring(stem, F.length(base) + 1, F.length(stem)))
    return F.when(rest == "", F.lit(0)).when(rest.rlike("^_[1-9][0-9]*$"), F.substring(rest, 2, 18).try_cast("long")).cast("long")


# ---------------------------------------------------------------- rename rules
# The rename rules, in priority order (case-insensitive).  The first
# rule is written in its documented form: the second date is the one right before
# the extension, and the English month-day pairs are turned into day-month.
EN_RULES = (
    # 2025-10-24_au_2025-10-30.csv -> alertes_2025_24-10_au_30-10.csv
    (r"(?i)(\d{4})[-_]?(\d{2})-(\d{2}).*?au.*?(\d{2})-(\d{2})\.csv$",
     ("alertes_", 1, "_", 3, "-", 2, "_au_", 5, "-", 4, ".csv")),
    # Alertes_2024.csv -> alertes_2024_complet.csv
    (r"(?i)Alertes[-_](\d{4})\.csv",
     ("alertes_", 1, "_complet.csv")),
    # Alertes_2024-01 à 03.csv -> alertes_2024_01-03_complet.csv
    (r"(?i)Alertes[-_](\d{4})-(\d{2})(?: *[àa] *| +)(\d{2})\.csv",
     ("alertes_", 1, "_", 2, "-", 3, "_complet.csv")),
    # Alertes_2025-01_05au12.csv -> alertes_2025_05-01_au_12-01.csv
    (r"(?i)Alertes[-_](\d{4})-(\d{2})[-_](\d{2})au(\d{2})\.csv",
     ("alertes_", 1, "_", 3, "-", 2, "_au_", 4, "-", 2, ".csv")),
    # Alertes_2025-01-05.csv -> alertes_2025_05-01.csv
    (r"(?i)Alertes[-_](\d{4})-(\d{2})-(\d{2})\.csv",
     ("alertes_", 1, "_", 3, "-", 2, ".csv")),
)

FR_RULES = (
    # 24-10-2025_au_30-10-2025.csv -> alertes_2025_24-10_au_30-10.csv
    (r"(\d{2})-(\d{2})-(\d{4}).*?au.*?(\d{2})-(\d{2})-(\d{4})\.csv$",
     ("alertes_", 3, "_", 1, "-", 2, "_au_", 4, "-", 5, ".csv")),
)


def _render(name: Column, pattern: str, template: tuple) -> Column:
    parts = [F.lit(p) if isinstance(p, str) else F.regexp_extract(name, pattern, p) for p in template]
    return F.concat(*parts)


def rewrite_name(name: Column, language: str = "en") -> Column:
    """New name by the first matching rule; NULL when no rule recognises the name."""
    rules = EN_RULES if language == "en" else FR_RULES
    out = None
    for pattern, template in rules:
        cond = name.rlike(pattern)
        out = F.when(cond, _render(name, pattern, template)) if out is None \
            else out.when(cond, _render(name, pattern, template))
    return out


def rewrite_name_sql(expr: str, language: str = "en") -> str:
    """DuckDB form of :func:`rewrite_name` (same regexes, RE2 syntax)."""
    rules = EN_RULES if language == "en" else FR_RULES
    whens = []
    for pattern, template in rules:
        parts = [f"'{p}'" if isinstance(p, str) else f"regexp_extract({expr}, '{pattern}', {p})"
                 for p in template]
        whens.append(f"when regexp_matches({expr}, '{pattern}') then concat({', '.join(parts)})")
    return "case " + " ".join(whens) + " end"
