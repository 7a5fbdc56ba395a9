"""Column helpers (Column -> Column).  All built-in expressions, so they stay
inside whole-stage codegen; nothing here runs Python per row.

T1-T6 of the silver layer and the small F-catalogue helpers used by the
query library, dashboard metrics and the outcome model.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- T1..T6 -----------------------------------------------------------------

def safe_int(c) -> Column:
    """Text -> BIGINT; missing, ``nan`` or not a number -> 0 (``'3.0'`` -> 3).
    A whole number keeps all its digits; only others go through a double."""
    whole = F.regexp_extract(_c(c).cast("string"), r"^\s*([+-]?\d+)\s*$", 1).try_cast("bigint")
    d = _c(c).try_cast("double")
    return F.coalesce(whole, F.when(~F.isnan(d), d).try_cast("bigint"), F.lit(0).cast("bigint"))


def safe_float(c) -> Column:
    """Strip ``%``, trim; not a number -> null."""
    return F.trim(F.replace(_c(c).cast("string"), F.lit("%"), F.lit(""))).try_cast("double")


def clean_str(c) -> Column:
    """Trim; the literal text ``nan`` -> null (empty CSV fields are
    already null when read)."""
    return F.nullif(F.trim(_c(c).cast("string")), F.lit("nan"))


def parse_date(c, fmt: str = "dd/MM/yyyy") -> Column:
    """T4: parse a day/month/year date; invalid (e.g. 31/02) -> null."""
    return F.to_date(F.try_to_timestamp(_c(c).cast("string"), F.lit(fmt)))


def season_of(date_col, overrides: list[tuple[int, int, int]] | None = None) -> Column:
    """T5: season from a match date.  A season that ran into the next calendar
    year (2020 played until early 2021) is mapped back with ``overrides``:
    (calendar year, last month, season)."""
    d = _c(date_col)
    expr = F.year(d)
    for year, last_month, season in (overrides if overrides is not None else SEASON_OVERRIDES):
        expr = F.when((F.year(d) == year) & (F.month(d) <= last_month), F.lit(season)).otherwise(expr)
    return expr.cast("int")


# The 2020 season ended in 2021 — January to March 2021 count as 2020.
SEASON_OVERRIDES = [(2021, 3, 2020)]


def minute_of(c) -> Column:
    """First run of digits of a minute text (``45+2`` -> 45); none -> 0."""
    digits = F.regexp_extract(_c(c).cast("string"), r"(\d+)", 1)
    return safe_int(F.when(digits == "", F.lit(None)).otherwise(digits))


# ---- F helpers --------------------------------------------------------------

def pct_of(part, total, digits: int = 1) -> Column:
    """percentage, 0 when the total is 0 or null."""
    return F.coalesce(F.round(F.try_divide(_c(part).cast("double"), _c(total)) * 100, digits), F.lit(0.0))


def result_letter(gf, ga) -> Column:
    """V / E / D of one side; null when a score is missing."""
    gf, ga = _c(gf), _c(ga)
    return (F.when(gf.isNull() | ga.isNull(), F.lit(None).cast("string"))
             .when(gf > ga, "V").when(gf == ga, "E").otherwise("D"))


def round_half_up(c, digits: int = 0) -> Column:
    """``Math.round`` style rounding (half towards +infinity)."""
    scale = 10 ** digits
    return F.floor(_c(c) * scale + 0.5) / scale


def capitalize_first(c) -> Column:
    """First letter upper, rest lower (not initcap, which does every word)."""
    s = _c(c)
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))


def club_match(c, name: str, collation: str | None = None) -> Column:
    """Club equality; ``collation='UNICODE_CI_AI_RTRIM'`` gives the
    case/accent-insensitive meaning of a MySQL ``*_unicode_ci`` column."""
    col = _c(c)
    if collation:
        return F.collate(col, collation) == F.lit(name)
    return col == F.lit(name)
