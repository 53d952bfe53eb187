"""Scalar column expressions (P3-P11, P14-P18 of the operator inventory).

All helpers return ``Column`` objects made of built-in functions so that they
stay inside whole-stage code generation. ANSI mode stays on: anything that may
fail on bad input uses the ``try_*`` variants.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The text formats used by the exported files.
DATE_FORMAT_US = "MM-dd-yyyy"
DATE_FORMAT_ISO = "yyyy-MM-dd"


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def half_up(c: Column, digits: int) -> Column:
    """Round half up on the binary value: ``floor(x * 10^d + 0.5) / 10^d``.

    Written out (rather than ``round``) so that Spark and the SQL twin apply
    the same arithmetic: Spark's ``round`` works on the shortest decimal text
    of a double, other engines on its binary value, and the two disagree on
    exact halves such as 3802.35375.
    """
    scale = 10 ** digits
    return F.floor(_c(c) * scale + 0.5) / scale


def parse_date(col: ColumnOrName) -> Column:
    """Text date in ``MM-dd-yyyy`` (price export) or ISO form -> DATE; bad text -> null."""
    c = _c(col)
    return F.coalesce(F.try_to_date(c, DATE_FORMAT_US), F.try_to_date(c, DATE_FORMAT_ISO))


def year_of_fiscal(col: ColumnOrName) -> Column:
    """``'2017-12'`` -> 2017 (int); malformed text -> null instead of a failed job."""
    return F.substring(_c(col).cast("string"), 1, 4).try_cast("int")


def year_of_date_text(col: ColumnOrName) -> Column:
    """Year of a ``MM-dd-yyyy`` (or ISO) text date."""
    return F.year(parse_date(col))


def year_of_iso_text(col: ColumnOrName) -> Column:
    """``substring(DATE, 1, 4)`` as int for ISO text dates."""
    return F.substring(_c(col).cast("string"), 1, 4).try_cast("int")


def split_year_month(col: ColumnOrName) -> tuple[Column, Column]:
    """``'2017-09'`` -> (2017, 9) as ints."""
    parts = F.split(_c(col).cast("string"), "-")
    return parts.getItem(0).try_cast("int"), parts.getItem(1).try_cast("int")


def make_month_date(year: ColumnOrName, month: ColumnOrName, day: int = 1) -> Column:
    """First (or given) day of a month from numeric year and month."""
    return F.make_date(_c(year).cast("int"), _c(month).cast("int"), F.lit(day))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` with null (not an error) for a zero or null denominator."""
    return F.try_divide(_c(num), _c(den))


def case_label(cond: Column, yes: str, no: str) -> Column:
    """Two-valued text label; a null condition falls to ``no`` (as numpy ``where``)."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def compound_label(returns_next: ColumnOrName, index_next: ColumnOrName) -> Column:
    """WINS only if the next return is positive and beats the index, else LOSES."""
    r, i = _c(returns_next), _c(index_next)
    return case_label((r > 0) & (r > i), "WINS", "LOSES")


def round_to_class(prob: ColumnOrName) -> Column:
    """Probability -> 0/1 with half-to-even rounding (0.5 -> 0), as Python's ``round``."""
    return F.bround(_c(prob), 0).cast("int")


def threshold_flag(prob: ColumnOrName, threshold: float = 0.8) -> Column:
    """``prob > threshold`` (strict)."""
    return _c(prob) > F.lit(threshold)


def url_for(code: ColumnOrName, prefix: str) -> Column:
    """Hyperlink per company code."""
    return F.concat(F.lit(prefix), _c(code))
