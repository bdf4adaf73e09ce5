"""Column functions over months, years and production ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text, let

FIRST_YEAR, LAST_YEAR = 1886, 2100
_YM = r"(\d{4})-(\d{2})(?:-\d{2})?"
_MY = r"(\d{2})\.(\d{4})"
_TILDE = r"\s*(?:～|~|—|–|\s-\s)\s*"
_OPEN = r"\s*(?:～|~|—|–|\s-)$"
_DASH = r"\s*-\s*"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_range(c: str | Column) -> Column:
    """struct(start, end, precision, confidence, parser) of a production range.

    Bounds are months YYYY-MM; a year starts in January and ends in December, and an open end is null. Forms with a
    tilde or with a hyphen between spaces hold months YYYY-MM (parser generic); those of the catalog site are MM.YYYY
    and YYYY (parser site). What fits no form, lies outside 1886-2100, has no such month or runs backwards is unknown,
    with confidence 0.
    """
    return let(F.coalesce(clean_text(c), F.lit("")), _range_of)


def _range_of(s: Column) -> Column:
    # (pattern, precision, parser, start, end): a bound is (year group, month group or fixed month), or None if open.
    forms = [
        (f"^{_YM}{_TILDE}{_YM}$", "month", "generic", (1, 2), (3, 4)),
        (f"^{_YM}{_OPEN}", "month", "generic", (1, 2), None),
        (r"^(\d{4})-(\d{2})$", "month", "generic", (1, 2), (1, 2)),
        (f"^{_MY}{_DASH}{_MY}$", "month", "site", (2, 1), (4, 3)),
        (f"^{_MY}{_DASH}$", "month", "site", (2, 1), None),
        (f"^{_DASH}{_MY}$", "month", "site", None, (2, 1)),
        (rf"^(\d{{4}}){_DASH}(\d{{4}})$", "year", "site", (1, "01"), (2, "12")),
        (rf"^(\d{{4}}){_DASH}$", "year", "site", (1, "01"), None),
        (rf"^{_DASH}(\d{{4}})$", "year", "site", None, (1, "12")),
        (r"^(\d{4})$", "year", "site", (1, "01"), (1, "12")),
    ]

    def bound(pattern: str, at: tuple | None) -> Column:
        if at is None:
            return F.lit(None).cast("string")
        month = F.lit(at[1]) if isinstance(at[1], str) else F.regexp_extract(s, pattern, at[1])
        return F.concat(F.regexp_extract(s, pattern, at[0]), F.lit("-"), month)

    def sound(v: Column) -> Column:
        return v.isNull() | (F.substring(v, 1, 4).try_cast("int").between(FIRST_YEAR, LAST_YEAR) & F.substring(v, 6, 2).try_cast("int").between(1, 12))

    known = F.lit(None).cast("struct<start:string,end:string,precision:string,confidence:double,parser:string>")
    unknown = F.struct(F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("end"), F.lit("unknown").alias("precision"), F.lit(0.0).alias("confidence"), F.lit("generic").alias("parser"))
    for pattern, exact, parser, a, b in reversed(forms):
        start, end = bound(pattern, a), bound(pattern, b)
        good = sound(start) & sound(end) & (start.isNull() | end.isNull() | (start <= end))
        hit = F.struct(start.alias("start"), end.alias("end"), F.lit(exact).alias("precision"), F.lit(1.0).alias("confidence"), F.lit(parser).alias("parser"))
        known = F.when(s.rlike(pattern), F.when(good, hit).otherwise(unknown)).otherwise(known)
    return F.coalesce(known, unknown)


def model_year(c: str | Column) -> Column:
    """1 to 9998 in digits only; 9999 means unknown."""
    n = F.when(_c(c).rlike(r"^\d+$"), _c(c)).try_cast("int")
    return F.when(n.between(1, 9998), n)


def month_year(c: str | Column) -> Column:
    return F.substring(_c(c), 1, 4).try_cast("int")


def fitment_window(v_from: Column, v_to: Column, p_from: Column, p_to: Column) -> tuple[Column, Column]:
    """The months that two open-ended ranges share; greatest and least pass over nulls."""
    return F.greatest(v_from, p_from), F.least(v_to, p_to)


def ranges_overlap(a_from: Column, a_to: Column, b_from: Column, b_to: Column) -> Column:
    return reduce(lambda x, y: x & y, [a_from.isNull() | b_to.isNull() | (a_from <= b_to), b_from.isNull() | a_to.isNull() | (b_from <= a_to)])


def ordered(start: Column, end: Column) -> Column:
    return start.isNull() | end.isNull() | (start <= end)


def year_in(year: Column, first: Column, last: Column) -> Column:
    """Whether a year lies between open-ended months."""
    return (first.isNull() | (year >= month_year(first))) & (last.isNull() | (year <= month_year(last)))


def in_year_window(end: Column, years: int, today: Column | None = None) -> Column:
    """Production ended no more than `years` years ago; an unknown end passes."""
    floor = F.year(today if today is not None else F.current_date()) - years
    return month_year(end).isNull() | (month_year(end) >= floor)


def period_text(period: Column, year_from: Column, year_to: Column) -> Column:
    """A period as given, or made of the years."""
    made = F.concat(F.coalesce(year_from.cast("string"), F.lit("")), F.lit(" - "), F.coalesce(year_to.cast("string"), F.lit("")))
    return F.coalesce(F.nullif(F.trim(period), F.lit("")), F.when(year_from.isNotNull() | year_to.isNotNull(), F.trim(made)))


def precision(*bounds: Column) -> Column:
    return F.when(reduce(lambda a, b: a | b, [b.isNotNull() for b in bounds]), "month").otherwise("unknown")
