"""Dates and years as they are printed in legal notes; strings in, strings or integers out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import extract, extract_all

#: Fixed abbreviations of months in calendar order.
SHORT_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
NAMED_DATE = r"\b(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z\.]*\s+(\d{1,2}),\s+(\d{4})\b"
SLASHED = r"(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})"


def iso_date(c: Column) -> Column:
    """X-31: the first `Mon D, YYYY` as YYYY-MM-DD, empty if none; the day is not validated."""
    month = F.array_position(F.array(*map(F.lit, SHORT_MONTHS)), F.left(F.regexp_extract(c, NAMED_DATE, 1), F.lit(3)))
    out = F.concat_ws("-", F.regexp_extract(c, NAMED_DATE, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(c, NAMED_DATE, 2), 2, "0"))
    return F.when(c.rlike(NAMED_DATE), out).otherwise(F.lit(""))


def four_digits(year: Column, pivot: int) -> Column:
    """A two-digit year: up to pivot in this century, above it in the last."""
    return F.when(F.length(year) == 2, F.concat(F.when(year.cast("int") > pivot, F.lit("19")).otherwise(F.lit("20")), year)).otherwise(year)


def dashed_date(c: Column, pivot: int = 30) -> Column:
    """X-32: M/D/YY or M-D-YY as MM-DD-YYYY; anything else as it is, with dashes."""
    d = F.replace(c, F.lit("/"), F.lit("-"))
    p = F.split(d, "-")
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return F.when(F.size(p) == 3, F.concat_ws("-", two(p[0]), two(p[1]), four_digits(p[2], pivot))).otherwise(d)


def slashed_dates(c: Column, pivot: int = 49) -> Column:
    """X-33: all M/D/Y dates as MM/DD/YYYY in order."""
    month, day, year = (extract_all(c, SLASHED, g) for g in (1, 2, 3))
    each = F.arrays_zip(month.alias("m"), day.alias("d"), year.alias("y"))
    return F.transform(each, lambda x: F.concat_ws("/", F.lpad(x["m"].cast("int").cast("string"), 2, "0"), F.lpad(x["d"].cast("int").cast("string"), 2, "0"), four_digits(x["y"], pivot)))


def last_date(c: Column, pivot: int = 49) -> Column:
    return F.coalesce(F.try_element_at(slashed_dates(c, pivot), F.lit(-1)), F.lit(""))


def trailing_year(c: Column) -> Column:
    """X-34."""
    return extract(c, r"(\d{4})$").cast("int")


def clamped_year(year: Column, edition: Column | int = 2100, first: int = 1789) -> Column:
    """X-35: null outside [first, edition]."""
    return F.when((year >= first) & (year <= edition), year)


def month_days(year: Column, month: Column) -> Column:
    """X-36."""
    return F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))


def latest_named(dates: Column) -> Column:
    """A-21: of `Month D, YYYY` strings the latest; the first of equals; unreadable ones lowest."""
    ranked = F.transform(dates, lambda d, i: F.struct(F.coalesce(F.try_to_date(d, "MMMM d, yyyy"), F.lit("0001-01-01").cast("date")).alias("at"), (-i).alias("i"), d.alias("d")))
    return F.coalesce(F.array_max(ranked)["d"], F.lit(""))


def current_and_prior(dates: Column, latest: str = "last") -> Column:
    """W-04: struct(current, prior) of an ordered list whose last or first entry is the current one."""
    n = F.size(dates)
    if latest == "last":
        current, prior = F.try_element_at(dates, F.lit(-1)), F.slice(dates, F.lit(1), F.greatest(n - 1, F.lit(0)))
    else:
        current, prior = F.get(dates, F.lit(0)), F.slice(dates, F.lit(2), F.greatest(n - 1, F.lit(0)))
    return F.struct(F.coalesce(current, F.lit("")).alias("current"), prior.alias("prior"))


def action_code(c: Column) -> Column:
    """X-38: the action of an administrative history note, in capitals."""
    return F.upper(F.regexp_extract(c, r"(?i)NMAC\s*-\s*(N(?:/E)?|A(?:/E)?|Rp|Rn|R|REC|RC)\b", 1))


def roman(c: Column) -> Column:
    """X-39: the roman numeral after a level's name."""
    return F.upper(F.regexp_extract(c, r"(?i)\b(?:title|part|chapter)\s+([IVXLCDM]+)\b", 1))
