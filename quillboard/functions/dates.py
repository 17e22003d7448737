"""Column expressions over dates as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: English months in order.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_NAME = "(?:" + "|".join(MONTHS) + ")"
_MONTH, _DAY = r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
#: The fullest reading of a place first: ISO day or month, day and month in either order with a year, month and year, year.
DATE = rf"\b\d{{4}}-{_MONTH}(?:-{_DAY})?\b(?!-)|\b{_NAME} \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}\b|\b\d{{1,2}}(?:st|nd|rd|th)? {_NAME},? \d{{4}}\b|\b{_NAME} \d{{4}}\b|(?<![\d-])(?:19|20)\d{{2}}(?![\d-])"


def _day(value: Column, form: str) -> Column:
    return F.try_to_timestamp(value, F.lit(form)).cast("date")


def stated_deadline(value: Column) -> tuple[Column, Column]:
    """Last day of a stated year, month or day, and whether it is ok, missing or malformed."""
    v = F.trim(value)
    day = F.when(v.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), _day(v, "yyyy-M-d")).when(v.rlike(r"^\d{4}-\d{1,2}$"), F.last_day(_day(v, "yyyy-M"))).when(v.rlike(r"^\d{4}$"), F.add_months(_day(v, "yyyy"), 12) - F.expr("interval 1 day"))
    day = day.cast("date")
    return day, F.when(F.coalesce(value, F.lit("")) == "", "missing").when(day.isNull(), "malformed").otherwise("ok")


def dates_in(text: Column) -> Column:
    """The dates that a text names, in order and without overlap, as they stand."""
    return F.regexp_extract_all(text, F.lit(f"(?i)({DATE})"), 1)


def date_parts(found: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of one of dates_in; what is not named is null."""
    whole = lambda c: F.when(c != "", c.cast("int"))
    name = F.initcap(F.regexp_extract(found, f"(?i)({_NAME})", 1))
    month = F.coalesce(whole(F.regexp_extract(found, r"^\d{4}-(\d{2})", 1)), F.when(name != "", F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("int")))
    day = F.coalesce(whole(F.regexp_extract(found, r"^\d{4}-\d{2}-(\d{2})", 1)), whole(F.regexp_extract(found, r"^(\d{1,2})(?:st|nd|rd|th)? \D", 1)), whole(F.regexp_extract(found, r"^\D+ (\d{1,2})(?:st|nd|rd|th)?,? \d{4}$", 1)))
    return F.regexp_extract(found, r"(\d{4})(?:-|$)", 1).cast("int"), month, day


def criterion_deadline(text: Column) -> Column:
    """(year, month, day) that a criterion closes on: the date right behind a "by", else the latest that it names; null without one."""
    by = F.nullif(F.regexp_extract(text, rf"(?i)\bby\s+(?:the\s+end\s+of\s+)?.{{0,3}}?({DATE})", 1), F.lit(""))

    def parts(found: Column) -> Column:
        year, month, day = date_parts(found)
        return F.struct(year.alias("year"), month.alias("month"), day.alias("day"))

    return F.when(by.isNotNull(), parts(by)).otherwise(F.array_max(F.transform(dates_in(text), parts)))
