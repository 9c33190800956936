"""Scalar rules of the normaliser as Column expressions. All run in the JVM; none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOI_BASE = "https://doi.org/"
LANG_PATTERN = "^[a-z]{2}$"
YEAR_PATTERN = "^[0-9]{4}$"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _real_date(year: Column, month: Column, day: Column) -> Column:
    """Whether year 1 to 9999, month and day (integers) name a day of the calendar."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    in_range = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    return F.coalesce(in_range & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))


def normalize_date(text: Column) -> Column:
    """A date string at day precision, or null where it can't be read (null too for null).

    Of a time stamp or a period the first part counts. Ten or more characters must start with a real date. Seven or four
    characters are taken for a month or a year unchecked. Anything else is numbers between hyphens, missing ones 1, that must make a real
    date; its year is written as it is, without zeros before it.
    """
    part = F.when(F.instr(text, " ") > 0, F.split_part(text, F.lit(" "), F.lit(1))).when(F.instr(text, "/") > 0, F.split_part(text, F.lit("/"), F.lit(1))).otherwise(text)
    n = F.char_length(part)
    head = F.substring(part, 1, 10)
    numbers = F.split(part, "-")

    def number(i: int) -> Column:
        piece = F.get(numbers, F.lit(i))
        read = F.when(piece.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(piece).try_cast("int"))
        return read if i == 0 else F.when(F.size(numbers) > i, read).otherwise(F.lit(1))

    year, month, day = number(0), number(1), number(2)
    head_ok = head.rlike(DATE_PATTERN) & _real_date(*(F.substring(part, a, b).try_cast("int") for a, b in ((1, 4), (6, 2), (9, 2))))
    loose = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return (
        F.when(n >= 10, F.when(head_ok, head))
        .when(n == 7, F.concat(part, F.lit("-01")))
        .when(n == 4, F.concat(part, F.lit("-01-01")))
        .otherwise(F.when(_real_date(year, month, day), loose))
    )


def normalize_lang(text: Column) -> Column:
    """Language codes of more than two characters are cut to two."""
    return F.when(F.char_length(text) > 2, F.substring(text, 1, 2)).otherwise(text)


def make_id(doi: Column, url: Column) -> Column:
    """The DOI's address, else the url, else null."""
    return F.coalesce(F.concat(F.lit(DOI_BASE), doi), url)


def record_id(endpoint_id: Column, record_identifier: Column) -> Column:
    return F.concat(endpoint_id, F.lit("::"), record_identifier)


def format_timestamp(ts: Column, offset: str | None = None) -> Column:
    """Like 2025-01-31 10:00:00.000000+0000, in the session's time zone; with an offset, that one stands behind a time without a zone as it is."""
    if offset is not None:
        return F.concat(F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(offset))
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSSxx")


def percent_of(part: Column, total: Column, digits: int) -> Column:
    """part in percent of total; null where total is zero or null."""
    return F.when(total > 0, F.round(part * 100 / total, digits))


def terms(text: Column) -> Column:
    """Lower-cased words (letters and digits) of a text, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
