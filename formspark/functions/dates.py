"""Dates found in folder and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formspark.functions.text import strip

# Month words and the number each stands for.
MONTH_ABBREVIATIONS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
MONTH_WORDS = {
    **MONTH_ABBREVIATIONS,
    "january": 1, "february": 2, "march": 3, "april": 4, "june": 6, "july": 7,
    "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
}

# Patterns of the names that carry a date.
STRICT_FOLDER = r"^([A-Za-z]{3,})\s+(\d{1,2})\s+(\d{4})$"
FILE_NAME_DATE = r"^([A-Za-z]{3})(\d{1,2})[_\W]"
ISO_LIKE = r"(\d{4})[-_/]?(\d{1,2})[-_/](\d{1,2})\b"
MONTH_DAY = r"([A-Za-z]{3,9})\.?\s*[_ ]?(\d{1,2})(?:(?:st|nd|rd|th)?)[,_ ]*\s*(\d{4})?"


def _lookup(table: dict[str, int], key: Column) -> Column:
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def _date(year: Column, month: Column, day: Column) -> Column:
    """Year-month-day to a date; a part that is null or empty, or no real day, gives null."""
    text = F.concat(year, F.lit("-"), month.cast("string"), F.lit("-"), day)
    return F.try_to_date(text, "yyyy-M-d")


def _group(text: Column, pattern: str, index: int) -> Column:
    """A group of the pattern, empty where it does not match."""
    return F.regexp_extract(text, pattern, index)


def strict_folder_date(name: Column) -> Column:
    """``Nov 18 2025`` to a date; the month goes by its first three letters."""
    text = strip(name)
    month = _lookup(MONTH_ABBREVIATIONS, F.lower(F.substring(_group(text, STRICT_FOLDER, 1), 1, 3)))
    return _date(_group(text, STRICT_FOLDER, 3), month, _group(text, STRICT_FOLDER, 2))


def folder_date(name: Column, default: Column) -> Column:
    """Best-effort date of a folder name: ISO-like first, then month and day.

    A missing year is the default's year; what cannot be read is the default.
    """
    text = strip(name)
    iso = _date(*(_group(text, ISO_LIKE, i) for i in (1, 2, 3)))
    year = F.coalesce(F.nullif(_group(text, MONTH_DAY, 3), F.lit("")), F.year(default).cast("string"))
    month = _lookup(MONTH_WORDS, F.lower(_group(text, MONTH_DAY, 1)))
    return F.coalesce(iso, _date(year, month, _group(text, MONTH_DAY, 2)), default)


def file_name_month_day(name: Column) -> Column:
    """Leading ``Dec14_`` of a file name to ``struct<month, day>``, else null."""
    text = strip(name)
    month = _lookup(MONTH_ABBREVIATIONS, F.lower(_group(text, FILE_NAME_DATE, 1)))
    day = _group(text, FILE_NAME_DATE, 2).try_cast("int")
    return F.when(
        month.isNotNull() & day.between(1, 31),
        F.struct(month.alias("month"), day.alias("day")),
    )


def iso_date(value: Column) -> Column:
    """``yyyy-mm-dd`` text to a date, null when it is not one."""
    return F.try_to_date(value.cast("string"), "yyyy-MM-dd")
