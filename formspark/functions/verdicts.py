"""Verdict tokens of the language and content gates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formspark.functions.text import strip

# What a content token means.
CONTENT_ISSUES = {
    "UNREADABLE": "Gemini could not read the page content",
    "BLANK": "The PDF is empty - there's no data to process",
}
# What a decline token means.
DECLINE_MARKINGS = {"DECLINED_WORD": "WORD", "DECLINED_SCRIBBLE": "SCRIBBLE"}


def _map(table: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def language_ok(verdict: Column, generic: bool = False) -> Column:
    """True only for the accepting token; anything else, null too, is not accepted."""
    wanted = "MATCH" if generic else "ENGLISH"
    return F.coalesce(F.upper(strip(verdict)) == wanted, F.lit(False))


def language_note(verdict: Column, language: str = "English", generic: bool = False) -> Column:
    note = f"The survey appears to be written in a language other than {language}"
    return F.when(~language_ok(verdict, generic), F.lit(note))


def content_verdict(verdict: Column) -> Column:
    """``struct<content_issue, decline_marking>``; an unknown token is no issue."""
    words = F.split(F.upper(strip(verdict)), r"\s+")
    return F.struct(
        _map(CONTENT_ISSUES, F.get(words, 0)).alias("content_issue"),
        _map(DECLINE_MARKINGS, F.get(words, 1)).alias("decline_marking"),
    )
