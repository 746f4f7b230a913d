"""Descriptions and keywords from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def readme_description(text: Column) -> Column:
    """First line with whitespace that is no heading: trimmed, lower first letter, no final dot."""
    lines = F.filter(
        F.split(text, "\n"),
        lambda line: line.rlike(r"\s") & ~line.rlike(r"^\s*#"),
    )
    line = F.regexp_replace(F.get(lines, 0), r"^\s+|\s+$", "")
    lowered = F.concat(F.lower(F.substring(line, 1, 1)), F.substring(line, F.lit(2), F.length(line)))
    return F.regexp_replace(lowered, r"\.$", "")


def split_keywords(value: Column) -> Column:
    """Keywords separated by whitespace or commas, empties dropped."""
    return F.filter(F.split(value, r"[\s,]+"), lambda word: word != "")


def tokens(text: Column) -> Column:
    """Distinct lower-case words (runs of letters, digits and underscores) of a text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+")
    return F.array_distinct(F.filter(words, lambda word: word != ""))
