"""Choosing and cleaning the main text of a record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cleaning patterns, removed label and minimum length.
CITATION = r"\[\s*\d+(?:-\d+)?\s*\]"
WHITESPACE_RUN = r"\s{2,}"
LABEL = "Abstract"
MIN_CHARS = 50


def preferred_text(content: Column, contents: Column, min_chars: int = MIN_CHARS) -> Column:
    """``content`` where it is longer than ``min_chars`` (untrimmed), else ``contents``."""
    usable = content.isNotNull() & (F.length(content) > min_chars)
    return F.when(usable, content).otherwise(contents)


def is_long_enough(text: Column, min_chars: int = MIN_CHARS) -> Column:
    return text.isNotNull() & (F.length(F.trim(text)) > min_chars)


def strip_citations(text: Column) -> Column:
    """``[1]`` and ``[ 2-3 ]`` become one space; lists such as ``[4, 5]`` stay."""
    return F.regexp_replace(text, CITATION, " ")


def squeeze_whitespace(text: Column) -> Column:
    """Runs of two or more whitespace characters become one space; a lone newline stays."""
    return F.regexp_replace(text, WHITESPACE_RUN, " ")


def strip_label(text: Column, label: str = LABEL) -> Column:
    """Remove a literal wherever it occurs, also inside longer words."""
    return F.replace(text, F.lit(label), F.lit(""))


def clean_text(text: Column) -> Column:
    """The cleaning steps in their fixed order.

    The label goes after the whitespace squeeze, so it can leave a double space
    behind; the empty tokens this makes are part of the result.
    """
    return F.trim(strip_label(squeeze_whitespace(strip_citations(text))))
