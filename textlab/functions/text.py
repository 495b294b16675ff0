"""Text expressions. Every function takes and returns a Column and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and the pattern of the quality flags.
LONG_TEXT_CHARS = 1000
FRAGMENT_CHARS = 20
TABLE_PATTERN = r"\d+\s+\d+\s+\d+"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def char_count(text: Column | str) -> Column:
    """Length in code points."""
    return F.length(_column(text))


def word_count(text: Column | str) -> Column:
    """Pieces after splitting on every single space, empty pieces included: one more than the spaces."""
    c = _column(text)
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + F.lit(1)


def avg_word_length(text: Column | str) -> Column:
    """Characters (spaces included) per word."""
    c = _column(text)
    return F.try_divide(char_count(c).cast("double"), word_count(c).cast("double"))


def estimated_tokens(text: Column | str, unicode: bool = True) -> Column:
    """Number of runs of non-blank characters."""
    pattern = r"(?U)[^\s\x1c-\x1f]+" if unicode else r"\S+"
    return F.regexp_count(_column(text), F.lit(pattern))


def is_long_text(text: Column | str) -> Column:
    return char_count(text) > LONG_TEXT_CHARS


def is_fragment(text: Column | str) -> Column:
    return char_count(text) < FRAGMENT_CHARS


def likely_table(text: Column | str, unicode: bool = False) -> Column:
    """Three numbers in a row, of ASCII digits and blanks; with ``unicode`` of any."""
    return _column(text).rlike(("(?U)" if unicode else "") + TABLE_PATTERN)


def preview(text: Column | str, n: int = 200, always: bool = False) -> Column:
    """First ``n`` characters with an ellipsis; without ``always`` only when something was cut."""
    c = _column(text)
    cut = F.concat(F.substring(c, 1, n), F.lit("..."))
    return cut if always else F.when(F.length(c) > n, cut).otherwise(c)


def pretty_name(name: Column | str) -> Column:
    """``free_sulfur_dioxide`` becomes ``Free Sulfur Dioxide``."""
    return F.initcap(F.replace(_column(name), F.lit("_"), F.lit(" ")))
