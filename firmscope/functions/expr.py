"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space (ASCII blanks,
# the four separators, next line, no-break space and the Unicode Z class).
SPACE = r"[ \t\n\x0b\f\r\x1c-\x1f\x85\xa0\p{Z}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A plain Python variable would paste the expression into every place that
    uses it, and lambdas re-evaluate what is pasted into them.
    """
    return F.get(F.transform(F.array(value), lambda bound: body(bound)), F.lit(0))


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends (``trim`` drops blanks only)."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def collapse_space(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(text, rf"{SPACE}+", " ")


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def first(items: Column) -> Column:
    """First element, null when the array is empty."""
    return F.get(items, F.lit(0))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def holds_any(text: Column, words: list[str] | tuple[str, ...]) -> Column:
    """Whether any of the words is part of the text; much cheaper than a pattern."""
    return reduce(or_, [text.contains(word) for word in words])


def any_of(words: list[str] | tuple[str, ...]) -> str:
    """Regular expression that matches any of the words as plain text."""
    return "|".join(_plain(word) for word in words)


def _plain(word: str) -> str:
    return "".join("\\" + c if c in r".$|()[]{}*+?^\\" else c for c in word)
