"""Column expressions on texts, all Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it, also inside inner functions."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def spaced_words(text: Column) -> Column:
    """Words between ASCII white space (space, tab to carriage return); none for null."""
    bare = F.btrim(whole(text), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+"))


def small_letters(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(whole(text), CAPITALS, CAPITALS.lower())
