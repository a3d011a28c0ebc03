"""Quality rules as one projection (operator 3); Spark's own functions only."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.llm.text_columns import SPACES, bound, spaced_words, whole

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for with on as was are be this by from at or an have not they which "
    "der die das und zu den von mit ein eine ist im dem nicht des auf sich auch es "
    "le la les et un une du en que qui dans est pour pas par sur au ce il "
    "el los las y se una por con para del lo como su al"
).split()


class Threshold(NamedTuple):
    """A ratio's allowed range, judged where the denominator is at least ``least``."""

    name: str
    over: str
    under: str
    low: float | None
    high: float | None
    least: int = 1


THRESHOLDS = (
    Threshold("word_length", "word_chars", "n_words", 2.0, 12.0),
    Threshold("symbols", "n_symbols", "n_words", None, 0.1),
    Threshold("stop_words", "n_stop_words", "n_words", 0.02, None, least=40),
    Threshold("repeated_lines", "n_dup_lines", "n_lines", None, 0.4, least=5),
)


def repeated_words(w: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text.

    A text without two equal windows costs a hash set; only others sort their
    windows, find neighbours that are equal and measure the words they cover.
    """

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def cover(p: Column) -> Column:
            again = F.filter(p, lambda e, k: (F.get(p, k - 1)["x"] == e["x"]) | (F.get(p, k + 1)["x"] == e["x"]))
            places = F.sort_array(F.transform(again, lambda e: e["i"]))
            start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
            step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"))
            return F.aggregate(places, start, step, lambda a: a["n"])

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bound(placed, cover))

    def windows_of(h: Column) -> Column:
        window = lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), window)

    hashed = F.transform(w, lambda x: F.xxhash64(x))
    found = bound(bound(hashed, windows_of), covered)
    return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(found)


def characters(text: Column, kinds: str) -> Column:
    return F.length(text) - F.length(F.translate(text, kinds, ""))


def rules(text: Column, table: Sequence[Threshold] = THRESHOLDS) -> Column:
    """Struct of counts, base_failed, failed (names of broken thresholds) and kept."""

    def of_words(w: Column) -> Column:
        stop = sorted({v for s in STOP_WORDS for v in (s, s.capitalize(), s.upper())})
        return F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    def of_text(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
        return F.struct(
            bound(spaced_words(t), of_words).alias("w"), bound(lines, of_lines).alias("l"),
            (F.length(t) - characters(t, SPACES)).cast("long").alias("word_chars"), characters(t, SYMBOLS).cast("long").alias("n_symbols"),
        )

    def verdict(c: Column) -> Column:
        counts = {
            "n_words": c["w"]["n_words"], "word_chars": c["word_chars"], "n_symbols": c["n_symbols"], "n_dup_lines": c["l"]["n_dup_lines"],
            "n_repeat_words": c["w"]["n_repeat_words"], "n_stop_words": c["w"]["n_stop_words"], "n_lines": c["l"]["n_lines"],
        }
        failed = F.array(*(F.when(broken(r, counts), F.lit(r.name)) for r in table)) if table else F.array().cast("array<string>")
        base = (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])

        def named(f: Column) -> Column:
            return F.struct(*(v.alias(k) for k, v in counts.items()), base.alias("base_failed"), f.alias("failed"), (~base & (F.size(f) == 0)).alias("kept"))

        return bound(F.array_compact(failed), named)

    return bound(bound(whole(text), of_text), verdict)


def broken(rule: Threshold, counts: dict[str, Column]) -> Column:
    """Whether a ratio leaves its range; compared by products, so nothing is divided."""
    over, under = counts[rule.over], counts[rule.under]
    out = F.lit(False)
    if rule.low is not None:
        out = out | (over < rule.low * under)
    if rule.high is not None:
        out = out | (over > rule.high * under)
    return (under >= rule.least) & out


def quality_rules(docs: DataFrame, table: Sequence[Threshold] = THRESHOLDS, name: str = "quality") -> DataFrame:
    """Documents with a struct column ``name``: counts, base_failed, failed and kept.

    The table is compiled into one projection; nothing is shuffled. Words are
    what stands between ASCII white space, lines what stands between line
    feeds. Null and blank texts have no words and fail the base rule. Every
    row keeps its columns, only one called ``name`` is replaced; repeated rows
    and null ids are judged like others.
    """
    return docs.withColumn(name, rules(F.col("text"), table))


def kept_documents(docs: DataFrame, table: Sequence[Threshold] = THRESHOLDS) -> DataFrame:
    """The documents that pass, with their columns."""
    return docs.where(rules(F.col("text"), table)["kept"])
