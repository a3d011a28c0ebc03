"""Fill-in-the-middle transformation of texts (operator 11)."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.llm.boundary_sets import BoundarySet
from rillcast.llm.token_counts import balanced

# Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
BATCH_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def text_boundaries(texts: pa.LargeStringArray) -> Iterator[np.ndarray]:
    """Per text the offsets (code points) of 0 and of every token's end.

    A token is a run of white space and the word behind it, or white space at
    the end of the text; found for all texts at once on their bytes.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    space = SPACE[data]
    ends = np.zeros(len(data), bool)
    ends[:-1] = ~space[:-1] & space[1:]
    ends[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    places = np.flatnonzero(ends)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = np.searchsorted(places, offsets)
    for a, b, start in zip(bounds[:-1].tolist(), bounds[1:].tolist(), offsets.tolist()):
        yield np.concatenate([[0], chars[places[a:b] + 1] - chars[start]])


def check_marks(marks: Sequence[str]) -> None:
    """Marks must be told apart wherever they stand: none lies in another, none ends as another begins."""
    for a in marks:
        for b in marks:
            if not a or (a is not b and a in b) or any(b.startswith(a[k:]) for k in range(1, len(a))):
                raise ValueError("marks overlap each other")


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers drawn for a document, by digest of seed and id."""
    text = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(text[8 * i : 8 * i + 8], 16) for i in range(4)]


def boundary_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n (tokens) and bounds (binary) of every whole text: what later draws of cuts need, without the texts."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts, _ in balanced(batches, BATCH_BYTES):
            sets = [BoundarySet.of(b) for b in text_boundaries(texts)]
            columns = [doc_ids, pa.array([len(s) - 1 for s in sets], pa.int64()), pa.array([s.to_bytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "bounds"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, bounds binary")


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, marks: Sequence[str] = MARKS) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of every whole text.

    Two cuts among the n + 1 token boundaries part a text into prefix, middle
    and suffix; the form (plain, psm or spm) and the cuts are drawn by the
    digest of ``seed`` and doc_id, so a lost task repeats them. Texts that are
    empty or hold a mark stay plain, with null lengths.

    Null counts as the empty text, a null doc_id draws as an empty one; every
    row gives a row; other columns are ignored. A task holds about
    ``BATCH_BYTES`` of text (a longer text comes alone).
    """
    check_marks(marks)
    p_mark, s_mark, m_mark = marks

    def run(batches) -> Iterator[pa.RecordBatch]:
        for doc_ids, texts, _ in balanced(batches, BATCH_BYTES):
            made = []
            for doc_id, text, bounds in zip(doc_ids.to_pylist(), texts.to_pylist(), text_boundaries(texts)):
                cuts = BoundarySet.of(bounds)
                n = len(cuts) - 1
                h1, h2, h3, h4 = draws(doc_id, seed)
                if not text or any(m in text for m in marks) or h3 % 100 >= percent:
                    made.append((doc_id, n, "plain", None, None, text))
                    continue
                a, b = (cuts.select(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                if h4 % 100 < spm_percent:
                    made.append((doc_id, n, "spm", a, b - a, f"{s_mark}{suffix}{p_mark}{prefix}{m_mark}{middle}"))
                else:
                    made.append((doc_id, n, "psm", a, b - a, f"{p_mark}{prefix}{s_mark}{suffix}{m_mark}{middle}"))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*made), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks))
    order = F.when(form == "psm", F.array(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
    order = order.otherwise(F.array(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
    return F.when(form == "plain", output).otherwise(F.array_join(order, ""))
