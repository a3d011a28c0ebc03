"""Token counts of texts (operator 5)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
LONG_BYTES = 4 << 20
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def pieces(text: str, size: int) -> Iterator[str]:
    """Cut a long text just before white space, where no token reaches across; a run without any stays whole."""
    at = 0
    while len(text) - at > size:
        cut = next((i for i in range(at + size, len(text)) if text[i] in " \t\n\v\f\r"), len(text))
        yield text[at:cut]
        at = cut
    if at < len(text) or not text:
        yield text[at:]


def balanced(batches: Iterable[pa.RecordBatch], batch_bytes: int):
    """Rows, texts and byte lengths, put together up to about ``batch_bytes``; a longer text comes alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        at = 0
        while at < len(lengths):
            n = int(np.searchsorted(np.cumsum(lengths[at:]), batch_bytes - size, side="right"))
            if n:
                held.append(batch.slice(at, n))
                size += int(lengths[at : at + n].sum())
                at += n
            if at < len(lengths):
                if held:
                    yield together(held)
                    held, size = [], 0
                elif n == 0:
                    yield together([batch.slice(at, 1)])
                    at += 1
    if held:
        yield together(held)


def together(batches: list[pa.RecordBatch]):
    table = pa.Table.from_batches(batches).combine_chunks()
    texts = table.column("text").cast(pa.large_string()).combine_chunks().fill_null("")
    return table.column("doc_id").combine_chunks().cast(pa.int64()), texts, pc.binary_length(texts).to_numpy()


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 2048,
    batch_bytes: int = BATCH_BYTES,
    long_bytes: int = LONG_BYTES,
) -> DataFrame:
    """Bytes and tokens of every whole text, without added special ids; ``over_limit`` above ``limit`` tokens.

    ``path`` names a tokenizers file (.json) or a sentencepiece model (.model).
    The texts never leave the Arrow function: it returns lengths only. Rows
    are taken together up to ``batch_bytes``; a text above ``long_bytes`` is
    counted piece by piece, cut before white space. A model that keeps white
    space gets whole texts instead, since there a cut could change ids.

    Null counts as the empty text (0 bytes, 0 tokens). Every row gives a row,
    repeated and null doc_ids included; other columns are ignored.
    """

    def count(batches):
        counts = counter(path)
        for doc_ids, texts, lengths in balanced(batches, batch_bytes):
            if len(texts) == 1 and lengths[0] > long_bytes and path.endswith(".json"):
                tokens = np.array([sum(int(counts(pa.array([p]))[0]) for p in pieces(texts[0].as_py(), long_bytes))])
            else:
                tokens = counts(texts)
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(lengths, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, SCHEMA)


def counter(path: str):
    """Function from an array of texts to their numbers of tokens."""
    if path.endswith(".json"):
        from rillcast.llm.words import WordEncoder

        return WordEncoder(path).counts
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(texts: pa.Array) -> np.ndarray:
        coded = model.encode(texts.fill_null("").to_pylist(), num_threads=1)
        return np.fromiter(map(len, coded), np.int64, len(coded))

    return counts
