"""Windows of words, parted by minimiser into packed runs (super-k-mers)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from rillcast.llm.words import spread

# Words that make one candidate for the minimiser of a window.
MINIMISER_WORDS = 4
# Windows that one packed run holds at most; periodic texts share a minimiser for ever.
RUN_WINDOWS = 32
BLANK = pa.scalar(" ", pa.large_string())


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Bounds of every text's words, code of every word, and the distinct words."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat = lists.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return np.concatenate([[0], np.cumsum(full)])[offsets], coded.indices.to_numpy(), coded.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of 64 spread over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_runs(values: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit digest of every ``size`` neighbours (the order counts)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + values[k : k + n]
    return mixed(h)


def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` neighbours, by doubling."""
    if len(values) < size:
        return values[:0]
    now, width = values, 1
    while 2 * width <= size:
        now = np.minimum(now[:-width], now[width:])
        width *= 2
    rest = size - width
    return np.minimum(now[: len(now) - rest], now[rest:]) if rest else now


def super_kmers(bounds: np.ndarray, codes: np.ndarray, words: pa.Array, size: int):
    """Packed runs of a batch of texts: (text, first word, number of windows, minimiser).

    A window's minimiser is the least digest of the ``MINIMISER_WORDS``-word
    sequences in it, so equal windows have equal minimisers wherever they are.
    Neighbouring windows of one text with the same minimiser are one run.
    """
    small = min(MINIMISER_WORDS, size)
    digests = np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))
    least = sliding_least(hashed_runs(digests[codes], small), size - small + 1)
    n_windows = np.maximum(np.diff(bounds) - size + 1, 0)
    at = spread(bounds[:-1], n_windows)
    text = np.repeat(np.arange(len(n_windows)), n_windows)
    mini = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (mini[1:] != mini[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    inside = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(inside % RUN_WINDOWS == 0)
    windows = np.diff(np.append(first, len(at)))
    return text[first], at[first] - bounds[text[first]], windows, mini[first].view(np.int64)


def packed(bounds: np.ndarray, codes: np.ndarray, words: pa.Array, text: np.ndarray, start: np.ndarray, windows: np.ndarray, size: int) -> pa.Array:
    """The runs' words, joined by blanks."""
    n = windows + size - 1
    taken = words.take(pa.array(codes[spread(bounds[text] + start, n)]))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int64()), taken), BLANK)


def same_windows(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Group number of the window of ``size`` codes at every place, equal for equal windows only.

    Windows are sorted by digest; neighbours of equal digest are compared word
    by word, and should two windows share a digest all are sorted by their words.
    """
    digest = hashed_runs(mixed(codes.astype(np.uint64) + np.uint64(1)), size)[at]
    order = np.argsort(digest, kind="stable")
    near = np.flatnonzero(digest[order][1:] == digest[order][:-1])
    for k in range(size):
        if (codes[at[order[near]] + k] != codes[at[order[near + 1]] + k]).any():
            rows = codes[at[:, None] + np.arange(size)]
            return np.unique(rows, axis=0, return_inverse=True)[1].ravel()
    group = np.empty(len(at), np.int64)
    group[order] = np.cumsum(np.concatenate([[0], digest[order][1:] != digest[order][:-1]]))
    return group


def later_windows(texts: pa.Array, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, place in it) of every window of packed runs that a run of a smaller owner holds too."""
    bounds, codes, _ = split_words(texts)
    n = np.diff(bounds) - size + 1
    at = spread(bounds[:-1], n)
    run = np.repeat(np.arange(len(n)), n)
    if not len(at):
        return run, at
    group = same_windows(codes, at, size)
    least = np.full(group.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, owner[run])
    late = np.flatnonzero(least[group] < owner[run])
    return run[late], at[late] - bounds[run[late]]
