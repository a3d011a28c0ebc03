"""Encode texts with the tokenizers library, each distinct word once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words handed to the library in one string, parted by a control character that none of them holds.
JOINED = 128
MARK = "\x01"


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of many runs, one after another: start, start + 1, ... for every run."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class WordTable:
    """Ids of words, kept one after another; subclasses learn new words.

    The words known so far are kept between batches up to ``keep_words`` words
    or ``keep_ids`` ids; that bounds memory, not results.
    """

    def __init__(self, keep_words: int, keep_ids: int):
        self.keep_words, self.keep_ids = keep_words, keep_ids
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.empty(1 << 14, np.int64)
        self.lengths = np.empty(1 << 14, np.int64)
        self.used = 0

    def trim(self) -> None:
        if len(self.known) > self.keep_words or self.used > self.keep_ids:
            self.clear()

    def learn(self, words: list[str]) -> None:
        raise NotImplementedError

    def add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.known)
        self.ids = grown(self.ids, self.used + len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts = grown(self.starts, first + len(words))
        self.lengths = grown(self.lengths, first + len(words))
        self.starts[first : first + len(words)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(words)] = lengths
        self.used += len(ids)
        self.known.update(zip(words, range(first, first + len(words))))

    def indexes(self, words: list[str]) -> np.ndarray:
        """Numbers of words (without repeats), learnt first where they are new."""
        known = self.known
        if new := [w for w in words if w not in known]:
            self.learn(new)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.empty(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


def by_list(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of every list."""
    ends = np.concatenate([[0], np.cumsum(values)])
    return ends[offsets[1:]] - ends[offsets[:-1]]


class WordEncoder(WordTable):
    """Token ids of whole texts for a tokenizer that drops white space and lower-cases.

    Such a tokenizer never joins what white space parts, so a text is cut at
    ASCII white space, every distinct word is encoded once, and ids or lengths
    are gathered by word. Null counts as the empty text; special strings
    inside texts become special ids, as the library does by default.
    """

    def __init__(self, path: str, keep_words: int = 600_000, keep_ids: int = 8_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        if self._ids("A b") != self._ids("a") + self._ids("  b\n"):
            raise ValueError("the tokenizer keeps white space or case: its texts can't be cut into words")
        (self.mark,) = self._ids(MARK)
        super().__init__(keep_words, keep_ids)

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        super().clear()
        self.tails = self.indexes([".", ","])

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if MARK not in w and "<|" not in w]
        for at in range(0, len(plain), 1 << 16):
            part = plain[at : at + (1 << 16)]
            joined = [f" {MARK} ".join(part[i : i + JOINED]) + f" {MARK}" for i in range(0, len(part), JOINED)]
            coded = self.library.encode_batch_fast(joined, add_special_tokens=False)
            flat = np.concatenate([np.array(c.ids, np.uint32) for c in coded])
            marks = np.flatnonzero(flat == self.mark)
            self.add(part, np.delete(flat, marks), np.diff(marks, prepend=-1) - 1)
        for word in words:
            if MARK in word or "<|" in word:
                ids = self._ids(word)
                self.add([word], np.array(ids, np.uint32), np.array([len(ids)]))

    def _look_up(self, texts: pa.Array):
        """(bounds of the texts' words, word by position, stem by word, tail or -1 by word)."""
        self.trim()
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = lists.flatten().dictionary_encode()
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        raw = coded.dictionary
        # Special strings are matched before lower-casing; all other words may be lower-cased first.
        low = pc.if_else(pc.match_substring(raw, "<|"), raw, pc.ascii_lower(raw))
        # A full stop or comma behind a letter is a token of its own.
        tailed = pc.match_substring_regex(low, "^[^<]*[a-z][.,]$")
        stems = pc.if_else(tailed, pc.utf8_slice_codeunits(low, 0, -1), low).dictionary_encode()
        dot = pc.ends_with(low, ".").to_numpy(zero_copy_only=False)
        stem = self.indexes(stems.dictionary.to_pylist())[stems.indices.to_numpy()] if len(raw) else np.empty(0, np.int64)
        tail = np.where(tailed.to_numpy(zero_copy_only=False), np.where(dot, self.tails[0], self.tails[1]), -1)
        return offsets, coded.indices.to_numpy(), stem, tail

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of every text."""
        offsets, codes, stem, tail = self._look_up(texts)
        by_word = self.lengths[stem] + np.where(tail >= 0, self.lengths[tail], 0)
        return by_list(offsets, by_word[codes])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids of every text."""
        offsets, codes, stem, tail = self._look_up(texts)
        parts = np.stack([stem, np.maximum(tail, 0)], axis=1).ravel()
        lengths = self.lengths[parts].reshape(-1, 2)
        lengths[tail < 0, 1] = 0
        by_word = lengths.sum(axis=1)
        words = self.ids[spread(self.starts[parts], lengths.ravel())]
        n = by_word[codes]
        return words[spread((np.cumsum(by_word) - by_word)[codes], n)], by_list(offsets, n)
