"""Pair-merge pieces as the sentencepiece library gives them (operator 4), in vectorised merge rounds.

The model file is read with the library (pieces, scores, kinds); texts are
encoded and decoded here. A text's symbols are its code points behind a word
mark, with blanks turned into word marks. No piece holds a mark behind another
symbol, so a text falls apart into words (a run of marks and what follows) that
are merged independently, each distinct one once.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.llm.token_counts import balanced
from rillcast.llm.words import WordTable, by_list, spread

MARK = "▁"
NONE = np.iinfo(np.int32).max
CODE_POINTS = 0x110000
# Words merged together, and bytes of text encoded together: both bound a task's memory, not results.
ROUND_WORDS = 1 << 14
PIECE_BATCH_BYTES = 1 << 20


class PieceModel:
    """Tables of a pair-merge model with byte fallback: symbols, mergeable pairs, bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = library.get_piece_size()
        pieces = [library.id_to_piece(i) for i in range(n)]
        self.control = np.array([library.is_control(i) for i in range(n)])
        self.is_byte = np.array([library.is_byte(i) for i in range(n)])
        self.unknown = library.unk_id()
        normal = {p: i for i, p in enumerate(pieces) if not (self.control[i] or self.is_byte[i] or library.is_unknown(i))}
        checks = (
            any(library.is_unused(i) for i in range(n)), self.is_byte.sum() != 256, library.normalize(" ａ  b\t") != f"{MARK}{MARK}ａ{MARK}{MARK}b\t",
            any(re.search(f"[^{MARK}]{MARK}", p) for p in normal), any(c not in normal for p in normal for c in p if len(p) > 1),
        )
        if any(checks):
            raise ValueError("only pair-merge models with byte fallback, a dummy prefix and no normalising are read")
        self.byte_ids = np.empty(256, np.int64)
        for i in np.flatnonzero(self.is_byte):
            self.byte_ids[int(pieces[i][3:-1], 16)] = i
        # Symbols that are no piece keep a number of their own behind the pieces' ids.
        self.symbols = np.arange(CODE_POINTS, dtype=np.int64) + n
        for p, i in normal.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        # Equal scores share a rank: among them the library takes the leftmost pair.
        ranks = {s: r for r, s in enumerate(sorted({library.get_score(i) for i in normal.values()}, reverse=True))}
        pairs = sorted(
            (normal[p[:k]] * n + normal[p[k:]], ranks[library.get_score(i)], i)
            for p, i in normal.items() for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal
        )
        self.keys, self.ranks, self.merged = (np.array(c, t) for c, t in zip(zip(*pairs), (np.int64, np.int32, np.int64)))
        data = [b"" if self.control[i] else " ⁇ ".encode() if i == self.unknown else bytes([int(p[3:-1], 16)]) if self.is_byte[i] else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.data_lengths = np.array([len(d) for d in data])
        self.data_starts = np.cumsum(self.data_lengths) - self.data_lengths
        self.marked = np.array([p.startswith(MARK) for p in pieces])

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols; rank NONE where they don't merge."""
        keys = np.where((left < self.size) & (right < self.size), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], NONE), self.merged[at]


def merge_rounds(model: PieceModel, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all words (given flat, with their lengths, none empty); returns flat symbols and new lengths.

    Each round finds every word's lowest pair rank, merges the leftmost
    non-overlapping pairs of that rank at once and closes up the arrays; words
    without a pair leave. Merging at once equals merging one by one unless a
    merge makes a pair that is due no later than the others of its round:
    such a word leaves and is merged one by one.
    """
    words = len(lengths)
    word = np.repeat(np.arange(words), lengths)
    done_symbols, done_words, careful = [], [], []
    original, starts, symbols = symbols, np.cumsum(lengths) - lengths, symbols.copy()

    def ranks_of(symbols, word):
        out = np.full(len(symbols), NONE, np.int32)
        out[:-1] = np.where(word[:-1] == word[1:], model.find(symbols[:-1], symbols[1:])[0], NONE)
        return out

    rank = ranks_of(symbols, word)
    while len(symbols):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.append(first, len(word)))
        least = np.minimum.reduceat(rank, first)
        if (over := least == NONE).any():
            out = np.repeat(over, size)
            done_symbols.append(symbols[out])
            done_words.append(word[out])
            symbols, word, rank = symbols[~out], word[~out], rank[~out]
            least, size = least[~over], size[~over]
            if not len(symbols):
                break
        due = np.repeat(least, size)
        at = np.flatnonzero(rank == due)
        # Of pairs that overlap in a row every second one, from the left.
        run = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]))
        at = at[(at - np.repeat(at[run], np.diff(np.append(run, len(at))))) % 2 == 0]
        symbols[at] = model.find(symbols[at], symbols[at + 1])[1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        place = (np.cumsum(stay) - 1)[at]
        symbols, word, rank, due = symbols[stay], word[stay], rank[stay], due[stay]
        near = np.unique(np.concatenate([place, np.maximum(place - 1, 0)]))
        last = np.minimum(near + 1, len(symbols) - 1)
        joined = (word[near] == word[last]) & (near != last)
        rank[near] = np.where(joined, model.find(symbols[near], symbols[last])[0], NONE)
        again = word[near[rank[near] <= due[near]]]
        if len(again):
            several = np.bincount(word[place], minlength=words) > 1
            again = np.unique(again[several[again]])
            if len(again):
                careful.extend(again.tolist())
                out = np.isin(word, again)
                symbols, word, rank = symbols[~out], word[~out], rank[~out]
    for w in careful:
        one = one_by_one(model, original_of(original, starts, lengths, w))
        done_symbols.append(np.array(one, np.int64))
        done_words.append(np.full(len(one), w))
    if not done_symbols:
        return np.empty(0, np.int64), np.zeros(words, np.int64)
    flat, owner = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(owner, kind="stable")
    return flat[order], np.bincount(owner, minlength=words)


def original_of(symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, w: int) -> list[int]:
    return symbols[starts[w] : starts[w] + lengths[w]].tolist()


def one_by_one(model: PieceModel, symbols: list[int]) -> list[int]:
    """Merge one word: always the pair of lowest rank, the leftmost of equals."""
    after, before, alive = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1)), [True] * len(symbols)
    heap: list[tuple[int, int, int, int, int]] = []
    table = {}

    def offer(a: int, b: int) -> None:
        if a < 0 or b >= len(symbols):
            return
        key = (symbols[a], symbols[b])
        if key not in table:
            rank, piece = model.find(np.array([key[0]]), np.array([key[1]]))
            table[key] = int(rank[0]), int(piece[0])
        if table[key][0] != NONE:
            heapq.heappush(heap, (table[key][0], a, b, *key))

    for a in range(len(symbols) - 1):
        offer(a, a + 1)
    while heap:
        _, a, b, left, right = heapq.heappop(heap)
        if not (alive[a] and alive[b]) or (symbols[a], symbols[b]) != (left, right) or after[a] != b:
            continue
        symbols[a], alive[b], after[a] = table[left, right][1], False, after[b]
        if after[a] < len(symbols):
            before[after[a]] = a
        offer(before[a], a)
        offer(a, after[a])
    return [s for s, live in zip(symbols, alive) if live]


class PieceEncoder(WordTable):
    """Ids of whole texts; distinct words are merged together, round by round, and kept between batches."""

    def __init__(self, path: str, keep_words: int = 250_000, keep_ids: int = 2_500_000):
        self.model = PieceModel(path)
        super().__init__(keep_words, keep_ids)

    def learn(self, words: list[str]) -> None:
        """Words come without the mark that stands before each."""
        for at in range(0, len(words), ROUND_WORDS):
            part = words[at : at + ROUND_WORDS]
            points = np.frombuffer((MARK + MARK.join(part)).encode("utf-32-le"), np.uint32)
            lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
            self.add(part, *self.with_bytes(*merge_rounds(self.model, self.model.symbols[points], lengths)))

    def with_bytes(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece become the ids of their UTF-8 bytes."""
        strange = symbols >= self.model.size
        if not strange.any():
            return symbols, lengths
        kinds, which = np.unique(symbols[strange] - self.model.size, return_inverse=True)
        coded = [chr(c).encode("utf-8", "surrogatepass") for c in kinds.tolist()]
        sizes = np.array([len(b) for b in coded])
        n = np.ones(len(symbols), np.int64)
        n[strange] = sizes[which]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        out = np.repeat(symbols, n)
        out[np.repeat(strange, n)] = self.model.byte_ids[np.frombuffer(b"".join(coded), np.uint8)][spread((np.cumsum(sizes) - sizes)[which], sizes[which])]
        return out, np.bincount(owner, n, minlength=len(lengths)).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of ids of every text."""
        self.trim()
        texts = texts.cast(pa.large_string()).fill_null("")
        # Single blanks between words: the words are what stands between blanks.
        odd = pc.or_(pc.match_substring_regex(texts, "^ |  | $|^$"), pc.match_substring(texts, MARK))
        words = pc.split_pattern(texts, " ")
        if (at := np.flatnonzero(odd.to_numpy(zero_copy_only=False))).size:
            own = [[w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + t.replace(" ", MARK))] if t else [] for t in texts.take(pa.array(at)).to_pylist()]
            words = with_lists(words, at, own)
        coded = words.flatten().dictionary_encode()
        offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
        index = self.indexes(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
        n = self.lengths[index]
        return self.ids[spread(self.starts[index], n)], by_list(offsets, n)


def with_lists(lists: pa.Array, at: np.ndarray, own: list[list[str]]) -> pa.Array:
    """The lists with those at some places replaced."""
    both = pa.concat_arrays([lists, pa.array(own, lists.type)])
    take = np.arange(len(lists))
    take[at] = len(lists) + np.arange(len(at))
    return both.take(pa.array(take))


def _next_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("piece_bytes", _next_byte)


def decode(model: PieceModel, ids: np.ndarray, lengths: np.ndarray) -> list[str]:
    """Texts of lists of ids: pieces joined, marks as blanks, without the blank of the dummy prefix.

    Bytes that don't form a code point come out as one replacement character each.
    """
    n = model.data_lengths[ids]
    starts = model.data_starts[ids]
    ends = np.cumsum(lengths)
    # The first piece that says something loses its mark.
    owner = np.repeat(np.arange(len(lengths)), lengths)
    says = np.flatnonzero(~model.control[ids])
    first = says[np.concatenate([[True], owner[says][1:] != owner[says][:-1]])] if len(says) else says
    cut = np.zeros(len(ids), np.int64)
    cut[first] = model.marked[ids[first]]
    data = model.data[spread(starts + cut, n - cut)].tobytes()
    bounds = np.concatenate([[0], np.cumsum(n - cut)])[np.concatenate([[0], ends])].tolist()
    return [data[a:b].decode("utf-8", "piece_bytes") for a, b in zip(bounds, bounds[1:])]


def piece_ids(docs: DataFrame, path: str, batch_bytes: int = PIECE_BATCH_BYTES, decoded: bool = False) -> DataFrame:
    """doc_id and ids (array of int) of every whole text, with ``decoded`` also the text decoded from these ids.

    Nothing is sampled or added: no begin or end ids. Null counts as the empty
    text (no ids, decoded to the empty text); every row gives a row, repeated
    and null doc_ids included; other columns are ignored. Memory holds one
    batch of about ``batch_bytes`` (a longer text comes alone) and known words.
    """

    def encode(batches) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(path)
        for doc_ids, texts, _ in balanced(batches, batch_bytes):
            ids, lengths = encoder.encode(texts)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
            columns = [doc_ids, pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))]
            if decoded:
                columns.append(pa.array(decode(encoder.model, ids, lengths), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][: len(columns)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>" + ", text string" * decoded)


def decode_ids(coded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of a table of doc_id and ids; null ids count as none."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = PieceModel(path)
        for batch in batches:
            lists = batch.column("ids")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decode(model, ids, lengths), pa.string())], names=["doc_id", "text"])

    rows = coded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the text decoded from them."""
    return piece_ids(docs, path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
