"""Benchmark items found in documents by canonical template windows (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillcast.llm.words import spread
from rillcast.sources.staged import stage

WINDOW = 5
LEAST_LITERALS = 2
FILTER_BITS = 22
BATCH_BYTES = 3 << 20
LITERAL, NUMBER, NAME, UNIT = range(4)
# Number words and units that a re-worded question may swap.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
).split()
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound pounds lb lbs oz "
    "ml l litre litres liter liters gallon gallons second seconds s minute minutes min hour hours h day days week weeks month months "
    "year years dollar dollars cent cents euro euros percent % kmh mph degrees"
).split()
MIX = np.uint64(0x9E3779B97F4A7C15)
WINDOWS_SCHEMA = "owner long, digest long, place int, hash long, slots array<string>"


def canonical(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text number, hash, kind) of every word that holds a letter or digit, and its bare value.

    A word is lower-cased and freed of punctuation around it. Numbers, units
    right behind a number, and capitalised words inside a sentence are
    placeholders: all words of such a kind have the same hash.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    coded = lists.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    raw, codes = coded.dictionary, coded.indices.to_numpy()
    bare = pc.replace_substring_regex(raw, r"^[^\p{L}\p{N}%]+|[^\p{L}\p{N}%]+$", "")
    low = pc.utf8_lower(bare)
    flag = lambda a: a.to_numpy(zero_copy_only=False).astype(bool)
    number = flag(pc.or_(pc.match_substring_regex(low, r"^[+-]?\p{N}[\p{N}.,:/-]*%?$"), pc.is_in(low, pa.array(NUMBER_WORDS, low.type))))
    unit = flag(pc.is_in(low, pa.array(UNITS, low.type)))
    capital = flag(pc.match_substring_regex(bare, r"^\p{Lu}\p{Ll}"))
    ends = flag(pc.match_substring_regex(raw, r"[.!?:;][^\p{L}\p{N}]*$"))
    some = flag(pc.not_equal(bare, ""))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, low.to_pylist()), np.uint64, len(low))
    here = some[codes] if len(raw) else np.empty(0, bool)
    sentence = ends[codes] if len(raw) else here
    codes, owner, before_ends = codes[here], owner[here], np.concatenate([[True], sentence[:-1]])[: len(sentence)][here]
    starts = np.concatenate([[True], owner[1:] != owner[:-1]])[: len(owner)]
    kind = np.zeros(len(codes), np.int8)
    if len(codes):
        kind[capital[codes] & ~starts & ~before_ends] = NAME
        kind[number[codes]] = NUMBER
        kind[1:][unit[codes][1:] & (kind[:-1] == NUMBER) & ~starts[1:]] = UNIT
    h = hashes[codes] if len(codes) else np.empty(0, np.uint64)
    return owner, np.where(kind == LITERAL, h, kind.astype(np.uint64)), kind, low.take(pa.array(codes))


def windows(texts: pa.Array, size: int):
    """(text number, place in the text, hash, first word) of windows with enough literal words, and the words' kinds and values."""
    owner, h, kind, values = canonical(texts)
    n = len(h) - size + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64), empty, kind, values
    total, literals = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = (total ^ h[k : k + n]) * MIX
            total ^= total >> np.uint64(29)
            literals += kind[k : k + n] == LITERAL
        total *= MIX
        total ^= total >> np.uint64(32)
    first = np.flatnonzero((owner[:n] == owner[size - 1 :]) & (literals >= min(LEAST_LITERALS, size)))
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    text_start = np.zeros(int(owner[-1]) + 1, np.int64)
    text_start[owner[starts]] = starts
    return owner[first], first - text_start[owner[first]], total[first], first, kind, values


def template_windows(rows: DataFrame, size: int, keep=None) -> DataFrame:
    """Windows of rows with owner, digest and text; ``keep`` is a broadcast bitmap of hashes worth returning."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        bitmap = None if keep is None else keep.value
        for owners, digests, texts in sized(batches):
            text, place, h, first, kind, values = windows(texts, size)
            if bitmap is not None:
                at = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                met = (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
                text, place, h, first = text[met], place[met], h[met], first[met]
            if not len(h):
                continue
            words = spread(first, np.full(len(first), size))
            slots = pc.if_else(pa.array(kind[words] != LITERAL), values.take(pa.array(words)).cast(pa.string()), pa.scalar(None, pa.string()))
            slots = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * size, pa.int32()), slots)
            columns = [owners.take(pa.array(text)), digests.take(pa.array(text)), pa.array(place, pa.int32()), pa.array(h.view(np.int64)), slots]
            yield pa.RecordBatch.from_arrays(columns, names=["owner", "digest", "place", "hash", "slots"])

    return rows.mapInArrow(run, WINDOWS_SCHEMA)


def sized(batches) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """Parts of batches of about BATCH_BYTES of text; a longer text comes alone."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_string())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, before + BATCH_BYTES, side="right")) - at)
            yield batch.column("owner").slice(at, n), batch.column("digest").slice(at, n), texts.slice(at, n)
            at += n


def hash_bitmap(hashed: DataFrame) -> np.ndarray:
    """Bitmap of the windows' hashes by their highest bits: 2 ** FILTER_BITS bits, however many windows there are."""
    place = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    rows = hashed.groupBy(F.shiftrightunsigned(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for row in rows:
        bitmap[row.word] = np.uint64(row.bits % (1 << 64))
    return bitmap


def leaks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: float = 0.8, agreement: float = 0.8) -> DataFrame:
    """Items found in documents: doc_id, digest (of the text), item_id, n_windows, n_found, share, agreement, changed.

    An item is found when at least ``share`` of its template windows occur in
    the document and at least ``agreement`` of its slot values are replaced
    consistently: within one alignment, equal values of the item stand for
    equal values of the document. ``changed`` tells whether any value differs.

    Documents are hashed where they lie; a bitmap of fixed size lets only
    windows that may occur in the benchmark into the hash join. Windows with
    fewer than two literal words aren't used on either side, so an item
    without any (or with fewer than ``size`` words) is never found. Null texts
    have no windows; repeated rows of a document count once; null ids are kept.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("owner"), F.lit(0).cast("long").alias("digest"), F.col("text").cast("string").alias("text"))
    own = stage(template_windows(items.distinct(), size).select(F.col("owner").alias("item_id"), F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots")))
    keep = docs.sparkSession.sparkContext.broadcast(hash_bitmap(own))
    rows = docs.select(F.col("doc_id").cast("long").alias("owner"), F.xxhash64(F.col("text").cast("string")).alias("digest"), F.col("text").cast("string").alias("text"))
    met = stage(template_windows(rows, size, keep).join(own, "hash"))
    key = ["owner", "digest", "item_id"]
    found = met.select(*key, "item_place").distinct().groupBy(*key).agg(F.count("*").alias("n_found"))
    totals = own.groupBy("item_id").agg(F.count_distinct("item_place").alias("n_windows"))
    enough = found.join(totals, found["item_id"].eqNullSafe(totals["item_id"])).drop(totals["item_id"]).withColumn("share", F.col("n_found") / F.col("n_windows")).where(F.col("share") >= share)
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda p: p["item_slots"].isNotNull())
    slots = met.select(*key, (F.col("place") - F.col("item_place")).alias("shift"), F.explode(pairs).alias("p")).select(
        *key, "shift", F.col("p.item_slots").alias("value"), F.col("p.slots").alias("other")
    ).distinct()
    by_value = slots.groupBy(*key, "shift", "value").agg(F.count("*").alias("n"), F.max(F.col("value") != F.col("other")).alias("differs"))
    by_item = by_value.groupBy(*key).agg(F.avg((F.col("n") == 1).cast("double")).alias("agreement"), F.max("differs").alias("changed"))
    same = [enough[k].eqNullSafe(by_item[k]) for k in key]
    return enough.join(by_item, same, "left").select(
        enough["owner"].alias("doc_id"), enough["digest"], enough["item_id"], "n_windows", "n_found", "share",
        F.coalesce("agreement", F.lit(1.0)).alias("agreement"), F.coalesce("changed", F.lit(False)).alias("changed"),
    ).where(F.col("agreement") >= agreement)


def without_leaks(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that hold no item, with their columns."""
    found = stage(leaks(docs, benchmark, **settings).select("doc_id", "digest").distinct())
    same = (F.xxhash64(F.col("row.text").cast("string")) == F.col("digest")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id"))
    return docs.select(F.struct("*").alias("row")).join(found, same, "left_anti").select("row.*")
