"""Repeated and nearly repeated lines (operator 10); Spark's own functions only.

Distinct lines are joined by edit distance: a line is cut into ``most + 1``
segments, of which one must appear unchanged, hardly moved, in any line within
``most`` edits. Segments and the substrings that may match them become hash
keys; pairs that meet on a key are verified by a banded bit-parallel distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillcast.llm.text_columns import SPACES, bound, whole
from rillcast.sources.staged import stage

MOST = 2
LEAST_CHARS = 32


def segment(i: int, length: Column, most: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of a line."""
    start = F.floor(i * length / (most + 1)).cast("int")
    return start, F.floor((i + 1) * length / (most + 1)).cast("int") - start


def index_keys(line: Column, length: Column, most: int) -> list[Column]:
    """One key per segment: its number, the line's length and the segment."""
    keys = []
    for i in range(most + 1):
        start, size = segment(i, length, most)
        keys.append(F.xxhash64(F.lit(i), length, F.substr(line, start + 1, size)))
    return keys


def probe_keys(line: Column, length: Column, most: int) -> list[Column]:
    """Keys of the substrings that can equal a segment of a line of this length or up to ``most`` shorter.

    The line's own index keys are such keys too and aren't made again. Left of segment ``i`` at most ``i`` edits and right of it at most ``most -
    i`` can be assumed, for any other split of the edits another segment
    matches; this bounds how far the segment has moved.
    """
    keys = []
    for shorter in range(most + 1):
        other = length - shorter
        for i in range(most + 1):
            start, size = segment(i, other, most)
            for move in range(max(-i, shorter - (most - i)), min(i, shorter + most - i) + 1):
                if shorter == 0 and move == 0:
                    continue
                at = start + move
                fits = (at >= 0) & (at + size <= length)
                keys.append(F.when(fits, F.xxhash64(F.lit(i), other, F.substr(line, at + 1, size))))
    return keys


def parities(letters: Column) -> Column:
    """Bit per class of neighbouring characters (by digest): whether their number is odd.

    An edit takes away two pairs of neighbours and brings two at most, so it
    flips four bits at most; a replaced word flips many more.
    """

    def flip(bits: Column, k: Column) -> Column:
        place = F.pmod(F.xxhash64(F.get(letters, k), F.get(letters, k + 1)), F.lit(64)).cast("int")
        return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))

    return F.aggregate(F.sequence(F.lit(0), F.size(letters) - 2), F.lit(0).cast("long"), flip)


def banded_distance(shorter: Column, longer: Column, most: int) -> Column:
    """Edit distance of two arrays of characters, or ``most + 1`` if it is larger.

    Their lengths differ by ``most`` at most, and the longer holds at least that many.

    Bit ``k`` of a column's vectors stands for the row ``k - most`` below the
    diagonal, so a column is a few operations on one integer. The distance is
    followed down the band's lowest diagonal until the last row, then along it
    for up to ``2 * most`` columns; once it is too large to come back from, the
    remaining columns are passed over.
    """
    width = 2 * most + 1
    every = F.lit((1 << width) - 1).cast("long")
    top = 1 << (width - 1)

    def column(state: Column, j: Column) -> Column:
        char = F.get(shorter, j)
        equal = F.lit(0).cast("long")
        for k in range(width):
            equal = equal.bitwiseOR(F.when(F.get(longer, j - most + k) == char, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))

        def step(x: Column) -> Column:
            up, down = state["up"], state["down"]
            zero = (x.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(x).bitwiseOR(down).bitwiseAND(every)

            def moved(d: Column) -> Column:
                right = down.bitwiseOR(every.bitwiseXOR(d.bitwiseOR(up)))
                left = d.bitwiseAND(up)
                shifted = F.shiftright(d, 1)
                row = F.size(longer) - most
                bit = F.when(j >= row, F.call_function("shiftright", F.lit(top >> 1).cast("long"), j - row)).otherwise(F.lit(0).cast("long"))
                diagonal = F.when(d.bitwiseAND(F.lit(top).cast("long")) == 0, F.lit(1)).otherwise(F.lit(0))
                along = F.when(right.bitwiseAND(bit) != 0, F.lit(1)).when(left.bitwiseAND(bit) != 0, F.lit(-1)).otherwise(F.lit(0))
                return F.struct(
                    left.bitwiseOR(every.bitwiseXOR(shifted.bitwiseOR(right).bitwiseAND(every))).alias("up"),
                    shifted.bitwiseAND(right).alias("down"),
                    (state["n"] + F.when(j < row, diagonal).otherwise(along)).alias("n"),
                )

            return bound(zero, moved)

        return F.when(state["n"] > 3 * most, state).otherwise(bound(equal, step))

    first = F.struct(
        F.lit(((1 << (most + 1)) - 1) << most).cast("long").alias("up"), F.lit(0).cast("long").alias("down"), F.lit(most).alias("n")
    )
    places = F.when(F.size(shorter) > 0, F.sequence(F.lit(0), F.size(shorter) - 1)).otherwise(F.array().cast("array<int>"))
    return F.least(F.aggregate(places, first, column, lambda s: s["n"]), F.lit(most + 1))


def characters(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit("(?s)."), F.lit(0))


def lines_of(docs: DataFrame, *more: Column) -> DataFrame:
    """Lines with a word, without white space around them: doc_id, digest h of the text, place, digests d1 and d2, line."""
    text = F.col("text").cast("string")
    # The digest before the lines are told apart: behind that it would be made once a line.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    placed = texts.select("doc_id", "h", F.posexplode(F.split("text", "\n")).alias("place", "raw"))
    bare = placed.withColumn("line", F.btrim("raw", F.lit(SPACES))).where("line <> ''").drop("raw")
    # Two digests, seeded apart, name a line.
    return bare.withColumns({"d1": F.xxhash64("line"), "d2": F.xxhash64(F.lit(1), "line")})


def distinct_lines(docs: DataFrame, most: int, least_chars: int) -> DataFrame:
    """d1, d2, first (doc_id, h, place of the first occurrence), copies and keys (null for short lines).

    Lines travel as digests and keys, not as text; equal ones are merged before the shuffle.
    """

    def keys_of(line: Column) -> Column:
        return bound(F.length(line), lambda n: F.when(n >= least_chars, F.array(*index_keys(line, n, most), *probe_keys(line, n, most))))

    keyed = lines_of(docs).withColumn("keys", bound(F.col("line"), keys_of))
    return keyed.groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id", "h", "place")).alias("first"), F.count("*").alias("copies"), F.first("keys").alias("keys")
    )


# A table of digests of up to this many rows (16 MB) is broadcast; a larger one is joined by shuffle.
BROADCAST_DIGESTS = 1_000_000


def counted(digests: DataFrame) -> DataFrame:
    """A written table of digests, broadcast if its counted rows allow it."""
    return F.broadcast(digests) if digests.count() <= BROADCAST_DIGESTS else digests


def line_links(docs: DataFrame, lines: DataFrame, most: int) -> DataFrame:
    """Links (d1, d2, e1, e2) of different lines within ``most`` edits, both ways.

    First each line only asks whether any other line shares one of its keys
    (semi joins, a row per key at most). The few lines left, with their texts
    and character parities, are then paired; pairs whose parities differ too
    much drop inside the join, the others are verified once.
    """
    keyed = lines.where("keys IS NOT NULL")
    index = keyed.select("d1", F.explode(F.slice("keys", 1, most + 1)).alias("key"))
    probe = keyed.select(F.col("d1").alias("e1"), F.explode("keys").alias("key2")).where("key2 IS NOT NULL")
    probe = stage(probe.join(index, (F.col("key2") == F.col("key")) & (F.col("e1") != F.col("d1")), "left_semi"))
    index = stage(index.join(probe, (F.col("key2") == F.col("key")) & (F.col("e1") != F.col("d1")), "left_semi"))
    met = stage(probe.select(F.col("e1").alias("d1")).unionByName(index.select("d1")).distinct())
    texts = lines_of(docs).select("d1", "d2", "line").join(counted(met), "d1", "left_semi").groupBy("d1", "d2").agg(F.min("line").alias("line"))
    texts = stage(texts.withColumn("letters", characters(F.col("line"))).withColumn("parity", bound(F.col("letters"), parities)))
    named = texts.select("d1", "d2", "parity")
    other = texts.select(*(F.col(c).alias(f"e{c[1:]}") for c in ("d1", "d2")), F.col("parity").alias("parity2"))
    near = F.bit_count(F.col("parity").bitwiseXOR(F.col("parity2"))) <= 4 * most
    pairs = index.join(named, "d1").join(
        probe.join(other, "e1"), (F.col("key") == F.col("key2")) & (F.col("d1") != F.col("e1")) & near
    ).select("d1", "d2", "e1", "e2").distinct()
    first = texts.select("d1", "d2", F.col("letters").alias("a"))
    second = texts.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("letters").alias("b"))
    both = pairs.join(first, ["d1", "d2"]).join(second, ["e1", "e2"])
    # The index holds lines as long as the probing one or shorter.
    links = both.where(F.abs(F.size("a") - F.size("b")) <= most).where(banded_distance(F.col("a"), F.col("b"), most) <= most)
    links = links.select("d1", "d2", "e1", "e2")
    turned = links.select(F.col("e1").alias("d1"), F.col("e2").alias("d2"), F.col("d1").alias("e1"), F.col("d2").alias("e2"))
    return links.unionByName(turned).distinct()


def dedup_lines(docs: DataFrame, most: int = MOST, least_chars: int = LEAST_CHARS, name: str = "lines") -> DataFrame:
    """Documents with repeated lines taken out of ``text``, and a struct ``name`` that counts them.

    A line is compared without the white space around it. It goes if an equal
    line, or one within ``most`` edits, occurs first at an earlier place:
    earlier document by doc_id (null first), then earlier in the text. Lines
    under ``least_chars`` characters only have equal ones. Blank lines stay.

    The struct holds n_lines, n_dropped, n_links (other lines within ``most``
    edits, summed over the text's lines) and class_id (the smallest doc_id in
    which one of its lines, or one linked to it, occurs first). Null texts
    stay null. Rows equal in doc_id and text are one document and keep the
    same lines; all other columns are kept whatever their names, only one called
    ``name`` is replaced.
    """
    if least_chars < max(most + 1, 1):
        raise ValueError("lines must be longer than the number of edits")
    lines = stage(distinct_lines(docs, most, least_chars))
    links = stage(line_links(docs, lines, most))
    firsts = lines.select("d1", "d2", "first")
    ends = links.join(firsts, ["d1", "d2"]).join(firsts.select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.col("first").alias("other")), ["e1", "e2"])
    linked = ends.groupBy("d1", "d2").agg(
        F.count("*").alias("n_links"), F.max(F.col("other") < F.col("first")).alias("late"), F.min("other.doc_id").alias("origin")
    )
    decided = stage(
        lines.select("d1", "d2", "first", "copies").join(linked, ["d1", "d2"], "left").where("copies > 1 OR n_links IS NOT NULL").select(
            "d1", "d2", "first", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("late", F.lit(False)).alias("late"),
            F.least("first.doc_id", "origin").alias("origin"),
        )
    )
    gone = F.col("late") | ~F.struct("doc_id", "h", "place").eqNullSafe(F.col("first"))
    met = lines_of(docs).select("doc_id", "h", "place", "d1", "d2").join(decided, ["d1", "d2"])
    by_doc = met.groupBy("doc_id", "h").agg(F.collect_set(F.struct("place", gone.alias("gone"), "n_links", "origin")).alias("met"))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").cast("string").alias("text")
    ).withColumn("h", F.xxhash64("text"))
    other = by_doc.select(F.col("doc_id").alias("id2"), F.col("h").alias("h2"), "met")
    joined = rows.join(other, (F.col("h") == F.col("h2")) & F.col("id").eqNullSafe(F.col("id2")), "left")

    def cleaned(parts: Column) -> Column:
        drop = F.transform(F.filter("met", lambda m: m["gone"]), lambda m: m["place"])
        left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), drop)
        return F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")

    text = F.when(F.exists("met", lambda m: m["gone"]), bound(F.split("text", "\n"), cleaned)).otherwise(F.col("text"))
    n_lines = F.size(F.filter(F.split(whole(F.col("text")), "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != ""))
    found = F.coalesce(F.col("met"), F.array().cast(by_doc.schema["met"].dataType))
    counts = F.struct(
        n_lines.cast("long").alias("n_lines"), F.size(F.filter(found, lambda m: m["gone"])).cast("long").alias("n_dropped"),
        F.aggregate(found, F.lit(0).cast("long"), lambda n, m: n + m["n_links"]).alias("n_links"),
        F.least(F.col("id"), F.array_min(F.transform(found, lambda m: m["origin"]))).alias("class_id"),
    )
    changed = F.col("row").withField("text", text)
    if name in docs.columns:
        changed = changed.dropFields(name)
    return joined.select(changed.alias("row"), counts.alias("counts")).select("row.*", F.col("counts").alias(name))
