import random

import pytest
from pyspark.sql import functions as F

from rillcast.llm.line_dedup import banded_distance, characters, dedup_lines
from rillcast.llm.text_columns import bound


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def within(a, b, most):
    """Whether two lines are within ``most`` edits: a plain search from both ends inward."""
    while a and b and a[0] == b[0]:
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        a, b = a[k:], b[k:]
    if not a or not b:
        return max(len(a), len(b)) <= most
    return most > 0 and (within(a[1:], b, most - 1) or within(a, b[1:], most - 1) or within(a[1:], b[1:], most - 1))


def test_within_is_the_distance():
    rng = random.Random(3)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(9)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(9)))
        assert all(within(a, b, most) == (distance(a, b) <= most) for most in range(4))


def edited(rng, line, edits):
    out = list(line)
    for _ in range(edits):
        k = rng.randrange(len(out) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            out.insert(k, rng.choice("abé"))
        elif out and kind == 1:
            out.pop(min(k, len(out) - 1))
        elif out:
            out[min(k, len(out) - 1)] = rng.choice("ab\U0001f600")
    return "".join(out)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_banded_distance(spark, most):
    rng = random.Random(most)
    rows = []
    for _ in range(1500):
        a = "".join(rng.choice("abé\n\U0001f600") for _ in range(rng.randrange(16)))
        a, b = sorted((a, edited(rng, a, rng.randrange(6))), key=len)
        if most <= len(b) <= len(a) + most:
            rows.append((a, b, min(distance(a, b), most + 1)))
    frame = spark.createDataFrame(rows, "a string, b string, want int")
    got = bound(characters(F.col("a")), lambda p: bound(characters(F.col("b")), lambda q: banded_distance(p, q, most)))
    assert frame.withColumn("got", got).where("got <> want").collect() == []


def plain(rows, most, least):
    """Cleaned texts and counts by brute force; rows are (doc_id, text)."""
    order = lambda d: (d is not None, d or 0)
    strip = " \t\n\x0b\x0c\r"
    found = [(order(d), k, line.strip(strip), i) for i, (d, t) in enumerate(rows) for k, line in enumerate((t or "").split("\n")) if line.strip(strip)]
    first = {}
    for d, k, line, i in sorted(found):
        first.setdefault(line, (d, k, i))
    near = {a: [b for b in first if a != b and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= most and within(a, b, most)] for a in first}
    out = []
    for i, (d, t) in enumerate(rows):
        if t is None:
            out.append((None, 0, 0, 0, d))
            continue
        kept, lines, dropped, links, ids = [], 0, 0, 0, [d]
        for k, line in enumerate(t.split("\n")):
            bare = line.strip(strip)
            gone = False
            if bare:
                lines += 1
                links += len(near[bare])
                ids += [first[x][0][1] if first[x][0][0] else None for x in [bare, *near[bare]]]
                gone = first[bare] != (order(d), k, i) or any(first[x] < first[bare] for x in near[bare])
                dropped += gone
            if not gone:
                kept.append(line)
        ids = [x for x in ids if x is not None]
        out.append(("\n".join(kept), lines, dropped, links, min(ids, default=None)))
    return out


@pytest.mark.parametrize(("most", "least"), [(2, 8), (1, 6), (0, 4), (3, 12)])
def test_documents_against_brute_force(spark, odd_texts, most, least):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdeé ") for _ in range(rng.randrange(5, 30))) for _ in range(25)] + ["", "  ", "ab", "a b c d e f g h"]
    texts = [rng.choice(["\n", "\n", " \n"]).join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3, 4])) for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    rows = [*enumerate([*odd_texts[:20], *texts], 1), (None, "some line here without an id\nab"), (500, "\n\n")]
    docs = spark.createDataFrame([(d, t, "x", i, [i]) for i, (d, t) in enumerate(rows)], "doc_id long, text string, met string, h int, place array<int>")
    result = dedup_lines(docs, most, least)
    assert result.columns == [*docs.columns, "lines"]
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
    got = {r.h: (r.text, r.lines.n_lines, r.lines.n_dropped, r.lines.n_links, r.lines.class_id) for r in result.collect()}
    want = plain(rows, most, least)
    for i in range(len(rows)):
        assert got[i] == want[i], rows[i]


def test_dense_variants_of_one_line(spark):
    """Lines that share segments but differ by a word aren't links; one-letter variants are."""
    rng = random.Random(2)
    words = [f"word{k}" for k in range(12)]
    texts = []
    for i in range(120):
        own = list(words)
        own[rng.randrange(12)] = "".join(rng.choice("qwxyz") for _ in range(5))
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.lines.n_lines, r.lines.n_dropped, r.lines.n_links, r.lines.class_id) for r in dedup_lines(docs).collect()}
    want = plain(rows, 2, 32)
    assert [got[i] for i in range(120)] == want


def test_repeated_rows_are_one_document_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b\nc"), (1, "a b\nc"), (2, "c\nd"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.text)) for r in dedup_lines(docs).collect())
    assert got == [("1", "a b\nc"), ("1", "a b\nc"), ("2", "d"), ("None", "None")]
    assert dedup_lines(docs.limit(0)).count() == 0
    again = dedup_lines(docs.selectExpr("*", "1 AS lines"))
    assert again.columns == ["doc_id", "text", "lines"] and again.where("lines.n_lines = 2").count() == 3
    with pytest.raises(ValueError, match="longer"):
        dedup_lines(docs, most=4, least_chars=4)
