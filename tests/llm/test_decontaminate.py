import random
import re

import pytest
from pyspark.sql import functions as F

from rillcast.llm import decontaminate
from rillcast.llm.decontaminate import NUMBER_WORDS, UNITS, leaks, without_leaks


def plain_words(text):
    """(kind, value) of words, by plain loops."""
    out, before = [], None
    for raw in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        bare = re.sub(r"^[^\w%]+|[^\w%]+$", "", raw.replace("_", " ")).strip()
        if bare:
            low = bare.lower()
            kind = "literal"
            if out and not re.search(r"[.!?:;]\W*$", before) and re.match(r"[A-Z][a-z]", bare):
                kind = "name"
            if re.fullmatch(r"[+-]?\d[\d.,:/-]*%?", low) or low in NUMBER_WORDS:
                kind = "number"
            elif low in UNITS and out and out[-1][0] == "number":
                kind = "unit"
            out.append((kind, low))
        before = raw
    return out


def plain_windows(text):
    words = plain_words(text)
    out = []
    for i in range(len(words) - 4):
        window = words[i : i + 5]
        if sum(k == "literal" for k, _ in window) >= 2:
            out.append((i, tuple(v if k == "literal" else f"<{k}>" for k, v in window), [None if k == "literal" else v for k, v in window]))
    return out


def plain_leaks(docs, items):
    out = {}
    for d, text in docs:
        mine = plain_windows(text)
        for item, question in items:
            own = plain_windows(question)
            if not own:
                continue
            found = {i for i, w, _ in own if any(w == x for _, x, _ in mine)}
            values, changed = {}, False
            for i, w, s in own:
                for k, x, t in mine:
                    if w == x:
                        for a, b in zip(s, t):
                            if a is not None:
                                values.setdefault((k - i, a), set()).add(b)
            agreement = sum(len(v) == 1 for v in values.values()) / len(values) if values else 1.0
            if len(found) / len(own) >= 0.8 and agreement >= 0.8:
                changed = any(b != a for (_, a), v in values.items() for b in v)
                out[d, item] = (len(own), len(found), changed)
    return out


QUESTION = "A train leaves Paris at 9 and drives 120 km to the town where Anna waits for it with 3 red apples and 120 km of string."
OTHER = "A train leaves Rome at 7 and drives 250 miles to the town where Otto waits for it with 8 red apples and 250 miles of string."
MIXED = "A train leaves Rome at 7 and drives 250 miles to the town where Otto waits for it with 8 red apples and 999 feet of string."


def test_reparameterised_questions(spark):
    filler = "Some words that stand before it here. "
    docs = [(1, filler + QUESTION + " and more"), (2, filler + OTHER), (3, "a train leaves nothing at all"), (4, None), (5, ""), (6, filler + QUESTION[:60])]
    items = [(10, QUESTION), (11, "too short"), (12, None), (13, "1 2 3 4 5 6 7 8")]
    got = {(r.doc_id, r.item_id): r for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == {(1, 10), (2, 10)}
    assert not got[1, 10].changed and got[2, 10].changed and got[2, 10].agreement == 1.0


def test_slots_must_be_replaced_consistently(spark):
    docs = spark.createDataFrame([(1, OTHER), (2, MIXED)], "doc_id long, text string")
    items = spark.createDataFrame([(10, QUESTION)], "item_id long, text string")
    assert {r.doc_id for r in leaks(docs, items, agreement=0.9).collect()} == {1}


@pytest.mark.parametrize("bytes_", [8 << 20, 300])
def test_against_brute_force(spark, odd_texts, monkeypatch, bytes_):
    monkeypatch.setattr(decontaminate, "BATCH_BYTES", bytes_)
    rng = random.Random(6)
    vocabulary = ["the", "a", "Tom", "Ada", "runs", "has", "5", "12", "km", "hours", "3.5", "seven", "red", "and.", "so?", "(of)", "--"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, line(rng.randrange(3, 20))) for i in range(25)]
    docs = list(enumerate([line(30) + " " + rng.choice(items)[1].replace(rng.choice(["5", "zz"]), "9").replace("Tom", rng.choice(["Tom", "Eve"])) + rng.choice([" ", ". "]) + line(9) for _ in range(60)]))
    docs += [(100 + i, t) for i, t in enumerate(odd_texts[:12])]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, item_id int, hash int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_found, r.changed) for r in leaks(frame, bench).collect()}
    want = plain_leaks(docs, items)
    assert len(want) > 20 and got == want
    kept = without_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _ in docs if d not in {k for k, _ in want}]


def test_empty_tables_repeats_and_null_ids(spark):
    docs = spark.createDataFrame([(None, QUESTION), (1, QUESTION), (1, QUESTION), (1, "clean text"), (None, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, QUESTION), (7, QUESTION), (7, QUESTION)], "item_id long, text string")
    assert sorted((str(r.doc_id), str(r.item_id)) for r in leaks(docs, items).collect()) == [("1", "7"), ("1", "None"), ("None", "7"), ("None", "None")]
    assert sorted(r.text for r in without_leaks(docs, items).collect()) == ["clean", "clean text"]
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0
    assert without_leaks(docs, items.limit(0)).count() == 5
