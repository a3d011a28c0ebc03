import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rillcast.llm import substring_dedup as sd
from rillcast.llm import super_kmers as sk

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(rows, size):
    """(kept words, removed) of (doc_id, text) rows, every window against every other."""
    first = {}
    words = [WORD.findall(t or "") for _, t in rows]
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if d is not None and first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        out.append(([x for i, x in enumerate(w) if i not in gone], len(gone)))
    return out


def corpus(seed, n=120):
    """Texts with shared passages, copies, near copies, periodic runs and odd white space."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(60)] + ["é", "日本", "\x85x", "A", "a", "x\x1cy"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 40))] for _ in range(8)]
    texts = [None, "", " \n", "one", " ".join(passages[0][:13]), "a " * 200, "a b " * 60]
    for _ in range(n):
        w = []
        for _ in range(rng.randrange(4)):
            w += [rng.choice(vocabulary) for _ in range(rng.randrange(20))] + rng.choice([[], rng.choice(passages)])
        texts.append("".join(x + rng.choice([" ", "  ", "\n", "\t\x0b"]) for x in w))
    texts += texts[10:30] + [t + " more" for t in texts[30:40]]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [0, 6, 512])
@pytest.mark.parametrize("size", [3, 13])
def test_windows_against_plain(spark, monkeypatch, hot, size):
    monkeypatch.setattr(sd, "HOT_RUNS", hot)
    if hot == 6:
        monkeypatch.setattr(sd, "SAMPLE", 1)
        monkeypatch.setattr(sd, "OFTEN", 12)
        monkeypatch.setattr(sd, "BROADCAST_SPANS", 0)
    rows = corpus(hot + size) + [(None, "a " * 40), (None, None), (5, "a " * 200), (5, "w1 w2 " * 20)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, passages string, a int").repartition(5)
    got = sorted(sd.dedup_passages(docs, size).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], r["text"] or ""))
    want = []
    for (d, t), (kept, removed) in zip(rows, plain(rows, size)):
        want.append((d, " ".join(kept) if removed else t, len(WORD.findall(t or "")), removed, 1))
    want.sort(key=lambda r: (r[0] is None, r[0], r[1] or ""))
    assert [(r["doc_id"], r["text"], *r["passages"], r["a"]) for r in got] == want
    assert sum(r[3] for r in want) > 300


def test_two_digests_alike_are_told_apart(monkeypatch):
    monkeypatch.setattr(sk, "hashed_runs", lambda v, size: np.zeros(max(len(v) - size + 1, 0), np.uint64))
    run, place = sk.later_windows(pa.array(["a b c d", "b c d e", "x y z", "a b c"]), np.array([1, 2, 3, 0]), 3)
    assert set(zip(run.tolist(), place.tolist())) == {(0, 0), (1, 0)}


def test_runs_cover_every_window_once():
    texts = pa.array([t for _, t in corpus(4)], pa.string())
    split = sk.split_words(texts)
    text, start, windows, mini = sk.super_kmers(*split, 13)
    n = np.maximum(np.diff(split[0]) - 12, 0)
    seen = [(t, s + k) for t, s, w in zip(text.tolist(), start.tolist(), windows.tolist()) for k in range(w)]
    assert sorted(seen) == [(t, k) for t, m in enumerate(n.tolist()) for k in range(m)]
    assert windows.max() <= sk.RUN_WINDOWS
    words = [WORD.findall(t or "") for t in texts.to_pylist()]
    owners = {}
    for t, s, w, m in zip(text.tolist(), start.tolist(), windows.tolist(), mini.tolist()):
        for k in range(w):
            assert owners.setdefault(tuple(words[t][s + k : s + k + 13]), m) == m
    assert sk.packed(*split, text, start, windows, 13).to_pylist() == [" ".join(words[t][s : s + w + 12]) for t, s, w in zip(text, start, windows)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sd.dedup_passages(docs).collect() == []
    assert sd.dedup_passages(docs).columns == ["doc_id", "text", "passages"]
