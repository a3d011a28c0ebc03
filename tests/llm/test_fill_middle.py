import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rillcast.llm.boundary_sets import ARRAY, BITMAP, RUNS, BoundarySet
from rillcast.llm.fill_middle import boundary_sets, check_marks, fill_in_middle, restored, text_boundaries

TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain(doc_id, text, seed=42):
    """(n, form, prefix_chars, middle_chars, output) by regular expression and slices."""
    text = text or ""
    units = TOKEN.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("kind", ["sparse", "dense", "runs", "mixed", "far", "none"])
def test_boundary_set_selects_every_member(kind):
    rng = np.random.default_rng(1)
    sets = {
        "sparse": rng.choice(1 << 18, 3000, replace=False), "dense": rng.choice(1 << 17, 60000, replace=False), "runs": np.arange(5, 200000),
        "mixed": np.concatenate([np.arange(1000), 70000 + rng.choice(60000, 30000, replace=False), [1 << 20]]),
        "far": np.array([0, 65535, 65536, 1 << 40]), "none": np.empty(0, np.int64),
    }
    members = np.unique(sets[kind]).astype(np.int64)
    built = BoundarySet.of(members)
    again = BoundarySet.from_bytes(built.to_bytes())
    assert len(built) == len(again) == len(members)
    picks = range(len(members)) if len(members) < 5000 else rng.integers(0, len(members), 3000).tolist() + [len(members) - 1]
    assert all(built.select(k) == again.select(k) == members[k] for k in picks)
    for k in (-1, len(members)):
        with pytest.raises(IndexError):
            built.select(k)


def test_container_kinds():
    kinds = {kind for kind, _ in BoundarySet.of(np.unique(np.concatenate([[3, 9, 11], 65536 + 2 * np.arange(20000), np.arange(1 << 18, (1 << 18) + 900)]))).containers}
    assert kinds == {ARRAY, BITMAP, RUNS}


def test_boundaries(odd_texts):
    texts = [t or "" for t in odd_texts]
    array = pa.array(["dropped", *texts], pa.large_string()).slice(1)
    for text, found in zip(texts, text_boundaries(array)):
        want = [0, *(m.end() for m in TOKEN.finditer(text))]
        assert found.tolist() == want


def test_outputs_against_slices(spark, odd_texts):
    rng = random.Random(3)
    texts = [*odd_texts, "a <P> b", "<S>", "x<", "<<P", *("".join(rng.choice("ab <>PSM\té") for _ in range(rng.randrange(80))) for _ in range(300))]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, "no id at all", 1, "x"), (7, "same id", 1, "x"), (7, "same id", 1, "x")], "doc_id long, text string, n int, output string")
    made = fill_in_middle(docs)
    got = made.withColumn("back", restored(made["output"], made["form"])).collect()
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"] or "", *plain(r["doc_id"], r["text"])[:2]) for r in docs.collect())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["back"], r["n"], r["form"]) for r in got) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] != 7}
    for i, t in enumerate(texts):
        if i != 7:
            assert tuple(by_id[i])[1:6] == plain(i, t)


def test_empty_and_sets(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle(docs).count() == 0 and boundary_sets(docs).count() == 0
    docs = spark.createDataFrame([(1, "ab c  d "), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n"], BoundarySet.from_bytes(bytes(r["bounds"]))) for r in boundary_sets(docs).collect()}
    assert [got[1][1].select(k) for k in range(5)] == [0, 2, 4, 7, 8] and got[1][0] == 4
    assert got[2][0] == 0 and got[2][1].select(0) == 0


def test_overlapping_marks_are_refused():
    check_marks(("<P>", "<S>", "<M>"))
    for marks in (("aba", "x", "y"), ("<P", "P>", "z"), ("ab", "abc", "d"), ("", "a", "b")):
        with pytest.raises(ValueError):
            check_marks(marks)
