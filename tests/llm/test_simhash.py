import random
import re

import pytest
import xxhash

from rillcast.llm.components import components
from rillcast.llm.simhash import fingerprint_links, fingerprint_text, one_of_each, simhash_groups


def plain_fingerprint(text, size=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("block_rows", [8192, 10])
def test_documents_against_brute_force(spark, odd_docs, odd_texts, block_rows):
    rng = random.Random(1)
    base = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(50)) for _ in range(400)]
    copies = [" ".join(w if rng.random() > p else "new" for w in base) for p in (0, 0.002, 0.005, 0.01, 0.02) for _ in range(12)]
    texts = [*odd_texts, *copies]
    docs = spark.createDataFrame([(i, t, "x", 0, 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, root int, component_id int")
    got = {r.doc_id: r for r in simhash_groups(docs, block_rows=block_rows).withColumn("hex", fingerprint_text("fp")).collect()}
    want = [plain_fingerprint(t) for t in texts]
    assert [got[i].hex for i in range(len(texts))] == [f"{f:016x}" for f in want]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (want[i] ^ want[j]).bit_count() <= 3]
    assert {i: got[i].component_id for i in got} == plain_groups(range(len(texts)), pairs)


@pytest.mark.parametrize("block_rows", [8192, 7])
def test_links_connect_like_all_pairs(spark, block_rows):
    """Chains, dense balls, and fingerprints just beyond the threshold."""
    rng = random.Random(4)
    fps = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fps.add(centre ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(6))))
    walk = rng.getrandbits(64)
    for _ in range(40):
        walk ^= sum(1 << k for k in rng.sample(range(64), 3))
        fps.add(walk)
    fps |= {0, 2**64 - 1, 0b1111, *(rng.getrandbits(64) for _ in range(50))}
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = [(r.a, r.b) for r in fingerprint_links(frame, block_rows=block_rows).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in links)
    every = sorted(map(signed, fps))
    pairs = [(a, b) for a in every for b in every if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert plain_groups(every, links) == plain_groups(every, pairs)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(50, 60), (60, 55), (70, 70), (50, 60)] + [(100 + i, 100) for i in range(1, 30)] + [(-5, 129)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = plain_groups({n for e in edges for n in e} - {70}, [(a, b) for a, b in edges if a != b])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_null_ids_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(None, ""), (None, "only me here now"), (7, None), (9, " "), (9, " ")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.fp == 0, r.component_id) for r in simhash_groups(docs).collect())
    assert got == [("7", True, 7), ("9", True, 7), ("9", True, 7), ("None", False, None), ("None", True, 7)]
    assert simhash_groups(docs.limit(0)).count() == 0
    assert sorted((str(r.doc_id), r.text) for r in one_of_each(docs).collect()) == [("7", None), ("None", "only me here now")]
