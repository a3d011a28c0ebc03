import random
import re

import pytest
from pyspark.sql import functions as F

from rillcast.llm.quality_rules import STOP_WORDS, Threshold, kept_documents, quality_rules


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    places = {k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    stop = {v for s in STOP_WORDS for v in (s, s.capitalize(), s.upper())}
    n = len(words)
    out = {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(places), "n_stop_words": sum(w in stop for w in words), "n_lines": len(lines),
    }
    out["base_failed"] = n < 10 or 100 * out["n_repeat_words"] > 20 * n
    out["failed"] = [
        name for name, bad in (
            ("word_length", n and not 2 * n <= out["word_chars"] <= 12 * n), ("symbols", n and out["n_symbols"] > 0.1 * n),
            ("stop_words", n >= 40 and out["n_stop_words"] < 0.02 * n), ("repeated_lines", len(lines) >= 5 and out["n_dup_lines"] > 0.4 * len(lines)),
        ) if bad
    ]
    out["kept"] = not out["base_failed"] and not out["failed"]
    return out


@pytest.fixture()
def texts(odd_texts):
    rng = random.Random(11)
    vocabulary = ["the", "Of", "and", "thoin", "reath", "#a", "b*c", "é", "<x>"]
    made = []
    for _ in range(150):
        line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(9)))
        lines = [line() for _ in range(rng.randrange(1, 8))]
        lines += rng.choices(lines, k=rng.randrange(4))
        made.append(rng.choice(["\n", "\r\n", " \t"]).join(lines))
    clean = " ".join(f"{w}{i}" if i % 4 else "the" for i, w in enumerate(["word", "other", "third"] * 30))
    return [*odd_texts[:40], *made, clean, clean + " " + clean, "a b c d e " * 40, "one two three four five six one two three four five"]


def test_counts_and_verdicts(spark, texts):
    docs = spark.createDataFrame([(i, t, 5, "q") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, w string")
    judged = quality_rules(docs)
    assert "Python" not in judged._jdf.queryExecution().executedPlan().toString()
    for row in judged.collect():
        assert row.quality.asDict() == plain(texts[row.doc_id]), texts[row.doc_id]
        assert (row.n_words, row.w) == (5, "q")
    kept = kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts) if plain(t)["kept"]}


def test_own_table_long_text_and_empty_table(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60_000)) + " end" * 9), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.quality for r in quality_rules(docs, [Threshold("long", "n_words", "n_lines", None, 100)]).collect()}
    assert got[1].n_words == 60_009 and got[1].n_repeat_words == 9 and got[1].failed == ["long"]
    assert got[2].n_words == 0 and got[2].base_failed and got[2].failed == []
    assert quality_rules(docs, []).where(F.col("quality.kept")).count() == 1
    assert quality_rules(docs.limit(0)).count() == 0
    again = quality_rules(docs.selectExpr("*", "1 AS quality"))
    assert again.columns == ["doc_id", "text", "quality"] and again.where("quality.base_failed").count() == 1
