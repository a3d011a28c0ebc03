import hashlib
import os
import random

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from test_decontaminate import plain_leaks
from test_line_dedup import edited
from test_line_dedup import plain as plain_lines
from test_near_copies import plain as plain_copies
from test_quality_rules import plain as plain_quality

import __spark_entry__ as entry
import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


def corpus(odd_texts):
    rng = random.Random(12)
    vocabulary = ["the", "and", "of", *(f"{a}{b}" for a in ("tho", "rea", "lin", "mer") for b in ("ning", "ble", "ster", "and", "ous", "ly"))]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    items = [(i, line(18)) for i in range(4)]
    texts = ["\n".join(line(rng.randrange(4, 25)) for _ in range(rng.randrange(2, 6))) for _ in range(40)]
    texts += [texts[0], texts[1] + "\n" + line(12), edited(rng, texts[2], 2)]
    texts += [line(20) + " " + items[k][1] + " " + line(10) for k in (0, 1, 2)]
    texts += ["#### $$$$ %%% " * 20, "spam spam spam spam spam " * 30, "\n".join([line(8)] * 9), texts[3].replace("\n", " \n") + "\n\n" + line(9)]
    near = line(400)
    texts += [near, near[:-1] + " indeed.", near.replace(" of ", " off ", 1)]
    return [*enumerate([*odd_texts[:14], *texts])], items


def expected(rows, items):
    rows = [(d, t) for d, t in rows if plain_quality(t)["kept"]]
    cleaned = plain_lines(rows, 2, 32)
    rows = [(d, c[0]) for (d, _), c in zip(rows, cleaned) if c[2] < c[1] or not c[2]]
    left = set(plain_copies(rows))
    rows = [(d, t) for d, t in rows if d in left]
    leaked = {d for d, _ in plain_leaks(rows, items)}
    rows = [(d, t) for d, t in rows if d not in leaked]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for d, t in rows:
        ids = library.encode(t)
        out.append((d, len(ids), ids, *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))))
    return out


def test_pipeline_against_brute_force(spark, odd_texts, tmp_path):
    rows, items = corpus(odd_texts)
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = expected(rows, items)
    assert 30 < len(want) < len(rows) - 12
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "s", 0)], COLUMNS)
    names = ["_lines", "lines", "row", "digest", "_first_id", "_first_digest", "_leak_id", "_leak_digest", "first", "root", "a b", "a.b"]
    for c in names:
        docs = docs.withColumn(c, F.lit("x"))
    for name, function in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            result = function(spark, table, str(tmp_path))
            assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in docs.schema], name
            result.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 2


def test_registered_queries():
    names = {name for name in entry.queries() if name.startswith("op") and name[2].isdigit()}
    assert {int(name[2:].split("_")[0]) for name in names} == set(range(1, 14)) and "pipeline" in entry.queries()
    assert os.path.samefile(corpus_pipeline.__file__, os.path.join(os.path.dirname(entry.__file__), "corpus_pipeline.py"))
