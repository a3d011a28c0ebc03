import random

import pytest


@pytest.fixture()
def odd_texts():
    """Texts with nulls, blanks, special strings, accents, very long words and repeats."""
    rng = random.Random(7)
    letters = "aA.,'<|>! \n\t́é1²\x01ß　"
    noise = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(200)]
    return [
        None, "", " \n ", "don't STOP'S <|endoftext|>x <|ENDOFTEXT|> a<|startoftext|>", "É é. a.́   b\x01c \x01",
        "İstanbul ΑΣ ﬁ 123.45, 　x", 'a.,b., "x." (y.)', "x" * 5000, "same text", "same text", "▁ a▁b  ▁", "日本語 \U0001f600 ok",
        "word " * 4000, *noise,
    ]


@pytest.fixture()
def odd_docs(spark, odd_texts):
    rows = [(i, t, "en", None, i % 3) for i, t in enumerate(odd_texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int")
