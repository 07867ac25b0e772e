"""A table with every awkward case: nulls in all columns, empty and long texts, repeated rows, clashing columns."""

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, ids string, copy int, n_words string, "
    "score string, labels int, id int, fp int, rid int, sha int, word int, row int, shuffle_key int, lang_pred int, text_hash int"
)


def messy_rows() -> list[tuple]:
    rnd = random.Random(5)
    vocab = ["the", "of", "and", "Thing", "wörd", "x", "alpha", "beta,", "GAMMA", "naïve", "in", "is", "日本", "to"]
    base = " ".join(rnd.choice(vocab) for _ in range(120))
    texts = [
        None, "", " \t\n", "word", "two words", "UPPER lower", "upper LOWER", base, base, base.upper(), base + " end", "x " * 30,
        "é" * 60, "ÉÉ", "éé", "a\n" * 12, "0123456789 " * 9, "under the MIT License", "Licensed under CC BY-NC 4.0.\nmore words here",
        "Apache License, Version 2.0 and the Apache License, Version 2.0", "#$%&*|<> " * 20, " lead and trail ", "▁ meta", "🙂 smile\r\nline",
        " ".join(rnd.choice(vocab) for _ in range(20_000)),
        *[" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 60))) for _ in range(40)],
    ]
    rows = [(k * 3 % 41, t, ["en", "de", None, "fr"][k % 4], ["a", "b", None, ""][k % 4 if k % 3 else 0], None if k % 5 else k) for k, t in enumerate(texts)]
    rows += rows[5:8] + [(None, "upper lower", None, None, None)] * 2 + [(None, base, "en", "a", 1)]
    clash = (True, "clash", 7, "clash", "clash", 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)
    return [r + clash for r in rows]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def texts(messy):
    return [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
