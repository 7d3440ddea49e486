from __future__ import annotations

import random

import pytest

from bazar.llm.tables import prepared

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, score string, fingerprint string, chunk string, row string, doc string, position string, key string"


@pytest.fixture(scope="session")
def ready(spark):
    return prepared(spark)


def messy_rows():
    """NULL and empty texts, one very long text, repeated rows, a NULL key, copies, and columns called like internal ones."""
    rng = random.Random(11)
    words = ["alpha", "Beta", "gämma", "delta", "the", "of", "#x", "日本", "e", "zeta."]
    body = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty twentyone"
    texts = [None, "", " \t\n", "word", body(30), body(40) + "\n" + passage, passage + " " + body(10), passage, passage, body(4000), "a" * 3000, "x y\nx y\n\nx y", body(25), "é" * 60, "q" + "é" * 59]
    rows = [(i, t, "en", ["s0", "s1", None][i % 3], len(t or ""), -1, "s", "f", "c", "r", "d", "p", "k") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, passage, "en", "s0", 1, -1, "s", "f", "c", "r", "d", "p", "k")]
    return rows


@pytest.fixture(scope="session")
def messy(ready):
    return ready.createDataFrame(messy_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def nothing(ready):
    return ready.createDataFrame([], COLUMNS)
