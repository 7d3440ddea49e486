"""One key, or one key and text, that most rows share."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from bazar.llm import exchange, substring_dedup, suffix_dedup, suffix_tree_lm
from test_dedup import brute_bytes
from test_rules_and_scores import brute_lm


@pytest.fixture()
def hot(monkeypatch):
    monkeypatch.setattr(exchange, "LEAST_CHUNK_BYTES", 2000)
    rng = random.Random(21)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{i}x{j}" for j in range(25)) for i in range(30)]
    rows = [(None, texts[i % 30]) for i in range(90)] + [(7, texts[3])] * 90 + [(8 + i, texts[i]) for i in range(10)]
    return rows + [(100, "some other words " * 12)]


def test_rows_of_one_key_go_to_many_chunks(ready, hot):
    chunks = exchange.chunked(ready.createDataFrame(hot, "doc_id bigint, text string"), "doc_id", "text")
    sizes = Counter(r.chunk for r in chunks.rows.collect())
    assert chunks.count >= 8 and sum(sizes.values()) == len(hot) and max(sizes.values()) < len(hot) / 4


def test_results_do_not_depend_on_the_chunks_of_a_key(ready, hot):
    docs = ready.createDataFrame(hot, "doc_id bigint, text string").repartition(3)
    got = suffix_dedup.suffix_dedup(docs).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got) == brute_bytes(hot, 50)
    # the first row of every text keeps it, all others lose it
    whole = Counter(r.text for r in substring_dedup.substring_dedup(docs).collect() if r.n_removed == 0)
    assert {t: whole[t] for t in {t for _, t in hot[:90]}} == {t: 1 for _, t in hot[:90]}
    expected, _ = brute_lm(hot)
    scored = suffix_tree_lm.score(docs).collect()
    assert sorted((r.n_tokens, r.train_tokens, round(r.score, 6)) for r in scored) == sorted((n, t, round(b, 6)) for n, _, t, _, b in expected)
