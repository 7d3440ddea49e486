"""Benchmarks of several blocks, and what their windows take in memory."""

from __future__ import annotations

import random
from collections import Counter

from bazar.llm import decontaminate
from test_rules_and_scores import brute_leaks


def test_windows_take_bounded_memory():
    rng = random.Random(3)
    items = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(1, 400)))) for i in range(2000)]
    size = sum(len(t) for _, t in items)
    assert size > 1_000_000 and decontaminate.NGrams(items, 10).nbytes < 12 * size


def test_several_blocks_are_brute_force(ready):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "Delta", "e1", "é", "zeta", "日本"]
    body = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, body(rng.choice([0, 1, 4, 9, 10, 11, 60]))) for i in range(60)]
    items += [(70, items[5][1]), (71, items[5][1])]
    rows = [(i, rng.choice([body(30), f"x {rng.choice(items)[1]} y", "", None])) for i in range(120)]
    docs = ready.createDataFrame(rows, "doc_id bigint, text string")
    got = decontaminate.find_leaks(docs, ready.createDataFrame(items, "item_id bigint, text string"), block_bytes=800).collect()
    assert Counter((r.text, str((r.n_words, r.hit_words, r.items))) for r in got) == Counter((t, str(tuple(brute_leaks(t, items)))) for _, t in rows)
