"""Merge of transforms at any depth, the array helpers against plain numpy, and words whose polynomials agree."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from bazar.llm import bwt, exchange, substring_dedup, suffix_dedup, suffix_tree_lm
from bazar.llm.text import PLACE_BITS, content_hashes, distinct, sliding_argmin, span_hashes
from test_dedup import brute_bytes

PARITY = [bin(i).count("1") % 2 for i in range(1024)]
ONE, OTHER = ("".join("ab"[p ^ flip] for p in PARITY) for flip in (0, 1))


@pytest.mark.parametrize("depth", [1, 4, 5, 7, 12])
def test_merge_finds_the_intervals_of_every_depth(depth):
    rng = random.Random(depth)
    for _ in range(20):
        groups = [list({bytes(rng.choice(b"\0ab\xff") for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 6))}) for _ in range(rng.randint(1, 4))]
        strings = [s for g in groups for s in g]
        shard = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
        texts = bwt.invert(bwt.transforms(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), shard))
        order, bounds = bwt.repeated_intervals(texts, depth)
        places = defaultdict(list)
        for first, s in zip(texts.firsts, [s for g in groups for s in sorted(g)]):
            for i in range(len(s) - depth + 1):
                places[s[i : i + depth]].append(int(first) + i)
        assert sorted(sorted(order[a:b].tolist()) for a, b in zip(bounds, bounds[1:])) == sorted(sorted(p) for p in places.values() if len(p) > 1)


def test_merge_of_nothing():
    order, bounds = bwt.repeated_intervals(bwt.invert([]), 10)
    assert len(order) == 0 and bounds.tolist() == [0]


def test_distinct_is_unique():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 5000):
        for bits, top in ((64, 2**64 - 1), (64, 1000), (20, 1 << 20)):
            values = rng.integers(0, top, size, dtype=np.uint64)
            values[: size // 3] = values[size // 2 : size // 2 + 1]
            for got, expected in zip(distinct(values, bits), np.unique(values, return_inverse=True)):
                assert (got == expected).all()


def test_sliding_argmin_is_the_leftmost_smallest():
    rng = np.random.default_rng(4)
    for total in (0, 3, 30, 70_000, 140_000):
        values = rng.integers(0, 2**64 - 1, total, dtype=np.uint64)
        values[::5] = 7
        for size in (1, 2, 5, 26):
            upper = values >> np.uint64(PLACE_BITS)
            expected = np.lib.stride_tricks.sliding_window_view(upper, size).argmin(1) + np.arange(total - size + 1) if total >= size else np.zeros(0, np.int64)
            assert (sliding_argmin(values, size) == expected).all()


def test_long_words_are_known_by_content(ready):
    data = np.frombuffer((ONE + OTHER).encode(), np.uint8)
    ends = np.array([0, 1024]), np.array([1024, 2048])
    assert len(set(span_hashes(data, *ends).tolist())) == 1 and len(set(content_hashes(data, *ends).tolist())) == 2

    words = [f"w{i}" for i in range(25)]
    texts = [" ".join([*words[:12], w, *words[12:]]) for w in (ONE, OTHER, ONE)]
    got = substring_dedup.substring_dedup(ready.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r.doc_id: r.n_removed for r in got.collect()} == {0: 0, 1: 0, 2: 26}

    learned, held = (next(i for i in range(100) if (zlib.crc32(str(i).encode()) % 10 == 0) == out) for out in (False, True))
    got = suffix_tree_lm.score(ready.createDataFrame([(learned, f"x {ONE}"), (held, f"x {OTHER}")], "doc_id bigint, text string"))
    assert {r.doc_id: (r.n_tokens, r.n_known) for r in got.collect()} == {learned: (3, 3), held: (3, 2)}


def test_suffix_dedup_at_an_odd_length(ready):
    passage = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRST"
    rows = [(0, passage[:52] + "!"), (1, "?" + passage[:52]), (2, passage[:51])]
    got = suffix_dedup.suffix_dedup(ready.createDataFrame(rows, "doc_id bigint, text string"), length=52).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 0, 1: 52, 2: 0}


@pytest.mark.parametrize("variants", [0, 8])
def test_only_anchors_with_different_segments_are_merged(ready, variants, monkeypatch):
    monkeypatch.setattr(exchange, "LEAST_CHUNK_BYTES", 1000)
    kept = []
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, stored=suffix_dedup.stored: kept.append(stored(df)) or kept[-1])
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(400)) for _ in range(10)]
    rows = [(i, texts[i % 10]) for i in range(40)] + [(100 + i, texts[i][60:200] + "?" + texts[i][250:]) for i in range(variants)]
    got = suffix_dedup.suffix_dedup(ready.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in got) == brute_bytes(rows, 50)
    assert sum(r.n_removed for r in got) > 30 * 400 - 1
    # the last step that is stored holds the answers of the slices that merged something
    assert bool(kept[-1].count()) == bool(variants)
    # what the sketch answered is read once: the chunks note their segments, one message each
    notes = kept[-2].filter(kept[-2].tag == suffix_dedup.NOTE_TAG)
    assert notes.count() == notes.select("chunk").distinct().count() > 1
