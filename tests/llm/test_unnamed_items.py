"""Benchmark items without an id, in the query and in the pipeline."""

from __future__ import annotations

import corpus_pipeline
from bazar.llm.queries import QUERIES


def test_items_without_an_id_hit(ready, tmp_path):
    docs = [(1, "one two three four"), (2, "Alpha beta"), (3, "delta"), (4, "zeta alpha beta delta"), (5, None)]
    items = [(None, "alpha BETA"), (None, "delta"), (7, "delta"), (8, None)]
    ready.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ready.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in QUERIES["op7_decontamination"](ready, str(tmp_path)).collect()}
    assert got == {1: (0, 0, False), 2: (2, 1, True), 3: (1, 2, True), 4: (3, 2, True), 5: (0, 0, False)}
    clean = corpus_pipeline.decontamination(ready, ready.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert sorted(r.doc_id for r in clean.collect()) == [1, 5]
