"""The registered text queries against their SQL, and the pipeline against a brute-force version."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as registered
import corpus_pipeline
from bazar.llm import quality_rules
from bazar.llm.queries import ORACLE, QUERIES
from checks.compare import connect, differences
from test_dedup import WORD, brute_components, brute_cuts, brute_fingerprint
from test_rules_and_scores import brute_leaks, brute_measures


def test_all_operators_are_registered():
    names = {name.split("_")[0] for name in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)} and registered.queries().keys() >= {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_every_row(spark, folder, name):
    source, key = ("pages", "page_id") if name.startswith("op9") else ("documents", "doc_id")
    rows = spark.read.parquet(f"{folder}/{source}.parquet").select(key)
    got = QUERIES[name](spark, folder)
    assert Counter(r[0] for r in got.select(key).collect()) == Counter(r[0] for r in rows.collect())


def test_pipeline_is_brute_force(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]

    def good(text):
        words, chars, symbols, again, repeated, lines = brute_measures(text)
        return words >= 20 and 100 * repeated <= 30 * words and 100 * symbols <= 10 * chars and not (again >= 3 and 100 * again > 30 * lines) and 2 * words <= chars <= 25 * words

    left = {k: t for k, t in docs.items() if good(t)}
    prints = [(k, brute_fingerprint(t, corpus_pipeline.SHINGLE)) for k, t in sorted(left.items())]
    left = {k: left[k] for (k, _), c in zip(prints, brute_components(prints)) if k == c}
    pruned = {k: rest.decode("utf-8", "ignore") if n_removed else left[k] for k, (_, n_removed, _, rest) in brute_cuts(left.items(), 50)}
    left = {k: t for k, t in pruned.items() if t == left[k] or WORD.search(t)}
    left = {k: t for k, t in left.items() if not brute_leaks(t, benchmark)[1]}

    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: r.text for r in got} == left and len(got) == len(left)
    assert all(r.n_chars == len(r.text) for r in got if r.text != docs[r.doc_id])
    assert sorted(r.position for r in got) == list(range(len(got)))


def test_stages_keep_the_columns(spark, messy, folder):
    docs = messy.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).columns == [*docs.columns, "block", "slot", "phase", "position"]
    assert quality_rules.CURRENT in quality_rules.POLICIES


def test_stages_of_an_empty_table(spark, nothing, folder):
    docs = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
