from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bazar.functions import sum_units, units
from bazar.operators import joins
from bazar.operators import (
    collapse,
    count_product,
    distinct_values,
    global_rank,
    global_row_number,
    left_join_split,
    left_join_unique,
    lookup_join,
    money_product,
    null_counts,
    ordered,
    positions,
    row_counts,
    rows_where,
    stack_by_key,
    sum_product,
    top_k,
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def hot_keys(n, seed):
    """A third of the rows on one key, some without any key, the rest spread."""
    rng = random.Random(seed)
    return [rng.choice([7, 7, None, *range(100, 106)]) if rng.random() < 0.6 else rng.randrange(50) for _ in range(n)]


@pytest.fixture(scope="module")
def facts(spark):
    data = [(k, i) for i, k in enumerate(hot_keys(3000, 1))]
    return spark.createDataFrame(data, "k bigint, v bigint").repartition(5), data


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_hot_and_null_keys(spark, facts, how):
    df, data = facts
    lookup = {k: k * 10 for k in range(0, 106, 2)} | {7: 70}
    got = lookup_join(df, spark.createDataFrame(list(lookup.items()), "k bigint, w bigint"), "k", how)
    expected = Counter((k, v, lookup.get(k)) for k, v in data if how == "left" or k in lookup)
    assert rows(got.select("k", "v", "w")) == expected


def test_left_join_unique_keeps_null_keys(spark, facts):
    df, data = facts
    got = left_join_unique(df, spark.createDataFrame([(7, "hot"), (3, "cold")], "k bigint, w string"), "k")
    assert rows(got.select("k", "v", "w")) == Counter((k, v, {7: "hot", 3: "cold"}.get(k)) for k, v in data)


def test_left_join_split_with_hot_right_side(spark):
    left = [(k, i) for i, k in enumerate([*range(60), None, None, 7])]
    right = [(k, i) for i, k in enumerate(hot_keys(900, 2))]
    matches = defaultdict(list)
    for k, w in right:
        matches[k].append(w)
    got = left_join_split(spark.createDataFrame(left, "k bigint, v bigint"), spark.createDataFrame(right, "k bigint, w bigint"), "k")
    expected = Counter((k, v, w) for k, v in left for w in (matches[k] if k is not None and matches[k] else [None]))
    assert rows(got.select("k", "v", "w")) == expected


def test_fan_out_is_weighted_not_built(spark):
    rng = random.Random(3)
    a = [(rng.randrange(20), rng.choice("xyz"), round(rng.uniform(0, 9), 2)) for _ in range(300)]
    b = [(rng.randrange(25),) for _ in range(200)]
    left = collapse(spark.createDataFrame(a, "k bigint, g string, m double"), ["k", "g"], units={"paid": units("m")}, copies="n")
    right = collapse(spark.createDataFrame(b, "k bigint"), ["k"])
    got = left.join(right, "k").groupBy("g").agg(count_product("n", "copies"), money_product("paid", "copies"))
    expected = defaultdict(lambda: [0, 0])
    for k, g, m in a:
        for (j,) in b:
            if j == k:
                expected[g][0] += 1
                expected[g][1] += round(m * 10000)
    assert {r[0]: [r[1], int(r[2])] for r in got.collect()} == dict(expected)


def test_stack_by_key_merges_tables_without_pairs(spark):
    a = spark.createDataFrame([(1, 2), (1, 3), (2, 5)], "k bigint, x bigint")
    b = spark.createDataFrame([(1, 10), (3, 20), (1, 30)], "k bigint, y bigint")
    got = stack_by_key("k", [a.withColumn("low", F.col("x")), b], sums=("x", "y"), least=("low",))
    assert rows(got.select("k", "x", "y", "low")) == Counter({(1, 5, 40, 2): 1, (2, 5, None, 5): 1, (3, None, 20, None): 1})


def ranked(values):
    return {v: 1 + sum(1 for o in values if o is not None and (v is None or o > v)) for v in set(values)}


@pytest.mark.parametrize("case", ["ties over several ranges", "all equal", "all null", "distinct", "one row", "empty"])
def test_global_rank_is_rank(spark, case):
    rng = random.Random(4)
    values = {
        "ties over several ranges": [rng.choice([5.0, 5.0, 5.0, None, None, rng.uniform(0, 10)]) for _ in range(1500)],
        "all equal": [1.0] * 400,
        "all null": [None] * 200,
        "distinct": [float(i) for i in range(500)],
        "one row": [2.0],
        "empty": [],
    }[case]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, v double").repartition(4)
    expected = ranked(values)
    got = global_rank(df, "v", "place")
    assert dict(got.dtypes)["place"] == "bigint"
    assert rows(got.select("id", "place")) == Counter((i, expected[v]) for i, v in enumerate(values))


def test_rank_of_equal_then_lower_values(spark):
    df = spark.createDataFrame([("a", 9.0), ("b", 9.0), ("c", 1.0)], "id string, v double")
    assert {r.id: r.place for r in global_rank(df, "v", "place").collect()} == {"a": 1, "b": 1, "c": 3}


def test_global_row_number(spark):
    rng = random.Random(5)
    data = [(i, rng.choice(["p", "q", "r", None])) for i in range(700)]
    df = spark.createDataFrame(data, "id bigint, g string").repartition(4)
    order = sorted(data, key=lambda r: (r[1] is None, -ord(r[1] or " "), r[0]))
    got = global_row_number(df, "g", ["id"], "place")
    assert {r.id: r.place for r in got.collect()} == {r[0]: n for n, r in enumerate(order, 1)}


def test_orders_put_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, v int")
    assert [r.id for r in ordered(df, ["v"]).collect()] == [2, 3, 1]
    assert [r.id for r in ordered(df, ["-v"]).collect()] == [3, 2, 1]
    assert [r.id for r in top_k(df, [F.col("v") * 2, "id"], 2).collect()] == [3, 2]


def test_positions_number_a_sorted_table(spark):
    rng = random.Random(9)
    data = [(i, rng.choice([None, 1.0, 2.0, rng.uniform(0, 3)]), rng.choice(["a", "b", None])) for i in range(900)]
    df = spark.createDataFrame(data, "id bigint, v double, g string").repartition(5)
    got = positions(df, ["-v", "g"], "nth").collect()
    assert sorted(r.nth for r in got) == list(range(1, 901))
    order = lambda v, g: (v is None, -(v or 0), g is None, g or "")
    by_place = [order(r.v, r.g) for r in sorted(got, key=lambda r: r.nth)]
    assert by_place == sorted(by_place)
    text = final_plan(positions(df, ["-v"], "nth"))
    # only the counts per range come to one task
    assert "SinglePartition" in text and text.count("Scan ExistingRDD") == 1
    assert positions(df.limit(0), ["v"], "nth").count() == 0


def test_profiles(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 2)], "a string, b int")
    assert null_counts(df, ["a", "b"]).first().asDict() == {"a_nulls": 3, "b_nulls": 0}
    assert rows(row_counts({"t": df, "u": df.limit(1)})) == Counter({("t", 3): 1, ("u", 1): 1})
    assert rows(distinct_values(df, "b")) == Counter({(1,): 1, (2,): 1})
    assert rows_where(df, F.col("b") == 2).count() == 2
    assert rows_where(df, F.col("b") == 2, limit=1).count() == 1


def test_products_of_counts_outgrow_64_bits(spark):
    big = 5_000_000_000
    df = spark.createDataFrame([(big, big, 3)], "a bigint, b bigint, u bigint")
    got = df.agg(sum_product("a", "b").alias("n"), money_product("u", "a", "b").alias("m")).first()
    assert int(got.n) == big * big and int(got.m) == 3 * big * big


def test_money_that_is_none(spark):
    df = spark.createDataFrame([(1e15,), (float("inf"),), (float("-inf"),), (float("nan"),), (2.5,), (None,)], "x double")
    assert [None if r[0] is None else int(r[0]) for r in df.select(units("x")).collect()] == [10**19, None, None, None, 25000, None]
    assert int(df.agg(sum_units(units("x"))).first()[0]) == 10**19 + 25000


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_reads_rows_twice(spark, folder):
    rows_df = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    lookup = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    text = planned(lookup_join(rows_df, lookup, "l_orderkey"))
    # once for the join, and once for the frequent keys, whose table is broadcast to both sides
    assert text.count("FileScan parquet [l_orderkey#") <= 3 and text.count("FileScan parquet [o_orderkey#") == 1


def test_left_join_unique_reads_each_side_once(spark, folder):
    left = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    right = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_nationkey")
    text = planned(left_join_unique(left, right, "c_custkey"))
    assert text.count("FileScan") == 2


def test_ranks_store_nothing_and_run_no_job_while_planned(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("double").alias("v")).repartition(4)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "planning")
    planned_only = [global_rank(df, "v", "place"), global_row_number(df, "v", ["id"], "place")]
    assert not tracker.getJobIdsForGroup("ranks")
    assert all(d.count() == 1000 for d in planned_only)


def final_plan(df) -> str:
    """The plan as it ran, each scan shown once however often its output was read."""
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


def test_ranks_read_their_input_once(spark, folder):
    """The counts per range are read from the exchange the rows went through."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    for df in (global_row_number(orders, "o_totalprice", ["o_orderkey"], "place"), global_rank(orders, "o_custkey", "place")):
        text = final_plan(df)
        assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_a_value_most_rows_share_spans_ranges(spark):
    """No task of a rank gets all rows of one value."""
    df = spark.range(40000).select("id", F.when(F.col("id") % 3 > 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked_rows = global_rank(df, "v", "place").withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = Counter(r.task for r in ranked_rows)
    assert max(sizes.values()) < 40000 / 2
    assert {r.place for r in ranked_rows if r.v == 7.0} == {sum(1 for i in range(0, 40000, 3) if i > 7) + 1}


def test_ranks_without_a_shared_exchange_stop(spark):
    """Two readers that see different ranges must not give numbers."""
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(50000).select("id", F.hash("id").alias("v")).repartition(6)
        got = global_row_number(df, "v", ["id"], "place")
        try:
            places = sorted(r.place for r in got.collect())
        except Exception as error:
            assert "dealt out twice" in str(error)
        else:
            assert places == list(range(1, 50001))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_hot_key_of_a_tiny_file_is_spread(spark, tmp_path):
    """A third of the rows on one key, in a file of a few kilobytes: every task of the join gets its share."""
    spark.range(60000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    lookup = spark.range(60000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(df, lookup, "k").withColumn("task", F.spark_partition_id())
        sizes = sorted(r["count"] for r in joined.groupBy("task").count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 60000 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


@pytest.fixture()
def no_help(spark):
    """Neither broadcasts nor run-time splits: what is left is the operator's own doing."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def task_sizes(df):
    return sorted(r["count"] for r in df.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect())


def test_a_key_of_one_in_two_thousand_is_split(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 2000 == 0, 7).otherwise(F.col("id") + 10).alias("k"), F.col("id").alias("v"))
    pieces = {r["__bucket"]: r["__pieces"] for r in joins.hot_buckets(df, "k").collect()}
    assert len(pieces) == 1 and set(pieces.values()) == {-(-101 * joins.SHARES // 200_000)} == {3}
    assert {(r.k, r["__pieces"]) for r in joins.hot_keys(df, "k").collect()} == {(7, 3)}
    assert joins.hot_keys(df.filter("k > 10"), "k").count() == 0


@pytest.fixture()
def few_buckets(monkeypatch):
    """Every bucket holds several keys, hot ones among them."""
    monkeypatch.setattr(joins, "BUCKETS", 8)
    monkeypatch.setattr(joins, "SHARES", 20)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_of_keys_in_hot_buckets(spark, facts, few_buckets, how):
    df, data = facts
    lookup = {k: k * 10 for k in range(0, 106, 2)} | {7: 70}
    got = lookup_join(df, spark.createDataFrame(list(lookup.items()), "k bigint, w bigint"), "k", how)
    assert rows(got.select("k", "v", "w")) == Counter((k, v, lookup.get(k)) for k, v in data if how == "left" or k in lookup)


@pytest.mark.parametrize("seed", [6, 7, 8])
def test_left_join_split_with_keys_hot_on_either_side(spark, few_buckets, seed):
    rng = random.Random(seed)
    # hot on both sides, on one side only, and on one side without a row on the other
    keys = [7, 8, 9, 10, None, *range(20, 40)]
    left = [(k, i) for i, k in enumerate(rng.choices(keys, [30, 20, 0, 25, 10] + [1] * 20, k=200))] + [(7, 0)] * 3
    right = [(k, i) for i, k in enumerate(rng.choices(keys, [30, 0, 30, 1, 10] + [1] * 20, k=200))] + [(7, 0)] * 3
    matches = defaultdict(list)
    for k, w in right:
        matches[k].append(w)
    got = left_join_split(spark.createDataFrame(left, "k bigint, v bigint"), spark.createDataFrame(right, "k bigint, w bigint"), "k")
    assert got.columns == ["k", "v", "w"]
    assert rows(got) == Counter((k, v, w) for k, v in left for w in (matches[k] if k is not None and matches[k] else [None]))


def test_no_task_of_a_split_join_outgrows_the_others(spark, no_help):
    """A third of the rows of both sides on one key, with no help from the engine."""
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))
    joined = left_join_split(left, right, "k")
    sizes = task_sizes(joined)
    assert sum(sizes) == 2001 * 301 + 3999 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_split_join_reads_rows_once_and_keys_for_counts(spark, folder):
    left = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    right = spark.read.parquet(f"{folder}/lineitem.parquet").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    text = planned(left_join_split(left, right, "o_orderkey"))
    # all columns are read in one place only; the other scans are of the key
    assert text.count("FileScan parquet [o_orderkey#") - text.count("ReadSchema: struct<o_orderkey:bigint>") == 1
    assert text.count("ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>") == 1
