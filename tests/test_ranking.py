"""Numbering and first-K against brute force, with one group holding most rows."""

import random
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from inkfold.functions.ranking import first_k, number_rows


def brute(rows):
    groups = defaultdict(list)
    for g, o, i in rows:
        groups[g].append((o, i))
    return {i: n for g in groups for n, (o, i) in enumerate(sorted(groups[g]), 1)}


def test_numbers_of_a_hot_group_spread_over_partitions(spark):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 50}", rnd.randrange(40), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, o int, i int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(df, ["g"], ["o", "i"], "n")
        assert {r.i: r.n for r in numbered.collect()} == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_first_k_beyond_the_optimizer_limit(spark):
    rows = [("hot" if i % 3 else "cold", i % 7, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o int, i int")
    got = first_k(df, ["g"], ["o", "i"], 1500, "n")
    assert "row_number" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.i: r.n for r in got.collect()} == {i: n for i, n in brute(rows).items() if n <= 1500}


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "g string, o int")
    assert sorted((r.o, r.n) for r in number_rows(df, ["g"], ["o"], "n").collect()) == [(1, 1), (2, 2), (3, 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), min_size=1, max_size=60), st.integers(1, 6))
def test_first_k_and_numbers_agree(spark, pairs, k):
    rows = [(g, o, i) for i, (g, o) in enumerate(pairs)]
    want = brute(rows)
    df = spark.createDataFrame(rows, "g string, o int, i int")
    assert {r.i: r.n for r in number_rows(df, ["g"], ["o", "i"], "n").collect()} == want
    first = first_k(df, ["g"], ["o", "i"], k, "n")
    assert {r.i: r.n for r in first.collect()} == {i: n for i, n in want.items() if n <= k}
