"""Dense surrogate keys: dense, ordered, deterministic, both strategies."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tradestar.operators.keys import bounded_broadcast, count_rows, dense_key, lookup_frame


def _frame(spark, rows, parts):
    return spark.createDataFrame(rows, "a long, b string").repartition(parts)


def test_range_path_is_dense_and_ordered(spark):
    rows = [(i % 97, f"x{i}") for i in range(5000)]
    df = _frame(spark, rows, 7)
    out = dense_key(df, ["a", "b"], "sk").collect()
    assert sorted(r["sk"] for r in out) == list(range(1, 5001))
    ordered = sorted(out, key=lambda r: (r["a"], r["b"]))
    assert [r["sk"] for r in ordered] == list(range(1, 5001))


def test_small_path_equals_range_path(spark):
    rows = [(i % 13, f"y{i % 50}") for i in range(400)]
    df = _frame(spark, list(set(rows)), 3)
    n = df.count()
    small = {(r["a"], r["b"]): r["sk"] for r in dense_key(df, ["a", "b"], "sk", rows=n).collect()}
    big = {(r["a"], r["b"]): r["sk"] for r in dense_key(df, ["a", "b"], "sk").collect()}
    assert small == big


def test_permutation_invariance(spark):
    rows = [(i % 31, f"z{i}") for i in range(3000)]
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    a = {(r["a"], r["b"]): r["sk"] for r in dense_key(_frame(spark, rows, 5), ["a", "b"], "sk").collect()}
    b = {(r["a"], r["b"]): r["sk"] for r in dense_key(_frame(spark, shuffled, 11), ["a", "b"], "sk").collect()}
    assert a == b


def test_keep_numbers_only_kept_rows(spark):
    rows = [(i, "drop" if i % 3 == 0 else "keep") for i in range(3000)]
    df = _frame(spark, rows, 6)
    out = dense_key(df, ["a"], "sk", keep=F.col("b") == "keep").collect()
    kept = sorted((r["a"], r["sk"]) for r in out if r["b"] == "keep")
    assert [sk for _, sk in kept] == list(range(1, len(kept) + 1))
    assert all(r["sk"] is None for r in out if r["b"] == "drop")


def test_nulls_sort_first(spark):
    df = spark.createDataFrame([(None, "n"), (2, "b"), (1, "a")], "a long, b string")
    out = {r["b"]: r["sk"] for r in dense_key(df, ["a"], "sk").collect()}
    assert out == {"n": 1, "a": 2, "b": 3}


def test_count_rows_and_bounded_broadcast(spark):
    a = spark.range(10)
    b = spark.range(3)
    assert count_rows({"a": a, "b": b}) == {"a": 10, "b": 3}
    plan_small = a.join(bounded_broadcast(b, max_rows=5), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan_small


def test_lookup_never_fans_out(spark):
    dim = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "id long, sk long")
    out = {r["id"]: r["sk"] for r in lookup_frame(dim, "id", "sk").collect()}
    assert out == {1: 10, 2: 12}
