"""Permutation invariance of the whole build, and the plan shape of dense keys."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tradestar.plans.pipeline import warehouse_for
from tradestar.plans.star import build_star
from tradestar.sources.bronze import Bronze


def _shuffled(bronze: Bronze, seed: int) -> Bronze:
    """Same rows, different order and partitioning."""
    return Bronze(
        **{
            name: (None if df is None else df.orderBy(F.rand(seed)).repartition(7 + seed))
            for name, df in bronze.tables().items()
        }
    )


def test_build_is_permutation_invariant(spark):
    built = warehouse_for(spark, SF_SMALL)
    other = build_star(spark, _shuffled(built.bronze, 3))
    for name, df in built.star.tables().items():
        a = sorted(df.collect())
        b = sorted(other.tables()[name].collect())
        assert a == b, name
    assert sorted(built.star.discard_audit.collect()) == sorted(other.discard_audit.collect())


def _single_partition_exchanges_outside_broadcasts(plan: str) -> list[str]:
    """``Exchange SinglePartition`` lines not nested under a BroadcastExchange."""
    bad = []
    broadcast_depth = None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if broadcast_depth is not None and depth <= broadcast_depth:
            broadcast_depth = None
        if "BroadcastExchange" in line and broadcast_depth is None:
            broadcast_depth = depth
        if "SinglePartition" in line and "Exchange" in line and broadcast_depth is None:
            bad.append(line.strip())
    return bad


def test_dense_key_never_ships_the_table_to_one_task(spark):
    df = E.queries()["surrogate_key_dense"](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert _single_partition_exchanges_outside_broadcasts(plan) == []


def test_fact_numbering_is_range_partitioned(spark):
    built = warehouse_for(spark, SF_SMALL)
    fact = built.star.fact
    fact.write.format("noop").mode("overwrite").save()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert _single_partition_exchanges_outside_broadcasts(plan) == []
    assert "BroadcastHashJoin" in plan  # offsets per partition are broadcast


def test_plan_check_detects_a_single_task_window(spark):
    """Positive control: an unpartitioned row_number over the table is flagged."""
    from pyspark.sql import Window

    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = lineitem.withColumn("rn", F.row_number().over(Window.orderBy("l_orderkey")))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert _single_partition_exchanges_outside_broadcasts(plan) != []


def test_range_path_for_every_dimension_gives_the_same_star(spark):
    """small_key_rows=0 sends every dimension through the range-partitioned
    numbering; max_broadcast_rows=0 turns every lookup into a shuffled join."""
    built = warehouse_for(spark, SF_SMALL)
    other = build_star(spark, built.bronze, max_broadcast_rows=0, small_key_rows=0)
    for name, df in built.star.tables().items():
        assert sorted(df.collect()) == sorted(other.tables()[name].collect()), name
