"""Insert-ignore load: only new keys, duplicates ignored, idempotent; the
Structured Streaming (availableNow) form gives the same table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tradestar.streaming.incremental import insert_ignore, load_incremental, stream_insert_ignore
from tests.test_sources import BRONZE_CSV, write_csv_dir


def test_insert_ignore_only_new_keys(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string").write.parquet(target)
    incoming = spark.createDataFrame([(2, "changed"), (3, "c"), (3, "c"), (4, "z"), (4, "d")], "id long, v string")
    delta = insert_ignore(spark, incoming, target, ["id"])
    assert sorted(delta.collect()) == [(3, "c"), (4, "d")]  # keep-first per key: smallest row
    assert sorted(spark.read.parquet(target).collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    again = insert_ignore(spark, incoming, target, ["id"])
    assert again.count() == 0
    assert spark.read.parquet(target).count() == 4


def test_load_incremental_tables_and_dir(spark, tmp_dir):
    src = write_csv_dir(os.path.join(tmp_dir, "bronze_sample"), BRONZE_CSV)
    target = os.path.join(tmp_dir, "origem")
    first = load_incremental(spark, src, target, tables=["cambios", "transacoes"])
    assert set(first) == {"cambios", "transacoes"}
    assert spark.read.parquet(os.path.join(target, "transacoes")).count() == 4
    assert not os.path.exists(os.path.join(target, "paises"))
    second = load_incremental(spark, src, target, tables=["cambios", "transacoes"])
    assert all(df.count() == 0 for df in second.values())
    assert spark.read.parquet(os.path.join(target, "cambios")).count() == 3


def test_stream_available_now(spark, tmp_dir):
    src = os.path.join(tmp_dir, "arriving")
    os.makedirs(src)
    with open(os.path.join(src, "part1.csv"), "w") as fh:
        fh.write("100001,2,1,5,1,125000.50,80,1,1\n100002,1,1,5,1,10.00,1,1,1\n")
    with open(os.path.join(src, "part2.csv"), "w") as fh:
        fh.write("100002,1,1,5,1,10.00,1,1,1\n100003,1,2,5,1,99.90,3,1,1\n")
    target = os.path.join(tmp_dir, "transacoes")
    ckpt = os.path.join(tmp_dir, "stream_ckpt")
    stream_insert_ignore(spark, src, "transacoes", target, ckpt)
    ids = sorted(r["id"] for r in spark.read.parquet(target).collect())
    assert ids == [100001, 100002, 100003]
    # a new file with an old and a new key: only the new one lands
    with open(os.path.join(src, "part3.csv"), "w") as fh:
        fh.write("100003,1,2,5,1,99.90,3,1,1\n100004,1,2,5,1,5.00,1,1,1\n")
    stream_insert_ignore(spark, src, "transacoes", target, ckpt)
    ids = sorted(r["id"] for r in spark.read.parquet(target).collect())
    assert ids == [100001, 100002, 100003, 100004]


def test_stream_processing_time_trigger(spark, tmp_dir):
    src = os.path.join(tmp_dir, "arriving")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write("7,1,1,5,1,10.00,1,1,1\n")
    target = os.path.join(tmp_dir, "t")
    ckpt = os.path.join(tmp_dir, "ck")
    query = stream_insert_ignore(spark, src, "transacoes", target, ckpt, processing_time="1 second")
    try:
        query.processAllAvailable()
        with open(os.path.join(src, "b.csv"), "w") as fh:
            fh.write("7,1,1,5,1,10.00,1,1,1\n8,1,1,5,1,11.00,1,1,1\n")
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [7, 8]


def test_small_batch_never_shuffles_the_target(spark, tmp_dir):
    from tradestar.streaming.incremental import new_rows

    target = spark.range(0, 5000).withColumnRenamed("id", "k").withColumn("v", F.lit("old"))
    batch = spark.createDataFrame([(4999, "x"), (5000, "y")], "k long, v string")
    small = new_rows(batch, target, ["k"], incoming_rows=2)
    assert sorted(small.collect()) == [(5000, "y")]
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    large = new_rows(batch, target, ["k"], incoming_rows=None)
    assert sorted(large.collect()) == [(5000, "y")]
