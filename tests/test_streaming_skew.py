"""Streaming features and a hot entity in the long form."""

import pytest
from pyspark.sql import functions as F

from mixlens.operators.composition import composition_stats_long
from mixlens.session import scratch_path
from mixlens.streaming.composition import run_stats_stream, stats_stream

COLS = ["1", "2", "3", "4"]


def _props(spark):
    return spark.createDataFrame([(1, 1.0), (2, 7.0), (3, 3.0), (4, 5.0)], "component int, prop double")


def test_stream_matches_batch_and_is_incremental(spark):
    schema = "entity_id long, `1` double, `2` double, `3` double, `4` double"
    src = scratch_path(spark, "src")
    spark.createDataFrame([(0, 50.0, 30.0, 20.0, 0.0)], schema).write.parquet(src)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    wide_schema = spark.read.parquet(src).schema
    out = run_stats_stream(spark, src, wide_schema, COLS, _props(spark), ["prop"], sink, ckpt)
    assert [r["prop_mean"] for r in out.collect()] == [pytest.approx(3.2)]
    # A new file is picked up by the next run; the first is not reprocessed.
    spark.createDataFrame([(1, 0.0, 100.0, 0.0, 0.0)], schema).write.mode("append").parquet(src)
    out = run_stats_stream(spark, src, wide_schema, COLS, _props(spark), ["prop"], sink, ckpt)
    got = {r["entity_id"]: r for r in out.collect()}
    assert len(got) == 2 and got[1]["prop_mode2"] == 1.0


def test_stream_split_column(spark):
    schema = "entity_id long, `1` double, `2` double, `3` double, `4` double"
    src = scratch_path(spark, "src")
    spark.range(0, 200).select("id", F.lit(50.0), F.lit(50.0), F.lit(0.0), F.lit(0.0)).toDF(
        "entity_id", *COLS).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out = stats_stream(stream, COLS, _props(spark), ["prop"], split_keys=["entity_id"])
    assert out.isStreaming and "split" in out.columns


def test_hot_entity_is_collapsed_before_the_shuffle(spark):
    # One entity holds most rows (many copies of few components).
    hot = spark.range(0, 30000).select(F.lit(7).cast("long").alias("entity_id"),
                                       (F.col("id") % 2 + 1).cast("int").alias("component"),
                                       F.lit(0.01).alias("weight_pct"))
    cold = spark.createDataFrame([(1, 3, 100.0)], "entity_id long, component int, weight_pct double")
    out = composition_stats_long(hot.union(cold), _props(spark), ["prop"])
    got = {r["entity_id"]: r for r in out.collect()}
    # 15000 * 0.01 = 150 on each of components 1 and 2
    assert got[7]["prop_mean"] == pytest.approx(1.5 * 1 + 1.5 * 7)
    assert got[7]["prop_mode1"] == 1.0 and got[7]["prop_mode2"] == 1.0
    assert got[1]["prop_mean"] == pytest.approx(3.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # map-side combine before the exchange


def test_bucketed_mix_needs_no_shuffle(spark):
    import uuid

    from mixlens.sinks import write_bucketed
    mix = spark.createDataFrame([(e, c, 100.0 / 3) for e in range(40) for c in (1, 2, 3)],
                                "entity_id long, component int, weight_pct double")
    table = write_bucketed(mix, f"mix_{uuid.uuid4().hex[:8]}", scratch_path(spark, "bucketed"), "entity_id", 4)
    out = composition_stats_long(table, _props(spark), ["prop"])
    assert out.count() == 40
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
