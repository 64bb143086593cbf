"""Size-checked lookup join: broadcast within the bound, a regular join beyond it."""

from pyspark.sql import functions as F

from mixlens.operators.joins import fits_broadcast, has_at_most, lookup_join


def test_lookup_join_paths(spark):
    big = spark.range(0, 1000).withColumn("k", (F.col("id") % 10).cast("int"))
    small = spark.range(0, 10).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    within = lookup_join(big, small, "k", max_rows=100)
    assert within.count() == 1000
    assert "BroadcastHashJoin" in within._jdf.queryExecution().executedPlan().toString()
    beyond = lookup_join(big, small, "k", max_rows=5)
    assert beyond.count() == 1000
    assert sorted(r["v"] for r in beyond.where("id < 3").collect()) == [0, 2, 4]


def test_has_at_most(spark):
    df = spark.range(0, 10)
    assert has_at_most(df, 10) and not has_at_most(df, 9)


def test_lookup_join_hot_keys_beyond_the_bound(spark):
    """A key with a third of the rows, NULL keys and unmatched keys, beyond both bounds: no row lost, hot rows by broadcast."""
    k = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 != 1, (F.col("id") % 4000).cast("int"))
    big = spark.range(0, 20000).withColumn("k", k)
    small = spark.range(0, 3000).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    for how in ("inner", "left"):
        want = sorted(map(tuple, big.join(small, "k", how).select("id", "k", "v").collect()))
        for bound in ({"max_rows": 2000}, {"max_bytes": 20000}):
            got = lookup_join(big, small, "k", how, **bound)
            assert sorted(map(tuple, got.select("id", "k", "v").collect())) == want


def test_fits_broadcast_counts_bytes(spark):
    wide = spark.range(0, 10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert fits_broadcast(wide, 10, 20_000) and not fits_broadcast(wide, 10, 5_000)
    assert fits_broadcast(wide.where("id < 0"), 0, 0)
