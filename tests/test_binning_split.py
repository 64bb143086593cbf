"""Bins (F8), strata, hash sampling and the train/test split invariants."""

from pyspark.sql import functions as F

from mixlens.operators import binning, split
from mixlens.sources.files import read_table
from tests.conftest import SF_MID


def test_bins_fixture(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.9,), (5.0,), (None,)], "x double")
    out = binning.equal_width_bins(df, "x", 5, "b").collect()
    assert [r["b"] for r in out] == ["0", "1", "4", "4", None]


def test_constant_target_goes_to_last_bin(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert {r["b"] for r in binning.equal_width_bins(df, "x", 5, "b").collect()} == {"4"}


def test_nan_left_out_of_range(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("nan"),)], "x double")
    r = binning.target_range(df, "x").collect()[0]
    assert (r["lo"], r["hi"]) == (0.0, 10.0)


def test_range_runs_as_one_subquery(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    plan = binning.equal_width_bins(df, "x", 5, "b")._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_except_distinct_fixture(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(3,)], "v int")
    assert sorted(r["v"] for r in split.except_distinct(a, b).collect()) == [1, 2]


def test_split_is_whole_disjoint_and_layout_free(spark):
    orders = read_table(spark, SF_MID, "orders").select("o_orderkey", "o_totalprice")
    binned = binning.equal_width_bins(orders, "o_totalprice", 5, "stratum")
    s1 = split.train_test_split(binned, ["o_orderkey"], 0.2)
    s2 = split.train_test_split(binned.repartition(7), ["o_orderkey"], 0.2)
    a = {(r["o_orderkey"], r["split"]) for r in s1.collect()}
    b = {(r["o_orderkey"], r["split"]) for r in s2.collect()}
    assert a == b
    assert len(a) == orders.count()
    share = sum(1 for _, s in a if s == "train") / len(a)
    assert 0.78 < share < 0.82
    # each stratum keeps about the train share
    per = s1.groupBy("stratum").agg(F.avg((F.col("split") == "train").cast("double")).alias("t"),
                                    F.count("*").alias("n")).collect()
    for r in per:
        if r["n"] > 500:
            assert 0.75 < r["t"] < 0.85


def test_sample_by_hash_per_stratum_rates(spark):
    df = spark.range(0, 20000).withColumn("g", (F.col("id") % 2).cast("string"))
    out = split.sample_by_hash(df, ["id"], "g", {"0": 0.5, "1": 0.1})
    counts = {r["g"]: r["count"] for r in out.groupBy("g").count().collect()}
    assert 4700 < counts["0"] < 5300 and 800 < counts["1"] < 1200


def test_seeded_sample_runs(spark):
    df = spark.range(0, 1000).withColumn("g", F.lit("0"))
    n = split.sample_by_seeded(df, "g", {"0": 0.8}, 42).count()
    assert 700 < n < 900


def test_null_stratum_rules(spark):
    df = spark.range(0, 4000).withColumn("g", F.when(F.col("id") % 2 == 0, F.lit("0")))
    # the split keeps every row, NULL stratum included
    parts = split.train_test_split(df, ["id"], 0.2)
    assert parts.count() == 4000 and parts.where("g IS NULL").count() == 2000
    # sampling draws a NULL stratum only when asked to
    assert split.sample_by_hash(df, ["id"], "g", {"0": 1.0}).where("g IS NULL").count() == 0
    got = split.sample_by_hash(df, ["id"], "g", {"0": 1.0, None: 0.5}).where("g IS NULL").count()
    assert 850 < got < 1150


def test_the_maximum_is_labelled_where_the_last_edge_rounds_below_it(spark):
    lo, hi = -653.9851968418982, 54225.890941973405
    assert lo + (hi - lo) * 5.0 / 5.0 < hi
    df = spark.createDataFrame([(lo,), (hi,), (0.0,)], "x double")
    assert {r["x"]: r["b"] for r in binning.equal_width_bins(df, "x", 5, "b").collect()} == {lo: "0", hi: "4", 0.0: "0"}


def test_infinities_and_missing_targets(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(0.0,), (5.0,), (inf,), (-inf,), (nan,), (None,)], "x double")
    got = [r["b"] for r in binning.equal_width_bins(df, "x", 5, "b").collect()]
    assert got == ["0", "4", "4", "0", None, None]
    assert [r["b"] for r in binning.equal_width_bins(df, "x", 5, "b", null_label="none").collect()][-2:] == ["none", "none"]


def test_null_keys_are_drawn_like_any_key(spark):
    df = spark.createDataFrame([(None, i) for i in range(200)], "k string, i int")
    assert split.sample_by_hash(df, ["k"], None, 1.0).count() == 200
    sides = split.train_test_split(df, ["k", "i"], 0.5).groupBy("split").count().collect()
    assert all(60 < r["count"] < 140 for r in sides) and len(sides) == 2


def test_exact_split_takes_each_stratums_share_and_whole_keys(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 100 == 7, "rare").when(F.col("id") % 100 != 8, "often").alias("s"))
    got = split.train_test_split_exact(df, ["k"], "s", {"rare": 0.8, "often": 0.8})
    assert got.columns == ["k", "s", "split"]
    n = {(r["s"], r["split"]): r["count"] for r in got.groupBy("s", "split").count().collect()}
    assert n == {("rare", "train"): 8, ("rare", "test"): 2, ("often", "train"): 784, ("often", "test"): 196, (None, "test"): 10}
    train = {r["k"] for r in got.where("split = 'train' and s = 'rare'").collect()}
    assert train == {r["k"] for r in split.sample_exact(df, ["k"], "s", {"rare": 0.8}).collect()}
    # Three rows a key: a share that ends among a key's rows takes the key whole.
    thrice = df.where("s = 'rare'").crossJoin(spark.range(3).select(F.col("id").alias("copy")))
    sides = split.train_test_split_exact(thrice, ["k"], "s", {"rare": 0.5}).groupBy("k").agg(F.collect_set("split").alias("on")).collect()
    assert sorted(r["on"][0] for r in sides if len(r["on"]) == 1) == ["test"] * 5 + ["train"] * 5
    assert split.train_test_split_exact(df, ["k"], "s", {}).where("split = 'train'").isEmpty()
    assert split.train_test_split_exact(df, ["k"], "s", {"rare": 1.0}).where("split = 'train'").count() == 10
