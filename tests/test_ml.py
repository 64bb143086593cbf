"""ML stages: persistable composition transformer, forest fit/save/load/score, metrics."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from mixlens.ml.regression import evaluate_rmse, fit_save_load, regression_pipeline
from mixlens.ml.transformers import CompositionStats
from mixlens.operators import split
from mixlens.operators.metrics import regression_metrics
from mixlens.session import scratch_path
from mixlens.sources.files import read_table
from tests.conftest import SF_SMALL


def test_composition_stage_save_load(spark):
    props = spark.createDataFrame([(1, 1.0), (2, 7.0), (3, 3.0), (4, 5.0)], "component int, prop double")
    wide = spark.createDataFrame([(0, 50.0, 30.0, 20.0, 0.0)], "entity_id long, `1` double, `2` double, "
                                 "`3` double, `4` double")
    stage = CompositionStats.from_table(props, ["prop"], ["1", "2", "3", "4"])
    path = scratch_path(spark, "stage")
    Pipeline(stages=[stage]).fit(wide).write().overwrite().save(path)
    row = PipelineModel.load(path).transform(wide).collect()[0]
    assert row["prop_mean"] == pytest.approx(3.2) and row["prop_mode2"] == 7.0


def test_forest_rows_save_load_and_beats_mean(spark):
    # In the synthetic lineitem, l_extendedprice does not depend on the line's
    # other columns, so the invariant is checked on a target that does.
    lines = read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                           "l_discount", "l_tax")
    lines = lines.withColumn("l_extendedprice", F.col("l_quantity") * (1 - F.col("l_discount")))
    lines = split.train_test_split(lines, ["l_orderkey"], 0.2)
    train, test = lines.where("split = 'train'"), lines.where("split = 'test'")
    pipe = regression_pipeline(["l_quantity", "l_discount", "l_tax"], "l_extendedprice",
                               num_trees=10, max_depth=5, seed=42)
    path = scratch_path(spark, "rf")
    loaded = fit_save_load(pipe, train, path)
    pred = loaded.transform(test)
    assert pred.count() == test.count()
    again = PipelineModel.load(path).transform(test)
    a = {(r["l_orderkey"], r["l_linenumber"], r["l_quantity"]): r["prediction"] for r in pred.collect()}
    b = {(r["l_orderkey"], r["l_linenumber"], r["l_quantity"]): r["prediction"] for r in again.collect()}
    assert a == b
    rmse = evaluate_rmse(pred, "l_extendedprice")
    sql_rmse = regression_metrics(pred, "l_extendedprice").collect()[0]["rmse"]
    assert rmse == pytest.approx(sql_rmse, rel=1e-9)
    mean = train.agg(F.avg("l_extendedprice")).collect()[0][0]
    base = regression_metrics(test.withColumn("prediction", F.lit(mean)), "l_extendedprice").collect()[0]["rmse"]
    assert rmse < base


def test_composition_stage_with_named_columns(spark):
    props = spark.createDataFrame([(8, 2.0), (14, 2.0), (11, 1.0)], "component int, s double")
    wide = spark.createDataFrame([(0, 60.0, 30.0, 10.0)], "entity_id long, O double, Si double, Na double")
    stage = CompositionStats.from_table(props, ["s"], {8: "O", 14: "Si", 11: "Na"})
    path = scratch_path(spark, "named")
    Pipeline(stages=[stage]).fit(wide).write().overwrite().save(path)
    row = PipelineModel.load(path).transform(wide).collect()[0]
    assert row["s_mean"] == pytest.approx(0.6 * 2 + 0.3 * 2 + 0.1 * 1) and row["s_min"] == 1.0


def test_binner_outside_labels_and_round_trip(spark, tmp_path):
    from mixlens.ml.binning import EqualWidthBinner, EqualWidthBinnerModel
    inf, nan = float("inf"), float("nan")
    train = spark.createDataFrame([(0.0,), (10.0,), (None,), (nan,), (inf,)], "x double")
    test = spark.createDataFrame([(-1.0,), (0.0,), (2.0,), (9.99,), (10.0,), (11.0,), (inf,), (-inf,), (nan,), (None,)], "x double")
    model = EqualWidthBinner(inputCol="x", outputCol="b", nullLabel="?").fit(train)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = EqualWidthBinnerModel.load(str(tmp_path / "m"))
    assert loaded.getOrDefault(loaded.edges) == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0]
    assert [r["b"] for r in loaded.transform(test).collect()] == ["0", "0", "1", "4", "4", "4", "4", "0", "?", "?"]
    inner = EqualWidthBinner(inputCol="x", outputCol="b", outside="null").fit(train)
    assert [r["b"] for r in inner.transform(test).collect()] == [None, "0", "1", "4", "4", None, None, None, None, None]
    assert [tuple(r) for r in inner.edge_table(spark).limit(1).collect()] == [("0", 0.0, 2.0)]
    with pytest.raises(Exception, match="outside the fitted range"):
        EqualWidthBinner(inputCol="x", outputCol="b", outside="error").fit(train).transform(test).collect()
    with pytest.raises(ValueError, match="outside must be"):
        EqualWidthBinner(inputCol="x", outputCol="b", outside="drop").fit(train)


def test_binner_without_finite_values_and_equal_to_the_plan(spark):
    from mixlens.ml.binning import EqualWidthBinner
    from mixlens.operators.binning import equal_width_bins
    none = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert {r["b"] for r in EqualWidthBinner(inputCol="x", outputCol="b").fit(none).transform(none).collect()} == {None}
    df = spark.range(4000).selectExpr("(id * 7919 % 1009) / 3.0D - 77.1D as x")
    for n in (1, 2, 5, 13):
        both = equal_width_bins(EqualWidthBinner(inputCol="x", outputCol="a", numBins=n).fit(df).transform(df), "x", n, "b")
        assert both.where("a <> b or a is null or b is null").count() == 0


def test_stats_estimator_fills_from_the_whole_table(spark, tmp_path):
    from mixlens.ml.transformers import CompositionStatsFit, CompositionStatsModel
    path = str(tmp_path / "props")
    spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None), (4, 40.0)], "z int, p double").write.parquet(path)
    df = spark.createDataFrame([(50.0, 50.0), (None, 100.0)], "a double, b double")
    fit = CompositionStatsFit(propertyPath=path, componentKey="z", propertyCols=["p"], componentCols=["a", "b"], componentIds=[1, 3], fill=True)
    model = fit.fit(df)  # component 3 takes the value of 2, which has no weight column
    model.write().overwrite().save(str(tmp_path / "m"))
    rows = CompositionStatsModel.load(str(tmp_path / "m")).transform(df).collect()
    assert [(r["p_mean"], r["p_min"], r["p_max"]) for r in rows] == [(15.0, 10.0, 20.0), (20.0, 20.0, 20.0)]
    with pytest.raises(Exception, match="NULL or NaN"):
        fit.copy({fit.nullWeight: "error"}).fit(df).transform(df).collect()
    gaps = fit.copy({fit.fill: False}).fit(df).transform(df).collect()
    assert [r["p_mean"] for r in gaps] == [None, None]


def test_forest_trains_on_bounded_blocks(spark):
    from mixlens.ml.regression import in_blocks
    train = spark.range(0, 6000, 1, 2).select("id", (F.col("id") % 7).alias("x"), (F.col("id") * 2.0).alias("y"))
    pipe = regression_pipeline(["x"], "y", num_trees=3, max_depth=2)
    row = 4 * (1 + 2 * 3) + 160
    dealt = in_blocks(train, pipe, block_bytes=500 * row)
    sizes = dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 12 and max(r["count"] for r in sizes) <= 600
    assert dealt.columns == train.columns and dealt.exceptAll(train).isEmpty() and dealt.count() == 6000
    again = in_blocks(train, pipe, block_bytes=500 * row)
    assert dealt.collect() == again.collect()  # the same rows in the same order, so the same bootstrap
    assert in_blocks(train, pipe) is train and in_blocks(train.limit(0), pipe, 1).count() == 0


def test_training_job_splits_each_label_bin(spark, tmp_path):
    from mixlens.plans import catalog
    d = str(tmp_path)
    # 60 orders; the bins of their prices hold 40, 0, 10, 0 and 5 orders, 5 orders have no price.
    price = F.when(F.col("id") < 40, F.col("id") / 10.0).when(F.col("id") < 50, F.col("id") + 0.0).when(F.col("id") < 55, F.lit(100.0))
    spark.range(60).select(F.col("id").alias("o_orderkey"), price.alias("o_totalprice")).write.parquet(f"{d}/orders.parquet")
    spark.range(180).selectExpr("id % 60 as l_orderkey", "id % 20 as l_partkey", "double(1 + id % 7) as l_quantity").write.parquet(f"{d}/lineitem.parquet")
    spark.range(20).selectExpr("id as p_partkey", "int(1 + id % 50) as p_size", "double(900 + id) as p_retailprice").write.parquet(f"{d}/part.parquet")
    pred, path = catalog._ml(spark, d)
    where = F.when(F.col("label") < 20, "low").when(F.col("label") < 60, "mid").when(F.col("label") >= 60, "high")
    assert {r["bin"]: r["count"] for r in pred.groupBy(where.alias("bin")).count().collect()} == {"low": 8, "mid": 2, "high": 1, None: 5}
    assert [(r["n"], r["n_skipped"]) for r in spark.read.parquet(path).collect()] == [(11, 5)]


def _forest(pipe):
    from pyspark.ml.regression import RandomForestRegressor
    return [s for s in pipe.getStages() if isinstance(s, RandomForestRegressor)]


def test_forest_fitted_in_stages_caches_few_trees_at_a_time(spark):
    stages = _forest(regression_pipeline(["x"], "y"))
    assert [s.getNumTrees() for s in stages] == [10] * 5 and {s.getMaxDepth() for s in stages} == {10}
    assert not any(s.getCacheNodeIds() for s in stages) and len({s.getSeed() for s in stages}) == 5
    assert [s.getNumTrees() for s in _forest(regression_pipeline(["x"], "y", num_trees=11))] == [6, 5]
    assert [(s.getNumTrees(), s.getPredictionCol()) for s in _forest(regression_pipeline(["x"], "y", num_trees=10))] == [(10, "prediction")]
    # Beside the bins of many features a few more counts weigh little.
    assert [s.getNumTrees() for s in _forest(regression_pipeline([f"x{i}" for i in range(62)], "y"))] == [50]


def test_forest_in_stages_predicts_the_mean_of_all_trees(spark, tmp_path):
    df = spark.range(0, 800, 1, 3).selectExpr("id", "double(id % 23) as x", "double(id % 7) as z", "(id % 23) * (id % 7) + id % 3 as y")
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    pipe = regression_pipeline(["x", "z"], "y", num_trees=23, max_depth=4)
    model = fit_save_load(pipe, df.select("x", "z", "y"), str(tmp_path / "m"))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
    out = model.transform(df.limit(20))
    assert out.columns == [*df.columns, "features", "prediction"]
    trees = [t for s in model.stages if hasattr(s, "trees") for t in s.trees]
    assert len(trees) == 23 and len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 23
    for r in out.collect():
        assert r["prediction"] == pytest.approx(sum(t.predict(r["features"]) for t in trees) / 23)


def test_forest_is_the_same_for_rows_in_another_order(spark):
    from mixlens.ml.regression import fit_stages
    df = spark.range(500).selectExpr("double(id % 23) as x", "double(id % 7) as z", "double(id * 7919 % 101) as y")
    pipe = regression_pipeline(["x", "z"], "y", num_trees=12, max_depth=4)
    up, down = (fit_stages(pipe, df.coalesce(1).sortWithinPartitions(F.col("y") * k)).transform(df).orderBy("x", "z", "y") for k in (1, -1))
    assert [r["prediction"] for r in up.collect()] == [r["prediction"] for r in down.collect()]
