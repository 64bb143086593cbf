"""Registered queries: one Spark plan per operator family, each with its DuckDB oracle.

Every query reads the driver tables (or data Spark derives from them) in
full. Doubles produced by sums are rounded the same way on both sides
(``ROUND_DIGITS``) for the value comparison; the library itself returns full
precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlens.functions.composition import STAT_NAMES
from mixlens.functions.ratios import nbo_t
from mixlens.ml.regression import assemble, evaluate_rmse, fit_save_load, fit_stages, regression_pipeline, vector_columns
from mixlens.ml.binning import EqualWidthBinner
from mixlens.ml.transformers import CompositionStats, CompositionStatsFit
from mixlens.operators import binning, split, text
from mixlens.operators.composition import (atomic_property_stats, composition_stats_long, composition_stats_wide, long_to_wide,
                                           pack_components, pack_stats, present_components,
                                           property_lookup, property_values, stat_columns)
from mixlens.operators.sparse_stats import composition_stats_sparse
from mixlens.operators.metrics import regression_metrics
from mixlens.operators.properties import ELECTRON_PROPERTIES, electron_shells, forward_fill, forward_fill_by_ranges
from mixlens.plans import oracle as O
from mixlens.plans.inputs import UNIVERSE, WEIGHT_COLS, mix_amounts, mix_long, part_property, property_table
from mixlens.session import scratch_path
from mixlens.operators.joins import lookup_join
from mixlens.sinks import append_metrics, scratch_table, write_parquet, write_split, write_text
from mixlens.sources.elements import element_table
from mixlens.sources.element_source import register
from mixlens.sources.files import read_csv_checked, read_lines, read_table, read_typed_csv, schema_from_json
from mixlens.streaming.composition import run_stats_stream

# Fixed parameters of the registered queries.
STATS_PROPS = ["s_filled", "min_price"]
TEST_SIZE = 0.2
SEED = 42
N_BINS = 5
RF_FEATURES = ["l_quantity", "l_discount", "l_tax"]
RF_LABEL = "l_extendedprice"


def rnd(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), O.ROUND_DIGITS)


def rnd4(c: Column | str) -> Column:
    """Coarser rounding for metrics built from long sums of large values."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(1e-9), 4)


def _round_all(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, *[rnd(c).alias(c) for c in df.columns if c not in keep])


def _stats_cols(props, stats=STAT_NAMES) -> list[str]:
    return stat_columns(props, stats)


# ----------------------------------------------------------------- composition

def _stats_long(spark, sf, props):
    """Statistics straight from the lines: amounts, divided by each entity's total."""
    return composition_stats_long(mix_amounts(spark, sf), property_table(spark, sf), props, weight_col="qty", normalize=True,
                                  components=UNIVERSE)


def q_composition_stats_long(spark, sf):
    return _round_all(_stats_long(spark, sf, STATS_PROPS), ["entity_id"])


def _wide_mix(spark, sf, by="order"):
    return long_to_wide(mix_amounts(spark, sf, by), UNIVERSE, weight_col="qty", percent=True)


def q_composition_stats_wide(spark, sf):
    wide = _wide_mix(spark, sf)
    out = composition_stats_wide(wide, WEIGHT_COLS, property_table(spark, sf), STATS_PROPS)
    return _round_all(out.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


def _long_subset(stats):
    def q(spark, sf):
        out = _stats_long(spark, sf, STATS_PROPS)
        return _round_all(out.select("entity_id", *_stats_cols(STATS_PROPS, stats)), ["entity_id"])
    return q


def q_electron_stats(spark, sf):
    return _round_all(_stats_long(spark, sf, ELECTRON_PROPERTIES), ["entity_id"])


def q_feature_pipeline(spark, sf):
    from pyspark.ml import Pipeline, PipelineModel
    props = property_table(spark, sf)
    _, values = property_values(props, STATS_PROPS)  # one read of the property table
    stages = [CompositionStats.from_values(values, [p], WEIGHT_COLS) for p in STATS_PROPS]
    wide = _wide_mix(spark, sf)
    path = scratch_path(spark, "feature_pipeline")
    Pipeline(stages=stages).fit(wide).write().overwrite().save(path)
    out = PipelineModel.load(path).transform(wide)
    return _round_all(out.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


def q_parquet_roundtrip(spark, sf):
    wide = _wide_mix(spark, sf)
    out = composition_stats_wide(wide, WEIGHT_COLS, property_table(spark, sf), STATS_PROPS)
    path = scratch_path(spark, "transformed")
    write_parquet(out, path)
    back = spark.read.parquet(path)
    return _round_all(back.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


def q_streaming_composition_stats(spark, sf):
    wide = _wide_mix(spark, sf)
    src = scratch_path(spark, "stream_src")
    write_parquet(wide, src)
    out = run_stats_stream(spark, src, wide.schema, WEIGHT_COLS, property_table(spark, sf), STATS_PROPS,
                           scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt"))
    return _round_all(out.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


def q_feature_select(spark, sf):
    wide = _wide_mix(spark, sf)
    out = composition_stats_wide(wide, WEIGHT_COLS, property_table(spark, sf), STATS_PROPS)
    # The statistics as one struct per property, expanded back by name.
    packed = pack_stats(out, "s_filled", "s_filled_stats")
    expanded = packed.select("*", "s_filled_stats.*").drop("s_filled_stats")
    # P5: features chosen by name from a declared list, never by position.
    spec = ["1", "2", "3", "4", "5", *_stats_cols(["s_filled"])]
    return _round_all(expanded.select("entity_id", *spec), ["entity_id"])


def q_property_lookup(spark, sf):
    out = property_lookup(mix_long(spark, sf), property_table(spark, sf), STATS_PROPS)
    return out.select("entity_id", "component", rnd("weight_pct").alias("weight_pct"), *STATS_PROPS)


def q_present_components(spark, sf):
    wide = _wide_mix(spark, sf)
    present = present_components(WEIGHT_COLS)
    return wide.select("entity_id", F.size(present).alias("n_present"),
                       F.array_join(present, ",").alias("present"))


def q_composition_pack(spark, sf):
    wide = _wide_mix(spark, sf)
    packed = pack_components(WEIGHT_COLS)
    as_int = F.transform(packed, lambda x: F.round(x * F.lit(1e6)).cast("bigint"))
    return wide.select("entity_id", F.size(packed).alias("n_components"),
                       F.array_join(as_int, ",").alias("packed_ppm"))


def q_linear_ratio(spark, sf):
    wide = long_to_wide(mix_amounts(spark, sf, by="customer"), O.RATIO_UNIVERSE, weight_col="qty", percent=True)
    return wide.select("entity_id", rnd(nbo_t({z: str(z) for z in O.RATIO_UNIVERSE})).alias("nbo_t"))


# ------------------------------------------------------------------ properties

def q_property_table(spark, sf):
    shells = electron_shells(element_table(spark)).join(part_property(spark, sf), "component", "left")
    return shells.select("component", "electronic_configuration", *ELECTRON_PROPERTIES, "min_price")


def q_electron_shells(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("component"))
    # The element dimension is 118 rows by definition: a fixed, bounded broadcast.
    joined = part.join(F.broadcast(element_table(spark)), "component")
    return electron_shells(joined).select("p_partkey", *ELECTRON_PROPERTIES)


def q_property_ffill(spark, sf):
    """All parts in key order; the price has gaps wherever the key's last digits say so."""
    price = F.when(F.col("p_partkey") % 7 > 3, F.col("p_retailprice"))
    table = read_table(spark, sf, "part").select("p_partkey", price.alias("price_raw")).withColumn("price_filled", F.col("price_raw"))
    return forward_fill(table, ["price_filled"], "p_partkey")


def q_property_ffill_brands(spark, sf):
    """The same gaps filled within each brand, over more ranges than one task carries."""
    price = F.when(F.col("p_partkey") % 7 > 3, F.col("p_retailprice"))
    table = read_table(spark, sf, "part").select("p_brand", "p_partkey", price.alias("price_filled"))
    return forward_fill_by_ranges(table, ["price_filled"], "p_partkey", n_ranges=60, partition_by=["p_brand"], fan=8)


# ------------------------------------------------- binning, sampling and split

def _orders_binned(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return binning.equal_width_bins(orders, "o_totalprice", N_BINS, "stratum")


FRACTIONS = {str(k): 1.0 - TEST_SIZE for k in range(N_BINS)}


def q_target_range(spark, sf):
    return binning.target_range(read_table(spark, sf, "orders"), "o_totalprice")


def q_equal_width_bins(spark, sf):
    return _orders_binned(spark, sf)


def _signed_orders(spark, sf):
    """Orders with a signed value, some NULL, on the train or test side."""
    x = F.when(F.col("o_custkey") % 7 > 0, F.col("o_totalprice") / 3.0 - F.lit(54225.890941973405))
    orders = read_table(spark, sf, "orders").select("o_orderkey", x.alias("x"))
    return split.train_test_split(orders, ["o_orderkey"], TEST_SIZE)


def q_binner_model(spark, sf):
    """Bins learned on the train side, saved and loaded in a pipeline, on the test side stretched beyond the range."""
    from pyspark.ml import Pipeline, PipelineModel
    rows = _signed_orders(spark, sf)
    binners = [EqualWidthBinner(inputCol="x", outputCol=how, numBins=N_BINS, outside=how, nullLabel="none") for how in ("end", "null")]
    untrained, trained = scratch_path(spark, "binner"), scratch_path(spark, "binner_model")
    Pipeline(stages=binners).write().overwrite().save(untrained)
    Pipeline.load(untrained).fit(rows.where("split = 'train'")).write().overwrite().save(trained)
    test = rows.where("split = 'test'").withColumn("x", F.col("x") * F.lit(1.25))
    return PipelineModel.load(trained).transform(test).select("o_orderkey", "x", F.col("end").alias("at_end"), F.col("null").alias("inside"))


def q_fitted_stats(spark, sf):
    """Estimators that read and fill the property table when fitted, saved and loaded before and after."""
    from pyspark.ml import Pipeline, PipelineModel
    path = scratch_path(spark, "properties")
    price = F.when(F.col("component") % 7 > 0, F.col("min_price"))
    write_parquet(property_table(spark, sf).withColumn("price_filled", price), path)
    fits = [CompositionStatsFit(propertyPath=path, propertyCols=[p], componentCols=WEIGHT_COLS, fill=p == "price_filled") for p in ("s_filled", "price_filled")]
    untrained, trained = scratch_path(spark, "stats_fit"), scratch_path(spark, "stats_fit_model")
    wide = _wide_mix(spark, sf)
    Pipeline(stages=fits).write().overwrite().save(untrained)
    Pipeline.load(untrained).fit(wide).write().overwrite().save(trained)
    out = PipelineModel.load(trained).transform(wide)
    return _round_all(out.select("entity_id", *_stats_cols(["s_filled", "price_filled"])), ["entity_id"])


def q_distinct_strata(spark, sf):
    return binning.distinct_strata(_orders_binned(spark, sf), "stratum")


def q_stratified_fractions(spark, sf):
    return split.stratified_fractions(_orders_binned(spark, sf), "stratum", 1.0 - TEST_SIZE)


def q_sample_by_hash(spark, sf):
    return split.sample_by_hash(_orders_binned(spark, sf), ["o_orderkey"], "stratum", FRACTIONS) \
        .select("o_orderkey", "stratum")


def q_sample_exact(spark, sf):
    """Exactly the rounded share of each bin's orders."""
    return split.sample_exact(_orders_binned(spark, sf), ["o_orderkey"], "stratum", FRACTIONS).select("o_orderkey", "stratum")


def _customer_orders(spark, sf):
    """Orders by the customer, as many strata as customers, a sixth of the orders in a stratum without a name."""
    who = F.when(F.col("o_orderkey") % 6 > 0, F.col("o_custkey").cast("string"))
    return read_table(spark, sf, "orders").select("o_orderkey", who.alias("stratum"))


def _customer_rates(spark, sf):
    """A rate for each customer that has one (every eleventh has none), and for the orders without a customer."""
    keys = read_table(spark, sf, "customer").select("c_custkey").where("c_custkey % 11 > 0")
    rates = keys.select(F.col("c_custkey").cast("string").alias("stratum"), ((F.col("c_custkey") % 8) / F.lit(8.0)).alias("rate"))
    return rates.unionByName(spark.range(1).select(F.lit(None).cast("string").alias("stratum"), F.lit(0.3125).alias("rate")))


def q_sample_by_hash_rates(spark, sf):
    return split.sample_by_hash(_customer_orders(spark, sf), ["o_orderkey"], "stratum", _customer_rates(spark, sf))


def q_sample_exact_rates(spark, sf):
    return split.sample_exact(_customer_orders(spark, sf), ["o_orderkey"], "stratum", _customer_rates(spark, sf))


def q_sample_by_seeded(spark, sf):
    return split.sample_by_seeded(_orders_binned(spark, sf), "stratum", FRACTIONS, SEED) \
        .select("o_orderkey", "stratum")


def q_except_distinct(spark, sf):
    rows = _orders_binned(spark, sf).select("o_orderkey", "stratum")
    sample = split.sample_by_hash(rows, ["o_orderkey"], "stratum", FRACTIONS)
    return split.except_distinct(rows, sample)


def q_except_distinct_wide(spark, sf):
    """120 columns: orders with 114 derived ones, some NULL, each third order twice, less those of the sample."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    wide = orders.select("*", *[F.when(F.col("o_custkey") % (k + 2) > 0, F.col("o_orderkey") % F.lit(k + 3)).alias(f"x{k}") for k in range(115)])
    rows = scratch_table(wide.unionByName(wide.where("o_orderkey % 3 = 0")), "wide-orders")
    left = split.except_distinct_wide(rows, split.sample_by_hash(rows, ["o_orderkey"], None, 1.0 - TEST_SIZE), verify=True)
    digits = F.concat_ws(",", *[F.coalesce(F.col(f"x{k}").cast("string"), F.lit("-")) for k in range(115)])
    return left.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.md5(digits).alias("derived"))


def q_train_test_split(spark, sf):
    return split.train_test_split(_orders_binned(spark, sf), ["o_orderkey"], TEST_SIZE) \
        .select("o_orderkey", "stratum", "split")


def q_split_roundtrip(spark, sf):
    df = split.train_test_split(_orders_binned(spark, sf), ["o_orderkey"], TEST_SIZE)
    path = scratch_path(spark, "splits")
    write_split(df.select("o_orderkey", "o_totalprice", "stratum", "split"), path)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "stratum", "split")


def _null_keys():
    return F.when(F.col("o_custkey") % 3 > 0, F.col("o_orderkey"))


def q_train_test_split_null_keys(spark, sf):
    """Half the two-part keys NULL in one part, a third of the one-part keys NULL: no row is lost, none favoured."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey").withColumn("key", _null_keys())
    out = split.train_test_split(orders, ["key", "o_custkey"], 0.5, split_col="by_two")
    out = split.train_test_split(out, ["key"], TEST_SIZE, split_col="by_one")
    return out.select("o_orderkey", "by_one", "by_two")


def q_sample_by_seeded_share(spark, sf):
    """Per stratum: rows, and whether the seeded sample's share is within five standard deviations."""
    rows = _orders_binned(spark, sf).select("o_orderkey", "stratum")
    drawn = split.sample_by_seeded(rows, "stratum", FRACTIONS, SEED).withColumn("drawn", F.lit(1))
    n, k, f = F.count("*"), F.count("drawn"), 1.0 - TEST_SIZE
    return (rows.join(drawn, ["o_orderkey", "stratum"], "left").groupBy("stratum")
            .agg(n.alias("n"), (F.abs(k - n * f) <= 5 * F.sqrt(n * f * (1 - f)) + 1).alias("share_ok")))


def q_equal_width_bins_signed(spark, sf):
    """Bins of a signed double column with awkward ends, NULLs under a label of their own."""
    x = F.when(F.col("o_custkey") % 7 > 0, F.col("o_totalprice") / 3.0 - F.lit(54225.890941973405))
    orders = read_table(spark, sf, "orders").select("o_orderkey", x.alias("x"))
    return binning.equal_width_bins(orders, "x", N_BINS, "stratum", null_label="none")


def _gapped(spark, sf):
    """The property table without every seventh component."""
    return property_table(spark, sf).where(F.col("component") % 7 > 0)


def q_composition_stats_unknown(spark, sf):
    out = composition_stats_long(mix_long(spark, sf), _gapped(spark, sf), STATS_PROPS, components=UNIVERSE)
    return _round_all(out, ["entity_id"])


def q_composition_stats_unknown_wide(spark, sf):
    out = composition_stats_wide(_wide_mix(spark, sf), WEIGHT_COLS, _gapped(spark, sf), STATS_PROPS)
    return _round_all(out.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


def q_composition_stats_subset(spark, sf):
    out = composition_stats_long(mix_long(spark, sf), property_table(spark, sf), STATS_PROPS, components=O.SUBSET)
    return _round_all(out, ["entity_id"])


def q_composition_stats_subset_wide(spark, sf):
    out = composition_stats_wide(_wide_mix(spark, sf), list(map(str, O.SUBSET)), property_table(spark, sf), STATS_PROPS)
    return _round_all(out.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


def q_composition_stats_normalized(spark, sf):
    """Wide form over raw quantities, which do not sum to 100."""
    wide = long_to_wide(mix_amounts(spark, sf), UNIVERSE, weight_col="qty")
    out = composition_stats_wide(wide, WEIGHT_COLS, property_table(spark, sf), STATS_PROPS, normalize=True)
    return _round_all(out.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


def q_composition_stats_null_weight(spark, sf):
    """Every seventh component has NULL weights, which count as 0."""
    mix = mix_long(spark, sf).withColumn("weight_pct", F.when(F.col("component") % 7 > 0, F.col("weight_pct")))
    return _round_all(composition_stats_long(mix, property_table(spark, sf), STATS_PROPS), ["entity_id"])


def q_composition_stats_many_components(spark, sf):
    """Every part a component of its own, a third of all lines in one entity; one property with gaps."""
    lines = read_table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 > 0, F.col("l_orderkey")).otherwise(F.lit(0)).alias("entity_id"),
        F.col("l_partkey").alias("component"), F.col("l_quantity").alias("qty"))
    props = read_table(spark, sf, "part").select(F.col("p_partkey").alias("component"), F.col("p_retailprice").alias("price"),
                                                 F.when(F.col("p_partkey") % 97 > 0, F.col("p_size")).alias("size"))
    out = composition_stats_sparse(lines, props, ["price", "size"], weight_col="qty", normalize=True)
    return _round_all(out, ["entity_id"])


def q_composition_stats_filled(spark, sf):
    """A property with gaps, filled from the component before inside the atomic statistics."""
    price = F.when(F.col("component") % 7 > 0, F.col("min_price"))
    props = property_table(spark, sf).withColumn("price_filled", price)
    out = atomic_property_stats(_wide_mix(spark, sf), props, "price_filled", WEIGHT_COLS, fill=True)
    return _round_all(out.select("entity_id", *_stats_cols(["price_filled"])), ["entity_id"])


def q_composition_stats_float(spark, sf):
    """float32 results: picked values as they are, sums by their distance from the doubles."""
    args = (_wide_mix(spark, sf), WEIGHT_COLS, property_table(spark, sf), STATS_PROPS)
    out = composition_stats_wide(*args, as_float=True)
    picked = [c for c in _stats_cols(STATS_PROPS, ("max", "min", "mode1", "mode2"))]
    sums = {c: c + "_near" for c in _stats_cols(STATS_PROPS, ("std", "mean"))}
    exact = composition_stats_wide(out, *args[1:], names={p: p + "_exact" for p in STATS_PROPS})

    def near(c: str) -> Column:
        double = F.col(c.replace("_std", "_exact_std").replace("_mean", "_exact_mean"))
        return F.abs(F.col(c).cast("double") - double) <= F.abs(double) * F.lit(2.0 ** -23)

    return exact.select("entity_id", F.lit(dict(out.dtypes)[picked[0]]).alias("type"),
                        *[F.col(c).cast("double").alias(c) for c in picked], *[near(c).alias(n) for c, n in sums.items()])


# ------------------------------------------------------------------ scans, text

ORDERS_SCHEMA_JSON = {
    "type": "struct",
    "fields": [
        {"name": "o_orderkey", "type": "long", "nullable": True, "metadata": {}},
        {"name": "o_custkey", "type": "long", "nullable": True, "metadata": {}},
        {"name": "o_orderstatus", "type": "string", "nullable": True, "metadata": {}},
        {"name": "o_totalprice", "type": "double", "nullable": True, "metadata": {}},
    ],
}


def q_csv_scan_typed(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "orders_csv")
    orders.write.option("header", "true").csv(path)
    return read_typed_csv(spark, path, schema_from_json(ORDERS_SCHEMA_JSON))


#: The raw orders file of the checked scan, with a timestamp.
RAW_ORDERS_JSON = {"type": "struct", "fields": [
    {"name": n, "type": t, "nullable": True, "metadata": {}}
    for n, t in (("o_orderkey", "long"), ("o_custkey", "integer"), ("note", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp"))]}


def _checked_orders(spark, sf):
    """Orders as CSV lines with quotes and commas, empty fields, texts for numbers, a month 13 and lines cut short."""
    key, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    quoted = F.concat(F.lit('"say ""'), F.col("o_orderstatus"), F.lit('"", ok"'))
    note = F.when(key % 4 == 0, quoted).when(key % 4 == 3, F.lit("")).otherwise(F.col("o_orderstatus"))
    price = F.when(key % 50 == 7, F.lit("n/a")).when(key % 11 == 0, F.lit("")).otherwise(text("o_totalprice"))
    when = F.when(key % 70 == 3, F.lit("2024-13-45 00:00:00")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    start = F.concat_ws(",", text("o_orderkey"), text("o_custkey"), note, price)
    line = F.when(key % 90 == 5, start).otherwise(F.concat_ws(",", start, when))
    path = scratch_path(spark, "raw_orders")
    write_text(read_table(spark, sf, "orders").select(line.alias("line")), "line", path)
    return read_csv_checked(spark, path, schema_from_json(RAW_ORDERS_JSON), header=False, options={"timestampFormat": "yyyy-MM-dd HH:mm:ss"})


def q_csv_rows(spark, sf):
    rows = _checked_orders(spark, sf).rows
    return rows.select("o_orderkey", "o_custkey", "note", "o_totalprice", F.unix_timestamp("o_orderdate").alias("ordered_at"))


def q_csv_rejects(spark, sf):
    rejects = _checked_orders(spark, sf).rejects
    return rejects.select("line", "wrong_fields", F.array_join("bad_columns", ";").alias("bad_columns"))


def q_metrics_rerun(spark, sf):
    """Two runs' metrics, one of the runs done twice, another with no rows the second time."""
    lines = _lines(spark, sf)
    path = scratch_path(spark, "metrics_runs")
    for run, limit in (("first", 1e9), ("second", 30_000.0), ("gone", 1e9), ("first", 1e9), ("gone", None)):
        kept = lines.where(F.col(RF_LABEL) < F.lit(limit))
        means = kept.groupBy("l_returnflag").agg(F.avg(RF_LABEL).alias("prediction"))
        m = regression_metrics(lookup_join(kept, means, "l_returnflag"), RF_LABEL).where("n > 0")
        append_metrics(m.select("n", rnd4("rmse").alias("rmse"), rnd4("mae").alias("mae")), path, run_id=run)
    return spark.read.parquet(path)


def q_element_source(spark, sf):
    """The property table from the data source by its name, in four tasks."""
    register(spark)
    elements = spark.read.format("mixlens_elements").option("partitions", 4).load()
    shells = electron_shells(elements).join(part_property(spark, sf), "component", "left")
    return shells.select("component", "electronic_configuration", *ELECTRON_PROPERTIES, "min_price")


def q_word_count(spark, sf):
    docs = read_table(spark, sf, "documents").select("text")
    return text.word_count(docs, "text", multiline=True)


def q_text_scan_word_count(spark, sf):
    docs = read_table(spark, sf, "documents")
    path = scratch_path(spark, "documents_text")
    write_text(docs.where(F.col("text").isNotNull()), "text", path)
    return text.word_count(read_lines(spark, path), "value")


# ------------------------------------------------------------------------- ML

def _lines(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                    RF_LABEL, *RF_FEATURES)


def q_vector_assemble(spark, sf):
    v = assemble(_lines(spark, sf), RF_FEATURES)
    return vector_columns(v.select("l_orderkey", "l_linenumber", "features"), "features",
                          [f"f_{c}" for c in RF_FEATURES])


def q_regression_metrics(spark, sf):
    lines = _lines(spark, sf)
    # Per-flag mean as the prediction: a few rows, broadcast after a size check
    # (a plain shuffle join on a 3-valued key would put a third of the lines
    # in each of three tasks).
    means = lines.groupBy("l_returnflag").agg(F.avg(RF_LABEL).alias("prediction"))
    scored = lookup_join(lines, means, "l_returnflag")
    m = regression_metrics(scored, RF_LABEL, "prediction")
    path = scratch_path(spark, "metrics")
    append_metrics(m.select("n", rnd4("rmse").alias("rmse"), rnd4("mae").alias("mae")), path)
    return spark.read.parquet(path)


def q_rf_regression(spark, sf):
    lines = split.train_test_split(_lines(spark, sf), ["l_orderkey"], TEST_SIZE)
    train = lines.where(F.col("split") == "train")
    test = lines.where(F.col("split") == "test")
    model = fit_save_load(regression_pipeline(RF_FEATURES, RF_LABEL, seed=SEED), train.select(*RF_FEATURES, RF_LABEL),
                          scratch_path(spark, "rf_model"))
    return model.transform(test).select("l_orderkey", "l_linenumber", RF_LABEL, "prediction")


def q_rf_model_check(spark, sf):
    """Per test row: the loaded model predicts as the fitted one, within the range of the training labels."""
    lines = split.train_test_split(_lines(spark, sf), ["l_orderkey"], TEST_SIZE)
    train, test = lines.where(F.col("split") == "train"), lines.where(F.col("split") == "test")
    pipeline = regression_pipeline(RF_FEATURES, RF_LABEL, seed=SEED)
    fitted = fit_stages(pipeline, train.select(*RF_FEATURES, RF_LABEL))
    path = scratch_path(spark, "rf_check")
    fitted.write().overwrite().save(path)
    loaded = type(fitted).load(path)
    r = train.agg(F.struct(F.min(RF_LABEL).alias("lo"), F.max(RF_LABEL).alias("hi"))).scalar()
    both = fitted.transform(test).withColumnRenamed("prediction", "direct").drop("features")
    both = loaded.transform(both)
    return both.select("l_orderkey", "l_linenumber", RF_LABEL, (F.col("direct") == F.col("prediction")).alias("same"),
                       F.col("prediction").between(r["lo"], r["hi"]).alias("within"))


#: The forest's error on held-out rows is at most this share of that of the training mean.
RF_SHARE = 0.25
#: A label that depends on its features (the line's price alone does not depend on quantity, discount and tax).
CHARGE_FEATURES = ["l_extendedprice", "l_discount", "l_tax"]


def q_rf_quality(spark, sf):
    """The forest against the constant mean on held-out rows, and Spark's evaluator against the SQL figure."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    lines = split.train_test_split(_lines(spark, sf).withColumn("charge", charge), ["l_orderkey"], TEST_SIZE)
    train, test = lines.where("split = 'train'"), lines.where("split = 'test'")
    model = fit_save_load(regression_pipeline(CHARGE_FEATURES, "charge", seed=SEED), train.select(*CHARGE_FEATURES, "charge"),
                          scratch_path(spark, "rf_quality"))
    pred = scratch_table(model.transform(test).select("charge", "prediction"), "rf_predictions")
    mean = train.agg(F.avg("charge")).first()[0]
    rmse = evaluate_rmse(pred, "charge")
    both = pred.agg(F.count("*").alias("n"), F.sqrt(F.avg((F.col("prediction") - F.col("charge")) ** 2)).alias("sql"),
                    F.sqrt(F.avg((F.lit(mean) - F.col("charge")) ** 2)).alias("constant"))
    return both.select("n", (F.abs(F.col("sql") - F.lit(rmse)) <= F.lit(1e-9) * F.col("sql")).alias("evaluator_same"),
                       (F.col("sql") <= F.lit(RF_SHARE) * F.col("constant")).alias("beats_mean"))


# --------------------------------------------- end-to-end jobs (ETL, training)

def _mix_schema_json() -> dict:
    fields = [{"name": "entity_id", "type": "long", "nullable": True, "metadata": {}}]
    fields += [{"name": c, "type": "double", "nullable": True, "metadata": {}} for c in WEIGHT_COLS]
    return {"type": "struct", "fields": fields}


def _etl(spark, sf) -> str:
    """Raw CSV with a JSON schema -> pipeline of composition stages -> Parquet; returns its path."""
    from pyspark.ml import Pipeline
    raw = scratch_path(spark, "raw_mix_csv")
    _wide_mix(spark, sf).write.option("header", "true").csv(raw)
    df = read_typed_csv(spark, raw, schema_from_json(_mix_schema_json()))
    props = property_table(spark, sf)
    _, values = property_values(props, STATS_PROPS)  # one read of the property table
    stages = [CompositionStats.from_values(values, [p], WEIGHT_COLS) for p in STATS_PROPS]
    out = scratch_path(spark, "transformed")
    write_parquet(Pipeline(stages=stages).fit(df).transform(df), out)
    return out


def q_etl_job(spark, sf):
    back = spark.read.parquet(_etl(spark, sf))
    return _round_all(back.select("entity_id", *_stats_cols(STATS_PROPS)), ["entity_id"])


#: The raw weight columns and the statistics derived from them.
ML_FEATURES = [*WEIGHT_COLS, *_stats_cols(STATS_PROPS)]


def _ml(spark, sf) -> tuple[DataFrame, str]:
    """Raw and derived composition features -> label bins -> split by bin, written by partition ->
    forest fit, save, load, score -> metrics appended to a table; predictions and that table's path.
    Missing features are not filled: they reach the forest as NaN."""
    feats = spark.read.parquet(_etl(spark, sf)).select("entity_id", *ML_FEATURES)
    orders = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("entity_id"),
                                                    F.col("o_totalprice").alias("label"))
    labels = orders.join(feats.select("entity_id"), "entity_id", "left_semi")
    binned = binning.equal_width_bins(labels, "label", N_BINS, "stratum")
    # An entity is in one stratum, so whole on one side; one without a label has none, no rate, and is not trained on.
    strata = scratch_table(binned.groupBy("entity_id").agg(F.min(F.struct("stratum"))["stratum"].alias("stratum")), "ml_strata")
    sides = split.train_test_split_exact(strata, ["entity_id"], "stratum", FRACTIONS)
    splits = scratch_path(spark, "ml_splits")
    write_split(feats.join(labels.join(sides, "entity_id"), "entity_id"), splits, drop=("stratum",))
    data = spark.read.parquet(splits)
    model = fit_save_load(regression_pipeline(ML_FEATURES, "label", seed=SEED, handle_invalid="keep"),
                          data.where(F.col("split") == "train").select(*ML_FEATURES, "label"), scratch_path(spark, "ml_model"))
    pred = model.transform(data.where(F.col("split") == "test")).select("entity_id", "label", "prediction")
    metrics = scratch_path(spark, "ml_metrics")
    append_metrics(regression_metrics(pred, "label"), metrics)
    return pred, metrics


def q_ml_job(spark, sf):
    return _ml(spark, sf)[0]


def q_ml_metrics_check(spark, sf):
    """The appended metrics of the training job beside the same figures recomputed in SQL from its predictions."""
    pred, path = _ml(spark, sf)
    again = pred.agg(F.expr("count(label)").alias("n_again"), F.expr("sqrt(sum(power(label - prediction, 2)) / count(label))").alias("rmse_again"),
                     F.expr("sum(abs(label - prediction)) / count(label)").alias("mae_again"))
    both = spark.read.parquet(path).join(F.broadcast(again))  # one row each

    def same(c: str) -> Column:
        return (F.abs(F.col(c) - F.col(f"{c}_again")) <= F.lit(1e-9) * F.col(c)).alias(f"{c}_same")

    return both.select("n", "n_skipped", (F.col("n") == F.col("n_again")).alias("n_same"), same("rmse"), same("mae"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "composition_stats_long": q_composition_stats_long,
    "composition_stats_wide": q_composition_stats_wide,
    "composition_min_max": _long_subset(("min", "max")),
    "composition_mean_mad": _long_subset(("mean", "std")),
    "composition_modes": _long_subset(("mode1", "mode2")),
    "electron_stats": q_electron_stats,
    "feature_pipeline": q_feature_pipeline,
    "parquet_roundtrip": q_parquet_roundtrip,
    "streaming_composition_stats": q_streaming_composition_stats,
    "feature_select": q_feature_select,
    "property_lookup": q_property_lookup,
    "present_components": q_present_components,
    "composition_pack": q_composition_pack,
    "linear_ratio": q_linear_ratio,
    "property_table": q_property_table,
    "electron_shells": q_electron_shells,
    "property_ffill": q_property_ffill,
    "property_ffill_brands": q_property_ffill_brands,
    "target_range": q_target_range,
    "equal_width_bins": q_equal_width_bins,
    "binner_model": q_binner_model,
    "fitted_stats": q_fitted_stats,
    "distinct_strata": q_distinct_strata,
    "stratified_fractions": q_stratified_fractions,
    "sample_by_hash": q_sample_by_hash,
    "sample_exact": q_sample_exact,
    "sample_by_hash_rates": q_sample_by_hash_rates,
    "sample_exact_rates": q_sample_exact_rates,
    "sample_by_seeded": q_sample_by_seeded,
    "except_distinct": q_except_distinct,
    "except_distinct_wide": q_except_distinct_wide,
    "train_test_split": q_train_test_split,
    "split_roundtrip": q_split_roundtrip,
    "train_test_split_null_keys": q_train_test_split_null_keys,
    "sample_by_seeded_share": q_sample_by_seeded_share,
    "equal_width_bins_signed": q_equal_width_bins_signed,
    "composition_stats_unknown": q_composition_stats_unknown,
    "composition_stats_unknown_wide": q_composition_stats_unknown_wide,
    "composition_stats_subset": q_composition_stats_subset,
    "composition_stats_subset_wide": q_composition_stats_subset_wide,
    "composition_stats_normalized": q_composition_stats_normalized,
    "composition_stats_null_weight": q_composition_stats_null_weight,
    "composition_stats_many_components": q_composition_stats_many_components,
    "composition_stats_filled": q_composition_stats_filled,
    "composition_stats_float": q_composition_stats_float,
    "rf_model_check": q_rf_model_check,
    "rf_quality": q_rf_quality,
    "csv_scan_typed": q_csv_scan_typed,
    "csv_rows": q_csv_rows,
    "csv_rejects": q_csv_rejects,
    "metrics_rerun": q_metrics_rerun,
    "element_source": q_element_source,
    "word_count": q_word_count,
    "text_scan_word_count": q_text_scan_word_count,
    "vector_assemble": q_vector_assemble,
    "regression_metrics": q_regression_metrics,
    "rf_regression": q_rf_regression,
    "etl_job": q_etl_job,
    "ml_job": q_ml_job,
    "ml_metrics_check": q_ml_metrics_check,
}
