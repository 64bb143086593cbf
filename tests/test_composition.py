"""Composition statistics: edge rows (FIXTURES F7), both forms, form agreement."""

import math

import pytest
from pyspark.sql import functions as F

from mixlens.functions.composition import STAT_NAMES
from mixlens.operators.composition import (atomic_property_stats, composition_stats_long, composition_stats_wide, long_to_wide,
                                           wide_to_long)
from mixlens.plans.inputs import UNIVERSE, WEIGHT_COLS, mix_long, property_table

P = [1.0, 7.0, 3.0, 5.0]
COLS = ["1", "2", "3", "4"]

# (weights, expected max, min, std, mean, mode1, mode2)
EDGE_ROWS = [
    ([50.0, 30.0, 20.0, 0.0], 7, 1, 2.28, 3.2, 1, 7),
    ([40.0, 40.0, 20.0, 0.0], 7, 1, 2.56, 3.8, 1, 1),      # tie for the top weight
    ([0.0, 100.0, 0.0, 0.0], 7, 7, 0.0, 7.0, 7, 1),        # one component
    ([0.0, 0.0, 0.0, 0.0], None, None, 0.0, 0.0, 1, 1),    # all zero
    ([None, 60.0, 40.0, 0.0], 7, 3, 1.92, 5.4, 7, 3),       # NULL weight counts as 0
    ([float("nan"), 60.0, 40.0, 0.0], 7, 3, 1.92, 5.4, 7, 3),  # NaN weight counts as 0
    ([25.0, 25.0, 0.0, 0.0], 7, 1, 1.5, 2.0, 1, 1),        # sums to 50: mean not normalised
]


def _props(spark, values=P):
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "component int, prop double")


def _wide(spark, rows):
    data = [(i, *w) for i, (w, *_rest) in enumerate(rows)]
    return spark.createDataFrame(data, "entity_id long, " + ", ".join(f"`{c}` double" for c in COLS))


def _check(row, expected, prefix="prop"):
    names = [f"{prefix}_{s}" for s in STAT_NAMES]
    for name, exp in zip(names, expected):
        got = row[name]
        if exp is None:
            assert got is None, (name, got)
        else:
            assert got == pytest.approx(exp, abs=1e-9), (name, got, exp)


def test_wide_edge_rows(spark):
    out = composition_stats_wide(_wide(spark, EDGE_ROWS), COLS, _props(spark), ["prop"])
    got = {r["entity_id"]: r for r in out.collect()}
    for i, (_, *expected) in enumerate(EDGE_ROWS):
        _check(got[i], expected)


def test_long_edge_rows(spark):
    long = wide_to_long(_wide(spark, EDGE_ROWS), COLS, keep_zero=True)
    out = composition_stats_long(long, _props(spark), ["prop"])
    got = {r["entity_id"]: r for r in out.collect()}
    for i, (_, *expected) in enumerate(EDGE_ROWS):
        _check(got[i], expected)


def test_long_sparse_rows_treat_absent_as_zero(spark):
    # Only present components are given; absent ones weigh 0 (mode2 -> first absent).
    long = spark.createDataFrame([(1, 2, 100.0), (2, 1, 50.0), (2, 3, 50.0)],
                                 "entity_id long, component int, weight_pct double")
    got = {r["entity_id"]: r for r in composition_stats_long(long, _props(spark), ["prop"]).collect()}
    _check(got[1], [7, 7, 0.0, 7.0, 7, 1])
    _check(got[2], [3, 1, 1.0, 2.0, 1, 1])


def test_long_duplicates_are_summed(spark):
    long = spark.createDataFrame([(1, 1, 30.0), (1, 1, 20.0), (1, 2, 30.0), (1, 3, 20.0)],
                                 "entity_id long, component int, weight_pct double")
    row = composition_stats_long(long, _props(spark), ["prop"]).collect()[0]
    _check(row, EDGE_ROWS[0][1:])


def test_null_property_rules(spark):
    props = _props(spark, [1.0, None, 3.0, 5.0])
    rows = [([50.0, 0.0, 50.0, 0.0],), ([50.0, 50.0, 0.0, 0.0],)]
    wide = _wide(spark, [(w[0],) for w in rows])
    for out in (composition_stats_wide(wide, COLS, props, ["prop"]),
                composition_stats_long(wide_to_long(wide, COLS, keep_zero=True), props, ["prop"])):
        got = {r["entity_id"]: r for r in out.collect()}
        # NULL property with zero weight: ignored.
        assert got[0]["prop_mean"] == pytest.approx(2.0) and got[0]["prop_std"] == pytest.approx(1.0)
        # NULL property with non-zero weight: min/max skip it, mean/std NULL.
        assert got[1]["prop_min"] == 1.0 and got[1]["prop_max"] == 1.0
        assert got[1]["prop_mean"] is None and got[1]["prop_std"] is None
        assert got[1]["prop_mode1"] == 1.0 and got[1]["prop_mode2"] == 1.0  # tie: mode2 = mode1


def test_normalize_option(spark):
    wide = _wide(spark, [([25.0, 25.0, 0.0, 0.0],)])
    row = composition_stats_wide(wide, COLS, _props(spark), ["prop"], normalize=True).collect()[0]
    assert row["prop_mean"] == pytest.approx(4.0) and row["prop_std"] == pytest.approx(3.0)
    long = wide_to_long(wide, COLS)
    row = composition_stats_long(long, _props(spark), ["prop"], normalize=True).collect()[0]
    assert row["prop_mean"] == pytest.approx(4.0) and row["prop_std"] == pytest.approx(3.0)


def test_normalize_all_zero_gives_null(spark):
    wide = _wide(spark, [([0.0, 0.0, 0.0, 0.0],)])
    row = composition_stats_wide(wide, COLS, _props(spark), ["prop"], normalize=True).collect()[0]
    assert row["prop_mean"] is None and row["prop_std"] is None and row["prop_mode1"] == 1.0
    long = wide_to_long(wide, COLS, keep_zero=True)
    row = composition_stats_long(long, _props(spark), ["prop"], normalize=True).collect()[0]
    assert row["prop_mean"] is None and row["prop_std"] is None and row["prop_mode1"] == 1.0


def test_float_parity_mode(spark):
    out = composition_stats_wide(_wide(spark, EDGE_ROWS[:1]), COLS, _props(spark), ["prop"], as_float=True)
    assert dict(out.dtypes)["prop_mean"] == "float"


def test_wide_and_long_forms_agree_on_driver_data(spark):
    from tests.conftest import SF_SMALL
    props = property_table(spark, SF_SMALL)
    cols = ["s_filled", "min_price", "d_unfilled"]
    long = composition_stats_long(mix_long(spark, SF_SMALL), props, cols)
    wide = composition_stats_wide(long_to_wide(mix_long(spark, SF_SMALL), UNIVERSE), WEIGHT_COLS, props, cols)
    a = {r["entity_id"]: r for r in long.collect()}
    b = {r["entity_id"]: r.asDict() for r in wide.select("entity_id", *long.columns[1:]).collect()}
    assert a.keys() == b.keys() and len(a) > 0
    for k, ra in a.items():
        for c in long.columns[1:]:
            x, y = ra[c], b[k][c]
            assert (x is None and y is None) or math.isclose(x, y, abs_tol=1e-9), (k, c, x, y)


def test_wide_plan_has_no_shuffle_and_no_python(spark):
    wide = _wide(spark, EDGE_ROWS)
    out = composition_stats_wide(wide, COLS, _props(spark), ["prop"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_property_table_size_is_checked(spark):
    from mixlens.operators.composition import property_values
    from mixlens.operators.joins import TooLargeError
    big = spark.range(0, 20).select(F.col("id").cast("int").alias("component"), F.lit(1.0).alias("p"))
    with pytest.raises(TooLargeError):
        property_values(big, ["p"], max_components=10)


def test_single_property_entry_points(spark):
    from mixlens.operators.composition import atomic_property_stats, electron_property_stats
    from mixlens.sources.elements import element_table
    # O 60 %, Si 30 %, Na 10 % as columns named by atomic number
    wide = spark.createDataFrame([(1, 60.0, 30.0, 10.0)], "entity_id long, `8` double, `14` double, `11` double")
    cols = ["8", "14", "11"]
    out = electron_property_stats(wide, element_table(spark), "p", cols, filled=False).collect()[0]
    # unfilled p: O 2, Si 4, Na 6
    assert out["p_unfilled_mean"] == pytest.approx(0.6 * 2 + 0.3 * 4 + 0.1 * 6)
    assert out["p_unfilled_mode1"] == 2 and out["p_unfilled_mode2"] == 4
    radius = spark.createDataFrame([(8, 0.66), (11, 1.66), (14, 1.11)], "component int, r double")
    out = atomic_property_stats(wide, radius, "r", cols).collect()[0]
    assert out["r_max"] == 1.66 and out["r_min"] == 0.66


def test_unknown_components_keep_their_rows_and_agree_with_the_wide_form(spark):
    from mixlens.operators.composition import composition_stats_long, composition_stats_wide, long_to_wide, property_lookup
    mix = spark.createDataFrame([(1, 1, 60.0), (1, 9, 40.0), (2, 9, 100.0), (3, 2, 100.0), (4, 7, 100.0)],
                                "entity_id int, component int, weight_pct double")
    props = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 8.0)], "component int, p double")
    universe = [1, 2, 9]
    long = composition_stats_long(mix, props, ["p"], components=universe)
    wide = composition_stats_wide(long_to_wide(mix, universe), list(map(str, universe)), props, ["p"]).select(long.columns)
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, wide.collect()))
    rows = {r["entity_id"]: r for r in composition_stats_long(mix, props, ["p"]).collect()}
    assert set(rows) == {1, 2, 3, 4} and rows[1]["p_mean"] is None and rows[1]["p_max"] == 2.0 and rows[2]["p_mode1"] is None
    assert property_lookup(mix, props, ["p"]).where("p is null").count() == 3
    other = long_to_wide(mix, universe, other_col="other").where("entity_id = 4").first()
    assert other["other"] == 100.0 and other["1"] == 0.0


def test_null_weight_rules(spark):
    wide = spark.createDataFrame([(1, 60.0, None, 40.0)], "entity_id int, `1` double, `2` double, `3` double")
    long = spark.createDataFrame([(1, 1, 60.0), (1, 2, None), (1, 3, 40.0)], "entity_id int, component int, weight_pct double")
    props = spark.createDataFrame([(1, 1.0), (2, 5.0), (3, 2.0)], "component int, prop double")
    cols = ["1", "2", "3"]
    for out in (composition_stats_wide(wide, cols, props, ["prop"]), composition_stats_long(long, props, ["prop"])):
        r = out.collect()[0]
        assert (r["prop_max"], round(r["prop_mean"], 9)) == (2.0, 1.4)
    for make in (lambda: composition_stats_wide(wide, cols, props, ["prop"], null_weight="error"),
                 lambda: composition_stats_long(long, props, ["prop"], null_weight="error")):
        with pytest.raises(Exception, match="a weight is NULL or NaN"):
            make().collect()
    with pytest.raises(ValueError, match="null_weight"):
        composition_stats_long(long, props, ["prop"], null_weight="drop")


def test_fill_inside_the_atomic_statistics(spark):
    wide = spark.createDataFrame([(1, 50.0, 50.0, 0.0)], "entity_id int, `1` double, `2` double, `3` double")
    props = spark.createDataFrame([(1, 4.0), (2, None), (3, 9.0)], "component int, prop double")
    plain = atomic_property_stats(wide, props, "prop", ["1", "2", "3"]).collect()[0]
    filled = atomic_property_stats(wide, props, "prop", ["1", "2", "3"], fill=True).collect()[0]
    assert plain["prop_mean"] is None and (filled["prop_mean"], filled["prop_std"], filled["prop_mode2"]) == (4.0, 0.0, 4.0)


def test_percent_pivot_counts_other_components(spark):
    mix = spark.createDataFrame([(1, 1, 3.0), (1, 9, 1.0), (2, 2, 0.0), (3, None, 5.0)], "entity_id int, component int, qty double")
    out = long_to_wide(mix, [1, 2], weight_col="qty", percent=True, other_col="other")
    rows = {r["entity_id"]: (r["1"], r["2"], r["other"]) for r in out.collect()}
    assert rows == {1: (75.0, 0.0, 25.0), 2: (0.0, 0.0, 0.0), 3: (0.0, 0.0, 100.0)}
    assert long_to_wide(mix, [1, 2], weight_col="qty", percent=True).columns == ["entity_id", "1", "2"]


def test_pivot_keeps_no_wide_row_per_component(spark):
    """One row per entity in the pivot's shuffles, not a row of all columns for each (entity, component)."""
    from mixlens.operators.composition import long_to_wide
    rows = [(1, 1, 3.0), (1, 1, 2.0), (1, 9, 5.0), (1, None, 10.0), (2, 3, float("nan")), (2, 3, 1.0), (3, 9, None), (None, 2, 4.0)]
    mix = spark.createDataFrame(rows, "entity_id long, component int, qty double")
    shares = long_to_wide(mix, [3, 1, 2], weight_col="qty", percent=True)
    assert shares.columns == ["entity_id", "3", "1", "2"]
    assert {r[0]: tuple(r)[1:] for r in shares.collect()} == {1: (0.0, 25.0, 0.0), 2: (0.0, 0.0, 0.0), 3: (0.0, 0.0, 0.0), None: (0.0, 0.0, 100.0)}
    other = long_to_wide(mix, [3, 1, 2], weight_col="qty", other_col="rest")
    assert {r[0]: tuple(r)[1:] for r in other.collect()}[1] == (0.0, 5.0, 0.0, 15.0)
    plain = long_to_wide(mix.withColumn("qty", F.col("component").cast("long")), [3, 1, 2], weight_col="qty")
    assert dict(plain.dtypes)["1"] == "bigint" and {r[0]: tuple(r)[1:] for r in plain.collect()}[2] == (6, 0, 0)
    for out in (shares, other, plain):
        assert "pivotfirst" not in out._jdf.queryExecution().executedPlan().toString()
