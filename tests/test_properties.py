"""Property preparation (FIXTURES F2, F8) and ratios."""


import pytest
from pyspark.sql import functions as F

from mixlens.functions.ratios import linear_ratio, nbo_t
from mixlens.operators.properties import ELECTRON_PROPERTIES, SUBSHELL_CAPACITY, electron_shells, forward_fill
from mixlens.sources.elements import element_table


def test_shell_counts_fixture(spark):
    rows = [("1s", 1, 0, 0, 0), ("1s2", 2, 0, 0, 0), ("[Ar] 3d10 4s2 4p2", 2, 2, 10, 0),
            ("[Kr] 4d10", 0, 0, 10, 0), ("[Kr] 5s", 1, 0, 0, 0)]
    df = spark.createDataFrame([(r[0],) for r in rows], "electronic_configuration string")
    got = {r["electronic_configuration"]: r for r in electron_shells(df).collect()}
    for cfg, s, p, d, f in rows:
        r = got[cfg]
        assert (r["s_filled"], r["p_filled"], r["d_filled"], r["f_filled"]) == (s, p, d, f)
        assert r["s_unfilled"] == 2 - s and r["f_unfilled"] == 14 - f


def test_filled_plus_unfilled_is_capacity_for_all_elements(spark):
    out = electron_shells(element_table(spark)).collect()
    assert len(out) == 118
    for r in out:
        for l, cap in SUBSHELL_CAPACITY.items():
            assert r[f"{l}_filled"] + r[f"{l}_unfilled"] == cap


def test_known_element_counts(spark):
    got = {r["component"]: r for r in electron_shells(element_table(spark)).collect()}
    # Fe, Pd, Au, Gd, U
    assert (got[26]["s_filled"], got[26]["d_filled"]) == (2, 6)
    assert (got[46]["s_filled"], got[46]["d_filled"]) == (0, 10)
    assert (got[79]["s_filled"], got[79]["d_filled"], got[79]["f_filled"]) == (1, 10, 14)
    assert (got[64]["d_filled"], got[64]["f_filled"]) == (1, 7)
    assert (got[92]["d_filled"], got[92]["f_filled"]) == (1, 3)


def test_forward_fill_fixture(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0), (3, None), (4, 3.0)], "component int, v double")
    got = [r["v"] for r in forward_fill(df, ["v"], "component").orderBy("component").collect()]
    assert got == [None, 2.0, 2.0, 3.0]


def test_forward_fill_partitioned(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 1, None), ("b", 2, 5.0), ("b", 3, None)],
                               "prop string, component int, v double")
    got = {(r["prop"], r["component"]): r["v"] for r in forward_fill(df, ["v"], "component", ["prop"]).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): 1.0, ("b", 1): None, ("b", 2): 5.0, ("b", 3): 5.0}


def test_linear_ratio_fixture(spark):
    df = spark.createDataFrame([(-1.0, 2.0), (1.0, 0.0), (None, 1.0)], "num double, den double")
    got = [r[0] for r in df.select(linear_ratio({"num": 1}, {"den": 1})).collect()]
    assert got == [0.0, None, None]


def test_nbo_t(spark):
    # Na 20, Ca 10, Al 5, Si 60 -> (20 + 2*10 - 5) / (60 + 5) = 35 / 65
    df = spark.createDataFrame([(20.0, 10.0, 5.0, 60.0)], "`11` double, `20` double, `13` double, `14` double")
    columns = {11: "11", 20: "20", 13: "13", 14: "14"}
    with pytest.raises(ValueError, match="55"):
        nbo_t(columns)
    got = df.select(nbo_t(columns, missing="zero").alias("r")).collect()[0]["r"]
    assert got == pytest.approx(35 / 65)


def test_electron_property_names():
    assert ELECTRON_PROPERTIES[:4] == ["s_filled", "p_filled", "d_filled", "f_filled"]


def test_forward_fill_by_ranges_matches_single_window(spark):
    import random

    from mixlens.operators.properties import forward_fill_by_ranges
    rng = random.Random(3)
    rows = [(i, None if rng.random() < 0.7 else float(i)) for i in range(0, 30000, 3)]
    rows[0] = (0, None)  # leading NULL stays NULL
    df = spark.createDataFrame(rows, "k long, v double")
    last, exp = None, {}
    for k, v in rows:
        last = v if v is not None else last
        exp[k] = last
    for n in (1, 7, 40):
        assert {r["k"]: r["v"] for r in forward_fill_by_ranges(df, ["v"], "k", n_ranges=n).collect()} == exp


def test_forward_fill_by_other_and_several_keys(spark):
    import datetime
    day = datetime.date(2020, 1, 1)
    rows = [(None if i == 0 else day + datetime.timedelta(i // 10), f"{i % 10}", float(i) if i % 4 == 1 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "d date, s string, v double")
    got = {(r["d"], r["s"]): r["v"] for r in forward_fill(df, ["v"], ["d", "s"], n_ranges=9).collect()}
    last = None
    for d, s, v in rows:
        last = v if v is not None else last
        assert got[d, s] == last


def test_forward_fill_splits_a_hot_key_the_same_way_every_time(spark):
    rows = [(5, float(i) if i % 3 == 0 else None) for i in range(900)] + [(9, None), (1, None)]
    df = spark.createDataFrame(rows, "k int, v double")
    runs = [sorted(map(tuple, forward_fill(df.repartition(p), ["v"], "k", n_ranges=8).collect()), key=repr) for p in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == 902
    values = dict(runs[0])
    assert values[1] is None and values[9] is not None


def test_forward_fill_by_ranges_carries_over_empty_ranges(spark):
    from mixlens.operators.properties import forward_fill_by_ranges
    rows = [(k, 5.0 if k == 1 else (9.0 if k == 95 else None)) for k in range(100)]
    df = spark.createDataFrame(rows, "k long, v double")
    for n in (3, 10):
        got = {r["k"]: r["v"] for r in forward_fill_by_ranges(df, ["v"], "k", n_ranges=n).collect()}
        assert got[0] is None and got[1] == 5.0 and got[50] == 5.0 and got[94] == 5.0 and got[99] == 9.0


def test_forward_fill_over_ranges_of_ranges(spark):
    from mixlens.operators.properties import forward_fill_by_ranges
    rows = [(k, f"{k}" if k % 1900 == 7 else None, 1.0 if k == 3 else None) for k in range(12_000)]
    df = spark.createDataFrame(rows, "k long, v string, x double")

    def filled(n, fan):
        return sorted(map(tuple, forward_fill_by_ranges(df, ["v", "x"], "k", n_ranges=n, fan=fan).collect()))

    want, v, x = [], None, None
    for k, new_v, new_x in rows:
        v, x = new_v or v, new_x or x
        want.append((k, v, x))
    assert filled(8, 1000) == want
    assert filled(300, 5) == want  # four levels
    assert filled(5000, 64) == want


def test_forward_fill_of_large_partitions_and_equal_rows(spark):
    rows = [("hot", 5, 1.5)] * 700 + [("hot", k, 0.5 if k == 2 else None) for k in range(300)] + [(None, 1, None), (None, 2, 7.0), (None, 3, None)] \
        + [(f"p{k % 9}", k, float(k) if k % 4 == 0 else None) for k in range(90)]
    df = spark.createDataFrame(rows, "p string, k int, v double")
    want = sorted(map(tuple, forward_fill(df, ["v"], "k", ["p"]).collect()), key=repr)
    for n in (6, 50):
        assert sorted(map(tuple, forward_fill(df, ["v"], "k", ["p"], n_ranges=n).collect()), key=repr) == want
    assert forward_fill(df.limit(0), ["v"], "k").count() == 0
