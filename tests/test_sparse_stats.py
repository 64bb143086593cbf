"""Composition statistics without a bound on components: against the gathering form and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from mixlens.operators import composition, joins, sparse_stats
from mixlens.operators.composition import composition_stats_long
from mixlens.operators.sparse_stats import composition_stats_sparse


def _rows(df):
    return {r[0]: [None if v is None else round(v, 9) + 0.0 for v in r[1:]] for r in df.collect()}


@pytest.fixture(scope="module")
def props(spark):
    rows = [(c, None if c % 5 == 4 else float((c * 7) % 11), float(-c)) for c in range(1, 31)]
    return spark.createDataFrame(rows, "component int, a double, b double")


@pytest.fixture(scope="module")
def mix(spark):
    rng = random.Random(4)
    rows = []
    for e in [*range(120), None]:
        for c in rng.sample(range(0, 36), rng.randint(1, 6)):  # 0 and 31..35 are unknown
            rows.append((e, c, rng.choice([None, float("nan"), 0.0, 0.0, 5.0, 5.0, 10.0, 30.0, -4.0])))
    rows += [(200, c, -float(c)) for c in range(1, 31)] + [(201, c, 0.0) for c in (1, 2, 4)] + [(202, 1, 3.0)] * 4 + [(203, 33, 0.0), (204, 2, -1.0), (205, 35, 9.0)]
    return spark.createDataFrame(rows, "entity_id int, component int, weight_pct double")


@pytest.mark.parametrize("options", [{}, {"normalize": True}, {"components": list(range(1, 31))}, {"components": [2, 3, 40, 50]}, {"components": [3]},
                                     {"as_float": True, "names": {"a": "x"}}])
def test_equals_the_gathering_form(mix, props, options):
    a, b = (f(mix, props, ["a", "b"], **options) for f in (composition_stats_long, composition_stats_sparse))
    assert a.columns == b.columns
    assert _rows(a) == _rows(b)


def test_beyond_the_broadcast_bounds(mix, props, monkeypatch):
    want = _rows(composition_stats_sparse(mix, props, ["a", "b"]))
    monkeypatch.setattr(sparse_stats, "lookup_join", lambda big, small, on, how="inner": joins.lookup_join(big, small, on, how, max_rows=3))
    assert _rows(composition_stats_sparse(mix, props, ["a", "b"])) == want


def test_long_form_takes_the_other_way_beyond_its_bound(mix, props, monkeypatch):
    want = _rows(composition_stats_long(mix, props, ["a", "b"]))
    monkeypatch.setattr(composition, "MAX_COMPONENTS", 3)
    assert _rows(composition_stats_long(mix, props, ["a", "b"])) == want
    assert _rows(composition_stats_long(mix, props, ["a", "b"], components=list(range(1, 31)))) == _rows(
        composition_stats_sparse(mix, props, ["a", "b"], components=list(range(1, 31))))


def test_hundred_thousand_components_and_a_million_rows_in_one_entity(spark):
    n = 100_000
    props = spark.range(n).select(F.col("id").alias("component"), (F.col("id") % 1009).cast("double").alias("p"))
    hot = spark.range(10 * n).select(F.lit(-1).cast("long").alias("entity_id"), (F.col("id") % n).alias("component"),
                                     (F.lit(1.0) + (F.col("id") % 7)).alias("weight_pct"))
    cold = spark.range(2000).select("id", ((F.col("id") * 7919) % n).alias("component"), F.lit(100.0).alias("weight_pct"))
    out = _rows(composition_stats_sparse(hot.union(cold), props, ["p"], normalize=True))
    assert len(out) == 2001
    w = [sum(1.0 + (i + k * n) % 7 for k in range(10)) for i in range(n)]
    total, p = sum(w), [float(i % 1009) for i in range(n)]
    mean = sum(a * b for a, b in zip(w, p)) / total
    ranked = sorted(range(n), key=lambda i: (-w[i], i))
    first, second = ranked[:2]
    hi, lo, std, got_mean, mode1, mode2 = out[-1]
    assert (hi, lo, mode1, mode2) == (1008.0, 0.0, p[first], p[first] if w[first] == w[second] else p[second])
    assert got_mean == pytest.approx(mean) and std == pytest.approx(sum(a * abs(b - mean) for a, b in zip(w, p)) / total)
    for e in (0, 1, 500, 1999):  # one component: mode2 is that of the first absent one
        c = e * 7919 % n
        assert out[e] == [p[c], p[c], 0.0, p[c], p[c], p[1 if c == 0 else 0]]


def test_doubled_components_and_empty(spark, mix, props):
    with pytest.raises(Exception, match="duplicate components"):
        composition_stats_sparse(mix, props.union(props.limit(1)), ["a"]).count()
    assert composition_stats_sparse(mix.limit(0), props, ["a"]).count() == 0
    nothing = composition_stats_sparse(mix, props.limit(0), ["a"])
    assert nothing.count() == mix.select("entity_id").distinct().count() and nothing.where("a_mode1 is not null").count() == 0
