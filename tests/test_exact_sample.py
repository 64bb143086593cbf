"""Exact stratified samples and rates from a table, against brute force."""

import hashlib

import pytest
from pyspark.sql import functions as F

from mixlens.operators import joins, split


def _brute(rows, rates, key=lambda r: str(r[0])):
    out = []
    for s in {r[1] for r in rows}:
        of = sorted((hashlib.md5(key(r).encode()).hexdigest(), r) for r in rows if r[1] == s)
        out += [r for _, r in of[: int((rates.get(s) or 0) * len(of) + 0.5)]]
    return sorted(out, key=repr)


def test_one_stratum_holds_nearly_all_rows(spark):
    df = spark.range(200_000).select(F.col("id").alias("k"), F.when(F.col("id") % 1000 < 997, "big").when(F.col("id") % 1000 < 999, "small").alias("s"))
    rows = [tuple(r) for r in df.collect()]
    rates = {"big": 0.123, "small": 0.5, None: 0.25}
    got = sorted((tuple(r) for r in split.sample_exact(df.repartition(13), ["k"], "s", rates).collect()), key=repr)
    assert got == _brute(rows, rates)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 0.999, 1.0, 2.0])
def test_shares_are_exact_and_nested(spark, rate):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("s"))
    got = {tuple(r) for r in split.sample_exact(df, ["k"], "s", rate).collect()}
    assert got == set(_brute([tuple(r) for r in df.collect()], {s: min(rate, 1.0) for s in range(7)}))
    assert got <= {tuple(r) for r in split.sample_exact(df, ["k"], "s", min(1.0, rate + 0.2)).collect()}


def test_repeated_keys_and_rows_at_the_cut(spark):
    # A third of all rows are one row, and keys repeat with other values.
    rows = [(1, "a", 5)] * 1000 + [(k % 40, "a", k) for k in range(2000)] + [(None, "b", k % 3) for k in range(30)]
    df = spark.createDataFrame(rows, "k int, s string, x int")
    for rate in (0.01, 0.3, 0.34, 0.5, 0.77):
        got = [tuple(r) for r in split.sample_exact(df, ["k"], "s", rate).collect()]
        again = [tuple(r) for r in split.sample_exact(df.repartition(5, "x"), ["k"], "s", rate).collect()]
        assert sorted(got, key=repr) == sorted(again, key=repr)
        for s, n in (("a", 3000), ("b", 30)):
            assert sum(r[1] == s for r in got) == int(rate * n + 0.5)
        left = list(rows)
        for r in got:
            left.remove(r)  # no row is drawn more often than it is there
        drawn = {hashlib.md5(str(r[0]).encode()).hexdigest() for r in got if r[1] == "a"}
        kept = {hashlib.md5(str(r[0]).encode()).hexdigest() for r in left if r[1] == "a"}
        assert max(drawn) <= min(kept)


def test_rates_from_a_table_of_any_size(spark, monkeypatch):
    df = spark.range(6000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 500).alias("s"))
    rates = spark.range(400).select(F.col("id").alias("s"), (F.col("id") % 5 / 4).alias("r")).unionByName(
        spark.createDataFrame([(None, 0.25)], "s long, r double"))
    by = {r["s"]: r["r"] for r in rates.collect()}
    rows = [tuple(r) for r in df.collect()]
    hashes = {r: hashlib.md5(str(r[0]).encode()).hexdigest()[:8] for r in rows}
    want = sorted((r for r in rows if r[1] in by and by[r[1]] > 0 and int(hashes[r], 16) < by[r[1]] * 16 ** 8), key=repr)
    exact = _brute(rows, by)
    for bound in (1_000_000, 10):  # broadcast, and the way beyond its bound
        def bounded(big, small, on, how="inner", f=joins.lookup_join, n=bound):
            return f(big, small, on, how, max_rows=n)
        monkeypatch.setattr(split, "lookup_join", bounded)
        assert sorted((tuple(r) for r in split.sample_by_hash(df, ["k"], "s", rates).collect()), key=repr) == want
        assert sorted((tuple(r) for r in split.sample_exact(df, ["k"], "s", rates).collect()), key=repr) == exact


def test_empty_tables_and_two_rates(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    none = spark.createDataFrame([], "s string, r double")
    assert split.sample_exact(df, ["k"], "s", none).count() == 0 and split.sample_by_hash(df, ["k"], "s", none).count() == 0
    assert split.sample_exact(df.limit(0), ["k"], "s", 0.5).count() == 0
    twice = spark.createDataFrame([("x", 0.1), ("x", 0.2)], "s string, r double")
    with pytest.raises(Exception, match="two rates"):
        split.sample_exact(df, ["k"], "s", twice).count()
