"""Checked CSV with rejects, retry-safe output, the element data source, EXCEPT on wide rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from mixlens.operators import joins, split
from mixlens.sinks import append_metrics, write_run
from mixlens.sources.element_source import KeyedRowsSource, register
from mixlens.sources.elements import ELEMENT_SCHEMA, element_rows
from mixlens.sources.files import read_csv_checked

JSON = {"type": "struct", "fields": [{"name": n, "type": t, "nullable": True, "metadata": {}}
                                     for n, t in (("id", "integer"), ("a b", "string"), ("ok", "boolean"), ("at", "timestamp"))]}
LINES = '''id,a b,ok,at
1,"x, ""quoted""",true,2024-01-31 10:00:00
2,,,
3,plain,maybe,2024-01-31 10:00:00
four,y,false,2024-02-30 10:00:00
5,short
6,long,true,2024-01-31 10:00:00,more
7,"été 日本",false,2024-12-01 00:00:00
99999999999,big,true,2024-12-01 00:00:00
'''


def _csv(tmp_path, text, name="t.csv"):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_good_rows_and_rejects(spark, tmp_path):
    got = read_csv_checked(spark, _csv(tmp_path, LINES), JSON)
    at = datetime.datetime(2024, 1, 31, 10)
    assert sorted(map(tuple, got.rows.collect())) == [(1, 'x, "quoted"', True, at), (2, None, None, None),
                                                     (7, "été 日本", False, datetime.datetime(2024, 12, 1))]
    rejects = {r["line"]: (r["wrong_fields"], r["bad_columns"]) for r in got.rejects.collect()}
    assert rejects == {
        "3,plain,maybe,2024-01-31 10:00:00": (False, ["ok"]), "four,y,false,2024-02-30 10:00:00": (False, ["id", "at"]),
        "5,short": (True, []), "6,long,true,2024-01-31 10:00:00,more": (True, []), "99999999999,big,true,2024-12-01 00:00:00": (False, ["id"])}
    assert got.rejects.where("file like '%t.csv'").count() == 5
    # Whatever columns are asked for, the same rows are good.
    assert got.rows.count() == 3 and got.rows.select("a b").where("`a b` is null").count() == 1 and got.rejects.count() == 5


def test_header_is_checked(spark, tmp_path):
    for bad in (LINES.replace("id,a b", "id,b a"), LINES.replace(",ok,at\n", ",ok\n", 1)):
        with pytest.raises(Exception, match="header"):
            read_csv_checked(spark, _csv(tmp_path, bad), JSON).rows.collect()
    body = LINES.split("\n", 1)[1]
    assert read_csv_checked(spark, _csv(tmp_path, body), JSON, header=False).rows.count() == 3


def test_empty_file_separators_and_null_text(spark, tmp_path):
    assert read_csv_checked(spark, _csv(tmp_path, "id,a b,ok,at\n"), JSON).rows.count() == 0
    text = "1;NA;true;NA\nNA;x;NA;31/01/2024\n2;x;true;2024-01-31\n"
    got = read_csv_checked(spark, _csv(tmp_path, text), JSON, header=False, sep=";", null_value="NA", options={"timestampFormat": "dd/MM/yyyy"})
    assert got.rows.count() == 2 and [r["bad_columns"] for r in got.rejects.collect()] == [["at"]]


def test_run_again_leaves_its_rows_once(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    write_run(df, path, "a")
    write_run(df.where("id < 3"), path, "b")
    write_run(df.where("id < 5"), path, "a")
    assert {r["run_id"]: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {"a": 5, "b": 3}
    write_run(df.where("id < 0"), path, "b")
    assert [r["run_id"] for r in spark.read.parquet(path).select("run_id").distinct().collect()] == ["a"]
    for bad in ("", "../x", "a b", "1", "a=b"):
        with pytest.raises(ValueError, match="not a run id"):
            write_run(df, path, bad)
    with pytest.raises(ValueError, match="already"):
        write_run(df.withColumn("run_id", F.lit(1)), path, "c")


def test_a_failed_run_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.range(100, numPartitions=4)
    append_metrics(df, path, run_id="a")
    with pytest.raises(Exception, match="late failure"):
        append_metrics(df.withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("late failure")).cast("long"))), path, run_id="a")
    assert spark.read.parquet(path).count() == 100
    append_metrics(df.limit(1), str(tmp_path / "plain"))
    append_metrics(df.limit(1), str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2


def test_element_source_by_name(spark):
    register(spark)
    read = spark.read.format("mixlens_elements")
    for n in (1, 4, 500):
        df = read.option("partitions", n).load()
        assert sorted(map(tuple, df.collect())) == element_rows() and df.schema == ELEMENT_SCHEMA
    assert read.option("partitions", 4).load().rdd.getNumPartitions() == 4
    assert [r[0] for r in read.option("first", 5).option("last", 7).load().orderBy("component").collect()] == [5, 6, 7]
    with pytest.raises(Exception, match="keys must lie in"):
        read.option("last", 200).load().collect()


def test_a_source_of_ones_own(spark):
    class Squares(KeyedRowsSource):
        KEYS = (0, 9)

        @classmethod
        def name(cls):
            return "squares"

        def schema(self):
            return "k int, s int"

        def rows_of(self, key):
            yield key, key * key

    spark.dataSource.register(Squares)
    assert sorted(map(tuple, spark.read.format("squares").option("partitions", 3).load().collect())) == [(k, k * k) for k in range(10)]


@pytest.mark.parametrize("verify", [False, True])
def test_except_on_wide_rows(spark, verify, monkeypatch):
    rows = [(i % 7, None if i % 3 else "x", float("nan") if i % 5 == 0 else 0.5 * (i % 4), [i % 2]) for i in range(200)] + [(1, "hot", 1.0, None)] * 500
    a = spark.createDataFrame(rows, "k int, s string, v double, l array<int>")
    b = spark.createDataFrame([(r[0], r[1], r[2], r[3]) for r in rows[:40]] + [(1, "HOT", 1.0, None)], "x long, s string, v double, l array<int>")

    def plain(df):
        return sorted(map(repr, map(tuple, df.collect())))

    want = plain(a.exceptAll(a.limit(0)).select(F.col("k").cast("long"), "s", "v", "l").subtract(b))
    assert plain(split.except_distinct_wide(a, b, verify)) == want
    monkeypatch.setattr(split, "lookup_join", lambda big, small, on, how="inner": joins.lookup_join(big, small, on, how, max_rows=2))
    assert plain(split.except_distinct_wide(a, b, verify)) == want
    assert plain(split.except_distinct_wide(a, a, verify)) == [] and split.except_distinct_wide(a.limit(0), a, verify).count() == 0
    assert split.except_distinct_wide(a, a.limit(0), verify).count() == a.distinct().count()


def test_rows_of_one_digest_are_compared(spark, monkeypatch):
    """Digests as poor as can be: all rows meet, and the third hash tells them apart."""
    poor = lambda cols: [F.lit(0).cast("long").alias("__d1"), F.lit(0).cast("long").alias("__d2"), F.xxhash64(*cols).alias("__d3")]
    monkeypatch.setattr(split, "row_digest", poor)
    a, b = spark.range(20).select("id", (F.col("id") % 3).alias("m")), spark.range(5, 30).select("id", (F.col("id") % 3).alias("m"))
    assert sorted(r["id"] for r in split.except_distinct_wide(a, b).collect()) == [0, 1, 2, 3, 4]


def test_one_narrow_exchange_settles_the_difference(spark):
    cols = [F.col("id"), *[(F.col("id") % (k + 2)).alias(f"c{k}") for k in range(119)]]
    left, right = spark.range(500).repartition(3).select(*cols), spark.range(20, 500).select(*cols)
    out = split.except_distinct_wide(left, right)
    assert len(out.collect()) == 20
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The rows left are the only wide ones that are shuffled (made distinct), and no join is on 120 keys.
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_verified_except_moves_each_row_once(spark):
    """With ``verify`` the rows of both sides cross one exchange, their whole numbers as one text, and come back as they were."""
    cols = [F.col("id"), *[F.when(F.col("id") % (k + 2) > 0, F.col("id") % (k + 3) - 2).alias(f"c{k}") for k in range(30)],
            (F.col("id") / 3).alias("v"), F.concat(F.lit("a,"), F.col("id")).alias("s")]
    left = spark.range(300).union(spark.range(50)).select(*cols)
    right = spark.range(40, 300).select(*cols).toDF(*[f"r{i}" for i in range(33)])
    out = split.except_distinct_wide(left, right, verify=True)
    assert out.schema.simpleString() == left.schema.simpleString()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted(map(repr, out.collect())) == sorted(map(repr, left.where("id < 40").distinct().collect()))
    wide = spark.createDataFrame([(None, None), (0, -1), (None, 5)], "a long, b int")
    assert sorted(map(repr, split.except_distinct_wide(wide, wide.where("b = -1"), verify=True).collect())) == ["Row(a=None, b=5)", "Row(a=None, b=None)"]
