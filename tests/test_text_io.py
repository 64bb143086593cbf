"""Word count (F6), typed CSV (S1, S2), Parquet/text round trips, split write (K2)."""

from pyspark.sql import functions as F

from mixlens.operators.text import tokens, word_count
from mixlens.session import scratch_path
from mixlens.sinks import append_metrics, write_split, write_text
from mixlens.sources.files import read_lines, read_typed_csv, schema_from_json


def test_tokens_fixture(spark):
    df = spark.createDataFrame([("a  b ",), ("",)], "value string")
    assert [r["word"] for r in tokens(df).collect()] == ["a", "", "b", "", ""]


def test_word_count_matches_python(spark):
    texts = ["the cat  the", "dog\nthe", " x"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r["word"]: r["count"] for r in word_count(df, multiline=True).collect()}
    exp = {}
    for t in texts:
        for line in t.split("\n"):
            for w in line.split(" "):
                exp[w] = exp.get(w, 0) + 1
    assert got == exp


def test_text_roundtrip(spark):
    df = spark.createDataFrame([("a b\nc",), ("d",)], "value string")
    path = scratch_path(spark, "t")
    write_text(df, "value", path)
    assert sorted(r["value"] for r in read_lines(spark, path).collect()) == ["a b", "c", "d"]


def test_typed_csv_bad_field_becomes_null(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("GLASNO,A_WT,SIO2,Patent\n1,2.5,60.0,true\n2,oops,70.0,false\n")
    schema = schema_from_json({"type": "struct", "fields": [
        {"name": "GLASNO", "type": "integer", "nullable": True, "metadata": {}},
        {"name": "A_WT", "type": "float", "nullable": True, "metadata": {}},
        {"name": "SIO2", "type": "float", "nullable": True, "metadata": {}},
        {"name": "Patent", "type": "boolean", "nullable": True, "metadata": {}}]})
    rows = read_typed_csv(spark, str(p), schema).orderBy("GLASNO").collect()
    assert rows[0]["A_WT"] == 2.5 and rows[1]["A_WT"] is None and rows[1]["SIO2"] == 70.0
    assert rows[1]["Patent"] is False


def test_split_write_prunes_partitions(spark):
    df = spark.range(0, 100).withColumn("split", F.when(F.col("id") < 80, "train").otherwise("test"))
    path = scratch_path(spark, "s")
    write_split(df, path)
    test = spark.read.parquet(path).where(F.col("split") == "test")
    assert test.count() == 20
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_metrics_append(spark):
    path = scratch_path(spark, "m")
    m = spark.createDataFrame([("rmse", 1.5)], "metric string, value double")
    append_metrics(m, path)
    append_metrics(m, path)
    assert spark.read.parquet(path).count() == 2
