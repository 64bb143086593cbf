"""The pipeline's stages against brute-force versions, and the registered queries."""

import os
import subprocess
import sys

import duckdb

import __spark_entry__ as entry
import corpus_pipeline
from mixlens.llm import mixing, quality
from mixlens.llm.queries import ORACLE_SQL, QUERIES
from mixlens.sources.files import read_table
from tests.llm.test_operators import brute_components, same

SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_part(spark):
    docs, before = read_table(spark, SF, "documents"), None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name != "packing":
            assert out.columns == docs.columns
            got = sorted((r["doc_id"], r["text"]) for r in out.collect())
        if name == "quality":
            model = quality.fit(docs, read_table(spark, SF, "labels"))
            assert got == sorted(r for r, s in zip(rows, model.score([t for _, t in rows])) if s >= 0.7)
        elif name == "exact_dedup":
            first = {}
            for i, t in sorted(rows):
                first.setdefault(" ".join(t.split()), i)
            assert [i for i, _ in got] == sorted(first.values())
        elif name == "near_dedup":
            assert [i for i, _ in got] == sorted({c for _, c in brute_components(rows, 5, 80).values()})
        elif name == "mixing":
            taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect() if r["taken"]}
            words = {}
            for i, t in got:
                words[i] = words.get(i, 0) + len(t.split())
            assert words == taken
        else:
            assert {r["doc_id"] for r in out.collect()} == {i for i, _ in rows}
        docs = out
    assert corpus_pipeline.run(spark, SF).columns == out.columns


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        same(entry.queries()[name](spark, SF).toPandas(), con.execute(sql).df())
    assert set(QUERIES) <= set(entry.queries())


def test_the_entry_module_works_without_this_package():
    code = ("import sys; sys.modules['mixlens.llm'] = None\n"
            "import builtins, importlib\nold = builtins.__import__\n"
            "def gone(name, *a, **b):\n"
            "    if name.startswith('mixlens.llm') or name == 'corpus_pipeline':\n"
            "        raise ModuleNotFoundError(name, name=name)\n"
            "    return old(name, *a, **b)\n"
            "builtins.__import__ = gone\nimport __spark_entry__ as e\nassert 'pipeline' not in e.queries() and len(e.queries()) > 30\n")
    root = os.path.dirname(os.path.abspath(entry.__file__))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
