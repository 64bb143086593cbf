"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Each query is built and forced to completion with the
``noop`` sink (every output column computed, nothing collected): one warm-up
run, then ``$BENCH_RUNS`` timed runs (median reported).

Headline comparison (SURVEY section 6): composition statistics on a
materialised mix in (a) wide form, (b) long form (also over a table bucketed
by entity), and (c) a row-at-a-time Python UDF over each entity's pairs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from mixlens.functions.composition import STAT_NAMES  # noqa: E402
from mixlens.operators.composition import composition_stats_long, composition_stats_wide, long_to_wide  # noqa: E402
from mixlens.operators.composition import property_values  # noqa: E402
from mixlens.plans import catalog  # noqa: E402
from mixlens.plans.inputs import UNIVERSE, WEIGHT_COLS, mix_long, property_table  # noqa: E402
from mixlens.session import local_session, scratch_path  # noqa: E402
from mixlens.sinks import write_bucketed  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
PROPS = ["s_filled", "min_price"]


def python_udf_stats(mix, props_df):
    """Row-at-a-time Python form (the slow path), for comparison only: one UDF over each entity's
    (component, weight) pairs gives the statistics of all properties, from their definitions."""
    _, tables = property_values(props_df, PROPS)
    names = [f"{p}_{s}" for p in PROPS for s in STAT_NAMES]

    def statistics_of(pairs):
        share = {c: x for c, x in pairs if x is not None and x > 0}
        ranked = sorted(UNIVERSE, key=lambda c: -share.get(c, 0.0))  # stable: ties in component order
        top, second = ranked[0], ranked[1]
        if share.get(second, 0.0) == share.get(top, 0.0):
            second = top
        result = {}
        for p in PROPS:
            value = tables[p]
            known = [value[c] for c in share if value[c] is not None]
            result[f"{p}_max"], result[f"{p}_min"] = max(known, default=None), min(known, default=None)
            result[f"{p}_mode1"], result[f"{p}_mode2"] = value[top], value[second]
            mean = spread = None
            if len(known) == len(share):
                mean = sum(x * value[c] for c, x in share.items()) / 100
                spread = sum(x * abs(value[c] - mean) for c, x in share.items()) / 100
            result[f"{p}_mean"], result[f"{p}_std"] = mean, spread
        return tuple(None if result[n] is None else float(result[n]) for n in names)

    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    gathered = mix.groupBy("entity_id").agg(F.collect_list(F.struct("component", "weight_pct")).alias("pairs"))
    return gathered.select("entity_id", F.udf(statistics_of, schema)("pairs").alias("r")).select("entity_id", "r.*")


def timed(df_fn) -> float:
    """Median wall time of building and running the query, after one untimed
    warm-up run (first-run costs: JIT warm-up, code generation and compilation,
    which a long job on a cluster pays once per executor)."""
    df_fn().write.format("noop").mode("overwrite").save()
    times = []
    for _ in range(RUNS):
        t0 = time.perf_counter()
        df_fn().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2, app_name="mixlens-bench")
    props = property_table(spark, SF_DIR)
    props_local = spark.createDataFrame(props.collect(), props.schema)  # bounded: 50 rows
    long_path, wide_path = scratch_path(spark, "bench_long"), scratch_path(spark, "bench_wide")
    # Materialised inputs (setup, not timed), one file per core as a cluster
    # table would be split across many files.
    parts = int(CPUS) * 2
    mix_long(spark, SF_DIR).repartition(parts).write.parquet(long_path)
    long_to_wide(spark.read.parquet(long_path), UNIVERSE).repartition(parts).write.parquet(wide_path)
    long_df, wide_df = spark.read.parquet(long_path), spark.read.parquet(wide_path)
    # The recommended layout for stored mixes: bucketed by entity (no shuffle
    # in the long-form statistics).
    bucketed_df = write_bucketed(long_df, "bench_mix_long_bucketed", scratch_path(spark, "bench_bucketed"),
                                 "entity_id", parts)

    q = {}
    q["stats_wide"] = timed(lambda: composition_stats_wide(wide_df, WEIGHT_COLS, props_local, PROPS))
    q["stats_long"] = timed(lambda: composition_stats_long(long_df, props_local, PROPS, components=UNIVERSE))
    q["stats_long_bucketed"] = timed(lambda: composition_stats_long(bucketed_df, props_local, PROPS, components=UNIVERSE))
    # Plain Spark over the same rows, never changed: tells a slower machine from a slower query.
    q["control"] = timed(lambda: long_df.groupBy("entity_id").agg(F.max("weight_pct"), F.count("component")))
    q["stats_python_udf"] = timed(lambda: python_udf_stats(long_df, props_local))
    for name in ("composition_stats_long", "composition_stats_wide", "electron_stats", "linear_ratio",
                 "equal_width_bins", "train_test_split", "word_count", "regression_metrics", "except_distinct",
                 "property_ffill", "sample_exact", "composition_stats_many_components"):
        q[name] = timed(lambda n=name: catalog.QUERIES[n](spark, SF_DIR))
    headline = [k for k in q if k not in ("stats_python_udf", "control")]
    print(json.dumps({
        "metric": "median_query_seconds_total",
        "value": round(sum(q[k] for k in headline), 3),
        "unit": "sec",
        "queries": q,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS,
        "runs": RUNS,
        "over_control": {k: round(v / max(q["control"], 1e-9), 2) for k, v in q.items()},
        "udf_over_wide_speedup": round(q["stats_python_udf"] / max(q["stats_wide"], 1e-9), 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
