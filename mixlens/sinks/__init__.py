"""Sinks: Parquet (K1), split tables (K2), models (K3), metrics (K4), text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mixlens.session import scratch_path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: parallel Parquet write, one file per task."""
    df.write.mode(mode).parquet(path)


def write_split(df: DataFrame, path: str, split_col: str = "split", mode: str = "overwrite",
                drop: tuple[str, ...] = ()) -> None:
    """K2: train and test in one write, as partitions ``split=train`` / ``split=test``.

    Readers filtering on ``split`` only list the matching folder.
    """
    df.drop(*drop).write.mode(mode).partitionBy(split_col).parquet(path)


def append_metrics(metrics: DataFrame, path: str, run_id: str | None = None) -> None:
    """K4: append a metrics row set to a Parquet table; with ``run_id`` a job run again replaces its own rows."""
    if run_id is None:
        metrics.write.mode("append").parquet(path)
    else:
        write_run(metrics, path, run_id)


_RUN_ID = re.compile(r"[A-Za-z][A-Za-z0-9_.-]*")


def write_run(df: DataFrame, path: str, run_id: str, run_col: str = "run_id") -> None:
    """K1/K4, safe to repeat: the rows of ``run_id`` in the table at ``path`` become those of ``df``.

    The table is partitioned by the run. Spark writes aside and swaps in the run's partition when all tasks are done
    (dynamic partition overwrite): a job that fails leaves what was there, one that is run again leaves its rows
    once, and other runs are never touched. A run that gives no rows any more empties its partition.
    """
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"not a run id: {run_id!r} (a letter, then letters, digits, '_', '.', '-')")
    if run_col in df.columns:
        raise ValueError(f"the table has a column {run_col!r} already")
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(run_col, F.lit(run_id))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run_col).parquet(path)
    if not seen.get["rows"]:
        df.limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{run_col}={run_id}")


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the session's ``spark.checkpoint.dir`` and read back: later steps read
    the columns they need, and a lost executor repeats no more than their own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_text(df: DataFrame, col: str, path: str, mode: str = "overwrite") -> None:
    """One line per value (values may themselves hold newlines)."""
    df.select(col).write.mode(mode).text(path)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as a table bucketed by ``key`` at ``path`` and return it.

    Later aggregates and joins on ``key`` (e.g. the long-form statistics by
    entity) read the buckets as an existing hash partitioning and need no
    shuffle. The bucket count is fixed at write time; pick it from the data
    size (about 128-512 MB per bucket file).
    """
    df.write.mode(mode).bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)
