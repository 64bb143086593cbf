"""Composition features on a stream.

The wide-form statistics and the hash split are per-row expressions, so they
run unchanged on a streaming DataFrame: no state store, no watermark, and
exactly-once output through the file sink's checkpoint. New raw files
landing in the source folder are featurised incrementally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mixlens.operators.composition import composition_stats_wide
from mixlens.operators.split import train_test_split


def stats_stream(stream: DataFrame, component_cols, props: DataFrame, property_cols: Sequence[str],
                 *, split_keys: Sequence[str] | None = None, test_size: float = 0.2) -> DataFrame:
    """Streaming DataFrame with the statistics (and optionally the split) added."""
    out = composition_stats_wide(stream, component_cols, props, property_cols)
    if split_keys:
        out = train_test_split(out, split_keys, test_size)
    return out


def run_stats_stream(spark: SparkSession, source: str, schema: T.StructType, component_cols,
                     props: DataFrame, property_cols: Sequence[str], sink: str, checkpoint: str,
                     *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Process every file present in ``source`` (trigger availableNow) into ``sink``.

    Returns the sink read back as a batch DataFrame.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source)
    out = stats_stream(stream, component_cols, props, property_cols)
    q = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)
