"""Regression metrics as one aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label_col: str, prediction_col: str = "prediction") -> DataFrame:
    """One row: n, rmse, mae, mse over rows with both values present, and n_skipped, the other rows.

    A single partial/final aggregate: each task reduces its rows to four
    numbers before the (one-row) shuffle.
    """
    err = F.col(prediction_col).cast("double") - F.col(label_col).cast("double")
    m = df.agg(F.count(err).alias("n"), F.count(F.when(err.isNull(), 1)).alias("n_skipped"),
               F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"))
    return m.select("n", F.sqrt("mse").alias("rmse"), "mae", "mse", "n_skipped")
