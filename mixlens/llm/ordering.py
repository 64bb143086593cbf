"""Places of rows in a total order, per group, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixlens.llm.common import stored, tasks_for


def positions(rows: DataFrame, group: list[str], order: list[str], name: str, carry: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``pos`` (from 0, in its group by ``order``, nulls first) and ``size`` (rows of the group).

    The rows are dealt out by ranges of (group, order) and stored with the number of their range, so a large group
    spans many ranges. Rows are numbered inside a range, and a window over one row for each (group, range) adds
    up the ranges before it. Equal rows are told apart by a row number of the scan: they split as others do,
    and which of them comes first does not matter. ``carry`` (a row for each group) is joined to those sums.
    """
    numbered = rows.withColumn("__salt", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(tasks_for(rows), *group, *order, "__salt").withColumn("__part", F.spark_partition_id())
    ranged = stored(ranged, name)
    ranges = ranged.groupBy("__part", *group).agg(F.count("*").alias("__n"))
    along = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.select("__part", *group, F.coalesce(F.sum("__n").over(along), F.lit(0)).alias("__before"),
                         F.sum("__n").over(Window.partitionBy(*group)).alias("size"))
    if carry is not None:
        sums = null_safe_join(sums, carry, group)
    inside = Window.partitionBy("__part", *group).orderBy(*order, "__salt")
    out = ranged.withColumn("__row", F.row_number().over(inside) - 1)
    return null_safe_join(out, sums, ["__part", *group]).withColumn("pos", F.col("__before") + F.col("__row")) \
        .drop("__salt", "__part", "__row", "__before")


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join where NULL equals NULL."""
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    return left.join(right, cond).drop(*[f"__r_{c}" for c in on])
