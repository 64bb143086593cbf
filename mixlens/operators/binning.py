"""Target range, equal-width bins and strata.

The edges are one aggregate used as a scalar subquery: Spark runs it once and
feeds the values into the projection as constants, so there is no driver
round trip and no join against the data. ``mixlens.ml.binning`` holds the same
bins as a fitted model, for use on other tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def target_range(df: DataFrame, col: str) -> DataFrame:
    """G1 + G2 in one pass: one row (lo, hi); NaN and infinities are left out of the range."""
    x = _finite(F.col(col).cast("double"))
    return df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))


def equal_width_edges(lo: Column, hi: Column, n: int) -> list[Column]:
    """M1: edge_i = lo + (hi - lo) * i / n, i = 0..n (the reference's arithmetic order)."""
    return [lo + (hi - lo) * F.lit(float(i)) / F.lit(float(n)) for i in range(n + 1)]


def bin_label(x: Column, edges: list[Column]) -> Column:
    """M2/P8: '0'..'n-1' for [e_k, e_k+1), the last bin closed; NULL outside or for NULL.

    Pass the range's own end as the last edge: the arithmetic one can round below it.
    """
    n = len(edges) - 1
    expr = None
    for k in range(n):
        upper_ok = (x <= edges[k + 1]) if k == n - 1 else (x < edges[k + 1])
        cond = (x >= edges[k]) & upper_ok
        expr = F.when(cond, F.lit(str(k))) if expr is None else expr.when(cond, F.lit(str(k)))
    return expr


def inner_edges_subquery(df: DataFrame, col: str, n: int) -> Column:
    """The edges between the bins, edge_1 .. edge_(n-1), as one scalar subquery (an array; NULL without a finite value)."""
    r = target_range(df, col)
    edges = equal_width_edges(F.col("lo"), F.col("hi"), n)[1:-1]
    return r.select(F.when(F.col("lo").isNotNull(), F.array(*edges) if edges else F.array().cast("array<double>")).alias("e")).scalar()


def count_label(x: Column, inner: Column, n: int) -> Column:
    """M2 for every value of the range: the number of inner edges at or below it, '0'..'n-1'; NULL for NULL and NaN.

    The same bins as ``bin_label`` gives values in the range; those outside get the label of the end bin on their side.
    Each edge is named once, so filters that Spark pushes below the label copy little.
    """
    below = sum(((x >= inner[k]).cast("int") for k in range(n - 1)), F.lit(0))
    return F.when(x.isNotNull() & ~F.isnan(x), below.cast("string"))


def equal_width_bins(df: DataFrame, col: str, n: int = 5, label_col: str | None = None,
                     null_label: str | None = None) -> DataFrame:
    """Add a string bin label of ``col`` over ``n`` equal-width bins of its range.

    Every finite value gets a label; infinities get that of the end bin on their side; NULL
    and NaN get ``null_label``.
    """
    label_col = label_col or f"{col}_stratified_label"
    label = count_label(F.col(col).cast("double"), inner_edges_subquery(df, col, n), n)
    return df.withColumn(label_col, label if null_label is None else F.coalesce(label, F.lit(null_label)))


def distinct_strata(df: DataFrame, label_col: str) -> DataFrame:
    """The distinct labels."""
    return df.select(label_col).distinct()
