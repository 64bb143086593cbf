"""Property preparation: forward fill (R1) and subshell electron counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlens.operators.joins import lookup_join, row_bytes
from mixlens.sinks import scratch_table

# Electron capacity of each subshell letter.
SUBSHELL_CAPACITY = {"s": 2, "p": 6, "d": 10, "f": 14}


def subshell_count(config: Column, letter: str) -> Column:
    """Electrons in the first ``<letter><digits>`` group of a configuration string.

    Letter absent -> 0; letter present without digits (``[Kr] 5s``) -> 1.
    Only core-abbreviated strings carry one group per letter, which is what
    the element dimension holds.
    """
    digits = F.regexp_extract(config, f"{letter}(\\d+)", 1)
    return (F.when(config.isNull(), F.lit(None).cast("int"))
            .when(~config.contains(letter), F.lit(0))
            .when(digits == "", F.lit(1))
            .otherwise(F.nullif(digits, F.lit("")).cast("int")))


def electron_shells(df: DataFrame, config_col: str = "electronic_configuration") -> DataFrame:
    """Add ``{s,p,d,f}_filled`` and ``{s,p,d,f}_unfilled`` (capacity - filled)."""
    cfg = F.col(config_col)
    filled = {f"{l}_filled": subshell_count(cfg, l) for l in SUBSHELL_CAPACITY}
    out = df.withColumns(filled)
    return out.withColumns({f"{l}_unfilled": F.lit(cap) - F.col(f"{l}_filled")
                            for l, cap in SUBSHELL_CAPACITY.items()})


ELECTRON_PROPERTIES = [f"{l}_{k}" for k in ("filled", "unfilled") for l in SUBSHELL_CAPACITY]


def forward_fill(df: DataFrame, cols: Sequence[str], order_by: str | Sequence[str],
                 partition_by: Sequence[str] = (), n_ranges: int | None = None) -> DataFrame:
    """Replace NULLs by the last non-NULL value before them in ``order_by`` order.

    Leading NULLs stay NULL; NULL keys come first. Rows with equal keys are ordered by a
    hash of the key and the filled columns, so the result is the same in every run. With
    ``partition_by`` (e.g. a property name in a long property table) each partition fills on its own:
    one window each, so they should be bounded, or give ``n_ranges``. Then, as without ``partition_by``, the whole
    table is filled over ranges in parallel, whatever its size and that of its partitions.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    if not partition_by or n_ranges:
        return forward_fill_by_ranges(df, cols, order, n_ranges, partition_by)
    w = Window.partitionBy(*partition_by).orderBy(*order, _tie(order, cols)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})


def _tie(order: Sequence[str], cols: Sequence[str]) -> Column:
    return F.xxhash64(*order, *cols)


#: Size of a range, and ranges that one task carries values over.
RANGE_BYTES = 128 << 20
FAN = 1000


def forward_fill_by_ranges(df: DataFrame, cols: Sequence[str], order_by: str | Sequence[str], n_ranges: int | None = None,
                           partition_by: Sequence[str] = (), fan: int = FAN) -> DataFrame:
    """Forward fill over the whole table, in parallel, for orderable keys of any type.

    The table is dealt out by ranges of its keys (``n_ranges``; by default one for every ``RANGE_BYTES``, at least as many
    as the session has shuffle partitions) and stored with the number of each row's range. Each range is filled by its own
    window task. Its last non-NULL value (one small aggregate) is carried into the ranges after it, level by level: over
    ``fan`` ranges by a window, over the groups of ``fan`` ranges by the next level, so the number of ranges has no bound.
    Rows with equal keys and values do not depend on one another's order; they are split like any others.
    """
    order, group = [order_by] if isinstance(order_by, str) else list(order_by), list(partition_by)
    if not n_ranges:
        size = df.agg(F.sum(row_bytes(df))).first()[0] or 0
        n_ranges = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    keyed = df.withColumns({"__tie": _tie(order, cols), "__row": F.monotonically_increasing_id()})
    ranged = keyed.repartitionByRange(n_ranges, *group, *order, "__tie", "__row").withColumn("__r", F.spark_partition_id().cast("long"))
    ranged = scratch_table(ranged.drop("__row"), "ffill-ranges").withColumn("__of", F.struct("__r", *group))
    inside = Window.partitionBy("__r", *group).orderBy(*order, "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = ranged.withColumns({c: F.last(F.col(c), ignorenulls=True).over(inside) for c in cols})
    # Last non-NULL value of each range: max over (key, value) structs, NULL values skipped.
    key = F.struct(*order, "__tie")
    lasts = ranged.groupBy("__r", *group).agg(*[
        F.max(F.when(F.col(c).isNotNull(), F.struct(key.alias("k"), F.col(c).alias("v"))))["v"].alias(f"__last{i}")
        for i, c in enumerate(cols)])
    carried = _carried(scratch_table(lasts, "ffill-lasts"), group, len(cols), n_ranges, fan)
    carried = carried.select(F.struct("__r", *group).alias("__of"), *[f"__carry{i}" for i in range(len(cols))])
    out = lookup_join(filled, carried, "__of", "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__carry{i}")) for i, c in enumerate(cols)})
    return out.select(*df.columns)


def _carried(lasts: DataFrame, group: list[str], n_cols: int, n: int, fan: int) -> DataFrame:
    """(__r, group, __carry0, ...): the last value before each of the ``n`` ranges."""
    names = [(f"__last{i}", f"__carry{i}") for i in range(n_cols)]

    def before(*keys: str) -> list[Column]:
        w = Window.partitionBy(*group, *keys).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
        return [F.last(last, ignorenulls=True).over(w).alias(carry) for last, carry in names]

    if n <= fan:
        return lasts.select("__r", *group, *before())
    of = lasts.withColumn("__s", F.floor(F.col("__r") / fan).cast("long"))
    tops = of.groupBy(F.col("__s").alias("__r"), *group).agg(*[
        F.max(F.when(F.col(last).isNotNull(), F.struct(F.col("__r"), F.col(last).alias("v"))))["v"].alias(last) for last, _ in names])
    above = _carried(tops, group, n_cols, -(-n // fan), fan)
    above = above.select(F.struct(F.col("__r"), *group).alias("__up"), *[F.col(c).alias(f"{c}_up") for _, c in names])
    near = of.select("__r", *group, F.struct(F.col("__s").alias("__r"), *group).alias("__up"), *before("__s"))
    return near.join(above, "__up", "left").select("__r", *group, *[F.coalesce(c, f"{c}_up").alias(c) for _, c in names])
