"""Composition statistics over any number of components, by mergeable states.

``composition_stats_long`` gathers the components of an entity, which is fast while a universe bounds them. Here nothing is
gathered: components, and the components of one entity, may be many millions. Per entity

* sums, extremes and counts are partial aggregates;
* the state for the modes is the top two (weight, component) with ties: tasks keep two rows an entity before the shuffle
  (Spark's group limit under ``row_number``), so a hot entity costs two rows a task;
* absent components weigh 0, so they matter only to entities with fewer than two positive weights, and then only the
  first two that are absent: those are found among the first few of the universe;
* the spread is a second pass, once the mean is known. Rows of hot entities meet a broadcast of their means (fewer than
  a thousand entities can be hot), the others are joined by entity and summed with partial aggregates.

Properties are joined, not folded into the plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlens.functions import composition as C
from mixlens.operators.joins import lookup_join
from mixlens.sinks import scratch_table


def universe_table(props: DataFrame, property_cols: Sequence[str], component_col: str, components: Sequence[int] | DataFrame | None) -> DataFrame:
    """(c, k, p0, p1, ...): the components and their properties; a component with two rows stops the job."""
    c = F.col(component_col).cast("long")
    fields = [F.col(p).cast("double").alias(f"p{i}") for i, p in enumerate(property_cols)]
    table = props.select(c.alias("c"), *fields)
    if components is not None:
        if not isinstance(components, DataFrame):
            components = props.sparkSession.createDataFrame([(int(x),) for x in components], "c long")
        wanted = components.select(F.col(components.columns[0]).cast("long").alias("c")).distinct()
        table = wanted.join(table, "c", "left")
    double = F.raise_error(F.concat(F.lit("property table has duplicate components: "), F.col("c").cast("string"))).cast("boolean")
    names = [f"p{i}" for i in range(len(property_cols))]
    return table.groupBy("c").agg(F.count("*").alias("n"), *[F.max(f).alias(f) for f in names]) \
        .select("c", F.when(F.col("n") == 1, F.lit(True)).otherwise(double).alias("k"), *names)


def _first_absent(rows: DataFrame, few: DataFrame, universe: DataFrame, fields: list[str]) -> DataFrame:
    """(e, c, w = 0, fields): the first two components of the universe that each entity of ``few`` does not hold.

    An entity that holds ``m`` components with a weight lacks at least two of the first ``m + 2``, so only that many are
    looked at, for the largest ``m`` (1, unless weights are negative).
    """
    held = lookup_join(rows.where("k and w <> 0"), few, "e")
    most = held.groupBy("e").count().agg(F.max("count")).first()[0] or 0
    first = universe.orderBy("c").limit(most + 2)
    first = scratch_table(first.withColumn("r", F.row_number().over(Window.orderBy("c")) - 1), "sparse-first")
    side = F.broadcast(first) if most < 100_000 else first
    placed = held.select("e", "c").join(side.select("c", "r"), "c")
    i = F.row_number().over(Window.partitionBy("e").orderBy("r")) - 1
    # Held ranks in order: the first gap is where a rank runs ahead of its place, the second where it does so by two.
    gaps = placed.withColumn("i", i).groupBy("e").agg(
        F.coalesce(F.min(F.when(F.col("r") > F.col("i"), F.col("i"))), F.count("*")).alias("a1"),
        F.coalesce(F.min(F.when(F.col("r") > F.col("i") + 1, F.col("i") + 1)), F.count("*") + 1).alias("a2"))
    absent = few.join(gaps, "e", "left").select("e", F.explode(F.array(F.coalesce("a1", F.lit(0)), F.coalesce("a2", F.lit(1)))).alias("r"))
    return absent.join(side, "r").select("e", "c", F.lit(0.0).alias("w"), *fields)


def composition_stats_sparse(mix_long: DataFrame, props: DataFrame, property_cols: Sequence[str], *, entity_col: str = "entity_id",
                             component_col: str = "component", weight_col: str = "weight_pct", normalize: bool = False,
                             as_float: bool = False, names: Mapping[str, str] | None = None,
                             components: Sequence[int] | DataFrame | None = None, null_weight: str = "zero") -> DataFrame:
    """A9/A10 for any number of components: one row per entity with ``<prop>_<stat>`` columns.

    The same results as ``composition_stats_long`` (weights of an entity's component are summed; ``components`` is the
    universe, a list or a table; by default that of ``props``, and unknown components stay, with NULL properties).
    """
    names, fields = dict(names or {}), [f"p{i}" for i in range(len(property_cols))]
    universe = scratch_table(universe_table(props, property_cols, component_col, components), "sparse-universe")
    e = F.struct(F.col(entity_col).alias("v")).alias("e")  # never NULL, so a NULL entity joins as others do
    summed = mix_long.select(e, F.col(component_col).cast("long").alias("c"), F.expr(C.clean_weight(C.q(weight_col), null_weight)).alias("w")) \
        .groupBy("e", "c").agg(F.sum("w").alias("w"))
    summed = scratch_table(summed, "sparse-summed")
    known = F.coalesce("k", F.lit(False))
    rows = scratch_table(lookup_join(summed, universe, "c", "left").withColumn("k", known), "sparse-rows")
    counts = F.col("k") if components is not None else F.lit(True)

    def over(value: Column, keep: Column) -> Column:
        return F.when(counts & keep, value)

    w, some = F.col("w"), F.col("w") != 0
    sums = [F.coalesce(F.sum(over(w, some)), F.lit(0.0)).alias("total"), F.count(over(w, w > 0)).alias("positive")]
    for f in fields:
        sums += [F.coalesce(F.sum(over(w / 100.0 * F.col(f), some)), F.lit(0.0)).alias(f"s_{f}"), F.min(over(F.col(f), w > 0)).alias(f"lo_{f}"),
                 F.max(over(F.col(f), w > 0)).alias(f"hi_{f}"), F.count(over(w, some & F.col(f).isNull())).alias(f"bad_{f}")]
    state = rows.groupBy("e").agg(*sums)
    scaled = (lambda x: F.try_divide(x * 100.0, F.col("total"))) if normalize else (lambda x: x)
    state = state.withColumns({f"mean_{f}": scaled(F.when(F.col(f"bad_{f}") == 0, F.col(f"s_{f}"))) for f in fields})
    state = scratch_table(state.drop(*[f"{x}_{f}" for f in fields for x in ("s", "bad")]), "sparse-state")

    # Top two with ties: known components of weight 0 are as good as absent.
    order = Window.partitionBy("e").orderBy(F.col("w").desc(), F.col("c").asc_nulls_last())
    best = rows.where(counts & ~(F.col("k") & ~some)).select("e", "c", "w", *fields)
    best = best.withColumn("n", F.row_number().over(order)).where("n <= 2").drop("n")
    few = state.where("positive < 2").select("e")
    best = best.unionByName(_first_absent(rows, few, universe, fields))
    best = best.withColumn("n", F.row_number().over(order)).where("n <= 2")
    picked = [F.max(F.when(F.col("n") == n, F.col(c))).alias(f"{c}_{n}") for c in ("w", *fields) for n in (1, 2)]
    modes = best.groupBy("e").agg(*picked)

    means = state.select("e", *[f"mean_{f}" for f in fields])
    far = lookup_join(rows.where(counts & some), means, "e")
    spread = far.groupBy("e").agg(*[F.sum(w / 100.0 * F.abs(F.col(f) - F.col(f"mean_{f}"))).alias(f"d_{f}") for f in fields])

    out = state.join(modes, "e", "left").join(spread, "e", "left")
    cols = [F.col("e.v").alias(entity_col)]
    for p, f in zip(property_cols, fields):
        tie = F.when(F.col("w_1") == F.col("w_2"), F.col(f"{f}_1")).otherwise(F.col(f"{f}_2"))
        stats = {"max": F.col(f"hi_{f}"), "min": F.col(f"lo_{f}"), "mean": F.col(f"mean_{f}"), "mode1": F.col(f"{f}_1"), "mode2": tie,
                 "std": F.when(F.col(f"mean_{f}").isNotNull(), scaled(F.coalesce(f"d_{f}", F.lit(0.0))))}
        cols += [stats[s].cast("float" if as_float else "double").alias(f"{names.get(p, p)}_{s}") for s in C.STAT_NAMES]
    return out.select(*cols)
