"""Inputs derived from the driver tables (the glass data of the reference is absent).

* ``mix_long``: one composition per order: component = ``p_size`` of the
  ordered part (1..50, standing for an atomic number), weight = percent of the
  order's quantity on that component.
* ``mix_long(by="customer")``: the same per customer (denser mixes), over components 1..56.
* ``property_table``: components 1..50 with the electron-shell counts of the
  element of that atomic number and ``min_price``, the lowest retail price of
  parts of that size (a property that Spark derives from ``part``).

``mix_amounts`` gives the lines themselves: lineitem |><| part on the part key (Spark/AQE choose
broadcast or sort-merge by measured size; skewed keys are split by AQE). The statistics sum them per
(entity, component) with map-side partial aggregation, gather each entity's few rows once, and take
percentages of the gathered total: two shuffles above the join, no window, no sort. The same lines serve
the pivot to wide. ``mix_long`` gives rows of percentages, by the same gather.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlens.operators.properties import electron_shells
from mixlens.sources.elements import element_table
from mixlens.sources.files import read_table

# Fixed value: the component universe, p_size 1..50 read as atomic numbers.
UNIVERSE = list(range(1, 51))
WEIGHT_COLS = [str(c) for c in UNIVERSE]


def mix_amounts(spark: SparkSession, sf_dir: str, by: str = "order") -> DataFrame:
    """(entity_id, component, qty), one row per line."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    component = F.col("p_size")
    lines = li.join(pt, li.l_partkey == pt.p_partkey)
    if by == "order":
        entity = F.col("l_orderkey")
    elif by == "customer":
        orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        entity = F.col("o_custkey")
        # Reaches all elements of the ratio (Cs 55, Ba 56): sizes 1..50, every other part 6 higher.
        component = (F.col("p_size") + F.lit(6) * (F.col("p_partkey") % 2)).cast("int")
    else:
        raise ValueError(by)
    return lines.select(entity.alias("entity_id"), component.alias("component"), F.col("l_quantity").alias("qty"))


def mix_long(spark: SparkSession, sf_dir: str, by: str = "order") -> DataFrame:
    """(entity_id, component, weight_pct): an entity has at most one row per component."""
    per_component = mix_amounts(spark, sf_dir, by).groupBy("entity_id", "component").agg(F.sum("qty").alias("qty"))
    gathered = per_component.groupBy("entity_id").agg(F.collect_list(F.struct("component", "qty")).alias("items"))
    total = F.aggregate("items", F.lit(0.0), lambda acc, x: acc + F.coalesce(x["qty"].cast("double"), F.lit(0.0)))
    rows = gathered.withColumn("total", total).select("entity_id", "total", F.inline("items"))
    return rows.select("entity_id", "component", F.try_divide(F.lit(100.0) * F.col("qty"), F.col("total")).alias("weight_pct"))


def part_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """min_price per component (p_size); NULL where no part has that size."""
    part = read_table(spark, sf_dir, "part")
    return part.groupBy(F.col("p_size").alias("component")).agg(F.min("p_retailprice").alias("min_price"))


def property_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    elements = element_table(spark).where(F.col("component").isin(UNIVERSE))
    shells = electron_shells(elements)
    return shells.join(part_property(spark, sf_dir), "component", "left")
