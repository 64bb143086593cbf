"""Composition statistics over DataFrames, in wide and long form.

Wide form: one weight column per component (the reference's layout, e.g.
columns named by atomic number). Map-only: properties are folded into the
projection as literals, no shuffle, no Python.

Long form: rows ``(entity_id, component, weight)``. Duplicates are summed per
``(entity_id, component)`` with map-side partial aggregation, so an entity
holds at most |universe| rows afterwards however hot it is; properties are
joined by a size-checked broadcast; each entity's (bounded) components are
then gathered and reduced with array functions. Larger universes go to
``mixlens.operators.sparse_stats``, which gathers nothing.

Both forms use the same definitions (``mixlens.functions.composition``) and
give the same numbers; components absent from a long-form entity weigh 0.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.functions import composition as C
from mixlens.operators.joins import bounded_rows, has_at_most, lookup_join
from mixlens.operators.sparse_stats import composition_stats_sparse

# Largest property table that is folded into a plan: the wide form's (one column per
# component) and the gathering long form's. The element dimension has 118 rows.
MAX_COMPONENTS = 4096


def property_values(props: DataFrame, property_cols: Sequence[str], component_col: str = "component",
                    max_components: int = MAX_COMPONENTS) -> tuple[list[int], dict[str, dict[int, float]]]:
    """Read a (bounded) property table: ordered universe and per-property values."""
    rows = _property_rows(props, property_cols, component_col, max_components)
    universe = [r["c"] for r in rows]
    values = {p: {r["c"]: r[p] for r in rows} for p in property_cols}
    return universe, values


def _property_rows(props: DataFrame, property_cols: Sequence[str], component_col: str,
                   max_components: int = MAX_COMPONENTS):
    rows = bounded_rows(props.select(F.col(component_col).cast("int").alias("c"),
                                     *[F.col(p).cast("double").alias(p) for p in property_cols]),
                        max_components, "property table")
    rows = sorted(rows, key=lambda r: r["c"])
    comps = [r["c"] for r in rows]
    if len(set(comps)) != len(comps):
        raise ValueError("property table has duplicate components")
    return rows


def stat_columns(property_cols: Sequence[str], stats: Sequence[str] = C.STAT_NAMES) -> list[str]:
    """Names of the statistic columns, ``<property>_<stat>``, in output order
    (e.g. to declare a feature list by name: oxides + ``stat_columns(props)``)."""
    return [f"{p}_{s}" for p in property_cols for s in stats]


def _component_columns(component_cols) -> list[tuple[int, str]]:
    if isinstance(component_cols, Mapping):
        pairs = [(int(k), v) for k, v in component_cols.items()]
    else:
        pairs = [(int(c), c) for c in component_cols]
    return sorted(pairs)


def pack_components(component_cols) -> Column:
    """The weight columns as one array, in component order."""
    return F.array(*[F.col(c).cast("double") for _, c in _component_columns(component_cols)])


def present_components(component_cols) -> Column:
    """Ids of the components with weight strictly above 0, in component order."""
    pairs = _component_columns(component_cols)
    return F.filter(F.array(*[F.when(F.col(c).cast("double") > 0, F.lit(k)) for k, c in pairs]),
                    lambda k: k.isNotNull())


def _finish(df: DataFrame, out_cols: list[str], as_float: bool) -> DataFrame:
    if not as_float:
        return df
    return df.withColumns({c: F.col(c).cast("float") for c in out_cols})


def pack_stats(df: DataFrame, prop: str, struct_col: str | None = None) -> DataFrame:
    """Gather one property's six statistics into a struct column (the reference's
    result shape); ``select('*', f'{struct_col}.*')`` expands it again (P3)."""
    cols = [f"{prop}_{s}" for s in C.STAT_NAMES]
    return df.withColumn(struct_col or prop, F.struct(*cols)).drop(*cols)


def _exprs(cols: Mapping[str, str]) -> dict[str, Column]:
    return {k: F.expr(v) for k, v in cols.items()}


def composition_stats_wide(df: DataFrame, component_cols, props: DataFrame, property_cols: Sequence[str],
                           *, normalize: bool = False, as_float: bool = False,
                           names: Mapping[str, str] | None = None, null_weight: str = "zero") -> DataFrame:
    """A9/A10, wide form: add ``<prop>_<stat>`` columns to each row.

    ``component_cols`` maps component id -> weight column (or lists columns
    named by their component id). Properties absent from ``props`` are NULL.
    Map-only: the plan is Scan -> Project, inside one compiled stage.
    """
    _, values = property_values(props, property_cols)
    return wide_stats_from_values(df, component_cols, values, property_cols, normalize=normalize,
                                  as_float=as_float, names=names, null_weight=null_weight)


# Above this many component x property terms the unrolled projection can give a
# fused method too large for the JIT unless Spark is told to fall back.
_JIT_SAFE_TERMS = 64


def _check_codegen_limit(df: DataFrame, terms: int) -> None:
    if terms <= _JIT_SAFE_TERMS:
        return
    try:
        limit = int(df.sparkSession.conf.get("spark.sql.codegen.hugeMethodLimit", "65535"))
    except Exception:  # noqa: BLE001 - conf not readable (e.g. remote session)
        return
    if limit > 8000:
        warnings.warn("composition_stats_wide: set spark.sql.codegen.hugeMethodLimit=8000 (see "
                      "mixlens.session.SCALE_CONF) so that large unrolled projections fall back to "
                      "JIT-compiled methods instead of running interpreted", RuntimeWarning, stacklevel=3)


def wide_stats_from_values(df: DataFrame, component_cols, values: Mapping[str, Mapping[int, float]],
                           property_cols: Sequence[str], *, normalize: bool = False,
                           as_float: bool = False, names: Mapping[str, str] | None = None,
                           null_weight: str = "zero") -> DataFrame:
    """Wide form with the property values already in hand (``{prop: {component: value}}``)."""
    pairs = _component_columns(component_cols)
    names = dict(names or {})
    _check_codegen_limit(df, len(pairs) * len(property_cols))
    ws = [f"__w{i}" for i in range(len(pairs))]
    # Stage 1: cleaned weights, each computed once.
    stage = df.withColumns(_exprs({w: C.clean_weight(C.q(c), null_weight) for w, (_, c) in zip(ws, pairs)}))
    # Stage 2: positions of the top two weights, extreme positions, means.
    arr = C.wide_weight_array(ws)
    first = C.wide_positions(arr, len(ws))
    if normalize:
        # Its own projection: the means below refer to it.
        stage = stage.withColumn("__total", F.expr(C.balanced_sum(ws)))
    pvals = {}
    for i, p in enumerate(property_cols):
        pvals[p] = [values[p].get(k) for k, _ in pairs]
        mean = C.wide_mean(ws, pvals[p])
        first[f"__mean{i}"] = f"try_divide(({mean}) * 100.0D, __total)" if normalize else mean
    stage = stage.withColumns(_exprs(first))
    # Stage 3: the six statistics per property.
    out, out_cols = {}, []
    for i, p in enumerate(property_cols):
        prefix = names.get(p, p)
        std = C.wide_std(ws, pvals[p], f"__mean{i}")
        if normalize:
            std = f"try_divide(({std}) * 100.0D, __total)"
        lo, hi = C.wide_min_max(ws, pvals[p])
        stats = {"max": hi, "min": lo, "std": std, "mean": f"__mean{i}",
                 "mode1": C.wide_mode(pvals[p], "__pos1"), "mode2": C.wide_mode(pvals[p], "__pos2")}
        for s in C.STAT_NAMES:
            out[f"{prefix}_{s}"] = f"CAST({stats[s]} AS DOUBLE)"
            out_cols.append(f"{prefix}_{s}")
    stage = stage.withColumns(_exprs(out))
    return _finish(stage.drop(*ws, "__total", *first), out_cols, as_float)


def property_lookup(mix_long: DataFrame, props: DataFrame, property_cols: Sequence[str],
                    component_col: str = "component") -> DataFrame:
    """Attach component properties; every row stays, with NULL where the component is unknown.

    Any table size: a table of few rows is broadcast (a mix has few components, so a shuffle
    by component would deal its rows to few tasks), a larger one is joined as Spark plans it.
    """
    side = props.select(component_col, *[F.col(p).cast("double").alias(p) for p in property_cols])
    return lookup_join(mix_long, side, component_col, "left")


def _gathers(mix_long: DataFrame, props: DataFrame, component_col: str, universe: Sequence[int] | None) -> bool:
    """True if an entity holds at most ``2 * MAX_COMPONENTS`` components, proven by bounded checks."""
    if universe is not None:
        return len(universe) <= MAX_COMPONENTS
    known = props.select(F.col(component_col).cast("int").alias("c"))
    if not has_at_most(known, MAX_COMPONENTS):
        return False
    met = mix_long.select(F.col(component_col).cast("int").alias("c")).distinct()
    return has_at_most(met.join(F.broadcast(known), "c", "left_anti"), MAX_COMPONENTS)


def composition_stats_long(mix_long: DataFrame, props: DataFrame, property_cols: Sequence[str],
                           *, entity_col: str = "entity_id", component_col: str = "component",
                           weight_col: str = "weight_pct", normalize: bool = False,
                           as_float: bool = False, names: Mapping[str, str] | None = None,
                           components: Sequence[int] | None = None, null_weight: str = "zero") -> DataFrame:
    """A9/A10, long form: one output row per entity with ``<prop>_<stat>`` columns.

    Plan: partial + final aggregate on (entity, component) -- duplicates
    summed, hot entities collapsed map-side -- then a broadcast join to the
    size-checked property table, then an aggregate on entity that gathers at
    most |universe| items per entity, then array expressions.
    That is for universes of at most ``MAX_COMPONENTS``; where more components are possible (a larger
    property table, or more unknown components in the mix: one bounded check, which a given ``components``
    saves) ``composition_stats_sparse`` computes the same statistics without gathering.
    ``components`` is the universe, as the weight columns are in the wide form: rows
    of other components are left out (an entity of such rows only keeps its row, all
    absent). By default it is the components of ``props`` and those the entity has. A
    component of the universe without a property has NULL properties, as in the wide
    form. Entities given only with zero weights get the all-zero result; entities with no rows
    are absent.
    """
    names = dict(names or {})
    fields = [f"p{i}" for i in range(len(property_cols))]
    universe = None if components is None else sorted({int(c) for c in components})
    if not _gathers(mix_long, props, component_col, universe):
        return composition_stats_sparse(mix_long, props, property_cols, entity_col=entity_col, component_col=component_col, weight_col=weight_col,
                                        normalize=normalize, as_float=as_float, names=names, components=components, null_weight=null_weight)
    if universe is not None:
        props = props.where(F.col(component_col).cast("int").isin(universe))
    rows = _property_rows(props, property_cols, component_col)
    universe = [r["c"] for r in rows] if universe is None else universe
    values = {p: {r["c"]: r[p] for r in rows} for p in property_cols}
    small = mix_long.sparkSession.createDataFrame(
        [(c, True, *[values[p].get(c) for p in property_cols]) for c in universe],
        ", ".join(["c int", "k boolean"] + [f"`{f}` double" for f in fields]))
    pre = (mix_long
           .select(F.col(entity_col).alias(entity_col),
                   F.col(component_col).cast("int").alias("c"),
                   F.expr(C.clean_weight(C.q(weight_col), null_weight)).alias("w"))
           .groupBy(entity_col, "c").agg(F.sum("w").alias("w")))
    # ``small`` is a local relation of at most MAX_COMPONENTS rows (checked).
    joined = pre.join(F.broadcast(small), "c", "left")
    item = F.struct("c", "w", "k", *fields)
    if components is not None:
        item = F.when(F.col("k"), item)  # collect_list leaves NULLs out
    # After the pre-aggregation each entity has at most len(universe) rows.
    # Only the gather happens in this aggregate: collect_list makes Spark use
    # its object (interpreted) aggregate for every function in the step, so
    # min/max/mean run faster as array functions over the few gathered items
    # (measured: adding them as aggregates here was 15-30% slower).
    items = (joined.groupBy(entity_col)
             .agg(F.sort_array(F.collect_list(item)).alias("__items")))
    n = len(universe)
    stage = items.withColumns(_exprs(C.items_arrays("__items", n)))
    stage = stage.withColumn("__top", F.expr(C.items_top("__ws", "__n_absent")))
    stage = stage.withColumn("__second", F.expr(C.items_second("__ws", "__top", "__n_absent", n)))
    first = {"__top_c": C.items_first_with("__cs", "__ws", "__top", universe),
             "__second_c": C.items_first_with("__cs", "__ws", "__second", universe)}
    first["__sums"] = C.items_sums("__items", fields)
    stage = stage.withColumns(_exprs(first))
    scaled = "try_divide(({}) * 100.0D, __sums.total)" if normalize else "{}"
    stage = stage.withColumns(_exprs({f"__mean{i}": scaled.format(f"IF(__sums.bad_{f}, {C.NULL}, __sums.s_{f})") for i, f in enumerate(fields)}))
    stage = stage.withColumn("__spreads", F.expr(C.items_spreads("__items", {f: f"__mean{i}" for i, f in enumerate(fields)})))
    out, out_cols = {}, []
    for i, (p, f) in enumerate(zip(property_cols, fields)):
        prefix = names.get(p, p)
        vals = [values[p].get(c) for c in universe]
        stats = {"max": f"__sums.hi_{f}", "min": f"__sums.lo_{f}",
                 "std": scaled.format(f"IF(__mean{i} IS NULL, {C.NULL}, __spreads.s_{f})"),
                 "mean": f"__mean{i}", "mode1": C.lookup_in_universe("__top_c", universe, vals),
                 "mode2": C.lookup_in_universe("__second_c", universe, vals)}
        for s in C.STAT_NAMES:
            out[f"{prefix}_{s}"] = f"CAST({stats[s]} AS DOUBLE)"
            out_cols.append(f"{prefix}_{s}")
    stage = stage.withColumns(_exprs(out))
    private = ["__items", "__ws", "__cs", "__top", "__n_absent", "__second", "__spreads", *first,
               *[f"__mean{i}" for i in range(len(fields))]]
    return _finish(stage.drop(*private), out_cols, as_float)


def long_to_wide(mix_long: DataFrame, universe: Sequence[int], *, entity_col: str = "entity_id",
                 component_col: str = "component", weight_col: str = "weight_pct",
                 other_col: str | None = None, percent: bool = False) -> DataFrame:
    """Pivot a long mix into one weight column per component (named by its id).

    Weight on components outside ``universe`` has no column; ``other_col`` names one for their sum.
    With ``percent`` the weights are amounts and become percentages of the entity's whole amount,
    that of other components included (0 where the whole is 0).

    An aggregate on (entity, component), with map-side partial aggregation, leaves an entity at most one row
    per column; those few are gathered as a map, from which the columns are read. So only narrow rows are hashed
    and shuffled: Spark's own pivot keeps and shuffles a row of all columns for each (entity, component).
    """
    wanted = [int(c) for c in universe]
    names = [str(c) for c in wanted]
    plain = other_col is None and not percent
    outside = min(wanted, default=0) - 1
    component = F.col(component_col)
    type_ = mix_long.schema[component_col].dataType
    known = component.isin([F.lit(c).cast(type_) for c in wanted] if plain else wanted)
    code = F.when(known, component.cast("int")).otherwise(F.lit(outside))
    weight = F.col(weight_col) if plain else F.col(weight_col).cast("double")
    pairs = (mix_long.select(entity_col, code.alias("__code"), weight.alias("__weight"))
             .groupBy(entity_col, "__code").agg(F.sum("__weight").alias("__weight")))
    item = F.struct("__code", "__weight")
    if plain:
        item = F.when(F.col("__code") != outside, item)  # collect_list leaves NULLs out
    gathered = pairs.groupBy(entity_col).agg(F.map_from_entries(F.collect_list(item)).alias("__weights"))
    codes = dict(zip(names, wanted))
    if not plain:
        names.append(other_col or "__other")
        codes[names[-1]] = outside
    # All columns in one array: looked up in 51 expressions of their own they make a method too large for the JIT.
    number = pairs.schema["__weight"].dataType
    weigh = lambda c: F.try_element_at("__weights", c)
    if number.typeName() == "double":
        weigh = lambda c: F.nanvl(F.try_element_at("__weights", c), F.lit(None).cast("double"))
    dense = F.transform(F.array(*[F.lit(codes[c]) for c in names]), lambda c: F.coalesce(weigh(c), F.lit(0).cast(number)))
    dense = gathered.select(entity_col, dense.alias("__dense"))
    wide = dense.select(entity_col, *[F.col("__dense")[i].alias(c) for i, c in enumerate(names)])
    if percent:
        wide = wide.withColumn("__whole", F.expr(C.balanced_sum([C.q(c) for c in names])))
        shares = {c: f"coalesce(try_divide(100.0D * {C.q(c)}, __whole), 0.0D)" for c in names}
        wide = wide.withColumns(_exprs(shares)).drop("__whole")
    return wide if plain or other_col else wide.drop("__other")


def wide_to_long(df: DataFrame, component_cols, *, entity_col: str = "entity_id",
                 keep_zero: bool = False) -> DataFrame:
    """Unpivot weight columns into (entity_id, component, weight_pct) rows."""
    pairs = _component_columns(component_cols)
    stacked = df.select(entity_col, F.explode(F.array(*[
        F.struct(F.lit(k).alias("component"), F.col(c).cast("double").alias("weight_pct"))
        for k, c in pairs])).alias("__e"))
    out = stacked.select(entity_col, "__e.component", "__e.weight_pct")
    return out if keep_zero else out.where(F.col("weight_pct") > 0)


def atomic_property_stats(df: DataFrame, element_df: DataFrame, property_id: str, component_cols,
                          fill: bool = False, **kw) -> DataFrame:
    """A9 for one property: add ``<property>_{max,min,std,mean,mode1,mode2}``.

    ``element_df`` is keyed by ``component`` (e.g. the atomic number). With ``fill`` a gap takes the
    value of the component before it; gaps at the start stay NULL.
    """
    if fill:
        from mixlens.operators.properties import forward_fill
        element_df = forward_fill(element_df.select("component", property_id), [property_id], "component")
    return composition_stats_wide(df, component_cols, element_df, [property_id], **kw)


def electron_property_stats(df: DataFrame, element_df: DataFrame, shell: str, component_cols,
                            filled: bool = True, **kw) -> DataFrame:
    """A10 for one subshell: statistics of its filled (or unfilled) electron count.

    ``element_df`` either has the ``<shell>_filled``/``_unfilled`` columns or an
    ``electronic_configuration`` column to derive them from.
    """
    from mixlens.operators.properties import electron_shells
    col = f"{shell}_{'filled' if filled else 'unfilled'}"
    table = element_df if col in element_df.columns else electron_shells(element_df)
    return composition_stats_wide(df, component_cols, table, [col], **kw)
