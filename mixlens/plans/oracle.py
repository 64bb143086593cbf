"""DuckDB SQL for the correctness gate: brute-force forms of each query.

The composition oracle materialises the *dense* matrix (each entity expanded
over every component of the universe, absent ones at weight 0) and ranks it,
which is the reference's array definition written out literally. It is meant
for the small correctness scale only; the Spark plans never build it.
"""

from __future__ import annotations

from mixlens.operators.properties import SUBSHELL_CAPACITY
from mixlens.plans.inputs import UNIVERSE
from mixlens.sources.elements import element_rows

# Rounding used on both sides for doubles produced by sums (addition order
# differs between engines; the offset keeps values off exact half-way points).
ROUND_DIGITS = 6
# Elements 1..56, which hold all of the NBO/T formula, and a part of the universe.
RATIO_UNIVERSE = list(range(1, 57))
SUBSET = list(range(1, 31))


def rnd(expr: str) -> str:
    return f"round(({expr}) + 1e-9, {ROUND_DIGITS})"


def mix_long_cte(by: str = "order") -> str:
    if by == "order":
        src = ("SELECT l.l_orderkey AS entity_id, p.p_size AS component, sum(l.l_quantity) AS qty "
               "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2")
    else:
        src = ("SELECT o.o_custkey AS entity_id, p.p_size + 6 * (p.p_partkey % 2) AS component, sum(l.l_quantity) AS qty "
               "FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey "
               "JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2")
    return (f"mix_q AS ({src}),\n"
            "mix_long AS (SELECT entity_id, component, "
            "CAST(100 AS DOUBLE) * qty / sum(qty) OVER (PARTITION BY entity_id) AS weight_pct FROM mix_q),\n"
            "mix_raw AS (SELECT entity_id, component, qty AS weight_pct FROM mix_q),\n"
            "mix_null AS (SELECT entity_id, component, CASE WHEN component % 7 > 0 THEN weight_pct END AS weight_pct FROM mix_long)")


def shell_sql(cfg: str, letter: str) -> str:
    digits = f"regexp_extract({cfg}, '{letter}(\\d+)', 1)"
    return (f"CASE WHEN {cfg} IS NULL THEN NULL WHEN NOT contains({cfg}, '{letter}') THEN 0 "
            f"WHEN {digits} = '' THEN 1 ELSE CAST({digits} AS INTEGER) END")


def elements_cte(max_component: int = max(UNIVERSE)) -> str:
    vals = ", ".join(f"({z}, '{c}')" for z, c in element_rows(max_component))
    return f"elements(component, electronic_configuration) AS (VALUES {vals})"


def shells_select(cfg: str = "electronic_configuration") -> str:
    filled = [f"{shell_sql(cfg, l)} AS {l}_filled" for l in SUBSHELL_CAPACITY]
    unfilled = [f"{cap} - ({shell_sql(cfg, l)}) AS {l}_unfilled" for l, cap in SUBSHELL_CAPACITY.items()]
    return ", ".join(filled + unfilled)


def props_cte(max_component: int = max(UNIVERSE)) -> str:
    return (elements_cte(max_component) + ",\n"
            "part_prop AS (SELECT p_size AS component, min(p_retailprice) AS min_price "
            "FROM part GROUP BY p_size),\n"
            f"props AS (SELECT e.component, e.electronic_configuration, {shells_select('e.electronic_configuration')}, "
            "pp.min_price, last_value(CASE WHEN e.component % 7 > 0 THEN pp.min_price END IGNORE NULLS) OVER "
            "(ORDER BY e.component ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_filled FROM elements e LEFT JOIN part_prop pp ON pp.component = e.component)")


def stats_sql(prop_cols: list[str], stats: tuple[str, ...] = ("max", "min", "std", "mean", "mode1", "mode2"),
              mix: str = "mix_long", by: str = "order", normalize: bool = False,
              universe: list[int] = UNIVERSE, known: str = "true") -> str:
    """Composition statistics for ``prop_cols`` by brute force over the dense matrix of ``universe``;
    ``known`` tells which components have properties."""
    lo, hi = min(universe), max(universe)
    ctes = [mix_long_cte(by), props_cte(),
            f"ents AS (SELECT DISTINCT entity_id FROM {mix})",
            f"mw AS (SELECT entity_id, component, sum(coalesce(weight_pct, 0)) AS w FROM {mix} GROUP BY 1, 2)",
            f"grid AS (SELECT entity_id, CAST(unnest(range({lo}, {hi + 1})) AS INTEGER) AS component FROM ents)",
            "dense AS (SELECT g.entity_id, g.component, coalesce(mw.w, 0.0) AS w FROM grid g "
            "LEFT JOIN mw ON mw.entity_id = g.entity_id AND mw.component = g.component)",
            "d AS (SELECT dense.*, " + ", ".join(f"CAST(pr.{p} AS DOUBLE) AS {p}" for p in prop_cols)
            + f" FROM dense LEFT JOIN props pr ON pr.component = dense.component AND ({known.format(c='pr.component')}))",
            "ranked AS (SELECT d.*, row_number() OVER (PARTITION BY entity_id ORDER BY w DESC, component) AS rk FROM d)",
            "tops AS (SELECT entity_id, max(w) FILTER (WHERE rk = 1) AS w1, max(w) FILTER (WHERE rk = 2) AS w2, "
            "max(component) FILTER (WHERE rk = 1) AS c1, max(component) FILTER (WHERE rk = 2) AS c2, "
            "sum(w) AS total FROM ranked GROUP BY entity_id)"]
    scale = "* 100 / t.total" if normalize else ""
    mean_parts = []
    for p in prop_cols:
        mean_parts.append(
            f"CASE WHEN count(*) FILTER (WHERE d.w <> 0 AND d.{p} IS NULL) > 0 THEN NULL "
            f"ELSE sum(CASE WHEN d.w <> 0 THEN d.w / 100 * d.{p} ELSE 0 END) END {scale} AS mean_{p}")
    ctes.append("means AS (SELECT d.entity_id, " + ", ".join(mean_parts)
                + " FROM d JOIN tops t ON t.entity_id = d.entity_id GROUP BY d.entity_id, t.total)")
    cols = []
    for p in prop_cols:
        exprs = {
            "max": f"max(d.{p}) FILTER (WHERE d.w > 0)",
            "min": f"min(d.{p}) FILTER (WHERE d.w > 0)",
            "std": (f"CASE WHEN count(*) FILTER (WHERE d.w <> 0 AND d.{p} IS NULL) > 0 THEN NULL "
                    f"ELSE sum(CASE WHEN d.w <> 0 THEN d.w / 100 * abs(d.{p} - m.mean_{p}) ELSE 0 END) END {scale}"),
            "mean": f"any_value(m.mean_{p})",
            "mode1": f"max(d.{p}) FILTER (WHERE d.component = t.c1)",
            "mode2": (f"max(d.{p}) FILTER (WHERE d.component = "
                      f"CASE WHEN t.w2 = t.w1 THEN t.c1 ELSE t.c2 END)"),
        }
        for s in stats:
            cols.append(f"{rnd(exprs[s])} AS {p}_{s}")
    body = ("SELECT d.entity_id, " + ", ".join(cols)
            + " FROM d JOIN tops t ON t.entity_id = d.entity_id JOIN means m ON m.entity_id = d.entity_id "
            "GROUP BY d.entity_id, t.total")
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rnd4(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 4)"


def _binned_cte() -> str:
    return f"binned AS (SELECT o_orderkey, x AS o_totalprice, stratum FROM ({_bins('o_totalprice')}))"


def _bins(x: str, none: str = "NULL", src: str = "orders") -> str:
    """o_orderkey, x, stratum: the label is the number of inner edges at or below the value."""
    below = " + ".join(f"CAST(v >= lo + (hi - lo) * CAST({k} AS DOUBLE) / CAST(5 AS DOUBLE) AS INTEGER)" for k in range(1, 5))
    return (f"SELECT o_orderkey, x, CASE WHEN x IS NULL OR isnan(x) THEN {none} WHEN lo = hi THEN '4' "
            f"ELSE CAST({below} AS VARCHAR) END AS stratum "
            f"FROM (SELECT *, least(greatest(x, lo), hi) AS v FROM (SELECT o_orderkey, {x} AS x FROM {src}), "
            f"(SELECT min(x) AS lo, max(x) AS hi FROM (SELECT {x} AS x FROM {src}) WHERE isfinite(x)))")


HASH_TRAIN = "substr(md5(CAST({key} AS VARCHAR)), 1, 8) < 'cccccccc'"


def _sample_where() -> str:
    return HASH_TRAIN.format(key="o_orderkey") + " AND stratum IN ('0', '1', '2', '3', '4')"


def _word_count(src: str) -> str:
    return ("SELECT word, count(*) AS count FROM (SELECT unnest(regexp_split_to_array(text, '[ \\n]')) "
            f"AS word FROM {src}) GROUP BY word")


def _wide_weight_cols(comps) -> str:
    return ", ".join(f"sum(weight_pct) FILTER (WHERE component = {c}) AS w{c}" for c in comps)


def oracle_queries() -> dict[str, str]:
    from mixlens.operators.properties import ELECTRON_PROPERTIES
    from mixlens.functions.ratios import NBO_T_DENOMINATOR, NBO_T_NUMERATOR

    props = ["s_filled", "min_price"]
    q: dict[str, str] = {}
    full = stats_sql(props)
    for name in ("composition_stats_long", "composition_stats_wide", "feature_pipeline",
                 "parquet_roundtrip", "streaming_composition_stats", "etl_job"):
        q[name] = full
    q["composition_min_max"] = stats_sql(props, ("min", "max"))
    q["composition_mean_mad"] = stats_sql(props, ("mean", "std"))
    q["composition_modes"] = stats_sql(props, ("mode1", "mode2"))
    q["electron_stats"] = stats_sql(list(ELECTRON_PROPERTIES))

    s_stats = stats_sql(["s_filled"])
    weights = ", ".join(f"{rnd(f'coalesce(w.w{c}, 0)')} AS \"{c}\"" for c in range(1, 6))
    q["feature_select"] = (
        f"WITH st AS ({s_stats}),\n" + mix_long_cte() + ",\n"
        f"w AS (SELECT entity_id, {_wide_weight_cols(range(1, 6))} FROM mix_long GROUP BY entity_id)\n"
        f"SELECT st.*, {weights} FROM st JOIN w ON w.entity_id = st.entity_id")

    q["property_lookup"] = (
        "WITH " + mix_long_cte() + ",\n" + props_cte() + "\n"
        f"SELECT m.entity_id, m.component, {rnd('m.weight_pct')} AS weight_pct, "
        "CAST(pr.s_filled AS DOUBLE) AS s_filled, CAST(pr.min_price AS DOUBLE) AS min_price "
        "FROM mix_long m LEFT JOIN props pr ON pr.component = m.component")

    lo, hi = min(UNIVERSE), max(UNIVERSE)
    q["present_components"] = (
        "WITH " + mix_long_cte() + ",\n"
        "mw AS (SELECT entity_id, component, sum(weight_pct) AS w FROM mix_long GROUP BY 1, 2)\n"
        "SELECT entity_id, CAST(count(*) FILTER (WHERE w > 0) AS INTEGER) AS n_present, "
        "coalesce(string_agg(CAST(component AS VARCHAR), ',' ORDER BY component) FILTER (WHERE w > 0), '') "
        "AS present FROM mw GROUP BY entity_id")

    q["composition_pack"] = (
        "WITH " + mix_long_cte() + ",\n"
        "ents AS (SELECT DISTINCT entity_id FROM mix_long),\n"
        "mw AS (SELECT entity_id, component, sum(weight_pct) AS w FROM mix_long GROUP BY 1, 2),\n"
        f"grid AS (SELECT entity_id, CAST(unnest(range({lo}, {hi + 1})) AS INTEGER) AS component FROM ents),\n"
        "dense AS (SELECT g.entity_id, g.component, coalesce(mw.w, 0.0) AS w FROM grid g "
        "LEFT JOIN mw ON mw.entity_id = g.entity_id AND mw.component = g.component)\n"
        f"SELECT entity_id, CAST({len(UNIVERSE)} AS INTEGER) AS n_components, "
        "string_agg(CAST(CAST(round(w * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY component) AS packed_ppm "
        "FROM dense GROUP BY entity_id")

    def lin(coefs):
        return " + ".join(f"coalesce(sum(weight_pct) FILTER (WHERE component = {z}), 0) * {float(k)}"
                          for z, k in coefs.items())
    q["linear_ratio"] = (
        "WITH " + mix_long_cte("customer") + ",\n"
        f"r AS (SELECT entity_id, {lin(NBO_T_NUMERATOR)} AS num, {lin(NBO_T_DENOMINATOR)} AS den "
        "FROM mix_long GROUP BY entity_id)\n"
        f"SELECT entity_id, {rnd('CASE WHEN den = 0 OR num IS NULL OR den IS NULL THEN NULL ELSE greatest(num / den, 0.0) END')} "
        "AS nbo_t FROM r")

    shells = ", ".join(ELECTRON_PROPERTIES)
    q["property_table"] = ("WITH " + props_cte(118) + "\n"
                           f"SELECT component, electronic_configuration, {shells}, min_price FROM props")
    q["electron_shells"] = (
        "WITH " + elements_cte(118) + "\n"
        f"SELECT p.p_partkey, {shells_select('e.electronic_configuration')} "
        "FROM part p JOIN elements e ON e.component = p.p_size")
    q["property_ffill"] = (
        "WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 7 > 3 THEN p_retailprice END AS price_raw FROM part)\n"
        "SELECT p_partkey, price_raw, last_value(price_raw IGNORE NULLS) OVER "
        "(ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_filled FROM t")

    q["property_ffill_brands"] = (
        "SELECT p_brand, p_partkey, last_value(CASE WHEN p_partkey % 7 > 3 THEN p_retailprice END IGNORE NULLS) OVER "
        "(PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_filled FROM part")
    q["target_range"] = ("SELECT min(o_totalprice) FILTER (WHERE NOT isnan(o_totalprice)) AS lo, "
                         "max(o_totalprice) FILTER (WHERE NOT isnan(o_totalprice)) AS hi FROM orders")
    binned = "WITH " + _binned_cte() + "\n"
    q["equal_width_bins"] = binned + "SELECT o_orderkey, o_totalprice, stratum FROM binned"
    q["distinct_strata"] = binned + "SELECT DISTINCT stratum FROM binned"
    q["stratified_fractions"] = binned + "SELECT DISTINCT stratum, CAST(0.8 AS DOUBLE) AS fraction FROM binned"
    q["sample_by_hash"] = binned + f"SELECT o_orderkey, stratum FROM binned WHERE {_sample_where()}"
    ranked = ("row_number() OVER (PARTITION BY stratum ORDER BY md5(CAST(o_orderkey AS VARCHAR))) AS rk, "
              "count(*) OVER (PARTITION BY stratum) AS n")
    q["sample_exact"] = (binned + f"SELECT o_orderkey, stratum FROM (SELECT *, {ranked} FROM binned WHERE stratum IS NOT NULL) "
                         "WHERE rk <= round(CAST(0.8 AS DOUBLE) * n)")
    rates = ("WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 > 0 THEN CAST(o_custkey AS VARCHAR) END AS stratum FROM orders),\n"
             "rates AS (SELECT CAST(c_custkey AS VARCHAR) AS s, (c_custkey % 8) / CAST(8 AS DOUBLE) AS rate FROM customer WHERE c_custkey % 11 > 0 "
             "UNION ALL SELECT NULL, CAST(0.3125 AS DOUBLE)),\n"
             f"r AS (SELECT t.*, rate, {ranked} FROM t JOIN rates ON s IS NOT DISTINCT FROM stratum)\n")
    q["sample_by_hash_rates"] = rates + ("SELECT o_orderkey, stratum FROM r WHERE rate > 0 AND substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) "
                                         "< printf('%08x', CAST(floor(rate * 4294967296) AS BIGINT))")
    q["sample_exact_rates"] = rates + "SELECT o_orderkey, stratum FROM r WHERE rk <= round(rate * n)"
    q["except_distinct"] = (binned + "SELECT o_orderkey, stratum FROM binned EXCEPT "
                            f"SELECT o_orderkey, stratum FROM binned WHERE {_sample_where()}")
    derived = " || ',' || ".join(f"coalesce(CAST(CASE WHEN o_custkey % {k + 2} > 0 THEN o_orderkey % {k + 3} END AS VARCHAR), '-')" for k in range(115))
    q["except_distinct_wide"] = (
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, md5({derived}) AS derived FROM orders WHERE NOT ("
        + HASH_TRAIN.format(key="o_orderkey") + ")")
    q["train_test_split"] = (binned + "SELECT o_orderkey, stratum, CASE WHEN "
                             + HASH_TRAIN.format(key="o_orderkey")
                             + " THEN 'train' ELSE 'test' END AS split FROM binned")
    q["split_roundtrip"] = (binned + "SELECT o_orderkey, o_totalprice, stratum, CASE WHEN "
                            + HASH_TRAIN.format(key="o_orderkey") + " THEN 'train' ELSE 'test' END AS split FROM binned")
    key = "coalesce(CAST(CASE WHEN o_custkey % 3 > 0 THEN o_orderkey END AS VARCHAR), '<null>')"
    q["train_test_split_null_keys"] = (
        f"SELECT o_orderkey, CASE WHEN {HASH_TRAIN.format(key=key)} THEN 'train' ELSE 'test' END AS by_one, "
        f"CASE WHEN substr(md5({key} || '|' || CAST(o_custkey AS VARCHAR)), 1, 8) < '80000000' THEN 'train' ELSE 'test' END "
        "AS by_two FROM orders")
    q["sample_by_seeded_share"] = binned + "SELECT stratum, count(*) AS n, true AS share_ok FROM binned GROUP BY stratum"
    q["equal_width_bins_signed"] = _bins(
        "CASE WHEN o_custkey % 7 > 0 THEN o_totalprice / CAST(3 AS DOUBLE) - CAST('54225.890941973405' AS DOUBLE) END", "'none'")
    below = " + ".join(f"CAST({{v}} >= lo + (hi - lo) * CAST({k} AS DOUBLE) / CAST(5 AS DOUBLE) AS INTEGER)" for k in range(1, 5))
    q["binner_model"] = (
        "WITH t AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 > 0 THEN o_totalprice / CAST(3 AS DOUBLE) - CAST('54225.890941973405' AS DOUBLE) END AS x, "
        + HASH_TRAIN.format(key="o_orderkey") + " AS train FROM orders),\n"
        "r AS (SELECT min(x) AS lo, max(x) AS hi FROM t WHERE train),\ny AS (SELECT o_orderkey, x * CAST(1.25 AS DOUBLE) AS x FROM t WHERE NOT train)\n"
        f"SELECT o_orderkey, x, CASE WHEN x IS NULL THEN 'none' ELSE CAST({below.format(v='x')} AS VARCHAR) END AS at_end, "
        f"CASE WHEN x IS NULL OR x < lo OR x > hi THEN 'none' ELSE CAST({below.format(v='x')} AS VARCHAR) END AS inside FROM y, r")
    q["fitted_stats"] = stats_sql(["s_filled", "price_filled"])
    for name, options in (("unknown", {"known": "{c} % 7 > 0"}), ("subset", {"universe": SUBSET})):
        q[f"composition_stats_{name}"] = q[f"composition_stats_{name}_wide"] = stats_sql(props, **options)
    q["composition_stats_normalized"] = stats_sql(props, mix="mix_raw", normalize=True)
    q["composition_stats_null_weight"] = stats_sql(props, mix="mix_null")
    many = []
    for p in ("price", "size"):
        bad = f"count(*) FILTER (WHERE {p} IS NULL) > 0"
        many += [f"{rnd(f'max({p})')} AS {p}_max", f"{rnd(f'min({p})')} AS {p}_min",
                 f"{rnd(f'CASE WHEN {bad} THEN NULL ELSE sum(w / t * abs({p} - mean_{p})) END')} AS {p}_std", f"{rnd(f'any_value(mean_{p})')} AS {p}_mean",
                 f"{rnd(f'max({p}) FILTER (WHERE rk = 1)')} AS {p}_mode1",
                 rnd(f"CASE WHEN count(*) = 1 THEN (SELECT arg_min(struct_pack(v := {p}), c).v FROM u WHERE c <> any_value(m.c)) "
                     f"ELSE max({p}) FILTER (WHERE rk = CASE WHEN w2 = w1 THEN 1 ELSE 2 END) END") + f" AS {p}_mode2"]
    q["composition_stats_many_components"] = (
        "WITH q AS (SELECT CASE WHEN l_orderkey % 3 > 0 THEN l_orderkey ELSE 0 END AS e, l_partkey AS c, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2),\n"
        "u AS (SELECT p_partkey AS c, p_retailprice AS price, CAST(CASE WHEN p_partkey % 97 > 0 THEN p_size END AS DOUBLE) AS size FROM part),\n"
        "j AS (SELECT q.*, price, size, sum(w) OVER (PARTITION BY e) AS t, row_number() OVER (PARTITION BY e ORDER BY w DESC, c) AS rk FROM q JOIN u USING (c)),\n"
        "m AS (SELECT *, max(w) OVER (PARTITION BY e) AS w1, max(CASE WHEN rk = 2 THEN w END) OVER (PARTITION BY e) AS w2, "
        + ", ".join(f"CASE WHEN bool_or({p} IS NULL) OVER (PARTITION BY e) THEN NULL ELSE sum(w * {p}) OVER (PARTITION BY e) / t END AS mean_{p}" for p in ("price", "size"))
        + " FROM j)\nSELECT e AS entity_id, " + ", ".join(many) + " FROM m GROUP BY e")
    q["composition_stats_filled"] = stats_sql(["price_filled"])
    picked = [f"{p}_{s}" for p in props for s in ("max", "min", "mode1", "mode2")]
    near = [f"true AS {p}_{s}_near" for p in props for s in ("std", "mean")]
    q["composition_stats_float"] = (
        "SELECT entity_id, 'float' AS type, " + ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in picked)
        + ", " + ", ".join(near) + f" FROM ({full})")
    mixed = "(SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))"
    q["ml_metrics_check"] = (
        f"WITH binned AS ({_bins('o_totalprice', src=mixed)}),\n"
        "e AS (SELECT o_orderkey, CASE WHEN count(*) = count(stratum) THEN min(stratum) END AS stratum FROM binned GROUP BY 1),\n"
        f"s AS (SELECT o_orderkey, stratum IS NOT NULL AND rk <= round(CAST(0.8 AS DOUBLE) * n) AS train FROM (SELECT *, {ranked} FROM e))\n"
        "SELECT count(x) AS n, count(*) - count(x) AS n_skipped, true AS n_same, true AS rmse_same, true AS mae_same "
        "FROM binned JOIN s USING (o_orderkey) WHERE NOT train")
    q["rf_model_check"] = ("SELECT l_orderkey, l_linenumber, l_extendedprice, true AS same, true AS within FROM lineitem WHERE NOT ("
                           + HASH_TRAIN.format(key="l_orderkey") + ")")
    q["rf_quality"] = ("SELECT count(*) AS n, true AS evaluator_same, true AS beats_mean FROM lineitem WHERE NOT ("
                       + HASH_TRAIN.format(key="l_orderkey") + ")")
    q["csv_scan_typed"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
    raw = ("WITH t AS (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 'say \"' || o_orderstatus || '\", ok' WHEN 3 THEN NULL ELSE o_orderstatus END AS note, "
           "o_orderkey % 50 = 7 AS bad_price, o_orderkey % 70 = 3 AS bad_date, o_orderkey % 90 = 5 AS short FROM orders)\n")
    q["csv_rows"] = (raw + "SELECT o_orderkey, o_custkey, note, CASE WHEN o_orderkey % 11 > 0 THEN o_totalprice END AS o_totalprice, "
                     "CAST(epoch(o_orderdate) AS BIGINT) AS ordered_at FROM t WHERE NOT (bad_price OR bad_date OR short)")
    q["csv_rejects"] = (
        raw + "SELECT o_orderkey || ',' || o_custkey || ',' || CASE o_orderkey % 4 WHEN 0 THEN '\"say \"\"' || o_orderstatus || '\"\", ok\"' "
        "WHEN 3 THEN '' ELSE o_orderstatus END || ',' || CASE WHEN bad_price THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN '' ELSE CAST(o_totalprice AS VARCHAR) END "
        "|| CASE WHEN short THEN '' WHEN bad_date THEN ',2024-13-45 00:00:00' ELSE ',' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS line, "
        "short AS wrong_fields, concat_ws(';', CASE WHEN bad_price THEN 'o_totalprice' END, CASE WHEN bad_date AND NOT short THEN 'o_orderdate' END) "
        "AS bad_columns FROM t WHERE bad_price OR bad_date OR short")
    run = ("SELECT '{name}' AS run_id, count(*) AS n, " + rnd4("sqrt(avg((p - y) * (p - y)))") + " AS rmse, " + rnd4("avg(abs(p - y))")
           + " AS mae FROM (SELECT l_extendedprice AS y, avg(l_extendedprice) OVER (PARTITION BY l_returnflag) AS p FROM lineitem WHERE l_extendedprice < {limit})")
    q["metrics_rerun"] = run.format(name="first", limit="1e9") + " UNION ALL " + run.format(name="second", limit="30000")
    q["element_source"] = q["property_table"]
    q["word_count"] = _word_count("documents")
    q["text_scan_word_count"] = _word_count("(SELECT text FROM documents WHERE text IS NOT NULL)")
    q["vector_assemble"] = ("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS f_l_quantity, "
                            "CAST(l_discount AS DOUBLE) AS f_l_discount, CAST(l_tax AS DOUBLE) AS f_l_tax "
                            "FROM lineitem")
    q["regression_metrics"] = (
        "WITH m AS (SELECT l_returnflag, avg(l_extendedprice) AS prediction FROM lineitem GROUP BY 1),\n"
        "s AS (SELECT l.l_extendedprice AS y, m.prediction AS p FROM lineitem l JOIN m "
        "ON m.l_returnflag = l.l_returnflag WHERE m.prediction - l.l_extendedprice IS NOT NULL)\n"
        f"SELECT count(*) AS n, {rnd4('sqrt(avg((p - y) * (p - y)))')} AS rmse, {rnd4('avg(abs(p - y))')} AS mae FROM s")
    return q
