"""Composition-weighted statistics as Spark SQL expressions.

A composition is a set of weights ``w_i`` (percent) over an ordered list of
components (the *universe*), each with a property value ``p_i``. Six
statistics are defined:

* ``min`` / ``max``: min / max of ``p_i`` over components with ``w_i > 0``
  (NULL properties are skipped; no present component -> NULL).
* ``mean``: ``sum(w_i / 100 * p_i)`` -- not divided by ``sum(w_i)`` unless
  ``normalize=True``.
* ``std``: ``sum(w_i / 100 * |p_i - mean|)``, a weighted mean *absolute*
  deviation (not a standard deviation).
* ``mode1``: ``p`` at the first position whose weight equals ``max(w)``.
* ``mode2``: ``p`` at the first position whose weight equals the second entry
  of ``w`` sorted descending (ties kept, so a tie for the top gives
  ``mode2 == mode1``; a single present component gives the property of the
  first absent component).

Weight cleaning: NULL and NaN weights count as 0. A NULL property makes
``mean``/``std`` NULL only where its weight is non-zero.

The builders return SQL expression *text* (used through ``F.expr``): the
optimiser sees ordinary built-in expressions, and building a plan with
hundreds of terms costs one JVM call per output column instead of one per
term.

``wide_*`` unroll the definition over one column per component with the
property values folded in as literals: compiled code, no lambdas, no Python.
(Measured at sf0.1: about 3x faster than the same definition written with
``zip_with``/``aggregate`` lambdas, which Spark interprets per element.)
``items_*`` are the same definition over an array of ``struct<c, w, p0..>``
holding only the components present in one entity (at most the universe).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

# Output order of the six statistics, as in the reference's result struct.
STAT_NAMES = ("max", "min", "std", "mean", "mode1", "mode2")

NULL = "CAST(NULL AS DOUBLE)"


def is_missing(v) -> bool:
    return v is None or (isinstance(v, float) and math.isnan(v))


def q(name: str) -> str:
    """Quote an identifier."""
    return "`" + name.replace("`", "``") + "`"


def dlit(v) -> str:
    """A double literal (NULL for missing values)."""
    if is_missing(v):
        return NULL
    r = repr(float(v))
    if "e" in r or "inf" in r:
        return f"CAST('{r}' AS DOUBLE)"
    return f"{r}D"


def clean_weight(col_sql: str, null_weight: str = "zero") -> str:
    """NULL and NaN weights count as 0; with ``null_weight='error'`` they fail the job."""
    if null_weight not in ("zero", "error"):
        raise ValueError(f"null_weight must be 'zero' or 'error', not {null_weight!r}")
    instead = "0.0D" if null_weight == "zero" else "CAST(raise_error('a weight is NULL or NaN') AS DOUBLE)"
    return f"coalesce(nanvl(CAST({col_sql} AS DOUBLE), {NULL}), {instead})"


def balanced_sum(terms: Sequence[str]) -> str:
    """(a + b) + (c + d) ...: a shallow tree keeps generated code small."""
    terms = list(terms)
    if not terms:
        return "0.0D"
    while len(terms) > 1:
        nxt = [f"({terms[i]} + {terms[i + 1]})" for i in range(0, len(terms) - 1, 2)]
        if len(terms) % 2:
            nxt.append(terms[-1])
        terms = nxt
    return terms[0]


def lit_array(values: Sequence) -> str:
    return "array(" + ", ".join(dlit(v) for v in values) + ")"


# --------------------------------------------------------------------------
# Wide form: cleaned weight columns ws[i] (SQL names), literal properties.
# --------------------------------------------------------------------------

def wide_weight_array(ws: Sequence[str]) -> str:
    return "array(" + ", ".join(ws) + ")"


def wide_positions(arr: str, n: int) -> dict[str, str]:
    """1-based positions of the first top weight and of the first weight equal
    to the second entry of the weights sorted descending. ``array_remove``
    drops every copy of the top: if two or more were dropped the second entry
    is the top itself, else it is the largest remaining weight (O(n), no sort)."""
    top = f"array_max({arr})"
    out = {"__pos1": f"CAST(array_position({arr}, {top}) AS INT)"}
    if n > 1:
        rest = f"array_remove({arr}, {top})"
        second = f"CASE WHEN size({arr}) - size({rest}) >= 2 THEN {top} ELSE array_max({rest}) END"
        out["__pos2"] = f"CAST(array_position({arr}, {second}) AS INT)"
    else:
        out["__pos2"] = "CAST(NULL AS INT)"
    return out


def _term(w: str, p, body: str) -> str:
    return f"CASE WHEN {w} <> 0.0D THEN {NULL} ELSE 0.0D END" if is_missing(p) else body


def wide_mean(ws: Sequence[str], props: Sequence) -> str:
    return balanced_sum([_term(w, p, f"{w} / 100.0D * {dlit(p)}") for w, p in zip(ws, props)])


def wide_std(ws: Sequence[str], props: Sequence, mean: str) -> str:
    return balanced_sum([_term(w, p, f"{w} / 100.0D * abs({dlit(p)} - {mean})") for w, p in zip(ws, props)])


def wide_min_max(ws: Sequence[str], props: Sequence) -> tuple[str, str]:
    """min / max of the property over present components.

    Components are listed in ascending property order (a plan-time sort of
    the literal values): the minimum is the property of the first present one
    in that order, the maximum of the first present one in reverse order. A
    first-match CASE stops at the first hit and allocates nothing (measured
    faster than building and scanning a flag array).
    """
    idx = sorted((i for i, p in enumerate(props) if not is_missing(p)), key=lambda i: (props[i], i))
    if not idx:
        return NULL, NULL

    def first_present(order):
        return "CASE " + " ".join(f"WHEN {ws[i]} > 0.0D THEN {dlit(props[i])}" for i in order) + " END"
    return first_present(idx), first_present(idx[::-1])


def wide_mode(props: Sequence, pos: str) -> str:
    """Property at a 1-based component position."""
    return f"element_at({lit_array(props)}, {pos})"


# --------------------------------------------------------------------------
# Item form: items = array<struct<c int, w double, p0 double, ...>>.
# --------------------------------------------------------------------------

def items_arrays(items: str, n_universe: int) -> dict[str, str]:
    """Weights and components of the items as plain arrays (one lambda pass each)."""
    return {"__ws": f"transform({items}, x -> x.w)", "__cs": f"transform({items}, x -> x.c)",
            "__n_absent": f"({n_universe} - size(filter({items}, x -> x.k)))"}


def items_top(ws: str, n_absent: str) -> str:
    """Largest weight; absent components weigh 0."""
    return f"greatest(array_max({ws}), CASE WHEN {n_absent} > 0 THEN 0.0D END)"


def items_second(ws: str, top: str, n_absent: str, n_universe: int) -> str:
    """Second entry of all weights sorted descending (ties kept). ``array_remove``
    drops every copy of the top; absent components weigh 0."""
    if n_universe < 2:
        return NULL
    rest = f"array_remove({ws}, {top})"
    n_top = f"(size({ws}) - size({rest}) + CASE WHEN {top} = 0.0D THEN {n_absent} ELSE 0 END)"
    below = f"greatest(array_max({rest}), CASE WHEN {n_absent} > 0 AND {top} > 0.0D THEN 0.0D END)"
    return f"CASE WHEN {n_top} >= 2 THEN {top} ELSE {below} END"


def items_first_with(cs: str, ws: str, target: str, universe: Sequence[int]) -> str:
    """First component (universe order) whose weight equals ``target``; absent
    components weigh 0. Items are sorted by component, so the first matching
    position is the smallest present component."""
    uni = "array(" + ", ".join(str(int(c)) for c in universe) + ")"
    pos = f"array_position({ws}, {target})"
    present = f"CASE WHEN {pos} > 0 THEN element_at({cs}, CAST({pos} AS INT)) END"
    first_absent = f"array_min(array_except({uni}, {cs}))"
    return f"least({present}, CASE WHEN {target} = 0.0D THEN {first_absent} END)"


def items_fold(items: str, start: dict[str, str], step: dict[str, str]) -> str:
    """One pass over the items with a struct accumulator ``a``; ``step`` gives each of its fields from ``a`` and the item ``x``."""
    def struct(fields: dict[str, str]) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {fields[k]}" for k in start) + ")"
    return f"aggregate({items}, {struct(start)}, (a, x) -> {struct(step)})"


def items_sums(items: str, fields: Sequence[str]) -> str:
    """Struct of the total weight ``total`` and, per field, the weighted sum ``s_*`` and the least and
    greatest value ``lo_*``, ``hi_*`` of present items, all in one pass; ``bad_*`` tells that a non-zero weight
    met a NULL property (the fields of the accumulator that start non-NULL must stay so). ``least`` and
    ``greatest`` skip NULLs."""
    start, step = {"total": "0.0D"}, {"total": "a.total + x.w"}
    for f in fields:
        start |= {f"s_{f}": "0.0D", f"bad_{f}": "false", f"lo_{f}": NULL, f"hi_{f}": NULL}
        step |= {f"s_{f}": f"a.s_{f} + coalesce(x.w / 100.0D * x.{f}, 0.0D)",
                 f"bad_{f}": f"a.bad_{f} OR (x.{f} IS NULL AND x.w <> 0.0D)",
                 f"lo_{f}": f"IF(x.w > 0.0D, least(a.lo_{f}, x.{f}), a.lo_{f})",
                 f"hi_{f}": f"IF(x.w > 0.0D, greatest(a.hi_{f}, x.{f}), a.hi_{f})"}
    return items_fold(items, start, step)


def items_spreads(items: str, means: dict[str, str]) -> str:
    """Struct of the weighted sums ``s_*`` of distances from the means (where these are known), in one pass."""
    return items_fold(items, {f"s_{f}": "0.0D" for f in means},
                      {f"s_{f}": f"a.s_{f} + coalesce(x.w / 100.0D * abs(x.{f} - {m}), 0.0D)" for f, m in means.items()})


def lookup_in_universe(component: str, universe: Sequence[int], values: Sequence) -> str:
    """Property of a universe component (NULL component -> NULL)."""
    uni = "array(" + ", ".join(str(int(c)) for c in universe) + ")"
    # A guard and not nullif: inside element_at that gave the last element for 0 (Spark 4.1).
    position = f"array_position({uni}, {component})"
    return f"CASE WHEN {position} > 0 THEN element_at({lit_array(values)}, CAST({position} AS INT)) END"
