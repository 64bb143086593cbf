"""Reproducible per-row uniform draws from a key hash.

``unit_hex(key)`` is the first 8 hex digits of ``md5`` of the key text: a
uniform 32-bit draw that depends only on the key, not on partitioning, file
layout or executor loss (a re-run task draws the same values). A fraction
``f`` becomes the 8-digit threshold ``floor(f * 2^32)`` in hex, and the row is
drawn when ``unit_hex < threshold`` (plain text comparison, which any SQL
engine with ``md5`` reproduces).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 8
#: How a NULL key column enters the hash.
NULL_KEY = "<null>"
_SPACE = 16 ** HASH_DIGITS


def key_text(keys: Sequence[str | Column]) -> Column:
    """Text of the key columns; a NULL is the marker ``NULL_KEY``, hashed like any key."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit(NULL_KEY)) for c in cols])


def unit_hex(keys: Sequence[str | Column], salt: str = "") -> Column:
    text = key_text(keys)
    if salt:
        text = F.concat(F.lit(salt + "|"), text)
    return F.substring(F.md5(text), 1, HASH_DIGITS)


def threshold_hex(fraction: float) -> str | None:
    """8-digit hex threshold for ``fraction``; None means 'always' (fraction >= 1)."""
    if fraction >= 1.0:
        return None
    return format(max(0, int(fraction * _SPACE)), f"0{HASH_DIGITS}x")


def draw_below(u: Column, fraction: float) -> Column:
    t = threshold_hex(fraction)
    if t is None:
        return F.lit(True)
    if fraction <= 0:
        return F.lit(False)
    return u < F.lit(t)


def _threshold_text(fraction: float) -> str:
    """Threshold as text: '' never draws, 'g' (above every hex digit) always draws."""
    if fraction >= 1.0:
        return "g"
    if fraction <= 0:
        return ""
    return threshold_hex(fraction)


def threshold_text(rate: str | Column) -> Column:
    """``_threshold_text`` of a column of rates; NULL has none."""
    f = F.col(rate) if isinstance(rate, str) else rate
    digits = F.lpad(F.lower(F.hex(F.floor(F.least(f, F.lit(1.0)) * F.lit(float(_SPACE))).cast("long"))), HASH_DIGITS, "0")
    return F.when(f >= 1.0, F.lit("g")).when(f <= 0.0, F.lit("")).when(f.isNotNull() & ~F.isnan(f), digits)


def draw_by_stratum(u: Column, stratum: Column, fractions: Mapping[object, float]) -> Column:
    """True when the row is drawn at its stratum's rate; unknown strata -> False.

    One lookup of the stratum in a literal map of thresholds (the stratum
    expression is referenced once, however many strata there are).
    """
    keyed = {k: _threshold_text(f) for k, f in fractions.items() if k is not None}
    lookup = F.lit(None).cast("string")
    if keyed:
        m = F.create_map(*[x for k, t in keyed.items() for x in (F.lit(k), F.lit(t))])
        lookup = F.try_element_at(m, stratum)
    if None in fractions:
        lookup = F.when(stratum.isNull(), F.lit(_threshold_text(fractions[None]))).otherwise(lookup)
    return F.coalesce(u < lookup, F.lit(False))
