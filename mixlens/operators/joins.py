"""Size checks for the small sides we fold into plans or broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

_FIXED = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp")


class TooLargeError(ValueError):
    pass


def bounded_rows(df: DataFrame, max_rows: int, what: str = "table") -> list[Row]:
    """Collect ``df`` only if it has at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows, so the check itself is bounded.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise TooLargeError(f"{what} has more than {max_rows} rows; refusing to fold it into the plan")
    return rows


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row of ``df`` takes."""
    fixed = sum(8 for _, t in df.dtypes if t in _FIXED)
    varying = [F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c, t in df.dtypes if t not in _FIXED]
    return sum(varying, F.lit(fixed + 8))


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and about ``max_bytes`` bytes (bounded check)."""
    width = row_bytes(df)
    r = df.limit(max_rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).collect()[0]
    return r["n"] <= max_rows and r["b"] <= max_bytes


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows (bounded check)."""
    return df.limit(max_rows + 1).count() <= max_rows


#: Keys with more than one in this many rows count as hot: fewer keys than this, whatever the data.
HOT_SHARE = 1000


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = 1_000_000,
                max_bytes: int = 64 << 20) -> DataFrame:
    """Join a per-key lookup table (``how``: inner or left): broadcast when its size is proven small.

    ``small`` (typically an aggregate of ``big``) is computed once and checkpointed to the session's
    checkpoint folder; a bounded check (at most ``max_rows + 1`` rows read) proves its rows and bytes.
    Beyond the bound both sides are split: rows of hot keys, which are fewer than ``HOT_SHARE`` keys however
    large ``big`` is, meet a broadcast of those keys' lookup rows (each key's number of them is checked too), and
    the others a regular join, in which no key then holds a large share of the rows.
    """
    from mixlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(small.sparkSession)
    small = small.checkpoint(eager=True)
    if fits_broadcast(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), on, how)
    keys = [on] if isinstance(on, str) else list(on)
    counted = big.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = big.agg((F.count("*") / HOT_SHARE).alias("__bound"))
    hot = counted.join(F.broadcast(total), F.col("__n") > F.col("__bound")).select(*keys).dropna().checkpoint(eager=True)
    hot_side = small.join(F.broadcast(hot), keys, "left_semi").checkpoint(eager=True)
    if hot.isEmpty() or not fits_broadcast(hot_side, max_rows, max_bytes):
        return big.join(small, on, how)
    cold = big.join(F.broadcast(hot), keys, "left_anti").join(small, on, how)
    busy = big.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(hot_side), on, how)
    return cold.unionByName(busy)
