"""Stratified fractions, sampling, set difference and train/test split (M3-M6).

The reproducible forms draw each row from a hash of its key
(``mixlens.functions.hashing``): no shuffle, no driver round trip, the same
rows for any partitioning, and safe to recompute after executor loss.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlens.functions.hashing import draw_by_stratum, draw_below, key_text, threshold_text, unit_hex
from mixlens.operators.joins import lookup_join
from mixlens.sinks import scratch_table

#: What a rate may be: one for all strata, one by stratum in a dict, or a table (stratum, rate).
Rates = Mapping[object, float] | float | DataFrame


def stratified_fractions(df: DataFrame, label_col: str, fraction: float) -> DataFrame:
    """M3: one row per distinct stratum with the same ``fraction``."""
    return df.select(label_col).distinct().withColumn("fraction", F.lit(float(fraction)))


def _stratum_key(label_col: str) -> Column:
    """A text for each stratum, NULL's own among them, so that strata join as plain keys."""
    return F.when(F.col(label_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(label_col).cast("string")))


def rate_table(df: DataFrame, label_col: str, rates: Rates) -> DataFrame:
    """(__stratum, __rate) of each stratum of ``df`` that has a rate."""
    strata = df.select(_stratum_key(label_col).alias("__stratum")).distinct()
    if isinstance(rates, DataFrame):
        label, rate = rates.columns[:2]
        named = rates.select(_stratum_key(label).alias("__stratum"), F.col(rate).cast("double").alias("__rate")).where("__rate is not null")
        once = named.groupBy("__stratum").agg(F.min("__rate").alias("__rate"), F.max("__rate").alias("__most"))
        two = F.raise_error(F.concat(F.lit("two rates for stratum "), F.col("__stratum"))).cast("double")
        return once.select("__stratum", F.when(F.col("__rate") == F.col("__most"), F.col("__rate")).otherwise(two).alias("__rate"))
    if isinstance(rates, Mapping):
        type_ = df.schema[label_col].dataType.simpleString()
        return rate_table(df, label_col, df.sparkSession.createDataFrame([(k, float(v)) for k, v in rates.items()], f"s {type_}, r double"))
    return strata.withColumn("__rate", F.lit(float(rates)))


def with_rates(df: DataFrame, label_col: str, rates: DataFrame) -> DataFrame:
    """``df`` with the column ``__rate`` of its row's stratum, NULL where the table (stratum, rate) names none.

    A table of any size: a small one is broadcast after a size check; beyond that the rows of strata that hold
    many rows meet a broadcast of their rates, and only the others are shuffled.
    """
    return lookup_join(df.withColumn("__stratum", _stratum_key(label_col)), rate_table(df, label_col, rates), "__stratum", "left").drop("__stratum")


def sample_by_hash(df: DataFrame, key_cols: Sequence[str], label_col: str | None, fractions: Rates, salt: str = "") -> DataFrame:
    """M4, reproducible: keep a row when its key hash falls below its stratum's rate.

    ``fractions`` is one rate, a dict or a table (stratum, rate); strata without a rate are not drawn.
    """
    u = unit_hex(key_cols, salt)
    if isinstance(fractions, DataFrame):
        return with_rates(df, label_col, fractions).where(F.coalesce(u < threshold_text("__rate"), F.lit(False))).drop("__rate")
    if isinstance(fractions, Mapping):
        cond = draw_by_stratum(u, F.col(label_col), fractions)
    else:
        cond = draw_below(u, float(fractions))
    return df.where(cond)


#: Hex digits of the key hash that a round of the selection looks at, and digits in all.
PIECE, DIGITS = 4, 32


def exact_cuts(df: DataFrame, key_cols: Sequence[str], label_col: str, fractions: Rates, salt: str = "") -> DataFrame:
    """Where an exact sample ends in each stratum: (__stratum, __cut, __rest).

    The sample is the ``round(rate * rows)`` rows with the smallest key hashes (md5). They end inside one hash prefix,
    found by rounds of histograms: each counts, in the prefix found so far, the rows by the next ``PIECE`` digits (partial
    aggregation, at most 65,536 counts a stratum) and goes into the piece where the wanted number of rows is reached. A
    round's counts shrink 65,536-fold, so two or three rounds do. Rows with a hash prefix below ``__cut`` are drawn,
    and ``__rest`` of those whose whole hash equals it (NULL: all rows with that prefix).
    """
    keyed = df.select(_stratum_key(label_col).alias("__stratum"), _hash(key_cols, salt).alias("__h"))
    sizes = keyed.groupBy("__stratum").agg(F.count("*").alias("__n"))
    wanted = sizes.join(rate_table(df, label_col, fractions), "__stratum").select(
        "__stratum", "__n", F.least(F.col("__n"), F.round(F.col("__rate") * F.col("__n")).cast("long")).alias("__rest"))
    wanted = scratch_table(wanted.where("__rest > 0"), "exact-wanted")
    done = [wanted.where("__rest = __n").select("__stratum", F.lit("g").alias("__cut"), F.lit(None).cast("long").alias("__rest"))]
    at = scratch_table(wanted.where("__rest < __n").select("__stratum", F.lit("").alias("__cut"), "__rest"), "exact-open")
    for used in range(0, DIGITS, PIECE):
        if at.isEmpty():
            break
        inside = lookup_join(keyed, at, "__stratum").where(F.substring("__h", 1, used) == F.col("__cut"))
        counts = inside.groupBy("__stratum", "__cut", "__rest", F.substring("__h", used + 1, PIECE).alias("__piece")).agg(F.count("*").alias("__n"))
        up_to = F.sum("__n").over(Window.partitionBy("__stratum").orderBy("__piece"))
        reached = counts.withColumn("__sum", up_to).where((F.col("__sum") >= F.col("__rest")) & (F.col("__sum") - F.col("__n") < F.col("__rest")))
        found = scratch_table(reached.select("__stratum", F.concat("__cut", "__piece").alias("__cut"), "__n",
                                             (F.col("__rest") - F.col("__sum") + F.col("__n")).alias("__rest")), "exact-round")
        whole = F.col("__rest") == F.col("__n")
        done.append(found.where(whole).select("__stratum", F.concat("__cut", F.lit("g")).alias("__cut"), F.lit(None).cast("long").alias("__rest")))
        at = found.where(~whole).select("__stratum", "__cut", "__rest")
    out = at
    for part in done:
        out = out.unionByName(part)
    return out


def _hash(key_cols: Sequence[str], salt: str) -> Column:
    text = key_text(key_cols)
    return F.md5(F.concat(F.lit(salt + "|"), text) if salt else text)


def sample_exact(df: DataFrame, key_cols: Sequence[str], label_col: str, fractions: Rates, salt: str = "") -> DataFrame:
    """M4 with exact shares: ``round(rate * rows)`` rows of each stratum, those with the smallest key hashes.

    ``fractions`` is one rate, a dict or a table (stratum, rate); strata without a rate are not drawn, a rate of 1 or more
    takes all. Selecting is a map-only filter by the cuts of ``exact_cuts``; no stratum is sorted or
    gathered, whatever its size. Only where rows share one key at the cut are those counted by all their
    columns (which must be groupable), and as many copies kept as are due.
    """
    cuts = scratch_table(exact_cuts(df, key_cols, label_col, fractions, salt), "exact-cuts")
    keyed = df.withColumns({"__stratum": _stratum_key(label_col), "__h": _hash(key_cols, salt)})
    placed = lookup_join(keyed, cuts, "__stratum")
    below = placed.where("substring(__h, 1, length(__cut)) < __cut").select(*df.columns)
    tied = placed.where("__h = __cut").groupBy("__stratum", "__rest", *df.columns).agg(F.count("*").alias("__n"))
    # Distinct rows of one stratum and key: few, however many copies they have.
    before = F.sum("__n").over(Window.partitionBy("__stratum").orderBy(F.xxhash64(*df.columns))) - F.col("__n")
    due = tied.withColumn("__due", F.least(F.col("__n"), F.col("__rest") - before)).where("__due > 0")
    copies = due.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__due"))))
    return below.unionByName(copies.select(*df.columns))


def sample_by_seeded(df: DataFrame, label_col: str, fractions: Mapping[object, float],
                     seed: int) -> DataFrame:
    """M4 as in the reference: Spark's Bernoulli ``sampleBy`` (depends on partitioning)."""
    return df.sampleBy(label_col, dict(fractions), seed)


def except_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    """M5: rows of ``df`` not in ``other``, duplicates removed (SQL EXCEPT DISTINCT).

    Both sides are made distinct first: their partial aggregation collapses
    repeated rows inside each task, so a row repeated a billion times crosses
    the shuffle once per task instead of once per copy before the anti join.
    """
    return df.distinct().subtract(other.distinct())


def row_digest(cols: Sequence[str]) -> list[Column]:
    """128 bits of a row, in two columns, and 64 bits more that tell rows of one digest apart."""
    return [F.xxhash64(*cols).alias("__d1"), F.xxhash64(F.lit(1), *cols).alias("__d2"), F.xxhash64(F.lit(2), *cols).alias("__d3")]


#: Types whose text is exact, holds no comma and is never empty.
_WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


def _pack_numbers(df: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """The columns ``numbers`` (whole numbers) as one text, a NULL as an empty field: a few bytes a number in a shuffle."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in numbers]
    return df.select(*[c for c in df.columns if c not in numbers], F.concat_ws(",", *fields).alias("__numbers"))


def _unpack_numbers(df: DataFrame, types: Mapping[str, str], numbers: Sequence[str]) -> DataFrame:
    """What ``_pack_numbers`` packed, with all columns in the order of ``types``."""
    at = {c: F.col("__fields")[i] for i, c in enumerate(numbers)}
    split = df.withColumn("__fields", F.split("__numbers", ",", -1))
    return split.select(*[F.when(at[c] != "", at[c].cast(t)).alias(c) if c in at else F.col(c) for c, t in types.items()])


def except_distinct_wide(df: DataFrame, other: DataFrame, verify: bool = False) -> DataFrame:
    """M5 for wide rows: EXCEPT DISTINCT by row digests instead of a join on all columns.

    With ``verify`` the rows themselves are compared, in one exchange: both sides' rows are grouped by their values
    (partial aggregation, so a row repeated a billion times is one state a task), whole numbers packed into one text that
    gives them back, and the groups of ``df`` alone are left. Without it:

    One narrow exchange settles which rows are left: both sides' digests are summed up by digest (partial
    aggregation) into "in ``df``" and "in ``other``". The wide
    rows of ``df`` whose digest is left are then picked, where the digests fit a checked broadcast without a
    shuffle, and only they are made distinct. Digests have 128 bits; where two rows of one digest differ in 64 bits more,
    the rows themselves are compared. A row could be lost only if another shares all 192 bits.
    """
    if len(df.columns) != len(other.columns):
        raise ValueError("the tables differ in their number of columns")
    cols = df.columns
    # A union gives both sides the column types that EXCEPT compares in.
    typed = dict(df.limit(0).union(other.limit(0)).dtypes)
    left = df.select(*[F.col(c).cast(typed[c]).alias(c) for c in cols])
    right = other.select(*[F.col(o).cast(typed[c]).alias(c) for o, c in zip(other.columns, cols)])
    if verify:
        numbers = [c for c in cols if typed[c] in _WHOLE_NUMBERS]
        if len(numbers) > 1:
            left, right = _pack_numbers(left, numbers), _pack_numbers(right.toDF(*cols), numbers)
        sides = left.withColumn("__left", F.lit(True)).union(right.withColumn("__left", F.lit(False)))
        alone = sides.groupBy(*left.columns).agg(F.min("__left").alias("__alone")).where("__alone").drop("__alone")
        return _unpack_numbers(alone, typed, numbers) if len(numbers) > 1 else alone
    keys = ["__d1", "__d2"]
    both = left.select(*row_digest(cols), F.lit(True).alias("__left")).unionByName(right.select(*row_digest(cols), F.lit(False).alias("__left")))
    state = both.groupBy(*keys).agg(F.max("__left").alias("__l"), F.min("__left").alias("__all_left"),
                                    (F.min("__d3") != F.max("__d3")).alias("__mixed")).where("__l")
    state = scratch_table(state.select(*keys, F.col("__all_left").alias("__fresh"), (F.col("__mixed") & ~F.col("__all_left")).alias("__compare")), "except-digests")
    marked = left.select(*cols, *row_digest(cols)[:2])
    out = lookup_join(marked, state.where("__fresh").select(*keys), keys).select(*cols).distinct()
    compare = state.where("__compare").select(*keys)
    if compare.isEmpty():
        return out
    # One comparison of whole rows: Spark derives constraints from every pair of columns compared on its own.
    whole = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    mine, theirs = (lookup_join(d.select(*row_digest(cols)[:2], whole.alias("__row")), compare, keys) for d in (left, right))
    theirs = theirs.select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate(keys)], F.col("__row").alias("__other"))
    same = [F.col(k) == F.col(f"__o{i}") for i, k in enumerate(keys)] + [F.col("__row").eqNullSafe(F.col("__other"))]
    kept = mine.join(theirs, same, "left_anti").select("__row").distinct()
    return out.unionByName(kept.select(*[F.col("__row")[f"c{i}"].alias(c) for i, c in enumerate(cols)]))


def train_test_split(df: DataFrame, key_cols: Sequence[str], test_size: float,
                     label_col: str | None = None, fractions: Mapping[object, float] | None = None,
                     split_col: str = "split", salt: str = "") -> DataFrame:
    """M6: add ``split`` = 'train' / 'test'. Every row is kept, on exactly one side.

    The train share is ``1 - test_size`` in every stratum (or the per-stratum
    ``fractions``). Rows are drawn per key, so all rows sharing a key go to
    the same side (a group split when the key is an entity id).
    """
    u = unit_hex(key_cols, salt)
    if fractions is not None:
        train = draw_by_stratum(u, F.col(label_col), fractions)
    else:
        train = draw_below(u, 1.0 - float(test_size))
    return df.withColumn(split_col, F.when(train, F.lit("train")).otherwise(F.lit("test")))


def train_test_split_exact(df: DataFrame, key_cols: Sequence[str], label_col: str, fractions: Rates, split_col: str = "split",
                           salt: str = "") -> DataFrame:
    """M6 with exact shares: 'train' for the ``round(rate * rows)`` rows of each stratum with the smallest key hashes.

    Every row is kept, on exactly one side; strata without a rate are 'test'. Rows of a stratum that share a key go to one
    side, to 'train' where the share ends among them.
    """
    cuts = scratch_table(exact_cuts(df, key_cols, label_col, fractions, salt).drop("__rest"), "split-cuts")
    keyed = df.withColumns({"__stratum": _stratum_key(label_col), "__h": _hash(key_cols, salt)})
    train = F.expr("substring(__h, 1, length(__cut)) <= __cut")
    placed = lookup_join(keyed, cuts, "__stratum", "left")
    return placed.select(*df.columns, F.when(train, F.lit("train")).otherwise(F.lit("test")).alias(split_col))
