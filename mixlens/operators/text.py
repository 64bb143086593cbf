"""Word count.

Tokens are what Python's ``str.split(' ')`` gives per line: repeated,
leading or trailing spaces yield empty tokens and an empty line yields one.
A multi-line value is split into lines first, then each line into words;
both splits are on one literal character (Java's fast path, no regex). The
count is a plain ``groupBy().count()``: partial aggregation per task before
the shuffle, so a hot word costs one row per task, not one per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tokens(df: DataFrame, text_col: str = "value", *, multiline: bool = False) -> DataFrame:
    """One row per token. ``multiline`` also splits lines inside a value."""
    lines = df.select(F.col(text_col).alias("__line"))
    if multiline:
        # Line ends as the line reader knows them: LF, CR LF and CR.
        ends = F.translate(F.replace(F.col("__line"), F.lit("\r\n"), F.lit("\n")), "\r", "\n")
        lines = lines.select(F.explode(F.split(ends, "\n", -1)).alias("__line"))
    return lines.select(F.explode(F.split(F.col("__line"), " ", -1)).alias("word"))


def word_count(df: DataFrame, text_col: str = "value", *, multiline: bool = False) -> DataFrame:
    """(word, count) over all tokens."""
    return tokens(df, text_col, multiline=multiline).groupBy("word").agg(F.count("*").alias("count"))
