"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import zlib
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.session import scratch_path

#: ASCII white space, and a word, as Java and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def by_value(module_name: str) -> None:
    """Send a module's functions to the executors by value, so that task code runs
    there without the library being installed on them."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


by_value(__name__)


def task_state() -> dict:
    """What a Python worker keeps from task to task (loaded tokenizers)."""
    return vars(sys.modules.setdefault("_mixlens_task_state", ModuleType("_mixlens_task_state")))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under ``spark.checkpoint.dir`` and read back: cuts the
    lineage, survives lost executors, and later steps read only the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def one_space(text: Column) -> Column:
    """Text with each run of white space replaced by one space; NULL becomes empty.

    Single plain spaces, nearly all of the white space in prose, need no replacing,
    so the pattern matches only the other runs.
    """
    other = rf"{SPACE}{{2,}}|[\x09-\x0D]"
    return F.regexp_replace(F.coalesce(text, F.lit("")), other, " ")


def held_out(doc_id) -> bool:
    """True for the quarter of documents that no model may learn from."""
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def held_out_column(doc_id: Column) -> Column:
    """``held_out`` as a column; a NULL id hashes as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def seeded_order(doc_id: Column, seed: int) -> Column:
    """A seeded 60-bit position of a document: the same in every run and for any partitioning."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def tasks_for(df: DataFrame) -> int:
    """Shuffle partitions of the session: the unit in which wide steps are dealt out."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the CRC-32 of an ASCII text, byte by byte and bit by bit (the reflected polynomial is a fixed value)."""
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bits}), 4294967295)"
