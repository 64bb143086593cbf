"""Scans: typed CSV (S1, S2), Parquet (S3), text lines."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_from_json(spec: str | Mapping) -> T.StructType:
    """A ``StructType`` from its JSON form (text or parsed dict)."""
    return T.StructType.fromJson(json.loads(spec) if isinstance(spec, str) else dict(spec))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str | Mapping,
                   *, header: bool = True, sep: str = ",", mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with an explicit schema; fields bind by position, bad fields become NULL.

    No schema inference (one pass, no sampling job); the scan prunes columns
    and splits large files across tasks.
    """
    if not isinstance(schema, T.StructType):
        schema = schema_from_json(schema)
    return (spark.read.format("csv").option("sep", sep).option("header", str(header).lower())
            .option("mode", mode).schema(schema).load(path))


class CheckedCsv(NamedTuple):
    """``rows`` that parsed whole, and ``rejects``: file, line, wrong_fields (their number), bad_columns (that did not parse)."""

    rows: DataFrame
    rejects: DataFrame


RAW = "__raw_line"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str | Mapping, *, header: bool = True,
                     sep: str = ",", null_value: str = "", options: Mapping[str, str] | None = None) -> CheckedCsv:
    """S1 without silent loss: no row with a bad field passes as one with a NULL.

    A row that has too few or too many fields, or a field that is not of its column's type, goes to the rejects
    as it stands in the file, with the columns at fault. Empty fields are NULL in good rows. Quotes are doubled inside quoted
    fields. Header names are checked against the schema (a wrong one stops the job). Nothing is gathered: both tables are
    filters over the same scan, which reads every field of a line, whatever columns are asked for later.
    """
    if not isinstance(schema, T.StructType):
        schema = schema_from_json(schema)
    how = {"sep": sep, "quote": '"', "escape": '"', "nullValue": null_value, "mode": "PERMISSIVE", **(options or {})}
    scan = (spark.read.format("csv").options(**how).option("header", str(header).lower()).option("enforceSchema", str(not header).lower())
            .option("columnNameOfCorruptRecord", RAW)
            .schema(T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])).load(path))
    names = schema.fieldNames()
    # Only fields that a query names are parsed, and so found bad: this condition, which always holds, names all.
    read = F.xxhash64(*names) >= F.lit(-(1 << 63))
    rows = scan.where(F.col(RAW).isNull() & read).select(*names)

    texts = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(RAW, T.StringType())])
    parsed = F.from_csv(F.col(RAW), _ddl(texts), {**how, "columnNameOfCorruptRecord": RAW})
    bad = scan.where(F.col(RAW).isNotNull() & read).withColumns({"__texts": parsed, "__file": F.col("_metadata.file_path")})
    lost = [F.when(F.col("__texts")[n].isNotNull() & F.col(n).isNull(), F.lit(n)) for n in names]
    rejects = bad.select(F.col("__file").alias("file"), F.col(RAW).alias("line"), F.col("__texts")[RAW].isNotNull().alias("wrong_fields"),
                         F.array_compact(F.array(*lost)).alias("bad_columns"))
    return CheckedCsv(rows, rejects)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
