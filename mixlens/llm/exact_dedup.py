"""Exact dedup: Grace hash deduplication with complete content comparison.

Method. Records are partitioned by a hash of their content until each bucket's distinct
texts fit an open-addressing table, which compares complete texts. The spill files of
the classical form are Spark's shuffle files, so a lost executor only repeats its tasks:

* each scan task first collapses the copies it sees itself in such a table (in runs of
  ``run_bytes``), so a text that a third of all rows share crosses the shuffle about
  once a task;
* the partitioning recurses on the narrow table of digests and lengths: buckets above
  ``bucket_bytes`` split again by the next hash until they fit or hold a single text;
* texts then go to their bucket once, and each bucket is a table in one task.

Cases: NULL text counts as empty; texts are equal when equal after replacing each run of
ASCII white space by one space. Of equal texts the row with the smallest doc_id stays (a
NULL doc_id only if all are NULL). Of repeated rows, equal in id and text, one is kept.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, one_space, stored, tasks_for

by_value(__name__)

BUCKET_BYTES = 32 << 20
RUN_BYTES = 64 << 20
MAX_LEVELS = 8
#: Groups of more than 1 / HOT of all rows count as hot.
HOT = 1000
GROUP_SCHEMA = "text_sha256 string, norm string, doc_id long, n long"


class ContentTable:
    """Open addressing with linear probing over complete contents; a slot holds an entry's number."""

    def __init__(self, slots: int = 1024) -> None:
        self.slots = [-1] * slots
        self.digests: list[str] = []
        self.texts: list[bytes] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.bytes = 0

    def add(self, digest: str, text: bytes, doc_id: int | None, n: int) -> None:
        mask = len(self.slots) - 1
        at = int(digest[:15], 16) & mask
        while (entry := self.slots[at]) >= 0:
            if self.texts[entry] == text:
                old = self.ids[entry]
                self.ids[entry] = doc_id if old is None else old if doc_id is None else min(old, doc_id)
                self.counts[entry] += n
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.texts)
        self.digests.append(digest)
        self.texts.append(text)
        self.ids.append(doc_id)
        self.counts.append(n)
        self.bytes += len(text) + 200
        if len(self.texts) * 2 > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.digests):
            at = int(digest[:15], 16) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry

    def batches(self, rows: int = 2000) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.texts), rows):
            j = i + rows
            texts = pa.array(self.texts[i:j], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.digests[i:j], pa.string()), texts, pa.array(self.ids[i:j], pa.int64()),
                 pa.array(self.counts[i:j], pa.int64())], ["text_sha256", "norm", "doc_id", "n"])


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [(c.cast(pa.binary()) if n == "norm" else c).to_pylist() for n in names for c in [batch.column(n)]]


def collapse_runs(run_bytes: int):
    """Task code: collapse the copies within a task, in runs of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for digest, text, doc_id in zip(*_columns(batch, "text_sha256", "norm", "doc_id")):
                table.add(digest, text, doc_id, 1)
                if table.bytes > run_bytes:
                    yield from table.batches()
                    table = ContentTable()
        yield from table.batches()
    return run


def deduplicate_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: rows sorted by bucket; one table a bucket. Yields a row per distinct text."""
    def groups(table: ContentTable) -> pa.RecordBatch:
        if len(set(table.digests)) < len(table.digests):
            raise ValueError("two different texts have one SHA-256 digest")
        return pa.RecordBatch.from_arrays(
            [pa.array(table.digests, pa.string()), pa.array(table.ids, pa.int64()), pa.array(table.counts, pa.int64())],
            ["text_sha256", "keep_id", "group_size"])

    table, current = ContentTable(), None
    for batch in batches:
        for bucket, digest, text, doc_id, n in zip(*_columns(batch, "bucket", "text_sha256", "norm", "doc_id", "n")):
            if bucket != current and table.texts:
                yield groups(table)
                table = ContentTable()
            current = bucket
            table.add(digest, text, doc_id, n)
    if table.texts:
        yield groups(table)


def grace_buckets(digests: DataFrame, bucket_bytes: int, fan_out: int) -> tuple[int, DataFrame]:
    """(first fan-out, table of later splits). The splits hold a row for each bucket above
    ``bucket_bytes`` with more than one text: its path so far and its next fan-out."""
    texts = stored(digests.groupBy("text_sha256").agg(F.first("bytes").alias("bytes")), "dedup-texts")
    total = texts.agg(F.sum("bytes")).first()[0] or 0
    first = max(fan_out, -(-2 * total // bucket_bytes))
    level, splits = texts.withColumn("bucket", _hash(0, F.lit(first))), []
    for k in range(1, MAX_LEVELS):
        over = (level.groupBy("bucket").agg(F.sum("bytes").alias("size"), F.count("*").alias("texts"))
                .where((F.col("size") > bucket_bytes) & (F.col("texts") > 1))
                .select("bucket", F.ceil(2 * F.col("size") / bucket_bytes).cast("long").alias("fan")))
        over = stored(over, f"dedup-over{k}")
        if over.isEmpty():
            break
        splits.append(over)
        level = level.join(over, "bucket").withColumn("bucket", _deeper(k, F.col("fan"))).drop("fan")
    return first, splits


def _hash(level: int, fan):
    return F.pmod(F.xxhash64(F.lit(level), F.col("text_sha256")), fan)


def _deeper(level: int, fan):
    return F.xxhash64(F.col("bucket"), F.lit(level), _hash(level, fan))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES,
          run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    norm = docs.select(F.col(id_col).cast("long").alias("doc_id"), one_space(F.col(text_col)).alias("norm"))
    norm = norm.withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256))
    digests = stored(norm.select("doc_id", "text_sha256", F.octet_length("norm").cast("long").alias("bytes")), "dedup-digests")
    tasks = tasks_for(docs)
    first, splits = grace_buckets(digests, bucket_bytes, tasks)
    texts = norm.select("text_sha256", "norm", "doc_id").mapInArrow(collapse_runs(run_bytes), GROUP_SCHEMA)
    texts = texts.withColumn("bucket", _hash(0, F.lit(first)))
    for k, over in enumerate(splits, 1):
        texts = texts.join(over, "bucket", "left").withColumn(
            "bucket", F.when(F.col("fan").isNull(), F.col("bucket")).otherwise(_deeper(k, F.col("fan")))).drop("fan")
    groups = (texts.repartition(max(tasks, min(first, 20_000)), "bucket").sortWithinPartitions("bucket")
              .mapInArrow(deduplicate_buckets, "text_sha256 string, keep_id long, group_size long"))
    groups = stored(groups, "dedup-groups")
    rows, many = digests.select("doc_id", "text_sha256"), groups.where(F.col("group_size") > 1)
    # Fewer than HOT groups can hold more than 1 / HOT of the rows each: a proven bound for the
    # broadcast, by which their rows are not dealt out by digest. Texts with one row need no join.
    hot = F.col("group_size") * HOT > digests.count()
    large = F.broadcast(many.where(hot))
    joined = rows.join(large, "text_sha256").unionByName(
        rows.join(large, "text_sha256", "left_anti").join(many.where(~hot), "text_sha256", "left"))
    alone = F.col("group_size").isNull()
    out = joined.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
    return _keep_one(out)


def _keep_one(out: DataFrame) -> DataFrame:
    """Mark the rows that stay. Rows of a group that carry the kept id are one row unless
    rows repeat; only those few are numbered."""
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    keepers = out.where(first & (F.col("group_size") > 1))
    number = F.row_number().over(Window.partitionBy("text_sha256").orderBy("doc_id"))
    return (out.where(~(first & (F.col("group_size") > 1))).withColumn("kept", first)
            .unionByName(keepers.withColumn("kept", number == 1))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def without_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that ``dedup`` drops; all columns stay as they are."""
    decided = stored(dedup(docs, id_col=id_col, text_col=text_col, **options), "dedup-decisions")
    sha = F.sha2(one_space(F.col(text_col)).cast("binary"), 256)
    same = [F.col(id_col).cast("long").eqNullSafe(F.col("__id")), F.col("__sha") == F.col("__dropped")]
    keyed = docs.withColumn("__sha", sha)
    # The dropped rows are few; a row whose twin (same id and text) is kept must not go with it.
    kept = decided.where("kept").select(F.col("doc_id").alias("k"), F.col("text_sha256").alias("s"))
    dropped = decided.where("not kept")
    twins = stored(dropped.join(kept, dropped.doc_id.eqNullSafe(F.col("k")) & (dropped.text_sha256 == F.col("s")), "left_semi")
                   .select("doc_id", "text_sha256").distinct(), "dedup-twins")
    gone = dropped.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__dropped")).distinct()
    out = keyed.join(gone, same, "left_anti")
    if twins.isEmpty():
        return out.select(*docs.columns)
    t = twins.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__dropped"))
    one = keyed.join(t, same, "left_semi").dropDuplicates([id_col, "__sha"])
    return out.unionByName(one).select(*docs.columns)


ORACLE_SQL = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256 FROM d"""
