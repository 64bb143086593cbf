"""Line dedup: lines that many documents hold, looked up in a sharded minimal perfect hash.

Method. A line's key (ASCII white space stripped at both ends, A-Z lower-cased) is hashed to 128
bits. Each task counts in how many documents it met a hash, and the counts are summed by hash. The hashes of
at least ``min_docs`` documents are dealt out to shards of about ``SHARD_KEYS`` keys, and each shard becomes a
minimal perfect hash: levels of bit arrays, where a key that is alone at its bit of a level has that bit, the
others go on to the next level, and the rank of a key's bit among all bits set is its slot. The slot
indexes two compact arrays, a 64-bit fingerprint, which rejects lines that are not in the index, and the
count (32 bits, saturating). A slot costs about 15 bytes, whatever the length of its line.

Documents probe the arrays, lines are not joined. An index of at most ``index_bytes`` is sent to all tasks and
probed while the texts are read. A larger one stays where it is: every document sends each of its hashes once to the
hash's shard, which streams them past its arrays, and the hits go back to their documents. Lines that hold more than a
thousandth of all hits (fewer than ``HOT`` lines, so a proven bound) do not travel: their documents meet a broadcast.

Cases: a row is a document, repeated rows and rows with one id or a NULL id count each. NULL and empty texts
have one empty line. Keys under ``min_chars`` code points always stay. A text all of whose lines go is empty; a
NULL text stays NULL in ``without_common_lines``. Two keys of one 128-bit hash count as one line. An empty table gives no
rows; other columns are ignored, or kept by ``without_common_lines``.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, stored, tasks_for

by_value(__name__)

MIN_DOCS, MIN_CHARS = 10, 1
SHARD_KEYS = 1 << 16
INDEX_BYTES = 32 << 20
HOT = 1000
#: Bits a key has at each level, and keys that a task counts before it hands them on.
GAMMA, RUN_KEYS = 2, 200_000
SLICE = 200
SPACE_BYTES = b" \t\n\x0b\x0c\r"
COUNTS = "a long, b long, n long"
SHARD = "shard long, sizes array<int>, bits binary, fingerprints binary, counts binary"
LINES = "doc_id long, t1 long, t2 long, a long, b long"


def line_keys(raw: bytes) -> list[bytes]:
    """The keys of a text's lines (``bytes`` lower-cases A-Z only)."""
    return [line.strip(SPACE_BYTES).lower() for line in raw.split(b"\n")]


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "surrogatepass")) >= min_chars)


def hash_pairs(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of the keys' 128-bit hashes."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


# ------------------------------------------------------------------ minimal perfect hash

def bit_of(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each key at a level of ``size`` bits: levels hash both halves anew."""
    x = a.astype(np.uint64) ^ (b.astype(np.uint64) * np.uint64(2 * level + 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) + np.uint64(level)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


def perfect_hash(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """(sizes and bits of the levels, slot of each key) for distinct keys (a, b)."""
    left, base, sizes, levels, slots = np.arange(len(a)), 0, [], [], np.zeros(len(a), np.int64)
    while len(left):
        size = -(-GAMMA * len(left) // 64) * 64
        at = bit_of(a[left], b[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        put = alone[at]
        slots[left[put]] = base + (np.cumsum(alone) - 1)[at[put]]
        base += int(alone.sum())
        sizes.append(size)
        levels.append(alone)
        left = left[~put]
    return sizes, levels, slots


class Shard:
    """The arrays of one shard, ready to probe."""

    def __init__(self, sizes: list[int], bits: bytes, fingerprints: bytes, counts: bytes) -> None:
        self.levels, at, base = [], 0, 0
        for size in sizes:
            on = np.unpackbits(np.frombuffer(bits, np.uint8, size // 8, at)).astype(bool)
            self.levels.append((on, base + np.cumsum(on, dtype=np.int32) - 1))
            base, at = base + int(on.sum()), at + size // 8
        self.fingerprints, self.counts = np.frombuffer(fingerprints, np.int64), np.frombuffer(counts, np.uint32)

    def probe(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Documents of each key; 0 where the index does not hold it."""
        found, left = np.zeros(len(a), np.uint32), np.arange(len(a))
        for level, (on, rank) in enumerate(self.levels):
            at = bit_of(a[left], b[left], level, len(on))
            hit = on[at]
            keys, slots = left[hit], rank[at[hit]]
            same = self.fingerprints[slots] == b[keys]
            found[keys[same]] = self.counts[slots[same]]
            left = left[~hit]
        return found


def build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: shard, a, b, n sorted by shard -> one row of arrays a shard."""
    def built(shard: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        a, b, n = np.concatenate(parts, axis=1)
        sizes, levels, slots = perfect_hash(a, b)
        fingerprints, counts = np.zeros(len(a), np.int64), np.zeros(len(a), np.uint32)
        fingerprints[slots], counts[slots] = b, np.minimum(n, (1 << 32) - 1)
        row = [[shard], [sizes], [b"".join(np.packbits(x).tobytes() for x in levels)], [fingerprints.tobytes()], [counts.tobytes()]]
        types = [pa.int64(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["shard", "sizes", "bits", "fingerprints", "counts"])

    current, parts = None, []
    for batch in batches:
        shard, *rest = (batch.column(c).to_numpy() for c in ("shard", "a", "b", "n"))
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if i == j:
                continue
            if parts and shard[i] != current:
                yield built(current, parts)
                parts = []
            current = int(shard[i])
            parts.append(np.stack([c[i:j] for c in rest]))
    if parts:
        yield built(current, parts)


class Index:
    """All shards, for tasks that hold the whole index."""

    def __init__(self, n_shards: int, rows: list[tuple]) -> None:
        self.n_shards, self.shards = n_shards, {shard: Shard(*arrays) for shard, *arrays in rows}

    def probe(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        found, shard = np.zeros(len(a), np.uint32), a % self.n_shards
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.n_shards + 1))
        for s in np.unique(shard).tolist():
            rows = order[cuts[s]:cuts[s + 1]]
            if s in self.shards:
                found[rows] = self.shards[s].probe(a[rows], b[rows])
        return found


# ------------------------------------------------------------------ task code

def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def count_task(min_chars: int):
    """Task code: text -> a, b, n: number of documents, as far as this task has met them."""
    def handed(counts: Counter) -> pa.RecordBatch:
        a, b = np.frombuffer(b"".join(counts), np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(list(counts.values()), pa.int64())], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                for raw in texts_of(batch.slice(i, SLICE)):
                    keys = {k for k in line_keys(raw or b"") if long_enough(k, min_chars)}
                    counts.update(map(xxhash.xxh3_128_digest, keys))
                    if len(counts) > RUN_KEYS:
                        yield handed(counts)
                        counts = Counter()
        if counts:
            yield handed(counts)
    return run


def hashes_task(min_chars: int):
    """Task code: doc_id, t1, t2, text -> a row for each distinct line hash of a document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                keys = [list({k for k in line_keys(raw or b"") if long_enough(k, min_chars)}) for raw in texts_of(part)]
                a, b = hash_pairs([k for of in keys for k in of])
                at = pa.array(np.repeat(np.arange(len(keys)), [len(of) for of in keys]))
                yield pa.RecordBatch.from_arrays([part.column(c).take(at) for c in ("doc_id", "t1", "t2")] + [pa.array(a), pa.array(b)],
                                                 ["doc_id", "t1", "t2", "a", "b"])
    return run


def probe_shards(min_docs: int):
    """Task code: rows sorted by shard, a shard's arrays before its lines -> the lines found often enough.
    A task holds one shard and one batch of lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, arrays = None, None
        for batch in batches:
            ids, is_line = batch.column("shard").to_numpy(), batch.column("is_line").to_pylist()
            a, b = (batch.column(c).fill_null(0).to_numpy() for c in "ab")  # the arrays' row has none
            keep, cuts = np.zeros(len(ids), bool), [0, *(np.flatnonzero(np.diff(ids)) + 1), len(ids)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i < j and not is_line[i]:
                    arrays = Shard(*(batch.column(c)[i].as_py() for c in ("sizes", "bits", "fingerprints", "counts")))
                    shard, i = int(ids[i]), i + 1
                if i < j and ids[i] == shard:
                    keep[i:j] = arrays.probe(a[i:j], b[i:j]) >= min_docs
            found = batch.filter(pa.array(keep))
            yield found.select(["doc_id", "t1", "t2", "a", "b"])
    return run


def cut_task(out: Callable, names: list[str], text_col: str, common: Callable):
    """Task code: documents -> ``out`` of each, given its lines and which of them go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                raws = texts_of(part, text_col)
                lines = [(raw or b"").split(b"\n") for raw in raws]
                gone = common(part, [line_keys(raw or b"") for raw in raws])
                yield pa.RecordBatch.from_arrays(out(part, raws, lines, gone), names)
    return run


def by_index(index, min_docs: int, min_chars: int):
    """Which lines go, by an index held in the task."""
    held: list[Index] = []  # the task's unpacked arrays

    def common(part: pa.RecordBatch, keys: list[list[bytes]]) -> list[list[bool]]:
        if not held:
            held.append(Index(*index.value))
        found = held[0].probe(*hash_pairs([k for of in keys for k in of])) >= min_docs
        at = np.cumsum([0, *map(len, keys)])
        return [[bool(x) and long_enough(k, min_chars) for x, k in zip(found[i:j].tolist(), of)] for i, j, of in zip(at[:-1], at[1:], keys)]
    return common


def by_hits(part: pa.RecordBatch, keys: list[list[bytes]]) -> list[list[bool]]:
    """Which lines go, by the hits that came with the documents."""
    out = []
    for found, of in zip(part.column("__hits").to_pylist(), keys):
        if not found:
            out.append([False] * len(of))
            continue
        hits = {(h["a"], h["b"]) for h in found}
        out.append([pair in hits for pair in zip(*(x.tolist() for x in hash_pairs(of)))])
    return out


def kept_lines(lines: list[bytes], gone: list[bool]) -> bytes:
    return b"\n".join(line for line, x in zip(lines, gone) if not x)


# ------------------------------------------------------------------ plans

def line_counts(docs: DataFrame, *, text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, n): hashes of the lines of at least ``min_docs`` documents."""
    met = docs.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count_task(min_chars), COUNTS)
    return met.groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


def line_index(counts: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[int, DataFrame]:
    """(number of shards, a row of arrays for each shard that has keys)."""
    n_shards = max(1, -(-counts.count() // shard_keys))
    keys = counts.withColumn("shard", F.pmod("a", F.lit(n_shards)))
    rows = keys.repartition(min(n_shards, 20_000), "shard").sortWithinPartitions("shard").mapInArrow(build_shards, SHARD)
    return n_shards, stored(rows, "lines-index")


def _text_hashes(text: Column) -> list[Column]:
    """Two hashes that tell a document's texts apart."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def _hits(docs: DataFrame, counts: DataFrame, n_shards: int, index: DataFrame, id_col: str, text_col: str,
          min_docs: int, min_chars: int) -> DataFrame:
    """(doc_id, t1, t2, hits): the common lines of each document that has any, by the shards."""
    text = F.col(text_col)
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_text_hashes(text), text.cast("binary").alias("text"))
    lines = stored(lines.mapInArrow(hashes_task(min_chars), LINES), "lines-hashes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # Fewer than HOT lines have more than 1 / HOT of the documents' common lines each: a proven bound.
    hot = F.broadcast(stored(counts.where(F.col("n") * HOT > total).select("a", "b"), "lines-hot"))
    cold = lines.join(hot, ["a", "b"], "left_anti").select(F.pmod("a", F.lit(n_shards)).alias("shard"), F.lit(True).alias("is_line"), *lines.columns)
    both = cold.unionByName(index.withColumn("is_line", F.lit(False)), allowMissingColumns=True)
    dealt = both.repartition(max(tasks_for(docs), min(n_shards, 20_000)), "shard").sortWithinPartitions("shard", "is_line")
    hits = dealt.mapInArrow(probe_shards(min_docs), LINES).unionByName(lines.join(hot, ["a", "b"], "left_semi").select(*lines.columns))
    return hits.groupBy("doc_id", "t1", "t2").agg(F.collect_set(F.struct("a", "b")).alias("__hits"))


def _cut(docs: DataFrame, out: Callable, names: list[str], schema, id_col: str, text_col: str, min_docs: int, min_chars: int,
         index_bytes: int, shard_keys: int) -> DataFrame:
    counts = stored(line_counts(docs, text_col=text_col, min_docs=min_docs, min_chars=min_chars), "lines-counts")
    n_shards, index = line_index(counts, shard_keys)
    size = index.agg(F.sum(sum(F.octet_length(c) for c in ("bits", "fingerprints", "counts")))).first()[0] or 0
    if size <= index_bytes:
        held = docs.sparkSession.sparkContext.broadcast((n_shards, [tuple(r) for r in index.collect()]))
        return docs.mapInArrow(cut_task(out, names, text_col, by_index(held, min_docs, min_chars)), schema)
    hits = _hits(docs, counts, n_shards, index, id_col, text_col, min_docs, min_chars)
    hits = hits.select(F.struct(F.col("doc_id"), F.col("t1"), F.col("t2")).alias("__key"), "__hits")
    key = F.struct(F.col(id_col).cast("long").alias("doc_id"), *_text_hashes(F.col(text_col)))
    joined = docs.withColumn("__of", key).join(hits, F.col("__of").eqNullSafe(F.col("__key")), "left").select(*docs.columns, "__hits")
    return joined.mapInArrow(cut_task(out, names, text_col, by_hits), schema)


def line_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS, index_bytes: int = INDEX_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
    def out(part, raws, lines, gone):
        digests = [hashlib.sha256(kept_lines(*x)).hexdigest() for x in zip(lines, gone)]
        return [part.column("doc_id"), pa.array(map(len, lines), pa.int64()), pa.array(map(sum, gone), pa.int64()),
                pa.array(digests, pa.string())]

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    return _cut(narrow, out, names, "doc_id long, n_lines long, n_dropped long, kept_sha256 string", "doc_id", "text", min_docs, min_chars,
                index_bytes, shard_keys)


def without_common_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                         min_chars: int = MIN_CHARS, index_bytes: int = INDEX_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` documents hold; other columns stay as they are."""
    names = list(docs.columns)

    def out(part, raws, lines, gone):
        texts = [None if raw is None else kept_lines(*x) for raw, *x in zip(raws, lines, gone)]
        return [pa.array(texts, pa.binary()).cast(part.column(i).type) if n == text_col else part.column(i) for i, n in enumerate(names)]

    return _cut(docs, out, names, docs.schema, id_col, text_col, min_docs, min_chars, index_bytes, shard_keys)


ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key AS common FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(common) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c ON key = common GROUP BY rid"""
