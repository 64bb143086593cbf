"""N-gram Jaccard join of documents: parity-sketch join with pigeonhole, then exact verification.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their sets of distinct
``words``-word shingles. That is ``|A ^ B| <= k(|A| + |B|)`` with ``k = (100 - percent) / (100 + percent)``.

Method, per document (once over the text, in Arrow batches):

* shingles are 64-bit hashes; their parity sketch is a bit string in which each shingle
  flips one bit, so the Hamming distance of two sketches is at most the symmetric difference;
* sizes form geometric bands in which linked documents lie in the same or adjacent ones. In
  a band at most K shingles can differ, so of C = K + 1 + e chunks (shingles dealt by
  hash, each chunk the XOR of its shingles) at least e + 1 agree;
* a chunk of fewer than two shingles says little and could be shared by very many documents.
  The e chunks to spare pay for leaving those out: a document with at most e of them
  leaves them out, one with more keeps them. A linked pair whose agreeing chunks are all
  such has more than e of them on both sides, so none is lost.

Documents that agree in a chunk meet there. In each meeting the sketches within the bound
are joined up (a spanning forest, not all pairs); the components of these joins are
small families, whose exact shingle sets are then compared: one against all the rest in
one pass, and only between documents not yet connected. The links found span the true
components: a linked pair meets, passes the sketch bound, and so is compared or connected.

Equal sets share one identity (a 64-bit digest of the set), so copies are one node. Meetings
and families above ``block`` members, and families above ``BLOCK_SHINGLES`` shingles, are dealt out as pairs of blocks;
so no task holds an unbounded group. Wide steps carry chunk keys, not texts. Sets are sets of 64-bit shingle hashes:
``n_shingles`` and the links are exact up to collisions of those.

Cases: NULL, empty or white-space-only texts have an empty set and link with nothing; fewer
words than a shingle make one shingle of the whole. Repeated rows are copies. A row is told by its id and the
hash of its text (``tid``), so rows with one doc_id or a NULL id but other texts link and go each for itself.
NULL ids come out with NULL component unless linked to an id. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, stored, tasks_for
from mixlens.llm.components import components

by_value(__name__)

BLOCK = 1024
#: Shingles of a block of a family: two blocks of sets meet in one task.
BLOCK_SHINGLES = 1 << 22
#: Distinct words whose hashes a task keeps; beyond it the table starts anew.
WORDS_KEPT = 1_000_000
SIDE = "doc_id long, tid long, n long, sid long, sketch binary, keys array<long>"
LINKS = "a long, b long"


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: multiply and shift, wrapping."""
    x = x ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, filled on demand."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles (ASCII lower case, ASCII white space)."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    n = min(words, len(tokens))
    out = mixed(h[: len(h) - n + 1], n)
    for i in range(1, n):
        out = mixed(out + h[i: len(h) - n + 1 + i], i)
    return np.unique(out)


def most_different(total: int, percent: int) -> int:
    """Largest symmetric difference of two linked sets of ``total`` shingles together."""
    return (100 - percent) * total // (100 + percent)


@lru_cache(None)
def band_tops(percent: int) -> tuple[int, ...]:
    """Largest set size of each band; a set's linked partners lie in its own or the next band."""
    tops, top = [], 1
    while top < 1 << 40:
        tops.append(top)
        top = max(top + 1, top * 100 // percent)
    return tuple(tops)


@lru_cache(None)
def band_chunks(band: int, percent: int) -> tuple[int, int]:
    """(chunks, chunks to spare) of a band."""
    top = band_tops(percent)[band]
    least = most_different(2 * top, percent) + 1
    if least == 1:
        return 1, 0
    load = top / least
    few = least * np.exp(-load) * (1 + load)
    spare = int(np.ceil(few + 3 * np.sqrt(few)))
    return least + spare, spare


def chunk_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Keys under which a set meets its partners: its own band's chunks, and the next band's
    if a set there can link with it."""
    n, keys = len(shingles), []
    tops = band_tops(percent)
    own = int(np.searchsorted(tops, n))
    for band in (own, own + 1):
        if band > own and 100 * n < percent * (tops[own] + 1):
            continue
        chunks, spare = band_chunks(band, percent)
        at = (mixed(shingles, 1000 + band) % np.uint64(chunks)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        count = np.bincount(at, minlength=chunks)
        value = np.zeros(chunks, np.uint64)
        filled = np.flatnonzero(count)
        starts = np.concatenate(([0], np.cumsum(count[filled])[:-1]))
        value[filled] = np.bitwise_xor.reduceat(mixed(shingles, 7)[order], starts)
        weak = count < 2
        use = np.arange(chunks) if weak.sum() > spare else np.flatnonzero(~weak)
        name = mixed(use.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(band), 3)
        keys.append(mixed(name ^ mixed(value[use] + count[use].astype(np.uint64), 11), 13))
    return np.concatenate(keys)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Each shingle flips one of about len(shingles) bits (a power of two, 64 at least)."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    flips = np.bincount((mixed(shingles, 5) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: int, bits: int, to: int) -> int:
    """A sketch of fewer bits: its parts XORed (bit positions are hashes modulo the length)."""
    while bits > to:
        bits //= 2
        sketch = (sketch >> bits) ^ (sketch & ((1 << bits) - 1))
    return sketch


def signatures(words: int, percent: int):
    """Task code: doc_id, tid, text -> doc_id, tid, set size, set identity, parity sketch, chunk keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                sizes, sids, sketches, keys, ends = [], [], [], [], [0]
                for text in batch.column(2).to_pylist():
                    s = shingle_set(text, words, hashes)
                    sizes.append(len(s))
                    sids.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                    sketches.append(parity_sketch(s) if len(s) else None)
                    k = chunk_keys(s, percent) if len(s) else np.empty(0, np.uint64)
                    keys.append(k)
                    ends.append(ends[-1] + len(k))
                flat = pa.array(np.concatenate(keys).view(np.int64)) if keys else pa.array([], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()), pa.array(sketches, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                    ["doc_id", "tid", "n", "sid", "sketch", "keys"])
    return run


class Forest:
    """Union-find over the ids a task has met; starts anew when it holds too many."""

    def __init__(self, most: int = 1_000_000) -> None:
        self.up: dict[int, int] = {}
        self.most = most

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = up[x]
        return x

    def union(self, a: int, b: int) -> None:
        if len(self.up) > self.most:
            self.up.clear()
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def link_table(links: list[tuple[int, int]]) -> pa.RecordBatch:
    a = [min(x) for x in links]
    b = [max(x) for x in links]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def groups_of(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal keys from sorted batches: (key, rows of the other columns)."""
    current, rows = None, []
    for batch in batches:
        names = [n for n in batch.schema.names if n not in keys]
        key_rows = zip(*[batch.column(k).to_pylist() for k in keys])
        for key, row in zip(key_rows, zip(*[batch.column(n).to_pylist() for n in names])):
            if key != current:
                if rows:
                    yield current, rows
                current, rows = key, []
            rows.append(row)
    if rows:
        yield current, rows


def sketch_matrix(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the shortest."""
    words = min(map(len, sketches)) // 8
    out = np.empty((len(sketches), words), np.uint64)
    lengths = np.fromiter(map(len, sketches), np.int64, len(sketches))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        parts = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(len(at), -1, words)
        out[at] = np.bitwise_xor.reduce(parts, axis=1)
    return out


def join_large(rows: list[tuple], percent: int, forest: Forest) -> list[tuple[int, int]]:
    """Spanning joins of a meeting: one sketch against all that are left, in one array step."""
    sids, sizes = [r[0] for r in rows], np.array([r[1] for r in rows])
    sketches, roots = sketch_matrix([r[2] for r in rows]), np.array([forest.find(s) for s in sids])
    alone, waiting, links = np.arange(len(rows)), [], []
    while len(alone):
        if not waiting:
            waiting.append(int(alone[0]))
            alone = alone[1:]
        u = waiting.pop()
        apart = np.bitwise_count(sketches[alone] ^ sketches[u]).sum(axis=1, dtype=np.int64)
        known = roots[alone] == roots[u]
        near = known | (apart <= (100 - percent) * (sizes[alone] + sizes[u]) // (100 + percent))
        links += [(sids[u], sids[v]) for v in alone[near & ~known].tolist()]
        waiting += alone[near].tolist()
        alone = alone[~near]
    for a, b in links:
        forest.union(a, b)
    return links


def join_small(rows: list[tuple], percent: int, forest: Forest) -> list[tuple[int, int]]:
    """The same for a few rows, on plain integers."""
    rest = [(sid, n, int.from_bytes(s, "little"), 8 * len(s)) for sid, n, s in rows]
    waiting, links = [], []
    while rest:
        sid, n, sketch, bits = waiting.pop() if waiting else rest.pop()
        apart = []
        for other in rest:
            o, m, other_sketch, other_bits = other
            near = forest.find(o) == forest.find(sid)
            if not near:
                to = min(bits, other_bits)
                x = folded(sketch, bits, to) ^ folded(other_sketch, other_bits, to)
                if x.bit_count() <= most_different(n + m, percent):
                    forest.union(sid, o)
                    links.append((sid, o))
                    near = True
            (waiting if near else apart).append(other)
        rest = apart
    return links


def meetings(percent: int):
    """Task code: rows sorted by (key, i, j) of sid, n, sketch -> joins of sketches within the bound."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, links = Forest(), []
        for _, rows in groups_of(batches, ("key", "i", "j")):
            if len(rows) > 1:
                links += (join_large if len(rows) > 8 else join_small)(rows, percent, forest)
            if len(links) > 20_000:
                yield link_table(links)
                links = []
        yield link_table(links)
    return run


def verify(percent: int):
    """Task code: rows sorted by (family, i, j) of sid, shingles -> true links, spanning what they connect."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups_of(batches, ("family", "i", "j")):
            found = {sid: np.frombuffer(s, np.uint64) for sid, s in rows}
            sids, sets = list(found), list(found.values())
            sizes = np.array([len(s) for s in sets])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            values, at = np.unique(np.concatenate(sets), return_inverse=True)
            inside = np.zeros(len(values), np.int8)
            alone, links, waiting = np.ones(len(sids), bool), [], []
            while waiting or alone.any():
                if not waiting:
                    waiting.append(int(np.argmax(alone)))
                    alone[waiting[0]] = False
                u = waiting.pop()
                rest = np.flatnonzero(alone)
                if not len(rest):
                    break
                own = at[starts[u]: starts[u] + sizes[u]]
                inside[own] = 1
                common = np.add.reduceat(inside[at].astype(np.int32), starts)[rest]
                inside[own] = 0
                hit = rest[100 * common >= percent * (sizes[u] + sizes[rest] - common)]
                alone[hit] = False
                waiting += hit.tolist()
                links += [(sids[u], sids[v]) for v in hit.tolist()]
            if links:
                yield link_table(links)
    return run


def shingle_rows(words: int):
    """Task code: texts -> sid, shingle set as bytes; a set is given once, if more than one row holds it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, given = WordHashes(), set()
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                sets = {}
                for text in whole.slice(i, 500).column(0).to_pylist():
                    s = shingle_set(text, words, hashes).tobytes()
                    sid = xxhash.xxh3_64_intdigest(s) - (1 << 63)
                    if s and sid not in given:
                        sets[sid] = s
                if len(given) > WORDS_KEPT:
                    given.clear()
                given.update(sets)
                yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), pa.array(list(sets.values()), pa.binary())],
                                                 ["sid", "shingles"])
    return run


def first_row() -> Column:
    """Key of a row, in the order in which the rows of a component come first."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tid")


def in_blocks(rows: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Add i, j: groups of one block stay whole (0, 0); in others each row goes to every pair of
    blocks that holds its own. ``counts`` has a group's number of ``blocks``."""
    b = rows.join(counts.select(key, F.col("blocks").alias("__blocks")), key)
    b = b.withColumn("__own", F.pmod(F.xxhash64("sid"), F.col("__blocks")).cast("int"))
    b = b.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return b.withColumns({"i": F.least("__own", "__other"), "j": F.greatest("__own", "__other")}) \
        .drop("__blocks", "__own", "__other")


def ngram_components(docs: DataFrame, *, words: int = 4, percent: int = 85, id_col: str = "doc_id",
                     text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    return _rows(docs, words, percent, id_col, text_col, block).select("doc_id", "n_shingles", "component_id")


def _rows(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str, block: int) -> DataFrame:
    """One row per document: doc_id, tid, n_shingles, component_id, best (the row of its component that
    comes first; NULL for a document without copies or links)."""
    tasks = tasks_for(docs)
    text = F.col(text_col)
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), text.alias("text"))
    side = stored(pairs.mapInArrow(signatures(words, percent), SIDE), "ngram-side")

    chunks = side.where("n > 0").select("sid", F.explode("keys").alias("key"))
    # Partial aggregation folds a hot key to one row a task, of key and count only. A key of copies of one
    # set counts here too; it is no meeting, which shows once the copies are one.
    shared = stored(chunks.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"), "ngram-shared")
    met = stored(chunks.join(shared, "key").distinct(), "ngram-met")
    members = met.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("members"))
    members = members.where("members > 1").drop("members")
    sketches = side.where("n > 0").groupBy("sid").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    sketches = sketches.join(met.select("sid").distinct(), "sid")
    rows = in_blocks(met, members, "key").join(sketches, "sid")
    maybe = (rows.select("key", "i", "j", "sid", "n", "sketch").repartition(tasks, "key", "i", "j")
             .sortWithinPartitions("key", "i", "j").mapInArrow(meetings(percent), LINKS).distinct())
    families = components(maybe).select(F.col("node").alias("sid"), F.col("component").alias("family"))
    families = stored(families, "ngram-families")

    # Whole sets are needed for the families only: one text of each set is read again.
    one = side.where("n > 0").groupBy("sid").agg(F.min(first_row()).alias("r"), F.first("n").alias("n")).join(families, "sid")
    size = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = one.groupBy("family").agg(size.alias("blocks"))
    one = one.select(F.col("r.doc_id").alias("__id"), F.col("r.tid").alias("__tid"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("tid") == F.col("__tid"))
    texts = pairs.join(one, same, "left_semi").select("text")
    sets = texts.mapInArrow(shingle_rows(words), "sid long, shingles binary").join(families, "sid")
    dealt = in_blocks(sets, sizes, "family").select("family", "i", "j", "sid", "shingles")
    links = (dealt.repartition(tasks, "family", "i", "j").sortWithinPartitions("family", "i", "j")
             .mapInArrow(verify(percent), LINKS))
    linked = components(links).select(F.col("node").alias("sid"), "component")
    return _documents(side, linked)


def _documents(side: DataFrame, linked: DataFrame) -> DataFrame:
    """Back from sets to documents: a component's id is its smallest doc_id."""
    ids = side.where("n > 0").groupBy("sid").agg(F.min(first_row()).alias("least"), F.count("*").alias("copies"))
    named = ids.join(linked, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    # Sets alone with one document name themselves; only the others are looked up.
    group = named.groupBy("component").agg(F.min("least").alias("best"), F.sum("copies").alias("documents"))
    sids = (named.join(group.where("documents > 1"), "component").select("sid", "best"))
    out = side.select("doc_id", "tid", "n", "sid").join(sids, "sid", "left")
    return out.select("doc_id", "tid", F.col("n").alias("n_shingles"), F.coalesce("best.doc_id", "doc_id").alias("component_id"), "best")


def one_of_each(docs: DataFrame, *, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                block: int = BLOCK) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (NULL ids last, then by
    text hash). Rows equal in id and text stay or go together."""
    decided = stored(_rows(docs, words, percent, id_col, text_col, block), "ngram-decisions")
    other = F.col("best").isNotNull() & ~(F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("tid") == F.col("best.tid")))
    gone = decided.where(other).select(F.col("doc_id").alias("__gone"), F.col("tid").alias("__tid")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gone")) & (F.xxhash64(text_col) == F.col("__tid"))
    return docs.join(gone, same, "left_anti")
