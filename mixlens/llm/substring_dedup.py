"""Substring dedup by content-defined chunks: shared chunks lead to repeated passages, bytes decide their extent.

Method. Runs of white space count as one space. A gear hash rolls over the text; a chunk ends where the hash of the last
32 bytes has ``MASK_BITS`` zero bits (or after ``MAX_BYTES``), so the same passage is cut alike whatever stands before it, and an
insertion changes the chunks around it only. Chunks of ``MIN_BYTES`` or more are deduplicated by digest: one that two
documents share is a repeat, and the document of smallest id that holds it keeps it. Where another document holds it,
both texts are compared byte by byte from the shared chunk on, in both directions, and what is equal, in whole words, is
the repeated passage. Passages of at least ``min_words`` words are removed; shorter ones (stock phrases, short lines) stay.

A passage is found by any one whole chunk of it. Chunks travel as digests with their place; texts only once the digests say that
a long enough passage is possible: a chunk that the others do not hold bounds a repeat, so few words between two such chunks
settle it. A document that many others repeat sends its text to blocks of ``BLOCK`` of them, so no task
holds an unbounded group, and they are compared one at a time.

Cases: words are split at ASCII white space, whose kind and number do not matter; NULL or empty texts have
no words and no spans. Repeats inside one document are left alone, as are those between rows of
one doc_id. Spans are byte offsets into the UTF-8 text, from the start of a word to the end of one.
Rows with a NULL id keep their text. Equal rows have equal spans. Empty tables give no rows; other columns are kept by
``without_repeats``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, stored, tasks_for

by_value(__name__)

MIN_BYTES, MAX_BYTES, MASK_BITS = 16, 256, 5
MIN_WORDS = 51
WINDOW = 32
GEAR_SEED = 61
BLOCK = 256
CHUNKS = "doc_id long, tid long, n_bytes long, n_chunks int, n_words int, digests array<long>, starts array<int>, words array<int>"
MATCHES = "doc_id long, tid long, f_id long, f_tid long, matches array<struct<at:int,f_at:int>>"
EXTENT = "struct<first:int,after:int,start:int,end:int>"
SPAN = "array<struct<start:int,end:int,words:long>>"


def gear_hashes(a: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Gear hash of the 32 bytes up to each position: sum of gear[byte] << distance, by doubling."""
    h = gear[a]
    for shift in (1, 2, 4, 8, 16):
        h[shift:] = h[shift:] + (h[:-shift] << np.uint32(shift))
    return h


def plain(text: str | None) -> bytes:
    """The text's bytes with one space for each run of white space, none at the ends."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def chunks(texts: list[str | None]) -> list[tuple[bytes, np.ndarray]]:
    """Per text: its plain bytes, and where its chunks begin and the last one ends."""
    gear = np.random.default_rng(GEAR_SEED).integers(0, 1 << 32, 256, dtype=np.uint32)
    raw = [plain(t) for t in texts]
    gap = b"\0" * WINDOW  # empties the window between texts
    a = np.frombuffer(gap + gap.join(raw) + gap, np.uint8)
    hit = np.flatnonzero((gear_hashes(a, gear) >> np.uint32(32 - MASK_BITS)) == 0) + 1
    out, at = [], WINDOW
    for r in raw:
        low, high = np.searchsorted(hit, (at + 1, at + len(r)))
        ends = np.concatenate(([0], hit[low:high] - at, [len(r)] if r else []))
        sizes = np.diff(ends)
        if len(sizes) and sizes.max() > MAX_BYTES:
            cuts = [np.arange(s, e, MAX_BYTES) for s, e in zip(ends[:-1], ends[1:])]
            ends = np.concatenate([*cuts, ends[-1:]])
        out.append((r, ends.astype(np.int32)))
        at += len(r) + WINDOW
    return out


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the words' starts and ends."""
    a = np.frombuffer(raw, np.uint8)
    space = (a == 0x20) | ((a >= 0x09) & (a <= 0x0D))
    turns = np.flatnonzero(np.diff(space, prepend=True, append=True))
    return turns[::2], turns[1::2]


def chunk_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: doc_id, tid, text -> the places and digests of each text's chunks of ``MIN_BYTES`` or more."""
    for whole in batches:
        for i in range(0, whole.num_rows, 200):
            batch = whole.slice(i, 200)
            digests, starts, words, ends, sizes, counts = [], [], [], [0], [], []
            texts = batch.column("text").to_pylist()
            for raw, bounds in chunks(texts):
                large = np.flatnonzero(np.diff(bounds) >= MIN_BYTES)
                begin, end = bounds[large], bounds[large + 1]
                digests.append(np.fromiter((xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(begin.tolist(), end.tolist())), np.uint64, len(large)))
                spaces = np.cumsum(np.frombuffer(raw, np.uint8) == 0x20, dtype=np.int32)
                starts.append(begin)
                words.append(spaces[begin])
                ends.append(ends[-1] + len(large))
                sizes.append(int(spaces[-1]) + 1 if raw else 0)
                counts.append(max(0, len(bounds) - 1))
            at = pa.array(ends, pa.int32())
            bytes_ = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(x).view(t))) for x, t in
                     ((digests, np.int64), (starts, np.int32), (words, np.int32))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tid"), pa.array(bytes_, pa.int64()), pa.array(counts, pa.int32()), pa.array(sizes, pa.int32()), *lists],
                ["doc_id", "tid", "n_bytes", "n_chunks", "n_words", "digests", "starts", "words"])


def possible(starts: np.ndarray, words: np.ndarray, n_words: int, held: np.ndarray, min_words: int) -> np.ndarray:
    """Which of a text's chunks (``held``: by an earlier document too) can lie in a repeat of ``min_words`` words.

    A repeat cannot hold a chunk that is not held and the 32 bytes before it, so it ends before the end of the next
    such chunk, and begins at most 32 bytes (16 words) before the start of the last one.
    """
    bars = np.flatnonzero(~held)
    before, after = np.searchsorted(bars, np.arange(len(held))), np.searchsorted(bars, np.arange(len(held)), "right")
    low = np.where(before > 0, words[bars[np.maximum(before - 1, 0)]] - WINDOW // 2, 0) if len(bars) else np.zeros(len(held), int)
    past = np.append(words[1:], n_words)  # words up to the next chunk's start
    high = np.where(after < len(bars), past[bars[np.minimum(after, len(bars) - 1)]], n_words) if len(bars) else np.full(len(held), n_words)
    return held & (high + 1 - low >= min_words)


def match_task(min_words: int):
    """Task code: a text's chunks and those that earlier documents hold -> per earlier document where to compare."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                doc_id, tid, n_words = (batch.column(c)[row].as_py() for c in ("doc_id", "tid", "n_words"))
                starts, words = (batch.column(c)[row].values.to_numpy() for c in ("starts", "words"))
                found = batch.column("found")[row].values
                at = found.field("at").to_numpy()
                may = dict(zip(starts.tolist(), possible(starts, words, n_words, np.isin(starts, at), min_words).tolist()))
                of = defaultdict(list)
                for a, f_id, f_tid, f_at in zip(*(found.field(c).to_pylist() for c in ("at", "f_id", "f_tid", "f_at"))):
                    if may[a]:
                        of[f_id, f_tid].append({"at": a, "f_at": f_at})
                out += [(doc_id, tid, *f, sorted(m, key=lambda x: x["at"])) for f, m in of.items()]
            types = [pa.int64()] * 4 + [pa.list_(pa.struct([("at", pa.int32()), ("f_at", pa.int32())]))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                                             ["doc_id", "tid", "f_id", "f_tid", "matches"])
    return run


def equal_run(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal values at the start of both, found in growing steps."""
    n, at, step = min(len(a), len(b)), 0, 512
    while at < n:
        differ = np.flatnonzero(a[at:min(n, at + step)] != b[at:min(n, at + step)])
        if len(differ):
            return at + int(differ[0])
        at, step = at + step, 4 * step
    return n


def extents(a: np.ndarray, b: np.ndarray, matches: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Runs of whole words [first, after) of ``a`` (word bounds ``starts``, ``ends``) that stand in ``b`` around the matches."""
    out, done = set(), {}
    for p, q in matches:
        if p < done.get(p - q, 0):
            continue  # inside the last extent of this alignment
        low = equal_run(a[:p][::-1], b[:q][::-1])
        high = equal_run(a[p:], b[q:])
        done[p - q] = p + high
        begin, end, shift = p - low, p + high, q - p
        i, j = int(np.searchsorted(starts, begin)), int(np.searchsorted(ends, end, "right"))
        # A word at the edge counts only if it is a whole one in both texts.
        if i < j and starts[i] == begin and begin + shift > 0 and b[begin + shift - 1] != 0x20:
            i += 1
        if i < j and ends[j - 1] == end and end + shift < len(b) and b[end + shift] != 0x20:
            j -= 1
        if j - i >= min_words:
            out.add((i, j))
    return sorted(out)


def extent_task(min_words: int):
    """Task code: rows sorted by (f_id, f_tid, block), the earlier document's text first -> extents of the others' repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, b = None, None
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("f_id", "f_tid", "block", "doc_id", "tid")]
            for r, (f_id, f_tid, block, doc_id, tid) in enumerate(zip(*columns)):
                text = batch.column("text")[r].as_py()
                if doc_id is None:
                    if key != (f_id, f_tid, block):
                        key, b = (f_id, f_tid, block), np.frombuffer(plain(text), np.uint8)
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                short = plain(text)
                matches = batch.column("matches")[r].values
                at = zip(matches.field("at").to_pylist(), matches.field("f_at").to_pylist())
                found = extents(np.frombuffer(short, np.uint8), b, list(at), *word_bounds(short), min_words)
                if found:
                    starts, ends = word_bounds(raw)
                    rows += [(doc_id, tid, {"first": i, "after": j, "start": int(starts[i]), "end": int(ends[j - 1])}) for i, j in found]
            kind = pa.struct([(c, pa.int32()) for c in ("first", "after", "start", "end")])
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), kind))],
                                             ["doc_id", "tid", "extent"])
    return run


def span_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: a document's extents -> its spans, overlapping and touching extents in one."""
    for batch in batches:
        out = []
        for found in batch.column("extents").to_pylist():
            spans = []
            for x in sorted(found, key=lambda x: (x["first"], x["after"])):
                if spans and x["first"] <= spans[-1]["after"]:
                    if x["after"] > spans[-1]["after"]:
                        spans[-1] |= {"after": x["after"], "end": x["end"]}
                else:
                    spans.append(dict(x))
            out.append([{"start": x["start"], "end": x["end"], "words": x["after"] - x["first"]} for x in spans])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), pa.array(out, kind)], ["doc_id", "tid", "spans"])


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, tid (hash of its text), n_bytes, n_chunks, spans (the passages to remove)."""
    text = F.col(text_col)
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), text.alias("text"))
    table = stored(pairs.mapInArrow(chunk_task, CHUNKS), "substring-chunks")
    named = table.where("doc_id is not null")
    one = named.select("doc_id", "tid", F.explode(F.arrays_zip("digests", "starts")).alias("c"))
    one = one.select("doc_id", "tid", F.col("c.digests").alias("digest"), F.col("c.starts").alias("at"))
    shared = one.groupBy("digest").agg(F.min("doc_id").alias("f_id"), F.max("doc_id").alias("last")).where("f_id < last")
    shared = stored(shared.select("digest", "f_id"), "substring-shared")
    met = stored(one.join(shared, "digest"), "substring-met")
    firsts = met.where("doc_id = f_id").groupBy("digest").agg(F.min(F.struct("tid", "at")).alias("f"))
    later = met.where("doc_id > f_id").join(firsts, "digest")
    found = later.groupBy("doc_id", "tid").agg(
        F.collect_set(F.struct("at", "f_id", F.col("f.tid").alias("f_tid"), F.col("f.at").alias("f_at"))).alias("found"))
    places = named.select("doc_id", "tid", "n_words", "starts", "words").dropDuplicates(["doc_id", "tid"])
    matches = stored(found.join(places, ["doc_id", "tid"]).mapInArrow(match_task(min_words), MATCHES), "substring-matches")

    # Texts go where they are compared: a document to each earlier one it may repeat, an earlier one to its blocks.
    sizes = matches.groupBy("f_id", "f_tid").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id", "tid"), F.col("blocks")).cast("int")
    asked = matches.join(sizes, ["f_id", "f_tid"]).select(
        F.col("doc_id").alias("__id"), F.col("tid").alias("__tid"), "f_id", "f_tid", own.alias("block"), "matches", F.lit(1).alias("role"))
    given = sizes.select(F.col("f_id").alias("__id"), F.col("f_tid").alias("__tid"), "f_id", "f_tid",
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"))
    wanted = asked.unionByName(given, allowMissingColumns=True)
    texts = pairs.where("doc_id is not null").join(wanted, (F.col("doc_id") == F.col("__id")) & (F.col("tid") == F.col("__tid")))
    later_only = F.col("role") == 1
    texts = texts.select("f_id", "f_tid", "block", "role", F.when(later_only, F.col("doc_id")).alias("doc_id"), "tid", "text", "matches")
    dealt = texts.repartition(tasks_for(docs), "f_id", "f_tid", "block").sortWithinPartitions("f_id", "f_tid", "block", "role")
    pieces = dealt.mapInArrow(extent_task(min_words), f"doc_id long, tid long, extent {EXTENT}")
    pieces = pieces.groupBy("doc_id", "tid").agg(F.collect_set("extent").alias("extents"))
    spans = stored(pieces.mapInArrow(span_task, f"doc_id long, tid long, spans {SPAN}"), "substring-found")
    out = table.select("doc_id", "tid", "n_bytes", "n_chunks").join(spans, ["doc_id", "tid"], "left")
    return out.withColumn("spans", F.coalesce("spans", F.array().cast(SPAN)))


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated passages cut out of the texts."""
    spans = stored(repeated_spans(docs, id_col=id_col, text_col=text_col, **options).where(F.size("spans") > 0), "substring-spans")
    names, at = docs.columns, docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
                if text is not None and found:
                    raw, kept, last = text.encode("utf-8", "surrogatepass"), [], 0
                    for s in found:
                        kept.append(raw[last:s["start"]])
                        last = s["end"]
                    text = b"".join([*kept, raw[last:]]).decode("utf-8", "surrogatepass")
                texts.append(text)
            columns = [pa.array(texts, batch.column(at).type) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    found = spans.select(F.col("doc_id").alias("__id"), F.col("tid").alias("__tid"), F.col("spans").alias("__spans")).distinct()
    same = (F.col(id_col).cast("long") == F.col("__id")) & (F.xxhash64(text_col) == F.col("__tid"))
    return docs.join(found, same, "left").select(*names, "__spans").mapInArrow(cut, docs.schema)
