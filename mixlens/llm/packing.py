"""Packing token sequences: bounded-space online packing.

Method. Each task keeps at most ``windows`` open sequences of ``size`` tokens. A document
is cut into full sequences and a rest; the rest goes to the fullest open window that it
fits (best fit). If none fits, a new window opens while there is room for one; else the
fullest is filled up with the rest's first tokens and emitted without padding, and what
is left of the rest is placed as before. At the end the open windows of the tasks are merged:
``fan_in`` tasks' windows at a time are packed again in the same way, round by round, until
one task is left, whose open windows are filled up from each other. The last one is cut at
powers of two, which need no padding.

Only the first round sees tokens; merging moves rows of (document, start, length). No task
merges more than ``fan_in * windows`` windows.

Cases: NULL text is empty; every document ends with ``end_id``, so empty ones have one token.
Repeated rows are packed each on its own (``copy_no`` tells rows of one doc_id in one task
apart). Special tokens in a text are encoded as the tokenizer file says. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, stored, task_state

by_value(__name__)

SIZE = 2048
WINDOWS = 32
FAN_IN = 32
END_ID = 1
#: Fixed value: how byte-level BPE files split a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATER = re.compile("[^\\x00-\u024f]")
#: A piece: where it comes from, what it holds, and the sequence and place it lies in.
PIECE = ("doc_id long, copy_no long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long, open boolean, task int, ids binary")
NAMES = [c.split()[0] for c in PIECE.split(", ")]
TYPES = [pa.int64()] * 8 + [pa.bool_(), pa.int32(), pa.binary()]
#: Fixed value: sequence ids of one task in one round.
PER_TASK = 1 << 32
#: Fixed value: task numbers of one round.
PER_ROUND = 1 << 24


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes for U+0100 and up, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of a byte-level BPE file of the ``tokenizers`` library.

    That library's ids define the result; tiktoken gives the same ones several times faster
    where this is provable, which is checked on loading: merges are ranked by the id of their
    token, and every token's own bytes encode to that token. (Then a merge by rank alone is
    always the merge the file lists: two neighbours that make up a token are the last
    state of that token's own encoding, which has one last merge.) Texts with special
    tokens, or with characters past Latin Extended-B, on whose classes the libraries' Unicode
    versions might differ, always go to ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
        self.slow = Tokenizer.from_file(path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = self.ranked(path)

    def ranked(self, path: str):
        import tiktoken

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        if (spec["normalizer"] or spec["model"]["type"] != "BPE" or spec["post_processor"] or spec["model"].get("ignore_merges")
                or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}):
            return None
        vocabulary, letters = spec["model"]["vocab"], byte_letters()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        order = [vocabulary["".join(m)] for m in merges]
        if order != sorted(order) or len(merges) + 256 != len(vocabulary) or min(order) != 256:
            return None
        if any([t.id for t in self.slow.model.tokenize(word)] != [i] for word, i in vocabulary.items()):
            return None
        ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items()}
        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str, end_id: int) -> np.ndarray:
        """Token ids of a text, ``end_id`` last."""
        if self.fast is None or LATER.search(text) or any(x in text for x in self.special):
            ids = np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        else:
            ids = self.fast.encode_to_numpy(text, disallowed_special=())
        return np.append(ids, np.uint32(end_id)).astype(np.uint32, copy=False)


class Packer:
    """Open windows of one task; ``emit`` gets (sequence number, piece, offset, open)."""

    def __init__(self, size: int, windows: int, emit) -> None:
        self.size, self.most, self.emit = size, windows, emit
        self.open: list[list] = []  # each window: [used, sequence number, pieces]
        self.sequences = 0

    def new(self) -> int:
        self.sequences += 1
        return self.sequences - 1

    def close(self, window: list, still_open: bool = False) -> None:
        offset = 0
        for piece, length in window[2]:
            self.emit(window[1], piece, offset, still_open)
            offset += length

    def place(self, piece, length: int, cut) -> None:
        """Place a rest of fewer than ``size`` tokens; ``cut(piece, n)`` splits it after n tokens."""
        while length:
            fitting = [w for w in self.open if w[0] + length <= self.size]
            if fitting:
                best = max(fitting, key=lambda w: w[0])
            elif len(self.open) < self.most:
                best = [0, self.new(), []]
                self.open.append(best)
            else:
                best = max(self.open, key=lambda w: w[0])
                head, piece_left = cut(piece, self.size - best[0])
                best[2].append((head, self.size - best[0]))
                length -= self.size - best[0]
                piece = piece_left
                self.open.remove(best)
                self.close(best)
                continue
            best[2].append((piece, length))
            best[0] += length
            length = 0
            if best[0] == self.size:
                self.open.remove(best)
                self.close(best)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Rows:
    """Rows of pieces gathered into record batches."""

    def __init__(self, task: int, first: int) -> None:
        self.rows: list[tuple] = []
        self.task, self.first = task, first

    def emit(self, sequence: int, piece: tuple, offset: int, still_open: bool) -> None:
        doc_id, copy_no, start, ids, doc_tokens = piece
        self.rows.append((doc_id, copy_no, start, len(ids), crc(ids), doc_tokens, self.first + sequence, offset,
                          still_open, self.task, ids.tobytes() if still_open else None))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [()] * len(NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], NAMES)


def cut_piece(piece: tuple, n: int) -> tuple[tuple, tuple]:
    doc_id, copy_no, start, ids, doc_tokens = piece
    return (doc_id, copy_no, start, ids[:n], doc_tokens), (doc_id, copy_no, start + n, ids[n:], doc_tokens)


def pack_task(tokenizer_path: str, size: int, windows: int, end_id: int):
    """Task code of the first round: doc_id, text -> pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        rows = Rows(task, task * PER_TASK)
        packer, no, kept = Packer(size, windows, rows.emit), 0, task_state()
        encoder = kept[tokenizer_path] = kept.get(tokenizer_path) or Encoder(tokenizer_path)
        for whole in batches:
            for i in range(0, whole.num_rows, 200):
                batch = whole.slice(i, 200)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                    ids = encoder.encode(text, end_id)
                    full = len(ids) // size * size
                    for at in range(0, full, size):
                        rows.emit(packer.new(), (doc_id, no, at, ids[at:at + size], len(ids)), 0, False)
                    if full < len(ids):
                        packer.place((doc_id, no, full, ids[full:], len(ids)), len(ids) - full, cut_piece)
                    no += 1
                if len(rows.rows) > 5000:
                    yield rows.batch()
        for window in packer.open:
            packer.close(window, True)
        yield rows.batch()
    return run


def merge_task(size: int, windows: int, fan_in: int, round_no: int, last: bool):
    """Task code of a merge: open windows of ``fan_in`` tasks, sorted by their group -> pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(group: int, found: list[tuple]) -> pa.RecordBatch:
            rows = Rows(group, (round_no * PER_ROUND + group) * PER_TASK)
            packer = Packer(size, windows, rows.emit)
            for doc_id, copy_no, start, doc_tokens, ids in found:
                ids = np.frombuffer(ids, np.uint32)
                packer.place((doc_id, copy_no, start, ids, doc_tokens), len(ids), cut_piece)
            if last:
                fill_up(packer)
            for window in packer.open:
                packer.close(window, not last)
            return rows.batch()

        current, found = None, []
        for batch in batches:
            d = batch.to_pydict()
            for row in zip(d["doc_id"], d["copy_no"], d["start"], d["doc_tokens"], d["ids"], d["task"]):
                group = row[-1] // fan_in
                if group != current and found:
                    yield finished(current, found)
                    found = []
                current = group
                found.append(row[:-1])
        if found:
            yield finished(current, found)
    return run


def fill_up(packer: Packer) -> None:
    """Fill the open windows from the emptiest until one is left, and cut that at powers of two."""
    while len(packer.open) > 1:
        emptiest = min(packer.open, key=lambda w: w[0])
        packer.open.remove(emptiest)
        packer.most = len(packer.open)
        for piece, length in emptiest[2]:
            packer.place(piece, length, cut_piece)
    for window in packer.open:
        left = [piece for piece, _ in window[2]]
        packer.open = []
        used = window[0]
        while used:
            part = 1 << (used.bit_length() - 1)
            used -= part
            target = [part, packer.new(), []]
            while part:
                n = min(part, len(left[0][3]))
                head, tail = cut_piece(left[0], n)
                target[2].append((head, n))
                part -= n
                left[:1] = [tail] if len(tail[3]) else []
            packer.close(target)


def pack(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         windows: int = WINDOWS, fan_in: int = FAN_IN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, copy_no."""
    pairs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(pairs.mapInArrow(pack_task(tokenizer_path, size, windows, end_id), PIECE), "packing-0")
    parts = (found.agg(F.max("task")).first()[0] or 0) + 1
    if parts >= PER_ROUND:
        raise ValueError("too many partitions for sequence ids")
    done, round_no, groups = [found.where("not open")], 0, parts
    while True:
        round_no, groups = round_no + 1, -(-groups // fan_in)
        merge = merge_task(size, windows, fan_in, round_no, groups <= 1)
        left = found.where("open").withColumn("__group", F.floor(F.col("task") / fan_in))
        # A group is the open windows of fan_in tasks, at most fan_in * windows * size tokens.
        left = left.repartition(max(1, groups), "__group").sortWithinPartitions("__group", "sequence_id", "offset")
        found = stored(left.drop("__group").mapInArrow(merge, PIECE), f"packing-{round_no}")
        done.append(found.where("not open"))
        if groups <= 1:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "copy_no")
