"""Conversation structure repair: Hirschberg's divide and conquer over a four-state machine.

Method. A repaired conversation is nothing, or an optional system turn and then pairs of user and assistant: the machine's
states are the start, and after a system, user or assistant turn. Rows are kept, given the role that is due, or deleted,
and empty turns are put in; each edit has its cost. A forward vector holds, for the four states after a row, the least
cost and the rank of the least audit among the four; a backward vector the least cost to the end. Where
they meet mid-conversation, the crossing state is the cheapest, of equals the one with the least audit, and both halves are
solved in the same way: linear space, and no table of back pointers. Audits that end on a row are never
prefixes of one another, so ranks decide ties exactly.

The same solver runs on blocks: a run of rows acts on the four states as a matrix of costs and ranks, and matrices compose.
Conversations of up to ``block`` rows (and ``block_bytes`` bytes of text) are read whole by one task, one at a time. Longer ones
are cut into blocks, the blocks' matrices into blocks of blocks until one is left, and the crossings are handed
down again, so no task holds more than a block. Their last step streams the edits of one conversation in order, since
the digest of the repaired text is sequential; of what it reads it holds the audit only.

Cases: a NULL role or text is one space (such a text is blank), a NULL turn comes first and has no place among the turns, the rows
with a NULL conv_id are one conversation. Rows of one turn are ordered by role, then text. Conversations without rows
have zeros and an empty audit. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, crc32_sql, stored, tasks_for
from mixlens.llm.ordering import null_safe_join, positions

by_value(__name__)

BLOCK = 4096
BLOCK_BYTES = 32 << 20
#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")
FAR = 1 << 60
STATES = range(4)
#: The state that the turn due next leads to, the states that kept rows lead to, and what a state still needs at the end.
DUE = (2, 2, 3, 2)
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDING = ("", "II", "I", "")
ENDING_COSTS = [INSERT * len(e) for e in ENDING]
NAMES = {2: "user", 3: "assistant"}
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROWS = "conv_id long, pos long, part int, role string, text string"
MATRIX = "conv_id long, pos long, costs array<long>, ranks array<int>"


# ------------------------------------------------------------------ the machine

def row_edits(initial: str | None, truncated: bool) -> tuple[list[list[int]], list[list[int]], dict]:
    """(costs, ranks, audits) of a row by state before and after it; initial None: it must go."""
    costs, ranks, audits = [[FAR] * 4 for _ in STATES], [[4] * 4 for _ in STATES], {}
    for s in STATES:
        best, at = {}, s
        for inserts in ("", "I", "II"):
            moves = [("D", at, DELETE)]
            if initial is not None:
                moves.append(("R", DUE[at], REROLE + TRUNCATED * truncated))
                if (at, initial) in KEEPS:
                    moves.append(("K", KEEPS[at, initial], TRUNCATED * truncated))
            for edit, t, cost in moves:
                found = (cost + INSERT * len(inserts), inserts + edit)
                best[t] = min(best.get(t, found), found)
            at = DUE[at]
        for rank, t in enumerate(sorted(best, key=lambda t: best[t][1])):
            costs[s][t], ranks[s][t], audits[s, t] = best[t][0], rank, best[t][1]
    return costs, ranks, audits


KINDS = {(i, cut): row_edits(i, cut) for i in ("s", "u", "a", "", None) for cut in (False, True)}


def kind_of(role: str, blank: bool, duplicate: bool, truncated: bool) -> tuple[str | None, bool]:
    return (None, False) if blank or duplicate else (role[:1] if role[:1] in ("s", "u", "a") else "", truncated)


def forward(items: list, lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least costs after items lo..hi-1 and the ranks of the least audits among the states."""
    cost, rank = [FAR] * 4, [0] * 4
    cost[start] = 0
    for i in range(lo, hi):
        costs, ranks = items[i][0], items[i][1]
        found = [min((cost[s] + costs[s][t], rank[s], ranks[s][t]) for s in STATES) for t in STATES]
        order = sorted(STATES, key=lambda t: found[t][1:] if found[t][0] < FAR else (9, 9))
        cost, rank = [f[0] if f[0] < FAR else FAR for f in found], [order.index(t) for t in STATES]
    return cost, rank


def backward(items: list, lo: int, hi: int, end: int | None) -> list[int]:
    """Least costs from each state before items lo..hi-1 to ``end`` (None: to the end of the conversation)."""
    cost = ENDING_COSTS if end is None else [0 if t == end else FAR for t in STATES]
    for i in range(hi - 1, lo - 1, -1):
        costs = items[i][0]
        cost = [min(costs[s][t] + cost[t] for t in STATES) for s in STATES]
    return cost


def crossings(items: list, start: int, end: int | None) -> list[int]:
    """The states after each item on the cheapest path, of equals the one with the least audit."""
    def meet(lo: int, hi: int, start: int, end: int | None) -> None:
        if hi - lo == 1 and end is not None:
            states[lo] = end
            return
        mid = (lo + hi) // 2 if hi - lo > 1 else hi
        cost, rank = forward(items, lo, mid, start)
        rest = backward(items, mid, hi, end)
        states[mid - 1] = cross = min(STATES, key=lambda s: (cost[s] + rest[s], rank[s]))
        if mid - lo > 1:
            meet(lo, mid, start, cross)
        if mid < hi:
            meet(mid, hi, cross, end)

    states = [0] * len(items)
    if items:
        meet(0, len(items), start, end)
    return states


def composed(items: list) -> tuple[list[list[int]], list[list[int]]]:
    """The matrix of a run of items."""
    rows = [forward(items, 0, len(items), s) for s in STATES]
    return [r[0] for r in rows], [r[1] for r in rows]


def solved(kinds: list[tuple[str | None, bool]]) -> tuple[int, list[str]]:
    """(cost, audit of each row; the last entry ends the conversation) of a whole conversation."""
    items, at, audits, cost = [KINDS[k] for k in kinds], 0, [], 0
    for item, t in zip(items, crossings(items, 0, None)):
        audits.append(item[2][at, t])
        cost, at = cost + item[0][at][t], t
    return cost + ENDING_COSTS[at], [*audits, ENDING[at]]


def replay(audit: str, at: int, role: str, text: str) -> tuple[int, list[tuple[str, str]]]:
    """(state after, repaired turns) of one row's part of the audit."""
    out = []
    for edit in audit:
        if edit == "K":
            at = KEEPS[at, role[:1]]
            out.append((role, text))
        elif edit != "D":
            at = DUE[at]
            out.append((NAMES[at], text if edit == "R" else ""))
    return at, out


# ------------------------------------------------------------------ rows

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the check sum of ``conv_id:turn`` names; those it drops stay, without text, as ``dropped``."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(fate <= 1, F.lit("")).when(fate == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    role = F.when(fate == 4, F.lit("user")).otherwise(plain("role"))
    copies = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                               text.alias("text"), (fate == 0).alias("dropped"), copies.alias("copies"))
    return out.withColumn("copy", F.explode("copies")).drop("copy", "copies")


def as_given(conversations: DataFrame) -> DataFrame:
    """The rows as they are, for use outside the check."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(False).alias("dropped"))


def with_faults(rows: DataFrame) -> DataFrame:
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    return rows.withColumns({"blank": trimmed == "", "cut": ~F.right(trimmed, F.lit(1)).isin(".", "!", "?")})


# ------------------------------------------------------------------ whole conversations

COLUMNS = ("conv_id", "turn", "role", "text", "dropped", "blank", "cut")


def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, rows in order) of each conversation of a sorted partition."""
    current, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in COLUMNS)):
            if rows and row[0] != current:
                yield current, rows
                rows = []
            current = row[0]
            rows.append(row)
    if rows:
        yield current, rows


def faults_of(rows: list[tuple]) -> tuple[list[int], list[tuple[str | None, bool]]]:
    """([gaps, blank, duplicate, truncated, illegal], kinds) of a conversation's rows."""
    seen, counts, kinds = set(), [0, 0, 0, 0, 0], []
    turns = {r[1] for r in rows if r[1] is not None}
    counts[0] = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    for _, _, role, text, _, blank, cut in rows:
        key = hashlib.md5(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()
        again = key in seen
        seen.add(key)
        counts[1] += blank
        counts[2] += again and not blank
        counts[3] += cut and not (blank or again)
        kinds.append(kind_of(role, blank, again, cut))
    counts[4] = sum(a[2][:1] + b[2][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
    return counts, kinds


def line(role: str, text: str) -> bytes:
    return f"{role}:{text}".encode("utf-8", "surrogatepass")


def report_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: sorted rows of whole conversations -> a report row for each."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    out = []
    for conv, rows in whole(batches):
        rows = [r for r in rows if not r[4]]
        counts, kinds = faults_of(rows)
        cost, audits = solved(kinds)
        at, lines = 0, []
        for audit, r in zip(audits, [*rows, (None, None, "", "")]):
            at, turns = replay(audit, at, r[2], r[3])
            lines += [line(*t) for t in turns]
        out.append((conv, *counts, cost, "".join(audits), hashlib.sha256(b"\n".join(lines)).hexdigest()))
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def rows_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: sorted rows of whole conversations -> their repaired turns."""
    for conv, rows in whole(batches):
        rows = [r for r in rows if not r[4]]
        _, audits = solved(faults_of(rows)[1])
        at, out = 0, []
        for pos, (audit, r) in enumerate(zip(audits, [*rows, (None, None, "", "")])):
            at, turns = replay(audit, at, r[2], r[3])
            out += [(conv, pos, part, *t) for part, t in enumerate(turns)]
        if out:
            yield turn_batch(out)


def turn_batch(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", "pos", "part", "role", "text"])


# ------------------------------------------------------------------ long conversations, by blocks

def item_of(row: dict) -> tuple:
    """A row or a stored matrix as an item of the solver."""
    if row.get("costs") is None:
        return KINDS[row["initial"], row["cut"]]
    return [row["costs"][4 * s:4 * s + 4] for s in STATES], [row["ranks"][4 * s:4 * s + 4] for s in STATES]


def grouped_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each block of a partition sorted by (conv_id, block, pos)."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["conv_id"], row["block"]) != key:
                yield rows
                rows = []
            key = (row["conv_id"], row["block"])
            rows.append(row)
    if rows:
        yield rows


def compose_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: the items of blocks -> the blocks' matrices."""
    for rows in grouped_rows(batches):
        costs, ranks = composed([item_of(r) for r in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[0]["conv_id"]], pa.int64()), pa.array([rows[0]["block"]], pa.int64()),
             pa.array([sum(costs, [])], pa.list_(pa.int64())), pa.array([sum(ranks, [])], pa.list_(pa.int32()))], ["conv_id", "pos", "costs", "ranks"])


def descend_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: the items of blocks, with the states before and after the block -> those of each item (after: NULL at
    the end of a conversation)."""
    for rows in grouped_rows(batches):
        before, after = rows[0]["before"], rows[0]["after"]
        ends = crossings([item_of(r) for r in rows], before, after)
        starts = [before, *ends[:-1]]
        if after is None:
            ends = [*ends[:-1], None]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["conv_id"] for r in rows], pa.int64()), pa.array([r["pos"] for r in rows], pa.int64()),
             pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["conv_id", "pos", "before", "after"])


def _blocks(items: DataFrame, block: int) -> DataFrame:
    dealt = items.withColumn("block", F.floor(F.col("pos") / block).cast("long"))
    return dealt.repartition(tasks_for(items), "conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")


def long_edits(rows: DataFrame, block: int) -> DataFrame:
    """The rows of long conversations with ``pos``, ``size``, ``initial``, ``duplicate``, ``before`` and ``after``."""
    placed = stored(positions(rows.where("not dropped"), ["conv_id"], ["turn", "role", "text"], "turns-ranges"), "turns-placed")
    text = [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "text", "role").alias("h2")]
    narrow = placed.select("conv_id", "pos", "size", "role", "blank", "cut", *text)
    first = narrow.groupBy("conv_id", "h1", "h2").agg(F.min("pos").alias("first"))
    start = F.substring("role", 1, 1)
    gone = F.col("blank") | F.col("duplicate")
    narrow = null_safe_join(narrow, first, ["conv_id", "h1", "h2"]).withColumn("duplicate", F.col("pos") > F.col("first"))
    narrow = narrow.select("conv_id", "pos", "duplicate", F.when(~gone, F.when(start.isin("s", "u", "a"), start).otherwise("")).alias("initial"),
                           (F.col("cut") & ~gone).alias("cut"))
    levels = [stored(narrow, "turns-kinds")]
    while not levels[-1].where("pos > 0").isEmpty() or len(levels) == 1:
        levels.append(stored(_blocks(levels[-1], block).mapInArrow(compose_task, MATRIX), f"turns-level{len(levels)}"))
    states = levels[-1].select("conv_id", "pos", F.lit(0).alias("before"), F.lit(None).cast("int").alias("after"))
    for items in levels[-2::-1]:
        above = states.withColumnRenamed("pos", "block")
        dealt = null_safe_join(items.withColumn("block", F.floor(F.col("pos") / block).cast("long")), above, ["conv_id", "block"])
        dealt = dealt.repartition(tasks_for(items), "conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
        states = stored(dealt.mapInArrow(descend_task, "conv_id long, pos long, before int, after int"), "turns-states")
    kinds = levels[0].select("conv_id", "pos", "initial", "duplicate", F.col("cut").alias("kept_cut"))
    return null_safe_join(null_safe_join(placed, kinds, ["conv_id", "pos"]), states, ["conv_id", "pos"])


def audit_of(row: dict) -> tuple[str, int]:
    """(part of the audit, cost) of a row of a long conversation; the last row's part ends the conversation."""
    costs, ranks, audits = KINDS[row["initial"], row["kept_cut"]]
    s, t, ending = row["before"], row["after"], ""
    if t is None:
        t = min(STATES, key=lambda t: (costs[s][t] + ENDING_COSTS[t], ranks[s][t]))
        ending = ENDING[t]
    return audits[s, t] + ending, costs[s][t] + INSERT * len(ending)


def long_report_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: rows of long conversations, sorted by (conv_id, pos) -> (conv_id, illegal, cost, audit, repaired_sha256).
    Rows are streamed; only the audit is held."""
    def done() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        row = (conv, illegal, cost, b"".join(audit).decode(), sha.hexdigest())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["conv_id", "illegal", "cost", "audit", "repaired_sha256"])

    begun, conv = False, None
    for batch in batches:
        for row in batch.to_pylist():
            if not begun or row["pos"] == 0:
                if begun:
                    yield done()
                begun, conv, illegal, cost, audit, sha, lines, last = True, row["conv_id"], 0, 0, [], hashlib.sha256(), 0, None
            part, more = audit_of(row)
            for turn in replay(part, row["before"], row["role"], row["text"])[1]:
                sha.update(b"\n" * (lines > 0) + line(*turn))
                lines += 1
            illegal += last is not None and last + row["role"][:1] not in LEGAL
            cost, last = cost + more, row["role"][:1]
            audit.append(part.encode())
    if begun:
        yield done()


def long_rows_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: rows of long conversations, in any order -> their repaired turns."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            turns = replay(audit_of(row)[0], row["before"], row["role"], row["text"])[1]
            out += [(row["conv_id"], row["pos"], part, *t) for part, t in enumerate(turns)]
        if out:
            yield turn_batch(out)


# ------------------------------------------------------------------ plans

def _split(rows: DataFrame, block: int, block_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of conversations that fit a task, those of the longer ones if there are any)."""
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text").cast("long") + 100).alias("bytes"))
    over = stored(sizes.where((F.col("rows") > block) | (F.col("bytes") > block_bytes)).select(F.col("conv_id").alias("__long")), "turns-long")
    if over.isEmpty():
        return rows, None
    is_long = F.col("conv_id").eqNullSafe(F.col("__long"))
    return rows.join(over, is_long, "left_anti"), rows.join(over, is_long, "left_semi")


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.select(*COLUMNS).repartition(tasks_for(rows), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


_LONG = ("conv_id", "pos", "role", "text", "initial", "kept_cut", "before", "after")


def report(rows: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, dropped): its faults, cost, audit and digest."""
    rows = with_faults(rows)
    short, longer = _split(rows, block, block_bytes)
    out = _sorted(short).mapInArrow(report_task, REPORT)
    if longer is None:
        return out
    edits = stored(long_edits(longer, block), "turns-edits")
    flag = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    counts = edits.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"), flag(F.col("blank")).alias("blank"),
        flag(F.col("duplicate") & ~F.col("blank")).alias("duplicate"), flag(F.col("kept_cut")).alias("truncated"))
    streamed = edits.select(*_LONG).repartition(tasks_for(rows), "conv_id").sortWithinPartitions("conv_id", "pos")
    streamed = streamed.mapInArrow(long_report_task, "conv_id long, illegal long, cost long, audit string, repaired_sha256 string")
    found = null_safe_join(counts, streamed, ["conv_id"]).select(*out.columns)
    # Conversations of dropped rows only.
    all_long = longer.select("conv_id").distinct().withColumnRenamed("conv_id", "__all")
    named = all_long.join(found, F.col("__all").eqNullSafe(F.col("conv_id")) & F.col("audit").isNotNull(), "left")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in out.columns[1:-2]}
    return out.unionByName(named.select(F.col("__all").alias("conv_id"), *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
                                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))


def repaired(rows: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The repaired turns (conv_id, pos, part, role, text); a conversation's order is that of (pos, part)."""
    rows = with_faults(rows)
    short, longer = _split(rows, block, block_bytes)
    out = _sorted(short).mapInArrow(rows_task, ROWS)
    if longer is None:
        return out
    return out.unionByName(long_edits(longer, block).select(*_LONG).mapInArrow(long_rows_task, ROWS))


ORACLE_SQL = f"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate FROM conversations),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM given)),
hurt AS (SELECT c, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE WHEN fate = 1 THEN ''
    WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM given g JOIN convs ON g.conv_id IS NOT DISTINCT FROM convs.conv_id WHERE fate > 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM hurt),
marked AS (SELECT *, trimmed = '' AS blank, trimmed <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS duplicate,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) AS pair FROM placed),
rows AS MATERIALIZED (SELECT *, blank OR duplicate AS gone, NOT blank AND NOT duplicate AND right(trimmed, 1) NOT IN ('.', '!', '?') AS cut FROM marked),
moves(s, m, ins) AS (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'), (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')),
edits(m, t, edit, price, initial) AS (SELECT m, m, 'D', 4, CAST(NULL AS VARCHAR) FROM range(4) r(m) UNION ALL SELECT m, CASE m WHEN 2 THEN 3 ELSE 2 END, 'R', 3, NULL
    FROM range(4) r(m) UNION ALL VALUES (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'), (3, 2, 'K', 0, 'u')),
walk AS (SELECT c, 0 AS i, 0 AS s, {{'cost': 0, 'audit': ''}} AS best FROM convs
    UNION ALL SELECT w.c, w.i + 1, e.t, min({{'cost': CAST(w.best.cost + 3 * length(ins) + price + CASE WHEN cut AND edit <> 'D' THEN 3 ELSE 0 END AS INTEGER),
      'audit': w.best.audit || ins || edit}})
    FROM walk w JOIN rows r ON r.c = w.c AND r.i = w.i + 1 JOIN moves ON moves.s = w.s JOIN edits e ON e.m = moves.m
      AND (edit = 'D' OR NOT gone) AND (e.initial IS NULL OR e.initial = left(role, 1))
    GROUP BY w.c, w.i, e.t),
lasts AS (SELECT c, count(*) AS n FROM rows GROUP BY c),
ends(s, ending) AS (VALUES (0, ''), (1, 'II'), (2, 'I'), (3, '')),
found AS MATERIALIZED (SELECT w.c, min({{'cost': w.best.cost + 3 * length(ending), 'audit': w.best.audit || ending}}) AS best
    FROM walk w JOIN ends ON ends.s = w.s LEFT JOIN lasts l ON l.c = w.c WHERE w.i = coalesce(l.n, 0) GROUP BY w.c),
played AS (SELECT c, 0 AS k, 0 AS s, 0 AS i, CAST(NULL AS VARCHAR) AS line FROM found
    UNION ALL SELECT p.c, k + 1, CASE e WHEN 'D' THEN s WHEN 'K' THEN CASE left(r.role, 1) WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
      ELSE CASE s WHEN 2 THEN 3 ELSE 2 END END, CASE e WHEN 'I' THEN p.i ELSE p.i + 1 END,
      CASE e WHEN 'D' THEN NULL WHEN 'K' THEN r.role || ':' || r.text
        ELSE CASE s WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || CASE e WHEN 'R' THEN r.text ELSE '' END END
    FROM (SELECT q.*, substr(f.best.audit, k + 1, 1) AS e FROM played q JOIN found f ON f.c = q.c WHERE k < length(f.best.audit)) p
    LEFT JOIN rows r ON r.c = p.c AND r.i = p.i + 1),
texts AS (SELECT c, string_agg(line, chr(10) ORDER BY k) AS text FROM played GROUP BY c),
counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, f.best.cost AS cost, f.best.audit AS audit, sha256(coalesce(text, '')) AS repaired_sha256
FROM convs JOIN found f USING (c) LEFT JOIN counts USING (c) LEFT JOIN texts USING (c)"""
