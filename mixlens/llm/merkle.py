"""Merkle dataset manifest: checkpoint and recompute.

Method. A row's leaf is the SHA-256 of its fields, each with its length. The leaves of a group stand in order of id and are
hashed in pairs, level by level, to the group's root (a last node without a partner is hashed alone); the
groups' roots, in order of group, likewise give the root of the table. Only every ``step``-th level is stored:
the nodes between are made inside an aligned subtree of ``2 ** step`` stored nodes, which is one
row of a task, and forgotten again. Proofs go down the same way: a subtree's task has its stored nodes and the path from
its top to the root, makes the missing nodes once more, and gives each of its nodes its siblings and that path.

Places come from ranges of (group, id) that are counted and added up, so one group that holds most rows spreads over many
tasks; a task holds one subtree. The leaves are narrow: texts are read once and never shuffled.

A path lists, from the leaf up, one entry a level: ``l`` or ``r`` and the digest of the sibling on that side, or ``r`` alone
where the node has none. A lone leaf is its group's root, and a lone group's root that of the table.

Cases: a NULL field is ``-``; a NULL group is a group of its own, the first; NULL ids come first. Rows of one id are
ordered by leaf, equal rows have neighbouring leaves and a proof each. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixlens.llm.common import by_value, crc32_sql, stored
from mixlens.llm.ordering import positions

by_value(__name__)

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = 6
NODES = "tree long, size long, pos long, digest string"
TAMPERED_IN = 7


def encoded(value: Column) -> Column:
    """A field of a leaf: its UTF-8 byte count, a colon and its text; NULL is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)), 256)


# ------------------------------------------------------------------ subtrees

def height(size: int) -> int:
    """Levels above the leaves of a tree of ``size`` leaves."""
    return max(0, size - 1).bit_length()


def subtree(digests: list[str], levels: int) -> list[list[str]]:
    """All levels of an aligned subtree, from its stored nodes up."""
    out = [digests]
    for _ in range(levels):
        row = out[-1]
        out.append([hashlib.sha256("".join(row[i:i + 2]).encode()).hexdigest() for i in range(0, len(row), 2)])
    return out


def siblings(levels: list[list[str]], i: int) -> list[str]:
    """Path of stored node ``i`` to the top of its subtree."""
    path = []
    for row in levels[:-1]:
        j = i ^ 1
        path.append("l" + row[j] if j < i else "r" + "".join(row[j:j + 1]))
        i >>= 1
    return path


def top_task(step: int):
    """Task code: subtrees -> their top nodes, the next stored level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, pos, size, nodes = (batch.column(c).to_pylist() for c in ("tree", "block", "size", "nodes"))
            tops = [subtree([n["digest"] for n in of], min(step, height(n0)))[-1][0] for n0, of in zip(size, nodes)]
            sizes = [((n0 - 1) >> step) + 1 for n0 in size]
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int64()), pa.array(sizes, pa.int64()), pa.array(pos, pa.int64()),
                                              pa.array(tops, pa.string())], ["tree", "size", "pos", "digest"])
    return run


def path_column(nodes: pa.StructArray, found: list[list[str]]) -> list[pa.Array]:
    return [pa.array(found, pa.list_(pa.string()))]


def path_task(step: int, names: Sequence[str], out: Callable, out_names: Sequence[str]):
    """Task code: subtrees with the path of their top -> their nodes (``names``) with ``out`` of the nodes and their paths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("tree", "size", "subroot", "path")))
            for (tree, size, subroot, above), of in zip(rows, batch.column("nodes")):
                nodes = of.values
                levels = subtree(nodes.field("digest").to_pylist(), min(step, height(size)))
                found = [siblings(levels, i) + above for i in range(len(nodes))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(nodes), pa.int64()), *map(nodes.field, names), pa.array([subroot] * len(nodes), pa.string()),
                     *out(nodes, found)], ["tree", *names, "subroot", *out_names])
    return run


def folded(digest: str, path: list[str]) -> str:
    """The root that a leaf's digest and path give."""
    for entry in path:
        side, other = entry[0], entry[1:]
        digest = hashlib.sha256((other + digest if side == "l" else digest + other).encode()).hexdigest()
    return digest


def verdict_columns(nodes: pa.StructArray, found: list[list[str]]) -> list[pa.Array]:
    """Digest of each leaf's proof, and the root folded from its altered digest, if it has one, or else its own."""
    given = [b or a for a, b in zip(nodes.field("digest").to_pylist(), nodes.field("altered").to_pylist())]
    proof = [hashlib.sha256("".join(e[1:] for e in path).encode()).hexdigest() for path in found]
    return [pa.array(proof, pa.string()), pa.array(map(folded, given, found), pa.string())]


def _subtrees(nodes: DataFrame, step: int) -> DataFrame:
    """One row for each aligned subtree of at most ``2 ** step`` stored nodes."""
    node = F.struct("pos", *[c for c in nodes.columns if c not in ("tree", "size", "pos")])
    return nodes.groupBy("tree", F.shiftright("pos", step).alias("block")) \
        .agg(F.first("size").alias("size"), F.array_sort(F.collect_list(node)).alias("nodes"))


# ------------------------------------------------------------------ forest

@dataclass(frozen=True)
class Forest:
    """Stored levels of trees (tree, size, pos, digest): ``levels[k]`` is level ``k * step``, the last one their roots."""

    levels: list[DataFrame]
    step: int

    @property
    def roots(self) -> DataFrame:
        return self.levels[-1].select("tree", "digest")


def grow(leaves: DataFrame, step: int = STEP) -> Forest:
    """The stored levels above ``leaves`` (tree, size, pos, digest)."""
    levels, largest = [leaves], leaves.agg(F.max("size")).first()[0] or 0
    for k in range(-(-height(largest) // step)):
        levels.append(stored(_subtrees(levels[-1], step).mapInArrow(top_task(step), NODES), f"merkle-level{k + 1}"))
    return Forest(levels, step)


def paths(forest: Forest, leaves: DataFrame, above: DataFrame, out: Callable = path_column, out_schema: str = "path array<string>") -> DataFrame:
    """``leaves`` (the first level, other columns too) with their subroot and ``out`` of their paths, given the path and
    subroot of the trees' roots (tree, path, subroot)."""
    upper = above.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
    for k in range(max(len(forest.levels) - 2, 0), -1, -1):
        nodes = forest.levels[k] if k else leaves
        names = ["pos", *[c for c in nodes.columns if c not in ("tree", "size", "pos")]]
        found, more = (path_column, "path array<string>") if k else (out, out_schema)
        added = T.StructType.fromDDL(f"subroot string, {more}")
        schema = T.StructType([nodes.schema["tree"], *[nodes.schema[c] for c in names], *added])
        upper = _subtrees(nodes, forest.step).join(upper, ["tree", "block"]).mapInArrow(path_task(forest.step, names, found, added.names[1:]), schema)
        if k:
            upper = stored(upper.select("tree", F.col("pos").alias("block"), "path", "subroot"), f"merkle-paths{k}")
    return upper


@dataclass(frozen=True)
class Manifest:
    """The placed leaves (with the columns they came with), the groups' trees and the tree of their roots."""

    leaves: DataFrame
    groups: Forest
    top: Forest


def manifest(leaves: DataFrame, group_col: str, order: Sequence[str], step: int = STEP) -> Manifest:
    """The manifest of ``leaves``, a table with a column ``digest``."""
    trees = positions(leaves.select(group_col).distinct(), [], [group_col], "merkle-groups")
    trees = stored(trees.select(group_col, F.col("pos").alias("tree"), F.col("size").alias("trees")), "merkle-trees")
    placed = positions(leaves, [group_col], [*order, "digest"], "merkle-ranges", carry=trees.drop("trees"))
    placed = stored(placed.drop(group_col), "merkle-leaves")
    groups = grow(placed.select("tree", "size", "pos", "digest"), step)
    tops = groups.roots.join(trees, "tree").select(F.lit(0).cast("long").alias("tree"), F.col("trees").alias("size"),
                                                   F.col("tree").alias("pos"), "digest")
    return Manifest(placed, groups, grow(stored(tops, "merkle-tops"), step))


def proofs(m: Manifest, out: Callable = path_column, out_schema: str = "path array<string>") -> DataFrame:
    """The leaves with their ``subroot``, ``root`` and ``path`` (or ``out`` of it)."""
    root = m.top.roots.select("tree", F.lit(None).cast("string").alias("subroot"), F.array().cast("array<string>").alias("path"))
    upper = paths(m.top, m.top.levels[0], root).select(F.col("pos").alias("tree"), "path", F.col("digest").alias("subroot"))
    found = paths(m.groups, m.leaves, stored(upper, "merkle-upper"), out, out_schema)
    # One row, the table's root: a proven bound.
    return found.join(F.broadcast(m.top.roots.select(F.col("digest").alias("root"))))


def tree_of(docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
            count_col: str = "n_chars", step: int = STEP) -> Manifest:
    """The manifest of a table; ``altered`` is the leaf of a row tampered with: 1 added to ``count_col`` where the
    CRC-32 of the id divides by ``TAMPERED_IN`` (never where the id is NULL)."""
    altered = leaf([F.col(c) + F.lit(1) if c == count_col else F.col(c) for c in fields])
    tampered = F.crc32(F.col(id_col).cast("string").cast("binary")) % TAMPERED_IN == 0
    leaves = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).alias("grouped"),
                         leaf([F.col(c) for c in fields]).alias("digest"), F.when(tampered, altered).alias("altered"))
    return manifest(stored(leaves, "merkle-digests"), "grouped", ["doc_id"], step)


def audit(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The manifest is made of the documents as they are; then each leaf, or its altered form, is folded with its proof.
    """
    found = proofs(tree_of(docs, **options), verdict_columns, "proof_sha256 string, folded_root string")
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def _field(c: str, add: int = 0) -> str:
    text = f"CAST({c} + {add} AS VARCHAR)" if add else f"CAST({c} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def oracle_sql() -> str:
    """The whole tree in DuckDB: all levels by recursion, siblings by joins, the fold by recursion."""
    leaf_of, other = (" || ".join(_field(c, add if c == "n_chars" else 0) for c in FIELDS) for add in (0, 1))
    return f"""
WITH RECURSIVE leaves AS MATERIALIZED (SELECT doc_id, lang, sha256({leaf_of}) AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % {TAMPERED_IN} = 0 THEN sha256({other}) ELSE sha256({leaf_of}) END AS given FROM documents),
trees AS MATERIALIZED (SELECT lang, n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
    FROM (SELECT lang, count(*) AS n FROM leaves GROUP BY lang)),
placed AS MATERIALIZED (SELECT l.*, t.tree, t.n, row_number() OVER (PARTITION BY t.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM leaves l JOIN trees t ON l.lang IS NOT DISTINCT FROM t.lang),
nodes AS (SELECT tree, 0 AS level, pos, n, leaf AS digest FROM placed
    UNION ALL SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes
    WHERE n > 1 GROUP BY tree, level, pos // 2, n),
held AS MATERIALIZED (SELECT * FROM nodes),
tops AS (SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM trees) AS n, digest FROM held WHERE n = 1
    UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops
    WHERE n > 1 GROUP BY level, pos // 2, n),
above AS MATERIALIZED (SELECT * FROM tops),
path AS MATERIALIZED (
    SELECT p.tree, p.pos, h.level AS step, s.digest AS sibling, (p.pos >> h.level) & 1 AS odd
    FROM placed p JOIN (SELECT DISTINCT tree, level FROM held WHERE n > 1) h ON h.tree = p.tree
    LEFT JOIN held s ON s.tree = p.tree AND s.level = h.level AND s.pos = xor(p.pos >> h.level, 1)
    UNION ALL
    SELECT p.tree, p.pos, 1000 + a.level, s.digest, (p.tree >> a.level) & 1
    FROM placed p CROSS JOIN (SELECT DISTINCT level FROM above WHERE n > 1) a
    LEFT JOIN above s ON s.level = a.level AND s.pos = xor(p.tree >> a.level, 1)),
proof AS MATERIALIZED (SELECT tree, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256,
    list({{'s': sibling, 'odd': odd}} ORDER BY step) AS entries FROM path GROUP BY tree, pos),
fold AS (SELECT p.tree, p.pos, 1 AS k, given AS digest, coalesce(entries, []) AS entries FROM placed p LEFT JOIN proof USING (tree, pos)
    UNION ALL SELECT tree, pos, k + 1, sha256(CASE WHEN entries[k].s IS NULL THEN digest WHEN entries[k].odd = 1
      THEN entries[k].s || digest ELSE digest || entries[k].s END), entries FROM fold WHERE k <= len(entries)),
done AS (SELECT tree, pos, digest AS folded_root FROM fold WHERE k = len(entries) + 1)
SELECT p.doc_id, p.leaf, h.digest AS subroot, r.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = r.digest AS verified
FROM placed p JOIN done USING (tree, pos) LEFT JOIN proof USING (tree, pos) JOIN held h ON h.tree = p.tree AND h.n = 1
CROSS JOIN (SELECT digest FROM above WHERE n = 1) r"""
