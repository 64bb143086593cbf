"""Approximate nearest neighbours: low-dimensional stable projections in kd-trees.

Method. Largest inner product becomes smallest Euclidean distance by one more coordinate
(``sqrt(M - |x|^2)``, 0 for queries, M the largest squared norm; queries are brought to length
``sqrt(M)``, which leaves their order of points alone and makes distances differ most). Gaussian (2-stable)
projections to ``dims`` numbers keep distances in law: a point at distance d has a projected squared
distance of d^2 times a chi-square variable with ``dims`` degrees of freedom. Points are
verified on the original vectors one after another by growing projected distance, which the kd-tree gives leaf by
leaf; the search stops where the next projected distance squared exceeds the chi-square quantile
``confidence`` times the squared distance of the k-th best so far: an unseen better point would then
have shown up earlier with at least that probability.

On Spark: equal vectors become one point with its ``k + 1`` smallest ids, all that any answer can
need. Points are dealt to cells of a top kd-tree (fitted on a bounded sample of projected
points, so the driver holds at most ``sample / 8`` cells) and large cells to salted blocks of about ``block``
points, each with a kd-tree of its own in one task. Queries visit cells in rounds by growing projected distance:
the nearest, the next 2, the next 4 and so on. Between rounds the stopping test, with the k-th best of all rounds so
far, rules out whole cells, and the search ends when no query has a cell left. In a round a
block is read by one task for every ``chunk_rows`` (``block`` or more) queries that visit it, and by none if no query does.

Cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part. A
shorter vector counts as filled up with zeros. Ties go to the smaller id; NULL ids are
never queries or answers. Repeated rows (id and vector) are one candidate; a query with two
vectors is answered for the first in array order. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, seeded_order, stored

by_value(__name__)

DIMS = 32
CONFIDENCE = 0.94
BLOCK = 8192
LEAF = 32
SAMPLE = 20_000
SEED = 41
#: Queries of one block go to tasks in chunks of about so many bytes, of ``BLOCK`` rows at least.
CHUNK_BYTES = 32_000_000
HITS = "qid long, ids array<long>, score double"


def chi_square(confidence: float, dims: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty's approximation)."""
    z, t = NormalDist().inv_cdf(confidence), 2 / (9 * dims)
    return dims * (1 - t + z * t ** 0.5) ** 3


def projection(width: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(width + 1, dims))


def as_matrix(column, width: int) -> np.ndarray:
    """Vectors of a column as rows, filled up with zeros."""
    rows = column.to_pylist()
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def project(x: np.ndarray, most: float, matrix: np.ndarray) -> np.ndarray:
    """Projections of points (``most``: largest squared norm)."""
    return x @ matrix[:-1] + np.sqrt(np.maximum(0, most - (x * x).sum(1)))[:, None] * matrix[-1]


def of_length(q: np.ndarray, most: float) -> np.ndarray:
    """Queries brought to the length of the longest point: the order of points by inner product stays."""
    return q * np.sqrt(most / (q * q).sum(1))[:, None]


def gaps(z: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``z`` to each box."""
    out = np.zeros((len(z), len(low)))
    for j in range(z.shape[1]):
        side = np.maximum(0, np.maximum(low[:, j] - z[:, j, None], z[:, j, None] - high[:, j]))
        out += side * side
    return out


def split_tree(points: np.ndarray, leaves: int) -> list:
    """Nested [axis, value, low, high]; leaves are numbered from the left. Splits at medians."""
    count = 0

    def build(p: np.ndarray, n: int):
        nonlocal count
        if n > 1 and len(p) > 1:
            axis = int(np.argmax(p.max(0) - p.min(0)))
            value = float(np.median(p[:, axis]))
            low = p[:, axis] < value
            if low.any() and not low.all():
                return [axis, value, build(p[low], n // 2), build(p[~low], n - n // 2)]
        count += 1
        return count - 1

    return build(points, leaves)


def cells(points: np.ndarray, tree) -> np.ndarray:
    """Leaf number of each point."""
    out = np.zeros(len(points), np.int64)

    def walk(at: np.ndarray, node) -> None:
        if isinstance(node, int):
            out[at] = node
        elif len(at):
            low = points[at, node[0]] < node[1]
            walk(at[low], node[2])
            walk(at[~low], node[3])

    walk(np.arange(len(points)), tree)
    return out


class Block:
    """A kd-tree over the projections of one block's points."""

    def __init__(self, ids: list[list[int]], x: np.ndarray, y: np.ndarray, leaf: int) -> None:
        tree = split_tree(y, max(1, 1 << max(0, (len(y) - 1) // leaf).bit_length()))
        at = cells(y, tree)
        order = np.argsort(at, kind="stable")
        self.x, self.y, self.ids = x[order], y[order], [ids[i] for i in order]
        self.first = np.array([i[0] for i in self.ids])
        self.length = (self.y * self.y).sum(1)
        starts = np.flatnonzero(np.concatenate(([True], at[order][1:] != at[order][:-1])))
        self.leaf = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(y))))
        self.low, self.high = np.minimum.reduceat(self.y, starts, axis=0), np.maximum.reduceat(self.y, starts, axis=0)
        self.verified = 0

    def search(self, q: np.ndarray, z: np.ndarray, gap: np.ndarray, bound: float, most: float, k: int, quantile: float) -> np.ndarray:
        """Points that may be among the k best of one query (length ``sqrt(most)``, projection ``z``).

        ``gap``: distance of each leaf; ``bound``: squared distance of the k-th best known. Leaves are
        opened in order; an opened point is verified when no closed leaf can be nearer.
        """
        leaves = np.argsort(gap, kind="stable")
        opened, step, batch = 0, 1 + 4 * k * len(gap) // len(self.x), max(16, 2 * k)
        waiting = np.zeros(0, np.int64)
        best = np.full(k, -np.inf)
        seen, scores = [], []
        away = self.length - 2 * (self.y @ z) + z @ z
        while opened < len(leaves) and gap[leaves[opened]] <= quantile * bound:
            chosen = np.zeros(len(leaves), bool)
            chosen[leaves[opened: opened + step]] = True
            opened, step = opened + step, 4 * step
            # Points beyond the bound can never pass the test, so they need no order.
            points = np.flatnonzero(chosen[self.leaf] & (away <= quantile * bound))
            waiting = np.concatenate([waiting, points])
            far = away[waiting]
            order = np.argsort(far)
            waiting, far = waiting[order], far[order]
            nearest_closed = gap[leaves[opened]] if opened < len(leaves) else np.inf
            # The first k are verified at once, so that there is a bound.
            ready, i = max(int(np.searchsorted(far, nearest_closed, "right")), k if bound == np.inf else 0), 0
            while i < ready:
                stop = min(ready, i + batch, int(np.searchsorted(far, quantile * bound, "right")))  # the stopping test
                if stop <= i:
                    break
                s = self.x.take(waiting[i:stop], axis=0) @ q
                seen.append(waiting[i:stop])
                scores.append(s)
                best = np.partition(np.concatenate([best, s]), -k)[-k:]
                bound = min(bound, max(0.0, 2 * most - 2 * float(best.min())))
                i, batch = stop, 2 * batch
            waiting = waiting[i:]
        if not seen:
            return np.zeros(0, np.int64)
        seen, scores = np.concatenate(seen), np.concatenate(scores)
        self.verified += len(seen)
        return seen[2 * most - 2 * scores <= bound * (1 + 1e-9) + 1e-12 * most]


def search_blocks(width: int, most: float, k: int, confidence: float, seed: int, dims: int, leaf: int):
    """Grouped task code: (key, queries, points) -> hits."""
    def run(key, queries: pa.Table, points: pa.Table) -> pa.Table:
        rows = []
        if queries.num_rows and points.num_rows:
            matrix, quantile = projection(width, dims, seed), chi_square(confidence, dims)
            x = as_matrix(points.column("v"), width)
            block = Block(points.column("ids").to_pylist(), x, project(x, most, matrix), leaf)
            for i in range(0, queries.num_rows, 500):
                some = queries.slice(i, 500)
                q, bound = as_matrix(some.column("v"), width), some.column("bound").to_pylist()
                scaled = of_length(q, most)
                z = scaled @ matrix[:-1]
                gap = gaps(z, block.low, block.high)
                for j, qid in enumerate(some.column("qid").to_pylist()):
                    near = block.search(scaled[j], z[j], gap[j], np.inf if bound[j] is None else bound[j], most, k, quantile)
                    score = (q[j] * block.x[near]).sum(1)
                    order = np.lexsort((block.first[near], -score))[:k]
                    rows += [(qid, block.ids[near[o]], float(score[o])) for o in order]
        a, b, c = zip(*rows) if rows else ((), (), ())
        return pa.table({"qid": pa.array(a, pa.int64()), "ids": pa.array(b, pa.list_(pa.int64())), "score": pa.array(c, pa.float64())})
    return run


def place(width: int, most: float, seed: int, dims: int, tree):
    """Task code: add the cell of each point."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = projection(width, dims, seed)
        for batch in batches:
            y = project(as_matrix(batch.column("v"), width), most, matrix)
            yield batch.append_column("cell", pa.array(cells(y, tree), pa.int64()))
    return run


def cell_boxes(width: int, most: float, seed: int, dims: int):
    """Task code: each batch's boxes of cells in projected space, a row a cell and dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = projection(width, dims, seed)
        for batch in batches:
            if not batch.num_rows:
                continue
            y, cell = project(as_matrix(batch.column("v"), width), most, matrix), batch.column("cell").to_numpy()
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.concatenate(([True], cell[order][1:] != cell[order][:-1])))
            low, high = np.minimum.reduceat(y[order], starts, axis=0), np.maximum.reduceat(y[order], starts, axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(cell[order][starts], dims)), pa.array(np.tile(np.arange(dims), len(starts)).astype(np.int32)),
                 pa.array(low.ravel()), pa.array(high.ravel())], ["cell", "axis", "low", "high"])
    return run


def route(width: int, most: float, seed: int, dims: int, boxes: dict, confidence: float, first: int, count: int):
    """Task code: queries -> a row for each block of the cells in places ``first`` to ``first + count`` of the
    query's order of cells that the test does not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, quantile = projection(width, dims, seed), chi_square(confidence, dims)
        names = ["qid", "v", "bound", "block"]
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                q = of_length(as_matrix(batch.column("v"), width), most)
                kth = np.array([-np.inf if s is None else s for s in batch.column("kth").to_pylist()])
                # The k-th best's inner product belongs to the query's own length.
                bound = np.maximum(0, 2 * most - 2 * kth * np.sqrt(most) / batch.column("length").to_numpy())
                gap = gaps(q @ matrix[:-1], boxes["low"], boxes["high"])
                cell = np.argsort(gap, axis=1, kind="stable")[:, first: first + count]
                row, at = np.nonzero(np.take_along_axis(gap, cell, 1) <= quantile * bound[:, None])
                cell = cell[row, at]
                parts = boxes["parts"][cell]
                row = np.repeat(row, parts)
                part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                block = np.repeat(boxes["cell"][cell], parts) * (1 << 32) + part
                known = pa.array([None if np.isinf(b) else b for b in bound[row]], pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column("qid").take(pa.array(row)), batch.column("v").take(pa.array(row)), known,
                                                  pa.array(block, pa.int64())], names)
    return run


def nearest(vectors: DataFrame, *, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            dims: int = DIMS, confidence: float = CONFIDENCE, block: int = BLOCK, leaf: int = LEAF, sample: int = SAMPLE,
            seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    v = F.transform(F.col(vector_col), lambda c: c.cast("double") + F.lit(0.0))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    valid = (vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
             .where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda c: c != 0)))
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    # Equal vectors: the k + 1 smallest ids are all that can be answers. The first limit runs in each task.
    number = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = valid.distinct().withColumn("n", number).where(F.col("n") <= k + 1)
    points = (few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
              .withColumns({"qid": F.element_at("ids", 1), "norm": norm}))
    points = stored(points, "nearest-points")
    width, most, total = points.agg(F.max(F.size("v")), F.max("norm"), F.count("*")).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    # Bounded sample for the top tree only: at most ``sample`` projected points reach the driver.
    leaves = max(1, min(-(-total // block), sample // 8))
    chosen = points.select("v").orderBy(seeded_order(F.col("qid"), seed)).limit(min(sample, total)).collect() if leaves > 1 else []
    x = np.zeros((len(chosen), width))
    for i, r in enumerate(chosen):
        x[i, : len(r["v"])] = r["v"]
    tree = split_tree(project(x, most, projection(width, dims, seed)), leaves) if leaves > 1 else 0

    schema = "v array<double>, ids array<long>, qid long, cell long"
    placed = stored(points.select("v", "ids", "qid").mapInArrow(place(width, most, seed, dims, tree), schema), "nearest-placed")
    per_cell = placed.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("long").alias("parts"))
    salted = placed.join(F.broadcast(per_cell), "cell").withColumn(
        "block", F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("qid"), "parts")).drop("parts", "cell")
    salted = stored(salted, "nearest-blocks")
    # Boxes of at most ``sample / 8`` cells, ``dims`` rows each.
    box = placed.select("v", "cell").mapInArrow(cell_boxes(width, most, seed, dims), "cell long, axis int, low double, high double")
    box = box.groupBy("cell", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    box = box.join(F.broadcast(per_cell), "cell").orderBy("cell", "axis").collect()
    boxes = {"cell": np.array([r["cell"] for r in box[::dims]], np.int64), "parts": np.array([r["parts"] for r in box[::dims]], np.int64),
             "low": np.array([r["low"] for r in box]).reshape(-1, dims), "high": np.array([r["high"] for r in box]).reshape(-1, dims)}

    asked = valid.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    asked = asked.join(points.select("v", "qid"), "v")  # queries of one vector are answered once
    asked = stored(asked.select(F.col("id").alias("query_id"), "qid", "v"), "nearest-asked")
    queries = stored(asked.groupBy("qid").agg(F.first("v").alias("v")).withColumn("length", F.sqrt(norm)), "nearest-queries")
    chunk_rows = max(block, CHUNK_BYTES // (8 * width))

    def searched(q: DataFrame) -> DataFrame:
        per = q.groupBy("block").agg(F.ceil(F.count("*") / chunk_rows).cast("long").alias("chunks"))
        q = q.join(per, "block").withColumn("chunk", F.pmod(F.xxhash64("qid"), "chunks")).drop("chunks")
        wanted = per.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("c"))
        p = salted.join(wanted, "block").select(F.col("block").alias("b"), "c", "v", "ids")
        return (q.groupBy("block", "chunk").cogroup(p.groupBy("b", "c"))
                .applyInArrow(search_blocks(width, most, k + 1, confidence, seed, dims, leaf), HITS))

    # Rounds of 1, 2, 4 ... cells a query; the k-th best of all rounds bounds the next one.
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("ids")[0])
    found, first, count = None, 0, 1
    while first < len(boxes["cell"]):
        if found is None:
            known = queries.withColumn("kth", F.lit(None).cast("double"))
        else:
            known = queries.join(found.where(F.col("n") == k + 1).select("qid", F.col("score").alias("kth")), "qid", "left")
        routed = known.select("qid", "v", "length", "kth").mapInArrow(
            route(width, most, seed, dims, boxes, confidence, first, count), "qid long, v array<double>, bound double, block long")
        routed = stored(routed, "nearest-routed")
        if routed.isEmpty():
            break
        hits = searched(routed)
        hits = hits if found is None else hits.unionByName(found.drop("n"))
        found = stored(hits.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1), "nearest-found")
        first, count = first + count, 2 * count
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    flat = found.select("qid", F.explode("ids").alias("vec_id"), "score")
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), "vec_id")
    top = stored(flat.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
                 .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("top")), "nearest-top")
    out = asked.select("query_id", "qid").join(top, "qid")
    others = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("query_id")), 1, k)
    return (out.select("query_id", F.posexplode(others).alias("rank", "t"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score")))
