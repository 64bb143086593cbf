"""Quality classifier: attention-based multiple-instance learning.

Method. A document is a bag of passages of ``PASSAGE_WORDS`` words, its whole text. A passage is
encoded from its bytes and words (shares of byte classes and hashed byte pairs, word shape
and repetition). Document labels train, in one network, an encoder layer ``h = tanh(W x)``,
gated attention ``a = softmax(w . (tanh(V h) * sigmoid(U h)))`` over the passages and a
logistic output on the weighted passage representation ``sum a h``.

Only the fit is bounded: at most ``per_class`` labelled documents a class, in seeded order,
and of a training document at most ``bag_passages`` passages spread over it; class weights
restore the classes' true shares. Every document is scored on all its passages. The fit runs on the
driver on these few megabytes; scoring is one pass over the texts, without a shuffle.

Cases: a NULL or empty text is one passage without words and gets that passage's score. Rows
with NULL labels or ids teach nothing; a document with several labels counts by the largest. Repeated
rows are scored alike; of rows that share an id one teaches. With labels of one class only every score is that class; without
any label it is 1. Empty tables give no rows; other columns are ignored, or kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, held_out_column, seeded_order, stored

by_value(__name__)

PASSAGE_WORDS = 96
PER_CLASS = 3000
BAG_PASSAGES = 32
THRESHOLD = 0.7
SEED = 29
PAIRS = 32
CLASSES = 12
WORD_FEATURES = 10
FEATURES = CLASSES + PAIRS + WORD_FEATURES
HIDDEN, GATE = 24, 12


def byte_classes() -> np.ndarray:
    """Class of each byte: white space 0-2, letters 3-4, digits 5, marks 6-8, non-ASCII 9-10, rest 11."""
    c = np.full(256, 11, np.int64)
    c[0x20], c[0x0A], c[[0x09, 0x0B, 0x0C, 0x0D]] = 0, 1, 2
    c[0x61:0x7B], c[0x41:0x5B], c[0x30:0x3A] = 3, 4, 5
    for k, marks in ((6, b".,;:?!"), (7, b"'\"()-"), (8, b"#$%&*+/<=>@[\\]^_`{|}~")):
        c[list(marks)] = k
    c[0xC0:], c[0x80:0xC0] = 9, 10
    return c


def passages(texts: list[str | None], words: int = PASSAGE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(encodings, one row a passage; number of passages of each text)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    a = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    sizes = np.array([len(r) + 1 for r in raw])
    doc_at = np.cumsum(sizes) - sizes
    cls = byte_classes()[a]
    inside = cls > 2
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    word_doc = np.searchsorted(doc_at, starts, side="right") - 1
    per_doc = np.bincount(word_doc, minlength=len(raw))
    bags = np.maximum(1, -(-per_doc // words))
    base = np.cumsum(bags) - bags
    number = np.arange(len(starts)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    word_bag = base[word_doc] + number // words
    total = int(bags.sum())
    out = np.zeros((total, FEATURES))
    if len(starts):
        # White space belongs to the word before it in the same document; the rest of it is left out.
        byte_word = np.cumsum(np.bincount(starts, minlength=len(a)))[: len(a)] - 1
        ends = doc_at[word_doc] + sizes[word_doc] - 1
        own = (byte_word >= 0) & (np.arange(len(a)) < ends[byte_word])
        byte_bag = word_bag[byte_word]
        out[:, :CLASSES] = np.bincount((byte_bag * CLASSES + cls)[own], minlength=total * CLASSES).reshape(total, CLASSES)
        pair = (a[:-1].astype(np.int64) * 37 + a[1:].astype(np.int64) * 101) % 1009 % PAIRS
        both = own[:-1] & own[1:]
        out[:, CLASSES:CLASSES + PAIRS] = np.bincount((byte_bag[:-1] * PAIRS + pair)[both], minlength=total * PAIRS).reshape(total, PAIRS)
        chars = np.maximum(1, out[:, :CLASSES].sum(1, keepdims=True))
        out[:, :CLASSES + PAIRS] /= chars
        out[:, CLASSES + PAIRS:] = word_shapes(a, cls, starts, inside, byte_word, word_bag, total)
    return out, bags


def word_shapes(a, cls, starts, inside, byte_word, word_bag, total) -> np.ndarray:
    """Per passage: count, length, spread, repeats, distinct, and shares of word forms."""
    count = np.bincount(word_bag, minlength=total)
    n = np.maximum(1, count)

    def share(values) -> np.ndarray:
        return np.bincount(word_bag, weights=values, minlength=total) / n

    length = np.add.reduceat(inside.astype(np.int64), starts)
    place = np.clip(np.arange(len(a)) - starts[byte_word], 0, 63)
    rng = np.random.default_rng(SEED)
    code = rng.integers(1, 1 << 62, 256, dtype=np.uint64) | np.uint64(1)
    power = rng.integers(1, 1 << 62, 64, dtype=np.uint64) | np.uint64(1)
    name = np.add.reduceat(np.where(inside, code[a] * power[place], np.uint64(0)), starts)
    same_bag = word_bag[1:] == word_bag[:-1]
    again = np.concatenate(([0.0], (name[1:] == name[:-1]) & same_bag))
    key = name ^ (word_bag.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    new = np.zeros(len(starts))
    new[first] = 1
    last = cls[starts + length - 1]
    upper = np.add.reduceat((cls == 4).astype(np.int64), starts)
    digits = np.add.reduceat((cls == 5).astype(np.int64), starts)
    marks = np.add.reduceat(((cls >= 6) & (cls <= 8)).astype(np.int64), starts)
    mean = share(length)
    spread = np.sqrt(np.maximum(0, share(length.astype(float) ** 2) - mean ** 2))
    return np.stack([np.log1p(count), np.log1p(mean), np.log1p(spread), share(again), share(new), share(cls[starts] == 4),
                     share(upper == length), share(digits > 0), share(last >= 6), share(marks == length)], axis=1)


class Network:
    """Gated-attention network on bags; parameters are plain arrays."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)

        def normal(*shape) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.mean, self.scale = mean, scale
        self.p = {"W": normal(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": normal(HIDDEN, GATE), "U": normal(HIDDEN, GATE),
                  "w": normal(GATE), "c": normal(HIDDEN), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, bags: np.ndarray) -> tuple[np.ndarray, dict]:
        """Logit of each bag; x holds the bags' passages one after the other."""
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        at = np.cumsum(bags) - bags
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), bags))
        weight = e / np.repeat(np.add.reduceat(e, at), bags)
        z = np.add.reduceat(weight[:, None] * h, at, axis=0)
        return z @ p["c"] + p["d"][0], {"x": x, "h": h, "t": t, "g": g, "a": weight, "z": z, "at": at}

    def gradients(self, x, bags, label, sample_weight) -> dict[str, np.ndarray]:
        """Of the weighted log loss, by the chain rule."""
        p = self.p
        logit, s = self.forward(x, bags)
        d_logit = (1 / (1 + np.exp(-logit)) - label) * sample_weight / sample_weight.sum()
        d_z = np.repeat(d_logit[:, None] * p["c"], bags, axis=0)
        d_a = (d_z * s["h"]).sum(1)
        d_e = s["a"] * (d_a - np.repeat(np.add.reduceat(s["a"] * d_a, s["at"]), bags))
        d_t, d_g = d_e[:, None] * p["w"] * s["g"], d_e[:, None] * p["w"] * s["t"]
        d_t, d_g = d_t * (1 - s["t"] ** 2), d_g * s["g"] * (1 - s["g"])
        d_h = s["a"][:, None] * d_z + d_t @ p["V"].T + d_g @ p["U"].T
        d_u = d_h * (1 - s["h"] ** 2)
        return {"W": s["x"].T @ d_u, "b": d_u.sum(0), "V": s["h"].T @ d_t, "U": s["h"].T @ d_g,
                "w": (s["t"] * s["g"]).T @ d_e, "c": s["z"].T @ d_logit, "d": np.array([d_logit.sum()])}

    def train(self, x, bags, label, sample_weight, *, steps: int = 1200, batch: int = 192, rate: float = 0.01) -> None:
        """Adam on random batches of bags, with a little weight decay."""
        rng = np.random.default_rng(SEED + 1)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(q) for k, q in self.p.items()}
        at = np.cumsum(bags) - bags
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(bags), batch)
            rows = np.concatenate([np.arange(at[i], at[i] + bags[i]) for i in pick])
            grad = self.gradients(x[rows], bags[pick], label[pick], sample_weight[pick])
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, q in self.p.items():
                g = grad[k] + 1e-4 * q
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                q -= now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)

    def score(self, texts: list[str | None]) -> np.ndarray:
        x, bags = passages(texts)
        return 1 / (1 + np.exp(-self.forward(x, bags)[0]))


class Constant:
    """What is known without labels of both classes."""

    def __init__(self, value: float) -> None:
        self.value = value

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.full(len(texts), self.value)


def encode_bags(bag_passages: int):
    """Task code: label, weight, text, id -> id, label, weight, encodings as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 100):
                batch = whole.slice(i, 100)
                x, bags = passages(batch.column("text").to_pylist())
                at = np.cumsum(bags) - bags
                rows = [x[s + np.unique(np.linspace(0, n - 1, min(n, bag_passages)).astype(int))].astype(np.float32).tobytes()
                        for s, n in zip(at, bags)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
                                                 ["doc_id", "label", "x"])
    return run


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_class: int = PER_CLASS, bag_passages: int = BAG_PASSAGES):
    """Learn from the labelled documents that are not held out."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out_column(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    known = known.join(docs.select(F.col(id_col).cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    known = stored(known.withColumn("place", seeded_order(F.col("doc_id"), SEED)), "quality-labels")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Constant(float(next(iter(counts), 1)))
    first, second = (known.where(F.col("label") == k).orderBy("place", "doc_id").limit(per_class) for k in (0, 1))
    sample = stored(first.unionByName(second).select("doc_id", "label"), "quality-sample")
    # At most 2 * per_class rows of two numbers: a proven bound for the broadcast.
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    encoded = texts.mapInArrow(encode_bags(bag_passages), "doc_id long, label int, x binary")
    # One row an id, however many rows share it, so what the driver reads keeps its bound.
    rows = sorted(encoded.groupBy("doc_id", "label").agg(F.min("x").alias("x")).collect())
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES).astype(float) for r in rows]
    label = np.array([r["label"] for r in rows], float)
    x, sizes = np.concatenate(bags), np.array([len(b) for b in bags])
    seen = {k: max(1, int((label == k).sum())) for k in (0, 1)}
    weight = np.where(label == 1, counts[1] / seen[1], counts[0] / seen[0])
    net = Network(x.mean(0), x.std(0) + 1e-6)
    net.train(x, sizes, label, weight / weight.mean())
    return net


def score_rows(model):
    """Task code: doc_id, held_out, text -> doc_id, held_out, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 100):
                batch = whole.slice(i, 100)
                score = model.score(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                                                 ["doc_id", "held_out", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out_column(F.col(id_col)).alias("held_out"),
                       F.col(text_col).alias("text"))
    out = rows.mapInArrow(score_rows(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD,
                   **options) -> DataFrame:
    """``docs`` without those that score below ``threshold``; all columns stay. One pass, no join."""
    model, at = fit(docs, labels, text_col=text_col, **options), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 100):
                batch = whole.slice(i, 100)
                yield batch.filter(pa.array(model.score(batch.column(at).to_pylist()) >= threshold))

    return docs.mapInArrow(run, docs.schema)
