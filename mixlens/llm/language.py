"""Language identification by hierarchical discrimination.

Method. A text is the shares of its hashed byte trigrams (lower case, whole text). One-versus-one
linear support vector machines first choose the language family, then one-versus-one machines among
the languages of that family choose the language. Each machine's margin becomes a number from 0 to 1
by the logistic function; a class's mark is the mean against its rivals, and ``score`` the
family's mark times the language's.

The machines are fitted by Spark ML on a bounded sample (about ``per_language`` texts a language, by
seeded hash) of the documents that are not held out and have a language. Prediction is one pass over
the texts without a shuffle; only the text is read.

Cases: NULL texts and texts without a letter are ``und`` with score 0. With one language learned,
that is every answer, with score 1; with none, ``und``. Repeated rows get equal answers. Rows
with a NULL id may teach. More than ``MAX_LANGUAGES`` different languages among the documents to learn from
raise ValueError. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import by_value, held_out_column, seeded_order, stored

by_value(__name__)

BUCKETS = 2048
PER_LANGUAGE = 800
MAX_LANGUAGES = 1000
#: The sample is a few megabytes: few tasks, so that a step of the fit is quick.
FIT_TASKS = 4
SEED = 53
#: Families of languages by ISO 639-1 code; others are families of their own.
FAMILIES = {"germanic": "en de nl sv da no is af", "romance": "fr es it pt ro ca gl", "slavic": "ru uk pl cs sk bg sr hr sl",
            "uralic": "fi et hu", "turkic": "tr az kk uz", "indic": "hi bn ur mr pa", "semitic": "ar he mt"}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def trigram_shares(texts: list[str | None]) -> np.ndarray:
    """One row a text: shares of its hashed byte trigrams."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    a = np.frombuffer(b"  ".join(raw) + b"  ", np.uint8).astype(np.uint32)
    sizes = np.array([len(r) + 2 for r in raw])
    code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(21)).astype(np.int64)
    doc = np.repeat(np.arange(len(raw)), sizes)[:-2]
    place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)[:-2]
    own = place < sizes[doc] - 2  # a trigram starts in its text; two spaces end each text
    out = np.bincount((doc * BUCKETS + bucket)[own], minlength=len(raw) * BUCKETS).reshape(len(raw), BUCKETS)
    return out / np.maximum(1, out.sum(1, keepdims=True))


class Duels:
    """One-versus-one machines among some classes."""

    def __init__(self, classes: list[str], machines: dict[tuple[int, int], tuple[np.ndarray, float]]) -> None:
        self.classes = classes
        self.pairs = sorted(machines)
        self.weights = np.array([machines[p][0] for p in self.pairs]).T
        self.offsets = np.array([machines[p][1] for p in self.pairs])

    def marks(self, x: np.ndarray) -> np.ndarray:
        """Mean of each class's results against the others, one row a text."""
        out = np.zeros((len(x), len(self.classes)))
        if len(self.classes) == 1:
            return out + 1
        won = 1 / (1 + np.exp(-2 * np.clip(x @ self.weights + self.offsets, -300, 300)))
        for k, (i, j) in enumerate(self.pairs):
            out[:, i] += won[:, k]
            out[:, j] += 1 - won[:, k]
        return out / (len(self.classes) - 1)


def shares_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 200):
            batch = whole.slice(i, 200)
            x = trigram_shares(batch.column("text").to_pylist())
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * BUCKETS, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), flat], ["lang", "x"])


def fit_duels(rows: DataFrame, column: str, classes: list[str]) -> Duels:
    """Fit a machine for each pair of classes."""
    machines = {}
    for i, j in combinations(range(len(classes)), 2):
        two = rows.where(F.col(column).isin(classes[i], classes[j]))
        two = two.select((F.col(column) == classes[i]).cast("double").alias("label"), "features").coalesce(FIT_TASKS).cache()
        model = LinearSVC(maxIter=15, regParam=1e-4, aggregationDepth=2).fit(two)
        two.unpersist()
        machines[i, j] = model.coefficients.toArray(), float(model.intercept)
    return Duels(classes, machines)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> tuple[Duels, dict[str, Duels]] | None:
    """(machines among families, machines among each family's languages); None without examples."""
    known = docs.where(F.col(lang_col).isNotNull() & ~held_out_column(F.col(id_col)))
    counts = known.groupBy(F.col(lang_col).alias("lang")).count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    # A share of each language by seeded hash: no shuffle, the same texts in every run.
    most = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], int(min(1.0, per_language / r["count"]) * (1 << 60)))])
    chosen = known.where(seeded_order(F.col(id_col), SEED) < F.element_at(most, F.col(lang_col)))
    chosen = chosen.where(F.col(text_col).rlike(r"\p{L}"))
    # One row an id, however many rows share it, so the sample keeps its bound.
    one = chosen.groupBy(F.col(id_col).alias("id")).agg(F.min(F.struct(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))).alias("r"))
    chosen = one.select("r.lang", "r.text")
    rows = stored(chosen.mapInArrow(shares_task, "lang string, x array<double>"), "language-sample")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return None
    family = {c: FAMILY_OF.get(c, c) for c in langs}
    names = F.create_map(*[F.lit(v) for c in langs for v in (c, family[c])])
    rows = rows.select("lang", F.element_at(names, F.col("lang")).alias("family"), array_to_vector("x").alias("features"))
    families = sorted(set(family.values()))
    inside = {f: fit_duels(rows, "lang", [c for c in langs if family[c] == f]) for f in families}
    return fit_duels(rows, "family", families), inside


def predict_task(model):
    """Task code: doc_id, held_out, letters, text -> doc_id, held_out, lang_pred, score."""
    def answers(texts: list[str | None], letters: list[bool]) -> tuple[list[str], np.ndarray]:
        if model is None:
            return ["und"] * len(texts), np.zeros(len(texts))
        families, inside = model
        x = trigram_shares(texts)
        marks = families.marks(x)
        best = marks.argmax(1)
        lang, score = np.empty(len(texts), object), np.zeros(len(texts))
        for f in np.unique(best):
            at = np.flatnonzero(best == f)
            duel = inside[families.classes[f]]
            own = duel.marks(x[at])
            first = own.argmax(1)
            lang[at] = [duel.classes[k] for k in first]
            score[at] = marks[at, f] * own[np.arange(len(at)), first]
        none = ~np.array(letters, bool)
        lang[none], score[none] = "und", 0.0
        return lang.tolist(), score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 200):
                batch = whole.slice(i, 200)
                lang, score = answers(batch.column("text").to_pylist(), batch.column("letters").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()),
                                                  pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def languages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out_column(F.col(id_col)).alias("held_out"),
                       F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict_task(model), "doc_id long, held_out boolean, lang_pred string, score double")
