"""Ordinal quality classifier: cumulative-link regression on hashed text.

Grades 0 < 1 < ... < K-1 share one weight vector over hashed features; K-1
ordered thresholds cut the score: P(grade <= k) = sigmoid(threshold_k - score).
Features of a text are its hashed words and their beginnings (A-Z as a-z),
scaled by its length, and bands of a few shape measures (capitals, marks,
digits, repetition, word length). Features seen in a smaller share of the rated
texts than ``min_share`` have no weight.

The model is fitted inside one task on at most about ``max_rated`` rated rows
(picked by a hash of the id), the documented bound of the fit; all texts are
scored where they are, without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from featurelens.llm import tokens as T
from featurelens.llm.tables import ready

BITS = 20
DIM = 1 << BITS
PREFIX = 4
MAX_RATED = 16_000
_BANDS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])


def _kinds() -> np.ndarray:
    """1 for bytes of letters and digits (all of other scripts), 2 for marks."""
    k = np.full(256, 2, np.uint8)
    k[:33] = 0
    for lo, hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
        k[lo:hi] = 1
    return k


_KIND = _kinds()


def features(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, values, each text's first (n + 1)) of a text column.

    A text of n words gives its words (runs of letters and digits) and their
    first ``PREFIX`` bytes, each counting 1 / sqrt(n) per occurrence, and one
    band of each shape measure, counting 1."""
    data, offs = T.text_buffer(col)
    kind = _KIND[data]
    starts, ends, ptr = T.word_bounds(data, offs, kind == 1)
    n, words = len(offs) - 1, np.diff(ptr)
    doc = np.repeat(np.arange(n), words)
    whole = T.word_hashes(data, starts, ends, True)
    head = T.mix(T.word_hashes(data, starts, np.minimum(ends, starts + PREFIX), True) + np.uint64(77))
    idx = np.concatenate([whole, head]) >> np.uint64(64 - BITS)
    # occurrences of one feature in one text become one value
    code, count = np.unique((np.concatenate([doc, doc]).astype(np.uint64) << np.uint64(BITS)) | idx, return_counts=True)
    doc, idx = (code >> np.uint64(BITS)).astype(np.int64), (code & np.uint64(DIM - 1)).astype(np.int64)
    value = count / np.sqrt(np.maximum(words, 1))[doc]

    def share(flag):
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return (total[offs[1:]] - total[offs[:-1]]) / np.maximum(np.diff(offs), 1)

    per = np.maximum(words, 1)
    measures = [share((data >= 65) & (data <= 90)), share(kind == 2), share((data >= 48) & (data <= 57)),
                np.bincount(doc, minlength=n) / (2 * per),
                np.minimum(np.bincount(np.repeat(np.arange(n), words), weights=ends - starts, minlength=n) / per / 20, 1),
                np.minimum(np.log1p(words) / 12, 1)]
    shape = [T.seeds(1, 1000 * (k + 1))[0] + np.searchsorted(_BANDS, m).astype(np.uint64) for k, m in enumerate(measures)]
    shape = (T.mix(np.stack(shape, 1).reshape(-1)) >> np.uint64(64 - BITS)).astype(np.int64)
    doc = np.concatenate([doc, np.repeat(np.arange(n), len(measures))])
    order = np.argsort(doc, kind="stable")
    return (np.concatenate([idx, shape])[order], np.concatenate([value, np.ones(len(shape))])[order].astype(np.float32),
            np.searchsorted(doc[order], np.arange(n + 1)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(idx: np.ndarray, value: np.ndarray, ptr: np.ndarray, y: np.ndarray, grades: int, epochs: int = 20,
        rate: float = 2.0, l2: float = 1e-5, min_share: float = 0.0012, batch: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Adaptive-rate mini-batch descent on the negative log likelihood:
    (weights, thresholds). Rows are visited in a fixed pseudo-random order."""
    w, acc = np.zeros(DIM), np.full(DIM, 1e-8)
    used = np.bincount(idx, minlength=DIM) >= max(3, min_share * len(y))
    share = np.cumsum(np.bincount(y, minlength=grades) + 1.0)[:-1] / (len(y) + grades)
    cut = np.log(share / (1 - share))
    cut_acc = np.full(grades - 1, 1e-8)
    for epoch in range(epochs):
        order = np.argsort(T.seeds(len(y), 3 + epoch), kind="stable")
        for at in range(0, len(y), batch):
            rows = order[at:at + batch]
            n = ptr[rows + 1] - ptr[rows]
            pos = np.repeat(ptr[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            f, r = idx[pos], np.repeat(np.arange(len(rows)), n)
            x = value[pos]
            s = np.bincount(r, weights=w[f] * x, minlength=len(rows))
            edge = np.concatenate([[-np.inf], cut, [np.inf]])
            a, b = _sigmoid(edge[y[rows] + 1] - s), _sigmoid(edge[y[rows]] - s)
            p = np.maximum(a - b, 1e-9)
            g_row = (1 - a - b) / len(rows)
            u, inv = np.unique(f, return_inverse=True)
            g = np.bincount(inv, weights=g_row[r] * x) + l2 * w[u]
            g[~used[u]] = 0
            acc[u] += g * g
            w[u] -= rate * g / np.sqrt(acc[u])
            gc = np.zeros(grades + 1)
            np.add.at(gc, y[rows] + 1, -a * (1 - a) / p / len(rows))
            np.add.at(gc, y[rows], b * (1 - b) / p / len(rows))
            gc = gc[1:-1]
            cut_acc += gc * gc
            cut = np.sort(cut - rate * gc / np.sqrt(cut_acc))
    return w, cut


def fit_ordinal(rated: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text",
                grade_col: str = "grade", max_rated: int = MAX_RATED, **kw) -> tuple[np.ndarray, np.ndarray]:
    """Fit on the rated rows (null ids, grades and grades outside 0..K-1 are
    left out; null texts are empty). ``max_rated`` bounds the rows used."""
    ready(rated.sparkSession)
    rows = (rated.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(grade_col).cast("int").alias("grade"))
            .where(F.col("id").isNotNull() & F.col("grade").between(0, grades - 1)))
    total = rows.count()
    if not total:
        return np.zeros(DIM), np.linspace(-1, 1, grades - 1)
    share = min(1.0, max_rated / total)
    rows = rows.where(F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def extract(batches):
        for whole in batches:
            for b in T.text_slices(whole, "text"):
                f, v, ptr = features(b["text"])
                f, cuts = f.astype(np.int32), list(zip(ptr[:-1], ptr[1:]))
                yield pa.RecordBatch.from_arrays(
                    [b["id"].cast(pa.string()), b["grade"], pa.array([f[x:y].tobytes() for x, y in cuts], pa.binary()),
                     pa.array([v[x:y].tobytes() for x, y in cuts], pa.binary())], ["id", "grade", "features", "counts"])

    def train(batches):
        y, f, v, n = [], [], [], [0]
        for b in batches:
            y += b["grade"].to_pylist()
            for i, x in zip(b["features"], b["counts"]):
                f.append(np.frombuffer(i.as_buffer(), np.int32))
                v.append(np.frombuffer(x.as_buffer(), np.float32))
                n.append(len(f[-1]))
        if y:
            f, v = np.concatenate(f), np.concatenate(v)
            w, cut = fit(f, v, np.cumsum(n), np.array(y), grades, **kw)
            yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()]), pa.array([cut.tobytes()])], ["w", "cut"])

    model = (rows.mapInArrow(extract, "id string, grade int, features binary, counts binary")
             .repartition(1).sortWithinPartitions("id", "grade", "features", "counts")
             .mapInArrow(train, "w binary, cut binary").first())
    if model is None:
        return np.zeros(DIM), np.linspace(-1, 1, grades - 1)
    return np.frombuffer(model["w"], np.float64), np.frombuffer(model["cut"], np.float64)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with score, expected_grade and tail_1 .. tail_{K-1}
    (P(grade >= k)); ``prefix`` goes before the new names."""
    ready(docs.sparkSession)
    w, cut = model[0].astype(np.float32), model[1]
    new = [prefix + c for c in ["score", "expected_grade", *(f"tail_{k + 1}" for k in range(len(cut)))]]

    def run(batches):
        for whole in batches:
            for b in T.text_slices(whole, text_col):
                idx, value, ptr = features(b[text_col])
                s = np.bincount(np.repeat(np.arange(b.num_rows), np.diff(ptr)), weights=w[idx] * value, minlength=b.num_rows)
                tails = _sigmoid(s[:, None] - cut[None, :])
                cols = [s, tails.sum(axis=1), *tails.T]
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array(c) for c in cols], b.schema.names + new)

    return docs.mapInArrow(run, StructType(docs.schema.fields + [StructField(c, DoubleType()) for c in new]))


def graded(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, grade) of the rated documents: 0 poor, 1 toxic, 2 good."""
    rating = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
              .agg(F.min(F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)).alias("grade")))
    return docs.select("doc_id", "text").join(rating, "doc_id")


def select_quality(docs: DataFrame, labels: DataFrame, keep_from: float = 0.5, max_rated: int = MAX_RATED) -> DataFrame:
    """(doc_id, score, expected_grade, tail_1, tail_2, kept) of every document:
    ``kept`` if the probability of the best grade is ``keep_from`` or more.
    Null and empty texts are scored by their shape alone; repeated rows stay."""
    model = fit_ordinal(graded(docs, labels), 3, max_rated=max_rated)
    return (score(docs.select("doc_id", "text"), model).drop("text")
            .withColumn("kept", F.col("tail_2") >= keep_from))
