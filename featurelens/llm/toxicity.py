"""Toxicity by compression distance: two zstandard dictionaries, one window
at a time.

A text is cut into windows of ``WORDS`` words (A-Z as a-z, marks left out, no
word cut). One dictionary is trained on windows of ordinary texts, another on
windows of toxic ones. The ordinary side compresses a window with the ordinary
dictionary; the toxic side has the toxic dictionary before the same ordinary
one, so that both sides spend alike on ordinary words and a window's
difference in length is what the toxic dictionary alone can express.

The labelled texts are dealt into two folds. Each fold's dictionaries are
tried on the other fold, where nothing is known by heart: there the number of
saved bytes is chosen from which a window counts, where windows of toxic texts
stand out most against those of ordinary texts. A second toxic dictionary is
trained on the windows that stood out; it stays if it does better across
the folds. Several dictionary sizes are tried in the same way.

A text's features are the shares of its windows that save so many bytes, the
most bytes saved and the mean of the four best; a logistic fit on the features
across the folds makes the score, moved so that ``DECIDE`` is the cut of the
best F1 there.

The dictionaries and the fit are made in one task from at most about
``max_toxic`` + ``max_ordinary`` labelled texts (picked by a hash of the id) and
``TEXT_WINDOWS`` windows a text: the documented bound of the fit. All texts are
scored whole, where they are, without a shuffle.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from featurelens.llm import tokens as T
from featurelens.llm.tables import ready

WORDS = 12
LEVEL = 9
ORDINARY_BYTES = 131_072
TOXIC_BYTES = (1024, 2048, 4096, 8192)
MAX_TOXIC, MAX_ORDINARY, TEXT_WINDOWS = 3_000, 6_000, 400
DECIDE = 0.7
_WORD = re.compile(rb"[a-z0-9\x80-\xff'-]+")
_BATCH = 1 << 15


def windows(text: bytes) -> list[bytes]:
    """The windows of a text; a text without words has one empty window."""
    words = _WORD.findall(text.lower())
    return [b" " + b" ".join(words[i:i + WORDS]) + b" " for i in range(0, max(len(words), 1), WORDS)]


def compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    d = zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(level=LEVEL)
    return zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)


def lengths(wins: list[bytes], by: zstd.ZstdCompressor) -> np.ndarray:
    """Compressed bytes of every window."""
    out = np.empty(len(wins), np.int32)
    for at in range(0, len(wins), _BATCH):
        part = wins[at:at + _BATCH]
        n = np.array([len(w) for w in part], np.uint64)
        start = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.uint64)
        packed = zstd.BufferWithSegments(b"".join(part), np.stack([start, n], 1).tobytes())
        out[at:at + len(part)] = [len(x) for x in by.multi_compress_to_buffer(packed, threads=0)]
    return out


def train(wins: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary of ``size`` bytes from segments that recur in windows. Too
    few windows to train on are a dictionary themselves."""
    try:
        return zstd.train_dictionary(size, wins, d=6, k=segment).as_bytes()
    except zstd.ZstdError:
        return b"".join(dict.fromkeys(wins))[:size] or b" " * 8


def _spread(wins: list[bytes]) -> list[bytes]:
    """At most ``TEXT_WINDOWS`` windows, evenly over the text."""
    if len(wins) <= TEXT_WINDOWS:
        return wins
    return [wins[i * len(wins) // TEXT_WINDOWS] for i in range(TEXT_WINDOWS)]


class Sides:
    """The windows of texts with what each costs on the ordinary side."""

    def __init__(self, texts: list[list[bytes]], ordinary: zstd.ZstdCompressor):
        self.wins = [w for t in texts for w in t]
        self.ptr = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.cost = lengths(self.wins, ordinary)

    def saved(self, toxic: zstd.ZstdCompressor) -> np.ndarray:
        return self.cost - lengths(self.wins, toxic)


def features(saved: np.ndarray, ptr: np.ndarray, cut: int) -> np.ndarray:
    """One row of features per text."""
    out = np.empty((len(ptr) - 1, 5))
    for i, (a, b) in enumerate(zip(ptr[:-1], ptr[1:])):
        best = np.sort(saved[a:b])[::-1].astype(np.float64)
        n = len(best)
        out[i] = (*(np.log((np.count_nonzero(best >= c) + 0.2) / (n + 4)) for c in (cut, cut + 2)),
                  best[0], best[:4].mean(), np.log(n))
    return out


def _stands_out(toxic: np.ndarray, ordinary: np.ndarray) -> tuple[float, int]:
    """(how clearly, from how many saved bytes) windows of toxic texts exceed
    their share of the windows that save so much."""
    scale = len(toxic) / max(len(ordinary), 1)
    best = (-np.inf, 1)
    for c in range(1, int(max(toxic.max(initial=1), 1)) + 1):
        a, b = np.count_nonzero(toxic >= c), np.count_nonzero(ordinary >= c) * scale
        best = max(best, ((a - b) / np.sqrt(a + b + 5), c))
    return best


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 40, l2: float = 0.01) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + l2 * np.eye(len(w)), x.T @ (p - y) + l2 * w)
    return w


def _best_cut(logit: np.ndarray, y: np.ndarray) -> float:
    """The logit from which calling a text toxic has the best F1."""
    order = np.argsort(-logit, kind="stable")
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(logit[order][1:] < logit[order][:-1], True)  # ties stay together
    at = int(np.argmax(np.where(ends, f1, -1)))
    below = logit[order][at + 1] if at + 1 < len(y) else logit[order][at] - 1
    return float(logit[order][at] + below) / 2


def fit(toxic: list[bytes], ordinary: list[bytes]) -> dict:
    """The model of labelled texts: dictionaries, cut, weights. Without two
    texts of each class every text scores 0."""
    if min(len(toxic), len(ordinary)) < 2:
        return {}
    wins = [[_spread(windows(t)) for t in side] for side in (toxic, ordinary)]
    folds = [[side[k::2] for side in wins] for k in (0, 1)]
    flat = lambda texts: [w for t in texts for w in dict.fromkeys(t)]
    base = [train(flat(f[1]), ORDINARY_BYTES, 64) for f in folds]
    # a fold's texts are always judged by the other fold's dictionaries
    sides = [[Sides(folds[k][c], compressor(base[1 - k])) for c in (0, 1)] for k in (0, 1)]
    source = [flat(f[0]) for f in folds]
    best = None
    for _ in range(2):
        for size in TOXIC_BYTES:
            tox = [compressor(train(s, size, 16) + b) for s, b in zip(source, base)]
            saved = [[sides[k][c].saved(tox[1 - k]) for c in (0, 1)] for k in (0, 1)]
            clear, cut = _stands_out(*(np.concatenate([saved[0][c], saved[1][c]]) for c in (0, 1)))
            if best is None or clear > best[0]:
                best = (clear, cut, size, source, saved)
        _, cut, _, _, saved = best
        found = [[w for w, s in zip(sides[k][0].wins, saved[k][0]) if s >= cut] for k in (0, 1)]
        if min(map(len, found)) < 20:
            break
        source = found
    _, cut, size, source, saved = best
    x = np.concatenate([features(saved[k][c], sides[k][c].ptr, cut) for k in (0, 1) for c in (0, 1)])
    y = np.concatenate([np.full(len(folds[k][c]), 1.0 - c) for k in (0, 1) for c in (0, 1)])
    mean, dev = x.mean(0), x.std(0) + 1e-9
    x = np.c_[(x - mean) / dev, np.ones(len(x))]
    w = _logistic(x, y)
    shift = np.log(DECIDE / (1 - DECIDE)) - _best_cut(x @ w, y)
    whole = train(flat(wins[1]), ORDINARY_BYTES, 64)
    return {"ordinary": whole, "toxic": train(source[0] + source[1], size, 16) + whole, "cut": cut,
            "weights": [*(w[:-1] / dev), w[-1] - float((w[:-1] * mean / dev).sum()) + shift]}


def predict(model: dict, texts: list[bytes], by: list[zstd.ZstdCompressor]) -> np.ndarray:
    """Scores of texts; ``by``: the ordinary and the toxic side."""
    if not model:
        return np.zeros(len(texts))
    cut = [windows(t) for t in texts]
    sides = Sides(cut, by[0])
    x = features(sides.saved(by[1]), sides.ptr, model["cut"])
    return 1 / (1 + np.exp(-np.clip(x @ model["weights"][:-1] + model["weights"][-1], -40, 40)))


def draw_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
                max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> DataFrame:
    """(_id, _y) of the ids to learn from: all, or by a hash of the id as many
    of each class as the bounds say (in expectation). Null ids and labels other
    than 0 and 1 are left out; an id with several labels is toxic if one is 1."""
    rows = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
            .where("_id is not null and _y in (0, 1)").groupBy("_id").agg(F.max("_y").alias("_y")))
    counts = {r["_y"]: r["n"] for r in rows.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit(13), F.col("_id").cast("string")), F.lit(1_000_000))
    share = {y: int(1_000_000 * min(1.0, most / max(counts.get(y, 0), 1))) for y, most in ((1, max_toxic), (0, max_ordinary))}
    return rows.where(draw < F.when(F.col("_y") == 1, share[1]).otherwise(share[0]))


def fit_toxicity(labelled: DataFrame, id_col: str = "_id", text_col: str = "text", label_col: str = "_y") -> dict:
    """The model of labelled texts (null texts are empty). One task reads all
    rows: their number is bounded by :func:`draw_labels`."""
    ready(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(label_col).alias("y"))

    def one(batches):
        texts: list[list[bytes]] = [[], []]
        for b in batches:
            for y, t in zip(b["y"].to_pylist(), b["text"]):
                texts[y].append(t.as_buffer().to_pybytes())
        m = fit(texts[1], texts[0])
        rest = json.dumps({k: m[k] if k == "cut" else list(map(float, m[k])) for k in ("cut", "weights")} if m else {})
        yield pa.RecordBatch.from_arrays([pa.array([m.get("ordinary", b"")], pa.binary()), pa.array([m.get("toxic", b"")], pa.binary()),
                                          pa.array([rest])], ["ordinary", "toxic", "rest"])

    got = (rows.withColumn("k", F.xxhash64(F.lit(17), "id", "text")).repartition(1).sortWithinPartitions("k", "id", "text")
           .select("y", "text").mapInArrow(one, "ordinary binary, toxic binary, rest string").first())
    if got is None or not got["toxic"]:
        return {}
    return json.loads(got["rest"]) | {"ordinary": bytes(got["ordinary"]), "toxic": bytes(got["toxic"])}


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text (0 to 1; null is empty)."""
    ready(docs.sparkSession)

    def run(batches):
        by = [compressor(model[k]) for k in ("ordinary", "toxic")] if model else []
        for whole in batches:
            for b in T.text_slices(whole, text_col):
                texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b[text_col].cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array(predict(model, texts, by))], b.schema.names + [out])

    kept = docs.drop(out) if out in docs.columns else docs
    return kept.mapInArrow(run, StructType(kept.schema.fields + [StructField(out, DoubleType())]))


def label_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   folds: int = 3, held_fold: int = 1, **bounds) -> DataFrame:
    """(id_col, held_out, score, predicted) of every row of ``docs``.

    Labels are learned from rows whose crc32(id as text) mod ``folds`` is not
    ``held_fold``; ``held_out`` tells the others (false for null ids, which teach
    nothing). An id with several labels counts as toxic if one is 1. Null
    texts are empty and score like them; repeated rows stay and score alike;
    an empty table gives no rows; no labels of both classes give score 0.
    """
    def held(c):
        return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % folds == held_fold, F.lit(False))

    held_out = held(id_col)
    src = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"), held_out.alias("_held"))
    # the drawn ids are few by their bounds; the texts are not shuffled for them
    drawn = F.broadcast(draw_labels(labels.where(~held(id_col)), id_col, **bounds))
    model = fit_toxicity(src.where("not _held").join(drawn, F.col("_doc") == F.col("_id")), "_id", "_text")
    scored = score_toxicity(src, model, "_text", "score")
    return scored.select(F.col("_doc").alias(id_col), F.col("_held").alias("held_out"), "score",
                         (F.col("score") >= DECIDE).cast("int").alias("predicted"))
