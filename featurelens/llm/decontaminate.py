"""Benchmark decontamination by size-partitioned MinHash containment search.

Benchmark items are partitioned by their number of shingles into doubling
classes. For a class of at most u shingles a document is seen as windows of
2u shingles every u, so an item's occurrence lies whole in one window and the
Jaccard similarity of item and window has a lower bound that depends on the
class only, however long the document is. MinHash signatures of the windows
(sliding minimums, one row per band) are matched with the items' signatures;
an item met in any window is verified by its exact containment in the whole
document.

The benchmark is the stated query set: its items are taken in blocks of at
most ``block_items`` (a bounded broadcast) against all documents, so the
documents are never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featurelens.llm import tokens as T
from featurelens.llm.tables import ready, stage

OUT = "doc_id long, item_id long, containment double, n_shared long, n_item long"


def bands_for(threshold: float, recall: float) -> int:
    """Signature length at which an item contained to ``threshold`` meets its
    window with probability ``recall``: the smallest item of a class has u/2 + 1
    shingles, so J >= t(u/2) / (u/2 + 2u - t(u/2)) = t / (5 - t)."""
    j = threshold / (5 - threshold)
    return int(np.ceil(np.log(1 - recall) / np.log(1 - j)))


def size_class(n: np.ndarray) -> np.ndarray:
    """Smallest power of two that is at least ``n``."""
    return np.left_shift(1, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))


def _window_minimums(v: np.ndarray, ptr: np.ndarray, u: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum of ``v`` over windows of 2u every u inside each text, and the
    text of each window."""
    count = np.diff(ptr)
    cells = -(-count // u)
    doc = np.repeat(np.arange(len(count)), cells)
    first = np.concatenate([[0], np.cumsum(cells)])
    at = ptr[:-1][doc] + (np.arange(first[-1]) - first[:-1][doc]) * u
    low = np.minimum.reduceat(v, at) if len(at) else v[:0]
    nxt = np.where(doc[1:] == doc[:-1], low[1:], low[:-1])
    low[:-1] = np.minimum(low[:-1], nxt)
    return low, doc


class _Items:
    """Signatures and shingles of one block of items (inside a task)."""

    def __init__(self, ids, texts, n, bands, lower):
        sh, ptr = T.shingles(*T.hashed_words(pa.array(texts, pa.string()), lower), n)
        self.ids, self.sets = ids, [np.unique(sh[a:b]) for a, b in zip(ptr[:-1], ptr[1:])]
        self.mult = T.seeds(bands, 43) | np.uint64(1)
        size = np.array([len(s) for s in self.sets])
        cls = size_class(size)
        self.classes = {}
        for u in sorted(set(cls[size > 0].tolist())):
            own = [i for i in range(len(ids)) if size[i] and cls[i] == u]
            tables = []
            for m in self.mult:
                key = np.array([(self.sets[i] * m).min() for i in own], np.uint64)
                order = np.argsort(key, kind="stable")
                tables.append((key[order], np.array(own)[order]))
            self.classes[u] = tables


def _search(ids, texts, n, bands, threshold, lower):
    items = None

    def run(batches):
        nonlocal items
        if items is None:
            items = _Items(ids, texts, n, bands, lower)
        for whole in batches:
            for b in T.text_slices(whole, "text"):
                sh, ptr = T.shingles(*T.hashed_words(b["text"], lower), n)
                doc_ids, met = b["doc_id"].to_pylist(), set()
                for k, m in enumerate(items.mult):
                    v = sh * m
                    for u, tables in items.classes.items():
                        low, doc = _window_minimums(v, ptr, u)
                        keys, own = tables[k]
                        a, z = np.searchsorted(keys, low, "left"), np.searchsorted(keys, low, "right")
                        for w in np.flatnonzero(z > a):
                            met.update((int(doc[w]), int(i)) for i in own[a[w]:z[w]])
                rows, sets = [], {}
                for d, i in sorted(met):
                    if d not in sets:
                        sets = {d: np.unique(sh[ptr[d]:ptr[d + 1]])}
                    q = items.sets[i]
                    shared = len(np.intersect1d(q, sets[d], assume_unique=True))
                    if shared >= threshold * len(q) - 1e-9:
                        rows.append((doc_ids[d], items.ids[i], shared / len(q), shared, len(q)))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], kinds[c]) for c in range(5)],
                    ["doc_id", "item_id", "containment", "n_shared", "n_item"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", n: int = 5, threshold: float = 0.8,
                 recall: float = 0.9999, block_items: int = 20_000, lower: bool = True,
                 block_chars: int = 16 << 20) -> DataFrame:
    """(doc_id, item_id, containment, n_shared, n_item) of every pair where the
    document holds ``threshold`` or more of the item's distinct shingles.

    Texts shorter than ``n`` words are one shingle. Null or empty items and
    documents, and null ids, give no pair; repeated rows give one pair. All
    texts of a repeated ``item_id`` are searched; a document's pair tells of the
    one it holds most of. A benchmark of any size is searched in blocks of at
    most ``block_items``, of ``block_chars`` characters and one more text.
    """
    ready(docs.sparkSession)
    spark = docs.sparkSession
    bands = bands_for(threshold, recall)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    queries = (benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
               .where("item_id is not null and trim(text) <> ''").distinct())
    out, block, held = spark.createDataFrame([], OUT), [], 0

    def search(block):
        return stage(src.mapInArrow(_search([i for i, _ in block], [t for _, t in block], n, bands, threshold, lower), OUT),
                     "leaks")

    # one block of items is held at a time
    for r in queries.toLocalIterator():
        block.append((r["item_id"], r["text"]))
        held += len(r["text"])
        if len(block) == block_items or held >= block_chars:
            out, block, held = out.unionAll(search(block)), [], 0
    if block:
        out = out.unionAll(search(block))
    # an item of several texts counts by the one that the document holds most of
    best = F.max(F.struct("containment", "n_shared", "n_item"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
