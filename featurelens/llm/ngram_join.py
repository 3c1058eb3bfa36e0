"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

1. Every text becomes its set of word-shingle hashes. Texts with the same set
   form a class (its members are copies); only one representative of a class
   goes on.
2. The forest: each of ``trees`` tries holds a label of up to ``max_depth``
   MinHash values per representative. A sorted prefix trie cut at depth k is
   the grouping of labels by their first k values, which Spark does by key.
   Prefixes are shortened from ``max_depth`` until a pair at the threshold
   meets in some tree with the target probability (``forest_depth``).
3. Texts that share a prefix are chained to the smallest id of the prefix (a
   star, never all pairs); connected components of these chains are the
   candidate groups, which co-locate a pair once however many trees it meets in.
4. Each candidate group is cut into blocks by hash and every pair of blocks is
   verified by exact set intersection inside one task, which returns counts per
   text and a spanning forest of the true links, not the pairs.
5. Connected components of the true links give the classes.

Null and empty texts have no shingle: they link with nothing. Texts of fewer
words than the shingle are one shingle. Repeated rows of one id count once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featurelens.llm import blocks, tokens as T
from featurelens.llm.tables import connected_components, ready, stage

BLOCK = 256


def forest_depth(trees: int, max_depth: int, threshold: float, recall: float) -> int:
    """Shorten prefixes from ``max_depth`` until a pair at ``threshold``
    shares one in some tree with probability ``recall`` or more."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold ** depth) ** trees >= recall:
            return depth
    return 1


def _distinct(sh: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending."""
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.lexsort((sh, doc))
    sh, doc = sh[order], doc[order]
    keep = np.ones(len(sh), bool)
    keep[1:] = (sh[1:] != sh[:-1]) | (doc[1:] != doc[:-1])
    sh, doc = sh[keep], doc[keep]
    return sh, np.searchsorted(doc, np.arange(len(ptr)))


def _fingerprints(n: int, trees: int, depth: int, lower: bool):
    mult = T.seeds(trees * depth, 29) | np.uint64(1)

    def run(batches):
        for whole in batches:
            for b in T.text_slices(whole, "text"):
                sh, ptr = _distinct(*T.shingles(*T.hashed_words(b["text"], lower), n))
                size = np.diff(ptr)
                full = np.flatnonzero(size)
                keys = np.zeros((len(full), trees), np.uint64)
                k1 = np.zeros(len(size), np.uint64)
                k2 = np.zeros(len(size), np.uint64)
                if len(full):
                    at = ptr[:-1][full]
                    k1[full] = np.add.reduceat(sh, at)
                    k2[full] = np.add.reduceat(T.mix(sh ^ np.uint64(0x5851F42D4C957F2D)), at)
                    for t in range(trees):
                        label = np.full(len(full), t + 1, np.uint64)
                        for d in range(depth):
                            low = np.minimum.reduceat(sh * mult[t * depth + d], at)
                            label = T.mix(label * np.uint64(0x9E3779B97F4A7C15) + low)
                        keys[:, t] = label
                lists = pa.ListArray.from_arrays(
                    np.concatenate([[0], np.cumsum(np.where(size > 0, trees, 0))]).astype(np.int32),
                    pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b["id"], pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                     pa.array(size.astype(np.int64)), lists], ["id", "k1", "k2", "size", "keys"])
    return run


def _sets(n: int, lower: bool):
    """Distinct shingles of each text as packed 64-bit words."""
    def run(batches):
        for whole in batches:
            for b in T.text_slices(whole, "text"):
                sh, ptr = _distinct(*T.shingles(*T.hashed_words(b["text"], lower), n))
                packed = [sh[x:y].tobytes() for x, y in zip(ptr[:-1], ptr[1:])]
                cols = [b[c] for c in b.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    cols + [pa.array(packed, pa.binary())],
                    [c for c in b.schema.names if c != "text"] + ["shingles"])
    return run


def _overlap(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of all sets of ``a`` with all sets of ``b``:
    a product of 0/1 matrices over the shingles found on both sides."""
    out = np.zeros((len(a), len(b)), np.float32)
    if not a or not b:
        return out
    ca, cb = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(ca, cb)
    ra, rb = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])
    pa_, pb = np.searchsorted(shared, ca), np.searchsorted(shared, cb)
    ha = (pa_ < len(shared)) & (shared[np.minimum(pa_, len(shared) - 1)] == ca) if len(shared) else np.zeros(len(ca), bool)
    hb = (pb < len(shared)) & (shared[np.minimum(pb, len(shared) - 1)] == cb) if len(shared) else np.zeros(len(cb), bool)
    pa_, ra, pb, rb = pa_[ha], ra[ha], pb[hb], rb[hb]
    oa, ob = np.argsort(pa_, kind="stable"), np.argsort(pb, kind="stable")
    pa_, ra, pb, rb = pa_[oa], ra[oa], pb[ob], rb[ob]
    for lo in range(0, len(shared), 4096):
        x0, x1 = np.searchsorted(pa_, [lo, lo + 4096])
        y0, y1 = np.searchsorted(pb, [lo, lo + 4096])
        width = min(4096, len(shared) - lo)
        ma, mb = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        ma[ra[x0:x1], pa_[x0:x1] - lo] = 1
        mb[rb[y0:y1], pb[y0:y1] - lo] = 1
        out += ma @ mb.T
    return out


def _verified(threshold: float):
    """Rows of one pair of blocks -> links per text and spanning edges."""
    def group(table):
        left, right = blocks.sides(table)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        size = np.array([len(x) for x in sets], np.float64)
        inter = _overlap([sets[i] for i in left], [sets[i] for i in right])
        # J >= t without a division: inter * (1 + t) >= t * (|a| + |b|)
        hit = inter * (1 + threshold) >= threshold * (size[left][:, None] + size[right][None, :]) - 1e-9
        if left is right:
            np.fill_diagonal(hit, False)
        return blocks.count_links(table, left, right, *np.nonzero(hit))
    return group


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
               threshold: float = 0.8, trees: int = 32, max_depth: int = 8, recall: float = 0.99999,
               lower: bool = False) -> DataFrame:
    """One row per id: (id_col, class_id, n_links, size).

    ``class_id`` is the smallest id reachable by links of Jaccard >=
    ``threshold`` on sets of ``n`` words, ``n_links`` the number of other ids
    linked directly, ``size`` the number of distinct shingles. Ids that are
    null are left out; a repeated id keeps one row (its smallest set of keys).
    """
    ready(docs.sparkSession)
    depth = forest_depth(trees, max_depth, threshold, recall)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    prints = stage(src.mapInArrow(_fingerprints(n, trees, depth, lower),
                                  "id long, k1 long, k2 long, size long, keys array<long>"), "forest-prints")
    one = prints.groupBy("id").agg(F.min(F.struct("size", "k1", "k2")).alias("s")).select("id", "s.*")
    classes = one.where("size > 0").groupBy("k1", "k2", "size").agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    members = stage(one.join(classes, ["k1", "k2", "size"], "left")
                    .select("id", "size", F.coalesce("rep", "id").alias("rep"), F.coalesce("weight", F.lit(1)).alias("weight")),
                    "forest-members")
    reps = members.where("id = rep and size > 0").select("id", "size", "weight")

    labels = (prints.where("size > 0").join(reps.select("id"), "id", "left_semi")
              .select("id", F.explode("keys").alias("prefix")))
    heads = labels.groupBy("prefix").agg(F.min("id").alias("head"), F.count("*").alias("c")).where("c > 1").drop("c")
    chains = (labels.join(heads, "prefix").where("id <> head")
              .select(F.col("id").alias("u"), F.col("head").alias("v")).distinct())
    groups = stage(connected_components(chains).select("id", F.col("component").alias("grp"))
                   .join(reps, "id"), "forest-groups")
    counts = blocks.block_counts(groups, ["grp"], BLOCK)
    texts = src.join(groups.select("id"), "id", "left_semi")
    sets = (texts.mapInArrow(_sets(n, lower), "id long, shingles binary")
            .groupBy("id").agg(F.min("shingles").alias("shingles")))
    dealt = blocks.deal(groups.join(sets, "id"), counts, ["grp"], ["weight", "shingles"])
    found = stage(dealt.mapInArrow(blocks.each_group(_verified(threshold), ["grp", "p", "q"]),
                                   "id long, links long, other long"), "forest-links")
    comps = connected_components(found.where("other is not null")
                                 .select(F.col("id").alias("u"), F.col("other").alias("v")))
    links = found.where("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    per_rep = (reps.select("id").join(links, "id", "left").join(comps, "id", "left")
               .select(F.col("id").alias("rep"), F.coalesce("component", "id").alias("class_id"),
                       F.coalesce("links", F.lit(0)).alias("links")))
    return (members.join(per_rep, "rep", "left")
            .select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"),
                    (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "size"))
