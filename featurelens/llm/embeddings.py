"""Embedding near-duplicates by collision-counting projections.

Unit vectors are projected on ``m`` fixed random directions. In each
projection the vectors of a block are sorted and every vector opens a window
centred on itself; a pair's collisions are the projections where one lies in
the other's window. For a pair at the threshold distance a collision has a
known probability p, so its count is binomial; pairs whose count passes the
number that such a pair reaches with probability ``recall`` are verified by
the exact cosine in double precision.

Vectors are compared within one label only. Equal vectors of a label are one
representative with a weight. A label of any size is cut into blocks, and each
pair of blocks is one unit of work.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from featurelens.llm import blocks, tokens as T
from featurelens.llm.tables import connected_components, ready, stage

BLOCK = 1024
WIDTH = 1.75


def calibrate(threshold: float, m: int, recall: float) -> tuple[float, int]:
    """(half width of the windows, collisions needed) for pairs of cosine
    ``threshold``: their projections differ by a normal variable whose
    deviation is their distance."""
    dist = math.sqrt(max(2 - 2 * threshold, 1e-12))
    p = math.erf(WIDTH / math.sqrt(2))
    need, tail = 0, 1.0
    for k in range(m):
        tail -= math.comb(m, k) * p ** k * (1 - p) ** (m - k)
        if tail < recall:
            break
        need = k + 1
    return WIDTH * dist, need


def directions(dim: int, m: int) -> np.ndarray:
    """``m`` fixed Gaussian directions (Box-Muller over hashed counters)."""
    u = (T.seeds(2 * dim * m, 97 + dim) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 + 2.0 ** -54
    return (np.sqrt(-2 * np.log(u[::2])) * np.cos(2 * np.pi * u[1::2])).reshape(dim, m)


def collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """Collision counts of all queries ``a`` with all of ``b`` (projected
    values, one column per projection): a window over the sorted values adds
    one to the ranks from its first to its last."""
    counts = np.zeros((len(b), len(a)), np.int16)
    row = np.arange(len(a))
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j], kind="stable")
        line = b[order, j]
        marks = np.zeros((len(b) + 1, len(a)), np.int8)
        marks[np.searchsorted(line, a[:, j] - half, "left"), row] += 1
        marks[np.searchsorted(line, a[:, j] + half, "right"), row] -= 1
        counts[order] += np.cumsum(marks[:-1], axis=0, dtype=np.int8)
    return counts.T


def _linked(threshold: float, m: int, recall: float):
    half, need = calibrate(threshold, m, recall)

    def group(table):
        left, right = blocks.sides(table)
        vec = table["embedding"].combine_chunks()
        x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vec), -1)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        norm = np.sqrt((x * x).sum(axis=1))
        proj = (x / norm[:, None]) @ directions(x.shape[1], m)
        hit = collisions(proj[left], proj[right], half) >= need
        if left is right:
            np.fill_diagonal(hit, False)
        i, k = np.nonzero(hit)
        ok = np.zeros(len(i), bool)
        for at in range(0, len(i), 65536):
            s = slice(at, at + 65536)
            u, v = left[i[s]], right[k[s]]
            ok[s] = np.einsum("nd,nd->n", x[u], x[v]) / (norm[u] * norm[v]) >= threshold
        return blocks.count_links(table, left, right, i[ok], k[ok])
    return group


def embedding_neardup(vecs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                      label_col: str = "label", threshold: float = 0.93, m: int = 40,
                      recall: float = 0.99999) -> DataFrame:
    """One row per id: (id_col, n_links, component_id, kept).

    Links join ids of equal label whose cosine is ``threshold`` or more.
    Vectors that are null, empty, zero or hold null or non-finite components,
    or whose label is null, link with nothing; vectors of unequal length do not
    link. Null ids are left out; a repeated id keeps one row (its smallest
    vector). An empty table gives no rows.
    """
    ready(vecs.sparkSession)
    rows = (vecs.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("embedding"),
                        F.col(label_col).alias("label")).where("id is not null")
            .groupBy("id").agg(F.min(F.struct("label", "embedding")).alias("s")).select("id", "s.*"))
    usable = F.expr("""label is not null and embedding is not null and size(embedding) > 0
        and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('Infinity'))
        and exists(embedding, x -> x <> 0)""")
    groups = (rows.where(usable).withColumn("dim", F.size("embedding"))
              .groupBy("label", "dim", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("weight")))
    # labels as numbers for the grouping key, whatever their type
    reps = stage(groups.select(F.xxhash64("label", "dim").alias("grp"), "label", "dim", "embedding",
                               F.col("rep").alias("id"), "weight"), "vector-reps")
    counts = blocks.block_counts(reps, ["grp"], BLOCK)
    dealt = blocks.deal(reps, counts, ["grp"], ["weight", "embedding"])
    found = stage(dealt.mapInArrow(blocks.each_group(_linked(threshold, m, recall), ["grp", "p", "q"]),
                                   "id long, links long, other long"), "vector-links")
    comps = connected_components(found.where("other is not null")
                                 .select(F.col("id").alias("u"), F.col("other").alias("v")))
    links = found.where("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    per_rep = (reps.join(links, "id", "left").join(comps, "id", "left")
               .select("label", "dim", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                       F.coalesce("component", "id").alias("component_id")))
    usable_rows = rows.where(usable).withColumn("dim", F.size("embedding"))
    linked = usable_rows.join(per_rep, ["label", "dim", "embedding"]).select("id", "n_links", "component_id")
    return (rows.select("id").join(linked, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.col(id_col) == F.col("component_id")))
