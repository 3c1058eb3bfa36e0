"""Groups compared in blocks: every pair of blocks of a group meets in one
task, so a group of any size is spread over many tasks and no pair of rows is
ever a row of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def block_counts(ids: DataFrame, grp: Sequence[str], rows: int) -> DataFrame:
    """Blocks (``nb``) of at most about ``rows`` rows per group."""
    return ids.groupBy(*grp).agg(F.ceil(F.count("*") / F.lit(float(rows))).cast("int").alias("nb"))


def deal(rows: DataFrame, counts: DataFrame, grp: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Rows (grp, id, payload) copied to each pair of blocks (p <= q) their
    block belongs to; ``side`` says whether a row stands in block p or q.
    Partitioned and sorted by group and pair, for :func:`each_group`."""
    return (rows.join(counts, list(grp))
            .withColumn("b", F.pmod(F.xxhash64("id"), F.col("nb").cast("long")).cast("int"))
            .withColumn("o", F.explode(F.expr("sequence(0, nb - 1)")))
            .select(*grp, F.least("b", "o").alias("p"), F.greatest("b", "o").alias("q"),
                    F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "id", *payload)
            .repartition(*grp, "p", "q").sortWithinPartitions(*grp, "p", "q", "side", "id"))


def each_group(fn: Callable[[pa.Table], Iterable[tuple]], keys: Sequence[str]):
    """Body of ``mapInArrow`` over dealt rows: ``fn`` gets the rows of one
    pair of blocks and gives (id, links, other) rows."""
    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)],
                                          ["id", "links", "other"])

    def run(batches):
        held, key, out = [], None, []
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b[k].to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(b.num_rows, bool)
            change[0] = True
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(change)
            for s, e in zip(at.tolist(), [*at[1:].tolist(), b.num_rows]):
                k = tuple(c[s] for c in cols)
                if held and k != key:
                    out += fn(pa.Table.from_batches(held))
                    held = []
                key = k
                held.append(b.slice(s, e - s))
            if len(out) >= 10_000:
                yield batch(out)
                out = []
        if held:
            out += fn(pa.Table.from_batches(held))
        yield batch(out)
    return run


def spanning_forest(n: int, us: np.ndarray, vs: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the given links among ``n`` nodes."""
    root, out = list(range(n)), []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in zip(us.tolist(), vs.tolist()):
        ru, rv = find(u), find(v)
        if ru != rv:
            root[max(ru, rv)] = min(ru, rv)
            out.append((u, v))
            if len(out) == n - 1:
                break
    return out


def sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks (the same rows if it is one block)."""
    side = table["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    one = len(np.unique(table["p"].to_numpy())) and table["p"][0].as_py() == table["q"][0].as_py()
    return left, (left if one else right)


def count_links(table: pa.Table, left: np.ndarray, right: np.ndarray, hit_l: np.ndarray, hit_r: np.ndarray):
    """(id, links, other) rows from links given as row numbers of the blocks."""
    ids, weight = table["id"].to_numpy(), table["weight"].to_numpy()
    x, y = left[hit_l], right[hit_r]
    n = len(ids)
    total = np.bincount(x, weights=weight[y], minlength=n)
    if left is not right:
        total += np.bincount(y, weights=weight[x], minlength=n)
    for i in np.flatnonzero(total).tolist():
        yield int(ids[i]), int(total[i]), None
    for u, v in spanning_forest(n, x, y):
        yield int(ids[u]), 0, int(ids[v])
