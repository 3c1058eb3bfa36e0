"""Hard negatives by an inverted multi-index.

Vectors become integers; a row's score for an anchor is their exact inner
product. Index: two codebooks, one for each half of the dimensions (k-means on
a bounded sample of ``SAMPLE`` rows), deal every row to the cell of its two
nearest codewords. A codeword's radius is the largest distance of any row it
holds; a half-score is at most codeword times anchor plus radius times the
anchor's norm, so the sum of two half bounds holds for a whole cell. Cells are
stored packed, in chunks of at most ``CHUNK`` rows.

Search: each anchor visits the cells by falling sum of half bounds (the
multi-sequence heap over the two sorted lists of codewords). It wants the
first k rows, by score and then id, of one or more windows: scores from lo to hi
and the anchor's label or another. A window is certified when the bound of the
next cell lies below its k-th row's score, or below lo if it has fewer; an
anchor stops when all its windows are. Anchors visit in rounds of growing size;
a round joins the visits of a block of anchors with the chunks of their cells
and keeps k rows a window and chunk, so scores are never rows of a table.

First the positives are one window without limits, then every positive opens
the window of its negatives. Results are exact for any codebook; a poor one
only lengthens the search.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from featurelens.llm.tables import ready, stage
from featurelens.llm.whitening import integers

SAMPLE = 16_384
CHUNK = 1024
CELL_ROWS = 512
BLOCK = 512
FIRST_VISIT = 4096
_FOUND = "anchor long, win int, id long, score long"


def codebook(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means centres of the rows of ``x`` (distinct rows, spread evenly, to
    start with); empty clusters keep their centre."""
    x = np.unique(x, axis=0)
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), 4096):
        part = x[at:at + 4096]
        out[at:at + 4096] = np.argmin((c * c).sum(1)[None, :] - 2.0 * (part @ c.T), axis=1)
    return out


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products, by floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(a.shape[1], 1)
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return a @ x.T


def visits(bounds: tuple[np.ndarray, np.ndarray], sizes: dict[tuple[int, int], int], stop: float, skip: int, rows: int):
    """The multi-sequence: (cells, next bound, visited). Pops cells by falling
    sum of half bounds; the first ``skip`` cells were visited before. Ends at
    a bound below ``stop``, or when the new cells hold ``rows`` rows; the next
    bound is -inf once all cells are visited."""
    order = [np.argsort(-b, kind="stable") for b in bounds]
    u, v = (b[o] for b, o in zip(bounds, order))
    heap, seen, cells, held, popped = [(-(u[0] + v[0]), 0, 0)], {(0, 0)}, [], 0, 0
    while heap:
        bound = -heap[0][0]
        if bound < stop or (held >= rows and popped > skip):
            return cells, bound, popped
        _, i, j = heapq.heappop(heap)
        for nxt in ((i + 1, j), (i, j + 1)):
            if nxt[0] < len(u) and nxt[1] < len(v) and nxt not in seen:
                seen.add(nxt)
                heapq.heappush(heap, (-(u[nxt[0]] + v[nxt[1]]), *nxt))
        cell = (int(order[0][i]), int(order[1][j]))
        popped += 1
        if popped > skip and cell in sizes:
            cells.append(cell)
            held += sizes[cell]
    return cells, -np.inf, popped


class Index:
    """Codebooks, radii and cell sizes (bounded by the codebooks) with the
    table of packed chunks."""

    def __init__(self, rows: DataFrame, books: int | None = None):
        spark = rows.sparkSession
        n = rows.count()
        self.dim = int(rows.agg(F.max(F.size("x"))).first()[0] or 0)
        self.half = self.dim // 2
        self.n = n
        if not n:
            return
        k = books or int(min(1024, max(4, round((n / CELL_ROWS) ** 0.5))))
        share = min(1.0, SAMPLE / n)
        half = self.half

        def learn(batches):
            x = [b["x"].flatten().to_numpy().reshape(b.num_rows, -1) for b in batches if b.num_rows]
            if x:
                x = np.concatenate(x).astype(np.float64)
                c = [codebook(p, k) for p in (x[:, :half], x[:, half:])]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in c]), pa.array([len(p) for p in c])], ["c", "k"])

        draw = F.pmod(F.xxhash64(F.lit(23), "id"), F.lit(1_000_000)) < max(1, int(share * 1_000_000))
        drawn = rows if n <= SAMPLE else rows.where(draw)
        got = (drawn.select("id", "x").repartition(1).sortWithinPartitions("id").select("x")
               .mapInArrow(learn, "c binary, k long").collect())
        books_ = self.books = [np.frombuffer(g["c"]).reshape(g["k"], -1) for g in got]

        def assign(batches):
            for b in batches:
                x = b["x"].flatten().to_numpy().reshape(b.num_rows, -1).astype(np.float64)
                parts = (x[:, :half], x[:, half:])
                at = [nearest(p, c) if p.shape[1] else np.zeros(len(p), np.int64) for p, c in zip(parts, books_)]
                far = [np.sqrt(((p - c[i]) ** 2).sum(1)) for p, c, i in zip(parts, books_, at)]
                yield pa.RecordBatch.from_arrays(b.columns + [pa.array(v) for v in (*at, *far)], b.schema.names + ["c0", "c1", "r0", "r1"])

        dealt = stage(rows.mapInArrow(assign, "id long, label string, x array<long>, c0 long, c1 long, r0 double, r1 double"), "negatives-dealt")
        cells = dealt.groupBy("c0", "c1").agg(F.count("*").alias("n"), F.max("r0").alias("r0"), F.max("r1").alias("r1")).collect()
        self.sizes = {(c["c0"], c["c1"]): c["n"] for c in cells}
        self.radius = [np.zeros(len(b)) for b in self.books]
        for c in cells:
            for h in (0, 1):
                self.radius[h][c[f"c{h}"]] = max(self.radius[h][c[f"c{h}"]], c[f"r{h}"])

        def pack(batches):
            for b in batches:
                key = np.stack([b[c].to_numpy() for c in ("c0", "c1")])
                cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
                for a, z in zip([0, *cut], [*cut, b.num_rows]):
                    for at in range(a, z, CHUNK):
                        p = b.slice(at, min(CHUNK, z - at))
                        yield pa.RecordBatch.from_arrays(
                            [p["c0"].slice(0, 1), p["c1"].slice(0, 1), pa.array([p["id"].to_numpy().tobytes()]),
                             pa.array([p["code"].to_numpy().tobytes()]), pa.array([p["x"].flatten().to_numpy().tobytes()])],
                            ["c0", "c1", "ids", "labels", "xs"])

        # ranges may part a cell: any chunk of it will do
        self.chunks = stage(dealt.select("id", F.xxhash64("label").alias("code"), "x", "c0", "c1")
                            .repartitionByRange("c0", "c1", "id").sortWithinPartitions("c0", "c1", "id")
                            .mapInArrow(pack, "c0 long, c1 long, ids binary, labels binary, xs binary"), "negatives-chunks")


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by id."""
    if len(score) > k:
        kth = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= kth)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def search(index: Index, anchors: DataFrame, k: int) -> DataFrame:
    """(anchor, win, id, score): the first ``k`` rows of every window of
    ``anchors`` (anchor, code, x, wins array<struct<win, lo, hi, same>>)."""
    spark = anchors.sparkSession
    empty = spark.createDataFrame([], _FOUND)
    if not index.n:
        return empty
    books, radius, sizes, half = index.books, index.radius, index.sizes, index.half
    reach = [np.array([np.linalg.norm(c, axis=1)]).max() + r.max() for c, r in zip(books, radius)]

    def plan(rows_each):
        def run(batches):
            for whole in batches:
                for at in range(0, whole.num_rows, BLOCK):
                    b = whole.slice(at, BLOCK)
                    x = b["x"].flatten().to_numpy().reshape(b.num_rows, -1).astype(np.float64)
                    want: dict[tuple[int, int], list[int]] = {}
                    nexts, done = [], []
                    for i, (stop, skip) in enumerate(zip(b["stop"].to_pylist(), b["skip"].to_pylist())):
                        bounds = []
                        for p, c, r, m in zip((x[i, :half], x[i, half:]), books, radius, reach):
                            size = np.sqrt((p * p).sum())
                            # a hair above the real bound: floating point rounds
                            bounds.append(np.minimum(c @ p + size * r, size * m) + 1e-9 * size * m + 1e-6)
                        cells, bound, popped = visits(tuple(bounds), sizes, -np.inf if stop is None else stop, skip, rows_each)
                        nexts.append(bound)
                        done.append(popped)
                        for c in cells:
                            want.setdefault(c, []).append(i)
                    ids = b["anchor"].to_numpy()
                    # one row a visited cell, and one (c0 -1) telling how far the anchors came
                    packed = [(c[0], c[1], pos) for c, pos in sorted(want.items())]
                    cols: list[list] = [[], [], [], [], [], [], []]
                    wins = b["wins"].to_pylist()
                    for c0, c1, pos in packed:
                        w = [(j, v["win"], v["lo"], v["hi"], v["same"]) for j, p in enumerate(pos) for v in wins[p]]
                        for col, v in zip(cols, (c0, c1, ids[pos].tobytes(), b["code"].to_numpy()[pos].tobytes(),
                                                 x[pos].astype(np.int64).tobytes(), np.array(w, np.int64).tobytes(), None)):
                            col.append(v)
                    for col, v in zip(cols, (-1, -1, ids.tobytes(), None, None, np.array(done, np.int64).tobytes(), np.array(nexts, np.float64).tobytes())):
                        col.append(v)
                    kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 5)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["c0", "c1", "anchors", "codes", "ax", "wins", "nexts"])
        return run

    def match(batches):
        for b in batches:
            out = []
            for r in range(b.num_rows):
                a, code, ids, labels = (np.frombuffer(b[c][r].as_buffer(), np.int64) for c in ("anchors", "codes", "ids", "labels"))
                ax, xs = (np.frombuffer(b[c][r].as_buffer(), np.int64).reshape(len(i), -1) for c, i in (("ax", a), ("xs", ids)))
                score = products(ax, xs)
                for j, win, lo, hi, same in np.frombuffer(b["wins"][r].as_buffer(), np.int64).reshape(-1, 5):
                    s = score[j]
                    at = np.flatnonzero((s >= lo) & (s <= hi) & ((labels == code[j]) == bool(same)) & (ids != a[j]))
                    at = at[_first(s[at], ids[at], k)]
                    out.append(np.stack([np.full(len(at), a[j]), np.full(len(at), win), ids[at], s[at]]))
            got = np.concatenate(out, axis=1) if out else np.empty((4, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(got[0]), pa.array(got[1].astype(np.int32)), pa.array(got[2]), pa.array(got[3])], ["anchor", "win", "id", "score"])

    def progress(batches):
        for b in batches:
            for r in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b[c][r].as_buffer(), t)) for c, t in (("anchors", np.int64), ("wins", np.int64), ("nexts", np.float64))],
                                                 ["anchor", "skip", "bound"])

    best = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id")
    open_ = stage(anchors.withColumn("skip", F.lit(0).cast("long")).withColumn("stop", F.lit(None).cast("double")), "negatives-anchors")
    kept, finished, rows = None, [], FIRST_VISIT
    while True:
        asked = stage(open_.select("anchor", "code", "x", "wins", "skip", "stop").mapInArrow(
            plan(rows), "c0 long, c1 long, anchors binary, codes binary, ax binary, wins binary, nexts binary"), "negatives-visits")
        met = asked.where("c0 >= 0").drop("nexts").join(index.chunks, ["c0", "c1"])
        fresh = met.select("anchors", "codes", "ax", "wins", "ids", "labels", "xs").mapInArrow(match, _FOUND)
        kept = stage((fresh if kept is None else fresh.unionByName(kept)).withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}").drop("rank"), "negatives-found")
        came = asked.where("c0 < 0").select("anchors", "wins", "nexts").mapInArrow(progress, "anchor long, skip long, bound double")
        # a window's stop: its k-th score, or lo while it holds fewer rows
        full = kept.groupBy("anchor", "win").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        stops = (open_.select("anchor", F.explode("wins").alias("w")).select("anchor", F.col("w.win").alias("win"), F.col("w.lo").alias("lo"))
                 .join(full, ["anchor", "win"], "left")
                 .groupBy("anchor").agg(F.min(F.when(F.col("n") >= k, F.col("kth")).otherwise(F.col("lo"))).cast("double").alias("stop")))
        state = (open_.drop("skip", "stop").join(stops, "anchor").join(came, "anchor"))
        open_ = stage(state.where("bound >= stop").drop("bound"), "negatives-anchors")
        if not open_.head(1):
            return kept
        rows *= 4


def mine_hard_negatives(vecs: DataFrame, anchor: str, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                        k_pos: int = 5, k_neg: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                        books: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) of the rows of id (long) for which the SQL test ``anchor``
    holds.

    An anchor's positives are its first ``k_pos`` other rows of its label; each
    one's negatives are the first ``k_neg`` rows of other labels whose score
    lies from ``low`` to ``high`` per cent of the positive's. Rows with a null id,
    label or vector, null or non-finite entries, an empty vector, or another
    length than most take no part. Equal rows count once; of a repeated id with
    different rows the smallest (label, vector) counts. Fewer rows give fewer
    results; an empty table gives none.
    """
    ready(vecs.sparkSession)
    rows = integers(vecs.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("v"))
                    .where("id is not null and label is not null"), "v", scale)
    rows = stage(rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("s")).select("id", "s.label", "s.x"), "negatives-rows")
    index = Index(rows, books)
    own = rows.where(F.expr(anchor)).select(F.col("id").alias("anchor"), F.xxhash64("label").alias("code"), "x")
    whole = F.array(F.struct(F.lit(0).alias("win"), F.lit(-(1 << 62)).alias("lo"), F.lit(1 << 62).alias("hi"), F.lit(1).alias("same")))
    positives = stage(search(index, own.withColumn("wins", whole), k_pos)
                      .withColumn("win", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))), "negatives-positives")
    # low * p <= 100 * s <= high * p, in whole numbers
    lo, hi = F.expr(f"cast(ceil({low} * cast(score as decimal(25,0)) / 100) as long)"), F.expr(f"cast(floor({high} * cast(score as decimal(25,0)) / 100) as long)")
    wins = (positives.select("anchor", F.struct("win", lo.alias("lo"), hi.alias("hi"), F.lit(0).alias("same")).alias("w"))
            .where("w.lo <= w.hi").groupBy("anchor").agg(F.array_sort(F.collect_list("w")).alias("wins")))
    found = search(index, own.join(wins, "anchor"), k_neg)
    rank = F.row_number().over(Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id"))
    return (found.select("anchor", "win", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"), rank.alias("rank"))
            .join(positives.select("anchor", "win", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor", "win"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
