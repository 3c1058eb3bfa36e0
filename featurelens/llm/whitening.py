"""Whitening by Chebyshev-filtered subspace iteration.

Vectors become integers, floor(``scale`` * entry). The fit list holds every
distinct integer vector once, packed into blocks in the shared folder; n, the
sums S and all covariances are over that list, divisor n, centred before
multiplying. A block of ``k`` wanted and some guard directions is improved by
rounds of

1. a Chebyshev polynomial of the covariance, by its three-term recurrence: it
   stays small over the unwanted spectrum, from 0 to the least Ritz value of
   the block, and grows fast above. Each step is one distributed pass of
   centred X^T X Q over the packed blocks, a d x block sum per task;
2. QR and Rayleigh-Ritz with one more pass, which also gives the residuals.

The rounds stop when the wanted pairs are certified: the residuals bound the
angle to the exact eigenvectors (residual over the gap to the other Ritz
values) by ``tol``, or are as small as double precision can show. Matrices of
d x block reach the driver, never rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featurelens.llm import tokens as T
from featurelens.llm.tables import ready, stage

PACK = 4096
DEGREE = 10
MAX_ROUNDS = 60


def usable(vec: str) -> str:
    """SQL test: a vector with entries, all of them finite."""
    return f"""{vec} is not null and size({vec}) > 0
        and not exists({vec}, x -> x is null or isnan(x) or abs(x) = double('Infinity'))"""


@dataclass
class Model:
    """``values`` and ``vectors`` (one column each) of the wanted components,
    falling; ``error`` bounds the vectors' angles to the exact ones."""
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    error: np.ndarray
    passes: int


def integers(vecs: DataFrame, vec_col: str, scale: int) -> DataFrame:
    """Usable rows with the integer vector ``x``. Vectors of another length
    than the most frequent one (of equally frequent, the longer) are left out."""
    kept = vecs.where(usable(vec_col))
    sizes = kept.groupBy(F.size(vec_col).alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    x = F.transform(F.col(vec_col), lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    return kept.where(F.size(vec_col) == (sizes["d"] if sizes else 0)).withColumn("x", x)


def _pack(batches):
    """Integer vectors as blocks of ``PACK`` rows in one binary value."""
    for b in batches:
        for at in range(0, b.num_rows, PACK):
            x = b["x"].slice(at, PACK)
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([x.flatten().to_numpy().astype(np.int64).tobytes()])], ["rows", "x"])


def _sum_blocks(blocks: DataFrame, rows: int, part: Callable[[np.ndarray], np.ndarray], dim: int) -> np.ndarray:
    """The sum over all blocks of ``part``, a matrix of ``rows`` rows: one per
    task, added up by row on the executors."""
    def run(batches):
        total = None
        for b in batches:
            for v in b["x"]:
                p = part(np.frombuffer(v.as_buffer(), np.int64).reshape(-1, dim))
                total = p if total is None else total + p
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), pa.array(list(total))], ["i", "v"])

    kind = "long" if part(np.zeros((1, dim), np.int64)).dtype == np.int64 else "double"
    width = part(np.zeros((1, dim), np.int64)).shape[1]
    each = blocks.mapInArrow(run, f"i long, v array<{kind}>").groupBy("i").agg(*[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(width)])
    got = sorted(each.collect())
    return np.array([r[1:] for r in got], np.int64 if kind == "long" else np.float64)


def components(x: DataFrame, k: int = 4, tol: float = 1e-11, guard: int = 28) -> tuple[Model | None, DataFrame]:
    """(model, packed fit list) of the distinct vectors ``x`` (array<long>).
    Components without variance are left out; no rows give None."""
    ready(x.sparkSession)
    blocks = stage(x.select("x").distinct().mapInArrow(_pack, "rows long, x binary"), "whitening-blocks")
    head = blocks.agg(F.sum("rows").alias("n"), F.max(F.octet_length("x") / F.col("rows") / 8).alias("d")).first()
    if not head["n"]:
        return None, blocks
    n, dim = int(head["n"]), int(head["d"])
    sums = _sum_blocks(blocks, 1, lambda b: b.sum(axis=0, keepdims=True), dim)[0]
    mean = np.array([int(s) / n for s in sums])
    passes = 0

    def cov(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(b):
            c = b - mean
            return c.T @ (c @ q)
        return _sum_blocks(blocks, dim, part, dim) / n

    trace = float(_sum_blocks(blocks, 1, lambda b: ((b - mean) ** 2).sum().reshape(1, 1), dim)[0, 0]) / n
    width = min(dim, k + guard)
    u = (T.seeds(dim * width, 29) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 - 0.5
    q = np.linalg.qr(u.reshape(dim, width))[0]
    floor = 4 * np.finfo(float).eps * np.sqrt(dim)
    best = None
    for _ in range(MAX_ROUNDS):
        a = cov(q)
        small = q.T @ a
        theta, r = np.linalg.eigh((small + small.T) / 2)
        theta, r = theta[::-1], r[:, ::-1]
        q, a = q @ r, a @ r
        left = np.linalg.norm(a - q * theta, axis=0)
        top = max(theta[0], 0.0)
        # the angle of a pair: its residual over the gap to all other values
        gap = np.array([min([abs(theta[i] - theta[j]) for j in range(width) if j != i], default=top) for i in range(width)])
        error = left / np.maximum(gap, np.finfo(float).tiny)
        wanted = slice(0, min(k, width))
        worst = left[wanted].max()
        stuck = best is not None and worst >= 0.5 * best[0] and best[0] <= 1e3 * floor * top
        if best is None or worst < best[0]:
            best = (worst, theta.copy(), q.copy(), error.copy())
        if width == dim or (error[wanted] <= tol).all() or worst <= floor * top or stuck:
            break
        # the polynomial is small on [0, cut]
        cut = max(theta[-1], 1e-6 * top)
        centre = half = cut / 2
        first = sigma = half / (top - centre)
        prev, cur = q, (a - centre * q) * (sigma / half)
        for _ in range(DEGREE - 1):
            after = 1 / (2 / first - sigma)
            prev, cur = cur, (cov(cur) - centre * cur) * (2 * after / half) - sigma * after * prev
            sigma = after
        q = np.linalg.qr(cur)[0]
    _, theta, q, error = best
    keep = [i for i in range(min(k, width)) if theta[i] > 1e-12 * max(trace, 0) and theta[i] > 0]
    vectors = q[:, keep]
    turn = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))]) if keep else np.ones(0)
    return Model(n, [int(s) for s in sums], trace, theta[keep], vectors * turn, error[keep], passes), blocks


def identity_error(model: Model, blocks: DataFrame) -> float:
    """Largest absolute entry of the whitened covariance less the identity."""
    if not len(model.values):
        return 0.0
    mean = np.array([s / model.n for s in model.sums])
    w = model.vectors / np.sqrt(model.values)

    def part(b):
        y = (b - mean) @ w
        return y.T @ y
    return float(np.abs(_sum_blocks(blocks, w.shape[1], part, len(mean)) / model.n - np.eye(w.shape[1])).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over dimensions of (n * x - S)^2."""
    s = np.array(sums, object)
    most = n * int(np.abs(x).max(initial=0)) + max((abs(v) for v in sums), default=0)
    if most * most * max(x.shape[1], 1) < 1 << 63:
        return [int(v) for v in ((x * n - s.astype(np.int64)) ** 2).sum(axis=1)]
    if most < 1 << 50:  # halves of 25 bits: squares and their sums stay in 63
        a = np.abs(x * n - s.astype(np.int64))
        hi, lo = a >> 25, a & ((1 << 25) - 1)
        parts = [(p * q).sum(axis=1) for p, q in ((hi, hi), (hi, lo), (lo, lo))]
        return [(int(h) << 50) + (int(m) << 26) + int(v) for h, m, v in zip(*parts)]
    return [int(v) for v in ((x.astype(object) * n - s) ** 2).sum(axis=1)]


def whiten(vecs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 4, scale: int = 256,
           tol: float = 1e-11) -> DataFrame:
    """(id_col, component, n, deviation decimal(38), whitened, explained,
    identity_error, eigenvalue, angle_error) per usable row and component.

    Vectors that are null, empty or hold null or non-finite entries, or of
    another length than most, take no part. Repeated rows stay, each with the
    components; null ids stay. Fewer than ``k`` dimensions, or dimensions
    without variance, give fewer components: one vector alone gives no rows,
    as an empty table does. ``angle_error`` bounds a component's angle to the
    exact eigenvector.
    """
    rows = integers(vecs, vec_col, scale).select(F.col(id_col).alias("_id"), "x")
    model, blocks = components(rows, k, tol)
    out = "component int, deviation string, whitened double, explained double, eigenvalue double, angle_error double"
    n, off = (model.n, identity_error(model, blocks)) if model else (0, 0.0)

    def run(batches):
        mean = np.array([s / model.n for s in model.sums])
        w = model.vectors / np.sqrt(model.values)
        count = len(model.values)
        for b in batches:
            for at in range(0, b.num_rows, PACK):
                part = b.slice(at, PACK)
                x = part["x"].flatten().to_numpy().astype(np.int64).reshape(-1, len(mean))
                y = (x - mean) @ w
                each = np.repeat(np.arange(len(x)), count)
                dev = pa.array([str(v) for v in deviations(x, model.n, model.sums)]).take(pa.array(each))
                yield pa.RecordBatch.from_arrays(
                    [part["_id"].take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))), dev,
                     pa.array(y.reshape(-1)), *[pa.array(np.tile(v, len(x))) for v in (model.values / model.trace, model.values, model.error)]],
                    ["_id", "component", "deviation", "whitened", "explained", "eigenvalue", "angle_error"])

    kind = rows.schema["_id"].dataType.simpleString()
    done = (rows.mapInArrow(run, f"_id {kind}, {out}") if model and len(model.values)
            else rows.where("false").selectExpr("_id", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in out.split(", ")]))
    return done.select(F.col("_id").alias(id_col), "component", F.lit(n).cast("long").alias("n"),
                       F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", "explained",
                       F.lit(off).alias("identity_error"), "eigenvalue", "angle_error")
