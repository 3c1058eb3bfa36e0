"""Hard negatives and whitening against brute force."""

import math

import numpy as np
import pytest

from featurelens.llm import negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, win int, x int"


def _rows(n=260, dim=8, seed=3, copies=60):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    x = (base[rng.integers(12, size=n)] + rng.normal(size=(n, dim)) * 0.3).astype(np.float32)
    x[-copies:] = x[0]  # a common vector
    return [(i, [float(v) for v in x[i]], int(rng.integers(4)), "a", 1, 2) for i in range(n)]


def _mined(rows, step, k_pos=5, k_neg=5, low=80, high=100):
    ok = {}
    for i, e, lab, *_ in rows:
        if i is None or lab is None or not e or any(c is None or not math.isfinite(c) for c in e):
            continue
        v = (str(lab), [math.floor(256 * c) for c in e])
        ok[i] = min(ok.get(i, v), v)
    size = max({len(v[1]) for v in ok.values()}, key=lambda d: (sum(len(v[1]) == d for v in ok.values()), d)) if ok else 0
    ok = {i: v for i, v in ok.items() if len(v[1]) == size}
    out = set()
    for a in ok:
        if a % step:
            continue
        every = sorted((-sum(p * q for p, q in zip(ok[a][1], v[1])), i) for i, v in ok.items() if i != a)
        for s, p in [t for t in every if ok[t[1]][0] == ok[a][0]][:k_pos]:
            far = [t for t in every if ok[t[1]][0] != ok[a][0] and low * -s <= 100 * -t[0] <= high * -s][:k_neg]
            out |= {(a, p, r + 1, i, -s, -t) for r, (t, i) in enumerate(far)}
    return out


def _found(df):
    return {tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


@pytest.mark.parametrize("chunk,block,first,books", [(1024, 512, 4096, None), (16, 4, 20, 5), (7, 512, 1, 40)])
def test_negatives_equal_brute_force(spark, monkeypatch, chunk, block, first, books):
    for k, v in (("CHUNK", chunk), ("BLOCK", block), ("FIRST_VISIT", first)):
        monkeypatch.setattr(negatives, k, v)
    rows = _rows()
    got = _found(negatives.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), "id % 10 = 0", books=books))
    assert got == _mined(rows, 10) and len(got) > 100


def test_negatives_take_odd_rows(spark):
    rows = _rows(60, copies=6)
    good = rows[0][1]
    rows += [(None, good, 1, "", 0, 0), (100, None, 1, "", 0, 0), (110, [], 1, "", 0, 0), (120, good, None, "", 0, 0),
             (130, [float("nan")] * 8, 1, "", 0, 0), (140, [float("inf")] * 8, 1, "", 0, 0), (150, good[:3], 1, "", 0, 0),
             (160, [None] + good[1:], 1, "", 0, 0), (170, [0.0] * 8, 1, "", 0, 0)]
    rows += rows[:5] + [(20, [9.0] * 8, 3, "", 0, 0)]  # repeated rows, and an id with two vectors
    got = _found(negatives.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), "id % 10 = 0"))
    assert got == _mined(rows, 10) and got


def test_negatives_of_few_rows(spark):
    for rows in ([], _rows(1, copies=1), [(0, [1.0], 1, "", 0, 0), (1, [1.0], 1, "", 0, 0), (2, [0.9], 2, "", 0, 0)],
                 [(0, None, None, "", 0, 0)]):
        got = _found(negatives.mine_hard_negatives(spark.createDataFrame(rows, SCHEMA), "id % 10 = 0"))
        assert got == _mined(rows, 10)


def test_visits_fall_and_skip():
    rng = np.random.default_rng(0)
    bounds = (rng.normal(size=6), rng.normal(size=5))
    sizes = {(i, j): 1 for i in range(6) for j in range(5) if (i + j) % 3}
    cells, bound, popped = negatives.visits(bounds, sizes, -np.inf, 0, 10**9)
    total = [bounds[0][i] + bounds[1][j] for i, j in cells]
    assert total == sorted(total, reverse=True) and set(cells) == set(sizes) and popped == 30 and bound == -np.inf
    head, _, at = negatives.visits(bounds, sizes, -np.inf, 0, 7)
    rest, _, _ = negatives.visits(bounds, sizes, -np.inf, at, 10**9)
    assert head + rest == cells
    few, bound, _ = negatives.visits(bounds, sizes, total[4], 0, 10**9)
    assert bound < total[4] and few == [c for c, t in zip(cells, total) if t >= total[4]]


def test_negative_scores_are_exact_beyond_doubles(spark):
    x = np.array([[2**28 + 1, 3]], np.int64)
    assert negatives.products(x, x)[0, 0] == (2**28 + 1) ** 2 + 9


def _whitened(rows, k=4):
    x = [(i, [math.floor(256 * c) for c in e]) for i, e in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    size = max({len(v) for _, v in x}, key=lambda d: (sum(len(v) == d for _, v in x), d))
    x = [(i, v) for i, v in x if len(v) == size]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, total = len(fit), fit.sum(axis=0)
    e, q = np.linalg.eigh((fit - total / n).T @ (fit - total / n) / n)
    e, q = e[::-1], q[:, ::-1]
    keep = [j for j in range(min(k, len(e))) if e[j] > 1e-9 * max(e.sum(), 1e-300)]
    return [(i, n, sum((n * a - int(s)) ** 2 for a, s in zip(v, total)), (np.array(v) - total / n) @ q[:, keep] / np.sqrt(e[keep]), e[keep] / e.sum()) for i, v in x]


def _check(spark, rows, k=4):
    df = spark.createDataFrame([(i, e, 1, "a") for i, e in rows], "vec_id long, embedding array<float>, n int, component string")
    got = whitening.whiten(df, k=k).collect()
    want = _whitened(rows, k)
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    sign = {}
    for i, n, dev, y, share in want:
        assert set(by[i]) == set(range(1, len(y) + 1))
        for c, v in enumerate(y):
            for r in by[i][c + 1]:
                assert (r["n"], int(r["deviation"])) == (n, dev)
                assert r["explained"] == pytest.approx(share[c], rel=1e-9) and r["identity_error"] < 1e-8
                if abs(v) > 1e-3:
                    assert sign.setdefault(c, np.sign(v * r["whitened"])) == np.sign(v * r["whitened"])
                assert abs(r["whitened"]) == pytest.approx(abs(v), abs=1e-7)
    assert len(got) == sum(len(w[3]) for w in want)


@pytest.mark.parametrize("dim", [3, 12, 48])
def test_whitening_equals_the_eigenvectors(spark, dim):
    rng = np.random.default_rng(dim)
    x = (rng.normal(size=(300, dim)) * np.linspace(1, 0.3, dim)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[7][1]) for i in range(100)]  # a common vector counts once in the fit
    _check(spark, rows)


def test_whitening_takes_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(40, 5)).astype(np.float32))]
    rows += [(90, None), (91, []), (92, [1.0]), (93, [float("nan")] * 5), (94, [float("-inf")] * 5), (95, [None] * 5), (96, [-0.0] * 5)]
    _check(spark, rows + rows[:3])


def test_whitening_without_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(df).count() == 0 and whitening.whiten(df.where("false")).count() == 0
    flat = [(i, [float(i), 1.0, 1.0]) for i in range(9)]  # one direction holds all variance
    assert {r["component"] for r in whitening.whiten(spark.createDataFrame(flat, df.schema)).collect()} == {1}


def test_filter_needs_several_rounds(spark):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(400, 40)) * 256).astype(np.int64)
    model, _ = whitening.components(spark.createDataFrame([(v.tolist(),) for v in x], "x array<long>"), 2, guard=4)
    c = x - x.mean(axis=0)
    e = np.linalg.eigvalsh(c.T @ c / len(x))[::-1]
    assert model.passes > whitening.DEGREE and model.values == pytest.approx(e[:2], rel=1e-12) and (model.error < 1e-9).all()


def test_deviations_are_exact():
    rng = np.random.default_rng(4)
    for n, top in ((10, 50), (10**6, 10**6), (10**7, 10**7), (10**9, 10**9)):
        x = rng.integers(-top, top, (5, 6))
        s = [int(v) for v in x.sum(axis=0)]
        assert whitening.deviations(x, n, s) == [sum((n * int(a) - b) ** 2 for a, b in zip(v, s)) for v in x]
