"""Near-duplicate operators against brute force."""

import collections

import numpy as np
import pytest

from featurelens.llm import blocks, decontaminate, embeddings, ngram_join
from featurelens.llm.tables import connected_components

WORDS = [f"w{i}" for i in range(400)]


def _text(rng, n):
    return " ".join(rng.choice(WORDS, n))


def _near(rng, text, edits):
    w = text.split()
    for i in rng.choice(len(w), edits, replace=False):
        w[i] = f"x{rng.integers(1_000_000)}"
    return " ".join(w)


def _corpus():
    rng = np.random.default_rng(5)
    rows, base = [], [_text(rng, 120) for _ in range(25)]
    for t in base:
        rows += [t, t] + [_near(rng, t, int(e)) for e in rng.integers(1, 5, 6)]
    hot = _text(rng, 90)
    rows += [hot] * 40 + [_near(rng, hot, 1) for _ in range(40)]
    rows += [_text(rng, 60) for _ in range(50)] + ["", None, "one", "one", "two words", "  \n\t "]
    return list(enumerate(rows))


def _sets(rows, n=5):
    out = {}
    for i, t in rows:
        w = (t or "").split()
        out[i] = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    return out


def _classes(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("block", [256, 16])
def test_ngram_join_finds_all_links(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = _corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(df).collect()}
    sets = _sets(rows)
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j]
             and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    n = collections.Counter(x for p in links for x in p)
    want = _classes(sets, links)
    assert got == {i: (want[i], n[i]) for i in sets}


def test_ngram_join_edge_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string, size long, keys string")
    assert ngram_join.ngram_join(df).count() == 0
    df = spark.createDataFrame([(None, "a b", 1), (3, None, 1), (4, "a b", 2), (4, "a b", 2), (5, "A b", 1)],
                               "doc_id long, text string, size long")
    got = {(r.doc_id, r.class_id, r.n_links) for r in ngram_join.ngram_join(df).collect()}
    assert got == {(3, 3, 0), (4, 4, 0), (5, 5, 0)}


def test_forest_depth_is_the_longest_that_reaches_the_recall():
    d = ngram_join.forest_depth(32, 8, 0.8, 0.99999)
    assert 1 - (1 - 0.8 ** d) ** 32 >= 0.99999 > 1 - (1 - 0.8 ** (d + 1)) ** 32


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    df = spark.createDataFrame(edges + [(None, 3), (7, None)], "u long, v long")
    got = {r.id: r.component for r in connected_components(df).collect()}
    ids = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {i: c for i, c in _classes(ids, [e for e in edges if e[0] != e[1]]).items()}
    assert connected_components(df.where("u < 0")).count() == 0


def _vectors():
    rng = np.random.default_rng(3)
    rows, vid = [], 0
    for label in (1, 2):
        centres = rng.normal(size=(30, 16))
        for c in centres:
            for _ in range(6):
                rows.append((vid, (c + rng.normal(size=16) * rng.choice([0.0, 0.2, 0.35])).astype(float).tolist(), label))
                vid += 1
    hot = rng.normal(size=16).tolist()
    rows += [(vid + k, hot, 1) for k in range(50)] + [(vid + 50 + k, [2 * x for x in hot], 1) for k in range(3)]
    vid += 60
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    return rows + [(vid + k, b, 1) for k, b in enumerate(bad)] + [(vid + 20, hot, None), (vid + 21, hot[:8], 1)]


@pytest.mark.parametrize("block", [1024, 40])
def test_embedding_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.embedding_neardup(df).collect()}

    def good(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    use = [(i, np.array(v), label) for i, v, label in rows if good(v, label)]
    links = [(i, j) for a, (i, u, lu) in enumerate(use) for j, v, lv in use[a + 1:]
             if lu == lv and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.93]
    n = collections.Counter(x for p in links for x in p)
    want = _classes([r[0] for r in rows], links)
    assert got == {i: (n[i], c, i == c) for i, c in want.items()}


def test_embedding_empty_table_and_repeats(spark):
    schema = "vec_id long, embedding array<float>, label string, n_links long"
    assert embeddings.embedding_neardup(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(1, [1.0, 0.0], "a", 9), (1, [1.0, 0.0], "a", 9), (2, [1.0, 0.0], "b", 9), (None, [1.0, 0.0], "a", 9)], schema)
    assert {(r.vec_id, r.n_links) for r in embeddings.embedding_neardup(df).collect()} == {(1, 0), (2, 0)}


def test_collisions_count_windows():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(30, 7)), rng.normal(size=(21, 7))
    want = (np.abs(a[:, None, :] - b[None, :, :]) <= 0.4).sum(axis=2)
    assert (embeddings.collisions(a, b, 0.4) == want).all()


def test_contained_items_are_found_wherever_they_stand(spark):
    rng = np.random.default_rng(8)
    items = [(i, _text(rng, int(n))) for i, n in enumerate(rng.integers(1, 70, 40))] + [(90, None), (91, ""), (92, "  ")]
    items.append((3, items[3][1]))
    docs = []
    for d in range(120):
        w = _text(rng, int(rng.integers(1, 3000))).split()
        if d % 3 == 0:
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = _near(rng, items[d % 40][1].upper() if d % 2 else items[d % 40][1], 0).split()
        docs.append((d, " ".join(w), 1))
    docs += [(200, None, 1), (201, "", 1), (None, items[1][1], 1), (5, docs[5][1], 1)]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string, item_id int"),
                                     spark.createDataFrame(items, "item_id long, text string"), block_items=15)
    got = {(r.doc_id, r.item_id): r.containment for r in got.collect()}
    ds, qs = _sets([(d, (t or "").lower()) for d, t, _ in docs if d is not None]), _sets([(i, (t or "").lower()) for i, t in items])
    want = {(d, i): len(q & s) / len(q) for d, s in ds.items() for i, q in qs.items() if q and len(q & s) >= 0.8 * len(q)}
    assert got == want and len(want) >= 30


def test_no_items_no_pairs(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, none).count() == 0
    assert decontaminate.contaminated(docs.limit(0), docs.selectExpr("doc_id as item_id", "text")).count() == 0


def test_spanning_forest():
    u, v = np.array([0, 1, 0, 3]), np.array([1, 2, 2, 4])
    assert blocks.spanning_forest(5, u, v) == [(0, 1), (1, 2), (3, 4)]


def test_every_text_of_an_item_is_searched(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    items = spark.createDataFrame([(1, a), (1, b), (2, b), (2, b), (3, b + " more")], "item_id long, text string")
    docs = spark.createDataFrame([(10, "start " + a + " end"), (11, b), (12, a + " " + b), (13, "none of it")], "doc_id long, text string")
    for chars in (16 << 20, 1):  # one block, and a block for each text
        got = {(r["doc_id"], r["item_id"]): (r["containment"], r["n_item"]) for r in decontaminate.contaminated(docs, items, block_chars=chars).collect()}
        assert got == {(10, 1): (1.0, 16), (11, 1): (1.0, 16), (11, 2): (1.0, 16), (11, 3): (16 / 17, 17),
                       (12, 1): (1.0, 16), (12, 2): (1.0, 16), (12, 3): (16 / 17, 17)}
