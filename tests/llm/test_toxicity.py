"""Toxicity by compression distance: held-out accuracy and odd rows."""

import zlib

import numpy as np

from featurelens.llm import toxicity

SCHEMA = "doc_id long, text string, score string, y int"


def _texts(n=900, seed=6):
    rng = np.random.default_rng(seed)
    parts = ["the", "er", "in", "on", "re", "an", "th", "nd", "es", "ti", "or", "at"]
    vocab = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(600)]
    bad = ["grumblix", "snarfel", "wuzzock", "drabnok", "flimpert"]
    out = []
    for i in range(n):
        words = list(rng.choice(vocab, rng.integers(40, 200)))
        toxic = i % 5 == 0
        for p in (rng.choice(len(words), max(2, len(words) // 15), replace=False) if toxic else []):
            words[p] = str(rng.choice(bad))
        out.append((i, " ".join(words), "x", int(toxic)))
    return out


def test_held_out_texts_are_told_apart(spark):
    rows = _texts()
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = docs.selectExpr("doc_id", "y as toxic", "1 as score")
    got = {r["doc_id"]: r for r in toxicity.label_toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (i in set(held)) for i, *_ in rows)
    truth = {i: y for i, _, _, y in rows}
    hit = [got[i]["predicted"] == truth[i] for i in held]
    assert np.mean(hit) > 0.95
    assert np.mean([got[i]["predicted"] for i in held if truth[i]]) > 0.85
    assert np.mean([got[i]["predicted"] for i in held if not truth[i]]) < 0.03
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_odd_rows_and_labels(spark):
    rows = _texts(150)
    odd = [(1000, None, None, None), (1001, "", "", 0), (1002, " \n ", "", 0), (None, "the in", "", 0), (1003, rows[0][1] * 400, "", 1), rows[3], rows[3]]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    labels = spark.createDataFrame([(i, y) for i, _, _, y in rows] + [(None, 1), (4, 0), (4, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    got = toxicity.label_toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["score"], r["predicted"]))
    assert len(by[rows[3][0]]) == 1
    assert by[1000] == by[1001] == by[1002]
    assert toxicity.label_toxicity(docs.where("false"), labels).count() == 0
    none = toxicity.label_toxicity(docs, labels.where("false")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}


def test_windows_keep_every_word():
    text = ("Word " * 100 + "ENd.").encode()
    assert b" ".join(toxicity.windows(text)).split() == [b"word"] * 100 + [b"end"]
    assert toxicity.windows(b"") == toxicity.windows(b" .. ") == [b"  "]


def test_batched_lengths_are_the_compressor_s():
    by = toxicity.compressor(b"some words that come again and again " * 5)
    wins = toxicity.windows(b"some words come again " * 200) + [b"", b"x"]
    assert toxicity.lengths(wins, by).tolist() == [len(by.compress(w)) for w in wins]


def test_no_labels_of_one_class():
    assert toxicity.fit([], [b"a"] * 9) == {} and toxicity.predict({}, [b"a", b""], []).tolist() == [0, 0]
