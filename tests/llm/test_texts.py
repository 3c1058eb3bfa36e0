"""Extraction, scoring, licences, mixing, quality, line dedup and personal
data against brute force on small tables."""

import collections
import hashlib
import math
import os
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featurelens.llm import html_diff, katz, licenses, line_dedup, mixing, pii, quality, tokens as T
from featurelens.llm.tables import stage
from featurelens.session import checkpoint_dir

SPACE = r"[^\x20\x09-\x0D]+"


# --- token helpers -------------------------------------------------------

def test_word_hashes_follow_words_only():
    texts = ["a bb  ccc", None, "", " bb\ta\n", "CCC bb", "x" * 50, "a\x0bbb\xa0"]
    words, ptr = T.hashed_words(pa.array(texts), True)
    got = [list(words[a:b]) for a, b in zip(ptr[:-1], ptr[1:])]
    seen = {}
    for t, h in zip(texts, got):
        own = re.findall(SPACE, (t or "").lower())
        assert len(own) == len(h)
        for w, x in zip(own, h):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_long_texts_hash_as_in_pieces():
    rng = np.random.default_rng(0)
    words = ["".join(map(chr, rng.integers(97, 123, int(n)))) for n in rng.integers(1, 12, 300_000)]
    whole, _ = T.hashed_words(pa.array([" ".join(words)]), False)
    each, _ = T.hashed_words(pa.array(words), False)
    assert (whole == each).all()


def test_shingles_of_short_texts():
    sh, ptr = T.shingles(*T.hashed_words(pa.array(["a b", "a b c d e f", "", "a b c d e", "a b"]), False), 5)
    assert list(np.diff(ptr)) == [1, 2, 0, 1, 1]
    assert sh[0] == sh[4] and sh[1] == sh[3] and sh[0] != sh[1]


# --- op1 -----------------------------------------------------------------

def _lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 6, int(rng.integers(0, 15))).tolist() for _ in range(2))
        at = html_diff.shared_lines(a, b)
        assert len(at) == _lcs(a, b)
        it = iter(b)
        assert all(a[i] in it for i in at)


ARTICLE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
<body><header>no</header><nav><ul><li><a href="/x>y">no</a></li></ul></nav><!-- no --><div class="ad top">no</div>
<article><header><h1>A &amp; B</h1></header><p><b>One&nbsp; two<br>three<p>x &lt; y &#233; <i>z</i>!</p><form>no</form>
<div id="comments"><p>no</p></div><p>last</p></article><aside>no</aside><footer>&copy; no</footer>"""


def test_article_blocks():
    text = html_diff.page_lines(ARTICLE)
    assert [x for x, z in text if z == html_diff.MAIN] == ["A & B", "One two three", "x < y é z!", "last"]
    assert all(z == html_diff.OFF for x, z in text if x in ("no", "© no"))


@pytest.mark.parametrize("page", ["<", "<p", "<p a='", "<script>x", "<!--", "</p></article>", "a<b c", "<svg/><p>x", "<" * 5000])
def test_broken_markup(page):
    html_diff.page_lines(page)


def test_pages_without_article_lose_shared_lines(spark):
    def page(i, body):
        return f"<html><body><div>Site name</div><p>Menu {i % 1}</p>{body}<p>Imprint</p></body></html>"
    rows = [(i, f"https://h.org/a/{i:03d}", page(i, f"<p>Story {i}</p><p>more of {i}</p><p>end {i}</p>"), "x") for i in range(300)]
    rows += [(900, "https://other.org/a", page(0, "<p>alone</p>"), "x"), (901, None, ARTICLE, "x"), (902, "https://h.org/b", None, "x"),
             (903, "not a url", "", "x"), (904, "https://h.org/a/000", rows[0][2], "x"), (901, None, ARTICLE, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    got = collections.defaultdict(list)
    for r in html_diff.extract_main_text(df).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert all(got[i] == [f"Story {i}\nmore of {i}\nend {i}"] for i in range(300))
    assert got[900] == ["Site name\nMenu 0\nalone\nImprint"] and got[902] == got[903] == [""]
    assert got[901] == ["A & B\nOne two three\nx < y é z!\nlast"] * 2 and got[904] == got[0]
    assert html_diff.extract_main_text(df.limit(0)).count() == 0


# --- op5 -----------------------------------------------------------------

def _tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(SPACE, low) + ["</s>"]


@pytest.mark.parametrize("hot_share,size", [(4000, 60), (5, 60), (5, 3)])
def test_katz_matches_brute_force_and_is_normalised(spark, monkeypatch, hot_share, size):
    monkeypatch.setattr(katz, "HOT_SHARE", hot_share)
    rng = np.random.default_rng(4)
    vocab = [f"w{i}" for i in range(60)]
    p = 1 / np.arange(1, 61) / (1 / np.arange(1, 61)).sum()
    rows = [(i, " ".join(rng.choice(vocab, int(n), p=p))) for i, n in enumerate(rng.integers(1, 80, size))]
    rows += [(900, None), (901, ""), (902, "new words W1 new"), (None, "w1 w2"), (1, "w3 w3")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = collections.defaultdict(list)
    for r in katz.katz_scores(df, group_bytes=500).collect():
        got[r.doc_id].append(r)
    toks = [(i, _tokens(t)) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    uni, bi = collections.Counter(), collections.Counter()
    for (_, t), h in zip(toks, held):
        if not h:
            uni.update(t)
            bi.update(zip(["<s>"] + t[:-1], t))
    n, v = sum(uni.values()), len(uni)
    z = n + v + 1
    disc = katz.discounts(np.array([sum(c == k for c in bi.values()) for k in range(1, katz.GT + 2)]))
    after = collections.defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c

    def prob(h, w):
        base = (uni[w] + 1) / z
        if h not in after:
            return base
        f = after[h]
        total, left = sum(f.values()), sum((1 - disc[c - 1]) * c for c in f.values() if c <= katz.GT)
        whole = left <= 0
        mass = total + whole
        if w in f:
            return f[w] * (disc[f[w] - 1] if f[w] <= katz.GT and not whole else 1) / mass
        return (1 if whole else left) / mass / (1 - sum(uni[x] + 1 for x in f) / z) * base

    for h in [*after, "nowhere"]:
        assert math.isclose(sum(prob(h, w) for w in uni) + prob(h, "@unknown"), 1, rel_tol=1e-9)
    want = collections.defaultdict(list)
    for (i, t), h in zip(toks, held):
        want[i].append((h, len(t), sum(w in uni for w in t), n, round(sum(math.log10((uni[w] + 1) / z) for w in t), 6),
                        round(sum(math.log10(prob(a, b)) for a, b in zip(["<s>"] + t[:-1], t)), 6)))
    found = {i: sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rs)
             for i, rs in got.items()}
    assert found == {i: sorted(x) for i, x in want.items()}
    assert katz.katz_scores(df.limit(0)).count() == 0


# --- op6 -----------------------------------------------------------------

def test_licenses_and_inheritance(spark):
    prose = " ".join(f"word{i}" for i in range(300))
    rows = [(1, "p/LICENSE", f"Preface.\nReleased under\nthe MIT License.\n{prose}"), (2, "p/a/x.py", prose),
            (3, "p/a/b/y.py", prose + "\nAll rights reserved."), (4, "p/a/b/COPYING", "Licensed under CC BY-NC 4.0."),
            (5, "p/a/b/c/z.py", prose), (6, "q/x.py", prose), (7, None, "Licensed under CC BY 4.0."), (8, "p/a/b/k.py", None), (9, "p/e.py", ""),
            (10, "p/a/b/c/w.py", "licensed under the apache license version 2.0"), (2, "p/a/x.py", prose)]
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, path string, text string, license string").repartition(3)
    got = collections.defaultdict(list)
    for r in licenses.scan_licenses(df).collect():
        got[r.doc_id].append((r.own_license, r.license, r.inherited_from))
    assert {k: v[0] for k, v in got.items()} == {
        1: ("MIT", "MIT", None), 2: (None, "MIT", "p"), 3: ("Proprietary", "Proprietary", None), 4: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
        5: (None, "Apache-2.0", "p/a/b/c"), 6: (None, None, None), 7: ("CC-BY-4.0", "CC-BY-4.0", None), 8: (None, "CC-BY-NC-4.0", "p/a/b"),
        9: (None, "MIT", "p"), 10: ("Apache-2.0", "Apache-2.0", None)}
    assert len(got[2]) == 2
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_licences_are_sought_in_every_window(spark):
    # the two rarest words of the template are not in the text, and one word is new
    templates = [("X", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu")]
    text = "one two alpha new gamma delta epsilon zeta eta theta iota kappa lambda end"
    df = spark.createDataFrame([(1, "a.py", text), (2, "b.py", "alpha beta gamma"), (3, "c.py", "beta mu " * 2)], "doc_id long, path string, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(df, templates=templates).collect()}
    words = [x.text.split() for x in df.collect()]
    want = {w: math.log((1 + 3) / (1 + sum(w in x for x in words))) + 1 for x in [*words, templates[0][1].split()] for w in x}
    other = math.log(1 + 3) + 1

    def cosine(window):
        t, own = collections.Counter(templates[0][1].split()), collections.Counter(window)
        weight = {w: want[w] if w in t else other for w in own}
        dot = sum(own[w] * weight[w] * t[w] * want[w] for w in own if w in t)
        return dot / math.sqrt(sum((own[w] * weight[w]) ** 2 for w in own) * sum((c * want[w]) ** 2 for w, c in t.items()))

    for i, x in enumerate(words, 1):
        best = max(cosine(x[s:s + 12]) for s in range(len(x)))
        assert got[i].own_license == ("X" if best >= 0.8 else None)
        assert best < 0.8 or got[i].own_score == pytest.approx(best)
    assert got[1].own_license == "X"


def test_standard_headers_and_heads_are_licences(spark):
    header = ("This program is free software{} you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
              "# the Free Software Foundation{} either version {} of the License, or\n# (at your option) any later version.\n")
    texts = {"GPL-3.0": header.format(":", ",", 3), "GPL-2.0": header.format(";", ";", 2),
             "ISC": "Copyright (c) 2020 A B\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
                    "copyright notice and this permission notice appear in all copies.\n",
             "Unlicense": "This is free and unencumbered software released into the public domain.\n",
             "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE\n Version 2.1, February 1999\n"}
    prose = " ".join(f"word{i}" for i in range(200))
    rows = [(k, f"{k}/LICENSE", x) for k, x in texts.items()] + [(k + " child", f"{k}/a/b.py", prose) for k in texts]
    got = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id string, path string, text string")).collect()}
    assert {k: got[k].own_license for k in texts} == {k: k for k in texts}
    assert {k: got[k + " child"].license for k in texts} == {k: k for k in texts}


# --- op7 -----------------------------------------------------------------

def _targets(sizes, weights, cap=3):
    total, full = sum(sizes), set()
    while True:
        rest = total - sum(cap * sizes[i] for i in full)
        w = sum(weights[i] for i in range(len(sizes)) if i not in full)
        new = {i for i in range(len(sizes)) if i not in full and rest / w * weights[i] > cap * sizes[i]} if w else set()
        if not new:
            return [cap * s if i in full else rest / w * weights[i] for i, s in enumerate(sizes)]
        full |= new


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1], [1, 1000, 50, 3, 0, 700, 20, 1]])
def test_mix_targets(spark, sizes):
    docs = [(1000 * i + k, "w " * 5, f"s{i}") for i, s in enumerate(sizes) for k in range(s)]
    docs += [(1000 * i + 999, "", f"s{i}") for i in range(len(sizes))]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    rows = mixing.mix_sources(df).collect()
    assert len(rows) == len(docs)
    want = _targets([5 * s for s in sizes], [[5, 2, 1][i % 3] for i in range(len(sizes))])
    taken = collections.Counter()
    for r in rows:
        i = r.doc_id // 1000
        assert r.source_size == 5 * sizes[i] and math.isclose(r.target, want[i], rel_tol=1e-9)
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        taken[i] += r.taken
    assert all(abs(taken[i] - t) <= 2.5 for i, t in enumerate(want))
    again = {(r.doc_id, r.taken) for r in mixing.mix_sources(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mix_nulls_repeats_weights_and_empty(spark):
    docs = [(1, None, "a"), (2, "x y", None), (2, "x y", None), (None, "x", "b"), (3, "x y z", "b")] + [(10 + k, "x y", "b") for k in range(50)]
    df = spark.createDataFrame([(*d, 1.0 + d[0] % 3 if d[0] else 1.0, "n") for d in docs],
                               "doc_id long, text string, source string, w double, target string")
    rows = mixing.mix_sources(df).collect()
    assert len(rows) == len(docs) and {r.source_size for r in rows if r.doc_id == 2} == {4}
    assert all(r.taken <= 3 * r.size for r in rows)
    heavy = mixing.mix_sources(df, doc_weight="w").collect()
    by = collections.Counter()
    for r in heavy:
        assert r.taken <= 3 * r.size
        by[r.source_size] += r.taken
    target = {r.source_size: r.target for r in heavy}
    assert all(abs(by[s] - t) <= 3 for s, t in target.items())
    assert mixing.mix_sources(df.limit(0)).count() == 0


# --- op8 -----------------------------------------------------------------

def _graded(rng, n):
    vocab = [f"common{i}" for i in range(300)]
    rows = []
    for i in range(n):
        g = i % 3
        w = rng.choice(vocab, int(rng.integers(10, 200))).tolist()
        if g == 0:
            w = [x.upper() + "!!" for x in w[:5]] * 8
        if g == 1:
            for k in range(0, len(w), 12):
                w[k] = f"nasty{rng.integers(4)}"
        rows.append((i, " ".join(w), g))
    return rows


def test_ordinal_classifier_on_held_out_rows(spark):
    rows = _graded(np.random.default_rng(6), 1500)
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, grade int, score string").repartition(4)
    model = quality.fit_ordinal(df.where("doc_id < 1100"), 3)
    w, cut = model
    assert cut[0] < cut[1]
    test = quality.score(df.where("doc_id >= 1100").drop("score"), model).collect()
    assert np.mean([round(r.expected_grade) == r.grade for r in test]) > 0.95
    assert all(0 <= r.tail_2 <= r.tail_1 <= 1 and math.isclose(r.expected_grade, r.tail_1 + r.tail_2) for r in test)
    again = quality.fit_ordinal(df.repartition(7).where("doc_id < 1100"), 3)
    assert (again[0] == w).all() and (again[1] == cut).all()


def test_classifier_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "a b", 0), (3, "x " * 50_000, 0), (3, "c", 0)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, None, 1), (2, 0, None), (3, 1, 0), (3, 1, 1), (None, 1, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.select_quality(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.expected_grade <= 2 for r in rows)
    assert quality.select_quality(docs.limit(0), labels).count() == 0
    assert quality.select_quality(docs, labels.limit(0)).count() == 5


# --- op9 -----------------------------------------------------------------

def _line_classes(docs, q=5, t=0.8):
    at = collections.defaultdict(list)
    for d, text in docs:
        for p, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                at[line.strip(" ")].append((d, p))
    lines = list(at)
    sets = [{x[i:i + q] for i in range(len(x) - q + 1)} or {x} for x in lines]
    root = list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, x in enumerate(lines):
        groups[find(i)] += at[x]
    return {min(g) for g in groups.values()}


def test_line_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghéñ漢"), int(n))) for n in rng.integers(2, 9, 500)]
    base = [" ".join(rng.choice(words, int(n))) for n in rng.integers(1, 40, 150)]
    docs = []
    for d in range(200):
        lines = []
        for k in rng.integers(0, 150, int(rng.integers(0, 9))):
            w = base[k].split(" ")
            if rng.random() < 0.4 and len(w) > 12:
                w[int(rng.integers(len(w)))] = "changed"
            lines.append(rng.choice(["", " "]) + " ".join(w))
            if rng.random() < 0.2:
                lines.append("")
        docs.append((d, "\n".join(lines)))
    docs += [(300, None), (301, ""), (302, "\n\n"), (303, "a\na \n a")]
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, n_lines int").repartition(4)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    first = _line_classes(docs)
    bad = 0
    for d, text in docs:
        if text is None:
            assert got[d].text is None and got[d].n_lines == 0
            continue
        kept = [x for p, x in enumerate(text.split("\n")) if not x.strip(" ") or (d, p) in first]
        bad += got[d].text != "\n".join(kept)
        assert got[d].n_lines - got[d].n_removed == sum(bool(x.strip(" ")) for x in got[d].text.split("\n"))
    assert bad <= 3 and len(got) == len(docs)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_finds_lines_with_changes_in_many_words(spark):
    rng = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    docs, pairs = [], 0
    for d in range(60):
        line = " ".join("".join(rng.choice(letters, int(n))) for n in rng.integers(3, 9, 40))
        other = list(line)
        sets = [{x[i:i + 5] for i in range(len(x) - 4)} for x in (line, line)]
        while True:  # letters change far apart while the lines stay similar
            changed = list(other)
            changed[int(rng.integers(len(other)))] = "#"
            sets[1] = {"".join(changed)[i:i + 5] for i in range(len(changed) - 4)}
            if len(sets[0] & sets[1]) < 0.8 * len(sets[0] | sets[1]):
                break
            other = changed
        docs += [(2 * d, line), (2 * d + 1, "".join(other))]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [k for k, x in docs if got[k] != (x if k % 2 == 0 else "")] == []


def test_line_dedup_compares_all_lines_of_a_band(spark):
    met = spark.createDataFrame([(1, 1, 10, 1), (1, 2, 10, 1), (1, 3, 10, 1), (1, 4, 5, 1), (2, 5, 10, 5), (2, 6, 10, 5), (2, 7, 10, 5), (3, 8, 9, 8), (3, 9, 9, 8)],
                                "band long, lid long, n int, partner long")
    comps = spark.createDataFrame([(6, 5), (7, 5), (5, 5)], "lid long, cid long")
    assert sorted(map(tuple, line_dedup.candidate_pairs(met).collect())) == [(1, 2), (1, 3), (1, 4), (5, 6), (5, 7), (8, 9)]
    assert [tuple(r) for r in line_dedup.remaining_pairs(met, comps, 0.8).collect()] == [(2, 3)]


def test_line_dedup_lets_unlike_lines_of_a_band_go(spark):
    rng = np.random.default_rng(11)
    lines = [" ".join(rng.choice(["tion", "the", "and", "ou", "er", "in"], 3)) + str(i % 7) for i in range(400)]
    met = line_dedup.meetings(spark.createDataFrame(list(enumerate(lines)), "id long, text string"), 24, 4, 5)
    groups = collections.Counter(r.band for r in met.collect())
    assert [r for r in met.where("not alike").collect() if groups[r.band] < 2] == []


def test_freed_stage_leaves_no_shuffle_files(spark):
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("\n").split("\n") if "shuffle_" in f}

    before = held()
    out = stage(spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count(), "freed", free=True)
    for _ in range(50):
        left = held() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and out.count() == 1000


def test_line_dedup_compares_sketches_of_both_halves(spark):
    # lines 2 and 3 agree in one half only, 2 and 4 in both, 5 has one half
    met = spark.createDataFrame([(1, k, 1) for k in (1, 2, 3, 4, 5)], "band long, lid long, partner long")
    far = int("0o" + "3" * 21, 8)
    sketches = spark.createDataFrame([(1, [0, 0]), (2, [0, 0]), (3, [0, far]), (4, [0, 0]), (5, [None, far])], "lid long, sketch array<long>")
    none = spark.createDataFrame([], "lid long, cid long")
    pairs = line_dedup.remaining_pairs(met, none, 0.8, line_dedup._alike_both("us", "vs", 24, 4), sketches)
    assert sorted(map(tuple, pairs.collect())) == [(2, 4), (2, 5), (3, 5), (4, 5)]


def test_line_dedup_leaves_no_signatures_behind(spark):
    def held():
        return {f for f in os.listdir(folder) if f.startswith(("line-signatures", "line-meetings"))} if os.path.isdir(folder) else set()

    folder = f"{checkpoint_dir(spark)}/featurelens-scratch"
    before = held()
    df = spark.createDataFrame([(1, "some line of words\nanother one"), (2, "some line of words")], "doc_id long, text string")
    assert line_dedup.dedup_lines(df).count() == 2 and held() <= before


def test_line_dedup_repeated_rows_stay_alike(spark):
    df = spark.createDataFrame([(1, "same\nother"), (1, "same\nother"), (2, "same"), (None, "other")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text) for r in line_dedup.dedup_lines(df).collect())
    assert got == [("1", "same"), ("1", "same"), ("2", ""), ("None", "other")]


# --- op10 ----------------------------------------------------------------

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def _base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 16 <= len(d) <= 19 and _luhn(d) or kind == "phone" and 8 <= len(d) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_match_the_rules(spark):
    rng = np.random.default_rng(7)
    parts = ["a.b@c.de", "x@y", "q@w@e.r.t", "a@b.c%d@e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1", "000255.1.1.1", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "378282246310005", "+1 (415) 555-0100", "+49 30 1234567", "+1234", "++1 2 3", "é", "漢字", "\n", "  ", "0000000000000000",
             "12345678901234567890", "+1 555 123 4567 4111111111111111", "%", "-", "word", "@", ".", "😀"]
    rows = [(i, "".join(rng.choice(parts, int(n)))) for i, n in enumerate(rng.integers(0, 25, 400))]
    rows += [(500 + i, " ".join(rng.choice(parts, int(n)))) for i, n in enumerate(rng.integers(0, 25, 400))]
    rows += [(1000, None), (1001, ""), (1002, "a@b.cc " * 1500 + "é1.1.1.1"), (1003, "1" * 30_000), (1003, "1" * 30_000), (None, "a@b.cc")]
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, found string").repartition(4)
    got = collections.defaultdict(list)
    for r in pii.digest(pii.find_pii(df)).collect():
        got[r.doc_id].append(r)
    for i, text in rows:
        base = _base(text)
        for r in got[i]:
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (i, base, r.spans)
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(base.count(k) for k in RULES)
            assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert sum(map(len, got.values())) == len(rows)
    assert pii.find_pii(df.limit(0)).count() == 0


def test_patterns_find_unseen_identifiers(spark):
    rng = np.random.default_rng(1)
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "6011000990139424"]
    rows = [(i, f"text card: {c} expires soon {rng.integers(9999)}") for i, c in enumerate(cards * 3)]
    rows += [(50, "text card: 4111111111111112 expires soon"), (51, "the id 4111111111111112 stands elsewhere"),
             (52, "key: AKIA123456 expires"), (53, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert [(f.kind, f.start, f.end, f.token) for f in got[50].found] == [("card", 11, 27, "4111111111111112")]
    assert all(not r.found for i, r in got.items() if i != 50)


def test_patterns_find_what_no_rule_matches(spark):
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "6011000990139424"]
    rows = [(i, f"ring +1 (743) 555-38{i:02} tonight or pay card {cards[i % 4]} promptly") for i in range(40)]
    rows += [(40 + i, f"mail anna{i}@mail.example.com today") for i in range(5)]
    rows += [(50, "so ring (743) 555-3824 tonight"), (51, "card 4111 1111 1111 1112, promptly"), (52, "please ring 0743 555 3825"),
             (53, 'mail "bert.miller[at]mail.example.com" today'), (54, "we pay 4111-1111-1111-1113 promptly"),
             (55, "room (743) 555-3826 elsewhere"), (56, "ring 7 tonight")]
    # accepted in the first round, these induce "dial" for the second
    rows += [(60 + i, f"ring 0743 555 91{i:02} tonight") for i in range(10)]
    rows += [(70 + i, f"dial 0743 555 91{i:02}") for i in range(10)] + [(80, "dial 0743 555 9999")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [(f.kind, f.token) for f in r.found] for r in pii.find_pii(df).collect()}
    assert got[50] == [("phone", "(743) 555-3824")]
    assert got[51] == [("card", "4111 1111 1111 1112")]
    assert got[52] == [("phone", "0743 555 3825")]
    assert got[53] == [("email", "bert.miller[at]mail.example.com")]
    assert got[54] == [("card", "4111-1111-1111-1113")]
    assert got[80] == [("phone", "0743 555 9999")]
    assert all(not got[i] for i in (*range(45), 55, 56))
    text = dict(rows)
    for r in pii.find_pii(df).collect():
        assert all(text[r.doc_id][f.start:f.end] == f.token for f in r.found)


def test_pii_takes_time_in_proportion_to_the_matches(spark):
    import time

    def seconds(n):
        docs = spark.createDataFrame([(1, "lorem a1b2 ip 10.0.0.1 " * n)], "doc_id long, text string")
        began = time.time()
        got = pii.digest(pii.find_pii(docs, rounds=0)).first()
        assert got["n_ip"] == n and got["spans"].endswith(f":{23 * n - 1}")
        return time.time() - began

    seconds(100)
    small, large = seconds(4000), seconds(16000)
    assert large < 10 * small + 2  # four times the matches; 370 kB


def test_pii_of_a_megabyte_of_matches(spark):
    docs = spark.createDataFrame([(1, "write to a@b.cc or not " * 45_000)], "doc_id long, text string")
    assert pii.digest(pii.find_pii(docs)).first()["n_email"] == 45_000
