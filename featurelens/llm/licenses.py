"""Licence scan: TF-IDF cosine to templates, then inheritance by path.

Every window of a text, of every template's length and from every word on
(shorter at the end), is searched whatever its line breaks: running sums bound
all windows' cosines from above, and those that can reach ``threshold`` are
computed. Weights are term frequency times inverse document frequency over all
documents; a word outside the templates weighs as one that no document holds. A
document's own licence is the best match of cosine ``threshold`` or more.
Templates are short statements, the standard headers of files and the heads or
first sentences of licence bodies; of near alike ones the best counts.

A licence file is a document named like one (LICENSE, COPYING, NOTICE, ...) or
whose whole text is a template. Documents without a licence of their own
inherit from the licence file of the nearest ancestor directory: distinct
directories are joined with the directories of the licence files, then the
documents with their directory's result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featurelens.llm import tokens as T
from featurelens.llm.quality import _KIND
from featurelens.llm.tables import ready, stage

_HEADER = ("This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} License as published by "
           "the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version.")

# The statements by which works name their licence, the headers
# that licences give for files, and how their texts begin.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Proprietary", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", _HEADER.format("program", ":", "General Public", ",", "3")),
    ("GPL-2.0", _HEADER.format("program", ";", "General Public", ";", "2")),
    ("LGPL-3.0", _HEADER.format("library", ":", "Lesser General Public", ",", "3")),
    ("LGPL-2.1", _HEADER.format("library", ";", "Lesser General Public", ";", "2.1")),
    ("AGPL-3.0", _HEADER.format("program", ":", "Affero General Public", ",", "3")),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\""),
)
FILES = r"(?i)(?:^|/)(?:licen[cs]e|copying|copyright|notice)(?:[._-][^/]*)?$"


def _words(col):
    """Hashed runs of letters and digits, A-Z as a-z."""
    data, offs = T.text_buffer(col)
    starts, ends, ptr = T.word_bounds(data, offs, _KIND[data] == 1)
    return T.word_hashes(data, starts, ends, True), ptr


def _places(vocab, words):
    """Position of each word in the sorted vocabulary, -1 if absent."""
    at = np.minimum(np.searchsorted(vocab, words), len(vocab) - 1)
    return np.where(vocab[at] == words, at, -1)


class _Templates:
    def __init__(self, templates, df, n_docs):
        words, ptr = _words(pa.array([t for _, t in templates]))
        self.names = [name for name, _ in templates]
        self.vocab = np.unique(words)
        idf = np.log((1 + n_docs) / (1 + df)) + 1
        self.idf, self.other = idf, np.log(1 + n_docs) + 1
        self.items = []
        for a, z in zip(ptr[:-1], ptr[1:]):
            own = np.searchsorted(self.vocab, words[a:z])
            weight = np.bincount(own, minlength=len(self.vocab)) * idf
            self.items.append((int(z - a), weight, float(np.sqrt((weight ** 2).sum()))))

    def cosine(self, window, k):
        """Cosine of a window (vocabulary positions, -1 outside, and the
        words' hashes) with template k."""
        at, words = window
        _, weight, norm = self.items[k]
        tf = np.bincount(at[at >= 0], minlength=len(self.vocab)) * self.idf
        _, others = np.unique(words[at < 0], return_counts=True)
        size = np.sqrt((tf ** 2).sum() + ((others * self.other) ** 2).sum())
        return float(tf @ weight / (size * norm)) if size else 0.0


def _frequencies(vocab):
    def run(batches):
        df, n = np.zeros(len(vocab), np.int64), 0
        for whole in batches:
            for b in T.text_slices(whole, "text"):
                words, ptr = _words(b["text"])
                at = _places(vocab, words)
                doc = np.repeat(np.arange(b.num_rows), np.diff(ptr))[at >= 0]
                df += np.bincount(np.unique(doc * len(vocab) + at[at >= 0]) % len(vocab), minlength=len(vocab))
                n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(vocab) + 1)), pa.array(np.concatenate([df, [n]]))], ["term", "n"])
    return run


def _scan(model: _Templates, threshold: float):
    def windows(at, ptr):
        """(text, start, end, template) of all windows that can reach the
        threshold, from the texts' words (vocabulary positions, -1 outside)."""
        own = np.append(model.idf, model.other)[at] ** 2  # -1: the last
        norms = np.concatenate([[0.0], np.cumsum(own)])
        ends, begin = np.repeat(ptr[1:], np.diff(ptr)), np.arange(len(at))
        found = []
        for k, (n, weight, norm) in enumerate(model.items):
            part = np.append(model.idf * weight, 0.0)[at]
            dots = np.concatenate([[0.0], np.cumsum(part)])
            to = np.minimum(begin + n, ends)
            # repeated words add to a window's norm: this is not over it
            low = np.sqrt(np.maximum(norms[to] - norms[begin], 1.0))
            hit = np.flatnonzero((dots[to] - dots[begin]) >= (threshold - 1e-6) * norm * low)
            found.append(np.stack([np.searchsorted(ptr, hit, "right") - 1, hit, to[hit], np.full(len(hit), k)], 1))
        found = np.concatenate(found)
        return found[np.lexsort((found[:, 1], found[:, 3], found[:, 0]))]

    def matches(near, at, words):
        """Best licences of one text: overlapping matches leave the best."""
        found = []
        for _, s, e, k in near.tolist():
            c = model.cosine((at[s:e], words[s:e]), k)
            if c >= threshold:
                found.append((-c, -(e - s), s, e, k))
        best = []
        for c, _, s, e, k in sorted(found):
            if all(e <= s2 or s >= e2 for _, s2, e2, _ in best):
                best.append((-c, s, e, k))
        return best

    def run(batches):
        for whole in batches:
            for b in T.text_slices(whole, "text"):
                words, ptr = _words(b["text"])
                at, rows = _places(model.vocab, words), []
                near = windows(at, ptr)
                first = np.searchsorted(near[:, 0], np.arange(b.num_rows + 1))
                for i in range(b.num_rows):
                    s, e = first[i], first[i + 1]
                    best = matches(near[s:e], at, words) if e > s else []
                    names = sorted({model.names[k] for *_, k in best})
                    n = max(1, ptr[i + 1] - ptr[i])
                    rows.append((model.names[best[0][3]] if best else None, best[0][0] if best else None, ",".join(names),
                                 bool(best and best[0][2] - best[0][1] >= 0.9 * n)))
                kinds = (pa.string(), pa.float64(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [b["id"], b["path"], *[pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)]],
                    ["id", "path", "own_license", "own_score", "licenses", "whole"])
    return run


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path",
                  templates=TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """One row per document: (id_col, path, own_license, own_score, licenses,
    license, inherited_from).

    ``licenses`` lists all licences found in the text, ``license`` is the own
    one, else the inherited one of the directory ``inherited_from``, else
    null. Null and empty texts have no licence of their own; a null path
    inherits nothing; of several licence files in a directory the best scored
    counts (then the first path); repeated rows stay.
    """
    ready(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    vocab = np.unique(_words(pa.array([t for _, t in templates]))[0])
    # one number per template word
    df = {r["term"]: r["s"] for r in src.mapInArrow(_frequencies(vocab), "term long, n long").groupBy("term").agg(F.sum("n").alias("s")).collect()}
    counts = np.array([df.get(i, 0) for i in range(len(vocab))], float)
    model = _Templates(templates, counts, df.get(len(vocab), 0))
    kind = dict(src.dtypes)
    found = stage(src.mapInArrow(_scan(model, threshold), f"id {kind['id']}, path {kind['path']}, own_license string, "
                                 "own_score double, licenses string, whole boolean"), "license-scan")
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    found = found.withColumn("dir", folder)
    files = (found.where(F.col("own_license").isNotNull() & F.col("path").isNotNull() & (F.col("whole") | F.col("path").rlike(FILES)))
             .groupBy("dir").agg(F.min(F.struct(-F.col("own_score"), "path", "own_license")).alias("best"))
             .select(F.col("dir").alias("above"), F.col("best.own_license").alias("passed")))
    dirs = found.where("own_license is null and dir is not null").select("dir").distinct()
    parts = F.split("dir", "/", -1)
    above = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")))).alias("a")).select("dir", "a.*")
    nearest = (above.join(files, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "passed")).alias("n"))
               .select("dir", F.col("n.above").alias("inherited_from"), F.col("n.passed").alias("passed")))
    own = F.col("own_license").isNotNull()
    return (found.join(nearest, "dir", "left")
            .select(F.col("id").alias(id_col), "path", "own_license", "own_score", "licenses",
                    F.coalesce("own_license", "passed").alias("license"),
                    F.when(~own, F.col("inherited_from")).alias("inherited_from")))
