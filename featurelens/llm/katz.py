"""Language-model scoring with a Katz backoff bigram model.

Counts are Good-Turing discounted; a context's left-over mass goes to the words
not seen after it, in proportion to the add-one unigrams, with an exactly
normalised backoff weight. Per token the model is evaluated recursively:
seen bigram, else backoff weight times unigram, where an unknown word has the
mass of one unseen type.

Texts are dealt to groups of about ``GROUP_BYTES`` by hash. A group never sends
its tokens: it asks for the counts of its distinct words, then of its distinct
word pairs, once each, as packed sorted arrays per bucket; the owner of a
bucket sums what all groups hold and answers every group. So a pair that makes
up a third of the corpus is one entry per group. The few contexts that hold
1 / HOT_SHARE of all tokens or more are spread over all buckets by pair and
their statistics summed afterwards. The unigram table, the answers and the
statistics are tables partitioned by bucket in the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from featurelens.llm import tokens as T
from featurelens.llm.tables import ready, stage, stage_by_key

GROUP_BYTES = 4 << 20
HOT_SHARE = 4000
GT = 5
_U = np.uint64
_START, _END = T.seeds(2, 1234567)
_ANSWER = "g long, kind int, b int, x binary, y binary, z binary, u binary"


def _bytes(*arrays):
    """Arrays as bytes, all lowest bytes first: small numbers leave runs of
    zeros, which the shuffle's compression takes out."""
    return [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in map(np.ascontiguousarray, arrays)]


def _tokens(text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, token before it, each text's first token (n + 1)); a text's
    tokens are its words and one end, the first stands after a start."""
    words, ptr = T.hashed_words(text, True)
    n = len(ptr) - 1
    at = ptr + np.arange(n + 1)
    tok = np.full(len(words) + n, _END, _U)
    inside = np.ones(len(tok), bool)
    inside[at[1:] - 1] = False
    tok[inside] = words
    before = np.empty_like(tok)
    before[1:] = tok[:-1]
    before[at[:-1]] = _START
    return tok, before, at


def _merge(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate(keys) if keys else np.empty(0, _U)
    c = np.concatenate(counts) if counts else np.empty(0, np.int64)
    u, inv = np.unique(k, return_inverse=True)
    return u, np.bincount(inv, weights=c, minlength=len(u)).astype(np.int64)


def _by_bucket(keys: np.ndarray, buckets: int):
    """(bucket, positions) of sorted keys, ascending inside a bucket."""
    b = (keys % _U(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    cut = np.searchsorted(b[order], np.arange(buckets + 1))
    for i in np.flatnonzero(np.diff(cut)).tolist():
        yield i, order[cut[i]:cut[i + 1]]


def _batch(rows, names, kinds):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _count_words(buckets: int):
    names, kinds = ["b", "x", "y"], (pa.int32(), pa.binary(), pa.binary())

    def run(batches):
        keys, counts, held = [], [], 0
        for whole in batches:
            for b in T.text_slices(whole, "text"):
                u, c = np.unique(_tokens(b["text"])[0], return_counts=True)
                keys.append(u)
                counts.append(c)
                held += len(u)
                if held > 1_000_000:
                    u, c = _merge(keys, counts)
                    keys, counts, held = [u], [c], 0
        u, c = _merge(keys, counts)
        rows = [(b, *_bytes(u[p], c[p])) for b, p in _by_bucket(u, buckets)]
        yield _batch(rows, names, kinds)
    return run


def _each_bucket(fn):
    """``fn`` gets a bucket's number and its rows, gives result batches."""
    def run(batches):
        held, key = [], None
        for b in batches:
            col = b["b"].to_numpy()
            at = np.flatnonzero(np.concatenate([[True], col[1:] != col[:-1]])) if len(col) else []
            for s, e in zip(at, [*at[1:], len(col)]):
                if held and col[s] != key:
                    yield from fn(key, pa.Table.from_batches(held))
                    held = []
                key = int(col[s])
                held.append(b.slice(int(s), int(e - s)))
        if held:
            yield from fn(key, pa.Table.from_batches(held))
    return run


def _arrays(col, kind) -> list[np.ndarray]:
    """The arrays of a column that :func:`_bytes` made."""
    size = np.dtype(kind).itemsize
    return [np.ascontiguousarray(np.frombuffer(x.as_buffer(), np.uint8).reshape(size, -1).T).view(kind).reshape(-1) for x in col]


def _sum_words(b, table):
    u, c = _merge(_arrays(table["x"], _U), _arrays(table["y"], np.int64))
    yield _batch([(b, *_bytes(u, c), int(c.sum()), len(u))], ["b", "x", "y", "n", "v"],
                 (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()))


def _pack(batches):
    """Texts compressed, for their way to the groups."""
    for b in batches:
        texts = [x.as_py().encode() for x in b["text"]]
        yield pa.RecordBatch.from_arrays(
            [b["id"], b["held"], b["g"], pa.array([len(x) for x in texts], pa.int64()),
             pa.array([pa.compress(x, "zstd", asbytes=True) if x else x for x in texts], pa.binary())],
            ["id", "held", "g", "size", "packed"])


def _texts(docs: pa.Table) -> pa.Array:
    return pa.array([pa.decompress(z.as_buffer(), n, "zstd", asbytes=True) if n else b""
                     for z, n in zip(docs["packed"], docs["size"].to_pylist())], pa.binary())


def _ask_words(buckets: int):
    """A group's distinct tokens, per bucket."""
    def run(docs: pa.Table) -> pa.Table:
        g, u = docs["g"][0].as_py(), np.unique(_tokens(_texts(docs))[0])
        return pa.Table.from_batches([_batch([(g, b, *_bytes(u[p])) for b, p in _by_bucket(u, buckets)], ["g", "b", "x"],
                                             (pa.int64(), pa.int32(), pa.binary()))])
    return run


def _answer_words(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Index inside the bucket (-1 if unknown) and count of every word asked."""
    u = _arrays(known["x"], _U)[0] if known.num_rows else np.empty(0, _U)
    c = _arrays(known["y"], np.int64)[0] if known.num_rows else np.empty(0, np.int64)
    rows = []
    for g, b, keys in zip(asked["g"].to_pylist(), asked["b"].to_pylist(), _arrays(asked["x"], _U)):
        at = np.searchsorted(u, keys)
        ok = at < len(u)
        ok[ok] = u[at[ok]] == keys[ok]
        at, n = np.where(ok, at, -1), np.zeros(len(keys), np.int64)
        n[ok] = c[at[ok]]
        rows.append((g, 0, b, *_bytes(at.astype(np.int32), n), None, None))
    return _answers(rows)


def _answers(rows) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
    return pa.Table.from_batches([_batch(rows, ["g", "kind", "b", "x", "y", "z", "u"], kinds)])


class _Model:
    """What all tasks know: sizes, the first id of each bucket, hot contexts."""

    def __init__(self, buckets, offsets, n, v, hot):
        self.buckets, self.offsets, self.n, self.v, self.hot = buckets, offsets, n, v, hot
        self.z = n + v + 1.0
        self.wide = np.uint32 if v + 1 < 1 << 32 else _U

    def bucket(self, h, w):
        spread = T.mix(h.astype(_U) * _U(3) + _U(1))
        hot = np.isin(h, self.hot)
        return ((spread + np.where(hot, T.mix(w.astype(_U) + _U(99)), _U(0))) % _U(self.buckets)).astype(np.int64), hot


class _Group:
    """A group's tokens with the global id (-1 unknown) and count of each, and
    its distinct pairs of known words in order of bucket, context, word."""

    def __init__(self, model: _Model, docs: pa.Table, words: pa.Table):
        self.docs = docs
        tok, before, self.at = _tokens(_texts(docs))
        u, inv = np.unique(tok, return_inverse=True)
        gid, count = np.full(len(u), -1, np.int64), np.zeros(len(u), np.int64)
        told = {b: (i, c) for b, i, c in zip(words["b"].to_pylist(), _arrays(words["x"], np.int32), _arrays(words["y"], np.int64))}
        for b, p in _by_bucket(u, model.buckets):
            i, c = told[b]
            gid[p] = np.where(i >= 0, i + model.offsets[b], -1)
            count[p] = c
        self.gid, self.count = gid[inv], count[inv]
        prev = np.concatenate([[-1], self.gid[:-1]])
        prev[self.at[:-1]] = model.v  # the id of the start
        self.prev = prev
        end = gid[np.searchsorted(u, _END)]
        self.known = np.flatnonzero((self.gid >= 0) & (prev >= 0))
        # an unknown word asks for its context by the context's pair with the end
        self.lone = np.flatnonzero((self.gid < 0) & (prev >= 0)) if end >= 0 else self.known[:0]
        h = prev[np.concatenate([self.known, self.lone])].astype(_U)
        w = np.concatenate([self.gid[self.known], np.full(len(self.lone), max(end, 0))]).astype(_U)
        code = h * _U(model.v + 1) + w if (model.v + 1) ** 2 < 1 << 64 else T.mix(h) + T.mix(w + _U(5)) * _U(3)
        _, first, self.pair = np.unique(code, return_index=True, return_inverse=True)
        h, w = h[first], w[first]
        held = np.repeat(np.array(docs["held"].to_pylist(), bool), np.diff(self.at))
        learns = np.concatenate([~held[self.known], np.zeros(len(self.lone), bool)])
        c = np.bincount(self.pair, weights=learns, minlength=len(first)).astype(np.int64)
        b, hot = model.bucket(h, w)
        order = np.lexsort((w, h, b))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.h, self.w, self.c, self.b, self.hot = h[order], w[order], c[order], b[order], hot[order]
        count = np.concatenate([self.count[self.known], np.full(len(self.lone), count[np.searchsorted(u, _END)])])
        self.cw = count[first][order]
        self.cut = np.searchsorted(self.b, np.arange(model.buckets + 1))

    def contexts(self, s: slice) -> tuple[np.ndarray, np.ndarray]:
        """First pair of each context of a bucket, and the pairs of each."""
        h = self.h[s]
        at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return at, np.diff(np.concatenate([at, [len(h)]]))


def _ask_pairs(model: _Model):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            g, me = docs["g"][0].as_py(), _Group(model, docs, words)
            for b in np.flatnonzero(np.diff(me.cut)).tolist():
                s = slice(me.cut[b], me.cut[b + 1])
                at, n = me.contexts(s)
                rows.append((g, b, *_bytes(me.h[s][at].astype(model.wide), n.astype(np.uint32), me.w[s].astype(model.wide),
                                           me.c[s].astype(np.uint32), me.cw[s].astype(np.int64))))
        return pa.Table.from_batches([_batch(rows, ["g", "b", "h", "n", "w", "c", "cw"],
                                             (pa.int64(), pa.int32(), *[pa.binary()] * 5))])
    return run


def _sum_pairs(model: _Model):
    """Answers of one bucket: to each group the counts of its pairs and, of
    its contexts, the total, the pairs of count 1..GT and the unigram counts
    of the words seen. The group -1 gets the counts of counts, and the parts
    of the hot contexts."""
    def run(b, table):
        hs = [np.repeat(h, n).astype(_U) for h, n in zip(_arrays(table["h"], model.wide), _arrays(table["n"], np.uint32))]
        ws = [w.astype(_U) for w in _arrays(table["w"], model.wide)]
        size = np.cumsum([0, *map(len, ws)])
        h, w = np.concatenate(hs), np.concatenate(ws)
        code = h * _U(model.v + 1) + w if (model.v + 1) ** 2 < 1 << 64 else T.mix(h) + T.mix(w + _U(5)) * _U(3)
        _, first, inv = np.unique(code, return_index=True, return_inverse=True)
        total = np.bincount(inv, weights=np.concatenate(_arrays(table["c"], np.uint32))).astype(np.int64)
        cw, h = np.concatenate(_arrays(table["cw"], np.int64))[first], h[first]
        seen = total > 0
        ctx, of = np.unique(h[seen], return_inverse=True)
        stats = np.zeros((len(ctx), GT + 2), np.int64)
        stats[:, 0] = np.bincount(of, weights=total[seen], minlength=len(ctx))
        for r in range(1, GT + 1):
            stats[:, r] = np.bincount(of, weights=total[seen] == r, minlength=len(ctx))
        stats[:, GT + 1] = np.bincount(of, weights=cw[seen] + 1, minlength=len(ctx))
        hot = np.isin(ctx, model.hot)
        rows = []
        for k, (g, own) in enumerate(zip(table["g"].to_pylist(), _arrays(table["h"], model.wide))):
            at = np.searchsorted(ctx, own.astype(_U))
            ok = at < len(ctx)
            ok[ok] = ctx[at[ok]] == own[ok]
            out = np.zeros((len(own), GT + 2), np.int64)
            out[ok] = np.where(hot[at[ok]][:, None], 0, stats[at[ok]])
            rows.append((g, 1, b, *_bytes(total[inv[size[k]:size[k + 1]]].astype(np.uint32), out.T.reshape(-1)), None, None))
        coc = np.bincount(np.minimum(total[seen], GT + 2), minlength=GT + 3)[1:GT + 2].astype(np.int64)
        rows.append((-1, 2, b, None, None, *_bytes(coc, np.column_stack([ctx[hot].astype(np.int64), stats[hot]]).reshape(-1))))
        yield from _answers(rows).to_batches()
    return run


def discounts(coc: np.ndarray) -> np.ndarray:
    """Katz's factors for counts 1..GT from the numbers of pairs of count
    1..GT+1. Where they are not in (0, 1), as on small data, the factors of
    absolute discounting by n1 / (n1 + 2 n2)."""
    n = coc.astype(float)
    r = np.arange(1, GT + 1)
    with np.errstate(all="ignore"):
        a = (GT + 1) * n[GT] / n[0]
        d = ((r + 1) * n[1:] / n[:-1] / r - a) / (1 - a)
    if not np.all((d > 0) & (d < 1)):
        d = 1 - (n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5) / r
    return d


def _score(model: _Model, disc: np.ndarray, hot_ids: np.ndarray, hot_stats: np.ndarray):
    factor = np.concatenate([[0.0], disc])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = answers["kind"].to_numpy()
        me = _Group(model, docs, answers.filter(pa.array(kinds == 0)))
        told = answers.filter(pa.array(kinds == 1))
        told = {b: (x, y) for b, x, y in zip(told["b"].to_pylist(), _arrays(told["x"], np.uint32), _arrays(told["y"], np.int64))}
        count, stats = np.zeros(len(me.h), np.int64), np.zeros((len(me.h), GT + 2), np.int64)
        for b in np.flatnonzero(np.diff(me.cut)).tolist():
            s = slice(me.cut[b], me.cut[b + 1])
            n = me.contexts(s)[1]
            x, y = told[b]
            count[s], stats[s] = x, np.repeat(y.reshape(GT + 2, -1).T, n, axis=0)
        if me.hot.any():
            stats[me.hot] = hot_stats[np.searchsorted(hot_ids, me.h[me.hot].astype(np.int64))]
        ch = stats[:, 0].astype(float)
        left = (stats[:, 1:GT + 1] * ((1 - disc) * np.arange(1, GT + 1))).sum(axis=1)
        # a context without a count to discount keeps one count back
        whole = left <= 0
        seen = count * np.where((count <= GT) & ~whole, factor[np.minimum(count, GT)], 1.0)
        mass = np.where(whole, ch + 1, ch)
        unigram = (me.cw + 1) / model.z
        with np.errstate(all="ignore"):
            back = np.where(whole, 1.0, left) / mass / (1 - stats[:, GT + 1] / model.z)
            p = np.where(ch > 0, np.where(count > 0, seen / mass, back * unigram), unigram)
        base = np.log10((me.count + 1) / model.z)
        log = base.copy()
        at = me.place[me.pair]
        log[me.known] = np.log10(p)[at[:len(me.known)]]
        own = at[len(me.known):]
        log[me.lone] += np.log10(np.where(ch > 0, back, 1.0))[own]
        at = me.at[:-1]
        n = np.diff(me.at)
        return pa.table({
            "id": docs["id"], "held_out": pa.array(docs["held"]), "n_tokens": pa.array(n),
            "n_known": pa.array(np.add.reduceat((me.count > 0).astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(n), model.n, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(np.add.reduceat(log, at))})
    return run


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                held_out: tuple[int, int] = (7, 2), group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document: (id_col, held_out, n_tokens, n_known,
    train_tokens, base_score, score).

    The model learns from documents whose crc32 of the id as text modulo
    ``held_out[0]`` is not ``held_out[1]``. ``base_score`` sums the add-one
    unigram log10 probabilities, ``score`` the model's. Null and empty texts
    have one token, the end; a null id counts as empty text; repeated rows are
    documents of their own; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ident = F.coalesce(F.col("id").cast("string"), F.lit(""))
    src = src.withColumn("held", F.crc32(ident.cast("binary")) % held_out[0] == held_out[1])
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # not fewer than Spark's shuffle partitions, so that the bucketed texts stay where they are
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // group_bytes))
    words = stage(src.where("not held").select("text").mapInArrow(_count_words(groups), "b int, x binary, y binary")
                  .repartition(groups, "b").sortWithinPartitions("b")
                  .mapInArrow(_each_bucket(_sum_words), "b int, x binary, y binary, n long, v long"), "katz-words")
    sizes = {r["b"]: (r["n"], r["v"]) for r in words.select("b", "n", "v").collect()}
    offsets = np.concatenate([[0], np.cumsum([sizes.get(b, (0, 0))[1] for b in range(groups)])]).astype(np.int64)
    n, v = sum(x for x, _ in sizes.values()), int(offsets[-1])

    def frequent(batches):
        for t in batches:
            for b, c in zip(t["b"].to_pylist(), _arrays(t["y"], np.int64)):
                own = np.flatnonzero(c >= n / HOT_SHARE) + offsets[b]
                yield _batch([(int(i),) for i in own], ["id"], (pa.int64(),))

    hot = [r["id"] for r in words.select("b", "y").mapInArrow(frequent, "id long").collect()]
    # the start is a context too; its id comes after the words'
    model = _Model(groups, offsets, n, v, np.array(sorted({*hot, v}), np.uint64))
    kind = dict(src.dtypes)["id"]
    dealt = stage_by_key(src.withColumn("g", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))
                         .mapInArrow(_pack, f"id {kind}, held boolean, g long, size long, packed binary"), "katz-texts", "g", groups)
    asked = dealt.groupBy("g").applyInArrow(_ask_words(groups), "g long, b int, x binary")
    told = stage(asked.groupBy("b").cogroup(words.select("b", "x", "y").groupBy("b"))
                 .applyInArrow(_answer_words, _ANSWER), "katz-words-told")
    pairs = (dealt.groupBy("g").cogroup(told.groupBy("g"))
             .applyInArrow(_ask_pairs(model), "g long, b int, h binary, n binary, w binary, c binary, cw binary"))
    sums = stage(pairs.repartition(groups, "b").sortWithinPartitions("b").mapInArrow(_each_bucket(_sum_pairs(model)), _ANSWER),
                 "katz-pairs-told")

    coc = np.zeros(GT + 1, np.int64)
    hot_ids = model.hot.astype(np.int64)
    hot_stats = np.zeros((len(hot_ids), GT + 2), np.int64)

    def parts(batches):
        total, stats = np.zeros(GT + 1, np.int64), np.zeros((len(hot_ids), GT + 2), np.int64)
        for t in batches:
            for z, u in zip(_arrays(t["z"], np.int64), _arrays(t["u"], np.int64)):
                total += z
                u = u.reshape(-1, GT + 3)
                stats[np.searchsorted(hot_ids, u[:, 0])] += u[:, 1:]
        yield _batch([(0, total.tobytes(), stats.tobytes())], ["k", "z", "u"], (pa.int32(), pa.binary(), pa.binary()))

    for r in sums.where("g = -1").select("z", "u").mapInArrow(parts, "k int, z binary, u binary").toLocalIterator():
        coc += np.frombuffer(r["z"], np.int64)
        hot_stats += np.frombuffer(r["u"], np.int64).reshape(-1, GT + 2)
    answers = told.unionByName(sums.where("g >= 0"))
    scored = (dealt.groupBy("g").cogroup(answers.groupBy("g"))
              .applyInArrow(_score(model, discounts(coc), hot_ids, hot_stats),
                            f"id {kind}, held_out boolean, n_tokens long, n_known long, "
                            "train_tokens long, base_score double, score double"))
    return scored.withColumnRenamed("id", id_col)
