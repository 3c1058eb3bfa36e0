import hashlib
import os
import random
import tempfile

import pytest

from pyspark.sql import functions as F

from featurelens.operators import encoding as enc, joins, sampling
from featurelens.sources import reports
from featurelens.sources.reports import load_artefacts, read_report, save_artefacts, write_report
from featurelens.sources.tables import sample_table_to_path


def test_encode_categories_fixture(spark):
    vals = ["a"] * 3 + ["b"] * 2 + ["c"] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c string")
    x, m = enc.encode_categories_train(df, ["c"])
    codes = {r["value"]: r["code"] for r in m.collect()}
    assert codes == {"a": 0, "b": 1, "least_perc": 2}
    got = {r["i"]: r["c"] for r in x.collect()}
    assert [got[i] for i in range(7)] == [0, 0, 0, 1, 1, 2, 2]
    score = spark.createDataFrame([(0, "a"), (1, "zzz"), (2, None)], "i int, c string")
    s = {r["i"]: r["c"] for r in enc.encode_categories_score(score, ["c"], m).collect()}
    assert s == {0: 0, 1: 2, 2: 2}


def test_encode_single_category(spark):
    df = spark.createDataFrame([(i, "x") for i in range(4)], "i int, c string")
    x, _m = enc.encode_categories_train(df, ["c"])
    assert {r["c"] for r in x.collect()} == {0}


def test_label_encode_score_unknown(spark):
    train = spark.createDataFrame([("x",), ("y",)], "l string")
    m = enc.label_map(train, "l")
    score = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "i int, l string")
    x, unknown = enc.label_encode_score(score, "l", m)
    assert {r["i"]: r["l_idx"] for r in x.collect()} == {1: 0, 2: 1}
    assert [r["label"] for r in unknown.collect()] == ["z"]


def test_index_categories_range(spark, sf_small):
    p = spark.read.parquet(f"{sf_small}/part.parquet")
    x, _m = enc.index_categories(p, ["p_type"])
    n = p.select("p_type").distinct().count()
    codes = sorted({r["p_type"] for r in x.collect()})
    assert codes == list(range(n))


def test_stratified_sample_fixture(spark):
    rows = [(i, "big") for i in range(250)] + [(1000 + i, "small") for i in range(3)]
    df = spark.createDataFrame(rows, "k int, l string")
    got = {r["l"]: r["count"] for r in sampling.stratified_sample(df, "l", 200, 1, ["k"])
           .groupBy("l").count().collect()}
    assert got == {"big": 200, "small": 3}


def test_sample_n_exact_and_repeatable(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    a = sampling.sample_n(o, 100, 5, ["o_orderkey"])
    b = sampling.sample_n(o.repartition(3), 100, 5, ["o_orderkey"])
    ka = sorted(r[0] for r in a.select("o_orderkey").collect())
    kb = sorted(r[0] for r in b.select("o_orderkey").collect())
    assert len(ka) == 100 and ka == kb


def test_split_by_customer_no_leak(spark):
    rows = [(0, i) for i in range(1000)] + [(k, 0) for k in range(1, 10)]
    df = spark.createDataFrame(rows, "cust int, i int")
    s = sampling.split_by_customer(df, "cust")
    both = s.groupBy("cust").agg(F.count_distinct("split").alias("n")).where("n > 1").count()
    assert both == 0
    counts = {r["dataset"]: r for r in sampling.split_counts(s, "cust").collect()}
    assert counts["original"]["counts"] == 1009
    assert counts["train"]["counts"] + counts.get("test", {"counts": 0})["counts"] == 1009


def test_cover_labels(spark):
    rows = [(i, "train", "a") for i in range(5)] + [(10 + i, "test", "b") for i in range(3)]
    df = spark.createDataFrame(rows, "k int, split string, lab string")
    out, mtr, mte = sampling.cover_labels(df, "lab", "split", ["k"])
    sides = {s: {r["lab"] for r in out.where(F.col("split") == s).collect()} for s in ("train", "test")}
    assert sides["train"] == {"a", "b"} and sides["test"] == {"a", "b"}
    assert [r["label"] for r in mtr.collect()] == ["b"]


def test_report_sections_replace(spark):
    base = tempfile.mkdtemp(prefix="fl-rep-")
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    write_report({"s1": a, "s2": a}, base, "r")
    write_report({"s1": b}, base, "r")
    assert read_report(spark, base, "r", "s1").first()["x"] == 2
    assert read_report(spark, base, "r", "s2").first()["x"] == 1


def test_artefacts_dynamic_overwrite(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="fl-art-"), "maps")
    df = spark.createDataFrame([("x", 1), ("y", 2)], "l string, i int")
    save_artefacts(enc.label_map(df, "l", "training"), path)
    save_artefacts(enc.label_map(df, "l", "retraining"), path)
    save_artefacts(enc.label_map(df.where("l = 'x'"), "l", "training"), path)
    assert load_artefacts(spark, path, "training").count() == 1
    assert load_artefacts(spark, path, "retraining").count() == 2


def test_sample_table_to_path_never_overwrites_source(spark):
    d = tempfile.mkdtemp(prefix="fl-src-")
    src = os.path.join(d, "t.parquet")
    spark.range(50).write.parquet(src)
    df, out = sample_table_to_path(spark, src, 10, 1, ["id"])
    assert out.endswith("t_sample") and df.count() == 10
    assert spark.read.parquet(src).count() == 50


def test_sample_n_threshold_equals_plain_top_n(spark, sf_small):
    from featurelens.functions.hashing import hash_order_key
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    ref = sorted(r[0] for r in o.orderBy(hash_order_key(7, "o_orderkey"), "o_orderkey").limit(150)
                 .select("o_orderkey").collect())
    for margin in (0.01, 1.2):  # a tiny margin forces the threshold to be raised
        got = sorted(r[0] for r in sampling.sample_n(o, 150, 7, ["o_orderkey"], margin=margin)
                     .select("o_orderkey").collect())
        assert got == ref


def test_stratified_threshold_equals_plain_window(spark, sf_small):
    from pyspark.sql import Window
    from featurelens.functions.hashing import hash_order_key
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    w = Window.partitionBy("o_orderstatus").orderBy(hash_order_key(3, "o_orderkey"), "o_orderkey")
    ref = sorted(r[0] for r in o.withColumn("rn", F.row_number().over(w)).where("rn <= 40")
                 .select("o_orderkey").collect())
    for parts in (1, 5):
        got = sorted(r[0] for r in sampling.stratified_sample(o.repartition(parts), "o_orderstatus", 40, 3, ["o_orderkey"])
                     .select("o_orderkey").collect())
        assert got == ref


def test_stratified_with_null_label(spark):
    rows = [(i, "a" if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, l string")
    got = {r["l"]: r["count"] for r in sampling.stratified_sample(df, "l", 5, 1, ["k"])
           .groupBy("l").count().collect()}
    assert got == {"a": 5, None: 5}


def test_a_value_named_like_the_rest_code(spark):
    vals = ["least_perc"] * 3 + ["a"] * 2 + ["b"] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c string")
    x, m = enc.encode_categories_train(df, ["c"])
    assert {(r["value"], r["code"], r["rest"]) for r in m.collect()} == {("least_perc", 0, False), ("a", 1, False), ("least_perc", 2, True)}
    assert [r["c"] for r in x.orderBy("i").collect()] == [0, 0, 0, 1, 1, 2, 2]
    path = os.path.join(tempfile.mkdtemp(prefix="fl-art-"), "maps")
    save_artefacts(m, path)
    again = enc.encode_categories_score(df, ["c"], load_artefacts(spark, path, "training"))
    assert [r["c"] for r in again.orderBy("i").collect()] == [0, 0, 0, 1, 1, 2, 2]


def _wide(spark, n_cols, n_rows, seed=2):
    rnd = random.Random(seed)
    rows = [(i, *[rnd.choice([None, "", "least_perc", *"abcdefgh"[: 2 + c % 7]]) for c in range(n_cols)]) for i in range(n_rows)]
    return rows, spark.createDataFrame(rows, "i int, " + ", ".join(f"c{c} string" for c in range(n_cols)))


@pytest.mark.parametrize("dict_bytes", [enc.DICT_BYTES, 0, 600])
def test_maps_of_many_columns_equal_brute_force(spark, dict_bytes):
    rows, df = _wide(spark, 12, 300)
    cols = [f"c{c}" for c in range(12)]
    m = enc.index_categories_map(df, cols)
    got = {r["i"]: tuple(r)[1:] for r in enc.apply_category_map(df, cols, m, kind="index", dict_bytes=dict_bytes).collect()}
    codes = [{v: k for k, v in enumerate(sorted({r[c + 1] for r in rows if r[c + 1] is not None}))} for c in range(12)]
    assert got == {r[0]: tuple(codes[c].get(r[c + 1]) for c in range(12)) for r in rows}
    # an unknown value, a column without a map, and a suffix
    score = spark.createDataFrame([(1, "zzz", "a")], "i int, c0 string, d string")
    assert enc.apply_category_map(score, ["c0", "d"], m, kind="index", suffix="_k", dict_bytes=dict_bytes).first().asDict() == {
        "i": 1, "c0": "zzz", "d": "a", "c0_k": None, "d_k": None}


def test_two_hundred_columns_without_a_join_each(spark):
    rows, df = _wide(spark, 200, 60)
    cols = [f"c{c}" for c in range(200)]
    x, m = enc.encode_categories_train(df, cols)
    for size in (enc.DICT_BYTES, 0):
        out = enc.apply_category_map(df, cols, m, dict_bytes=size)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") <= 2
    got = {r["i"]: r for r in x.collect()}
    for c in (0, 77, 199):
        seen = [r[c + 1] for r in rows if r[c + 1] is not None]
        order = sorted(set(seen), key=lambda v: (-seen.count(v), v))
        assert [got[r[0]][f"c{c}"] for r in rows] == [order.index(r[c + 1]) if r[c + 1] is not None else len(order) - 1 for r in rows]


def test_lookup_maps(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "i int, p string, q string")
    m = spark.createDataFrame([("p", "a", 7), ("q", "x", 8), ("q", "a", 9)], "column string, value string, code long")
    assert [tuple(r) for r in joins.lookup_maps(df, ["p", "q"], m).orderBy("i").collect()] == [(1, "a", "x", 7, 8), (2, "b", None, None, None)]


@pytest.mark.parametrize("n,percent", [(1, 20), (2, 20), (3, 20), (997, 20), (1000, 33.3), (50, 0), (50, 100)])
def test_exact_share_of_customers(spark, n, percent):
    rows = [(k, i) for k in range(n) for i in range(1 + (k == 0) * 50)] + [(None, 0)]
    s = sampling.split_by_customer_exact(spark.createDataFrame(rows, "cust int, i int"), "cust", percent)
    side = {}
    for r in s.collect():
        side.setdefault(r["cust"], set()).add(r["split"])
    assert all(len(v) == 1 for v in side.values()) and side.pop(None) == {"train"}
    test = {k for k, v in side.items() if v == {"test"}}
    by_hash = sorted(range(n), key=lambda k: hashlib.md5(f"33|{k}".encode()).hexdigest())
    assert test == set(by_hash[:int(n * percent / 100 + 0.5)])


def _broken(spark):
    return spark.range(4).selectExpr("raise_error('stop') as x")


def test_a_write_that_dies_leaves_the_old_report_whole(spark):
    base = tempfile.mkdtemp(prefix="fl-rep-")
    one = spark.createDataFrame([(1,)], "x int")
    two = spark.createDataFrame([(2,)], "x int")
    write_report({"a": one, "b": one}, base, "r")
    with pytest.raises(Exception):
        write_report({"a": two, "b": _broken(spark)}, base, "r", overwrite=True)
    assert [read_report(spark, base, "r", s).first()["x"] for s in "ab"] == [1, 1]
    during = read_report(spark, base, "r", "a")  # a reader that began before the rewrite
    write_report({"a": two}, base, "r", overwrite=True)
    assert during.first()["x"] == 1 and read_report(spark, base, "r", "a").first()["x"] == 2
    assert set(reports.report_sections(spark, base, "r")) == {"a"}
    with pytest.raises(KeyError):
        read_report(spark, base, "r", "b")
    assert reports.vacuum(spark, f"{base}/r", keep=1) == 2  # the first report and the dead write
    assert read_report(spark, base, "r", "a").first()["x"] == 2


def test_two_writers_keep_each_other_s_entries(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="fl-art-"), "maps")
    df = spark.createDataFrame([("x",), ("y",)], "l string")
    save_artefacts(enc.label_map(df, "l", "first"), path)
    real, calls = reports._manifest, []

    def slow(s, root, number=None):
        got = real(s, root, number)
        if not calls:  # another writer commits between this writer's read and its own commit
            calls.append(1)
            save_artefacts(enc.label_map(df, "l", "other"), path)
        return got

    monkeypatch.setattr(reports, "_manifest", slow)
    save_artefacts(enc.label_map(df, "l", "mine"), path)
    assert {r["artefact"] for r in load_artefacts(spark, path).collect()} == {"first", "other", "mine"}


def test_maps_that_die_leave_the_old_ones(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="fl-art-"), "maps")
    assert load_artefacts(spark, path).count() == 0
    m = enc.label_map(spark.createDataFrame([("x",)], "l string"), "l")
    save_artefacts(m, path)
    with pytest.raises(Exception):
        save_artefacts(m.withColumn("value", F.raise_error(F.lit("stop")).cast("string")), path)
    assert [r["value"] for r in load_artefacts(spark, path).collect()] == ["x"]


def test_report_as_csv(spark):
    base = tempfile.mkdtemp(prefix="fl-rep-")
    write_report({"s": spark.createDataFrame([(1, "a")], "x int, y string")}, base, "r", csv=True)
    assert spark.read.option("header", True).csv(reports.report_sections(spark, base, "r")["s"]).first().asDict() == {"x": "1", "y": "a"}
