import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from featurelens.operators import aggregates as agg, joins


def test_agg_numeric_median_exact(spark):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randint(1, 5)}", float(rnd.randint(0, 50)), rnd.random())
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    got = {r["k"]: r for r in agg.agg_numeric(df, "k", ["a", "b"], ("sum", "median", "std")).collect()}
    for k in got:
        a = np.array([r[1] for r in rows if r[0] == k])
        b = np.array([r[2] for r in rows if r[0] == k])
        assert abs(got[k]["a_median"] - np.median(a)) < 1e-9
        assert abs(got[k]["b_median"] - np.median(b)) < 1e-12
        assert abs(got[k]["a_sum"] - a.sum()) < 1e-6
        assert abs(got[k]["b_std"] - b.std(ddof=1)) < 1e-9


def test_with_key_counts_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,), (None,)], "k int")
    r = agg.with_key_counts(df, "k").first()
    assert r["distinct_cnt_k"] == 3 and r["records"] == 5


def test_cumulative_share_order_and_total(spark):
    df = spark.createDataFrame([(v,) for v in "aaabbc"], "v string")
    rows = agg.cumulative_share(agg.freq_table(df, "v"), "v", num_partitions=3).orderBy("cum_perc").collect()
    assert [r["v"] for r in rows] == ["a", "b", "c"]
    assert abs(rows[-1]["cum_perc"] - 1.0) < 1e-12


def test_join_mapping_drops_unmapped(spark):
    ev = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "user_id int, e string")
    m = spark.createDataFrame([(1, 10), (2, None)], "kais int, cif_id int")
    out = joins.join_mapping(ev, m, "user_id", "kais", "cif_id")
    assert [r["user_id"] for r in out.collect()] == [1]


def test_lagged_join_uses_previous_day(spark):
    lab = spark.createDataFrame([(1, dt.date(2024, 1, 2))], "k int, date date")
    feats = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5), (1, dt.date(2024, 1, 2), 7)],
                                  "k int, as_of_dt date, f int")
    out = joins.lagged_join(lab, feats, "k", "as_of_dt").collect()
    assert [(r["date"], r["f"]) for r in out] == [(dt.date(2024, 1, 2), 5)]


def test_labels_not_in(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "l string")
    b = spark.createDataFrame([("y",)], "l string")
    assert [r["label"] for r in joins.labels_not_in(a, b, "l").collect()] == ["x"]


def test_membership_join_no_duplication(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    members = spark.createDataFrame([(1,), (1,)], "k int")
    assert joins.customer_membership_join(df, members, "k").count() == 2


def test_split_in_time_ranges(spark):
    from featurelens.operators.sampling import split_in_time
    rows = [(i, 1, dt.datetime(2022, 8, 9, 12)) for i in range(2)] + [(10, 1, dt.datetime(2022, 8, 10, 23))] + \
           [(20, 2, dt.datetime(2024, 5, 10, 23, 59))] + [(30, 3, dt.datetime(2024, 5, 11))]
    df = spark.createDataFrame(rows, "i int, c int, d timestamp_ntz")
    got = {r["i"]: r["split"] for r in split_in_time(df, "d", "c").collect()}
    assert set(got) == {10, 20} and got[20] == "oos" and got[10] in ("train", "test")


def test_null_labels_are_no_value(spark):
    df = spark.createDataFrame([("a", "train"), (None, "train"), (None, "test"), ("a", "test"), ("b", "train")], "l string, split string")
    assert {r["l"]: r["percentage"] for r in agg.freq_table(df, "l").collect()} == {"a": 2 / 3, "b": 1 / 3}
    from featurelens.operators import sampling
    got = [(r["l"], r["count"], r["percentage_train"]) for r in sampling.label_distribution(df, "l").collect()]
    assert got == [("a", 2, 0.5), ("b", 1, 0.5)]


def test_cover_labels_with_shared_and_null_order_keys(spark):
    from featurelens.operators import sampling
    rows = [(1, "x", "train"), (1, "y", "train"), (1, "z", "train"), (None, "x", "test"), (None, "x", "test")]
    df = spark.createDataFrame(rows, "k int, l string, split string")
    out, _train, _test = sampling.cover_labels(df, "l", "split", ["k"])
    got = out.collect()
    assert len(got) == 5 and {r["l"] for r in got if r["split"] == "test"} == {"y", "z"}


def test_last_day_is_whole(spark):
    import datetime as dt
    from featurelens.operators import columns
    df = spark.createDataFrame([(dt.datetime(1996, 12, 31, 10),), (dt.datetime(1997, 1, 1),)], "t timestamp")
    assert columns.between_dates(df, "t", "1996-01-01", "1996-12-31").count() == 1


def test_null_groups_have_their_own_order_statistics(spark):
    from featurelens.operators import iv
    from featurelens.operators.aggregates import agg_numeric
    rows = [(None, "p", 1.0), (None, "p", 3.0), (None, None, 9.0), ("a", "p", 5.0), ("a", None, None), ("b", "p", None)]
    df = spark.createDataFrame(rows, "k string, j string, x double")
    got = {r["k"]: (r["x_median"], r["x_max"]) for r in agg_numeric(df, "k", ["x"], ("max", "median")).collect()}
    assert got == {None: (3.0, 9.0), "a": (5.0, 5.0), "b": (None, None)}
    two = {(r["k"], r["j"]): r["x_median"] for r in agg_numeric(df, ["k", "j"], ["x"], ("median",)).collect()}
    assert two == {(None, "p"): 2.0, (None, None): 9.0, ("a", "p"): 5.0, ("a", None): None, ("b", "p"): None}
    d = {r["k"]: r for r in iv.describe_by(df, "k", "x").collect()}
    assert [d[None][c] for c in ("count", "25%", "50%", "75%", "max")] == [3, 2.0, 3.0, 6.0, 9.0]
    assert d["b"]["count"] == 0 and d["b"]["50%"] is None
