import math
import random

import numpy as np
from pyspark.sql import functions as F

from featurelens.operators import iv
from featurelens.operators.ranking import exact_quantiles, ordered_index, running_total


def test_running_total_matches_cumsum(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("ab"), rnd.randint(0, 1000), rnd.randint(1, 5)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, x int, w int").dropDuplicates(["g", "x"])
    got = running_total(df, [F.col("x")], ["g"], "w", "cum", num_partitions=6).toPandas()
    got = got.sort_values(["g", "x"])
    ref = got.groupby("g")["w"].cumsum()
    assert (got["cum"].values == ref.values).all()


def test_ordered_index_desc(spark):
    df = spark.createDataFrame([(v,) for v in ["c", "a", "b", "d"]], "v string")
    got = {r["v"]: r["i"] for r in ordered_index(df, [F.col("v").desc()], out="i", num_partitions=3).collect()}
    assert got == {"d": 0, "c": 1, "b": 2, "a": 3}


def test_exact_quantiles_equal_numpy_linear(spark):
    rnd = random.Random(3)
    vals = [round(rnd.gauss(0, 10), 2) for _ in range(2001)] + [5.0] * 300
    df = spark.createDataFrame([("v", x) for x in vals], "g string, x double")
    probs = [i / 10 for i in range(11)]
    got = exact_quantiles(df, "g", "x", probs, num_partitions=5).first()["quantiles"]
    ref = np.quantile(np.array(vals), probs, method="linear")
    assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9) for a, b in zip(got, ref))


def test_quantile_bins_fixture(spark):
    xs = [1, 2, 3, 4, 5, 5, 5, 5, 5, 6, 7, 8, 9, 10, 11, None]
    df = spark.createDataFrame([(float(x) if x is not None else None,) for x in xs], "x double")
    edges = iv.quantile_edges(df, ["x"]).first()["edges"]
    assert [round(e, 6) for e in edges] == [1.0, 2.4, 3.8, 5.0, 5.4, 6.8, 8.2, 9.6, 11.0]
    bins = iv.quantile_bins(df, ["x"]).collect()
    counts = {r["bin_idx"]: r["n"] for r in bins}
    assert counts[None] == 1
    assert [counts.get(i, 0) for i in range(1, 9)] == [2, 1, 6, 0, 1, 2, 1, 2]
    assert 4 not in counts  # empty bins do not appear


def test_iv_single_label_gives_null(spark):
    df = spark.createDataFrame([("A", float(i)) for i in range(30)], "y string, x double")
    v = iv.iv_verbose(df, "y", iv.BinPlan(("x",), (), ()))
    s = iv.iv_summary(v).first()
    assert s["total_neg"] == 0 and s["iv"] is None


def test_iv_bin_without_positives_is_finite(spark):
    rows = [("A", "u")] * 5 + [("B", "u")] * 5 + [("B", "v")] * 5
    df = spark.createDataFrame(rows, "y string, c string")
    v = iv.iv_verbose(df, "y", iv.BinPlan((), (), ("c",)))
    for r in v.collect():
        assert r["iv"] is not None and math.isfinite(r["iv"]) and r["iv"] >= 0


def test_iv_properties_on_orders(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    plan = iv.BinPlan(("o_totalprice",), (), ("o_orderpriority",))
    v = iv.iv_verbose(o, "o_orderstatus", plan).toPandas()
    assert (v["iv"] >= 0).all()
    counts = o.groupBy("o_orderstatus").count().toPandas().set_index("o_orderstatus")["count"]
    pos = v.groupby(["label", "var"])["pos"].sum()
    for (lab, _var), n in pos.items():
        assert n == counts[lab]
    # every bin appears for every label
    assert v.groupby(["var", "bin"])["label"].nunique().eq(3).all()


def test_iv_strength_bands(spark):
    df = spark.createDataFrame([(x,) for x in [0.01, 0.02, 0.1, 0.3, 0.5, None]], "iv double")
    got = [r["iv_strength"] for r in iv.iv_strength(df).collect()]
    assert got == ["useless", "weak", "medium", "strong", "too good to be true", None]


def test_unbinned_numeric_missing_fill(spark):
    df = spark.createDataFrame([("A", 1), ("B", None), ("A", 2)], "y string, k int")
    v = iv.iv_verbose(df, "y", iv.BinPlan((), ("k",), ()))
    assert {r["bin"] for r in v.collect()} == {"1", "2", "9999999"}


def test_exact_quantiles_both_paths_agree(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("abc"), round(rnd.gauss(5, 3), 3)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    a = {r["g"]: r["quantiles"] for r in exact_quantiles(df, "g", "x", probs).collect()}
    b = {r["g"]: r["quantiles"] for r in
         exact_quantiles(df, "g", "x", probs, num_partitions=5).collect()}
    for k in a:
        ref = np.quantile(np.array([x for g, x in rows if g == k]), probs, method="linear")
        assert all(math.isclose(p, q, rel_tol=1e-12, abs_tol=1e-12) for p, q in zip(a[k], ref))
        assert all(math.isclose(p, q, rel_tol=1e-12, abs_tol=1e-12) for p, q in zip(b[k], ref))


def test_exact_quantiles_many_groups_distributed(spark):
    rnd = random.Random(21)
    rows = [(f"c{rnd.randint(0, 300)}", float(rnd.randint(0, 40))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["quantiles"][0] for r in
           exact_quantiles(df, "g", "x", [0.5], num_partitions=7).collect()}
    for k, med in got.items():
        assert math.isclose(med, float(np.median([x for g, x in rows if g == k])), abs_tol=1e-12)
    assert len(got) == len({g for g, _ in rows})


def test_iv_of_a_short_integer_with_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("b", 2)], "y string, x int").selectExpr("y", "cast(x as tinyint) as x")
    v = iv.iv_verbose(df, "y", iv.BinPlan((), ("x",), ())).collect()
    assert {r["bin"] for r in v} == {"1", "2", "9999999"} and len(v) == 6
