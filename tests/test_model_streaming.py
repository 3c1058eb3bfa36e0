import itertools
import os
import random
import tempfile

from pyspark.sql import functions as F

from featurelens.operators import encoding as enc
from featurelens.plans import model as mdl
from featurelens.spec import FeatureSpec
from featurelens.streaming import score_stream


def test_auc_mu_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 2), round(rnd.random(), 2), round(rnd.random(), 2), round(rnd.random(), 2))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, p0 double, p1 double, p2 double")
    got = {(r["ci"], r["cj"]): r["auc"] for r in mdl.auc_mu_pairs(df, "y", ["p0", "p1", "p2"]).collect()}
    for i, j in itertools.combinations(range(3), 2):
        si = [r[1 + i] - r[1 + j] for r in rows if r[0] == i]
        sj = [r[1 + i] - r[1 + j] for r in rows if r[0] == j]
        wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in si for b in sj)
        assert abs(got[(i, j)] - wins / (len(si) * len(sj))) < 1e-12


def test_feature_report_remarks(spark):
    summary = spark.createDataFrame(
        [("a", 0.0, 0.0, 5), ("b", 1.0, None, 1), ("cif_id", 0.0, 0.0, 9), ("label", 0.0, None, 3)],
        "var string, missing_rate double, zero_rate double, num_unique long")
    imp = spark.createDataFrame([("a", 0.7, 3)], "feature string, gain_importance double, split_importance long")
    rep = {r["var"]: r for r in mdl.feature_report(summary, imp, FeatureSpec(), 1).collect()}
    assert rep["a"]["remarks"] == "is model selected" and rep["a"]["used_as_model_input"] == 1
    assert rep["b"]["remarks"] == "missing_rate==1, cardinality==1"
    assert rep["b"]["status"] == "NA:dropped_from_model_input"
    assert rep["cif_id"]["remarks"] == "is primary key"
    assert rep["label"]["remarks"] == "is label"


def test_score_stream_applies_saved_maps(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "c string")
    m = enc.encode_categories_map(train, ["c"])
    d = tempfile.mkdtemp(prefix="fl-stream-")
    src = os.path.join(d, "in")
    spark.createDataFrame([("a",), ("c",), ("zz",)], "c string").write.parquet(src)
    stream = spark.readStream.schema("c string").parquet(src)
    out = score_stream(stream, m, ["c"]).withColumnRenamed("c", "code")
    q = out.writeStream.format("memory").queryName("fl_scored").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    codes = sorted(r["code"] for r in spark.sql("SELECT * FROM fl_scored").collect())
    assert codes == [0, 2, 2]
