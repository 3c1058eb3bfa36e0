import random

import pytest
from pyspark.sql import functions as F

from featurelens.plans import model as mdl
from featurelens.plans import trees

# code -> class by no order of the codes
KIND = {c: (c * 7) % 11 % 3 for c in range(11)}


def _rows(n=900, seed=5, noise=0.0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        c = r.randrange(11)
        y = KIND[c] if r.random() >= noise else r.randrange(3)
        out.append((i, c, r.random() * (1 + y), y, "test" if i % 4 == 0 else "train"))
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id long, c int, x double, y int, split string")


@pytest.fixture(scope="module")
def fitted(spark):
    return mdl.train_ova_model(_frame(spark, _rows()), ["c", "x"], "y", max_iter=6, keys=["id"], categorical=["c"])


def test_trees_split_sets_of_categories(fitted):
    splits = [r["split"] for r in fitted.nodes.where("leftChild >= 0").collect()]
    assert fitted.categorical == ("c",)
    assert any(s["featureIndex"] == 0 for s in splits)
    assert all((s["numCategories"] == 12) == (s["featureIndex"] == 0) for s in splits)
    first = [s["leftCategoriesOrThreshold"] for s in splits if s["featureIndex"] == 0]
    assert any(sorted(f) != list(range(int(min(f)), int(max(f)) + 1)) for f in first)  # a set, not a range


def test_numbering_of_categories_does_not_matter(spark, fitted):
    order = [3, 9, 0, 7, 10, 1, 5, 2, 8, 6, 4]
    other = mdl.train_ova_model(_frame(spark, [(i, order[c], x, y, s) for i, c, x, y, s in _rows()]), ["c", "x"], "y",
                                max_iter=6, keys=["id"], categorical=["c"])
    a, b = ({r["id"]: tuple(round(r[f"score_{k}"], 9) for k in range(3)) for r in mdl.model_scores(t).collect()} for t in (fitted, other))
    assert a == b
    by_order = [mdl.train_ova_model(_frame(spark, rows), ["c", "x"], "y", max_iter=2, keys=["id"])
                for rows in (_rows(), [(i, order[c], x, y, s) for i, c, x, y, s in _rows()])]
    a, b = ({r["id"]: round(r["score_0"], 9) for r in mdl.model_scores(t).collect()} for t in by_order)
    assert a != b  # split by order, the numbering does matter


def test_too_many_categories_are_split_by_order(spark):
    tm = mdl.train_ova_model(_frame(spark, _rows(200)), ["c", "x"], "y", max_iter=1, categorical=["c"], max_categories=5)
    assert tm.categorical == () and all(r["split"]["numCategories"] < 0 for r in tm.nodes.where("leftChild >= 0").collect())


def test_null_codes_and_labels(spark):
    rows = [(i, None if i % 9 == 0 else c, x, None if i % 13 == 0 else y, s) for i, c, x, y, s in _rows(300)]
    tm = mdl.train_ova_model(_frame(spark, rows), ["c", "x"], "y", max_iter=2, keys=["id"], categorical=["c"])
    want = sum(r[4] == "test" and r[3] is not None for r in rows)
    assert mdl.model_scores(tm).where("score_0 is not null and score_2 is not null").count() == want
    with pytest.raises(ValueError):
        mdl.train_ova_model(_frame(spark, rows).where("y is null"), ["c", "x"], "y")


def test_eval_set_stops_a_class_at_its_best_iteration(spark):
    df = _frame(spark, _rows(700, noise=0.5))
    kw = dict(max_iter=25, step_size=0.5, max_depth=4, categorical=["c"])
    whole = mdl.train_ova_model(df, ["c", "x"], "y", **kw)
    stopped = mdl.train_ova_model(df, ["c", "x"], "y", eval_split="test", eval_tol=0.0, **kw)
    loss = {}
    for r in mdl.learning_curve(whole).collect():
        loss.setdefault(r["class"], {})[r["iteration"]] = r["test_loss"]
    for k, m in enumerate(stopped.models):
        n, e = len(m.treeWeights), loss[k]
        assert n < 25
        assert all(e[i + 1] < e[i] for i in range(1, n)) and e[n + 1] >= e[n]
    curve = mdl.learning_curve(stopped).collect()
    assert {(r["class"], r["iteration"]) for r in curve} == {(k, i + 1) for k, m in enumerate(stopped.models) for i in range(len(m.treeWeights))}


def test_curve_equals_the_models_own_evaluation(fitted):
    curve = {(r["class"], r["iteration"]): r for r in mdl.learning_curve(fitted).collect()}
    assert len(curve) == 18
    for k, m in enumerate(fitted.models):
        for part, rows in (("train", fitted.train), ("test", fitted.test)):
            own = m.evaluateEachIteration(rows.withColumn(m.getLabelCol(), (F.col("y") == k).cast("double")))
            assert [curve[k, i + 1][f"{part}_loss"] for i in range(6)] == pytest.approx(own, rel=1e-9)
    for part in ("train", "test"):
        last = mdl.auc_mu(mdl.model_scores(fitted, part), "y", [f"score_{k}" for k in range(3)]).first()["auc_mu"]
        assert curve[0, 6][f"{part}_auc_mu"] == pytest.approx(last, rel=1e-12)
        assert curve[0, 6][f"{part}_auc_mu"] == curve[2, 6][f"{part}_auc_mu"]


def test_staged_scores_end_at_the_model_s(fitted):
    staged = {r["id"]: r for r in mdl.staged_scores(fitted).where("iteration = 6 and part = 'test'").collect()}
    for r in mdl.model_scores(fitted).collect():
        assert [staged[r["id"]][f"score_{k}"] for k in range(3)] == pytest.approx([r[f"score_{k}"] for k in range(3)], rel=1e-9)


def test_curve_reads_its_rows_in_one_scan_whatever_the_classes(fitted):
    plan = mdl.staged_scores(fitted)._jdf.queryExecution().optimizedPlan().toString()
    # the vector becomes an array once a row; the trees are plain expressions
    assert plan.count("Generate") == 1 and plan.count("UDF(") == 1 and plan.count("LogicalRDD") == 1


def test_importance_counts_the_nodes(fitted):
    gain, count = {}, {}
    for r in fitted.nodes.where("leftChild >= 0").collect():
        f = fitted.features[r["split"]["featureIndex"]]
        gain[f] = gain.get(f, 0) + r["gain"] * r["rawCount"]
        count[f] = count.get(f, 0) + 1
    got = mdl.feature_importance(fitted).collect()
    assert [r["feature"] for r in got] == sorted(fitted.features, key=lambda f: -gain.get(f, 0))
    for r in got:
        assert r["gain_importance"] == pytest.approx(gain.get(r["feature"], 0)) and r["split_importance"] == count.get(r["feature"], 0)


def test_curve_without_test_rows(spark):
    tm = mdl.train_ova_model(_frame(spark, _rows(120)).where("split = 'train'"), ["c", "x"], "y", max_iter=2, categorical=["c"], eval_split="test")
    assert all(r["test_loss"] is None and r["test_auc_mu"] is None and r["train_loss"] > 0 for r in mdl.learning_curve(tm).collect())


def test_tree_sql_sends_unknown_values_right():
    nodes = {0: {"leftChild": 1, "rightChild": 2, "split": {"featureIndex": 1, "numCategories": 3, "leftCategoriesOrThreshold": [0.0, 2.0]}},
             1: {"leftChild": -1, "prediction": 1.5}, 2: {"leftChild": -1, "prediction": -2.0}}
    assert trees.tree_sql(nodes, "x") == "CASE WHEN x[1] IN (0.0D, 2.0D) THEN 1.5D ELSE -2.0D END"


def test_whole_run_with_covered_labels_and_the_eval_set(spark):
    import datetime as dt

    from featurelens.operators.sampling import split_by_customer
    from featurelens.spec import FeatureSpec
    r = random.Random(2)
    people = spark.createDataFrame([(k,) for k in range(60)], "cust int")
    side = {x["cust"]: x["split"] for x in split_by_customer(people, "cust").collect()}
    only_train = [k for k, s in side.items() if s == "train"][0]
    rows = [(i, k, dt.date(2024, 1, 1) + dt.timedelta(days=i % 70), "rare" if k == only_train else r.choice(["p", "q"]), r.random(), r.choice("abc"))
            for i, k in enumerate(k for k in range(60) for _ in range(6))]
    df = spark.createDataFrame(rows, "id int, cust int, day date, label string, x double, c string")
    spec = FeatureSpec(cust_key="cust", pkeys=("id", "cust"), dkeys=("day", "month", "week", "month_idx", "week_idx"), label="label",
                       drop_cols=(), date_col="day")
    run = mdl.run_model_pipeline(df, spec, 1, cover_order=["id"], max_iter=3, keys=["id"])
    assert run.trained.categorical == ("c",) and run.trained.num_classes == 3
    assert {x["label_idx"] for x in run.trained.test.select("label_idx").distinct().collect()} == {0.0, 1.0, 2.0}
    assert run.auc_mu.first()["pairs"] == 3
    assert all(len(m.treeWeights) <= 3 for m in run.trained.models)
    plain = mdl.run_model_pipeline(df, spec, 1, max_iter=1, eval_split=None)
    assert len({x["label_idx"] for x in plain.trained.test.select("label_idx").distinct().collect()}) == 2


def test_rows_that_no_tree_tells_apart_are_one_cell(fitted):
    rows = fitted.data.withColumn("part", F.col("split"))
    cells = trees.cells(rows, fitted.nodes, "features", 2, ["part", "y"], "n").cache()
    every = fitted.data.count()
    assert cells.agg(F.sum("n")).first()[0] == every and cells.count() < every / 2
    # the cells have the rows' margins, as often
    own = {}
    for r in mdl.staged_scores(fitted).where("iteration = 6").collect():
        key = (r["part"], r["y"], *[round(r[f"score_{k}"], 9) for k in range(3)])
        own[key] = own.get(key, 0) + 1
    got = {}
    for r in trees.staged(cells, fitted.models, fitted.nodes, "features", ["part", "y", "n"]).where("iteration = 6").collect():
        key = (r["part"], int(r["y"]), *[round(s, 9) for s in r["scores"]])
        got[key] = got.get(key, 0) + r["n"]
    assert got == own


def test_auc_counts_weights_as_rows(spark):
    rows = [(0, 0.9, 0.1, 3), (0, 0.2, 0.6, 2), (1, 0.4, 0.5, 4), (1, 0.9, 0.1, 1)]
    df = spark.createDataFrame(rows, "y int, p0 double, p1 double, w long")
    whole = df.select("y", "p0", "p1", F.explode(F.expr("sequence(1, w)")))
    a = mdl.auc_mu_pairs(df, "y", ["p0", "p1"], weight="w").collect()
    assert a == mdl.auc_mu_pairs(whole, "y", ["p0", "p1"]).collect() and a[0]["n_i"] == 5


def _own_fit(df, k, **kw):
    """MLlib's trees over the rows themselves."""
    from pyspark.ml.classification import GBTClassifier
    return GBTClassifier(labelCol="_l", maxDepth=3, stepSize=0.1, seed=33, **kw).fit(
        df.withColumn("_l", (F.col("y") == k).cast("double")))


def test_counted_cells_give_the_trees_of_the_rows(spark):
    # 24,000 rows: MLlib draws its split candidates from a sample; x has many values, z few, w and n are often zero
    df = spark.range(0, 24_000, 1, 3).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(7))).cast("int").alias("c"), (F.pmod(F.hash("id"), F.lit(100_003)) / 7.0).alias("x"),
        (F.pmod(F.hash("id", F.lit(1)), F.lit(5))).cast("double").alias("z"),
        F.when(F.pmod(F.hash("id", F.lit(2)), F.lit(10)) == 0, F.pmod(F.hash("id", F.lit(3)), F.lit(1000)).cast("double")).otherwise(0.0).alias("w"),
        F.when(F.pmod(F.hash("id", F.lit(4)), F.lit(4)) > 0, F.pmod(F.hash("id", F.lit(5)), F.lit(900)).cast("double")).otherwise(0.0).alias("n"))
    label = F.pmod(F.floor(F.col("x") / 3000) + F.when(F.col("c").isin(1, 4), 1).otherwise(0) + F.when(F.col("n") > 500, 1).otherwise(F.when(F.col("w") > 300, 2).otherwise(0))
                   + F.pmod(F.hash("id", F.lit(6)), F.lit(2)), F.lit(3)).cast("int")
    df = df.withColumn("y", label).withColumn("split", F.when(F.col("id") % 5 == 0, "test").otherwise("train"))
    tm = mdl.train_ova_model(df, ["c", "x", "z", "w", "n"], "y", max_iter=4, keys=["id"], categorical=["c"])
    assert tm.cells.agg(F.sum("_rows")).first()[0] == 24_000
    for k in range(3):
        own = _own_fit(tm.train, k, maxIter=4)
        mine = {r["id"]: r["p"] for r in tm.models[k].transform(tm.test).selectExpr("id", "probability p").collect()}
        theirs = {r["id"]: r["p"] for r in own.transform(tm.test).selectExpr("id", "probability p").collect()}
        assert all(mine[i][1] == pytest.approx(theirs[i][1], rel=1e-9) for i in theirs)
    # the root's rows are rows, not cells
    assert {r["rawCount"] for r in tm.nodes.where("id = 0").collect()} == {19_200}


def test_no_iteration_reads_the_rows(spark):
    df = _frame(spark, _rows(600))
    tm = mdl.train_ova_model(df, ["c", "x"], "y", max_iter=2, categorical=["c"])
    assert tm.cells.count() < 600 * 0.9
    assert mdl.learning_curve(tm).count() == 6


def test_every_iteration_is_shown_and_the_best_kept(spark):
    df = _frame(spark, _rows(700, noise=0.5))
    kw = dict(max_iter=12, step_size=0.5, max_depth=4, categorical=["c"], keys=["id"], eval_split="test", eval_tol=0.0)
    stopped = mdl.train_ova_model(df, ["c", "x"], "y", **kw)
    shown = mdl.train_ova_model(df, ["c", "x"], "y", every_iteration=True, **kw)
    assert [len(m.treeWeights) for m in shown.models] == [len(m.treeWeights) for m in stopped.models]
    assert [len(m.treeWeights) for m in shown.fitted] == [12] * 3 and mdl.learning_curve(shown).count() == 36
    assert max(len(m.treeWeights) for m in shown.models) < 12
    a, b = ({r["id"]: [r[f"score_{k}"] for k in range(3)] for r in mdl.model_scores(t).collect()} for t in (shown, stopped))
    assert all(a[i] == pytest.approx(b[i], rel=1e-9) for i in b) and len(a) == len(b)
    assert shown.nodes.count() == stopped.nodes.count()


def test_registered_run_has_its_eval_set(spark, sf_small):
    from featurelens.plans import catalog
    run = catalog._run(spark, sf_small)
    loss: dict = {}
    for r in run.learning.collect():
        loss.setdefault(r["class"], {})[r["iteration"]] = r["test_loss"]
    for k, m in enumerate(run.trained.models):
        e, n = loss[k], len(m.treeWeights)
        assert len(e) == 20
        # MLlib's rule with its tolerance of a hundredth
        assert all(e[i] - e[i + 1] >= 0.01 * e[i + 1] for i in range(1, n)) and (n == 20 or e[n] - e[n + 1] < 0.01 * e[n + 1])
