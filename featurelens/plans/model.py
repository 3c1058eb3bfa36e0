"""One-vs-all boosted trees (MLlib) with categorical splits and an eval set,
learning curve, importance, AUC-mu and the feature selection report."""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, functions as F, Window

from featurelens.functions.constants import (
    DROPPED_FROM_MODEL, REMARK_CARDINALITY, REMARK_DKEY, REMARK_LABEL, REMARK_MISSING,
    REMARK_NOT_SELECTED, REMARK_PKEY, REMARK_SELECTED, REMARK_ZERO,
)
from featurelens.functions.text import remarks
from featurelens.operators.ranking import running_total
from featurelens.plans import trees


@dataclass
class TrainedModel:
    """One boosted model per class. ``categorical`` are the features that
    trees split by sets of codes; the others are split by order. ``fitted`` are
    the models of all iterations, ``models`` those that the eval set keeps;
    ``cells`` counts (``_rows``) the rows alike to the trees."""
    models: list
    features: list
    label_idx: str
    train: DataFrame
    test: DataFrame
    num_classes: int
    data: DataFrame
    split_col: str = "split"
    keys: tuple = ()
    categorical: tuple = ()
    fitted: list | None = None
    cells: DataFrame | None = None
    fitted_nodes: DataFrame | None = None

    @property
    def nodes(self) -> DataFrame:
        """The nodes of all trees of ``models``."""
        kept = F.create_map(*[F.lit(x) for k, m in enumerate(self.models) for x in (k, len(m.treeWeights))])
        return self.fitted_nodes.where(F.col("treeID") < kept[F.col("class")])


def _attributes(features: Sequence[str], arity: dict[str, int]) -> dict:
    """Metadata of the feature vector: which entries are codes of how many
    categories."""
    nominal = [{"idx": i, "name": f, "num_vals": arity[f]} for i, f in enumerate(features) if f in arity]
    numeric = [{"idx": i, "name": f} for i, f in enumerate(features) if f not in arity]
    groups = {k: v for k, v in (("numeric", numeric), ("nominal", nominal)) if v}
    return {"ml_attr": {"attrs": groups, "num_attrs": len(features)}}


def train_ova_model(df: DataFrame, features: Sequence[str], label_idx: str, split_col: str = "split",
                    max_depth: int = 3, max_iter: int = 20, step_size: float = 0.1, seed: int = 33,
                    parallelism: int = 4, checkpoint: bool = True, keys: Sequence[str] = (),
                    categorical: Sequence[str] = (), max_categories: int = 1024,
                    eval_split: str | None = None, eval_tol: float = 0.01, every_iteration: bool = False) -> TrainedModel:
    """Fit one boosted-tree model per class (one-vs-rest) on the train rows.

    ``categorical`` names features that hold codes 0..n-1: they become nominal
    attributes, so trees split sets of codes and their numbering does not
    matter; a NULL code is a category of its own. Features of more than
    ``max_categories`` codes are split by order (the trees' bins grow with the
    largest number of categories). With ``eval_split`` the rows of that split
    are the eval set: a class stops boosting when its loss there no longer
    falls by ``eval_tol`` of itself, and keeps its best iteration. With
    ``every_iteration`` it boosts on, for the learning curve, and keeps the same
    iteration. Rows without a label are left out.

    Trees tell rows apart only by codes and by the intervals between MLlib's
    split candidates. Rows alike in them and in split and label are counted in
    one scan, and MLlib fits the counted cells, weighted by their rows: the
    trees are those of the rows, but no iteration reads the rows again. The
    models have the rows' thresholds.

    The assembled training frame is checkpointed to the shared folder
    (``spark.checkpoint.dir``): the trees read it many times, and a lost
    executor then recomputes from the checkpoint, not the whole lineage.
    ``keys`` are carried along, so that scores can be joined back.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    from featurelens.session import cut_lineage, scratch_dir

    names = list(features)
    nominal = [f for f in names if f in set(categorical)]
    arity = {}
    if nominal:
        # a code of its own stands for NULL, so every category is counted once more
        top = df.agg(*[F.max(f).cast("long").alias(f"m{i}") for i, f in enumerate(nominal)]).first()
        arity = {f: (-1 if top[i] is None else top[i]) + 2 for i, f in enumerate(nominal)}
        arity = {f: n for f, n in arity.items() if n <= max_categories}
        df = df.withColumns({f: F.coalesce(F.col(f).cast("long"), F.lit(n - 1)) for f, n in arity.items()})
    asm = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    data = asm.transform(df.where(F.col(label_idx).isNotNull()).withColumn(label_idx, F.col(label_idx).cast("double")))
    data = data.select(*keys, "features", label_idx, split_col)
    if checkpoint:
        data = cut_lineage(data)
    data = data.withColumn("features", F.col("features").alias("features", metadata=_attributes(names, arity)))
    train, test = (data.where(F.col(split_col) == s) for s in ("train", "test"))
    held = F.col(split_col) == eval_split
    seen = data.agg(F.max(label_idx).alias("k"), F.count(F.when(held, 1)).alias("held") if eval_split else F.lit(0).alias("held"),
                    F.count(F.when(F.col(split_col) == "train", 1)).alias("train")).first()
    classes = int(seen["k"]) + 1 if seen["k"] is not None else 0
    if not classes:
        raise ValueError(f"no row has a label in {label_idx}")
    bins = max([32, *arity.values()])
    ordered = [i for i, f in enumerate(names) if f not in arity]
    cuts = trees.split_candidates(train, "features", ordered, seen["train"], bins, seed)
    x = data.where(F.col(split_col).isin("train", "test", *([eval_split] if eval_split else [])))
    # many reads of a small table
    cells = cut_lineage(trees.counted(x, "features", len(names), cuts, [split_col, label_idx], "_rows"))
    fit_on = trees.binned(cells, "features", len(names), cuts).withColumn(
        "features", F.col("features").alias("features", metadata=_attributes(names, arity)))
    fit_on = fit_on.withColumn("_held", held if seen["held"] else F.lit(False)).where((F.col(split_col) == "train") | F.col("_held"))
    few = fit_on.agg(F.count(F.when(~F.col("_held"), 1))).first()[0]
    # MLlib wants as many rows as bins: cells are cut in parts of equal weight
    parts = 1
    while 0 < few * parts < min(bins, seen["train"]):
        parts *= 2
    fit_on = fit_on.withColumn("_weight", F.col("_rows") / F.lit(float(parts))).withColumn("_part", F.explode(F.sequence(F.lit(1), F.lit(parts)))).drop("_part")
    stop = bool(seen["held"]) and not every_iteration
    extra = {"validationIndicatorCol": "_held", "validationTol": eval_tol} if stop else {}
    spark = data.sparkSession

    def one(k: int):
        own = fit_on.withColumn(f"_is_{k}", (F.col(label_idx) == k).cast("double"))
        gbt = GBTClassifier(labelCol=f"_is_{k}", maxDepth=max_depth, maxIter=max_iter, stepSize=step_size, seed=seed,
                            maxBins=bins, weightCol="_weight", **extra)
        binned = gbt.fit(own if stop else own.where("not _held"))
        losses = binned.evaluateEachIteration(own.where("_held")) if seen["held"] and every_iteration else []
        model, nodes = trees.with_cuts(binned, cuts, spark, scratch_dir(spark, f"trees-{k}"))
        return model, nodes.select(F.lit(k).alias("class"), "*"), trees.first_trees(model, _best(losses, eval_tol)) if losses else model

    with ThreadPool(min(parallelism, classes)) as pool:
        done = pool.map(inheritable_thread_target(spark)(one), range(classes))
    fitted, nodes, kept = zip(*done)
    return TrainedModel(list(kept), names, label_idx, train, test, classes, data, split_col, tuple(keys), tuple(arity),
                        list(fitted), cells, functools.reduce(DataFrame.unionByName, nodes))


def _best(losses: Sequence[float], tol: float) -> int:
    """The iterations MLlib keeps by these losses of the eval set."""
    best = 1
    for m in range(1, len(losses)):
        if losses[best - 1] - losses[m] < tol * max(losses[m], 0.01):
            break
        best = m + 1
    return best


def _parts(tm: TrainedModel, rows: DataFrame) -> DataFrame:
    return rows.where(F.col(tm.split_col).isin("train", "test")).withColumn("part", F.col(tm.split_col))


def _staged(tm: TrainedModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    out = trees.staged(rows, tm.fitted, tm.fitted_nodes, "features", ["part", *keep, tm.label_idx])
    return out.select("part", *keep, F.col(tm.label_idx).cast("int").alias(tm.label_idx), "iteration",
                      *[F.get("scores", F.lit(k)).alias(f"score_{k}") for k in range(tm.num_classes)])


def staged_scores(tm: TrainedModel) -> DataFrame:
    """(part, keys, label_idx, iteration, score_0..score_k-1): the margins of
    every train and test row after every boosting iteration, from one scan."""
    return _staged(tm, _parts(tm, tm.data), tm.keys)


def learning_curve(tm: TrainedModel) -> DataFrame:
    """(class, iteration, train_loss, test_loss, train_auc_mu, test_auc_mu).

    The loss is that of the class model after the iteration; AUC-mu is of all
    classes together after it (the same in every class's row). Rows of one part
    and label that no tree tells apart have the same margins throughout: the
    trees, the losses and the ranks take the counts of the model's cells (rows x
    iterations are never made, and no row is read). Two aggregations, however
    many classes and iterations; a part without rows has NULLs.
    """
    from featurelens.session import cut_lineage
    scores = [f"score_{k}" for k in range(tm.num_classes)]
    # both aggregations read it
    cells = cut_lineage(trees.cells(_parts(tm, tm.cells), tm.fitted_nodes, "features", len(tm.features), ["part", tm.label_idx], "_rows", "_rows"))
    st = _staged(tm, cells, ["_rows"])
    losses = st.groupBy("part", "iteration").agg(*[
        (F.sum(trees.log_loss(F.col(c), F.col(tm.label_idx) == k) * F.col("_rows")) / F.sum("_rows")).alias(c) for k, c in enumerate(scores)])
    each = losses.select("part", "iteration", F.posexplode(F.array(*scores)).alias("class", "loss"))
    length = F.create_map(*[F.lit(x) for k, m in enumerate(tm.fitted) for x in (k, len(m.treeWeights))])
    loss = (each.where(F.col("iteration") <= length[F.col("class")]).groupBy("class", "iteration")
            .agg(*[F.max(F.when(F.col("part") == p, F.col("loss"))).alias(f"{p}_loss") for p in ("train", "test")]))
    auc = (auc_mu_pairs(st, tm.label_idx, scores, by=("part", "iteration"), weight="_rows").groupBy("iteration")
           .agg(*[F.avg(F.when(F.col("part") == p, F.col("auc"))).alias(f"{p}_auc_mu") for p in ("train", "test")]))
    return loss.join(auc, "iteration", "left").select(
        "class", "iteration", "train_loss", "test_loss", "train_auc_mu", "test_auc_mu")


def feature_importance(tm: TrainedModel) -> DataFrame:
    """(feature, gain_importance, split_importance) over the inner nodes of all
    trees of all class models: the sum of gain x rows, and the number of
    splits. Read from the models' saved trees."""
    used = (tm.nodes.where("leftChild >= 0").groupBy(F.col("split.featureIndex").alias("_i"))
            .agg(F.sum(F.col("gain") * F.col("rawCount")).alias("gain_importance"), F.count("*").alias("split_importance")))
    names = tm.train.sparkSession.createDataFrame(list(enumerate(tm.features)), "_i int, feature string")
    return (names.join(used, "_i", "left")
                 .select("feature", F.coalesce("gain_importance", F.lit(0.0)).alias("gain_importance"),
                         F.coalesce("split_importance", F.lit(0)).alias("split_importance"))
                 .orderBy(F.col("gain_importance").desc(), "feature"))


def importance_elbow(importance: DataFrame) -> int:
    """Number of features up to the elbow of the sorted gain curve: the point
    farthest from the chord first -> last (one row per feature, collected)."""
    g = [r[0] for r in importance.orderBy(F.col("gain_importance").desc(), "feature")
         .select("gain_importance").collect()]
    if len(g) < 3:
        return len(g)
    x0, y0, x1, y1 = 0.0, g[0], float(len(g) - 1), g[-1]
    dx, dy = x1 - x0, y1 - y0
    norm = (dx * dx + dy * dy) ** 0.5 or 1.0
    dist = [abs(dy * i - dx * (v - y0)) / norm for i, v in enumerate(g)]
    return max(range(len(g)), key=lambda i: dist[i]) + 1


def auc_mu_pairs(scores: DataFrame, label_idx: str, score_cols: Sequence[str], by: Sequence[str] = (),
                 weight: str | None = None) -> DataFrame:
    """Pairwise AUC of classes (i, j), i < j, scored by s = p_i - p_j
    (Kleiman & Page, 2019): P(s_i > s_j) + 0.5 P(s_i = s_j). ``by`` groups
    the rows first (a part, an iteration); a row counts ``weight`` times (a long)."""
    by = list(by)
    times = F.lit(1).cast("long") if weight is None else F.col(weight)
    lab, p = F.col(label_idx).cast("int"), F.array(*[F.col(c) for c in score_cols])
    # a row meets each other class once
    met = scores.select(*by, lab.alias("y"), p.alias("p"), times.alias("m"), F.explode(F.sequence(F.lit(0), F.lit(len(score_cols) - 1))).alias("o")).where("o <> y")
    long = met.select(*by, F.least("y", "o").alias("ci"), F.greatest("y", "o").alias("cj"),
                      (F.get("p", F.least("y", "o")) - F.get("p", F.greatest("y", "o"))).alias("s"),
                      (F.col("y") < F.col("o")).alias("is_i"), "m")
    cnt = long.groupBy(*by, "ci", "cj", "s").agg(F.sum(F.when(F.col("is_i"), F.col("m")).otherwise(0)).alias("ni"),
                                           F.sum(F.when(F.col("is_i"), 0).otherwise(F.col("m"))).alias("nj"))
    ranked = running_total(cnt, [F.col("s")], [*by, "ci", "cj"], "nj", "cum_nj")
    below = F.col("cum_nj") - F.col("nj")
    return (ranked.groupBy(*by, "ci", "cj")
                  .agg(F.sum(F.col("ni") * (below + F.col("nj") * 0.5)).alias("_w"),
                       F.sum("ni").alias("n_i"), F.sum("nj").alias("n_j"))
                  .select(*by, "ci", "cj", F.try_divide(F.col("_w"), F.col("n_i") * F.col("n_j")).alias("auc"),
                          F.col("n_i").cast("long").alias("n_i"), F.col("n_j").cast("long").alias("n_j")))


def auc_mu(scores: DataFrame, label_idx: str, score_cols: Sequence[str], weight: str | None = None) -> DataFrame:
    """Mean pairwise AUC (one row); a row counts ``weight`` times."""
    return auc_mu_pairs(scores, label_idx, score_cols, weight=weight).agg(F.avg("auc").alias("auc_mu"),
                                                          F.count(F.lit(1)).alias("pairs"))


def model_scores(tm: TrainedModel, part: str = "test") -> DataFrame:
    """(keys, label_idx, score_0..score_k-1) from the class models' raw margins."""
    return _margins(tm, tm.test if part == "test" else tm.train, tm.keys)


def _margins(tm: TrainedModel, out: DataFrame, keep: Sequence[str]) -> DataFrame:
    from pyspark.ml.functions import vector_to_array as vec
    cols = [*keep, F.col(tm.label_idx).cast("int").alias(tm.label_idx)]
    for k, sub in enumerate(tm.models):
        # a copy: the fitted model keeps its own column names
        out = (sub.copy().setRawPredictionCol(f"_raw{k}").setPredictionCol(f"_pred{k}")
                  .setProbabilityCol(f"_prob{k}").transform(out).drop(f"_pred{k}", f"_prob{k}"))
        cols.append(vec(F.col(f"_raw{k}"))[1].alias(f"score_{k}"))
    return out.select(*cols)


def feature_report(summary: DataFrame, importance: DataFrame, spec, number_of_features: int) -> DataFrame:
    """Every summarised column with model use, selection flag (top n by gain),
    remarks and importance; columns without importance are marked dropped."""
    w = Window.orderBy(F.col("gain_importance").desc(), F.col("feature"))  # one row per feature
    fi = importance.withColumn("_rank", F.row_number().over(w) - 1).select(
        "feature", "gain_importance", "split_importance",
        (F.col("_rank") < number_of_features).cast("int").alias("is_model_selected_flag"))
    base = summary.select("var", "missing_rate", "zero_rate", "num_unique")
    rep = base.join(fi, base["var"] == fi["feature"], "left")
    flag = F.col("is_model_selected_flag")
    rem = remarks(
        (F.col("missing_rate") == 1, REMARK_MISSING),
        (F.col("zero_rate") == 1, REMARK_ZERO),
        (F.col("num_unique") == 1, REMARK_CARDINALITY),
        (flag == 1, REMARK_SELECTED),
        (flag == 0, REMARK_NOT_SELECTED),
        (F.col("var").isin(list(spec.pkeys)), REMARK_PKEY),
        (F.col("var").isin(list(spec.dkeys)), REMARK_DKEY),
        (F.col("var") == F.lit(spec.label), REMARK_LABEL),
    )
    return rep.select(
        "var",
        F.col("gain_importance").isNotNull().cast("int").alias("used_as_model_input"),
        flag.alias("is_model_selected_flag"),
        rem.alias("remarks"),
        "gain_importance",
        F.col("split_importance").cast("long").alias("split_importance"),
        F.when(F.col("gain_importance").isNull(), F.lit(DROPPED_FROM_MODEL)).alias("status"),
    )


def sort_feature_report(rep: DataFrame) -> DataFrame:
    return rep.orderBy(F.col("gain_importance").desc_nulls_last(), "var")


@dataclass
class ModelRun:
    """What :func:`run_model_pipeline` leaves."""
    prepared: object
    trained: TrainedModel
    label_map: DataFrame
    split_counts: DataFrame
    label_distribution: DataFrame
    learning: DataFrame
    importance: DataFrame
    elbow: int
    auc_mu: DataFrame
    report: DataFrame
    path: str | None = None
    base: str | None = None


def run_model_pipeline(df: DataFrame, spec, number_of_features: int | None = None, base: str | None = None,
                       report: str = "model", artefacts: str | None = None, artefact: str = "training",
                       keys: Sequence[str] = (), eval_split: str | None = "test", cover_order: Sequence[str] = (),
                       **train_args) -> ModelRun:
    """The whole run: features -> label codes -> split by customer -> one
    model per class -> curves, importance, AUC of the test rows, feature
    report.

    Without ``number_of_features`` the elbow of the importance curve decides.
    ``base`` saves the report's sections, ``artefacts`` the label and category
    maps. The coded text features are categorical for the trees, and the test
    rows are the eval set (``eval_split=None``: every iteration is kept).
    ``cover_order`` names columns that order the rows: then labels missing on
    one side are written over its last rows first (:func:`cover_labels`, which
    falsifies those labels).
    """
    from pyspark.ml.functions import array_to_vector

    from featurelens.operators import encoding, sampling
    from featurelens.plans.features import prepare_features
    from featurelens.session import cut_lineage
    prep = prepare_features(df, spec)
    x = sampling.split_by_customer(prep.df, spec.cust_key)
    if cover_order:
        x, _, _ = sampling.cover_labels(x, spec.label, "split", list(cover_order))
    x, labels = encoding.label_encode(x, spec.label, artefact)
    idx = f"{spec.label}_idx"
    tm = train_ova_model(x, prep.valid, idx, keys=keys, categorical=prep.categorical, eval_split=eval_split, **train_args)
    # one row per feature, and per class and iteration: computed once
    importance = cut_lineage(feature_importance(tm))
    elbow = importance_elbow(importance)
    counts = sampling.split_counts(x, spec.cust_key)
    dist = sampling.label_distribution(x, idx, "split", spec.label)
    learning = cut_lineage(learning_curve(tm))
    # rows of one cell have the same scores
    cells = tm.cells.where(F.col("split") == "test").withColumn("features", array_to_vector("features"))
    auc = auc_mu(_margins(tm, cells, ["_rows"]), idx, [f"score_{k}" for k in range(tm.num_classes)], "_rows")
    rep = sort_feature_report(feature_report(prep.summary, importance, spec, number_of_features or elbow))
    if artefacts:
        from featurelens.sources.reports import save_artefacts
        save_artefacts(labels, artefacts)
        if prep.category_map is not None:
            save_artefacts(prep.category_map, artefacts)
    path = None
    if base:
        summary = prep.summary.withColumn("samples", F.array_join("samples", "|"))
        path = save_feature_report(base, report, summary, counts, dist, learning, importance, rep)
    return ModelRun(prep, tm, labels, counts, dist, learning, importance, elbow, auc, rep, path, base)


def save_feature_report(base: str, report: str, summary: DataFrame, split_counts: DataFrame,
                        label_dist: DataFrame, learning: DataFrame, importance: DataFrame,
                        selection: DataFrame) -> str:
    from featurelens.sources.reports import write_report
    return write_report({
        "data_summary": summary, "train_test_count": split_counts, "label_dist": label_dist,
        "learning_details": learning, "feature_importance": importance,
        "feature_selection_report": selection}, base, report)
