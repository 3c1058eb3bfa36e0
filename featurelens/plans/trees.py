"""Boosted trees as column expressions: scores after every iteration.

A fitted tree becomes one SQL expression (nested CASE over the feature array),
so the outputs of all trees of all classes come from one scan, inside code
generation, and their running sums are the scores after each iteration. The
node table is model metadata: classes x iterations x 2^depth rows.
"""

from __future__ import annotations

import math
import sys
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def split_candidates(train: DataFrame, features: str, at: Sequence[int], rows: int, bins: int, seed: int) -> dict[int, list]:
    """The thresholds that MLlib's trees of ``seed`` and at most ``bins`` bins
    choose from, for the entries ``at`` of the vector: from the values of all
    rows, or of the sample that MLlib takes of more than 10,000 (or bins^2)."""
    from pyspark.ml.functions import vector_to_array
    if not rows or not at:
        return {i: [] for i in at}
    spark, x = train.sparkSession, train.select(features)
    most = min(bins, rows)
    share = min(1.0, max(most * most, 10_000) / rows)
    if share < 1:
        seed = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        drawn = x._jdf.toJavaRDD().sample(False, share, seed)
        x = DataFrame(spark._jsparkSession.createDataFrame(drawn, x._jdf.schema()), spark)
    x = x.select(vector_to_array(features).alias("_x"))
    value = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.get("_x", F.lit(i)) + 0.0).alias("v")) for i in at])).alias("e")
    held: dict = {i: {} for i in at}
    for r in x.select(value).groupBy("e.i", "e.v").count().collect():
        held[r["i"]][r["v"]] = r["count"]
    return {i: _candidates(v, share * rows, rows, most - 1) for i, v in held.items()}


def _candidates(counts: dict, expected: float, rows: int, most: int) -> list:
    """At most ``most`` thresholds between the values, near equal shares."""
    missing = math.isnan
    seen = sorted((v, n) for v, n in counts.items() if v and not missing(v))
    zeros = expected - sum(n for v, n in counts.items() if v)
    if zeros > sys.float_info.epsilon * rows * 100:
        seen = sorted([*seen, (0.0, zeros)])
    seen += [(math.nan, n) for v, n in counts.items() if missing(v)][:1]
    if len(seen) - 1 <= most:
        found = [(a + b) / 2 for (a, _), (b, _) in zip(seen, seen[1:])]
    else:
        stride = target = expected / (most + 1)
        upto, found = float(seen[0][1]), []
        for (a, _), (b, n) in zip(seen, seen[1:]):
            before, upto = upto, upto + n
            if abs(before - target) < abs(upto - target):
                found.append((a + b) / 2)
                target += stride
    return [v for v in found if not missing(v)]


def counted(data: DataFrame, features: str, size: int, cuts: dict, keep: Sequence, count: str) -> DataFrame:
    """``keep`` columns, ``features`` as an array in which every value with
    ``cuts`` is the first cut not under it, and the number of rows alike."""
    from pyspark.ml.functions import vector_to_array
    x = data.select(*keep, vector_to_array(features).alias("_x"))
    entries = [_upto_sql(f"_x[{i}]", cuts[i], 0, len(cuts[i])) if i in cuts else f"_x[{i}]" for i in range(size)]
    return (x.select(*keep, F.expr(f"array({', '.join(entries)})").alias(features))
            .groupBy(*keep, features).agg(F.count(F.lit(1)).alias(count)))


def binned(cells: DataFrame, features: str, size: int, cuts: dict) -> DataFrame:
    """:func:`counted` cells with a vector of the cuts' numbers."""
    from pyspark.ml.functions import array_to_vector
    number = [F.coalesce(F.array_position(F.array(*map(F.lit, cuts[i])).cast("array<double>"), F.get(features, F.lit(i))), F.lit(0)).cast("int")
              if i in cuts else None for i in range(size)]
    entries = [F.get(features, F.lit(i)) if c is None else F.when(c == 0, len(cuts[i])).otherwise(c - 1).cast("double") for i, c in enumerate(number)]
    return cells.withColumn(features, array_to_vector(F.array(*entries)))


def with_cuts(model, cuts: dict, spark, path: str):
    """A model of :func:`binned` cells as one of the rows, and its nodes
    (treeID, id, prediction, gain, rawCount, leftChild, rightChild, split): the
    thresholds are the cuts, the counts are rows. Saved at ``path``."""
    from pyspark.ml.classification import GBTClassificationModel
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")

    def moved(r):
        r = r.asDict(recursive=True)
        n = r["nodeData"]
        if n["leftChild"] >= 0 and n["split"]["numCategories"] < 0:
            n["split"]["leftCategoriesOrThreshold"] = [cuts[n["split"]["featureIndex"]][math.floor(n["split"]["leftCategoriesOrThreshold"][0])]]
        n["rawCount"] = round(n["impurityStats"][0])
        return r

    # model metadata: a row per node
    rows = [moved(r) for r in saved.collect()]
    spark.createDataFrame(rows, saved.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    out = GBTClassificationModel.load(path)
    # rows have no weights
    out._java_obj.clear(out._java_obj.getParam("weightCol"))
    out.clear(out.weightCol)
    return out, spark.read.schema(saved.schema).parquet(f"{path}/data").select("treeID", "nodeData.*")


def first_trees(model, n: int):
    """The boosted model of the first ``n`` trees."""
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel
    if n == len(model.treeWeights):
        return model
    sc = SparkContext._active_spark_context
    jvm, trees_, weights = sc._jvm, model._java_obj.trees(), model.treeWeights
    some = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    shares = sc._gateway.new_array(jvm.double, n)
    for i in range(n):
        some[i], shares[i] = trees_[i], float(weights[i])
    return GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, some, shares))


def _double(v: float) -> str:
    return f"{v!r}D" if math.isfinite(v) else f"double('{v}')"


def _goes_left(split, x: str) -> str:
    value = f"{x}[{split['featureIndex']}]"
    if split["numCategories"] < 0:
        return f"{value} <= {_double(split['leftCategoriesOrThreshold'][0])}"
    cats = ", ".join(f"{c!r}D" for c in split["leftCategoriesOrThreshold"])
    return f"{value} IN ({cats})" if cats else "false"


def tree_sql(nodes: dict, x: str, at: int = 0) -> str:
    """One tree (node rows by id) as an expression over the array ``x``. A
    value that no test is true for (NaN, an unknown category) goes right."""
    n = nodes[at]
    if n["leftChild"] < 0:
        return f"{n['prediction']!r}D"
    return (f"CASE WHEN {_goes_left(n['split'], x)} THEN {tree_sql(nodes, x, n['leftChild'])} "
            f"ELSE {tree_sql(nodes, x, n['rightChild'])} END")


def outputs(nodes: DataFrame, weights: Sequence[Sequence[float]], x: str) -> list[Column]:
    """Per class the array of its trees' weighted outputs, in tree order."""
    rows: dict = {}
    for r in nodes.collect():
        rows.setdefault((r["class"], r["treeID"]), {})[r["id"]] = r
    out = []
    for k, ws in enumerate(weights):
        parts = ", ".join(f"{float(w)!r}D * ({tree_sql(rows[k, i], x)})" for i, w in enumerate(ws))
        out.append(F.expr(f"array({parts})"))
    return out


def _upto_sql(value: str, cuts: list, low: int, high: int) -> str:
    """The first of the sorted ``cuts`` that is not under the value, infinity
    if there is none (NaN too), by binary search."""
    if low == high:
        return _double(cuts[low]) if low < len(cuts) else "double('Infinity')"
    mid = (low + high) // 2
    return (f"CASE WHEN {value} <= {_double(cuts[mid])} THEN {_upto_sql(value, cuts, low, mid)} "
            f"ELSE {_upto_sql(value, cuts, mid + 1, high)} END")


def cell_values(nodes: DataFrame, x: str, size: int) -> Column:
    """The array ``x`` of ``size`` features with every value replaced by one
    that all tests of all trees send the same way."""
    cuts, codes = {}, {}
    for r in nodes.where("leftChild >= 0").select("split.*").distinct().collect():
        (cuts if r["numCategories"] < 0 else codes).setdefault(r["featureIndex"], set()).update(r["leftCategoriesOrThreshold"])
    out = []
    for i in range(size):
        if i in cuts:
            out.append(_upto_sql(f"{x}[{i}]", sorted(cuts[i]), 0, len(cuts[i])))
        elif codes.get(i):
            out.append(f"CASE WHEN {x}[{i}] IN ({', '.join(f'{c!r}D' for c in sorted(codes[i]))}) THEN {x}[{i}] ELSE double('NaN') END")
        else:
            out.append("0.0D")
    return F.expr(f"array({', '.join(out)})")


def cells(data: DataFrame, nodes: DataFrame, features: str, size: int, keep: Sequence, count: str,
          weight: str | None = None) -> DataFrame:
    """``keep`` columns, ``features`` as an array and the number of rows (``count``)
    of every cell: rows alike in ``keep`` that no tree tells apart. A row counts
    ``weight`` times; ``features`` is a vector or an array."""
    from pyspark.ml.functions import vector_to_array
    array = data.schema[features].dataType.typeName() == "array"
    # the array is made below the tests, once a row
    x = data.select(*keep, (F.col(features) if array else vector_to_array(features)).alias("_x"), F.lit(1).alias("_n") if weight is None else F.col(weight).alias("_n"))
    return (x.select(*keep, cell_values(nodes, "_x", size).alias(features), "_n")
            .groupBy(*keep, features).agg(F.sum("_n").alias(count)))


def staged(data: DataFrame, models: Sequence, nodes: DataFrame, features: str, keep: Sequence) -> DataFrame:
    """``keep`` columns, iteration (from 1) and scores (array with one margin
    per class) of every row after every iteration of the longest class; a class
    that stopped earlier keeps its last margin. ``features`` is a vector or an
    array."""
    from pyspark.ml.functions import vector_to_array
    weights = [list(m.treeWeights) for m in models]
    longest = max(map(len, weights))
    array = data.schema[features].dataType.typeName() == "array"
    # the array is made below the trees, once a row
    x = data.select(*keep, (F.col(features) if array else vector_to_array(features)).alias("_x"))
    sums = [F.aggregate(o, F.array().cast("array<double>"), lambda acc, v: F.concat(
        acc, F.array(v + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0))))) for o in outputs(nodes, weights, "_x")]
    x = x.select(*keep, *[s.alias(f"_s{k}") for k, s in enumerate(sums)])
    at = [F.get(f"_s{k}", F.least(F.col("iteration"), F.lit(len(w))) - 1) for k, w in enumerate(weights)]
    return (x.withColumn("iteration", F.explode(F.sequence(F.lit(1), F.lit(longest))))
            .select(*keep, "iteration", F.array(*at).alias("scores")))


def log_loss(margin: Column, positive: Column) -> Column:
    """The boosting loss 2 ln(1 + exp(-2 y margin)), y = +1 or -1."""
    t = F.when(positive, -2 * margin).otherwise(2 * margin)
    return 2 * F.when(t > 0, t + F.log1p(F.exp(-t))).otherwise(F.log1p(F.exp(t)))
