"""Quantile binning and information value (IV) for every label and feature.

One scan for all labels and all features, in long form: the binned table is
unpivoted to (label, var, bin) and counted with map-side combine. That small
table of the combinations that occur is checkpointed; bin totals, label totals
and the zero cells come from it by joins, so the number of labels is not
bounded and no label reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from featurelens.functions.constants import (
    EPS_IV, HIGH_BIN_IV, MAX_UNBINNED_DISTINCT, MISSING_BIN_LABEL,
    MISSING_NUMERIC_BIN, MISSING_TEXT_BIN, QUANTILE_BINS, SIGNIFICANT_LABEL_ROWS,
    USEFUL_IV,
)
from featurelens.functions.text import iv_strength as _iv_strength
from featurelens.operators.columns import nan_to_null, proposed_type
from featurelens.operators.ranking import exact_quantiles, null_safe_join
from featurelens.session import cut_lineage


def decile_probs(q: int = QUANTILE_BINS) -> list[float]:
    return [i / q for i in range(q + 1)]


def quantile_edges(df: DataFrame, cols: Sequence[str], q: int = QUANTILE_BINS,
                   method: str = "exact", edge_decimals: int | None = None,
                   accuracy: int = 100000) -> DataFrame:
    """(var, edges): sorted distinct quantile edges of each numeric column.

    ``exact`` ranks distinct values across range partitions (no single-task
    buffer); ``approx`` uses ``percentile_approx`` (bounded memory sketch).
    ``edge_decimals`` rounds edges (for comparisons with other engines).
    """
    probs = decile_probs(q)
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "var string, edges array<double>")
    vals = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols]
    long = df.select(*vals).unpivot([], cols, "var", "x")
    if method == "exact":
        qs = exact_quantiles(long, "var", "x", probs, out="q").select("var", "q")
    elif method == "approx":
        qs = long.groupBy("var").agg(F.percentile_approx("x", probs, accuracy).cast("array<double>").alias("q"))
    else:
        raise ValueError(f"unknown method {method!r}")
    q = F.col("q")
    if edge_decimals is not None:
        q = F.transform(q, lambda e: F.round(e, edge_decimals))
    return qs.select("var", F.array_sort(F.array_distinct(q)).alias("edges"))


@dataclass(frozen=True)
class BinPlan:
    """Which columns are binned by quantile, kept as values, or text."""
    binned: tuple
    unbinned: tuple
    categorical: tuple


def plan_bins(summary: DataFrame, features: Sequence[str] | None = None,
              max_unbinned: int = MAX_UNBINNED_DISTINCT) -> BinPlan:
    """Decide per column from the summary (collects one row per column)."""
    rows = summary.select("var", "proposed_data_type", "num_unique").collect()
    want = set(features) if features is not None else None
    b, u, c = [], [], []
    for r in rows:
        if want is not None and r["var"] not in want:
            continue
        if r["proposed_data_type"] == "numerical":
            (b if r["num_unique"] > max_unbinned else u).append(r["var"])
        else:
            c.append(r["var"])
    return BinPlan(tuple(b), tuple(u), tuple(c))


def binned_long(df: DataFrame, label_col: str, plan: BinPlan, edges: DataFrame | None = None,
                q: int = QUANTILE_BINS, method: str = "exact",
                edge_decimals: int | None = None) -> DataFrame:
    """(_label, var, bin_idx, s) for every row and feature.

    Binned numbers: bin_idx = number of edges below the value (at least 1),
    NULL for a missing value. Numbers with few values: s = the value as
    text, NULL -> 9999999. Text: s = the value, NULL -> ``NA``. Bin texts
    and edges are attached after aggregation (:func:`attach_bins`).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    df = nan_to_null(df)
    if plan.binned and edges is None:
        edges = quantile_edges(df, plan.binned, q, method, edge_decimals)
    structs = []
    names = []
    for c in plan.binned:
        structs.append(F.struct(F.col(c).cast("double").alias("x"), F.lit(None).cast("string").alias("s")).alias(c))
        names.append(c)
    for c in plan.unbinned:
        # the filler goes in as text: it may not fit a short column type
        fill = str(float(MISSING_NUMERIC_BIN)) if isinstance(fields[c], (T.FloatType, T.DoubleType)) else str(MISSING_NUMERIC_BIN)
        structs.append(F.struct(F.lit(None).cast("double").alias("x"),
                                F.coalesce(F.col(c).cast("string"), F.lit(fill)).alias("s")).alias(c))
        names.append(c)
    for c in plan.categorical:
        structs.append(F.struct(F.lit(None).cast("double").alias("x"),
                                F.coalesce(F.col(c).cast("string"), F.lit(MISSING_TEXT_BIN)).alias("s")).alias(c))
        names.append(c)
    wide = df.select(F.col(label_col).cast("string").alias("_label"), *structs)
    long = wide.unpivot(["_label"], names, "var", "v").select("_label", "var", "v.x", "v.s")
    if plan.binned:
        # edges: one row per binned column, spread to columns e1..e(q+1) so
        # that the bin test is plain comparisons in generated code
        n = q + 1
        flat = edges.select("var", F.lit(True).alias("_binned"), *[
            F.try_element_at(F.col("edges"), F.lit(i)).alias(f"_e{i}") for i in range(1, n + 1)])
        long = long.join(F.broadcast(flat), "var", "left")
        below = None
        for i in range(1, n + 1):
            t = F.when(F.col(f"_e{i}") < F.col("x"), 1).otherwise(0)
            below = t if below is None else below + t
        idx = F.when(F.col("_binned").isNotNull() & F.col("x").isNotNull(), F.greatest(F.lit(1), below))
        long = long.withColumn("bin_idx", idx.cast("int"))
    else:
        long = long.withColumn("bin_idx", F.lit(None).cast("int"))
    return long.select("_label", "var", "bin_idx", "s")


def attach_bins(df: DataFrame, edges: DataFrame | None, binned: Sequence[str]) -> DataFrame:
    """From (var, bin_idx, s) add bin_lo, bin_hi and the text ``bin``:
    ``(lo, hi]`` for quantile bins, ``nan`` for their missing values, the
    value text otherwise. Runs on aggregated rows."""
    if not binned or edges is None:
        return (df.withColumn("bin_lo", F.lit(None).cast("double"))
                  .withColumn("bin_hi", F.lit(None).cast("double"))
                  .withColumn("bin", F.col("s")).drop("s"))
    x = df.join(F.broadcast(edges), "var", "left")
    is_binned = F.col("var").isin(list(binned))
    lo = F.element_at(F.col("edges"), F.col("bin_idx"))
    hi = F.element_at(F.col("edges"), F.least(F.col("bin_idx") + 1, F.size(F.col("edges"))))
    has = F.col("bin_idx").isNotNull()
    label = F.format_string("(%s, %s]", lo.cast("string"), hi.cast("string"))
    return (x.withColumn("bin_lo", F.when(has, lo)).withColumn("bin_hi", F.when(has, hi))
             .withColumn("bin", F.when(~is_binned, F.col("s")).when(~has, F.lit(MISSING_BIN_LABEL))
                                 .otherwise(label))
             .drop("edges", "s"))


def quantile_bins(df: DataFrame, cols: Sequence[str], q: int = QUANTILE_BINS, method: str = "exact",
                  edge_decimals: int | None = None) -> DataFrame:
    """Rows per quantile bin of each column: (var, bin_idx, bin_lo, bin_hi, bin, n)."""
    plan = BinPlan(tuple(cols), (), ())
    edges = quantile_edges(df, cols, q, method, edge_decimals)
    long = binned_long(df.withColumn("_nolabel", F.lit(None).cast("string")), "_nolabel",
                       plan, edges=edges, q=q)
    counts = long.groupBy("var", "bin_idx", "s").agg(F.count(F.lit(1)).alias("n"))
    return attach_bins(counts, edges, cols).select("var", "bin_idx", "bin_lo", "bin_hi", "bin", "n")


def _iv_term(neg_rate: Column, pos_rate: Column) -> Column:
    return (neg_rate - pos_rate) * F.log((neg_rate + F.lit(EPS_IV)) / (pos_rate + F.lit(EPS_IV)))


def iv_verbose(df: DataFrame, label_col: str, plan: BinPlan, q: int = QUANTILE_BINS, method: str = "exact",
               edge_decimals: int | None = None, types: dict | None = None) -> DataFrame:
    """Per label x feature x bin: neg, pos, totals, rates and IV of the bin.

    The result holds every bin for every label (a bin without the label has
    pos 0 and counts for the label's IV). Rows with a NULL label count as
    negatives of all labels.
    """
    edges = quantile_edges(df, plan.binned, q, method, edge_decimals) if plan.binned else None
    long = binned_long(df, label_col, plan, edges=edges, q=q)
    # the combinations that occur; NULL parts of a bin get a value so that
    # plain equality joins them
    counts = cut_lineage(long.groupBy("var", "bin_idx", "s", "_label").agg(F.count(F.lit(1)).alias("n"))
                         .withColumn("_bin", F.struct(F.coalesce("bin_idx", F.lit(-1)).alias("i"),
                                                      F.col("s").isNull().alias("z"), F.coalesce("s", F.lit("")).alias("s"))))
    labelled = counts.where(F.col("_label").isNotNull()).withColumnRenamed("_label", "label")
    per_bin = counts.groupBy("var", "_bin", "bin_idx", "s").agg(F.sum("n").alias("_bin_n"))
    # every row falls in exactly one bin of each feature, so any feature's
    # bins add up to the label totals
    per_label = labelled.groupBy("var", "label").agg(F.sum("n").alias("total_pos"))
    per_var = counts.groupBy("var").agg(F.sum("n").alias("_n"))
    totals = per_label.join(per_var, "var").withColumn("total_neg", F.col("_n") - F.col("total_pos"))
    grid = attach_bins(per_bin, edges, plan.binned).join(totals, "var")
    pos = labelled.select("var", "_bin", "label", F.col("n").alias("pos"))
    grid = grid.join(pos, ["var", "_bin", "label"], "left").withColumn("pos", F.coalesce("pos", F.lit(0)))
    fields = {f.name: f.dataType for f in df.schema.fields}
    ptype = F.create_map(*[x for c in plan.binned + plan.unbinned + plan.categorical
                           for x in (F.lit(c), F.lit((types or {}).get(c, proposed_type(fields[c]))))])
    neg_rate = F.try_divide(F.col("neg"), F.col("total_neg"))
    pos_rate = F.try_divide(F.col("pos"), F.col("total_pos"))
    return (grid.withColumn("neg", F.col("_bin_n") - F.col("pos"))
                .select("label", "var", "bin", "bin_idx", "bin_lo", "bin_hi",
                        F.element_at(ptype, F.col("var")).alias("proposed_data_type"),
                        F.col("neg").cast("long").alias("neg"), F.col("pos").cast("long").alias("pos"),
                        F.col("total_neg").cast("long").alias("total_neg"),
                        F.col("total_pos").cast("long").alias("total_pos"),
                        neg_rate.alias("neg_rate"), pos_rate.alias("pos_rate"))
                .withColumn("iv", _iv_term(F.col("neg_rate"), F.col("pos_rate"))))


def iv_summary(verbose: DataFrame) -> DataFrame:
    """Per label x feature: totals and IV = sum over bins."""
    return (verbose.groupBy("label", "var", "proposed_data_type")
                   .agg(F.max("total_neg").alias("total_neg"), F.max("total_pos").alias("total_pos"),
                        F.sum("iv").alias("iv")))


def iv_all(df: DataFrame, label_col: str, summary: DataFrame, features: Sequence[str] | None = None,
           q: int = QUANTILE_BINS, method: str = "exact", edge_decimals: int | None = None,
           materialize: bool = True):
    """(verbose, summary) IV tables for all labels x all features."""
    if features is None:
        features = [c for c in df.columns if c != label_col]
    plan = plan_bins(summary, features)
    verbose = iv_verbose(df, label_col, plan, q=q, method=method, edge_decimals=edge_decimals)
    if materialize:
        # labels x bins rows; both outputs (and any review) read it
        verbose = cut_lineage(verbose)
    return verbose, iv_summary(verbose)


def iv_strength(iv_table: DataFrame, iv_col: str = "iv") -> DataFrame:
    return iv_table.withColumn("iv_strength", _iv_strength(iv_col))


def sort_bins(verbose: DataFrame) -> DataFrame:
    """Report order: label, var, then bins by lower edge (missing bin last) or by text."""
    return verbose.orderBy("label", "var", F.col("bin_idx").asc_nulls_last(), "bin")


def label_counts(df: DataFrame, label_col: str, min_rows: int = SIGNIFICANT_LABEL_ROWS) -> DataFrame:
    """Rows per label and whether the label is significant (>= min_rows)."""
    return (df.groupBy(F.col(label_col).cast("string").alias("label"))
              .agg(F.count(F.lit(1)).alias("count"))
              .withColumn("is_significant", F.col("count") >= min_rows))


def describe_by(df: DataFrame, by: str, value: str, prefix: str = "",
                count_name: str | None = None, method: str = "exact") -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max of ``value`` per ``by`` (NULL is a
    group of its own)."""
    p = prefix
    base = df.groupBy(by).agg(
        F.count(value).alias(count_name or f"{p}count"), F.avg(value).alias(f"{p}mean"),
        F.stddev_samp(value).alias(f"{p}std"), F.min(value).cast("double").alias(f"{p}min"),
        F.max(value).cast("double").alias(f"{p}max"))
    probs = [0.25, 0.5, 0.75]
    if method == "exact":
        qs = exact_quantiles(df.select(F.col(by), F.col(value).cast("double").alias("_x")), by, "_x", probs)
        qs = qs.select(by, "quantiles")
    else:
        qs = df.groupBy(by).agg(F.percentile_approx(F.col(value).cast("double"), probs, 100000)
                                .cast("array<double>").alias("quantiles"))
    out = null_safe_join(base, qs, [by], "left")
    return out.select(base.columns[:-1] + [
        F.col("quantiles")[0].alias(f"{p}25%"), F.col("quantiles")[1].alias(f"{p}50%"),
        F.col("quantiles")[2].alias(f"{p}75%"), f"{p}max"])


def iv_review(base: DataFrame, label_col: str, verbose: DataFrame,
              min_rows: int = SIGNIFICANT_LABEL_ROWS, materialize: bool = True) -> dict:
    """Review of bin-level IV (``base`` and ``label_col`` name the source; the
    label counts come from the bin table itself).

    ``adjusted``: bin rows with IV 0 for labels with < min_rows rows;
    ``describe``: IV described per var over all labels;
    ``describe_significant``: the same without the non-significant labels;
    ``high_bins``: bins with IV > 24; ``max_bins``: bins with the largest IV;
    ``useful``: vars whose significant-label max IV > 0.02.
    """
    if materialize:
        # read by five outputs below: computed once
        verbose = cut_lineage(verbose)
    # rows per label are the label totals already in the bin table: no scan
    counts = (verbose.groupBy("label").agg(F.max("total_pos").alias("count"))
                     .withColumn("is_significant", F.col("count") >= min_rows))
    flagged = verbose.join(counts.select("label", "is_significant"), "label", "left")
    sig = F.coalesce(F.col("is_significant"), F.lit(False))
    adjusted = flagged.withColumn("iv", F.when(sig, F.col("iv")).otherwise(F.lit(0.0))).drop("is_significant")
    describe = describe_by(verbose, "var", "iv", prefix="iv_", count_name="iv_count")
    describe_sig = describe_by(flagged.where(sig), "var", "iv", prefix="iv_", count_name="iv_count")
    top = verbose.select(F.max("iv")).scalar()
    return {
        "label_counts": counts,
        "adjusted": adjusted,
        "describe": describe,
        "describe_significant": describe_sig,
        "high_bins": verbose.where(F.col("iv") > HIGH_BIN_IV),
        "max_bins": verbose.where(F.col("iv") == top),
        "useful": describe_sig.where(F.col("iv_max") > USEFUL_IV),
    }
