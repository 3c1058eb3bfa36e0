"""Label x period cross-tabs, column shares and population stability index.

Tables are long: (label, period, period_idx, n[, ratio, psi]) with every label
in every period; cells without rows have n 0. Totals carry the text ``All``
and are told from data by the flags ``all_labels`` and ``all_periods``, so a
label or period of that name is data like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from featurelens.functions.constants import EPS_PSI
from featurelens.session import cut_lineage

ALL = "All"
ALL_LABELS = "all_unique_labels"


def crosstab_margins(df: DataFrame, label: str, period: str, key: str | None,
                     period_idx: str | None = None, weight: str | None = None) -> DataFrame:
    """Count of non-null ``key`` per (label, period), zero cells included,
    with ``All`` margins: (label, period, period_idx, n, all_labels,
    all_periods).

    ``weight`` sums a pre-aggregated count column instead of counting keys.
    Rows are counted once per (label, period) with map-side combine; the
    grid and its margins come from that table.
    """
    # without an index, periods are ordered by their text (ISO dates sort)
    idx = F.col(period_idx) if period_idx else F.lit(None)
    measure = F.sum(weight) if weight else F.count(key)
    cells = (df.where(F.col(label).isNotNull() & F.col(period).isNotNull())
               .groupBy(F.col(label).cast("string").alias("label"),
                        F.struct(idx.cast("long").alias("i"), F.col(period).cast("string").alias("p")).alias("_p"))
               .agg(F.coalesce(measure, F.lit(0)).cast("long").alias("n")))
    cells = cut_lineage(cells)
    # each label's missing periods: all periods as one array, exploded per label
    periods = cells.select(F.sort_array(F.collect_set("_p"))).scalar()
    zeros = cells.select("label").distinct().select("label", F.explode(periods).alias("_p"), F.lit(0).cast("long").alias("n"))
    g = (cells.unionByName(zeros).cube("label", "_p")
              .agg(F.sum("n").alias("n"), F.grouping("label").alias("_gl"), F.grouping("_p").alias("_gp")))
    return g.where(F.col("n").isNotNull()).select(
        F.when(F.col("_gl") == 1, F.lit(ALL)).otherwise(F.col("label")).alias("label"),
        F.when(F.col("_gp") == 1, F.lit(ALL)).otherwise(F.col("_p.p")).alias("period"),
        F.col("_p.i").alias("period_idx"), "n",
        (F.col("_gl") == 1).alias("all_labels"), (F.col("_gp") == 1).alias("all_periods"))


def crosstab_ratio(ct: DataFrame) -> DataFrame:
    """Each cell divided by its period (column) total."""
    totals = (ct.where("all_labels").select(F.col("period").alias("_tp"), F.col("period_idx").alias("_ti"),
                                            F.col("all_periods").alias("_ta"), F.col("n").alias("_tn")))
    on = ((ct["period"] == totals["_tp"]) & ct["period_idx"].eqNullSafe(totals["_ti"])
          & (ct["all_periods"] == totals["_ta"]))
    return ct.join(totals, on).withColumn("ratio", F.try_divide(F.col("n"), F.col("_tn"))).drop("_tp", "_ti", "_ta", "_tn")


def psi(ratio: DataFrame, eps: float = EPS_PSI, decimals: int = 4) -> DataFrame:
    """PSI per label and period against the period before; first period NULL.
    Adds row ``all_unique_labels`` = unrounded sum."""
    cells = ratio.where("not all_labels and not all_periods").select("label", "period", "period_idx", "ratio")
    w = Window.partitionBy("label").orderBy("period_idx", "period")  # one label: its periods
    cur, prev = F.coalesce(F.col("ratio"), F.lit(0.0)), F.coalesce(F.col("_prev"), F.lit(0.0))
    raw = F.when(F.col("_k") > 1, (cur - prev) * F.log((cur + F.lit(eps)) / (prev + F.lit(eps))))
    per_label = (cells.withColumn("_prev", F.lag("ratio").over(w)).withColumn("_k", F.row_number().over(w))
                      .select("label", "period", "period_idx", raw.alias("psi_raw"), F.lit(False).alias("all_labels")))
    total = (per_label.groupBy("period", "period_idx").agg(F.sum("psi_raw").alias("psi_raw"))
                      .select(F.lit(ALL_LABELS).alias("label"), "period", "period_idx", "psi_raw", F.lit(True).alias("all_labels")))
    both = per_label.unionByName(total)
    return both.withColumn("psi", F.when(F.col("all_labels"), F.col("psi_raw")).otherwise(F.round("psi_raw", decimals)))


GRAINS = {"dly": ("_day", "_day_idx"), "wly": ("week", "week_idx"), "mly": ("month", "month_idx")}


def label_report(df: DataFrame, cust_key: str, label: str, date_col: str) -> dict:
    """Nine tables: total / ratio / psi by day, week and month.

    The table is read once, into counts per (label, day), a checkpointed table
    of labels x days. Days come from all of it; weeks and months from its days
    inside complete periods.
    """
    from featurelens.functions.calendar import epoch_day
    from featurelens.operators.calendar import period_columns
    days = cut_lineage(df.groupBy(F.col(label), F.to_date(F.col(date_col)).alias("_date")).agg(F.count(cust_key).alias("_n"))
                       .withColumn("_day", F.col("_date").cast("string")).withColumn("_day_idx", epoch_day("_date")))
    periods = period_columns(days, "_date")
    out = {}
    for g, (per, i) in GRAINS.items():
        ct = crosstab_margins(days if g == "dly" else periods, label, per, None, i, weight="_n")
        r = crosstab_ratio(ct)
        out[f"total_{g}"] = ct
        out[f"ratio_{g}"] = r
        out[f"psi_{g}"] = psi(r)
    return out
