"""Grouped aggregates, frequency tables and key counts."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from featurelens.operators.ranking import exact_quantiles, null_safe_join, running_total

_FUNCS = {"min": F.min, "mean": F.avg, "max": F.max, "std": F.stddev_samp, "sum": F.sum}


def agg_numeric(df: DataFrame, key, cols: Sequence[str],
                funcs: Sequence[str] = ("min", "mean", "max", "std", "sum")) -> DataFrame:
    """Per key (NULL is one), each column: ``<col>_<fn>`` for fn in funcs.

    ``median`` is exact (linear interpolation) and computed by ranking
    distinct values over range partitions, so one hot key never holds all
    its values in one aggregation buffer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    plain = [f for f in funcs if f != "median"]
    aggs = [_FUNCS[f](F.col(c)).alias(f"{c}_{f}") for c in cols for f in plain]
    out = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    if "median" not in funcs:
        return out
    g = F.struct(*[F.col(k) for k in keys]).alias("_fl_g")
    long = df.select(g, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ["_fl_g"], list(cols), "_fl_var", "_fl_x")
    long = long.select(F.struct("_fl_g", "_fl_var").alias("_fl_gv"), "_fl_x")
    med = exact_quantiles(long, "_fl_gv", "_fl_x", [0.5], out="_fl_q")
    med = med.select(*[F.col(f"_fl_gv._fl_g.{k}").alias(k) for k in keys],
                     F.col("_fl_gv._fl_var").alias("_fl_var"), F.col("_fl_q")[0].alias("_fl_med"))
    wide = med.groupBy(*keys).pivot("_fl_var", list(cols)).agg(F.first("_fl_med"))
    wide = wide.select(*keys, *[F.col(c).alias(f"{c}_median") for c in cols])
    return null_safe_join(out, wide, keys, "left")


def freq_table(df: DataFrame, col: str) -> DataFrame:
    """(value, count, percentage) of the values that are not NULL."""
    total = df.select(F.count(col)).scalar()
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
              .withColumn("percentage", F.try_divide(F.col("count"), total)))


def cumulative_share(freq: DataFrame, value_col: str, count_col: str = "count",
                     num_partitions: int | None = None) -> DataFrame:
    """``perc`` and running ``cum_perc`` in order count desc, value asc.

    The running sum is computed over range partitions (no single-task window).
    """
    total = freq.select(F.sum(count_col)).scalar()
    order = [F.col(count_col).desc(), F.col(value_col).asc_nulls_last()]
    r = running_total(freq, order, (), count_col, "_fl_cum", num_partitions)
    return (r.withColumn("perc", F.try_divide(F.col(count_col), total))
             .withColumn("cum_perc", F.try_divide(F.col("_fl_cum"), total)).drop("_fl_cum"))


def with_key_counts(df: DataFrame, pkey: str) -> DataFrame:
    """Add ``distinct_cnt_<pkey>`` (NULL counted as a value) and ``records``."""
    b = df.select(F.struct(
        (F.count_distinct(pkey) + F.max(F.col(pkey).isNull().cast("int"))).alias("d"),
        F.count(F.lit(1)).alias("n"))).scalar()
    return (df.withColumn(f"distinct_cnt_{pkey}", b.getField("d").cast("long"))
              .withColumn("records", b.getField("n")))


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    """min and max of a column as text, one pass."""
    return df.agg(F.min(col).cast("string").alias(f"min_{col}"),
                  F.max(col).cast("string").alias(f"max_{col}"))
