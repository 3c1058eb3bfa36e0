"""Global order statistics without single-task windows.

``Window.orderBy(..)`` with no partition, or ``partitionBy(column_name)``
over the distinct values of a wide key, sends a whole ordered set through
one task. These helpers range-partition the rows first, work inside each
range partition, and add per-partition offsets from a table whose size is
bounded by the number of partitions plus the number of groups (usually
column names; AQE decides whether to broadcast it). Ties on the order keys
stay in one partition.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from featurelens.session import cut_lineage

_PID, _LOCAL, _PTOT, _OFF = "_fl_pid", "_fl_local", "_fl_ptotal", "_fl_offset"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL is a key like others; the left side's
    key columns stay."""
    mine = {k: f"_fl_right_{i}" for i, k in enumerate(keys)}
    r = right.withColumnsRenamed(mine)
    on = [left[k].eqNullSafe(r[m]) for k, m in mine.items()]
    return left.join(r, on, how).drop(*mine.values())


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: Sequence, partition_by: Iterable[str] = (),
                  weight: str | None = None, out: str = "running_total",
                  num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` (1 per row if None) in ``order``.

    ``partition_by`` restarts the sum per group; groups are expected to be
    few (column names, labels), but a group may hold any number of rows:
    its rows are spread over range partitions.
    """
    part = list(partition_by)
    order_exprs = [_col(o) for o in order]
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    n = _num_partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *[F.col(p) for p in part], *order_exprs)
                .withColumn(_PID, F.spark_partition_id()))
    # Range bounds come from a sample whose rows depend on shuffle-read
    # order, so two evaluations may cut the ranges differently. A reliable
    # checkpoint fixes one partitioning for both branches below (and for
    # recomputation after an executor loss).
    ranged = cut_lineage(ranged)
    within = (Window.partitionBy(_PID, *part).orderBy(*order_exprs)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn(_LOCAL, F.sum(w).over(within))
    totals = ranged.groupBy(_PID, *part).agg(F.sum(w).alias(_PTOT))
    before = (Window.partitionBy(*part).orderBy(_PID)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(_PID, *part,
                            F.coalesce(F.sum(_PTOT).over(before), F.lit(0)).alias(_OFF))
    # offsets: at most num_partitions + groups rows. Groups are usually column
    # names, but may be many (a median per customer): no hint, AQE broadcasts
    # it when its measured size is small
    return (null_safe_join(local, offsets, [_PID, *part])
                 .withColumn(out, F.col(_LOCAL) + F.col(_OFF))
                 .drop(_PID, _LOCAL, _OFF))


def ordered_index(df: DataFrame, order: Sequence, partition_by: Iterable[str] = (),
                  out: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (within ``partition_by``)."""
    r = running_total(df, order, partition_by, None, "_fl_rt", num_partitions)
    return r.withColumn(out, F.col("_fl_rt") - 1).drop("_fl_rt")


def exact_quantiles(long_df: DataFrame, group_col: str, value_col: str,
                    probs: Sequence[float], out: str = "quantiles",
                    num_partitions: int | None = None, method: str = "ranked") -> DataFrame:
    """Exact linear-interpolated quantiles of ``value_col`` per ``group_col``.

    Same definition as ``percentile`` / ``quantile_cont`` / NumPy's linear
    method. ``ranked``: distinct values with their counts are ranked by
    :func:`running_total` and only the rows that hold a wanted rank are kept,
    so no task holds a whole group. ``inline``: Spark's ``percentile``, for
    callers who know that a group's distinct values fit one buffer.
    NULL is a group like others. Returns (group_col, out array<double> in
    ``probs`` order, n).
    """
    g, v = group_col, value_col
    if method == "inline":
        return (long_df.where(F.col(v).isNotNull()).groupBy(g)
                       .agg(F.percentile(F.col(v), [float(p) for p in probs]).alias(out), F.count(F.col(v)).alias("n")))
    vals = (long_df.where(F.col(v).isNotNull())
                   .groupBy(g, v).agg(F.count(F.lit(1)).alias("_fl_c")))
    ranked = running_total(vals, [v], [g], "_fl_c", "_fl_cum", num_partitions)
    # from the checkpointed ranking: the values are not aggregated again
    sizes = ranked.groupBy(g).agg(F.max("_fl_cum").alias("_fl_n"))
    # wanted 0-based ranks per group: one row per group (column names)
    targets = []
    for i, p in enumerate(probs):
        pos = (F.col("_fl_n") - 1) * F.lit(float(p))
        targets += [F.floor(pos).cast("long").alias(f"_fl_lo{i}"), F.ceil(pos).cast("long").alias(f"_fl_hi{i}"),
                    (pos - F.floor(pos)).alias(f"_fl_d{i}")]
    sizes = sizes.select(g, "_fl_n", *targets)
    # values ascend with the running count, so the value at 0-based rank r
    # is the smallest value whose running count exceeds r
    aggs = []
    for i in range(len(probs)):
        aggs.append(F.min(F.when(F.col("_fl_cum") > F.col(f"_fl_lo{i}"), F.col(v))).alias(f"_fl_lo{i}v"))
        aggs.append(F.min(F.when(F.col("_fl_cum") > F.col(f"_fl_hi{i}"), F.col(v))).alias(f"_fl_hi{i}v"))
    # sizes: one row per group (no hint: groups may be many, see above)
    picked = null_safe_join(ranked, sizes, [g]).groupBy(g).agg(*aggs)
    res = null_safe_join(picked, sizes, [g])
    qs = [F.col(f"_fl_lo{i}v") + F.col(f"_fl_d{i}") * (F.col(f"_fl_hi{i}v") - F.col(f"_fl_lo{i}v"))
          for i in range(len(probs))]
    res = res.withColumnRenamed("_fl_n", "n")
    return res.select(g, F.array(*qs).alias(out), "n")
