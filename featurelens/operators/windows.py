"""Range windows over days, pre-aggregated to one row per (user, day).

Rows are first reduced to counts per (user, day, intent) with partial
aggregation. A day's count enters every later (or earlier) day's range at one day
and leaves it at another; the running sum of these changes per (user, intent) is
constant between them, and active days are joined to the pieces by user and a
bucket of days. No row holds the labels of many days, and a hot user's days
spread over buckets. The pivot over a given list of intents sums counts over
a range frame per user instead. The forward fill is a prefix scan over range
partitions: inside each, then across their last values.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from featurelens.functions.calendar import epoch_day
from featurelens.functions.constants import (
    HISTORY_DAYS, LOOKAHEAD_DAYS, LOOKAHEAD_GAP_DAYS, NO_HISTORY,
)
from featurelens.session import cut_lineage

_DAY = "_fl_day"
BUCKET_DAYS = 8


def _per_day(df: DataFrame, user: str, date_col: str, *aggs: Column) -> DataFrame:
    return (df.groupBy(F.col(user), F.to_date(F.col(date_col)).alias("date"))
              .agg(*aggs).withColumn(_DAY, epoch_day("date")))


def _day_counts(df: DataFrame, user: str, date_col: str, intent: str) -> DataFrame:
    """(user, date, intent, n): rows per user, day and intent (NULL is one)."""
    return (df.groupBy(F.col(user), F.to_date(F.col(date_col)).alias("date"), F.col(intent).cast("string").alias("intent"))
              .agg(F.count(F.lit(1)).alias("n")))


def _in_range(counts: DataFrame, user: str, days: tuple) -> tuple[DataFrame, DataFrame]:
    """Active days (user, date), and the intents in each one's range of days:
    (user, date, intent, n), only where there are any. Rows without a date are
    in no range; NULL is a user like others."""
    lo, hi = days
    day = epoch_day("date")
    active = counts.select(user, "date").distinct()
    # what happens on day d is in range from day d - hi to day d - lo
    turns = (counts.where("intent is not null and date is not null")
             .select(user, "intent", F.inline(F.array(
                 F.struct((day - hi).alias("at"), F.col("n").alias("change")),
                 F.struct((day - lo + 1).alias("at"), (-F.col("n")).alias("change"))))))
    turns = turns.groupBy(user, "intent", "at").agg(F.sum("change").alias("change"))
    w = Window.partitionBy(user, "intent").orderBy("at")
    pieces = (turns.select(user, "intent", "at", F.lead("at").over(w).alias("until"),
                           F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("n"))
              .where("n > 0"))

    def bucket(c):
        return F.floor(c / F.lit(BUCKET_DAYS)).cast("int")

    spread = pieces.select(F.col(user).alias("_fl_user"), "intent", "n", "at", "until",
                           F.explode(F.sequence(bucket(F.col("at")), bucket(F.col("until") - 1))).alias("_fl_b"))
    placed = active.withColumn(_DAY, day).withColumn("_fl_bucket", bucket(F.col(_DAY)))
    met = placed.join(spread, placed[user].eqNullSafe(spread["_fl_user"]) & (F.col("_fl_bucket") == F.col("_fl_b"))
                      & (F.col(_DAY) >= F.col("at")) & (F.col(_DAY) < F.col("until")))
    return active, met.select(user, "date", "intent", "n")


def _per_active(active: DataFrame, found: DataFrame, user: str) -> DataFrame:
    """``active`` with what was found for each of its rows, if anything."""
    right = found.withColumnRenamed(user, "_fl_user").withColumnRenamed("date", "_fl_date")
    return active.join(right, active[user].eqNullSafe(right["_fl_user"]) & active["date"].eqNullSafe(right["_fl_date"]), "left").drop("_fl_user", "_fl_date")


def lookahead_labels(df: DataFrame, user: str, date_col: str, intent: str,
                     days: tuple = LOOKAHEAD_DAYS, out: str = "next_7_day_labels") -> DataFrame:
    """Per (user, date): sorted set of intents from day+lo to day+hi (inclusive).
    A day costs its distinct labels, however often they are repeated."""
    active, found = _in_range(_day_counts(df, user, date_col, intent), user, days)
    sets = found.groupBy(user, "date").agg(F.array_sort(F.collect_list("intent")).alias(out))
    return _per_active(active, sets, user).withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def lookahead_labels_gap(df: DataFrame, user: str, date_col: str, intent: str,
                         days: tuple = LOOKAHEAD_GAP_DAYS,
                         out: str = "next_7_day_labels_with_gap") -> DataFrame:
    return lookahead_labels(df, user, date_col, intent, days, out)


def explode_labels(labels: DataFrame, labels_col: str = "next_7_day_labels",
                   out: str = "label") -> DataFrame:
    """One row per (user, date, label set, label).

    Rows are already one per (user, date) and sets hold no repeats, so the
    result is distinct without another shuffle.
    """
    keep = [c for c in labels.columns]
    return labels.select(*keep, F.explode(labels_col).alias(out))


def history_rows(df: DataFrame, user: str, date_col: str, intent: str, days: tuple = HISTORY_DAYS,
                 out: str = "cb_past_intent") -> DataFrame:
    """One row per (user, date, past intent) with its count ``n_past`` over the
    earlier days in range; an empty history gives one row with NULL intent and
    count 0. No list is made on the way."""
    active, found = _in_range(_day_counts(df, user, date_col, intent), user, days)
    x = _per_active(active, found, user)
    return x.select(user, "date", F.col("intent").alias(out), F.coalesce("n", F.lit(0)).cast("long").alias("n_past"))


def history_list(df: DataFrame, user: str, date_col: str, intent: str,
                 days: tuple = HISTORY_DAYS, out: str = "historical_interactions", repeats: bool = False) -> DataFrame:
    """Per (user, date): the intents of the earlier days in range as a
    multiset, array of (intent, n) sorted by intent; with ``repeats`` the sorted
    list itself, each intent as often as it occurred (its length grows with a
    user's events)."""
    active, found = _in_range(_day_counts(df, user, date_col, intent), user, days)
    items = found.groupBy(user, "date").agg(F.array_sort(F.collect_list(F.struct("intent", "n"))).alias(out))
    x = _per_active(active, items, user)
    if repeats:
        return x.withColumn(out, F.coalesce(F.flatten(F.transform(out, lambda i: F.array_repeat(i["intent"], i["n"].cast("int")))),
                                            F.array().cast("array<string>")))
    return x.withColumn(out, F.coalesce(out, F.array().cast("array<struct<intent:string,n:bigint>>")))


def explode_history(hist: DataFrame, list_col: str = "historical_interactions",
                    out: str = "cb_past_intent") -> DataFrame:
    """The rows of :func:`history_rows` from the lists of :func:`history_list`."""
    keep = [c for c in hist.columns if c != list_col]
    x = hist.select(*keep, F.explode_outer(list_col).alias("_fl_h"))
    return x.select(*keep, F.col("_fl_h.intent").alias(out),
                    F.coalesce(F.col("_fl_h.n"), F.lit(0)).cast("long").alias("n_past"))


def history_pivot(df: DataFrame, user: str, date_col: str, intent: str, values: Sequence[str] | None = None,
                  days: tuple = HISTORY_DAYS, per_day: bool = False,
                  no_history: str = NO_HISTORY) -> DataFrame:
    """Per (user, date): count of each listed intent in the earlier days of
    the range, and column ``null`` for an empty history.

    Default counts equal a pivot over the exploded event rows: a day with r
    events multiplies its counts by r. ``per_day=True`` counts once per day.
    Without ``values`` the counts are one column ``counts``, a map from intent to
    count with any number of intents. A listed intent with the name of the
    ``no_history`` column is refused.
    """
    if values is None:
        counts = _day_counts(df, user, date_col, intent)
        active, found = _in_range(counts, user, days)
        rows = counts.groupBy(user, "date").agg(F.sum("n").alias("_r"))
        items = found.groupBy(user, "date").agg(F.array_sort(F.collect_list(F.struct("intent", "n"))).alias("_items"))
        mult = F.lit(1) if per_day else F.col("_r")
        return _per_active(rows, items, user).select(
            user, "date",
            F.coalesce(F.map_from_entries(F.transform("_items", lambda i: F.struct(i["intent"], (i["n"] * mult).cast("long")))),
                       F.create_map().cast("map<string,bigint>")).alias("counts"),
            F.when(F.col("_items").isNull(), mult).otherwise(F.lit(0)).cast("long").alias(no_history))
    if no_history in values:
        raise ValueError(f"an intent is named {no_history!r}: give another no_history name")
    lo, hi = days
    lab = F.col(intent)
    aggs = [F.count(F.lit(1)).alias("_r"), F.count(lab).alias("_n")] + [
        F.count(F.when(lab == F.lit(v), 1)).alias(f"_n{i}") for i, v in enumerate(values)]
    day = _per_day(df, user, date_col, *aggs)
    w = Window.partitionBy(user).orderBy(_DAY).rangeBetween(lo, hi)
    mult = F.lit(1) if per_day else F.col("_r")
    hist_n = F.coalesce(F.sum("_n").over(w), F.lit(0))
    cols = [(F.coalesce(F.sum(f"_n{i}").over(w), F.lit(0)) * mult).cast("long").alias(v)
            for i, v in enumerate(values)]
    empty = F.when(hist_n == 0, mult).otherwise(F.lit(0)).cast("long").alias(no_history)
    return day.select(user, "date", *cols, empty)


def forward_fill(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                 num_partitions: int | None = None) -> DataFrame:
    """Replace NULLs by the last non-null value so far per ``key``.

    Rows are range-partitioned by (key, order), so a key with many rows spreads
    over many tasks. Each range is filled by itself; the last values of every
    (key, range) are carried to the key's later ranges. A NULL key is a key of
    its own, a NULL order value comes first. ``order`` must make rows unique
    within a key.
    """
    cols = list(cols)
    if not cols:
        return df
    pid, nk = "_fl_pid", "_fl_nokey"
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order_exprs = [F.col(o) for o in order]
    # one cut of the ranges for all uses below (see ranking.running_total)
    x = cut_lineage(df.repartitionByRange(n, F.col(key), *order_exprs)
                      .withColumn(pid, F.spark_partition_id()).withColumn(nk, F.col(key).isNull()))
    w_in = Window.partitionBy(pid, key).orderBy(*order_exprs).rowsBetween(Window.unboundedPreceding, 0)
    filled = x.select(*[F.last(c, ignorenulls=True).over(w_in).alias(c) if c in cols else F.col(c) for c in x.columns])
    ordkey = F.struct(*order_exprs)
    # one row per key and range that holds it
    last = x.groupBy(pid, nk, key).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordkey)).alias(f"_last{i}") for i, c in enumerate(cols)])
    w_prev = Window.partitionBy(key).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(pid, nk, F.col(key).alias("_fl_key"), *[
        F.last(f"_last{i}", ignorenulls=True).over(w_prev).alias(f"_carry{i}") for i in range(len(cols))])
    joined = filled.join(carry, (filled[pid] == carry[pid]) & (filled[nk] == carry[nk])
                         & filled[key].eqNullSafe(carry["_fl_key"]), "left")
    return joined.select(*[F.coalesce(filled[c], F.col(f"_carry{cols.index(c)}")).alias(c) if c in cols
                           else filled[c] for c in df.columns])
