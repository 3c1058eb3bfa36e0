"""Repeatable samples and leakage-free splits.

Every random choice is a hash of (seed, key): the same row or customer
gets the same draw on every executor and in every run, and a split needs
no join or shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from featurelens.functions.constants import (
    ROWS_PER_LABEL, SAMPLE_ROWS, SAMPLE_SEED, SPLIT_SEED, TEST_PERCENT,
)
from featurelens.functions.calendar import day_range
from featurelens.functions.hashing import hash_bucket, hash_order_key
from featurelens.operators.joins import labels_not_in
from featurelens.operators.ranking import ordered_index
from featurelens.session import cut_lineage


def _keys(df: DataFrame, key_cols) -> list[str]:
    if key_cols is None:
        return list(df.columns)
    return [key_cols] if isinstance(key_cols, str) else list(key_cols)


def sample_n(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED,
             key_cols: Sequence[str] | str | None = None, margin: float = 1.2) -> DataFrame:
    """Exactly min(n, rows) rows: those with the n smallest hashes of (seed, key).

    A plain ``orderBy(hash).limit(n)`` sends n rows from every partition to
    one task. Here the rows whose 32-bit hash prefix lies under a threshold
    (expected n * margin rows, raised until at least n pass) are kept by a
    distributed filter, and only those are ordered. The n smallest hashes
    always lie under a threshold that passes n rows, so the result is the
    same set.
    """
    keys = _keys(df, key_cols)
    h = hash_order_key(seed, *keys)
    total = df.count()
    if total <= n:
        return df
    prefix = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    space = float(1 << 32)
    t = int(min(space, space * (n * margin + 16) / total)) + 1
    while True:
        cand = df.where(prefix < F.lit(t))
        if t >= space or cand.count() >= n:
            break
        t = int(min(space, t * 2))
    return cand.orderBy(h, *keys).limit(n)


def stratified_sample(df: DataFrame, label: str, n: int = ROWS_PER_LABEL, seed: int = SAMPLE_SEED,
                      key_cols: Sequence[str] | str | None = None) -> DataFrame:
    """min(n, size) rows per label: those with the n smallest hashes.

    Hashes are counted per (label, 16-bit prefix); a label's cut is the first
    prefix by which n rows are reached. Rows beyond their label's cut leave in
    a join, so the final ranking of a label gets about n rows, however many the
    label has. NULL is a label of its own.
    """
    keys = _keys(df, key_cols)
    h = hash_order_key(seed, *keys)
    prefix = F.conv(F.substring(h, 1, 4), 16, 10).cast("long")
    seen = df.groupBy(F.col(label).alias("_fl_label"), prefix.alias("_fl_p")).agg(F.count(F.lit(1)).alias("_fl_n"))
    # a label has at most 65536 prefixes
    before = Window.partitionBy("_fl_label").orderBy("_fl_p").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (seen.withColumn("_fl_before", F.coalesce(F.sum("_fl_n").over(before), F.lit(0))).where(F.col("_fl_before") < n)
                .groupBy("_fl_label").agg(F.max("_fl_p").alias("_fl_cut")))
    cand = df.join(cuts, df[label].eqNullSafe(cuts["_fl_label"])).where(prefix <= F.col("_fl_cut")).drop("_fl_label", "_fl_cut")
    w = Window.partitionBy(label).orderBy(h, *keys)
    return cand.withColumn("_fl_rn", F.row_number().over(w)).where(F.col("_fl_rn") <= n).drop("_fl_rn")


def split_by_customer(df: DataFrame, cust_key: str, test_percent: int = TEST_PERCENT,
                      seed: int = SPLIT_SEED, out: str = "split") -> DataFrame:
    """``train``/``test`` per customer: test iff hash bucket < test_percent."""
    b = hash_bucket(seed, cust_key)
    return df.withColumn(out, F.when(b < test_percent, F.lit("test")).otherwise(F.lit("train")))


def split_by_customer_exact(df: DataFrame, cust_key: str, test_percent: float = TEST_PERCENT,
                            seed: int = SPLIT_SEED, out: str = "split") -> DataFrame:
    """``train``/``test`` per customer with exactly round(test_percent %) of the
    distinct customers in test (halves up): those of the smallest hashes.

    The cut is an order statistic: customers are counted by a 16-bit prefix of
    their hash (65,536 counts), and only those of the prefix that holds the
    cut are ordered. The split itself is a filter by the cut. Rows without a
    customer are train.
    """
    h = hash_order_key(seed, cust_key)
    prefix = F.conv(F.substring(h, 1, 4), 16, 10).cast("int")
    people = df.where(F.col(cust_key).isNotNull()).select(cust_key).distinct()
    seen = people.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    total = seen.agg(F.sum("n").alias("n")).first()["n"] or 0
    want = int(total * test_percent / 100 + 0.5)
    if not want:
        return df.withColumn(out, F.lit("train"))
    upto = seen.withColumn("c", F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)))
    at = upto.where(F.col("c") >= want).orderBy("p").select("p", (F.col("c") - F.col("n")).alias("before")).first()
    last = (people.where(prefix == at["p"]).select(h.alias("h")).orderBy("h").limit(want - at["before"]).agg(F.max("h").alias("h")).first()["h"])
    return df.withColumn(out, F.when(F.col(cust_key).isNotNull() & (h <= last), F.lit("test")).otherwise(F.lit("train")))


def split_in_time(df: DataFrame, date_col: str, cust_key: str,
                  train_start="2022-08-10", train_end="2023-03-10",
                  oos_start="2023-03-10", oos_end="2024-05-10",
                  test_percent: int = TEST_PERCENT, seed: int = 99, out: str = "split") -> DataFrame:
    """train/test by customer inside [train_start, train_end); ``oos`` inside
    [oos_start, oos_end]; other rows dropped."""
    in_tt = day_range(date_col, train_start, train_end, end_inclusive=False)
    in_oos = day_range(date_col, oos_start, oos_end)
    b = hash_bucket(seed, cust_key)
    split = (F.when(in_tt & (b < test_percent), F.lit("test"))
              .when(in_tt, F.lit("train"))
              .when(in_oos, F.lit("oos")))
    # the union of both ranges is stated on the raw column for the scan
    return df.where(in_tt | in_oos).withColumn(out, split)


def split_counts(df: DataFrame, cust_key: str, split_col: str = "split") -> DataFrame:
    """Rows and distinct customers: original, train, test (one rollup)."""
    g = df.rollup(split_col).agg(F.count(F.lit(1)).alias("counts"),
                                 F.count_distinct(cust_key).alias(f"unique_{cust_key}"),
                                 F.grouping_id().alias("_g"))
    return g.select(F.when(F.col("_g") == 1, F.lit("original")).otherwise(F.col(split_col)).alias("dataset"),
                    F.col("counts").cast("long").alias("counts"),
                    F.col(f"unique_{cust_key}").cast("long").alias(f"unique_{cust_key}"))


def label_distribution(df: DataFrame, label: str, split_col: str = "split",
                       label_desc: str | None = None) -> DataFrame:
    """count and share per label overall, in train and in test, by falling
    count. Rows with a NULL label are left out."""
    keys = [label] + ([label_desc] if label_desc else [])
    g = df.where(F.col(label).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        F.count(F.when(F.col(split_col) == "train", 1)).alias("count_train"),
        F.count(F.when(F.col(split_col) == "test", 1)).alias("count_test"))
    counts = ("count", "count_train", "count_test")
    total = g.select(F.struct(*[F.sum(c).alias(c) for c in counts])).scalar()
    out = g
    for c in counts:
        out = out.withColumn(c.replace("count", "percentage"), F.try_divide(F.col(c), total.getField(c)))
    cols = [label] + ([F.col(label_desc).alias(f"{label}_desc")] if label_desc else []) + [
        "count", "percentage", "count_train", "percentage_train", "count_test", "percentage_test"]
    return out.select(*cols).orderBy(F.col("count").desc(), label)


def cover_labels(df: DataFrame, label: str, split_col: str, order_cols: Sequence[str]):
    """Make train and test hold every label by overwriting the labels of the
    last rows (by ``order_cols`` desc) of the side that misses them.

    The i-th missing label (label order) replaces the label of the i-th row
    from the end. Returns (frame, missing_in_train, missing_in_test).
    This changes labels: use only when a model needs all classes on both sides.
    """
    # one scan: a row per label and side
    seen = cut_lineage(df.where(F.col(split_col).isin("train", "test")).select(label, split_col).distinct())
    train = seen.where(F.col(split_col) == "train")
    test = seen.where(F.col(split_col) == "test")
    miss_train = labels_not_in(test, train, label)
    miss_test = labels_not_in(train, test, label)
    out = df
    for side, miss in (("train", miss_train), ("test", miss_test)):
        if not miss.head(1):
            continue
        # positions instead of keys: rows that share their order columns, or
        # hold NULL there, are told apart
        nth = ordered_index(miss, ["label"], out="_fl_i").select("_fl_i", F.col("label").alias("_fl_new"))
        last = ordered_index(out.where(F.col(split_col) == side), [F.col(c).desc() for c in order_cols], out="_fl_i")
        new = last.join(nth, "_fl_i", "left").withColumn(label, F.coalesce("_fl_new", label)).select(*df.columns)
        out = out.where(~F.col(split_col).eqNullSafe(side)).unionByName(new)
    return out, miss_train, miss_test
