"""Deterministic hashing of keys: repeatable samples and splits without shuffles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _key_text(seed, cols) -> Column:
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.concat_ws("|", *parts)


def hash_order_key(seed, *cols) -> Column:
    """md5 text of ``seed|k1|k2..``; ordering by it is a seeded shuffle."""
    return F.md5(_key_text(seed, cols))


def hash_bucket(seed, *cols, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from the first 32 bits of md5(``seed|key``).

    A pure function of the key: the same customer always lands in the same
    bucket, on every executor, in every run.
    """
    h = F.conv(F.substring(hash_order_key(seed, *cols), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("int")
