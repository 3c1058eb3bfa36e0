"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from featurelens.functions.calendar import epoch_day, to_day
from featurelens.functions.hashing import hash_bucket, hash_order_key
from featurelens.functions.text import iv_strength, remarks, value_range

__all__ = ["epoch_day", "to_day", "hash_bucket", "hash_order_key",
           "iv_strength", "remarks", "value_range"]
