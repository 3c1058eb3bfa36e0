"""Text expressions: remarks, IV bands, value ranges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from featurelens.functions.constants import IV_BAND_BELOW, IV_BANDS


def remarks(*flags) -> Column:
    """Join the texts of the true flags with ", " (no leading comma).

    ``flags`` are (condition Column, text) pairs; NULL conditions count as false.
    """
    parts = [F.when(cond, F.lit(text)) for cond, text in flags]
    return F.concat_ws(", ", *parts)


def iv_strength(iv) -> Column:
    """Band of an information value (lower edge inclusive)."""
    c = F.col(iv) if isinstance(iv, str) else iv
    expr = None
    for lo, name in IV_BANDS:
        expr = F.when(c >= lo, F.lit(name)) if expr is None else expr.when(c >= lo, F.lit(name))
    return expr.when(c.isNotNull(), F.lit(IV_BAND_BELOW))


def value_range(lo, hi, kind: str) -> Column:
    """``min -> max: (a, b)``; numbers with 3 decimals, integers exactly."""
    if kind == "integer":
        lo, hi = (F.concat(x.cast("string"), F.lit(".000")) for x in (lo, hi))
    elif kind == "number":
        # + 0.0 turns -0.0 into 0.0 (engines differ on min(-0.0, 0.0))
        return F.format_string("min -> max: (%.3f, %.3f)", lo + F.lit(0.0), hi + F.lit(0.0))
    return F.concat(F.lit("min -> max: ("), lo.cast("string"), F.lit(", "), hi.cast("string"), F.lit(")"))
