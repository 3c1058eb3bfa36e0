"""Apply saved label and category maps to a streaming DataFrame."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from featurelens.operators.encoding import apply_category_map, apply_label_map


def score_stream(stream: DataFrame, maps: DataFrame, categorical: Sequence[str],
                 label: str | None = None, artefact: str = "training") -> DataFrame:
    """Stream-static left joins with the (static) map table; unseen
    categories get the ``least_perc`` code. Returns a streaming DataFrame."""
    out = apply_category_map(stream, categorical, maps, artefact, "category")
    if label:
        out = apply_label_map(out, label, maps, artefact)
    return out
