"""featurelens: feature analysis on Spark DataFrames.

Column summaries and profiles, quantile binning and information value,
label drift by population stability index, look-ahead labels and
interaction history with range windows, forward fill of snapshots,
leakage-free sampling and splitting, encoders kept as parquet tables,
and one-vs-all boosted trees with MLlib. Every operator takes and
returns DataFrames; nothing is collected except O(columns) or O(labels)
metadata.
"""

from featurelens.session import get_session, scratch_dir
from featurelens.spec import FeatureSpec

__all__ = ["get_session", "scratch_dir", "FeatureSpec"]
