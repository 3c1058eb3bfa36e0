"""Property tests (hypothesis) for the order statistics behind bins and medians."""

import math

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st

from featurelens.operators.profile import profile_table
from featurelens.operators.ranking import exact_quantiles

values = st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=values, b=values)
def test_distributed_quantiles_match_numpy(spark, a, b):
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
    got = {r["g"]: r["quantiles"] for r in
           exact_quantiles(df, "g", "x", probs, num_partitions=3).collect()}
    for g, xs in (("a", a), ("b", b)):
        ref = np.quantile(np.array(xs, dtype=float), probs, method="linear")
        assert all(math.isclose(p, q, rel_tol=1e-12, abs_tol=1e-9) for p, q in zip(got[g], ref))


def test_profile_table_sample_size(spark, sf_small):
    o = spark.read.parquet(f"{sf_small}/orders.parquet")
    rows = {r["feature_name"]: r for r in profile_table(o, "o_orderdate", sample_size=300,
                                                        key_cols=["o_orderkey"], with_explored_date=False).collect()}
    assert rows["o_orderkey"]["records_count"] == 300
    assert rows["o_orderkey"]["spark_dtype"] == "bigint"
    assert rows["o_orderkey"]["min_o_orderdate"].startswith("1995")
