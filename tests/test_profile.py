import pytest
from pyspark.sql import functions as F

from featurelens.operators import profile
from featurelens.operators.columns import valid_features
from featurelens.operators.profile import data_profile, data_summary


def _by_var(df, key="var"):
    return {r[key]: r for r in df.collect()}


def test_summary_nulls_counted_as_value(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,), (5.0,)], "c double")
    r = _by_var(data_summary(df))["c"]
    assert r["num_unique"] == 5
    assert r["missing_cnt"] == 1 and r["non_missing_cnt"] == 4
    assert r["missing_rate"] == 0.2
    assert r["zero_cnt"] == 0 and r["zero_rate"] == 0.0
    assert r["samples"] == ["1.0", "2.0", "4.0", "5.0"]
    assert r["proposed_data_type"] == "numerical"
    assert r["remarks"] == ""


def test_summary_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "c double")
    r = _by_var(data_summary(df))["c"]
    assert r["missing_cnt"] == 1


def test_summary_flags_and_valid_features(spark):
    df = spark.createDataFrame([(0, None, "x"), (0, None, "x"), (0, None, "x")], "c int, d double, e string")
    s = data_summary(df)
    r = _by_var(s)
    assert r["c"]["remarks"] == "zero_rate==1, cardinality==1"
    assert r["d"]["remarks"] == "missing_rate==1, cardinality==1"
    assert r["e"]["remarks"] == "cardinality==1"
    assert r["e"]["zero_cnt"] is None
    v = _by_var(valid_features(s))
    assert not any(x["is_valid"] for x in v.values())
    assert v["c"]["all_zero"] and v["d"]["all_missing"] and v["e"]["single_cardinality"]


def test_samples_are_lowest_and_highest_typed(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 21)] + [(None,)], "c long")
    r = _by_var(data_summary(df))["c"]
    assert r["samples"] == ["1", "2", "3", "4", "5", "16", "17", "18", "19", "20"]
    assert r["num_unique"] == 21


def test_profile_duplicates_and_samples(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("b",)], "l string")
    r = _by_var(data_profile(df), "feature_name")["l"]
    assert r["unique_vals"] == 3 and r["count_duplicated"] == 2
    assert r["sample_values"] == ["a", "b"]
    assert r["range_of_features"] == "not_applicable"


def test_profile_date_text_range(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-01",), (None,)], "d string")
    r = _by_var(data_profile(df), "feature_name")["d"]
    assert r["range_of_features"] == "min -> max: (2024-01-01, 2024-01-02)"


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a double, b string")
    rows = _by_var(data_summary(df))
    assert rows["a"]["num_unique"] == 0
    assert rows["a"]["missing_rate"] is None


def test_partition_count_does_not_change_summary(spark):
    df = spark.range(0, 500).select((F.col("id") % 37).alias("k"), (F.col("id") % 5 == 0).alias("b"))
    a = sorted(map(tuple, data_summary(df.repartition(1)).drop("samples").collect()))
    b = sorted(map(tuple, data_summary(df.repartition(7)).drop("samples").collect()))
    assert a == b


def test_duplicate_columns_and_stringify(spark):
    from featurelens.operators.columns import duplicate_columns, stringify_temporal
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y")], "k int, v string")
    j = a.join(b, a["k"] == b["k"])
    assert sorted(duplicate_columns(j)) == ["k", "v"]
    import datetime as dt
    t = spark.createDataFrame([(dt.date(2024, 1, 2),)], "d date")
    assert stringify_temporal(t).first()["d"] == "2024-01-02"


def test_decimal_column_summary_and_profile(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(Decimal("1.50"),), (Decimal("0.00"),), (None,), (Decimal("1.50"),)], "p decimal(10,2)")
    r = _by_var(data_summary(df))["p"]
    assert r["num_unique"] == 3 and r["zero_cnt"] == 1 and r["missing_cnt"] == 1
    assert r["samples"] == ["0.00", "1.50"]
    pr = _by_var(data_profile(df), "feature_name")["p"]
    assert pr["range_of_features"] == "min -> max: (0.000, 1.500)"


def test_digits_are_no_date_and_long_integers_stay_exact(spark):
    df = spark.createDataFrame([("12345", "2024-01-05", 9007199254740993), ("67890", "2024-02-05 10:00:00", 1)], "zip string, day string, big long")
    got = {r["feature_name"]: r["range_of_features"] for r in data_profile(df).collect()}
    assert got["zip"] == "not_applicable"
    assert got["day"] == "min -> max: (2024-01-05, 2024-02-05 10:00:00)"
    assert got["big"] == "min -> max: (1.000, 9007199254740993.000)"


def test_long_texts_with_one_beginning(spark):
    head = "https://example.org/a/very/long/way/down/"
    vals = [head + f"{i:04d}" for i in range(500)] * 2 + [None, "", "zz", "Ab"]
    df = spark.createDataFrame([(v, len(v or "")) for v in vals], "t string, n int")
    r = {x["var"]: x for x in profile.column_stats(df).collect()}["t"]
    distinct = sorted({v for v in vals if v is not None})
    assert r["num_unique"] == len(distinct) + 1 and r["rows"] == len(vals)
    assert r["samples"] == distinct[:5] + distinct[-5:]
    assert (r["min_text"], r["max_text"]) == ("", "zz") and r["is_date_field"] is False


def test_whole_texts_stay_out_of_the_counts(spark):
    df = spark.createDataFrame([("x" * 5000 + str(i % 50),) for i in range(300)], "t string")
    counts = profile._value_counts(df, ["t"])
    assert counts.count() == 50
    assert max(len(r["head"]) for r in counts.collect()) == profile.HEAD
    assert profile.column_stats(df).first()["samples"] == sorted({"x" * 5000 + str(i) for i in range(50)})[:5] + sorted({"x" * 5000 + str(i) for i in range(50)})[-5:]


@pytest.mark.parametrize("values,name", [
    (["2024-01-05", "2024-01-05 10:00:00", "2024-01-06T01:02:03.5"], "iso"),
    (["1/13/2024", "02/03/2024"], "month/day/year"), (["13/1/2024", "02/03/2024"], "day/month/year"),
    (["02/03/2024"], "month/day/year"), (["1/13/2024", "13/1/2024"], None), (["2024/3/4 10:15"], "year/month/day"),
    (["3.4.2024"], "day.month.year"), (["31-12-2024"], "day-month-year"), (["5 Mar 2024", "17 March 2024"], "day month-name year"),
    (["Mar 5, 2024", "March 17, 2024 9:00"], "month-name day, year"), (["20240229"], "yearmonthday"), (["20240230"], None),
    (["1700000000"], "epoch seconds"), (["1700000000000"], "epoch milliseconds"), (["170000000"], None),
    (["2024-01-05", "1/5/2024"], None), (["2024-02-30"], None), (["May"], None), ([""], None), (["2024-01-05" + " " * 40], None)])
def test_one_format_reads_all_values(spark, values, name):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "t string")
    r = profile.column_stats(df).first()
    assert (r["is_date_field"], r["date_format"]) == (name is not None, name)


def test_convert_dates(spark):
    df = spark.createDataFrame([("13/1/2024", "a", None, 1), (None, "b", None, 2)], "d string, w string, e string, n int")
    out, found = profile.convert_dates(df)
    assert found == {"d": "day/month/year"} and dict(out.dtypes) == {"d": "date", "w": "string", "e": "string", "n": "int"}
    assert [str(r["d"]) for r in out.orderBy("n").collect()] == ["2024-01-13", "None"]
    assert profile.convert_dates(df.select("n"))[1] == {}


def test_stats_read_the_table_once_and_rank_only_the_ends(spark):
    df = spark.range(0, 5000, 1, 3).select(
        (F.col("id") * 7 % 5000).alias("n"), (F.col("id") % 1000 / 2 - 100).alias("d"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 3).cast("int").alias("few"), F.lit(None).cast("double").alias("nul"))
    st = profile.column_stats(df)
    # the table's values are counted before: only the literal table of the columns is a range
    assert st._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    got = {r["var"]: r for r in st.collect()}
    assert got["n"]["samples"] == [str(x) for x in (0, 1, 2, 3, 4, 4995, 4996, 4997, 4998, 4999)]
    assert got["d"]["samples"] == [str(x / 2 - 100) for x in (0, 1, 2, 3, 4, 995, 996, 997, 998, 999)]
    assert got["few"]["samples"] == ["0", "1", "2"] and got["few"]["num_unique"] == 4 and got["few"]["non_missing_cnt"] == 4000
    assert got["nul"]["samples"] == [] and got["nul"]["non_missing_cnt"] == 0 and got["nul"]["num_unique"] == 1
    assert got["n"]["zero_cnt"] == 1 and got["d"]["zero_cnt"] == 5 and got["n"]["max_int"] == 4999 and got["d"]["min_num"] == -100.0
