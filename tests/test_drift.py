import datetime as dt

from featurelens.operators import calendar as cal, drift


def test_crosstab_margins_fixture(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (None, "b", "x"), (4, None, "y"), (5, "b", "y")]
    df = spark.createDataFrame(rows, "c int, l string, d string")
    ct = {(r["label"], r["period"]): r["n"] for r in drift.crosstab_margins(df, "l", "d", "c").collect()}
    assert ct[("a", "x")] == 1 and ct[("a", "y")] == 1 and ct[("a", "All")] == 2
    assert ct[("b", "x")] == 0 and ct[("b", "y")] == 1 and ct[("b", "All")] == 1
    assert ct[("All", "x")] == 1 and ct[("All", "y")] == 2 and ct[("All", "All")] == 3
    assert sum(v for (l, p), v in ct.items() if l != "All" and p != "All") == ct[("All", "All")]


def test_psi_equal_shares_is_zero(spark):
    rows = [("a", "p1"), ("b", "p1"), ("a", "p2"), ("b", "p2")]
    df = spark.createDataFrame([(i, l, p) for i, (l, p) in enumerate(rows)], "k int, l string, p string")
    p = drift.psi(drift.crosstab_ratio(drift.crosstab_margins(df, "l", "p", "k")))
    got = {(r["label"], r["period"]): r["psi"] for r in p.collect()}
    assert got[("a", "p1")] is None and got[("b", "p1")] is None
    assert got[("a", "p2")] == 0 and got[("b", "p2")] == 0
    assert got[("all_unique_labels", "p1")] is None


def test_psi_missing_cell_counts_as_zero(spark):
    # label b absent in p2 and present again in p3
    rows = [("a", "p1"), ("b", "p1"), ("a", "p2"), ("a", "p3"), ("b", "p3")]
    df = spark.createDataFrame([(i, l, p) for i, (l, p) in enumerate(rows)], "k int, l string, p string")
    p = drift.psi(drift.crosstab_ratio(drift.crosstab_margins(df, "l", "p", "k")))
    got = {(r["label"], r["period"]): r["psi_raw"] for r in p.collect()}
    assert got[("b", "p2")] > 0 and got[("b", "p3")] > 0
    assert got[("all_unique_labels", "p2")] >= got[("b", "p2")]
    assert all(v is None or v >= 0 for v in got.values())


def test_week_bins_fixture(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(29)]
    df = spark.createDataFrame(days, "d date")
    w = cal.week_bins(df, "d").groupBy("week_idx", "week").count().orderBy("week_idx").collect()
    assert [r["count"] for r in w] == [7, 7, 7, 7]
    assert w[0]["week"] == "week_01_2024-01-01_2024-01-08"


def test_month_bins_fixture(spark):
    start = dt.date(2022, 7, 10)
    days = [(start + dt.timedelta(days=i),) for i in range((dt.date(2022, 10, 5) - start).days + 1)]
    df = spark.createDataFrame(days, "d date")
    m = cal.month_bins(df, "d").groupBy("month_idx", "month").count().orderBy("month_idx").collect()
    assert [(r["month"], r["count"]) for r in m] == [
        ("months_01_2022-08-01_2022-09-01", 31), ("months_02_2022-09-01_2022-10-01", 30)]


def test_period_columns_fallback(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i),) for i in range(20)]
    p = cal.period_columns(spark.createDataFrame(days, "d date"), "d")
    rows = p.collect()
    assert all(r["month"] is None for r in rows) and len(rows) == 14


def test_label_report_tables_and_psi_nonnegative(spark, sf_small):
    e = spark.read.parquet(f"{sf_small}/events.parquet")
    rep = drift.label_report(e, "user_id", "event_type", "ts")
    assert sorted(rep) == sorted(f"{k}_{g}" for k in ("total", "ratio", "psi") for g in ("dly", "wly", "mly"))
    for g in ("dly", "wly"):
        vals = [r["psi_raw"] for r in rep[f"psi_{g}"].collect() if r["psi_raw"] is not None]
        assert vals and all(v >= 0 for v in vals)
        tot = {r["period"]: r["n"] for r in rep[f"total_{g}"].where("label = 'All'").collect()}
        cells = rep[f"total_{g}"].where("label <> 'All' AND period <> 'All'").groupBy("period").sum("n").collect()
        assert all(tot[r["period"]] == r["sum(n)"] for r in cells)


def test_a_label_and_a_period_named_all(spark):
    rows = [(i, l, p) for i, (l, p) in enumerate([("All", "p1"), ("a", "p1"), ("a", "All"), ("All", "All"), ("All", "All")])]
    df = spark.createDataFrame(rows, "k int, l string, p string")
    ct = drift.crosstab_margins(df, "l", "p", "k")
    data = {(r.label, r.period): r.n for r in ct.where("not all_labels and not all_periods").collect()}
    assert data == {("All", "p1"): 1, ("a", "p1"): 1, ("a", "All"): 1, ("All", "All"): 2}
    total = ct.where("all_labels and all_periods").collect()
    assert [r.n for r in total] == [5]
    p = drift.psi(drift.crosstab_ratio(ct)).where("not all_labels").collect()
    assert {r.label for r in p} == {"All", "a"} and len(p) == 4
