"""DuckDB SQL for the registered queries (the correctness oracle).

Each string computes, from the same parquet tables, what the matching
query in :mod:`featurelens.plans.catalog` computes with Spark. Built from
small SQL pieces so that shared parts (bins, weeks, labels) are written once.
"""

from __future__ import annotations

R = 12
EPS_PSI = "1.1920928955078125e-07"
EPS_IV = "2.220446049250313e-16"
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PROBS = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]::DOUBLE[]"

ORDERS = [("o_orderkey", "bigint", True), ("o_custkey", "bigint", True), ("o_orderstatus", "string", False),
          ("o_totalprice", "double", True), ("o_orderdate", "timestamp_ntz", False),
          ("o_orderpriority", "string", False)]
PART = [("p_partkey", "bigint", True), ("p_name", "string", False), ("p_brand", "string", False),
        ("p_type", "string", False), ("p_size", "int", True), ("p_retailprice", "double", True)]

# queries whose result has a DATE column named "date"
DATE_COLUMN_QUERIES = ("derive_dates", "join_features", "lagged_join", "ffill_join", "snapshot_features",
                       "history_pivot", "lookahead_labels", "lookahead_labels_gap", "explode_labels",
                       "history_list", "explode_history", "history_sorted_list", "history_map", "lookahead_many_labels", "dedup_rows", "label_dataset",
                       "interaction_features", "transaction_features")

EV_NULLED = ("SELECT event_id, ts, user_id, event_type, CASE WHEN value > 50 THEN value END AS value, props "
             "FROM events")


def _md5_bucket(seed, key):
    return f"(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 100)"


# --- summary / profile -------------------------------------------------------

def _samples(table, c, num, k_each, both=True):
    d = f"CAST({c} AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
    cond = (f"row_number() OVER (ORDER BY d NULLS LAST, s) <= {k_each}"
            + (f" OR row_number() OVER (ORDER BY d DESC NULLS LAST, s DESC) <= {k_each}" if both else ""))
    return (f"coalesce((SELECT string_agg(s, '|' ORDER BY d NULLS LAST, s) FROM ("
            f"SELECT s, d FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS s, {d} AS d FROM {table} "
            f"WHERE {c} IS NOT NULL) u QUALIFY {cond}) v), '')")


def _nunique(table, c):
    return f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM {table}) u)"


def summary_sql(table, cols):
    parts = []
    for i, (c, typ, num) in enumerate(cols):
        zc = f"CAST(count(*) FILTER (WHERE {c} = 0) AS BIGINT)" if num else "CAST(NULL AS BIGINT)"
        zr = f"count(*) FILTER (WHERE {c} = 0) / count(*)" if num else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT {i} AS col_idx, '{c}' AS var, CAST({_nunique(table, c)} AS BIGINT) AS num_unique, "
            f"{_samples(table, c, num, 5)} AS samples, '{typ}' AS type, "
            f"'{'numerical' if num else 'categorical'}' AS proposed_data_type, "
            f"CAST(count({c}) AS BIGINT) AS non_missing_cnt, CAST(count(*) - count({c}) AS BIGINT) AS missing_cnt, "
            f"(count(*) - count({c})) / count(*) AS missing_rate, {zc} AS zero_cnt, {zr} AS zero_rate FROM {table}")
    body = " UNION ALL ".join(parts)
    return (f"SELECT *, concat_ws(', ', CASE WHEN missing_rate = 1 THEN 'missing_rate==1' END, "
            f"CASE WHEN zero_rate = 1 THEN 'zero_rate==1' END, "
            f"CASE WHEN num_unique = 1 THEN 'cardinality==1' END) AS remarks FROM ({body}) s")


def profile_sql(table, cols, where=""):
    src = f"(SELECT * FROM {table} {where})" if where else table
    parts = []
    for c, typ, num in cols:
        if num:
            rng = f"printf('min -> max: (%.3f, %.3f)', CAST(min({c}) AS DOUBLE) + 0.0, CAST(max({c}) AS DOUBLE) + 0.0)"
        elif typ.startswith("timestamp") or typ == "date":
            rng = (f"CASE WHEN min({c}) IS NOT NULL THEN 'min -> max: (' || CAST(min({c}) AS VARCHAR) || ', ' "
                   f"|| CAST(max({c}) AS VARCHAR) || ')' ELSE 'not_applicable' END")
        else:
            rng = (f"CASE WHEN bool_and({c} IS NULL OR try_cast({c} AS DATE) IS NOT NULL) AND min({c}) IS NOT NULL "
                   f"THEN 'min -> max: (' || min({c}) || ', ' || max({c}) || ')' ELSE 'not_applicable' END")
        nu = _nunique(src, c)
        parts.append(
            f"SELECT '{c}' AS feature_name, CAST(count(*) AS BIGINT) AS records_count, '{typ}' AS dtype, "
            f"CAST({nu} AS BIGINT) AS unique_vals, CAST(count(*) - count({c}) AS BIGINT) AS count_missing_values, "
            f"CAST(count(*) - {nu} AS BIGINT) AS count_duplicated, "
            f"{_samples(src, c, num, 4, both=False)} AS sample_values, {rng} AS range_of_features FROM {src}")
    return " UNION ALL ".join(parts)


# --- windows over days -----------------------------------------------------------

def lookahead_sql(lo, hi):
    return (f"(WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS \"date\" FROM events), "
            f"e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS \"date\", event_type FROM events) "
            f"SELECT d.user_id, d.\"date\", list_sort(list_distinct(array_agg(e.event_type))) AS lst "
            f"FROM d LEFT JOIN e ON e.user_id = d.user_id AND e.\"date\" BETWEEN d.\"date\" + {lo} AND d.\"date\" + {hi} "
            f"GROUP BY d.user_id, d.\"date\")")


LABELS = f"(SELECT user_id, \"date\", unnest(lst) AS label FROM {lookahead_sql(0, 8)} la)"


def history_day_sql():
    cnts = ", ".join(f"count(*) FILTER (WHERE event_type = '{v}') AS n{i}" for i, v in enumerate(EVENT_TYPES))
    return (f"(SELECT user_id, CAST(ts AS DATE) AS \"date\", count(*) AS r, count(event_type) AS n, {cnts} "
            f"FROM events GROUP BY ALL)")


def history_pivot_sql(src_filter=""):
    day = history_day_sql() if not src_filter else history_day_sql().replace("FROM events", f"FROM events {src_filter}")
    cols = ", ".join(f"CAST(coalesce(sum(b.n{i}), 0) * a.r AS BIGINT) AS \"{v}\"" for i, v in enumerate(EVENT_TYPES))
    return (f"(SELECT a.user_id, a.\"date\", {cols}, "
            f"CAST(CASE WHEN coalesce(sum(b.n), 0) = 0 THEN a.r ELSE 0 END AS BIGINT) AS \"null\" "
            f"FROM {day} a LEFT JOIN {day} b ON b.user_id = a.user_id "
            f"AND b.\"date\" BETWEEN a.\"date\" - 60 AND a.\"date\" - 1 GROUP BY a.user_id, a.\"date\", a.r)")


def history_counts_sql():
    """(user, date, past intent, count) over the earlier 60 days; NULL intent
    with count 0 when the history is empty."""
    return ("(SELECT d.user_id, d.\"date\", e.event_type AS cb_past_intent, CAST(count(e.event_type) AS BIGINT) AS n_past "
            "FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS \"date\" FROM events) d "
            "LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS \"date\", event_type FROM events) e "
            "ON e.user_id = d.user_id AND e.\"date\" BETWEEN d.\"date\" - 60 AND d.\"date\" - 1 "
            "GROUP BY d.user_id, d.\"date\", e.event_type)")


def purchase_snapshot_sql():
    return ("(SELECT user_id, CAST(ts AS DATE) AS as_of_dt, sum(value) AS bal, count(*) AS n_purch "
            "FROM events WHERE event_type = 'purchase' GROUP BY ALL)")


def daily_facts_sql():
    return ("(SELECT user_id, CAST(ts AS DATE) AS as_of_dt, count(*) AS n_events, sum(value) AS total_value "
            "FROM events GROUP BY ALL)")


def ffill_sql(snap_where=""):
    snap = purchase_snapshot_sql()
    if snap_where:
        snap = f"(SELECT * FROM {snap} s {snap_where})"
    return (f"SELECT user_id, \"date\", label, "
            f"last_value(bal IGNORE NULLS) OVER w AS bal, last_value(n_purch IGNORE NULLS) OVER w AS n_purch "
            f"FROM (SELECT l.user_id, l.\"date\", l.label, s.bal, CAST(s.n_purch AS BIGINT) AS n_purch FROM {LABELS} l "
            f"LEFT JOIN {snap} s ON s.user_id = l.user_id AND s.as_of_dt = l.\"date\") j "
            f"WINDOW w AS (PARTITION BY user_id ORDER BY \"date\", label ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


# --- calendar ----------------------------------------------------------------------

def week_sql(src, dcol):
    d = f"CAST({dcol} AS DATE)"
    return (f"(SELECT * EXCLUDE (_k, _mn, _mx), "
            f"printf('week_%02d_%s_%s', _k + 1, CAST(_mn + 7 * _k AS VARCHAR), CAST(_mn + 7 * _k + 7 AS VARCHAR)) AS week, "
            f"CAST(_k + 1 AS INTEGER) AS week_idx FROM ("
            f"SELECT s.*, CAST(floor(date_diff('day', b.mn, {d}) / 7) AS INTEGER) AS _k, b.mn AS _mn, b.mx AS _mx "
            f"FROM {src} s, (SELECT min({d}) AS mn, max({d}) AS mx FROM {src} t) b) x "
            f"WHERE (_k + 1) * 7 <= date_diff('day', _mn, _mx))")


def _month_parts(dcol):
    d = f"CAST({dcol} AS DATE)"
    ms = f"CAST(date_trunc('month', {d}) AS DATE)"
    first = ("CASE WHEN b.mn = CAST(date_trunc('month', b.mn) AS DATE) THEN b.mn "
             "ELSE CAST(date_trunc('month', b.mn) + INTERVAL 1 MONTH AS DATE) END")
    return d, ms, first


def month_sql(src, dcol, mode="filter"):
    d, ms, first = _month_parts(dcol)
    inner = (f"SELECT s.*, {ms} AS _ms, b.mn AS _mn, b.mx AS _mx, {first} AS _first "
             f"FROM {src} s, (SELECT min({d}) AS mn, max({d}) AS mx FROM {src} t) b")
    in_month = "(_ms >= _mn AND CAST(_ms + INTERVAL 1 MONTH AS DATE) <= _mx)"
    has_month = "(CAST(_first + INTERVAL 1 MONTH AS DATE) <= _mx)"
    idx = "CAST(date_diff('month', _first, _ms) + 1 AS INTEGER)"
    label = (f"printf('months_%02d_%s_%s', {idx}, CAST(_ms AS VARCHAR), "
             f"CAST(CAST(_ms + INTERVAL 1 MONTH AS DATE) AS VARCHAR))")
    if mode == "filter":
        return (f"(SELECT * EXCLUDE (_ms, _mn, _mx, _first), {label} AS month, {idx} AS month_idx "
                f"FROM ({inner}) x WHERE {in_month})")
    return (f"(SELECT * EXCLUDE (_ms, _mn, _mx, _first), CASE WHEN {has_month} THEN {label} END AS month, "
            f"CASE WHEN {has_month} THEN {idx} END AS month_idx FROM ({inner}) x "
            f"WHERE NOT {has_month} OR {in_month})")


def periods_sql(src, dcol):
    return week_sql(month_sql(src, dcol, "periods"), dcol)


# --- cross-tabs, ratio, psi ---------------------------------------------------------

def crosstab_sql(src, label, period, idx, key, flags=False):
    """The full grid labels x periods, counted, with margins."""
    base = (f"(SELECT CAST({label} AS VARCHAR) AS label, CAST({period} AS VARCHAR) AS p, CAST({idx} AS BIGINT) AS i, "
            f"{key} AS k FROM {src} z WHERE {label} IS NOT NULL AND {period} IS NOT NULL)")
    al, ap = (", false AS all_labels, false AS all_periods", ", false, true") if flags else ("", "")
    la, aa = (", true, false", ", true, true") if flags else ("", "")
    return (f"(SELECT l.label, p.p AS period, p.i AS period_idx, CAST(coalesce(c.n, 0) AS BIGINT) AS n{al} "
            f"FROM (SELECT DISTINCT label FROM {base} b1) l CROSS JOIN (SELECT DISTINCT p, i FROM {base} b2) p "
            f"LEFT JOIN (SELECT label, p, i, count(k) AS n FROM {base} b3 GROUP BY ALL) c "
            f"ON c.label = l.label AND c.p = p.p AND c.i IS NOT DISTINCT FROM p.i "
            f"UNION ALL SELECT label, 'All', CAST(NULL AS BIGINT), CAST(count(k) AS BIGINT){ap} FROM {base} b4 GROUP BY label "
            f"UNION ALL SELECT 'All', p, i, CAST(count(k) AS BIGINT){la} FROM {base} b5 GROUP BY p, i "
            f"UNION ALL SELECT 'All', 'All', CAST(NULL AS BIGINT), CAST(count(k) AS BIGINT){aa} FROM {base} b6 "
            f"HAVING count(*) > 0)")


def ratio_sql(ct, flags=False):
    if flags:
        return (f"(SELECT *, n / max(CASE WHEN all_labels THEN n END) OVER (PARTITION BY period, period_idx, all_periods) AS ratio "
                f"FROM {ct} c)")
    return (f"(SELECT *, n / max(CASE WHEN label = 'All' THEN n END) OVER (PARTITION BY period) AS ratio "
            f"FROM {ct} c)")


def psi_sql(src, label, period, idx, key):
    """From the source rows: shares of every label in every period, against
    the period before."""
    return (f"WITH e AS (SELECT CAST({label} AS VARCHAR) AS label, CAST({period} AS VARCHAR) AS period, "
            f"CAST({idx} AS BIGINT) AS period_idx, {key} AS k FROM {src} z WHERE {label} IS NOT NULL AND {period} IS NOT NULL), "
            f"pr AS (SELECT period, period_idx, row_number() OVER (ORDER BY period_idx, period) AS k, cnt FROM "
            f"(SELECT period, period_idx, count(k) AS cnt FROM e GROUP BY ALL) x), "
            f"cells AS (SELECT l.label, pr.k, pr.period, pr.period_idx, "
            f"coalesce((SELECT count(e.k) FROM e WHERE e.label = l.label AND e.period = pr.period) / nullif(pr.cnt, 0), 0) AS r "
            f"FROM (SELECT DISTINCT label FROM e) l CROSS JOIN pr), "
            f"pl AS (SELECT c.label, c.period, c.period_idx, CASE WHEN c.k > 1 THEN (c.r - v.r) * ln((c.r + {EPS_PSI}) / "
            f"(v.r + {EPS_PSI})) END AS psi_raw FROM cells c LEFT JOIN cells v ON v.label = c.label AND v.k + 1 = c.k) "
            f"SELECT label, period, period_idx, round(psi_raw, {R}) AS psi_raw FROM pl UNION ALL "
            f"SELECT 'all_unique_labels', period, period_idx, round(sum(psi_raw), {R}) FROM pl GROUP BY period, period_idx")


# --- bins and IV --------------------------------------------------------------------

O_FEAT = "(SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS o_prio FROM orders)"


def edges_sql(src, binned):
    if not binned:
        return "(SELECT CAST(NULL AS VARCHAR) AS var, CAST(NULL AS DOUBLE[]) AS edges WHERE false)"
    parts = [f"SELECT '{c}' AS var, list_sort(list_distinct(list_transform(quantile_cont(CAST({c} AS DOUBLE), {PROBS}), "
             f"lambda q: round(q, 6)))) AS edges FROM {src} s" for c in binned]
    return "(" + " UNION ALL ".join(parts) + ")"


def binned_long_sql(src, label, binned, unbinned, categorical, num_types=None):
    num_types = num_types or {}
    parts = []
    lab = f"CAST({label} AS VARCHAR)" if label else "CAST(NULL AS VARCHAR)"
    for c in binned:
        parts.append(f"SELECT {lab} AS lab, '{c}' AS var, CAST({c} AS DOUBLE) AS x, CAST(NULL AS VARCHAR) AS s FROM {src} z")
    for c in unbinned:
        fill = "9999999.0" if num_types.get(c) == "double" else "9999999"
        parts.append(f"SELECT {lab} AS lab, '{c}' AS var, CAST(NULL AS DOUBLE) AS x, CAST(coalesce({c}, {fill}) AS VARCHAR) AS s FROM {src} z")
    for c in categorical:
        parts.append(f"SELECT {lab}, '{c}', CAST(NULL AS DOUBLE), coalesce(CAST({c} AS VARCHAR), 'NA') FROM {src} z")
    long = "(" + " UNION ALL ".join(parts) + ")"
    e = edges_sql(src, binned)
    hi = "edges[least(bin_idx + 1, len(edges))]"
    return (f"(SELECT lab, var, bin_idx, CASE WHEN bin_idx IS NOT NULL THEN edges[bin_idx] END AS bin_lo, "
            f"CASE WHEN bin_idx IS NOT NULL THEN {hi} END AS bin_hi, "
            f"CASE WHEN edges IS NULL THEN s WHEN bin_idx IS NULL THEN 'nan' "
            f"ELSE '(' || CAST(edges[bin_idx] AS VARCHAR) || ', ' || CAST({hi} AS VARCHAR) || ']' END AS bin FROM ("
            f"SELECT l.*, e.edges, CASE WHEN e.edges IS NOT NULL AND l.x IS NOT NULL THEN "
            f"CAST(greatest(1, len(list_filter(e.edges, lambda q: q < l.x))) AS INTEGER) END AS bin_idx "
            f"FROM {long} l LEFT JOIN {e} e USING (var)) y)")


def iv_verbose_sql(src, label, binned, unbinned, categorical, num_types=None, rnd=True):
    bl = binned_long_sql(src, label, binned, unbinned, categorical, num_types)
    cat = ", ".join(f"'{c}'" for c in categorical) or "''"
    iv = (f"(neg_rate - pos_rate) * ln((neg_rate + {EPS_IV}) / (pos_rate + {EPS_IV}))")
    ivc = f"round({iv}, {R})" if rnd else iv
    return (f"WITH bl AS {bl}, "
            f"lab_list AS (SELECT DISTINCT CAST({label} AS VARCHAR) AS label FROM {src} z WHERE {label} IS NOT NULL), "
            f"tot AS (SELECT l.label, count(*) FILTER (WHERE CAST(z.{label} AS VARCHAR) = l.label) AS total_pos, "
            f"count(*) - count(*) FILTER (WHERE CAST(z.{label} AS VARCHAR) = l.label) AS total_neg "
            f"FROM lab_list l, {src} z GROUP BY l.label), "
            f"per_bin AS (SELECT var, bin, bin_idx, bin_lo, bin_hi, count(*) AS bin_n FROM bl GROUP BY ALL), "
            f"pos AS (SELECT var, bin, lab AS label, count(*) AS pos FROM bl GROUP BY ALL), "
            f"g AS (SELECT pb.*, l.label, coalesce(p.pos, 0) AS pos, t.total_pos, t.total_neg FROM per_bin pb "
            f"CROSS JOIN lab_list l LEFT JOIN pos p ON p.var = pb.var AND p.bin = pb.bin AND p.label = l.label "
            f"JOIN tot t ON t.label = l.label), "
            f"g2 AS (SELECT *, bin_n - pos AS neg, (bin_n - pos) / total_neg AS neg_rate, pos / total_pos AS pos_rate FROM g) "
            f"SELECT label, var, bin, bin_idx, bin_lo, bin_hi, "
            f"CASE WHEN var IN ({cat}) THEN 'categorical' ELSE 'numerical' END AS proposed_data_type, "
            f"CAST(neg AS BIGINT) AS neg, CAST(pos AS BIGINT) AS pos, CAST(total_neg AS BIGINT) AS total_neg, "
            f"CAST(total_pos AS BIGINT) AS total_pos, neg_rate, pos_rate, {ivc} AS iv FROM g2")


IV_ORDERS = (O_FEAT, "o_orderstatus", ["o_totalprice", "o_custkey"], ["o_prio"], ["o_orderpriority"])


def iv_orders_verbose(rnd=True):
    return iv_verbose_sql(*IV_ORDERS, rnd=rnd)


def iv_summary_sql(verbose):
    return (f"SELECT label, var, proposed_data_type, max(total_neg) AS total_neg, max(total_pos) AS total_pos, "
            f"round(sum(iv), {R}) AS iv FROM ({verbose}) v GROUP BY ALL")


def strength(col):
    return (f"CASE WHEN {col} >= 0.5 THEN 'too good to be true' WHEN {col} >= 0.3 THEN 'strong' "
            f"WHEN {col} >= 0.1 THEN 'medium' WHEN {col} >= 0.02 THEN 'weak' "
            f"WHEN {col} IS NOT NULL THEN 'useless' END")


def describe_sql(src, by, value, prefix, count_name, d):
    p = prefix
    return (f"SELECT {by}, CAST(count({value}) AS BIGINT) AS {count_name or p + 'count'}, "
            f"round(avg({value}), {d}) AS {p}mean, round(stddev_samp({value}), {d}) AS {p}std, "
            f"round(CAST(min({value}) AS DOUBLE), {d}) AS {p}min, "
            f"round(quantile_cont({value}, 0.25), {d}) AS \"{p}25%\", round(quantile_cont({value}, 0.5), {d}) AS \"{p}50%\", "
            f"round(quantile_cont({value}, 0.75), {d}) AS \"{p}75%\", round(CAST(max({value}) AS DOUBLE), {d}) AS {p}max "
            f"FROM {src} z GROUP BY {by}")


def order_split(seed=33, pct=20):
    return f"(SELECT *, CASE WHEN {_md5_bucket(seed, 'o_custkey')} < {pct} THEN 'test' ELSE 'train' END AS split FROM orders)"


def split_counts_sql(split, whole):
    return (f"SELECT split AS dataset, CAST(count(*) AS BIGINT) AS counts, CAST(count(DISTINCT o_custkey) AS BIGINT) "
            f"AS unique_o_custkey FROM {split} s GROUP BY split UNION ALL SELECT 'original', "
            f"CAST(count(*) AS BIGINT), CAST(count(DISTINCT o_custkey) AS BIGINT) FROM {whole} w")


def build() -> dict:
    q = {}
    q["read_table"] = "SELECT * FROM orders"
    q["stringify_temporal"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                               "CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders")
    q["with_key_counts"] = ("SELECT *, CAST((SELECT count(DISTINCT o_custkey) + max(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) "
                            "FROM orders) AS BIGINT) AS distinct_cnt_o_custkey, "
                            "CAST((SELECT count(*) FROM orders) AS BIGINT) AS records FROM orders")
    q["write_table"] = "SELECT * FROM orders"
    q["sample_n"] = "SELECT * FROM orders ORDER BY md5('111|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 2000"
    q["sample_table_to_path"] = q["sample_n"]
    q["write_report"] = ("SELECT CAST(o_orderpriority AS VARCHAR) AS label, CAST(count(*) AS BIGINT) AS count "
                         "FROM orders GROUP BY ALL")
    bmap = ("SELECT 'p_brand' AS \"column\", p_brand AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS BIGINT) AS code, "
            "count(*) OVER () AS k FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand")
    tmap = ("SELECT 'p_type' AS \"column\", p_type AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS BIGINT) AS code, "
            "count(*) OVER () AS k FROM part WHERE p_type IS NOT NULL GROUP BY p_type")
    q["save_artefacts"] = (
        f"SELECT 'training' AS artefact, 'category' AS kind, \"column\", value, code FROM ({bmap} UNION ALL {tmap}) m WHERE code < k - 1 "
        f"UNION ALL SELECT 'training', 'category', \"column\", 'least_perc', CAST(max(k) - 1 AS BIGINT) FROM ({bmap} UNION ALL {tmap}) m GROUP BY \"column\" "
        f"UNION ALL SELECT 'training', 'label', 'o_orderstatus', o_orderstatus, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS BIGINT) "
        f"FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL) d")

    q["select_cols"] = "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem"
    q["drop_cols"] = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"
    q["prefix_columns"] = ("SELECT c_custkey, c_name AS sa_dly_c_name, c_nationkey AS sa_dly_c_nationkey, "
                           "c_acctbal AS sa_dly_c_acctbal, c_mktsegment AS sa_dly_c_mktsegment FROM customer")
    q["between_dates"] = "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
    q["between_stamps"] = "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10'"
    q["half_open_dates"] = "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-25'"
    q["not_null"] = f"SELECT * FROM ({EV_NULLED}) e WHERE value IS NOT NULL"
    q["cast_decimals"] = "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS price FROM orders"
    q["fill_numeric"] = "SELECT event_id, CASE WHEN value > 50 THEN value ELSE 0 END AS value FROM events"
    q["fill_categorical"] = "SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type ELSE 'NAN' END AS event_type FROM events"
    cf = ("(SELECT o_orderkey, o_totalprice, o_orderpriority, 0 AS z, CAST(NULL AS DOUBLE) AS nul, 'x' AS const FROM orders)")
    cf_cols = [("o_orderkey", "bigint", True), ("o_totalprice", "double", True), ("o_orderpriority", "string", False),
               ("z", "int", True), ("nul", "double", True), ("const", "string", False)]
    q["valid_features"] = (
        f"SELECT var, proposed_data_type, coalesce(missing_rate = 1, false) AS all_missing, "
        f"coalesce(zero_rate = 1, false) AS all_zero, coalesce(num_unique = 1, false) AS single_cardinality, "
        f"NOT (coalesce(missing_rate = 1, false) OR coalesce(zero_rate = 1, false) OR coalesce(num_unique = 1, false)) AS is_valid "
        f"FROM ({summary_sql(cf, cf_cols)}) s")
    q["features_by_proposed_type"] = f"SELECT var FROM ({summary_sql('orders', ORDERS)}) s WHERE proposed_data_type = 'numerical'"
    q["one_vs_rest_label"] = ("SELECT o_orderkey, o_orderstatus, CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) "
                              "AS pseudo_label FROM orders")
    q["derive_dates"] = ("SELECT event_id, CAST(ts AS DATE) AS date, "
                         "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) * 86400 AS unix_date, "
                         "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch_day FROM events")

    q["join_mapping"] = ("SELECT e.event_id, e.user_id, e.event_type, c.c_custkey, c.c_mktsegment FROM events e "
                         "JOIN customer c ON e.user_id = c.c_custkey WHERE c.c_custkey IS NOT NULL")
    q["join_features"] = (f"SELECT l.user_id, l.\"date\", l.label, CAST(f.n_events AS BIGINT) AS n_events, f.total_value "
                          f"FROM {LABELS} l JOIN {daily_facts_sql()} f ON f.user_id = l.user_id AND f.as_of_dt = l.\"date\"")
    q["lagged_join"] = (f"SELECT a.user_id, a.as_of_dt AS \"date\", CAST(a.n_events AS BIGINT) AS n_today, "
                        f"CAST(b.n_events AS BIGINT) AS n_yesterday FROM {daily_facts_sql()} a JOIN {daily_facts_sql()} b "
                        f"ON b.user_id = a.user_id AND b.as_of_dt + 1 = a.as_of_dt")
    q["customer_membership_join"] = (f"SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer "
                                     f"WHERE {_md5_bucket(33, 'c_custkey')} >= 20)")
    q["labels_not_in"] = ("SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS label FROM orders "
                          "WHERE CAST(year(o_orderdate) AS VARCHAR) NOT IN (SELECT CAST(year(o_orderdate) AS VARCHAR) "
                          "FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')")
    q["ffill_join"] = ffill_sql()
    q["snapshot_features"] = ffill_sql("WHERE as_of_dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'")

    aggs = []
    for c in ["l_quantity", "l_discount", "l_tax"]:
        aggs += [f"round(min({c}), 6) AS {c}_min", f"round(avg({c}), 6) AS {c}_mean", f"round(max({c}), 6) AS {c}_max",
                 f"round(stddev_samp({c}), 6) AS {c}_std", f"round(sum({c}), 6) AS {c}_sum"]
    q["agg_numeric"] = f"SELECT l_returnflag, {', '.join(aggs)} FROM lineitem GROUP BY l_returnflag"
    q["agg_numeric_median"] = ("SELECT l_returnflag, round(sum(l_quantity), 6) AS l_quantity_sum, "
                               "round(quantile_cont(l_quantity, 0.5), 6) AS l_quantity_median, "
                               "round(sum(l_extendedprice), 6) AS l_extendedprice_sum, "
                               "round(quantile_cont(l_extendedprice, 0.5), 6) AS l_extendedprice_median "
                               "FROM lineitem GROUP BY l_returnflag")
    q["freq_table"] = ("SELECT p_type, CAST(count(*) AS BIGINT) AS count, count(*) / (SELECT count(*) FROM part) AS percentage "
                       "FROM part GROUP BY p_type")
    # NULLs are no value: neither counted nor in the total
    q["freq_table_nulls"] = ("WITH p AS (SELECT p_type FROM part WHERE p_partkey % 3 <> 0 AND p_type IS NOT NULL) "
                             "SELECT p_type, CAST(count(*) AS BIGINT) AS count, count(*) / (SELECT count(*) FROM p) AS percentage FROM p GROUP BY p_type")
    q["cumulative_share"] = (f"SELECT *, count / (SELECT count(*) FROM part) AS perc, "
                             f"sum(count) OVER (ORDER BY count DESC, p_type NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
                             f"/ (SELECT count(*) FROM part) AS cum_perc FROM ({q['freq_table']}) f")
    q["date_bounds"] = ("SELECT CAST(min(o_orderdate) AS VARCHAR) AS min_o_orderdate, "
                        "CAST(max(o_orderdate) AS VARCHAR) AS max_o_orderdate FROM orders")
    q["label_counts"] = ("SELECT CAST(o_orderstatus AS VARCHAR) AS label, CAST(count(*) AS BIGINT) AS count, "
                         "count(*) >= 100 AS is_significant FROM orders GROUP BY ALL")
    nulled = ("(SELECT CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag, CASE WHEN l_linenumber > 2 THEN l_linenumber END AS line, "
              "l_extendedprice FROM lineitem)")
    q["agg_numeric_nulls"] = ("SELECT flag, line, round(min(l_extendedprice), 6) AS l_extendedprice_min, round(max(l_extendedprice), 6) AS l_extendedprice_max, "
                              f"round(quantile_cont(l_extendedprice, 0.5), 6) AS l_extendedprice_median FROM {nulled} x GROUP BY flag, line")
    q["describe_by_nulls"] = describe_sql(nulled, "flag", "l_extendedprice", "", None, 6)
    q["describe_by"] = describe_sql("lineitem", "l_returnflag", "l_extendedprice", "", None, 6)
    wk = week_sql("events", "ts")
    ct_w = crosstab_sql(wk, "event_type", "week", "week_idx", "user_id")
    q["crosstab_margins"] = f"SELECT * FROM {ct_w} c"
    q["crosstab_ratio"] = f"SELECT * FROM {ratio_sql(ct_w)} r"
    docs = ("(SELECT CASE WHEN source = 'src1' THEN 'All' WHEN source <> 'src2' THEN source END AS source, "
            "CASE WHEN lang = 'de' THEN 'All' ELSE lang END AS lang, doc_id FROM documents)")
    q["crosstab_sparse"] = (f"SELECT * EXCLUDE (all_labels, all_periods) FROM "
                            f"{ratio_sql(crosstab_sql(docs, 'source', 'lang', 'NULL', 'doc_id', True), True)} r")
    q["history_pivot"] = f"SELECT * FROM {history_pivot_sql()} h"
    q["split_counts"] = split_counts_sql(order_split(), "orders")
    q["label_distribution"] = (
        f"WITH x AS (SELECT *, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS BIGINT) AS o_orderstatus_idx "
        f"FROM {order_split()} s), g AS (SELECT o_orderstatus_idx, o_orderstatus AS o_orderstatus_idx_desc, "
        f"count(*) AS count, count(*) FILTER (WHERE split = 'train') AS count_train, "
        f"count(*) FILTER (WHERE split = 'test') AS count_test FROM x GROUP BY ALL) "
        f"SELECT o_orderstatus_idx, o_orderstatus_idx_desc, CAST(count AS BIGINT) AS count, count / sum(count) OVER () AS percentage, "
        f"CAST(count_train AS BIGINT) AS count_train, count_train / sum(count_train) OVER () AS percentage_train, "
        f"CAST(count_test AS BIGINT) AS count_test, count_test / sum(count_test) OVER () AS percentage_test FROM g")

    q["label_distribution_nulls"] = (
        f"WITH x AS (SELECT o_orderpriority AS lab, split FROM {order_split()} s WHERE o_orderkey % 4 <> 0 AND o_orderpriority IS NOT NULL), "
        f"g AS (SELECT lab, count(*) AS count, count(*) FILTER (WHERE split = 'train') AS count_train, "
        f"count(*) FILTER (WHERE split = 'test') AS count_test FROM x GROUP BY lab) "
        f"SELECT lab, CAST(count AS BIGINT) AS count, count / sum(count) OVER () AS percentage, "
        f"CAST(count_train AS BIGINT) AS count_train, count_train / sum(count_train) OVER () AS percentage_train, "
        f"CAST(count_test AS BIGINT) AS count_test, count_test / sum(count_test) OVER () AS percentage_test FROM g")

    q["lookahead_labels"] = (f"SELECT user_id, \"date\", array_to_string(lst, '|') AS next_7_day_labels "
                             f"FROM {lookahead_sql(0, 8)} l")
    q["lookahead_labels_gap"] = (f"SELECT user_id, \"date\", coalesce(array_to_string(lst, '|'), '') AS next_7_day_labels_with_gap "
                                 f"FROM {lookahead_sql(3, 10)} l")
    q["explode_labels"] = (f"SELECT user_id, \"date\", array_to_string(lst, '|') AS next_7_day_labels, unnest(lst) AS label "
                           f"FROM {lookahead_sql(0, 8)} l")
    q["history_list"] = (f"SELECT user_id, \"date\", coalesce(string_agg(cb_past_intent || ':' || CAST(n_past AS VARCHAR), '|' "
                         f"ORDER BY cb_past_intent), '') AS historical_interactions FROM {history_counts_sql()} h "
                         f"GROUP BY user_id, \"date\"")
    many = ("(SELECT CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, CAST(ts AS DATE) AS \"date\", "
            "CASE WHEN event_id % 11 <> 0 THEN 'L' || CAST(event_id % 3000 AS VARCHAR) END AS lab FROM events)")
    days = f"(SELECT user_id, \"date\", count(*) AS r FROM {many} e GROUP BY ALL)"
    met = "ON e.user_id IS NOT DISTINCT FROM d.user_id AND e.\"date\" BETWEEN d.\"date\" {} AND d.\"date\" {}"
    q["lookahead_many_labels"] = (f"SELECT d.user_id, d.\"date\", coalesce(array_to_string(list_sort(list(DISTINCT e.lab) FILTER (WHERE e.lab IS NOT NULL)), '|'), '') "
                                  f"AS next_7_day_labels FROM {days} d LEFT JOIN {many} e {met.format('', '+ 8')} GROUP BY d.user_id, d.\"date\"")
    q["history_map"] = (f"SELECT user_id, \"date\", coalesce(string_agg(lab || ':' || CAST(n * r AS VARCHAR), '|' ORDER BY lab) FILTER (WHERE lab IS NOT NULL), '') AS counts, "
                        f"CAST(CASE WHEN count(lab) = 0 THEN any_value(r) ELSE 0 END AS BIGINT) AS \"null\" FROM (SELECT d.user_id, d.\"date\", d.r, e.lab, count(e.lab) AS n "
                        f"FROM {days} d LEFT JOIN {many} e {met.format('- 60', '- 1')} GROUP BY ALL) x GROUP BY user_id, \"date\"")
    q["history_sorted_list"] = ("SELECT d.user_id, d.\"date\", coalesce(string_agg(e.event_type, '|' ORDER BY e.event_type), '') AS historical_interactions "
                                "FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS \"date\" FROM events) d LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS \"date\", event_type FROM events) e "
                                "ON e.user_id = d.user_id AND e.\"date\" BETWEEN d.\"date\" - 60 AND d.\"date\" - 1 GROUP BY d.user_id, d.\"date\"")
    q["explode_history"] = f"SELECT * FROM {history_counts_sql()} h"
    q["forward_fill"] = (f"SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id "
                         f"ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value "
                         f"FROM ({EV_NULLED}) e")
    q["forward_fill_nulls"] = (f"SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id "
                               f"ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM "
                               f"(SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, "
                               f"CASE WHEN event_id % 11 <> 0 THEN ts END AS ts, value FROM ({EV_NULLED}) e) x")
    q["psi"] = psi_sql(wk, "event_type", "week", "week_idx", "user_id")
    mo = periods_sql("orders", "o_orderdate")
    q["psi_monthly"] = psi_sql(mo, "o_orderstatus", "month", "month_idx", "o_custkey")

    ev_p = periods_sql("events", "ts")
    # daily tables hold all days, the others the days inside complete periods
    ev_d = "(SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS _day, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS _day_idx FROM events)"
    parts = []
    for g, (p, i) in {"dly": ("_day", "_day_idx"), "wly": ("week", "week_idx"), "mly": ("month", "month_idx")}.items():
        src = ev_d if g == "dly" else ev_p
        ct = crosstab_sql(src, "event_type", p, i, "user_id")
        parts.append(f"SELECT 'total_{g}' AS \"table\", label, period, period_idx, n, CAST(NULL AS DOUBLE) AS ratio, "
                     f"CAST(NULL AS DOUBLE) AS psi_raw FROM {ct} c")
        parts.append(f"SELECT 'ratio_{g}', label, period, period_idx, n, ratio, CAST(NULL AS DOUBLE) FROM {ratio_sql(ct)} r")
        parts.append(f"SELECT 'psi_{g}', label, period, period_idx, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), psi_raw "
                     f"FROM ({psi_sql(src, 'event_type', p, i, 'user_id')}) s")
    q["label_report"] = " UNION ALL ".join(parts)

    q["sort_report"] = iv_orders_verbose() + " ORDER BY label, var, bin_idx NULLS LAST, bin"
    q["top_iv_bins"] = (f"SELECT * EXCLUDE (iv), round(iv, {R}) AS iv FROM ({iv_orders_verbose(False)}) v "
                        f"WHERE iv = (SELECT max(iv) FROM ({iv_orders_verbose(False)}) w)")
    q["dedup_rows"] = "SELECT DISTINCT user_id, CAST(ts AS DATE) AS \"date\", event_type FROM events"

    q["week_bins"] = f"SELECT event_id, user_id, week, week_idx FROM {wk} w"
    q["month_bins"] = f"SELECT o_orderkey, month, month_idx FROM {month_sql('orders', 'o_orderdate')} m"
    q["period_columns"] = f"SELECT o_orderkey, month, month_idx, week, week_idx FROM {mo} m"
    q["period_columns_weeks_only"] = f"SELECT event_id, month, month_idx, week, week_idx FROM {ev_p} p"

    q["data_summary"] = summary_sql("orders", ORDERS)
    q["data_profile"] = profile_sql("part", PART)
    bounds = ("(SELECT CAST(min(o_orderdate) AS VARCHAR) FROM orders) AS min_o_orderdate, "
              "(SELECT CAST(max(o_orderdate) AS VARCHAR) FROM orders) AS max_o_orderdate")
    types = " ".join(f"WHEN '{c}' THEN '{t}'" for c, t, _ in ORDERS)
    q["profile_table"] = (f"SELECT p.*, {bounds}, CASE feature_name {types} END AS spark_dtype FROM ("
                          f"{profile_sql('orders', ORDERS, 'WHERE o_orderdate BETWEEN TIMESTAMP ' + chr(39) + '1996-01-01' + chr(39) + ' AND TIMESTAMP ' + chr(39) + '1996-12-31' + chr(39))}) p")
    ev_txt = "(SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, props FROM events)"
    q["is_date_field"] = " UNION ALL ".join(
        f"SELECT '{c}' AS var, bool_and({c} IS NULL OR try_cast({c} AS DATE) IS NOT NULL) AS is_date_field FROM {ev_txt} e"
        for c in ("day", "event_type", "props"))
    LINEITEM = [("l_orderkey", "bigint", True), ("l_partkey", "bigint", True), ("l_suppkey", "bigint", True),
                ("l_linenumber", "int", True), ("l_quantity", "double", True), ("l_extendedprice", "double", True),
                ("l_discount", "double", True), ("l_tax", "double", True), ("l_returnflag", "string", False),
                ("l_linestatus", "string", False), ("l_shipdate", "timestamp_ntz", False)]
    stamps = ("(SELECT lpad(CAST(o_orderkey AS VARCHAR), 6, '1') AS digits, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, "
              "CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day, "
              "CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'none' END AS mixed FROM orders)")
    iso = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}.*)?$'"
    q["is_date_field_text"] = " UNION ALL ".join(
        f"SELECT '{c}' AS var, bool_and({c} IS NULL OR (regexp_matches({c}, {iso}) AND try_cast({c} AS TIMESTAMP) IS NOT NULL)) AS is_date_field "
        f"FROM {stamps} e" for c in ("digits", "stamp", "day", "mixed"))
    # name -> (format that all texts share, text in SQL, the same for reading)
    texts = {"us": ("month/day/year", "%m/%d/%Y"), "eu": ("day/month/year", "%d/%m/%Y"), "slash": ("year/month/day", "%Y/%m/%d"),
             "dot": ("day.month.year", "%d.%m.%Y"), "dash": ("day-month-year", "%d-%m-%Y"), "day_name": ("day month-name year", "%-d %b %Y"),
             "name_day": ("month-name day, year", "%B %-d, %Y"), "compact": ("yearmonthday", "%Y%m%d"), "stamp": ("month/day/year", "%-m/%-d/%Y %H:%M:%S")}
    written = ", ".join(f"strftime(o_orderdate, '{f}') AS {n}" for n, (_, f) in texts.items())
    epoch = "CAST(CAST(epoch(o_orderdate) AS BIGINT) + 1000000000 AS VARCHAR)"
    q["date_formats"] = " UNION ALL ".join(
        [f"SELECT '{n}' AS var, bool_and(try_strptime({n}, '{f.replace('%-', '%')}') IS NOT NULL) AS is_date_field, '{name}' AS date_format FROM (SELECT {written} FROM orders) x"
         for n, (name, f) in texts.items()]
        + [f"SELECT 'epoch', bool_and(length({epoch}) = 10), 'epoch seconds' FROM orders", "SELECT 'mixed', false, NULL", "SELECT 'words', false, NULL"])
    day = "strftime(o_orderdate, '%Y-%m-%d')"
    q["derive_dates_text"] = (f"SELECT o_orderkey, {', '.join(f'{day} AS {n}' for n in texts)}, "
                              f"strftime(to_timestamp(CAST({epoch} AS BIGINT)) AT TIME ZONE 'UTC', '%Y-%m-%d') AS epoch FROM orders")
    q["data_summary_texts"] = summary_sql("documents", [("doc_id", "bigint", True), ("text", "string", False), ("lang", "string", False),
                                                         ("source", "string", False), ("n_chars", "bigint", True)])
    q["value_range_long"] = ("SELECT 'big' AS feature_name, 'min -> max: (' || CAST(min(b) AS VARCHAR) || '.000, ' || CAST(max(b) AS VARCHAR) || '.000)' "
                             "AS range_of_features FROM (SELECT o_orderkey + 9007199254740993 AS b FROM orders) x")
    q["value_range"] = f"SELECT feature_name, range_of_features FROM ({profile_sql('lineitem', LINEITEM)}) p"
    qb = binned_long_sql("lineitem", None, ["l_extendedprice", "l_quantity", "l_discount"], [], [])
    q["quantile_bins"] = f"SELECT var, bin_idx, bin_lo, bin_hi, bin, CAST(count(*) AS BIGINT) AS n FROM {qb} b GROUP BY ALL"
    q["iv_verbose"] = iv_orders_verbose()
    q["iv_summary"] = iv_summary_sql(iv_orders_verbose(False))
    q["iv_strength"] = f"SELECT *, {strength('iv')} AS iv_strength FROM ({q['iv_summary']}) s"
    o4 = "(SELECT o_orderstatus, o_totalprice, o_orderpriority, o_custkey FROM orders)"
    q["iv_all"] = iv_summary_sql(iv_verbose_sql(o4, "o_orderstatus", ["o_totalprice", "o_custkey"], [],
                                                ["o_orderpriority"], rnd=False))
    docs = ("(SELECT l.quality, d.lang, d.source, d.n_chars FROM labels l "
            "JOIN documents d ON d.doc_id = l.doc_id)")
    q["iv_documents"] = (f"SELECT *, {strength('iv')} AS iv_strength FROM ("
                         f"{iv_summary_sql(iv_verbose_sql(docs, 'quality', ['n_chars'], [], ['lang', 'source'], rnd=False))}) s")
    q["iv_review"] = describe_sql(f"({iv_orders_verbose(False)})", "var", "iv", "iv_", "iv_count", R)
    verbose = f"({iv_orders_verbose(False)})"
    cnt = "(SELECT CAST(o_orderstatus AS VARCHAR) AS label, CAST(count(*) AS BIGINT) AS count, count(*) >= 100 AS is_significant FROM orders GROUP BY ALL)"
    q["iv_review_label_counts"] = f"SELECT * FROM {cnt} c"
    rates = f"round(neg_rate, {R}) AS neg_rate, round(pos_rate, {R}) AS pos_rate, round(bin_lo, {R}) AS bin_lo, round(bin_hi, {R}) AS bin_hi"
    q["iv_review_adjusted"] = (f"SELECT v.* REPLACE ({rates}, CASE WHEN c.is_significant THEN round(iv, {R}) ELSE 0.0 END AS iv) "
                               f"FROM {verbose} v JOIN {cnt} c USING (label)")
    significant = f"(SELECT v.* FROM {verbose} v JOIN {cnt} c USING (label) WHERE c.is_significant)"
    q["iv_review_describe_significant"] = describe_sql(significant, "var", "iv", "iv_", "iv_count", R)
    q["iv_review_useful"] = f"SELECT * FROM ({q['iv_review_describe_significant']}) d WHERE iv_max > 0.02"
    q["iv_review_high_bins"] = f"SELECT v.* REPLACE ({rates}, round(iv, {R}) AS iv) FROM {verbose} v WHERE iv > 24"
    many = "(SELECT *, o_custkey % 3000 AS lab FROM orders)"
    q["iv_many_labels"] = "SELECT * REPLACE (round(iv, 9) AS iv) FROM (" + iv_summary_sql(iv_verbose_sql(many, "lab", ["o_totalprice"], [], ["o_orderpriority"], rnd=False)) + ") m"
    nulls = ("(SELECT CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS p_brand, CASE WHEN p_size > 5 THEN p_size % 7 END AS size, "
             "CASE WHEN p_size < 40 THEN p_type END AS p_type FROM part)")
    q["iv_nulls"] = iv_verbose_sql(nulls, "p_brand", [], ["size"], ["p_type"])

    q["stratified_sample"] = ("SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus "
                              "ORDER BY md5('111|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) <= 200")
    q["split_by_customer_exact"] = (
        "SELECT o_orderkey, o_custkey, CASE WHEN r <= CAST(floor(n * 0.2 + 0.5) AS BIGINT) THEN 'test' ELSE 'train' END AS split FROM orders JOIN "
        "(SELECT o_custkey AS k, row_number() OVER (ORDER BY md5('33|' || CAST(o_custkey AS VARCHAR))) AS r, count(*) OVER () AS n "
        "FROM (SELECT DISTINCT o_custkey FROM orders) d) c ON k = o_custkey")
    q["split_by_customer"] = f"SELECT o_orderkey, o_custkey, split FROM {order_split()} s"
    q["split_in_time"] = (
        f"SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND "
        f"CAST(o_orderdate AS DATE) < DATE '1999-01-01' THEN CASE WHEN {_md5_bucket(99, 'o_custkey')} < 20 THEN 'test' "
        f"ELSE 'train' END ELSE 'oos' END AS split FROM orders WHERE (CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND "
        f"CAST(o_orderdate AS DATE) < DATE '1999-01-01') OR (CAST(o_orderdate AS DATE) >= DATE '1999-01-01' AND "
        f"CAST(o_orderdate AS DATE) <= DATE '2000-12-31')")
    q["train_test_oos"] = (
        f"WITH s AS ({q['split_in_time'].replace('SELECT o_orderkey, o_custkey, o_orderdate,', 'SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus,', 1)}), "
        f"m AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM "
        f"(SELECT DISTINCT o_orderstatus AS value FROM s WHERE split = 'train' AND o_orderstatus IS NOT NULL) d) "
        f"SELECT s.o_orderkey, s.split, s.o_orderstatus, m.code AS o_orderstatus_idx FROM s JOIN m ON m.value = s.o_orderstatus")
    cov_src = (f"(SELECT o_orderkey, CASE WHEN {_md5_bucket(33, 'o_custkey')} < 2 THEN 'test' ELSE 'train' END AS split, "
               f"CAST(CAST(floor(o_totalprice / 25000) AS INTEGER) AS VARCHAR) AS lab FROM orders)")
    q["cover_labels"] = (
        f"WITH o AS {cov_src}, "
        f"mtr AS (SELECT lab, row_number() OVER (ORDER BY lab) AS i FROM (SELECT DISTINCT lab FROM o WHERE split = 'test' "
        f"AND lab IS NOT NULL EXCEPT SELECT DISTINCT lab FROM o WHERE split = 'train') a), "
        f"mte AS (SELECT lab, row_number() OVER (ORDER BY lab) AS i FROM (SELECT DISTINCT lab FROM o WHERE split = 'train' "
        f"AND lab IS NOT NULL EXCEPT SELECT DISTINCT lab FROM o WHERE split = 'test') a), "
        f"rtr AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS i FROM o WHERE split = 'train'), "
        f"rte AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS i FROM o WHERE split = 'test'), "
        f"rep AS (SELECT rtr.o_orderkey, mtr.lab FROM rtr JOIN mtr USING (i) UNION ALL "
        f"SELECT rte.o_orderkey, mte.lab FROM rte JOIN mte USING (i)) "
        f"SELECT o.o_orderkey, o.split, coalesce(rep.lab, o.lab) AS lab FROM o LEFT JOIN rep USING (o_orderkey)")

    q["label_encode"] = ("SELECT o_orderkey, o_orderstatus, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS BIGINT) "
                         "AS o_orderstatus_idx FROM orders")
    yr = "CAST(year(o_orderdate) AS VARCHAR)"
    q["label_encode_score"] = (
        f"WITH m AS (SELECT yr, CAST(row_number() OVER (ORDER BY yr) - 1 AS BIGINT) AS code FROM "
        f"(SELECT DISTINCT {yr} AS yr FROM orders WHERE {yr} < '1999') d) "
        f"SELECT o.o_orderkey, o.yr, m.code AS yr_idx FROM (SELECT o_orderkey, {yr} AS yr FROM orders) o "
        f"JOIN m USING (yr) WHERE o.yr >= '1998'")
    q["index_categories"] = ("SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand, "
                             "CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type FROM part")

    def cat_map(col, where):
        return (f"(SELECT value, code, k FROM (SELECT {col} AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 "
                f"AS BIGINT) AS code, count(*) OVER () AS k FROM part WHERE {col} IS NOT NULL {where} GROUP BY {col}) x)")

    def cat_apply(where_fit, where_score):
        bm, tm = cat_map("p_brand", where_fit), cat_map("p_type", where_fit)
        return (f"SELECT p.p_partkey, CAST(coalesce((SELECT code FROM {bm} b WHERE b.value = p.p_brand AND b.code < b.k - 1), "
                f"(SELECT max(k) - 1 FROM {bm} b2)) AS BIGINT) AS p_brand, "
                f"CAST(coalesce((SELECT code FROM {tm} t WHERE t.value = p.p_type AND t.code < t.k - 1), "
                f"(SELECT max(k) - 1 FROM {tm} t2)) AS BIGINT) AS p_type FROM part p {where_score}")
    named = ("(SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'least_perc' WHEN p_size > 2 THEN p_brand END AS brand, p_type, "
             "CAST(p_size AS VARCHAR) AS size FROM part)")
    ranks = "(SELECT {0} AS v, row_number() OVER (ORDER BY count(*) DESC, {0}) - 1 AS c, count(*) OVER () AS k FROM " + named + " x WHERE {0} IS NOT NULL GROUP BY {0})"
    q["encode_named_like_the_rest"] = "SELECT p_partkey, " + ", ".join(
        f"CAST(coalesce({c}_m.c, (SELECT max(k) - 1 FROM {ranks.format(c)} r)) AS BIGINT) AS {c}" for c in ("brand", "p_type", "size")) + f" FROM {named} p " + " ".join(
        f"LEFT JOIN {ranks.format(c)} {c}_m ON {c}_m.v = p.{c}" for c in ("brand", "p_type", "size"))
    half = "(SELECT {0} AS v, CAST(dense_rank() OVER (ORDER BY {0}) - 1 AS BIGINT) AS c FROM (SELECT DISTINCT {0} FROM part WHERE p_partkey % 2 = 0 AND {0} IS NOT NULL) d)"
    q["lookup_maps"] = ("SELECT p_partkey, p_brand, p_type, b.c AS p_brand_code, t.c AS p_type_code FROM part "
                        f"LEFT JOIN {half.format('p_brand')} b ON b.v = p_brand LEFT JOIN {half.format('p_type')} t ON t.v = p_type")
    q["encode_categories_train"] = cat_apply("", "")
    q["encode_categories_score"] = (cat_apply("AND p_size <= 25", "WHERE p.p_size > 25")
                                    .replace("SELECT p.p_partkey,", "SELECT p.p_partkey, p.p_size,", 1))

    # the saved map of the retraining: the same codes
    q["encode_categories_retrain"] = q["encode_categories_score"]
    q["lookup_map"] = ("WITH m AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM "
                       "(SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' "
                       "AND o_orderpriority IS NOT NULL) d) "
                       "SELECT o.o_orderkey, o.o_orderpriority, m.code AS o_orderpriority_code FROM orders o "
                       "LEFT JOIN m ON m.value = o.o_orderpriority")
    q["label_dataset"] = (f"SELECT l.user_id, l.\"date\", array_to_string(l.lst, '|') AS next_7_day_labels, "
                          f"unnest(l.lst) AS label, c.c_custkey, c.c_nationkey FROM {lookahead_sql(0, 8)} l "
                          f"JOIN customer c ON l.user_id = c.c_custkey")
    hp = history_pivot_sql("WHERE ts >= TIMESTAMP '2023-11-11' AND ts < TIMESTAMP '2024-01-31'")
    q["interaction_features"] = f"SELECT l.*, h.* EXCLUDE (user_id, \"date\") FROM {LABELS} l JOIN {hp} h USING (user_id, \"date\")"
    q["transaction_features"] = (f"SELECT l.user_id, l.\"date\", l.label, CAST(f.n_events AS BIGINT) AS n_events, f.total_value "
                                 f"FROM {LABELS} l JOIN {daily_facts_sql()} f ON f.user_id = l.user_id AND f.as_of_dt + 1 = l.\"date\"")
    q["prepare_features"] = (f"SELECT o_orderkey, o_totalprice, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) "
                             f"AS o_orderpriority, month_idx, week_idx FROM {mo} m")
    imp = (f"(SELECT var AS feature, round(sum(iv), {R}) AS gain_importance, CAST(count(DISTINCT bin) AS BIGINT) AS split_importance "
           f"FROM ({iv_verbose_sql('orders', 'o_orderstatus', ['o_totalprice'], [], ['o_orderpriority'], rnd=False)}) v GROUP BY var)")
    q["feature_report"] = (
        f"WITH s AS ({summary_sql('orders', ORDERS)}), "
        f"fi AS (SELECT *, CAST(row_number() OVER (ORDER BY gain_importance DESC, feature) - 1 < 1 AS INTEGER) AS flag FROM {imp} i) "
        f"SELECT s.var, CAST(fi.gain_importance IS NOT NULL AS INTEGER) AS used_as_model_input, fi.flag AS is_model_selected_flag, "
        f"concat_ws(', ', CASE WHEN s.missing_rate = 1 THEN 'missing_rate==1' END, CASE WHEN s.zero_rate = 1 THEN 'zero_rate==1' END, "
        f"CASE WHEN s.num_unique = 1 THEN 'cardinality==1' END, CASE WHEN fi.flag = 1 THEN 'is model selected' END, "
        f"CASE WHEN fi.flag = 0 THEN 'is not model selected' END, "
        f"CASE WHEN s.var IN ('o_orderkey', 'o_custkey') THEN 'is primary key' END, "
        f"CASE WHEN s.var IN ('o_orderdate', 'month', 'week', 'month_idx', 'week_idx') THEN 'is date key' END, "
        f"CASE WHEN s.var = 'o_orderstatus' THEN 'is label' END) AS remarks, fi.gain_importance, fi.split_importance, "
        f"CASE WHEN fi.gain_importance IS NULL THEN 'NA:dropped_from_model_input' END AS status "
        f"FROM s LEFT JOIN fi ON s.var = fi.feature")
    sc = ("(SELECT CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS y, "
          "o_totalprice / 500000 AS p0, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) / 5 AS p1, "
          "CAST(dayofyear(o_orderdate) AS DOUBLE) / 366 AS p2 FROM orders)")
    pairs = []
    for i, j in [(0, 1), (0, 2), (1, 2)]:
        pairs.append(f"SELECT {i} AS ci, {j} AS cj, p{i} - p{j} AS s, y = {i} AS is_i FROM {sc} z WHERE y IN ({i}, {j})")
    q["auc_mu"] = (
        f"WITH l AS ({' UNION ALL '.join(pairs)}), "
        f"c AS (SELECT ci, cj, s, count(*) FILTER (WHERE is_i) AS ni, count(*) FILTER (WHERE NOT is_i) AS nj FROM l GROUP BY ALL), "
        f"r AS (SELECT *, sum(nj) OVER (PARTITION BY ci, cj ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_nj FROM c) "
        f"SELECT CAST(ci AS INTEGER) AS ci, CAST(cj AS INTEGER) AS cj, round(sum(ni * (cum_nj - nj + nj * 0.5)) / (sum(ni) * sum(nj)), {R}) AS auc, "
        f"CAST(sum(ni) AS BIGINT) AS n_i, CAST(sum(nj) AS BIGINT) AS n_j FROM r GROUP BY ci, cj")
    q["auc_mu_mean"] = (f"SELECT round(avg(auc), {R}) AS auc_mu, CAST(count(*) AS BIGINT) AS pairs FROM "
                        f"({q['auc_mu'].replace(f'round(sum(ni * (cum_nj - nj + nj * 0.5)) / (sum(ni) * sum(nj)), {R})', 'sum(ni * (cum_nj - nj + nj * 0.5)) / (sum(ni) * sum(nj))')}) a")
    prepared = periods_sql("orders", "o_orderdate")
    classes = f"(SELECT count(DISTINCT o_orderstatus) FROM {prepared} p)"
    columns = "(SELECT count(*) + 4 FROM (DESCRIBE orders))"
    one = "SELECT 'section' AS part, '{}' AS key, CAST({} AS BIGINT) AS n"
    split_of = f"(SELECT *, CASE WHEN {_md5_bucket(33, 'o_custkey')} < 20 THEN 'test' ELSE 'train' END AS split FROM {prepared} p)"
    q["saved_split_counts"] = split_counts_sql(split_of, prepared)
    q["saved_label_distribution"] = q["label_distribution"].replace(order_split(), split_of)
    q["model_run"] = (
        f"SELECT 'scored' AS part, CAST(c AS VARCHAR) AS key, CAST(count(*) AS BIGINT) AS n FROM (SELECT dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS c, "
        f"{_md5_bucket(33, 'o_custkey')} < 20 AS test FROM {prepared} p) x WHERE test GROUP BY c "
        f"UNION ALL SELECT 'iterations', CAST(i AS VARCHAR), CAST(20 AS BIGINT) FROM (SELECT unnest(range({classes})) AS i) y "
        f"UNION ALL SELECT 'auc', 'pairs', CAST({classes} * ({classes} - 1) / 2 AS BIGINT) UNION ALL "
        + " UNION ALL ".join(one.format(k, v) for k, v in (
            ("data_summary", columns), ("train_test_count", 3), ("label_dist", classes), ("learning_details", f"20 * {classes}"),
            ("feature_selection_report", columns))))
    # DATE columns as ISO text at the comparison edge (same on the Spark side)
    for k in DATE_COLUMN_QUERIES:
        q[k] = f'SELECT * REPLACE (CAST("date" AS VARCHAR) AS "date") FROM ({q[k]}) _o'
    return q
