"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str, text: str) -> str:
    """(key, s): the distinct runs of five words; a shorter text is one run."""
    words = f"(SELECT {key}, regexp_extract_all({text}, {_WORD}) AS w FROM {table} WHERE {text} IS NOT NULL)"
    return (f"(SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN "
            f"list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) "
            f"WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM {words} x)")


def _components(links: str, ids: str, key: str) -> str:
    """(key, n_links, component) from a table of directed links (a, b)."""
    return (f"reach(a, b) AS (SELECT a, b FROM {links} UNION SELECT r.a, l.b FROM reach r JOIN {links} l ON l.a = r.b), "
            f"low AS (SELECT a, min(b) AS m FROM reach GROUP BY a), "
            f"deg AS (SELECT a, count(*) AS n FROM {links} GROUP BY a), "
            f"out AS (SELECT i.{key}, CAST(coalesce(deg.n, 0) AS BIGINT) AS n_links, least(i.{key}, coalesce(low.m, i.{key})) AS component "
            f"FROM {ids} i LEFT JOIN deg ON deg.a = i.{key} LEFT JOIN low ON low.a = i.{key})")


def oracle_sql() -> dict[str, str]:
    q = {}
    q["op2_embedding_neardup"] = (
        "WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings "
        "WHERE label IS NOT NULL AND embedding IS NOT NULL), "
        "u AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS n FROM v), "
        "links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.vec_id <> y.vec_id "
        "WHERE x.n > 0 AND y.n > 0 AND list_inner_product(x.e, y.e) / (x.n * y.n) >= 0.93), "
        + _components("links", "embeddings", "vec_id")
        + " SELECT vec_id, n_links, component AS component_id, vec_id = component AS kept FROM out")
    q["op3_ngram_join"] = (
        f"WITH RECURSIVE sh AS {_shingles('documents', 'doc_id', 'text')}, "
        "n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id), "
        "both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2), "
        "links AS (SELECT a, b FROM both_ JOIN n p ON p.doc_id = a JOIN n r ON r.doc_id = b WHERE c * 1.8 >= 0.8 * (p.n + r.n) - 1e-9), "
        + _components("links", "documents", "doc_id")
        + " SELECT out.doc_id, component AS class_id, n_links, CAST(coalesce(n.n, 0) AS BIGINT) AS size FROM out LEFT JOIN n USING (doc_id)")
    q["op4_decontaminate"] = (
        f"WITH d AS {_shingles('documents', 'doc_id', _LOWER)}, i AS {_shingles('benchmark', 'item_id', _LOWER)}, "
        "n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id) "
        "SELECT doc_id, item_id, count(*) / max(n) AS containment, CAST(count(*) AS BIGINT) AS n_shared, CAST(max(n) AS BIGINT) AS n_item "
        "FROM d JOIN i USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * max(n) - 1e-9")
    q["op7_mix_sources"] = (
        f"WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {_WORD})), 0) AS BIGINT) AS size FROM documents), "
        "s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source), "
        "r AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM s), "
        "w AS (SELECT *, ([5, 2, 1])[rank % 3 + 1] AS weight, 3 * source_size AS most FROM r), "
        "t AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) "
        "/ CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS try_level FROM w WINDOW o AS (ORDER BY most / weight, rank)), "
        "g AS (SELECT source, source_size, least(CAST(most AS DOUBLE), "
        "(SELECT max(try_level) FROM t WHERE try_level * weight <= most) * weight) AS target FROM t), "
        "c AS (SELECT d.doc_id, d.source, d.size, g.source_size, g.target, "
        "CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS copies FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source), "
        "p AS (SELECT *, CAST(floor(copies) AS BIGINT) AS whole, copies - floor(copies) AS p, "
        "(('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM c), "
        "need AS (SELECT source, any_value(target) - sum(whole * size) AS need FROM p GROUP BY source), "
        "k AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY u / (1 - u) / (p / (1 - p)), doc_id, size "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto FROM p WHERE p > 0 AND size > 0), "
        "x AS (SELECT k.*, upto - size < need AND upto - need <= need - (upto - size) AS drawn FROM k JOIN need n ON k.source IS NOT DISTINCT FROM n.source) "
        "SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN drawn THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM x "
        "UNION ALL SELECT doc_id, size, source_size, target, whole * size FROM p WHERE NOT (p > 0 AND size > 0)")
    q["op11_hard_negatives"] = (
        "WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, "
        "list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x FROM embeddings "
        "WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0), "
        "s AS (SELECT a.vec_id AS anchor, a.label = r.label AS same, r.vec_id AS id, CAST(list_inner_product(a.x, r.x) AS BIGINT) AS score "
        "FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0), "
        "p AS (SELECT anchor, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5), "
        "n AS (SELECT p.anchor AS anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score, "
        "CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank "
        "FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score) "
        "SELECT * FROM n WHERE rank <= 5")
    return q
