"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

_OP8 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM (SELECT doc_id, host, unnest(ls) AS l FROM w)
), hosts AS (
  SELECT host, count(DISTINCT doc_id) AS host_docs FROM d GROUP BY host
), common AS (
  SELECT host, line FROM (SELECT host, line, count(DISTINCT doc_id) AS c FROM lines GROUP BY ALL) JOIN hosts USING (host)
  WHERE c > 20 AND c > 0.1 * host_docs
), removed AS (
  SELECT doc_id, sum(len(string_split(line, ' '))) AS n FROM lines SEMI JOIN common USING (host, line) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
       CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
       CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
       len(ws) < 20 OR 100 * coalesce(covered.n, 0) > 30 * len(ws) AS base_failed,
       CAST(coalesce(removed.n, 0) AS BIGINT) AS n_boilerplate_words,
       NOT (len(ws) < 20 OR 100 * coalesce(covered.n, 0) > 30 * len(ws))
         AND len(ws) - coalesce(removed.n, 0) >= 0.3 * len(ws) AS kept
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

_OP3 = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+19], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id
), words AS (
  SELECT w.doc_id, ws, coalesce(ps, []) AS ps FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ps) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(ps, i)), ' '), '')) AS kept_sha256
FROM words
"""

_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_OP5 = rf"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, ws, least(10, len(ws)) AS n
  FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0
), phrases AS (
  SELECT DISTINCT item, n, array_to_string(ws[i:i+n-1], ' ') AS g
  FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM b)
), grams AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i+n-1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b))
), found AS (
  SELECT doc_id, item, i, n FROM grams JOIN phrases USING (n, g)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _floor_div(a: str, b: str) -> str:
    """floor(a / b) of whole numbers, b > 0, exactly."""
    return f"(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


_WHOLE = "len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64"


def _op12(k: int = 8, rounds: int = 10) -> str:
    """Every round as two tables: the clusters of all vectors, the centroids that follow."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_WHOLE}
), x AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS p, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h, v LIMIT {k})
)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""m{i} AS MATERIALIZED (SELECT c, unnest(range(1, 65)) AS p, unnest(v) AS m FROM c{i}),
a{i} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT r, c, CAST(sum((x - m) * (x - m)) AS BIGINT) AS d FROM x JOIN m{i} USING (p) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)"""
        )
        if i < rounds:
            mean = _floor_div("s", "n")
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(w, v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(CAST({mean} AS BIGINT) ORDER BY p) AS w
    FROM (SELECT c, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY c, p) GROUP BY c
  ) USING (c)
)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} USING (c)
"""
    )


def _op13(entries: int = 16, rounds: int = 6) -> str:
    """Every round rescans all entries."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_WHOLE}
), x AS MATERIALIZED (SELECT r, (p - 1) // 8 AS part, (p - 1) % 8 AS q, x FROM (SELECT r, unnest(range(1, 65)) AS p, unnest(v) AS x FROM kept)),
b0 AS MATERIALIZED (
  SELECT e, (p - 1) // 8 AS part, (p - 1) % 8 AS q, m FROM (
    SELECT e, unnest(range(1, 65)) AS p, unnest(v) AS m
    FROM (SELECT row_number() OVER (ORDER BY vec_id, v) - 1 AS e, v FROM (SELECT vec_id, v FROM kept ORDER BY vec_id, v LIMIT {entries}))
  )
)"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, part, e, d FROM (
    SELECT r, part, e, CAST(sum((x - m) * (x - m)) AS BIGINT) AS d FROM x JOIN b{i} USING (part, q) GROUP BY r, part, e
  ) QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, e) = 1
)"""
        )
        if i < rounds:
            mean = _floor_div("s", "n")
            steps.append(
                f"""b{i + 1} AS MATERIALIZED (
  SELECT e, part, q, coalesce(CAST({mean} AS BIGINT), m) AS m FROM b{i} LEFT JOIN (
    SELECT part, e, q, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{i} JOIN x USING (r, part) GROUP BY part, e, q
  ) USING (part, e, q)
)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY part, e, q)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""
    )


def oracle_sql() -> dict[str, str]:
    return {
        "op3_substring_dedup": _OP3,
        "op5_decontamination": _OP5,
        "op8_quality_rules": _OP8,
        "op12_lookup_clusters": _op12(),
        "op13_part_codes": _op13(),
    }
