"""The operators on whole-number vectors in DuckDB SQL: every round is a pair of table expressions."""

from __future__ import annotations

from . import codes, va_clustering

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _floor(total: str, count: str) -> str:
    """``total / count`` rounded down, for whole numbers of either sign."""
    return f"CAST(({total} - (({total} % {count}) + {count}) % {count}) // {count} AS BIGINT)"


def _rounds(count: int, group: str) -> str:
    """``a0, c1, a1, ..., c<count>, a<count>``: assignments of ``n`` to the centres ``c0``, and what they become."""
    keys = f"{group}, k" if group else "k"
    parts = []
    for t in range(count + 1):
        near = f"r, {keys}"
        by = f"r, {group}" if group else "r"
        parts.append(f"""a{t} AS MATERIALIZED (
          SELECT {near}, distance FROM (
            SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY distance, k) AS place FROM (
              SELECT {near}, CAST(sum((x - y) * (x - y)) AS BIGINT) AS distance FROM n JOIN c{t} USING (d) GROUP BY {near}
            )
          ) WHERE place = 1
        )""")
        if t < count:
            parts.append(f"""s{t} AS (
          SELECT k, d, sum(x) AS total, count(*) AS rows
          FROM n JOIN a{t} USING (r{', ' + group if group else ''}) GROUP BY k, d
        ), c{t + 1} AS MATERIALIZED (
          SELECT c.k, c.d, CASE WHEN rows IS NULL THEN y ELSE {_floor('total', 'rows')} END AS y
          FROM c{t} c LEFT JOIN s{t} s ON s.k = c.k AND s.d = c.d
        )""")
    return ", ".join(parts)


def _numbers(where: str, scale: int, part: str, columns: str = "") -> str:
    """``v`` numbers the vectors, ``n`` holds a row per number, ``p`` its part."""
    return f"""v AS MATERIALIZED (
          SELECT row_number() OVER () AS r, vec_id{columns}, embedding FROM embeddings WHERE {where} AND {_FINITE}
        ), n AS MATERIALIZED (
          SELECT r, d{part}, CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) AS x
          FROM (SELECT r, unnest(embedding) AS x, unnest(range(len(embedding))) AS d FROM v)
        )"""


def compressed() -> str:
    length = f"""(SELECT len(embedding) FROM embeddings WHERE len(embedding) > 0 AND len(embedding) % {codes.PARTS} = 0
                  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""
    last = codes.ROUNDS
    return f"""
        WITH {_numbers(f"len(embedding) = {length}", codes.SCALE, f", d // ({length} // {codes.PARTS}) AS p", ", label")},
        c0 AS (
          SELECT k, d, x AS y FROM n JOIN (
            SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v WHERE vec_id IS NOT NULL
          ) USING (r) WHERE k < {codes.ENTRIES}
        ), {_rounds(last, 'p')}, coded AS (
          SELECT r, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(distance) AS BIGINT) AS error
          FROM a{last} GROUP BY r
        ), books AS (
          SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, k, d)) AS codebooks_sha256
          FROM c{last} JOIN (SELECT DISTINCT d, p FROM n) USING (d)
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM coded JOIN v USING (r) CROSS JOIN books"""


def clustered() -> str:
    last = va_clustering.ROUNDS
    return f"""
        WITH {_numbers(f"len(embedding) = {va_clustering.LENGTH}", va_clustering.SCALE, "")},
        c0 AS (
          SELECT k, d, x AS y FROM n JOIN (
            SELECT r, row_number() OVER (ORDER BY sha256('{va_clustering.SEED_PREFIX}' || vec_id) NULLS LAST) - 1 AS k FROM v
          ) USING (r) WHERE k < {va_clustering.CENTROIDS}
        ), {_rounds(last, '')}, centres AS (
          SELECT k, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY k
        )
        SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{last} JOIN v USING (r) JOIN centres USING (k)"""
