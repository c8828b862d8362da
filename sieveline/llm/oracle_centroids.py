"""The clustering of ``centroids.cluster`` in DuckDB SQL, round by round over all
vectors."""

from __future__ import annotations

from sieveline.llm.centroids import CLUSTERS, ROUNDS, SCALE, SEED, WIDTH

_FAR = "list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(k.x, c.x)])"


def _round(n: int) -> str:
    """Assignment to the centroids ``c{n}``, and ``c{n + 1}`` from it."""
    return f"""
far{n} AS (SELECT k.rid, k.vec_id, k.x, c.c, {_FAR} AS d FROM k CROSS JOIN c{n} AS c),
a{n} AS (SELECT rid, vec_id, x, c, d FROM far{n} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1),
s{n} AS (
  SELECT c, i, sum(v) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS v, unnest(range(1, {WIDTH + 1})) AS i FROM a{n}) GROUP BY c, i),
m{n} AS (SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY i) AS x FROM s{n} GROUP BY c),
c{n + 1} AS (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{n} AS c LEFT JOIN m{n} AS m ON c.c = m.c)"""


CENTROIDS = f"""
WITH k AS (
  SELECT row_number() OVER () AS rid, vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS x
  FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {WIDTH}),
c0 AS (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x
  FROM (SELECT sha256('{SEED}:' || vec_id) AS h, x FROM k WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {CLUSTERS})),
{",".join(_round(n) for n in range(ROUNDS + 1))},
i AS (SELECT c, sum(d) AS s FROM a{ROUNDS} GROUP BY c)
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance, CAST(i.s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(s) FROM i) AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} AS a JOIN i ON a.c = i.c JOIN c{ROUNDS} AS c ON a.c = c.c"""
