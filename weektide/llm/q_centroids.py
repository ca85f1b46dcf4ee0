"""Query op12: clusters of all embeddings, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.centroids import CENTROIDS, DIMS, ROUNDS, SCALE, SEED, cluster, with_inertia
from weektide.llm.registry import query, read


def _assign(k: int) -> str:
    """Every vector's nearest centroid of round ``k``."""
    return f"""a{k} AS MATERIALIZED (
    SELECT r, c AS cluster, dist FROM (
        SELECT r, c, dist, row_number() OVER (PARTITION BY r ORDER BY dist, c) AS nth FROM (
            SELECT x.r, m.c, sum((x.v - m.v) * (x.v - m.v))::BIGINT AS dist
            FROM x JOIN c{k} m USING (d) GROUP BY x.r, m.c
        )
    ) WHERE nth = 1
)"""


def _move(k: int) -> str:
    """The centroids after round ``k``: floors of the means, empty ones as before."""
    return f"""c{k + 1} AS MATERIALIZED (
    SELECT c, d, coalesce((s - ((s % n) + n) % n) // n, v)::BIGINT AS v FROM c{k} LEFT JOIN (
        SELECT a.cluster AS c, x.d, sum(x.v) AS s, count(*) AS n
        FROM a{k} a JOIN x USING (r) GROUP BY a.cluster, x.d
    ) USING (c, d)
)"""


_ROUNDS = ", ".join(f"{_assign(k)}, {_move(k)}" for k in range(ROUNDS))

SQL = f"""
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
), kept AS (
    SELECT * FROM rows WHERE len(embedding) = {DIMS} AND len(list_filter(embedding,
        lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0
), x AS MATERIALIZED (
    SELECT r, unnest(range({DIMS})) AS d,
        floor({SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS v FROM kept
), first AS (
    SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, ''))) - 1 AS c
    FROM kept
), c0 AS MATERIALIZED (
    SELECT f.c, x.d, x.v FROM first f JOIN x USING (r) WHERE f.c < {CENTROIDS}
), {_ROUNDS}, {_assign(ROUNDS)}, told AS (
    SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY d)) AS sha FROM c{ROUNDS} GROUP BY c
)
SELECT vec_id, cluster::INTEGER AS cluster, dist AS distance,
    (sum(dist) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
    (sum(dist) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (r) JOIN told ON c = cluster
"""


@query("op12_centroids", SQL)
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The cluster of every embedding."""
    return with_inertia(*cluster(read(spark, folder, "embeddings"), "vec_id", "embedding"))
