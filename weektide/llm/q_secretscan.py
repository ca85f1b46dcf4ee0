"""Query op11: secrets in every document, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.llm import secretscan as S
from weektide.llm.registry import query, read

_LIMITS = {k: S.most_weight(bits) for k, bits in S.LEAST_BITS.items()}
_SHAPES = "|".join(S.ALLOWED_SHAPES)
_WORDS = " ".join(f"AND NOT contains(lower(secret), '{w}')" for w in S.ALLOWED_WORDS)
_QUOTED = {k: p.replace("'", "''") for k, p in {
    "assign": S.ASSIGN, "access": S.ACCESS, "hex": S.HEX, "entropy": S.candidates(),
}.items()}
_FOUND = " UNION ALL ".join(
    f"SELECT r, t, {k} AS rank, regexp_extract_all(t, '{_QUOTED[kind]}', 0) AS m, "
    f"string_split_regex(t, '{_QUOTED[kind]}') AS g FROM d"
    for k, kind in enumerate(S.KINDS)
)

SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({_FOUND}), one AS (
    SELECT r, rank, unnest(m) AS m, unnest(g[1:len(m)]) AS g, unnest(range(len(m))) AS i
    FROM found WHERE len(m) > 0
), placed AS (
    SELECT r, rank, m, sum(length(g) + length(m)) OVER (PARTITION BY r, rank ORDER BY i) AS e
    FROM one
), base AS (
    SELECT r, rank, (e - length(m))::BIGINT AS s, e::BIGINT AS e FROM placed
    WHERE rank < 3 AND (rank > 0 OR length(regexp_extract(m, '{_QUOTED["assign"]}', 2)) >= {S.LEAST_VALUE})
), windows AS (
    SELECT r, (e - length(m))::BIGINT AS origin, m, unnest(range(length(m) - {S.WINDOW - 1})) AS p
    FROM placed WHERE rank = 3 AND NOT regexp_full_match(m, '{_SHAPES}')
), signs AS (
    SELECT r, origin, m, p, unnest(string_split(substr(m, p + 1, {S.WINDOW}), '')) AS c FROM windows
), counted AS (
    SELECT r, origin, m, p, c, count(*) AS n FROM signs GROUP BY r, origin, m, p, c
), measured AS (
    SELECT r, origin, m, p, sum(round(n * log2(n) * {S.UNIT})::BIGINT) AS f,
        sum(CASE WHEN regexp_matches(c, '[A-Z]') THEN n ELSE 0 END) AS up,
        sum(CASE WHEN regexp_matches(c, '[a-z]') THEN n ELSE 0 END) AS low,
        sum(CASE WHEN regexp_matches(c, '[0-9]') THEN n ELSE 0 END) AS dig,
        sum(CASE WHEN regexp_matches(c, '[^0-9A-Za-z]') THEN n ELSE 0 END) AS sign,
        sum(CASE WHEN regexp_matches(c, '[0-9A-Fa-f]') THEN 0 ELSE n END) AS other
    FROM counted GROUP BY r, origin, m, p
), high AS (
    SELECT r, origin, m, p, CASE
        WHEN p > lag(p) OVER (PARTITION BY r, origin ORDER BY p) + {S.WINDOW} THEN 1 ELSE 0 END AS new
    FROM measured WHERE CASE
        WHEN other = 0 THEN dig >= 3 AND up + low >= 3 AND f <= {_LIMITS["hex"]}
        WHEN sign = 0 AND (up = 0 OR low = 0) THEN dig >= 3 AND up + low >= 3 AND f <= {_LIMITS["alnum"]}
        ELSE sign <= 2 AND dig >= 2 AND up >= 2 AND low >= 2 AND f <= {_LIMITS["mixed"]} END
), islands AS (
    SELECT *, sum(new) OVER (PARTITION BY r, origin ORDER BY p) AS k FROM high
), spans AS (
    SELECT r, origin, min(p) AS s, max(p) + {S.WINDOW} AS e,
        substr(any_value(m), min(p) + 1, max(p) + {S.WINDOW} - min(p)) AS secret
    FROM islands GROUP BY r, origin, k
), every AS (
    SELECT * FROM base
    UNION ALL SELECT r, 3, origin + s, origin + e FROM spans WHERE true {_WORDS}
), told AS (
    SELECT r, rank, s, e,
        ['assign', 'access', 'hex', 'entropy'][rank + 1] || ':' || s || ':' || e AS told FROM every
), texts AS (
    SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
        count(*) FILTER (rank = 2) AS n_hex,
        string_agg(told, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
        string_agg(told, ',' ORDER BY s, rank) AS spans
    FROM told GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM d LEFT JOIN texts USING (r)
"""


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    def told(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
        )))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )


@query("op11_secretscan", SQL)
def op11_secretscan(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of secrets in all documents."""
    return digest(S.scan(read(spark, folder, "documents"), "doc_id", "text"))
