"""SQL for words and word shingles, as DuckDB says it."""

from __future__ import annotations


def shingles(table: str, key: str) -> str:
    """A query for the distinct rows ``id, s``: five-word shingles of every text, or the
    whole sequence where a text has fewer words."""
    return f"""
  SELECT DISTINCT id, s FROM (
    SELECT id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE
      [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM (SELECT {key} AS id, regexp_extract_all(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') AS w FROM {table}) WHERE len(w) > 0)"""
