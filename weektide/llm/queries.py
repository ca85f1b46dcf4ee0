"""All named queries of the text operators."""

from weektide.llm import (  # noqa: F401  (importing registers)
    q_centroids,
    q_decontam,
    q_fingerprint,
    q_html,
    q_jaccard,
    q_langid,
    q_packing,
    q_pii,
    q_secretscan,
    q_suffixdedup,
    q_tokencount,
    q_warc,
    q_whitening,
)
from weektide.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
