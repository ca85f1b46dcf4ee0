"""Right-closed banding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def band_number(col: Column, edges: list[float]) -> Column:
    """1-based number of the band ``(edge[i], edge[i+1]]``; NULL outside all bands."""
    value = col.cast("double")
    expr = None
    for i, (low, high) in enumerate(zip(edges, edges[1:]), start=1):
        inside = (value > F.lit(float(low))) & (value <= F.lit(float(high)))
        expr = F.when(inside, i) if expr is None else expr.when(inside, i)
    return expr
