"""Checks on vector columns that the vector operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither NULL nor empty, and every component a finite number."""
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))
