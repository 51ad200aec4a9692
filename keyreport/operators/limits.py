"""Limits: a stable first-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order_by``: a top-n sort (each task keeps its n
    best, the driver merges n per task), not a full sort."""
    return df.orderBy(*order_by).limit(n)
