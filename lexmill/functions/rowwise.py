"""Evaluating expensive row-local expressions exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    Plain projections are merged and filters are pushed through them, which copies an expensive
    expression into every place that uses it. A generator over a one-element array keeps it in
    place.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
