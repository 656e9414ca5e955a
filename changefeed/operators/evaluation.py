"""Evaluate an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add column ``name`` = ``expr``, evaluated exactly once per row.

    A one-element explode is a Generate, and filters that read ``name``
    stay above it.  With a plain projection Catalyst inlines ``expr`` into
    a pushed-down filter, so an expensive expression (a JSON parse or
    render) would run once per reference there and once more in the
    projection.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))
