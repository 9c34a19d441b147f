"""Helpers that shape a plan without changing its result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a costly column such that later filters on it do not compute it again.

    A filter on a projected column is pushed below the projection together with
    a copy of its expression, so parsing a text and keeping the rows that parse
    would parse twice. Unfolding a one-element array keeps the filter above.
    """
    return df.select("*", F.inline(F.array(F.struct(expression.alias(name)))))
