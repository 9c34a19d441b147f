"""Latest row per key and exact de-duplication as partial aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one_row(df: DataFrame, keys: Sequence[str], pick: Column) -> DataFrame:
    chosen = df.groupBy(*keys).agg(pick.alias("_row"))
    rest = [c for c in df.columns if c not in keys]
    return chosen.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*df.columns)


def _payload(df: DataFrame, keys: Sequence[str], lead: Sequence[str]) -> Column:
    rest = [c for c in df.columns if c not in keys and c not in lead]
    return F.struct(*lead, *rest)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the largest ``order_by`` values per key.

    An aggregation rather than a window: each task first reduces its rows to
    one per key, so a key holding most of the table costs no more than others.
    Ties on ``order_by`` fall to the largest remaining columns, so the result
    does not depend on the row order.
    """
    return _one_row(df, keys, F.max(_payload(df, keys, order_by)))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order_by`` values per key; see ``latest_per_key``."""
    return _one_row(df, keys, F.min(_payload(df, keys, order_by)))
