"""Neighbouring-row operators over long ordered histories.

A plain window over one taxi or one zone puts that key's whole history into a
single task. Here every key is cut into time chunks: rows look around inside
their chunk, and what a chunk needs from the others is carried over from a
summary with one row per (key, chunk), built with partial aggregation. The
summary is the only thing ever windowed by the bare key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabstream.session import work_folder

CHUNK = "_chunk"
RANGE = "_range"
DEFAULT_CHUNK_SECONDS = 3600


def time_chunk(epoch_s: Column | str, seconds: int = DEFAULT_CHUNK_SECONDS) -> Column:
    """Number of the time chunk an epoch second falls into."""
    epoch_s = F.col(epoch_s) if isinstance(epoch_s, str) else epoch_s
    return F.floor(epoch_s / seconds)


def range_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Rows with a chunk number (column ``_range``) that grows with ``order`` within each key.

    The table is cut by row count, not by time: it is sorted into ranges of
    (keys, order) of about equal size, so neither a busy key nor a bulk load
    that arrived in one second makes a large chunk. The numbers are written to
    shared storage with the rows, since ranges drawn anew would differ.
    """
    spark = df.sparkSession
    number = chunks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = work_folder(spark, "range-chunks")
    cut = df.repartitionByRange(number, *keys, *order).withColumn(RANGE, F.spark_partition_id())
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def even_chunks(df: DataFrame, column: str, chunks: int | None = None, least: int = 100_000) -> Column | None:
    """A chunk number that cuts a whole-number column into equal steps, or None if one step would hold too many rows.

    Two small aggregations look at the column first: its ends, then the rows of
    each step. Up to four times the mean, or ``least`` rows, are fine for one task.
    """
    number = chunks or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    if low is None:
        return F.lit(0)
    step = F.floor((F.col(column) - low) / max(1, -(-(high - low + 1) // number)))
    fullest = df.groupBy(step.alias("s")).count().agg(F.max("count")).first()[0]
    return F.coalesce(step, F.lit(-1)) if fullest <= max(least, 4 * rows // number) else None


def _with_carry(rows: DataFrame, summary: DataFrame, keys: Sequence[str],
                carry: Column) -> DataFrame:
    carried = summary.select(*keys, CHUNK, carry.alias("_carry"))
    return rows.join(carried, [*keys, CHUNK], "left")


def _neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
               values: Sequence[str], name: str, forward: bool) -> DataFrame:
    base = df.withColumn(CHUNK, chunk)
    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    by_key = Window.partitionBy(*keys).orderBy(CHUNK)
    payload, rank = F.struct(*values), F.struct(*order)
    step = F.lead if forward else F.lag
    edge = F.min_by(payload, rank) if forward else F.max_by(payload, rank)
    rows = base.withColumn("_near", step(payload).over(in_chunk))
    summary = base.groupBy(*keys, CHUNK).agg(edge.alias("_edge"))
    joined = _with_carry(rows, summary, keys, step("_edge").over(by_key))
    return joined.withColumn(name, F.coalesce("_near", "_carry")).drop("_near", "_carry", CHUNK)


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                 values: Sequence[str], name: str = "prev") -> DataFrame:
    """Add struct ``name`` with ``values`` of the preceding row of the key (null at the start)."""
    return _neighbour(df, keys, order, chunk, values, name, forward=False)


def next_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
             values: Sequence[str], name: str = "next") -> DataFrame:
    """Add struct ``name`` with ``values`` of the following row of the key (null at the end)."""
    return _neighbour(df, keys, order, chunk, values, name, forward=True)


def last_known(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
               value: Column, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` of the key at or before each row."""
    base = df.withColumn(CHUNK, chunk).withColumn("_v", value)
    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.when(F.col("_v").isNotNull(), F.struct(*order))
    rows = base.withColumn("_near", F.last("_v", ignorenulls=True).over(in_chunk))
    summary = base.groupBy(*keys, CHUNK).agg(F.max_by("_v", rank).alias("_edge"))
    joined = _with_carry(rows, summary, keys, F.last("_edge", ignorenulls=True).over(earlier))
    return joined.withColumn(name, F.coalesce("_near", "_carry")) \
        .drop("_near", "_carry", "_v", CHUNK)


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                value: Column, name: str) -> DataFrame:
    """Add ``name``: the largest ``value`` among the *earlier* rows of the key."""
    base = df.withColumn(CHUNK, chunk).withColumn("_v", value)
    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("_near", F.max("_v").over(in_chunk))
    summary = base.groupBy(*keys, CHUNK).agg(F.max("_v").alias("_edge"))
    joined = _with_carry(rows, summary, keys, F.max("_edge").over(earlier))
    # greatest() skips nulls, so either side alone is enough.
    return joined.withColumn(name, F.greatest("_near", "_carry")) \
        .drop("_near", "_carry", "_v", CHUNK)


def numbered_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column) -> DataFrame:
    """Stored rows with ``_at``, their number in the key from 1, and ``_before``, the sum of ``value`` over earlier rows.

    Rows are numbered and summed inside ranges of about equal row counts; counts and sums of the ranges before are
    carried over from one row per range. Missing values count as 0. ``order`` has to be unique within a key.
    """
    base = range_chunks(df.withColumn("_v", F.coalesce(value, F.lit(0))), keys, order)
    inside = Window.partitionBy(*keys, RANGE).orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("_near_at", F.row_number().over(inside)).withColumn(
        "_near_sum", F.sum("_v").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    summary = base.groupBy(*keys, RANGE).agg(F.count(F.lit(1)).alias("_n"), F.sum("_v").alias("_s")).select(
        *keys, RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s"))
    out = rows.join(summary, [*keys, RANGE]).select(
        *df.columns, (F.col("_near_at") + F.col("_n")).alias("_at"),
        (F.coalesce("_near_sum", F.lit(0)) + F.col("_s")).alias("_before"))
    path = work_folder(df.sparkSession, "numbered-sums")
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def rows_back(rows: DataFrame, keys: Sequence[str], back: int, values: dict[str, str]) -> DataFrame:
    """Add columns of the row ``back`` rows earlier in the key (``new name -> column``) to rows with ``_at``; null at the start.

    A join on the row's number, so no task has to see more of a key than the rows it is dealt.
    """
    earlier = rows.select(*keys, (F.col("_at") + back).alias("_at"), *[F.col(c).alias(n) for n, c in values.items()])
    return rows.join(earlier, [*keys, "_at"], "left")


def trailing_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows: int, name: str) -> DataFrame:
    """Add ``name``: the mean of ``value`` over up to ``rows`` rows before, null without any; exact for whole numbers.

    The difference of two running sums over the number of rows between, for keys with histories of any length.
    """
    summed = rows_back(numbered_sums(df, keys, order, F.col(value)), keys, rows, {"_then": "_before"})
    many = F.least(F.col("_at") - 1, F.lit(rows))
    mean = F.when(many > 0, (F.col("_before") - F.coalesce("_then", F.lit(0))) / many)
    return summed.select(*df.columns, mean.alias(name))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str,
              right_time: str, right_order: Sequence[str], values: Sequence[str],
              name: str = "asof", chunk_seconds: int | None = None) -> DataFrame:
    """For each left row, ``values`` of the last right row of the key at or before its time.

    Both sides are put on one time line and the last known right row is carried
    forward; nothing is paired up. Times are epoch seconds; ``right_order``
    breaks ties between right rows of the same second (the largest wins). Chunks
    are cut by row count; ``chunk_seconds`` cuts them by time instead, without
    storing the time line, for keys known to be even.
    """
    payload = F.struct(*[F.col(c) for c in values])
    ties = F.struct(*[F.col(c) for c in right_order])
    seen = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
                        ties.alias("_tie"), payload.alias("_seen"))
    rows = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
                       F.struct(*left.columns).alias("_row"))
    line = rows.unionByName(seen, allowMissingColumns=True)
    order = ["_t", "_side", "_tie"]
    if chunk_seconds is None:
        line, chunk = range_chunks(line, keys, order), F.col(RANGE)
    else:
        chunk = time_chunk("_t", chunk_seconds)
    filled = last_known(line, keys, order, chunk, F.col("_seen"), name)
    return filled.filter("_side = 1").select("_row.*", name)
