"""Lateness, blackouts, silent gaps and activity sessions of an event history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstream.operators.demand import demand_windows
from cabstream.operators.ordered import (
    RANGE, even_chunks, last_known, next_row, previous_row, range_chunks, running_max, time_chunk)


def drop_late(df: DataFrame, max_delay: int = 180, event_time: str = "event_s",
              arrival_order: Sequence[str] = ("ingest_s",),
              source: Sequence[str] = (), chunk: Column | None = None) -> DataFrame:
    """Drop events more than ``max_delay`` seconds behind the newest event seen before them.

    Times are epoch seconds. Without ``source`` columns there is one clock for
    the whole table; it is still computed chunk by chunk. Chunks are equal steps
    of the first arrival column where no step has too many rows; after a bulk
    load they are cut by row count, which stores the rows once. A ``chunk`` of
    one's own is any number that grows with the arrival order (e.g. the broker
    offset divided by 100,000).
    """
    keys = list(source) or ["_all"]
    rows = df if source else df.withColumn("_all", F.lit(0))
    whole = isinstance(df.schema[arrival_order[0]].dataType, T.IntegralType)
    if chunk is None and whole:
        chunk = even_chunks(df, arrival_order[0])
    if chunk is None:
        rows, chunk = range_chunks(rows, keys, list(arrival_order)), F.col(RANGE)
    seen = running_max(rows, keys, list(arrival_order), chunk, F.col(event_time), "_newest")
    late = F.col(event_time) < F.col("_newest") - max_delay
    return seen.filter(~F.coalesce(late, F.lit(False))).drop("_newest", "_all", RANGE)


def event_vs_arrival_windows(by_event: DataFrame, by_arrival: DataFrame,
                             window: str = "30 seconds") -> DataFrame:
    """Demand windows on the event clock next to those on the arrival clock."""
    keep = ["zone_id", "window_start", "active_vehicles", "pending_requests"]
    left = demand_windows(by_event, window).select(*keep)
    right = demand_windows(by_arrival, window).select(*keep)
    joined = left.alias("e").join(right.alias("a"), ["zone_id", "window_start"], "full")

    def of(side: str, column: str):
        return F.coalesce(F.col(f"{side}.{column}"), F.lit(0))

    return joined.select(
        "zone_id", "window_start",
        of("e", "active_vehicles").alias("event_active"),
        of("a", "active_vehicles").alias("arrival_active"),
        of("e", "pending_requests").alias("event_pending"),
        of("a", "pending_requests").alias("arrival_pending"),
        (of("e", "active_vehicles") - of("a", "active_vehicles")).alias("active_delta"),
        (of("e", "pending_requests") - of("a", "pending_requests")).alias("pending_delta"),
    )


def lateness_histogram(df: DataFrame, event_time: str = "event_s", arrival_time: str = "ingest_s",
                       bin_seconds: int = 60) -> DataFrame:
    """Events per delay bin, with the delay range and mean of each bin."""
    delay = F.col(arrival_time) - F.col(event_time)
    return df.select(delay.alias("d")).groupBy(
        (F.floor(F.col("d") / bin_seconds) * bin_seconds).cast("bigint").alias("delay_from_s")
    ).agg(F.count(F.lit(1)).alias("events"), F.min("d").alias("min_delay_s"),
          F.max("d").alias("max_delay_s"), F.avg("d").alias("mean_delay_s"))


def blackout_intervals(raw: DataFrame, key: str = "taxi_id", time: str = "timestamp",
                       tie: Sequence[str] = ()) -> DataFrame:
    """Pair each BLACKOUT_START with the next marker of the vehicle if that is an END.

    Runs on raw events: marker rows carry no valid position. An unanswered
    start is reported as open.
    """
    markers = raw.filter(F.col("status").isin("BLACKOUT_START", "BLACKOUT_END"))
    paired = next_row(markers, [key], [time, *tie], time_chunk(time), ["status", time], "next")
    ended = F.col("next.status") == "BLACKOUT_END"
    return paired.filter("status = 'BLACKOUT_START'").select(
        key, F.col(time).alias("start_s"),
        F.when(ended, F.col(f"next.{time}")).alias("end_s"),
        F.when(ended, F.col(f"next.{time}") - F.col(time)).alias("duration_s"),
        F.coalesce(~ended, F.lit(True)).alias("is_open"),
    )


def silent_gaps(df: DataFrame, key: str = "taxi_id", time: str = "timestamp",
                longer_than: int = 60) -> DataFrame:
    """Stretches without any event of a vehicle that last more than ``longer_than`` seconds.

    Events of one second are no gap, so they are first reduced to one map-side.
    """
    seconds = df.select(key, time).distinct()
    near = previous_row(seconds, [key], [time], time_chunk(time), [time], "prev")
    gap = F.col(time) - F.col(f"prev.{time}")
    return near.filter(gap > longer_than).select(
        key, F.col(f"prev.{time}").alias("silent_from_s"), F.col(time).alias("silent_to_s"),
        gap.alias("gap_s"))


def activity_sessions(df: DataFrame, key: str = "taxi_id", time: str = "timestamp",
                      gap_seconds: int = 60) -> DataFrame:
    """Sessions of a vehicle, split where it is silent for ``gap_seconds`` or longer.

    Same sessions as ``session_window``, which would sort one vehicle's whole
    history in one task; the session start is carried from chunk to chunk here.
    """
    per_second = df.groupBy(key, F.col(time).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    near = previous_row(per_second, [key], ["_t"], time_chunk("_t"), ["_t"], "prev")
    opens = F.col("prev").isNull() | (F.col("_t") - F.col("prev._t") >= gap_seconds)
    marked = last_known(near, [key], ["_t"], time_chunk("_t"), F.when(opens, F.col("_t")),
                        "session_start_s")
    return marked.groupBy(key, "session_start_s").agg(
        (F.max("_t") + gap_seconds).alias("session_end_s"), F.sum("_n").alias("events"))
