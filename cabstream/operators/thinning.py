"""Per-vehicle thinning of a ping history (batch form)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THIN_INTERVAL_S = 2
CHUNK_SECONDS = 3600


def _keep_times(times: Column, first_allowed: Column, interval: int) -> Column:
    """Fold sorted times: keep a time once it is not before the next allowed one."""
    start = F.struct(first_allowed.cast("bigint").alias("allowed"),
                     F.array().cast("array<bigint>").alias("kept"))
    return F.aggregate(
        times, start,
        lambda acc, t: F.when(
            t >= acc["allowed"],
            F.struct((t + interval).alias("allowed"),
                     F.concat(acc["kept"], F.array(t)).alias("kept")),
        ).otherwise(acc),
    )


def _exit_delay(times: Column, start: Column, entry_delay: Column, interval: int,
                chunk_seconds: int) -> Column:
    """Seconds of the following chunk still blocked when this one was entered with a delay."""
    allowed = F.aggregate(
        times, (start + entry_delay).cast("bigint"),
        lambda acc, t: F.when(t >= acc, t + interval).otherwise(acc),
    )
    return F.greatest(allowed - (start + chunk_seconds), F.lit(0)).cast("int")


def thin_by_interval(df: DataFrame, key: str = "taxi_id", time: str = "timestamp",
                     order_by: Sequence[str] = (), interval: int = THIN_INTERVAL_S,
                     chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Keep an event only if it is at least ``interval`` seconds after the last kept one.

    Whether an event survives depends on the previously *kept* one, a chain
    through a vehicle's whole history. The chain is cut exactly:

    1. one row per (vehicle, second), since a second row of the same second is
       always dropped; this is a partial aggregation, so copies vanish map-side;
    2. per (vehicle, chunk) the times are folded once for each possible entry
       state, of which there are only ``interval``: how many leading seconds of
       the chunk are still blocked by the last kept event before it;
    3. the small tables "entry state -> exit state" are chained per vehicle,
       which gives the real entry state of every chunk;
    4. every chunk is thinned on its own with its entry state.

    Events are taken in time order, ties by ``order_by`` then the other columns.
    """
    rest = [c for c in df.columns if c not in (key, time, *order_by)]
    seconds = df.groupBy(key, F.col(time).cast("bigint").alias("_t")) \
        .agg(F.min(F.struct(*order_by, *rest, F.col(time).alias("_time"))).alias("_row"))
    chunked = seconds.withColumn("_chunk", F.floor(F.col("_t") / chunk_seconds))
    start = F.col("_chunk") * chunk_seconds

    times = chunked.groupBy(key, "_chunk").agg(F.sort_array(F.collect_list("_t")).alias("_times"))
    exits = F.array(*[_exit_delay(F.col("_times"), start, F.lit(d), interval, chunk_seconds)
                      for d in range(interval)])
    # Only chunks that can block the next one matter; most end in a silent second.
    links = times.select(key, "_chunk", exits.alias("_exits")).filter(F.array_max("_exits") > 0) \
        .groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_chunk", "_exits"))).alias("_links"))
    first = F.struct(F.lit(-1).cast("bigint").alias("next"), F.lit(0).alias("delay"),
                     F.array().cast("array<struct<_chunk:bigint,_entry:int>>").alias("entries"))

    def follow(acc: Column, link: Column) -> Column:
        entry = F.when(acc["next"] == link["_chunk"], acc["delay"]).otherwise(F.lit(0))
        delay, following = F.get(link["_exits"], entry), link["_chunk"] + 1
        passed_on = F.array(F.struct(following.alias("_chunk"), delay.alias("_entry")))
        return F.struct(following.alias("next"), delay.alias("delay"),
                        F.concat(acc["entries"], passed_on).alias("entries"))

    delayed = links.select(key, F.inline(
        F.aggregate("_links", first, follow, lambda acc: acc["entries"]))).filter("_entry > 0")
    kept = times.join(delayed, [key, "_chunk"], "left").select(
        key, F.explode(_keep_times(F.col("_times"), start + F.coalesce("_entry", F.lit(0)),
                                   interval)["kept"]).alias("_t"))
    picked = seconds.join(kept, [key, "_t"], "left_semi")
    columns = {time: F.col("_row._time"),
               **{c: F.col(f"_row.`{c}`") for c in (*order_by, *rest)}}
    return picked.select(*[F.col(key) if c == key else columns[c].alias(c) for c in df.columns])
