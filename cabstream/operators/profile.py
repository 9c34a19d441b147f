"""Dataset profiling: columns, distributions, one-row summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.functions.labels import monday_based_weekday

FRIDAY = 4


def profile_columns(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows per column: null count and distinct values.

    Exact distinct counts are taken over one (column, value) table: distinct
    pairs are removed map-side and spread over all tasks, where a wide row of
    COUNT(DISTINCT ...) would multiply every input row by the column count in
    a single aggregation. ``approximate`` uses sketches in one pass instead.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                      for c in df.columns])
    tall = df.select(F.inline(cells))
    if approximate:
        return tall.groupBy("column_name").agg(
            F.count_if(F.col("v").isNull()).alias("null_count"),
            F.approx_count_distinct("v").alias("n_unique"))
    per_value = tall.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column_name").agg(
        F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("v").alias("n_unique"))


def missing_rate(df: DataFrame, flag: str = "missing_data") -> DataFrame:
    """Share of rows flagged missing, in percent."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  (F.count_if(F.col(flag)) / F.count(F.lit(1)) * 100).alias("missing_data_pct"))


def trips_per_taxi_summary(df: DataFrame, taxi: str = "taxi_id") -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of trips per taxi."""
    per_taxi = df.groupBy(taxi).agg(F.count(F.lit(1)).alias("n"))
    return per_taxi.agg(F.count("n").alias("taxis"), F.avg("n").alias("mean_trips"),
                        F.stddev_samp("n").alias("stddev_trips"), F.min("n").alias("min_trips"),
                        F.max("n").alias("max_trips"))


def calendar_distribution(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Trips per hour, weekday (0 = Monday) and weekend flag."""
    weekday = monday_based_weekday(ts)
    return df.groupBy(F.hour(ts).alias("hour"), weekday.alias("dow")) \
        .agg(F.count(F.lit(1)).alias("trips")) \
        .withColumn("is_weekend", F.col("dow").isin(5, 6))


def active_taxis_per_hour(df: DataFrame, taxi: str = "taxi_id", ts: str = "ts") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.count_distinct(taxi).alias("active_taxis"))


def slice_counts(ts: str) -> dict[str, Column]:
    """Counts of the reported time slices; hour limits are inclusive."""
    hour, friday = F.hour(ts), monday_based_weekday(ts) == FRIDAY
    noon = hour.between(12, 14)
    return {
        "friday_trips": F.count_if(friday),
        "friday_12_14_trips": F.count_if(friday & noon),
        "all_12_14_trips": F.count_if(noon),
        "morning_peak_07_09_trips": F.count_if(hour.between(7, 9)),
        "evening_peak_17_19_trips": F.count_if(hour.between(17, 19)),
    }


def _percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def time_slice_shares(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Friday noon share against the overall noon share, and both peaks, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"),
                    *[c.alias(name) for name, c in slice_counts(ts).items()])
    return counts.withColumns({
        "friday_12_14_share_pct": _percent(F.col("friday_12_14_trips"), F.col("friday_trips")),
        "all_12_14_share_pct": _percent(F.col("all_12_14_trips"), F.col("rows")),
    })


def duration_bounds(df: DataFrame, column: str = "trip_duration_sec",
                    bounds: Sequence[float] = (0.01, 0.99), exact: bool = True,
                    accuracy: int = 1000) -> DataFrame:
    """Low and high percentile of a duration.

    Durations are whole sampling intervals, so the exact form first counts per
    distinct duration; ``exact=False`` uses the approximate percentile.
    """
    if not exact:
        found = F.percentile_approx(column, list(bounds), accuracy)
        return df.agg(F.get(found, F.lit(0)).cast("double").alias("low"),
                      F.get(found, F.lit(1)).cast("double").alias("high"))
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(*[F.percentile(column, F.lit(b), F.col("n")).alias(name)
                         for b, name in zip(bounds, ("low", "high"), strict=True)])


def clipped_histogram(df: DataFrame, column: str = "trip_duration_sec", bins: int = 20,
                      bounds: Sequence[float] = (0.01, 0.99)) -> DataFrame:
    """Histogram between two percentiles; the last bin includes the upper bound.

    Works on the (duration, count) table: the trips are read once for the
    bounds and once for the bins, and only distinct durations go further.
    """
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    limits = counted.agg(F.struct(*[
        F.percentile(column, F.lit(b), F.col("n")).alias(name)
        for b, name in zip(bounds, ("low", "high"), strict=True)]).alias("b"))
    low, high = (limits.select(f"b.{side}").scalar() for side in ("low", "high"))
    staged = counted.withColumns({"low": low, "high": high}) \
        .filter(F.col(column).between(F.col("low"), F.col("high")))
    width = (F.col("high") - F.col("low")) / bins
    # A zero width (one single duration) puts everything into the first bin.
    place = F.coalesce(F.floor((F.col(column) - F.col("low")) / F.nullif(width, F.lit(0.0))), F.lit(0))
    number = F.least(place, F.lit(bins - 1))
    return staged.groupBy(number.cast("int").alias("bin"),
                          (F.col("low") + number * width).alias("from_value")) \
        .agg(F.sum("n").alias("trips"))


def dataset_summary(df: DataFrame, ts: str = "ts", taxi: str = "taxi_id",
                    call_type: str = "call_type", duration: str = "trip_duration_sec",
                    distance: str = "trip_distance_km", missing: str = "missing_data",
                    origin_area: str = "origin_area", dest_area: str = "dest_area") -> DataFrame:
    """One row with the 13 headline figures of a trip table; ties go to the smaller name.

    The four most frequent values come from one table of (what, value, count),
    so the trips are read twice in all.
    """
    looked_at = {"peak_hour": F.lpad(F.hour(ts).cast("string"), 2, "0"), "top_call_type": F.col(call_type),
                 "top_origin_area": F.col(origin_area), "top_destination_area": F.col(dest_area)}
    cells = F.array(*[F.struct(F.lit(name).alias("what"), value.cast("string").alias("v"))
                      for name, value in looked_at.items()])
    frequent = df.select(F.inline(cells)).filter(F.col("v").isNotNull()) \
        .groupBy("what", "v").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy("what").agg(F.min(F.struct(-F.col("n"), "v"))["v"].alias("v"))
    top = frequent.agg(F.struct(*[F.max(F.when(F.col("what") == name, F.col("v"))).alias(name)
                                  for name in looked_at]).alias("top")).select("top").scalar()
    counts = slice_counts(ts)
    base = df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(taxi).alias("unique_taxis"),
        F.avg(duration).alias("avg_duration_seconds"), F.avg(distance).alias("avg_distance"),
        (F.count_if(F.col(missing)) / F.count(F.lit(1)) * 100).alias("missing_data_pct"),
        *[c.alias(name) for name, c in counts.items()])
    return base.withColumn("top", top).select(
        "rows", "unique_taxis", "avg_duration_seconds", "avg_distance", "missing_data_pct",
        F.col("top.peak_hour").cast("int").alias("peak_hour"), "top.top_call_type",
        "morning_peak_07_09_trips", "evening_peak_17_19_trips",
        _percent(F.col("friday_12_14_trips"), F.col("friday_trips")).alias("friday_12_14_share_pct"),
        _percent(F.col("all_12_14_trips"), F.col("rows")).alias("all_data_12_14_share_pct"),
        "top.top_origin_area", "top.top_destination_area",
    )
