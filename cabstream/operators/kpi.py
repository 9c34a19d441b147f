"""Operational KPIs over curated trips, and their tall table.

Every KPI is one hash aggregation with map-side partial results; ordering is
left to whoever presents the rows (``ranked``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabstream.functions import labels


def _count(name: str = "trip_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def ranked(df: DataFrame, metric: str, *ties: str) -> DataFrame:
    """Order by a metric, largest first, ties by the named columns."""
    return df.orderBy(F.desc(metric), *[F.asc(t) for t in ties])


def top_k(df: DataFrame, metric: str, k: int, *ties: str) -> DataFrame:
    """The k rows with the largest metric."""
    return ranked(df, metric, *ties).limit(k)


def trips_per_zone(trips: DataFrame, zone: Sequence[str] = ("zone_id", "zone_name")) -> DataFrame:
    return trips.groupBy(*zone).agg(_count())


def avg_duration_per_zone(trips: DataFrame,
                          zone: Sequence[str] = ("zone_id", "zone_name")) -> DataFrame:
    return trips.groupBy(*zone).agg(F.avg("trip_duration_sec").alias("avg_duration_sec"))


def peak_demand_hours(trips: DataFrame, ts: str = "ts") -> DataFrame:
    """Trips per hour of day with a label such as 09:00."""
    return trips.groupBy(F.hour(ts).alias("hour_of_day")).agg(_count()) \
        .withColumn("hour_label", labels.hour_label("hour_of_day"))


def coverage_gap(trips: DataFrame, zone: Sequence[str] = ("zone_id", "zone_name"),
                 taxi: str = "taxi_id", underserved_above: float = 100,
                 critical_below: int = 5) -> DataFrame:
    """Trips per taxi and zone, judged underserved, critical or adequate (first rule wins)."""
    stats = trips.groupBy(*zone).agg(_count(), F.count_distinct(taxi).alias("unique_taxis"))
    return judge_coverage(stats, underserved_above, critical_below)


def judge_coverage(stats: DataFrame, underserved_above: float = 100, critical_below: int = 5) -> DataFrame:
    """Add trips_per_taxi and the verdict to rows with trip_count and unique_taxis."""
    per_taxi = F.round(F.col("trip_count") / F.greatest("unique_taxis", F.lit(1)), 1)
    verdict = F.when(F.col("trips_per_taxi") > underserved_above, "underserved") \
        .when(F.col("unique_taxis") < critical_below, "critical").otherwise("adequate")
    return stats.withColumn("trips_per_taxi", per_taxi).withColumn("coverage_gap", verdict)


def uncovered_zones(trips: DataFrame, zone: Sequence[str] = ("zone_id",), taxi: str = "taxi_id",
                    demand_above: int = 0, vehicles_below: int = 2) -> DataFrame:
    """Zones with demand above a threshold and fewer vehicles than needed."""
    stats = trips.groupBy(*zone).agg(_count("demand"), F.count_distinct(taxi).alias("vehicles"))
    return stats.filter((F.col("demand") > demand_above) & (F.col("vehicles") < vehicles_below))


def trip_type_distribution(trips: DataFrame, call_type: str = "call_type") -> DataFrame:
    return trips.groupBy(call_type).agg(_count()) \
        .withColumn("type_label", labels.call_type_label(call_type))


def trip_type_share(trips: DataFrame, call_type: str = "call_type") -> DataFrame:
    """Percentage of trips per call type, two digits."""
    counts = trips.groupBy(call_type).agg(_count())
    total = F.sum("trip_count").over(Window.partitionBy())
    return counts.withColumn("percentage", F.round(F.col("trip_count") / total * 100, 2))


def weekly_trends(trips: DataFrame, ts: str = "ts", calendar_label: bool = False) -> DataFrame:
    """Trips per week; ISO weeks unless the calendar-year label is asked for."""
    label = labels.calendar_year_week(ts) if calendar_label else labels.iso_year_week(ts)
    return trips.groupBy(label.alias("year_week")).agg(_count())


def week_over_week(weekly: DataFrame) -> DataFrame:
    """Change against the previous listed week; the input has one row per week."""
    before = F.lag("trip_count").over(Window.partitionBy().orderBy("year_week"))
    return weekly.withColumn("previous_count", F.coalesce(before, F.lit(0))).withColumn(
        "change", F.when(before.isNotNull(), F.col("trip_count") - before).otherwise(F.lit(0)))


def zone_hour_month_demand(records: DataFrame, zone: str = "PULocationID",
                           ts: str = "tpep_pickup_datetime", fare: str = "fare_amount",
                           distance: str = "trip_distance",
                           passengers: str = "passenger_count") -> DataFrame:
    """Demand of a zone per hour of day and month with mean fare, distance and passengers."""
    return records.groupBy(
        F.col(zone), F.hour(ts).alias("hour_of_day"), F.date_format(ts, "yyyy-MM").alias("month")
    ).agg(_count(), F.avg(fare).alias("avg_fare"), F.avg(distance).alias("avg_distance"),
          F.avg(passengers).alias("avg_passenger_count"))


def od_matrix(df: DataFrame, origin: str = "origin_zone", dest: str = "destination_zone") -> DataFrame:
    """Trips per origin and destination zone."""
    return df.groupBy(origin, dest).agg(_count())


def demand_curve(trips: DataFrame, ts: str = "ts") -> DataFrame:
    """Hourly demand multipliers (trips of the hour / mean of the hours) with a Friday factor.

    The Friday factor compares the hour's share of all Friday trips with its
    share of all trips.
    """
    hourly = trips.groupBy(F.hour(ts).alias("hour_of_day")).agg(
        _count(), F.count_if(labels.monday_based_weekday(ts) == 4).alias("friday_count"))
    every = Window.partitionBy()
    share = F.col("trip_count") / F.sum("trip_count").over(every)
    friday = F.try_divide(F.col("friday_count"), F.sum("friday_count").over(every))
    return hourly.select(
        "hour_of_day", "trip_count",
        (F.col("trip_count") / F.avg("trip_count").over(every)).alias("multiplier"),
        F.coalesce(friday / share, F.lit(0.0)).alias("friday_factor"),
    )


def match_kpis(matches: DataFrame, requested: str = "requested_at", matched_at: str = "matched_at",
               within_s: int = 5, as_of: Column | None = None) -> DataFrame:
    """Requests of the last 24 h, mean ETA and match rate within a few seconds, in one row.

    ``as_of`` defaults to the newest request in the table.
    """
    newest = as_of if as_of is not None else matches.select(F.max(requested)).scalar()
    recent = F.col(requested) > newest - 86400
    quick = F.col("matched") & (F.col(matched_at) - F.col(requested) <= within_s)
    return matches.agg(
        F.count_if(recent).alias("trips_24h"),
        F.avg(F.when(F.col("matched"), F.col("eta_seconds"))).alias("avg_eta"),
        (F.count_if(quick) / F.count(F.lit(1)) * 100).alias("match_rate_5s"),
    )


def sla_metrics(df: DataFrame, event_time: str = "event_s", arrival_time: str = "ingest_s",
                targets: Sequence[int] = (5, 15)) -> DataFrame:
    """P95 and mean latency in whole seconds, and the share within each target.

    Latencies are counted per second first; the exact percentile then needs one
    entry per distinct latency.
    """
    per_second = df.groupBy((F.col(arrival_time) - F.col(event_time)).alias("s")).agg(_count("n"))
    total = F.sum("n")
    return per_second.agg(
        total.alias("events"), F.percentile("s", F.lit(0.95), F.col("n")).alias("p95_s"),
        (F.sum(F.col("s") * F.col("n")) / total).alias("mean_s"), F.max("s").alias("max_s"),
        *[(F.sum(F.when(F.col("s") <= t, F.col("n")).otherwise(0)) / total).alias(f"within_{t}s")
          for t in targets],
    )


def to_kpi_rows(df: DataFrame, kpi_name: str, category: Column | str, value: Column | str,
                subcategory: Column | str | None = None,
                label: Column | str | None = None) -> DataFrame:
    """Rows of the tall KPI table: a null category becomes 'null', a null label the category."""
    def col(c):
        return F.col(c) if isinstance(c, str) else c

    cat = F.coalesce(col(category).cast("string"), F.lit("null"))
    sub = F.lit("") if subcategory is None else F.coalesce(col(subcategory).cast("string"), F.lit(""))
    lab = cat if label is None else F.coalesce(col(label).cast("string"), cat)
    return df.select(F.lit(kpi_name).alias("kpi_name"), cat.alias("category"),
                     sub.alias("subcategory"), lab.alias("label"),
                     col(value).cast("double").alias("value"))


def kpi_table(trips: DataFrame, ts: str = "ts", taxi: str = "taxi_id") -> DataFrame:
    """All dashboard KPIs as one tall table.

    The trips are first reduced to one row per (zone, hour, call type, week),
    mostly map-side; the grouping sets then expand that small table and not the
    trips. Distinct taxis are counted from a second, (zone, taxi) reduction.
    """
    base = trips.select("zone_id", "zone_name", F.col(taxi).alias("taxi_id"), "trip_duration_sec",
                        F.hour(ts).alias("hour_of_day"), "call_type",
                        labels.iso_year_week(ts).alias("year_week"))
    zone, hour, kind, week = (F.col(c) for c in ("zone_id", "hour_of_day", "call_type", "year_week"))
    sets = [[zone, F.col("zone_name")], [hour], [kind], [week], []]
    cells = base.groupBy("zone_id", "zone_name", "hour_of_day", "call_type", "year_week").agg(
        _count("n"), F.sum("trip_duration_sec").alias("seconds"))
    grouped = cells.groupingSets(sets, zone, F.col("zone_name"), hour, kind, week).agg(
        F.sum("n").alias("trip_count"), F.sum("seconds").alias("duration_sum"),
        F.grouping("zone_id").alias("g_zone"), F.grouping("hour_of_day").alias("g_hour"),
        F.grouping("call_type").alias("g_type"), F.grouping("year_week").alias("g_week"))
    # Distinct taxis need their own grouping; first to (zone, taxi), then per zone.
    taxis = base.groupBy("zone_id", "zone_name", "taxi_id").agg(_count()) \
        .groupBy("zone_id", "zone_name").agg(F.sum("trip_count").alias("trip_count"),
                                             F.count("taxi_id").alias("unique_taxis"))
    gaps = judge_coverage(taxis)

    cat = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    hour_text, count = labels.hour_label("hour_of_day"), F.col("trip_count").cast("double")
    mean = F.col("duration_sum") / F.col("trip_count")

    def row(name: str, category: Column, label: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("kpi_name"), category.alias("category"),
                        F.lit("").alias("subcategory"), label.alias("label"), value.alias("value"))

    zone_cat, zone_label = cat(zone), F.coalesce(F.col("zone_name"), cat(zone))
    kind_label = F.coalesce(labels.call_type_label("call_type"), cat(kind))
    rows = (
        F.when(F.col("g_zone") == 0, F.array(
            row("trips_per_zone", zone_cat, zone_label, count),
            row("avg_duration_per_zone", zone_cat, zone_label, mean)))
        .when(F.col("g_hour") == 0, F.array(row(
            "peak_demand_hours", hour_text, F.concat(F.lit("Hour "), cat(hour)), count)))
        .when(F.col("g_type") == 0, F.array(row("trip_type_distribution", cat(kind), kind_label, count)))
        .when(F.col("g_week") == 0, F.array(row("weekly_trends", cat(week), cat(week), count)))
        .otherwise(F.array(row("total_trips", F.lit("total"), F.lit("Total trips"), count),
                           row("avg_duration_overall", F.lit("overall"), F.lit("Average duration"),
                               mean)))
    )
    tall = grouped.select(F.inline(rows))
    return tall.unionByName(to_kpi_rows(gaps, "coverage_gap", "zone_id", "trips_per_taxi",
                                        "coverage_gap", "zone_name"))


def headline_rows(kpis: DataFrame, top_zones: int = 3) -> DataFrame:
    """Dashboard headlines derived from the tall table: busiest hour and busiest zones."""
    ranks = Window.partitionBy("kpi_name").orderBy(F.desc("value"), F.asc("category"))
    placed = kpis.filter(F.col("kpi_name").isin("peak_demand_hours", "trips_per_zone")) \
        .withColumn("place", F.row_number().over(ranks))
    hour = placed.filter("kpi_name = 'peak_demand_hours' and place = 1") \
        .withColumn("kpi_name", F.lit("peak_hour_top"))
    zones = placed.filter((F.col("kpi_name") == "trips_per_zone") & (F.col("place") <= top_zones)) \
        .withColumn("kpi_name", F.lit("top_zone"))
    return hour.unionByName(zones).drop("place")
