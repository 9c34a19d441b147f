"""Demand-forecast features: calendar, zone, weather, lags, temporal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabstream.operators.demand import slot_demand
from cabstream.operators.enrich import enrich_weather, enrich_zone_features
from cabstream.operators.ordered import numbered_sums, rows_back

SLOT = "time_slot_30min"
SLOTS_PER_DAY, SLOTS_PER_WEEK = 48, 336
DAY_S, WEEK_S = 86_400, 604_800
LAG_MODES = ("rows", "calendar", "dense")
LAG_COLUMNS = ("demand_lag_1d", "demand_lag_7d", "rolling_7d_mean")

# Model inputs in their training order.
FEATURE_COLUMNS = (
    "hour_of_day", "day_of_week", "is_weekend", "is_friday", "population_density",
    "is_residential", "is_commercial", "is_industrial", "is_transit_hub", "temperature_2m",
    "rain", "is_raining", "temp_cold", "temp_hot", "temp_mild", "demand_lag_1d", "demand_lag_7d",
    "rolling_7d_mean", "zone_id",
)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def add_calendar_features(df: DataFrame, ts: str = SLOT) -> DataFrame:
    """Hour, weekday (1 = Sunday), weekend and Friday flags."""
    weekday = F.dayofweek(ts)
    return df.withColumns({
        "hour_of_day": F.hour(ts), "day_of_week": weekday,
        "is_weekend": _flag(weekday.isin(1, 7)), "is_friday": _flag(weekday == 6),
    })


def add_weather_flags(df: DataFrame) -> DataFrame:
    """Rain and temperature bands; 15 to 28 degrees inclusive is mild."""
    temp = F.col("temperature_2m")
    return df.withColumns({
        "is_raining": _flag(F.col("rain") > 0), "temp_cold": _flag(temp < 15),
        "temp_hot": _flag(temp > 28), "temp_mild": _flag(temp.between(15, 28)),
    })


def add_row_lags(df: DataFrame, value: str = "demand_count", long_zones: bool = False) -> DataFrame:
    """Lags by row count per zone: 48 and 336 rows back, mean of the 336 rows before.

    ``long_zones`` cuts the rows of a zone into ranges and looks rows up by
    their number instead of sorting a zone in one task. Else the input holds one row per zone and slot, so a zone's window is short. The
    mean comes from a running sum and its value 336 rows earlier, which is exact
    for counts and touches each row once; a sliding frame would add up 336 rows
    for every row. The current row never enters its own features; missing
    history is 0.
    """
    if long_zones:
        rows = numbered_sums(df, ["zone_id"], [SLOT], F.col(value))
        near = rows_back(rows, ["zone_id"], SLOTS_PER_DAY, {"demand_lag_1d": value})
        far = rows_back(rows, ["zone_id"], SLOTS_PER_WEEK, {"demand_lag_7d": value, "_then": "_before"})
        both = near.join(far.select("zone_id", "_at", "demand_lag_7d", "_then"), ["zone_id", "_at"])
        many = F.least(F.col("_at") - 1, F.lit(SLOTS_PER_WEEK))
        mean = F.when(many > 0, (F.col("_before") - F.coalesce("_then", F.lit(0))) / F.nullif(many, F.lit(0)))
        return both.select(*df.columns, "demand_lag_1d", "demand_lag_7d", mean.alias("rolling_7d_mean")) \
            .fillna(0, list(LAG_COLUMNS))
    order = Window.partitionBy("zone_id").orderBy(SLOT)
    summed = df.withColumns({
        "demand_lag_1d": F.lag(value, SLOTS_PER_DAY).over(order),
        "demand_lag_7d": F.lag(value, SLOTS_PER_WEEK).over(order),
        "_before": F.coalesce(F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)),
        "_rows": F.least(F.row_number().over(order) - 1, F.lit(SLOTS_PER_WEEK)),
    })
    week = F.col("_before") - F.coalesce(F.lag("_before", SLOTS_PER_WEEK).over(order), F.lit(0))
    mean = F.when(F.col("_rows") > 0, week / F.nullif("_rows", F.lit(0)))
    return summed.withColumn("rolling_7d_mean", mean).drop("_before", "_rows") \
        .fillna(0, list(LAG_COLUMNS))


def add_calendar_lags(df: DataFrame, value: str = "demand_count") -> DataFrame:
    """Lags by time: the same slot 1 and 7 days ago, mean over the 7 days before.

    One sort per zone serves all three, as ranges on the slot's epoch second.
    """
    epoch = F.unix_timestamp(SLOT)
    order = Window.partitionBy("zone_id").orderBy("_epoch")
    return df.withColumn("_epoch", epoch).withColumns({
        "demand_lag_1d": F.sum(value).over(order.rangeBetween(-DAY_S, -DAY_S)),
        "demand_lag_7d": F.sum(value).over(order.rangeBetween(-WEEK_S, -WEEK_S)),
        "rolling_7d_mean": F.avg(value).over(order.rangeBetween(-WEEK_S, -1)),
    }).drop("_epoch").fillna(0, list(LAG_COLUMNS))


def densify(demand: DataFrame, zones: DataFrame, value: str = "demand_count") -> DataFrame:
    """Every zone x every slot between the first and last one, absent demand as 0.

    The slot range is a scalar subquery and each zone row unfolds its own
    sequence, so no join produces the spine.
    """
    ends = demand.select(F.struct(F.min(SLOT).alias("lo"), F.max(SLOT).alias("hi")).alias("b"))
    low, high = (ends.select(f"b.{side}").scalar() for side in ("lo", "hi"))
    slots = F.sequence(low, high, F.expr("interval 30 minutes"))
    # Zone rows are spread first, so each task unfolds its own zones.
    spine = zones.select("zone_id").repartition("zone_id").select("zone_id", F.explode(slots).alias(SLOT))
    return spine.join(demand, ["zone_id", SLOT], "left") \
        .withColumn(value, F.coalesce(value, F.lit(0)))


def build_features(trips: DataFrame, zones: DataFrame, weather: DataFrame, lag_mode: str = "rows",
                   zone: str = "zone_id", ts: str = "ts", trip_id: str = "trip_id") -> DataFrame:
    """Feature matrix per zone and half-hour slot.

    ``lag_mode``: ``rows`` counts existing rows back, ``calendar`` looks at the
    clock, ``dense`` first fills empty slots with 0 (then both agree).
    """
    if lag_mode not in LAG_MODES:
        raise ValueError(f"lag_mode is one of {LAG_MODES}, not {lag_mode!r}")
    demand = slot_demand(trips, zone, ts, trip_id)
    if lag_mode == "dense":
        demand = densify(demand, zones)
    lagged = add_calendar_lags(demand) if lag_mode == "calendar" else add_row_lags(demand)
    enriched = enrich_weather(enrich_zone_features(add_calendar_features(lagged), zones), weather)
    return add_weather_flags(enriched).withColumn("year_month", F.date_format(SLOT, "yyyy-MM"))


def temporal_split(features: DataFrame, last_train_month: str = "2013-09") -> tuple[DataFrame, DataFrame]:
    """(train, test): months up to and including the cut, and the months after it."""
    return (features.filter(F.col("year_month") <= last_train_month),
            features.filter(F.col("year_month") > last_train_month))
