"""Queries: slot demand, feature matrix, model metrics, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstream.operators import features, forecast
from cabstream.operators.demand import slot_demand
from cabstream.plans.catalog.demand import GPS_VIEWS, window_ctes, windows
from cabstream.plans.catalog.registry import city_zones, query, r6
from cabstream.plans.views import view

FV = ["v_trips", "v_zones", "v_weather"]
SLOT_SQL = "time_bucket(interval 30 minutes, ts)"
DEMAND_SQL = f"""d as (select zone_id, {SLOT_SQL} as time_slot_30min, count(trip_id) as demand_count
  from v_trips group by all)"""
ROW_LAGS = """lagged as (select *, coalesce(lag(demand_count, 48) over w, 0) as demand_lag_1d,
  coalesce(lag(demand_count, 336) over w, 0) as demand_lag_7d,
  round(coalesce(avg(demand_count) over (partition by zone_id order by time_slot_30min
    rows between 336 preceding and 1 preceding), 0), 6) as rolling_7d_mean
  from {0} window w as (partition by zone_id order by time_slot_30min))"""
CALENDAR_LAGS = """lagged as (select d.*, coalesce(a.demand_count, 0) as demand_lag_1d,
  coalesce(b.demand_count, 0) as demand_lag_7d,
  round(coalesce(avg(d.demand_count) over (partition by d.zone_id order by d.time_slot_30min
    range between interval 7 days preceding and interval 1 second preceding), 0), 6) as rolling_7d_mean
  from d left join d a on a.zone_id = d.zone_id and a.time_slot_30min = d.time_slot_30min - interval 1 day
  left join d b on b.zone_id = d.zone_id and b.time_slot_30min = d.time_slot_30min - interval 7 days)"""
DENSE = """dense as (select z.zone_id, s.slot as time_slot_30min, coalesce(d.demand_count, 0) as demand_count
  from v_zones z, (select unnest(generate_series(min(time_slot_30min), max(time_slot_30min), interval 30 minutes)) as slot
    from d) s left join d on d.zone_id = z.zone_id and d.time_slot_30min = s.slot)"""
FLAGS_SQL = """
select l.zone_id, l.time_slot_30min, l.demand_count, cast(hour(l.time_slot_30min) as int) as hour_of_day,
  cast(dayofweek(l.time_slot_30min) + 1 as int) as day_of_week,
  case when dayofweek(l.time_slot_30min) in (0, 6) then 1 else 0 end as is_weekend,
  case when dayofweek(l.time_slot_30min) = 5 then 1 else 0 end as is_friday, z.population_density,
  case when zone_type = 'residential' then 1 else 0 end as is_residential,
  case when zone_type = 'commercial' then 1 else 0 end as is_commercial,
  case when zone_type = 'industrial' then 1 else 0 end as is_industrial,
  case when zone_type = 'transit_hub' then 1 else 0 end as is_transit_hub,
  coalesce(w.temperature_2m, 15e0) as temperature_2m, coalesce(w.rain, 0e0) as rain,
  case when w.rain > 0 then 1 else 0 end as is_raining,
  case when coalesce(w.temperature_2m, 15e0) < 15 then 1 else 0 end as temp_cold,
  case when w.temperature_2m > 28 then 1 else 0 end as temp_hot,
  case when coalesce(w.temperature_2m, 15e0) between 15 and 28 then 1 else 0 end as temp_mild,
  demand_lag_1d, demand_lag_7d, rolling_7d_mean, strftime(l.time_slot_30min, '%Y-%m') as year_month
from lagged l left join v_zones z on z.zone_id = l.zone_id
left join (select time_slot_1h, rain, nullif(temperature_2m, 20e0) as temperature_2m from v_weather) w on w.time_slot_1h = date_trunc('hour', l.time_slot_30min)"""


def matrix(spark, sf, lag_mode="rows"):
    # A reading of exactly 20 degrees stands for a missing one; hours without a trip have no row.
    weather = view(spark, sf, "v_weather").withColumn("temperature_2m", F.nullif("temperature_2m", F.lit(20.0)))
    return features.build_features(view(spark, sf, "v_trips"), city_zones(spark), weather, lag_mode)


def rounded(df):
    return df.withColumn("rolling_7d_mean", r6("rolling_7d_mean"))


@query("slot_demand", f"with {DEMAND_SQL} select * from d", ["v_trips"])
def _(spark, sf):
    return slot_demand(view(spark, sf, "v_trips"))


@query("feature_matrix_row_lags", f"with {DEMAND_SQL}, {ROW_LAGS.format('d')} {FLAGS_SQL}", FV)
def _(spark, sf):
    return rounded(matrix(spark, sf))


@query("feature_matrix_calendar_lags", f"with {DEMAND_SQL}, {CALENDAR_LAGS} {FLAGS_SQL}", FV)
def _(spark, sf):
    return rounded(matrix(spark, sf, "calendar"))


@query("feature_matrix_dense", f"""with {DEMAND_SQL}, {DENSE}, {ROW_LAGS.format('dense')}
select year_month, zone_id, cast(count(*) as bigint) as slots, cast(sum(demand_count) as bigint) as demand,
  cast(sum(demand_lag_1d) as bigint) as lag_1d, cast(sum(demand_lag_7d) as bigint) as lag_7d,
  cast(sum(cast(round(rolling_7d_mean * 1e6) as bigint)) as bigint) as rolling_micros, cast(sum(is_raining) as bigint) as rainy from ({FLAGS_SQL}) f
group by 1, 2""", FV)
def _(spark, sf):
    dense = rounded(matrix(spark, sf, "dense"))
    return dense.groupBy("year_month", "zone_id").agg(
        F.count(F.lit(1)).alias("slots"), F.sum("demand_count").alias("demand"),
        F.sum("demand_lag_1d").alias("lag_1d"), F.sum("demand_lag_7d").alias("lag_7d"),
        F.sum(F.round(F.col("rolling_7d_mean") * 1_000_000).cast("bigint")).alias("rolling_micros"), F.sum("is_raining").alias("rainy"))


SPLIT_MONTH = "1996-12"


@query("temporal_split", f"""with {DEMAND_SQL}, {ROW_LAGS.format('d')}, f as ({FLAGS_SQL})
select case when year_month <= '{SPLIT_MONTH}' then 'train' else 'test' end as part, count(*) as rows,
  min(year_month) as first_month, max(year_month) as last_month from f group by 1""", FV)
def _(spark, sf):
    parts = features.temporal_split(matrix(spark, sf), SPLIT_MONTH)
    named = [p.select(F.lit(n).alias("part"), "year_month") for n, p in zip(("train", "test"), parts, strict=True)]
    return named[0].unionByName(named[1]).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("year_month").alias("first_month"),
        F.max("year_month").alias("last_month"))


def _predicted(spark, sf):
    """Feature rows with the rolling mean standing in as a prediction."""
    return matrix(spark, sf).withColumn("prediction", r6("rolling_7d_mean"))


_ERRORS = (f"with {DEMAND_SQL}, {ROW_LAGS.format('d')}, f as ({FLAGS_SQL}), "
           "e as (select *, demand_count - rolling_7d_mean as err, demand_count - demand_lag_7d as naive from f)")


@query("forecast_metrics", f"""{_ERRORS} select count(*) as rows, round(sqrt(avg(err*err)), 6) as rmse,
  round(avg(abs(err)), 6) as mae, round(sqrt(avg(naive*naive)), 6) as baseline_rmse,
  sqrt(avg(err*err)) < sqrt(avg(naive*naive)) as beats_baseline from e""", FV)
def _(spark, sf):
    return forecast.forecast_metrics(_predicted(spark, sf)) \
        .withColumns({c: r6(c) for c in ("rmse", "mae", "baseline_rmse")})


@query("zone_forecast_metrics", f"""{_ERRORS} select zone_id, round(sqrt(avg(err*err)), 6) as model_rmse,
  round(sqrt(avg(naive*naive)), 6) as baseline_rmse from e group by 1""", FV)
def _(spark, sf):
    return forecast.zone_metrics(_predicted(spark, sf)) \
        .withColumns({c: r6(c) for c in ("model_rmse", "baseline_rmse")})


@query("forecast_inputs", f"""with {DEMAND_SQL}, {ROW_LAGS.format('d')}, f as ({FLAGS_SQL}),
l as (select *, row_number() over (partition by zone_id order by time_slot_30min desc) as rn from f)
select zone_id::double as zone_id, 9e0 as hour_of_day, 6e0 as day_of_week, 0e0 as is_weekend, 1e0 as is_friday,
  population_density::double as population_density, temperature_2m, rain, demand_lag_1d::double as demand_lag_1d,
  demand_lag_7d::double as demand_lag_7d, rolling_7d_mean from l where rn = 1""", FV)
def _(spark, sf):
    at = F.lit("2024-01-05 09:00:00").cast("timestamp")
    rows = rounded(forecast.forecast_inputs(matrix(spark, sf), at))
    return rows.select("zone_id", "hour_of_day", "day_of_week", "is_weekend", "is_friday", "population_density",
                       "temperature_2m", "rain", "demand_lag_1d", "demand_lag_7d", "rolling_7d_mean")


_FORECAST = ("fc as (select zone_id, window_start, round(avg(pending_requests) over (partition by zone_id order by "
             "window_start rows between 10 preceding and 1 preceding), 2) as forecasted_demand from dw "
             "where active_vehicles > 0)")


def _compared(spark, sf):
    """Windows next to a forecast (trailing mean) made where vehicles were free only."""
    from pyspark.sql.window import Window

    actual = windows(spark, sf)
    past = Window.partitionBy("zone_id").orderBy("window_start").rowsBetween(-10, -1)
    made = actual.filter("active_vehicles > 0").withColumn(
        "forecasted_demand", F.round(F.avg("pending_requests").over(past), 2))
    return forecast.forecast_vs_actual(actual, made)


@query("forecast_vs_actual", f"""with {window_ctes()}, {_FORECAST}
select dw.zone_id, dw.window_start, pending_requests, coalesce(forecasted_demand, -1) as forecasted_demand,
  round(coalesce(forecasted_demand - pending_requests, 0), 6) as error
from dw left join fc using (zone_id, window_start)""", GPS_VIEWS)
def _(spark, sf):
    return _compared(spark, sf).select(
        "zone_id", "window_start", "pending_requests",
        F.coalesce("forecasted_demand", F.lit(-1.0)).alias("forecasted_demand"),
        r6(F.coalesce("error", F.lit(0.0))).alias("error"))


@query("forecast_errors", f"""with {window_ctes()}, {_FORECAST}, c as (
  select zone_id, forecasted_demand - pending_requests as error from dw join fc using (zone_id, window_start)
  where forecasted_demand is not null)
select zone_id, count(*) as slots, round(avg(error), 6) as bias, round(avg(abs(error)), 6) as mae from c group by 1""",
       GPS_VIEWS)
def _(spark, sf):
    return forecast.forecast_errors(_compared(spark, sf)).withColumns({c: r6(c) for c in ("bias", "mae")})


@query("demand_forecast")
def _(spark, sf):
    rows = matrix(spark, sf)
    train, _test = features.temporal_split(rows, SPLIT_MONTH)
    model = forecast.demand_estimator().fit(forecast.as_model_input(train))
    at = F.lit("2024-01-05 09:00:00").cast("timestamp")
    return forecast.forecast_zones(rows, model, at, city_zones(spark))


@query("model_evaluation")
def _(spark, sf):
    """The fitted model on the months after the cut: overall and per zone against the seven-day lag, and its inputs' weights."""
    train, test = features.temporal_split(matrix(spark, sf), SPLIT_MONTH)
    model = forecast.demand_estimator().fit(forecast.as_model_input(train))
    scored = model.transform(forecast.as_model_input(test))

    def told(df, kind: str, name, *values: str):
        return df.select(F.lit(kind).alias("kind"), name.cast("string").alias("name"), F.inline(F.array(*[
            F.struct(F.lit(v).alias("metric"), F.round(F.col(v).cast("double"), 6).alias("value")) for v in values])))

    overall = told(forecast.forecast_metrics(scored), "all", F.lit(""), "rows", "rmse", "mae", "baseline_rmse", "beats_baseline")
    zones = told(forecast.zone_metrics(scored), "zone", F.col("zone_id").cast("int"), "model_rmse", "baseline_rmse")
    inputs = told(forecast.feature_importances(model, spark), "input", F.col("feature"), "importance")
    return overall.unionByName(zones).unionByName(inputs)
