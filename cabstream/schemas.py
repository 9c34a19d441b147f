"""Fixed schemas of the entities as DDL text (never inferred)."""

from __future__ import annotations

ZONE = (
    "zone_id INT, zone_name STRING, zone_type STRING, population_density INT, "
    "centroid_lat DOUBLE, centroid_lon DOUBLE, adjacency ARRAY<INT>"
)

GPS_RAW = (
    "taxi_id STRING, trip_id STRING, timestamp LONG, event_time STRING, lat DOUBLE, lon DOUBLE, "
    "speed DOUBLE, status STRING, late_arrival BOOLEAN, anomaly STRING, blackout_duration_s INT"
)

GPS_NORMALIZED = (
    "taxi_id STRING, trip_id STRING, timestamp LONG, event_time STRING, lat DOUBLE, lon DOUBLE, "
    "speed DOUBLE, status STRING, city STRING, zone_id INT, zone_name STRING, late_arrival BOOLEAN"
)

TRIP_REQUEST = (
    "trip_id STRING, rider_id STRING, origin_zone INT, origin_zone_name STRING, "
    "destination_zone INT, destination_zone_name STRING, requested_at LONG, "
    "request_time_iso STRING, call_type STRING, late_arrival BOOLEAN, anomaly STRING, "
    "anomaly_zone INT, fare DOUBLE"
)

DEMAND_WINDOW = (
    "city STRING, zone_id INT, window_start TIMESTAMP, active_vehicles INT, "
    "pending_requests INT, ratio DOUBLE, forecasted_demand DOUBLE, centroid_lat DOUBLE, "
    "centroid_lon DOUBLE"
)

MATCH_RESULT = (
    "trip_id STRING, taxi_id STRING, origin_zone INT, dest_zone INT, rider_id STRING, "
    "fare DOUBLE, eta_seconds INT, matched BOOLEAN, matched_zone INT, timestamp LONG, "
    "event_time STRING"
)

TRIP_RAW = (
    "TRIP_ID STRING, CALL_TYPE STRING, ORIGIN_CALL INT, ORIGIN_STAND INT, TAXI_ID INT, "
    "TIMESTAMP LONG, DAY_TYPE STRING, MISSING_DATA BOOLEAN, POLYLINE STRING"
)

TRIP_CURATED = (
    "TRIP_ID STRING, CALL_TYPE STRING, ORIGIN_CALL INT, ORIGIN_STAND INT, TAXI_ID INT, "
    "TIMESTAMP LONG, DAY_TYPE STRING, MISSING_DATA BOOLEAN, POLYLINE STRING, hour_of_day INT, "
    "day_of_week INT, trip_distance_km DOUBLE, CASA_ORIGIN_ZONE INT, trip_duration_sec INT, "
    "CASA_ORIGIN_ZONE_NAME STRING, CASA_ORIGIN_ZONE_TYPE STRING, year_month STRING"
)

TRIP_RECORD = (
    "PULocationID INT, tpep_pickup_datetime TIMESTAMP, fare_amount DOUBLE, "
    "trip_distance DOUBLE, passenger_count DOUBLE"
)

WEATHER_HOUR = ("time_slot_1h TIMESTAMP, temperature_2m DOUBLE, rain DOUBLE")

KPI_AGGREGATE = (
    "kpi_name STRING, category STRING, subcategory STRING, label STRING, value DOUBLE"
)
