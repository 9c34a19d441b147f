"""Tolerant JSON parsing: every field falls back to its default, bad text is set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.functions.plan import evaluated_once

BAD_RECORD = "_bad_record"

# Field -> (type, default) of the event payloads.
GPS_FIELDS = {
    "taxi_id": ("string", None), "trip_id": ("string", None), "timestamp": ("bigint", 0),
    "event_time": ("string", ""), "lat": ("double", 0.0), "lon": ("double", 0.0),
    "speed": ("double", 0.0), "status": ("string", "UNKNOWN"), "late_arrival": ("boolean", False),
    "anomaly": ("string", None), "blackout_duration_s": ("int", None),
}
NORMALIZED_GPS_FIELDS = {
    "taxi_id": ("string", ""), "zone_id": ("int", 0), "timestamp": ("bigint", 0),
    "lat": ("double", 0.0), "lon": ("double", 0.0), "status": ("string", ""),
}
TRIP_REQUEST_FIELDS = {
    "trip_id": ("string", ""), "rider_id": ("string", ""), "origin_zone": ("int", 0),
    "origin_zone_name": ("string", None), "destination_zone": ("int", 0),
    "destination_zone_name": ("string", None), "requested_at": ("bigint", 0),
    "request_time_iso": ("string", None), "event_time": ("string", None),
    "call_type": ("string", None), "late_arrival": ("boolean", False),
    "anomaly": ("string", None), "anomaly_zone": ("int", None), "fare": ("double", 0.0),
}


def _typed(text: Column, kind: str) -> Column:
    if kind == "string":
        return text
    if kind == "boolean":
        return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0)
    if kind == "double":
        return text.try_cast("double")
    # Integers also accept "12.7" and 1e3, cutting the fraction off.
    return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))


def parse_json_fields(df: DataFrame, column: str, fields: dict[str, tuple[str, object]],
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a JSON text column into typed fields plus ``_bad_record``.

    Fields are read as text and cast one by one, so one badly typed value
    costs that field its value and not the record. ``_bad_record`` holds the
    text of a record that is not a JSON object at all.
    """
    text_schema = ", ".join(f"`{name}` STRING" for name in fields)
    parsed = F.from_json(
        F.col("_text"), f"{text_schema}, `{BAD_RECORD}` STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD},
    )
    staged = evaluated_once(df.select(*keep, F.col(column).alias("_text")), "_p", parsed)
    typed = []
    for name, (kind, default) in fields.items():
        value = _typed(F.col(f"_p.`{name}`"), kind)
        typed.append((value if default is None else F.coalesce(value, F.lit(default))).alias(name))
    bad = F.when(F.col("_p").isNull(), F.coalesce(F.col("_text"), F.lit(""))) \
        .otherwise(F.col(f"_p.`{BAD_RECORD}`"))
    return staged.select(*keep, *typed, bad.alias(BAD_RECORD))


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Texts that could not be parsed."""
    return parsed.filter(F.col(BAD_RECORD).isNotNull()).select(F.col(BAD_RECORD).alias("text"))


def parse_gps(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw GPS events with the event clock ``ts``; batch or stream."""
    parsed = parse_json_fields(df, column, GPS_FIELDS, keep)
    return parsed.withColumn("ts", F.timestamp_seconds("timestamp"))


def parse_normalized_gps(df: DataFrame, column: str = "value") -> DataFrame:
    """Zone-mapped GPS events as the demand and matching jobs read them."""
    parsed = parse_json_fields(df, column, NORMALIZED_GPS_FIELDS)
    return parsed.withColumn("ts", F.timestamp_seconds("timestamp"))


def parse_trip_request(df: DataFrame, column: str = "value",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Trip requests; a missing ``requested_at`` falls back to the ISO ``event_time``."""
    parsed = parse_json_fields(df, column, TRIP_REQUEST_FIELDS, keep)
    from_iso = F.unix_timestamp(F.col("event_time").try_cast("timestamp"))
    requested = F.when(F.col("requested_at") > 0, F.col("requested_at")) \
        .otherwise(F.coalesce(from_iso, F.lit(0)))
    return parsed.withColumn("requested_at", requested.cast("bigint")) \
        .withColumn("ts", F.timestamp_seconds("requested_at")).drop("event_time")
