"""Dimensions: route, stop, service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import (LOCATION_TYPE_NAMES, WEEKDAY_FLAGS,
                                      WHEELCHAIR_BOARDING_NAMES, decode_sql, service_category,
                                      service_name_sql)


def dim_route(stg_routes: DataFrame) -> DataFrame:
    """Routes with ``service_category`` (route description; empty -> Unknown)."""
    return stg_routes.select(
        "route_id", "route_short_name", "route_long_name", "route_description",
        service_category("route_description").alias("service_category"),
        "route_type_code", "route_type_name", "route_color_hex", "route_text_color_hex",
        "agency_id", *[c for c in stg_routes.columns if c == "feed_key"],
    )


def dim_stop(stg_stops: DataFrame) -> DataFrame:
    """Stops with decoded location type and wheelchair boarding."""
    return stg_stops.selectExpr(
        "stop_id", "stop_code", "stop_name", "stop_description", "stop_latitude",
        "stop_longitude", "zone_id", "parent_station_id", "location_type",
        decode_sql("location_type", LOCATION_TYPE_NAMES) + " AS location_type_name",
        "location_type = 1 AS is_station",
        "wheelchair_boarding_code",
        decode_sql("wheelchair_boarding_code", WHEELCHAIR_BOARDING_NAMES)
        + " AS wheelchair_boarding_name",
    )


def service_activity(service_dates: DataFrame) -> DataFrame:
    """Per service: number of active days, first and last active date."""
    return service_dates.groupBy("service_id").agg(
        F.count(F.lit(1)).alias("active_days_count"),
        F.min("service_date").alias("first_active_date"),
        F.max("service_date").alias("last_active_date"),
    )


def dim_service(stg_calendar: DataFrame, service_dates: DataFrame) -> DataFrame:
    """One row per calendar service: name from the weekday pattern, window,
    active-day statistics (0 when never active).  Services that appear only
    in calendar exceptions get no row."""
    activity = service_activity(service_dates)
    return stg_calendar.join(activity, "service_id", "left").select(
        "service_id",
        F.expr(service_name_sql("service_id")).alias("service_name"),
        "service_start_date", "service_end_date",
        F.coalesce(F.col("active_days_count"), F.lit(0).cast("long")).alias("active_days_count"),
        "first_active_date", "last_active_date",
        *WEEKDAY_FLAGS,
    )
