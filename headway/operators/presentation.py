"""Presentation marts: route summary, daily stop arrivals, hourly density.

These marts only need *counts* of departures and stop visits, so they are
computed from the pre-expansion tables (``trip_windows``: one row per
frequency window; ``window_stops``: one row per window and stop row) with
closed-form series arithmetic, instead of from the exploded facts.  The
results are the same rows the exploded facts would give (tests compare them
with a brute-force expansion); the work no longer grows with the number of
departures per window.

The date-grained marts keep the template -> expand -> re-aggregate shape:
visits are first counted per (service, ..., next-day offset), the small
template is summed over services with the same active dates, joined with
those, and only then re-summed to the clock-date grain.  Catalyst does not push an aggregate through that
join, so the order is written out here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.series import (col, count_in_range, hour_numbers, hour_of_number,
                                      hours_spanned)
from headway.functions.times import SECONDS_PER_DAY, clock_date
from headway.operators.calendar import date_classes
from headway.operators.joins import spread


def _series_bounds(offset: str | None = None) -> tuple[str, str, str]:
    """SQL (first, step, count) of a window's series in ascending order,
    shifted by ``offset`` (a negative headway counts down, so it is flipped)."""
    first = ("least(window_start_seconds, window_start_seconds"
             " + (n_departures - 1) * headway_seconds)")
    if offset is not None:
        first = f"({first} + {offset})"
    return first, "abs(headway_seconds)", "n_departures"


def _feed(df: DataFrame) -> list[str]:
    return [c for c in ("feed_key",) if c in df.columns]


# --- route summary --------------------------------------------------------

def route_trip_summary(windows: DataFrame) -> DataFrame:
    """Per route: distinct trips, departures, distinct services and headway
    statistics over *departures* (a window counts once per departure)."""
    start = F.col("window_start_seconds")
    h = F.col("headway_seconds")
    n = F.col("n_departures")
    last = start + (n - 1) * h
    return windows.groupBy("route_id").agg(
        F.countDistinct("trip_id").alias("distinct_trips_count"),
        F.sum(n).alias("abstract_departures_count"),
        F.countDistinct("service_id").alias("distinct_services_count"),
        (F.sum(h * n) / F.sum(n)).alias("avg_headway_seconds"),
        F.min(h).alias("min_headway_seconds"),
        F.max(h).alias("max_headway_seconds"),
        F.min(F.least(start, last)).alias("first_departure_seconds"),
        F.max(F.greatest(start, last)).alias("last_departure_seconds"),
    )


def route_stop_summary(trip_stops: DataFrame) -> DataFrame:
    """Per route: distinct stops visited by at least one departure."""
    return trip_stops.groupBy("route_id").agg(
        F.countDistinct("stop_id").alias("distinct_stops_served"))


def route_summary(dim_route: DataFrame, windows: DataFrame, trip_stops: DataFrame) -> DataFrame:
    """One row per route with template-level KPIs; routes without trips keep
    zero counts and NULL headways."""
    trips = route_trip_summary(windows)
    stops = route_stop_summary(trip_stops)
    zero = F.lit(0).cast("long")
    avg = F.col("avg_headway_seconds")
    return (dim_route.join(trips, "route_id", "left").join(stops, "route_id", "left").select(
        "route_id", "route_short_name", "route_long_name", "service_category", "route_color_hex",
        F.coalesce("distinct_trips_count", zero).alias("distinct_trips_count"),
        F.coalesce("abstract_departures_count", zero).alias("abstract_departures_count"),
        F.coalesce("distinct_stops_served", zero).alias("distinct_stops_served"),
        F.coalesce("distinct_services_count", zero).alias("distinct_services_count"),
        F.round(avg, 0).alias("avg_headway_seconds"),
        "min_headway_seconds", "max_headway_seconds",
        F.round(avg / F.lit(60.0), 1).alias("avg_headway_minutes"),
        "first_departure_seconds", "last_departure_seconds",
        F.round((F.col("last_departure_seconds") - F.col("first_departure_seconds"))
                / F.lit(3600.0), 1).alias("service_window_hours"), *_feed(dim_route)))


# --- visit counts per pair ------------------------------------------------

def visits_by_day_offset(pairs: DataFrame) -> DataFrame:
    """Per (window, stop row): visits on the service date (offset 0) and on
    the next clock date (offset 1, arrival >= 24:00:00).  A NULL arrival
    counts on offset 0."""
    first, step, n = _series_bounds("arrival_offset_seconds")
    next_day = (f"CASE WHEN arrival_offset_seconds IS NULL THEN CAST(0 AS BIGINT) ELSE "
                f"{count_in_range(first, step, n, SECONDS_PER_DAY, None)} END")
    split = (f"inline(array(named_struct('next_day_offset', 0, 'visits', n_departures - ({next_day})),"
             f" named_struct('next_day_offset', 1, 'visits', {next_day})))")
    return pairs.select("*", col(split)).where("visits > 0")


def visits_by_service_hour(pairs: DataFrame) -> DataFrame:
    """Per (window, stop row): visits per service hour (arrival div 3600,
    hours 24+ kept).  A NULL arrival gives one NULL-hour entry."""
    first, step, n = _series_bounds("arrival_offset_seconds")
    untimed = "arrival_offset_seconds IS NULL"
    own = {"__first": first, "__step": step, "__span": hours_spanned(first, step, n)}
    # Only numbers are generated; what they stand for is arithmetic on columns.
    each = pairs.withColumns({c: F.expr(sql) for c, sql in own.items()}).select(
        "*", F.expr(f"explode(CASE WHEN {untimed} THEN array(CAST(0 AS BIGINT)) "
                    f"ELSE {hour_numbers(n, '__span')} END) AS __number"))
    hour, visits = hour_of_number("__first", "__step", n, "__span", "__number")
    return (each.withColumns({
        "service_hour": F.expr(f"CASE WHEN NOT ({untimed}) THEN {hour} END"),
        "visits": F.expr(f"CASE WHEN {untimed} THEN n_departures ELSE {visits} END")})
        .where("visits > 0").drop(*own, "__number"))


# --- date-grained marts ---------------------------------------------------

def _expand_over_dates(template: DataFrame, service_dates: DataFrame,
                       keys: list[str]) -> DataFrame:
    """template (service_id, keys, arrivals_count) x active dates.

    Services that run on the same dates are summed first (``date_classes``),
    so the rows to be joined grow with the classes, not the services.  Each of
    them becomes as many rows as its class has active dates (hundreds to
    thousands), so they, which are few, are dealt evenly first.  Active dates
    are broadcast if Spark finds them small; otherwise the join is a plain
    shuffle that AQE can split."""
    classes, dates = date_classes(service_dates)
    summed = template.join(classes, "service_id").groupBy("date_class", *keys).agg(
        F.sum("arrivals_count").alias("arrivals_count"))
    joined = spread(summed, None, "date_class", *keys).join(dates, "date_class")
    return joined.withColumn("clock_date", clock_date("service_date", "next_day_offset"))


def daily_stop_arrivals(pairs: DataFrame, service_dates: DataFrame) -> DataFrame:
    """Arrivals per (clock date, stop); hours 24+ count on the next date."""
    template = (visits_by_day_offset(pairs)
                .groupBy("service_id", "stop_id", "next_day_offset")
                .agg(F.sum("visits").alias("arrivals_count")))
    expanded = _expand_over_dates(template, service_dates, ["stop_id", "next_day_offset"])
    return expanded.groupBy("clock_date", "stop_id").agg(
        F.sum("arrivals_count").cast("long").alias("arrivals_count")) \
        .select(F.col("clock_date").alias("service_date"), "stop_id", "arrivals_count")


def hourly_template(pairs: DataFrame, dim_route: DataFrame) -> DataFrame:
    """Visits per (service, category, clock hour, next-day offset).  Routes
    missing from ``dim_route`` drop out (inner join)."""
    by_route = (visits_by_service_hour(pairs)
                .groupBy("service_id", "route_id", "service_hour")
                .agg(F.sum("visits").alias("visits")))
    routes = dim_route.select("route_id", "service_category", *_feed(dim_route))
    hour = F.col("service_hour")
    return (by_route.join(routes, "route_id")
            .groupBy("service_id", "service_category", *_feed(dim_route),
                     (hour % 24).alias("hour_of_day"),
                     F.when(hour >= 24, F.lit(1)).otherwise(F.lit(0)).alias("next_day_offset"))
            .agg(F.sum("visits").alias("arrivals_count")))


def hourly_network_density(pairs: DataFrame, dim_route: DataFrame,
                           service_dates: DataFrame) -> DataFrame:
    """Arrivals per (clock date, clock hour, service category)."""
    template = hourly_template(pairs, dim_route)
    expanded = _expand_over_dates(template, service_dates,
                                  ["service_category", "hour_of_day", "next_day_offset",
                                   *_feed(dim_route)])
    feed = _feed(dim_route)
    return expanded.groupBy("clock_date", "hour_of_day", "service_category", *feed).agg(
        F.sum("arrivals_count").cast("long").alias("arrivals_count")) \
        .select(F.col("clock_date").alias("service_date"), "hour_of_day", "service_category",
                "arrivals_count", *feed)
