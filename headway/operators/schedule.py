"""Scheduled trips and stop visits from headway-based frequencies.

Shapes (at the reference's scale: 772 windows -> 70k departures -> 3M stop
visits):

* ``trip_windows``: one row per (frequency window, trip) with route and
  service attributes and the window's departure count.  All dimension joins
  happen here, *before* anything is expanded, on the smallest table.
* ``fact_scheduled_trip``: ``trip_windows`` exploded to one row per departure.
* ``trip_stop_stats``: per trip, the first arrival (minimum over the trip's
  stop times, NULLs ignored) and the number of stop rows.
* ``window_stops``: every (window, stop row) pair of the same trip, with the
  stop's offsets from the trip's first arrival.  It is the pre-expansion form
  of the stop-visit fact: a pair stands for ``n_departures`` visits.
* ``fact_scheduled_stop_event``: ``window_stops`` exploded per departure.

* ``trip_loads``: per trip, its windows, departures and stop rows.  It says
  how many rows each trip will emit before anything is joined, which sizes
  the expansions and cuts hot trips into cells (``joins.grid_join``).
* ``trip_totals`` and ``trip_stops``: departures per trip, and each stop row
  with its trip's departures, for marts that need no times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.keys import surrogate_key
from headway.functions.series import col, departure_count, departure_series
from headway.operators.joins import grid_join


def frequency_windows(stg_frequencies: DataFrame) -> DataFrame:
    """Frequency windows that yield at least one departure, with the count."""
    return (stg_frequencies
            .selectExpr("trip_id",
                        "start_seconds_from_service_midnight AS window_start_seconds",
                        "end_seconds_from_service_midnight AS window_end_seconds",
                        "headway_seconds", "is_exact_times",
                        departure_count("start_seconds_from_service_midnight",
                                        "end_seconds_from_service_midnight",
                                        "headway_seconds") + " AS n_departures")
            .where("n_departures > 0"))


def trip_windows(windows: DataFrame, stg_trips: DataFrame, dim_route: DataFrame,
                 dim_service: DataFrame, grid: DataFrame | None = None,
                 tasks: int | None = None) -> DataFrame:
    """Frequency windows (``frequency_windows``) joined to their trip, route
    and service.  Trips without a frequency row have no departures and do
    not appear (inner join); unknown routes/services keep NULL attributes.
    ``grid`` cuts trips with very many windows (see ``joins.cells``).  With
    ``tasks`` both sides are dealt over so many tasks by trip."""
    feed = [c for c in ("feed_key",) if c in stg_trips.columns]
    trips = stg_trips.select("trip_id", "route_id", "service_id", "direction_id",
                             "trip_headsign", "trip_short_name", "shape_id", *feed)
    if tasks:
        windows, trips = (d.repartition(tasks, "trip_id") for d in (windows, trips))
    joined = grid_join(windows, trips, ["trip_id"], grid)
    routes = dim_route.select(
        "route_id", F.col("service_category").alias("route_service_category"),
        "route_short_name", "route_long_name", "route_color_hex")
    services = dim_service.select(
        "service_id", "service_name",
        F.col("active_days_count").alias("service_active_days_count"))
    return joined.join(routes, "route_id", "left").join(services, "service_id", "left")


def _departures() -> F.Column:
    return col(departure_series("window_start_seconds", "window_end_seconds", "headway_seconds"))


def fact_scheduled_trip(windows: DataFrame) -> DataFrame:
    """One row per (trip, departure); the end of each window is exclusive."""
    dep = F.col("departure_seconds_from_service_midnight")
    return (windows
            .select("*", F.explode(_departures()).alias("departure_seconds_from_service_midnight"))
            .select(
                surrogate_key("trip_id", dep).alias("scheduled_trip_id"),
                "trip_id", "route_id", "service_id", "direction_id", "trip_headsign",
                "trip_short_name", "shape_id", dep,
                F.col("window_start_seconds").alias("source_window_start_seconds"),
                F.col("window_end_seconds").alias("source_window_end_seconds"),
                F.col("headway_seconds").alias("source_headway_seconds"),
                "is_exact_times", "route_service_category", "route_short_name",
                "route_long_name", "route_color_hex", "service_name",
                "service_active_days_count", *[c for c in windows.columns if c == "feed_key"]))


def trip_stop_stats(stg_stop_times: DataFrame) -> DataFrame:
    """Per trip: minimum arrival seconds (the offset base) and stop rows."""
    return stg_stop_times.groupBy("trip_id").agg(
        F.min("arrival_seconds_from_service_midnight").alias("trip_first_arrival_seconds"),
        F.count(F.lit(1)).alias("n_stop_rows"))


def trip_loads(windows: DataFrame, stats: DataFrame) -> DataFrame:
    """Per trip with departures: n_windows, n_departures, n_stop_rows, and
    the trip's first arrival."""
    per_trip = windows.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_windows"),
                                              F.sum("n_departures").alias("n_departures"))
    return per_trip.join(stats, "trip_id", "left").withColumn(
        "n_stop_rows", F.coalesce("n_stop_rows", F.lit(0)))


def stop_offsets(stg_stop_times: DataFrame, stats: DataFrame) -> DataFrame:
    """Each stop row's arrival and departure offset from the trip's first
    arrival.  The base is the minimum arrival, not the lowest sequence."""
    base = F.col("trip_first_arrival_seconds")
    joined = stg_stop_times.join(stats.select("trip_id", "trip_first_arrival_seconds"), "trip_id")
    return joined.select(
        "trip_id", "stop_id", "stop_sequence",
        (F.col("arrival_seconds_from_service_midnight") - base).alias("arrival_offset_seconds"),
        (F.col("departure_seconds_from_service_midnight") - base).alias("departure_offset_seconds"),
        "stop_headsign", "shape_distance_traveled")


def trip_totals(windows: DataFrame) -> DataFrame:
    """Per trip, with its route and category: departures over all windows."""
    keys = [c for c in ("feed_key", "trip_id", "route_id", "service_id", "route_service_category")
            if c in windows.columns]
    return windows.groupBy(*keys).agg(F.sum("n_departures").alias("n_departures"))


def trip_stops(totals: DataFrame, stg_stop_times: DataFrame) -> DataFrame:
    """Each stop row with its trip's route, category and departures: one row
    per trip and stop row, whatever the number of windows."""
    return stg_stop_times.select("trip_id", "stop_id").join(totals, "trip_id")


def window_stops(windows: DataFrame, stg_stop_times: DataFrame, stats: DataFrame,
                 grid: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """(window, stop row) pairs of the same trip with the stop offsets.
    ``grid`` cuts trips with very many pairs along both sides.  With ``tasks``
    the pairs are dealt over so many tasks by trip; all sides are, so nothing
    is shuffled after a join."""
    if tasks:
        # Only what is read of the stop rows is dealt.
        stg_stop_times = stg_stop_times.select(
            "trip_id", "stop_id", "stop_sequence", "arrival_seconds_from_service_midnight",
            "departure_seconds_from_service_midnight", "stop_headsign", "shape_distance_traveled")
        windows, stg_stop_times, stats = (d.repartition(tasks, "trip_id") for d in (
            windows, stg_stop_times, stats.select("trip_id", "trip_first_arrival_seconds")))
    stops = stg_stop_times.join(
        stats.select("trip_id", "trip_first_arrival_seconds"), "trip_id").select(
        "trip_id", "stop_id", "stop_sequence", "arrival_seconds_from_service_midnight",
        "departure_seconds_from_service_midnight", "trip_first_arrival_seconds",
        "stop_headsign", "shape_distance_traveled")
    pairs = grid_join(windows, stops, ["trip_id"], grid,
                      ["window_start_seconds", "window_end_seconds", "headway_seconds"],
                      ["stop_sequence", "stop_id"])
    base = F.col("trip_first_arrival_seconds")
    return pairs.select(
        *[c for c in pairs.columns if c not in (
            "arrival_seconds_from_service_midnight", "departure_seconds_from_service_midnight",
            "trip_first_arrival_seconds")],
        (F.col("arrival_seconds_from_service_midnight") - base).alias("arrival_offset_seconds"),
        (F.col("departure_seconds_from_service_midnight") - base).alias("departure_offset_seconds"))


def fact_scheduled_stop_event(pairs: DataFrame) -> DataFrame:
    """One row per (departure, stop row): the visit time is the departure
    plus the stop's offset."""
    dep = F.col("trip_start_seconds_from_service_midnight")
    trip_key = surrogate_key("trip_id", dep)
    return (pairs
            .select("*", F.explode(_departures()).alias("trip_start_seconds_from_service_midnight"))
            .select(
                surrogate_key(trip_key, "stop_sequence").alias("scheduled_stop_event_id"),
                trip_key.alias("scheduled_trip_id"),
                "trip_id", "route_id", "service_id", "stop_id", "direction_id", "stop_sequence",
                (dep + F.col("arrival_offset_seconds")).alias("arrival_seconds_from_service_midnight"),
                (dep + F.col("departure_offset_seconds")).alias("departure_seconds_from_service_midnight"),
                dep, "stop_headsign", "shape_distance_traveled", "route_short_name",
                "route_long_name", "route_service_category", "service_name",
                *[c for c in pairs.columns if c == "feed_key"]))


def with_visits(departures: DataFrame, events: DataFrame) -> DataFrame:
    """Rows of ``fact_scheduled_trip`` with their ``visits``, counted over the
    rows of ``fact_scheduled_stop_event`` (NULL where there are none).

    Overlapping windows repeat a departure, and its visits with it.  Where
    both facts are dealt by trip, a window over the rows of both brings them
    together where they are; a join on (trip, departure) would shuffle each
    of them again."""
    dep = "departure_seconds_from_service_midnight"
    counted = events.groupBy("trip_id", F.col("trip_start_seconds_from_service_midnight").alias(
        dep)).agg(F.count(F.lit(1)).alias("__events"))
    both = departures.withColumn("__events", F.lit(None).cast("long")).unionByName(
        counted, allowMissingColumns=True)
    key = Window.partitionBy("trip_id", dep)
    return both.withColumns({
        "__visits": F.max("__events").over(key),
        "__times": F.count(F.when(F.col("__events").isNull(), 1)).over(key)}).where(
        "__events IS NULL").select(*departures.columns, F.expr("__visits DIV __times").alias("visits"))
