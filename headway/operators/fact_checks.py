"""Checks on the two facts without forming their rows.

A frequency window stands for its departures, and a stop row for as many
visits as its trip has departures, so a check on a fact is a check on windows
or stop rows that counts what each stands for:

* columns that all of a window's (or stop row's) fact rows share are checked
  once and weighted by ``n_rows``;
* of the departures themselves, those out of bounds are counted in closed
  form;
* a departure key repeats where two windows of a trip share a departure.
  Windows are laid on a grid of (trip, hour); only hours that more than one
  window has departures in are expanded, to those departures;
* a stop visit's key is a departure key and a stop sequence, so it repeats
  where either does: with D departures of which d are repeated, and S
  sequences of which s are, D * s + d * (S - s) keys repeat in a trip.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.keys import surrogate_key
from headway.functions.series import count_in_range, departure_series, hour_buckets
from headway.session import stored_table

DEPARTURE = "departure_seconds_from_service_midnight"
ARRIVAL = "arrival_seconds_from_service_midnight"


@dataclass(frozen=True)
class Weighted:
    """A fact as rows that stand for several: ``rows`` has the checked columns
    and ``n_rows``; ``series`` names a column whose values differ among them,
    given by ``first``, ``step`` and ``n_rows``; ``repeats`` has one row per
    repeated key: (``key`` parts as text, n_keys).  Both are made when a check
    first asks for them."""
    make_rows: Callable[[], DataFrame]
    make_repeats: Callable[[], DataFrame]
    series: str | None = None

    @cached_property
    def rows(self) -> DataFrame:
        return self.make_rows()

    @cached_property
    def repeats(self) -> DataFrame:
        return self.make_repeats()


def out_of_range(low: int, high: int) -> str:
    """SQL: how many of a window's departures lie outside [low, high]."""
    # A series that counts down is the same set of values counted up.
    least = "least(first, first + (n_rows - 1) * step)"
    return f"(n_rows - {count_in_range(least, 'abs(step)', 'n_rows', low, high)})"


def repeated_departures(windows: DataFrame) -> DataFrame:
    """(trip_id, departure, times) of departures that several windows of a
    trip have."""
    start, end, step = "window_start_seconds", "window_end_seconds", "headway_seconds"
    least = f"least({start}, {start} + (n_departures - 1) * {step})"
    hours = windows.select(
        "trip_id", start, end, step, F.expr(f"explode({hour_buckets(least, f'abs({step})', 'n_departures')})")
        .alias("b")).select("trip_id", start, end, step, F.col("b.bucket").alias("hour"))
    # Equal windows are counted, not repeated, before anything is shuffled
    # back; a window whose twin is there shares all its hours.
    cells = hours.groupBy("trip_id", start, end, step, "hour").agg(F.count(F.lit(1)).alias("times"))
    cells = stored_table(cells, "hours")
    shared = (cells.groupBy("trip_id", "hour").agg(F.sum("times").alias("n")).where("n > 1")
              .select("trip_id", "hour"))
    each = cells.join(shared, ["trip_id", "hour"]).select("trip_id", "times", F.expr(
        f"explode(filter({departure_series(start, end, step)}, d -> d div 3600 = hour))")
        .alias("departure"))
    return (each.groupBy("trip_id", "departure").agg(F.sum("times").alias("times"))
            .where("times > 1"))


def found_once(windows: DataFrame) -> Callable[[], DataFrame]:
    """``repeated_departures``, found and stored when first asked for: both
    facts' keys repeat by them."""
    return cache(lambda: stored_table(repeated_departures(windows), "repeated"))


def trip_fact(windows: DataFrame, repeated: Callable[[], DataFrame] | None = None) -> Weighted:
    """``fact_scheduled_trip`` by its windows (``trip_windows``, stored)."""
    repeated = repeated or found_once(windows)
    rows = windows.select(
        surrogate_key("trip_id", F.col("window_start_seconds")).alias("scheduled_trip_id"),
        "trip_id", "route_id", "service_id", F.col("window_start_seconds").alias(DEPARTURE),
        F.col("headway_seconds").alias("source_headway_seconds"),
        F.col("window_start_seconds").alias("first"), F.col("headway_seconds").alias("step"),
        F.col("n_departures").alias("n_rows"))

    def found() -> DataFrame:
        return repeated().select(F.concat_ws("|", "trip_id", "departure").alias("key"),
                                 F.lit(1).cast("long").alias("n_keys"))

    return Weighted(lambda: rows, found, DEPARTURE)


def stop_event_fact(windows: DataFrame, stg_stop_times: DataFrame, stats: DataFrame,
                    pairs: Callable[[], DataFrame] | None = None,
                    repeated: Callable[[], DataFrame] | None = None) -> Weighted:
    """``fact_scheduled_stop_event`` by stop rows of trips with departures, or
    by ``pairs`` (stored window_stops) where others read them too."""
    repeated = repeated or found_once(windows)
    return Weighted(lambda: (_pair_rows(pairs()) if pairs else
                             _stop_rows(windows, stg_stop_times, stats)),
                    lambda: _repeated_visits(windows, stg_stop_times, repeated()))


def _pair_rows(pairs: DataFrame) -> DataFrame:
    first = F.col("window_start_seconds")
    trip_key = surrogate_key("trip_id", first)
    return pairs.select(
        surrogate_key(trip_key, "stop_sequence").alias("scheduled_stop_event_id"),
        trip_key.alias("scheduled_trip_id"), "trip_id", "route_id", "stop_id", "stop_sequence",
        (first + F.col("arrival_offset_seconds")).alias(ARRIVAL),
        (first + F.col("departure_offset_seconds")).alias(DEPARTURE),
        F.col("n_departures").alias("n_rows"))


def _stop_rows(windows: DataFrame, stg_stop_times: DataFrame, stats: DataFrame) -> DataFrame:
    totals = windows.groupBy("trip_id", "route_id").agg(
        F.sum("n_departures").alias("n_rows"), F.min("window_start_seconds").alias("first"))
    stops = stg_stop_times.join(stats.select("trip_id", "trip_first_arrival_seconds"), "trip_id")
    base = F.col("trip_first_arrival_seconds")
    rows = stored_table(stops.join(totals, "trip_id").select(
        "trip_id", "route_id", "stop_id", "stop_sequence", "first",
        (F.col("first") + F.col(ARRIVAL) - base).alias(ARRIVAL),
        (F.col("first") + F.col(DEPARTURE) - base).alias(DEPARTURE), "n_rows"), "stop_rows")
    # The keys are made by the checks that read them.
    trip_key = surrogate_key("trip_id", F.col("first"))
    return rows.select(
        surrogate_key(trip_key, "stop_sequence").alias("scheduled_stop_event_id"),
        trip_key.alias("scheduled_trip_id"), *[c for c in rows.columns if c != "first"])


def _repeated_visits(windows: DataFrame, stg_stop_times: DataFrame, repeated: DataFrame
                     ) -> DataFrame:
    # Null sequences are one key, as in the surrogate key.
    sequences = stg_stop_times.groupBy("trip_id", "stop_sequence").agg(
        F.count(F.lit(1)).alias("n")).groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("s_all"), F.count(F.when(F.col("n") > 1, 1)).alias("s"))
    every = windows.groupBy("trip_id").agg(F.sum("n_departures").alias("n"))
    twice = repeated.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("d"), F.sum(F.col("times") - 1).alias("extra"))
    trips = sequences.join(every, "trip_id").join(twice, "trip_id", "left").select(
        F.col("trip_id").alias("key"), F.expr(
            "(n - coalesce(extra, 0)) * s + coalesce(d, 0) * (s_all - s)").alias("n_keys"))
    return stored_table(trips.where("n_keys > 0"), "repeats")
