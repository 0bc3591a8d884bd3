"""The model graph: every model in dependency order, built lazily once.

``FeedModels`` takes the raw feed tables (all-STRING DataFrames keyed by
table name) and exposes each model as a cached attribute.  Staging models
stay lazy views; nothing is computed until a caller runs an action or
writes a model out (see ``headway.plans.build``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import calendar as cal
from headway.operators import dims, joins, presentation, schedule, staging
from headway.operators.fact_checks import Weighted, found_once, stop_event_fact, trip_fact
from headway.operators.joins import ROWS_PER_TASK, cells, partitions_for, spread
from headway.session import stored_table
from headway.sources.schemas import conform, empty_table, raw_schema

# Model name -> (layer, upstream models).  Layers decide how a
# model is materialized: staging stays a lazy view, intermediate models are
# inlined where they are used, marts are written as tables.
MODEL_GRAPH: dict[str, tuple[str, tuple[str, ...]]] = {
    "stg_stops": ("staging", ()),
    "stg_routes": ("staging", ()),
    "stg_trips": ("staging", ()),
    "stg_stop_times": ("staging", ()),
    "stg_calendar": ("staging", ()),
    "stg_calendar_dates": ("staging", ()),
    "stg_frequencies": ("staging", ()),
    "dim_date": ("marts_core", ()),
    "service_calendar": ("intermediate", ("stg_calendar", "dim_date", "stg_calendar_dates")),
    "dim_route": ("marts_core", ("stg_routes",)),
    "dim_stop": ("marts_core", ("stg_stops",)),
    "dim_service": ("marts_core", ("stg_calendar", "service_calendar")),
    "fact_scheduled_trip": ("marts_core", ("stg_frequencies", "stg_trips", "dim_route",
                                           "dim_service")),
    "fact_scheduled_stop_event": ("marts_core", ("fact_scheduled_trip", "stg_stop_times")),
    "presentation_route_summary": ("marts_presentation", ("dim_route", "fact_scheduled_trip",
                                                          "fact_scheduled_stop_event")),
    "presentation_daily_stop_arrivals": ("marts_presentation", ("fact_scheduled_stop_event",
                                                                "service_calendar")),
    "presentation_hourly_network_density": ("marts_presentation", (
        "fact_scheduled_stop_event", "dim_route", "service_calendar")),
}


def build_order() -> list[str]:
    """Models sorted so every model comes after its upstreams."""
    done: list[str] = []

    def visit(name: str, trail: tuple[str, ...] = ()) -> None:
        if name in done:
            return
        if name in trail:
            raise ValueError(f"cycle through {name}")
        for up in MODEL_GRAPH[name][1]:
            visit(up, trail + (name,))
        done.append(name)

    for model in MODEL_GRAPH:
        visit(model)
    return done


#: Columns of raw rows that tell feeds or snapshots apart.
ORIGIN_COLUMNS = ("snapshot_date", "archive", "source_path")

#: Columns of ``window_stops`` that marts and checks read.
PAIR_COLUMNS = ("feed_key", "trip_id", "route_id", "service_id", "stop_id", "stop_sequence",
                "window_start_seconds", "window_end_seconds", "headway_seconds", "n_departures",
                "arrival_offset_seconds", "departure_offset_seconds")

#: Raw id columns: with several feeds, ids of one feed mean nothing in another.
ID_COLUMNS = {
    "stops": ("stop_id", "parent_station"), "routes": ("route_id",),
    "trips": ("trip_id", "route_id", "service_id", "shape_id"),
    "stop_times": ("trip_id", "stop_id"), "calendar": ("service_id",),
    "calendar_dates": ("service_id",), "frequencies": ("trip_id",),
}


def with_feed_key(raw: DataFrame, table: str, feed_key: Sequence[str]) -> DataFrame:
    """``raw`` plus ``feed_key`` (the columns' values joined with '/'), and
    every id in the form '<feed_key>:<id>'.  ':' and '%' in the key are
    written %3A and %25, so different ids stay different."""
    missing = [c for c in feed_key if c not in raw.columns]
    if missing:
        raise ValueError(f"{table} lacks the feed key columns {missing}")
    key = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in feed_key])
    key = F.replace(F.replace(key, F.lit("%"), F.lit("%25")), F.lit(":"), F.lit("%3A"))
    keyed = raw.withColumn("feed_key", key)
    return keyed.withColumns({c: F.concat("feed_key", F.lit(":"), c)
                              for c in ID_COLUMNS.get(table, ())})


class FeedModels:
    """All models of one feed, or of several.

    For several feeds or snapshots at once, ``feed_key`` names the raw
    columns that tell them apart (for example ``snapshot_date``).  Ids are
    then qualified by the feed they come from, so joins, groups and surrogate
    keys never mix feeds, and models that have no id in their grain carry
    ``feed_key``.  Raw tables that hold several snapshots but come without a
    feed key are refused: their joins would multiply rows."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 spine_start: dt.date = cal.SPINE_START, spine_end: dt.date = cal.SPINE_END,
                 feed_key: Sequence[str] = ()):
        self.spark = spark
        self.raw = {name: conform(df, name) for name, df in raw.items()}
        self.feed_key = tuple(feed_key)
        for name in staging.STAGING:
            if name not in self.raw:
                self.raw[name] = (spark.createDataFrame([], raw_schema(name, self.feed_key))
                                  if feed_key else empty_table(spark, name))
        if feed_key:
            self.raw = {n: with_feed_key(df, n, self.feed_key) for n, df in self.raw.items()}
        else:
            self._refuse_several_feeds()
        self.spine_start = spine_start
        self.spine_end = spine_end

    def _refuse_several_feeds(self) -> None:
        for column in ORIGIN_COLUMNS:
            parts = [self.raw[n].select(F.col(column).cast("string").alias("origin"))
                     for n in staging.STAGING if column in self.raw[n].columns]
            if not parts:
                continue
            every = parts[0]
            for p in parts[1:]:
                every = every.union(p)
            found = every.agg(F.min("origin").alias("a"), F.max("origin").alias("z")).first()
            if found.a != found.z:
                raise ValueError(f"the raw tables hold several values of {column} "
                                 f"({found.a!r} to {found.z!r}): name a feed_key")

    @classmethod
    def from_bridge(cls, spark: SparkSession, sf_dir: str, stored: bool = True) -> "FeedModels":
        """Models over the feed mapped from the test tables at ``sf_dir``;
        ``stored`` reads the raw tables from their stored copy (written once)."""
        from headway.sources.bridge import raw_feed, raw_folder, stored_raw_feed
        if not stored:
            return cls(spark, raw_feed(spark, sf_dir))
        models = cls(spark, stored_raw_feed(spark, sf_dir))
        models.kept_in = raw_folder(spark, sf_dir)
        return models

    #: Folder of the raw tables' present state, where what several jobs need
    #: of them is stored once for all; None: each FeedModels has its own.
    kept_in: str | None = None

    def _kept(self, build, name: str) -> DataFrame:
        if self.kept_in is None:
            return stored_table(build(), name)
        from headway.sources.bridge import stored_once
        return stored_once(build, f"{self.kept_in}/{name}", self.spark)

    # staging -------------------------------------------------------------
    @cached_property
    def stg_stops(self) -> DataFrame:
        return staging.stg_stops(self.raw["stops"])

    @cached_property
    def stg_routes(self) -> DataFrame:
        return staging.stg_routes(self.raw["routes"])

    @cached_property
    def stg_trips(self) -> DataFrame:
        return staging.stg_trips(self.raw["trips"])

    @cached_property
    def stg_stop_times(self) -> DataFrame:
        return staging.stg_stop_times(self.raw["stop_times"])

    @cached_property
    def stg_calendar(self) -> DataFrame:
        return staging.stg_calendar(self.raw["calendar"])

    @cached_property
    def stg_calendar_dates(self) -> DataFrame:
        return staging.stg_calendar_dates(self.raw["calendar_dates"])

    @cached_property
    def stg_frequencies(self) -> DataFrame:
        return staging.stg_frequencies(self.raw["frequencies"])

    # calendar ------------------------------------------------------------
    @cached_property
    def date_spine(self) -> DataFrame:
        return cal.date_spine(self.spark, self.spine_start, self.spine_end)

    @cached_property
    def dim_date(self) -> DataFrame:
        return cal.dim_date(self.spark, self.spine_start, self.spine_end)

    @cached_property
    def service_calendar(self) -> DataFrame:
        return cal.service_calendar(self.stg_calendar, self.stg_calendar_dates,
                                    self.spine_start, self.spine_end)

    # dimensions ----------------------------------------------------------
    @cached_property
    def dim_route(self) -> DataFrame:
        return dims.dim_route(self.stg_routes)

    @cached_property
    def dim_stop(self) -> DataFrame:
        return dims.dim_stop(self.stg_stops)

    @cached_property
    def dim_service(self) -> DataFrame:
        return dims.dim_service(self.stg_calendar, self.service_calendar)

    # what each trip will emit ---------------------------------------------
    #: Rows a task should emit; trips beyond it are cut into cells.
    rows_per_task = ROWS_PER_TASK

    @cached_property
    def frequency_windows(self) -> DataFrame:
        return schedule.frequency_windows(self.stg_frequencies)

    @cached_property
    def trip_stop_stats(self) -> DataFrame:
        return schedule.trip_stop_stats(self.stg_stop_times)

    @cached_property
    def trip_loads(self) -> DataFrame:
        """Per trip: windows, departures, stop rows; stored, as both the sizes
        below and the grids read it."""
        return self._kept(lambda: schedule.trip_loads(self.frequency_windows,
                                                      self.trip_stop_stats), "trip_loads")

    @cached_property
    def load(self) -> dict[str, int]:
        """Totals and maxima of ``trip_loads``: one row reaches the driver."""
        row = self.trip_loads.agg(
            F.sum("n_departures").alias("departures"),
            F.sum(F.col("n_departures") * F.col("n_stop_rows")).alias("visits"),
            F.max("n_windows").alias("max_windows"),
            F.max("n_departures").alias("max_departures"),
            F.max(F.col("n_departures") * F.col("n_stop_rows")).alias("max_visits"),
            F.max(F.col("n_windows") * F.col("n_stop_rows")).alias("max_pairs")).first()
        return {k: v or 0 for k, v in row.asDict().items()}

    @property
    def trip_tasks(self) -> int | None:
        """Tasks that the facts are dealt over by trip: one deal serves their
        joins, their expansion and what is grouped by trip afterwards.  None:
        some trip is too much for a task."""
        limit = min(self.rows_per_task, joins.ROWS_PER_TASK)
        if max(self.load["max_visits"], self.load["max_departures"]) > limit:
            return None
        return partitions_for(self.spark, self.load["visits"], limit)

    # schedule ------------------------------------------------------------
    @cached_property
    def trip_windows(self) -> DataFrame:
        grid = None
        if self.load["max_windows"] > self.rows_per_task:
            grid = cells(self.trip_loads.withColumn("one", F.lit(1).cast("long")), "n_windows",
                         "one", self.rows_per_task)
        return schedule.trip_windows(self.frequency_windows, self.stg_trips, self.dim_route,
                                     self.dim_service, grid)

    @cached_property
    def dealt_windows(self) -> DataFrame | None:
        """``trip_windows`` in ``trip_tasks`` by trip, joined where they are."""
        if self.trip_tasks is None:
            return None
        windows = self.__dict__.get("trip_windows")     # a stored table
        if windows is None:
            windows = schedule.trip_windows(self.frequency_windows, self.stg_trips, self.dim_route,
                                            self.dim_service, tasks=self.trip_tasks)
        # Spark leaves this out where routes and services were broadcast.
        return windows.repartition(self.trip_tasks, "trip_id")

    @cached_property
    def fact_scheduled_trip(self) -> DataFrame:
        if self.dealt_windows is not None:
            return schedule.fact_scheduled_trip(self.dealt_windows)
        return schedule.fact_scheduled_trip(spread(
            self.trip_windows, self.load["departures"], "trip_id", "window_start_seconds",
            "window_end_seconds", "headway_seconds"))

    @cached_property
    def stop_offsets(self) -> DataFrame:
        return schedule.stop_offsets(self.stg_stop_times, self.trip_stop_stats)

    @cached_property
    def trip_stops(self) -> DataFrame:
        """Stop rows with their trip's departures (no times, no windows)."""
        return schedule.trip_stops(schedule.trip_totals(self.trip_windows), self.stg_stop_times)

    @cached_property
    def window_stops(self) -> DataFrame:
        grid = None
        if self.load["max_pairs"] > self.rows_per_task:
            grid = cells(self.trip_loads, "n_windows", "n_stop_rows", self.rows_per_task)
        return schedule.window_stops(self.trip_windows, self.stg_stop_times,
                                     self.trip_loads, grid)

    @cached_property
    def fact_scheduled_stop_event(self) -> DataFrame:
        if self.dealt_windows is not None:
            # No trip is too much for a task: its rows are dealt before they
            # are joined, so the pairs, which are far more, stay where they are.
            return schedule.fact_scheduled_stop_event(schedule.window_stops(
                self.dealt_windows, self.stg_stop_times, self.trip_loads, tasks=self.trip_tasks))
        return schedule.fact_scheduled_stop_event(spread(
            self.window_stops, self.load["visits"], "trip_id", "window_start_seconds",
            "headway_seconds", "stop_sequence", "stop_id"))

    @cached_property
    def weighted_facts(self) -> dict[str, Weighted]:
        """The facts as weighted rows, to be checked without forming them."""
        windows = stored_table(self.trip_windows, "trip_windows")
        self.__dict__["trip_windows"] = windows
        repeated = found_once(windows)
        return {"fact_scheduled_trip": trip_fact(windows, repeated),
                "fact_scheduled_stop_event": stop_event_fact(
                    windows, self.stg_stop_times, self.trip_loads, lambda: self.stored_pairs,
                    repeated)}

    @cached_property
    def stored_pairs(self) -> DataFrame:
        """What marts and checks read of ``window_stops``, stored; marts that
        are asked for afterwards read it."""
        columns = [c for c in PAIR_COLUMNS if c in self.window_stops.columns]
        return stored_table(self.window_stops.select(*columns), "pairs")

    @property
    def pairs(self) -> DataFrame:
        return self.__dict__.get("stored_pairs", self.window_stops)

    # presentation --------------------------------------------------------
    @cached_property
    def presentation_route_summary(self) -> DataFrame:
        # Distinct stops are those of the pairs, too.
        return presentation.route_summary(self.dim_route, self.trip_windows,
                                          self.__dict__.get("stored_pairs", self.trip_stops))

    @cached_property
    def presentation_daily_stop_arrivals(self) -> DataFrame:
        return presentation.daily_stop_arrivals(self.pairs, self.service_calendar)

    @cached_property
    def presentation_hourly_network_density(self) -> DataFrame:
        return presentation.hourly_network_density(self.pairs, self.dim_route,
                                                   self.service_calendar)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    PRESENTATION_ALIASES = {
        "route_summary": "presentation_route_summary",
        "daily_stop_arrivals": "presentation_daily_stop_arrivals",
        "hourly_network_density": "presentation_hourly_network_density",
    }

    def table(self, name: str) -> DataFrame:
        """Any layer's table by name: ``raw_<table>``, staging, dims, facts,
        or a presentation mart (with or without its ``presentation_`` prefix)."""
        if name.startswith("raw_"):
            return self.raw[name[4:]]
        return getattr(self, self.PRESENTATION_ALIASES.get(name, name))
