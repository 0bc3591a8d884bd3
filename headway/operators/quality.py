"""Declarative data-quality checks.

Each check kind has a function returning its *failing rows* (what a person
looks at when a check fails), and ``run_checks`` evaluates a whole list of
checks into one summary DataFrame ``(check_id, check_type, model,
column_name, failures, status)``.  ``failures`` counts what the check's
failing-row query returns:

* not_null               rows where the column is NULL
* unique                 distinct non-NULL values that occur more than once
* accepted_values        distinct non-NULL values outside the list
* relationships          child rows (non-NULL key) with no parent row
* between                rows (matching the row condition) outside the bounds;
                         NULL values pass
* unique_combination     column combinations that occur more than once

Row-level kinds (not_null, accepted_values, between) of one model are all
evaluated in a single aggregation pass over that model; key kinds group once
per check.  A relationship check counts the child's rows per key first, so
that only distinct keys are shuffled and compared.  Nothing is cached: the
checks are meant to run over written tables; models that aren't written yet
are stored once (``stored_resolver``), and the facts are checked without
forming their rows (``fact_checks``).  ``failing_rows`` lists what fails.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.operators.fact_checks import Weighted, out_of_range
from headway.session import stored_table


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str | tuple[str, ...]
    values: tuple = ()
    min_value: float | int | None = None
    max_value: float | int | None = None
    row_condition: str | None = None
    to: str | None = None
    field: str | None = None
    quote: bool = True

    @property
    def check_id(self) -> str:
        col = "__".join(self.column) if isinstance(self.column, tuple) else self.column
        extra = f"__{self.to}" if self.to else ""
        return f"{self.kind}__{self.model}__{col}{extra}"

    @property
    def column_name(self) -> str:
        return ",".join(self.column) if isinstance(self.column, tuple) else self.column


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


# --- failing rows per kind ------------------------------------------------------

def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _packed(key: F.Column) -> F.Column:
    """A text as bytes, for grouping and joining: hex digits, as surrogate
    keys are, take half the room.  The first byte tells which it is, so
    different texts stay different."""
    raw = F.unhex(key)
    return F.when(F.lower(F.hex(raw)) == key, F.concat(F.unhex(F.lit("01")), raw)).otherwise(
        F.concat(F.unhex(F.lit("00")), key.cast("binary")))


def _unpacked(key: F.Column) -> F.Column:
    rest = F.substring(key, 2, 1 << 30)
    return F.when(F.substring(key, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(
        rest.cast("string"))


#: Columns that hold hex digits, each value in few rows.
SURROGATE_KEYS = ("scheduled_trip_id", "scheduled_stop_event_id")


def _is_key(df: DataFrame, column: str) -> bool:
    return column in SURROGATE_KEYS and isinstance(df.schema[column].dataType, T.StringType)


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    text, key = _is_key(df, column), F.col(column)
    found = (df.where(key.isNotNull()).groupBy((_packed(key) if text else key).alias("unique_field"))
             .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1"))
    return found.withColumn("unique_field", _unpacked(F.col("unique_field"))) if text else found


def accepted_values_predicate(column: str, values: Sequence) -> str:
    return f"`{column}` NOT IN ({', '.join(_lit(v) for v in values)})"


def accepted_values_failures(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return (df.groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(accepted_values_predicate("value_field", values)))


def relationships_failures(child: DataFrame, column: str, parent: DataFrame,
                           field: str) -> DataFrame:
    keys = parent.select(F.col(field).alias(column)).where(F.col(column).isNotNull())
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str,
                n_rows: str = "1") -> DataFrame:
    """(key, n_records): child keys without a parent row; a child row stands
    for ``n_rows`` (SQL).  Keys are counted per task before they are shuffled,
    so no key is hot."""
    text = _is_key(child, column) and _is_key(parent, field)

    def packed(name: str) -> F.Column:
        return (_packed(F.col(name)) if text else F.col(name)).alias("key")

    keys = (child.where(F.col(column).isNotNull()).groupBy(packed(column))
            .agg(F.sum(F.expr(n_rows)).alias("n_records")))
    known = parent.where(F.col(field).isNotNull()).select(packed(field))
    orphans = keys.join(known, "key", "left_anti")
    return orphans.withColumn("key", _unpacked(F.col("key"))) if text else orphans


def between_predicate(column: str, min_value=None, max_value=None,
                      row_condition: str | None = None) -> str:
    bounds = []
    if min_value is not None:
        bounds.append(f"`{column}` >= {min_value}")
    if max_value is not None:
        bounds.append(f"`{column}` <= {max_value}")
    fail = f"NOT ({' AND '.join(bounds)})"
    return f"({row_condition}) AND {fail}" if row_condition else fail


def between_failures(df: DataFrame, column: str, min_value=None, max_value=None,
                     row_condition: str | None = None) -> DataFrame:
    return df.where(between_predicate(column, min_value, max_value, row_condition))


def unique_combination_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def freshness(loaded: DataFrame, loaded_at: str, as_of: dt.date,
              warn_after_days: int = 8, error_after_days: int = 30) -> DataFrame:
    """One row: latest load date, its age in days on ``as_of`` and the status
    ('pass', 'warn' after ``warn_after_days``, 'error' after
    ``error_after_days``; 'error' when nothing was ever loaded)."""
    age = F.datediff(F.lit(as_of), F.col("max_loaded_at"))
    return loaded.agg(F.max(F.to_date(F.col(loaded_at))).alias("max_loaded_at")).select(
        "max_loaded_at", age.cast("long").alias("age_days"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age > error_after_days, F.lit("error"))
        .when(age > warn_after_days, F.lit("warn")).otherwise(F.lit("pass")).alias("status"))


# --- summary over many checks ---------------------------------------------------

_ROW_LEVEL = ("not_null", "accepted_values", "between")


def _fails(c: Check) -> str:
    """SQL: does a row fail a row-level check?"""
    if c.kind == "not_null":
        return f"`{c.column}` IS NULL"
    if c.kind == "accepted_values":
        return accepted_values_predicate(c.column, c.values)
    return between_predicate(c.column, c.min_value, c.max_value, c.row_condition)


def _failing_rows_of(c: Check, weighted: Weighted | None) -> str:
    """SQL: how many rows of the model a row stands for that fail ``c``."""
    if weighted is None:
        return f"IF({_fails(c)}, 1, 0)"
    if c.kind == "between" and c.column == weighted.series:
        return out_of_range(c.min_value, c.max_value)
    return f"IF({_fails(c)}, n_rows, 0)"


def _row_level_sql(c: Check, weighted: Weighted | None = None) -> str:
    if c.kind == "accepted_values":
        return f"count(DISTINCT CASE WHEN {_fails(c)} THEN `{c.column}` END)"
    return f"coalesce(sum({_failing_rows_of(c, weighted)}), 0)"


def _summary_row(df: DataFrame, c: Check) -> DataFrame:
    return df.select(F.lit(c.check_id).alias("check_id"), F.lit(c.kind).alias("check_type"),
                     F.lit(c.model).alias("model"), F.lit(c.column_name).alias("column_name"),
                     F.col("failures").cast("long").alias("failures"))


def stored_resolver(checks: Sequence[Check], resolve: Callable[[str], DataFrame]
                    ) -> Callable[[str], DataFrame]:
    """``resolve``, with each model that several of the checks derive anew
    stored as a table once; raw and staged tables are only projections."""
    reads = [n for c in checks if c.kind not in _ROW_LEVEL for n in (c.model, c.to) if n]
    reads += list({c.model for c in checks if c.kind in _ROW_LEVEL})
    stored: dict[str, DataFrame] = {}

    def table(name: str) -> DataFrame:
        if reads.count(name) > 1 and not name.startswith(("raw_", "stg_")):
            if name not in stored:
                stored[name] = stored_table(resolve(name), name)
            return stored[name]
        return resolve(name)

    return table


def _of_parent(c: Check, model: Callable[[str], DataFrame], facts: Mapping[str, Weighted]
               ) -> DataFrame:
    """Orphan keys of a relationships check."""
    child = facts[c.model].rows if c.model in facts else model(c.model)
    parent = facts[c.to].rows if c.to in facts else model(c.to)
    n_rows = "n_rows" if c.model in facts else "1"
    if c.to in facts and c.column == c.field == "scheduled_trip_id":
        # Departures of a trip are the same series in both facts, so a key
        # is there if its trip is.
        return orphan_keys(child, "trip_id", parent, "trip_id", n_rows)
    return orphan_keys(child, c.column, parent, c.field, n_rows)


def run_checks(spark: SparkSession, checks: Sequence[Check],
               resolve: Callable[[str], DataFrame],
               facts: Mapping[str, Weighted] | None = None) -> DataFrame:
    """Evaluate ``checks`` (models looked up with ``resolve``) into one
    summary row per check.  ``facts`` gives models as weighted rows, which
    are then never formed (see ``fact_checks``)."""
    model, facts = resolve, facts or {}
    parts: list[DataFrame] = []
    row_level: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind in _ROW_LEVEL:
            row_level.setdefault(c.model, []).append(c)
    for name, group in row_level.items():
        weighted = facts.get(name)
        aggs = [F.expr(_row_level_sql(c, weighted)).alias(f"c{i}") for i, c in enumerate(group)]
        stack = ", ".join(f"{_lit(c.check_id)}, CAST(c{i} AS BIGINT)" for i, c in enumerate(group))
        one_pass = (weighted.rows if weighted else model(name)).agg(*aggs).selectExpr(
            f"stack({len(group)}, {stack}) AS (check_id, failures)")
        meta = spark.createDataFrame(
            [(c.check_id, c.kind, c.model, c.column_name) for c in group],
            "check_id string, check_type string, model string, column_name string")
        parts.append(F.broadcast(meta).join(one_pass, "check_id").select(
            "check_id", "check_type", "model", "column_name", "failures"))
    for c in checks:
        if c.kind == "unique" and c.model in facts:
            failed = facts[c.model].repeats.agg(
                F.coalesce(F.sum("n_keys"), F.lit(0)).alias("failures"))
        elif c.kind == "unique":
            failed = unique_failures(model(c.model), c.column).agg(
                F.count(F.lit(1)).alias("failures"))
        elif c.kind == "unique_combination":
            failed = unique_combination_failures(model(c.model), list(c.column)).agg(
                F.count(F.lit(1)).alias("failures"))
        elif c.kind == "relationships":
            failed = _of_parent(c, model, facts).agg(
                F.coalesce(F.sum("n_records"), F.lit(0)).alias("failures"))
        else:
            continue
        parts.append(_summary_row(failed, c))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") > 0, F.lit("fail"))
                          .otherwise(F.lit("pass")))


# Columns that name a row of each model in a report.
ROW_KEYS: dict[str, tuple[str, ...]] = {
    "raw_stops": ("stop_id",), "raw_routes": ("route_id",), "raw_trips": ("trip_id",),
    "raw_stop_times": ("trip_id", "stop_sequence"), "raw_frequencies": ("trip_id", "start_time"),
    "stg_stops": ("stop_id",), "stg_routes": ("route_id",), "stg_trips": ("trip_id",),
    "stg_stop_times": ("trip_id", "stop_sequence"), "stg_calendar": ("service_id",),
    "stg_calendar_dates": ("service_id", "exception_date"), "stg_frequencies": ("trip_id",),
    "dim_date": ("date_id",), "dim_route": ("route_id",), "dim_stop": ("stop_id",),
    "dim_service": ("service_id",), "fact_scheduled_trip": ("trip_id",),
    "fact_scheduled_stop_event": ("trip_id", "stop_sequence"), "route_summary": ("route_id",),
    "daily_stop_arrivals": ("service_date", "stop_id"),
    "hourly_network_density": ("service_date", "hour_of_day", "service_category"),
}


def failing_rows(checks: Sequence[Check], resolve: Callable[[str], DataFrame],
                 facts: Mapping[str, Weighted] | None = None) -> DataFrame:
    """(check_id, row_key, n_records): what fails each check.

    Row-level checks name rows by ``ROW_KEYS`` (nulls as ``-``); all of a
    model are evaluated in one scan, which emits an array of the checks that a
    row fails.  ``unique``, ``unique_combination`` and ``accepted_values``
    name the values, ``relationships`` the keys without a parent.  A repeated
    key of the facts is named by its trip (and departure); of stop visits,
    ``n_records`` is the trip's number of repeated keys."""
    facts = facts or {}

    def named(columns: Sequence[str]) -> F.Column:
        return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-"))
                                  for c in columns])

    parts = []
    for name in dict.fromkeys(c.model for c in checks):
        group = [c for c in checks if c.model == name and c.kind in ("not_null", "between")]
        if not group:
            continue
        weighted = facts.get(name)
        each = ", ".join(f"named_struct('check_id', {_lit(c.check_id)}, 'n', "
                         f"CAST({_failing_rows_of(c, weighted)} AS BIGINT))" for c in group)
        rows = (weighted.rows if weighted else resolve(name)).select(
            named(ROW_KEYS[name]).alias("row_key"),
            F.explode(F.expr(f"filter(array({each}), x -> x.n > 0)")).alias("x"))
        parts.append(rows.groupBy(F.col("x.check_id").alias("check_id"), "row_key").agg(
            F.sum("x.n").alias("n_records")))
    for c in checks:
        if c.kind == "unique" and c.model in facts:
            rows = facts[c.model].repeats.select(F.col("key").alias("row_key"),
                                                 F.col("n_keys").alias("n_records"))
        elif c.kind == "unique":
            rows = unique_failures(resolve(c.model), c.column).select(
                F.col("unique_field").cast("string").alias("row_key"), "n_records")
        elif c.kind == "unique_combination":
            rows = unique_combination_failures(resolve(c.model), list(c.column)).select(
                named(c.column).alias("row_key"), "n_records")
        elif c.kind == "accepted_values":
            rows = accepted_values_failures(resolve(c.model), c.column, c.values).select(
                F.col("value_field").cast("string").alias("row_key"), "n_records")
        elif c.kind == "relationships":
            rows = _of_parent(c, resolve, facts).select(
                F.col("key").cast("string").alias("row_key"), "n_records")
        else:
            continue
        parts.append(rows.select(F.lit(c.check_id).alias("check_id"), "row_key",
                                 F.col("n_records").cast("long").alias("n_records")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_failing_rows(rows: DataFrame, path: str) -> None:
    """Failing rows as a table with one folder per check."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "check_id").parquet(path)


# --- the declared checks --------------------------------------------------------

def _nn(model: str, *cols: str) -> list[Check]:
    return [Check("not_null", model, c) for c in cols]


# The declared checks of every layer (113 in total), in the
# order the layers declare them.
ROUTE_TYPE_LABELS = ("tram", "subway", "rail", "bus", "ferry", "cable_tram", "aerial_lift",
                     "funicular", "trolleybus", "monorail", "unknown")
LOCATION_TYPE_LABELS = ("stop_or_platform", "station", "entrance_or_exit", "generic_node",
                        "boarding_area", "unknown")
LAT_RANGE = (-7.0, -5.0)
LON_RANGE = (106.0, 107.5)

SOURCE_CHECKS: list[Check] = [
    *_nn("raw_stops", "stop_id"), Check("unique", "raw_stops", "stop_id"),
    *_nn("raw_routes", "route_id"), Check("unique", "raw_routes", "route_id"),
    *_nn("raw_trips", "trip_id"), Check("unique", "raw_trips", "trip_id"),
    *_nn("raw_trips", "route_id"),
    Check("relationships", "raw_trips", "route_id", to="raw_routes", field="route_id"),
    *_nn("raw_stop_times", "trip_id", "stop_id"),
    *_nn("raw_frequencies", "trip_id"),
]

STAGING_CHECKS: list[Check] = [
    *_nn("stg_stops", "stop_id"), Check("unique", "stg_stops", "stop_id"),
    *_nn("stg_stops", "stop_name"),
    Check("between", "stg_stops", "stop_latitude", min_value=LAT_RANGE[0], max_value=LAT_RANGE[1],
          row_condition="stop_latitude IS NOT NULL"),
    Check("between", "stg_stops", "stop_longitude", min_value=LON_RANGE[0], max_value=LON_RANGE[1],
          row_condition="stop_longitude IS NOT NULL"),
    *_nn("stg_routes", "route_id"), Check("unique", "stg_routes", "route_id"),
    *_nn("stg_routes", "route_type_code"),
    Check("accepted_values", "stg_routes", "route_type_name", values=ROUTE_TYPE_LABELS),
    *_nn("stg_trips", "trip_id"), Check("unique", "stg_trips", "trip_id"),
    *_nn("stg_trips", "route_id"),
    Check("relationships", "stg_trips", "route_id", to="stg_routes", field="route_id"),
    *_nn("stg_trips", "service_id"),
    Check("accepted_values", "stg_trips", "direction_id", values=(0, 1), quote=False),
    *_nn("stg_stop_times", "trip_id"),
    Check("relationships", "stg_stop_times", "trip_id", to="stg_trips", field="trip_id"),
    *_nn("stg_stop_times", "stop_id"),
    Check("relationships", "stg_stop_times", "stop_id", to="stg_stops", field="stop_id"),
    *_nn("stg_stop_times", "stop_sequence"),
    Check("between", "stg_stop_times", "stop_sequence", min_value=0),
    *_nn("stg_calendar", "service_id"), Check("unique", "stg_calendar", "service_id"),
    *_nn("stg_calendar", "service_start_date", "service_end_date"),
    *_nn("stg_calendar_dates", "service_id", "exception_date"),
    Check("accepted_values", "stg_calendar_dates", "exception_type_name",
          values=("added", "removed", "unknown")),
    *_nn("stg_frequencies", "trip_id"),
    Check("relationships", "stg_frequencies", "trip_id", to="stg_trips", field="trip_id"),
    *_nn("stg_frequencies", "headway_seconds"),
    Check("between", "stg_frequencies", "headway_seconds", min_value=60, max_value=86400,
          row_condition="headway_seconds IS NOT NULL"),
]

CORE_CHECKS: list[Check] = [
    *_nn("dim_date", "date_id"), Check("unique", "dim_date", "date_id"),
    *_nn("dim_date", "year", "day_of_week"),
    Check("accepted_values", "dim_date", "day_of_week", values=(1, 2, 3, 4, 5, 6, 7), quote=False),
    *_nn("dim_date", "is_weekend"),
    *_nn("dim_route", "route_id"), Check("unique", "dim_route", "route_id"),
    Check("relationships", "dim_route", "route_id", to="stg_routes", field="route_id"),
    *_nn("dim_route", "route_type_name", "service_category"),
    *_nn("dim_service", "service_id"), Check("unique", "dim_service", "service_id"),
    Check("relationships", "dim_service", "service_id", to="stg_calendar", field="service_id"),
    *_nn("dim_service", "service_name", "service_start_date", "active_days_count"),
    Check("between", "dim_service", "active_days_count", min_value=0),
    *_nn("fact_scheduled_trip", "scheduled_trip_id"),
    Check("unique", "fact_scheduled_trip", "scheduled_trip_id"),
    *_nn("fact_scheduled_trip", "trip_id"),
    Check("relationships", "fact_scheduled_trip", "trip_id", to="stg_trips", field="trip_id"),
    *_nn("fact_scheduled_trip", "route_id"),
    Check("relationships", "fact_scheduled_trip", "route_id", to="dim_route", field="route_id"),
    *_nn("fact_scheduled_trip", "service_id"),
    Check("relationships", "fact_scheduled_trip", "service_id", to="dim_service",
          field="service_id"),
    *_nn("fact_scheduled_trip", "departure_seconds_from_service_midnight"),
    Check("between", "fact_scheduled_trip", "departure_seconds_from_service_midnight",
          min_value=0, max_value=172800),
    *_nn("fact_scheduled_trip", "source_headway_seconds"),
    *_nn("fact_scheduled_stop_event", "scheduled_stop_event_id"),
    Check("unique", "fact_scheduled_stop_event", "scheduled_stop_event_id"),
    *_nn("fact_scheduled_stop_event", "scheduled_trip_id"),
    Check("relationships", "fact_scheduled_stop_event", "scheduled_trip_id",
          to="fact_scheduled_trip", field="scheduled_trip_id"),
    *_nn("fact_scheduled_stop_event", "trip_id", "route_id"),
    Check("relationships", "fact_scheduled_stop_event", "route_id", to="dim_route",
          field="route_id"),
    *_nn("fact_scheduled_stop_event", "stop_id"),
    Check("relationships", "fact_scheduled_stop_event", "stop_id", to="dim_stop", field="stop_id"),
    *_nn("fact_scheduled_stop_event", "stop_sequence", "arrival_seconds_from_service_midnight",
         "departure_seconds_from_service_midnight"),
    *_nn("dim_stop", "stop_id"), Check("unique", "dim_stop", "stop_id"),
    Check("relationships", "dim_stop", "stop_id", to="stg_stops", field="stop_id"),
    *_nn("dim_stop", "stop_name"),
    Check("accepted_values", "dim_stop", "location_type_name", values=LOCATION_TYPE_LABELS),
    Check("between", "dim_stop", "stop_latitude", min_value=LAT_RANGE[0], max_value=LAT_RANGE[1],
          row_condition="stop_latitude IS NOT NULL"),
    Check("between", "dim_stop", "stop_longitude", min_value=LON_RANGE[0], max_value=LON_RANGE[1],
          row_condition="stop_longitude IS NOT NULL"),
]

PRESENTATION_CHECKS: list[Check] = [
    *_nn("route_summary", "route_id"), Check("unique", "route_summary", "route_id"),
    Check("relationships", "route_summary", "route_id", to="dim_route", field="route_id"),
    *_nn("route_summary", "route_short_name", "service_category", "abstract_departures_count"),
    Check("between", "route_summary", "abstract_departures_count", min_value=0),
    *_nn("route_summary", "distinct_stops_served"),
    Check("between", "route_summary", "distinct_stops_served", min_value=0),
    *_nn("daily_stop_arrivals", "service_date", "stop_id"),
    Check("relationships", "daily_stop_arrivals", "stop_id", to="dim_stop", field="stop_id"),
    *_nn("daily_stop_arrivals", "arrivals_count"),
    Check("between", "daily_stop_arrivals", "arrivals_count", min_value=1),
    Check("unique_combination", "daily_stop_arrivals", ("service_date", "stop_id")),
    *_nn("hourly_network_density", "service_date", "hour_of_day"),
    Check("accepted_values", "hourly_network_density", "hour_of_day", values=tuple(range(24)),
          quote=False),
    *_nn("hourly_network_density", "service_category", "arrivals_count"),
    Check("between", "hourly_network_density", "arrivals_count", min_value=1),
    Check("unique_combination", "hourly_network_density",
          ("service_date", "hour_of_day", "service_category")),
]

ALL_CHECKS: list[Check] = SOURCE_CHECKS + STAGING_CHECKS + CORE_CHECKS + PRESENTATION_CHECKS
FRESHNESS = {"warn_after_days": 8, "error_after_days": 30}


def checks_of(kind: str) -> list[Check]:
    return [c for c in ALL_CHECKS if c.kind == kind]
