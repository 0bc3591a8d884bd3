"""Staging models: one per raw table, same grain, fixed types and names.

Casts are strict (ANSI): a value that does not fit its declared type fails
the job instead of turning into NULL.  Time-of-day text is the exception; it
is parsed by ``functions.times``, which yields NULL for malformed text.
Each model is one projection written as SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.labels import EXCEPTION_TYPE_NAMES, ROUTE_TYPE_NAMES, decode_sql
from headway.functions.times import digits_to_seconds, gtfs_time_digits

DATE_FORMAT = "yyyyMMdd"
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def _s(name: str, alias: str | None = None) -> str:
    return f"CAST(`{name}` AS STRING) AS {alias or name}"


def _l(name: str, alias: str | None = None) -> str:
    return f"CAST(`{name}` AS BIGINT) AS {alias or name}"


def _d(name: str, alias: str) -> str:
    return f"to_date(CAST(`{name}` AS STRING), '{DATE_FORMAT}') AS {alias}"


def _select(raw: DataFrame, *cols) -> DataFrame:
    """The columns, and the feed a row belongs to where there are several."""
    feed = [c for c in raw.columns if c == "feed_key"]
    return raw.select(*[F.expr(c) if isinstance(c, str) else c for c in cols], *feed)


def stg_stops(raw: DataFrame) -> DataFrame:
    return _select(
        raw, _s("stop_id"), _s("stop_code"), _s("stop_name"), _s("stop_desc", "stop_description"),
        "CAST(stop_lat AS DOUBLE) AS stop_latitude", "CAST(stop_lon AS DOUBLE) AS stop_longitude",
        _s("zone_id"), _s("stop_url"), _l("location_type"), _s("parent_station", "parent_station_id"),
        _l("wheelchair_boarding", "wheelchair_boarding_code"))


def stg_routes(raw: DataFrame) -> DataFrame:
    return _select(
        raw, _s("route_id"), _s("agency_id"), _s("route_short_name"), _s("route_long_name"),
        _s("route_desc", "route_description"), _l("route_type", "route_type_code"),
        decode_sql("CAST(route_type AS BIGINT)", ROUTE_TYPE_NAMES) + " AS route_type_name",
        _s("route_url"), _s("route_color", "route_color_hex"),
        _s("route_text_color", "route_text_color_hex"))


def stg_trips(raw: DataFrame) -> DataFrame:
    return _select(
        raw, _s("trip_id"), _s("route_id"), _s("service_id"), _s("trip_headsign"), _s("trip_short_name"),
        _l("direction_id"), _s("block_id"), _s("shape_id"),
        _l("wheelchair_accessible", "wheelchair_accessible_code"),
        _l("bikes_allowed", "bikes_allowed_code"))


def _parsed_times(raw: DataFrame, *columns: str) -> DataFrame:
    """``raw`` with the digits of each time column, in columns of ``_digits``.

    The parser is evaluated once per row.  Because the digits come out of a
    generator, later filters on them (``n_departures > 0``, say) cannot be
    rewritten onto the raw text, which would evaluate the regex parser again
    for every reference in the predicate; what remains is arithmetic.  The
    parser is built with the Column API, so its pattern is a plain literal
    whatever the session's SQL string-escaping settings are."""
    return raw.select("*", F.inline(F.array(F.struct(
        *[gtfs_time_digits(F.col(c)).alias(_digits(c)) for c in columns]))))


def _digits(column: str) -> str:
    return f"__{column}_digits"


def _t(column: str, alias: str) -> F.Column:
    return digits_to_seconds(_digits(column)).alias(alias)


def stg_stop_times(raw: DataFrame) -> DataFrame:
    return _select(
        _parsed_times(raw, "arrival_time", "departure_time"),
        _s("trip_id"), _s("stop_id"), _l("stop_sequence"),
        _s("arrival_time", "arrival_time_str"), _s("departure_time", "departure_time_str"),
        _t("arrival_time", "arrival_seconds_from_service_midnight"),
        _t("departure_time", "departure_seconds_from_service_midnight"),
        _s("stop_headsign"), _l("pickup_type", "pickup_type_code"),
        _l("drop_off_type", "drop_off_type_code"),
        "CAST(shape_dist_traveled AS DOUBLE) AS shape_distance_traveled")


def stg_calendar(raw: DataFrame) -> DataFrame:
    return _select(
        raw, _s("service_id"), *[f"CAST(`{d}` AS BIGINT) = 1 AS runs_{d}" for d in WEEKDAYS],
        _d("start_date", "service_start_date"), _d("end_date", "service_end_date"))


def stg_calendar_dates(raw: DataFrame) -> DataFrame:
    return _select(
        raw, _s("service_id"), _d("date", "exception_date"), _l("exception_type", "exception_type_code"),
        decode_sql("CAST(exception_type AS BIGINT)", EXCEPTION_TYPE_NAMES) + " AS exception_type_name")


def stg_frequencies(raw: DataFrame) -> DataFrame:
    return _select(
        _parsed_times(raw, "start_time", "end_time"),
        _s("trip_id"), _s("start_time", "start_time_str"), _s("end_time", "end_time_str"),
        _t("start_time", "start_seconds_from_service_midnight"),
        _t("end_time", "end_seconds_from_service_midnight"),
        _l("headway_secs", "headway_seconds"), "CAST(exact_times AS BIGINT) = 1 AS is_exact_times")


STAGING = {
    "stops": stg_stops, "routes": stg_routes, "trips": stg_trips,
    "stop_times": stg_stop_times, "calendar": stg_calendar,
    "calendar_dates": stg_calendar_dates, "frequencies": stg_frequencies,
}
