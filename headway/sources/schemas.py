"""Declared raw columns of the known feed tables.

Raw tables are all-STRING and header-driven: columns are matched by *name*
(feeds reorder them), declared columns a file lacks are added as NULL, and
columns a file has beyond the declaration are kept after them.  A table that
is header-only, or absent, still yields its declared, typed (STRING) columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The thirteen feed tables the loader knows, in load order.
KNOWN_TABLES = (
    "agency", "stops", "routes", "trips", "stop_times", "calendar",
    "calendar_dates", "shapes", "fare_attributes", "fare_rules",
    "frequencies", "transfers", "feed_info",
)

# The columns of each table (the GTFS static reference fields).
DECLARED_COLUMNS: dict[str, tuple[str, ...]] = {
    "agency": ("agency_id", "agency_name", "agency_url", "agency_timezone",
               "agency_lang", "agency_phone", "agency_fare_url", "agency_email"),
    "stops": ("stop_id", "stop_code", "stop_name", "stop_desc", "stop_lat", "stop_lon",
              "zone_id", "stop_url", "location_type", "parent_station", "wheelchair_boarding"),
    "routes": ("route_id", "agency_id", "route_short_name", "route_long_name", "route_desc",
               "route_type", "route_url", "route_color", "route_text_color"),
    "trips": ("route_id", "service_id", "trip_id", "trip_headsign", "trip_short_name",
              "direction_id", "block_id", "shape_id", "wheelchair_accessible", "bikes_allowed"),
    "stop_times": ("trip_id", "arrival_time", "departure_time", "stop_id", "stop_sequence",
                   "stop_headsign", "pickup_type", "drop_off_type", "shape_dist_traveled"),
    "calendar": ("service_id", "monday", "tuesday", "wednesday", "thursday", "friday",
                 "saturday", "sunday", "start_date", "end_date"),
    "calendar_dates": ("service_id", "date", "exception_type"),
    "shapes": ("shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence",
               "shape_dist_traveled"),
    "fare_attributes": ("fare_id", "price", "currency_type", "payment_method", "transfers",
                        "agency_id", "transfer_duration"),
    "fare_rules": ("fare_id", "route_id", "origin_id", "destination_id", "contains_id"),
    "frequencies": ("trip_id", "start_time", "end_time", "headway_secs", "exact_times"),
    "transfers": ("from_stop_id", "to_stop_id", "transfer_type", "min_transfer_time"),
    "feed_info": ("feed_publisher_name", "feed_publisher_url", "feed_lang", "default_lang",
                  "feed_start_date", "feed_end_date", "feed_version", "feed_contact_email",
                  "feed_contact_url"),
}


def raw_schema(table: str, extra: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True)
                         for c in DECLARED_COLUMNS[table] + tuple(extra)])


def conform(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Declared columns by name (cast to STRING, missing ones NULL), then any
    further file columns, then the pass-through columns in ``keep``."""
    declared = DECLARED_COLUMNS[table]
    present = {c.strip().lstrip("\ufeff"): c for c in df.columns}
    extra = [n for n in present if n not in declared and n not in keep]
    if list(present) == list(declared) + extra + [k for k in keep if k in present] and all(
            isinstance(f.dataType, T.StringType) for f in df.schema.fields
            if f.name not in keep):
        return df
    cols = [f"CAST(`{present[c]}` AS STRING) AS `{c}`" if c in present
            else f"CAST(NULL AS STRING) AS `{c}`" for c in declared]
    cols += [f"CAST(`{present[n]}` AS STRING) AS `{n}`" for n in extra]
    cols += [f"`{present[k]}`" for k in keep if k in present]
    return df.selectExpr(*cols)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], raw_schema(table))
