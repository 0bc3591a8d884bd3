"""Bridge: raw GTFS-shaped tables derived from the provided test tables.

The test tables are TPC-H-like, not GTFS.  This module only *maps* them to
raw feed tables with the exact raw shape a feed reader produces (every
column STRING).  It does none of the models' work: parsing, calendar
unrolling, expansion, joins and roll-ups all happen downstream in the
library, which must be right for any data of this shape.

Mapping (every row of each source table contributes):

* supplier -> stops       one stop per supplier; most have a parent station;
  a few lie outside the service area
* nation x region -> routes  region name is the route description
  (category); region 4 gets an empty description
* nation -> calendar      one service per nation; the weekday pattern and
  window come from the nation key, so every service-name shape appears,
  including windows outside the date spine
* orders -> calendar_dates  distinct (service, date, type) exceptions
* orders and customer -> trips  one trip per order, and one per customer that
  runs on a fixed timetable (no frequency row); some trips are on unknown
  routes or services, some have no valid direction
* orders -> frequencies   one headway window per order, a second one that
  follows it for every fourth, and a third one that overlaps the first for
  every sixteenth; some windows are empty, some run once a day, some headways
  are under five minutes or too short to be valid; some times are exact
* lineitem -> stop_times  one stop row per line; line numbers that an order
  repeats repeat the stop sequence; some times are malformed or missing; every
  other order has distances
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("region", "nation", "supplier", "customer", "orders", "lineitem")


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table ``name``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hms(seconds_sql: str) -> str:
    """SQL text for HH:MM:SS (hours zero-padded to two digits, may pass 24)."""
    s = f"({seconds_sql})"
    return (f"lpad(cast(cast(floor({s} / 3600) as bigint) as string), 2, '0') || ':' || "
            f"lpad(cast(cast(floor(({s} % 3600) / 60) as bigint) as string), 2, '0') || ':' || "
            f"lpad(cast({s} % 60 as string), 2, '0')")


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, sf_dir, "supplier").selectExpr(
        "'S' || CAST(s_suppkey AS STRING) AS stop_id",
        "s_name AS stop_name",
        "CASE WHEN s_suppkey % 37 = 5 THEN '-7.5' "
        "ELSE CAST(-6.9 + s_suppkey % 100 * 0.01 AS STRING) END AS stop_lat",
        "CAST(106.1 + s_suppkey % 100 * 0.01 AS STRING) AS stop_lon",
        "CAST(s_suppkey % 6 AS STRING) AS location_type",
        "CASE WHEN s_suppkey % 5 <> 0 "
        "THEN 'S' || CAST(s_suppkey - s_suppkey % 5 AS STRING) END AS parent_station",
        "CAST(s_nationkey % 4 AS STRING) AS wheelchair_boarding",
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_source(spark, sf_dir, "nation")
    region = read_source(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "'R' || CAST(n_nationkey AS STRING) AS route_id",
        "CAST(n_nationkey AS STRING) AS route_short_name",
        "n_name AS route_long_name",
        "CASE WHEN n_regionkey = 4 THEN '' ELSE r_name END AS route_desc",
        "CAST(n_nationkey % 14 AS STRING) AS route_type",
    )


# Weekday pattern by (nation key mod 9): the keys that run on each day.
_RUNS_ON = {
    "monday": (0, 1, 3, 6, 7), "tuesday": (0, 1, 3), "wednesday": (0, 1, 3, 7),
    "thursday": (0, 1, 3), "friday": (0, 1, 3, 5), "saturday": (0, 2, 3),
    "sunday": (0, 2, 4),
}
_OLD_WINDOW_KEYS = (6, 8)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    def keys(ks: tuple[int, ...]) -> str:
        return ", ".join(map(str, ks))
    old = f"n_nationkey % 9 IN ({keys(_OLD_WINDOW_KEYS)})"
    return read_source(spark, sf_dir, "nation").selectExpr(
        "'V' || CAST(n_nationkey AS STRING) AS service_id",
        *[f"CASE WHEN n_nationkey % 9 IN ({keys(ks)}) THEN '1' ELSE '0' END AS {day}"
          for day, ks in _RUNS_ON.items()],
        f"CASE WHEN {old} THEN '20050101' ELSE '20240101' END AS start_date",
        f"CASE WHEN {old} THEN '20051231' ELSE '20240630' END AS end_date",
    )


def calendar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, sf_dir, "orders").selectExpr(
        "'V' || CAST(o_orderkey % 8 AS STRING) AS service_id",
        "'2024' || lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0')"
        " || lpad(CAST(1 + o_orderkey % 28 AS STRING), 2, '0') AS date",
        "CAST(1 + o_orderkey % 2 AS STRING) AS exception_type",
    ).distinct()


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_order = read_source(spark, sf_dir, "orders").selectExpr(
        "'T' || CAST(o_orderkey AS STRING) AS trip_id",
        "CASE WHEN o_orderkey % 89 = 3 THEN 'RX' "
        "ELSE 'R' || CAST(o_orderkey % 24 AS STRING) END AS route_id",
        "CASE WHEN o_orderkey % 83 = 5 THEN 'VX' "
        "ELSE 'V' || CAST(o_custkey % 8 AS STRING) END AS service_id",
        "CASE WHEN o_orderkey % 113 = 7 THEN '2' "
        "ELSE CAST(o_orderkey % 2 AS STRING) END AS direction_id",
    )
    fixed = read_source(spark, sf_dir, "customer").selectExpr(
        "'C' || CAST(c_custkey AS STRING) AS trip_id",
        "'R' || CAST(c_nationkey AS STRING) AS route_id",
        "'V' || CAST(c_custkey % 8 AS STRING) AS service_id",
        "CAST(c_custkey % 2 AS STRING) AS direction_id",
    )
    return by_order.unionByName(fixed)


def _windows(orders: DataFrame, where: str, start: str, end: str, headway: str) -> DataFrame:
    return orders.where(where).selectExpr(
        "'T' || CAST(o_orderkey AS STRING) AS trip_id",
        f"{_hms(start)} AS start_time", f"{_hms(end)} AS end_time",
        f"CAST({headway} AS STRING) AS headway_secs",
        "CASE WHEN o_orderkey % 9 = 0 THEN '1' ELSE '0' END AS exact_times")


def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_source(spark, sf_dir, "orders")
    start = "(14400 + (o_orderkey % 20) * 3600)"
    end = f"({start} + (CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE 1 + o_orderkey % 3 END) * 3600)"
    headway = ("CASE WHEN o_orderkey % 97 = 0 THEN 86400 WHEN o_orderkey % 211 = 0 THEN 30 "
               "WHEN o_orderkey % 50 = 1 THEN 240 WHEN o_orderkey % 50 = 2 THEN 480 "
               "ELSE 600 + 60 * (o_orderkey % 50) END")
    return (_windows(orders, "true", start, end, headway)
            .unionByName(_windows(orders, "o_orderkey % 4 = 0", end, f"({end} + 3600)", "1200"))
            .unionByName(_windows(orders, "o_orderkey % 16 = 0", start, f"({start} + 1800)", "900")))


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = "(18000 + l_linenumber * 400 + CAST(l_quantity AS BIGINT))"
    return read_source(spark, sf_dir, "lineitem").selectExpr(
        "'T' || CAST(l_orderkey AS STRING) AS trip_id",
        "'S' || CAST(l_suppkey AS STRING) AS stop_id",
        "CAST(l_linenumber AS STRING) AS stop_sequence",
        "CASE WHEN l_orderkey % 61 = 7 AND l_linenumber = 2 THEN '5:0:0' "
        "WHEN l_orderkey % 67 = 9 AND l_linenumber = 3 THEN NULL "
        f"ELSE {_hms(a)} END AS arrival_time",
        f"{_hms(a + ' + 15')} AS departure_time",
        "CASE WHEN l_orderkey % 2 = 0 THEN CAST(l_linenumber * 0.5 AS STRING) END "
        "AS shape_dist_traveled",
    )


BUILDERS = {
    "stops": stops, "routes": routes, "trips": trips, "stop_times": stop_times,
    "calendar": calendar, "calendar_dates": calendar_dates, "frequencies": frequencies,
}


def raw_feed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All seven raw tables (the feed models conform them to the declared
    raw columns)."""
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}


def raw_folder(spark: SparkSession, sf_dir: str, root: str | None = None) -> str:
    """The folder of what is stored for the given tables as they are now: it
    is named by the source files' names, sizes and times, so files that have
    changed have another.  It lies under ``root`` (default: the session's
    checkpoint folder, on a cluster the shared folder of
    ``spark.checkpoint.dir``)."""
    from headway.session import ensure_checkpoint_dir
    from headway.sources import files
    seen = files.fingerprint(spark, *[f"{sf_dir.rstrip('/')}/{t}.parquet" for t in SOURCE_TABLES])
    return f"{(root or ensure_checkpoint_dir(spark)).rstrip('/')}/headway-raw-{seen}"


def stored_once(build, path: str, spark: SparkSession) -> DataFrame:
    """The table at ``path``; written from ``build()`` when its ``_SUCCESS``
    marker is missing."""
    from headway.sources import files
    from headway.sources.archive import write_table
    if not files.exists(spark, f"{path}/_SUCCESS"):
        write_table(build(), path)
    return spark.read.parquet(path)


def stored_raw_feed(spark: SparkSession, sf_dir: str, root: str | None = None) -> dict[str, DataFrame]:
    """The raw feed written once as parquet tables (the raw layer) and read
    back, so every model reads stored raw tables with column pruning and
    filter pushdown instead of recomputing the mapping.  Files that have
    changed are loaded anew (``raw_folder``)."""
    target = raw_folder(spark, sf_dir, root)
    return {name: stored_once(lambda: build(spark, sf_dir), f"{target}/{name}", spark)
            for name, build in BUILDERS.items()}
