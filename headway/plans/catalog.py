"""Registered queries: name -> (Spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, derives the raw feed from the test
tables at ``sf_dir`` (see ``headway.sources.bridge``) and returns the model
or analysis as a DataFrame over the whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import schedule
from headway.plans import oracle
from headway.plans.models import FeedModels
from headway.session import stored_table

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def _models(spark: SparkSession, sf_dir: str) -> FeedModels:
    return FeedModels.from_bridge(spark, sf_dir)


def register(name: str, oracle_sql: str | None):
    def wrap(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, oracle_sql)
        return fn
    return wrap


def _model_query(name: str, model: str, oracle_cte: str) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _models(spark, sf_dir).model(model)
    build.__name__ = name
    build.__doc__ = f"The {model} model over the bridged feed."
    REGISTRY[name] = (build, oracle.table(oracle_cte))


for _name in ("stg_stops", "stg_routes", "stg_trips", "stg_stop_times", "stg_calendar",
              "stg_calendar_dates", "stg_frequencies"):
    _model_query(_name, _name, _name)

_model_query("service_calendar", "service_calendar", "service_calendar")
_model_query("dim_route", "dim_route", "dim_route")
_model_query("dim_stop", "dim_stop", "dim_stop")
_model_query("dim_service", "dim_service", "dim_service")
_model_query("stop_offsets", "stop_offsets", "stop_offsets")
_model_query("fact_scheduled_trip", "fact_scheduled_trip", "fact_scheduled_trip")
_model_query("fact_scheduled_stop_event", "fact_scheduled_stop_event", "fact_scheduled_stop_event")
_model_query("route_summary", "presentation_route_summary", "route_summary")
_model_query("daily_stop_arrivals", "presentation_daily_stop_arrivals", "daily_stop_arrivals")
_model_query("hourly_network_density", "presentation_hourly_network_density",
             "hourly_network_density")


@register("frequency_expansion", oracle.sql(
    "SELECT trip_id, dep AS departure_seconds, ws AS window_start_seconds, "
    "we AS window_end_seconds, hw AS headway_seconds FROM departures", ("departures",)))
def frequency_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every staged frequency window expanded to its departures (end
    exclusive), before any join."""
    from headway.functions.series import departure_series
    f = _models(spark, sf_dir).stg_frequencies
    start, end = "start_seconds_from_service_midnight", "end_seconds_from_service_midnight"
    return f.selectExpr(
        "trip_id", f"explode({departure_series(start, end, 'headway_seconds')}) AS departure_seconds",
        f"{start} AS window_start_seconds", f"{end} AS window_end_seconds", "headway_seconds")


def queries() -> dict[str, Builder]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}


# --- analyses -------------------------------------------------------------------
from headway.operators import analyses as _an  # noqa: E402

# The bridged feed has no BRT tier; a region name plays the category.
CORRIDOR_CATEGORY = "ASIA"


@register("busiest_corridors", oracle.busiest_corridors(CORRIDOR_CATEGORY, 15))
def busiest_corridors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 15 routes of one category by abstract departures, ranked."""
    return _an.busiest_corridors(_models(spark, sf_dir).presentation_route_summary,
                                 CORRIDOR_CATEGORY, 15)


@register("busiest_routes", oracle.busiest_routes(10))
def busiest_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 routes by abstract departures."""
    return _an.busiest_routes(_models(spark, sf_dir).presentation_route_summary, 10)


@register("network_pulse", oracle.NETWORK_PULSE)
def network_pulse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average arrivals per clock hour, weekday vs weekend."""
    m = _models(spark, sf_dir)
    return _an.network_pulse(m.presentation_hourly_network_density, m.dim_date)


@register("service_frequency_tiers", oracle.FREQUENCY_TIERS)
def service_frequency_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures per headway tier with shares."""
    return _an.service_frequency_tiers(_models(spark, sf_dir).trip_windows)


@register("peaking_factor", oracle.PEAKING_FACTOR)
def peaking_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peak hour and peaking factor, network-wide and per category."""
    return _an.peaking_factor(_models(spark, sf_dir).presentation_hourly_network_density)


@register("service_tier_mix", oracle.TIER_MIX)
def service_tier_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departures, share, routes and distinct stops per service category."""
    m = _models(spark, sf_dir)
    return _an.service_tier_mix(m.trip_windows, m.trip_stops)


@register("busiest_stops", oracle.busiest_stops(10))
def busiest_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 stops by scheduled visits per service day."""
    m = _models(spark, sf_dir)
    return _an.busiest_stops(m.trip_stops, m.dim_stop, 10)


@register("top_interchange_hubs", oracle.top_interchange_hubs(10))
def top_interchange_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 hubs (parent station or stop) by routes, then visits."""
    m = _models(spark, sf_dir)
    return _an.top_interchange_hubs(m.trip_stops, m.dim_stop, 10)


@register("stop_hour_histogram", oracle.STOP_HOUR_HISTOGRAM)
def stop_hour_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits per (stop, service-day hour) for every stop; hours 24+ kept."""
    return _an.stop_hour_histogram(_models(spark, sf_dir).window_stops)


@register("service_active_days", oracle.SERVICE_ACTIVE_DAYS)
def service_active_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active days per service against its calendar window."""
    return _an.service_active_days(_models(spark, sf_dir).dim_service)


# --- data-quality checks ----------------------------------------------------------
from headway.operators import quality as _q  # noqa: E402


def _facts(m: FeedModels, checks: list) -> dict:
    """The facts as weighted rows, if any of the checks asks for them."""
    names = ("fact_scheduled_trip", "fact_scheduled_stop_event")
    return m.weighted_facts if any(c.model in names for c in checks) else {}


def _dq_query(name: str, kind: str) -> None:
    checks = _q.checks_of(kind)

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = _models(spark, sf_dir)
        return _q.run_checks(spark, checks, _q.stored_resolver(checks, m.table), _facts(m, checks))
    build.__name__ = name
    build.__doc__ = f"Every declared {kind} check over all layers of the bridged feed."
    REGISTRY[name] = (build, oracle.quality(checks))


for _name, _kind in (("dq_not_null", "not_null"), ("dq_unique", "unique"),
                     ("dq_accepted_values", "accepted_values"),
                     ("dq_relationships", "relationships"), ("dq_between", "between"),
                     ("dq_unique_combination", "unique_combination")):
    _dq_query(_name, _kind)


@register("dq_failing_rows", oracle.failing_rows(_q.ALL_CHECKS, _q.ROW_KEYS))
def dq_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What fails each of the declared checks, written as a table with one
    folder per check and read back."""
    m, path = _models(spark, sf_dir), f"{_scratch(spark, 'failing')}/rows"
    rows = _q.failing_rows(_q.ALL_CHECKS, _q.stored_resolver(_q.ALL_CHECKS, m.table),
                           m.weighted_facts)
    _q.write_failing_rows(rows, path)
    return spark.read.schema("row_key string, n_records long, check_id string").parquet(path)


# --- ingestion round trips --------------------------------------------------------
def _scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared storage
    on a cluster)."""
    import uuid

    from headway.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@register("feed_csv_roundtrip", oracle.table("stg_stop_times"))
def feed_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridged raw feed written as a CSV feed folder (``<table>.txt``),
    read back with the feed reader and staged: stop times."""
    from headway.operators import staging
    from headway.sources.bridge import raw_feed
    from headway.sources.feed import read_feed_csv
    folder = _scratch(spark, "csv-feed")
    for name, df in raw_feed(spark, sf_dir).items():
        df.write.mode("overwrite").option("header", True).option("escape", '"') \
            .csv(f"{folder}/{name}.txt")
    tables, _report = read_feed_csv(spark, folder)
    return staging.stg_stop_times(tables["stop_times"])


@register("feed_csv_multiline", oracle.sql(
    "SELECT trip_id, stop_sequence, 'to' || chr(10) || '\"' || stop_id || '\", as no. ' || chr(10) "
    "|| stop_sequence AS stop_headsign FROM raw_stop_times", ("raw_stop_times",)))
def feed_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridged stop times as a CSV feed in which every headsign has
    newlines and quotes, read back by many tasks."""
    from headway.sources.bridge import stored_raw_feed
    from headway.sources.feed import read_feed_csv
    folder = _scratch(spark, "csv-feed")
    rows = stored_raw_feed(spark, sf_dir)["stop_times"]
    rows.withColumn("stop_headsign", F.expr(
        r"""concat('to\n"', stop_id, '", as no. \n', stop_sequence)""")).write.option(
        "header", True).option("escape", '"').csv(f"{folder}/stop_times.txt")
    tables, _report = read_feed_csv(spark, folder, ("stop_times",))
    return tables["stop_times"].select("trip_id", "stop_sequence", "stop_headsign")


@register("snapshot_replay", oracle.table("stg_trips"))
def snapshot_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the raw trips archived by date; the later one is
    replayed (the date filter prunes the other partition) and staged."""
    from headway.operators import staging
    from headway.sources.archive import archive_snapshot, replay_snapshot
    from headway.sources.bridge import raw_feed
    root = _scratch(spark, "archive")
    trips = raw_feed(spark, sf_dir)["trips"]
    archive_snapshot({"trips": trips.where("direction_id = '0'")}, root, "2024-01-01")
    archive_snapshot({"trips": trips}, root, "2024-02-01")
    from headway.sources.schemas import conform
    replayed = replay_snapshot(spark, root, ["trips"], "2024-02-01")["trips"]
    return staging.stg_trips(conform(replayed, "trips"))


@register("truncate_and_load", oracle.sql(
    "SELECT * FROM stg_trips WHERE direction_id = 0", ("stg_trips",)))
def truncate_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips loaded into a table twice; the second load, of one
    direction, is all that is there afterwards."""
    from headway.operators import staging
    from headway.sources.archive import load_tables
    from headway.sources.bridge import stored_raw_feed
    from headway.sources.schemas import conform
    target, trips = _scratch(spark, "raw"), stored_raw_feed(spark, sf_dir)["trips"]
    load_tables(spark, {"trips": trips}, target)
    loaded = load_tables(spark, {"trips": trips.where("direction_id = '0'")}, target)["trips"]
    return staging.stg_trips(conform(loaded, "trips"))


@register("empty_table_replay", oracle.sql("""
SELECT 'stop_times' AS table_name, count(*) AS rows, 9 AS declared_columns FROM raw_stop_times
UNION ALL SELECT 'calendar_dates', 0, 3""", ("raw_stop_times",)))
def empty_table_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of stop times with a header-only calendar_dates, taken in as
    the stream does and replayed: rows and declared columns of each table."""
    from headway.sources.archive import replay_snapshot
    from headway.sources.bridge import stored_raw_feed
    from headway.sources.schemas import DECLARED_COLUMNS
    from headway.streaming.feed_watch import archive_batch
    rows, root = stored_raw_feed(spark, sf_dir)["stop_times"], _scratch(spark, "archive")
    archives = stored_table(_zip_archives(rows, 1 + rows.count() // _ZIP_ROWS), "archives")
    tables = ("stop_times", "calendar_dates")
    archive_batch(archives.withColumn("snapshot_date", F.lit("2024-01-01")), root, tables)
    out = None
    for name, df in replay_snapshot(spark, root, list(tables), "2024-01-01").items():
        known = sum(c in DECLARED_COLUMNS[name] for c in df.columns)
        one = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"),
                     F.lit(known).alias("declared_columns"))
        out = one if out is None else out.unionByName(one)
    return out


@register("service_calendar_dated", oracle.sql(
    "SELECT c.service_id, d.* FROM service_calendar c JOIN dim_date d ON d.date_id = c.service_date",
    ("service_calendar", "dim_date")))
def service_calendar_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every active date of every service with all attributes of the date."""
    m = _models(spark, sf_dir)
    active = m.service_calendar.withColumnRenamed("service_date", "date_id")
    return active.join(m.dim_date, "date_id").select("service_id", *m.dim_date.columns)


_ZIP_ROWS = 20_000   # stop rows per stand-in archive


def _zip_archives(rows: DataFrame, n: int) -> DataFrame:
    """Stand-in archives (path, content) of ``stop_times`` rows, as a landing
    folder of ``n`` zip files would give them."""
    def pack(pdf):
        import io
        import zipfile

        import pandas as pd
        text = pdf.drop(columns=["part"]).to_csv(index=False)
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("feed/stop_times.txt", text)
            archive.writestr("feed/calendar_dates.txt", "service_id,date,exception_type\n")
            archive.writestr("feed/readme.md", "no table")
        return pd.DataFrame({"path": [f"zip:/{pdf['part'].iloc[0]}.zip"],
                             "content": [held.getvalue()]})
    part = F.pmod(F.xxhash64("trip_id", "stop_sequence", "stop_id"), F.lit(n)).alias("part")
    return rows.select("*", part).groupBy("part").applyInPandas(pack, "path string, content binary")


@register("feed_zip_roundtrip", oracle.table("stg_stop_times"))
def feed_zip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridged stop times as zip archives, read back in one pass over
    the archives and staged."""
    from headway.operators import staging
    from headway.sources.bridge import stored_raw_feed
    from headway.sources.schemas import conform
    from headway.sources.zipfeed import ZipTables
    rows = stored_raw_feed(spark, sf_dir)["stop_times"]
    archives = stored_table(_zip_archives(rows, 1 + rows.count() // _ZIP_ROWS), "archives")
    return staging.stg_stop_times(conform(ZipTables(archives).table("stop_times"), "stop_times"))


@register("feed_load_report", oracle.sql(" UNION ALL ".join([
    f"SELECT '{t}' AS table_name, 'loaded' AS status, count(*) AS rows FROM raw_{t}"
    for t in ("stops", "routes", "trips", "stop_times", "calendar", "calendar_dates",
              "frequencies")] + [
    f"SELECT '{t}', 'skipped', NULL" for t in ("agency", "shapes", "fare_attributes", "fare_rules",
                                               "transfers", "feed_info")]),
    tuple(f"raw_{t}" for t in ("stops", "routes", "trips", "stop_times", "calendar",
                               "calendar_dates", "frequencies"))))
def feed_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load report of the bridged feed written as a CSV folder: each
    known table, loaded with its rows or skipped."""
    from headway.sources.bridge import stored_raw_feed
    from headway.sources.feed import read_feed_csv
    folder = _scratch(spark, "csv-feed")
    for name, df in stored_raw_feed(spark, sf_dir).items():
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.txt")
    return read_feed_csv(spark, folder)[1].drop("path")


FRESHNESS_AS_OF = dt.date(2024, 2, 5)


@register("dq_freshness", """
WITH e AS (SELECT CAST(min(ts) AS DATE) a, CAST(max(ts) AS DATE) z FROM events),
t AS (SELECT 'calendar' AS table_name, z - 10 AS d FROM e
      UNION ALL SELECT 'frequencies', a FROM e UNION ALL SELECT 'stops', NULL
      UNION ALL SELECT 'trips', z FROM e)
SELECT table_name, d AS max_loaded_at, CAST(DATE '2024-02-05' - d AS BIGINT) AS age_days,
  CASE WHEN d IS NULL OR DATE '2024-02-05' - d > 30 THEN 'error'
       WHEN DATE '2024-02-05' - d > 8 THEN 'warn' ELSE 'pass' END AS status
FROM t""")
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of archived snapshots as of a given date: trips archived on
    the first and last day of the events, the calendar ten days before the
    last, frequencies only on the first, stops never."""
    from headway.sources.archive import archive_snapshot, snapshot_dates
    from headway.sources.bridge import read_source, stored_raw_feed
    day = read_source(spark, sf_dir, "events").agg(
        F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("z")).first()
    raw, root = stored_raw_feed(spark, sf_dir), _scratch(spark, "archive")
    loads = {"trips": (day.a, day.z), "calendar": (day.z - dt.timedelta(10),),
             "frequencies": (day.a,), "stops": ()}
    out = None
    for name, dates in loads.items():
        for d in dates:
            archive_snapshot({name: raw[name]}, root, d.isoformat())
        one = _q.freshness(snapshot_dates(spark, root, name), "snapshot_date", FRESHNESS_AS_OF,
                           **_q.FRESHNESS).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("multi_snapshot_facts", oracle.sql(f"""
SELECT s.d AS feed_key, md5(concat_ws('-', s.d || ':' || f.trip_id,
    cast(f.departure_seconds_from_service_midnight as varchar))) AS scheduled_trip_id,
  s.d || ':' || f.trip_id AS trip_id, s.d || ':' || f.route_id AS route_id,
  s.d || ':' || f.service_id AS service_id, f.departure_seconds_from_service_midnight,
  f.route_service_category, f.service_active_days_count, v.visits
FROM fact_scheduled_trip f
LEFT JOIN (SELECT trip_id, count(*) AS visits FROM stg_stop_times GROUP BY trip_id) v USING (trip_id)
CROSS JOIN (VALUES ('2024-01-01'), ('2024-02-01')) s(d)""",
    ("fact_scheduled_trip", "stg_stop_times")))
def multi_snapshot_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the bridged feed archived, replayed together and
    modelled with the snapshot date as feed key: each departure of each
    snapshot, with the number of its stop visits."""
    from headway.sources.archive import archive_snapshot, replay_all
    from headway.sources.bridge import stored_raw_feed
    raw, root = stored_raw_feed(spark, sf_dir), _scratch(spark, "archive")
    for date in ("2024-01-01", "2024-02-01"):
        archive_snapshot(raw, root, date)
    m = FeedModels(spark, {t: replay_all(spark, root, t) for t in raw},
                   feed_key=("snapshot_date",))
    # Visits are counted over the stop-visit fact itself.
    departures = m.fact_scheduled_trip.select(
        "feed_key", "scheduled_trip_id", "trip_id", "route_id", "service_id",
        "departure_seconds_from_service_midnight", "route_service_category",
        "service_active_days_count")
    return schedule.with_visits(departures, m.fact_scheduled_stop_event)


@register("registry_load", """
SELECT 'reg_stops' AS name, 'csv' AS format, 'loaded' AS status, CAST(count(*) AS BIGINT) AS rows
FROM supplier
UNION ALL
SELECT 'reg_trips', 'parquet', 'loaded',
  (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
UNION ALL
SELECT 'reg_missing', 'csv', 'failed', CAST(NULL AS BIGINT)
UNION ALL
SELECT 'reg_sheet', 'xlsx', 'failed', CAST(NULL AS BIGINT)""")
def registry_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of four datasets derived from the test tables (a CSV, a
    parquet table, a missing path, an unsupported format) loaded into tables;
    the failing entries are reported and the others still load."""
    from headway.sources.bridge import raw_feed
    from headway.sources.registry import load_registry
    folder = _scratch(spark, "registry")
    raw = raw_feed(spark, sf_dir)
    raw["stops"].write.mode("overwrite").option("header", True).csv(f"{folder}/in/stops")
    raw["trips"].write.mode("overwrite").parquet(f"{folder}/in/trips")
    entries = [{"name": "reg_stops", "path": f"{folder}/in/stops", "format": "csv"},
               {"name": "reg_trips", "path": f"{folder}/in/trips", "format": "parquet"},
               {"name": "reg_missing", "path": f"{folder}/in/none", "format": "csv"},
               {"name": "reg_sheet", "path": f"{folder}/in/stops", "format": "xlsx"}]
    return load_registry(spark, entries, f"{folder}/out").drop("error")


@register("catalog_marts", oracle.sql(
    "SELECT s.service_id, s.service_name, s.active_days_count, count(c.service_date) AS dates "
    "FROM dim_service s LEFT JOIN service_calendar c USING (service_id) GROUP BY ALL",
    ("dim_service", "service_calendar")))
def catalog_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service dimension and the date dimension built into the catalog's
    database of their layer, and read from there by qualified name."""
    import uuid

    from headway.plans.build import build_all
    m, name = _models(spark, sf_dir), f"headway_{uuid.uuid4().hex[:8]}"
    build_all(spark, m, _scratch(spark, "warehouse"), run_quality=False, databases=name,
              only=("dim_service", "dim_date"))
    m.service_calendar.createOrReplaceTempView(f"{name}_active")
    return spark.sql(f"""
        SELECT s.service_id, s.service_name, s.active_days_count, count(d.date_id) AS dates
        FROM {name}_marts_core.dim_service s LEFT JOIN {name}_active a
          ON a.service_id = s.service_id
        LEFT JOIN {name}_marts_core.dim_date d ON d.date_id = a.service_date
        GROUP BY ALL""")


@register("warehouse_build_checks", oracle.quality(_q.ALL_CHECKS))
def warehouse_build_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build every model of the bridged feed in dependency order, write the
    marts (shared intermediates stored), then run all 113 declared
    checks over the written tables."""
    from headway.plans.build import build_all
    out = build_all(spark, _models(spark, sf_dir), _scratch(spark, "warehouse"))
    return out["quality"]
