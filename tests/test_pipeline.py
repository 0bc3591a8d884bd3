import io
import os
import zipfile

import pytest
from conftest import raw
from fixture_feed import fixture_models
from pyspark.sql import functions as F

from headway.plans.build import build_all
from headway.plans.models import FeedModels, build_order
from headway.sources.zipfeed import list_archives
from headway.streaming.feed_watch import archive_batch, watch_feed_archives


def test_build_order_respects_upstreams():
    order = build_order()
    assert order.index("service_calendar") < order.index("dim_service") < \
        order.index("fact_scheduled_trip") < order.index("fact_scheduled_stop_event") < \
        order.index("presentation_daily_stop_arrivals")


def test_build_all_writes_marts(spark, scratch):
    m = fixture_models(spark)
    expected = m.presentation_daily_stop_arrivals.count()
    out = build_all(spark, fixture_models(spark), os.path.join(scratch, "wh"))
    assert os.path.isdir(out["fact_scheduled_stop_event"])
    assert spark.read.parquet(out["presentation_daily_stop_arrivals"]).count() == expected
    assert out["quality"].count() == 113


def test_a_narrower_build_leaves_no_old_months(spark, scratch):
    from fixture_feed import CALENDAR, fixture_tables
    target = os.path.join(scratch, "wh")
    tables = fixture_tables(spark)
    year = dict(tables, calendar=raw(
        spark, "calendar", [(*c[:-2], "20240101", "20240331") for c in CALENDAR],
        tables["calendar"].columns))
    build_all(spark, FeedModels(spark, year), target, run_quality=False)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        out = build_all(spark, FeedModels(spark, tables), target, run_quality=False)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    stored = spark.read.parquet(out["presentation_daily_stop_arrivals"])
    want = FeedModels(spark, tables).presentation_daily_stop_arrivals
    assert stored.count() == want.count()


def test_two_snapshots_give_exactly_twice_the_rows(spark):
    from fixture_feed import fixture_tables
    one = fixture_models(spark)
    tables = fixture_tables(spark)
    both = {n: df.withColumn("snapshot_date", F.lit("2024:01")).unionByName(
        df.withColumn("snapshot_date", F.lit("2024:02"))) for n, df in tables.items()}
    with pytest.raises(ValueError, match="feed_key"):
        FeedModels(spark, both)
    m = FeedModels(spark, both, feed_key=("snapshot_date",))
    for name in ("service_calendar", "dim_service", "fact_scheduled_trip", "fact_scheduled_stop_event",
                 "presentation_route_summary", "presentation_daily_stop_arrivals",
                 "presentation_hourly_network_density"):
        assert m.model(name).count() == 2 * one.model(name).count(), name
    keys = m.fact_scheduled_stop_event.select("feed_key", "scheduled_stop_event_id").distinct()
    assert keys.groupBy("scheduled_stop_event_id").count().where("count > 1").count() == 0
    per_feed = m.presentation_hourly_network_density.groupBy("feed_key").agg(
        F.sum("arrivals_count").alias("n")).collect()
    alone = one.presentation_hourly_network_density.agg(F.sum("arrivals_count")).first()[0]
    assert {(r.feed_key, r.n) for r in per_feed} == {("2024%3A01", alone), ("2024%3A02", alone)}
    from headway.operators import analyses as an
    tiers = an.service_frequency_tiers(m.trip_windows).groupBy("feed_key").agg(
        F.round(F.sum("share_of_departures"), 2).alias("s")).collect()
    assert [r.s for r in tiers] == [1.0, 1.0]
    mix = an.service_tier_mix(m.trip_windows, m.trip_stops)
    assert mix.count() == 2 * an.service_tier_mix(one.trip_windows, one.trip_stops).count()
    peaks = an.peaking_factor(m.presentation_hourly_network_density).where("scope = 'ALL'")
    assert peaks.count() == 2
    assert an.network_pulse(m.presentation_hourly_network_density, m.dim_date).count() == \
        2 * an.network_pulse(one.presentation_hourly_network_density, one.dim_date).count()


def test_streaming_picks_up_new_archives(spark, scratch):
    landing = os.path.join(scratch, "landing")
    archive = os.path.join(scratch, "archive")
    ckpt = os.path.join(scratch, "ckpt")

    def land(date, stops, name="feed.zip", text=None):
        d = os.path.join(landing, f"snapshot_date={date}")
        os.makedirs(d, exist_ok=True)
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            if text is None:
                zf.writestr("stops.txt", "stop_id,stop_name\n" + "".join(f"{s},n\n" for s in stops))
            else:
                zf.writestr("trips.txt", text)
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(buf.getvalue())

    land("2024-01-01", ["A", "B"])
    q = watch_feed_archives(spark, landing, archive, ckpt, tables=("stops",))
    q.awaitTermination(120)
    land("2024-01-02", ["A", "B", "C"])
    q = watch_feed_archives(spark, landing, archive, ckpt, tables=("stops",))
    q.awaitTermination(120)
    stops = spark.read.parquet(os.path.join(archive, "stops"))
    per_day = {str(r.snapshot_date): r["count"] for r in stops.groupBy("snapshot_date").count().collect()}
    assert per_day == {"2024-01-01": 2, "2024-01-02": 3}

    # Another archive of a date stands beside the first; one delivered again
    # replaces itself, also when its table has gone.
    land("2024-01-02", ["X"], name="other.zip")
    q = watch_feed_archives(spark, landing, archive, ckpt, tables=("stops",))
    q.awaitTermination(120)

    def count():
        df = spark.read.option("mergeSchema", True).parquet(os.path.join(archive, "stops"))
        return {str(r.snapshot_date): r["count"] for r in df.groupBy("snapshot_date").count().collect()}
    assert count() == {"2024-01-01": 2, "2024-01-02": 4}
    land("2024-01-02", [], text="trip_id\nT\n")
    archive_batch(list_archives(spark, landing).where("path LIKE '%2024-01-02/feed.zip'"), archive,
                  ("stops",))
    assert count() == {"2024-01-01": 2, "2024-01-02": 1}
