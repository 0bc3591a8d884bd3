"""Closed-form marts against brute force over the exploded facts."""

import random

from conftest import raw
from fixture_feed import fixture_models
from pyspark.sql import functions as F

from headway.plans.models import FeedModels


def _brute_daily(m):
    ev = m.fact_scheduled_stop_event
    t = ev.groupBy("service_id", "stop_id", F.expr(
        "CASE WHEN arrival_seconds_from_service_midnight >= 86400 THEN 1 ELSE 0 END").alias("o")
    ).count()
    return (t.join(m.service_calendar, "service_id")
            .groupBy(F.expr("date_add(service_date, o)").alias("service_date"), "stop_id")
            .agg(F.sum("count").alias("arrivals_count")))


def _brute_hourly(m):
    ev = m.fact_scheduled_stop_event.join(m.dim_route.select("route_id", "service_category"),
                                          "route_id")
    t = ev.groupBy("service_id", "service_category",
                   F.expr("(arrival_seconds_from_service_midnight div 3600) % 24").alias("h"),
                   F.expr("CASE WHEN arrival_seconds_from_service_midnight >= 86400 THEN 1 ELSE 0 END").alias("o")
                   ).count()
    return (t.join(m.service_calendar, "service_id")
            .groupBy(F.expr("date_add(service_date, o)").alias("service_date"),
                     F.col("h").alias("hour_of_day"), "service_category")
            .agg(F.sum("count").alias("arrivals_count")))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _check(m):
    daily = m.presentation_daily_stop_arrivals
    assert _rows(daily.select("service_date", "stop_id", "arrivals_count")) == \
        _rows(_brute_daily(m).select("service_date", "stop_id", "arrivals_count"))
    hourly = m.presentation_hourly_network_density
    cols = ["service_date", "hour_of_day", "service_category", "arrivals_count"]
    assert _rows(hourly.select(*cols)) == _rows(_brute_hourly(m).select(*cols))
    rs = {r.route_id: r for r in m.presentation_route_summary.collect()}
    ft = m.fact_scheduled_trip
    for r in ft.groupBy("route_id").agg(
            F.count("*").alias("n"), F.countDistinct("trip_id").alias("t"),
            F.avg("source_headway_seconds").alias("avg"),
            F.min("departure_seconds_from_service_midnight").alias("first"),
            F.max("departure_seconds_from_service_midnight").alias("last")).collect():
        if r.route_id in rs:
            s = rs[r.route_id]
            assert (s.abstract_departures_count, s.distinct_trips_count) == (r.n, r.t)
            assert (s.first_departure_seconds, s.last_departure_seconds) == (r.first, r.last)
            assert s.avg_headway_seconds == round(r.avg)
    stops = {r.route_id: r.c for r in m.fact_scheduled_stop_event.groupBy("route_id")
             .agg(F.countDistinct("stop_id").alias("c")).collect()}
    for rid, s in rs.items():
        assert s.distinct_stops_served == stops.get(rid, 0)


def test_marts_on_fixture(spark):
    m = fixture_models(spark)
    _check(m)
    assert m.presentation_route_summary.where("route_id = 'R9'").first().abstract_departures_count == 0
    # an arrival at 24:30 lands on hour 0 of the next clock date
    hourly = m.presentation_hourly_network_density
    assert hourly.where("hour_of_day = 0").count() > 0


def test_marts_on_random_windows(spark):
    rnd = random.Random(11)
    trips, freqs, stop_times = [], [], []
    for t in range(60):
        trips.append((f"T{t}", f"R{t % 5}", "WK" if t % 3 else "WE", str(t % 2)))
        for w in range(rnd.randint(1, 3)):
            start = rnd.randint(0, 30) * 1800 + rnd.choice([0, 17, 59])
            end = start + rnd.randint(0, 10) * 1700
            hw = rnd.choice([60, 300, 599, 900, 3600, 5000, 86400])
            freqs.append((f"T{t}", f"{start // 3600:02d}:{start % 3600 // 60:02d}:{start % 60:02d}",
                          f"{end // 3600:02d}:{end % 3600 // 60:02d}:{end % 60:02d}", str(hw), "0"))
        base = rnd.randint(5, 20) * 3600
        for s in range(rnd.randint(1, 6)):
            a = base + s * rnd.randint(60, 9000)
            txt = None if rnd.random() < 0.05 else f"{a // 3600:02d}:{a % 3600 // 60:02d}:{a % 60:02d}"
            stop_times.append((f"T{t}", f"S{rnd.randint(0, 9)}", str(s), txt, txt))
    tables = {
        "stops": raw(spark, "stops", [(f"S{i}", f"Stop {i}") for i in range(10)],
                     ["stop_id", "stop_name"]),
        "routes": raw(spark, "routes", [(f"R{i}", str(i), f"Route {i}", ["A", "B", ""][i % 3], "3")
                                        for i in range(5)],
                      ["route_id", "route_short_name", "route_long_name", "route_desc", "route_type"]),
        "trips": raw(spark, "trips", trips, ["trip_id", "route_id", "service_id", "direction_id"]),
        "calendar": raw(spark, "calendar", [("WK", "1", "1", "1", "1", "1", "0", "0", "20240101", "20240115"),
                                            ("WE", "0", "0", "0", "0", "0", "1", "1", "20240101", "20240115")],
                        ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday",
                         "saturday", "sunday", "start_date", "end_date"]),
        "frequencies": raw(spark, "frequencies", freqs,
                           ["trip_id", "start_time", "end_time", "headway_secs", "exact_times"]),
        "stop_times": raw(spark, "stop_times", stop_times,
                          ["trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time"]),
    }
    _check(FeedModels(spark, tables))


def test_invariants(spark):
    """Daily and hourly totals agree when every route resolves; arrival
    offsets are never negative; departures stay before the window end."""
    m = fixture_models(spark)
    resolved = m.presentation_daily_stop_arrivals.agg(F.sum("arrivals_count")).first()[0]
    hourly = m.presentation_hourly_network_density.agg(F.sum("arrivals_count")).first()[0]
    unknown_route_visits = (m.fact_scheduled_stop_event.where("route_service_category IS NULL")
                            .join(m.service_calendar, "service_id").count())
    assert resolved == hourly + unknown_route_visits
    assert m.stop_offsets.where("arrival_offset_seconds < 0").count() == 0
    assert m.fact_scheduled_trip.where(
        "departure_seconds_from_service_midnight >= source_window_end_seconds").count() == 0
