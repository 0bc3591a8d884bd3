from fixture_feed import fixture_models
from pyspark.sql import functions as F


def test_fact_scheduled_trip(spark):
    m = fixture_models(spark)
    f = m.fact_scheduled_trip
    per_trip = {r.trip_id: r.n for r in f.groupBy("trip_id").agg(F.count("*").alias("n")).collect()}
    # T1: 17 hourly + 16 quarter-hourly; T2: 9 + 1 overlapping; T6: 29; T7: 1.
    assert per_trip == {"T1": 17 + 16, "T2": 9 + 1, "T4": 1, "T6": 29, "T7": 1}
    t4 = f.where("trip_id = 'T4'").first()
    assert t4.route_service_category is None and t4.service_name == "Weekday (WK)"
    t1 = f.where("trip_id = 'T1'").agg(F.max("departure_seconds_from_service_midnight")).first()[0]
    assert t1 == 26 * 3600 - 900            # end exclusive
    cats = {r.trip_id: r.route_service_category for r in f.select("trip_id", "route_service_category").distinct().collect()}
    assert cats["T6"] == "Unknown" and cats["T2"] == "Unknown" and cats["T1"] == "BRT"
    dup = f.where("trip_id = 'T2'").groupBy("scheduled_trip_id").count().where("count > 1").count()
    assert dup == 1                          # overlapping windows repeat 23:30


def test_stop_offsets_and_events(spark):
    m = fixture_models(spark)
    off = {(r.trip_id, r.stop_sequence): (r.arrival_offset_seconds, r.departure_offset_seconds)
           for r in m.stop_offsets.collect()}
    assert off[("T1", 0)] == (0, 10) and off[("T1", 1)] == (181, 191)
    assert off[("T1", 2)] == (None, None)
    assert off[("T2", 1)] == (0, 30) and off[("T2", 0)] == (300, 300)   # base = min arrival
    ev = m.fact_scheduled_stop_event
    row = ev.where("trip_id = 'T1' AND stop_sequence = 1 "
                   "AND trip_start_seconds_from_service_midnight = 21600").first()
    assert row.arrival_seconds_from_service_midnight == 21600 + 181      # 06:03:01
    assert row.departure_seconds_from_service_midnight == 21600 + 191
    # visits = departures x stops for every trip
    deps = {r.trip_id: r.n for r in m.fact_scheduled_trip.groupBy("trip_id").agg(F.count("*").alias("n")).collect()}
    stops = {"T1": 4, "T2": 3, "T4": 1, "T6": 2, "T7": 2}
    visits = {r.trip_id: r.n for r in ev.groupBy("trip_id").agg(F.count("*").alias("n")).collect()}
    assert visits == {t: deps[t] * stops[t] for t in deps}
    assert ev.where("arrival_seconds_from_service_midnight >= 172800").count() > 0


def test_dims(spark):
    m = fixture_models(spark)
    r = {x.route_id: x for x in m.dim_route.collect()}
    assert r["R2"].service_category == "Unknown" and r["R3"].service_category == "Unknown"
    assert r["R3"].route_type_name == "trolleybus"
    s = {x.stop_id: x for x in m.dim_stop.collect()}
    assert s["S1"].is_station and s["S1"].location_type_name == "station"
    assert s["S4"].location_type_name == "generic_node"
    assert s["S2"].wheelchair_boarding_name == "not_accessible"
    assert s["007"].location_type_name == "unknown" and s["007"].is_station is None
    svc = {x.service_id: x for x in m.dim_service.collect()}
    assert svc["WK"].service_name == "Weekday (WK)" and svc["WK"].active_days_count == 22
    assert svc["WE"].service_name == "Weekend (WE)" and svc["WE"].active_days_count == 9
    assert "NOSVC" not in svc


def test_stop_visits_are_dealt_once_by_trip(spark):
    few, hot = fixture_models(spark), fixture_models(spark)
    hot.rows_per_task = 1          # every trip is too much for a task
    plan = few.fact_scheduled_stop_event._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join")]
    assert "Repartition" not in above
    a, b = (sorted(map(str, m.fact_scheduled_stop_event.collect())) for m in (few, hot))
    assert a and a == b


def test_departures_meet_their_visits_where_they_are(spark):
    import collections

    from headway.operators.schedule import with_visits
    few, hot = fixture_models(spark), fixture_models(spark)
    hot.rows_per_task = 1          # every trip is too much for a task
    found = [with_visits(m.fact_scheduled_trip, m.fact_scheduled_stop_event) for m in (few, hot)]
    plan = found[0]._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan[:plan.index("Union")].splitlines() if "Exchange" in x]
    assert dealt == []             # nothing is shuffled once departures are rows
    dep = "departure_seconds_from_service_midnight"
    stops = collections.Counter(r.trip_id for r in few.stg_stop_times.collect())
    want = sorted((r.trip_id, r[dep], stops[r.trip_id] or None)
                  for r in few.fact_scheduled_trip.collect())
    for df in found:
        got = sorted((r.trip_id, r[dep], r.visits) for r in df.collect())
        assert [str(x) for x in got] == [str(x) for x in want]
