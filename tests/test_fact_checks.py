"""Checks on the facts by windows, against the rows themselves."""
import collections
import random

import pytest

from headway.operators import fact_checks, quality
from headway.operators.quality import Check, failing_rows, run_checks

WINDOW = "trip_id string, window_start_seconds long, window_end_seconds long, " \
         "headway_seconds long, n_departures long"


def departures(start, end, step):
    return list(range(start, end, step)) if step > 0 else list(range(start, end - 2, step))


def windows_of(rng, n):
    rows = []
    for i in range(n):
        start, step = rng.randrange(0, 90_000, 300), rng.choice([300, 420, 600, 3600, 86_400, -300])
        end = start + rng.choice([300, 1800, 7200, 40_000]) * (1 if step > 0 else -1)
        row = (f"T{rng.randrange(12)}", start, end, step)
        rows += [row] * rng.choice([1, 1, 1, 2])
    return [(*r, len(departures(*r[1:]))) for r in rows if departures(*r[1:])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_departures_against_expansion(spark, seed):
    rows = windows_of(random.Random(seed), 60)
    times = collections.Counter((t, d) for t, *w, _ in rows for d in departures(*w))
    got = fact_checks.repeated_departures(spark.createDataFrame(rows, WINDOW)).collect()
    assert {(r.trip_id, r.departure): r.times for r in got} == {k: n for k, n in times.items() if n > 1}


def test_windows_that_share_an_hour_but_no_departure(spark):
    rows = [("A", 0, 1800, 600, 3), ("A", 1800, 3600, 600, 3), ("B", 0, 7200, 1200, 6),
            ("B", 300, 7200, 1200, 6), ("C", 0, 3600, 1200, 3)]
    assert fact_checks.repeated_departures(spark.createDataFrame(rows, WINDOW)).collect() == []


@pytest.mark.parametrize("seed", [4, 5])
def test_checks_by_weights_equal_checks_on_rows(spark, seed):
    rng = random.Random(seed)
    rows = [(*w[:4], w[4], rng.choice(["R1", "R2", None]), "S") for w in windows_of(rng, 40)]
    windows = spark.createDataFrame(rows, WINDOW + ", route_id string, service_id string")
    stops = [(f"T{rng.randrange(14)}", rng.choice(["S1", "S2", None, "gone"]), rng.choice([1, 2, 3, None]),
              rng.choice([60, 90, None]), 95) for _ in range(50)]
    times = spark.createDataFrame(stops, "trip_id string, stop_id string, stop_sequence long, "
                                  f"{fact_checks.ARRIVAL} long, {fact_checks.DEPARTURE} long")
    stats = times.groupBy("trip_id").agg({fact_checks.ARRIVAL: "min"}).toDF(
        "trip_id", "trip_first_arrival_seconds")
    weighted = {"trip": fact_checks.trip_fact(windows),
                "event": fact_checks.stop_event_fact(windows, times, stats)}
    trips = [(t, d, r) for t, a, z, h, _, r, _ in rows for d in departures(a, z, h)]
    first = {t: min((x[3] for x in stops if x[0] == t and x[3] is not None), default=None)
             for t in {x[0] for x in stops}}
    events = [(t, d, r, s, q, None if a is None or first[t] is None else d + a - first[t])
              for t, d, r in trips for u, s, q, a, _ in stops if u == t]
    parents = {"stops": spark.createDataFrame([("S1",), ("S2",)], "stop_id string"),
               "routes": spark.createDataFrame([("R1",)], "route_id string")}
    checks = [Check("not_null", "trip", "route_id"), Check("not_null", "event", "stop_id"),
              Check("not_null", "event", fact_checks.ARRIVAL), Check("not_null", "event", "stop_sequence"),
              Check("between", "trip", fact_checks.DEPARTURE, min_value=5000, max_value=60_000),
              Check("unique", "trip", "scheduled_trip_id"),
              Check("unique", "event", "scheduled_stop_event_id"),
              Check("relationships", "trip", "route_id", to="routes", field="route_id"),
              Check("relationships", "event", "stop_id", to="stops", field="stop_id")]
    want = [sum(r is None for *_, r in trips), sum(e[3] is None for e in events),
            sum(e[5] is None for e in events), sum(e[4] is None for e in events),
            sum(not 5000 <= d <= 60_000 for _, d, _ in trips),
            sum(n > 1 for n in collections.Counter((t, d) for t, d, _ in trips).values()),
            sum(n > 1 for n in collections.Counter((e[0], e[1], e[4]) for e in events).values()),
            sum(r == "R2" for *_, r in trips), sum(e[3] == "gone" for e in events)]
    got = {r.check_id: r.failures for r in run_checks(spark, checks, parents.__getitem__, weighted)
           .collect()}
    assert [got[c.check_id] for c in checks] == want
    keys = {"trip": ("trip_id",), "event": ("trip_id", "stop_sequence")}
    quality.ROW_KEYS.update(keys)
    listed = collections.Counter()
    for r in failing_rows(checks, parents.__getitem__, weighted).collect():
        listed[r.check_id] += r.n_records
    for k in keys:
        del quality.ROW_KEYS[k]
    assert {c.check_id: listed[c.check_id] for c in checks} == got


def test_pairs_and_repeats_of_the_facts_are_made_once(spark, monkeypatch):
    from fixture_feed import fixture_models

    from headway.plans import models
    m, stored, found = fixture_models(spark), [], []
    keep, search = models.stored_table, fact_checks.repeated_departures
    monkeypatch.setattr(models, "stored_table", lambda df, name: stored.append(name) or keep(df, name))
    monkeypatch.setattr(fact_checks, "repeated_departures", lambda w: found.append(1) or search(w))
    facts = m.weighted_facts
    event, trip = facts["fact_scheduled_stop_event"], facts["fact_scheduled_trip"]
    assert trip.repeats.count() and event.repeats.count() and len(found) == 1
    assert event.rows.agg({"n_rows": "sum"}).first()[0] == m.fact_scheduled_stop_event.count()
    marts = [m.presentation_daily_stop_arrivals, m.presentation_hourly_network_density,
             m.presentation_route_summary]
    assert stored.count("pairs") == 1
    plain = fixture_models(spark)
    for df, other in zip(marts, (plain.presentation_daily_stop_arrivals,
                                 plain.presentation_hourly_network_density,
                                 plain.presentation_route_summary)):
        assert "pairs" in "".join(df.inputFiles())
        assert sorted(map(str, df.collect())) == sorted(map(str, other.collect()))
