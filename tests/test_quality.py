import datetime as dt

from fixture_feed import fixture_models
from pyspark.sql import functions as F

from headway.operators import quality as q


def test_each_kind_catches_a_seeded_violation(spark):
    df = spark.createDataFrame(
        [("a", 1, -6.0, "x"), ("a", 2, -8.0, "y"), (None, 3, None, "bad"), ("b", 3, -5.5, "x")],
        "id string, n long, lat double, label string")
    parent = spark.createDataFrame([("a",)], "id string")
    assert q.not_null_failures(df, "id").count() == 1
    assert q.unique_failures(df, "id").count() == 1                      # 'a' twice, NULL ignored
    assert q.accepted_values_failures(df, "label", ["x", "y"]).count() == 1
    assert q.relationships_failures(df, "id", parent, "id").count() == 1  # 'b'
    assert q.between_failures(df, "lat", -7.0, -5.0, "lat IS NOT NULL").count() == 1
    assert q.between_failures(df, "n", min_value=2).count() == 1
    assert q.unique_combination_failures(df, ["n"]).count() == 1
    checks = [q.Check("not_null", "t", "id"), q.Check("unique", "t", "id"),
              q.Check("accepted_values", "t", "label", values=("x", "y")),
              q.Check("relationships", "t", "id", to="p", field="id"),
              q.Check("between", "t", "lat", min_value=-7.0, max_value=-5.0,
                      row_condition="lat IS NOT NULL"),
              q.Check("unique_combination", "t", ("n",))]
    summary = q.run_checks(spark, checks, {"t": df, "p": parent}.__getitem__)
    got = {r.check_type: (r.failures, r.status) for r in summary.collect()}
    assert all(v == (1, "fail") for v in got.values()) and len(got) == 6


def test_declared_checks_on_fixture(spark):
    assert len(q.ALL_CHECKS) == 113
    m = fixture_models(spark)
    res = {r.check_id: r.failures for r in q.run_checks(spark, q.ALL_CHECKS, m.table).collect()}
    assert len(res) == 113
    # the fixture has a trip on an unknown route and a service missing from the calendar
    assert res["relationships__stg_trips__route_id__stg_routes"] == 1
    assert res["relationships__fact_scheduled_trip__route_id__dim_route"] == 1
    assert res["not_null__fact_scheduled_stop_event__arrival_seconds_from_service_midnight"] > 0
    assert res["unique__fact_scheduled_trip__scheduled_trip_id"] == 1
    assert res["unique__dim_date__date_id"] == 0


def test_freshness(spark):
    loads = spark.createDataFrame([("2024-01-01",), ("2024-01-05",)], "snapshot_date string")
    row = q.freshness(loads, "snapshot_date", dt.date(2024, 1, 10)).first()
    assert (row.age_days, row.status) == (5, "pass")
    assert q.freshness(loads, "snapshot_date", dt.date(2024, 1, 20)).first().status == "warn"
    assert q.freshness(loads, "snapshot_date", dt.date(2024, 3, 1)).first().status == "error"
    empty = loads.where(F.lit(False))
    assert q.freshness(empty, "snapshot_date", dt.date(2024, 3, 1)).first().status == "error"


def test_surrogate_keys_are_compared_by_half_their_bytes(spark):
    import hashlib

    key = hashlib.md5(b"x").hexdigest()
    texts = [key, key, key.upper(), "", "", "0", "00", "00", "1", "01", "zz", "é", "é", None, None]
    df = spark.createDataFrame([(t,) for t in texts], "scheduled_trip_id string")
    failed = q.unique_failures(df, "scheduled_trip_id")
    assert "unhex" in failed._jdf.queryExecution().toString()
    assert {r.unique_field: r.n_records for r in failed.collect()} == {key: 2, "": 2, "00": 2, "é": 2}
    parent = df.where("scheduled_trip_id IN ('0', 'zz') OR length(scheduled_trip_id) = 32")
    orphans = q.orphan_keys(df, "scheduled_trip_id", parent, "scheduled_trip_id")
    assert {r.key: r.n_records for r in orphans.collect()} == {"": 2, "00": 2, "1": 1, "01": 1, "é": 2}
