import datetime as dt

from conftest import raw

from headway.operators import calendar as cal
from headway.operators import staging

CAL_COLS = ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday",
            "sunday", "start_date", "end_date"]


def _cal(spark, rows, exceptions):
    c = staging.stg_calendar(raw(spark, "calendar", rows, CAL_COLS))
    d = staging.stg_calendar_dates(raw(spark, "calendar_dates", exceptions,
                                       ["service_id", "date", "exception_type"]))
    return c, d


def brute_force(rows, exceptions, spine=(cal.SPINE_START, cal.SPINE_END)):
    """The range-join definition, in plain Python."""
    days = [spine[0] + dt.timedelta(n) for n in range((spine[1] - spine[0]).days + 1)]
    base = set()
    for r in rows:
        sid, flags = r[0], [f == "1" for f in r[1:8]]
        start = dt.datetime.strptime(r[8], "%Y%m%d").date()
        end = dt.datetime.strptime(r[9], "%Y%m%d").date()
        for d in days:
            if start <= d <= end and flags[d.weekday()]:
                base.add((sid, d))
    removed = {(s, dt.datetime.strptime(d, "%Y%m%d").date()) for s, d, t in exceptions if t == "2"}
    added = {(s, dt.datetime.strptime(d, "%Y%m%d").date()) for s, d, t in exceptions if t == "1"}
    return (base - removed) | added


def test_service_calendar_matches_range_join(spark):
    rows = [("WK", "1", "1", "1", "1", "1", "0", "0", "20240101", "20240131"),
            ("OLD", "1", "1", "1", "1", "1", "1", "1", "20050101", "20051231"),   # outside spine
            ("EDGE", "0", "0", "0", "0", "0", "1", "1", "20301220", "20310110"),  # clipped at end
            ("BACK", "1", "1", "1", "1", "1", "1", "1", "20240110", "20240101")]  # start > end
    exceptions = [("WK", "20240102", "2"), ("WK", "20240102", "1"),  # removed and added: active
                  ("WK", "20240103", "2"),                            # removed
                  ("WK", "20240106", "1"),                            # added Saturday
                  ("ONLYX", "20240105", "1"),                         # only in exceptions
                  ("WK", "20310105", "1"),                            # added after the spine
                  ("WK", "20240104", "3")]                            # unknown type: ignored
    c, d = _cal(spark, rows, exceptions)
    got = {(r.service_id, r.service_date) for r in cal.service_calendar(c, d).collect()}
    assert got == brute_force(rows, exceptions)
    assert ("WK", dt.date(2024, 1, 2)) in got and ("WK", dt.date(2024, 1, 3)) not in got
    assert ("WK", dt.date(2031, 1, 5)) in got
    assert not any(s == "OLD" or s == "BACK" for s, _ in got)
    assert max(x for s, x in got if s == "EDGE") == dt.date(2030, 12, 29)


def test_dim_date_shape(spark):
    d = cal.dim_date(spark)
    assert d.count() == 4018
    row = d.where("date_id = DATE'2024-01-06'").first()
    assert (row.day_of_week, row.day_name, row.day_name_short, row.month_name,
            row.year_month, row.is_weekend, row.iso_week_number, row.quarter) == \
        (7, "Saturday", "Sat", "January", "2024-01", True, 1, 1)


def test_services_of_the_same_dates_are_one_class(spark):
    day = [dt.date(2024, 1, d) for d in range(1, 5)]
    rows = ([("A", d) for d in day] + [("B", d) for d in reversed(day)] + [("C", day[0])]
            + [("D", day[0]), ("D", None), (None, day[1])] + [("E", day[0])] * 2)
    classes, dates = cal.date_classes(spark.createDataFrame(rows, "service_id string, service_date date"))
    of = {r.service_id: r.date_class for r in classes.collect()}
    assert of["A"] == of["B"] and of["C"] == of["E"] and len(set(of.values())) == 4
    held = {(r.date_class, r.service_date) for r in dates.collect()}
    assert held == {(of[s], d) for s, d in rows} and dates.count() == len(held)
