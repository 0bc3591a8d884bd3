"""A small hand-made feed with the edge cases the test tables cannot give."""

from conftest import raw

from headway.plans.models import FeedModels

STOPS = [("S1", "Hub A", "-6.2", "106.8", "1", None, "1"),
         ("S2", "Hub A platform", "-6.2", "106.8", "0", "S1", "2"),
         ("S3", "Mid", "-6.3", "106.9", "0", None, None),
         ("S4", "End", "-6.4", "107.0", "3", None, "0"),
         ("007", "Leading zeros", "-6.5", "107.1", None, None, None)]
ROUTES = [("R1", "1", "Corridor 1", "BRT", "3"),
          ("R2", "2", "Feeder", "", "3"),
          ("R3", "3", "Nameless", None, "11"),
          ("R9", "9", "No trips", "BRT", "3")]
TRIPS = [("T1", "R1", "WK", "0"), ("T2", "R2", "WE", "1"), ("T3", "R1", "WK", "0"),
         ("T4", "RX", "WK", "0"), ("T5", "R3", "NOSVC", "1"), ("T6", "R3", "WK", "0"),
         ("T7", "R1", "WK", "1")]
CALENDAR = [("WK", "1", "1", "1", "1", "1", "0", "0", "20240101", "20240131"),
            ("WE", "0", "0", "0", "0", "0", "1", "1", "20240101", "20240131")]
CALENDAR_DATES = [("WK", "20240102", "2"), ("WE", "20240102", "1")]
FREQUENCIES = [("T1", "05:00:00", "22:00:00", "3600", "0"),
               ("T1", "22:00:00", "26:00:00", "900", "1"),   # shares the 22:00 boundary
               ("T2", "23:30:00", "25:00:00", "600", "0"),
               ("T2", "23:30:00", "24:00:00", "1800", "0"),  # overlaps: duplicate departures
               ("T4", "06:00:00", "07:00:00", "3600", "0"),  # unknown route
               ("T5", "10:00:00", "10:00:00", "600", "0"),   # empty window
               ("T6", "05:00:00", "22:00:00", "2180", "0"),  # 29 departures
               ("T7", "00:00:00", "24:00:00", "86400", "0")]  # once a day
STOP_TIMES = [("T1", "S1", "0", "05:00:00", "05:00:10"),
              ("T1", "S2", "1", "05:03:01", "05:03:11"),
              ("T1", "S3", "2", None, None),                   # NULL arrival mid-trip
              ("T1", "S4", "3", "05:10:00", "05:10:00"),
              ("T2", "S3", "0", "10:05:00", "10:05:00"),
              ("T2", "S1", "1", "10:00:00", "10:00:30"),       # earliest time, not lowest seq
              ("T2", "S4", "2", "58:00:00", "58:00:00"),       # 48h+ offset
              ("T4", "S1", "0", "06:00:00", "06:00:00"),
              ("T6", "S2", "0", "05:00:00", "05:00:00"),
              ("T6", "007", "1", "05:30:00", "05:31:00"),
              ("T7", "S1", "0", "23:59:00", "23:59:00"),
              ("T7", "S2", "1", "24:30:00", "24:31:00")]


def fixture_tables(spark) -> dict:
    return {
        "stops": raw(spark, "stops", STOPS, ["stop_id", "stop_name", "stop_lat", "stop_lon",
                                             "location_type", "parent_station",
                                             "wheelchair_boarding"]),
        "routes": raw(spark, "routes", ROUTES, ["route_id", "route_short_name",
                                                "route_long_name", "route_desc", "route_type"]),
        "trips": raw(spark, "trips", TRIPS, ["trip_id", "route_id", "service_id", "direction_id"]),
        "calendar": raw(spark, "calendar", CALENDAR,
                        ["service_id", "monday", "tuesday", "wednesday", "thursday", "friday",
                         "saturday", "sunday", "start_date", "end_date"]),
        "calendar_dates": raw(spark, "calendar_dates", CALENDAR_DATES,
                              ["service_id", "date", "exception_type"]),
        "frequencies": raw(spark, "frequencies", FREQUENCIES,
                           ["trip_id", "start_time", "end_time", "headway_secs", "exact_times"]),
        "stop_times": raw(spark, "stop_times", STOP_TIMES,
                          ["trip_id", "stop_id", "stop_sequence", "arrival_time",
                           "departure_time"]),
    }


def fixture_models(spark) -> FeedModels:
    return FeedModels(spark, fixture_tables(spark))
