import hashlib

from pyspark.sql import functions as F

from headway.functions.keys import KEY_NULL_SENTINEL, surrogate_key
from headway.functions.series import col, count_in_range, departure_count, departure_series
from headway.functions.times import gtfs_time_to_seconds


def test_time_parsing(spark):
    cases = [("05:00:00", 18000), ("5:00:00", 18000), ("25:15:00", 90900),
             ("05:99:00", 5 * 3600 + 99 * 60), ("5:0:0", None), ("", None), (None, None),
             ("05:00:00\n", None), ("105:00:00", None), ("aa:bb:cc", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "t string")
    by_name = [r[0] for r in df.select(gtfs_time_to_seconds("t")).collect()]
    by_col = [r[0] for r in df.select(gtfs_time_to_seconds(F.col("t"))).collect()]
    assert by_name == [e for _, e in cases]
    assert by_col == [e for _, e in cases]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([("T1", 21600), ("T2", None)], "trip_id string, dep long")
    got = [r[0] for r in df.select(surrogate_key("trip_id", "dep")).collect()]
    want = [hashlib.md5(b"T1-21600").hexdigest(),
            hashlib.md5(f"T2-{KEY_NULL_SENTINEL}".encode()).hexdigest()]
    assert got == want


def _series(spark, rows):
    df = spark.createDataFrame(rows, "s long, e long, h long")
    out = df.select(col(departure_series("s", "e", "h")).alias("a"),
                    col(departure_count("s", "e", "h")).alias("n")).collect()
    return [(r.a, r.n) for r in out]


def test_departure_series_edges(spark):
    rows = [(18000, 79200, 2180),   # 05:00-22:00 every 2180 s: 29 departures
            (100, 100, 10),         # end = start: none
            (100, 50, 10),          # end < start: none
            (100, 200, 0),          # zero headway: none
            (100, 200, 500),        # headway longer than the window: one
            (0, 86400, 86400),      # once a day
            (100, 200, 50),         # end exclusive: 100, 150
            (None, 200, 10),        # NULL bound
            (100, 91, -5)]          # negative headway counts down to end - 1
    got = _series(spark, rows)
    assert got[0][1] == 29 and got[0][0][-1] == 18000 + 28 * 2180
    assert got[1] == (None, 0) and got[2] == (None, 0) and got[3] == (None, 0)
    assert got[4] == ([100], 1)
    assert got[5] == ([0], 1)
    assert got[6] == ([100, 150], 2)
    assert got[7] == (None, 0)
    assert got[8] == ([100, 95, 90], 3)


def test_count_in_range_against_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        first, step, n = rnd.randint(0, 100000), rnd.randint(1, 7000), rnd.randint(1, 40)
        lo = rnd.randint(0, 200000)
        hi = lo + rnd.randint(0, 20000)
        rows.append((first, step, n, lo, hi))
    df = spark.createDataFrame(rows, "f long, st long, n long, lo long, hi long")
    got = [r[0] for r in df.select(col(count_in_range("f", "st", "n", "lo", "hi"))).collect()]
    want = [sum(1 for k in range(n) if lo <= f + k * st <= hi) for f, st, n, lo, hi in rows]
    assert got == want
