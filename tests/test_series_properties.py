"""Closed-form series helpers against Python brute force (property-based)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from headway.functions.series import col, departure_count, departure_series, hour_buckets

WINDOWS = st.lists(st.tuples(st.integers(0, 100_000), st.integers(-20_000, 200_000),
                             st.integers(-7_200, 7_200), st.integers(-4_000, 100_000)),
                   min_size=1, max_size=40)


def _series(start, end, headway):
    if headway > 0 and end - 1 >= start:
        return list(range(start, end, headway))
    if headway < 0 and end - 1 <= start:
        return list(range(start, end - 2, headway))   # down to end - 1 inclusive
    return []


def _bucket(v):
    return int(v / 3600)   # truncating division


@settings(max_examples=8, deadline=None)
@given(WINDOWS)
def test_series_count_and_hour_buckets(spark, rows):
    df = spark.createDataFrame(rows, "s long, e_off long, h long, off long") \
        .selectExpr("s", "s + e_off AS e", "h", "off")
    n = departure_count("s", "e", "h")
    first = f"least(s, s + (({n}) - 1) * h) + off"
    out = df.select(
        col(departure_series("s", "e", "h")).alias("a"), col(n).alias("n"),
        col(f"CASE WHEN {n} > 0 THEN {hour_buckets(first, 'abs(h)', n)} END").alias("b")).collect()
    for (s, e_off, h, off), r in zip(rows, out):
        want = _series(s, s + e_off, h)
        assert (r.a or []) == want
        assert r.n == len(want)
        if want:
            counts = {}
            for v in want:
                counts[_bucket(v + off)] = counts.get(_bucket(v + off), 0) + 1
            got = {}
            for item in r.b:
                got[item.bucket] = got.get(item.bucket, 0) + item.n
            assert got == counts
