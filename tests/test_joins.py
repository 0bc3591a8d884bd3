import re

import pytest
from fixture_feed import fixture_models
from pyspark.sql import functions as F

from headway.operators import joins
from headway.plans.models import FeedModels

LIMIT = 400


def skewed(spark):
    """Keys 0-39 hot on the left, 40-79 hot on the right, 80-119 on both."""
    def rows(n, *hot):
        hot_keys = [k for a, z in hot for k in range(a, z)]
        df = spark.range(n).select((F.col("id") % 200).alias("k"), F.col("id").alias("v"))
        more = spark.range(120 * len(hot_keys)).select(
            F.element_at(F.array(*[F.lit(k) for k in hot_keys]),
                         (F.col("id") % len(hot_keys) + 1).cast("int")).cast("long").alias("k"),
            (F.col("id") + n).alias("v"))
        return df.unionByName(more)
    return rows(400, (0, 40), (80, 120)), rows(400, (40, 80), (80, 120)).withColumnRenamed("v", "w")


@pytest.fixture(scope="module")
def parts(spark):
    left, right = skewed(spark)
    loads = left.groupBy("k").agg(F.count("*").alias("l")).join(
        right.groupBy("k").agg(F.count("*").alias("r")), "k")
    return left, right, loads


def test_cells_bound_the_pairs_of_a_cell(parts):
    _, _, loads = parts
    hot = joins.cells(loads, "l", "r", LIMIT).collect()
    assert {r.k for r in hot} == {r.k for r in loads.where(f"l * r > {LIMIT}").collect()}
    assert len(hot) >= 40                                    # no cap on hot keys
    for r in hot:
        # Cells of rows dealt evenly emit LIMIT pairs at most.
        assert -(-r.l // r.left_cells) * -(-r.r // r.right_cells) <= LIMIT * 1.1
        assert r.left_cells <= r.l and r.right_cells <= r.r


def test_grid_join_equals_plain_join_and_spreads_every_hot_key(spark, parts):
    left, right, loads = parts
    grid = joins.cells(loads, "l", "r", LIMIT)
    joined = joins.grid_join(left, right, ["k"], grid)
    plain = left.join(right, "k")
    assert sorted(map(tuple, joined.select("k", "v", "w").collect())) == \
        sorted(map(tuple, plain.select("k", "v", "w").collect()))


def test_grid_join_partitions(spark, parts):
    """Many hot keys over many partitions: no partition emits much more than
    its share, and the number of partitions is the session's."""
    left, right, loads = parts
    # Coalescing off: the shuffle's own dealing is looked at.
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                             "spark.sql.adaptive.enabled",
                                             "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def sizes(df):
            return sorted((r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()))
        grid = joins.cells(loads, "l", "r", LIMIT)
        cut = sizes(joins.grid_join(left, right, ["k"], grid))
        plain = sizes(left.join(right, "k"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(cut) >= 60
    assert cut[-1] < plain[-1] / 2 and cut[-1] < 2 * sum(cut) / len(cut)


def test_joins_stay_open_to_adaptive_splitting(spark, parts):
    left, right, loads = parts
    for grid in (None, joins.cells(loads, "l", "r", LIMIT)):
        joined = joins.grid_join(left, right, ["k"], grid)
        plan = joined._jdf.queryExecution().toString()
        assert "REPARTITION" not in plan


MODELS = ("fact_scheduled_trip", "fact_scheduled_stop_event", "stop_offsets",
          "presentation_daily_stop_arrivals", "presentation_hourly_network_density",
          "presentation_route_summary")


def rows_of(m):
    return {name: sorted((tuple(r) for r in m.model(name).select(
        sorted(m.model(name).columns)).collect()), key=repr) for name in MODELS}


def test_models_with_every_trip_hot_match(spark, monkeypatch):
    plain = rows_of(fixture_models(spark))
    monkeypatch.setattr(FeedModels, "rows_per_task", 1)
    m = fixture_models(spark)
    assert m.load["max_pairs"] > 1 and m.load["max_windows"] > 1
    hot = rows_of(m)
    for name in plain:
        assert hot[name] == plain[name], name


def test_expansion_partitions_grow_with_output(spark):
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert joins.partitions_for(spark, 10) == joins.partitions_for(spark, None) == base
    assert joins.partitions_for(spark, 10_000_000_001, rows_per_task=1_000_000) == 10_001
    assert joins.partitions_for(spark, 500_000_000_000) == joins.MOST_TASKS


def test_model_graph_totals(spark):
    m = fixture_models(spark)
    assert m.load["departures"] == m.fact_scheduled_trip.count()
    assert m.load["visits"] == m.fact_scheduled_stop_event.count()


def test_large_expansion_is_spread(spark, monkeypatch):
    """With a tiny rows-per-task target the stop-visit fact deals its pairs
    over more partitions; the rows are the same."""
    plain = fixture_models(spark).fact_scheduled_stop_event
    want = sorted((tuple(r) for r in plain.collect()), key=repr)
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 10)
    wide = fixture_models(spark).fact_scheduled_stop_event
    found = re.search(r"hashpartitioning\(trip_id#\d+, [^)]*stop_id#\d+, (\d+)\)",
                      wide._jdf.queryExecution().simpleString())
    assert int(found[1]) == -(-len(want) // 10)
    assert sorted((tuple(r) for r in wide.collect()), key=repr) == want
