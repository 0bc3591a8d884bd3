"""Analyses over the marts: supply rankings, hourly pulse, tiers, hubs.

Top-k reports take the k rows with a bounded ``orderBy().limit()`` (each task
keeps its own k best, then the k best of those are merged), and only then
compute RANK over those k rows.  That equals the rank over the whole input:
every row that outranks a top-k row is itself in the top k.  No global
window ever runs over an unbounded input.

Counts that the facts would give by counting exploded rows are sums of
``n_departures`` over the pre-expansion tables (a window stands for
``n_departures`` departures, a trip's stop row for as many visits as the trip
has departures).

Models of several feeds carry ``feed_key``; reports over the whole network
are then made per feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.labels import WEEKDAY_FLAGS
from headway.operators.presentation import visits_by_service_hour

# Headway tiers in minutes, upper bounds inclusive (README cuts:
# 5 minutes or better, 6-10, ... worse than 20).
FREQUENCY_TIERS = [(1, "<= 5 min", 300), (2, "5-10 min", 600), (3, "10-15 min", 900),
                   (4, "15-20 min", 1200), (5, "> 20 min", None)]
DAYTIME_HOURS = tuple(range(7, 22))


def _feed(df: DataFrame) -> list[str]:
    return [c for c in ("feed_key",) if c in df.columns]


def _with_total(df: DataFrame, value: str) -> DataFrame:
    """``df`` plus ``total``, the sum of ``value`` per feed: one row per feed
    joined back, whatever the number of rows."""
    feed = _feed(df)
    sums = df.groupBy(*feed, F.lit(1).alias("all_rows")).agg(F.sum(value).alias("total"))
    return df.withColumn("all_rows", F.lit(1)).join(sums, [*feed, "all_rows"]).drop("all_rows")


def _rank_top(df: DataFrame, order: list, top_n: int, rank_name: str,
              rank_order: list | None = None) -> DataFrame:
    top = df.orderBy(*order).limit(top_n)
    w = Window.orderBy(*(rank_order or order[:-1]))
    return top.withColumn(rank_name, F.rank().over(w).cast("long"))


def busiest_corridors(route_summary: DataFrame, category: str = "BRT",
                      top_n: int = 15) -> DataFrame:
    """Routes of one service category ranked by abstract departures."""
    dep = F.col("abstract_departures_count")
    ranked = _rank_top(route_summary.where(F.col("service_category") == category),
                       [dep.desc(), F.col("route_id")], top_n, "supply_rank", [dep.desc()])
    return ranked.select("route_short_name", "route_long_name", "service_category",
                         "abstract_departures_count", "distinct_stops_served",
                         "avg_headway_minutes", "service_window_hours", "supply_rank")


def busiest_routes(route_summary: DataFrame, top_n: int = 10) -> DataFrame:
    """All routes ranked by abstract departures (ties by route id)."""
    dep = F.col("abstract_departures_count")
    ranked = _rank_top(route_summary, [dep.desc(), F.col("route_id")], top_n, "departures_rank",
                       [dep.desc()])
    return ranked.select("route_id", "route_short_name", "route_long_name", "service_category",
                         "abstract_departures_count", "departures_rank")


def network_pulse(hourly: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Average arrivals per clock hour on a typical weekday and weekend day.

    The date dimension has a fixed, known size (the spine), so it is
    broadcast; dates outside the spine drop out of the inner join."""
    dates = F.broadcast(dim_date.select(F.col("date_id").alias("service_date"), "is_weekend"))
    day_type = F.when(F.col("is_weekend"), F.lit("Weekend")).otherwise(F.lit("Weekday"))
    feed = _feed(hourly)
    per_date = (hourly.join(dates, "service_date")
                .groupBy("service_date", "hour_of_day", day_type.alias("day_type"), *feed)
                .agg(F.sum("arrivals_count").alias("arrivals_count")))
    return (per_date.groupBy("hour_of_day", "day_type", *feed)
            .agg(F.round(F.avg("arrivals_count"), 0).alias("avg_arrivals_per_hour"))
            .orderBy("hour_of_day", "day_type", *feed))


def _tier(headway: F.Column) -> tuple[F.Column, F.Column]:
    order = label = None
    for n, name, bound in FREQUENCY_TIERS:
        if bound is None:
            order, label = order.otherwise(F.lit(n)), label.otherwise(F.lit(name))
        elif order is None:
            order, label = F.when(headway <= bound, F.lit(n)), F.when(headway <= bound, F.lit(name))
        else:
            order, label = order.when(headway <= bound, F.lit(n)), label.when(headway <= bound, F.lit(name))
    return order, label


def service_frequency_tiers(windows: DataFrame) -> DataFrame:
    """Scheduled departures by headway tier, with each tier's share."""
    order, label = _tier(F.col("headway_seconds"))
    tiers = windows.groupBy(order.cast("long").alias("tier_order"), label.alias("frequency_tier"),
                            *_feed(windows)).agg(F.sum("n_departures").alias("departures_count"))
    # One row per tier (and feed): a window per feed is small.
    total = F.sum("departures_count").over(Window.partitionBy(*_feed(windows)))
    return tiers.select("tier_order", "frequency_tier", "departures_count",
                        F.round(F.col("departures_count") / total, 4).alias("share_of_departures"),
                        *_feed(windows))


def peaking_factor(hourly: DataFrame, daytime_hours: tuple[int, ...] = DAYTIME_HOURS) -> DataFrame:
    """Busiest clock hour vs. the mean daytime hour, network-wide and per
    service category.

    For each scope and clock hour, arrivals are summed per date and averaged
    over the dates with service in that hour.  The peak hour has the highest
    average (ties: earliest hour); the factor is that average divided by the
    mean of the daytime hours' averages.

    One pass over ``hourly``: grouping sets give the per-category and the
    network sums together, and one window per scope finds the peak and the
    daytime mean (no self-join, so the input is computed once)."""
    feed = _feed(hourly)
    d, h, c = "service_date", "hour_of_day", "service_category"
    more = [F.col(f) for f in feed]
    sums = (hourly.where("hour_of_day IS NOT NULL")
            .groupingSets([[F.col(d), F.col(h), F.col(c), *more], [F.col(d), F.col(h), *more]],
                          d, h, c, *feed)
            .agg(F.sum("arrivals_count").alias("arrivals_count"), F.grouping(c).alias("level"))
            .selectExpr("CASE WHEN level = 0 THEN 'category' ELSE 'network' END AS scope_type",
                        "CASE WHEN level = 0 THEN service_category ELSE 'ALL' END AS scope",
                        "hour_of_day", "arrivals_count", *feed))
    by_hour = sums.groupBy("scope_type", "scope", "hour_of_day", *feed) \
        .agg(F.expr("avg(arrivals_count) AS avg_arrivals"))
    hours = ", ".join(map(str, daytime_hours))
    by = ", ".join(["scope_type", "scope", *feed])
    scoped = by_hour.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {by} ORDER BY avg_arrivals DESC, hour_of_day) AS rn",
        f"avg(CASE WHEN hour_of_day IN ({hours}) THEN avg_arrivals END) "
        f"OVER (PARTITION BY {by}) AS daytime_mean")
    return scoped.where("rn = 1").selectExpr(
        "scope_type", "scope", "hour_of_day AS peak_hour",
        "round(avg_arrivals, 0) AS peak_avg_arrivals",
        "round(daytime_mean, 0) AS daytime_mean_arrivals",
        "round(avg_arrivals / daytime_mean, 2) AS peaking_factor", *feed)


def service_tier_mix(windows: DataFrame, trip_stops: DataFrame) -> DataFrame:
    """Per service category: departures, share, routes with departures and
    distinct stops served (counted over stop visits, not summed per route)."""
    cat, feed = "route_service_category", _feed(windows)
    supply = windows.groupBy(cat, *feed).agg(F.sum("n_departures").alias("departures_count"),
                                             F.countDistinct("route_id").alias("routes_count"))
    stops = trip_stops.groupBy(cat, *feed).agg(
        F.countDistinct("stop_id").alias("distinct_stops_served"))
    on = supply[cat].eqNullSafe(stops[cat])
    for f in feed:
        on = on & supply[f].eqNullSafe(stops[f])
    joined = supply.join(stops, on, "left").select(
        supply[cat].alias("service_category"), "departures_count", "routes_count",
        F.coalesce("distinct_stops_served", F.lit(0).cast("long")).alias("distinct_stops_served"),
        *[supply[f] for f in feed])
    return _with_total(joined, "departures_count").select(
        "service_category", "departures_count",
        F.round(F.col("departures_count") / F.col("total"), 4).alias("share_of_departures"),
        "routes_count", "distinct_stops_served", *feed)


def _visits_per_stop(trip_stops: DataFrame) -> DataFrame:
    return trip_stops.groupBy("stop_id").agg(F.sum("n_departures").alias("arrivals_count"))


def busiest_stops(trip_stops: DataFrame, dim_stop: DataFrame, top_n: int = 10) -> DataFrame:
    """Stops with the most scheduled visits per service day."""
    arr = F.col("arrivals_count")
    top = _rank_top(_visits_per_stop(trip_stops), [arr.desc(), F.col("stop_id")], top_n,
                    "arrivals_rank", [arr.desc()])
    return top.join(dim_stop.select("stop_id", "stop_name"), "stop_id", "left").select(
        "stop_id", "stop_name", "arrivals_count", "arrivals_rank")


def top_interchange_hubs(trip_stops: DataFrame, dim_stop: DataFrame, top_n: int = 10) -> DataFrame:
    """Transfer points: stops rolled up to their parent station, ranked by
    distinct routes calling, then by visits."""
    # Visits are first summed per (stop, route) with a map-side partial
    # aggregate, so the join with the stop dimension sees one row per stop
    # and route (no hot stop can skew it), and the hub roll-up is small.
    per_stop_route = trip_stops.groupBy("stop_id", "route_id").agg(
        F.sum("n_departures").alias("n_departures"))
    parents = dim_stop.select("stop_id", "parent_station_id")
    hub = F.coalesce(F.col("parent_station_id"), F.col("stop_id"))
    per_hub = (per_stop_route.join(parents, "stop_id", "left")
               .groupBy(hub.alias("hub_id"))
               .agg(F.countDistinct("route_id").alias("distinct_routes"),
                    F.countDistinct("stop_id").alias("member_stops"),
                    F.sum("n_departures").alias("arrivals_count")))
    order = [F.col("distinct_routes").desc(), F.col("arrivals_count").desc()]
    top = _rank_top(per_hub, order + [F.col("hub_id")], top_n, "hub_rank", order)
    names = dim_stop.select(F.col("stop_id").alias("hub_id"), F.col("stop_name").alias("hub_name"))
    return top.join(names, "hub_id", "left").select(
        "hub_id", "hub_name", "distinct_routes", "member_stops", "arrivals_count", "hub_rank")


def stop_hour_histogram(pairs: DataFrame, stop_id: str | None = None) -> DataFrame:
    """Visits per (stop, service-day hour); hours 24 and 25 stay as they are.
    With ``stop_id`` only that stop (the filter reaches the stop-times scan)."""
    if stop_id is not None:
        pairs = pairs.where(F.col("stop_id") == stop_id)
    return (visits_by_service_hour(pairs)
            .groupBy("stop_id", "service_hour")
            .agg(F.sum("visits").alias("arrivals_count")))


def service_active_days(dim_service: DataFrame) -> DataFrame:
    """Active days of each service against its calendar window."""
    days = sum(F.coalesce(F.col(f).cast("long"), F.lit(0).cast("long")) for f in WEEKDAY_FLAGS)
    window = (F.datediff("service_end_date", "service_start_date") + 1).cast("long")
    return dim_service.select(
        "service_id", "service_name", days.alias("days_per_week"),
        window.alias("calendar_window_days"), "active_days_count",
        F.round(window * days / F.lit(7.0), 1).alias("expected_active_days"),
        F.round(F.col("active_days_count") / window, 4).alias("active_share_of_window"))
