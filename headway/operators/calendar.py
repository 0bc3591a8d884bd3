"""Date spine, date dimension and the unrolled service calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.labels import WEEKDAY_FLAGS
from headway.session import stored_table

# The spine covers these days, both ends included.
SPINE_START = dt.date(2020, 1, 1)
SPINE_END = dt.date(2030, 12, 31)


def date_spine(spark: SparkSession, start: dt.date = SPINE_START,
               end: dt.date = SPINE_END) -> DataFrame:
    """One row per day from ``start`` to ``end`` (4,018 rows by default)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_id"))


def dim_date(spark: SparkSession, start: dt.date = SPINE_START,
             end: dt.date = SPINE_END) -> DataFrame:
    """Date dimension; day_of_week is 1 = Sunday ... 7 = Saturday."""
    d = F.col("date_id")
    return date_spine(spark, start, end).select(
        d,
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"),
        F.dayofmonth(d).cast("long").alias("day_of_month"),
        F.dayofweek(d).cast("long").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.weekofyear(d).cast("long").alias("iso_week_number"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def _runs_on(day: str) -> F.Column:
    """The weekday flag that governs ``day`` (dayofweek 1 = Sunday)."""
    flags = ["runs_sunday", "runs_monday", "runs_tuesday", "runs_wednesday", "runs_thursday",
             "runs_friday", "runs_saturday"]
    whens = " ".join(f"WHEN {n} THEN {flag}" for n, flag in enumerate(flags, start=1))
    return F.expr(f"CASE dayofweek({day}) {whens} END")


def base_service_dates(calendar: DataFrame, start: dt.date = SPINE_START,
                       end: dt.date = SPINE_END) -> DataFrame:
    """(service_id, service_date) for every spine day inside each service's
    window whose weekday flag is set.

    This is the range join ``date BETWEEN start AND end`` written without a
    join: each window is clipped to the spine and exploded, so there is no
    nested-loop join and the work is proportional to the output."""
    lo = f"greatest(service_start_date, DATE'{start.isoformat()}')"
    hi = f"least(service_end_date, DATE'{end.isoformat()}')"
    ok = f"service_start_date IS NOT NULL AND service_end_date IS NOT NULL AND {lo} <= {hi}"
    days = calendar.selectExpr("service_id", *WEEKDAY_FLAGS,
                               f"explode(CASE WHEN {ok} THEN sequence({lo}, {hi}) END) AS service_date")
    return days.where(_runs_on("service_date")).select("service_id", "service_date")


def service_calendar(calendar: DataFrame, calendar_dates: DataFrame,
                     start: dt.date = SPINE_START, end: dt.date = SPINE_END) -> DataFrame:
    """Active (service_id, service_date) pairs: the weekly pattern inside the
    spine, minus removed dates, plus added dates (removals first, so a date
    both removed and added is active).  Added dates are not clipped to the
    spine.  Output is distinct.

    The set difference and the union are one aggregation: every candidate
    pair carries flags (in the weekly pattern / removed / added) and a pair
    is kept when it was added, or is in the pattern and was not removed.
    That is one shuffle instead of three, and NULLs group together just as
    they compare equal in set operations."""
    base = base_service_dates(calendar, start, end).selectExpr(
        "service_id", "service_date", "true AS in_pattern", "false AS removed", "false AS added")
    exceptions = calendar_dates.where("exception_type_code IN (1, 2)").selectExpr(
        "service_id", "exception_date AS service_date", "false AS in_pattern",
        "exception_type_code = 2 AS removed", "exception_type_code = 1 AS added")
    flags = base.unionByName(exceptions).groupBy("service_id", "service_date").agg(
        F.expr("max(in_pattern) AS in_pattern"), F.expr("max(removed) AS removed"),
        F.expr("max(added) AS added"))
    return flags.where("added OR (in_pattern AND NOT removed)").select("service_id", "service_date")


def date_classes(service_dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Services by their sets of active dates: (service_id, date_class) and
    (date_class, service_date).  Feeds name many services that run on the
    same dates; what is counted for them can be summed before dates are
    joined.  A service has at most as many dates as the spine and its
    exceptions, so a set of them is small."""
    sets = service_dates.groupBy("service_id").agg(
        F.array_sort(F.collect_set(F.struct("service_date"))).alias("dates"))
    sets = stored_table(sets.withColumn("date_class", F.sha2(F.to_json("dates"), 256)),
                        "date_classes")
    dates = sets.groupBy("date_class").agg(F.first("dates").alias("dates"))
    return (sets.select("service_id", "date_class"),
            dates.select("date_class", F.explode("dates").alias("d"))
            .select("date_class", "d.service_date"))
