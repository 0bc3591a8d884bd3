"""Column-level helpers; all are native Spark expressions (no Python UDFs).

Helpers whose name ends in ``_sql`` (and everything in ``series``) return
SQL expression text, so a large expression costs one call into the JVM.
"""

from headway.functions.keys import surrogate_key
from headway.functions.labels import decode, decode_sql, service_category, service_name_sql
from headway.functions.series import (col, count_in_range, departure_count, departure_series,
                                      hour_buckets)
from headway.functions.times import clock_date, gtfs_time_to_seconds

__all__ = [
    "surrogate_key", "decode", "decode_sql", "service_category", "service_name_sql", "col",
    "count_in_range", "departure_count", "departure_series", "hour_buckets", "clock_date",
    "gtfs_time_to_seconds",
]
