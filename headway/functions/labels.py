"""Code decoders and derived labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# GTFS code -> label tables used by the staging models and
# dimensions.  Anything not listed decodes to 'unknown'.
ROUTE_TYPE_NAMES = {
    0: "tram", 1: "subway", 2: "rail", 3: "bus", 4: "ferry", 5: "cable_tram",
    6: "aerial_lift", 7: "funicular", 11: "trolleybus", 12: "monorail",
}
LOCATION_TYPE_NAMES = {
    0: "stop_or_platform", 1: "station", 2: "entrance_or_exit",
    3: "generic_node", 4: "boarding_area",
}
WHEELCHAIR_BOARDING_NAMES = {0: "unknown", 1: "accessible", 2: "not_accessible"}
EXCEPTION_TYPE_NAMES = {1: "added", 2: "removed"}
UNKNOWN = "unknown"
UNKNOWN_CATEGORY = "Unknown"

# Service-name shapes, checked in this order, by which weekday
# flags are set (Mon..Sun); the first match wins, otherwise 'Custom'.  The
# Mon–Sat label holds an en dash.
SERVICE_NAME_PATTERNS = [
    ("Daily", (True, True, True, True, True, True, True)),
    ("Weekday", (True, True, True, True, True, False, False)),
    ("Weekend", (False, False, False, False, False, True, True)),
    ("Mon–Sat", (True, True, True, True, True, True, False)),
    ("Sunday only", (False, False, False, False, False, False, True)),
    ("Friday only", (False, False, False, False, True, False, False)),
]
SERVICE_NAME_FALLBACK = "Custom"
WEEKDAY_FLAGS = ["runs_monday", "runs_tuesday", "runs_wednesday", "runs_thursday",
                 "runs_friday", "runs_saturday", "runs_sunday"]


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def decode_sql(code: str, table: dict, default: str = UNKNOWN) -> str:
    """SQL text: CASE code WHEN k THEN v ... ELSE default END (NULL -> default)."""
    whens = " ".join(f"WHEN {k} THEN {_sql_str(v)}" for k, v in table.items())
    return f"CASE {code} {whens} ELSE {_sql_str(default)} END"


def decode(code: Column | str, table: dict, default: str = UNKNOWN) -> Column:
    """Column version of ``decode_sql``; ``code`` is a column name or Column."""
    if isinstance(code, str):
        return F.expr(decode_sql(f"`{code}`", table, default))
    expr = None
    for key, label in table.items():
        expr = (F.when(code == F.lit(key), F.lit(label)) if expr is None
                else expr.when(code == F.lit(key), F.lit(label)))
    return expr.otherwise(F.lit(default))


def service_category(route_description: Column | str) -> Column:
    """Empty or NULL route description -> 'Unknown'."""
    if isinstance(route_description, str):
        return F.expr(f"coalesce(nullif(`{route_description}`, ''), {_sql_str(UNKNOWN_CATEGORY)})")
    return F.coalesce(F.nullif(route_description, F.lit("")), F.lit(UNKNOWN_CATEGORY))


def service_name_sql(service_id: str = "service_id") -> str:
    """SQL text: '<shape> (<service_id>)' from the seven weekday flags.

    A NULL flag never satisfies a shape (three-valued logic), so it falls
    through to 'Custom'."""
    whens = []
    for label, pattern in SERVICE_NAME_PATTERNS:
        cond = " AND ".join(flag if wanted else f"NOT {flag}"
                            for flag, wanted in zip(WEEKDAY_FLAGS, pattern))
        whens.append(f"WHEN {cond} THEN concat({_sql_str(label + ' (')}, {service_id}, ')')")
    fallback = f"concat({_sql_str(SERVICE_NAME_FALLBACK + ' (')}, {service_id}, ')')"
    return f"CASE {' '.join(whens)} ELSE {fallback} END"
