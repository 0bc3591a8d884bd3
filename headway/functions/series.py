"""Arithmetic on headway windows.

A frequency window (start, end, headway) stands for the departures
``start, start + headway, ...`` strictly before ``end``.  ``departure_series``
materializes them; the other helpers answer counting questions about the
same series in closed form, so marts that only need counts never have to
explode one row per departure.

The helpers take SQL expressions (column names or expression text) and
return SQL text, wrapped into a Column by the ``*_col`` functions; one
expression is then one call into the JVM, however large it is.  All inputs
are BIGINT seconds.  ``div`` truncates toward zero; values are far below
2**53 so the double divisions inside CEIL/FLOOR are exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _p(x: str | int) -> str:
    return f"({x})"


def valid_up(start: str, end: str, headway: str) -> str:
    return f"({_p(headway)} > 0 AND {_p(end)} - 1 >= {_p(start)})"


def valid_down(start: str, end: str, headway: str) -> str:
    return f"({_p(headway)} < 0 AND {_p(end)} - 1 <= {_p(start)})"


def departure_series(start: str, end: str, headway: str) -> str:
    """Array of departures in ``[start, end)`` stepping by ``headway``, or NULL.

    The end is exclusive.  A headway at least as long as the window gives one
    departure.  End <= start, a zero headway and NULL bounds give nothing (the
    guard sits inside the expression, because ``sequence`` raises on an empty
    or zero-step range).  A negative headway counts down from ``start`` to
    ``end - 1``, as a generated array with a negative step does."""
    return (f"CASE WHEN {valid_up(start, end, headway)} OR {valid_down(start, end, headway)} "
            f"THEN sequence({_p(start)}, {_p(end)} - 1, {_p(headway)}) END")


def departure_count(start: str, end: str, headway: str) -> str:
    """Number of elements of ``departure_series`` (0 when it is NULL)."""
    s, e, h = _p(start), _p(end), _p(headway)
    return (f"CAST(CASE WHEN {valid_up(start, end, headway)} THEN ({e} - 1 - {s}) div {h} + 1 "
            f"WHEN {valid_down(start, end, headway)} THEN ({s} - ({e} - 1)) div (-{h}) + 1 "
            f"ELSE 0 END AS BIGINT)")


def count_in_range(first: str, step: str, count: str, low: str | int,
                   high: str | int | None) -> str:
    """How many of ``first + k*step`` (k = 0..count-1, step > 0) lie in
    ``[low, high]``; ``high=None`` means unbounded above."""
    f, st, n = _p(first), _p(step), _p(count)
    k_low = f"greatest(CAST(0 AS BIGINT), CAST(ceil(({_p(low)} - {f}) / {st}) AS BIGINT))"
    if high is None:
        k_high = f"{n} - 1"
    else:
        k_high = f"least({n} - 1, CAST(floor(({_p(high)} - {f}) / {st}) AS BIGINT))"
    return f"greatest(CAST(0 AS BIGINT), {k_high} - {k_low} + 1)"


def hour_buckets(first: str, step: str, count: str) -> str:
    """Array of (bucket, n): how many series values fall in each service
    hour ``value div 3600``.  Emits min(count, hours spanned) entries, so a
    24h window at a 10-minute headway yields 24 entries, not 144, and a
    once-daily window yields one.  (Truncating division: bucket 0 holds
    -3599..3599.)"""
    f, st, n = _p(first), _p(step), _p(count)
    last = f"({f} + ({n} - 1) * {st})"
    b_low, b_high = f"({f} div 3600)", f"({last} div 3600)"
    low = "CASE WHEN b > 0 THEN b * 3600 ELSE b * 3600 - 3599 END"
    high = "CASE WHEN b < 0 THEN b * 3600 ELSE b * 3600 + 3599 END"
    per_departure = (f"transform(sequence(CAST(0 AS BIGINT), {n} - 1), "
                     f"k -> named_struct('bucket', ({f} + k * {st}) div 3600, 'n', CAST(1 AS BIGINT)))")
    per_bucket = (f"filter(transform(sequence({b_low}, {b_high}), b -> named_struct('bucket', b, 'n', "
                  f"{count_in_range(first, step, count, low, high)})), s -> s.n > 0)")
    return (f"CASE WHEN {n} <= 0 THEN CAST(array() AS ARRAY<STRUCT<bucket: BIGINT, n: BIGINT>>) "
            f"WHEN {n} <= {b_high} - {b_low} + 1 THEN {per_departure} ELSE {per_bucket} END")


def hours_spanned(first: str, step: str, count: str) -> str:
    """How many hour boundaries the series crosses."""
    f = _p(first)
    return f"(({f} + ({_p(count)} - 1) * {_p(step)}) div 3600 - {f} div 3600)"


def hour_numbers(count: str, span: str) -> str:
    """``hour_buckets`` as an array of numbers alone; ``hour_of_number`` says
    what one stands for.  It is plain arithmetic, which Spark compiles."""
    return (f"CASE WHEN {_p(count)} > 0 THEN "
            f"sequence(CAST(0 AS BIGINT), least({_p(count)} - 1, {_p(span)})) END")


def hour_of_number(first: str, step: str, count: str, span: str, number: str) -> tuple[str, str]:
    """The bucket of a ``number`` and its n, which may be 0; all are columns."""
    few = f"{count} <= {span} + 1"          # no more values than hours
    b = f"({first} div 3600 + {number})"
    low = f"(CASE WHEN {b} > 0 THEN {b} * 3600 ELSE {b} * 3600 - 3599 END)"
    high = f"(CASE WHEN {b} < 0 THEN {b} * 3600 ELSE {b} * 3600 + 3599 END)"
    return (f"CASE WHEN {few} THEN ({first} + {number} * {step}) div 3600 ELSE {b} END",
            f"CASE WHEN {few} THEN CAST(1 AS BIGINT) ELSE "
            f"{count_in_range(first, step, count, low, high)} END")


def col(sql: str) -> Column:
    """Column for a SQL expression produced by this module."""
    return F.expr(sql)
