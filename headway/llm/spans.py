"""Spans of pattern matches, by DataFrame functions only.

Spark's functions return a pattern's matches but not where they are.  A
text's matches and the pieces between them (the text split by the same
pattern) alternate, so a match starts where the lengths of the pieces and
matches before it end.  Lengths are in code points, so positions are too.

Matches are summed up by a window over one text's matches of one kind; no
text leaves the scan, only matches and some context around them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.tables import stored

CONTEXT = 32     # code points kept on either side of a match

#: One match: its number in the text, the code points since the match before
#: it, itself, and the text around it.
MATCH = "array<struct<gap: int, match: string, before: string, after: string>>"


@dataclass(frozen=True)
class Kind:
    """A kind of span.  ``pattern`` is a Java regular expression; ``hint`` a
    cheap SQL condition on ``text`` without which it can't match."""
    name: str
    pattern: str
    hint: str = "true"


def found(kinds: Sequence[Kind], docs: DataFrame) -> DataFrame:
    """``docs`` (row, text, ...) with an array of matches per kind in place
    of the text."""
    hold = [c for c in docs.columns if c != "text"]
    for k in kinds:
        hint = F.expr(k.hint)
        docs = docs.select(
            *docs.columns,
            F.when(hint, F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).alias("__all"),
            F.when(hint, F.split("text", k.pattern)).alias("__gaps"))
        docs = docs.select(*docs.columns, F.expr("slice(__gaps, 2, greatest(size(__gaps) - 1, 0))").alias("__next"))
        one = F.transform(F.arrays_zip("__all", "__gaps", "__next"), lambda x: F.struct(
            F.length(x["__gaps"]).alias("gap"), x["__all"].alias("match"),
            F.right(x["__gaps"], F.lit(CONTEXT)).alias("before"),
            F.left(x["__next"], F.lit(CONTEXT)).alias("after")))
        # The piece after the last match has no match of its own.
        own = F.filter(one, lambda x: x["match"].isNotNull())
        hold.append(k.name)
        docs = docs.withColumn(k.name, F.coalesce(own, F.array().cast(MATCH))).drop(
            "__all", "__gaps", "__next")
    return docs.select(*hold)


def scanned(docs: DataFrame, kinds: Sequence[Kind], text: Column, **keep: Column) -> DataFrame:
    """One stored row per document: row (a number of its own), the ``keep``
    columns and each kind's matches."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       *[c.alias(n) for n, c in keep.items()],
                       F.coalesce(text, F.lit("")).alias("text"))
    return stored(found(kinds, rows), "scan")


def matches(scan: DataFrame, kinds: Sequence[Kind], *keep: str) -> DataFrame:
    """One row per match: row, kind, order (of the kind), start, end, match,
    before, after and the ``keep`` columns."""
    each = None
    for i, k in enumerate(kinds):
        own = scan.select("row", *keep, F.lit(k.name).alias("kind"), F.lit(i).alias("order"),
                          F.posexplode(k.name).alias("i", "m")).select(
            "row", *keep, "kind", "order", "i", "m.*")
        each = own if each is None else each.unionByName(own)
    upto = (Window.partitionBy("row", "kind").orderBy("i")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ended = each.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
    return ended.select("row", *keep, "kind", "order",
                        (F.col("end") - F.length("match")).alias("start"), "end", "match",
                        "before", "after")


def joined_spans(spans: str, order: str) -> str:
    """SQL: 'kind:start:end' of an array of span structs, comma-joined, in
    the given order of struct fields."""
    return (f"array_join(transform(array_sort(transform({spans}, s -> struct({order}, s.kind AS "
            "kind, s.start AS start, s.end AS end))), s -> concat_ws(':', s.kind, s.start, "
            "s.end)), ',')")


def per_document(scan: DataFrame, spans: DataFrame, base: Sequence[str], order: str,
                 *extra: Column) -> DataFrame:
    """One row per document: id, n_<kind> of the base kinds, base_sha256,
    spans, and ``extra`` columns over ``every`` (the document's spans).
    ``spans`` has row, kind, order, start, end, base and what extra needs."""
    fields = [c for c in spans.columns if c != "row"]
    lists = spans.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("every"))
    empty = F.expr("filter(array(named_struct(%s)), s -> false)" % ", ".join(
        f"'{f.name}', CAST(NULL AS {f.dataType.simpleString()})" for f in spans.schema if
        f.name != "row"))
    rows = scan.select("row", "id").join(lists, "row", "left").select(
        "id", F.coalesce("every", empty).alias("every"))
    own = "filter(every, s -> s.base)"
    return rows.select(
        "id", *[F.expr(f"size(filter(every, s -> s.base AND s.kind = '{k}'))").cast("long")
                .alias(f"n_{k}") for k in base],
        F.expr(f"sha2({joined_spans(own, order)}, 256)").alias("base_sha256"),
        F.expr(joined_spans("every", order)).alias("spans"), *extra)


def redacted(text: str, spans: str) -> Column:
    """The column ``text`` with each span of the array column ``spans``
    (kind, start, end) replaced by its kind in brackets; spans that overlap
    the one before them are taken out with it."""
    return F.expr(
        f"aggregate(array_sort(transform({spans}, s -> struct(s.start AS start, s.end AS end, "
        "s.kind AS kind))), struct('' AS text, 0L AS at), (a, s) -> IF(s.start >= a.at, struct("
        f"concat(a.text, substring({text}, CAST(a.at + 1 AS INT), CAST(s.start - a.at AS INT)), "
        "'[', s.kind, ']') AS text, CAST(s.end AS BIGINT) AS at), struct(a.text AS text, "
        f"greatest(a.at, CAST(s.end AS BIGINT)) AS at)), a -> concat(a.text, substring({text}, "
        "CAST(a.at + 1 AS INT))))")
