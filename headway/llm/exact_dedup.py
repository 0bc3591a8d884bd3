"""Exact duplicates by progressive refinement.

Rows are grouped by text length, then by a hash of a prefix, and only texts
whose (length, prefix) is not alone are hashed in full.

Which (length, prefix) pairs collide is kept in a bitmap that is sized by
their number, up to 64 MB, and broadcast, so texts that are alone are told
apart in the scan, without moving any text.  A pair that is taken for another
only costs a full hash that was not needed (one in 16 up to 33 million
colliding pairs, a third at 200 million); the groups themselves are formed on
(length, prefix hash, SHA-256), so the result is exact at any size.

Defined results: a null text counts as empty.  Empty texts are equal to each
other.  Texts of any length count whole.  Rows with a null id take part; the largest non-null id stays, and
where a group has only null ids one of its rows stays.  Rows repeated as a
whole (same id, same text) count as copies: one of them stays.  An empty
table gives an empty result.  Other columns, whatever their names, pass
through ``drop_copies`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import KeyFilter, flagged, free_name, key_filter, stored

PREFIX_CHARS = 256


def _length(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def _pair(text: Column) -> Column:
    """Hash of a text's length and prefix."""
    return F.xxhash64(_length(text), F.substring(text, 1, PREFIX_CHARS))


def colliding_pairs(docs: DataFrame, text_col: str = "text") -> KeyFilter:
    """The (length, prefix) pairs that at least two rows have.

    Refined in two steps: lengths that occur once are settled first, then
    the (length, prefix) pairs of the others are counted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(_length(text).alias("len"), _pair(text).alias("key"))
    # One partially aggregated pass gives both levels: a pair's rows by
    # length, then the lengths that occur more than once.
    pairs = keys.groupBy("len", "key").agg(F.count(F.lit(1)).alias("n"))
    many = pairs.groupBy("len").agg(F.sum("n").alias("rows")).where("rows > 1").select("len")
    return key_filter(stored(pairs.join(many, "len", "left_semi").where("n > 1").select("key"),
                             "pairs"))


def survivors(docs: DataFrame, text_col: str, flag: str) -> DataFrame:
    """``docs`` plus the boolean ``flag``: must the text be read in full?"""
    return flagged(docs, _pair(F.coalesce(F.col(text_col), F.lit(""))),
                   colliding_pairs(docs, text_col), flag)


def _full_key(text_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [_length(text).alias("__len"), _pair(text).alias("__pre"),
            F.sha2(text, 256).alias("__sha")]


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: the id, keep_id (id of the row that stays in
    its group of equal texts), group_size and kept, plus the ``carry``
    columns, which must depend on the text alone."""
    carry = carry or {}
    names = list(carry)
    wanted = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                         *[c.alias(n) for n, c in carry.items()])
    marked = survivors(wanted, "__text", "__read")
    alone = marked.where(~F.col("__read")).select(
        F.col("__id").alias(id_col), F.col("__id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *names)
    key = ["__len", "__pre", "__sha"]
    read = stored(marked.where("__read").select("__id", *_full_key("__text"), *names), "read")
    # Groups are summed per task first and stored, so that the join below
    # has a plain shuffle on both sides and a large group can be split.
    groups = stored(read.groupBy(*key).agg(F.max("__id").alias("keep_id"),
                                           F.count(F.lit(1)).alias("group_size")), "groups")
    counted = read.groupBy(*key, "__id").agg(F.count(F.lit(1)).alias("__n"),
                                             *[F.first(n).alias(n) for n in names])
    rows = counted.join(groups, key)
    each = rows.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
    kept = F.col("__id").eqNullSafe(F.col("keep_id")) & (F.col("__i") == 1)
    return alone.unionByName(each.select(F.col("__id").alias(id_col), "keep_id", "group_size",
                                         kept.alias("kept"), *names))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    Rows whose text is alone pass straight from the scan; only the others
    are dealt by their full hash.  Among rows of one text that share the
    largest id, the smallest by the remaining columns stays."""
    flag = free_name(docs, "__read")
    marked = survivors(docs, text_col, flag)
    alone = marked.where(~F.col(flag)).drop(flag)
    read = marked.where(F.col(flag)).drop(flag)
    names = {n: free_name(docs, n) for n in ("__len", "__pre", "__sha", "__keep")}
    keyed = read.select("*", *[c.alias(names[n]) for n, c in
                               zip(("__len", "__pre", "__sha"), _full_key(text_col))])
    key = [names["__len"], names["__pre"], names["__sha"]]
    rest = [c for c in docs.columns if c != id_col and c != text_col]
    best = stored(keyed.select(*key, F.col(id_col).alias(names["__keep"])).groupBy(*key).agg(
        F.max(names["__keep"]).alias(names["__keep"])), "groups")
    held = keyed.join(best, key).where(F.col(id_col).eqNullSafe(F.col(names["__keep"])))
    # Equal text and id: keep one, chosen by the remaining columns.
    if rest:
        order = F.struct(*[_orderable(docs, c) for c in rest])
        row = F.struct(*[F.col(c) for c in rest])
        one = held.groupBy(*key, id_col).agg(F.min_by(row, order).alias("__row"),
                                             F.first(text_col).alias("__text"))
        out = one.select(*[F.col("__text").alias(c) if c == text_col else F.col(c) if c == id_col
                           else F.col("__row").getField(c).alias(c) for c in docs.columns])
    else:
        out = held.groupBy(*key, id_col).agg(F.first(text_col).alias("__text")).select(
            *[F.col("__text").alias(c) if c == text_col else F.col(c) for c in docs.columns])
    return alone.unionByName(out)


def _orderable(df: DataFrame, col: str) -> Column:
    """A column to order rows by; maps and the like by their text form."""
    kind = df.schema[col].dataType.typeName()
    simple = {"string", "long", "integer", "short", "byte", "double", "float", "boolean",
              "date", "timestamp", "decimal", "binary"}
    return F.col(col) if kind in simple else F.to_json(F.struct(F.col(col)))
