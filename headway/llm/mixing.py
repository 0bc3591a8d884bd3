"""Mixing sources to target weights by systematic sampling.

Sources get a target number of words from their weights; targets stop at
``cap`` times the source's size and the excess is shared again by weight.
Each document of a source is expected target / source size times.  Within a
source, documents are put in order of size, their expected copies are
prefix-summed, one random offset is added, and a document is emitted once
for each integer the sum crosses.  Ordering by size makes the sample follow
the spread of sizes, so a source's words come within about one document of
its target.

All sums are of integers (expected copies in units of 2**-24), so the
result doesn't depend on how rows are dealt, and reruns agree.  Prefix sums
are taken over blocks (``tables.prefix_sums``), so one source may hold any
share of all rows.

Defined results: a null text has size 0.  A null source is a source of its
own, last in order.  Documents of size 0 are copied like the others and add
no words.  A source of size 0 has target 0 and its documents are not taken.
Repeated rows are documents of their own; of documents of one size the lesser
id comes first.  Texts of any length are counted whole.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.tables import WORD, free_name, prefix_sums, stored

UNIT = 1 << 24


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float,
                   cap: float) -> DataFrame:
    """(source, source_size, target): weights are dealt to sources in order
    of code points, null last, repeating.

    The list of sources is ordered by the same block-wise prefix sums as the
    documents.  Resharing ends when no target is above its cap; each round
    caps at least one further source, and needs one row of totals."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = prefix_sums(sources.select("*", F.col("source").isNull().alias("last"),
                                        F.lit(1).cast("long").alias("one"),
                                        F.lit(0).alias("all")),
                         ["all"], ["last", "source"], "one", "rank")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    weighed = stored(ranked.select(
        "source", "source_size", (F.col("source_size") * F.lit(float(cap))).alias("most"),
        F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
        .cast("long").alias("weight")), "sources")
    total = float(share) * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    # Each source gets its weight's part of what is left; sources above their
    # cap keep the cap and the rest is reshared, until no further one is.
    part, capped = None, -1
    while True:
        over = F.lit(False) if part is None else F.col("most") <= part
        n, held, weight = weighed.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if n == capped or not weight:
            break
        capped = n
        part = F.lit(float(total - held)) * F.col("weight") / F.lit(float(weight))
    if part is None:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    return weighed.select("source", "source_size",
                          F.least(F.col("most"), part).alias("target"))


def copies(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
           cap: int = 2, seed: int = 0) -> DataFrame:
    """Rows (id, source, size) plus source_size, target and copies."""
    targets = stored(source_targets(sizes, weights, share, cap), "targets")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"),
                                               F.coalesce(F.col("source"), F.lit("")))), 1, 6),
                    16, 10).cast("long")
    rate = targets.select("*", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") / F.col("source_size") * F.lit(float(UNIT)))).otherwise(F.lit(0))
        .cast("long").alias("expected"), offset.alias("offset"))
    dealt = sizes.join(rate, sizes["source"].eqNullSafe(rate["source"])).select(
        sizes["id"], sizes["source"], sizes["size"], "source_size", "target", "expected",
        "offset")
    # One random offset per source; the sums start at it.
    run = prefix_sums(dealt, ["source"], ["size", "id"], "expected", "reached")
    upto = F.expr(f"(reached + offset) DIV {UNIT}")
    before = F.expr(f"(reached - expected + offset) DIV {UNIT}")
    return run.select("id", "source", "size", "source_size", "target",
                      (upto - before).cast("long").alias("copies"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                              word_count(F.col(text_col)).alias("size")), "sizes")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", **params) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words the
    mix takes, repeats counted), copies."""
    run = copies(sized(docs, id_col, text_col, source_col), **params)
    return run.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", **params) -> DataFrame:
    """The mixed rows: each document as often as the mix takes it, with its
    own columns.

    Documents are matched to their copies by (id, source, size).  Rows that
    agree in all three are numbered one by one, again in blocks, so that
    each gets its own number of copies."""
    plan = copies(sized(docs, id_col, text_col, source_col), **params)
    key = ["__id", "__source", "__size"]
    names = {k: free_name(docs, k) for k in (*key, "__n", "__each", "__at", "__row", "__one")}
    matched = plan.groupBy(F.col("id").alias(names["__id"]),
                           F.col("source").alias(names["__source"]),
                           F.col("size").alias(names["__size"])).agg(
        F.count(F.lit(1)).alias(names["__n"]), F.sum("copies").alias(names["__each"]))
    # One row per document: a table without a bound is never broadcast.
    matched = stored(matched, "copies").hint("merge")
    keyed = docs.select("*", word_count(F.col(text_col)).alias("__words"))
    on = (keyed[id_col].eqNullSafe(matched[names["__id"]])
          & keyed[source_col].eqNullSafe(matched[names["__source"]])
          & (keyed["__words"] == matched[names["__size"]]))

    def emit(df: DataFrame, times: str) -> DataFrame:
        again = df.where(F.col(times) > 0).withColumn(
            names["__at"], F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
        return again.select(*docs.columns)

    single = emit(keyed.join(matched.where(F.col(names["__n"]) == 1), on), names["__each"])
    if not matched.where(F.col(names["__n"]) > 1).take(1):
        return single
    # Equal keys: the group's copies are dealt evenly, the first rows by
    # number getting the odd ones.
    ties = stored(keyed.join(matched.where(F.col(names["__n"]) > 1), on)
                  .withColumn(names["__row"], F.monotonically_increasing_id())
                  .withColumn(names["__one"], F.lit(1).cast("long")), "ties")
    tied_key = [names[k] for k in key]
    ranks = prefix_sums(ties.select(*tied_key, names["__n"], names["__each"], names["__row"],
                                    names["__one"]),
                        tied_key, [names["__row"]], names["__one"], names["__at"])
    total, n, at = names["__each"], names["__n"], names["__at"]
    own = ranks.select(names["__row"], F.expr(
        f"`{total}` DIV `{n}` + CAST(`{at}` <= `{total}` % `{n}` AS BIGINT)").alias("__times"))
    repeated = emit(ties.join(own, names["__row"]).withColumn(
        at, F.lit(0)), "__times")
    return single.unionByName(repeated)
