"""Helpers shared by the operators: reading tables, stored tables, prefix sums."""

from __future__ import annotations

import os
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.session import ensure_checkpoint_dir

#: Characters that separate words: space, tab, newline, VT, FF, CR.  Python's
#: ``bytes.split()`` without arguments splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a batch that goes to a Python worker.
BATCH_ROWS = 500

#: A bitmap that tells rows apart in a scan has FILTER_SHARE bits for each key
#: in it, so one key in FILTER_SHARE is taken for another; at most MOST_BITS
#: (64 MB, which are broadcast), which is enough for 33 million keys.  Beyond
#: that more keys are mistaken: a third at 200 million.
FILTER_SHARE = 16
MOST_BITS = 1 << 29

#: Rows per block of a distributed prefix sum.
BLOCK_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, by a path that only Spark has to be able to open."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make ready for Python workers.

    Texts are long and may be very long, so Arrow batches hold at most
    ``BATCH_ROWS`` rows (Spark's own bound on their bytes holds besides).
    Workers of a local session can import this package whatever the working
    folder is; on a cluster it is installed or sent with ``--py-files``."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of its own in the shared checkpoint folder
    and read back: lineage is cut, and a lost executor costs no recompute.
    Values that depend on how rows are dealt (row numbers, partition ids)
    are fixed from here on."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder of its own in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}/{name}"


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that
    name (Spark resolves column names without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class KeyFilter(NamedTuple):
    """A set of hashed keys, never too small: (piece, bits) rows of 4 KB."""
    bits: DataFrame
    size: int


def key_filter(keys: DataFrame) -> KeyFilter:
    """The filter of the column ``key`` (long) of a stored table."""
    size = 1 << 15
    while size < min(FILTER_SHARE * keys.count(), MOST_BITS):
        size *= 2
    bucket = keys.select(F.pmod("key", F.lit(size)).alias("bucket"))
    return KeyFilter(
        bucket.groupBy(F.expr("bitmap_bucket_number(bucket)").alias("piece"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bucket))").alias("bits")), size)


def flagged(df: DataFrame, key: Column, among: KeyFilter, flag: str) -> DataFrame:
    """``df`` plus the boolean ``flag``: may its key be among those of the
    filter?  The filter is broadcast, so no row of ``df`` moves."""
    piece, held, at = (free_name(df, c) for c in ("__piece", "__bits", "__bucket"))
    marked = df.withColumn(at, F.pmod(key, F.lit(among.size)))
    joined = marked.join(F.broadcast(among.bits.select(F.col("piece").alias(piece),  # MOST_BITS
                                                       F.col("bits").alias(held))),
                         F.expr(f"bitmap_bucket_number({at})") == F.col(piece), "left")
    byte = (f"CAST(conv(hex(substring({held}, CAST(bitmap_bit_position({at}) DIV 8 AS INT) + 1,"
            " 1)), 16, 10) AS INT)")
    one = F.expr(f"(shiftright({byte}, CAST(bitmap_bit_position({at}) % 8 AS INT)) & 1) = 1")
    return (joined.withColumn(flag, F.coalesce(one, F.lit(False)))
            .select(*[joined[c] for c in df.columns], flag))


def prefix_sums(rows: DataFrame, group: list[str], order: list[str], value: str,
                out: str = "prefix") -> DataFrame:
    """``rows`` plus ``out``: the sum of ``value`` over this row and the rows
    before it in its group, in the given order.

    A group may hold any share of all rows: rows are dealt by range of
    (group, order) into blocks of about ``BLOCK_ROWS`` rows, summed within
    each block, and shifted by the sums of the group's earlier blocks, of
    which there are at most the number of blocks plus the number of groups.
    ``order`` must put the rows of a group in a total order, up to rows
    whose values don't differ."""
    spark = rows.sparkSession
    n = max(shuffle_partitions(spark), -(-rows.count() // BLOCK_ROWS))
    dealt = stored(rows.repartitionByRange(n, *group, *order)
                   .withColumn("__block", F.spark_partition_id()), "blocks")
    before = (Window.partitionBy(*group).orderBy("__block")
              .rowsBetween(Window.unboundedPreceding, -1))
    blocks = (dealt.groupBy(*group, "__block").agg(F.sum(value).alias("__sum"))
              .select(*group, "__block",
                      F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before")))
    within = (Window.partitionBy(*group, "__block").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    summed = dealt.withColumn("__within", F.sum(value).over(within))
    on = [summed[c].eqNullSafe(blocks[c]) for c in (*group, "__block")]
    return (summed.join(blocks, on, "left")
            .select(*[summed[c] for c in rows.columns],
                    (F.col("__within") + F.col("__before")).alias(out)))
