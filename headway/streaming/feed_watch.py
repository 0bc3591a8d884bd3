"""Incremental pick-up of newly landed feed archives.

Feeds arrive as zip archives in a landing folder (optionally under
``snapshot_date=<date>/`` folders).  ``watch_feed_archives`` is a Structured
Streaming query over that folder: the file source remembers which archives
it has already taken (in the checkpoint), and each micro-batch extracts the
new archives' tables into the snapshot archive, one folder per snapshot date
and archive, each published in one step.  Archives of one date stand beside each other; an archive
delivered again under its own path replaces itself, tables that have become
empty or that it no longer has included.  With ``availableNow`` the query
processes what has landed and stops, which is how a scheduled ingestion run
uses it; with a processing-time trigger it keeps watching.

An archive without a ``snapshot_date`` folder is dated by its modification
time (UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.sources import files
from headway.sources.publish import added_files, data_files, start_all, switch
from headway.sources.schemas import KNOWN_TABLES
from headway.sources.zipfeed import ZipTables


def _dated(batch: DataFrame) -> DataFrame:
    if "snapshot_date" in batch.columns:
        dated = batch.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))
    else:
        dated = batch.withColumn("snapshot_date", F.date_format("modificationTime", "yyyy-MM-dd"))
    return dated.withColumn("archive", F.substring(F.sha2("path", 256), 1, 16))


def archive_batch(batch: DataFrame, archive_root: str,
                  tables: tuple[str, ...] = KNOWN_TABLES) -> None:
    """Put every table of the archives in ``batch`` into the archive."""
    spark = batch.sparkSession
    archives = _dated(batch)
    found = ZipTables(archives, tables)
    root = archive_root.rstrip("/")
    # As many rows as the batch's archives have tables.
    listed = found.manifest().join(archives.select(
        F.col("path").alias("source_path"), "snapshot_date", "archive"), "source_path").collect()
    units = {r: f"{root}/{r.table_name}/snapshot_date={r.snapshot_date}/archive={r.archive}"
             for r in listed}
    there = {f"{place}/{name}" for place in {u.rpartition("/")[0] for u in units.values()}
             for name in files.folders(spark, place)}
    known = {r: u for r, u in units.items() if u in there}
    before = dict(zip(known, files.each(lambda p: set(data_files(spark, p)), known.values())))
    for table in tables:
        (found.table(table).write.mode("append").partitionBy("snapshot_date", "archive")
         .parquet(f"{root}/{table}"))
    schemas = {t: found.table(t).drop("snapshot_date", "archive").schema for t in tables}

    def settle(unit) -> None:
        r, place = unit
        if r.status == "loaded":
            switch(spark, place, added_files(spark, place, before[r]), schemas[r.table_name],
                   r.rows)
        else:      # gone from an archive that had it before
            files.delete(spark, place)

    files.each(settle, known.items())
    for table in tables:
        start_all(spark, [(u, r.rows) for r, u in units.items() if u not in there
                          and r.table_name == table and r.status == "loaded"], schemas[table])


ARCHIVE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def watch_feed_archives(spark: SparkSession, landing: str, archive_root: str,
                        checkpoint_location: str, tables: tuple[str, ...] = KNOWN_TABLES,
                        available_now: bool = True, processing_time: str = "1 hour",
                        dated_folders: bool = True) -> StreamingQuery:
    """Start the streaming ingestion of ``landing`` into ``archive_root``.
    ``dated_folders``: archives sit under ``snapshot_date=<date>/`` folders."""
    schema = ARCHIVE_SCHEMA + (", snapshot_date string" if dated_folders else "")
    stream = (spark.readStream.format("binaryFile").schema(schema)
              .option("pathGlobFilter", "*.zip")
              .load(landing))
    if files.in_tasks(spark, landing):    # tasks open the archives themselves
        stream = stream.drop("content")
    writer = (stream.writeStream
              .foreachBatch(lambda df, _epoch: archive_batch(df, archive_root, tables))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    return writer.start()
