"""Raw-table sinks: truncate-and-load tables and the snapshot archive.

* ``load_tables``: replace each raw table under ``target/<table>`` (the raw
  layer always mirrors the latest feed) and read it back.
* ``archive_source``: keep a feed's source files as they came, under
  ``root/_source/snapshot_date=<date>/``.
* ``archive_snapshot``: one folder per table and snapshot,
  ``root/<table>/snapshot_date=<date>``.  Writing a snapshot again replaces
  it, also when the table has become empty.
* ``replay_snapshot``: the raw tables as of one snapshot date, from that
  snapshot's folders alone, with the columns it had.

Tables and snapshots are published (see ``sources.publish``): readers see a
whole state, the old or the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources import files
from headway.sources.publish import Manifest, publish, read_manifests, read_together
from headway.sources.schemas import DECLARED_COLUMNS, conform, raw_schema


def write_table(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Truncate-and-load: replace whatever is at ``path``.  With
    ``partitions``, the rows are spread evenly over that many files first, so
    later scans (and the per-row time parsing in staging) run in that many
    tasks even when the source came as one unsplittable file."""
    if partitions:
        df = df.repartition(partitions)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def load_tables(spark: SparkSession, tables: dict[str, DataFrame], target: str) -> dict[str, DataFrame]:
    """Replace each table under ``target/<name>`` and read it back."""
    return {name: publish(df, f"{target.rstrip('/')}/{name}") for name, df in tables.items()}


def _place(root: str, table: str, snapshot_date: str) -> str:
    return f"{root.rstrip('/')}/{table}/snapshot_date={snapshot_date}"


def archive_source(spark: SparkSession, path: str, root: str, snapshot_date: str) -> list[str]:
    """Keep the file(s) at ``path`` unparsed under the snapshot's date."""
    return files.copy_into(spark, path, _place(root, "_source", snapshot_date))


def archive_snapshot(tables: dict[str, DataFrame], root: str, snapshot_date: str) -> None:
    """Add (or replace) one snapshot of every table under ``root``."""
    for name, df in tables.items():
        publish(df.drop("snapshot_date"), _place(root, name, snapshot_date))


def _units(spark: SparkSession, place: str) -> dict[str, Manifest]:
    """What is published of a snapshot, by folder: the whole, or one part
    per archive of that date."""
    inner = [f"{place}/{n}" for n in files.folders(spark, place) if n.startswith("archive=")]
    places = [place, *inner]
    return read_manifests(spark, places)


def replay_snapshot(spark: SparkSession, root: str, tables: list[str],
                    snapshot_date: str) -> dict[str, DataFrame]:
    """Raw tables as they were archived on ``snapshot_date``; a snapshot that
    a table lacks is an error."""
    out = {}
    for name in tables:
        units = _units(spark, _place(root, name, snapshot_date))
        if not units:
            raise FileNotFoundError(f"{name} has no snapshot of {snapshot_date} in {root}")
        df = read_together(spark, units)
        out[name] = conform(df, name) if name in DECLARED_COLUMNS else df
    return out


def replay_all(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Every snapshot of one table, with ``snapshot_date``; columns that only
    some snapshots have are NULL in the others."""
    path = f"{root.rstrip('/')}/{table}"
    listed = [f"{place}/{name}" for units in _snapshots(spark, path).values()
              for place, m in units.items() for name in m.files]
    if not listed:
        return spark.createDataFrame([], raw_schema(table, ("snapshot_date",)))
    df = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*listed)
    return conform(df.withColumn("snapshot_date", F.col("snapshot_date").cast("string")),
                   table, keep=tuple(c for c in ("archive", "snapshot_date") if c in df.columns))


def _snapshots(spark: SparkSession, path: str) -> dict[str, dict[str, Manifest]]:
    """What is published of each snapshot of a table, by date."""
    found = {n.partition("=")[2]: _units(spark, f"{path}/{n}")
             for n in files.folders(spark, path) if n.startswith("snapshot_date=")}
    return {date: units for date, units in found.items() if units}


def snapshot_dates(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(snapshot_date): the archived snapshots of a table, empty ones too."""
    names = _snapshots(spark, f"{root.rstrip('/')}/{table}")
    return spark.createDataFrame([(n,) for n in names], "snapshot_date string")


def latest_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One row: the most recent snapshot date of ``table`` (for freshness)."""
    return snapshot_dates(spark, root, table).agg(
        F.max("snapshot_date").alias("latest_snapshot_date"))
