"""Feed readers: folders of CSV text files, one or many snapshots.

A feed table is a ``<table>.txt`` CSV file with a header row.  Quoted fields
may hold commas, doubled quotes and newlines, whatever the table and the
file's size.  Every column is read as
STRING and matched by header *name*.  Files are read together only if their
headers are the same; files with other columns, or the same ones in another
order, are read apart and united by name.  A known table that is absent
yields an empty DataFrame with the declared columns and is reported as
skipped.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources import files, records
from headway.sources.schemas import KNOWN_TABLES, conform, empty_table, raw_schema

def csv_reader(spark: SparkSession):
    """Spark's CSV reader for files whose records are single lines."""
    reader = (spark.read.option("header", True).option("inferSchema", False)
              .option("encoding", "UTF-8"))
    for name, value in records.OPTIONS.items():
        reader = reader.option(name, value)
    return reader


def read_feed_table(spark: SparkSession, path: str, table: str,
                    base_path: str | None = None) -> DataFrame:
    """One table from the CSV file(s) at ``path`` (a file, folder or glob).
    With ``base_path``, a ``snapshot_date=<date>`` folder below it becomes a
    column after the table's own.

    Large files are read by many tasks, also those with newlines in quotes
    (see ``sources.records``)."""
    return read_feed_tables(spark, {table: path}, base_path)[table]


def read_feed_tables(spark: SparkSession, paths: dict[str, str],
                     base_path: str | None = None) -> dict[str, DataFrame]:
    """Tables by name, each from its file(s); one job looks at all of them."""
    found = {t: [f.path for f in files.list_files(spark, p)] for t, p in paths.items()}
    by_name = {unquote(p): p for ps in found.values() for p in ps}
    seen = {by_name[unquote(s.path)]: s for s in records.scan(spark, list(by_name.values()))}
    return {t: _table(spark, t, [seen[p]._replace(path=p) for p in ps if p in seen], base_path)
            for t, ps in found.items()}


def _table(spark: SparkSession, table: str, found: list[records.Scanned],
           base_path: str | None) -> DataFrame:
    parts: list[DataFrame] = []
    for names in sorted({s.names for s in found if s.one_line and any(s.names)}):
        reader = csv_reader(spark)
        if base_path:
            reader = reader.option("basePath", base_path)
        parts.append(reader.csv([s.path for s in found if s.one_line and s.names == names]))
    rest = [s for s in found if not s.one_line]
    if rest:
        rows = records.records(spark, [s.path for s in rest], base_path)
        by_file = {s.file: s.names for s in rest if s.names}
        longer = [s.file for s in rest if not s.names]    # headers of several lines
        by_file |= records.header_records(rows, longer) if longer else {}
        for names in sorted(set(by_file.values())):
            its = [f for f, n in by_file.items() if n == names]
            part = rows if len(its) == len(by_file) else rows.where(F.col("file").isin(its))
            parts.append(records.parsed(part, names))
    out = None
    for df in parts:
        keep = ("snapshot_date",) if base_path and "snapshot_date" in df.columns else ()
        part = conform(df, table, keep=keep)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return empty_table(spark, table)
    if "snapshot_date" in out.columns:
        rest_columns = [c for c in out.columns if c != "snapshot_date"]
        out = out.select(*rest_columns, F.col("snapshot_date").cast("string"))
    return out


def load_report(spark: SparkSession, loaded: dict[str, DataFrame], skipped: dict[str, str],
                paths: dict[str, str]) -> DataFrame:
    """(table_name, status, rows, path): rows are counted when the report is
    read, in one job over all tables."""
    schema = "table_name string, status string, rows bigint, path string"
    out = spark.createDataFrame([(t, "skipped", None, p) for t, p in skipped.items()], schema)
    for table, df in loaded.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), F.lit("loaded").alias("status"), "rows",
            F.lit(paths[table]).alias("path")))
    return out


def read_feed_csv(spark: SparkSession, feed_dir: str, tables: tuple[str, ...] = KNOWN_TABLES
                  ) -> tuple[dict[str, DataFrame], DataFrame]:
    """All known tables of one feed folder, plus a load report
    (table_name, status 'loaded' | 'skipped', rows, path)."""
    paths = {t: f"{feed_dir.rstrip('/')}/{t}.txt" for t in tables}
    there = {t for t, p in paths.items() if files.exists(spark, p)}
    out = read_feed_tables(spark, paths)
    return out, load_report(spark, {t: out[t] for t in tables if t in there},
                            {t: p for t, p in paths.items() if t not in there}, paths)


def read_feed_snapshots(spark: SparkSession, root: str,
                        tables: tuple[str, ...] = KNOWN_TABLES) -> dict[str, DataFrame]:
    """Every snapshot under ``root/snapshot_date=<date>/<table>.txt`` as one
    DataFrame per table with a ``snapshot_date`` column (filters on it prune
    the other snapshots' files)."""
    out = read_feed_tables(spark, {
        t: f"{root.rstrip('/')}/snapshot_date=*/{t}.txt" for t in tables}, base_path=root)
    return {t: df if "snapshot_date" in df.columns else
            spark.createDataFrame([], raw_schema(t, ("snapshot_date",)))
            for t, df in out.items()}
