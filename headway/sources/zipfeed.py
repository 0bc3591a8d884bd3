"""Zip feed reader: many feed archives, their members side by side.

``spark.read.format("binaryFile")`` lists the archives (``key=value`` folders
such as ``snapshot_date=2024-05-01`` become columns).  A first pass reads each
archive's directory; the wanted members are dealt to tasks by archive and
member, and a second pass opens the archive at each member, inflates it as a
stream and streams its records.  So the members of one archive are read by
several tasks, none is ever held whole, and archives may have any size.
Archives that tasks can't open by their path come with their ``content``; the
first pass then cuts out the members as they are, compressed.  The records are stored
once, partitioned by table, in the session's checkpoint folder, and every
table is read from there.

Only ``.txt`` members count; the table name is the file stem; unknown members
are ignored.  Every column of a member is kept, declared or not, and read as
text (ids keep leading zeros); empty fields become NULL, and a UTF-8
byte-order mark is dropped.  Quoted fields, also those of the header, may
hold newlines.  A record with more fields than its header is an error, as is
a member whose checksum is wrong.

The functions that run in the executors hold all they need, so workers don't
have to have this package.  Only archives that come with their content have a
bound, that of ``binaryFile``: 2 GB, compressed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import ensure_checkpoint_dir
from headway.sources import files
from headway.sources.schemas import DECLARED_COLUMNS, KNOWN_TABLES

CHUNK_RECORDS = 20_000
_FILE_COLUMNS = ("path", "modificationTime", "length", "content")


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """The ``.zip`` files at ``path`` (folder or glob), one row per archive;
    with their content only where tasks can't open them by their path."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return found.drop("content") if files.in_tasks(spark, path) else found


def _cutter(wanted: tuple[str, ...], extra: list[str]):
    """The first pass: one row per wanted member, by its number in the
    archive's directory, or compressed as it is where there is content."""
    locate = files.locator()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import os
        import struct
        import zipfile

        def packed(content, archive, info):
            """(method, bytes) of a member; unusual methods are undone here."""
            if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED) \
                    or info.flag_bits & 1:
                return zipfile.ZIP_STORED, archive.read(info)
            # Its own header says how long its name and extra field are.
            name, more = struct.unpack_from("<HH", content, info.header_offset + 26)
            begin = info.header_offset + 30 + name + more
            return info.compress_type, content[begin:begin + info.compress_size]

        def opened(row):
            if "content" in row:
                return io.BytesIO(row["content"])
            system, path = locate(row["path"])
            return system.open_input_file(path)

        for batch in batches:
            for row in batch.to_dict("records"):
                with opened(row) as source, zipfile.ZipFile(source) as archive:
                    for n, info in enumerate(archive.infolist()):
                        stem, ending = os.path.splitext(os.path.basename(info.filename))
                        if ending == ".txt" and stem in wanted:
                            method, data = (packed(bytes(row["content"]), archive, info)
                                            if "content" in row else (None, None))
                            yield pd.DataFrame([{
                                "source_path": row["path"], "table_name": stem, "n": n,
                                "member": info.filename, "method": method, "crc": info.CRC,
                                "data": data, **{c: row[c] for c in extra}}])

    return cut


def _reader(extra: list[str], chunk: int):
    """The second pass: per member a record 0 that names its columns, then
    its records from 1, each a map of column to text."""
    locate = files.locator()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import contextlib
        import csv
        import io
        import zipfile
        import zlib

        import numpy as np
        import pyarrow as pa

        csv.field_size_limit(1 << 30)

        class Member(io.RawIOBase):
            """A member's text, inflated piece by piece and checked."""
            def __init__(self, row):
                self.row, self.at, self.crc, self.held = row, 0, 0, b""
                self.inflate = zlib.decompressobj(-15) if row["method"] else None

            def readable(self):
                return True

            def readinto(self, into):
                while not self.held:
                    piece = self.row["data"][self.at:self.at + (1 << 16)]
                    self.at += len(piece)
                    if self.inflate is None:
                        self.held = piece
                    elif piece or self.inflate.unconsumed_tail:
                        self.held = self.inflate.decompress(
                            self.inflate.unconsumed_tail + piece, 1 << 20)
                    if not self.held and not piece and not (
                            self.inflate and self.inflate.unconsumed_tail):
                        if self.crc != self.row["crc"]:
                            raise ValueError(f"{self.row['member']}: its checksum is wrong")
                        return 0
                    self.crc = zlib.crc32(self.held, self.crc)
                n = min(len(into), len(self.held))
                into[:n], self.held = self.held[:n], self.held[n:]
                return n

        @contextlib.contextmanager
        def inflated(row):
            if row["data"] is not None:
                yield io.BufferedReader(Member(row))
                return
            system, path = locate(row["source_path"])
            with system.open_input_file(path) as source:
                with zipfile.ZipFile(io.BufferedReader(source, 1 << 20)) as archive:
                    with archive.open(archive.infolist()[row["n"]]) as member:
                        yield member

        def chunks(row):
            with inflated(row) as member:
                yield from records(row, io.TextIOWrapper(member, encoding="utf-8-sig", newline=""))

        def records(row, text):
            rows = csv.reader(text)
            names = [n.strip() for n in next(rows, [])]
            if not names:
                return
            # Of columns with one name the last counts.
            at = {name: i for i, name in enumerate(names)}
            keep = None if len(at) == len(names) else list(at.values())
            yield list(at), 0, [[""] * len(at)]
            held, begin = [], 1
            for n, fields in enumerate((r for r in rows if r), 1):
                if len(fields) > len(names):
                    raise ValueError(f"{row['member']}: record {n} has {len(fields)} fields, "
                                     f"the header {len(names)}")
                if len(fields) < len(names):
                    fields += [""] * (len(names) - len(fields))
                held.append([fields[i] for i in keep] if keep else fields)
                if len(held) >= chunk:
                    yield list(at), begin, held
                    held, begin = [], n + 1
            if held:
                yield list(at), begin, held

        def arrow(row, names, begin, held):
            n, k = len(held), len(names)
            keys = pa.array(names, pa.string()).take(pa.array(np.tile(np.arange(k), n)))
            values = pa.array([v or None for fields in held for v in fields], pa.string())
            fields = pa.MapArray.from_arrays(
                pa.array(np.arange(0, n * k + 1, k), pa.int32()), keys, values)
            same = [pa.repeat(pa.scalar(row[c], pa.string()), n)
                    for c in ("source_path", "table_name", *extra)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(begin, begin + n), pa.int64()), fields, *same],
                names=["record", "fields", "source_path", "table_name", *extra])

        for batch in batches:
            for row in batch.to_pylist():
                for names, begin, held in chunks(row):
                    yield arrow(row, names, begin, held)

    return read


def members(archives: DataFrame, tables: tuple[str, ...] = KNOWN_TABLES) -> DataFrame:
    """One row per wanted member of each archive, dealt to tasks by archive
    and member; compressed in ``data`` if the archives have their content."""
    extra = [c for c in archives.columns if c not in _FILE_COLUMNS]
    held = [c for c in ("path", "content") if c in archives.columns]
    source = archives.select(*held, *[F.col(c).cast("string") for c in extra])
    schema = ("source_path string, table_name string, n int, member string, method int, "
              "crc bigint, data binary" + "".join(f", `{c}` string" for c in extra))
    spark = archives.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return source.mapInPandas(_cutter(tuple(tables), extra), schema).repartition(
        n, "source_path", "member")


class ZipTables:
    """The members of a set of archives, read once and stored by table."""

    def __init__(self, archives: DataFrame, tables: tuple[str, ...] = KNOWN_TABLES,
                 chunk: int = CHUNK_RECORDS):
        self.spark, self.tables = archives.sparkSession, tuple(tables)
        self.extra = [c for c in archives.columns if c not in _FILE_COLUMNS]
        schema = ("record bigint, fields map<string, string>, source_path string, "
                  "table_name string" + "".join(f", `{c}` string" for c in self.extra))
        rows = members(archives, self.tables).mapInArrow(_reader(self.extra, chunk), schema)
        place = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/zip-{uuid.uuid4().hex}"
        rows.write.partitionBy("table_name").parquet(place)
        self.rows = self.spark.read.schema(rows.schema).parquet(place)
        self.archives = archives.select(F.col("path").alias("source_path"),
                                        *[F.col(c).cast("string") for c in self.extra])
        named = (self.rows.where("record = 0")
                 .select("table_name", F.explode(F.map_keys("fields")).alias("name"))
                 .distinct().collect())   # as many rows as there are column names
        self.names = {t: sorted(r["name"] for r in named if r["table_name"] == t)
                      for t in self.tables}

    def table(self, name: str) -> DataFrame:
        """Declared columns, then the others found, ``source_path`` and the
        folder columns."""
        more = [c for c in self.names[name] if c not in DECLARED_COLUMNS[name]]
        return (self.rows.where((F.col("table_name") == name) & (F.col("record") > 0))
                .select(*[F.col("fields").getItem(c).alias(c)
                          for c in (*DECLARED_COLUMNS[name], *more)],
                        "source_path", *self.extra))

    def manifest(self) -> DataFrame:
        """(source_path, table_name, status, rows) per archive and table; a
        table that an archive lacks is skipped."""
        every = self.archives.select("source_path", F.explode(
            F.array(*[F.lit(t) for t in self.tables])).alias("table_name"))
        there = self.rows.groupBy("source_path", "table_name").agg(
            F.max("record").alias("rows"))
        return every.join(there, ["source_path", "table_name"], "left").select(
            "source_path", "table_name",
            F.when(F.col("rows").isNull(), "skipped").otherwise("loaded").alias("status"), "rows")


def read_zip_feeds(spark: SparkSession, path: str,
                   tables: tuple[str, ...] = KNOWN_TABLES) -> dict[str, DataFrame]:
    """Every known table from every archive at ``path``."""
    found = ZipTables(list_archives(spark, path), tables)
    return {t: found.table(t) for t in tables}


def zip_manifest(archives: DataFrame) -> DataFrame:
    """Per archive and known table: loaded or skipped, and its rows."""
    return ZipTables(archives).manifest()
