"""CSV records of files that many tasks read, newlines in quotes included.

A task that begins in the middle of a file can't tell a newline within quotes
from one that ends a record.  But each stretch of lines is a small function:
begun outside or inside a quoted field, does it end inside?  A stretch that
ends the same way however it begins settles the state; the others keep it or
turn it over.  So

1. one pass packs the lines of each split of a file (a byte range that one
   task reads) into chunks of some ``CHUNK`` bytes, each with its function,
   and stores them;
2. these functions are applied one after another over a file's chunks (a few
   numbers each), which gives the state at the start of every chunk;
3. a pass over the chunks, each by itself, cuts them into records.  Only the
   pieces of records that reach over the end of a chunk are shuffled.

Files in which no line ends inside a quoted field (a first pass tells) need
no more than that pass: their lines are records, and Spark's CSV reader
splits them.  The pass also brings the first line of every file, so headers
are read by the same job.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.session import stored_table

OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
_BOM = "﻿"

#: Bytes of lines that are cut into records in one go.
CHUNK = 1 << 18


class Scanned(NamedTuple):
    """What the first pass tells about a file."""
    path: str
    names: tuple[str, ...]     # header names; none if it reaches over its line
    one_line: bool             # is every record one line?
    file: str                  # the path as in the column of that name


def lines(spark: SparkSession, paths: Sequence[str], base_path: str | None = None) -> DataFrame:
    """(file, block, value): every line (as bytes) with its file and the
    offset at which the split that holds its start begins; a split's lines
    come in their order.  Folder columns of ``base_path`` come last."""
    reader = spark.read.option("lineSep", "\n")
    if base_path:
        reader = reader.option("basePath", base_path)
    text = reader.text(list(paths))
    folders = [c for c in text.columns if c != "value"]
    return text.select(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"),
                       F.col("value").cast("binary").alias("value"), *folders)


def _cutter():
    """A function for tasks: text that begins outside or inside a quoted field
    to its records, and whether it ends inside.  A quote opens a field only at
    its start; elsewhere it is a character."""
    import re
    opened = re.compile(rb'(?<![^\n,])"[^"]*+(?:""[^"]*+)*+("?)')
    closed = re.compile(rb'[^"]*+(?:""[^"]*+)*+("?)')

    def cut(text: bytes, inside: bool) -> tuple[list[bytes], bool]:
        spans = []
        if inside:
            m = closed.match(text)
            spans, inside = [m.span()], not m[1]
        if not inside:
            for m in opened.finditer(text, spans[0][1] if spans else 0):
                inside = not m[1]
                spans.append(m.span())
        out, begin, at = [], 0, 0
        for a, z in spans:
            if text.find(b"\n", a, z) >= 0:
                first, *rest = text[at:a].split(b"\n")
                if rest:
                    out.append(text[begin:at] + first)
                    out += rest[:-1]
                    begin = a - len(rest[-1])
                at = z
        first, *rest = text[at:].split(b"\n")
        return [*out, text[begin:at] + first, *rest], inside

    return cut


def _runs():
    """A function for tasks: batches of ``lines`` to (place of a run's split,
    batch, first row, its lines) for runs of lines of one split."""
    def runs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            file, block = batch.column("file"), batch.column("block")
            value, n, at = batch.column("value"), batch.num_rows, 0
            while at < n:
                key = (file[at].as_py(), block[at].as_py())
                end = n
                if (file[n - 1].as_py(), block[n - 1].as_py()) != key:
                    end = next(i for i in range(at, n)
                               if (file[i].as_py(), block[i].as_py()) != key)
                yield key, batch, at, value.slice(at, end - at).to_pylist()
                at = end

    return runs


def _looker():
    """The first pass: a row per split, with its first line and whether any
    record is more than a plain line."""
    cut, runs = _cutter(), _runs()

    def odd(lines: list[bytes]) -> bool:
        text = b"\n".join(lines)
        records, inside = cut(text, False)
        # A return within a line is kept as part of a quoted field.
        return inside or len(records) < len(lines) or b"\r" in text and any(
            b'"' in x and b"\r" in x.rstrip(b"\r") for x in lines)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        def row():
            (file, block), first, more = held
            return pa.RecordBatch.from_pydict({
                "file": pa.array([file]), "block": pa.array([block], pa.int64()),
                "first": pa.array([first], pa.binary()),
                "opens": pa.array([cut(first, False)[1]]), "odd": pa.array([more])})

        held = None
        for key, _, _, lines in runs(batches):
            if held is None or held[0] != key:
                if held:
                    yield row()
                held = (key, lines[0], False)
            held = (*held[:2], held[2] or odd(lines))
        if held:
            yield row()

    return look


def splits(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, block, first, opens, odd): a row per split."""
    return lines(spark, paths).mapInArrow(
        _looker(), "file string, block long, first binary, opens boolean, odd boolean")


def scan(spark: SparkSession, paths: Sequence[str]) -> list[Scanned]:
    """One job over all files; one row per file reaches the driver.  Empty
    files have no row."""
    if not paths:
        return []
    first = F.min_by(F.struct(F.col("first").cast("string").alias("value"), "opens"), "block")
    rows = splits(spark, paths).groupBy("file").agg(F.max("odd").alias("odd"), first.alias("first")).collect()
    return sorted(Scanned(r.file, () if r["first"].opens else header_names(r["first"].value),
                          not r.odd, r.file) for r in rows)


def header_names(record: str) -> tuple[str, ...]:
    names = next(csv.reader([record.rstrip("\r")], strict=False), [])
    return tuple(n.strip().lstrip(_BOM).strip() for n in names)


def _packer(folders: list[str], size: int):
    """Lines to chunks of some ``size`` bytes of one split, with what each does."""
    cut, runs = _cutter(), _runs()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        def chunk():
            (file, block), text = key, b"\n".join(held)
            found, stays = cut(text, True)
            return pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([text], pa.binary()), pa.array([cut(text, False)[1]]),
                 pa.array([stays]), pa.array([stays and len(found) > 1]), *own],
                names=["file", "block", "n", "text", "opens", "stays", "reopens", *folders])

        key, n, held, room, own = None, 0, [], size, []
        for split, batch, at, lines in runs(batches):
            if split != key:
                if held:
                    yield chunk()
                key, n, held, room = split, 0, [], size
                own = [batch.column(c).slice(at, 1) for c in folders]
            for line in lines:
                held.append(line)
                room -= len(line) + 1
                if room <= 0:
                    yield chunk()
                    n, held, room = n + 1, [], size
        if held:
            yield chunk()

    return pack


def _splitter(folders: list[str], whole: bool):
    """Chunks to their ``whole`` records, or to the pieces of those that reach
    over their chunk; a piece has the chunk in which its record began."""
    cut = _cutter()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for batch in batches:
            for at, row in enumerate(batch.drop_columns(folders).to_pylist()):
                place, begun = (row["block"], row["n"]), row["begun"]
                found, inside = cut(row["text"], begun)
                last = len(found) - 1
                parts = [(0, row["own_block"], row["own_n"])] if begun else []
                if inside and not (begun and last == 0):
                    parts.append((last, *place))
                header = 0 if place == (0, 0) and not begun else None
                if whole:
                    kept = range(1 if begun else 0, last if inside else last + 1)
                    owners = [place] * len(kept)
                else:
                    kept, owners = [p[0] for p in parts], [p[1:] for p in parts]
                if not kept:
                    continue
                here = pa.array([at] * len(kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("file").take(here),
                     pa.array([i == header for i in kept]),
                     pa.array([o[0] for o in owners], pa.int64()),
                     pa.array([o[1] for o in owners], pa.int64()),
                     batch.column("block").take(here), batch.column("n").take(here),
                     pa.array([found[i] for i in kept], pa.binary()),
                     *[batch.column(c).take(here) for c in folders]],
                    names=["file", "header", "own_block", "own_n", "block", "n", "record",
                           *folders])

    return split


def _inside_after(settled: Column, turns: Column, turns_then: Column, begun: Column) -> Column:
    """The state after text of which the last that settles left ``settled``
    (null if none did) when ``turns_then`` of the ``turns`` had happened."""
    odd = (turns - F.coalesce(turns_then, F.lit(0))) % 2 == 1
    return F.coalesce(settled, begun) != odd


def records(spark: SparkSession, paths: Sequence[str], base_path: str | None = None) -> DataFrame:
    """(file, header, record): every record of the files, and whether it is
    its file's first; folder columns come last."""
    found = lines(spark, paths, base_path)
    folders = [c for c in found.columns if c not in ("file", "block", "value")]
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in found.schema
                   if f.name in folders)
    # Many small splits make few files; no row moves.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = stored_table(found.mapInArrow(
        _packer(folders, CHUNK), "file string, block long, n long, text binary, opens boolean, "
        f"stays boolean, reopens boolean{more}").coalesce(tasks), "chunks")
    # Each chunk as one function, applied in turn over its file.
    order = Window.partitionBy("file").orderBy("block", "n")        # a small row per chunk
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = chunks.select("file", "block", "n", "opens", "stays", "reopens").withColumn(
        "turned", F.sum(F.expr("CAST(opens AND NOT stays AS LONG)")).over(
            order.rowsBetween(Window.unboundedPreceding, 0)))
    settled = F.when(F.expr("opens = stays"), F.struct("opens", "turned"))
    whole = whole.withColumn("held", F.last(settled, ignorenulls=True).over(before)).withColumn(
        "turned_before", F.coalesce(F.lag("turned").over(order), F.lit(0)))
    whole = whole.withColumn("begun", _inside_after(
        F.col("held.opens"), F.col("turned_before"), F.col("held.turned"), F.lit(False)))
    opened = F.when(F.expr("IF(begun, reopens, opens)"), F.struct("block", "n"))
    inner = whole.withColumn("own", F.last(opened, ignorenulls=True).over(before)).where("begun")
    inner = stored_table(inner.select("file", "block", "n", "begun", F.col("own.block").alias(
        "own_block"), F.col("own.n").alias("own_n")), "inner")
    # At most a row per CHUNK bytes.
    placed = chunks.select("file", "block", "n", "text", *folders).join(
        F.broadcast(inner), ["file", "block", "n"], "left").withColumn(
        "begun", F.coalesce("begun", F.lit(False)))
    schema = ("file string, header boolean, own_block long, own_n long, block long, n long, "
              f"record binary{more}")
    record = F.col("record").cast("string").alias("record")
    single = placed.mapInArrow(_splitter(folders, True), schema).select(
        "file", "header", record, *folders)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "n", record))),
                        lambda p: p["record"])
    many = placed.mapInArrow(_splitter(folders, False), schema).groupBy(
        "file", "own_block", "own_n").agg(
        F.max("header").alias("header"), F.concat_ws("\n", parts).alias("record"),
        *[F.first(c).alias(c) for c in folders])
    return single.unionByName(many.select("file", "header", "record", *folders)).withColumn(
        "record", F.regexp_replace("record", r"\r\z", ""))


def header_records(found: DataFrame, files: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Header names by file, whatever lines they take."""
    first = found.where(F.col("header") & F.col("file").isin(list(files)))
    return {r.file: header_names(r.record) for r in first.collect()}


def parsed(found: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns ``names`` of ``records`` (all text; empty fields are null),
    without header and empty records; folder columns come last."""
    folders = [c for c in found.columns if c not in ("file", "header", "record")]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = found.where(r"NOT header AND trim(BOTH ' \t\r\n' FROM record) <> ''")
    return rows.select(F.from_csv("record", schema, OPTIONS).alias("r"), *folders).select(
        *[F.col("r").getField(n).alias(n) for n in names], *folders)
