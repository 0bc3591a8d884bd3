"""Tables that change from one whole state to the next.

A published table is a folder of Parquet files with a manifest beside them:
the names of the files that make up the table, its columns and its number of
rows.  Publishing adds new files under new names, writes a new manifest to a
temporary file, and renames that over the old one, which is one step.
Readers open what the manifest lists, so they see the old state until then
and the new one afterwards; files of a write that was stopped are listed
nowhere.  Files that are no longer listed are removed after the switch.  An
empty table has a manifest too, so its columns are known.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.sources import files

MANIFEST = "_manifest.json"


class Manifest(NamedTuple):
    files: tuple[str, ...]      # names in the table's folder
    schema: T.StructType
    rows: int


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """What is published at ``path``, if anything is."""
    text = files.read_text(spark, f"{path.rstrip('/')}/{MANIFEST}")
    if text is None:
        return None
    return _manifest(text)


def _manifest(text: str) -> Manifest:
    held = json.loads(text)
    return Manifest(tuple(held["files"]), T.StructType.fromJson(held["schema"]), held["rows"])


def switch(spark: SparkSession, path: str, names: Sequence[str], schema: T.StructType,
           rows: int) -> None:
    """Make the files ``names`` in the folder ``path`` the table, and remove
    the others."""
    place = path.rstrip("/")
    held = {"files": sorted(names), "schema": schema.jsonValue(), "rows": rows}
    files.replace_text(spark, f"{place}/{MANIFEST}", json.dumps(held))
    for f in files.list_files(spark, place):
        if f.path.rsplit("/", 1)[-1] not in names and "/" not in _below(f.path, place):
            files.delete(spark, f.path)


def _starter(schema: str):
    locate = files.locator()

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        import uuid

        from pyarrow import fs

        for batch in batches:
            for row in batch.itertuples(index=False):
                system, place = locate(row.place)
                system.create_dir(place, recursive=True)
                there = [f.base_name for f in system.get_file_info(fs.FileSelector(place))]
                names = sorted(n for n in there if n.endswith(".parquet") and n[:1] not in "_.")
                held = f"{place}/.{row.manifest}-{uuid.uuid4().hex}"
                with system.open_output_stream(held) as out:
                    out.write(json.dumps({"files": names, "schema": json.loads(schema),
                                          "rows": int(row.rows)}).encode())
                try:
                    system.move(held, f"{place}/{row.manifest}")
                except OSError:      # this task ran before
                    if system.get_file_info(f"{place}/{row.manifest}").type != fs.FileType.File:
                        raise
                    system.delete_file(held)
            yield batch[["place"]]

    return start


def start_all(spark: SparkSession, units: Sequence[tuple[str, int]], schema: T.StructType) -> None:
    """Publish tables of ``schema`` at places where nothing was before: all
    data files at each (place, rows) make up its table.  Tasks do it, as
    there may be very many."""
    if not units:
        return
    if not files.in_tasks(spark, units[0][0]):
        files.each(lambda u: switch(spark, u[0], data_files(spark, u[0]), schema, u[1]), units)
        return
    rows = spark.createDataFrame([(files.qualified(spark, p), n, MANIFEST) for p, n in units],
                                 "place string, rows long, manifest string")
    done = rows.repartition(files.tasks_for(spark, len(units))).mapInPandas(
        _starter(schema.json()), "place string")
    if done.agg(F.count("place")).first()[0] != len(units):
        raise OSError("not every table was published")


def read_manifests(spark: SparkSession, places: Sequence[str]) -> dict[str, Manifest]:
    """What is published at each of ``places``; read by tasks if they are many."""
    if len(places) <= files.SIDE_BY_SIDE or not files.in_tasks(spark, places[0]):
        found = zip(places, files.each(lambda p: read_manifest(spark, p), places))
        return {p: m for p, m in found if m is not None}
    own = {files.qualified(spark, p): p for p in places}
    rows = spark.createDataFrame([(f"{p}/{MANIFEST}",) for p in own], "path string").repartition(
        files.tasks_for(spark, len(own))).mapInPandas(_manifest_reader(), "path string, text string")
    return {own[r.path.rpartition("/")[0]]: _manifest(r.text) for r in rows.collect()}


def _manifest_reader():
    locate = files.locator()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch["path"]:
                system, place = locate(path)
                if system.get_file_info(place).type == fs.FileType.File:
                    with system.open_input_stream(place) as held:
                        found.append((path, held.read().decode()))
            yield pd.DataFrame(found, columns=["path", "text"])

    return read


def _below(path: str, folder: str) -> str:
    """``path`` from its folder on (folders are given with or without scheme)."""
    name = folder.rsplit("/", 1)[-1]
    return path.rsplit(f"/{name}/", 1)[-1]


def added_files(spark: SparkSession, path: str, before: set[str]) -> list[str]:
    """Names of the data files directly in ``path`` that weren't there before."""
    return [n for n in data_files(spark, path) if n not in before]


def data_files(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.names(spark, path) if n.endswith(".parquet") and n[:1] not in "_."]


def publish(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` by ``df`` in one step; the table as read."""
    spark = df.sparkSession
    before = set(data_files(spark, path))
    df.write.mode("append").parquet(path)
    names = added_files(spark, path, before)
    place = path.rstrip("/")
    rows = spark.read.schema(df.schema).parquet(*[f"{place}/{n}" for n in names]).count() \
        if names else 0
    switch(spark, path, names, df.schema, rows)
    return read_published(spark, path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The table published at ``path``."""
    found = read_manifest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no table is published at {path}")
    return read_together(spark, {path: found})


def read_together(spark: SparkSession, units: Mapping[str, Manifest]) -> DataFrame:
    """The tables published at several places, one below the other; columns
    that only some have are NULL in the others.  Those of the same columns are
    one scan, however many they are."""
    alike: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType] = {}
    for path, held in units.items():
        key = held.schema.json()
        schemas.setdefault(key, held.schema)
        alike.setdefault(key, []).extend(f"{path.rstrip('/')}/{n}" for n in held.files)
    out = None
    for key, paths in alike.items():
        part = (spark.read.schema(schemas[key]).parquet(*paths) if paths
                else spark.createDataFrame([], schemas[key]))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
