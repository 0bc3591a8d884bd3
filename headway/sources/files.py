"""Files on any Hadoop file system: listing, copying, deleting.

The driver only looks at names, sizes and times.  Contents are read by
Spark's readers, or as streams by tasks, which reach the file systems of
``TASK_SCHEMES`` (``file`` is a folder that all machines share).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple, TypeVar

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

TASK_SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs")
BLOCK = 8 << 20       # bytes of a file that a copying task holds
SIDE_BY_SIDE = 16     # names that the driver looks at or changes at a time

Item, Out = TypeVar("Item"), TypeVar("Out")


class File(NamedTuple):
    path: str
    size: int
    modified: int


def _open(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def each(work: Callable[[Item], Out], items: Iterable[Item]) -> list[Out]:
    """``work`` on every item, side by side: the driver mostly waits for the
    file system."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        return list(pool.map(work, items))


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _open(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens where there is none."""
    fs, place = _open(spark, path)
    fs.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in ``path`` (none if it isn't there)."""
    fs, place = _open(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` (none if it isn't there)."""
    fs, place = _open(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(place) if s.isFile())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if it isn't there."""
    fs, place = _open(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(
            stream)).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file in one step: readers see the old or the new."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs, place = _open(spark, path)
    fs.mkdirs(place.getParent())
    held = hadoop.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex}")
    out = fs.create(held, True)
    out.write(bytearray(text.encode()))
    out.close()
    over = spark.sparkContext._gateway.new_array(
        getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    where = fs.makeQualified(place)
    hadoop.FileContext.getFileContext(where.toUri(), conf).rename(
        fs.makeQualified(held), where, over)


def list_files(spark: SparkSession, pattern: str) -> list[File]:
    """The files that ``pattern`` (a file, folder or glob) names, those in
    folders included; names beginning with ``_`` or ``.`` are no data."""
    fs, place = _open(spark, pattern)
    out: list[File] = []

    def add(status) -> None:
        if status.getPath().getName()[:1] in "_.":
            return
        if status.isDirectory():
            for inner in fs.listStatus(status.getPath()):
                add(inner)
        else:
            out.append(File(status.getPath().toString(), status.getLen(),
                            status.getModificationTime()))

    for status in fs.globStatus(place) or ():
        add(status)
    return sorted(out)


def fingerprint(spark: SparkSession, *patterns: str) -> str:
    """Changes whenever a file behind the patterns is added, removed or
    written again (by names, sizes and modification times)."""
    found = [tuple(f) for p in patterns for f in list_files(spark, p)]
    return hashlib.sha256(repr(found).encode()).hexdigest()[:16]


def in_tasks(spark: SparkSession, path: str) -> bool:
    """Whether tasks can open the files at ``path`` as streams."""
    fs, _ = _open(spark, path)
    return fs.getUri().getScheme() in TASK_SCHEMES


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as tasks need it."""
    fs, place = _open(spark, path)
    return fs.makeQualified(place).toString()


def tasks_for(spark: SparkSession, items: int) -> int:
    """Tasks for small files: the session's partitions, a file each at most."""
    return max(1, min(items, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def locator():
    """A function for tasks: a file's address to (its file system, its path
    there).  It needs nothing of this package on the workers."""
    def locate(address: str):
        import re

        from pyarrow import fs

        scheme, host, path = re.match(r"(?s)([a-z0-9]+):(?://([^/]*))?(/.*)$", address).groups()
        if scheme == "file":
            return fs.LocalFileSystem(), path
        system, root = fs.FileSystem.from_uri(f"{scheme}://{host or ''}/")
        return system, root.rstrip("/") + path

    return locate


def _copier(block: int):
    locate = locator()

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        for batch in batches:
            for row in batch.itertuples(index=False):
                (here, source), (there, target) = locate(row.source), locate(row.target)
                folder, _, name = target.rpartition("/")
                there.create_dir(folder, recursive=True)
                held = f"{folder}/.{name}-{uuid.uuid4().hex}"
                size = 0
                with here.open_input_stream(source) as inp, there.open_output_stream(held) as out:
                    while piece := inp.read(block):
                        out.write(piece)
                        size += len(piece)
                if size != row.size:
                    there.delete_file(held)
                    raise OSError(f"{row.source}: {size} bytes were read of {row.size}")
                if there.get_file_info(target).type != fs.FileType.NotFound:
                    there.delete_file(target)
                there.move(held, target)
            yield batch[["target"]]

    return copy


def copy_into(spark: SparkSession, pattern: str, folder: str) -> list[str]:
    """Copy the files behind ``pattern`` into ``folder``, byte for byte; what
    lies in different folders keeps its place below the one they share.

    Tasks copy one file each, block by block, under a name of their own that
    is changed when the copy is whole, so a task that is run again does no
    harm.  Where a file system isn't among ``TASK_SCHEMES`` the driver has
    Hadoop copy the files.
    """
    found = list_files(spark, pattern)
    if not found:
        return []
    fs, place = _open(spark, folder)
    root = fs.makeQualified(place).toString().rstrip("/")
    shared = found[0].path.rpartition("/")[0]
    while not all(f.path.startswith(shared + "/") for f in found):
        shared = shared.rpartition("/")[0]
    pairs = [(f.path, f"{root}/{f.path[len(shared) + 1:]}", f.size) for f in found]
    if in_tasks(spark, folder) and all(in_tasks(spark, f.path) for f in found):
        copied = (spark.createDataFrame(pairs, "source string, target string, size long")
                  .repartition(len(pairs)).mapInPandas(_copier(BLOCK), "target string"))
        if copied.agg(F.count("target")).first()[0] != len(pairs):
            raise OSError(f"not every file of {pattern} was copied")
    else:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for source, target, _ in pairs:
            (here, a), (there, b) = _open(spark, source), _open(spark, target)
            hadoop.FileUtil.copy(here, a, there, b, False, True, conf)
    return [target for _, target, _ in pairs]
