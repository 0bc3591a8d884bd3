"""Registry-driven loader for extra datasets.

A registry lists entries ``{name, path, format, description, refresh}`` (a
YAML/JSON file with a ``datasets`` list, or Python dicts).  Loading an entry
takes four steps: find its source files, keep them unparsed under
``<target>/_source/<name>/<load date>``, parse them with Spark's reader for
the format, and replace the table ``<target>/<name>`` in one step.  Entries
load side by side, those of one name in their order.  What goes wrong in
one entry is reported with its whole error text and the others still load;
an empty registry is a no-op.  The result is a status DataFrame
``(name, format, status, rows, error)``.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from headway.sources import files
from headway.sources.publish import publish, read_manifest

#: Format -> reader options.
READERS: dict[str, dict[str, str]] = {
    "csv": {"header": "true", "multiLine": "true", "escape": '"'},
    "parquet": {}, "json": {}, "orc": {},
}
SIDE_BY_SIDE = 8      # entries whose jobs are submitted at a time
STATUS_SCHEMA = "name string, format string, status string, rows bigint, error string"


def read_registry(spark: SparkSession, path: str) -> list[dict]:
    """Entries of a registry file (``.yml``/``.yaml`` or ``.json``)."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    if path.endswith(".json"):
        listed = json.loads(text) if text.strip() else None
    else:
        import yaml
        listed = yaml.safe_load(text)
    return (listed or {}).get("datasets") or []


def load_entry(spark: SparkSession, entry: dict, target: str, load_date: str) -> int:
    """Archive, parse and replace one dataset; its number of rows."""
    kind = str(entry.get("format", "")).lower()
    if kind not in READERS:
        raise ValueError(f"no reader for the format {kind!r}; there are {sorted(READERS)}")
    kept = files.copy_into(spark, entry["path"],
                           f"{target}/_source/{entry['name']}/{load_date}")
    if not kept:
        raise FileNotFoundError(f"no file at {entry['path']}")
    place = f"{target}/{entry['name']}"
    publish(spark.read.format(kind).options(**READERS[kind]).load(entry["path"]), place)
    return read_manifest(spark, place).rows


def load_registry(spark: SparkSession, entries: Sequence[dict] | str, target: str,
                  load_date: str | None = None) -> DataFrame:
    """Load every entry into ``target/<name>``; one status row per entry."""
    load_date = load_date or dt.date.today().isoformat()
    listed = read_registry(spark, entries) if isinstance(entries, str) else entries
    named: dict[object, list[int]] = {}
    for at, entry in enumerate(listed):
        named.setdefault(entry.get("name"), []).append(at)

    def load(places: list[int]) -> list[tuple[int, tuple]]:
        out = []
        for at in places:
            row = (listed[at].get("name"), str(listed[at].get("format", "")))
            try:
                row += ("loaded", load_entry(spark, listed[at], target.rstrip("/"), load_date),
                        None)
            except Exception as why:  # one bad entry must not stop the others
                row += ("failed", None, str(why))
            out.append((at, row))
        return out

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        done = dict(each for rows in pool.map(load, named.values()) for each in rows)
    return spark.createDataFrame([done[at] for at in sorted(done)], STATUS_SCHEMA)
