import io
import os
import zipfile

import pytest

from headway.sources import files
from headway.sources.archive import (archive_snapshot, archive_source, latest_snapshot,
                                     load_tables, replay_all, replay_snapshot)
from headway.sources.bridge import stored_raw_feed
from headway.sources.feed import read_feed_csv, read_feed_snapshots
from headway.sources.publish import read_published
from headway.sources.registry import load_registry
from headway.sources.zipfeed import ZipTables, list_archives, read_zip_feeds, zip_manifest

STOPS_TXT = ("﻿stop_name,stop_id,stop_lat,stop_lon,stop_desc\r\n"
             "\"Halte \"\"A\"\"\",007,-6.2,106.8,\"two\nlines\"\r\n"
             "Plain,S2,-6.3,106.9,\r\n")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_csv_feed_quirks(spark, scratch):
    feed = os.path.join(scratch, "feed")
    _write(f"{feed}/stops.txt", STOPS_TXT)
    _write(f"{feed}/calendar_dates.txt", "service_id,date,exception_type\n")   # header only
    tables, report = read_feed_csv(spark, feed)
    stops = {r.stop_id: r for r in tables["stops"].collect()}
    assert set(stops) == {"007", "S2"}                       # id keeps its zeros
    assert stops["007"].stop_name == 'Halte "A"'             # doubled quotes
    assert stops["007"].stop_desc == "two\nlines"            # newline inside quotes
    assert stops["S2"].stop_desc is None                     # empty -> NULL
    assert stops["S2"].stop_code is None                     # optional column absent
    assert tables["stops"].columns[0] == "stop_id"           # declared order, by name
    cd = tables["calendar_dates"]
    assert cd.count() == 0 and cd.columns == ["service_id", "date", "exception_type"]
    status = {r.table_name: (r.status, r.rows) for r in report.collect()}
    assert status["stops"] == ("loaded", 2) and status["trips"] == ("skipped", None)
    assert status["calendar_dates"] == ("loaded", 0)
    assert tables["trips"].count() == 0 and "trip_id" in tables["trips"].columns


def test_csv_snapshots_and_pruning(spark, scratch):
    root = os.path.join(scratch, "snaps")
    _write(f"{root}/snapshot_date=2024-01-01/stops.txt", "stop_id,stop_name\nA,One\n")
    _write(f"{root}/snapshot_date=2024-02-01/stops.txt", "stop_id,stop_name\nA,One\nB,Two\n")
    stops = read_feed_snapshots(spark, root, tables=("stops", "trips"))["stops"]
    assert stops.where("snapshot_date = '2024-02-01'").count() == 2
    assert stops.count() == 3


def _zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, text in members.items():
            zf.writestr(name, text.encode("utf-8"))
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())


def test_zip_feeds(spark, scratch):
    root = os.path.join(scratch, "zips")
    _zip(f"{root}/snapshot_date=2024-01-01/feed.zip",
         {"stops.txt": STOPS_TXT, "notes.md": "ignored", "extra_table.txt": "a,b\n1,2\n",
          "calendar_dates.txt": "service_id,date,exception_type\n"})
    _zip(f"{root}/snapshot_date=2024-02-01/feed.zip",
         {"gtfs/stops.txt": "stop_id,stop_name\nX,Ex\n", "trips.txt": "route_id,trip_id\nR,T\n"})
    feeds = read_zip_feeds(spark, root, tables=("stops", "trips", "calendar_dates"))
    stops = {(r.snapshot_date, r.stop_id): r for r in feeds["stops"].collect()}
    assert set(stops) == {("2024-01-01", "007"), ("2024-01-01", "S2"), ("2024-02-01", "X")}
    assert stops[("2024-01-01", "007")].stop_desc == "two\nlines"
    assert stops[("2024-01-01", "007")].stop_name == 'Halte "A"'
    assert stops[("2024-01-01", "S2")].stop_desc is None
    assert feeds["trips"].count() == 1 and feeds["calendar_dates"].count() == 0
    manifest = {(os.path.basename(os.path.dirname(r.source_path)), r.table_name): r.status
                for r in zip_manifest(list_archives(spark, root)).collect()}
    assert manifest[("snapshot_date=2024-01-01", "trips")] == "skipped"
    assert manifest[("snapshot_date=2024-02-01", "trips")] == "loaded"


def test_registry(spark, scratch):
    good = os.path.join(scratch, "pop.csv")
    _write(good, "area,people\nA,10\nB,20\n")
    entries = [{"name": "population", "path": good, "format": "csv"},
               {"name": "broken", "path": os.path.join(scratch, "missing.csv"), "format": "csv"},
               {"name": "sheet", "path": good, "format": "xlsx"}]
    status = {r.name: r for r in load_registry(spark, entries, os.path.join(scratch, "out")).collect()}
    assert status["population"].status == "loaded" and status["population"].rows == 2
    assert status["broken"].status == "failed"
    assert status["sheet"].status == "failed" and "no reader for the format" in status["sheet"].error
    assert len(status["broken"].error) > 20
    kept = os.path.join(scratch, "out", "_source", "population")
    (date,) = os.listdir(kept)
    assert open(os.path.join(kept, date, "pop.csv"), encoding="utf-8").read() == open(good, encoding="utf-8").read()
    assert load_registry(spark, [], os.path.join(scratch, "out")).count() == 0


def test_registry_entries_keep_their_order_and_faults_apart(spark, scratch):
    entries = []
    for i in range(12):
        path = os.path.join(scratch, f"f{i}.csv")
        _write(path, "a\n" + "1\n" * (i + 1))
        entries.append({"name": f"t{i % 10}", "path": path if i % 4 else path + ".gone",
                        "format": "csv"})
    out = os.path.join(scratch, "out")
    rows = load_registry(spark, entries, out).collect()
    assert [r.name for r in rows] == [e["name"] for e in entries]
    assert [(r.status, r.rows) for r in rows] == [
        ("loaded", i + 1) if i % 4 else ("failed", None) for i in range(12)]
    assert read_published(spark, f"{out}/t1").count() == 12    # the later of that name


def test_snapshots_are_united_by_column_name(spark, scratch):
    root = os.path.join(scratch, "snaps")
    _write(f"{root}/snapshot_date=2024-01-01/stops.txt", "stop_id,stop_name\nA,One\n")
    _write(f"{root}/snapshot_date=2024-02-01/stops.txt", "stop_name,stop_id\nTwo,B\n")
    _write(f"{root}/snapshot_date=2024-03-01/stops.txt",
           'stop_id,"stop_name",platform_code,"odd\nname"\nC,Three,7,x\n')
    stops = read_feed_snapshots(spark, root, tables=("stops",))["stops"]
    got = {r.stop_id: (r.stop_name, r.platform_code, r["odd\nname"], r.snapshot_date)
           for r in stops.collect()}
    assert got == {"A": ("One", None, None, "2024-01-01"), "B": ("Two", None, None, "2024-02-01"),
                   "C": ("Three", "7", "x", "2024-03-01")}


def test_a_quoted_newline_in_any_table(spark, scratch):
    feed = os.path.join(scratch, "feed")
    _write(f"{feed}/stop_times.txt", 'trip_id,stop_id,stop_headsign\nT,S,"two\nlines"\nT,S2,x\n')
    tables, report = read_feed_csv(spark, feed, tables=("stop_times",))
    assert {r.stop_headsign for r in tables["stop_times"].collect()} == {"two\nlines", "x"}
    assert [r.rows for r in report.collect()] == [2]


def stops(spark, rows, columns="stop_id string, stop_name string"):
    return spark.createDataFrame(rows, columns)


def test_archived_snapshots_are_replaced_whole(spark, scratch):
    root = os.path.join(scratch, "archive")
    archive_snapshot({"stops": stops(spark, [("A", "a"), ("B", "b")])}, root, "2024-01-01")
    archive_snapshot({"stops": stops(spark, [("C", "c", "x")],
                                     "stop_id string, stop_name string, platform string")},
                     root, "2024-02-01")
    archive_snapshot({"stops": stops(spark, [])}, root, "2024-01-01")       # now empty
    first = replay_snapshot(spark, root, ["stops"], "2024-01-01")["stops"]
    assert first.count() == 0 and "stop_lat" in first.columns
    every = replay_all(spark, root, "stops").collect()
    assert [(r.stop_id, r.platform, r.snapshot_date) for r in every] == [("C", "x", "2024-02-01")]
    archive_snapshot({"stops": stops(spark, [])}, root, "2024-03-01")
    assert latest_snapshot(spark, root, "stops").first()[0] == "2024-03-01"
    assert latest_snapshot(spark, root, "trips").first()[0] is None
    assert replay_all(spark, root, "trips").count() == 0
    with pytest.raises(Exception):
        replay_snapshot(spark, root, ["stops"], "2020-01-01")


def test_tables_are_truncated_and_loaded(spark, scratch):
    load_tables(spark, {"stops": stops(spark, [("A", "a"), ("B", "b")])}, scratch)
    again = load_tables(spark, {"stops": stops(spark, [("C", "c")])}, scratch)["stops"]
    assert [r.stop_id for r in again.collect()] == ["C"]


def test_a_write_that_stops_before_it_is_published_changes_nothing(spark, scratch, monkeypatch):
    from headway.sources import publish as p
    place = os.path.join(scratch, "t")
    p.publish(stops(spark, [("A", "a"), ("B", "b")]), place)
    with monkeypatch.context() as m:
        m.setattr(p, "switch", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            p.publish(stops(spark, [("C", "c")]), place)
    assert sorted(r.stop_id for r in p.read_published(spark, place).collect()) == ["A", "B"]
    archive_snapshot({"t": stops(spark, [("A", "a")])}, scratch, "2024-01-01")
    with monkeypatch.context() as m:
        m.setattr(p, "switch", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        for date in ("2024-01-01", "2024-01-02"):
            with pytest.raises(RuntimeError):
                archive_snapshot({"t": stops(spark, [("X", "x")])}, scratch, date)
    assert [r.stop_id for r in replay_snapshot(spark, scratch, ["t"], "2024-01-01")["t"].collect()] == ["A"]
    assert latest_snapshot(spark, scratch, "t").first()[0] == "2024-01-01"
    # What the stopped writes left goes with the next one.
    now = p.publish(stops(spark, [("D", "d")]), place)
    assert [r.stop_id for r in now.collect()] == ["D"]
    held = p.read_manifest(spark, place)
    assert sorted(held.files) == p.data_files(spark, place) and held.rows == 1


def test_a_header_only_table_of_an_archive_is_replayed_with_its_columns(spark, scratch):
    from headway.streaming.feed_watch import archive_batch
    landing, root = os.path.join(scratch, "landing"), os.path.join(scratch, "archive")
    _zip(f"{landing}/snapshot_date=2024-01-01/a.zip", {
        "calendar_dates.txt": "service_id,date,exception_type,note\n", "stops.txt": STOPS_TXT})
    archive_batch(list_archives(spark, landing), root, ("calendar_dates", "stops", "trips"))
    got = replay_snapshot(spark, root, ["calendar_dates", "stops"], "2024-01-01")
    assert got["calendar_dates"].count() == 0 and got["stops"].count() == 2
    assert got["calendar_dates"].columns[:3] == ["service_id", "date", "exception_type"]
    assert replay_all(spark, root, "calendar_dates").count() == 0
    assert latest_snapshot(spark, root, "calendar_dates").first()[0] == "2024-01-01"
    with pytest.raises(FileNotFoundError):
        replay_snapshot(spark, root, ["trips"], "2024-01-01")


def test_archives_of_one_snapshot_are_replayed_in_one_scan(spark, scratch):
    from headway.streaming.feed_watch import archive_batch
    archives = []
    for n in range(4):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            z.writestr("routes.txt", f"route_id\nR{n}\n")
            z.writestr("calendar_dates.txt", "service_id,date,exception_type\n")
        archives.append((f"zip:/{n}.zip", held.getvalue(), "2024-01-01"))
    batch = spark.createDataFrame(archives, "path string, content binary, snapshot_date string")
    tables = ("routes", "calendar_dates")
    archive_batch(batch, scratch, tables)
    back = replay_snapshot(spark, scratch, list(tables), "2024-01-01")
    assert sorted(r.route_id for r in back["routes"].collect()) == ["R0", "R1", "R2", "R3"]
    assert back["calendar_dates"].count() == 0
    assert "Union" not in back["routes"]._jdf.queryExecution().toString()


def test_new_archives_are_published_and_listed_by_tasks(spark, scratch, monkeypatch):
    import pandas as pd

    from headway.sources import archive, publish
    from headway.streaming import feed_watch
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        z.writestr("stops.txt", "stop_id,stop_id,stop_name\na,b,\nc,d,x\n")
        z.writestr("calendar_dates.txt", "service_id,date,exception_type\n")
    batch = spark.createDataFrame(pd.DataFrame(
        [(f"zip:/{i}.zip", packed.getvalue(), "2024-01-01") for i in range(20)],
        columns=["path", "content", "snapshot_date"]))
    tables = ("stops", "calendar_dates", "trips")

    def one_by_one(*_):
        raise AssertionError("the driver handled a new archive by itself")
    with monkeypatch.context() as m:
        m.setattr(feed_watch, "switch", one_by_one)
        m.setattr(publish, "read_manifest", one_by_one)
        feed_watch.archive_batch(batch, scratch, tables)
        got = archive.replay_snapshot(spark, scratch, ["stops", "calendar_dates"], "2024-01-01")
    assert sorted((r.stop_id, r.stop_name) for r in got["stops"].collect()) == (
        [("b", None)] * 20 + [("d", "x")] * 20)
    assert got["calendar_dates"].count() == 0 and "date" in got["calendar_dates"].columns
    feed_watch.archive_batch(batch, scratch, tables)      # delivered again: replaced
    again = archive.replay_snapshot(spark, scratch, ["stops"], "2024-01-01")["stops"]
    assert again.count() == 40


def test_changed_input_is_loaded_again(spark, scratch):
    import shutil
    here = os.path.join(scratch, "sf")
    os.makedirs(here)
    for t in ("region", "nation", "supplier", "customer", "orders", "lineitem"):
        shutil.copyfile(f"/root/testdata/sf0.001/{t}.parquet", f"{here}/{t}.parquet")
    assert stored_raw_feed(spark, here)["stops"].count() == 10
    one = spark.read.parquet(f"{here}/supplier.parquet").toPandas().head(3)
    one.to_parquet(f"{here}/supplier.parquet")
    assert stored_raw_feed(spark, here)["stops"].count() == 3


def test_source_files_are_kept(spark, scratch):
    feed = os.path.join(scratch, "feed")
    _zip(f"{feed}/a.zip", {"stops.txt": STOPS_TXT})
    (kept,) = archive_source(spark, f"{feed}/a.zip", os.path.join(scratch, "archive"), "2024-01-01")
    assert "/_source/snapshot_date=2024-01-01/" in kept
    assert [f.size for f in files.list_files(spark, kept)] == [os.path.getsize(f"{feed}/a.zip")]


def test_files_are_copied_by_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(files, "BLOCK", 1000)
    held = {"a.bin": os.urandom(4321), "b c=%20é#.csv": b"x", "x/a.bin": b"other", "x/y/empty": b"",
            "_hidden": b"no"}
    for name, data in held.items():
        path = os.path.join(scratch, "in", name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
    out = os.path.join(scratch, "out")
    for _ in range(2):      # again over the first copies
        kept = files.copy_into(spark, os.path.join(scratch, "in"), out)
        found = {os.path.relpath(os.path.join(d, n), out): open(os.path.join(d, n), "rb").read()
                 for d, _, names in os.walk(out) for n in names if not n.endswith(".crc")}
        assert found == {n: data for n, data in held.items() if n != "_hidden"}
        assert len(kept) == 4
    driver = os.path.join(scratch, "by_driver")
    monkeypatch.setattr(files, "TASK_SCHEMES", ())
    files.copy_into(spark, os.path.join(scratch, "in"), driver)
    assert open(os.path.join(driver, "x", "a.bin"), "rb").read() == b"other"
    assert files.copy_into(spark, os.path.join(scratch, "nothing"), out) == []


def test_zip_keeps_every_column_in_chunks(spark, scratch):
    root = os.path.join(scratch, "zips")
    rows = "".join(f"S{i},n{i},{i % 3}\n" for i in range(50))
    _zip(f"{root}/a.zip", {"stops.txt": "stop_id,stop_name,platform_code\n" + rows,
                           "routes.txt": 'route_id,"long\nname"\nR,\n'})
    found = ZipTables(list_archives(spark, root), ("stops", "routes", "trips"), chunk=7)
    got = found.table("stops").collect()
    assert sorted(r.stop_id for r in got) == sorted(f"S{i}" for i in range(50))
    assert all(r.platform_code == str(int(r.stop_id[1:]) % 3) for r in got)
    assert found.table("routes").first()["long\nname"] is None
    status = {r.table_name: (r.status, r.rows) for r in found.manifest().collect()}
    assert status == {"stops": ("loaded", 50), "routes": ("loaded", 1), "trips": ("skipped", None)}
    _zip(f"{root}/b.zip", {"stops.txt": "stop_id\nA,too,many\n"})
    with pytest.raises(Exception):
        ZipTables(list_archives(spark, root), ("stops",))


@pytest.mark.parametrize("by_content", [False, True])
def test_members_of_one_archive_are_read_by_several_tasks(spark, scratch, by_content):
    from pyspark.sql import functions as F

    from headway.sources.zipfeed import members
    path = os.path.join(scratch, "zips", "a =%20é#.zip")
    os.makedirs(os.path.dirname(path))
    texts = {t: f"{t}_id,note\n" + "".join(f"{t}{i},{'é' * (i % 90)}\n" for i in range(4000))
             for t in ("stops", "routes", "trips", "shapes", "calendar", "agency")}
    kinds = [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED, zipfile.ZIP_BZIP2]
    with zipfile.ZipFile(path, "w") as zf:
        for i, (t, text) in enumerate(texts.items()):
            zf.writestr(f"feed/{t}.txt", text, compress_type=kinds[i % 3])
        zf.writestr("feed/frequencies.txt", "")
    archives = list_archives(spark, os.path.dirname(path))
    assert "content" not in archives.columns
    if by_content:
        archives = spark.read.format("binaryFile").load(os.path.dirname(path))
    cut = members(archives, tuple(texts))
    assert cut.count() == 6 and cut.select(F.spark_partition_id()).distinct().count() > 1
    found = ZipTables(archives, (*texts, "frequencies"), chunk=1000)
    for t in texts:
        rows = {r[f"{t}_id"]: r.note for r in found.table(t).select(f"{t}_id", "note").collect()}
        assert rows == {f"{t}{i}": "é" * (i % 90) or None for i in range(4000)}
    assert found.table("frequencies").count() == 0


def test_a_damaged_member_is_an_error(spark, scratch):
    path = os.path.join(scratch, "zips", "a.zip")
    _zip(path, {"stops.txt": "stop_id,stop_name\n" + "A,one\n" * 50})
    held = bytearray(open(path, "rb").read())
    held[45] ^= 1
    with open(path, "wb") as f:
        f.write(held)
    with pytest.raises(Exception):
        ZipTables(list_archives(spark, os.path.dirname(path)), ("stops",))
