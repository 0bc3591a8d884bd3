"""Records of files that many tasks read, against Python's csv module."""
import csv
import io
import os
import random

import pytest

from headway.sources import records
from headway.sources.feed import read_feed_snapshots, read_feed_table

FIELDS = ("plain", "", "two\nlines", 'a "quoted" word', "a,b", "\n", '"', '""\n"', ",\n,", "é\r\nb",
          "x" * 40, "\n\n\n", '",', ',"')


@pytest.fixture
def small_splits(spark):
    """Every task reads a few dozen bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    held = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "23")
    yield
    for n, value in held.items():
        spark.conf.set(n, value)


def _text(rows, end="\n", always=False):
    out = io.StringIO()
    csv.writer(out, lineterminator=end,
               quoting=csv.QUOTE_ALL if always else csv.QUOTE_MINIMAL).writerows(rows)
    return out.getvalue()


def _file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}.txt"
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


def _rows(df, names):
    return sorted(tuple(r[n] or "" for n in names) for r in df.collect())


NAMES = ["trip_id", "stop_id", "stop_headsign"]


@pytest.mark.parametrize("end,always", [("\n", False), ("\r\n", True)])
def test_newlines_at_every_bound(spark, scratch, small_splits, end, always):
    rng = random.Random(len(end))
    rows = [(f"T{i}", rng.choice(FIELDS), rng.choice(FIELDS)) for i in range(150)]
    path = _file(scratch, "stop_times", _text([NAMES, *rows], end, always))
    df = read_feed_table(spark, path, "stop_times")
    assert records.lines(spark, [path]).rdd.getNumPartitions() > 50
    assert _rows(df, NAMES) == sorted(rows)


def test_one_field_longer_than_many_splits(spark, scratch, small_splits):
    long = "\n".join(f'line {i}, "{i}"' for i in range(60))
    rows = [("A", "1", long), ("B", "2", ""), ("C", "3", long + "\n")]
    path = _file(scratch, "stop_times", "﻿" + _text([NAMES, *rows]))
    assert _rows(read_feed_table(spark, path, "stop_times"), NAMES) == rows


def test_quotes_within_plain_fields_are_characters(spark, scratch, small_splits):
    path = _file(scratch, "stop_times", 'trip_id,stop_id,stop_headsign\n'
                 'A,5" pipe,x\nB,7"" pipe,"two\nlines"\nC,"q",6" and 7"\n')
    assert _rows(read_feed_table(spark, path, "stop_times"), NAMES) == [
        ("A", '5" pipe', "x"), ("B", '7"" pipe', "two\nlines"), ("C", "q", '6" and 7"')]


def test_files_of_one_line_records_go_to_the_plain_reader(spark, scratch):
    one = _file(scratch, "a", _text([NAMES, ("A", 'with "q"', "x,y")]))
    two = _file(scratch, "b", _text([NAMES, ("B", "1", "a\nb")]))
    seen = records.scan(spark, [one, two, _file(scratch, "c", "")])
    assert [(os.path.basename(s.path), s.one_line, s.names) for s in seen] == [
        ("a.txt", True, tuple(NAMES)), ("b.txt", False, tuple(NAMES))]
    df = read_feed_table(spark, f"{scratch}/*.txt", "stop_times")
    assert _rows(df, NAMES) == [("A", 'with "q"', "x,y"), ("B", "1", "a\nb")]


def test_headers_and_snapshots_of_several_forms(spark, scratch, small_splits):
    texts = {"2024-01-01": _text([["stop_id", "stop_name"], ("A", "one\ntwo")]),
             "2024-01-02": _text([["stop_name", "stop\nnote", "stop_id"], ("B\nb", "n", "B")]),
             "2024-01-03": _text([["stop_id", "stop_name"], ("C", "plain")]),
             "2024-01-04": "", "2024-01-05": "stop_id,stop_name\n\n \n"}
    for date, text in texts.items():
        _file(f"{scratch}/snapshot_date={date}", "stops", text)
    stops = read_feed_snapshots(spark, scratch, ("stops",))["stops"]
    got = {(r.stop_id, r.stop_name, r["stop\nnote"], r.snapshot_date) for r in stops.collect()}
    assert got == {("A", "one\ntwo", None, "2024-01-01"), ("B", "B\nb", "n", "2024-01-02"),
                   ("C", "plain", None, "2024-01-03")}


def test_records_of_wrong_width_fail_alike(spark, scratch):
    for name, field in (("a", "x"), ("b", '"x\ny"')):
        path = _file(scratch, name, f"trip_id,stop_id\nT,{field}\nT,{field},more\n")
        with pytest.raises(Exception, match="(?i)malformed"):
            read_feed_table(spark, path, "stop_times").collect()


def test_records_are_cut_in_chunks_without_moving_lines(spark, scratch, monkeypatch):
    rows = [(f"T{i}", FIELDS[i % len(FIELDS)], "two\nlines") for i in range(300)]
    path = _file(scratch, "stop_times", _text([NAMES, *rows]))
    monkeypatch.setattr(records, "CHUNK", 50)
    found = records.records(spark, [path])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan
    assert _rows(records.parsed(found, NAMES), NAMES) == sorted(rows)


def test_the_first_pass_keeps_a_row_per_split(spark, scratch):
    path = _file(scratch, "stop_times", _text([NAMES, *[(f"T{i}", "a", "b") for i in range(500)]]))
    seen = records.splits(spark, [path])
    assert "Sort" not in seen._jdf.queryExecution().executedPlan().toString()
    assert [(bytes(r["first"]).decode(), r.opens, r.odd) for r in seen.collect()] == [
        (",".join(NAMES), False, False)]
    assert [s.one_line for s in records.scan(spark, [path])] == [True]
