import os
import shutil
import subprocess
import sys

import duckdb

import __spark_entry__ as entry
from headway.plans import catalog

SMOKE = "/root/testdata/sf0.001"
VIEWS = ("region", "nation", "supplier", "customer", "orders", "lineitem", "events")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["service_date", "hour_of_day", "service_category", "arrivals_count"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())
    assert len(entry.queries()) >= 43


def test_queries_match_duckdb_on_smoke_tables(spark):
    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name in ("service_calendar", "dim_service", "route_summary", "daily_stop_arrivals",
                 "busiest_stops", "service_frequency_tiers", "dq_relationships"):
        df = entry.queries()[name](spark, SMOKE)
        got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
        res = con.execute(entry.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        want = sorted((tuple(r[i] for i in order) for r in res.fetchall()), key=repr)
        assert got == want, name


def test_entry_works_without_the_optional_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/headway", tmp_path / "headway",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True,
                         capture_output=True, text=True).stdout
    assert out.split() == [str(len(catalog.queries()))] * 2
