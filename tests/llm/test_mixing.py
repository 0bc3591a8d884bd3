import collections

import duckdb
import pytest

from headway.llm import queries
from headway.llm.mixing import mix, mix_plan

from .conftest import EXTRA, ODD_ROWS


def some(n=600):
    return [(i, "w " * (1 + (i * 7919) % 60), "en", None if i % 11 == 0 else "hot" if i % 3 else
             f"s{i % 5}") for i in range(n)]


def test_plan_matches_sql(spark, documents):
    rows = some() + ODD_ROWS
    con = duckdb.connect()
    con.register("documents", documents(rows).toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(queries.ORACLE_SQL["op4_source_mixing"]).fetchall()
    got = [tuple(r) for r in mix_plan(documents(rows, extra=True)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_taken_words_come_near_targets_and_no_document_exceeds_twice_its_size(documents):
    by = collections.defaultdict(list)
    for r in mix_plan(documents(some())).collect():
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]
        by[r.target, r.source_size].append(r.taken)
    for (target, size), taken in by.items():
        assert target <= 2 * size
        assert abs(sum(taken) - target) <= 2 * 60


def test_reruns_agree_and_partitions_do_not_matter(documents):
    df = documents(some())
    one = sorted(map(tuple, mix_plan(df).collect()))
    assert one == sorted(map(tuple, mix_plan(df.repartition(7)).collect()))


def test_mix_emits_rows_as_planned(documents):
    rows = some(200) + ODD_ROWS
    df = documents(rows, extra=True)
    plan = collections.Counter()
    for r in mix_plan(df).collect():
        plan[r.doc_id] += r.copies
    out = mix(df)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *EXTRA]
    got = collections.Counter(r.doc_id for r in out.collect())
    assert got == +plan


@pytest.mark.parametrize("rows", [[], [(1, None, "en", "a")], [(1, "", None, None)]])
def test_no_words(documents, rows):
    assert [r.taken for r in mix_plan(documents(rows)).collect()] == [0] * len(rows)
    assert mix(documents(rows)).count() == 0
