import collections
import itertools

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from headway.llm import byte_bpe, quality_rules, queries
from headway.llm.tables import stored

from .test_byte_bpe import reference
from .test_quality_rules import brute as brute_measures
from .test_simhash import brute_fingerprint, brute_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents and each stage's result, as the pipeline hands them on."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(stored(stage(spark, out[-1], SF), f"stage{i}"))
    return out


def rows(df):
    return df.collect()


def test_stages_return_the_columns_of_documents(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in stages[0].schema]


def test_quality_rules_follow_the_verdicts(stages):
    kept = {r.doc_id for r in rows(stages[1])}
    verdict = {r.doc_id: r.kept for r in rows(quality_rules.judge(stages[0]))}
    assert kept == {i for i, k in verdict.items() if k}
    for r in rows(stages[0]):
        n_words, *_, n_repeat = brute_measures(r.text)
        if n_words < 50 or 100 * n_repeat > 50 * n_words:
            assert r.doc_id not in kept


def test_exact_dedup_keeps_the_largest_id_of_each_text(stages):
    best = {}
    for r in rows(stages[1]):
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    assert {r.text: r.doc_id for r in rows(stages[2])} == best
    assert stages[2].count() == len(best)


def test_near_dedup_keeps_the_least_id_of_each_group(stages):
    docs = sorted(rows(stages[2]), key=lambda r: r.doc_id)
    groups = brute_groups([brute_fingerprint(r.text) for r in docs])
    want = [min(docs[i].doc_id for i in members) for members in
            ([i for i, g in enumerate(groups) if g == own] for own in set(groups))]
    assert sorted(r.doc_id for r in rows(stages[3])) == sorted(want)


def test_mixing_follows_the_sql_plan(stages):
    con = duckdb.connect()
    con.register("documents", stages[3].toPandas())
    plan = con.execute(queries.ORACLE_SQL["op4_source_mixing"]).df()
    want = {r.doc_id: r.copies for r in plan.itertuples() if r.copies}
    assert collections.Counter(r.doc_id for r in rows(stages[4])) == want
    texts = {r.doc_id: r.text for r in rows(stages[3])}
    assert all(texts[r.doc_id] == r.text for r in rows(stages[4]))


def test_ids_are_another_librarys_and_decode_to_the_texts(stages):
    own = reference()
    texts = {r.doc_id: r.text for r in rows(stages[4])}
    assert stages[5].count() == stages[4].count()
    for r in rows(stages[5]):
        assert r.ids == own.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids)
        assert byte_bpe.decode_ids(np.array(r.ids), *byte_bpe.files(None, None)) == \
            texts[r.doc_id].encode()
        assert len(r.char_start) == len(r.char_end) == len(r.ids)


def test_run_gives_the_last_stage(spark, stages):
    def key(df):
        return sorted((r.doc_id, r.n_tokens, tuple(r.ids)) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[-1])


def test_stages_take_odd_and_empty_tables(spark, documents):
    from .conftest import ODD_ROWS
    for data in (ODD_ROWS, []):
        for (_, stage), _ in zip(corpus_pipeline.STAGES, itertools.count()):
            stage(spark, documents(data), SF).collect()
