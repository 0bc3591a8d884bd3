import numpy as np
import pytest

from headway.llm import language as lg
from headway.llm.queries import op2_language_id

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def found(spark):
    return op2_language_id(spark, SF).toPandas()


def test_every_row_once(spark, found):
    for kind, name, key in (("document", "documents", "doc_id"), ("page", "pages", "page_id")):
        ids = spark.read.parquet(f"{SF}/{name}.parquet").select(key).toPandas()[key]
        got = found[found["kind"] == kind]
        assert sorted(got[key]) == sorted(ids)
        assert got["prob"].between(0.2, 1).all()


def test_accuracy_on_rows_outside_the_sample(spark, monkeypatch):
    monkeypatch.setattr(lg, "SAMPLE", 60)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trained = {t for t in lg.sample(docs.selectExpr("doc_id AS id", "text", "lang")).toPandas()["text"]}
    got = op2_language_id(spark, SF).where("kind = 'document'").toPandas().merge(
        docs.toPandas(), on="doc_id", suffixes=("", "_label"))
    held = got[~got["text"].isin(trained)]
    assert len(held) > 500
    assert (held["lang"] == held["lang_label"]).mean() > 0.97


def test_page_languages_follow_the_declared_ones(spark, found):
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas().merge(found, on="page_id")
    declared = pages["html"].str.extract(r'<html lang="(\w+)"')[0]
    assert (declared == pages["lang"]).mean() > 0.97


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id AS id", "text", "lang")


SCHEMA = "id long, text string, markup boolean, declared string, host string, domain string, suffix string"


def test_weak_text_is_decided_by_other_evidence(spark, labelled):
    text = {r.lang: r.text for r in labelled.collect() if len(r.text) > 400}
    rows = [(i, text["de"], False, "de", "www.a.de", "a.de", "de") for i in range(30)]
    rows += [(100 + i, text["fr"], False, "fr", "www.b.fr", "b.fr", "fr") for i in range(30)]
    rows += [(1000, "", False, "de", None, None, None), (1001, None, True, None, "www.b.fr", "b.fr", None),
             (1002, "", False, None, "new.a.de", "a.de", None), (1003, "", False, None, None, None, "fr"),
             (1004, text["fr"], False, "de", "www.a.de", "a.de", "de"), (None, None, None, None, None, None, None),
             (None, None, None, None, None, None, None)]
    got = {r.id: r for r in lg.identify(spark.createDataFrame(rows, SCHEMA), labelled, ["id"]).collect()}
    assert [got[i].lang for i in (1000, 1001, 1002, 1003)] == ["de", "fr", "de", "fr"]
    assert got[1004].text_lang == got[1004].lang == "fr"     # clear text outweighs the rest
    assert got[None].lang in ("de", "fr")


def test_empty_tables(spark, labelled):
    empty = spark.createDataFrame([], SCHEMA)
    assert lg.identify(empty, labelled, ["id"]).collect() == []
    some = spark.createDataFrame([(1, "x", False, None, None, None, None)], SCHEMA)
    assert [tuple(r) for r in lg.identify(some, labelled.limit(0), ["id"]).collect()] == [(1, None, None, None)]


def test_sample_is_bounded_and_whole(spark, labelled, monkeypatch):
    monkeypatch.setattr(lg, "SAMPLE", 5)
    rows = lg.sample(labelled).collect()
    assert sorted({r.lang for r in rows}) == ["de", "en", "es", "fr"] and len(rows) == 20
    whole = {r.text for r in labelled.collect()}
    assert all(r.text in whole for r in rows)


def test_trigram_buckets():
    assert len(lg.trigrams("")) == len(lg.trigrams(None)) == len(lg.trigrams("12 ,.")) == 0
    assert np.array_equal(lg.trigrams("Ab c"), lg.trigrams(" aB\nC "))
    assert len(lg.trigrams("ab")) == 2


def test_markup_goes_as_by_a_pattern():
    import random
    import re

    from headway.llm.language import without_markup
    pattern = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
    rng = random.Random(2)
    pieces = ["<", ">", "<!--", "-->", "<script", "</script >", "<STYLE>", "</style>", "a", " ", "<p x>", "--"]
    for _ in range(3000):
        html = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert without_markup(html) == pattern.sub(" ", html), html
