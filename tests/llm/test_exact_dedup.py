import collections
import hashlib

from headway.llm.exact_dedup import dedup_decisions, drop_copies
from pyspark.sql import functions as F

from .conftest import EXTRA, ODD_ROWS


def brute(rows):
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not seen,
                        hashlib.sha256(t.encode()).hexdigest()))
            seen = seen or i == keep
    return sorted(out, key=repr)


def test_decisions_match_brute_force(documents):
    rows = ODD_ROWS + [(100 + i, f"text {i % 40}", "en", "s") for i in range(400)]
    df = dedup_decisions(documents(rows, extra=True), carry={
        "text_sha256": F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)})
    got = sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept",
                                              "text_sha256").collect()), key=repr)
    assert got == brute(rows)


def test_texts_that_share_length_and_prefix_stay_apart(documents):
    long = "p" * 400
    rows = [(1, long + "a", "en", "s"), (2, long + "b", "en", "s"), (3, long + "a", "en", "s")]
    kept = drop_copies(documents(rows)).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3]


def test_drop_copies_keeps_one_row_of_each_text(documents):
    kept = drop_copies(documents(ODD_ROWS, extra=True))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", *EXTRA]
    rows = kept.collect()
    texts = [r.text or "" for r in rows]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t, *_ in ODD_ROWS})
    assert {(r.doc_id, r.lang) for r in rows if r.text == "same text here"} == {(5, "aa")}
    assert {r.doc_id for r in rows if not r.text} == {3}


def test_empty_table(documents):
    assert dedup_decisions(documents([])).collect() == []
    assert drop_copies(documents([])).collect() == []
