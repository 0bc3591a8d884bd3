import collections
import re

import numpy as np
import pytest

from headway.llm import quality_rules as q

from .conftest import EXTRA, LONG, ODD_ROWS

W = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(W, text)
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
               for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(W, line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


@pytest.mark.parametrize("text", [None, "", " \n", "a", "a b c a b c", "a a a a", "x\nx\n x\n\n \n",
                                  "é# b | c\x85d <e>\x0bé# b | c\x85d", LONG[:9000],
                                  "a b c d a b c", "a b\na b\n\ta b"])
def test_measures_match_brute_force(text):
    assert q.measure_text(text)[:5] == brute(text)


def prose(i, n=120):
    rng = np.random.default_rng(i)
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 8)))
                    for _ in range(n))


def test_outliers_of_their_group_go_and_others_stay(documents):
    rows = [(i, prose(i), "en", "a") for i in range(300)]
    # In source t, tables are usual: the same rate is no outlier there.
    rows += [(1000 + i, prose(i).replace(" ", " | "), "en", "t") for i in range(300)]
    rows += [(5000, prose(1).replace(" ", " | "), "en", "a"), (5001, prose(2).upper(), "en", "a"),
             (5002, prose(3), "xx", "rare"), (5003, "too short", "en", "a"),
             (5004, "again and again " * 60, "en", "a")]
    out = {r.doc_id: r for r in q.judge(documents(rows, extra=True)).collect()}
    assert {i for i, r in out.items() if not r.kept} == {5000, 5001, 5003, 5004}
    assert {i for i, r in out.items() if r.base_failed} == {5003, 5004}
    kept = q.keep_good(documents(rows, extra=True))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", *EXTRA]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in out.items() if r.kept)


def test_sketches_merge_to_the_sketch_of_all(spark):
    values = [int(v) for v in np.random.default_rng(1).integers(0, 5000, 4000)]
    df = spark.createDataFrame([("en", "a", v, 0, 0, 0, 0, 0) for v in values],
                               ["lang", "source", *q.METRICS])
    halves = [q.sketches(df.where("symbol_rate % 2 = 0")), q.sketches(df.where("symbol_rate % 2 = 1"))]
    both = (halves[0].unionByName(halves[1]).groupBy("lang", "source", "metric", "bin")
            .sum("n").collect())
    assert sorted(map(tuple, both)) == sorted(map(tuple, q.sketches(df).collect()))
    got = {r.metric: r for r in q._quantiles(q.sketches(df), ["lang"]).collect()}["symbol_rate"]
    assert abs(got.mid / np.quantile(values, 0.5) - 1) < 0.02
    assert abs(got.high / np.quantile(values, 0.75) - 1) < 0.02


def rates_of(text):
    words, chars, symbols, dup, repeats, caps, bangs = q.measure_text(text)
    each = {"symbol_rate": symbols, "repeat_rate": repeats, "caps_rate": caps, "bang_rate": bangs,
            "line_rate": dup}
    return {**{k: v * 1000 // words if words else 0 for k, v in each.items()},
            "word_length": chars * 100 // words if words else 0}


def brute_fences(rows):
    """Fences by sorting all values of a group."""
    def floor(v):
        keep = max(v.bit_length() - 7, 0)
        return v if v < 1024 else v >> keep << keep

    def quantile(values, percent):
        values = sorted(map(floor, values))
        return values[-(-len(values) * percent // 100) - 1]

    def drawn(own, n, towards):
        return (n * own + q.SHRINK * towards) // (n + q.SHRINK)

    rates = [(lang, source, rates_of(t)) for _, t, lang, source in rows]
    out = {}
    for lang, source in {r[:2] for r in rates}:
        for k, (percent, margin) in q.METRICS.items():
            every = [r[2][k] for r in rates]
            of_lang = [r[2][k] for r in rates if r[0] == lang]
            own = [r[2][k] for r in rates if r[:2] == (lang, source)]
            mid, high = (drawn(quantile(own, p), len(own), drawn(
                quantile(of_lang, p), len(of_lang), quantile(every, p))) for p in (50, percent))
            out[lang, source, k] = high + q.REACH * (high - mid) + margin
    return out


def test_fences_and_verdicts_against_brute_force(documents):
    rng = np.random.default_rng(5)
    rows = [(9, None, None, None), (9, LONG, None, "a"), (8, LONG, None, "a")]
    for i in range(500):
        lang, source = [("en", "a"), ("en", "b"), ("de", "a"), (None, "a"), ("en", None)][i * i % 5]
        text = prose(i, 60 + int(rng.integers(200)))
        kind = rng.integers(9) if source == "b" else rng.integers(40)
        if kind == 0:
            text = text.replace(" ", " & ", int(rng.integers(100)))
        if kind == 1:
            text = text.upper().replace(" ", "!! ", int(rng.integers(80)))
        if kind == 2:
            text = text + ("\n" + text[:50]) * int(rng.integers(20))
        if kind == 3:
            text = text.replace(" ", "", int(rng.integers(40)))
        rows.append((100 + i, text, lang, source))
    want = brute_fences(rows)
    measured = q.judge(documents(rows, extra=True)).collect()
    kept = collections.Counter()
    for _, t, lang, source in rows:
        ok = all(v <= want[lang, source, k] for k, v in rates_of(t).items())
        m = q.measure_text(t)
        kept[(*m[:5], ok and m[0] >= 50 and 100 * m[4] <= 50 * m[0])] += 1
    assert collections.Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                                r.n_repeat_words, r.kept) for r in measured) == kept
    assert len({want[g, s, "word_length"] for g, s, k in want}) > 2
    assert 0 < sum(not r.kept and not r.base_failed for r in measured) < 100


def test_good_texts_of_the_test_tables_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    rows = q.judge(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    assert len(rows) > 300 and all(r.kept for r in rows)


def test_odd_rows(documents):
    out = q.judge(documents(ODD_ROWS, extra=True)).collect()
    assert len(out) == len(ODD_ROWS)
    assert all(r.base_failed and not r.kept for r in out if r.n_words < 50)
    assert q.judge(documents([])).collect() == [] and q.keep_good(documents([])).collect() == []
