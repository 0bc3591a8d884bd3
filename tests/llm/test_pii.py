import hashlib
import re

from headway.llm import pii

from .conftest import ODD_ROWS

SF = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          lambda m: all(int(p) <= 255 for p in m[0].split("."))),
         ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p, ok in KINDS for m in re.finditer(p, text or "") if ok(m)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in spans).encode()).hexdigest()


TEXTS = [
    "é🎉 a.b+c@d-e.f.g, x@y z@ @q.r a@b.c@d.e", "a@b.c_d@e.f.g %@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1",
    "1.2.3 00000000000001.2.3.4 999999999999999999999.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "41111111111111114111 4495114827612972", "+1 (274) 555-9629. +12345678 +123456789 +1234567890123456",
    "call +1 (274) 555-9629 or (274) 555-9629", "1.1.1.1" * 4, "x" * 3000 + "@", "9" * 3000, "a" * 2000 + "@b.c",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "a.b@c" + ".d" * 3000, "+1-" * 400,
]


def test_base_spans_match_brute_force(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (documents([(i, t, "en", "s") for i, t in enumerate(TEXTS)], extra=True), docs):
        texts = {r.doc_id: r.text for r in df.collect()}
        got = pii.pii_report(df).collect()
        assert len(got) == len(texts)
        for r in got:
            want = base_spans(texts[r.doc_id])
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
                sum(s[0] == k for s in want) for k, _, _ in KINDS], texts[r.doc_id][:80]
            assert r.base_sha256 == digest(want)
            listed = r.spans.split(",") if r.spans else []
            base = [s for s in listed if s.split(":")[0] in {k for k, _, _ in KINDS}]
            assert base == [f"{k}:{a}:{z}" for k, a, z in want]
            assert len(listed) - len(base) == r.n_added


def test_trees_tell_held_out_spans_apart(spark):
    """Held-out accuracy against the checks, on spans the trees haven't seen."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = pii.scanned(docs, pii.KINDS, docs["text"], id=docs["doc_id"])
    spans = pii.stored(pii.described(pii.matches(rows, pii.KINDS)), "spans")
    trees, threshold = pii.fit(spans)
    held = pii.scored(spans.where("label IS NOT NULL AND pmod(turn, 100) < 30"), trees).toPandas()
    said = held["score"] >= threshold
    assert len(held) > 25 and 0 < held["label"].mean() < 1
    assert (held["label"][said] == 1).mean() >= 0.95
    assert said[held["label"] == 1].mean() >= 0.9


def test_added_spans_are_chosen_by_score_and_never_overlap(spark):
    schema = "row long, kind string, `order` int, start long, `end` long, base boolean"
    spans = spark.createDataFrame([(1, "card", 2, 10, 20, True), (1, "phone", 3, 18, 25, True)], schema)
    assert pii.added(spans, None).count() == 2


def test_numbers_within_runs_are_proposed_and_chosen(documents, monkeypatch):
    texts = [("10.0.0.1 555-123-4567 x", ["555-123-4567"]), ("2024-03-05 555 123 4567", ["2024-03-05", "555 123 4567"]),
             ("é 17 (274) 555-9629", ["(274) 555-9629"]), ("a 555-123-4567 555-987-6543.",
                                                          ["555-123-4567", "555-987-6543"])]
    df = documents([(i, t, "en", "s") for i, (t, _) in enumerate(texts)])
    rows = pii.scanned(df, pii.KINDS, df["text"], id=df["doc_id"])
    found = pii.proposed(rows)
    ids = {r.row: r.id for r in rows.select("row", "id").collect()}
    each = found.collect()
    for r in each:
        t = texts[ids[r.row]][0]
        assert t[r.start:r.end] == r.match and t[:r.start].endswith(r.before), r
        assert r.before == t[max(0, r.start - 32):r.start] and r.after == t[r.end:r.end + 32], r
    assert len({(r.row, r.kind, r.start, r.end) for r in each}) == len(each)
    monkeypatch.setattr(pii, "scored", lambda rows, trees: rows.selectExpr("*", "0.99 AS score"))
    got = {i: [] for i in range(len(texts))}
    for r in pii.added(pii.described(found), (None, 0.5)).where("kind = 'number'").collect():
        got[ids[r.row]].append((r.start, texts[ids[r.row]][0][r.start:r.end]))
    assert [[m for _, m in sorted(v)] for v in got.values()] == [w for _, w in texts]


def test_dates_are_not_cut_and_whole_accounts_are_taken(documents, monkeypatch):
    texts = [("order no 2024-03-05 12345678", ["2024-03-05", "12345678"]),
             ("on 15.3.2024 555 123 4568", ["15.3.2024", "555 123 4568"]),
             ("IBAN GB82 WEST 1234 5698 7654 32 x", ["GB82 WEST 1234 5698 7654 32"]),
             ("IBAN DE89370400440532013000", ["DE89370400440532013000"])]
    df = documents([(i, t, "en", "s") for i, (t, _) in enumerate(texts)])
    rows = pii.scanned(df, pii.KINDS, df["text"], id=df["doc_id"])
    ids = {r.row: r.id for r in rows.select("row", "id").collect()}
    spans = pii.described(pii.proposed(rows))
    monkeypatch.setattr(pii, "scored", lambda rows, trees: rows.selectExpr("*", "0.9 AS score"))
    got = {i: [] for i in range(len(texts))}
    for r in pii.added(spans, (None, 0.5)).where("NOT base").collect():
        got[ids[r.row]].append((r.start, texts[ids[r.row]][0][r.start:r.end]))
    assert [[m for _, m in sorted(v)] for v in got.values()] == [w for _, w in texts]
    label = {(ids[r.row], r.start): r.label for r in spans.where("label IS NOT NULL").collect()}
    assert (label[0, 9], label[1, 3], label[2, 5], label[3, 5]) == (0, 0, 1, 1)


def greedy(spans):
    """The best of ``spans`` (start, end, score), then the best that overlaps none taken."""
    out = []
    for s in spans:
        if all(s[0] >= t[1] or t[0] >= s[1] for t in out):
            out.append(s)
    return out


def test_large_sets_are_chosen_from_like_small_ones(spark, monkeypatch):
    import random

    from pyspark.sql import functions as F
    rng = random.Random(5)
    rows = []
    for row in range(6):
        seen = set()
        for _ in range(rng.choice([1, 3, 150])):
            start = rng.randrange(60 if row % 2 else 400)
            seen.add((start, start + rng.choice([3, 7, 7, 12, 200])))
        rows += [(row, 0, "number", 4, a, z, rng.choice([0.9, 0.95, 0.99])) for a, z in seen]
    rows += [(9, 0, "number", 4, 5 * i, 5 * i + 14, 0.9) for i in range(300)]   # all equal
    sets = spark.createDataFrame(rows, "row long, `set` long, kind string, `order` int, start long, "
                                       "`end` long, score double")
    sets = sets.selectExpr("*", *[f"0.0D AS {c}" for c in pii.TIES])
    value = [-F.col("score"), F.col("start") - F.col("end"), F.xxhash64("start"), F.col("start")]
    want = {row: greedy([(r.start, r.end) for r in sets.where(F.col("row") == row).orderBy(*value).collect()])
            for row in {r[0] for r in rows}}
    for limit in (1, 40, 1000):
        monkeypatch.setattr(pii, "SET_ROWS", limit)
        got = {row: [] for row in want}
        for r in pii.best_apart(sets).collect():
            got[r.row].append((r.start, r.end))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_one_long_run_of_numbers(documents, monkeypatch):
    """Every group of a run that fits a span is covered, in time in line with the run."""
    text = " ".join(str(1000 + i * 7919 % 9000) for i in range(20000))
    df = documents([(1, text, "en", "s"), (2, "call 555 123 4567", "en", "s")])
    rows = pii.scanned(df, pii.KINDS, df["text"], id=df["doc_id"])
    spans = pii.stored(pii.described(pii.proposed(rows)), "spans")
    monkeypatch.setattr(pii, "scored", lambda rows, trees: rows.selectExpr(
        "*", "IF(f_digits > 19, 0.1D, 0.9D) AS score"))
    long = rows.where("id = 1").first().row
    got = sorted((r.start, r.end) for r in pii.added(spans, (None, 0.5)).collect() if r.row == long)
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:]))
    left = [text[a:b] for a, b in zip([0] + [z for _, z in got], [a for a, _ in got] + [len(text)])]
    assert all(sum(c.isdigit() for c in g) < 7 for g in left)


def test_nothing_to_learn_from(documents):
    out = pii.pii_report(documents(ODD_ROWS, extra=True)).collect()
    assert len(out) == len(ODD_ROWS)
    assert {(r.spans, r.base_sha256, r.n_added) for r in out} == {("", digest([]), 0)}
    assert pii.pii_report(documents([])).collect() == []
    one = pii.pii_report(documents([(1, "mail a@b.cd now", "en", "s")])).collect()[0]
    assert one.spans == "email:5:11"


def test_trees_are_fitted_on_every_labelled_span(spark, monkeypatch):
    kept, stored = {}, pii.stored
    monkeypatch.setattr(pii, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    spans = spark.range(9000).selectExpr(
        "id AS turn", "0L AS row", "id AS start", "CAST(id % 2 AS DOUBLE) AS label",
        *[f"CAST(id % {n + 2} AS DOUBLE) AS {name}" for n, name in enumerate(pii.FEATURES)])
    trees, _ = pii.fit(spans)
    assert kept["fit"].agg({"weight": "sum"}).first()[0] == 9000
    assert kept["fit"].where("own").agg({"weight": "sum"}).first()[0] == 6300
