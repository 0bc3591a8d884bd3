import itertools
import random

import numpy as np
import pytest
import xxhash

from headway.llm import simhash
from headway.llm.tables import stored

from .conftest import EXTRA, LONG, ODD_ROWS


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(fps, distance=2):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= distance:
            a, b = sorted((root(i), root(j)))
            label[b] = a
    return [root(i) for i in range(len(fps))]


def clustered(n, seed=1):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(max(1, n // 30))]
    out = set()
    while len(out) < n:
        fp = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            fp ^= 1 << rng.randrange(64)
        out.add(fp)
    return sorted(out)


def test_fingerprints_match_brute_force():
    for text in ["", " ", None, "One", "one TWO", "a b c", "a b c a b c a b c", "É A\x85B c d e f",
                 LONG[:4000], "ÀB c\x0bd\x0ce f g"]:
        assert simhash.fingerprint(text) % (1 << 64) == brute_fingerprint(text), text


@pytest.mark.parametrize("n", [2, 17, 300, 3000])
def test_hierarchy_finds_every_linked_pair(n):
    values = np.array(clustered(n), np.uint64)
    values = values[np.argsort(simhash.gray_rank(values))]
    got = {(int(a), int(b)) for x, y in simhash.linked_pairs(values) for a, b in zip(x, y)}
    diff = np.bitwise_count(values[:, None] ^ values[None, :])
    want = {(int(a), int(b)) for a, b in np.argwhere(diff <= 2) if a < b}
    assert got == want


@pytest.mark.parametrize("leaf_rows", [4096, 16])
def test_groups_match_brute_force(spark, leaf_rows):
    fps = clustered(700, seed=3)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    prints = stored(spark.createDataFrame([(i, f) for i, f in enumerate(signed)],
                                          "id long, fp long"), "prints")
    got = {r.fp: r.root for r in simhash.roots(prints, leaf_rows=leaf_rows).collect()}
    want = brute_groups(fps)
    for i, j in itertools.combinations(range(len(fps)), 2):
        assert (got[signed[i]] == got[signed[j]]) == (want[i] == want[j])
    for g in set(want):
        members = [signed[i] for i, w in enumerate(want) if w == g]
        assert {got[m] for m in members} == {min(members)}


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)],
                                  "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_query_matches_brute_force_on_odd_rows(documents):
    rows = [r for r in ODD_ROWS]
    got = sorted(map(repr, ((r.doc_id, r.fingerprint, r.component_id) for r in
                            simhash.near_groups(documents(rows, extra=True)).collect())))
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    label = brute_groups(fps)
    want = []
    for (i, *_), fp, own in zip(rows, fps, label):
        ids = [r[0] for r, other in zip(rows, label) if other == own and r[0] is not None]
        want.append(repr((i, f"{fp:016x}", min(ids, default=None))))
    assert got == sorted(want)


def test_one_document_of_each_group_stays(documents):
    out = simhash.drop_near_copies(documents(ODD_ROWS, extra=True))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", *EXTRA]
    groups = {}
    for (i, t, *_), own in zip(ODD_ROWS, brute_groups([brute_fingerprint(t) for _, t, *_ in ODD_ROWS])):
        groups.setdefault(own, []).append(i)
    want = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(documents):
    assert simhash.near_groups(documents([])).collect() == []
    assert simhash.drop_near_copies(documents([])).collect() == []
