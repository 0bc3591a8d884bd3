import hashlib
import random
import re
import zlib

import pytest
from headway.llm import prefix_trie
from headway.llm.prefix_trie import ROOT_KEY, decompose, rebuilt, trie, turn_rows

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(turns):
    convs = {}
    for c, t, role, text in turns:
        if c is not None:
            convs.setdefault(c, []).append((t, role or "", text or ""))
    for c, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(*r[1:])))
        convs[c] = [r[1:] for r in rows]
    whole = {}
    for c, rows in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole[c] = tuple(convs.get(base, [])[:h] + rows[h:])
    nodes = {(): list(whole)}
    for c, rows in whole.items():
        for d in range(1, len(rows) + 1):
            nodes.setdefault(rows[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        inside = [p for p in nodes if p[:len(path)] == path]
        leaf = [p for p in inside if not any(len(q) == len(p) + 1 and q[:len(p)] == p
                                             for q in nodes)]
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in inside]
        ends = ",".join(str(c) for c in sorted(c for c in members if whole[c] == path))
        out.append((min(members, default=None), len(path),
                    min(nodes[path[:-1]]) if path else None, len(members),
                    sum(len(q) == len(path) + 1 and q[:len(path)] == path for q in nodes),
                    len(leaf), sum((len(nodes[p]) - 1) * w for p, w in zip(inside, words)),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [(3, None, None, None), (3, 0, "user", ""), (3, 0, "user", ""), (None, 1, "user", "lost"),
       (-7, 5, "user", "a b"), (-7, 2, "tool", "x y z"), (-20, 1, "user", "q"), (5, 0, "u", "w " * 50_000),
       (61, 1, "a", "one"), (41, 0, "user", "no base")]


def some_turns(n=90):
    rng = random.Random(11)
    rows = list(ODD)
    for c in range(40, 40 + n):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant",
                         rng.choice(["hi there", "what is it", "a b c d", f"only {c}"])))
    rows += [(300 + c, t, "user", f"turn {t}") for c in range(30) for t in range(4)]   # copies
    rows += [(400, t, "user", f"step {t}") for t in range(60)]                          # a chain
    return rows


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
         "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("part_nodes", [None, 7])
def test_nodes_against_brute_force(spark, part_nodes):
    rows = some_turns() if part_nodes is None else some_turns(20)
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", key string, pos long")
    got = trie(*rebuilt(turn_rows(turns)), part_nodes).select(*NAMES).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_a_long_conversation_is_summed_in_blocks(spark):
    rows = [(1, t, "user", f"t{t % 5}") for t in range(25_000)]
    rows += [(2, t, "user", f"t{t % 5}") for t in range(21_000)]
    turns = turn_rows(spark.createDataFrame(rows, SCHEMA))
    lengths = turns.groupBy("conv_id").count().withColumnRenamed("count", "turns")
    nodes = {r.depth: r for r in trie(turns, lengths).collect()}
    assert len(nodes) == 25_001 and nodes[0].key == ROOT_KEY
    assert (nodes[21_000].n_convs, nodes[21_001].n_convs) == (2, 1)
    assert nodes[0].saved_tokens == 21_000 and nodes[20_000].saved_tokens == 1001
    assert nodes[21_000].ends_sha256 == hashlib.sha256(b"2").hexdigest()


def test_ends_of_a_node_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 50)
    ends = spark.range(1000).selectExpr("IF(id % 10 = 0, 'b', 'a') AS key", "999 - id AS conv_id")
    got = {r.key: r.ends_sha256 for r in prefix_trie.end_digests(ends).collect()}
    for key in "ab":
        ids = sorted(999 - i for i in range(1000) if (i % 10 == 0) == (key == "b"))
        assert got[key] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_decomposition_of_random_forests():
    rng = random.Random(3)
    for shape in ("random", "chain", "star"):
        for _ in range(30):
            n = rng.randrange(1, 60)
            above = [None if i == 0 or rng.random() < .05 else
                     {"random": rng.randrange(i), "chain": i - 1, "star": 0}[shape]
                     for i in range(n)]
            own = [rng.randrange(1, 9) for _ in range(n)]
            value = [rng.randrange(-5, 50) for _ in range(n)]
            weight, total = list(own), list(value)
            for i in reversed(range(n)):
                if above[i] is not None:
                    weight[above[i]] += weight[i]
                    total[above[i]] += total[i]
            assert decompose(list(range(n)), above, weight, [value]) == [total]


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    (root,) = trie(*rebuilt(turn_rows(turns))).select(*NAMES).collect()
    assert tuple(root) == (None, 0, None, 0, 0, 1, 0, prefix_trie.EMPTY_SHA)
