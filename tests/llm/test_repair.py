import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from headway.llm import repair
from headway.llm.repair import (AT_END, BLOCK_TURNS, costs_between, damage, estimates, report,
                                search)

GOOD = re.compile(r"(s?(ua)+)?")


def cheapest(rows, limit=60):
    """(cost, edits) by trying every string of edits in order of (cost, string).
    rows: (initial, must go, truncated)."""
    heap = [(0, "", 0, "")]         # cost, edits, rows taken, initials
    while heap:
        cost, edits, i, made = heapq.heappop(heap)
        if i == len(rows) and GOOD.fullmatch(made):
            return cost, edits
        if cost > limit or not any(GOOD.fullmatch(made + x) for x in ("", "a", "ua")):
            continue
        for new in "ua":
            heapq.heappush(heap, (cost + 3, edits + "I", i, made + new))
        if i < len(rows):
            initial, must_go, cut = rows[i]
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, made))
            if not must_go:
                heapq.heappush(heap, (cost + 3 * cut, edits + "K", i + 1, made + (initial or "?")))
                for new in "ua":
                    heapq.heappush(heap, (cost + 3 + 3 * cut, edits + "R", i + 1, made + new))


def symbols(rows):
    return "".join(repair.symbol(*r) for r in rows)


def test_every_short_conversation_against_trying_all_edits():
    kinds = [("s", False, False), ("u", False, False), ("a", False, False), ("x", False, False),
             ("u", True, False), ("u", False, True), ("a", False, True)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert search(symbols(rows))[:2] == cheapest(rows), rows


def test_longer_conversations_against_trying_all_edits():
    rng = random.Random(4)
    for _ in range(60):
        rows = [(rng.choice("uuaasx"), rng.random() < .1, rng.random() < .2)
                for _ in range(rng.randrange(4, 7))]
        assert search(symbols(rows))[:2] == cheapest(rows), rows


def test_estimates_never_exceed_the_cost():
    rng = random.Random(5)
    for _ in range(300):
        rows = "".join(rng.choice("bsuaxSUAXuaua") for _ in range(12))
        assert all(e <= search(rows[i:], s)[0] for i, e in enumerate(estimates(rows))
                   for s in range(4))


def test_blocks_link_to_the_path_of_the_whole():
    rng = random.Random(6)
    for _ in range(100):
        rows = "".join(rng.choice("bsuaxSUAXuauauaua") for _ in range(40))
        cuts = [rows[i:i + 7] for i in range(0, 40, 7)]
        after, behind = AT_END, []
        for cut in reversed(cuts):
            behind.append(after)
            m = costs_between(cut)
            after = tuple(min(m[4 * s + e] + after[e] for e in range(4)) for s in range(4))
        state, path = 0, ""
        for cut, rest in zip(cuts, reversed(behind)):
            _, edits, state = search(cut, state, None if cut is cuts[-1] else rest)
            path += edits
        cost, whole, _ = search(rows)
        assert (after[0], path) == (cost, whole)


def test_long_blocks_are_searched_fast_and_within_the_stack():
    rng = random.Random(7)
    for weights in ("ua" * 8 + "bsxUA", "u", "bsuaxSUAX", "xa"):
        rows = "".join(rng.choice(weights) for _ in range(BLOCK_TURNS))
        assert search(rows)[0] > 0


def brute(turns):
    out = {c: [] for c, *_ in turns}
    for c, t, role, text in turns:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (t, "user" if kind == 4 else role, text)
        out[c] += [] if kind == 0 else [row] * (2 if kind == 3 else 1)
    for c, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r))
        seen, kinds, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = (0 if not solid else 1 if (role, text) in seen else
                     2 if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            kinds.append((role[:1], fault in (0, 1), fault == 2))
        known = [t for t, *_ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum((a + b) not in ("su", "ua", "au") for (a, *_), (b, *_) in
                      zip(kinds, kinds[1:]))
        cost, audit = cheapest(kinds) if len(kinds) < 7 else search(symbols(kinds))[:2]
        state, i, lines = "", 0, []
        for e in audit:
            due = "assistant" if state == "u" else "user"
            role, text = rows[i][1:] if e != "I" else ("", "")
            i += e != "I"
            if e != "D":
                role = role if e == "K" else due
                state = role[:1]
                lines.append(f"{role}:{text}")
        out[c] = (gaps, *counts, illegal, cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"
ODD = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes"), (1, None, None, None),
       (1, 1, "assistant", "Yes"), (None, 0, "user", "Q?"), (None, None, "tool", "x"),
       (2, 7, "", ""), (3, None, None, " \t"), (4, -5, "User", "word\x85"), (4, 9, "user", "a.\n "),
       (4, 9, "user", "b!\v"), (5, 0, "assistant", "w " * 100_000)]


def some_turns():
    rng = random.Random(8)
    rows = list(ODD)
    for c in range(20, 140):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t + rng.randrange(2), rng.choice(["user", "assistant", "system", "user",
                                                              "assistant"]),
                         rng.choice(["One.", "Two!", "Three", "", "Four? ", f"{t}."])))
    return rows


@pytest.mark.parametrize("block", [BLOCK_TURNS, 3])
def test_report_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK_TURNS", block)
    rows = some_turns()
    turns = spark.createDataFrame(rows, SCHEMA)
    got = report(turns, repair.repair(damage(turns))).collect()
    want = brute(rows)
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want


def test_pieces_hold_the_repaired_rows_and_columns_may_clash(spark):
    rows = [(1, 0, "user", "A.", "x", 1), (1, 1, "user", "B.", "y", 2)]
    turns = spark.createDataFrame(rows, "conv long, n long, who string, said string, "
                                  "blank string, audit long")
    (piece,) = repair.repair(turns, "conv", "n", "who", "said").collect()
    assert piece.audit == search("uu")[1]
    assert [tuple(r) for r in piece.repaired][0] == ("K", "user", "A.")
    assert (piece.cost, piece.illegal) == (3, 1)


def test_empty_table(spark):
    turns = spark.createDataFrame([], SCHEMA)
    assert report(turns, repair.repair(damage(turns))).collect() == []
