"""Structure of conversations: faults, and the cheapest repair.

A conversation should have the role initials ``(s?(ua)+)?``.  Edits, in
their ASCII order: D deletes a row (4; blank and repeated rows must go), I
inserts an empty turn of the role that is due (3), K keeps a row whose role
fits (0), R gives a row the role that is due (3).  A truncated row that
isn't deleted costs 3 more.  The edits before a position fix the role that
is due there, so a string of edits says all.

The search is iterative-deepening A*: depth first, trying edits in ASCII
order, under a cost bound that starts at a lower bound of the whole and rises
to the least estimate that went over it.  States (row, role due) that failed
are kept with the cost to go that their failure proves, so they are not
searched again under a bound too small for it.  The first accepting path is
then the cheapest and, of the cheapest, the ASCII-least.  The estimate sums
what each row costs whatever the others do, and 3 for each of a set of
disjoint neighbours with one role, which can't both stay as they are.

A conversation of at most ``BLOCK_TURNS`` rows is searched as a whole.  A
longer one, which may hold any share of all rows, is cut into blocks.  Each
block's costs between any two states make a (min, +) matrix; their products
from the end give the exact cost of all that follows a block, so blocks are
searched apart, each from every state it may begin in, and their paths are
linked in order.  Only summaries of blocks meet in one task, and pass through
it one by one.

Defined results: rows are ordered by turn (null first), then role, then
text; a null role or text is one space.  A row is blank if it has no
character but white space, else a repeat if an earlier row of its
conversation has its role and text, else truncated if its last character
(white space aside) isn't one of ``.!?``.  A role's initial is its first
character as it is, so ``User`` and an empty role fit nowhere.  Rows with a
null conversation id form one conversation.  Texts of any length are taken
whole.  An empty table gives no rows.  Other columns are left out, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import prefix_sums, ship, stored

BLOCK_TURNS = 200

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: States: nothing yet, after a system turn, after a user turn, after an
#: assistant turn.  The state that the role due leads to, and that a kept
#: initial leads to.
STATES = range(4)
_DUE = (2, 2, 3, 2)
_ROLE = (None, "system", "user", "assistant")
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)
_FAR = 1 << 60
_LEGAL = ("su", "ua", "au")

_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def symbol(initial: str, must_go: bool, truncated: bool) -> str:
    """What the search needs of a row: the initial (x if it fits nowhere),
    upper case if truncated, or b if the row must go."""
    if must_go:
        return "b"
    s = initial if initial in ("s", "u", "a") else "x"
    return s.upper() if truncated else s


def steps(state: int, row: str | None) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, rows taken, next state) in ASCII order; ``row`` is None
    after the last row."""
    due = _DUE[state]
    if row is None:
        yield "I", INSERT, 0, due
        return
    yield "D", DELETE, 1, state
    yield "I", INSERT, 0, due
    if row != "b":
        more = TRUNCATED if row.isupper() else 0
        kept = _KEEP.get((state, row.lower()))
        if kept is not None:
            yield "K", more, 1, kept
        yield "R", REROLE + more, 1, due


_STEPS = {(s, r): tuple(steps(s, r)) for s in STATES for r in (None, *"bsuaxSUAX")}
#: The least that a row costs, whatever the state.
_LEAST = {r: min(c for s in STATES for _, c, taken, _ in _STEPS[s, r] if taken)
          for r in "bsuaxSUAX"}


def estimates(rows: str) -> list[int]:
    """A lower bound of the cost from each row on."""
    n = len(rows)
    least, pairs, out = 0, [0] * (n + 2), [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least += _LEAST[rows[i]]
        same = i + 1 < n and rows[i] == rows[i + 1] and rows[i] in "ua"
        pairs[i] = 1 + pairs[i + 2] if same else pairs[i + 1]
        out[i] = least + REROLE * pairs[i]
    return out


def search(rows: str, start: int = 0, after: tuple[int, ...] | None = None) -> tuple[int, str, int]:
    """(cost, edits, end state) of the cheapest, ASCII-least path over
    ``rows`` from ``start``.  ``after`` is what follows costs from each
    state; None if nothing does, when turns may be inserted at the end."""
    n = len(rows)
    rest = 0 if after is None else min(after)
    ahead = [e + rest for e in estimates(rows)]
    proven: dict[tuple[int, int], int] = {}     # cost to go is at least this
    path: list[str] = []

    def visit(i: int, state: int, left: int) -> tuple[int, int]:
        """(cost to go if a path within ``left`` was found, else a proven
        lower bound above ``left``; its end state or -1)."""
        if i == n:
            if after is not None:
                return after[state], state if after[state] <= left else -1
            if state in _ENDS:
                return 0, state
        low = max(ahead[i], proven.get((i, state), 0))
        if low > left:
            return low, -1
        best = _FAR
        for edit, cost, taken, to in _STEPS[state, rows[i] if i < n else None]:
            if cost > left:
                best = min(best, cost)
                continue
            path.append(edit)
            found, end = visit(i + taken, to, left - cost)
            if end >= 0:
                return cost + found, end
            path.pop()
            best = min(best, cost + found)
        proven[i, state] = best
        return best, -1

    bound = ahead[0]
    while True:
        bound, end = visit(0, start, bound)
        if end >= 0:
            return bound, "".join(path), end


def costs_between(rows: str) -> list[int]:
    """The least cost from each state to each state over all of ``rows``
    (16 numbers, by first state); a path ends with a row."""
    out = []
    for start in STATES:
        at = [_FAR] * 4
        at[start] = 0
        for row in rows:
            for _ in range(2):      # inserted turns before the row
                at = [min(at[s], *(at[p] + INSERT for p in STATES if _DUE[p] == s), _FAR)
                      for s in STATES]
            to = [_FAR] * 4
            for s in STATES:
                for _, cost, taken, end in _STEPS[s, row]:
                    if taken:
                        to[end] = min(to[end], at[s] + cost)
            at = to
        out += at
    return out


#: The cost of ending after each state, when turns may be inserted.
AT_END = tuple(search("", s)[0] for s in STATES)


def apply_edits(edits: str, start: int, rows: list[tuple[str, str]]) -> list[tuple]:
    """(edit, role, text) of each edit, deleted rows included."""
    out, state, i = [], start, 0
    for edit in edits:
        role, text = (None, "") if edit == "I" else rows[i]
        i += edit != "I"
        if edit == "K":
            state = _KEEP[state, role[:1]]
        elif edit != "D":
            state = _DUE[state]
            role = _ROLE[state]
        out.append((edit, role, text))
    return out


def illegal_pairs(initials: Iterable[str]) -> int:
    initials = list(initials)
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


# --- Spark side -----------------------------------------------------------

_NONE = object()      # no conversation yet; its id may be null
_PIECE = ("conv_id long, block long, blocks long, gaps long, blank long, duplicate long, "
          "truncated long, illegal long, cost long, audit string, "
          "repaired array<struct<edit:string,role:string,text:string>>")


def _ordered_rows(turns: DataFrame, id_col: str, turn_col: str, role_col: str,
                  text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(" "))
    # the last character that isn't white space; none if blank
    last = F.substring(F.rtrim(F.translate(text, _BLANKS, " " * len(_BLANKS))), -1, 1)
    return turns.select(F.col(id_col).cast("long").alias("conv_id"),
                        F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                        text.alias("text"), (last == "").alias("blank"),
                        (~last.isin(".", "!", "?")).alias("cut"))


def _by_conversation(batches: Iterator[pd.DataFrame], key: str = "conv_id"):
    """(id, frame) of each run of rows with one id, over batch bounds."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        ids = batch[key].astype("Int64")
        new = (ids != ids.shift()).fillna(ids.isna() != ids.shift().isna()).to_numpy(bool)
        new[0] = False
        for k, run in enumerate(np.split(batch, np.flatnonzero(new))):
            if held and (k or not _same(held[-1][key].iloc[-1], run[key].iloc[0])):
                yield held[0][key].iloc[0], pd.concat(held)
                held = []
            held.append(run)
    if held:
        yield held[0][key].iloc[0], pd.concat(held)


def _same(a, b) -> bool:
    return (pd.isna(a) and pd.isna(b)) or a == b


def _id(value) -> int | None:
    return None if pd.isna(value) else int(value)


def _short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Conversations of one block, in their order."""
    out = []
    for conv, frame in _by_conversation(batches):
        seen: set[tuple[str, str]] = set()
        counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        symbols = []
        rows = list(zip(frame["role"], frame["text"]))
        for row, blank, cut in zip(rows, frame["blank"], frame["cut"]):
            fault = ("blank" if blank else "duplicate" if row in seen else
                     "truncated" if cut else None)
            seen.add(row)
            if fault:
                counts[fault] += 1
            symbols.append(symbol(row[0][:1], fault in ("blank", "duplicate"),
                                  fault == "truncated"))
        cost, audit, _ = search("".join(symbols))
        turn = frame["turn"].dropna()
        gaps = int(turn.max()) - int(turn.min()) + 1 - turn.nunique() if len(turn) else 0
        out.append((_id(conv), 0, 1, gaps, *counts.values(),
                    illegal_pairs(r[:1] for r, _ in rows), cost, audit,
                    [dict(zip(("edit", "role", "text"), e))
                     for e in apply_edits(audit, 0, rows)]))
        if len(out) >= 200:
            yield _pieces(out)
            out = []
    if out:
        yield _pieces(out)


def _pieces(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _PIECE.split(", ")])
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame


def _to(df: DataFrame, other: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on columns of one name."""
    other = other.select(*[F.col(c).alias(f"__{c}" if c in keys else c) for c in other.columns])
    both = df.join(other, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], how)
    return both if how in ("left_semi", "left_anti") else both.drop(*[f"__{k}" for k in keys])


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of long conversations with their block, symbol and fault."""
    number = prefix_sums(rows.withColumn("one", F.lit(1).cast("long")), ["conv_id"],
                         ["turn", "role", "text"], "one", "pos").drop("one")
    number = number.withColumn("same", F.sha2(F.concat(
        F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    number = stored(number, "numbered")
    first = number.groupBy("conv_id", "same").agg(F.min("pos").alias("first"),
                                                  F.count(F.lit(1)).alias("n"))
    first = first.where("n > 1").select("conv_id", "same", "first")
    held = _to(number, first, ["conv_id", "same"], "left")
    fault = (F.when(F.col("blank"), "blank").when(F.col("pos") > F.col("first"), "duplicate")
             .when(F.col("cut"), "truncated"))
    initial = F.substring("role", 1, 1)
    shown = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return stored(held.withColumn("fault", fault).select(
        "conv_id", F.expr(f"(pos - 1) DIV {BLOCK_TURNS}").alias("block"), "pos", "turn", "role",
        "text", "fault", F.when(F.col("fault").isin("blank", "duplicate"), "b").when(
            F.col("fault") == "truncated", F.upper(shown)).otherwise(shown).alias("symbol"),
        initial.alias("initial")), "faults")


def _blocks(rows: DataFrame) -> DataFrame:
    """One row per block: its symbols and initials in order, and counts."""
    def each(col: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("pos", col))), lambda x: x[col])

    def faults(kind: str) -> Column:
        return F.count(F.when(F.col("fault") == kind, 1)).alias(kind)

    return rows.groupBy("conv_id", "block").agg(
        F.concat_ws("", each("symbol")).alias("symbols"), each("initial").alias("initials"),
        faults("blank"), faults("duplicate"), faults("truncated"))


def _matrix(symbols: pd.Series) -> pd.Series:
    return symbols.map(costs_between)


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What follows each block costs from each state; blocks come last first."""
    now, after = _NONE, None
    for batch in batches:
        out = []
        for conv, block, costs in zip(batch["conv_id"], batch["block"], batch["costs"]):
            if now is _NONE or not _same(now, conv):
                now, after, matrix = conv, AT_END, None
            out.append((_id(conv), block, list(after)))
            matrix = np.asarray(costs, np.int64).reshape(4, 4)
            after = tuple(int(x) for x in np.minimum((matrix + np.array(after)).min(1), _FAR))
        frame = pd.DataFrame(out, columns=["conv_id", "block", "after"])
        frame["conv_id"] = frame["conv_id"].astype("Int64")
        yield frame


def _from_each_state(symbols: pd.Series, after: pd.Series, last: pd.Series) -> pd.Series:
    out = []
    for rows, cost_after, ends in zip(symbols, after, last):
        paths = [search(rows, s, None if ends else tuple(cost_after)) for s in STATES]
        out.append([dict(zip(("cost", "edits", "state"), p)) for p in paths])
    return pd.Series(out)


def _forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Link the blocks' paths in order."""
    now, state, cost, initial = _NONE, 0, 0, None
    for batch in batches:
        out = []
        for conv, block, initials, paths in zip(batch["conv_id"], batch["block"],
                                                batch["initials"], batch["paths"]):
            first = now is _NONE or not _same(now, conv)
            if first:
                now, state, cost, initial = conv, 0, int(paths[0]["cost"]), None
            pairs = illegal_pairs([*([] if initial is None else [initial]), *initials])
            out.append((_id(conv), block, state, paths[state]["edits"], pairs,
                        cost if first else 0))
            initial, state = initials[-1], paths[state]["state"]
        frame = pd.DataFrame(out, columns=["conv_id", "block", "start", "audit", "illegal",
                                           "cost"])
        frame["conv_id"] = frame["conv_id"].astype("Int64")
        yield frame


def _repaired(frame: pd.DataFrame) -> pd.DataFrame:
    """One block's rows after its edits."""
    frame = frame.sort_values("pos")
    head = frame.iloc[0]
    edits = apply_edits(head["audit"], head["start"], list(zip(frame["role"], frame["text"])))
    return pd.DataFrame({"conv_id": pd.array([_id(head["conv_id"])], "Int64"),
                         "block": [head["block"]], "repaired": [
                             [dict(zip(("edit", "role", "text"), e)) for e in edits]]})


def _long(rows: DataFrame) -> DataFrame:
    matrix = F.pandas_udf(_matrix, "array<long>")
    from_each_state = F.pandas_udf(_from_each_state,
                                   "array<struct<cost:long,edits:string,state:int>>")
    rows = _numbered(rows)
    blocks = stored(_blocks(rows).withColumn("costs", matrix("symbols")), "blocks")
    gaps = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"),
                   F.lit(0)).alias("gaps"), (F.max("block") + 1).alias("blocks"))
    after = (blocks.select("conv_id", "block", "costs").repartition("conv_id")
             .sortWithinPartitions("conv_id", F.desc("block"))
             .mapInPandas(_backward, "conv_id long, block long, after array<long>"))
    keys = ["conv_id", "block"]
    ready = _to(_to(blocks.drop("costs"), after, keys), gaps, ["conv_id"])
    paths = stored(ready.withColumn("paths", from_each_state(
        "symbols", "after", F.col("block") == F.col("blocks") - 1)), "paths")
    linked = (paths.select("conv_id", "block", "initials", "paths").repartition("conv_id")
              .sortWithinPartitions("conv_id", "block").mapInPandas(
                  _forward, "conv_id long, block long, start int, audit string, illegal long, "
                  "cost long"))
    linked = stored(_to(paths.drop("initials", "paths", "symbols", "after"), linked, keys),
                    "linked")
    edited = (_to(rows.select(*keys, "pos", "role", "text"),
                  linked.select(*keys, "start", "audit"), keys)
              .groupBy(*keys).applyInPandas(_repaired, "conv_id long, block long, repaired "
                                            "array<struct<edit:string,role:string,text:string>>"))
    names = [c.split()[0] for c in _PIECE.split(", ")]
    return _to(linked, edited, keys).select(*names)


def repair(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per block of a conversation: conv_id, block, blocks (how many
    it has), counts of faults (gaps of the whole conversation; illegal
    neighbours at a block's start included; cost of the whole on the first
    block), the edits as ``audit`` and what they make of the rows as
    ``repaired`` (edit, role, text; deleted rows included)."""
    ship(turns.sparkSession)
    rows = _ordered_rows(turns, id_col, turn_col, role_col, text_col)
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    longs = stored(sizes.where(F.col("n") > BLOCK_TURNS).select("conv_id"), "long")
    short = (_to(rows, longs, ["conv_id"], "left_anti").repartition("conv_id")
             .sortWithinPartitions("conv_id", "turn", "role", "text")
             .mapInPandas(_short, _PIECE))
    if longs.isEmpty():
        return short
    return short.unionByName(_long(_to(rows, longs, ["conv_id"], "left_semi")))


def repaired_text() -> Column:
    """A piece's repaired rows as ``role:text`` lines."""
    kept = F.filter("repaired", lambda x: x["edit"] != "D")
    return F.concat_ws("\n", F.transform(kept, lambda x: F.concat(x["role"], F.lit(":"),
                                                                  x["text"])))


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each long conversation, piece by piece."""
    now, digest, any_line = _NONE, None, False
    for batch in batches:
        out = []
        for conv, lines, some in zip(batch["conv_id"], batch["lines"], batch["some"]):
            if now is _NONE or not _same(now, conv):
                if digest is not None:
                    out.append((_id(now), digest.hexdigest()))
                now, digest, any_line = conv, hashlib.sha256(), False
            if some:
                digest.update((("\n" if any_line else "") + lines).encode())
                any_line = True
        yield _digest_rows(out)
    if digest is not None:
        yield _digest_rows([(_id(now), digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["conv_id", "repaired_sha256"])
    frame["conv_id"] = frame["conv_id"].astype("Int64")
    return frame


def report(ids: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row for each of ``ids`` (column conv_id): faults, cost, edits and
    the SHA-256 of the repaired conversation; zeros for those without rows."""
    pieces = stored(pieces, "pieces")
    sums = ["blank", "duplicate", "truncated", "illegal", "cost"]
    one = pieces.where("blocks = 1").select(
        "conv_id", "gaps", *sums, "audit", F.sha2(repaired_text(), 256).alias("repaired_sha256"))
    many = pieces.where("blocks > 1")
    audits = F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))),
                         lambda x: x["audit"])
    total = many.groupBy("conv_id").agg(F.max("gaps").alias("gaps"),
                                        *[F.sum(c).alias(c) for c in sums],
                                        F.concat_ws("", audits).alias("audit"))
    some = F.exists("repaired", lambda x: x["edit"] != "D")
    digests = (many.select("conv_id", "block", repaired_text().alias("lines"),
                           some.alias("some")).repartition("conv_id")
               .sortWithinPartitions("conv_id", "block")
               .mapInPandas(_digests, "conv_id long, repaired_sha256 string"))
    found = one.unionByName(_to(total, digests, ["conv_id"]))
    every = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = _to(every, found, ["conv_id"], "left")
    return joined.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                      for c in ("gaps", *sums)],
                         F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)
                                    ).alias("repaired_sha256"))


def damage(turns: DataFrame) -> DataFrame:
    """Planted faults: of the rows (conv_id, turn, role, text), by
    crc32("conv_id:turn") % 20, 0 drops, 1 empties the text, 2 takes its
    ``.!?``, 3 repeats the row, 4 sets the role user.  Nulls in the key, the
    role and the text are one space."""
    def shown(col: str) -> Column:
        return F.coalesce(F.col(col).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"),
                        shown("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = (F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
        .alias("role"), text.alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2)))
                  .otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
