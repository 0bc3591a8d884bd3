"""Prefix trie of conversations, rolled up by centroid decomposition.

Every distinct sequence of first turns is a node; a node's parent lacks the
last turn.  A turn is known by digests of (position, role, text), and a
sequence by four sums of 32 bits of them, which are summed over blocks of
rows, so a conversation may hold any share of all rows; a node's parent is
its own sums less its last turn's.  Nodes come from one grouped, partially
aggregated pass.

Sums over subtrees use the parent-edge forest's centroids.  A node weighs as
much as it has conversations, so a subtree's weight, the turns from its top
on, is known from the same pass.  In each component the deepest node that
holds more than half of the weight is the centroid.  The component's total
below it is the centroid's own sum and is added along the path from the
centroid to the component's top; then the centroid goes, and its children's
subtrees and what is above it are components of at most half the weight.  The
path is found among the turns of one conversation through the centroid, not
link by link.  Components of more than ``PART_NODES`` nodes are split so by
Spark, all at once, in as many rounds as their weights take to halve; smaller
ones are finished in the same way in tasks that hold ``PART_NODES`` nodes or
so at a time.

Defined results: rows are ordered by turn (null first), then by the digest of
role and text; null roles and texts are empty; rows without a conversation
id are left out.  Texts of any length count whole.  Repeated rows are turns
like others.  An empty table gives the root alone, without members (its
conv_id is null).  Other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.tables import prefix_sums, ship, shuffle_partitions, stored

PART_NODES = 1 << 16
BLOCK_IDS = 100_000       # ids of one block of a node's ends
LANES = ("s0", "s1", "s2", "s3")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_rows(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, turn digest, words) of every turn, pos from 1 on."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text),
               256).alias("digest"), words.alias("words"), F.lit(1).cast("long").alias("one"))
    return prefix_sums(rows, ["conv_id"], ["turn", "digest"], "one", "pos").select(
        "conv_id", "pos", "digest", "words")


def sequences(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, words, own sums, sums of the first ``depth`` turns,
    left: turns from this one on) of (conv_id, pos, digest, words)."""
    mark = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")), 256)
    for i, lane in enumerate(LANES):
        rows = rows.withColumn(f"o_{lane}", F.conv(F.substring(mark, 8 * i + 1, 8), 16, 10)
                               .cast("long"))
    summed = _running(rows, [(f"o_{lane}", lane) for lane in LANES])
    return summed.join(lengths, "conv_id").select(
        "conv_id", F.col("pos").alias("depth"), "words", *LANES, *[f"o_{x}" for x in LANES],
        (F.col("turns") - F.col("pos") + 1).alias("left"))


def _running(rows: DataFrame, values: list[tuple[str, str]]) -> DataFrame:
    """Running sums of several columns by conversation, in blocks of
    positions, so a conversation of any length is summed by many tasks."""
    block = F.expr("(pos - 1) DIV 10000")
    within = (Window.partitionBy("conv_id", "block").orderBy("pos")
              .rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("block", block)
    rows = stored(rows.select("*", *[F.sum(v).over(within).alias(out) for v, out in values]),
                  "summed")
    before = (Window.partitionBy("conv_id").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    later = rows.where("block > 0").select("conv_id").distinct()
    sums = (rows.join(later, "conv_id", "left_semi").groupBy("conv_id", "block")
            .agg(*[F.sum(v).alias(f"b_{out}") for v, out in values])
            .select("conv_id", "block", *[F.sum(f"b_{out}").over(before).alias(f"b_{out}")
                                          for _, out in values]))
    added = rows.join(sums, ["conv_id", "block"], "left")
    names = [c for c in rows.columns if c not in {out for _, out in values}]
    return added.select(*names, *[(F.col(out) + F.coalesce(F.col(f"b_{out}"), F.lit(0)))
                                  .alias(out) for _, out in values])


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.md5(F.concat_ws(",", depth, *sums))


ROOT_KEY = hashlib.md5(b"0,0,0,0,0").hexdigest()


def with_keys(seqs: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, words, left) of every turn."""
    own = [F.col(x) for x in LANES]
    above = [F.col(x) - F.col(f"o_{x}") for x in LANES]
    return seqs.select("conv_id", "depth", _key(F.col("depth"), own).alias("key"),
                       _key(F.col("depth") - 1, above).alias("parent"), "words", "left")


def trie_nodes(steps: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: key, parent, conv_id, depth, n_convs, words, weight
    (of its subtree)."""
    # The root is every conversation's turn 0, even if it has no turns.
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("conv_id").alias("n_convs"),
                       F.coalesce(F.sum(F.col("turns") + 1), F.lit(1)).alias("weight"))
    inner = steps.groupBy("key").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.first("words").alias("words"), F.sum("left").alias("weight"))
    top = root.select(F.lit(ROOT_KEY).alias("key"), F.lit(None).cast("string").alias("parent"),
                      "conv_id", F.lit(0).cast("long").alias("depth"), "n_convs",
                      F.lit(0).cast("long").alias("words"), "weight")
    return inner.select(*top.columns).unionByName(top)


# --- centroid decomposition -------------------------------------------------

def decompose(keys: list, parents: list, weights: list, values: list[list]) -> list[list]:
    """Sums of each of ``values`` over every node's subtree within a forest
    whose nodes come parents first; ``weights`` are those of the subtrees
    (positive, more than all children's together)."""
    at = {k: i for i, k in enumerate(keys)}
    n = len(keys)
    above = [at.get(p, -1) for p in parents]
    below: list[list[int]] = [[] for _ in range(n)]
    for i, p in enumerate(above):
        if p >= 0:
            below[p].append(i)
    weight = list(weights)
    sums = [[0] * n for _ in values]
    gone = [False] * n
    tops = [i for i, p in enumerate(above) if p < 0]
    while tops:
        top = tops.pop()
        half, c = weight[top] / 2, top
        while True:                         # down to the centroid
            heavy = next((x for x in below[c] if not gone[x] and weight[x] > half), None)
            if heavy is None:
                break
            c = heavy
        part, stack = [], [c]               # what the component has from c on
        while stack:
            i = stack.pop()
            part.append(i)
            stack += [x for x in below[i] if not gone[x]]
        totals = [sum(v[i] for i in part) for v in values]
        taken, i = weight[c], c
        for s, total in zip(sums, totals):
            s[c] += total
        while i != top:                     # along the path to the top
            i = above[i]
            weight[i] -= taken
            for s, total in zip(sums, totals):
                s[i] += total
        gone[c] = True
        tops += [x for x in below[c] if not gone[x]]
        if c != top:
            tops.append(top)
    return sums


_FINAL = "key string, leaves long, saved long"


def _finish(batches: Iterator[pd.DataFrame], limit: int) -> Iterator[pd.DataFrame]:
    """Whole components, ``limit`` nodes or so at a time."""
    held: list[pd.DataFrame] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows > limit:
            frame = pd.concat(held)
            last = frame["part"].iloc[-1]
            ready = frame[frame["part"] != last]
            if len(ready):
                yield _rolled(ready)
                held = [frame[frame["part"] == last]]
                rows = len(held[0])
    if rows:
        yield _rolled(pd.concat(held))


def _rolled(frame: pd.DataFrame) -> pd.DataFrame:
    leaves, saved = decompose(frame["key"].tolist(), frame["up"].tolist(),
                              frame["weight"].tolist(),
                              [frame["leaf"].tolist(), frame["own"].tolist()])
    return pd.DataFrame({"key": frame["key"].to_numpy(),
                         "leaves": frame["leaves"].to_numpy() + leaves,
                         "saved": frame["saved"].to_numpy() + saved})


_STATE = ["key", "parent", "conv_id", "depth", "part", "weight", "leaf", "own", "leaves", "saved"]


def roll_up(nodes: DataFrame, steps: DataFrame, part_nodes: int | None = None) -> DataFrame:
    """(key, leaves, saved): sums of ``leaf`` and ``own`` over the subtree of
    every node.  ``steps`` has (conv_id, depth, key, parent) of each turn of
    each node's conversation."""
    limit = part_nodes or PART_NODES
    ship(nodes.sparkSession)
    zero = F.lit(0).cast("long")
    state = stored(nodes.select("key", "parent", "conv_id", "depth",
                                F.lit(ROOT_KEY).alias("part"), "weight", "leaf", "own",
                                zero.alias("leaves"), zero.alias("saved")), "state")
    small, done = [], []
    while True:
        parts = state.groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                          F.max("weight").alias("whole"))
        large = stored(parts.where(F.col("n") > limit).select("part", "whole"), "large")
        if large.isEmpty():
            small.append(state)
            break
        small.append(state.join(large, "part", "left_anti").select(*_STATE))
        state, centroids = _split(state.join(large, "part"), steps)
        done.append(centroids)
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)
    # A part's top has no parent in it, whatever its parent is elsewhere.
    up = F.when(F.col("key") != F.col("part"), F.col("parent"))
    out = (rest.withColumn("up", up).repartition("part").sortWithinPartitions("part", "depth")
           .mapInPandas(lambda batches: _finish(batches, limit), _FINAL))
    for centroids in done:
        out = out.unionByName(centroids)
    return out


def _split(state: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: (state without the centroids, centroids' own results)."""
    heavy = state.where(F.col("weight") * 2 > F.col("whole"))
    centroid = stored(heavy.groupBy("part").agg(
        F.max_by(F.struct("key", "conv_id", "depth", "weight"), "depth").alias("c")).select(
        "part", F.col("c.key").alias("c_key"), F.col("c.conv_id").alias("c_conv"),
        F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")), "centroid")
    # Which child of the centroid a deeper node lies under, if any.
    placed = state.join(centroid, "part")
    deeper = placed.where(F.col("depth") > F.col("c_depth"))
    turn = steps.select(F.col("conv_id").alias("t_conv"), F.col("depth").alias("t_depth"),
                        F.col("key").alias("t_key"), F.col("parent").alias("t_parent"))
    deeper = deeper.join(turn, (F.col("conv_id") == F.col("t_conv"))
                         & (F.col("c_depth") + 1 == F.col("t_depth")))
    under = F.col("t_parent") == F.col("c_key")
    deeper = deeper.select(*_STATE, "c_key", F.when(under, F.col("t_key")).alias("child"))
    higher = placed.where(F.col("depth") <= F.col("c_depth")).select(
        *_STATE, "c_key", F.lit(None).cast("string").alias("child"))
    marked = stored(deeper.unionByName(higher), "marked")
    below = F.col("child").isNotNull() | (F.col("key") == F.col("c_key"))
    total = marked.where(below).groupBy("part").agg(F.sum("leaf").alias("t_leaf"),
                                                    F.sum("own").alias("t_own"))
    total = stored(centroid.join(total, "part"), "total")
    # The path from the centroid to its part's top: turns of its conversation.
    path = (turn.join(total, (F.col("t_conv") == F.col("c_conv"))
                      & (F.col("t_depth") < F.col("c_depth")))
            .select(F.col("t_key").alias("key"), "part", "t_leaf", "t_own", "c_weight"))
    root = total.where("c_depth > 0").select(
        F.lit(ROOT_KEY).alias("key"), "part", "t_leaf", "t_own", "c_weight")
    stays = marked.where(F.col("key") != F.col("c_key")).drop("c_key")
    moved = stays.where("child IS NOT NULL").withColumn("part", F.col("child")).drop("child")
    kept = stays.where("child IS NULL").drop("child").join(
        path.unionByName(root), ["part", "key"], "left")
    kept = kept.select(
        "key", "parent", "conv_id", "depth", "part",
        (F.col("weight") - F.coalesce("c_weight", F.lit(0))).alias("weight"), "leaf", "own",
        (F.col("leaves") + F.coalesce("t_leaf", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("t_own", F.lit(0))).alias("saved"))
    own = marked.where(F.col("key") == F.col("c_key")).join(
        total.select("part", "t_leaf", "t_own"), "part").select(
        "key", (F.col("leaves") + F.col("t_leaf")).alias("leaves"),
        (F.col("saved") + F.col("t_own")).alias("saved"))
    return stored(moved.unionByName(kept), "state"), own


# --- members that end at a node ----------------------------------------------

def _end_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's ids, block by block."""
    now, digest, out = None, None, []
    for batch in batches:
        for key, ids in zip(batch["key"], batch["ids"]):
            if key != now:
                if now is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        out = []
    if now is not None:
        yield pd.DataFrame([(now, digest.hexdigest())], columns=["key", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): ids in ascending order.

    A node may end any share of all conversations: ids are dealt by range
    into blocks, joined there, and only blocks meet, one by one."""
    ship(ends.sparkSession)
    n = max(shuffle_partitions(ends.sparkSession), -(-ends.count() // BLOCK_IDS))
    blocks = (ends.repartitionByRange(n, "key", "conv_id")
              .withColumn("block", F.spark_partition_id()))
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    joined = stored(blocks.groupBy("key", "block").agg(F.concat_ws(",", ids).alias("ids")),
                    "ends")
    return (joined.repartition("key").sortWithinPartitions("key", "block")
            .select("key", "ids").mapInPandas(_end_digests, "key string, ends_sha256 string"))


def trie(rows: DataFrame, lengths: DataFrame, part_nodes: int | None = None) -> DataFrame:
    """One row per node of the trie of the conversations ``lengths`` (conv_id,
    turns) with the turns ``rows`` (conv_id, pos, digest, words): key,
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    steps = stored(with_keys(sequences(rows, lengths)), "steps")
    nodes = stored(trie_nodes(steps, lengths), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy("parent").agg(
        F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "key")
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = stored(nodes.join(children, "key", "left").join(above, "parent", "left").select(
        *nodes.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "parent_conv_id", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")
        .alias("leaf"), F.greatest(
            (F.col("n_convs") - 1) * F.col("words"), F.lit(0)).alias("own")), "full")
    rolled = roll_up(full, steps, part_nodes)
    empty = lengths.where("turns = 0").select(F.lit(ROOT_KEY).alias("key"), "conv_id")
    ends = end_digests(steps.where("left = 1").select("key", "conv_id").unionByName(empty))
    return (full.join(rolled, "key").join(ends, "key", "left").select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, lengths) of the conversations rebuilt: c takes the first h turns
    of c - c % 20, then its own after its first h; h is crc32(c) % 4.  The
    remainder has the sign of c, as in SQL."""
    rows = stored(rows, "turns")
    sizes = rows.groupBy("conv_id").agg(F.max("pos").alias("own_turns")).select(
        "conv_id", "own_turns", F.expr("conv_id - conv_id % 20").alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h"))
    heads = rows.where("pos <= 3 AND conv_id % 20 = 0").groupBy(
        F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(
            F.struct("pos", "digest", "words"))).alias("head"))      # three at most
    convs = sizes.join(heads, "base", "left").select(
        "conv_id", "h", "own_turns", F.coalesce(F.slice("head", F.lit(1), F.col("h")),
                                                F.slice("head", 1, 0), F.array().cast(
            "array<struct<pos:long,digest:string,words:long>>")).alias("head"))
    convs = stored(convs.withColumn("m", F.size("head").cast("long")), "convs")
    first = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    own = rows.join(convs.select("conv_id", "h", "m"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "digest", "words")
    lengths = convs.select("conv_id", (F.col("m") + F.greatest(
        F.col("own_turns") - F.col("h"), F.lit(0))).alias("turns"))
    return first.unionByName(own), lengths
