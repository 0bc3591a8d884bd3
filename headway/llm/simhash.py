"""Near duplicates by SimHash and a Gray-order hierarchical index.

A text's fingerprint has a bit set where more than half of the hashes
(XXH64, seed 42) of its word shingles have it.  Fingerprints link at
``DISTANCE`` or fewer differing bits; linked ones, however far apart, form
one group.

The index is a hierarchy of masked bit patterns over the distinct
fingerprints.  Upper nodes share the bits under a mask: the 64 bits are cut
into DISTANCE + 1 masks, and as a linked pair differs in at most DISTANCE
bits, it agrees under one of them and meets in that node; pairs of nodes
that differ there are pruned without being looked at.  A node of more than
``LEAF_ROWS`` fingerprints is refined: its free bits are cut into
DISTANCE + 1 masks again, and its children share those bits too.  A node
with few free bits can't hold more, so refining ends by itself.

Within a leaf the fingerprints are sorted by Gray rank, which puts
neighbours of few differing bits side by side.  Runs of ``FANOUT`` factor
out the bits they all share, and so do runs of runs.  A fingerprint's
differences from a run's pattern are accumulated on the way down, each level
adding only the bits that its parent had not factored out; above DISTANCE the
whole run is pruned.

A leaf gives a spanning star of each group it finds instead of all pairs, and
groups are joined over leaves by passing minima along edges (large and small
stars) in Spark.

Defined results: a null text counts as empty; a text without words has
fingerprint zero, which links like any other.  Texts of fewer words than a
shingle are one shingle.  Rows with a null id get a fingerprint and the
component of their group (null where the group has no id at all).  A bit
that exactly half of the hashes have is 0.  Texts of any length are read
whole.  Repeated rows are rows of the same group.  An empty table gives an
empty result.  Other columns pass through ``drop_near_copies`` unchanged,
whatever their names, and are left out by ``near_groups``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import flagged, free_name, key_filter, ship, stored

SHINGLE = 3
SEED = 42
DISTANCE = 2
LEAF_ROWS = 4096
FANOUT = 16
_SMALL = 12          # groups up to here are compared side by side
_QUERIES = 256       # fingerprints that go down a leaf's hierarchy at once


# --- fingerprints -----------------------------------------------------------

def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    words = (text or "").encode().lower().split()   # bytes: A-Z only
    if not words:
        return np.empty(0, "<u8")
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in
                        zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())),
                       "<u8", len(words) - size + 1)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    hashes = shingle_hashes(text, size)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, size: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return of(text)


# --- the index --------------------------------------------------------------

def _masks(free: list[int], parts: int) -> list[int]:
    """The free bits cut into ``parts`` masks, as signed integers."""
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    masks = [sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks if m]


def _free_bits(mask: int) -> list[int]:
    return [b for b in range(64) if not mask >> b & 1]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def hierarchy(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the top: (mask, pattern) of the bits that each run of
    FANOUT nodes of the level below shares and its parent doesn't."""
    low, high = values, values
    shared = []
    while len(low) > 1:
        at = np.arange(0, len(low), FANOUT)
        low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        shared.append((~(low ^ high), low))
    levels = []
    for mask, pattern in reversed(shared):
        if levels:
            above = np.repeat(full, FANOUT)[:len(mask)]
            levels.append((mask & ~above, pattern & mask & ~above))
        else:
            levels.append((mask, pattern & mask))
        full = mask
    return levels


def linked_pairs(values: np.ndarray, distance: int = DISTANCE
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of distinct values in Gray order that differ in
    at most ``distance`` bits, found by going down the hierarchy."""
    levels = hierarchy(values)
    for start in range(0, len(values), _QUERIES):
        query = np.arange(start, min(start + _QUERIES, len(values)))
        node = np.zeros(len(query), np.int64)
        spent = np.zeros(len(query), np.int64)
        span = FANOUT ** len(levels)
        for depth, (mask, pattern) in enumerate(levels):
            spent = spent + np.bitwise_count((values[query] ^ pattern[node]) & mask[node])
            # Runs that end before the query hold only pairs seen from the other side.
            live = (spent <= distance) & ((node + 1) * span > query)
            query, node, spent = query[live], node[live], spent[live]
            children = len(levels[depth + 1][0]) if depth + 1 < len(levels) else len(values)
            size = len(query)
            node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            query, spent = np.repeat(query, FANOUT), np.repeat(spent, FANOUT)
            there = node < children
            query, node, spent = query[there], node[there], spent[there]
            span //= FANOUT
            if not size:
                break
        later = node > query
        query, node = query[later], node[later]
        near = np.bitwise_count(values[query] ^ values[node]) <= distance
        yield query[near], node[near]


def settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of a and b: the least index each can reach."""
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def leaf_edges(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star of each group among one leaf's fingerprints."""
    values = fps.view(np.uint64)
    order = np.argsort(gray_rank(values))
    values, fps = values[order], fps[order]
    label = np.arange(len(values))
    for a, b in linked_pairs(values, distance):
        label = settle(label, a, b)
    moved = label != np.arange(len(values))
    return fps[moved], fps[label[moved]]


def _edges_of(distance: int):
    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Leaves come whole and in a row: complete ones are searched as
        batches arrive; the last one waits, and holds LEAF_ROWS at most."""
        held: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            mask, pattern = rows["mask"].to_numpy(), rows["pattern"].to_numpy()
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
            last = int(new[-1]) if len(new) else 0
            held = rows.iloc[last:]
            yield from searched(rows.iloc[:last], new[:-1])
        if held is not None:
            yield from searched(held, np.empty(0, np.int64))

    def searched(rows: pd.DataFrame, new: np.ndarray) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        fps = rows["fp"].to_numpy(np.int64)
        bounds = np.concatenate(([0], new, [len(fps)]))
        sizes = np.diff(bounds)
        small = sizes <= _SMALL
        leaf = np.repeat(np.where(small, np.arange(len(sizes)), -1), sizes)
        bits = fps.view(np.uint64)
        for d in range(1, _SMALL):
            if d >= len(fps):
                break
            near = np.flatnonzero((leaf[d:] == leaf[:-d]) & (leaf[d:] >= 0))
            near = near[np.bitwise_count(bits[near] ^ bits[near + d]) <= distance]
            if len(near):
                yield pd.DataFrame({"a": fps[near], "b": fps[near + d]})
        for k in np.flatnonzero(~small):
            a, b = leaf_edges(fps[bounds[k]:bounds[k + 1]].copy(), distance)
            if len(a):
                yield pd.DataFrame({"a": a, "b": b})

    return edges


def links(distinct: DataFrame, distance: int = DISTANCE, leaf_rows: int = LEAF_ROWS
          ) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect
    every pair of at most ``distance`` differing bits."""
    parts = distance + 1
    masks = _masks(list(range(64)), parts)
    level = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask"))
    found = []
    while True:
        nodes = level.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("pattern"), "fp")
        sizes = stored(nodes.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n"))
                       .where("n > 1"), "nodes")
        final = [m for m in masks if 1 << len(_free_bits(m)) <= leaf_rows]
        large = (F.col("n") > leaf_rows) & ~F.col("mask").isin(final)
        leaves = nodes.join(sizes.where(~large), ["mask", "pattern"])
        found.append(leaves.select("mask", "pattern", "fp").repartition("mask", "pattern")
                     .sortWithinPartitions("mask", "pattern")
                     .mapInPandas(_edges_of(distance), "a long, b long"))
        if not sizes.where(large).take(1):
            break
        # Children share their parent's bits and one part of the free ones.
        below = {m: [m | c for c in _masks(_free_bits(m), parts)] for m in masks if m not in final}
        children = F.create_map(*[x for m, cs in below.items()
                                  for x in (F.lit(m), F.array(*[F.lit(c) for c in cs]))])
        level = stored(nodes.join(sizes.where(large), ["mask", "pattern"]).select(
            "fp", F.explode(children[F.col("mask")]).alias("mask")), "refined")
        masks = sorted({c for cs in below.values() for c in cs})
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b) that are not the least of
    their component; root is the least.

    Large stars hand every larger neighbour to a node's least one, small
    stars every smaller neighbour and the node itself, until edges don't
    change any more; each round is a stored table."""
    def tidy(df: DataFrame) -> DataFrame:
        return stored(df.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                            F.sum(F.xxhash64("b", "a") % 1_000_003)).first())

    now = tidy(edges)
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = tidy(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = tidy(small.unionByName(least.select("a", F.col("m").alias("b"))))
        new = state(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def roots(prints: DataFrame, distance: int = DISTANCE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(fp, root, first_id): the group of every distinct fingerprint of
    ``prints`` (id, fp), named by its least fingerprint, and the
    fingerprint's least id."""
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct")
    group = components(links(distinct, distance, leaf_rows))
    return stored(distinct.join(group, distinct["fp"] == group["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id"), "roots")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, distance: int = DISTANCE,
                leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per document: the id, fingerprint (16 hex digits) and
    component_id, the least id of the documents it reaches over links."""
    ship(docs.sparkSession)
    prints = stored(docs.select(F.col(id_col).alias("id"),
                                fingerprints(F.col(text_col), shingle).alias("fp")), "prints")
    named = roots(prints, distance, leaf_rows)
    first = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_print = named.join(first, "root").select("fp", "component_id")
    return prints.join(per_print, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, distance: int = DISTANCE,
                     leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``docs`` without all but one document of each group, with its own
    columns.  The document with the least id stays (rows with a null id
    only where the group has no other; of one id with several texts, the
    text with the least hash).

    Rows are named by id and text hash, so no text is stored again; rows that
    agree in both are one text, of which one row stays.  Only rows that a
    bitmap, sized by the rows that go (64 MB at most), says may go are shuffled."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    prints = stored(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"),
                                fingerprints(F.col(text_col), shingle).alias("fp")), "prints")
    named = roots(prints.select("id", "fp"), distance, leaf_rows)
    rows = (prints.groupBy("id", "hash", "fp").agg(F.count(F.lit(1)).alias("n"))
            .join(named.select("fp", "root"), "fp"))
    best = stored(rows.groupBy("root").agg(F.min_by(
        F.struct("id", "hash"), F.struct(F.col("id").isNull(), "id", "hash")).alias("k")), "best")
    judged = rows.join(best, "root")
    stays = F.col("id").eqNullSafe(F.col("k.id")) & (F.col("hash") == F.col("k.hash"))
    # Classes of rows (id, text hash) that go, or that stay with one row.
    names = {k: free_name(docs, f"__{k}") for k in ("id", "hash", "stays", "own", "look")}
    touched = stored(judged.where(~stays | (F.col("n") > 1)).select(
        F.col("id").alias(names["id"]), F.col("hash").alias(names["hash"]),
        stays.alias(names["stays"])), "touched")

    # All other rows pass straight from the scan.
    hashed = docs.withColumn(names["own"], F.xxhash64(text))
    marked = flagged(hashed, F.xxhash64(id_col, names["own"]), key_filter(touched.select(
        F.xxhash64(names["id"], names["hash"]).alias("key"))), names["look"])
    clear = marked.where(~F.col(names["look"]))
    found = marked.where(F.col(names["look"])).join(
        touched, F.col(id_col).eqNullSafe(F.col(names["id"]))
        & (F.col(names["own"]) == F.col(names["hash"])), "left")
    free = found.where(F.col(names["stays"]).isNull())
    once = (found.where(F.col(names["stays"]))
            .dropDuplicates([names["id"], names["hash"]]))
    return clear.select(*docs.columns).unionByName(free.select(*docs.columns)).unionByName(
        once.select(*docs.columns))
