"""SimHash near-duplicates, searched through a vantage-point tree.

Distinct fingerprints are dealt to the leaves of a tree of vantage points: at a node a fingerprint goes left if its
Hamming distance to the vantage point is at most the node's bound, else right. By the triangle inequality two
fingerprints that differ in r bits have distances at most r apart, so a right-hand fingerprint within r of the bound also
goes left as a visitor; every other branch is pruned. Each pair within r then meets in some leaf. Leaves are searched
exactly, in blocks, and give links of a spanning forest only, never all pairs of a dense group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderworks.llm.common import boxed, chunks, components, scratch

#: Fingerprints of a leaf, on average; the tree is as deep as the table of fingerprints needs for that.
LEAF = 4096
#: Fingerprints sampled per leaf for the choice of vantage points, and the most levels. The driver gets 262,144 sampled
#: fingerprints (2 MB) at most, whatever the input, and the tree has 8,192 leaves; leaves that grow beyond LEAF have trees of their own.
SAMPLE, LEVELS = 32, 13
#: Largest differing bits of linked fingerprints.
RADIUS = 2
BLOCK = 1024
#: Most frequent fingerprints whose rows are judged by broadcast; any other has fewer than one in HOT of all rows.
HOT = 1024
SEED = 42


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of the text's word shingles: a bit is set if it is set in over half of the shingles' hashes."""
    found = text.lower().split()  # of bytes: A-Z and the six ASCII white-space characters
    if not found:
        return 0
    if len(found) < words:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    line, digest, ends, start = b" ".join(found), xxhash.xxh64_intdigest, [], 0
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = [0, *ends[:-words].tolist()]
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)], dtype="<u8")
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint (the 64 bits as a long) of each row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def grow(sample: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and bounds of a full binary tree in heap order, chosen from a sample (uint64) to halve it at each node."""
    points, bounds = np.zeros(2**levels - 1, np.uint64), np.zeros(2**levels - 1, np.int16)
    held = {0: sample}
    for node in range(2**levels - 1):
        own = held.pop(node, sample[:0])
        if not len(own):
            own = sample[node % max(len(sample), 1) :][:1]
        if len(own):
            points[node] = own[node * 2654435761 % len(own)]
            away = np.bitwise_count(own ^ points[node]).astype(np.int16)
            bounds[node] = int(np.median(away))
            held |= {2 * node + 1: own[away <= bounds[node]], 2 * node + 2: own[away > bounds[node]]}
    return points, bounds


def route(fps: np.ndarray, points: np.ndarray, bounds: np.ndarray, levels: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and leaves: each fingerprint's own leaf and those that it visits within the radius of a bound."""
    row, node = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    for _ in range(levels):
        away = np.bitwise_count(fps[row] ^ points[node]).astype(np.int16) - bounds[node]
        left, right = away <= radius, away > 0
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    return row, node - (2**levels - 1)


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def near(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint of a leaf the number of the first one of its group of links within the radius."""
    forest = Forest(len(fps))
    for a in range(0, len(fps), BLOCK):
        for b in range(a, len(fps), BLOCK):
            linked = np.bitwise_count(fps[a : a + BLOCK, None] ^ fps[None, b : b + BLOCK]) <= radius
            while linked.any():  # of the links that still join two groups, one for each column; then again
                x, y = (np.array([forest.root(i) for i in range(at, min(at + BLOCK, len(fps)))]) for at in (a, b))
                linked &= x[:, None] != y[None, :]
                columns = np.flatnonzero(linked.any(axis=0))
                for i, j in zip((linked[:, columns].argmax(axis=0) + a).tolist(), (columns + b).tolist(), strict=True):
                    forest.join(i, j)
    return np.array([forest.root(i) for i in range(len(fps))])


def leaf_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of one leaf. A leaf far above the usual size is first dealt out by a tree of its own."""
    if len(fps) > 4 * LEAF:
        levels = math.ceil(math.log2(len(fps) / LEAF))
        points, bounds = grow(fps[:: max(1, len(fps) // (SAMPLE << levels))], levels)
        row, leaf = route(fps, points, bounds, levels, radius)
        order = np.argsort(leaf, kind="stable")
        parts = np.split(fps[row[order]], np.flatnonzero(np.diff(leaf[order])) + 1)
        if max(map(len, parts)) < 0.9 * len(fps):
            found = [leaf_links(p, radius) for p in parts]
            return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])
    first = near(fps, radius)
    linked = first != np.arange(len(fps))
    return fps[linked], fps[first[linked]]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints (column fp) within `radius` bits, as a spanning forest by leaf."""
    n = distinct.count()
    levels = min(LEVELS, max(0, math.ceil(math.log2(max(n, 1) / LEAF))))
    taken = distinct.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE << levels).toArrow()["fp"].to_numpy() if levels else np.zeros(0, np.int64)
    points, bounds = grow(taken.view(np.uint64), levels)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            row, leaf = route(fps, points, bounds, levels, radius)
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array(fps[row].view(np.int64))], ["leaf", "fp"])

    def links(group: pd.DataFrame) -> pd.DataFrame:
        a, b = leaf_links(np.sort(group["fp"].to_numpy().view(np.uint64)), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct.select("fp").mapInArrow(deal, "leaf int, fp long").groupBy("leaf").applyInPandas(links, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Texts are lower-cased (A-Z) and hashed by three-word shingles; a text of one or two words is one shingle, one without
    words (or null) has the fingerprint zero, which is linked like any other. component_id is the smallest doc_id that
    links of at most `radius` bits lead to. Rows that repeat an id get its row each; an empty table gives an empty result.
    """
    prints = scratch(fingerprints(docs, id_col, text_col))
    distinct = scratch(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    roots = components(fingerprint_links(distinct, radius))
    placed = roots.join(distinct, roots["node"] == distinct["fp"]).select("node", "root", "least")
    groups = placed.join(placed.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "component")
    known = scratch(distinct.join(groups, distinct["fp"] == groups["node"], "left").select("fp", "n", F.coalesce("component", "least").alias("component_id")))
    rows = _with_groups(prints, known)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def _with_groups(prints: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, print and component_id of all rows.

    The HOT most frequent fingerprints, whose rows are the large groups of equal texts, are joined by broadcast; in the
    join for the others their rows have keys of their own, so that no task gets more than its share.
    """
    hot = known.where("n > 1").orderBy(F.desc("n"), "fp").limit(HOT).select("fp", F.col("component_id").alias("hot_id"))
    rows = prints.withColumn("print", F.col("fp")).join(F.broadcast(scratch(hot)), "fp", "left")
    rows = rows.withColumn("fp", F.when(F.col("hot_id").isNull(), F.col("fp")).otherwise(F.xxhash64("doc_id", "fp"))).alias("r")
    rows = rows.join(known.alias("k"), F.col("r.fp") == F.col("k.fp"), "left")
    return rows.select("doc_id", "print", F.coalesce("hot_id", "component_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of `docs` with the smallest id of each group, with all columns."""
    groups = scratch(near_groups(docs, id_col, text_col, radius))
    gone = groups.where("component_id < doc_id").select(F.col("doc_id").alias("key")).distinct()
    return boxed(docs, id=F.col(id_col)).join(gone.hint("shuffle_hash"), F.col("id") == F.col("key"), "left_anti").select("doc.*")
