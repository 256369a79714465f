"""Merkle manifest of a table by superblocks: leaves are numbered within their groups, and buckets of FANOUT ** LEVELS
consecutive ones collapse by so many levels at once; the buckets' roots are the next round's nodes, until each group has
one. The groups' roots, in the order of the groups, are reduced in the same way to the root of all.

A proof is the siblings on the way to the root. Its lower part comes from the bucket that a node is in, the upper part from
the rounds above, joined by bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ladderworks.llm.common import scratch

#: Nodes of a run, and levels that a bucket collapses at once: 729 nodes, whose siblings are 384 bytes each at most.
FANOUT, LEVELS = 3, 6
#: Bits of monotonically_increasing_id that number the rows of a partition.
ROW_BITS = 33
#: Most groups whose roots and proofs are broadcast (some 1 KB each); more are joined by a shuffle that Spark splits where it is skewed.
GROUPS = 10_000


def leaf(*values: Column) -> Column:
    """The digest (32 bytes) of a row: each value as its UTF-8 byte count, a colon and itself, or `-` if it is null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def digest(nodes: list[bytes]) -> bytes:
    """SHA-256 of digests that are written one after the other as lower-case hex text."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def height(n: int, fanout: int = FANOUT) -> int:
    """Levels above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def collapse(nodes: list[bytes], levels: int, fanout: int = FANOUT) -> tuple[list[bytes], list[bytes]]:
    """The nodes `levels` levels above consecutive nodes, and each node's siblings on the way, from left to right by level."""
    proofs = [[] for _ in nodes]
    width = 1
    for _ in range(levels):
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        others = [b"".join(run[:j] + run[j + 1 :]) for run in runs for j in range(len(run))]
        for i, proof in enumerate(proofs):
            proof.append(others[i // width])
        nodes, width = [digest(run) for run in runs], width * fanout
    return nodes, [b"".join(p) for p in proofs]


def fold(node: bytes, proof: bytes, index: int, n: int, fanout: int = FANOUT) -> tuple[bytes, bytes]:
    """The root that `node`, number `index` of n, gives with its siblings, and what is left of the proof."""
    while n > 1:
        place, run = index % fanout, min(fanout, n - index // fanout * fanout)
        own, proof = proof[: 32 * (run - 1)], proof[32 * (run - 1) :]
        node = digest([own[: 32 * place], node, own[32 * place :]])
        index, n = index // fanout, -(-n // fanout)
    return node, proof


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with `at`, the number of each row in that order from 0, and `part`, the partition of the sort that it was in.

    A sort by ranges numbers the rows of each partition; the counts of the partitions before, a row for each, are added.
    """
    by_range = scratch(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("at", ROW_BITS)
    counts = by_range.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", before.alias("before"))
    return by_range.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("at", F.col("at").bitwiseAND((1 << ROW_BITS) - 1) + F.col("before")).drop("before")


def reduced(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Of nodes (tree, at, n, node: number `at` of the n nodes of a tree): (tree, at, proof), and the roots (tree, root)."""
    width = fanout**levels

    def bucket(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        up, proofs = collapse(group["node"].tolist(), min(levels, height(int(group["n"].iloc[0]), fanout)), fanout)
        return pd.DataFrame({"tree": group["tree"], "at": group["at"], "n": group["n"], "proof": proofs, "up": up + [None] * (len(group) - 1)})

    rounds, most = [], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        done = scratch(nodes.groupBy("tree", F.expr(f"at div {width}")).applyInPandas(bucket, "tree long, at long, n long, proof binary, up binary"))
        rounds.append(done)
        nodes = done.where("up is not null").select("tree", F.expr(f"at div {width}").alias("at"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), F.col("up").alias("node"))
        most = -(-most // width)
        if most <= 1:
            break
    proofs = rounds.pop().select("tree", "at", "proof")
    while rounds:
        upper = proofs.select("tree", F.col("at").alias("bucket"), F.col("proof").alias("upper"))
        lower = rounds.pop().select("tree", F.expr(f"at div {width}").alias("bucket"), "at", "proof")
        proofs = lower.join(upper, ["tree", "bucket"]).select("tree", "at", F.concat("proof", "upper").alias("proof"))
    return proofs, nodes.select("tree", F.col("node").alias("root"))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), also: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per row of `docs`: id, leaf, at and n (its place among the group's leaves and their number), tree and trees (the
    group's place and their number), subroot, root, proof (siblings up to the root), digests being 32 bytes, and `also`.

    A leaf is the digest of the fields, each with its length, null apart from empty. Leaves ascend by id within their group,
    null first; rows that repeat an id ascend by leaf, and equal rows have places of their own. Null is a group, the first;
    the others ascend by their UTF-8 bytes. Every run of `fanout` nodes has a parent, the last run with fewer too. An empty
    table gives an empty result; other columns are ignored.
    """
    rows = scratch(docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("of"), leaf(*(F.col(c) for c in fields)).alias("leaf"), (F.lit(None) if also is None else also).cast("binary").alias("also")))
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # so that equal rows need not lie in one range
    leaves = scratch(numbered(rows, F.col("of").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("row")))
    # A group's rows are consecutive, so that a row for each group and partition places them.
    spans = leaves.groupBy("of", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    spans = spans.groupBy("of").agg(F.min("start").alias("start"), F.sum("n").alias("n"), F.collect_list("part").alias("parts"))
    trees = scratch(numbered(spans, F.col("start")).withColumnRenamed("at", "tree").drop("part"))
    named = trees.select(F.col("of").alias("of2"), "start", "n", "tree", F.explode("parts").alias("part2"))
    placed = leaves.join(named, F.col("of").eqNullSafe(F.col("of2")) & (F.col("part") == F.col("part2")))
    placed = scratch(placed.select("id", "leaf", "also", "tree", "n", (F.col("at") - F.col("start")).alias("at")))
    lower, subroots = reduced(placed.select("tree", "at", "n", F.col("leaf").alias("node")), fanout, levels)
    count = trees.count()
    tops = scratch(subroots.withColumnRenamed("root", "subroot"))
    upper, root = reduced(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("node")), fanout, levels)
    root = root.first() or {"root": b""}
    upper = upper.select(F.col("at").alias("tree"), F.col("proof").alias("upper")).join(tops, "tree")
    proved = placed.join(lower, ["tree", "at"]).join(F.broadcast(upper) if count <= GROUPS else upper, "tree")
    return proved.select("id", "leaf", "at", "n", "tree", F.lit(count).cast("long").alias("trees"), "subroot", F.lit(bytes(root["root"])).alias("root"), F.concat("proof", "upper").alias("proof"), "also")


def folded(rows: DataFrame, node: str, fanout: int = FANOUT) -> DataFrame:
    """Rows of a manifest with `folded`: the root that the digest in column `node` gives with the row's siblings."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (node, "proof", "at", "n", "tree", "trees")]
            roots = []
            for start, proof, at, n, tree, trees in zip(*columns, strict=True):
                start, proof = fold(start, proof, at, n, fanout)
                roots.append(fold(start, proof, tree, trees, fanout)[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.binary())], [*batch.schema.names, "folded"])

    return rows.mapInArrow(up, StructType([*rows.schema, StructField("folded", BinaryType())]))


def tampered(docs: DataFrame) -> DataFrame:
    """The manifest of documents, folded again where 2 divides the CRC-32 of the id, after the line ends of the text were
    deleted: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, in hex. A row with a null id isn't tampered with.
    """
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    changed = leaf(*(F.col(c) for c in fields[:-1]), F.translate("text", "\n", ""))
    other = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, changed)
    rows = manifest(docs, also=other).withColumn("start", F.coalesce("also", "leaf"))
    rows = folded(rows, "start")
    text = lambda c: F.lower(F.hex(c))
    return rows.select(
        F.col("id").alias("doc_id"), *(text(c).alias(c) for c in ("leaf", "subroot", "root")), F.sha2(text("proof").cast("binary"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )
