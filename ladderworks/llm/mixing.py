"""Mixing sources to target weights by hierarchical budgets.

A token budget goes down a tree of domains, languages and sources in proportion to the nodes' weights. A node can take at
most its documents' tokens times the epochs allowed; what it cannot take goes to its siblings in proportion, and only what
all siblings together cannot take goes to the next level up. Each leaf then gives whole epochs of its documents and a
token prefix of one more, in an order drawn from the seed. Where the prefix ends is found from sums over BUCKETS ranges of
the order, so only the documents of the range that holds the end are sorted, whatever the leaf's size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.llm.common import boxed

#: Most leaves of the tree, which is planned on the driver; ranges of a leaf's order.
MAX_LEAVES, BUCKETS = 100_000, 4096
LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"


def share(budget: int, weights: list[float], room: list[int]) -> list[int]:
    """`budget` by weight, none above its room; the rest goes to the others by weight until all is given or all are full."""
    got, open_ = [0] * len(room), [i for i, w in enumerate(weights) if w > 0 and room[i] > 0]
    while open_ and budget > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if room[i] <= budget * weights[i] / total]
        if not full:
            given = {i: int(budget * weights[i] / total) for i in open_}
            for i in open_[: budget - sum(given.values())]:  # tokens lost to rounding
                given[i] += 1
            for i, n in given.items():
                got[i] = min(n, room[i])
            break
        for i in full:
            got[i] = room[i]
        budget -= sum(room[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return got


def budgets(room: Mapping[tuple, int], weights: Mapping[tuple, float], budget: int) -> dict[tuple, int]:
    """Tokens for each leaf (a path through LEVELS), given what each can take. A node without a weight has weight 1."""

    def down(paths: list[tuple], depth: int, tokens: int) -> dict[tuple, int]:
        if depth == len(LEVELS):
            return {paths[0]: tokens}
        parts: dict[tuple, list[tuple]] = {}
        for p in paths:
            parts.setdefault(p[: depth + 1], []).append(p)
        given = share(tokens, [weights.get(k, 1.0) for k in parts], [sum(room[p] for p in v) for v in parts.values()])
        return {p: n for (_, v), t in zip(parts.items(), given, strict=True) for p, n in down(v, depth + 1, t).items()}

    return down(sorted(room), 0, min(budget, sum(room.values()))) if room else {}


def mixed(docs: DataFrame, domain: Column, weights: Mapping[tuple, float], *, budget_share: float, epochs: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixture as rows (doc, domain, epoch, tokens, taken): all columns of a document, its words, and how many of the first are taken.

    Tokens are words. The budget is `budget_share` of all tokens. A document comes once for each epoch that takes it. Null
    texts have no tokens; null domains, languages and sources count as values of their own. Documents without tokens come
    with whole epochs, and with a prefix that ends after their place. Rows that repeat an id are drawn by their texts
    as well; of equal ones it makes no difference which is taken. Very long texts count whole. An empty table, or one without tokens, gives an empty result.
    """
    spark = docs.sparkSession
    leaf = [F.coalesce(c, F.lit("")) for c in (domain, F.col("lang"), F.col("source"))]
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = boxed(docs, leaf=F.array(*leaf), domain=leaf[0], tokens=tokens, id=F.col(id_col), ends_text=F.xxhash64(F.col(text_col)))
    found = rows.groupBy("leaf").agg(F.sum("tokens").alias("n")).limit(MAX_LEAVES + 1).collect()
    if len(found) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves")
    have = {tuple(r["leaf"]): r["n"] for r in found if r["n"]}
    given = budgets({k: n * epochs for k, n in have.items()}, weights, int(budget_share * sum(have.values())))
    plan = spark.createDataFrame([(list(k), n // have[k], n % have[k]) for k, n in given.items() if n], "leaf array<string>, whole int, rest long")
    draw = F.xxhash64(F.lit(seed), "whole", "id", "ends_text")
    drawn = rows.join(F.broadcast(plan), "leaf").withColumn("draw", draw).withColumn("part", F.shiftrightunsigned("draw", 52))
    sums = drawn.where("rest > 0").groupBy("leaf", "rest", "part").agg(F.sum("tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("leaf").orderBy("part")) - F.col("n")
    ends = sums.withColumn("before", before).where("before < rest").groupBy("leaf").agg(F.max("part").alias("end"), F.max("before").alias("before"))
    ends = spark.createDataFrame(ends.collect(), ends.schema)  # a row for each leaf at most
    drawn = drawn.join(F.broadcast(ends), "leaf", "left")
    keep = ["doc", "domain", "epoch", "tokens", "taken"]
    none = F.array().cast("array<int>")
    whole = F.when(F.col("whole") > 0, F.sequence(F.lit(0), F.col("whole") - 1)).otherwise(none)
    more = F.when(F.col("part") < F.col("end"), F.array("whole")).otherwise(none)
    sure = drawn.withColumn("epoch", F.explode(F.concat(whole, more))).withColumn("taken", F.col("tokens")).select(keep)
    order = Window.partitionBy("leaf").orderBy("draw", "id", "tokens", "ends_text").rowsBetween(Window.unboundedPreceding, -1)
    last = drawn.where("part = end").withColumn("at", F.col("before") + F.coalesce(F.sum("tokens").over(order), F.lit(0)))
    prefix = last.where("at < rest").withColumn("epoch", F.col("whole")).withColumn("taken", F.least(F.col("tokens"), F.col("rest") - F.col("at"))).select(keep)
    return sure.unionByName(prefix)


def cut_text(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of `mixed` as documents: the text cut to the tokens taken, and n_chars with it if there is one.

    Texts taken whole stay as they are, null and empty ones included; cut ones are their first words, joined by one space. Other
    columns, whatever their names, stay; an empty table stays empty; a document comes as often as `mixed` gives it.
    """
    text, cut = F.col(f"doc.{text_col}"), F.col("taken") < F.col("tokens")
    words = F.slice(F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+"), F.lit(1), F.col("taken").cast("int"))
    new = {text_col: F.when(cut, F.array_join(words, " ")).otherwise(text)}
    fields = rows.schema["doc"].dataType
    if "n_chars" in fields.names:
        new["n_chars"] = F.when(cut, F.char_length(new[text_col]).cast(fields["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return rows.select(*(new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in fields.names))
