"""Ranked lexical search by TPUT, the three-phase uniform threshold (Cao and Wang, 2004), over term-partitioned postings.

Postings are a table of (term, impact, document), partitioned by ranges of term and impact, so that a frequent term lies in
several partitions. For each query, the heads of its terms' lists give a lower bound of the last score that counts; every
list then sends whatever reaches that bound divided by the number of lists, which raises the bound and leaves the documents
whose scores may still reach it; these are looked up in the table of documents and scored exactly.

Queries travel to the executors in blocks of at most BLOCK_TERMS terms. Values of a list are sent once for all queries of a
block, and summed by document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.llm.common import chunks, forget, scratch

#: Results of a query; terms of a block of queries, unless one query alone has more; bytes of a text that are split at once.
BEST, BLOCK_TERMS, PIECE = 50, 500_000, 1 << 20
#: Cells (document, query) and products that one numpy step works on.
CELLS = 1 << 21
#: Fixed value: ASCII letters and digits and all bytes of other letters make terms, A-Z counting as a-z.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, some at a time."""
    text, start = text.translate(TERM_BYTES), 0
    while start < len(text):
        end = start + PIECE
        if end < len(text):
            cut = text.rfind(b" ", start, end)
            end = cut if cut > start else text.find(b" ", end)
        end = len(text) if end < 0 else min(end, len(text))
        yield text[start:end].split()
        start = end


@dataclass
class Block:
    """Some queries: their rows, and for each of their terms the queries that have it (in `query`, from `first[t]` on)."""

    rows: list[int]
    words: dict[bytes, int]
    first: np.ndarray
    query: np.ndarray


def _block(found: list[tuple[int, list[bytes]]]) -> Block:
    words = {w: i for i, w in enumerate(sorted({w for _, ws in found for w in ws}))}
    term = np.array([words[w] for _, ws in found for w in ws], np.int64)
    query = np.repeat(np.arange(len(found)), [len(ws) for _, ws in found])
    order = np.argsort(term, kind="stable")
    return Block([r for r, _ in found], words, np.searchsorted(term[order], np.arange(len(words) + 1)), query[order])


def _queries(items: DataFrame) -> Iterator[Block]:
    """Blocks of the queries that have a term; `items` has row and text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array([sorted({w for ws in terms(t) for w in ws}) for t in texts], pa.list_(pa.binary()))], ["row", "words"])

    held, total = [], 0
    for r in items.mapInArrow(split, "row long, words array<binary>").where("size(words) > 0").toLocalIterator():
        if held and total + len(r.words) > BLOCK_TERMS:
            yield _block(held)
            held, total = [], 0
        held.append((r.row, [bytes(w) for w in r.words]))
        total += len(r.words)
    if held:
        yield _block(held)


def _documents(docs: DataFrame, words: dict[bytes, int]) -> DataFrame:
    """Documents with a term: row, id, n (all its terms), and those of `words` that it has, with their numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                n, found, times = [], [], []
                for text in texts:
                    counts, all_terms = Counter(), 0
                    for ws in terms(text):
                        all_terms += len(ws)
                        counts.update(map(words.get, ws))
                    counts.pop(None, None)
                    n.append(all_terms)
                    found.append(list(counts))
                    times.append(list(counts.values()))
                out = pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))], ["row", "id", "n", "terms", "times"])
                yield out.filter(pa.compute.greater(out.column("n"), 0))

    return docs.mapInArrow(count, f"row long, id {docs.schema['id'].dataType.simpleString()}, n long, terms array<int>, times array<long>")


def _sums(block: Block, doc: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int, low: np.ndarray, top: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of documents: the first one, and by document and query the sum of the values from `low` on, and of the most
    that those lists' values could have been (`top`) if given. Documents are numbered as they come in `doc`."""
    queries, each = len(block.rows), np.diff(block.first)[term]
    starts = np.searchsorted(doc, np.arange(docs + 1))
    work = np.concatenate([[0], np.cumsum(each)])[starts] + np.arange(docs + 1) * queries
    at = 0
    while at < docs:
        end = max(at + 1, int(np.searchsorted(work, work[at] + CELLS, "right")) - 1)
        s = slice(starts[at], starts[end])
        own = np.repeat(np.arange(s.start, s.stop), each[s])
        place = np.arange(len(own)) - np.repeat(np.cumsum(each[s]) - each[s], each[s])
        query = block.query[block.first[term[own]] + place]
        sent = value[own] >= low[query]
        own, query = own[sent], query[sent]
        cell = (doc[own] - at) * queries + query
        shape, size = (end - at, queries), (end - at) * queries
        total = np.bincount(cell, value[own], size).reshape(shape)  # below 2**53, so exact
        yield at, total, total if top is None else np.bincount(cell, np.minimum(low[query], top[term[own]]), size).reshape(shape)
        at = end


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Of a column of lists: the number of the row of each value, and the values."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), column.flatten()


def _last(df: DataFrame, k: int) -> dict[int, int]:
    """The k-th highest `score` of each query that has as many."""
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    rows = df.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    return {r.query: int(r.least) for r in rows.groupBy("query").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k).collect()}


def _search(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """Of each query of the block the best documents, and some more: query, id, row, score."""
    spark, queries = docs.sparkSession, len(block.rows)
    known = scratch(_documents(docs, block.words))
    n_docs, n_terms = known.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    empty = spark.createDataFrame([], f"query int, id {docs.schema['id'].dataType.simpleString()}, row long, score long")
    if not n_docs:
        return empty
    counts = np.zeros(len(block.words), np.int64)
    for r in known.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        counts[r.term] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in counts], np.int64)
    held = spark.createDataFrame(pa.table({"term": pa.array(np.arange(len(weight)), pa.int32()), "weight": weight}))

    # The postings, by term and from the highest impact down.
    longer = F.lit(100 - 50) + F.expr(f"(50 * n * {n_docs}L) div {n_terms}L")
    pairs = known.select("row", longer.alias("m"), F.explode(F.arrays_zip("terms", "times")).alias("p")).select("row", "m", F.col("p.terms").alias("term"), F.col("p.times").alias("tf"))
    impact = F.expr("(1000000000L * tf) div (1000 * tf + 20 * m)")
    postings = scratch(pairs.select("term", impact.alias("x"), "row").repartitionByRange("term", F.desc("x"), "row").sortWithinPartitions("term", F.desc("x")))

    # First phase: the heads of the lists.
    down = Window.partitionBy("term").orderBy(F.desc("x"), "row")
    heads = scratch(postings.withColumn("place", F.row_number().over(down)).where(F.col("place") <= k).join(F.broadcast(held), "term").select("term", "row", "place", (F.col("x") * F.col("weight")).alias("value")))
    asks = spark.createDataFrame(pa.table({"term": pa.array(np.repeat(np.arange(len(weight)), np.diff(block.first)), pa.int32()), "query": pa.array(block.query, pa.int32())}))
    low = _last(heads.join(F.broadcast(asks), "term").groupBy("query", "row").agg(F.sum("value").alias("score")), k)
    bound = np.array([low.get(q, 0) for q in range(queries)], np.int64)
    top = np.zeros(len(weight), np.int64)
    for r in heads.where("place = 1").select("term", "value").collect():
        top[r.term] = r.value
    forget(heads)

    # Second phase: every list sends what reaches the bound over the number of lists.
    lists = np.bincount(block.query, np.repeat(counts > 0, np.diff(block.first)), queries).astype(np.int64)
    least = bound // np.maximum(lists, 1)
    by_term = np.minimum.reduceat(least[block.query], block.first[:-1])
    cut = np.where(weight > 0, -(-by_term // np.maximum(weight, 1)), np.where(by_term > 0, 1 << 40, 0))
    cuts = spark.createDataFrame(pa.table({"term": pa.array(np.arange(len(cut)), pa.int32()), "cut": cut}))
    sent = postings.join(F.broadcast(cuts), "term").where("x >= cut").groupBy("row").agg(F.collect_list(F.struct("term", "x")).alias("sent"))
    sent = scratch(sent)
    forget(postings)
    most = np.bincount(block.query, np.minimum(least[block.query], np.repeat(top, np.diff(block.first))), queries)

    def summed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        doc, pairs = _lists(batch.column("sent"))
        term, x = (pairs.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        return _sums(block, doc, term, weight[term] * x, batch.num_rows, least, top)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each query the best sums of a slice of documents."""
        for batch in batches:
            for _, total, _ in summed(batch):
                best = np.partition(total, -k, axis=0)[-k:] if len(total) > k else total
                query = np.broadcast_to(np.arange(queries), best.shape)[best > bound]
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(best[best > bound].astype(np.int64))], ["query", "score"])

    low = _last(sent.mapInArrow(partial, "query int, score long"), k)
    bound = np.maximum(bound, [low.get(q, 0) for q in range(queries)])

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """By document, the queries for which the values that weren't sent may still bring it up to the bound."""
        for batch in batches:
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            for at, total, possible in summed(batch):
                doc, query = np.nonzero((total > 0) & (total + most - possible >= bound))
                ends = np.searchsorted(doc, np.arange(len(total) + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(query, pa.int32()))
                out = pa.RecordBatch.from_arrays([pa.array(rows[at : at + len(total)]), lists], ["row", "queries"])
                yield out.filter(pa.array(np.diff(ends) > 0))

    # Third phase: exact scores of the documents that are left.
    left = scratch(sent.mapInArrow(reach, "row long, queries array<int>"))
    forget(sent)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(queries, np.int64)
        for batch in batches:
            doc, term = _lists(batch.column("terms"))
            term, tf = term.to_numpy(zero_copy_only=False), _lists(batch.column("times"))[1].to_numpy(zero_copy_only=False)
            m = batch.column("m").to_numpy(zero_copy_only=False)[doc]
            own, asked = _lists(batch.column("queries"))
            asked = asked.to_numpy(zero_copy_only=False)
            for at, total, _ in _sums(block, doc, term, weight[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m)), batch.num_rows, none):
                mine = slice(*np.searchsorted(own, (at, at + len(total))))
                wanted = np.zeros(total.shape, bool)
                wanted[own[mine] - at, asked[mine]] = True
                i, query = np.nonzero(wanted & (total > 0))
                take = pa.array(i + at)
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), batch.column("id").take(take), batch.column("row").take(take), pa.array(total[i, query].astype(np.int64))], ["query", "id", "row", "score"])

    looked = left.join(known, "row").select("row", "id", longer.alias("m"), "terms", "times", "queries")
    return looked.mapInArrow(exact, empty.schema)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """The k best documents of each query: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z counting as a-z; a null text has
    none. Only scores above 0 count; equal ones go by ascending id, null last, then in any order. A query without a term, or
    whose terms no document has, gives no row; rows that repeat a query or a document are queries and documents of their own.
    Empty tables give an empty result; other columns are ignored.
    """
    asked = scratch(items.select(F.monotonically_increasing_id().alias("row"), F.col(item_col).alias("item"), F.col(query_col).alias("text")))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    best, out = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row"), None
    for block in _queries(asked.select("row", "text")):
        found = _search(texts, block, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        names = docs.sparkSession.createDataFrame(pa.table({"query": pa.array(range(len(block.rows)), pa.int32()), "of": pa.array(block.rows, pa.int64())}))
        found = found.join(F.broadcast(names), "query").select("of", "rank", "id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return asked.limit(0).join(texts.limit(0).select("id"), F.lit(True)).select(F.col("item").alias("item_id"), F.lit(1).alias("rank"), F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out.join(asked.select(F.col("row").alias("of"), "item"), "of").select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
