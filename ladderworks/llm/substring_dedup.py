"""Removal of repeated passages: every window of words that occurs earlier in the corpus goes.

Windows meet by content. A window is known by 75 bits or more of two hashes of all its words: one of BUCKETS buckets or more
and 64 bits beside it. Each few megabytes of text give one row per bucket, with the hash, document and start of each window that is
new there; a window that occurred before in the same text is settled there. So a window, however common, comes once
from each chunk of input, and buckets are even whatever the texts hold. Buckets are shuffled and judged one after the
other: all windows but the first by document and start are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderworks.llm.common import chunks, worker_state

WINDOW = 20
#: Words of the grams that the bucket is made from.
GRAM = 6
#: Least number of buckets (at 30 GB one has some two million windows) and how many there are for each input partition
#: beyond that, so that a bucket stays as large whatever the input.
BUCKETS, EACH = 2048, 2
#: Whole buckets of so many windows are judged at once, or one bucket alone.
JUDGED = 1 << 21
#: Most words whose hash a worker remembers.
REMEMBERED = 1_500_000
#: Stands for a null id, which comes last.
NO_ID = 2**63 - 1
#: Windows by bucket: `first` is the document of the first one, `docs` what each adds to it. Settled spans have no hashes.
PIECES = "bucket int, first long, hashes binary, docs binary, starts binary, ends binary"
PRESSED = "doc_id long, doc long, text binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for j in range(n):
        out = out * _ODD + codes[j : j + len(out)]
    return _mixed(out)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest unsigned type that holds them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def _blobs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _planes(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A blob per range of values: all their lowest bytes, then the next ones, which compress well if they are zeros."""
    values = _narrow(values)
    width, sizes = values.itemsize, np.diff(offsets)
    data = values.view(np.uint8).reshape(-1, width)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = (width - 1) * offsets[:-1][row] + np.arange(len(values))
    out = np.empty(data.size, np.uint8)
    for b in range(width):
        out[at + b * sizes[row]] = data[:, b]
    return _blobs(out, offsets * width)


def _from_planes(blob: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(-1, n).T).view(f"u{len(blob) // n}")[:, 0]


def _piece(bucket: np.ndarray, first: np.ndarray, *columns: pa.Array | None) -> pa.RecordBatch:
    filled = [pa.nulls(len(bucket), pa.binary()) if c is None else c for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(first.astype(np.int64)), *filled], ["bucket", "first", "hashes", "docs", "starts", "ends"])


def _keys(codes: np.ndarray, start: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """64 bits of hash and the bucket of the windows at `start`, both of all their words."""
    grams = _grams(codes, GRAM)
    other = sum((_mixed(grams[start + j] + np.uint64(j)) for j in (0, GRAM, 2 * GRAM, WINDOW - GRAM)), np.zeros(len(start), np.uint64))
    return _grams(codes, WINDOW)[start], (_mixed(other) % np.uint64(buckets)).astype(np.int32)


def _pieces(ids: np.ndarray, split: list[list[bytes]], hashes: WordHashes, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of PIECES for some documents, in the order of their ids."""
    lengths = np.array([len(w) for w in split], np.int64)
    codes = np.fromiter((hashes[w] for words in split for w in words), np.uint64, count=int(lengths.sum()))
    if len(codes) < WINDOW:
        return
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.flatnonzero(owner[: len(codes) - WINDOW + 1] == owner[WINDOW - 1 :])
    if not len(place):
        return
    own = owner[place]
    doc, start = ids[own], place - (np.cumsum(lengths) - lengths)[own]
    key, bucket = _keys(codes, place, buckets)
    if (ids[1:] == ids[:-1]).any():  # rows of one document: its windows by start
        order = np.lexsort((start, doc))
        doc, start, key, bucket = doc[order], start[order], key[order], bucket[order]
    group = pd.factorize(pd.factorize(key)[0] * buckets + bucket)[0]
    leader = np.full(group.max() + 1, len(doc))
    np.minimum.at(leader, group, np.arange(len(doc)))
    known = leader[group] < np.arange(len(doc))
    gone = known & ((doc[leader[group]] != doc) | (start[leader[group]] != start))
    if gone.any():
        spans = _merged(doc[gone], start[gone], start[gone] + WINDOW)
        one = np.array([0, len(spans)])
        yield _piece(bucket[gone][:1], np.zeros(1), None, *(_blobs(spans.column(c).to_numpy(), one) for c in ("doc", "start", "end")))
    at = np.flatnonzero(~known)
    at = at[np.argsort(bucket[at], kind="stable")]
    doc, bucket = doc[at], bucket[at]
    new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    first = np.flatnonzero(new)
    step = np.diff(doc.view(np.uint64), prepend=doc[:1].view(np.uint64))
    step[new] = 0
    offsets = np.append(first, len(at))
    yield _piece(bucket[first], doc[first], _blobs(key[at], offsets), _planes(step, offsets), _planes(start[at], offsets), None)


def _dealt(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_state("word hashes", WordHashes)
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                if len(hashes) > REMEMBERED:
                    hashes.clear()
                ids = part.column("doc").to_numpy()
                order = np.argsort(ids, kind="stable")
                yield from _pieces(ids[order], [texts[i].split() for i in order], hashes, buckets)

    return run


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """The given spans of words, those of a document that touch made one."""
    if len(doc):
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        rank = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])]) << 40
        reach = np.maximum.accumulate(rank + end)
        new = np.concatenate([[True], rank[1:] + start[1:] > reach[:-1]])
        at = np.flatnonzero(new)
        doc, start, end = doc[at], start[at], (reach - rank)[np.append(at[1:], len(new)) - 1]
    return pa.RecordBatch.from_arrays([pa.array(doc.astype(np.int64)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["doc", "start", "end"])


def _unpacked(pieces: pa.Table) -> tuple[np.ndarray, ...]:
    """bucket, hash, document and start of all windows of some rows."""
    out = []
    for bucket, first, hashes, docs, starts in zip(*(pieces[c].to_pylist() for c in ("bucket", "first", "hashes", "docs", "starts")), strict=True):
        n = len(hashes) // 8
        steps, at = _from_planes(docs, n), _from_planes(starts, n)
        out.append((np.full(n, bucket, np.int32), np.frombuffer(hashes, np.uint64), np.cumsum(steps, dtype=np.uint64).view(np.int64) + first, at.astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _later(pieces: pa.Table) -> Iterator[pa.RecordBatch]:
    """Spans that occur earlier, of all windows of some buckets."""
    settled = pieces.filter(pa.compute.is_null(pieces["hashes"]))
    for docs, starts, ends in zip(*(settled[c].to_pylist() for c in ("docs", "starts", "ends")), strict=True):
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(docs, np.int64)), pa.array(np.frombuffer(starts, np.int32)), pa.array(np.frombuffer(ends, np.int32))], ["doc", "start", "end"])
    open_ = pieces.filter(pa.compute.is_valid(pieces["hashes"]))
    if not len(open_):
        return
    bucket, key, doc, start = _unpacked(open_)
    again = pd.Series(key).duplicated(keep=False).to_numpy()
    bucket, key, doc, start = bucket[again], key[again], doc[again], start[again]
    order = np.lexsort((start, doc, bucket, key))
    bucket, key, doc, start = bucket[order], key[order], doc[order], start[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])])[: len(key)]
    leader = np.flatnonzero(new)[np.cumsum(new) - 1]
    gone = (doc[leader] != doc) | (start[leader] != start)
    yield pa.RecordBatch.from_arrays([pa.array(doc[gone]), pa.array(start[gone].astype(np.int32)), pa.array((start[gone] + WINDOW).astype(np.int32))], ["doc", "start", "end"])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that occur earlier, from rows in the order of their buckets."""
    held, windows = [], 0
    for batch in batches:
        if not len(batch):
            continue
        bucket = batch.column("bucket").to_numpy()
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column("hashes")), 0).to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        last = held[-1].column("bucket")[-1].as_py() if held else None
        for a, b in zip(begin, np.append(begin[1:], len(bucket)), strict=True):
            if held and windows >= JUDGED and bucket[a] != last:
                yield from _later(pa.Table.from_batches(held))
                held, windows = [], 0
            held.append(batch.slice(a, b - a))
            last, windows = bucket[a], windows + int(sizes[a:b].sum()) // 8
    if held:
        yield from _later(pa.Table.from_batches(held))


def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, which takes a third less on disk than the compression of the shuffle (null: null)."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([*batch.drop_columns(["text"]).columns, pa.array([None if t is None else press.compress(t) for t in texts], pa.binary())], PRESSED.replace(" long", "").replace(" binary", "").split(", "))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        for part in (batch.slice(i, 256) for i in range(0, len(batch), 256)):
            out = []
            texts = (unpress.decompress(t) if t is not None else b"" for t in part.column("text").to_pylist())
            for text, starts, ends in zip(texts, part.column("starts").to_pylist(), part.column("ends").to_pylist(), strict=True):
                words, n = text.split(), 0
                total = len(words)
                if starts:
                    edge = np.zeros(total + 1, np.int64)
                    np.add.at(edge, np.minimum(starts, total), 1)
                    np.add.at(edge, np.minimum(ends, total), -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    n = total - int(stays.sum())
                    words = list(compress(words, stays.tolist()))
                out.append((total, n, b" ".join(words)))
            total, n, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(total, pa.int64()), pa.array(n, pa.int64()), pa.array([x.decode() for x in kept]) if "kept" in part.schema.names else pa.array([hashlib.sha256(x).hexdigest() for x in kept])], ["doc_id", "n_words", "n_removed", "kept"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of words (doc, start, end) to remove, in pieces that may overlap; a null id is NO_ID."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text_col).alias("text"))
    buckets = max(BUCKETS, EACH * docs.rdd.getNumPartitions())
    return rows.mapInArrow(_dealt(buckets), PIECES).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_judged, "doc long, start int, end int")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, digest: bool = True) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept: the SHA-256 of the words that stay, joined by spaces.

    With `digest` false, kept is that text itself. A null text has no words. Ids name documents: of rows that share one,
    equal passages at equal places are the same passage, and what is found in one is removed from all. A null id comes
    after all others. An empty table gives an empty result.
    """
    spans = repeated_spans(docs, id_col, text_col).groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans")).select("doc", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc")).select("doc_id", "doc", "text").mapInArrow(_pressed, PRESSED)
    marked = rows.join(spans.hint("shuffle_hash"), "doc", "left").select("doc_id", "text", "starts", "ends", *([] if digest else [F.lit(True).alias("kept")]))
    return marked.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
