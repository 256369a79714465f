"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Texts are tokenised in one pass. How the pieces fill sequences depends on nothing but how many there are of each length,
so the packing is planned on that histogram (as many rows as a sequence has tokens, at most): a bin is filled greedily,
longest fitting piece first, then its smallest piece gives way to two unpacked pieces that fill the gap better. A
pattern that was found is used as often as the counts allow. The plan, a small table, is joined back to the pieces by
their rank within their length; ranks come from counts by partition, so no task sees all pieces of a length.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.llm.common import chunks, scratch, worker_state

MAX_TOKENS = 2048
#: Most words whose tokens a worker remembers.
REMEMBERED = 1_000_000
#: Words of lower-case Latin letters only.
LETTERS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


def ends_in_mark(word: bytes) -> bool:
    """Whether the word is a Latin letter and more, then a comma or full stop, which the tokenizer always splits off.

    Letters whose lower case is more than one character (it ends in a combining mark) are left to the tokenizer.
    """
    return len(word) > 1 and word[-1:] in (b",", b".") and (last := word[:-1].decode()[-1]) < "\u0250" and last.isalpha() and len(last.lower()) == 1


def plain(word: bytes) -> bytes:
    """The word in lower case, without a final mark. Words that may hold a special token or combining marks stay as they are."""
    if ends_in_mark(word):
        word = word[:-1]
    return word.lower() if word.isascii() and b"<|" not in word else word


class WordTokens(dict):
    """Little-endian ids by word, filled on demand; the tokenizer drops white space, so words can be encoded one by one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.whole.model)  # for words that the other steps leave as they are
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, word: bytes) -> bytes:
        if (base := plain(word)) != word:
            ids = self[base] + (self[word[-1:]] if ends_in_mark(word) else b"")
        else:
            found = self.whole.encode(word.decode(), add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        self[word] = ids
        return ids

    def learn(self, words: list[bytes]) -> None:
        """Encodes the new words of a chunk together, which takes a third of the time of one by one."""
        if len(self) > REMEMBERED:
            self.clear()
        new = [w.decode() for w in {plain(w) for w in set(words).difference(self)}.difference(self)]
        for tokenizer, some in ((self.letters, [w for w in new if LETTERS.fullmatch(w)]), (self.whole, [w for w in new if not LETTERS.fullmatch(w)])):
            for word, found in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                self[word.encode()] = struct.pack(f"<{len(found.ids)}I", *found.ids)


def tokenized(docs: DataFrame, tokenizer_path: str, max_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document: its ids, then 0, cut every `max_tokens`; with their rank by length in their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens, part, seen = worker_state(f"words of {tokenizer_path}", lambda: WordTokens(tokenizer_path)), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for rows, texts in chunks(batch, "text"):
                split = [t.split() for t in texts]
                tokens.learn([w for words in split for w in words])
                out = []
                for doc_id, words in zip(rows.column("doc_id").to_pylist(), split, strict=True):
                    ids = b"".join(map(tokens.__getitem__, words)) + b"\0\0\0\0"
                    for piece, at in enumerate(range(0, len(ids), 4 * max_tokens)):
                        own = ids[at : at + 4 * max_tokens]
                        n = len(own) // 4
                        out.append((doc_id, piece, at // 4, n, zlib.crc32(own), part, seen[n]))
                        seen[n] += 1
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def _fill(counts: np.ndarray, size: int) -> list[int]:
    """Lengths of one bin: the longest that fit, then the smallest gives way to the two that best fill what it leaves."""
    left, gap, got = counts.copy(), size, []
    while gap > 0:
        there = np.flatnonzero(left[1 : gap + 1])
        if not len(there):
            break
        n = int(there[-1]) + 1
        times = min(int(left[n]), gap // n)
        got += [n] * times
        left[n] -= times
        gap -= n * times
    if gap and len(got) > 1:
        small = got[-1]
        room = gap + small
        there = np.flatnonzero(left[1:room]) + 1
        # the best partner of each length: the longest other one that still fits
        best = (small, None)
        for n in there.tolist():
            fits = there[: np.searchsorted(there, min(n, room - n), side="right")]
            if len(fits) and fits[-1] == n and left[n] < 2:
                fits = fits[:-1]
            if len(fits) and n + int(fits[-1]) > best[0]:
                best = (n + int(fits[-1]), [n, int(fits[-1])])
        if best[1]:
            got = [*got[:-1], *best[1]]
    return got


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, ranks, bins, first bin, offset): ranks of a length go through the bins in turn."""
    counts = np.zeros(size + 1, np.int64)
    for n, k in histogram.items():
        counts[n] = k
    used, bins, slots = np.zeros(size + 1, np.int64), 0, []
    while len(there := np.flatnonzero(counts)):
        got = Counter(_fill(counts, size))
        times = min(int(counts[n]) // k for n, k in got.items())
        offset = 0
        for n, k in sorted(got.items(), reverse=True):
            slots.append((n, int(used[n]), k * times, times, bins, offset))
            used[n] += k * times
            counts[n] -= k * times
            offset += n * k
        bins += times
    return slots


def packed(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the single id 0. Rows that repeat an id are packed each. An empty table gives no piece. A very
    long text gives as many pieces as it needs, each of `max_tokens` but the last; pieces of one length go into the bins in
    the order of their input partitions, so ties are settled by that order.
    """
    spark = docs.sparkSession
    pieces = scratch(tokenized(docs, tokenizer_path, max_tokens, id_col, text_col))
    by_part = scratch(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    before = by_part.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most max_tokens rows
    slots = spark.createDataFrame(plan(counts, max_tokens), "slot_length long, first long, ranks long, bins long, first_bin long, base long")
    ranked = pieces.join(before, ["length", "part"]).withColumn("at", F.col("rank") + F.col("before"))
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length")) & (F.col("at") >= F.col("first")) & (F.col("at") < F.col("first") + F.col("ranks")))
    turn = F.col("at") - F.col("first")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_bin") + turn % F.col("bins")).alias("sequence_id"), (F.col("base") + F.col("length") * F.floor(turn / F.col("bins"))).alias("offset"))
