"""Language identification: averaged embeddings of hashed subwords, a linear softmax, calibrated rejection.

The model is trained on the driver by stochastic gradient descent on a bounded sample of labelled texts: the TEXTS distinct
texts with the smallest hashes, as many of each language, each of which gives SNIPPETS pieces from anywhere in its whole
length. A fifth of the sampled texts is kept back to fit the temperature of the scores and the score under which a
prediction is rejected. Predicting is one pass over whole texts without a shuffle.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.llm.common import chunks, scratch

#: Bounds of the training sample: distinct texts in all, pieces of each, words of a piece. So many languages at most.
TEXTS, SNIPPETS, SNIPPET_WORDS = 4_000, 3, (2, 60)
#: The model: hash buckets of subwords, numbers of an embedding, lengths of the subwords.
BUCKETS, DIMENSIONS, LENGTHS = 1 << 16, 16, (1, 2, 3, 4)
#: The share of accepted predictions that should be right.
ACCURACY = 0.99
#: Runs of letters (and of numbers that are no digits, such as fractions); longer ones are read in pieces of so many. Words whose
#: sums a worker remembers, unless those that it works on are more; words that it works on together.
WORD, HELD_WORDS, TOGETHER = re.compile(r"[^\W\d_]{1,48}"), 400_000, 400_000
#: Characters of a text that are split into words at once.
PIECE = 1 << 20


def words(text: str) -> Iterator[list[str]]:
    """The words of a whole text in lower case, some at a time; a piece ends where no letter follows, if it can."""
    start = 0
    while start < len(text):
        end = min(start + PIECE, len(text))
        while start + PIECE // 2 < end < len(text) and text[end].isalpha():
            end -= 1
        yield WORD.findall(text[start:end].lower())
        start = end


def subwords(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all subwords of some words, and the number of the word of each: pieces of LENGTHS letters, with a blank
    before and after the word. A piece's hash is a polynomial of its code points."""
    text = " " + "  ".join(found) + " "
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in found], np.int64)
    owner = np.repeat(np.arange(len(found)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at, hashed = np.arange(len(points)), np.zeros(len(points), np.uint64)
    buckets, owners = [], []
    for n in range(1, max(LENGTHS) + 1):
        last = np.minimum(at + n - 1, len(points) - 1)
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + points[last] + np.uint64(n)
        if n in LENGTHS:
            whole = (at + n <= ends) & ~((n == 1) & (points == 32))
            mixed = hashed[whole] ^ (hashed[whole] >> np.uint64(29))
            buckets.append(((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64) % BUCKETS)
            owners.append(owner[whole])
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order], owner[order]


@dataclass
class Model:
    """Learned languages, the share of each subword in the scores, the temperature and the least score that is accepted."""

    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0
    _known: dict[str, int] = field(default_factory=dict, repr=False)
    _sums: np.ndarray | None = field(default=None, repr=False)
    _shares: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}, "_sums": None, "_shares": None}

    def numbers(self, found: list[str]) -> np.ndarray:
        """The row of each word in the remembered sums: the scores of its subwords, and their number."""
        new = set(found).difference(self._known)
        if self._sums is None or len(self._known) + len(new) > HELD_WORDS:
            self._known, self._sums, new = {}, np.zeros((0, len(self.languages) + 1)), set(found)
        if new:
            if self._shares is None:
                self._shares = np.column_stack([self.embeddings @ self.weights, np.ones(BUCKETS)])
            ordered = list(new)
            bucket, owner = subwords(ordered)
            sums = np.add.reduceat(self._shares[bucket], np.searchsorted(owner, np.arange(len(ordered))), axis=0)
            self._known.update(zip(ordered, range(len(self._known), len(self._known) + len(ordered)), strict=True))
            self._sums = np.concatenate([self._sums, sums])
        return np.fromiter(map(self._known.__getitem__, found), np.int64, len(found))

    def logits(self, pieces: Iterable[tuple[int, list[str]]], texts: int) -> np.ndarray:
        """Scores by language of each text, from pieces (number of the text, words)."""
        total, owners, sizes, held = np.zeros((texts, len(self.languages) + 1)), [], [], []

        def add() -> None:
            rows = self.numbers(held)
            np.add.at(total, owners, np.add.reduceat(self._sums[rows], np.cumsum([0, *sizes[:-1]]), axis=0))

        for owner, found in pieces:
            if found:
                owners.append(owner)
                sizes.append(len(found))
                held += found
            if len(held) >= TOGETHER:
                add()
                owners, sizes, held = [], [], []
        if held:
            add()
        return total[:, :-1] / np.maximum(total[:, -1:], 1) + self.bias

    def chances(self, logits: np.ndarray) -> np.ndarray:
        scaled = logits / self.temperature
        e = np.exp(scaled - scaled.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


def sample(labelled: DataFrame, label: Column, text: Column, texts: int = TEXTS) -> list[tuple[str, int, str]]:
    """(label, hash of the text, piece of the text) of the bounded sample, in a fixed order. A text counts once for each label,
    however often it is repeated; texts without a letter and rows without a label don't count."""
    rows = labelled.select(label.alias("label"), text.alias("text")).where(F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("text"))
    distinct = scratch(rows.select("label", "hash").distinct())
    sizes = distinct.groupBy("label").agg(F.count("*").alias("n")).limit(texts + 1).collect()
    if len(sizes) > texts:
        raise ValueError(f"more than {texts} languages")
    # Hashes are spread evenly, so that few beyond the smallest `each` lie below a bound; these few are then ranked.
    each = max(1, texts // max(len(sizes), 1))
    bounds = [(r.label, min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, (1.2 * each + 20) / r.n)))) for r in sizes]
    bounds = rows.sparkSession.createDataFrame(bounds, "label string, bound long")
    first = Window.partitionBy("label").orderBy("hash")
    low = distinct.join(F.broadcast(bounds), "label").where("hash <= bound")
    hashes = low.withColumn("place", F.row_number().over(first)).where(F.col("place") <= each)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in chunks(batch, "text"):
                out = []
                for lang, seed, whole in zip(part.column("label").to_pylist(), part.column("hash").to_pylist(), found, strict=True):
                    own = [w for ws in words(whole.decode()) for w in ws]
                    rng = random.Random(seed)
                    for _ in range(SNIPPETS):
                        size = min(len(own), round(SNIPPET_WORDS[0] * (SNIPPET_WORDS[1] / SNIPPET_WORDS[0]) ** rng.random()))
                        start = rng.randint(0, len(own) - size)
                        out.append({"label": lang, "hash": seed, "text": " ".join(own[start : start + size])})
                yield pa.RecordBatch.from_pylist(out, part.schema.remove(part.schema.get_field_index("text")).append(pa.field("text", pa.string())))

    chosen = rows.join(F.broadcast(hashes.select("label", "hash")), ["label", "hash"]).select("label", "hash", "text")
    found = chosen.mapInArrow(pieces, "label string, hash long, text string").distinct().collect()
    return sorted((r.label, r.hash, r.text) for r in found)


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The subwords of each text one after the other, and where each text's start."""
    found = [t.split(" ") for t in texts]
    bucket, owner = subwords([w for ws in found for w in ws])
    of = np.repeat(np.arange(len(found)), [len(ws) for ws in found])[owner]
    return bucket, np.searchsorted(of, np.arange(len(found) + 1))


def train(rows: list[tuple[str, int, str]], epochs: int = 4, rate: float = 0.5, batch: int = 32, seed: int = 0) -> Model:
    """A model from (label, hash, text) rows; those whose hash is a multiple of five calibrate it. No rows: a model of no language."""
    languages = sorted({r[0] for r in rows})
    rng = np.random.default_rng(seed)
    model = Model(languages, rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS, np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages)))
    if not rows:
        return model
    bucket, starts = _bags([r[2] for r in rows])
    truth = np.array([languages.index(r[0]) for r in rows])
    back = np.array([r[1] % 5 == 0 for r in rows])
    own, kept = np.flatnonzero(~back) if not back.all() else np.arange(len(rows)), np.flatnonzero(back)
    balance = len(rows) / (len(languages) * np.bincount(truth, minlength=len(languages)))
    steps, done = epochs * -(-len(own) // batch), 0
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(own), -(-len(own) // batch)):
            sizes = starts[some + 1] - starts[some]
            of = np.repeat(np.arange(len(some)), sizes)
            ids = bucket[np.arange(len(of)) + np.repeat(starts[some] - np.cumsum(sizes) + sizes, sizes)]
            used, index = np.unique(ids, return_inverse=True)
            share = np.bincount(of * len(used) + index, minlength=len(some) * len(used)).reshape(len(some), len(used)) / sizes[:, None]
            mean = share @ model.embeddings[used]
            off = (np.eye(len(languages))[truth[some]] - model.chances(mean @ model.weights + model.bias)) * balance[truth[some], None]
            step = rate * (1 - done / steps)
            model.embeddings[used] += step * (share.T @ (off @ model.weights.T))
            model.weights += step * (mean.T @ off)
            model.bias += step * off.sum(axis=0) / len(some)
            done += 1
    if len(kept):
        logits = np.array([np.add.reduce(model.embeddings[bucket[starts[i] : starts[i + 1]]]) / (starts[i + 1] - starts[i]) for i in kept]) @ model.weights + model.bias
        calibrate(model, logits, truth[kept])
    model.embeddings = model.embeddings.astype(np.float32)
    return model


def calibrate(model: Model, logits: np.ndarray, truth: np.ndarray) -> None:
    """The temperature at which the truth is likeliest, and the lowest score from which on ACCURACY of the predictions are right."""

    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(np.maximum(model.chances(logits)[np.arange(len(truth)), truth], 1e-12)).mean()

    model.temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    chances = model.chances(logits)
    score, right = chances.max(axis=1), chances.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    good = np.flatnonzero(np.cumsum(right[order]) >= ACCURACY * np.arange(1, len(order) + 1))
    model.least = float(score[order[good[-1]]]) if len(good) else 1.0


def languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score, accepted.

    The whole text is read. A null text, or one without a letter, is `und` with score 0, as is every text if the model knows no
    language; else lang_pred is the likeliest learned language, also where the score is too low to be accepted. Rows that
    repeat a text are judged alike; an empty table gives an empty result; other columns are ignored.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in chunks(batch, "text"):
                lettered = np.zeros(len(found), bool)

                def pieces(found: list[bytes] = found, lettered: np.ndarray = lettered) -> Iterator[tuple[int, list[str]]]:
                    for i, text in enumerate(found):
                        for ws in words(text.decode()):
                            lettered[i] |= any(map(str.isalpha, chain.from_iterable(ws))) if not lettered[i] else True
                            yield i, ws

                logits = model.logits(pieces(), len(found)) if model.languages else np.zeros((len(found), 1))
                known = lettered & bool(model.languages)
                chances = model.chances(logits)
                best, score = chances.argmax(axis=1), np.where(known, chances.max(axis=1), 0.0)
                names = [model.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(known & (score >= model.least))], ["doc_id", "lang_pred", "score", "accepted"])

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def fitted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = TEXTS) -> Model:
    """A model trained on the bounded sample of the labelled rows."""
    return train(sample(docs, F.col(lang_col), F.col(text_col), texts))
