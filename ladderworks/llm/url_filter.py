"""URL filter: fixed rules first, else logistic regression on hashed character n-grams of host and path.

The model is trained from a small labelled table of URLs (LABELLED rows at most, which is checked) and is one weight per
hash bucket, 256 KB, that travels with the code. Scoring is one pass over the pages' URLs without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of the labelled table; buckets of the hashed n-grams; their lengths.
LABELLED, BUCKETS, LENGTHS = 10_000, 1 << 16, (3, 4, 5)
#: Fixed values: (verdict, host and start of the path). A rule holds for its host and all subdomains; the longest wins.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))

# Words for the small labelled table, from general knowledge of block lists and of ordinary sites, not from any page table.
_BAD = (
    "casino poker slots jackpot roulette blackjack betting bookie wager lottery gambling viagra cialis pharmacy pills steroid diet weightloss payday loan credit forex crypto "
    "replica outlet rolex escort porn xxx adult webcam hookup nude dating torrent warez keygen crack serials clickbait survey prize giveaway popunder banner adserver tracker "
    "malware phishing spam backlink linkfarm botnet spyware"
).split(), "bonus vip online24 cheap cash king offer instant free hot best4u winner deals girls click promo secret unlimited rich discount boost now".split()
_GOOD = (
    "harbor meadow city museum garden weather recipe physics orchestra village mountain railway archive tannery thistle norther library science history school university health "
    "travel photo chess music theatre poetry astronomy botany geology kitchen bicycle sailing forest river bridge farmers parish council hospital software compiler linux python "
    "journal gazette herald tribune weaving pottery"
).split(), "news data maps club society review guide notes daily lab institute online forum project review free trust weekly house studies collection today".split()
_ENDS = "com net org info io de fr es co.uk example.com example.net example.org".split()
_PATHS = ("/", "/index.html", "/{}", "/en/{}", "/{}/page", "/de/{}.html", "/p?id={}", "/fr/articles/{}/", "/2024/{}")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small training table: url and bad (0 or 1), four names for each first word, with endings and paths shared by both."""
    rows = []
    for bad, (first, second) in ((1, _BAD), (0, _GOOD)):
        for i, word in enumerate(first):
            for j in range(4):
                name = (word, ("-", "", "-", "")[(i + j) % 4], second[(5 * i + 7 * j) % len(second)])
                name = "".join(name if j < 3 else name[::-1])
                front, end, tail = ("", "www.", "blog.", "m.", "shop.")[(i + j) % 5], _ENDS[(3 * i + 5 * j) % len(_ENDS)], _PATHS[(2 * i + 5 * j) % len(_PATHS)]
                rows.append((f"https://{front}{name}.{end}{tail.format((37 * i + 211 * j) % 1000)}", bad))
    return spark.createDataFrame(rows, "url string, bad int")


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _grams(kind: str, text: str) -> np.ndarray:
    text = f"{kind}^{text}$"
    return np.array([xxhash.xxh64_intdigest(text[0] + text[i : i + n]) % BUCKETS for n in LENGTHS for i in range(1, len(text) - n + 1)], np.int64)


def train(labelled: DataFrame, rounds: int = 300, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Weights by bucket, and the bias at the end, of a logistic regression on the mean of the n-grams' indicators."""
    rows = labelled.select(host(F.col("url")).alias("h"), path(F.col("url")).alias("p"), "bad").limit(LABELLED + 1).collect()
    if len(rows) > LABELLED:
        raise ValueError(f"the labelled table has more than {LABELLED} rows")
    grams = [np.concatenate([_grams("h", r["h"]), _grams("p", r["p"])]) for r in rows]
    owner, bucket = np.repeat(np.arange(len(rows)), [len(g) for g in grams]), np.concatenate([*grams, np.zeros(0, np.int64)])
    share = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=len(rows)), 1))
    truth, w = np.array([r["bad"] for r in rows], float), np.zeros(BUCKETS + 1)
    for _ in range(rounds if rows else 0):
        z = np.bincount(owner, weights=w[bucket], minlength=len(rows)) * share + w[-1]
        off = (truth - 1 / (1 + np.exp(-z))) / len(rows)
        w[:-1] += rate * (np.bincount(bucket, weights=(off * share)[owner], minlength=BUCKETS) - decay * w[:-1])
        w[-1] += rate * off.sum()
    return w.astype(np.float32)


def judge(pages: DataFrame, weights: np.ndarray, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, rule, verdict, score (the model's chance of a bad URL).

    A null URL, or one without `://`, has an empty host and path, which the model judges by its bias. Pages that repeat a
    URL are judged alike; an empty table gives an empty result.
    """
    held = F.lit(None).cast("string")
    said = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # so that the longest is asked first
        name, slash, rest = rule.partition("/")
        fits = ((F.col("host") == name) | F.endswith("host", F.lit(f".{name}"))) & F.startswith("path", F.lit(slash + rest))
        held, said = F.when(fits, F.lit(rule)).otherwise(held), F.when(fits, F.lit(verdict)).otherwise(said)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(100_000)
        def part(kind: str, text: str) -> tuple[float, int]:
            grams = _grams(kind, text)
            return float(weights[grams].sum()), len(grams)

        for batch in batches:
            both = [(part("h", h), part("p", p)) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            z = np.array([(a + b) / max(m + n, 1) ** 0.5 for (a, m), (b, n) in both], float) + float(weights[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-z)))], [*batch.schema.names, "score"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    scored = rows.mapInArrow(score, "page_id long, host string, path string, score double")
    return scored.select("page_id", "host", "path", held.alias("rule"), F.coalesce(said, F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score")
