"""Quality rules: fixed rules on word statistics, then robust multivariate outliers by language and source.

One pass over the texts gives a few counts per document. Documents that pass the fixed rules form cells by language and
source; one with few rows is judged by the estimate of all rows of its language, or of all rows if these are few too. Each
estimate is a minimum covariance determinant: from several starts (medians and median deviations, and seeded parts of the
rows) concentration steps re-estimate mean and covariance from the share `SUPPORT` of the rows with the least Mahalanobis
distances until the determinant falls no more; the start that ends with the least determinant counts. Every step is two aggregations
over all rows of the table of counts, so cells of any size are estimated from all their rows and nothing but sums is
gathered. Rows whose distance equals the one that ends the share are all in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderworks.llm.common import WHITE, boxed, chunks, forget, scratch

#: Share of a cell's rows that a concentration step keeps; up to the rest may be outliers.
SUPPORT = 0.75
#: Starts of each estimate; all but the first are means and covariances of one in PART rows, chosen by hash.
STARTS, PART = 3, 4
#: Concentration steps end when no determinant falls by more than this (of its logarithm), which it can't do forever.
TOLERANCE = 1e-3
#: Median of the chi-squared distribution with five degrees of freedom, and the squared distance beyond which rows go: under
#: that distribution 4 in a thousand million do, so that clean texts, whose counts have longer tails, stay.
CHI2_MEDIAN, CUTOFF = 4.351, 48.0
#: Least deviations of the five features: what varies less than this in a cell isn't held against a document.
FLOORS = (0.5, 0.08, 0.35, 0.5, 0.04)
#: Cells whose estimates, some 300 bytes each, are broadcast; beyond that the join is left to Spark.
BROADCAST = 20_000
P = len(FLOORS)
#: A cell with fewer rows, five for each feature, is judged by the estimate of a larger one.
LEAST_ROWS = 5 * P
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]

_SYMBOLS = b"#*$%&|<>"  # fixed value
_WHITE = WHITE.encode()
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _factorize(values: np.ndarray) -> np.ndarray:
    return pd.factorize(values)[0].astype(np.int64)


def repeat_words(words: list[bytes], lengths: np.ndarray, window: int = 5) -> np.ndarray:
    """For each text: its words inside a window that occurs twice or more in it. `words` holds the texts' words in a row."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out = np.zeros(len(lengths), np.int64)
    if len(words) < window:
        return out
    code = _factorize(np.array(words, dtype=object))
    pair = _factorize(code[:-1] * (code.max() + 1) + code[1:])
    four = _factorize(pair[:-2] * (pair.max() + 1) + pair[2:])
    five = _factorize(four[:-1] * (code.max() + 1) + code[window - 1 :])
    inside = owner[: len(five)] == owner[window - 1 :]
    at, own = np.flatnonzero(inside), owner[: len(five)][inside]
    if not len(at):
        return out
    key = _factorize(five[inside] * len(lengths) + own)
    twice = at[np.bincount(key)[key] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + window, -1)
    return np.bincount(owner, weights=np.cumsum(edge[:-1]) > 0, minlength=len(lengths)).astype(np.int64)


def word_counts(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of COUNTS for some texts."""
    words, lengths, chars, symbols, again = [], [], [], [], []
    solid = np.ones(256, bool)
    solid[list(_WHITE)] = solid[0x80:0xC0] = False  # neither white space nor a continuation byte
    for t in texts:
        found = t.split()  # bytes are split at exactly the six ASCII white-space characters
        words += found
        lengths.append(len(found))
        seen = np.bincount(np.frombuffer(t, np.uint8), minlength=256)
        chars.append(seen[solid].sum())
        symbols.append(seen[list(_SYMBOLS)].sum())
        lines = [x for x in t.split(b"\n") if x.strip()]
        again.append(len(lines) - len(set(lines)))
    n = np.array(lengths, np.int64)
    return [n, np.array(chars, np.int64), np.array(symbols, np.int64), np.array(again, np.int64), repeat_words(words, n)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays([*part.drop_columns(["text"]).columns, *map(pa.array, word_counts(texts))], ["doc_id", "lang", "source", *(x.split()[0] for x in COUNTS.split(", "))])


def _features() -> list[Column]:
    n = F.col("n_words") + 1
    return [F.log(n), F.log((F.col("word_chars") + 1) / n), F.log1p(100 * F.col("n_symbols") / (F.col("word_chars") + 1)), F.log1p("n_dup_lines"), F.col("n_repeat_words") / n]


def _cells(rows: DataFrame, least: int) -> DataFrame:
    """Adds `cell`, by which a row is judged: language and source, or the language, or all, the first with `least` rows.

    Adds `cells` too, the estimates that it is part of: its own one, and those of its language and of all where others need them.
    """
    both = scratch(rows.groupBy("lang", "source").agg(F.count("*").alias("n")))  # a row for each cell
    by_lang = both.groupBy(F.col("lang").alias("l")).agg(F.sum("n").alias("all"), F.min("n").alias("fewest"))
    placed = both.join(by_lang, F.col("lang") == F.col("l"))
    own, wide = F.concat_ws("|", F.lit("s"), "lang", "source"), F.concat_ws("|", F.lit("l"), "lang")
    cell = F.when(F.col("n") >= least, own).when(F.col("all") >= least, wide).otherwise("all")
    placed = scratch(placed.select("lang", "source", cell.alias("cell")))
    used = ["all"] if placed.where("cell = 'all'").take(1) else []
    wides = placed.where("cell LIKE 'l|%'").select("lang", F.col("cell").alias("wide")).distinct()
    placed = placed.join(wides, "lang", "left")
    cells = F.array_distinct(F.array_compact(F.array("cell", "wide", *map(F.lit, used))))
    placed = scratch(placed.select(F.col("lang").alias("cell_lang"), F.col("source").alias("cell_source"), "cell", cells.alias("cells")))
    few = placed.limit(BROADCAST + 1).count() <= BROADCAST
    return rows.join(F.broadcast(placed) if few else placed, (F.col("lang") == F.col("cell_lang")) & (F.col("source") == F.col("cell_source"))).drop("cell_lang", "cell_source")


def _solved(found: pd.DataFrame) -> pd.DataFrame:
    """Inverse and log determinant of each row's covariance, to which the least deviations are added."""
    inverses, logs = [], []
    for cov in found["cov"]:
        s = np.zeros((P, P))
        for (i, j), v in zip(PAIRS, cov, strict=True):
            s[i, j] = s[j, i] = v
        s += np.diag(np.square(FLOORS))
        inverses.append([float(np.linalg.inv(s)[i, j]) for i, j in PAIRS])
        logs.append(float(np.linalg.slogdet(s)[1]))
    return pd.DataFrame({"cell": found["cell"], "mean": found["mean"], "inv": inverses, "logdet": logs})


def _solve(estimates: DataFrame) -> DataFrame:
    run = lambda frames: (_solved(x) for x in frames)
    return scratch(estimates.mapInPandas(run, "cell string, mean array<double>, inv array<double>, logdet double"))


def _with(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows and the small table of their cell; it is broadcast if it has BROADCAST rows at most, so no cell meets in one task."""
    few = estimates.limit(BROADCAST + 1).count() <= BROADCAST
    return rows.join(F.broadcast(estimates) if few else estimates, "cell")


def _distance() -> Column:
    gap = [F.col(f"x{i}") - F.col("mean")[i] for i in range(P)]
    return sum((F.col("inv")[k] * gap[i] * gap[j] * (1 if i == j else 2) for k, (i, j) in enumerate(PAIRS)), F.lit(0.0))


def _start(rows: DataFrame) -> DataFrame:
    """First estimates of all cells, which end in the number of the start."""
    first, others = rows.where("start = 0"), rows.where("start > 0 AND pmod(xxhash64(start, x0, x1, x2, x3, x4), %d) = 0" % PART)
    mid = scratch(first.groupBy("cell").agg(F.array(*(F.percentile_approx(f"x{i}", 0.5, 10000) for i in range(P))).alias("mean")))
    off = _with(first, mid).groupBy("cell").agg(F.first("mean").alias("mean"), *(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col("mean")[i]), 0.5, 10000).alias(f"d{i}") for i in range(P)))
    robust = off.select("cell", "mean", F.array(*((F.col(f"d{i}") * 1.4826) ** 2 if i == j else F.lit(0.0) for i, j in PAIRS)).alias("cov"))
    means, products = (F.avg(f"x{i}") for i in range(P)), (F.covar_pop(f"x{i}", f"x{j}") for i, j in PAIRS)
    return _solve(robust.unionByName(others.groupBy("cell").agg(F.array(*means).alias("mean"), F.array(*products).alias("cov"))))


def _step(rows: DataFrame, now: DataFrame) -> DataFrame:
    far = _with(rows, now).withColumn("d", _distance())
    cut = scratch(far.groupBy("cell").agg(F.percentile_approx("d", SUPPORT, 10000).alias("cut")))
    gap = [F.col(f"x{i}") - F.col("mean")[i] for i in range(P)]  # sums about the last mean lose no digits
    sums = _with(far, cut).where("d <= cut").groupBy("cell").agg(F.first("mean").alias("old"), *(F.avg(g).alias(f"m{i}") for i, g in enumerate(gap)), *(F.avg(gap[i] * gap[j]).alias(f"s{i}{j}") for i, j in PAIRS))
    return _solve(sums.select("cell", F.array(*(F.col("old")[i] + F.col(f"m{i}") for i in range(P))).alias("mean"), F.array(*(F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in PAIRS)).alias("cov")))


def robust_estimates(rows: DataFrame, starts: int = STARTS) -> DataFrame:
    """Minimum-covariance-determinant mean and inverse covariance of x0.. by `cell`, and the scale of its distances.

    An empty table has no estimates. Of starts that end alike the first counts.
    """
    each = scratch(rows.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(starts - 1)))).withColumn("cell", F.concat("cell", F.lit("#"), F.col("start").cast("string"))))
    open_, done = _start(each), None
    while open_.take(1):
        step = _step(each, open_)  # of the open cells' rows only
        both = scratch(step.join(open_.select("cell", F.col("logdet").alias("was")), "cell"))
        forget(step)
        forget(open_)
        ended = F.col("was") - F.col("logdet") <= TOLERANCE
        done = both.where(ended).drop("was") if done is None else done.unionByName(both.where(ended).drop("was"))
        open_ = both.where(~ended).drop("was")
    if done is None:
        done = open_
    forget(each)
    parts = done.select(F.regexp_extract("cell", r"(?s)^(.*)#", 1).alias("base"), F.struct(F.round("logdet", 6), "cell").alias("order"), F.struct("mean", "inv").alias("found"))
    best = scratch(parts.groupBy("base").agg(F.min_by("found", "order").alias("found")).select(F.col("base").alias("cell"), "found.mean", "found.inv"))
    scale = _with(rows, best).groupBy("cell").agg(F.greatest(F.lit(1.0), F.percentile_approx(_distance(), 0.5, 10000) / CHI2_MEDIAN).alias("scale"))
    return scratch(best.join(scale, "cell"))


def quality_verdicts(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang, source): the counts, base_failed, kept, cell and squared distance.

    A null text has no words. Null languages and sources count as values of their own. base_failed: under 10 words, or
    over a fifth of the words repeated. Others go if their scaled squared distance is above `cutoff`; where even all rows
    together are fewer than `least_rows` they make one cell. Equal rows get equal verdicts, and a distance equal to the cutoff
    stays. Very long texts are counted whole. An empty table gives an empty result.
    """
    counts = scratch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text").mapInArrow(_counted, f"doc_id long, lang string, source string, {COUNTS}"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counts = counts.withColumn("base_failed", failed)
    rows = counts.where("not base_failed").withColumns({f"x{i}": x for i, x in enumerate(_features())})
    rows = scratch(_cells(rows, least_rows))
    found = robust_estimates(rows.select(F.explode("cells").alias("cell"), *(f"x{i}" for i in range(P))))
    judged = rows.join(F.broadcast(found) if found.limit(BROADCAST + 1).count() <= BROADCAST else found, "cell", "left").withColumn("distance", _distance() / F.col("scale"))
    names = ["doc_id", *(x.split()[0] for x in COUNTS.split(", ")), "base_failed"]
    kept = judged.select(*names, (F.coalesce("distance", F.lit(0.0)) <= cutoff).alias("kept"), "cell", "distance")
    gone = counts.where("base_failed").select(*names, F.lit(False).alias("kept"), F.lit(None).cast("string").alias("cell"), F.lit(None).cast("double").alias("distance"))
    return kept.unionByName(gone)


def keep_quality(docs: DataFrame, cutoff: float = CUTOFF, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The rows of `docs` that pass, with all columns. Rows that share an id go only together, if all of them are rejected."""
    verdicts = scratch(quality_verdicts(docs, cutoff, least_rows).select("doc_id", "kept"))
    gone = verdicts.groupBy(F.col("doc_id").alias("key")).agg(F.max("kept").alias("kept")).where("not kept")
    return boxed(docs, id=F.col("doc_id")).join(gone.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("key")), "left_anti").select("doc.*")
