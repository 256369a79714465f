"""Small tables of documents for the tests, with every awkward case, and brute-force versions of operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that a user may have and that operators use inside.
CLASHES = ("id", "key", "n", "row", "kept", "digest", "leaf", "part", "doc", "cell", "fp", "stays", "_id", "place")


def words(text):
    return WORD.findall(text or "")


def documents(spark: SparkSession, rows, *, clashes: bool = False) -> DataFrame:
    """Rows (doc_id, text) or (doc_id, text, lang, source) as documents."""
    full = [(i, t, *(rest or ("en", "src0")), len(t) if t is not None else None) for i, t, *rest in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


def awkward(seed: int = 1):
    """Texts with nulls, empty and very long ones, ties, repeats and near copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = prose(60)
    texts = [None, "", " \n\t ", "one", "two words", prose(20_000), passage, passage, "  " + passage.replace(" ", "\n"), passage + " " + prose(30), prose(30) + " " + passage, prose(10) + " " + passage + " " + passage]
    near = prose(400)
    texts += [near, near + " tail", near.replace(" ", "\t"), near.upper()]
    texts += [prose(rng.randint(15, 200)) for _ in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts, 5))
