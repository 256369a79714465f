"""Ranked search, Merkle manifest and language identification beside plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladderworks.llm import entry, language_id, lexical_search, merkle
from tests.llm.helpers import awkward, documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def scored(rows, query):
    """(id, score) of each row, by the formula."""
    own = [Counter(terms(t)) for _, t in rows]
    docs, total = sum(map(bool, own)), sum(sum(c.values()) for c in own)
    out = [[i, 0] for i, _ in rows]
    for term in set(terms(query)):
        df = sum(term in c for c in own)
        w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))
        for c, hit in zip(own, out, strict=True):
            if tf := c[term]:
                m = 100 - 50 + (50 * sum(c.values()) * docs) // total
                hit[1] += w * ((10**9 * tf) // (1000 * tf + 20 * m))
    return out


def best(rows, query, k):
    hits = sorted(((-s, i is None, i or 0) for i, s in scored(rows, query) if s > 0))[:k]
    return [(r, None if none else i, -s) for r, (s, none, i) in enumerate(hits, 1)]


@pytest.mark.parametrize(("k", "block"), [(3, 500_000), (50, 40)])
def test_search_gives_what_scoring_everything_gives(spark, monkeypatch, k, block):
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    monkeypatch.setattr(lexical_search, "CELLS", 64)
    monkeypatch.setattr(lexical_search, "PIECE", 100)
    rng = random.Random(5)
    rows = [*awkward(4), (None, "w3 w5 w8"), (None, "w3 w5 w8"), (900, "W3 w5, w8é…Ü W9"), (900, "W3 w5, w8é…Ü W9"), (901, "x" * 300 + " w3"), (902, "\x7f\x00 !?")]
    queries = [(i, " ".join(f"{'w' if i % 3 else 'W'}{rng.randrange(300)}" for _ in range(rng.randrange(1, 40)))) for i in range(12)]
    queries += [(100, None), (101, ""), (102, "nowhere"), (103, "w3 w3 w3 Ü"), (103, "w5"), (None, "w8"), (104, rows[5][1])]
    items = spark.createDataFrame(queries, "item_id long, text string").withColumns({c: F.lit("x") for c in ("row", "query", "of", "term", "score")})
    want = Counter((i, *hit) for i, q in queries for hit in best(rows, q, k))
    got = Counter(map(tuple, lexical_search.ranked(documents(spark, rows, clashes=True), items, k).select("item_id", "rank", "doc_id", "score").collect()))
    assert got == want


def test_search_of_empty_tables(spark):
    docs, items = documents(spark, awkward(4)), spark.createDataFrame([(1, "w3")], "item_id int, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs, items.where("false")), (documents(spark, [(1, None)]), items)):
        found = lexical_search.ranked(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_search_when_every_document_says_the_same(spark):
    """One text in all documents: every term's weight and every score tie, so that ids decide."""
    rows = [(i, "a b c") for i in range(200, 0, -1)]
    items = spark.createDataFrame([(1, "a c")], "item_id int, text string")
    got = lexical_search.ranked(documents(spark, rows), items, 5).collect()
    assert [(r["rank"], r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [hit[:2] for hit in best(rows, "a c", 5)]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """The root, and for each node the siblings by level with the place among them."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, at, strict=True):
            run = nodes[i // 3 * 3 : i // 3 * 3 + 3]
            path.append((run[: i % 3], run[i % 3 + 1 :]))
        nodes, at = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], [i // 3 for i in at]
    return nodes[0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of each row."""
    leaf = lambda r, text: h(*map(said, (r[0], r[3], r[2], len(r[1]) if r[1] is not None else None, text)))
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf(r, r[1]) for r in sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))]) for s in order}
    root, tops = tree([trees[s][0] for s in order])
    out = Counter()
    for s, top in zip(order, tops, strict=True):
        for r, path in zip(sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))), trees[s][1], strict=True):
            change = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            node = leaf(r, r[1].replace("\n", "") if change else r[1])
            for left, right in path + top:
                node = h(*left, node, *right)
            out[r[0], leaf(r, r[1]), trees[s][0], root, h(*(x for left, right in path + top for x in left + right)), node, node == root] += 1
    return out


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_is_that_of_a_plain_tree(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle.manifest, "__defaults__", (*merkle.manifest.__defaults__[:-1], levels))
    rng = random.Random(levels)
    rows = [(i, t, rng.choice(["en", "de", None, ""]), rng.choice(["b", "b", "b", "ä", "B", None, ""])) for i, t in awkward(6)]
    rows += [(None, "no\nid", "en", "b"), (None, "no\nid", "en", "b"), (None, None, None, None), (7, "line\nline", "en", "b"), (7, "line\nline", "en", "b"), (7, "other", "en", "b"), (70, "lone\n", "en", "lone")]
    got = merkle.tampered(documents(spark, rows, clashes=True))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 3, 10])
def test_manifest_of_small_tables(spark, n):
    rows = [(i, f"t\n{i}", "en", "a") for i in range(n)]
    assert Counter(map(tuple, merkle.tampered(documents(spark, rows)).collect())) == (plain_manifest(rows) if n else Counter())


def test_manifest_finds_any_change(spark):
    """A proof folds to the root from its own leaf alone."""
    rows = [(i, f"text {i}", "en", f"s{i % 4}") for i in range(40)]
    found = merkle.manifest(documents(spark, rows)).withColumn("wrong", F.unhex(F.sha2("leaf", 256)))
    right, wrong = (merkle.folded(found, c).where("folded = root").count() for c in ("leaf", "wrong"))
    assert (right, wrong) == (40, 0)


SYLLABLES = {"xx": "ba be bi bo bu da de di".split(), "yy": "kra kre kri gro gru stra ské".split(), "zz": "лен лог мир нов дом".split()}


def labelled(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 80))), lang, "s"))
    return rows


def test_languages_of_texts_that_were_not_learned(spark):
    model = language_id.fitted(documents(spark, [*labelled(300, 1), (1, None, "xx", "s"), (2, "12 !", "yy", "s"), (3, "ba", None, "s")], clashes=True))
    assert model.languages == ["xx", "yy", "zz"] and 0 <= model.least <= 1
    fresh = labelled(200, 2)
    odd = [(1000, None, "xx", "s"), (1001, "", "xx", "s"), (1002, "12 _ ! ½", "xx", "s"), (None, "ba be", "xx", "s"), (5, "ba " * 300_000, "xx", "s"), (5, "krastra" * 100_000, "yy", "s")]
    got = language_id.languages(documents(spark, fresh + odd, clashes=True), model).collect()
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
        assert 0 <= r.score <= 1
    assert len(got) == 206 and all(by_id[i][0].lang_pred == "und" and by_id[i][0].score == 0 and not by_id[i][0].accepted for i in (1000, 1001, 1002))
    assert by_id[None][0].lang_pred == "xx" and {r.lang_pred for r in by_id[5]} >= {"xx", "yy"}
    right = sum(any(r.lang_pred == lang for r in by_id[i]) for i, _, lang, _ in fresh)
    assert right >= 0.98 * len(fresh)


def test_language_model_without_labels_or_rows(spark):
    model = language_id.fitted(documents(spark, [(1, "abc", None, "s")]))
    assert [tuple(r) for r in language_id.languages(documents(spark, [(1, "abc")]), model).collect()] == [(1, "und", 0.0, False)]
    assert language_id.languages(documents(spark, []), model).count() == 0
    with pytest.raises(ValueError, match="languages"):
        language_id.sample(documents(spark, labelled(30, 3)), F.col("lang"), F.col("text"), texts=2)


def test_sample_is_bounded_and_counts_copies_once(spark):
    rows = labelled(100, 4) + [(i, "ba be bi", "xx", "s") for i in range(200, 400)]
    found = language_id.sample(documents(spark, rows), F.col("lang"), F.col("text"), texts=30)
    texts = {(lang, key) for lang, key, _ in found}
    assert Counter(lang for lang, _ in texts) == {"xx": 10, "yy": 10, "zz": 10}
    assert max(Counter((lang, key) for lang, key, _ in found).values()) <= language_id.SNIPPETS


def test_remembered_words_change_no_score(spark, monkeypatch):
    rows = language_id.sample(documents(spark, labelled(60, 5)), F.col("lang"), F.col("text"))
    model = language_id.train(rows, epochs=1)
    texts = [t.split() for _, t, _, _ in labelled(40, 6)]
    pieces = [(i, ws[k : k + 7]) for i, ws in enumerate(texts) for k in range(0, len(ws), 7)]
    want = np.concatenate([model.logits([(0, ws)], 1) for ws in texts])
    assert np.allclose(want, model.logits(pieces, len(texts)))
    monkeypatch.setattr(language_id, "HELD_WORDS", 12)
    monkeypatch.setattr(language_id, "TOGETHER", 20)
    fresh = language_id.train(rows, epochs=1)
    assert np.allclose(want, fresh.logits([*pieces, (3, [])], len(texts)))
    whole = language_id.train(rows, epochs=1).logits([(1, ["babe"]), (0, ["kraské"])], 3)
    bucket, owner = language_id.subwords(["kraské", "babe"])
    for i in range(2):
        assert np.allclose(whole[i], model.embeddings[bucket[owner == i]].mean(axis=0) @ model.weights + model.bias)
    assert np.allclose(whole[2], model.bias)


def test_calibration_bounds_the_errors():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 3, 4000)
    logits = 4 * np.eye(3)[truth] + rng.normal(0, 2, (4000, 3))
    model = language_id.Model(["a", "b", "c"], np.zeros((1, 1)), np.zeros((1, 3)), np.zeros(3))
    language_id.calibrate(model, logits, truth)
    chances = model.chances(logits)
    taken = chances.max(axis=1) >= model.least
    assert 0.3 < taken.mean() < 1 and (chances.argmax(axis=1) == truth)[taken].mean() >= 0.985
    sure = np.abs(chances.max(axis=1).mean() - (chances.argmax(axis=1) == truth).mean())
    assert sure < 0.03


def test_registered_query_holds_back_a_quarter(spark):
    df = entry.QUERIES["op13_languages"](spark, "/root/testdata/sf0.001")
    want = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang").collect()}
    rows = df.collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in want if zlib.crc32(str(i).encode()) % 4 == 2} and len(rows) == len(want)
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.9 * len(held)
