import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ladderworks.llm import line_dedup, simhash_dedup, substring_dedup
from ladderworks.llm.common import components
from ladderworks.llm.entry import ORACLES, op10_repeated_passages
from ladderworks.llm.exact_dedup import drop_exact_copies, exact_copies, misra_gries
from ladderworks.llm.simhash_dedup import Forest, drop_near_copies, grow, leaf_links, near, near_groups, route
from tests.llm.helpers import awkward, documents, words

SMALL = "/root/testdata/sf0.001"


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (1, 0), (200, 201)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_copies_brute_force(spark):
    rows = awkward()
    groups = {}
    for i, t in rows:
        groups.setdefault(plain(t), []).append((-len(t or ""), i))
    want = {i: (min(g)[1], len(g), min(g)[1] == i, hashlib.sha256(p.encode()).hexdigest()) for p, g in groups.items() for _, i in g}
    for counters in (1, 1000):  # with and without heavy hitters
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_copies(documents(spark, rows, clashes=True), counters=counters).collect()}
        assert got == want
    kept = drop_exact_copies(documents(spark, rows, clashes=True))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, w in want.items() if w[2])
    assert kept.columns == documents(spark, rows, clashes=True).columns


def test_exact_copies_repeated_and_null_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (1, "ab "), (2, "ab"), (None, "ab"), (3, "c"), (3, "d")]
    got = exact_copies(documents(spark, rows)).collect()
    assert len(got) == 7 and sum(r.kept for r in got) == 3 and {r.keep_id for r in got} == {1, 3}
    kept = [(r.doc_id, r.text) for r in drop_exact_copies(documents(spark, rows)).collect()]
    assert sorted((i, plain(t)) for i, t in kept) == [(1, "ab"), (3, "c"), (3, "d")]
    assert exact_copies(documents(spark, [])).count() == 0 == drop_exact_copies(documents(spark, [])).count()


def test_misra_gries_keeps_heavy_values():
    import pyarrow as pa

    values = [b"hot"] * 400 + [str(i).encode() for i in range(600)]
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i::10])], ["v"]) for i in range(10)]
    held = misra_gries(iter(batches), 5)
    assert len(held) <= 5 and b"hot" in held and held[b"hot"] <= 400


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_groups_brute_force(spark):
    rows = awkward(2)
    prints = {i: fingerprint(t) for i, t in rows}
    ids, root = sorted(prints), {}
    forest = Forest(len(ids))
    for a, i in enumerate(ids):
        for b in range(a):
            if (prints[i] ^ prints[ids[b]]).bit_count() <= 2:
                forest.join(a, b)
    root = {i: ids[forest.root(a)] for a, i in enumerate(ids)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_groups(documents(spark, rows, clashes=True)).collect()}
    assert got == {i: (f"{prints[i]:016x}", root[i]) for i in ids}
    kept = drop_near_copies(documents(spark, rows, clashes=True))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))
    assert near_groups(documents(spark, [])).count() == 0
    assert near_groups(documents(spark, [(1, "a"), (1, "a"), (2, None)])).count() == 3


@pytest.mark.parametrize("levels", [2, 4])
def test_leaves_beyond_the_tree_lose_no_link(spark, monkeypatch, levels):
    """With fewer levels than the fingerprints need, leaves grow trees of their own, and components are those of all pairs."""
    monkeypatch.setattr(simhash_dedup, "LEAF", 16)
    monkeypatch.setattr(simhash_dedup, "LEVELS", levels)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 150).astype(np.uint64)
    bit = lambda n: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    fps = np.unique(np.concatenate([base, *(base ^ bit(150) ^ bit(150) for _ in range(6))]))
    rows = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp long")
    first = near(fps, 2)
    want = {}
    for v, f in zip(fps.view(np.int64).tolist(), first.tolist(), strict=True):
        want.setdefault(f, set()).add(v)
    got = {}
    for r in components(simhash_dedup.fingerprint_links(rows)).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_tree_meets_every_near_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    bit = lambda n: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    fps = np.unique(np.concatenate([base, *(base ^ bit(200) ^ bit(200) for _ in range(10)), rng.integers(0, 2**63, 1000).astype(np.uint64)]))
    whole = near(fps, 2)
    points, bounds = grow(fps[::8], 5)
    row, leaf = route(fps, points, bounds, 5, 2)
    forest, place = Forest(len(fps)), {int(v): i for i, v in enumerate(fps)}
    for x in range(32):
        for a, b in zip(*leaf_links(np.sort(fps[row[leaf == x]]), 2), strict=True):
            forest.join(place[int(a)], place[int(b)])
    assert [forest.root(i) for i in range(len(fps))] == whole.tolist()
    assert len(row) < 4 * len(fps)


def without_repeats(rows):
    """Every window of 20 words, in order; words of windows that were there before go."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        out[i] = (len(w), sum(gone), " ".join(a for a, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_passages_brute_force(spark, seed):
    rows = [*awkward(seed), (1000, "the " * 70), (1001, "a b " * 40), (1002, "a b " * 25), (None, "the " * 30)]
    docs = documents(spark, rows, clashes=True).repartition(3)
    want = without_repeats(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.without_repeats(docs, digest=False).collect()} == want
    assert {r.doc_id: r.kept for r in substring_dedup.without_repeats(docs).collect()} == {i: hashlib.sha256(w[2].encode()).hexdigest() for i, w in want.items()}


def test_repeated_passages_edges(spark):
    text = " ".join(f"x{i}" for i in range(30))
    got = substring_dedup.without_repeats(documents(spark, [(1, text), (1, text)]), digest=False).collect()
    assert [(r.n_removed, r.kept) for r in got] == [(0, text)] * 2  # repeats of a row are one document
    assert substring_dedup.without_repeats(documents(spark, [])).count() == 0


def test_one_changing_word_makes_another_window(spark):
    """One template with 1,000 fillers: only what stands before and after all of them is repeated."""
    head, tail = (" ".join(f"{c}{i}" for i in range(19)) for c in "ht")
    rows = [(i, f"{head} filler{i} {tail}") for i in range(1000)] + [(5000, head + " filler7 " + tail)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.without_repeats(documents(spark, rows).repartition(8), digest=False).collect()}
    assert got == without_repeats(rows)
    assert sum(n for _, n, _ in got.values()) == 39


def test_a_common_phrase_meets_in_no_one_task(spark):
    """Windows around a phrase of six words in otherwise different texts are spread over all tasks, a common one comes once a chunk."""
    phrase, passage = "all rights reserved by the publisher", " ".join(f"p{i}" for i in range(20))
    side = lambda i, c: " ".join(f"{c}{i}x{k}" for k in range(14))
    rows = [(i, f"{side(i, 'a')} {phrase} {side(i, 'b')}") for i in range(400)] + [(1000 + i, passage) for i in range(400)]
    docs = documents(spark, rows).select(F.col("doc_id").alias("doc"), "text").coalesce(1)
    shuffled = docs.mapInArrow(substring_dedup._dealt(substring_dedup.BUCKETS), substring_dedup.PIECES).repartition(8, "bucket")
    sizes = [r.n for r in shuffled.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("hashes") / 8).alias("n")).collect()]
    assert sum(sizes) == 400 * 15 + 1 and len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_repeated_passages_agree_with_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    got = sorted(map(tuple, op10_repeated_passages(spark, SMALL).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
    assert got == sorted(con.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({ORACLES['op10_repeated_passages']})").fetchall())


def fuzzy(rows):
    first = {}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            q = re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ").lower()
            if q and q not in first:
                first[q] = (i, n)
    sets = [(p, {q[k : k + 8] for k in range(max(1, len(q) - 7))}) for q, p in first.items()]
    forest = Forest(len(sets))
    for a, (_, x) in enumerate(sets):
        for b in range(a):
            if len(x & sets[b][1]) >= 0.8 * len(x | sets[b][1]):
                forest.join(a, b)
    return {p: sets[forest.root(a)][0] for a, (p, _) in enumerate(sets)}


def test_fuzzy_lines_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog and then runs away from the very angry bear"
    rows = [(1, f"{base}\n\nshort\n{base.upper()}  \nother line of some words"), (2, None), (3, ""), (4, base.replace("fox", "cat")), (5, "short\nSHORT"), (6, "x" * 50_000 + "\n" + "x" * 50_000 + "y"), (7, "\n".join(f"{base} {i}" for i in range(60)))]
    rows += [(i + 100, t) for i, t in awkward(4)]
    docs = documents(spark, rows, clashes=True)
    got = {(r.doc_id, r.line): (r.keep_doc, r.keep_line) for r in line_dedup.fuzzy_lines(docs).collect()}
    assert got == fuzzy(rows)
    assert line_dedup.fuzzy_lines(documents(spark, [])).count() == 0
    assert "Python" not in line_dedup.lines(docs)._jdf.queryExecution().toString()


@pytest.mark.parametrize("few", [0, 1024])
def test_open_buckets_lose_no_link(spark, monkeypatch, few):
    """Compared directly or by their rarest shingles, the components are those of all pairs; a common passage joins nothing."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    base = "the quick brown fox jumps over the lazy dog and then runs away from the very angry bear"
    texts = [f"{base} {i}" for i in range(40)] + [f"{base[: 40 + i]} {'tail ' * (i // 4)}" for i in range(40)]
    texts += [f"{chr(97 + i) * 9} {i * 977} {base} {chr(97 + i) * 5} {i * 7919}" for i in range(26)]
    rows = list(enumerate(texts))
    got = {(r.doc_id, r.line): (r.keep_doc, r.keep_line) for r in line_dedup.fuzzy_lines(documents(spark, rows)).collect()}
    assert got == fuzzy(rows)


def test_recall_of_fuzzy_lines(spark):
    """On lines with random edits, nearly all pairs of similarity 0.8 or more end in one component, and no others are linked."""
    rng = random.Random(3)
    letters = "abcdefghijklmnop     "
    texts = []
    for _ in range(60):
        base = "".join(rng.choice(letters) for _ in range(rng.choice((40, 120, 400)))).strip()
        for _ in range(5):
            line = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                line[rng.randrange(len(line))] = rng.choice("qrstuvwxyz")
            texts.append(" ".join("".join(line).split()))
    sets = [{t[k : k + 8] for k in range(max(1, len(t) - 7))} for t in texts]
    close = [(a, b) for a in range(len(texts)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    got = {(r.doc_id, r.line): (r.keep_doc, r.keep_line) for r in line_dedup.line_verdicts(documents(spark, list(enumerate(texts)))).collect()}
    found = sum(got[a, 0] == got[b, 0] for a, b in close)
    print(f"recall: {found} of {len(close)} pairs")
    assert len(close) > 100 and found >= 0.97 * len(close)
    want = fuzzy(list(enumerate(texts)))
    assert all(want[k] == want[got[k]] for k in want)


@pytest.mark.parametrize("hot", [1, 1000])
def test_every_line_has_a_verdict(spark, monkeypatch, hot):
    """Each occurrence has a row, one of each component stays, and the texts lose the others."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    base = "the quick brown fox jumps over the lazy dog and then runs away from the very angry bear"
    rows = [(1, f"{base}\n\nshort\n{base.upper()}  "), (2, None), (3, f"SHORT\n{base}"), (4, base + "s"), (5, "new\n \nshort")]
    docs = documents(spark, rows, clashes=True)
    got = sorted((r.doc_id, r.line, r.keep_doc, r.keep_line, r.kept) for r in line_dedup.line_verdicts(docs).collect())
    assert got == [(1, 0, 1, 0, True), (1, 2, 1, 2, True), (1, 3, 1, 0, False), (3, 0, 1, 2, False), (3, 1, 1, 0, False), (4, 0, 1, 0, False), (5, 0, 5, 0, True), (5, 2, 1, 2, False)]
    cleaned = line_dedup.drop_fuzzy_lines(docs)
    assert cleaned.columns == docs.columns
    assert {r.doc_id: r.text for r in cleaned.collect()} == {1: f"{base}\n\nshort", 2: None, 3: "", 4: "", 5: "new\n "}


def test_prefix_is_shared_by_similar_lines(spark):
    low = {1: list(range(100, 196)), 2: [*range(1, 20), *range(100, 177)], 3: list(range(500, 596))}
    rows = spark.createDataFrame(list(low.items()), "k long, low array<int>")
    got = {k: {r.shingle for r in line_dedup.prefixes(rows, 0.8).where(F.col("k") == k).collect()} for k in low}
    assert got[1] & got[2] and not got[1] & got[3] and len(got[1]) == 96 - 66 + 1


def test_parities_tell_no_similar_lines_apart(spark):
    """Sets of at least the similarity always pass the bound, far ones hardly do; one shingle and thousands work alike."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        n = rng.choice((1, 5, 60, 200, 3000))
        x = [rng.getrandbits(64) - 2**63 for _ in range(n)]
        kept = rng.sample(x, rng.randint(n // 2, n))
        rows.append((i, x, kept + [rng.getrandbits(64) - 2**63 for _ in range(rng.randint(0, max(1, n // 8)))]))
    df = spark.createDataFrame(rows, "i long, x array<long>, y array<long>")
    known = lambda c: F.struct(F.size(c).alias("n"), *line_dedup.parities(F.col(c))).alias(f"known_{c}")
    passed = {r.i for r in df.select("i", known("x"), known("y")).where(line_dedup._may_be("known_x", "known_y", 0.8)).collect()}
    share = {i: len(set(x) & set(y)) / len(set(x) | set(y)) for i, x, y in rows}
    close = {i for i, v in share.items() if v >= 0.8}
    far = {i for i, v in share.items() if v < 0.65 and len(rows[i][1]) in (60, 200)}
    assert len(close) > 30 and close <= passed
    assert len(far) > 20 and len(far & passed) < 0.2 * len(far)


@pytest.mark.parametrize("rounds", [0, 3])
def test_rounds_change_no_component(spark, monkeypatch, rounds):
    monkeypatch.setattr(line_dedup, "FEW", 0)
    monkeypatch.setattr(line_dedup, "ROUNDS", rounds)
    rng = random.Random(8)
    base = [rng.choice(["river", "stone", "cloud", "paper", "light", "metal", "glass", "north"]) for _ in range(16)]
    texts = [" ".join(w if rng.random() > 0.1 else rng.choice(base) + str(rng.randint(0, 9)) for w in base) for _ in range(60)]
    rows = list(enumerate(texts))
    got = {(r.doc_id, r.line): (r.keep_doc, r.keep_line) for r in line_dedup.line_verdicts(documents(spark, rows)).collect()}
    want = fuzzy(rows)
    assert all(want[k] == want[got[k]] for k in want)  # nothing is linked that isn't similar
    assert sum(got[k] == want[k] for k in want) >= 0.95 * len(want)


@pytest.mark.parametrize("few", [0, 1024])
def test_no_pair_of_lines_is_compared_twice(spark, monkeypatch, few):
    """Neither in the steps that follow each other nor, by several rare hashes that they share, in the last one."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    rng = random.Random(8)
    base = [rng.choice(["river", "stone", "cloud", "paper", "light", "metal", "glass", "north"]) for _ in range(16)]
    texts = [" ".join(w if rng.random() > 0.1 else rng.choice(base) + str(rng.randint(0, 9)) for w in base) for _ in range(60)]
    compared, many = [], []
    similar, many_pairs = line_dedup.similar, line_dedup.many_pairs

    def seen(step, into):
        def run(*given):
            out = step(*given)
            into.extend((r.a, r.b) for r in (given[0] if step is similar else out).collect())
            return out

        return run

    monkeypatch.setattr(line_dedup, "similar", seen(similar, compared))
    monkeypatch.setattr(line_dedup, "many_pairs", seen(many_pairs, many))
    assert line_dedup.fuzzy_lines(documents(spark, list(enumerate(texts)))).count() == len(set(texts))
    assert len(compared) > 50 and len(compared) == len(set(compared))
    assert bool(many) == (few == 0) and len(many) == len(set(many))


def test_shingles_are_exact(spark):
    rows = spark.createDataFrame([("abcdefghij",), ("é" * 9,), ("ab",)], "t string")
    n = [r.n for r in rows.select(F.size(F.array_distinct(line_dedup.shingles(F.col("t")))).alias("n")).collect()]
    assert n == [3, 1, 1]
