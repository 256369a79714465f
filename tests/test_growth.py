"""What must not grow faster than the input: exchanges of words, rows of pairs, and how often a history is read."""

import random
from collections import Counter

from pyspark.sql import functions as F

from ladderworks.operators import similarity as N
from ladderworks.plans import meta_queries



def test_two_nearest_in_blocks_are_those_of_all_pairs(spark, monkeypatch):
    for name, value in (("BLOCK", 5), ("PART", 7), ("DECKS", 2), ("ENTRIES", 9)):
        monkeypatch.setattr(N, name, value)
    rng = random.Random(5)
    bags = {i: Counter(rng.choices("abcdefghijklmnop"[: 3 + i % 13], k=rng.randint(1, 12))) for i in range(60)} | {60: Counter("zz")}
    rows = lambda ids, key: spark.createDataFrame([(i, w, q) for i in ids for w, q in bags[i].items()], f"{key} long, item string, qty long")
    own, keys = N.bags(rows([*range(0, 60, 3), 60], "deck_id"), "deck_id")
    theirs, names = N.bags(rows([i for i in range(60) if i % 3], "lib_id"), "lib_id")
    firsts = names.groupBy("bag").agg(F.min("lib_id").alias("first"))
    pairs = N._nearest_sharing(own, theirs, firsts).join(firsts.withColumnRenamed("bag", "other"), "other").join(keys, "bag").select("deck_id", "first", "sim").collect()
    got = {}
    for r in pairs:
        got.setdefault(r.deck_id, []).append((-r.sim, r.first))
    lib = {tuple(sorted(bags[i].items())): i for i in reversed(range(60)) if i % 3}
    for d in (*range(0, 60, 3), 60):
        sims = sorted((-sum((bags[d] & bags[i]).values()) / sum((bags[d] | bags[i]).values()), i) for i in lib.values() if bags[d] & bags[i])
        assert sorted(got.get(d, []))[:2] == sims[:2]
    assert N._nearest_sharing(own, theirs.limit(0), firsts).count() == N._nearest_sharing(own.limit(0), theirs, firsts).count() == 0
    assert "Generate explode(items" not in N._nearest_sharing(own, theirs, firsts)._jdf.queryExecution().optimizedPlan().toString()


def test_words_stay_where_their_text_is(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b a"), (2, "a c"), (3, ""), (5, None), (6, "q Q")], "doc_id long, text string")
    monkeypatch.setattr(meta_queries, "read", lambda spark, sf_dir, name: docs)
    cards, likeness = meta_queries.k13_key_items(spark, ""), meta_queries.f26_multiset_similarity(spark, "")
    for rows in (cards, likeness):
        assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in cards.collect()} == {(1, "a x2; b x1"), (2, "a x1; c x1"), (6, "q x2")}
    assert [tuple(r) for r in likeness.collect()] == [(1, 0.25)]


def test_presence_reads_its_history_once(spark):
    from ladderworks.operators import presence as P

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("1", "A", "t", 1, "x", "P", "1"), ("1", "B", "t", 2, "y", "Q", ""), ("2", "A", "t", None, "x", "P", "1"), ("2", None, "t", 1, "y", "Q", "")]
    plain = spark.createDataFrame(rows, "EventID string, Deck string, Tier string, Place int, Archetype string, Pilot string, LoginID string").withColumn("EventDate", F.lit("2024-01-01").cast("date"))
    table = P.presence(plain.mapInArrow(counted, plain.schema))
    got = table.unionByName(table).distinct().orderBy("Deck").collect()
    assert seen.value == len(rows)
    assert got == P.presence_of(P.entries(plain)).orderBy("Deck").collect() and [(r.Deck, r.Events, r.AvgPlace) for r in got] == [("A", 2, 1.0), ("B", 1, 2.0)]
    assert table.schema == P.presence_of(P.entries(plain)).schema


def test_event_checks_multiply_no_rows(spark):
    from ladderworks.operators import quality as Q

    rows = [("1", "2024-01-01", "t", 1, "P", "a"), ("1", "2024-01-02", "t", 2, "Q", "a"), ("2", "2024-01-01", "t", 1, "P", ""), ("2", "2024-01-01", "u", 1, "Q", "")]
    found = Q.event_checks(spark.createDataFrame(rows, "EventID string, EventDate string, Tier string, Place int, Pilot string, LoginID string"), 2)
    assert {(r.check_id, r.key, r.detail) for r in found.collect()} == {("one_date", "1", "2"), ("one_tier", "2", "2"), ("places", "2", "1/1/1"), ("one_name", "1:a", "2")}
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_published_runs_read_their_events_once(spark, monkeypatch):
    from ladderworks.plans import publish_queries as Q

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(str(e), p, "t", f"d{p}", f"P{e + p}", f"{e + p}") for e in (5, 12, 103) for p in range(1, 5)]
    plain = spark.createDataFrame(rows, "EventID string, Place int, Tier string, Deck string, Pilot string, LoginID string").withColumn("EventDate", F.lit("1995-01-01").cast("date"))
    monkeypatch.setattr(Q, "whole_events", lambda spark, sf_dir: plain.mapInArrow(counted, plain.schema))
    got = {r.run: (r.state, r.rows_shown, r.registry_count, r.fetched_count, r.invariant_problem_count) for r in Q.q05_q08_published_runs(spark, "").collect()}
    assert seen.value == len(rows)
    assert got["complete"] == ("full", 4, "3", "3", None) and got["missing"] == ("withheld", 0, "3", "2", None) and got["missing, allowed"] == ("partial", 4, "3", "2", None)
    assert got["other window"][0] == got["no registry"][0] == "withheld" and got["faulty"] == ("withheld", 0, None, None, "1")


def test_sheets_read_their_history_once(spark, monkeypatch):
    from ladderworks.plans import file_queries as Q

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [("1", 1, "t", "b", "x", "P", "1", 101), ("1", 2, "t", "a", "x", "Q", "", 102), ("2", 1, "u", "a", "y", "P", "1", 201), ("3", 1, "t", "a", "y", "P", "1", 301)]
    plain = spark.createDataFrame(rows, "EventID string, Place int, Tier string, Deck string, Archetype string, Pilot string, LoginID string, row_id long").withColumn("EventDate", F.lit("2024-01-01").cast("date"))
    monkeypatch.setattr(Q, "history", lambda spark, sf_dir: plain.mapInArrow(counted, plain.schema))
    got = {tuple(r) for r in Q.k04_sheets(spark, "").collect()}
    assert seen.value == len(rows)
    assert got == {("1_STATUS", 1, None), ("2_Ct_Decks", 1, "a"), ("2_Ct_Decks", 2, "b"), ("4_Cu_Decks", 1, "a")}


def test_pilots_are_named_by_their_latest_row_without_a_sort_of_the_history(spark):
    from ladderworks.operators import presence as P

    rows = [
        ("2024-01-01", 1, "a", "Old", "1", 1), ("2024-02-01", 9, "a", "Late", " 1", 2), ("2024-02-01", None, "b", "Later row", "1", 3), (None, 2, " a ", "No date", "1", 4), (None, None, None, "Q", "", 5),
        (None, None, "c", "q", "", 6), ("2024-01-01", 1, "", "Z", None, 7), ("2024-01-01", 1, "b", "Z", None, 8), ("2024-01-01", 1, "a", " ", "5", 9),
    ]
    plain = spark.createDataFrame(rows, "d string, Place int, Deck string, Pilot string, LoginID string, row_id long").withColumn("EventDate", F.col("d").cast("date"))
    got = {r.Pilot: (r.LoginID, r.Rank, r.Wins, r.Top8, r.Top32, r.AvgPlace, r.BestPlace, r.DecksPlayed, r.WinningDecks) for r in P.pilot_table(plain, F.col("row_id")).collect()}
    assert got == {"Z": (None, 1, 2, 2, 2, 1.0, 1, 2, "b"), "Late": ("1", 2, 1, 2, 3, 4.0, 1, 3, "a"), "Q": ("", 3, 0, 0, 0, None, 999, 1, "")}
    keyed = plain.withColumns({"_key": F.col("LoginID"), "_row": F.col("row_id")})
    plan = P._first_decks(keyed)._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate(keys=[_key" in plan.splitlines()[-3] + plan.splitlines()[-2] + plan.splitlines()[-4]


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    from ladderworks.plans import file_queries as Q
    from ladderworks.sources import sinks

    monkeypatch.setattr(sinks, "BUCKET_ROWS", 10)
    rows = [(str(9 + e % 5), e, f"P{e}", str(e)) for e in range(150)]
    plain = spark.createDataFrame(rows, "EventID string, Place int, Pilot string, LoginID string")
    monkeypatch.setattr(Q, "history", lambda spark, sf_dir: plain)
    stored, fresh = Q._bucketed(spark, "")
    assert sinks.buckets_of(plain.limit(3)) == sinks.buckets_of(plain.limit(0)) == 8
    joined = Q.L.name_drift(stored, fresh)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SelectedBucketsCount: 15 out of 15") == 2 and "Exchange" not in plan
    assert {(r.EventID, r.Place, r.NewPilot) for r in joined.collect()} == {(e, p, f"{n} jr") for e, p, n, _ in rows if int(e) % 9 == 0}


def _search(rng, n):
    """Texts of which some are edits of others; every twentieth id is a query of the search."""
    pool = [f"w{i}" for i in range(300)]
    base = [rng.choices(pool, k=30) for _ in range(n // 2 - 1)]
    return [(i, "  ".join(base[i % len(base)][: 30 - i % 3]), f"s{i % 4}") for i in range(n)]


def test_labels_at_the_bound_read_their_texts_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    texts = [*_search(random.Random(7), 120), (120, None, "s1"), (121, " ", "s2")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    monkeypatch.setattr(meta_queries, "read", lambda spark, sf_dir, name: docs.mapInArrow(counted, docs.schema))
    got = {r.deck_id: (r.nearest, r.second, r.nearest_sim) for r in meta_queries.j12_labels_at_the_bound(spark, "").collect()}
    assert seen.value <= 2 * len(texts)  # the queries and the library
    assert set(got) == {0, 20, 40, 60, 80, 100} and sum(v[0] is not None and v[1] is not None for v in got.values()) > 2


def test_one_rare_word_makes_no_candidate(spark):
    """Bags that share their rarest word only can't be alike at the bound, and aren't compared."""
    rows = [(i, w, 1) for i in range(40) for w in ["rare", *(f"u{i}-{k}" for k in range(12)), *(f"c{k}" for k in range(20))]] + [(90, w, 1) for w in ["rare", *(f"u0-{k}" for k in range(12)), *(f"c{k}" for k in range(20))]]
    each = spark.createDataFrame(rows, "id long, item string, qty long")
    own, keys = N.bags(each.where("id = 90"), "id")
    theirs, names = N.bags(each.where("id BETWEEN 1 AND 40"), "id")
    assert N.candidate_pairs(own, theirs, 0.9).count() == 0
    theirs, names = N.bags(each.where("id < 40"), "id")
    assert N.candidate_pairs(own, theirs, 0.9).join(names.withColumnRenamed("bag", "other"), "other").select("id").collect() == [(0,)]
    assert [r.sim for r in N.similar_pairs(own, theirs, 0.9).collect()] == [1.0]


def test_a_search_multiplies_neither_side(spark, monkeypatch):
    """Blocks of decks go to the library's tasks; no bag is written or shuffled for each block, whatever their number."""
    texts = N.packed_texts(spark.createDataFrame([(i, t) for i, t, _ in _search(random.Random(8), 60)], "id long, text string"), "id")
    own, _ = N.bags(texts.where("id % 3 = 0"), "id")
    theirs, _ = N.bags(texts.where("id % 3 <> 0"), "id")
    whole = sorted(N._nearest_sharing(own, theirs).join(own.select("bag"), "bag").select("bag", "sim").collect())
    written = []
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "cut", lambda rows, cut=N.cut: written.append(rows) or cut(rows))
    found = N._nearest_sharing(own, theirs)
    assert len(written) == 5 and all("Exchange" not in w._jdf.queryExecution().sparkPlan().toString() and w.columns == ["bag", "other", "sim"] for w in written)
    best = lambda rows: {b: max(s for c, s in rows if bytes(c) == b) for b in {bytes(c) for c, _ in rows}}
    assert best(found.select("bag", "sim").collect()) == best(whole)


def test_words_of_texts_are_counted_in_place(spark, monkeypatch):
    monkeypatch.setattr(N, "TEXTS", 2)
    docs = spark.createDataFrame([(1, "b A  b"), (2, "é z"), (3, ""), (4, None), (5, " "), (6, "q Q\tq"), (7, "b")], "id long, text string")
    rows = N.packed_texts(docs.repartition(1), "id")
    assert {(r.id, *zip(r["keys"], r.quantities)) for r in rows.collect()} == {(1, ("a", 1), ("b", 2)), (2, ("z", 1), ("é", 1)), (6, ("q", 1), ("q\tq", 1)), (7, ("b", 1))}
    plain = rows.selectExpr("id", "inline(arrays_zip(keys, quantities)) AS (item, qty)")
    assert {(r.id, bytes(r.bag), r.n) for r in N.packed(plain, "id").collect()} == {(r.id, bytes(r.bag), r.n) for r in N.packed(rows, "id").collect()}
    assert rows.limit(0).count() == N.packed_texts(docs.limit(0), "id").count() == 0
