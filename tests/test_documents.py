"""Event documents are parsed once a row, whatever is asked of them."""

import json

from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.sources import events, sinks
from ladderworks.streaming import pending


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _document(i, logins=("a", ""), pilots=("Ann ", "bob"), size=2):
    players = [{"player": p, "loginid": x, "wins": 2 - n, "winner": n == 0, "seeding": n + 1} for n, (p, x) in enumerate(zip(pilots, logins))]
    return json.dumps({"event_id": str(i), "player_count": {"players": str(size)}, "final_rank": [{"loginid": str(n), "rank": str(n + 1)} for n in range(size)], "decklists": [{"loginid": x, "player": p, "main_deck": []} for x, p in (("a", "Ann"), ("b1", "Bob"), ("b2", " BOB "))][-2:] + [], "brackets": [{"index": 0, "matches": [{"players": players}]}]})


def test_documents_are_parsed_once(spark):
    pages = spark.createDataFrame([("<script>window.MTGO.decklists.data = " + _document(1) + ";",)], "html string").repartition(2)
    docs = events.embedded_events(pages)
    for rows, parsed in ((events.brackets(docs), 1), (events.event_status(docs, 2), 1), (pending.match_table(docs, 2), 1), (events.swiss(docs), 1)):
        assert _plan(rows).count("from_json") == parsed and "Join" not in _plan(rows)
    cells = events.result_rows(spark.createDataFrame([("e", "<tr><td>1st<td></td><td>D</td><td>P</td></tr>")], "id string, html string").repartition(2), "id")
    assert _plan(cells).count("<td") == 1


def test_matches_and_states_of_one_reading(spark):
    docs = events.parse_events(spark.createDataFrame([(_document(1),), (_document(2, size=3),), ("{}",)], "value string"))
    rows = {r.EventID: r for r in pending.match_table(docs, 2).collect()}
    assert (rows["1"].State, rows["1"].WinnerLoginID, rows["1"].LoserLoginID, rows["1"].Borrowed, rows["1"].Reason) == ("rows", "a", "b2", 1, None)
    assert (rows["2"].State, rows["2"].WinnerPilot, rows["2"].Borrowed, rows["2"].Reason) == ("error", None, None, "places are not 1 to 2") and rows[None].State == "error"
    assert [r.LoserLoginID for r in events.brackets(docs).orderBy("EventID").collect()] == ["b2", "b2"]


def test_names_of_references(spark):
    row = spark.createDataFrame([("&amp;&nosuch;&eacute;&#65;&nbsp;x",)], "x string").select(T.unescaped(F.col("x")).alias("x")).first()
    assert row.x == "&&nosuch;éA x"


def test_cached_documents_in_files_of_either_kind(spark, tmp_path):
    rows = spark.createDataFrame([("1.json", "one"), ("1.0.json", "older"), ("2.0.json", "two"), ("9.json", "other")], "name string, id string")
    sinks.write_documents(rows, f"file://{tmp_path}/events", F.col("name"), F.to_json(F.struct(F.col("id").alias("event_id"))))
    (tmp_path / "events" / "3.json").write_text('{"event_id": "three"}')
    ids = spark.createDataFrame([("1.0",), ("2",), ("3",), ("4",)], "EventID string")
    found = {r.EventID: r.event.event_id for r in events.cached_events(spark, f"file://{tmp_path}/events", ids).collect()}
    assert found == {"1": "one", "2": "two", "3": "three"}


def test_matches_need_no_cards(spark):
    """Matches and states are the same from a parse that passes over the cards, and the query for them parses no more."""
    from ladderworks.plans import state_queries

    page = "<script>window.MTGO.decklists.data = " + _document(1).replace('"main_deck": []', '"main_deck": [{"qty": "2", "card_attributes": {"card_name": "x"}}]') + ";"
    pages = spark.createDataFrame([(page,)], "html string")
    whole, some = (pending.match_table(events.embedded_events(pages, layout=x), 2).collect() for x in (events.EVENT, events.MATCHES))
    assert whole == some and len(some) == 1
    rows = spark.createDataFrame([(1, 1, 1, 1, 9.0, "R", 1.0)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_quantity double")
    tables = {"lineitem": rows, "orders": spark.sql("SELECT 1L AS o_orderkey, current_timestamp() AS o_orderdate, 'F' AS o_orderstatus, 'x' AS o_orderpriority"), "part": spark.sql("SELECT 1L AS p_partkey, 'b' AS p_brand, 't' AS p_type, 'n' AS p_name")}
    from ladderworks.plans import standins

    own, standins.read = standins.read, lambda spark, sf_dir, name: tables[name]
    try:
        docs = state_queries._faulty_documents(spark, "", events.MATCHES)
    finally:
        standins.read = own
    assert "main_deck" not in str(docs.schema) and docs.first().event.event_id == "1"


def test_cards_of_rosters_are_read_once(spark):
    """Rosters with their cards as by joining the two, from one parse and without an exchange."""
    card = lambda name, qty=None: {"card_attributes": {"card_name": name}} | ({"qty": qty} if qty else {})
    deck = [card("Bolt", "3"), card(" BOLT "), card("Island", "9"), card(" "), card("Opt", "4"), card("bolt", "2")]
    body = {"event_id": "7", "final_rank": [{"loginid": "a", "rank": "2"}, {"loginid": "a", "rank": "1"}], "decklists": [{"loginid": "a", "player": "Ann", "main_deck": deck}, {"loginid": "b", "player": "Bob", "main_deck": [card("Opt", "1")]}, {"loginid": "c", "player": "Cy", "main_deck": [card("Forest", "60")]}, {"loginid": "d", "player": "Di"}]}
    pages = spark.createDataFrame([("<script>window.MTGO.decklists.data = " + json.dumps(body) + ";",)], "html string").repartition(2)
    found = events.roster_cards(events.embedded_events(pages, layout=events.ROSTERS))
    assert {tuple(r) for r in found.collect()} == {("7", "a", "Ann", 1, "bolt", 6), ("7", "a", "Ann", 1, "opt", 4), ("7", "b", "Bob", None, "opt", 1)}
    assert _plan(found).count("from_json") == 1 and "Join" not in _plan(found) and "Aggregate" not in _plan(found)
    rosters = events.rosters(events.embedded_events(pages))
    sums = events.cards(rosters).collect()
    assert {(r.deck_id, r["item"], r.qty) for r in sums} == {(f"{r.EventID}:{r.LoginID}", r["item"], r.qty) for r in found.collect()}


def test_rosters_of_documents_are_parsed_once(spark, monkeypatch):
    from ladderworks.plans import state_queries

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    plain = spark.createDataFrame([(str(e), p, f"n {p}", f"P{e + p}") for e in (1, 2) for p in range(1, 4)], "EventID string, Place int, RawDeck string, Pilot string")
    monkeypatch.setattr(state_queries, "history", lambda spark, sf_dir: plain.mapInArrow(counted, plain.schema))
    got = {tuple(r) for r in state_queries.s15_j25_rosters(spark, "").select("EventID", "LoginID", "Pilot", "Place", "item", "qty").collect()}
    assert seen.value == 6 and got == {(str(e), f"L{p}", f"P{e + p}", p, f"n {p}", p + 2) for e in (1, 2) for p in range(1, 4)}


def test_embedded_document_ends_at_its_first_end(spark):
    mark = "window.MTGO.decklists.data"
    pages = [f'x {mark} = {{"event_id": "1"}};\n var y = {{}};', f'{mark}={{"event_id": "a}}b;\n}}"}} ;}}', f'{mark} ={{}};{{}};', f'{mark} = {{"event_id": "2"', f'{mark} = {{"event_id": "{"z" * 300_000}}}"}};', "none"]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    lazy = F.regexp_extract("html", r"(?s)window\.MTGO\.decklists\.data\s*=\s*(\{.*?\});", 1)
    got = rows.select("i", F.regexp_extract("html", events.EMBEDDED, 1).alias("x"), lazy.alias("y")).collect()
    assert all(r.x == r.y for r in got) and [bool(r.x) for r in sorted(got)] == [True, False, True, False, True, False]
