"""Queries that write tables with the sinks and read them back with the sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.functions.scoring import week_folder
from ladderworks.operators import league as L
from ladderworks.operators import presence as P
from ladderworks.operators import rules as R
from ladderworks.operators import similarity as N
from ladderworks.operators import state as U
from ladderworks.operators.ranking import ranks
from ladderworks.plans.event_queries import PRESENCE
from ladderworks.plans.standins import H, history, matches, query, read, shares
from ladderworks.plans.standins import M as SHARES
from ladderworks.sources import pages, sinks
from ladderworks.sources import tables as S
from ladderworks.sources.scratch import cut, shared_folder
from ladderworks.sources.store import KeyedTable
from ladderworks.sources.tables import cache_key


_TEXT = "EventID, CAST(EventDate AS VARCHAR) AS EventDate, Tier, Deck, Archetype, Pilot"


@query(H + f"SELECT {_TEXT}, Place, CASE WHEN CAST(EventID AS BIGINT) % 2 = 0 THEN LoginID ELSE '' END AS LoginID FROM h")
def s01_k01_history_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History in CSV files of two generations, the older ones without logins and in another order of columns."""
    rows = history(spark, sf_dir).select("EventDate", "Format", "Tier", "EventSlug", "EventID", "Place", "Deck", "Archetype", "Pilot", "LoginID")
    old, folder = F.col("EventID").cast("long") % 2 == 1, shared_folder(spark)
    sinks.write_csv(rows.where(~old), f"{folder}/new")
    sinks.write_csv(rows.where(old).select("EventID", "Pilot", "Place", "Deck", "Archetype", "EventDate", "Tier", "Format", "EventSlug"), f"{folder}/old")
    back = S.typed_history(S.read_csv(spark, f"{folder}/*", S.HISTORY))
    return back.select("EventID", F.col("EventDate").cast("string").alias("EventDate"), "Tier", "Deck", "Archetype", "Pilot", "Place", "LoginID")


_POINTS = "CASE WHEN Place = 1 THEN 5 ELSE 1 END"


@query(H + f"SELECT EventID, Place, Pilot, CASE WHEN CAST(EventID AS BIGINT) % 3 = 0 THEN 'Challenge' ELSE EventClass END AS EventClass, {_POINTS} AS LeaguePoints FROM h")
def s02_k14_u10_u13_result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """League results in CSV files, a third of them from before there were classes."""
    points = F.when(F.col("Place") == 1, 5).otherwise(1).alias("LeaguePoints")
    rows = history(spark, sf_dir).select("EventID", "EventDate", "Tier", "EventClass", "Pilot", "LoginID", "Place", "Deck", points)
    old, folder = F.col("EventID").cast("long") % 3 == 0, shared_folder(spark)
    sinks.write_csv(rows.where(~old), f"{folder}/new")
    sinks.write_csv(rows.where(old).drop("EventClass"), f"{folder}/old")
    return S.typed_results(L.with_class(S.read_csv(spark, f"{folder}/*", S.RESULTS))).select("EventID", "Place", "Pilot", "EventClass", "LeaguePoints")


@query(H + """SELECT a.EventID, CAST(a.EventDate AS VARCHAR) AS EventDate, 'F' AS Round, a.Pilot AS WinnerPilot, b.Pilot AS LoserPilot, a.Deck AS WinnerDeck, b.Deck AS LoserDeck
    FROM h a JOIN h b USING (EventID) WHERE a.Place = 1 AND b.Place = 2 AND a.EventDate BETWEEN DATE '1995-03-01' AND DATE '1996-08-31'""")
def s03_bracket_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bracket matches of a range of dates, beside a list of events without a bracket, which is left out."""
    folder = shared_folder(spark)
    sinks.write_csv(matches(spark, sf_dir), f"{folder}/a")
    rows = S.bracket_matches(spark, f"{folder}/a", "1995-03-01", "1996-08-31")
    return rows.select("EventID", F.col("EventDate").cast("string").alias("EventDate"), "Round", "WinnerPilot", "LoserPilot", "WinnerDeck", "LoserDeck")


@query(H + SHARES + "SELECT Archetype, CAST(count(*) AS BIGINT) AS decks, string_agg(Deck, ';' ORDER BY Deck) AS names FROM m GROUP BY Archetype")
def k05_archetype_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archetypes and their decks as nested XML, read back."""
    folder = shared_folder(spark)
    sinks.write_xml(sinks.archetype_tree(shares(spark, sf_dir)), folder)
    schema = "_name string, _decks long, Deck array<struct<_name: string, _meta: double>>"
    rows = spark.read.format("xml").option("rowTag", "Archetype").schema(schema).load(folder)
    return rows.select(F.col("_name").alias("Archetype"), F.col("_decks").alias("decks"), F.array_join(F.array_sort(F.col("Deck._name")), ";").alias("names"))


@query(H + SHARES + """SELECT Deck AS name, '{"archetype":"' || Archetype || '","games":' || Games || '}' AS value FROM m""")
def k06_k09_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document with sorted keys for each deck, read back by name."""
    folder = shared_folder(spark)
    fields = sinks.status_row(games=F.col("Games"), archetype=F.col("Archetype"))
    sinks.write_documents(shares(spark, sf_dir), folder, F.col("Deck"), F.to_json(F.struct(*fields)))
    return spark.read.schema("name string, value string").parquet(folder)


@query(H + "SELECT EventID, Place, CASE WHEN Tier = '1-URGENT' THEN 'again' ELSE Deck END AS Deck FROM h")
def k07_k08_by_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version of the results whose events of one tier are written again, each in place of its old rows."""
    rows, folder = history(spark, sf_dir), shared_folder(spark)
    tiers = sinks.write_version(rows.select("EventID", "Tier", "Place", "Deck"), folder, "00000001")
    stored = f"{folder}/by-tier"
    spark.read.parquet(tiers).write.partitionBy("Tier").parquet(stored)
    sinks.write_by(spark.read.parquet(tiers).where("Tier = '1-URGENT'").withColumn("Deck", F.lit("again")), stored, "Tier")
    return spark.read.parquet(stored).select("EventID", "Place", "Deck")


@query(H + SHARES + """SELECT Deck, Meta, Winrate FROM (SELECT Deck, CASE WHEN Deck LIKE '%1' THEN NULL ELSE Meta END AS Meta, CASE WHEN Deck LIKE '%2' THEN NULL ELSE Winrate END AS Winrate FROM m)
    WHERE Meta IS NOT NULL AND Winrate IS NOT NULL""")
def p06_s25_run_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market share that stands in a run's own folder, without decks that lack a share or a win rate."""
    folder = shared_folder(spark)
    rows = shares(spark, sf_dir).select("Deck", F.when(~F.col("Deck").endswith("1"), F.col("Meta")).alias("Meta"), F.when(~F.col("Deck").endswith("2"), F.col("Winrate")).alias("Winrate"))
    sinks.write_csv(rows, f"{folder}/metagame", one_file=True)
    return S.run_share(S.read_csv(spark, f"{folder}/metagame", ("Deck", "Meta", "Winrate")))


@query(H + """SELECT EventID, Pilot, Place, CASE WHEN Deck = 'Brand#11' AND CAST(EventID AS BIGINT) % 2 = 0 THEN 'L' || Place WHEN Deck = 'Brand#11' THEN 'NEEDS_MANUAL_REVIEW' ELSE Deck END AS Deck FROM h
    WHERE (EventID, Pilot) IN (SELECT (EventID, Pilot) FROM h GROUP BY EventID, Pilot HAVING count(*) = 1)""")
def u09_rescanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that wait for review after another classification, which knows half of them."""
    h = history(spark, sf_dir)
    h = h.join(h.groupBy("EventID", "Pilot").count().where("count = 1"), ["EventID", "Pilot"], "left_semi")
    waiting = h.select("EventID", "Pilot", "Place", F.when(F.col("Deck") == "Brand#11", U.SENTINEL).otherwise(F.col("Deck")).alias("Deck"))
    labels = h.select("EventID", "Pilot", F.when(F.col("EventID").cast("long") % 2 == 0, F.concat(F.lit("L"), "Place")).otherwise(U.SENTINEL).alias("label"))
    return U.rescan(waiting, labels)


@query(H + """, d AS (SELECT *, EventID || '-' || Place AS deck_id, Games / 50.0 AS s1, Games / 90.0 AS s2, CASE WHEN Games > 10 THEN Archetype ELSE Deck END AS second FROM h WHERE Archetype LIKE 'P%'),
    r AS (SELECT *, CASE WHEN Place = 1 THEN 'winner' WHEN Archetype <> second THEN 'labels differ' WHEN s1 < CASE WHEN Place <= 8 THEN 0.95 ELSE 0.9 END THEN 'too far' END AS reason FROM d),
    w AS (SELECT deck_id, w, length(w) AS n FROM (SELECT DISTINCT deck_id, unnest(string_split(RawDeck, ' ')) AS w FROM d)),
    c AS (SELECT deck_id, string_agg(w || ' x' || n, '; ' ORDER BY n DESC, w) AS key_cards FROM (SELECT *, row_number() OVER (PARTITION BY deck_id ORDER BY n DESC, w) AS i FROM w) WHERE i <= 8 GROUP BY deck_id)
    SELECT EventID AS event_id, CAST(EventDate AS VARCHAR) AS date, Format AS format, EventClass AS kind, Tier AS tier, CAST(Place AS INTEGER) AS place, Pilot AS pilot, reason, Archetype AS nearest_label,
        round_even(s1 * 1000, 0) / 1000 AS nearest_sim, second AS second_label, round_even(s2 * 1000, 0) / 1000 AS second_sim, key_cards, EventSlug AS event_url, '' AS resolved_deck
    FROM r JOIN c USING (deck_id) WHERE reason IS NOT NULL""")
def k13_review_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries that wait for review, as the file in which their decks are filled in."""
    rows = history(spark, sf_dir).where("Archetype LIKE 'P%'").withColumn("deck_id", F.concat("EventID", F.lit("-"), "Place"))
    second = F.when(F.col("Games") > 10, F.col("Archetype")).otherwise(F.col("Deck"))
    games = F.col("Games").cast("double")
    rated = N.classified(rows.select("deck_id", F.col("Archetype").alias("nearest"), (games / 50).alias("nearest_sim"), second.alias("second"), (games / 90).alias("second_sim")), rows.select("deck_id", "Place"))
    cards = N.key_items(rows.select("deck_id", F.explode(F.array_distinct(F.split("RawDeck", " "))).alias("item")).withColumn("qty", F.length("item")))
    names = {"EventID": "event_id", "EventDate": "date", "Format": "format", "EventClass": "kind", "Tier": "tier", "Pilot": "pilot", "EventSlug": "event_url"}
    folder = shared_folder(spark)
    sinks.write_csv(N.review_items(rated, cards, rows.select("deck_id", *(F.col(c).alias(n) for c, n in names.items()))), folder)
    types = {"place": "int", "nearest_sim": "double", "second_sim": "double"}
    return S.read_csv(spark, folder, N.REVIEW).withColumns({c: F.col(c).cast(t) for c, t in types.items()})


_PAGE = 37


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a calendar, in pages, whose answers are stored with faults: of each page the service has none, half of
    one, or all; the backup has every second and the cache all."""
    rows = read(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    text = F.when(n % 4 == 0, "Modern Challenge 64").when(n % 4 == 1, " MODERN  challenge").when(n % 4 == 2, "Legacy Challenge 32").otherwise("Modern Challenge later")
    body = F.to_json(F.struct(text.alias("description"), (n % 3).alias("minimumplayers"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("starttime"), n.alias("tournamentid")))
    numbered = ranks(rows.select("o_orderkey", body.alias("body")), F.col("o_orderkey"))
    page = numbered.withColumn("page", F.floor((F.col("Rank") - 1) / _PAGE).cast("int"))
    lists = page.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("Rank", "body"))).alias("l"), F.count("*").alias("n"))
    whole = lists.select("page", F.concat(F.lit('{"tournament_calendar_list": ['), F.array_join("l.body", ", "), F.lit("]}")).alias("body"))
    last = lists.agg((F.max("page") + 1).cast("int").alias("page")).select("page", F.lit('{"tournament_calendar_list": []}').alias("body"))
    return whole.unionByName(last)


def _stored(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark)
    whole = _calendar(spark, sf_dir).persist()
    key = cache_key(F.lit("s:dgc/calendar"), F.create_map(F.lit("c:limit"), F.lit(str(_PAGE)), F.lit("c:start"), (F.col("page") * _PAGE).cast("string")))
    named = whole.withColumn("name", F.concat(F.lit("s:dgc_calendar_"), key, F.lit(".json")))
    answer = lambda source, where, body="body": named.where(where).select(F.lit(source).alias("source"), "name", F.expr(body).alias("body"))
    pages.store_answers(answer("primary", "page % 3 = 0").unionByName(answer("primary", "page % 3 = 1", "left(body, 50)")).unionByName(answer("backup", "page % 2 = 0")).unionByName(answer("cache", "page % 3 <> 0")), folder)
    whole.unpersist()
    return folder


_ORDERS = f"WITH o AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // {_PAGE} AS page FROM orders)"


@query(_ORDERS + """ SELECT CAST(page AS INT) AS page, CASE WHEN page % 3 = 0 THEN 'primary' WHEN page % 2 = 0 THEN 'backup' ELSE 'cache' END AS source, count(*) AS n, CAST(min(o_orderkey) AS VARCHAR) AS first, CAST(max(o_orderkey) AS VARCHAR) AS last FROM o GROUP BY page""")
def s09_paged_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of stored pages, each from the first source that can answer it: service, backup, cache."""
    rows = pages.all_rows(spark, _stored(spark, sf_dir), "s:dgc/calendar", "tournament_calendar_list", _PAGE)
    each = rows.withColumn("id", F.get_json_object("value", "$.tournamentid").cast("long"))
    return each.groupBy("page", "source").agg(F.count("*").alias("n"), F.min("id").cast("string").alias("first"), F.max("id").cast("string").alias("last"))


@query(_ORDERS + """ SELECT CAST(page AS INT) AS page, count(*) AS n FROM o WHERE page BETWEEN 2 AND 5 AND page <> 4 GROUP BY page""")
def s09_some_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some pages; no other is asked for."""
    found = pages.pages(spark, _stored(spark, sf_dir), "s:dgc/calendar", "tournament_calendar_list", _PAGE)
    return found.where("page >= 2 AND page < 6 AND page IN (2, 3, 5, 7)").groupBy("page").agg(F.count("value").alias("n"))


@query("""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS EventDate, CASE WHEN o_orderkey % 4 = 0 THEN 64 ELSE o_orderkey % 3 END AS size, o_orderkey AS id FROM orders WHERE o_orderkey % 4 IN (0, 1))
    SELECT EventDate, CAST(size AS INT) AS size, CAST(id AS VARCHAR) AS event_id, 'modern-challenge-' || size || '-' || EventDate || id AS slug, 'calendar' AS listed FROM o WHERE size > 0 AND EventDate BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'""", dates="EventDate")
def s16_calendar_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.all_rows(spark, _stored(spark, sf_dir), "s:dgc/calendar", "tournament_calendar_list", _PAGE)
    return pages.found_events(pages.calendar_events(rows, " Modern", "1994-01-01", "1996-12-31"), _index(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events of an index page."""
    day, n = F.to_date("o_orderdate"), F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(day.alias("EventDate"), F.when(n % 2 == 0, 64).otherwise(32).alias("size"), n.cast("string").alias("event_id"), F.concat(F.lit("slug-"), n.cast("string")).alias("slug"))


@query("""SELECT CAST(o_orderdate AS DATE) AS EventDate, CASE WHEN o_orderkey % 2 = 0 THEN 64 ELSE 32 END AS size, CAST(max(o_orderkey) AS VARCHAR) AS event_id, 'slug-' || max(o_orderkey) AS slug, 'index' AS listed FROM orders GROUP BY 1, 2""", dates="EventDate")
def s16_events_of_the_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar without an event of the format leaves the index page."""
    rows = _calendar(spark, sf_dir).select(F.explode(F.from_json(F.get_json_object("body", "$.tournament_calendar_list"), "array<string>")).alias("value"))
    return pages.found_events(pages.calendar_events(rows, "Vintage", "1992-01-01", "2002-12-31"), _index(spark, sf_dir))


@query(PRESENCE + """, o AS (SELECT *, row_number() OVER (PARTITION BY Tier ORDER BY Top32EventFreqPct DESC, Top32EventCount DESC, Deck) AS i FROM p)
    SELECT CAST(2 * dense_rank() OVER (ORDER BY Tier) AS VARCHAR) || '_C' || Tier || '_Decks' AS sheet, CAST(i AS INT) AS position, Deck FROM o
    UNION ALL SELECT '1_STATUS', 1, NULL""")
def k04_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheets of a run, written and read again: their order, and that of the decks in them. The history is written once for all."""
    folder = shared_folder(spark)
    h = cut(history(spark, sf_dir).select("EventID", "EventDate", "Tier", "Place", "Deck", "Archetype", "Pilot", "LoginID", "row_id", T.identity_key("LoginID", "Pilot").alias("_id")))
    entries = P.uncounted(h)
    events = cut(P.event_counts(entries))
    decks, groups = (cut(P.presence_of(entries, key, events)) for key in ("Deck", "Archetype"))
    tiers = sorted(r.Tier for r in decks.select("Tier").distinct().collect())
    status = spark.createDataFrame([(True, False)], "Complete boolean, Partial boolean")
    sheets = sinks.statistics_sheets(status, tiers, decks, groups, P.all_tiers(decks), P.all_tiers(groups, "Archetype"), P.pilot_table(h, F.col("row_id")))
    sinks.write_sheets(sheets, folder)
    read_back = None
    for i, name in enumerate(sheets, 1):
        if name == "STATUS" or (name.endswith("_Decks") and not name.startswith("ALL")):
            rows = S.numbered(S.read_csv(spark, f"{folder}/{i:02d}_{name}", ("Deck",))).select(F.lit(f"{i}_{name}").alias("sheet"), (F.col("ordinal") + 1).cast("int").alias("position"), F.nullif("Deck", F.lit("")).alias("Deck"))
            read_back = rows if read_back is None else read_back.unionByName(rows)
    return read_back


_RULES = """WITH r AS (SELECT CASE p_partkey % 3 WHEN 0 THEN 'contains' WHEN 1 THEN 'regex' ELSE 'exact' END AS kind, CASE p_partkey % 3 WHEN 0 THEN upper(split_part(p_name, ' ', 2)) || ' b' WHEN 1 THEN '^' || split_part(p_name, ' ', 1) || ' .*' || right(p_brand, 2) || '$' ELSE p_name || '  ' || p_brand END AS pattern,
        'T' || p_partkey AS target, p_partkey % 7 AS priority, p_partkey AS ordinal FROM part WHERE p_partkey % 5 = 0)
    , n AS (SELECT DISTINCT p_name || ' ' || p_brand AS name FROM part),
    m AS (SELECT name, arg_min(target, (priority, ordinal)) AS target FROM n JOIN r ON CASE kind WHEN 'exact' THEN lower(name) = lower(replace(pattern, '  ', ' ')) WHEN 'contains' THEN contains(lower(name), lower(pattern)) ELSE regexp_matches(name, '(?i)' || pattern) END GROUP BY name)
"""


@query(_RULES + "SELECT p_partkey, target FROM part LEFT JOIN m ON name = p_name || ' ' || p_brand")
def j03_s04_rules_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule table of a fifth of the parts, written and read as a file, on all names."""
    part, folder = read(spark, sf_dir, "part"), shared_folder(spark)
    kind, word = F.col("p_partkey") % 3, lambda i: F.split("p_name", " ")[i]
    pattern = F.when(kind == 0, F.concat(F.upper(word(1)), F.lit(" b"))).when(kind == 1, F.concat(F.lit("^"), word(0), F.lit(" .*"), F.right("p_brand", F.lit(2)), F.lit("$"))).otherwise(F.concat_ws("  ", "p_name", "p_brand"))
    rules = part.where("p_partkey % 5 = 0").select(pattern.alias("pattern"), F.concat(F.lit("T"), "p_partkey").alias("canonical_name"), F.when(kind == 0, "").when(kind == 1, " Regex").otherwise("EXACT").alias("match_type"), (F.col("p_partkey") % 7).alias("priority"), F.col("p_partkey").alias("place"))
    sinks.write_csv(rules, f"{folder}/rules")
    stored = S.read_csv(spark, f"{folder}/rules", ("pattern", "canonical_name", "match_type", "priority", "place")).withColumn("ordinal", F.col("place").cast("long"))
    names = part.select(F.concat_ws(" ", "p_name", "p_brand").alias("name")).distinct()
    found = R.first_match(names, R.load_rules(stored, "canonical_name"), base=T.text_of("name"), key=T.normalize_name("name"), pattern_key=T.normalize_name("pattern"))
    return part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("name")).join(found, "name", "left").select("p_partkey", "target")


_CHANGED = "CAST(EventID AS BIGINT) > (SELECT 0.99 * max(CAST(EventID AS BIGINT)) FROM h)"


def _changed(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, list]:
    """The history in 16 files by event, of which the newest hundredth of the ids is read again, then one deck renamed there."""
    h = history(spark, sf_dir).select(F.col("EventID").cast("long").alias("Event"), "EventID", "Pilot", "Place", "Deck", "Archetype").withColumn("Deck", F.when(F.col("Place") == 1, U.SENTINEL).otherwise(F.col("Deck")))
    table = KeyedTable(spark, f"{shared_folder(spark)}/keyed", "Event")
    changes = [table.create(h, 16)]
    top = h.agg(F.max("Event").alias("top"))
    fresh = h.join(F.broadcast(top), F.col("Event") > 0.99 * F.col("top")).drop("top").withColumns({"Deck": F.lit("again"), "Archetype": F.lit("new")})
    again = lambda old: U.replace_again(old.drop("Event"), fresh.drop("Event")).withColumn("Event", F.col("EventID").cast("long"))
    changes.append(table.change(fresh.select("Event"), again, 1))
    changes.append(table.update(F.col("Deck") == "again", {"Deck": F.lit("winner")}, 1))
    return table, changes


@query(H + f""", d AS (SELECT EventID, Pilot, max((Deck, Archetype)) AS s FROM h WHERE Place <> 1 AND {_CHANGED} GROUP BY ALL)
    SELECT EventID, Pilot, CAST(Place AS INT) AS Place, CASE WHEN {_CHANGED} THEN coalesce(s[1], 'winner') WHEN Place = 1 THEN 'NEEDS_MANUAL_REVIEW' ELSE Deck END AS Deck, CASE WHEN {_CHANGED} THEN coalesce(s[2], 'new') ELSE Archetype END AS Archetype FROM h LEFT JOIN d USING (EventID, Pilot)""".replace("(Deck, Archetype)", "[Deck, Archetype]"))
def u01_u06_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after both changes, from its newest version."""
    table, _ = _changed(spark, sf_dir)
    return table.read().select("EventID", "Pilot", "Place", "Deck", "Archetype")


@query(H + """SELECT * FROM (VALUES (1, true, true), (2, true, true), (3, true, true)) AS t(version, few_rewritten, others_kept)""")
def u01_files_of_a_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each version, whether two files or fewer were rewritten and the others of the sixteen stayed."""
    _, changes = _changed(spark, sf_dir)
    rows = [(c.version, c.rewritten <= 2 and c.looked_into <= 2, c.version == 1 or c.kept >= 13) for c in changes]
    return spark.createDataFrame(rows, "version int, few_rewritten boolean, others_kept boolean")


@query(H + "SELECT EventID, Place, Pilot AS OldPilot, Pilot || ' jr' AS NewPilot, LoginID AS NewLoginID FROM h WHERE CAST(EventID AS BIGINT) % 9 = 0")
def j17_drift_of_bucketed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored and fresh results, both bucketed by event, so that they join where they lie."""
    stored, fresh = _bucketed(spark, sf_dir)
    return L.name_drift(stored, fresh)


def _bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    h = cut(history(spark, sf_dir).select("EventID", "Place", "Pilot", "LoginID"))
    buckets = sinks.buckets_of(h)
    renamed = h.withColumn("Pilot", F.when(F.col("EventID").cast("long") % 9 == 0, F.concat("Pilot", F.lit(" jr"))).otherwise(F.upper("Pilot")))
    name = uuid.uuid4().hex
    return tuple(sinks.write_bucketed(t, f"results_{s}_{name}", f"{shared_folder(spark)}/{s}", buckets=buckets).hint("merge") for s, t in (("stored", h), ("fresh", renamed)))


@query(H + """, w AS (SELECT DISTINCT date_trunc('month', EventDate) AS m FROM h), n AS (SELECT m, row_number() OVER (ORDER BY m) AS i FROM w),
    d AS (SELECT date_trunc('month', EventDate) AS m, Deck, any_value(CASE WHEN Deck < 'Brand#2' THEN 'Brand#11' ELSE left(Deck, 7) END) AS A, CAST(count(*) AS DOUBLE) AS Meta FROM h WHERE month(EventDate) % 5 <> 0 GROUP BY ALL),
    r AS (SELECT m, Deck, Meta, 'Deck' AS Level FROM d UNION ALL SELECT m, A, sum(Meta), 'Archetype' FROM d GROUP BY m, A), x AS (SELECT * FROM r JOIN n USING (m)),
    p AS (SELECT *, avg(Meta) OVER (PARTITION BY Deck ORDER BY i, Level = 'Archetype' ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS past FROM x)
    SELECT CAST(i AS INT) AS WeekIndex, CAST(CAST(m AS DATE) AS VARCHAR) AS WeekStart, Deck, Level, Meta, CASE WHEN Level = 'Archetype' OR past IS NULL THEN 'Stable' WHEN Meta - past > 0.5 THEN 'Rising' WHEN Meta - past < -0.5 THEN 'Falling' ELSE 'Stable' END AS "Trend Label" FROM p""")
def u05_rebuilt_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as runs, two of each year without decks; some archetypes have the name of a deck."""
    h = history(spark, sf_dir).withColumn("start", F.trunc("EventDate", "MM"))
    path = week_folder(F.col("start"), F.last_day("start"))
    runs = S.run_folders(h.select("start").distinct().select(F.concat(F.lit("runs/"), path).alias("path")))
    group = F.when(F.col("Deck") < "Brand#2", "Brand#11").otherwise(F.left("Deck", F.lit(7)))
    decks = h.where(F.month("EventDate") % 5 != 0).groupBy(F.concat(F.lit("runs/"), path).alias("path"), "Deck").agg(F.count("*").cast("double").alias("Meta")).withColumn("Archetype", group)
    return U.rebuilt_shares(runs, decks).select("WeekIndex", F.col("WeekStart").cast("string").alias("WeekStart"), "Deck", "Level", "Meta", "Trend Label")
