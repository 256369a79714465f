"""Queries of table changes, sources and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderworks.operators import presence as P
from ladderworks.operators import quality as Q
from ladderworks.operators import review
from ladderworks.operators import rules as R
from ladderworks.operators import similarity as N
from ladderworks.operators import state as U
from ladderworks.plans.meta_queries import _RULE_SQL, _rules
from ladderworks.plans.standins import H, history, query, read
from ladderworks.sources import events, sinks, tables
from ladderworks.sources.scratch import cut, once, shared_folder
from ladderworks.sources.store import KeyedTable
from ladderworks.streaming import pending
from ladderworks.streaming.sync import activity_windows

_COLS = "EventID, EventDate, Format, Place, Deck, Archetype, Pilot"


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History with one row per event and pilot, the best placed."""
    h = history(spark, sf_dir)
    first = h.groupBy("EventID", "Pilot").agg(F.min("Place").alias("Place"))
    return h.join(first, ["EventID", "Pilot", "Place"]).select(*_COLS.split(", "))


_S = H + f", s AS (SELECT {_COLS} FROM h QUALIFY row_number() OVER (PARTITION BY EventID, Pilot ORDER BY Place) = 1)\n"


@query(_S + """, f AS (SELECT EventID, EventDate, Format, Place, CASE WHEN Place = 1 AND CAST(EventID AS BIGINT) % 4 <> 0 THEN Deck ELSE 'fresh' END AS Deck, CASE WHEN Place = 1 AND CAST(EventID AS BIGINT) % 4 <> 0 THEN Archetype ELSE 'new' END AS Archetype, Pilot || '' AS Pilot
        FROM s WHERE Format = 'F' AND EventDate BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' AND CAST(EventID AS BIGINT) % 3 = 0)
    SELECT EventID, EventDate, Format, Place, CASE WHEN CAST(EventID AS BIGINT) % 4 = 0 THEN 'NEEDS_MANUAL_REVIEW' ELSE Deck END AS Deck, Archetype, Pilot FROM s WHERE EventID NOT IN (SELECT EventID FROM f) UNION ALL
    SELECT EventID, EventDate, Format, Place, CASE WHEN CAST(EventID AS BIGINT) % 4 = 0 THEN 'fresh' ELSE (SELECT x.Deck FROM s x WHERE x.EventID = f.EventID AND x.Pilot = f.Pilot) END, CASE WHEN CAST(EventID AS BIGINT) % 4 = 0 THEN 'new' ELSE (SELECT x.Archetype FROM s x WHERE x.EventID = f.EventID AND x.Pilot = f.Pilot) END, Pilot FROM f""", dates="EventDate")
def u01_j13_window_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _stored(spark, sf_dir)
    waiting = F.col("EventID").cast("long") % 4 == 0
    stored = s.withColumn("Deck", F.when(waiting, U.SENTINEL).otherwise(F.col("Deck")))
    fresh = s.where((F.col("Format") == "F") & F.col("EventDate").between("1998-01-01", "1998-06-30") & (F.col("EventID").cast("long") % 3 == 0)).withColumns({"Deck": F.lit("fresh"), "Archetype": F.lit("new")})
    return U.sync_window(stored, fresh, "f", "1998-01-01", "1998-06-30")


@query(_S + f"SELECT {_COLS} FROM s WHERE CAST(EventID AS BIGINT) % 100 <> 0 UNION ALL SELECT EventID, EventDate, Format, Place, 'x', Archetype, Pilot FROM s WHERE CAST(EventID AS BIGINT) % 100 = 0", dates="EventDate")
def u02_u06_o03_replace_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _stored(spark, sf_dir)
    return U.replace_event(s, s.where(F.col("EventID").cast("long") % 100 == 0).withColumn("Deck", F.lit("x")), "EventID").select(*_COLS.split(", "))


@query(H + """, f AS (SELECT CASE WHEN CAST(EventID AS BIGINT) % 5 = 0 THEN '' ELSE EventID END AS EventID, EventDate, Tier, Place, Deck, CAST(EventID AS BIGINT) * 100 + Place AS ordinal FROM h),
    k AS (SELECT DISTINCT EventDate, Tier FROM f WHERE EventID <> ''), a AS (SELECT * FROM f WHERE EventID <> '' UNION ALL SELECT f.* FROM f ANTI JOIN k USING (EventDate, Tier) WHERE EventID = '')
    SELECT EventID, EventDate, Tier, Place, Deck FROM a QUALIFY row_number() OVER (PARTITION BY EventID, EventDate, Tier, Place ORDER BY ordinal DESC) = 1""", dates="EventDate")
def u03_rebuilt_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    files = h.select(F.when(F.col("EventID").cast("long") % 5 == 0, "").otherwise(F.col("EventID")).alias("EventID"), "EventDate", "Tier", "Place", "Deck", F.col("row_id").alias("ordinal"))
    return U.rebuild(files).select("EventID", "EventDate", "Tier", "Place", "Deck")


@query(H + """, w AS (SELECT Deck, CAST(year(EventDate) - 1994 AS INT) AS WeekIndex, 'Deck' AS Level, count(*) AS Meta FROM h GROUP BY ALL)
    SELECT * FROM w WHERE WeekIndex <> 3 UNION ALL SELECT Deck, 3, 'Deck', Meta FROM w WHERE WeekIndex = 2 UNION ALL SELECT 'all', 3, 'Archetype', CAST(sum(Meta) AS BIGINT) FROM w WHERE WeekIndex = 2""")
def u04_replaced_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = history(spark, sf_dir).groupBy("Deck", (F.year("EventDate") - 1994).alias("WeekIndex")).agg(F.count("*").alias("Meta")).select("Deck", "WeekIndex", F.lit("Deck").alias("Level"), "Meta")
    decks = w.where("WeekIndex = 2").withColumn("WeekIndex", F.lit(3))
    total = decks.agg(F.sum("Meta").alias("Meta")).select(F.lit("all").alias("Deck"), F.lit(3).alias("WeekIndex"), F.lit("Archetype").alias("Level"), "Meta")
    return U.replace_week(w, decks, total, 3)


@query("SELECT DISTINCT date_trunc('week', o_orderdate)::DATE AS WeekStart, date_trunc('week', o_orderdate)::DATE + 6 AS WeekEnd, dense_rank() OVER (ORDER BY date_trunc('week', o_orderdate)) AS WeekIndex FROM orders", dates="WeekStart WeekEnd")
def u05_numbered_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.to_date(F.date_trunc("week", "o_orderdate"))
    return U.numbered_weeks(read(spark, sf_dir, "orders").select(start.alias("WeekStart"), F.date_add(start, 6).alias("WeekEnd")))


_RULES = """WITH r AS (SELECT DISTINCT p_name AS pattern, 'exact' AS match_type, 'old' AS target, 100 AS priority FROM part),
    q AS (SELECT p_name AS pattern, arg_max(p_brand, p_partkey) AS target FROM part WHERE p_partkey % 11 = 0 GROUP BY 1)
"""


@query(_RULES + "SELECT * FROM r WHERE pattern NOT IN (SELECT pattern FROM q) UNION ALL SELECT upper(pattern), 'exact', target, 1 FROM q")
def u07_u16_rule_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    rules = part.select(F.col("p_name").alias("pattern")).distinct().withColumns({"match_type": F.lit("exact"), "target": F.lit("old"), "priority": F.lit(100)})
    queued = part.where("p_partkey % 11 = 0").select(F.upper("p_name").alias("pattern"), F.lit("exact").alias("match_type"), F.col("p_brand").alias("target"), F.lit(1).alias("priority"), F.col("p_partkey").alias("ordinal"))
    blank = queued.limit(1).withColumn("pattern", F.lit(" "))
    return U.upsert_rules(rules, queued.unionByName(blank), "target")


@query("""WITH m AS (SELECT p_name AS raw_name, 'a' AS canonical_name FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL), q AS (SELECT p_name AS raw_name, arg_max(p_brand, p_partkey) AS canonical_name FROM part WHERE p_partkey % 3 = 0 GROUP BY 1)
    SELECT * FROM q UNION ALL SELECT * FROM m WHERE raw_name NOT IN (SELECT raw_name FROM q)""")
def u07_mapping_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    saved = part.where("p_partkey % 2 = 0").select(F.col("p_name").alias("raw_name")).distinct().withColumn("canonical_name", F.lit("a"))
    return U.upsert_mappings(saved, part.where("p_partkey % 3 = 0").select(F.col("p_name").alias("raw_name"), F.col("p_brand").alias("canonical_name"), F.col("p_partkey").alias("ordinal")))


@query("""WITH m AS (SELECT p_name AS raw_name, 'a' AS canonical_name FROM part WHERE p_partkey % 7 = 0 AND p_name <> 'old bolt' GROUP BY ALL), q AS (SELECT p_name AS raw_name, arg_max(p_brand, p_partkey) AS canonical_name FROM part WHERE p_partkey % 3 = 0 GROUP BY 1)
    SELECT * FROM m UNION ALL SELECT * FROM q WHERE raw_name NOT IN (SELECT raw_name FROM m)""")
def u11_editor_saves(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    saved = U.remove_mapping(part.where("p_partkey % 7 = 0").select(F.col("p_name").alias("raw_name")).distinct().withColumn("canonical_name", F.lit("a")), "Old  Bolt")
    return U.add_missing_mappings(saved, part.where("p_partkey % 3 = 0").select(F.col("p_name").alias("raw_name"), F.col("p_brand").alias("canonical_name"), F.col("p_partkey").alias("ordinal")))


@query("SELECT min(p_partkey) AS ordinal, CASE WHEN p_type = 'PROMO' THEN 'Other' ELSE arg_min(CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) ELSE p_type END, p_partkey) END AS archetype FROM part GROUP BY p_type")
def u08_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(F.col("p_partkey") % 2 == 0, F.lower("p_type")).otherwise(F.col("p_type"))
    return U.replace_archetype(U.catalog(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("ordinal"), mixed.alias("archetype"))), "promo", "Other")


_ASSIGNED = """, a AS (SELECT p_brand AS deck, 'Fixed ' || max(p_partkey) AS archetype FROM part WHERE p_partkey % 2 = 0 AND p_brand < 'Brand#3' GROUP BY 1)
"""


def _assigned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Decks that are assigned an archetype again and again, and some that are told to be unknown."""
    part, n = read(spark, sf_dir, "part"), F.col("p_partkey")
    said = part.where("p_brand < 'Brand#3'").select(n.alias("ordinal"), F.upper("p_brand").alias("deck"), F.when(n % 2 == 0, F.concat(F.lit("Fixed "), n)).when(n % 4 == 1, "Unknown").otherwise(" ").alias("archetype"))
    rules = part.select("p_brand").distinct().select(F.col("p_brand").alias("pattern"), F.lit("exact").alias("match_type"), F.lit("old").alias("target"), F.lit(100).alias("priority"))
    return U.save_assignments(history(spark, sf_dir), rules, said)


@query(H + _ASSIGNED + "SELECT EventID, Place, coalesce(a.archetype, h.Archetype) AS Archetype FROM h LEFT JOIN a ON h.Deck = a.deck")
def u15_assigned_archetypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir)[0].select("EventID", "Place", "Archetype")


@query(H + _ASSIGNED + "SELECT upper(deck) AS pattern, 'exact' AS match_type, archetype AS target, 1 AS priority FROM a UNION ALL SELECT DISTINCT p_brand, 'exact', 'old', 100 FROM part WHERE p_brand NOT IN (SELECT deck FROM a)")
def u15_rules_of_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir)[1]


_HITS = """, x AS (SELECT RawDeck AS raw, arg_max(Deck, CAST(EventID AS BIGINT) * 100 + Place) AS D FROM h WHERE RawDeck LIKE '%bolt%' GROUP BY RawDeck)
"""


def _relabelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """All rows that a search finds get an archetype, in weeks up to the end of 1999."""
    h = history(spark, sf_dir)
    hits = h.where(U.matches(" BOLT", ("RawDeck",))).select(F.col("row_id").alias("ordinal"), F.col("RawDeck").alias("raw_deck"), "Deck")
    rows = h.withColumns({"source_names": F.concat(F.lit("none | "), F.upper("RawDeck")), "week_end": F.col("EventDate")})
    mappings = spark.createDataFrame([("Old  Bolt", "kept?", "kept?"), ("other", "stays", "stays")], "raw_name string, canonical_name string, archetype string")
    none = spark.createDataFrame([("other", "exact", "stays", 5)], "pattern string, match_type string, target string, priority int")
    return U.relabel(rows, hits, " Bolted ", mappings, none, none, F.lit("1999-12-31").cast("date"))


@query(H + _HITS + "SELECT EventID, Place, CASE WHEN EventDate <= DATE '1999-12-31' THEN coalesce(D, Deck) ELSE Deck END AS Deck, CASE WHEN EventDate <= DATE '1999-12-31' AND D IS NOT NULL THEN 'Bolted' ELSE Archetype END AS Archetype FROM h LEFT JOIN x ON raw = RawDeck")
def u14_relabelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relabelled(spark, sf_dir)[0].select("EventID", "Place", "Deck", "Archetype")


@query(H + _HITS + """SELECT 'mapping' AS kind, raw AS name, D || '/Bolted' AS target FROM x UNION ALL SELECT 'mapping', 'other', 'stays/stays' UNION ALL SELECT 'alias', raw, D FROM x UNION ALL SELECT 'alias', 'other', 'stays'
    UNION ALL SELECT 'rule', raw, 'Bolted' FROM x UNION ALL SELECT DISTINCT 'rule', Deck, 'Bolted' FROM h WHERE RawDeck LIKE '%bolt%' UNION ALL SELECT 'rule', 'other', 'stays'""")
def u14_saved_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mappings, aliases, rules = _relabelled(spark, sf_dir)
    said = mappings.select(F.lit("mapping").alias("kind"), F.col("raw_name").alias("name"), F.concat_ws("/", "canonical_name", "archetype").alias("target"))
    for kind, table in (("alias", aliases), ("rule", rules)):
        said = said.unionByName(table.select(F.lit(kind).alias("kind"), F.col("pattern").alias("name"), "target"))
    return said


@query(H + "SELECT EventID, CAST(count(*) AS BIGINT) AS players FROM h WHERE CAST(EventID AS BIGINT) % 4 < 3 GROUP BY EventID")
def s17_cached_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a folder by either name; one in four events isn't there, one has an older file besides."""
    folder = shared_folder(spark)
    docs = _documents(spark, sf_dir).select(F.col("event.event_id").alias("id"), F.to_json("event").alias("body"))
    n, file = F.col("id").cast("long") % 4, lambda end, body: F.struct(F.concat("id", F.lit(end)).alias("name"), body.alias("body"))
    both = F.array(F.when(n < 2, file(".json", F.col("body"))), F.when(n.isin(1, 2), file(".0.json", F.when(n == 1, "{}").otherwise(F.col("body")))))
    rows = cut(docs.select(F.explode(both).alias("f")).where("f IS NOT NULL").select("f.*"))
    sinks.write_documents(rows, f"{folder}/events", F.col("name"), F.col("body"))
    ids = history(spark, sf_dir).select(F.concat("EventID", F.lit(".0")).alias("EventID")).distinct()
    return events.cached_events(spark, f"{folder}/events", ids).select("EventID", F.col("event.player_count.players").cast("long").alias("players"))


@query(H + """, c AS (SELECT p_name, min(p_brand) AS canonical_name FROM part WHERE p_name LIKE '%bolt' GROUP BY 1)
    SELECT EventID, Place, CASE WHEN EventDate <= DATE '1999-12-31' THEN coalesce(canonical_name, Deck) ELSE Deck END AS Deck FROM h LEFT JOIN c ON p_name = RawDeck""")
def j20_propagated_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = read(spark, sf_dir, "part").where("p_name LIKE '%bolt'").groupBy(F.col("p_name").alias("raw_name")).agg(F.min("p_brand").alias("canonical_name"), F.min("p_type").alias("archetype"))
    rows = history(spark, sf_dir).withColumns({"source_names": F.concat(F.lit("none | "), F.upper("RawDeck")), "week_end": F.col("EventDate")})
    return U.propagate(rows, changes, F.lit("1999-12-31").cast("date")).select("EventID", "Place", "Deck")


@query(H + """, i AS (SELECT DISTINCT CASE WHEN CAST(EventID AS BIGINT) % 200 = 0 THEN 'x' || EventID ELSE EventID END AS E, EventID, Pilot FROM h), n AS (SELECT EventID, Pilot, count(*) AS n FROM h GROUP BY ALL)
    SELECT E AS EventID, Pilot, CASE WHEN E <> i.EventID THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'updated' END AS outcome FROM i JOIN n USING (EventID, Pilot)""")
def j19_review_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    key = F.col("EventID").cast("long")
    items = h.select(F.when(key % 200 == 0, F.concat(F.lit("x"), "EventID")).otherwise(F.col("EventID")).alias("EventID"), "Pilot").distinct()
    return U.apply_review(h, items.withColumn("resolved_deck", F.lit("R"))).select("EventID", "Pilot", "outcome")


@query(H + """, n AS (SELECT EventID, Pilot, count(*) AS n FROM h GROUP BY ALL) SELECT EventID, Place, CASE WHEN n = 1 AND CAST(EventID AS BIGINT) % 50 = 0 THEN 'R' ELSE Deck END AS Deck FROM h JOIN n USING (EventID, Pilot)""")
def j19_u09_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return U.reviewed(h, h.where(F.col("EventID").cast("long") % 50 == 0).select("EventID", "Pilot").distinct().withColumn("resolved_deck", F.lit("R"))).select("EventID", "Place", "Deck")


@query("""WITH r AS (SELECT p_name AS raw_deck, p_brand AS deck, CASE WHEN p_partkey % 10 = 0 THEN 'unknown' ELSE p_type END AS archetype, p_partkey FROM part WHERE p_partkey >= 100 AND p_name NOT LIKE 'hot%'),
    x AS (SELECT *, concat_ws(', ', CASE WHEN archetype = 'unknown' THEN 'Unknown Archetype' WHEN archetype = 'PROMO' THEN 'Non-catalog Archetype' END, CASE WHEN raw_deck NOT IN (SELECT p_name FROM part WHERE p_partkey < 100) THEN 'First Seen Raw' END, CASE WHEN deck NOT IN (SELECT p_brand FROM part WHERE p_partkey < 100) THEN 'First Seen Deck' END) AS reason FROM r)
    SELECT raw_deck, deck, archetype, reason FROM x WHERE reason <> ''""")
def u12_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    rows = part.select(F.col("p_name").alias("raw_deck"), F.col("p_brand").alias("deck"), F.when(F.col("p_partkey") % 10 == 0, "unknown").otherwise(F.col("p_type")).alias("archetype"), "p_partkey")
    known = part.where("p_type <> 'PROMO'").select(F.col("p_type").alias("archetype"))
    handled = part.where("p_name LIKE 'hot%'").select(F.col("p_name").alias("raw_name"))
    return U.review_reasons(rows.where("p_partkey >= 100"), known, rows.where("p_partkey < 100"), handled)


@query(H + "SELECT EventID, Place, CASE WHEN RawDeck LIKE '%bolt%' THEN 'Bolted' ELSE Archetype END AS Archetype FROM h")
def u14_bulk_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.bulk_relabel(history(spark, sf_dir), " BOLT", "Bolted").select("EventID", "Place", "Archetype")


@query(H + "SELECT EventID, Place FROM h WHERE RawDeck LIKE '%bolt%' AND Archetype = 'PROMO' ORDER BY CAST(EventID AS BIGINT) * 100 + Place LIMIT 500")
def p07_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.search(history(spark, sf_dir).withColumn("ordinal", F.col("row_id")), "bolt", "promo").select("EventID", "Place")


@query(H + "SELECT 'archetype' AS asked, count(*) AS n FROM (SELECT 1 FROM h WHERE Archetype = 'PROMO' LIMIT 500) UNION ALL SELECT 'nothing', 0")
def p07_search_without_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archetype alone finds its rows; nothing at all finds none."""
    rows = history(spark, sf_dir).withColumn("ordinal", F.col("row_id"))
    found = lambda name, archetype: U.search(rows, " ", archetype).agg(F.lit(name).alias("asked"), F.count("*").alias("n"))
    return found("archetype", "promo").unionByName(found("nothing", None))


@query("SELECT 'saved_mapping' AS check_id, 'hard' AS severity, p_name || p_partkey AS key, CASE WHEN p_partkey % 4 = 0 THEN 'missing' ELSE 'b' END AS detail FROM part WHERE p_partkey % 4 <> 1")
def q09_saved_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    rows = part.select(F.concat("p_name", F.col("p_partkey").cast("string")).alias("raw_name"), F.when(F.col("p_partkey") % 4 == 1, "b").otherwise("a").alias("canonical_name"), "p_partkey")
    return Q.saved_mappings_check(rows, rows.where("p_partkey % 4 <> 0").withColumn("canonical_name", F.lit("b")))


@query(H + """, e AS (SELECT DISTINCT EventID, EventDate FROM h) SELECT EventID, EventDate, CAST(EventID AS BIGINT) % 6 <> 0 AS fetched FROM e""", dates="EventDate")
def j18_registry_against_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = history(spark, sf_dir).select("EventID", "EventDate").distinct()
    stored = registry.where(F.col("EventID").cast("long") % 6 != 0).select("EventID")
    there = registry.join(stored, "EventID", "left_semi").withColumn("fetched", F.lit(True))
    return there.unionByName(registry.join(stored, "EventID", "left_anti").withColumn("fetched", F.lit(False)))




def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    slug = F.when(F.col("o_orderkey") % 3 == 0, "modern-challenge-64").when(F.col("o_orderkey") % 3 == 1, "modern-super-qualifier").otherwise("pauper-league")
    link = F.concat(F.when(F.col("o_orderkey") % 2 == 0, '<p><A HREF="/Decklist/').otherwise('<p><a href="/decklist/'), slug, F.lit("-"), day, (F.col("o_orderkey") + 12000000).cast("string"), F.lit('">x</a> <a href="/other">y</a></p>'))
    return read(spark, sf_dir, "orders").select(link.alias("html"))


@query("""SELECT CASE o_orderkey % 3 WHEN 0 THEN 'modern-challenge-64' WHEN 1 THEN 'modern-super-qualifier' ELSE 'pauper-league' END AS slug, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey + 12000000 AS VARCHAR) AS event_id,
    CASE o_orderkey % 3 WHEN 0 THEN 'challenge' WHEN 1 THEN 'premier' ELSE 'ignored' END AS kind, CASE o_orderkey % 3 WHEN 0 THEN 64 END AS size FROM orders""", dates="date")
def s10_s12_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.registry(events.index_links(_pages(spark, sf_dir)), "^modern-challenge", "qualifier", "league")


@query("""SELECT CAST(o_orderdate AS DATE) AS date, 64 AS size, CAST(max(o_orderkey) + 12000000 AS VARCHAR) AS event_id, 'modern-challenge-64' AS slug FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL""", dates="date")
def s10_s16_newest_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.newest_of_day(events.registry(events.index_links(_pages(spark, sf_dir)), "^modern-challenge", "qualifier", "league").where("kind = 'challenge'"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, count(*) + month(any_value(o_orderdate)) % 2 AS n_stored, 'fewer links' AS reason FROM orders GROUP BY 1 HAVING month(any_value(o_orderdate)) % 2 = 1""")
def s13_truncated_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = events.index_links(_pages(spark, sf_dir))
    stored = links.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg((F.count("*") + F.month(F.min("date")) % 2).alias("n_stored"))
    return events.truncated_months(links, stored, F.lit("1990-01-01").cast("date"))


@query(H + "SELECT EventID, CAST(Place AS INT) AS place, CASE WHEN Place = 3 THEN Deck || ' Mana cost 3' ELSE Deck END AS deck, Pilot AS pilot FROM h WHERE Place NOT IN (2, 4, 5)")
def s11_result_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tables in which the second place has no ordinal, the third no colon, the fourth no pilot and the fifth no deck."""
    at = F.col("Place")
    row = F.concat(
        F.lit("<tr class=x><td>"), at.cast("string"), F.when(at == 1, "st").when(at == 2, "").otherwise("TH"), F.lit("</td><TD><b>"), F.when(at == 5, "").otherwise(F.col("Deck")),
        F.when(at == 3, "</b> Mana cost 3</TD><td>&nbsp;").otherwise("</b> Mana Cost : 3</TD><td>&nbsp;"), F.when(at == 4, " ").otherwise(F.col("Pilot")), F.lit("</td></tr>"),
    )
    pages = history(spark, sf_dir).groupBy("EventID").agg(F.concat(F.lit("<table><tr><td>Place</td></tr>"), F.array_join(F.collect_list(row), "\n"), F.lit("</table>")).alias("html"))
    return events.result_rows(pages, "EventID").select("EventID", "place", "deck", "pilot")


def _documents(spark: SparkSession, sf_dir: str, layout: str = events.EVENT) -> DataFrame:
    """Event documents as JSON inside a page, from each order. The plain rows are dealt out by event, not the lists made of them."""
    login = F.concat(F.lit("L"), F.col("Place").cast("string"))
    h = history(spark, sf_dir).select("EventID", "Place", "RawDeck", "Pilot").repartition("EventID")
    card = lambda name, qty: F.struct(qty.cast("string").alias("qty"), F.struct(name.alias("card_name")).alias("card_attributes"))
    written = F.concat(F.lit(" "), F.upper(F.replace("RawDeck", F.lit(" "), F.lit("  "))))
    deck = F.struct(login.alias("loginid"), F.col("Pilot").alias("player"), F.array(card(F.col("RawDeck"), F.col("Place") + 1), card(written, F.lit(None)), card(F.lit("Island"), F.lit(9)), card(F.lit(" WASTES "), F.lit(None)), card(F.lit(" "), F.lit(2))).alias("main_deck"))
    rank = F.struct(login.alias("loginid"), F.col("Place").cast("string").alias("rank"))
    standing = F.struct(F.upper("Pilot").alias("login_name"), F.when(F.col("Place") % 2 == 0, login).otherwise("").alias("loginid"), F.col("Place").cast("string").alias("rank"), F.lit("9").alias("score"))
    own = F.when(F.col("EventID").cast("long") % 3 != 0, login).otherwise(" ")
    player = lambda p, win: F.when(F.col("Place") == p, F.struct(F.col("Pilot").alias("player"), (login if win else own).alias("loginid"), F.lit(2 if win else 1).alias("wins"), F.lit(win).alias("winner"), F.lit(p).alias("seeding")))
    h = h.select("EventID", "Place", deck.alias("deck"), rank.alias("entry"), standing.alias("s"), player(1, True).alias("winner"), player(2, False).alias("loser"))  # in generated code
    match = F.struct(F.lit(0).alias("index"), F.array(F.struct(F.array(F.max("winner"), F.max("loser")).alias("players"))).alias("matches"))
    body = F.struct(F.first("EventID").alias("event_id"), F.struct(F.count("*").cast("string").alias("players")).alias("player_count"), F.collect_list("entry").alias("final_rank"), F.transform(F.array_sort(F.collect_list(F.struct("Place", "s"))), lambda s: s["s"]).alias("standings"), F.array_sort(F.collect_list("deck")).alias("decklists"), F.when(F.count("*") > 1, F.array(match)).when(F.col("EventID").cast("long") % 2 == 0, F.array().cast("array<struct<index: int, matches: array<struct<players: array<struct<player: string, loginid: string, wins: int, winner: boolean, seeding: int>>>>>>")).alias("brackets"))
    pages = h.groupBy("EventID").agg(F.concat(F.lit("<script>window.MTGO.decklists.data = "), F.to_json(body), F.lit(";\n</script>")).alias("html")).select("html")
    return events.embedded_events(pages, layout=layout)


_N = H + ", d AS (SELECT * FROM h)\n"


@query(_N + """, n AS (SELECT EventID, count(*) AS n, CAST(EventID AS BIGINT) % 5 AS m FROM d GROUP BY EventID)
    SELECT EventID, CASE WHEN n <> 4 OR m = 4 THEN 'ERROR' WHEN m = 0 THEN 'PENDING' WHEN m = 1 THEN 'ERROR' ELSE 'OK' END AS status, CASE WHEN n <> 4 OR m = 4 THEN 'places are not 1 to 4' WHEN m = 0 THEN 'no decklists' WHEN m = 1 THEN '3 decklists' END AS reason, CAST(n AS INT) AS PlayerCount FROM n""")
def s14_s24_event_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.event_status(_faulty_documents(spark, sf_dir), 4)


def _faulty_documents(spark: SparkSession, sf_dir: str, layout: str = events.EVENT) -> DataFrame:
    """Events of four: some without decklists, with one less, with a login that is ranked twice, or whose last rank is its first,
    some without a bracket."""
    m, again = F.col("event.event_id").cast("long") % 5, lambda i: F.array_append("event.final_rank", F.struct(F.lit("L1").alias("loginid"), F.lit(i).alias("rank"), F.lit(None).cast("string").alias("roundnumber")))
    docs = once(_documents(spark, sf_dir, layout), event=F.col("event").withField("decklists", F.when(m == 0, F.slice("event.decklists", 1, 0)).when(m == 1, F.slice("event.decklists", 1, 3)).otherwise(F.col("event.decklists"))))
    docs = once(docs, event=F.col("event").withField("final_rank", F.when(m == 4, again("2")).when(m == 3, again("1")).otherwise(F.col("event.final_rank"))))
    return once(docs, event=F.col("event").withField("brackets", F.when(m == 2, F.slice("event.brackets", 1, 0)).otherwise(F.col("event.brackets"))))


@query(_N + """, n AS (SELECT EventID, count(*) AS n, CAST(EventID AS BIGINT) % 5 AS m FROM d GROUP BY EventID)
    SELECT CAST(o_orderkey AS VARCHAR) AS EventID, CASE WHEN n IS NULL THEN 'missing' WHEN n <> 4 OR m IN (1, 4) AND m <> 0 THEN 'error' WHEN m = 0 THEN 'pending' WHEN m = 2 THEN 'none' ELSE 'rows' END AS State FROM orders LEFT JOIN n ON EventID = CAST(o_orderkey AS VARCHAR)""")
def s15_k07_event_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned with matches, scanned without a bracket, not published, in error, never scanned."""
    table = pending.match_table(_faulty_documents(spark, sf_dir, events.MATCHES), 4)
    return pending.event_states(table, read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("EventID")))


@query(_N + """, n AS (SELECT EventID, count(*) AS n, CAST(EventID AS BIGINT) % 5 AS m FROM d GROUP BY EventID)
    SELECT a.EventID, 'F' AS Round, a.Pilot AS WinnerPilot, b.Pilot AS LoserPilot FROM n JOIN d a ON n.EventID = a.EventID AND a.Place = 1 JOIN d b ON b.EventID = a.EventID AND b.Place = 2 WHERE n = 4 AND m = 3""")
def s15_k07_committed_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches of a table that was written with the states of its events, where an event that was pending came later."""
    table = KeyedTable(spark, f"{shared_folder(spark)}/matches", "EventID")
    docs = cut(_faulty_documents(spark, sf_dir, events.MATCHES).select("event"))
    late = F.col("event.event_id").cast("long") % 10 == 3
    hidden = once(docs, event=F.col("event").withField("decklists", F.when(late, F.slice("event.decklists", 1, 0)).otherwise(F.col("event.decklists"))))
    table.create(cut(pending.match_table(hidden, 4)), 4)
    table.replace(cut(pending.match_table(docs.where(late), 4)))
    return table.read().where(F.col("State") == pending.ROWS).select("EventID", "Round", "WinnerPilot", "LoserPilot")


@query(_N + "SELECT EventID, 'L' || Place AS LoginID, Pilot, CAST(Place AS INT) AS Place, lower(RawDeck) AS item, CAST(Place + 2 AS BIGINT) AS qty FROM d")
def s15_j25_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.roster_cards(_documents(spark, sf_dir, events.ROSTERS))


@query(_N + """, l AS (SELECT EventID, Pilot, max('L' || Place) AS l FROM d GROUP BY ALL), x AS (SELECT *, CAST(EventID AS BIGINT) % 3 = 0 AS blank FROM d)
    SELECT a.EventID, 'F' AS Round, a.Pilot AS WinnerPilot, 'L1' AS WinnerLoginID, 2 AS WinnerGames, 1 AS WinnerSwissRank, b.Pilot AS LoserPilot, CASE WHEN b.blank THEN l ELSE 'L2' END AS LoserLoginID, 1 AS LoserGames, 2 AS LoserSwissRank, CAST(b.blank AS INT) AS Borrowed
    FROM d a JOIN x b ON a.EventID = b.EventID AND a.Place = 1 AND b.Place = 2 JOIN l ON l.EventID = b.EventID AND l.Pilot = b.Pilot""")
def s23_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.brackets(_documents(spark, sf_dir))


@query(_N + "SELECT EventID, 'no bracket' AS Reason FROM d GROUP BY EventID HAVING count(*) = 1")
def s23_without_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.without_bracket(_documents(spark, sf_dir))


@query(_N + """, l AS (SELECT EventID, Pilot, max('L' || Place) AS l FROM d GROUP BY ALL), r AS (SELECT EventID, CASE WHEN Place % 2 = 0 THEN 'L' || Place ELSE l END AS LoginID, Place, Place % 2 = 1 AS ByName FROM d JOIN l USING (EventID, Pilot))
    SELECT EventID, LoginID, CAST(max(Place) AS INT) AS SwissRank, 9 AS SwissPoints, arg_max(ByName, Place) AS ByName FROM r GROUP BY EventID, LoginID""")
def j14_j24_swiss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.swiss(_documents(spark, sf_dir)).select("EventID", "LoginID", "SwissRank", "SwissPoints", "ByName")


@query(_N + """, l AS (SELECT EventID, Pilot, min('L' || Place) AS l FROM d GROUP BY ALL) SELECT EventID, 'L' || Place AS LoginID, Pilot AS Roster, l AS ByName FROM d JOIN l USING (EventID, Pilot)""")
def j10_j15_roster_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = events.rosters(_documents(spark, sf_dir))
    named = r.withColumn("k", F.lower(F.trim("Pilot"))).where("k IS NOT NULL")
    first = F.min("LoginID").over(Window.partitionBy("EventID", "k"))
    return named.select("EventID", "LoginID", F.col("Pilot").alias("Roster"), first.alias("ByName"))


@query("""SELECT 'runs/' || strftime(d, '%Y/%m/') || 'W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') || '_' || (d - 6) || '_to_' || d AS path, d - 6 AS week_start, d AS week_end FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""", dates="week_start week_end")
def s06_run_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderworks.functions.scoring import week_folder

    d = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    paths = d.select(F.concat(F.lit("runs/"), week_folder(F.date_sub("d", 6), F.col("d"))).alias("path"))
    return tables.run_folders(paths.unionByName(spark.createDataFrame([("runs/readme",)], "path string")))


@query("""SELECT 'runs/' || strftime(d, '%Y/%m/') || 'W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') || '_' || (d - 6) || '_to_' || d AS path FROM (SELECT CAST(max(o_orderdate) AS DATE) AS d FROM orders)""")
def s20_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest_run(s06_run_folders(spark, sf_dir).select("path"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN p_brand ELSE p_type END AS raw_deck FROM part")
def s21_first_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    rows = read(spark, sf_dir, "part").select("p_partkey", F.when(k == 0, F.col("p_name")).otherwise(" ").alias("Source Deck Names"), F.when(k == 1, F.col("p_brand")).alias("Raw Deck"), F.col("p_type").alias("Deck"))
    return tables.first_name(rows).select("p_partkey", "raw_deck")


@query("SELECT p_name AS name, 'parts' AS source_label FROM part UNION ALL SELECT s_name, 'suppliers' FROM supplier")
def s22_o02_labelled_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.labelled_union({"parts": read(spark, sf_dir, "part").select(F.col("p_name").alias("name")), "suppliers": read(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))})


@query("SELECT arg_min(CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END, p_partkey) AS name FROM part GROUP BY p_name")
def s18_o05_distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return tables.distinct_names(read(spark, sf_dir, "part").select(mixed.alias("name"), "p_partkey"), "name", "p_partkey")


@query("SELECT DISTINCT upper(p_type) AS Format FROM part WHERE p_type <> 'PROMO'")
def s19_available_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select(F.col("p_type").alias("Format"))
    return tables.available_formats(part.select(F.upper("Format").alias("Format")).distinct(), part.where("Format <> 'PROMO'").select(F.lower("Format").alias("Format")))


@query("""WITH a AS (SELECT user_id AS key, event_type AS source, max(event_id) AS body FROM events WHERE event_type IN ('view', 'click', 'error') GROUP BY ALL), r AS (SELECT *, CASE source WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS p FROM a)
    SELECT key, CAST(arg_min(body, p) AS VARCHAR) AS body, arg_min(source, p) AS source FROM r GROUP BY key""")
def s08_first_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").where("event_type IN ('view', 'click', 'error')").groupBy(F.col("user_id").alias("key"), F.col("event_type").alias("source")).agg(F.max("event_id").cast("string").alias("body"))
    return tables.first_answer(rows, ("view", "click", "error"))


@query("""SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS VARCHAR) AS start, event_type, count(*) AS n, round_even(sum(value) * 100, 0) / 100 AS value FROM events GROUP BY ALL""")
def streaming_activity_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity_windows(read(spark, sf_dir, "events"))
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", (F.rint(F.col("value") * 100) / 100).alias("value"))


_RAW = "CASE CAST(EventID AS BIGINT) % 5 WHEN 0 THEN ' ' WHEN 2 THEN 'map me' WHEN 3 THEN 'Map  Both' ELSE RawDeck END"


@query(H + f""", s AS (SELECT EventID, Pilot, {_RAW} AS raw, CAST(EventID AS BIGINT) % 5 AS m FROM h WHERE Place = 1), c AS (SELECT EventID, Pilot, count(*) AS n FROM h GROUP BY ALL),
    o AS (SELECT s.*, CASE WHEN m = 0 THEN 'skipped' WHEN m = 4 THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'applied' END AS outcome FROM s JOIN c USING (EventID, Pilot)),
    f AS (SELECT *, CASE m WHEN 2 THEN 'Mapped' WHEN 3 THEN 'Both' ELSE {_RULE_SQL.format(rest='x')} END AS D FROM (SELECT *, raw AS x, lower(raw) AS n FROM o)),
    a AS (SELECT *, CASE WHEN m = 3 THEN 'Given' WHEN contains(lower(D), 'bolt') THEN 'Bolts' WHEN lower(D) = 'small ring' THEN 'Ring' WHEN contains(lower(D), 'widget') THEN 'Widgets' ELSE 'Unknown' END AS A FROM f)
    SELECT h.EventID, h.Place, CASE WHEN a.outcome = 'applied' THEN D ELSE h.Deck END AS Deck, CASE WHEN a.outcome = 'applied' THEN A ELSE h.Archetype END AS Archetype, a.outcome FROM h LEFT JOIN a ON a.EventID = h.EventID AND h.Place = 1""")
def j19_reviewed_decks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winners' decks filled in by hand: by saved mappings, by alias rules, blank, for another name, and where a pilot is there twice."""
    h = history(spark, sf_dir)
    m, raw = F.col("EventID").cast("long") % 5, F.col("RawDeck")
    chosen = h.where("Place = 1").select(F.concat("EventID", F.lit(".0")).alias("event_id"), F.when(m == 4, "nobody").otherwise(F.concat(F.lit(" "), "Pilot")).alias("pilot"), F.when(m == 0, " ").when(m == 2, "map me").when(m == 3, "Map  Both").otherwise(raw).alias("resolved_deck"), F.col("row_id").alias("ordinal"))
    mappings = R.load_mappings(spark.createDataFrame([("Map Me", "Mapped", "", 1), ("map both", "older", "Older", 2), ("MAP BOTH", "Both", "Given", 3)], "raw_name string, canonical_name string, archetype string, ordinal long"))
    rows, outcomes = review.apply_selections(h.select("EventID", "Place", "Pilot", "Deck", "Archetype"), chosen, _rules(spark), _rules(spark), mappings)
    said = outcomes.select(F.regexp_replace("event_id", r"\.0$", "").alias("_e"), "outcome")
    return rows.join(said, (F.col("EventID") == F.col("_e")) & (F.col("Place") == 1), "left").select("EventID", "Place", "Deck", "Archetype", "outcome")


@query("""WITH w AS (SELECT doc_id, w AS item, count(*) AS qty FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY ALL),
    z AS (SELECT doc_id, sum(qty) AS n FROM w GROUP BY 1),
    s AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.qty, b.qty)) AS low FROM w a JOIN w b ON a.item = b.item AND a.doc_id % 3 <> 0 AND b.doc_id % 3 = 0 GROUP BY ALL),
    r AS (SELECT a, lang AS label, low / (x.n + y.n - low) AS sim, row_number() OVER (PARTITION BY a ORDER BY low / (x.n + y.n - low) DESC, b) AS i FROM s JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b JOIN documents d ON d.doc_id = b),
    t AS (SELECT a, max(label) FILTER (i = 1) AS l1, max(sim) FILTER (i = 1) AS s1, max(label) FILTER (i = 2) AS l2 FROM r GROUP BY a),
    f AS (SELECT doc_id AS row_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN l1 = l2 AND s1 >= 0.9 AND doc_id % 2 = 0 OR l1 = l2 AND s1 >= 0.95 AND doc_id % 2 = 1 THEN l1 ELSE 'NEEDS_MANUAL_REVIEW' END AS Deck FROM documents LEFT JOIN t ON a = doc_id)
    SELECT row_id, Deck, CASE WHEN row_id % 3 = 0 THEN 'known' WHEN Deck = 'NEEDS_MANUAL_REVIEW' THEN 'waits' WHEN Deck = 'en' THEN 'English' ELSE 'Unknown' END AS Archetype FROM f""")
def u09_rescanned_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as decks of words: those of two thirds wait, and take the language of their nearest among the others."""
    docs = read(spark, sf_dir, "documents").withColumnRenamed("doc_id", "row_id")
    open_ = F.col("row_id") % 3 != 0
    rows = docs.select("row_id", F.when(F.col("row_id") % 2 == 0, 20).otherwise(5).alias("Place"), F.when(open_, U.SENTINEL).otherwise(F.col("lang")).alias("Deck"), F.when(open_, "waits").otherwise("known").alias("Archetype"))
    mappings = R.load_mappings(spark.createDataFrame([("EN", "en", "English", 1)], "raw_name string, canonical_name string, archetype string, ordinal long"))
    found, _, _ = review.rescan(rows, N.packed_texts(docs, "row_id"), _rules(spark), mappings)
    return found.select("row_id", "Deck", "Archetype")
