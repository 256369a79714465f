"""Queries of presence tables, leagues, brackets and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.operators import bitmaps as B
from ladderworks.operators import league as L
from ladderworks.operators import presence as P
from ladderworks.operators import publishing
from ladderworks.operators import quality as Q
from ladderworks.operators import similarity as N
from ladderworks.plans.standins import H, history, matches, query, read
from ladderworks.sources import sinks
from ladderworks.sources.scratch import cut

_R = lambda x, d=2: f"round_even({x}, {d})"

_PRESENCE = f""", n AS (SELECT Tier, count(DISTINCT EventID) AS n_events FROM h GROUP BY Tier),
    pil AS (SELECT Tier, {{key}}, count(*) AS DistinctPilots, max(c) AS most FROM (SELECT Tier, {{key}}, K, count(*) AS c FROM h GROUP BY ALL) GROUP BY ALL),
    s AS (SELECT Tier, {{key}}, count(DISTINCT EventID) AS Events, count(*) AS Appearances, {_R('avg(Place)', 1)} AS AvgPlace, min(Place) AS BestPlace,
          count(*) FILTER (Place <= 16) AS Top16Count, count(*) FILTER (Place <= 8) AS Top8Count, count(*) FILTER (Place <= 4) AS Top4Count, count(*) FILTER (Place <= 2) AS Top2Count, count(*) FILTER (Place = 1) AS WinnerCount,
          count(DISTINCT EventID) FILTER (Place <= 16) AS Top16EventCount, count(DISTINCT EventID) FILTER (Place <= 8) AS Top8EventCount, count(DISTINCT EventID) FILTER (Place <= 4) AS Top4EventCount,
          count(DISTINCT EventID) FILTER (Place <= 2) AS Top2EventCount, count(DISTINCT EventID) FILTER (Place = 1) AS WinnerEventCount,
          array_to_string(list_sort(list(DISTINCT EventID)), ';') AS EventIDs, array_to_string(list_sort(list(DISTINCT CAST(EventDate AS VARCHAR))), ';') AS EventDates FROM h GROUP BY Tier, {{key}}),
    p AS (SELECT s.*, DistinctPilots, n_events, {_R('Events / n_events * 100.0')} AS PresencePct, {_R('Events / n_events * 100.0')} AS Top32EventFreqPct,
          {_R('Top16EventCount / n_events * 100.0')} AS Top16EventFreqPct, {_R('Top8EventCount / n_events * 100.0')} AS Top8EventFreqPct, Top4EventCount / n_events * 100.0 AS Top4EventFreqPct, Top2EventCount / n_events * 100.0 AS Top2EventFreqPct,
          {_R('Top16EventCount / n_events * 100.0')} AS Top16PresencePct, {_R('Top8EventCount / n_events * 100.0')} AS Top8PresencePct, {_R('WinnerEventCount / n_events * 100.0')} AS WinnerEventFreqPct,
          {_R('Top16Count / Appearances * 100.0')} AS Top16Rate, {_R('Top8Count / Appearances * 100.0')} AS Top8Rate, {_R('WinnerCount / Appearances * 100.0')} AS WinnerRate,
          {_R('Top16Count / Appearances * 100.0')} AS Top16ShareOfTop32EntriesPct, {_R('Top8Count / Appearances * 100.0')} AS Top8ShareOfTop32EntriesPct, {_R('WinnerCount / Appearances * 100.0')} AS WinnerShareOfTop32EntriesPct,
          Events AS Top32EventCount, Appearances AS Top32EntryCount, {_R('most / Appearances', 4)} AS TopPilotShare
          FROM s JOIN pil USING (Tier, {{key}}) JOIN n USING (Tier))
"""
PRESENCE = H + _PRESENCE.format(key="Deck")


@query(PRESENCE + "SELECT * FROM p")
def a01_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.single(history(spark, sf_dir))
    return P.presence_of(rows).join(P.event_lists(rows, "Tier", "Deck"), ["Tier", "Deck"])


@query(H + _PRESENCE.format(key="Archetype") + "SELECT * FROM p")
def a01_presence_archetypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return P.presence(h, "Archetype").join(P.event_lists(h, "Tier", "Archetype"), ["Tier", "Archetype"])


_ALL = PRESENCE + f""", t AS (SELECT sum(n_events) AS n_all FROM n),
    g AS (SELECT Deck, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in P.SUMMED)}, sum(AvgPlace * Appearances) AS pl, min(BestPlace) AS BestPlace,
          array_to_string(list_sort(list_distinct(flatten(list(string_split(EventIDs, ';'))))), ';') AS EventIDs, array_to_string(list_sort(list_distinct(flatten(list(string_split(EventDates, ';'))))), ';') AS EventDates FROM p GROUP BY Deck),
    total AS (SELECT g.* EXCLUDE (pl), n_all, {_R('pl / Appearances', 1)} AS AvgPlace, 'ALL' AS Tier, {_R('Events / n_all * 100.0')} AS PresencePct, {_R('Events / n_all * 100.0')} AS Top32EventFreqPct, {_R('WinnerEventCount / n_all * 100.0')} AS WinnerEventFreqPct,
    {', '.join(f"{_R(f'Top{k}EventCount / n_all * 100.0')} AS Top{k}PresencePct, {_R(f'Top{k}EventCount / n_all * 100.0')} AS Top{k}EventFreqPct" for k in (8, 16))},
    {', '.join(f"{_R(f'{c}Count / Appearances * 100.0')} AS {c}Rate, {_R(f'{c}Count / Appearances * 100.0')} AS {c}ShareOfTop32EntriesPct" for c in ('Top16', 'Top8', 'Winner'))} FROM g, t)
"""


@query(_ALL + "SELECT * REPLACE (CAST(n_all AS BIGINT) AS n_all) FROM total")
def a02_all_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ALL table with its lists of events, which are spelled out from bitmaps at the end. The history is read once."""
    rows = P.entries(history(spark, sf_dir)).persist()
    numbers = B.event_numbers(rows)
    bits = B.event_bitmaps(rows, numbers).where(F.col("Tier") == B.ALL)
    return P.all_tiers(P.presence_of(rows)).join(B.lists(bits, numbers, "Deck"), "Deck")


@query(PRESENCE + """, a AS (SELECT Deck, count(DISTINCT EventID) AS n, count(DISTINCT EventID) FILTER (year(EventDate) % 2 = 0) AS even FROM h GROUP BY Deck)
    SELECT Tier, Deck, Events, CAST(NULL AS BIGINT) AS EvenYears FROM p UNION ALL SELECT 'ALL', Deck, n, even FROM a""")
def a01_a02_event_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each deck by tier and over all, counted from bitmaps; those of even years by merging the tiers' bitmaps of these years."""
    rows = cut(P.entries(history(spark, sf_dir)).select("Tier", "Deck", "EventID", "EventDate").distinct())  # whoever entered
    numbers = B.event_numbers(rows)  # is written once by itself
    every = B.counted(B.event_bitmaps(rows, numbers), "Tier", "Deck")
    even = B.event_bitmaps(rows.where(F.year("EventDate") % 2 == 0), numbers).where(F.col("Tier") != B.ALL)
    some = B.counted(B.merged(even, "Deck"), "Deck").select(F.lit(B.ALL).alias("Tier"), "Deck", F.col("Events").alias("EvenYears"))
    return every.join(some, ["Tier", "Deck"], "left").withColumn("EvenYears", F.when(F.col("Tier") == B.ALL, F.coalesce("EvenYears", F.lit(0))))


@query(H + f""", k AS (SELECT K, arg_max(Pilot, (EventDate, -(CAST(EventID AS BIGINT) * 100 + Place))) AS Pilot, min(LoginID) AS LoginID, count(*) FILTER (Place = 1) AS Wins, count(*) FILTER (Place <= 8) AS Top8, count(*) AS Top32,
        {_R('avg(Place)', 1)} AS AvgPlace, min(Place) AS BestPlace, count(DISTINCT Deck) AS DecksPlayed, coalesce(array_to_string(list_sort(list(DISTINCT Deck) FILTER (Place = 1)), ';'), '') AS WinningDecks FROM h GROUP BY K)
    SELECT * EXCLUDE (K), row_number() OVER (ORDER BY Wins DESC, Top8 DESC, Top32 DESC, K) AS Rank FROM k""")
def a03_w02_pilot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pilot_table(history(spark, sf_dir), F.col("row_id"))


_TOTALS = f""", r AS (SELECT *, CAST(CASE WHEN EventClass = 'Premier' THEN 2 ELSE 1 END * CASE WHEN Place = 1 THEN 5 WHEN Place = 2 THEN 4 WHEN Place <= 4 THEN 3 WHEN Place <= 8 THEN 2 WHEN Place <= 16 THEN 1 ELSE 0 END AS INT) AS LeaguePoints FROM h),
    """
_RANKED = """SELECT *, row_number() OVER (ORDER BY Points DESC, Wins DESC, Top2 DESC, Top4 DESC, Top8 DESC, Top16 DESC, Starts DESC, fin, Pilot, LoginID) AS Rank FROM (
        SELECT K, min(Pilot) AS Pilot, min(LoginID) AS LoginID, CAST(sum(LeaguePoints) AS BIGINT) AS Points, CAST(coalesce(sum(LeaguePoints) FILTER (EventClass = 'Premier'), 0) AS BIGINT) AS PremierPoints,
               count(*) FILTER (Place <= 1) AS Wins, count(*) FILTER (Place <= 2) AS Top2, count(*) FILTER (Place <= 4) AS Top4, count(*) FILTER (Place <= 8) AS Top8, count(*) FILTER (Place <= 16) AS Top16,
               count(DISTINCT EventID) AS Starts, avg(Place) AS fin FROM r WHERE EventDate <= DATE '{day}' GROUP BY K)"""
_SEASON = H + _TOTALS + f"now AS ({_RANKED.format(day='2000-01-31')}), prev AS (SELECT K, Rank AS PrevRank FROM ({_RANKED.format(day='2000-01-24')}))"


@query(_SEASON + """ SELECT now.* EXCLUDE (fin, K), now.K AS _key, PrevRank, PrevRank - Rank AS RankChange, CASE WHEN PrevRank IS NULL THEN 'new' WHEN PrevRank > Rank THEN 'up' WHEN PrevRank < Rank THEN 'down' ELSE 'same' END AS Movement FROM now LEFT JOIN prev USING (K)""")
def a04_w01_j16_season_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.season_table(L.with_points(history(spark, sf_dir)), F.col("row_id"), F.lit("2000-01-31").cast("date"))


@query(H + f""", d AS (SELECT EventDate, row_number() OVER (ORDER BY EventDate) > greatest(1, (SELECT count(DISTINCT EventDate) FROM h) // 2) AS new FROM (SELECT DISTINCT EventDate FROM h)),
    z AS (SELECT count(*) FILTER (new) AS a, count(*) FILTER (NOT new) AS b FROM d),
    k AS (SELECT Deck, count(DISTINCT EventDate) FILTER (new) / any_value(a) * 100.0 - count(DISTINCT EventDate) FILTER (NOT new) / any_value(b) * 100.0 AS x,
          count(DISTINCT EventDate) FILTER (new AND Place <= 8) / any_value(a) * 100.0 - count(DISTINCT EventDate) FILTER (NOT new AND Place <= 8) / any_value(b) * 100.0 AS y FROM h JOIN d USING (EventDate), z GROUP BY Deck)
    SELECT Deck, {_R('x')} AS DeltaTop32, {_R('y')} AS DeltaTop8, CASE WHEN 0.7 * x + 0.3 * y >= 10 THEN 'Rising' WHEN 0.7 * x + 0.3 * y <= -10 THEN 'Falling' ELSE 'Stable' END AS Trend FROM k""")
def a10_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.trend(history(spark, sf_dir))


@query(PRESENCE + f""", d AS (SELECT EventDate, row_number() OVER (ORDER BY EventDate) > greatest(1, (SELECT count(DISTINCT EventDate) FROM h) // 2) AS new FROM (SELECT DISTINCT EventDate FROM h)),
    z AS (SELECT count(*) FILTER (new) AS a, count(*) FILTER (NOT new) AS b FROM d),
    k AS (SELECT Deck, count(DISTINCT EventDate) FILTER (new) / any_value(a) * 100.0 - count(DISTINCT EventDate) FILTER (NOT new) / any_value(b) * 100.0 AS x FROM h JOIN d USING (EventDate), z GROUP BY Deck)
    SELECT Tier, Deck, Events, {_R('x')} AS DeltaTop32 FROM p LEFT JOIN k USING (Deck)""")
def j09_presence_with_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return P.presence(h).select("Tier", "Deck", "Events").join(P.trend(h).select("Deck", "DeltaTop32"), "Deck", "left")


@query(H + """, m AS (SELECT DISTINCT strftime(EventDate, '%Y-%m') AS Month FROM h), t AS (SELECT DISTINCT Tier FROM h),
    c AS (SELECT strftime(EventDate, '%Y-%m') AS Month, Tier, count(DISTINCT EventID) AS n FROM h WHERE NOT (Tier = '1-URGENT' AND EventDate BETWEEN DATE '1996-02-01' AND DATE '1996-03-31') GROUP BY ALL),
    g AS (SELECT Month, Tier, coalesce(n, 0) AS Events FROM m CROSS JOIN t LEFT JOIN c USING (Month, Tier))
    SELECT *, coalesce(lag(Events) OVER (PARTITION BY Tier ORDER BY Month), 0) > 0 AND Events = 0 AS Gap FROM g""")
def a12_w07_tier_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    hole = (F.col("Tier") == "1-URGENT") & F.col("EventDate").between("1996-02-01", "1996-03-31")
    return L.tier_coverage(h.where(~hole))


@query(H + """SELECT strftime(EventDate, '%Y-%m') AS Month, count(DISTINCT EventID) FILTER (Tier = '1-URGENT') AS "1-URGENT", count(DISTINCT EventID) FILTER (Tier = '2-HIGH') AS "2-HIGH" FROM h GROUP BY 1""")
def a12_tier_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.tier_pivot(history(spark, sf_dir), ["1-URGENT", "2-HIGH"])


@query(H + """SELECT Tier, count(*) AS n_rows, count(DISTINCT EventID) AS n_events FROM h GROUP BY Tier""")
def a13_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).groupBy("Tier").agg(F.count("*").alias("n_rows"), F.countDistinct("EventID").alias("n_events"))


@query(H + """, s AS (SELECT EventDate, Tier, 'slug-' || CAST(EventID AS BIGINT) % 50 AS slug, substr(sha1(array_to_string(list_sort(list(lower(Pilot) || '::' || lower(Deck))), '|')), 1, 12) AS sig FROM h WHERE Format = 'O' GROUP BY ALL)
    SELECT EventDate, Tier, count(*) AS SlugCount, string_agg(slug, ', ' ORDER BY slug) AS EventSlugs, count(DISTINCT sig) = 1 AS ContentHashesMatch, string_agg(sig, ', ' ORDER BY slug) AS Signatures FROM s GROUP BY ALL HAVING count(*) > 1""", dates="EventDate")
def a14_f25_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.concat(F.lit("slug-"), (F.col("EventID").cast("long") % 50).cast("string"), F.lit(" "))
    return N.collisions(history(spark, sf_dir).withColumn("EventSlug", slug), " o")


@query(H + """, s AS (SELECT EventDate, Tier, EventSlug, substr(sha1(array_to_string(list_sort(list(lower(Pilot) || '::' || lower(Deck))), '|')), 1, 12) AS sig FROM h GROUP BY ALL),
    n AS (SELECT *, row_number() OVER w AS i, first_value(sig) OVER w AS s1, first_value(EventSlug) OVER w AS slug FROM s WINDOW w AS (PARTITION BY EventDate, Tier ORDER BY EventSlug))
    SELECT EventDate, Tier, min(slug) AS EventSlug, count(*) FILTER (i > 1 AND sig = s1) AS Duplicates, count(*) FILTER (sig <> s1) AS Collisions FROM n GROUP BY ALL""", dates="EventDate")
def j23_republished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.without_republished(history(spark, sf_dir))


#: Labels that are and aren't unknown, dealt by the event's number.
_SAID = ("", "Unknown", "unkown", " N/A", "na", "NONE", "null", "?", " - ", "unknown deck", "nan", "--", "Control")
_LABEL = "(['" + "', '".join(_SAID) + "'])[CAST(EventID AS BIGINT) % 13 + 1]"


@query(H + """SELECT count(*) FILTER (m < 10) AS unknown, count(*) AS total, count(*) FILTER (m < 10) / count(*) AS share FROM (SELECT CAST(EventID AS BIGINT) % 13 AS m FROM h)""")
def a15_unknown_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.unknown_share(_labelled(history(spark, sf_dir)))


def _labelled(h: DataFrame) -> DataFrame:
    return h.withColumn("Archetype", F.get(F.array(*map(F.lit, _SAID)), (F.col("EventID").cast("long") % 13).cast("int")))


@query(H + f"SELECT EventID, Place, Pilot, Deck, {_LABEL} AS Archetype FROM h WHERE CAST(EventID AS BIGINT) % 13 < 10")
def a15_unknown_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose archetype is unknown."""
    return Q.unknown_rows(_labelled(history(spark, sf_dir))).select("EventID", "Place", "Pilot", "Deck", "Archetype")


@query(H + """SELECT a.EventID, a.EventDate, a.Tier, a.Deck AS FirstDeck, a.Pilot AS FirstPilot, b.Deck AS SecondDeck, b.Pilot AS SecondPilot FROM h a JOIN h b ON a.EventID = b.EventID AND a.Place = 1 AND b.Place = 2""", dates="EventDate")
def a16_finalists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.finalists(history(spark, sf_dir))


@query(H + _TOTALS + """d AS (SELECT K AS _key, count(DISTINCT Deck) AS n_decks, count(*) AS n_results, CAST(sum(LeaguePoints) AS BIGINT) AS points FROM r GROUP BY K) SELECT * FROM d""")
def a17_pilot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = L.pilot_documents(L.with_points(history(spark, sf_dir)))
    doc = F.from_json("document", "distinctDecks BIGINT, results ARRAY<STRUCT<points: INT>>")
    return docs.withColumn("d", doc).select("_key", F.col("d.distinctDecks").alias("n_decks"), F.size("d.results").cast("long").alias("n_results"), F.aggregate("d.results", F.lit(0).cast("long"), lambda s, r: s + r["points"]).alias("points"))


@query(H + """, v AS (SELECT K, Pilot || CASE WHEN year(EventDate) % 2 = 0 THEN ' x' ELSE '' END AS P, EventDate, CAST(EventID AS BIGINT) * 100 + Place AS row_id, LoginID FROM h),
    k AS (SELECT CASE WHEN LoginID = '' THEN 'name:' || lower(P) ELSE K END AS K, P, min((EventDate, row_id)) AS f FROM v GROUP BY ALL)
    SELECT K AS _key, string_agg(P, ' > ' ORDER BY f) AS Names, count(*) AS n_names, arg_max(P, f) AS Current FROM k GROUP BY K""")
def a18_name_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    name = F.concat("Pilot", F.when(F.year("EventDate") % 2 == 0, " x").otherwise(""))
    return L.name_history(h.withColumn("Pilot", name), F.col("row_id"))


@query(H + """SELECT count(DISTINCT K) FILTER (LoginID <> '') AS by_login, count(DISTINCT K) FILTER (LoginID = '') AS by_name, min(EventDate) AS first_date, min(EventDate) > DATE '1994-12-01' AS partial FROM h""", dates="first_date")
def a19_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return L.identity_coverage(h).crossJoin(L.partial_season(h, F.lit("1994-12-01").cast("date")))  # a row each


@query("""WITH p AS (SELECT event_type AS endpoint, ts, event_id % 7 <> 0 AS ok FROM events), l AS (SELECT endpoint, max(ts) FILTER (ok) AS t FROM p GROUP BY 1)
    SELECT endpoint, 100.0 * count(*) FILTER (ok) / count(*) AS uptime_pct, count(*) FILTER (NOT ok AND (t IS NULL OR ts > t)) AS failing FROM p JOIN l USING (endpoint) GROUP BY 1""")
def a21_k12_uptime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.uptime(read(spark, sf_dir, "events").select(F.col("event_type").alias("endpoint"), "ts", (F.col("event_id") % 7 != 0).alias("ok")))


_W = H + """, w AS (SELECT EventID, EventDate, 'F' AS Round, Pilot AS WP, LoginID AS WL, Deck AS WD FROM h WHERE Place = 1), l AS (SELECT EventID, Pilot AS LP, LoginID AS LL, Deck AS LD FROM h WHERE Place = 2), x AS (SELECT * FROM w JOIN l USING (EventID))
"""


@query(_W + """SELECT EventID, EventDate, Round, WP AS Pilot, WL AS LoginID, WD AS Deck, LP AS Opponent, LD AS OpponentDeck, 'W' AS Result FROM x UNION ALL SELECT EventID, EventDate, Round, LP, LL, LD, WP, WD, 'L' FROM x""", dates="EventDate")
def j21_s23_both_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.both_sides(matches(spark, sf_dir))


@query(_W + """, b AS (SELECT WD AS Deck, LD AS OpponentDeck, 1 AS w FROM x UNION ALL SELECT LD, WD, 0 FROM x)
    SELECT Deck, OpponentDeck, count(*) FILTER (w = 1) AS Wins, count(*) FILTER (w = 0) AS Losses, count(*) AS Games FROM b WHERE Deck <> OpponentDeck GROUP BY ALL""")
def j22_matchup_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.matchup_matrix(matches(spark, sf_dir))


@query(H + """SELECT EventID, Place, Pilot AS OldPilot, Pilot || ' jr' AS NewPilot, LoginID AS NewLoginID FROM h WHERE CAST(EventID AS BIGINT) % 9 = 0""")
def j17_name_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    fresh = h.withColumn("Pilot", F.when(F.col("EventID").cast("long") % 9 == 0, F.concat("Pilot", F.lit(" jr"))).otherwise(F.upper("Pilot")))
    return L.name_drift(h, fresh)


@query(H + """, e AS (SELECT EventID, EventDate, Tier, count(*) AS n_decklists, max(Deck) FILTER (Place = 1) AS winner_deck, max(Pilot) FILTER (Place = 1) AS winner_pilot,
    string_agg(Place || ':' || Deck || ' (' || Pilot || ')', '; ' ORDER BY Place) FILTER (Place <= 8) AS top8_decks FROM h GROUP BY ALL) SELECT * FROM e""", dates="EventDate")
def a13_f29_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.manifest(history(spark, sf_dir))


@query(H + """SELECT string_agg(EventDate || ' ' || Tier || ' (' || EventID || ')', '; ' ORDER BY EventDate, EventDate || ' ' || Tier || ' (' || EventID || ')') AS note FROM (SELECT DISTINCT EventDate, Tier, EventID FROM h WHERE EventClass = 'Premier' AND EventDate >= DATE '2001-06-01')
    UNION ALL SELECT 'No Modern premier events in window 1901-01-01..1901-01-31 (registry checked)' FROM h WHERE EventDate <= DATE '1901-01-31' HAVING count(*) = 0""")
def f39_premier_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notes of two windows, one of which has no event."""
    h = history(spark, sf_dir).where("EventClass = 'Premier'").select(F.col("EventDate").alias("date"), F.col("Tier").alias("event_type"), F.col("EventID").alias("event_id")).distinct()
    late = publishing.premier_note(h.where("date >= DATE '2001-06-01'"), "Modern", "2001-06-01", "2001-12-31")
    return late.unionByName(publishing.premier_note(h.where("date <= DATE '1901-01-31'"), "Modern", "1901-01-01", "1901-01-31"))


@query(H + """SELECT EventID, Place, Deck FROM h WHERE EventDate IN (SELECT DISTINCT EventDate FROM h ORDER BY 1 DESC LIMIT 8)""")
def p02_last_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.last_dates(history(spark, sf_dir), 8).select("EventID", "Place", "Deck")


@query(H + """SELECT EventID, Place, Deck, 'C' || left(Tier, 1) AS TierLabel FROM h WHERE EventDate BETWEEN DATE '1998-02-01' AND DATE '1998-02-28' AND lower(Format) = 'f' AND EventClass <> 'Premier'""")
def p01_p03_p08_p10_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    premier = h.where("EventClass = 'Premier'").select("EventID").distinct()
    rows = P.in_window(h, "1998-02-01", "1998-02-28").where(T.normalize_name("Format") == "f").join(premier, "EventID", "left_anti")
    return rows.select("EventID", "Place", "Deck", F.concat(F.lit("C"), F.left("Tier", F.lit(1))).alias("TierLabel"))


@query(H + """SELECT EventID, Place, CASE WHEN Place = 1 THEN 'Unknown' ELSE Deck END AS Deck, CASE WHEN Archetype = 'LARGE' THEN 'Unknown' ELSE Archetype END AS Archetype FROM h""")
def p09_relabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    rows = h.withColumns({"Deck": F.when(F.col("Place") == 1, "NEEDS_MANUAL_REVIEW").otherwise(F.col("Deck")), "Archetype": F.when(F.col("Archetype") == "LARGE", " ").otherwise(F.col("Archetype"))})
    return P.relabelled(rows).select("EventID", "Place", "Deck", "Archetype")


@query(H + """, k AS (SELECT Deck FROM h GROUP BY Deck ORDER BY count(*) DESC, Deck LIMIT 10), d AS (SELECT DISTINCT EventDate FROM h), x AS (SELECT DISTINCT EventDate, Deck FROM h)
    SELECT EventDate, Deck, CASE WHEN (EventDate, Deck) IN (SELECT (EventDate, Deck) FROM x) THEN 100 ELSE 0 END AS Present FROM d, k""", dates="EventDate")
def c07_presence_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.presence_matrix(history(spark, sf_dir))


@query(_ALL + "SELECT Deck, Top32EntryCount, Top8Rate, WinnerRate FROM total ORDER BY Top32EntryCount DESC, Deck LIMIT 20")
def c06_w08_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderworks.operators.metagame import conversion

    return conversion(P.all_tiers(P.presence(history(spark, sf_dir))))


_NONE = "SELECT CAST(NULL AS VARCHAR) AS check_id, CAST(NULL AS VARCHAR) AS severity, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS detail WHERE false"


@query(H + """SELECT 'rows' AS check_id, 'hard' AS severity, EventID AS key, CAST(count(*) AS VARCHAR) AS detail FROM h GROUP BY EventID HAVING count(*) <> 4""")
def q01_event_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.event_checks(history(spark, sf_dir), 4)


@query(H + "SELECT 'no_premier' AS check_id, 'hard' AS severity, EventID AS key, 'premier event' AS detail FROM (SELECT DISTINCT EventID FROM h WHERE EventClass = 'Premier')")
def q01_no_premier(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return Q.no_premier(h, h.where("EventClass = 'Premier'").select("EventID").distinct())


@query(_NONE)
def q01_q03_presence_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = P.presence(history(spark, sf_dir))
    return Q.union(Q.presence_checks(tables), Q.all_tier_checks(P.all_tiers(tables), tables))


@query("SELECT 'degenerate' AS check_id, 'hard' AS severity, 'Format' AS key, '1.0' AS detail")
def q02_degenerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir).withColumn("Format", F.lit(1))
    return Q.degenerate(rows, ("Place", "Format", "Games"))


@query(H + _TOTALS + """e AS (SELECT EventID, sum(LeaguePoints) AS p, any_value(EventClass) AS c FROM r GROUP BY EventID) SELECT 'event_points' AS check_id, 'hard' AS severity, EventID AS key, CAST(CAST(p AS BIGINT) AS VARCHAR) AS detail FROM e WHERE p <> CASE WHEN c = 'Premier' THEN 62 ELSE 31 END""")
def q04_league_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = L.with_points(history(spark, sf_dir))
    return Q.league_checks(r, L.season_totals(r, F.col("row_id")))


@query(H + """, n AS (SELECT count(DISTINCT EventID) AS a, count(DISTINCT EventID) FILTER (EventDate < DATE '2001-01-01') AS b FROM h) SELECT a AS registry_count, b AS fetched_count, a = b AND a > 0 AS complete FROM n""")
def q05_q08_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return Q.completeness(h.select("EventID").withColumn("kind", F.lit("challenge")), h.where("EventDate < DATE '2001-01-01'"))


@query(H + """SELECT 'swiss_score' AS check_id, 'warn' AS severity, EventID || ':' || Place AS key, CAST(s AS VARCHAR) AS detail FROM (SELECT EventID, Place, CAST(Games AS INT) AS s FROM h) WHERE s > 15 OR s = 14""")
def q06_standings_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.standings_checks(history(spark, sf_dir).select("EventID", F.col("Place").alias("rank"), F.col("Games").cast("int").alias("score"), F.lit(5).alias("rounds")))


@query(_W + "SELECT 'bracket_shape' AS check_id, 'hard' AS severity, EventID AS key, '0/0/1' AS detail FROM x")
def q07_bracket_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.bracket_checks(matches(spark, sf_dir), history(spark, sf_dir).dropDuplicates(["EventID", "Place"]))


_EIGHT = H + """, p AS (SELECT EventID, Place, CAST(EventID AS BIGINT) % 8 AS m FROM h WHERE Place <= 8 AND EventID IN (SELECT EventID FROM h GROUP BY EventID HAVING count(*) >= 8)), e AS (SELECT DISTINCT EventID, m FROM p)
    SELECT CASE m WHEN 1 THEN 'bracket_semifinal' WHEN 2 THEN 'bracket_games' WHEN 3 THEN 'bracket_seeds' WHEN 4 THEN 'bracket_shape' WHEN 5 THEN 'bracket_final' WHEN 6 THEN 'bracket_top8' WHEN 7 THEN 'bracket_score' END AS check_id,
           CASE WHEN m IN (3, 7) THEN 'warn' ELSE 'hard' END AS severity, EventID AS key,
           CASE m WHEN 1 THEN '1/2' WHEN 2 THEN '1' WHEN 3 THEN '1v7 2v8 3v6 4v5' WHEN 4 THEN '3/2/1' WHEN 5 THEN '1/3' WHEN 6 THEN '7/8' WHEN 7 THEN '1' END AS detail FROM e WHERE m > 0
"""


@query(_EIGHT)
def q07_bracket_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brackets of events with eight entries or more, seven of eight with one fault each."""
    h = history(spark, sf_dir)
    full = h.withColumn("_n", F.max("Place").over(Window.partitionBy("EventID"))).where("_n >= 8 AND Place <= 8").withColumn("Pilot", F.concat("Pilot", F.lit("-"), "Place")).withColumn("LoginID", F.lit(""))
    m, n = F.col("EventID").cast("long") % 8, F.col("n")
    pairs = (("QF", 1, 8), ("QF", 4, 5), ("QF", 2, 7), ("QF", 3, 6), ("SF", 1, 4), ("SF", 2, 3), ("F", 1, 2))
    each = full.groupBy("EventID").agg(F.map_from_entries(F.collect_list(F.struct(F.col("Place").cast("int"), "Pilot"))).alias("who")).select("EventID", "who", F.posexplode(F.array(*(F.struct(F.lit(r).alias("Round"), F.lit(a).alias("a"), F.lit(b).alias("b")) for r, a, b in pairs))).alias("n", "x")).select("EventID", "who", "n", "x.*")
    loser = F.when((m == 1) & (n == 4), 5).when((m == 5) & (n == 6), 3).otherwise(F.col("b"))
    seed = lambda c: F.when((m == 3) & (c >= 7), 15 - c).otherwise(c)
    rows = each.where(~((m == 4) & (n == 0))).select(
        "EventID", "Round", F.col("who")[F.col("a")].alias("WinnerPilot"), F.lit("").alias("WinnerLoginID"), F.when((m == 6) & (n == 0), "nobody").otherwise(F.col("who")[loser]).alias("LoserPilot"), F.lit("").alias("LoserLoginID"),
        F.when((m == 2) & (n == 6), 1).when((m == 7) & (n == 6), 3).otherwise(2).alias("WinnerGames"), F.when((m == 2) & (n == 6), "x").otherwise("1").alias("LoserGames"), seed(F.col("a")).alias("WinnerSwissRank"), seed(F.col("b")).alias("LoserSwissRank"),
    )
    return Q.bracket_checks(rows, full)


@query(H + """, bad AS (SELECT EventID FROM h GROUP BY EventID HAVING count(*) <> 4) SELECT EventID, Place, CASE WHEN EventID NOT IN (SELECT EventID FROM bad) THEN LoginID END AS LoginID FROM h""")
def q10_isolated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return Q.isolate(h, Q.event_checks(h, 4), ("LoginID",)).select("EventID", "Place", "LoginID")
