"""Queries of market shares, rules, likeness and charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderworks.functions import scoring as S
from ladderworks.functions import text as T
from ladderworks.operators import metagame as M
from ladderworks.operators import presence as P
from ladderworks.operators import rules as R
from ladderworks.operators import similarity as N
from ladderworks.plans.event_queries import _R
from ladderworks.plans.standins import H, history, query, read, shares
from ladderworks.plans.standins import M as SHARES

#: A rule table with all three kinds, ties and an exact rule of low priority.
_ALIASES = [("small ring", "Ring", "exact", 50), ("widget", "Widgets", "contains", 100), ("^old ", "Antiques", "regex", 100), ("bolt", "Bolts", "contains", 10), ("hot gear", "Hot", "exact", 200), ("gear$", "Gears", "regex", 100)]
_RULE_SQL = "CASE WHEN n LIKE '%bolt%' THEN 'Bolts' WHEN n = 'small ring' THEN 'Ring' WHEN n LIKE '%widget%' THEN 'Widgets' WHEN regexp_matches(x, '(?i)^old ') THEN 'Antiques' WHEN regexp_matches(x, '(?i)gear$') THEN 'Gears' ELSE {rest} END"


def _rules(spark: SparkSession) -> DataFrame:
    rows = [(p, t, m, k, i) for i, (p, t, m, k) in enumerate(_ALIASES)]
    return R.load_rules(spark.createDataFrame(rows, "pattern string, t string, match_type string, priority int, ordinal long"), "t")


@query(f"SELECT p_partkey, {_RULE_SQL.format(rest='x')} AS Canonical FROM (SELECT p_partkey, p_name AS x, lower(p_name) AS n FROM part)")
def j03_s04_canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit(" Generic  "), F.col("p_name")).alias("Deck"))
    return R.canonical_names(rows, _rules(spark)).select("p_partkey", "Canonical")


@query(f"SELECT p_partkey, {_RULE_SQL.format(rest=chr(39) + 'Unknown' + chr(39))} AS Archetype FROM (SELECT p_partkey, p_name AS x, lower(p_name) AS n FROM part)")
def j04_archetypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.archetypes(read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("Deck")), _rules(spark)).select("p_partkey", "Archetype")


_MAPPED = """, u AS (SELECT lower(p_name) AS k, arg_max(p_brand, p_partkey) AS canonical_name, arg_max(p_type, p_partkey) AS archetype FROM part WHERE p_partkey % 2 = 0 AND p_name LIKE 'o%' GROUP BY 1)"""


@query(H + _MAPPED + " SELECT EventID, Place, u.canonical_name AS mapped_name, u.archetype AS mapped_archetype FROM h LEFT JOIN u ON lower(RawDeck) = u.k")
def j01_s05_saved_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "part").where("p_partkey % 2 = 0 AND p_name LIKE 'o%'").select(F.upper("p_name").alias("raw_name"), F.col("p_brand").alias("canonical_name"), F.col("p_type").alias("archetype"), F.col("p_partkey").alias("ordinal"))
    return R.with_mapping(history(spark, sf_dir), R.load_mappings(table), "RawDeck").select("EventID", "Place", "mapped_name", "mapped_archetype")


@query("""WITH u AS (SELECT p_name AS raw_name, p_brand AS canonical_name, p_partkey AS ordinal FROM part WHERE p_partkey < 20),
    e AS (SELECT p_name AS raw_name, p_brand AS canonical_name, p_partkey AS ordinal, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) AS i FROM part WHERE p_partkey >= 20 AND p_name NOT IN (SELECT raw_name FROM u))
    SELECT * FROM u UNION ALL SELECT raw_name, canonical_name, ordinal FROM e WHERE i = 1""")
def j02_merged_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select(F.col("p_name").alias("raw_name"), F.col("p_brand").alias("canonical_name"), F.col("p_partkey").alias("ordinal"))
    return R.merged_mappings(rows.where("ordinal < 20"), rows.where("ordinal >= 20"))


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan of matchups: a row per brand with its results against part types."""
    rows = history(spark, sf_dir).groupBy("Deck", "Archetype").agg((F.count_if(F.col("Flag") == "R") / F.count("*")).alias("winrate"), F.count("*").alias("games"))
    m = F.sort_array(F.collect_list(F.struct(F.col("Archetype").alias("opponent"), "winrate", "games"))).alias("matchups")
    return rows.groupBy("Deck").agg(m).select(F.regexp_extract("Deck", "([0-9]+)", 1).cast("int").alias("ordinal"), F.col("Deck").alias("name"), "matchups")


@query(H + "SELECT Archetype AS opponent, count(*) FILTER (Flag = 'R') / count(*) AS winrate, count(*) AS games FROM h WHERE Deck = 'Brand#2' GROUP BY 1")
def j05_my_matchups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.my_matchups(_scan(spark, sf_dir), "brand#2")


@query(H + f""", r AS (SELECT Archetype, EventClass, count(*) FILTER (Flag = 'R') / count(*) AS w, count(*) AS g FROM h WHERE Deck = 'Brand#2' GROUP BY ALL) SELECT lower(Archetype) AS opponent, {_R('sum(w * g) / sum(g)', 4)} AS winrate, CAST(sum(g) AS BIGINT) AS games FROM r GROUP BY 1""")
def a09_collapsed_matchups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir).where("Deck = 'Brand#2'").groupBy(F.col("Archetype").alias("opponent"), "EventClass").agg((F.count_if(F.col("Flag") == "R") / F.count("*")).alias("winrate"), F.count("*").alias("games"))
    return M.collapse_matchups(rows)


_OWN = """, e AS (SELECT Deck, SourceName, Meta, Winrate, Games, Archetype, n, CASE WHEN n % 3 = 0 THEN 'primary' WHEN n % 3 = 1 THEN 'fallback' ELSE 'none' END AS src FROM (
        SELECT Deck, RawDeck AS SourceName, CAST(count(*) AS DOUBLE) AS Meta, count(*) FILTER (Flag = 'R') / count(*) AS Winrate, CAST(sum(Games) AS BIGINT) AS Games, min(Archetype) AS Archetype, count(*) AS n FROM h GROUP BY ALL))"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw entries of the roll-up: a row per brand and part name."""
    rows = history(spark, sf_dir).groupBy("Deck", F.col("RawDeck").alias("SourceName")).agg(F.count("*").alias("n"), F.count_if(F.col("Flag") == "R").alias("w"), F.sum("Games").cast("long").alias("Games"), F.min("Archetype").alias("Archetype"))
    source = F.when(F.col("n") % 3 == 0, "primary").when(F.col("n") % 3 == 1, "fallback").otherwise("none")
    return rows.select("Deck", "SourceName", F.col("n").cast("double").alias("Meta"), (F.col("w") / F.col("n")).alias("Winrate"), "Games", "Archetype", source.alias("MySource"), F.when(source != "none", F.col("w") / F.col("n")).alias("MyWinrate"), F.when(source != "none", F.col("n")).otherwise(0).alias("MyGames"), "n")


@query(H + _OWN + f""", v AS (SELECT Deck, Archetype, row_number() OVER (PARTITION BY Deck ORDER BY count(*) DESC, Archetype) AS i FROM e GROUP BY Deck, Archetype),
    g AS (SELECT Deck, array_to_string(list_sort(list(DISTINCT SourceName)), ' | ') AS "Source Deck Names", {_R('sum(Meta)')} AS Meta, {_R('sum(Winrate * Games) / sum(Games)')} AS Winrate, CAST(sum(Games) AS BIGINT) AS "Winrate Game Count",
        CASE WHEN bool_or(src = 'primary') THEN 'primary' WHEN bool_or(src = 'fallback') THEN 'fallback' ELSE 'none' END AS s, avg(Winrate) FILTER (src = 'primary') AS wp, avg(Winrate) FILTER (src = 'fallback') AS wf, max(n) FILTER (src = 'primary') AS gp, max(n) FILTER (src = 'fallback') AS gf FROM e GROUP BY Deck)
    SELECT g.* EXCLUDE (s, wp, wf, gp, gf), {_R("CASE s WHEN 'primary' THEN wp WHEN 'fallback' THEN wf ELSE 0.5 END")} AS "My Deck Winrate", CASE s WHEN 'primary' THEN gp WHEN 'fallback' THEN gf ELSE 0 END AS "My Deck Winrate Game Count",
        s = 'fallback' AS "My Deck Winrate Fallback180", s = 'none' AS "My Deck Winrate Imputed", Archetype FROM g JOIN v USING (Deck) WHERE i = 1""")
def a05_j06_raw_roll_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.roll_up_raw(_entries(spark, sf_dir))


@query(H + _OWN + f"""SELECT Deck, {_R('sum(Meta)')} AS Meta, {_R('sum(Meta * Winrate) / sum(Meta)')} AS Winrate, CAST(sum(Games) AS BIGINT) AS Games, arg_min(Archetype, SourceName) AS Archetype,
    {_R("sum(Meta * Winrate) FILTER (src <> 'none') / sum(Meta) FILTER (src <> 'none')")} AS MyWinrate, CAST(coalesce(sum(n) FILTER (src <> 'none'), 0) AS BIGINT) AS MyGames, bool_or(src = 'none') AS Imputed, CASE WHEN {_R('sum(Meta)')} < 240 THEN 'Rogue' ELSE 'Main' END AS "Meta Tier" FROM e GROUP BY Deck""")
def a06_a07_grouped_decks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.group_decks(_entries(spark, sf_dir).withColumn("ordinal", F.col("SourceName")), 240)


@query(H + SHARES + f"""SELECT Deck, Archetype, Meta, Winrate, Games FROM m WHERE Meta >= 4 UNION ALL SELECT 'Rogue', 'Mixed', {_R('sum(Meta)')}, {_R('sum(Meta * Winrate) / sum(Meta)')}, CAST(sum(Games) AS BIGINT) FROM m WHERE Meta < 4 HAVING count(*) > 0""")
def a07_rogue_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.rogue_bucket(shares(spark, sf_dir).withColumn("Meta Tier", F.when(F.col("Meta") < 4, "Rogue").otherwise("Main")))


@query(H + SHARES + f"""SELECT CASE WHEN Deck LIKE '%1%' THEN 'One' ELSE 'Other' END AS Archetype, {_R('sum(Meta)')} AS Meta, {_R('sum(Meta * Winrate) / sum(Meta)')} AS Winrate, CAST(sum(Games) AS BIGINT) AS Games, {_R('sum(Meta * Winrate) FILTER (Meta < 4) / sum(Meta) FILTER (Meta < 4)')} AS MyWinrate, count(*) AS Decks FROM m GROUP BY 1""")
def a08_archetype_roll_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shares(spark, sf_dir).withColumns({"Archetype": F.when(F.contains("Deck", F.lit("1")), "One").otherwise("Other"), "MyWinrate": F.when(F.col("Meta") < 4, F.col("Winrate"))})
    return M.roll_up_archetypes(rows)


_SIDE = "SELECT lower(RawDeck) AS o, {r} AS w, CAST(sum(Games) AS BIGINT) AS g FROM h WHERE {where} GROUP BY 1"


@query(H + f""", p AS ({_SIDE.format(r=_R("sum(CASE WHEN Flag = 'R' THEN Games ELSE 0 END) / sum(Games)", 4), where="Place = 1 AND RawDeck LIKE '%o%'")}), f AS ({_SIDE.format(r=_R("sum(CASE WHEN Flag = 'R' THEN Games ELSE 0 END) / sum(Games)", 4), where="Place = 2 AND RawDeck NOT LIKE '%w%'")}), d AS (SELECT DISTINCT RawDeck FROM h)
    SELECT RawDeck AS Deck, coalesce(p.w, f.w) AS MyWinrate, CASE WHEN p.w IS NOT NULL THEN p.g WHEN f.w IS NOT NULL THEN f.g ELSE 0 END AS MyGames, CASE WHEN p.w IS NOT NULL THEN 'primary' WHEN f.w IS NOT NULL THEN 'fallback' ELSE 'none' END AS MySource FROM d LEFT JOIN p ON p.o = lower(RawDeck) LEFT JOIN f ON f.o = lower(RawDeck)""")
def j06_my_winrates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rates against each deck from the primary window, else the fallback, else none."""
    h = history(spark, sf_dir)
    side = lambda where: M.collapse_matchups(h.where(where).select(F.upper("RawDeck").alias("opponent"), F.when(F.col("Flag") == "R", 1.0).otherwise(0.0).alias("winrate"), F.col("Games").cast("long").alias("games")))
    decks = h.select(F.col("RawDeck").alias("Deck")).distinct()
    return M.with_my_winrate(decks, side("Place = 1 AND RawDeck LIKE '%o%'"), side("Place = 2 AND RawDeck NOT LIKE '%w%'"))


@query(H + f""", m AS (SELECT CASE WHEN contains(RawDeck, 'bolt') THEN 'Bolts' WHEN RawDeck = 'small ring' THEN 'Ring' WHEN contains(RawDeck, 'widget') THEN 'Widgets' WHEN RawDeck LIKE 'old %' THEN 'Antiques' WHEN RawDeck LIKE '%gear' THEN 'Gears' ELSE 'Unknown' END AS A, count(*) * 0.125e0 AS s FROM h GROUP BY RawDeck),
    g AS (SELECT A, {_R('sum(s)')} AS MetaPct FROM m GROUP BY A)
    SELECT DISTINCT a.A AS Archetype, coalesce(MetaPct, 0) AS MetaPct FROM (SELECT unnest(['Bolts', 'Ring', 'Widgets', 'Antiques', 'Gears', 'Unknown', 'Elsewhere']) AS A) a LEFT JOIN g USING (A)""")
def j08_share_by_ruled_archetype(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market share of archetypes by the rules for the decks' names; the share's own archetype doesn't count."""
    meta = history(spark, sf_dir).groupBy(F.concat(F.lit(" "), "RawDeck").alias("Deck")).agg((F.count("*") * 0.125).alias("Meta"), F.min("Archetype").alias("Archetype"))
    known = spark.createDataFrame([(a,) for a in ("Bolts", "Ring", "Widgets", "Antiques", "Gears", "Unknown", "Elsewhere")], "Archetype string")
    return M.with_meta_share(known, meta, "Archetype", _rules(spark))


_ENC = "(1 - (1000.0 - c) / 1000 * (999.0 - c) / 999 * (998.0 - c) / 998 * (997.0 - c) / 997 * (996.0 - c) / 996)"
_METRICS = H + SHARES + f""", x AS (SELECT max(Meta) AS top, min(Winrate) AS low, max(Winrate) AS high, median(Meta) AS mm, median(Winrate) AS mw FROM m),
    i AS (SELECT m.*, mm, mw, 0.7 * Meta / top + 0.3 * (Winrate - low) / (high - low) AS imp, CAST(round_even(Meta * 10, 0) AS INT) AS c FROM m, x),
    q AS (SELECT quantile_cont(imp, 0.25) AS q1, quantile_cont(imp, 0.5) AS q2, quantile_cont(imp, 0.75) AS q3 FROM i),
    f AS (SELECT Deck, Meta, Winrate, Games, Archetype, c AS "Encounter Copies", {_R(_ENC, 6)} AS "Encounter Probability", {_R('imp', 6)} AS Importance, CASE WHEN imp <= q1 THEN 'Q1' WHEN imp <= q2 THEN 'Q2' WHEN imp <= q3 THEN 'Q3' ELSE 'Q4' END AS Quartile,
        CASE WHEN Meta < mm AND Winrate > mw THEN 'Underplayed Winner' WHEN Meta > mm AND Winrate < mw THEN 'Popular Trap' ELSE 'Neutral' END AS "Performance Label" FROM i, q)
"""


@query(_METRICS + """SELECT *, CASE Quartile WHEN 'Q4' THEN 'Very High' WHEN 'Q3' THEN 'High' WHEN 'Q2' THEN 'Medium' ELSE 'Low' END AS "Prep Priority" FROM f""")
def a11_f16_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.metrics(shares(spark, sf_dir))


@query(H + SHARES + f"""SELECT 'Field median' AS Deck, {', '.join(f'{_R(f"{c} * pow(w, {k}) * pow(1 - w, {5 - k})", 6)} AS "{k}-{5 - k}"' for k, c in ((5, 1), (4, 5), (3, 10), (2, 10), (1, 5), (0, 1)))} FROM (SELECT median(Winrate) AS w FROM m)
    UNION ALL SELECT Deck, {', '.join(_R(f"{c} * pow(Winrate, {k}) * pow(1 - Winrate, {5 - k})", 6) for k, c in ((5, 1), (4, 5), (3, 10), (2, 10), (1, 5), (0, 1)))} FROM m""")
def a20_record_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.record_table(shares(spark, sf_dir))


_COMPARE = H + SHARES + f""", c AS (SELECT Deck, count(*) AS n FROM h WHERE EventClass = 'Premier' AND Deck <> 'Brand#3' GROUP BY 1), t AS (SELECT sum(n) AS total FROM c),
    z AS (SELECT Deck, coalesce(n, 0) AS "Challenge Count", coalesce({_R('100.0 * n / total')}, 0) AS "Challenge Share", coalesce({_R('Meta')}, 0) AS "Meta Share" FROM c FULL JOIN m USING (Deck), t),
    d AS (SELECT *, {_R('"Challenge Share" - "Meta Share"')} AS "Delta pp" FROM z)
"""


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.compare_share(history(spark, sf_dir).where("EventClass = 'Premier' AND Deck <> 'Brand#3'"), shares(spark, sf_dir))


@query(_COMPARE + "SELECT * FROM d")
def j07_c04_compared_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir)


_STATS = H + SHARES + f""", a AS (SELECT Deck, {_R("100.0 * count(DISTINCT EventID) / (SELECT sum(n) FROM (SELECT count(DISTINCT EventID) AS n FROM h GROUP BY Tier))")} AS Top32EventFreqPct,
        {_R("100.0 * count(DISTINCT EventID) FILTER (Place <= 8) / (SELECT sum(n) FROM (SELECT count(DISTINCT EventID) AS n FROM h GROUP BY Tier))")} AS Top8EventFreqPct FROM h GROUP BY Deck),
    s AS (SELECT a.*, CASE WHEN Deck = 'Brand#4' THEN 0 ELSE coalesce({_R('Meta')}, 0) END AS MetaPct FROM a LEFT JOIN m USING (Deck)), x AS (SELECT *, {_R('Top32EventFreqPct - MetaPct')} AS delta, CAST(round_even(MetaPct * 10, 0) AS INT) AS c FROM s)
"""


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decks over all tiers, with their market share, which one deck lacks."""
    return M.with_meta_share(P.all_tiers(P.presence(history(spark, sf_dir))), shares(spark, sf_dir).where("Deck <> 'Brand#4'"))


@query(_STATS + f"""SELECT Deck, delta AS "Delta pp", CAST(row_number() OVER (ORDER BY delta DESC, Deck) AS INT) AS DeltaRank, (SELECT CASE WHEN count(*) >= 4 THEN {_R('median(delta)', 4)} END FROM x WHERE c > 0 AND {_ENC} >= 0.18) AS MedianDelta FROM x WHERE c > 0 AND {_ENC} >= 0.18""")
def c05_delta_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.delta_ranking(_stats(spark, sf_dir), cutoff=18)


@query(_STATS + f"""SELECT Deck, delta AS "Delta pp", CAST(row_number() OVER (ORDER BY delta DESC, Deck) AS INT) AS DeltaRank, (SELECT {_R('median(delta)', 4)} FROM x) AS MedianDelta FROM x WHERE c > 0 AND {_ENC} >= 0.18""")
def c05_delta_ranking_beside_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.delta_ranking(_stats(spark, sf_dir), cutoff=18, median_of_all=True)


@query(_STATS + f"SELECT Deck, Top32EventFreqPct, Top8EventFreqPct, MetaPct, CAST(row_number() OVER (ORDER BY Top32EventFreqPct DESC, Top8EventFreqPct DESC, MetaPct DESC, Deck) AS INT) AS \"Order\" FROM x WHERE c > 0 AND {_ENC} >= 0.18")
def c04_presence_against_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.presence_against_share(_stats(spark, sf_dir), cutoff=18)


@query(_STATS + f"SELECT Deck, Top32EventFreqPct, Top8EventFreqPct, MetaPct, CAST(row_number() OVER (ORDER BY MetaPct DESC, Top32EventFreqPct DESC, Top8EventFreqPct DESC, Deck) AS INT) AS \"Order\" FROM x WHERE c > 0 AND {_ENC} >= 0.18")
def c04_presence_by_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.presence_against_share(_stats(spark, sf_dir), cutoff=18, by_share=True)


@query(H + SHARES + f"""SELECT Tier, Deck, count(DISTINCT EventID) AS Events, CASE WHEN Deck = 'Brand#4' THEN 0.0 ELSE {_R('any_value(Meta)')} END AS MetaPct FROM h JOIN m USING (Deck) GROUP BY Tier, Deck""")
def j08_presence_with_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_meta_share(P.presence(history(spark, sf_dir)).select("Tier", "Deck", "Events"), shares(spark, sf_dir).where("Deck <> 'Brand#4'"))


@query(H + SHARES + f"""SELECT * FROM (SELECT Deck, Meta, {_R(f'100 * {_ENC}', 4)} AS EncounterPct FROM (SELECT *, CAST(round_even(Meta * 10, 0) AS INT) AS c FROM m)) WHERE EncounterPct >= 18""")
def c01_p04_encounter_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.encounter_chart(shares(spark, sf_dir), 18)


@query(H + SHARES + f"""SELECT Deck, {_R('Winrate * 5', 4)} AS ExpectedWins, Games, CASE WHEN Games >= 150 THEN 'Trusted' ELSE 'Sample' END AS Trust FROM m WHERE Games >= 50 ORDER BY ExpectedWins DESC, Deck LIMIT 20""")
def c02_p05_expected_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.expected_wins(shares(spark, sf_dir))


_WEEKS = H + """, wk AS (SELECT Deck, CAST(year(EventDate) - 1994 AS INT) AS WeekIndex, 'Deck' AS Level, CAST(count(*) AS DOUBLE) AS Meta FROM h GROUP BY ALL)"""


def _weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).groupBy("Deck", (F.year("EventDate") - 1994).alias("WeekIndex")).agg(F.count("*").cast("double").alias("Meta")).withColumn("Level", F.lit("Deck"))


@query(_WEEKS + """, p AS (SELECT Deck, avg(Meta) AS past FROM (SELECT *, row_number() OVER (PARTITION BY Deck ORDER BY WeekIndex DESC) AS i FROM wk WHERE WeekIndex <> 6) WHERE i <= 4 GROUP BY Deck)
    SELECT Deck, Meta, CASE WHEN Meta - past > 5 THEN 'Rising' WHEN Meta - past < -5 THEN 'Falling' ELSE 'Stable' END AS "Trend Label" FROM wk JOIN p USING (Deck) WHERE WeekIndex = 6""")
def w03_week_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = _weeks(spark, sf_dir)
    return M.week_trend(weeks, weeks.where("WeekIndex = 6").select("Deck", "Meta"), 6, 5.0)


@query(_WEEKS + f""", r AS (SELECT * FROM wk WHERE WeekIndex BETWEEN 3 AND 6), t AS (SELECT Deck FROM r WHERE WeekIndex = 6 ORDER BY Meta DESC, Deck LIMIT 10),
    x AS (SELECT *, row_number() OVER (PARTITION BY Deck ORDER BY WeekIndex DESC) AS i FROM r WHERE Deck IN (SELECT Deck FROM t))
    SELECT Deck, max(Meta) FILTER (i = 1) AS Now, {_R('avg(Meta) FILTER (i > 1)', 6)} AS Past, count(*) AS Weeks,
    CASE WHEN max(Meta) FILTER (i = 1) - {_R('avg(Meta) FILTER (i > 1)', 6)} > 0.5 THEN 'Rising' WHEN max(Meta) FILTER (i = 1) - {_R('avg(Meta) FILTER (i > 1)', 6)} < -0.5 THEN 'Falling' ELSE 'Stable' END AS Status FROM x GROUP BY Deck HAVING count(*) >= 2""")
def w04_c03_chart_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.chart_trend(_weeks(spark, sf_dir), 6)


@query("""WITH w AS (SELECT DISTINCT year(o_orderdate) - 1991 AS WeekIndex, date_trunc('year', o_orderdate) AS WeekStart FROM orders),
    asked AS (SELECT min(WeekStart) AS d FROM w UNION ALL SELECT max(WeekStart) FROM w UNION ALL SELECT max(WeekStart) + INTERVAL 3 YEAR FROM w)
    SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS week_start, CAST(coalesce((SELECT max(WeekIndex) FROM w WHERE WeekStart = d), (SELECT max(WeekIndex) + 1 FROM w), 1) AS BIGINT) AS WeekIndex FROM asked""")
def w05_week_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the first week there is, of the last, and of one that is new."""
    year = F.year("o_orderdate")
    weeks = read(spark, sf_dir, "orders").select((year - 1991).alias("WeekIndex"), F.make_date(year, F.lit(1), F.lit(1)).alias("WeekStart")).distinct().withColumn("WeekEnd", F.date_add("WeekStart", 6))
    first, last = weeks.agg(F.min("WeekStart"), F.max("WeekStart")).first()
    asked = (first, last, last.replace(year=last.year + 3))
    rows = [M.week_index(weeks, F.lit(d), F.date_add(F.lit(d), 6)).select(F.lit(str(d)).alias("week_start"), F.col("WeekIndex").cast("long").alias("WeekIndex")) for d in asked]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


_WORDS = """WITH d AS (SELECT doc_id AS deck_id, w AS item, count(*) AS qty FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents WHERE doc_id % 20 = 0) WHERE w <> '' GROUP BY ALL),
    l AS (SELECT item_id AS lib_id, 'L' || item_id % 5 AS label, w AS item, count(*) AS qty FROM (SELECT item_id, unnest(string_split(lower(text), ' ')) AS w FROM benchmark) WHERE w <> '' GROUP BY ALL),
    s AS (SELECT deck_id, lib_id, sum(least(d.qty, l.qty)) AS low FROM d JOIN l USING (item) GROUP BY ALL), n AS (SELECT deck_id, sum(qty) AS n FROM d GROUP BY 1), m AS (SELECT lib_id, label, sum(qty) AS m FROM l GROUP BY ALL),
    r AS (SELECT deck_id, label, low / (n + m - low) AS sim, row_number() OVER (PARTITION BY deck_id ORDER BY low / (n + m - low) DESC, lib_id) AS i FROM s JOIN n USING (deck_id) JOIN m USING (lib_id)),
    z AS (SELECT deck_id, max(label) FILTER (i = 1) AS nearest, max(label) FILTER (i = 2) AS second, round_even(coalesce(max(sim) FILTER (i = 1), 0) * 1e6, 0) / 1e6 AS nearest_sim, round_even(coalesce(max(sim) FILTER (i = 2), 0) * 1e6, 0) / 1e6 AS second_sim FROM (SELECT DISTINCT deck_id FROM d) LEFT JOIN r USING (deck_id) GROUP BY deck_id)
"""


def _bag(texts: DataFrame, *keys: str) -> DataFrame:
    """Texts (text and the keys) as bags of words. The texts are dealt out by the first key, so that their words stay where they are."""
    rows = texts.select(*keys, "text").repartition(keys[0])
    return rows.select(*keys, F.explode(F.split(F.lower("text"), " ")).alias("item")).where("item <> ''").groupBy(*keys, "item").agg(F.count("*").alias("qty"))


@query(_WORDS + """, p AS (SELECT *, CAST(deck_id % 7 + 1 AS INT) * 2 AS Place FROM z), q AS (SELECT *, CASE WHEN second IS NULL THEN 'library too small' WHEN Place = 1 THEN 'winner' WHEN nearest <> second THEN 'labels differ' WHEN nearest_sim < CASE WHEN Place <= 8 THEN 0.95 ELSE 0.9 END THEN 'too far' END AS reason FROM p)
    SELECT *, CASE WHEN reason IS NULL THEN nearest ELSE 'NEEDS_MANUAL_REVIEW' END AS label FROM q""")
def j12_f26_nearest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    decks = _bag(read(spark, sf_dir, "documents").where("doc_id % 20 = 0").withColumnRenamed("doc_id", "deck_id"), "deck_id")  # the queries of the search
    library = _bag(read(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "lib_id"), "lib_id").withColumn("label", F.concat(F.lit("L"), (F.col("lib_id") % 5).cast("string")))
    places = decks.select("deck_id").distinct().withColumn("Place", ((F.col("deck_id") % 7 + 1) * 2).cast("int"))
    return N.classified(N.nearest_labels(decks, library), places)


@query("""WITH w AS (SELECT doc_id, w AS item, count(*) AS qty FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY ALL),
    z AS (SELECT doc_id, sum(qty) AS n FROM w GROUP BY 1),
    s AS (SELECT a.doc_id AS deck_id, b.doc_id AS lib_id, sum(least(a.qty, b.qty)) AS low FROM w a JOIN w b ON a.item = b.item AND a.doc_id % 20 = 0 AND b.doc_id % 20 <> 0 GROUP BY ALL),
    r AS (SELECT deck_id, source AS label, low / (x.n + y.n - low) AS sim, row_number() OVER (PARTITION BY deck_id ORDER BY low / (x.n + y.n - low) DESC, lib_id) AS i FROM s JOIN z x ON x.doc_id = deck_id JOIN z y ON y.doc_id = lib_id JOIN documents d ON d.doc_id = lib_id),
    t AS (SELECT deck_id, max(label) FILTER (i = 1) AS nearest, max(sim) FILTER (i = 1) AS nearest_sim, max(label) FILTER (i = 2) AS second, max(sim) FILTER (i = 2) AS second_sim FROM r GROUP BY deck_id HAVING max(sim) >= 0.9),
    f AS (SELECT z.doc_id AS deck_id, CAST(z.doc_id // 20 % 4 + 1 AS INT) AS Place, nearest, second, round_even(coalesce(nearest_sim, 0) * 1e6, 0) / 1e6 AS nearest_sim, round_even(coalesce(second_sim, 0) * 1e6, 0) / 1e6 AS second_sim FROM z LEFT JOIN t ON t.deck_id = z.doc_id WHERE z.doc_id % 20 = 0),
    q AS (SELECT *, CASE WHEN nearest IS NULL THEN CASE WHEN Place = 1 THEN 'winner' ELSE 'too far' END WHEN second IS NULL THEN 'library too small' WHEN Place = 1 THEN 'winner' WHEN nearest <> second THEN 'labels differ' WHEN nearest_sim < 0.95 THEN 'too far' END AS reason FROM f)
    SELECT *, CASE WHEN reason IS NULL THEN nearest ELSE 'NEEDS_MANUAL_REVIEW' END AS label FROM q""")
def j12_labels_at_the_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bags of words, labelled by the sources of those that are as good as equal. Only rare words meet."""
    docs = read(spark, sf_dir, "documents")
    decks = N.packed_texts(docs.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "deck_id"), "deck_id")  # the queries of the search
    library = N.packed_texts(docs.where("doc_id % 20 <> 0").withColumnsRenamed({"doc_id": "lib_id", "source": "label"}), "lib_id", "label")
    found = N.labels_at(decks, library)
    return N.classified_at(found, found.select("deck_id", (F.floor(F.col("deck_id") / 20) % 4 + 1).cast("int").alias("Place")))


@query("""WITH d AS (SELECT doc_id AS deck_id, w AS item, count(*) AS qty FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY ALL),
    t AS (SELECT *, row_number() OVER (PARTITION BY deck_id ORDER BY qty DESC, item) AS i FROM d) SELECT deck_id, string_agg(item || ' x' || qty, '; ' ORDER BY i) AS key_cards FROM t WHERE i <= 8 GROUP BY deck_id""")
def k13_key_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.key_items(_bag(read(spark, sf_dir, "documents").withColumnRenamed("doc_id", "deck_id"), "deck_id"))


@query("""WITH b AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY ALL),
    pairs AS (SELECT doc_id AS x, doc_id + 1 AS y FROM documents WHERE doc_id + 1 IN (SELECT doc_id FROM documents)),
    low AS (SELECT x, sum(least(a.n, c.n)) AS low FROM pairs JOIN b a ON a.doc_id = x JOIN b c ON c.doc_id = y AND c.w = a.w GROUP BY x), s AS (SELECT doc_id, sum(n) AS n FROM b GROUP BY doc_id)
    SELECT x AS doc_id, round_even(coalesce(low, 0) / (s.n + t.n - coalesce(low, 0)) * 1e6, 0) / 1e6 AS similarity FROM pairs JOIN s ON s.doc_id = x JOIN s t ON t.doc_id = y LEFT JOIN low USING (x)""")
def f26_multiset_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's bag of words beside that of the document with the next id. A text goes to both of its pairs, and no bag is shuffled."""
    pair = lambda at, after: F.struct((F.col("doc_id") - at).alias("first"), F.lit(after).alias("after"))
    texts = read(spark, sf_dir, "documents").select(F.inline(F.array(pair(0, False), pair(1, True))), "text")
    entry = lambda side: F.when(side, F.struct("item", F.col("qty").cast("int")))
    both = _bag(texts, "first", "after").groupBy("first").agg(*(F.map_from_entries(F.collect_list(entry(side))).alias(n) for n, side in (("bag", ~F.col("after")), ("other", F.col("after")))))
    found = both.where((F.size("bag") > 0) & (F.size("other") > 0))
    return found.select(F.col("first").alias("doc_id"), S.rounded(N.multiset_similarity(F.col("bag"), F.col("other")), 6).alias("similarity"))


@query(H + """, r AS (SELECT DISTINCT EventID AS RosterID, EventDate, Tier, Pilot FROM h), s AS (SELECT RosterID, EventID, count(*) AS Shared FROM r JOIN (SELECT DISTINCT EventID, EventDate, Tier, Pilot FROM h) USING (EventDate, Tier, Pilot) GROUP BY ALL),
    b AS (SELECT *, row_number() OVER w AS i, coalesce(lead(Shared) OVER w, 0) AS nx FROM s WINDOW w AS (PARTITION BY RosterID ORDER BY Shared DESC, EventID)), z AS (SELECT RosterID, count(*) AS Size FROM r GROUP BY 1)
    SELECT RosterID, EventID, Shared, Size, Shared >= floor(0.85 * Size) AND Shared - nx >= 8 AS Clear FROM b JOIN z USING (RosterID) WHERE i = 1""")
def j11_roster_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return N.owner_event(h.withColumnRenamed("EventID", "RosterID"), h)


@query()
def f27_name_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "part").select(F.concat(F.col("p_name"), F.lit("s")).alias("name"))
    return N.name_suggestions(names, read(spark, sf_dir, "part").select(F.col("p_name").alias("name")))
