"""Market share and win rates: roll-ups of raw entries, matchups, metrics, trends over weeks and chart data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.functions.scoring import copies, hits_at_least_one, prep_priority, record_probabilities, rounded, steady, trend_label, trust_label
from ladderworks.operators.ranking import ranks
from ladderworks.operators.rules import archetypes

#: Population, rounds, cutoff of encounter charts in percent, weeks of a trend, thresholds of trends.
POPULATION, ROUNDS, CUTOFF, WEEKS_BACK, DECK_TREND, ARCHETYPE_TREND = 1000, 5, 5.0, 4, 0.5, 0.2
MIN_GAMES, CHART_ROWS, TREND_DECKS = 50, 20, 10


def _weighted(value: str, weight: str) -> Column:
    """Mean by weight, the plain mean where the weights sum to nothing."""
    w = F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))
    return F.when(w > 0, F.sum(F.col(value) * F.col(weight)) / w).otherwise(F.avg(value))


def roll_up_raw(rows: DataFrame) -> DataFrame:
    """Canonical decks of raw entries (Deck, SourceName, Meta, Winrate, Games, Archetype, MyWinrate, MyGames, MySource).

    Share and games are summed and the win rate weighted by games. My deck's win rate is the mean over the rows of the
    best source there is (primary, fallback); without any it is 0.5 and marked as imputed. The archetype is the most
    frequent one, the first by name of equals.
    """
    votes = rows.groupBy("Deck", "Archetype").agg(F.count("*").alias("v")).groupBy("Deck").agg(F.min_by("Archetype", F.struct((-F.col("v")).alias("v"), "Archetype")).alias("Archetype"))
    best = lambda source, x: F.when(F.col("MySource") == source, F.col(x))
    own = {s: (F.avg(best(s, "MyWinrate")).alias(f"w_{s}"), F.max(best(s, "MyGames")).alias(f"g_{s}"), F.count_if(F.col("MySource") == s).alias(f"n_{s}")) for s in ("primary", "fallback")}
    out = rows.groupBy("Deck").agg(F.array_join(F.array_sort(F.collect_set("SourceName")), " | ").alias("Source Deck Names"), rounded(F.sum("Meta")).alias("Meta"), rounded(_weighted("Winrate", "Games")).alias("Winrate"), F.sum("Games").alias("Winrate Game Count"), *own["primary"], *own["fallback"])
    source = F.when(F.col("n_primary") > 0, "primary").when(F.col("n_fallback") > 0, "fallback").otherwise("none")
    mine = F.when(source == "primary", F.col("w_primary")).when(source == "fallback", F.col("w_fallback")).otherwise(F.lit(0.5))
    games = F.when(source == "primary", F.col("g_primary")).when(source == "fallback", F.col("g_fallback")).otherwise(F.lit(0))
    done = out.withColumns({"My Deck Winrate": rounded(mine), "My Deck Winrate Game Count": games, "My Deck Winrate Fallback180": source == "fallback", "My Deck Winrate Imputed": source == "none"})
    return done.drop(*(f"{a}_{s}" for a in "wgn" for s in own)).join(votes, "Deck")


def _by_meta(value: Column) -> Column:
    return F.try_divide(F.sum(F.col("Meta") * value), F.sum(F.when(value.isNotNull(), F.col("Meta"))))


def group_decks(rows: DataFrame, threshold: float) -> DataFrame:
    """Decks of the raw roll-up (with `ordinal`): win rates by share, the first known archetype, Main or Rogue by share."""
    known = F.when(~T.is_unknown("Archetype"), F.col("Archetype"))
    out = rows.groupBy("Deck").agg(rounded(F.sum("Meta")).alias("Meta"), rounded(_by_meta(F.coalesce("Winrate", F.lit(0.0)))).alias("Winrate"), F.sum("Games").alias("Games"), F.coalesce(F.min_by(known, F.when(known.isNotNull(), F.col("ordinal"))), F.lit("Unknown")).alias("Archetype"), rounded(_by_meta(F.col("MyWinrate"))).alias("MyWinrate"), F.sum("MyGames").alias("MyGames"), F.bool_or(F.col("MySource") == "none").alias("Imputed"))
    return out.withColumn("Meta Tier", F.when(F.col("Meta") < threshold, "Rogue").otherwise("Main"))


def rogue_bucket(grouped: DataFrame) -> DataFrame:
    """The decks of the Rogue tier as one row, Rogue of archetype Mixed, beside the others."""
    small = F.col("Meta Tier") == "Rogue"
    merged = grouped.where(small).groupBy().agg(F.sum("Meta").alias("Meta"), _by_meta(F.col("Winrate")).alias("Winrate"), F.sum("Games").alias("Games"), F.count("*").alias("n")).where("n > 0")
    one = merged.select(F.lit("Rogue").alias("Deck"), F.lit("Mixed").alias("Archetype"), rounded("Meta").alias("Meta"), rounded("Winrate").alias("Winrate"), "Games")
    return grouped.where(~small).select("Deck", "Archetype", "Meta", "Winrate", "Games").unionByName(one)


def roll_up_archetypes(decks: DataFrame) -> DataFrame:
    """Archetypes: share summed, win rates by share, my win rate over decks that have one."""
    return decks.groupBy("Archetype").agg(steady(F.sum("Meta")).alias("Meta"), steady(_by_meta(F.col("Winrate"))).alias("Winrate"), F.sum("Games").alias("Games"), steady(_by_meta(F.col("MyWinrate"))).alias("MyWinrate"), F.count("*").alias("Decks"))


def my_matchups(scan: DataFrame, deck: str) -> DataFrame:
    """The matchups of the row that is my deck: the first of that name, else the last whose name holds mine or is held.

    `scan` has ordinal, name (canonical) and matchups (array of opponent, winrate, games).
    """
    own, name = T.normalize_name(F.lit(deck)), T.normalize_name("name")
    exact, loose = name == own, F.contains(name, own) | F.contains(own, name)
    pick = scan.where(exact | loose).orderBy(F.desc(exact), F.when(exact, F.col("ordinal")).otherwise(-F.col("ordinal"))).limit(1)
    return pick.select(F.explode("matchups").alias("m")).select("m.*")


def collapse_matchups(rows: DataFrame) -> DataFrame:
    """One row per opponent: win rate by games, the plain mean without games; rows without a win rate are left out."""
    return rows.where("winrate IS NOT NULL").groupBy(T.normalize_name("opponent").alias("opponent")).agg(rounded(_weighted("winrate", "games"), 4).alias("winrate"), F.sum("games").alias("games"))


def with_my_winrate(decks: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Adds my win rate and its source: the primary window, else the fallback one, else none."""
    side = lambda t, s: t.select(F.col("opponent").alias(f"o_{s}"), F.col("winrate").alias(f"w_{s}"), F.col("games").alias(f"g_{s}"))
    out = decks.join(side(primary, "p"), T.normalize_name("Deck") == F.col("o_p"), "left").join(side(fallback, "f"), T.normalize_name("Deck") == F.col("o_f"), "left")
    source = F.when(F.col("w_p").isNotNull(), "primary").when(F.col("w_f").isNotNull(), "fallback").otherwise("none")
    return out.withColumns({"MyWinrate": F.coalesce("w_p", "w_f"), "MyGames": F.when(source == "primary", F.col("g_p")).when(source == "fallback", F.col("g_f")).otherwise(0), "MySource": source}).drop("o_p", "w_p", "g_p", "o_f", "w_f", "g_f")


def compare_share(challenge: DataFrame, meta: DataFrame) -> DataFrame:
    """Challenge entries against market share by deck: shares in percent and their difference, decks of either side."""
    counts = challenge.groupBy("Deck").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    own = counts.crossJoin(F.broadcast(total)).select("Deck", F.col("n").alias("Challenge Count"), rounded(100.0 * F.col("n") / F.col("total")).alias("Challenge Share"))
    both = own.join(meta.select("Deck", rounded("Meta").alias("Meta Share")), "Deck", "full").na.fill(0)
    return both.withColumn("Delta pp", rounded(F.col("Challenge Share") - F.col("Meta Share")))


def with_meta_share(presence: DataFrame, meta: DataFrame, key: str = "Deck", rules: DataFrame | None = None) -> DataFrame:
    """Adds the market share summed by key, 0 where there is none. By archetype, with `rules`: that of the deck's name by the
    rules, whatever archetype the market share itself has."""
    named = meta.withColumn("Deck", T.trimmed("Deck"))
    meta = archetypes(named.drop("Archetype"), rules) if rules is not None else named
    share = meta.groupBy(key).agg(rounded(F.sum("Meta")).alias("MetaPct"))
    return presence.join(share, key, "left").na.fill(0, ["MetaPct"])


def metrics(rows: DataFrame, population: int = POPULATION, rounds: int = ROUNDS) -> DataFrame:
    """Encounter copies and chance, importance, quartile, priority and performance label of decks (Meta, Winrate).

    Quartiles and medians are exact, by linear interpolation, and come from one aggregation over the table.
    """
    at = lambda p: F.percentile("_imp", p)
    ends = rows.agg(F.max("Meta").alias("_top"), F.min("Winrate").alias("_low"), F.max("Winrate").alias("_high"), F.median("Meta").alias("_mm"), F.median("Winrate").alias("_mw"))
    share = F.col("Meta") / F.when(F.col("_top") > 0, F.col("_top")).otherwise(1.0)
    span = F.when(F.col("_high") > F.col("_low"), F.col("_high") - F.col("_low")).otherwise(1.0)
    own = rows.crossJoin(F.broadcast(ends)).withColumn("_imp", 0.7 * share + 0.3 * (F.col("Winrate") - F.col("_low")) / span)
    own = own.crossJoin(F.broadcast(own.agg(at(0.25).alias("_q1"), at(0.5).alias("_q2"), at(0.75).alias("_q3"))))
    quartile = F.when(F.col("_imp") <= F.col("_q1"), "Q1").when(F.col("_imp") <= F.col("_q2"), "Q2").when(F.col("_imp") <= F.col("_q3"), "Q3").otherwise("Q4")
    label = F.when((F.col("Meta") < F.col("_mm")) & (F.col("Winrate") > F.col("_mw")), "Underplayed Winner").when((F.col("Meta") > F.col("_mm")) & (F.col("Winrate") < F.col("_mw")), "Popular Trap").otherwise("Neutral")
    out = own.withColumns({"Encounter Copies": copies(F.col("Meta"), population), "Importance": rounded("_imp", 6), "Quartile": quartile, "Performance Label": label})
    out = out.withColumns({"Encounter Probability": rounded(hits_at_least_one(F.col("Encounter Copies"), population, rounds), 6), "Prep Priority": prep_priority("Quartile")})
    return out.drop(*(c for c in out.columns if c.startswith("_")))


def whole_column_percent(rows: DataFrame, col: str) -> DataFrame:
    """Numbers of a text column; if any has a percent sign or is above 1 the whole column is divided by 100."""
    value = T.parse_percent(col)
    scale = rows.agg(F.coalesce(F.bool_or(F.contains(T.text_of(col), F.lit("%"))) | (F.max(value) > 1), F.lit(False)).alias("_percent"))
    return rows.crossJoin(F.broadcast(scale)).withColumn(col, F.when(F.col("_percent"), value / 100).otherwise(value)).drop("_percent")


def week_trend(history: DataFrame, current: DataFrame, week: int, threshold: float = DECK_TREND) -> DataFrame:
    """Adds the trend of each deck against the mean share of its last four rows of other weeks; Stable without any."""
    place = Window.partitionBy("Deck").orderBy(F.desc("WeekIndex"), F.desc("Level"))
    past = history.where(F.col("WeekIndex") != week).withColumn("_n", F.row_number().over(place)).where("_n <= 4").groupBy("Deck").agg(F.avg("Meta").alias("_past"))
    return current.join(past, "Deck", "left").withColumn("Trend Label", trend_label(F.col("Meta"), F.coalesce("_past", "Meta"), threshold)).drop("_past")


def chart_trend(history: DataFrame, week: int, weeks_back: int = WEEKS_BACK, threshold: float = DECK_TREND, top: int = TREND_DECKS) -> DataFrame:
    """The last value of each of the top decks against the mean of its earlier ones in the window; two values at least."""
    rows = history.where(F.col("WeekIndex").between(max(1, week - weeks_back + 1), week))
    decks = rows.where(F.col("WeekIndex") == week).orderBy(F.desc("Meta"), "Deck").limit(top).select("Deck")
    place = Window.partitionBy("Deck").orderBy(F.desc("WeekIndex"))
    seen = rows.join(F.broadcast(decks), "Deck", "left_semi").withColumn("_n", F.row_number().over(place))
    out = seen.groupBy("Deck").agg(F.max(F.when(F.col("_n") == 1, F.col("Meta"))).alias("Now"), rounded(F.avg(F.when(F.col("_n") > 1, F.col("Meta"))), 6).alias("Past"), F.count("*").alias("Weeks")).where("Weeks >= 2")
    return out.withColumn("Status", trend_label(F.col("Now"), F.col("Past"), threshold))


def week_index(history: DataFrame, start: Column, end: Column) -> DataFrame:
    """The number of a week: that of the same range if it is there, else one more than the largest, else 1."""
    same = (F.col("WeekStart") == start) & (F.col("WeekEnd") == end)
    return history.agg(F.coalesce(F.max(F.when(same, F.col("WeekIndex"))), F.max("WeekIndex") + 1, F.lit(1)).alias("WeekIndex"))


def records(decks: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Chances of each record by deck, `w-l` and probability; a win rate of zero counts as 0.5."""
    rate = F.when(F.coalesce("Winrate", F.lit(0.0)) == 0, 0.5).otherwise(F.col("Winrate"))
    rows = decks.select("Deck", F.posexplode(record_probabilities(rate, rounds)).alias("wins", "p"))
    return rows.select("Deck", F.concat_ws("-", "wins", F.lit(rounds) - F.col("wins")).alias("Record"), rounded("p", 6).alias("Probability"))


def record_table(decks: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The same as a column for each record, the median win rate of the field first."""
    field = decks.agg(F.median("Winrate").alias("Winrate")).select(F.lit("Field median").alias("Deck"), "Winrate")
    names = [f"{rounds - l}-{l}" for l in range(rounds + 1)]  # noqa: E741
    return records(field.unionByName(decks.select("Deck", "Winrate")), rounds).groupBy("Deck").pivot("Record", names).agg(F.first("Probability"))


def encounter_chart(decks: DataFrame, cutoff: float = CUTOFF, population: int = POPULATION, rounds: int = ROUNDS) -> DataFrame:
    """Decks whose chance of being met reaches the cutoff (percent); decks without copies have none."""
    chance = hits_at_least_one(F.least(F.greatest(copies(F.col("Meta"), population), F.lit(0)), F.lit(population)), population, rounds, none=0.0)
    return decks.select("Deck", "Meta", rounded(chance * 100, 4).alias("EncounterPct")).where(F.col("EncounterPct") >= cutoff)


def expected_wins(decks: DataFrame, rounds: int = ROUNDS, min_games: int = MIN_GAMES, top: int = CHART_ROWS) -> DataFrame:
    """The decks with most expected wins among those with enough games, and how far their win rate is trusted."""
    rows = decks.where(F.col("Games") >= min_games).withColumn("ExpectedWins", rounded(F.col("Winrate") * rounds, 4))
    return rows.orderBy(F.desc("ExpectedWins"), "Deck").limit(top).select("Deck", "ExpectedWins", "Games", trust_label("Games").alias("Trust"))


def _met(share: Column, population: int, rounds: int) -> Column:
    """The chance of meeting a deck of that share; decks without copies have none."""
    return hits_at_least_one(F.least(F.greatest(copies(share, population), F.lit(0)), F.lit(population)), population, rounds, none=0.0)


def presence_against_share(stats: DataFrame, key: str = "Deck", *, by_share: bool = False, cutoff: float = CUTOFF, population: int = POPULATION, rounds: int = ROUNDS) -> DataFrame:
    """Presence beside the market share (MetaPct) of the keys whose chance of being met reaches the cutoff, in their order.

    The order is by event frequency of entries, then of top eights, then share, or by share first; ties go by key.
    """
    bars = ("Top32EventFreqPct", "Top8EventFreqPct", "MetaPct")
    rows = stats.select(key, *bars).na.fill(0, list(bars)).where(_met(F.col("MetaPct"), max(1, population), max(1, rounds)) >= cutoff / 100)
    order = ("MetaPct", *bars[:2]) if by_share else bars
    return ranks(rows, *(-F.col(c) for c in order), F.col(key), name="Order")


def delta_ranking(stats: DataFrame, key: str = "Deck", *, least: int = 4, cutoff: float = CUTOFF, population: int = POPULATION, rounds: int = ROUNDS, median_of_all: bool = False) -> DataFrame:
    """Keys whose chance of being met reaches the cutoff by how far their event frequency lies above their market share
    (MetaPct), beside the median difference of these, or of all keys, where there are enough."""
    rows = stats.select(key, "Top32EventFreqPct", "MetaPct").na.fill(0, ["Top32EventFreqPct", "MetaPct"]).withColumn("Delta pp", rounded(F.col("Top32EventFreqPct") - F.col("MetaPct")))
    shown = rows.where(_met(F.col("MetaPct"), max(1, population), max(1, rounds)) >= cutoff / 100)
    middle = (rows if median_of_all else shown).agg(F.when(F.count("*") >= least, rounded(F.median("Delta pp"), 4)).alias("MedianDelta"))
    placed = ranks(shown.select(key, "Delta pp"), -F.col("Delta pp"), F.col(key), name="DeltaRank")
    return placed.join(F.broadcast(middle), F.lit(True))  # one row of the median


def conversion(presence: DataFrame, top: int = CHART_ROWS) -> DataFrame:
    """Entries and conversion to the top eight and to wins of the keys with most entries."""
    return presence.orderBy(F.desc("Top32EntryCount"), "Deck").limit(top).select("Deck", "Top32EntryCount", "Top8Rate", "WinnerRate")
