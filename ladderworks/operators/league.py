"""The season league: points, ranking with movement, names, coverage, brackets and documents for a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.functions.scoring import league_points, premier_points
from ladderworks.operators.ranking import ranks

TOPS = ("Wins", "Top2", "Top4", "Top8", "Top16")


def with_points(results: DataFrame) -> DataFrame:
    """Adds LeaguePoints by place, double for premier events; rows without a place are left out."""
    rows = results.where(F.col("Place").isNotNull())
    return rows.withColumn("LeaguePoints", F.when(F.col("EventClass") == "Premier", premier_points("Place")).otherwise(league_points("Place")))


def with_class(results: DataFrame) -> DataFrame:
    """EventClass is Challenge where older files lack it."""
    if "EventClass" not in results.columns:
        return results.withColumn("EventClass", F.lit("Challenge"))
    return results.withColumn("EventClass", F.when(T.trimmed("EventClass") == "", "Challenge").otherwise(F.col("EventClass")))


def season_totals(results: DataFrame, row: Column) -> DataFrame:
    """One row per identity: points and counts, average finish, the latest name and the first login."""
    rows = results.where(T.trimmed("Pilot") != "").withColumns({"_key": T.identity_key("LoginID", "Pilot"), "_row": row})
    tops = [F.count_if(F.col("Place") <= k).alias(n) for n, k in zip(TOPS, (1, 2, 4, 8, 16), strict=True)]
    latest = F.max_by("Pilot", F.struct(F.col("EventDate").isNotNull().alias("d"), "EventDate", (-F.col("_row")).alias("r")))
    return rows.groupBy("_key").agg(latest.alias("Pilot"), F.min_by("LoginID", "_row").alias("LoginID"), F.sum("LeaguePoints").alias("Points"), F.sum(F.when(F.col("EventClass") == "Premier", F.col("LeaguePoints")).otherwise(0)).alias("PremierPoints"), *tops, F.countDistinct("EventID").alias("Starts"), F.avg("Place").alias("_finish"))


def ranked(totals: DataFrame) -> DataFrame:
    """Rank 1..n by points, then wins to starts, then average finish, name and login. The table has a row per pilot of a season."""
    # the key of the identity comes last, so that the order is total
    return ranks(totals, *(-F.col(c) for c in ("Points", *TOPS, "Starts")), *map(F.col, ("_finish", "Pilot", "LoginID", "_key")))


def season_table(results: DataFrame, row: Column, as_of: Column, days_back: int = 7) -> DataFrame:
    """The leaderboard, with the rank of `days_back` days before and the change since; null for who is new."""
    now = ranked(season_totals(results.where(F.col("EventDate") <= as_of), row))
    before = ranked(season_totals(results.where(F.col("EventDate") <= F.date_sub(as_of, days_back)), row)).select("_key", F.col("Rank").alias("PrevRank"))
    table = now.join(before, "_key", "left").withColumn("RankChange", F.col("PrevRank") - F.col("Rank"))
    return table.withColumn("Movement", F.when(F.col("PrevRank").isNull(), "new").when(F.col("RankChange") > 0, "up").when(F.col("RankChange") < 0, "down").otherwise("same")).drop("_finish")


def tier_coverage(history: DataFrame) -> DataFrame:
    """Events by month and tier, and whether a tier had events in the month before (of those there are) and has none now."""
    months = history.select(F.date_format("EventDate", "yyyy-MM").alias("Month")).distinct()
    tiers = history.select("Tier").distinct()
    counts = history.groupBy(F.date_format("EventDate", "yyyy-MM").alias("Month"), "Tier").agg(F.countDistinct("EventID").alias("Events"))
    grid = months.crossJoin(F.broadcast(tiers)).join(counts, ["Month", "Tier"], "left").withColumn("Events", F.coalesce("Events", F.lit(0)))
    last = F.lag("Events").over(Window.partitionBy("Tier").orderBy("Month"))
    return grid.withColumn("Gap", (F.coalesce(last, F.lit(0)) > 0) & (F.col("Events") == 0))


def tier_pivot(history: DataFrame, tiers: list[str]) -> DataFrame:
    """Events by month, a column for each of the tiers."""
    return history.groupBy(F.date_format("EventDate", "yyyy-MM").alias("Month")).pivot("Tier", tiers).agg(F.countDistinct("EventID")).na.fill(0)


def name_history(results: DataFrame, row: Column) -> DataFrame:
    """The names of each identity by the date of their first use, and how many; the current name is the last one first seen."""
    rows = results.withColumns({"_key": T.identity_key("LoginID", "Pilot"), "_row": row})
    first = rows.groupBy("_key", "Pilot").agg(F.min(F.struct("EventDate", "_row")).alias("f"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("f", "Pilot"))), lambda s: s["Pilot"])
    return first.groupBy("_key").agg(F.array_join(names, " > ").alias("Names"), F.count("*").alias("n_names"), F.element_at(names, -1).alias("Current"))


def identity_coverage(results: DataFrame) -> DataFrame:
    """How many identities rest on a login and how many on a name."""
    keys = results.select(T.identity_key("LoginID", "Pilot").alias("k")).distinct()
    return keys.groupBy().agg(F.count_if(F.startswith("k", F.lit("id:"))).alias("by_login"), F.count_if(F.startswith("k", F.lit("name:"))).alias("by_name"))


def partial_season(results: DataFrame, start: Column) -> DataFrame:
    """First date and whether the data begin after the season."""
    return results.agg(F.min("EventDate").alias("first_date")).withColumn("partial", F.col("first_date") > start)


def both_sides(matches: DataFrame) -> DataFrame:
    """Each match as two rows, the winner's and the loser's."""
    side = lambda own, other, result: F.struct(F.col(f"{own}Pilot").alias("Pilot"), F.col(f"{own}LoginID").alias("LoginID"), F.col(f"{own}Deck").alias("Deck"), F.col(f"{other}Pilot").alias("Opponent"), F.col(f"{other}Deck").alias("OpponentDeck"), F.lit(result).alias("Result"))
    sides = F.explode(F.array(side("Winner", "Loser", "W"), side("Loser", "Winner", "L"))).alias("s")
    return matches.select("EventID", "EventDate", "Round", sides).select("EventID", "EventDate", "Round", "s.*")


def matchup_matrix(matches: DataFrame) -> DataFrame:
    """Wins, losses and games by deck and opposing deck, mirrors left out."""
    rows = both_sides(matches).where("Deck <> OpponentDeck")
    return rows.groupBy("Deck", "OpponentDeck").agg(F.count_if(F.col("Result") == "W").alias("Wins"), F.count_if(F.col("Result") == "L").alias("Losses"), F.count("*").alias("Games"))


def name_drift(history: DataFrame, fresh: DataFrame) -> DataFrame:
    """Places of the history whose name differs from the freshly read one."""
    new = fresh.select("EventID", "Place", F.col("Pilot").alias("NewPilot"), F.col("LoginID").alias("NewLoginID"))
    return history.join(new, ["EventID", "Place"]).where(T.normalize_name("Pilot") != T.normalize_name("NewPilot")).select("EventID", "Place", F.col("Pilot").alias("OldPilot"), "NewPilot", "NewLoginID")


def pilot_documents(results: DataFrame) -> DataFrame:
    """A JSON document for each identity: its results by date and event, and how many decks it played."""
    rows = results.withColumn("_key", T.identity_key("LoginID", "Pilot"))
    one = F.struct(F.col("EventDate").cast("string").alias("date"), F.col("EventID").alias("event"), F.col("Place").alias("place"), F.col("Deck").alias("deck"), F.col("LeaguePoints").alias("points"))
    return rows.groupBy("_key").agg(F.to_json(F.struct(F.countDistinct("Deck").alias("distinctDecks"), F.sort_array(F.collect_list(one)).alias("results"))).alias("document"))
