"""Presence of decks and archetypes at events: by tier, over all tiers, by half of a period, and by pilot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.functions.scoring import percent, rounded
from ladderworks.operators.ranking import ranks
from ladderworks.sources.scratch import cut

TOPS, TOP_PLACES = (8, 16), (16, 8, 4, 2)
SUMMED = ("Events", "Appearances", "Top8Count", "Top16Count", "WinnerCount", "Top32EventCount", "Top32EntryCount", "Top8EventCount", "Top16EventCount", "WinnerEventCount")


def _listed(x: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(x)), ";")


def entries(history: DataFrame, key: str = "Deck") -> DataFrame:
    """History rows counted by tier, key, event and pilot: what presence, its lists and its bitmaps are all made from.

    Rows without a key are counted too, so that an event counts for its tier whatever was entered. A caller that needs more
    than one of these tables keeps this one, and the history is read once.
    """
    return history.groupBy("Tier", key, "EventID", "EventDate", T.identity_key("LoginID", "Pilot").alias("_id")).agg(
        F.count("*").alias("n"), F.sum("Place").alias("places"), F.count("Place").alias("placed"), F.min("Place").alias("best"),
        *(F.count_if(F.col("Place") <= k).alias(f"in{k}") for k in TOP_PLACES), F.count_if(F.col("Place") == 1).alias("won"),
    )


def single(history: DataFrame, *keys: str) -> DataFrame:
    """History rows as `entries` of the keys that aren't counted yet, one each, written once to the shared folder. No row is shuffled for it."""
    return uncounted(cut(history.select("Tier", *(keys or ("Deck",)), "EventID", "EventDate", T.identity_key("LoginID", "Pilot").alias("_id"), "Place")))


def uncounted(rows: DataFrame) -> DataFrame:
    """Rows (Tier, EventID, EventDate, _id, Place and keys) as `entries` of one each, for a caller that has written them already."""
    within = lambda cond: F.coalesce(cond.cast("long"), F.lit(0).cast("long"))
    place = F.col("Place")
    tops = {f"in{k}": within(place <= k) for k in TOP_PLACES}
    return rows.withColumns({"n": F.lit(1).cast("long"), "places": place.cast("long"), "placed": within(place.isNotNull()), "best": place, **tops, "won": within(place == 1)}).drop("Place")


def event_counts(history: DataFrame) -> DataFrame:
    """Tier and n_events: the distinct events of each tier."""
    return history.groupBy("Tier").agg(F.countDistinct("EventID").alias("n_events"))


def event_lists(history: DataFrame, *by: str) -> DataFrame:
    """EventIDs and EventDates of each group, sorted and joined by semicolons, for tables that are written out.

    A list is as long as its key has events; what only counts events doesn't need it.
    """
    rows = history.where(F.col(by[-1]).isNotNull())
    ids = rows.select(*by, "EventID").distinct().groupBy(*by).agg(_listed(F.col("EventID")).alias("EventIDs"))
    days = rows.select(*by, F.col("EventDate").cast("string").alias("d")).distinct().groupBy(*by).agg(_listed(F.col("d")).alias("EventDates"))
    return ids.join(days, list(by))


def presence(history: DataFrame, key: str = "Deck") -> DataFrame:
    """The presence table of each tier and key, of history rows (EventID, EventDate, Tier, Place, the key, Pilot, LoginID).

    The few columns needed are written to the shared folder (`single`), so that the history is read once, however often the
    table is used, and nothing is grouped or shuffled before; events then count by their best place, so that no row is read once for each distinct count. Rows without a key are dropped. Percentages of events are over the tier's events and
    rounded to two digits, but those of the top 4 and top 2, which are not rounded. For the lists of events see `event_lists`.
    """
    return presence_of(single(history, key), key)


def presence_of(counted: DataFrame, key: str = "Deck", events: DataFrame | None = None) -> DataFrame:
    """The presence table, from `entries`, and from their `event_counts` where a caller has them."""
    rows = counted.where(F.col(key).isNotNull())
    each = rows.groupBy("Tier", key, "EventID").agg(*(F.sum(c).alias(c) for c in ("n", "places", "placed", *(f"in{k}" for k in TOP_PLACES), "won")), F.min("best").alias("best"))
    event = F.col("EventID").isNotNull()
    stats = each.groupBy("Tier", key).agg(
        F.count("EventID").alias("Events"), F.sum("n").alias("Appearances"), rounded(F.sum("places") / F.sum("placed"), 1).alias("AvgPlace"), F.coalesce(F.min("best"), F.lit(999)).alias("BestPlace"),
        *(F.sum(f"in{k}").alias(f"Top{k}Count") for k in TOP_PLACES), F.sum("won").alias("WinnerCount"),
        *(F.count_if(event & (F.col(f"in{k}") > 0)).alias(f"Top{k}EventCount") for k in TOP_PLACES), F.count_if(event & (F.col("won") > 0)).alias("WinnerEventCount"),
    )
    by_pilot = rows.groupBy("Tier", key, "_id").agg(F.sum("n").alias("n")).groupBy("Tier", key).agg(F.count("*").alias("DistinctPilots"), F.max("n").alias("_most"))
    n, seen = F.col("n_events"), F.greatest(F.col("Appearances"), F.lit(1))
    out = stats.join(by_pilot, ["Tier", key]).join(event_counts(counted) if events is None else events, "Tier")
    pct = {"PresencePct": percent(F.col("Events"), n)}
    pct |= {f"Top{k}EventFreqPct": percent(F.col(f"Top{k}EventCount"), n, 2 if k >= 8 else None) for k in (16, 8, 4, 2)}
    pct |= {f"Top{k}PresencePct": pct[f"Top{k}EventFreqPct"] for k in TOPS}
    pct |= {"Top32EventFreqPct": pct["PresencePct"], "WinnerEventFreqPct": percent(F.col("WinnerEventCount"), n)}
    pct |= {f"{name}Rate": percent(F.col(f"{name}Count"), seen) for name in ("Top16", "Top8", "Winner")}
    pct |= {f"{name}ShareOfTop32EntriesPct": pct[f"{name}Rate"] for name in ("Top16", "Top8", "Winner")}
    more = {"Top32EventCount": F.col("Events"), "Top32EntryCount": F.col("Appearances"), "TopPilotShare": rounded(F.col("_most") / seen, 4)}
    return out.withColumns(pct | more).drop("_most")


def all_tiers(tables: DataFrame, key: str = "Deck") -> DataFrame:
    """The ALL table: sums over the tiers' presence tables, percentages over the sum of their events.

    The average place is weighted by appearances from the tiers' rounded averages. Top 4, top 2 and pilots are not carried.
    """
    total = tables.select("Tier", "n_events").distinct().agg(F.sum("n_events").alias("n_all"))
    sums = tables.groupBy(key).agg(*(F.sum(c).alias(c) for c in SUMMED), F.sum(F.col("AvgPlace") * F.col("Appearances")).alias("_places"), F.min("BestPlace").alias("BestPlace"))
    n, seen = F.col("n_all"), F.greatest(F.col("Appearances"), F.lit(1))
    pct = {"AvgPlace": rounded(F.col("_places") / seen, 1), "Tier": F.lit("ALL")}
    pct |= {"PresencePct": percent(F.col("Events"), n), "Top32EventFreqPct": percent(F.col("Events"), n), "WinnerEventFreqPct": percent(F.col("WinnerEventCount"), n)}
    for k in TOPS:
        pct |= dict.fromkeys((f"Top{k}PresencePct", f"Top{k}EventFreqPct"), percent(F.col(f"Top{k}EventCount"), n))
    for name in ("Top16", "Top8", "Winner"):
        pct |= dict.fromkeys((f"{name}Rate", f"{name}ShareOfTop32EntriesPct"), percent(F.col(f"{name}Count"), seen))
    return sums.crossJoin(F.broadcast(total)).withColumns(pct).drop("_places")  # one row of totals


def finalists(history: DataFrame) -> DataFrame:
    """First and second of each event that has both."""
    at = lambda p, c: F.max(F.when(F.col("Place") == p, F.col(c)))
    rows = history.where("Place <= 2").groupBy("EventID", "EventDate", "Tier").agg(at(1, "Deck").alias("FirstDeck"), at(1, "Pilot").alias("FirstPilot"), at(2, "Deck").alias("SecondDeck"), at(2, "Pilot").alias("SecondPilot"))
    return rows.where("FirstPilot IS NOT NULL AND SecondPilot IS NOT NULL")


def _first_decks(rows: DataFrame) -> DataFrame:
    day = F.coalesce(F.unix_date(F.col("EventDate").cast("date")), F.lit(-(2**31))).cast("decimal(12,0)")
    late = (day * F.lit(str(2**64)).cast("decimal(20,0)") - F.col("_row").cast("decimal(20,0)")).cast("decimal(38,0)")
    # numbers only, by names first: such an aggregation needs no sort of the history's rows
    each = rows.groupBy("_key", "Pilot", "LoginID", "Deck").agg(
        F.max(late).alias("_late"), F.min("_row").alias("_row"), F.count_if(F.col("Place") == 1).alias("won"), F.count_if(F.col("Place") <= 8).alias("top"), F.count("Place").alias("placed"),
        F.sum("Place").alias("places"), F.min("Place").alias("best"),
    )
    names = F.array_join(F.array_sort(F.collect_set(F.when((F.col("won") > 0) & (F.trim("Deck") != ""), F.trim("Deck")))), ";")
    return each.groupBy("_key").agg(
        F.max_by("Pilot", "_late").alias("Pilot"), F.min_by("LoginID", "_row").alias("LoginID"), F.sum("won").alias("Wins"), F.sum("top").alias("Top8"), F.sum("placed").alias("Top32"),
        rounded(F.sum("places") / F.sum("placed"), 1).alias("AvgPlace"), F.coalesce(F.min("best"), F.lit(999)).alias("BestPlace"), F.countDistinct("Deck").alias("DecksPlayed"), names.alias("WinningDecks"),
    )


def pilot_table(history: DataFrame, row: Column) -> DataFrame:
    """Pilots by wins, top eights and entries; `row` numbers the rows in the order in which they stand.

    A pilot is the login, or the name where there is none; the name shown is the latest. Ties keep the order of the keys.
    """
    rows = history.where(T.trimmed("Pilot") != "").withColumns({"_key": T.identity_key("LoginID", "Pilot"), "_row": row})
    return ranks(_first_decks(rows), -F.col("Wins"), -F.col("Top8"), -F.col("Top32"), F.col("_key")).drop("_key")


def trend(history: DataFrame, key: str = "Deck") -> DataFrame:
    """Presence by distinct dates in the older and the newer half of the dates, their differences and the label.

    The older half has half of the dates, rounded down, one at least. Fewer than two dates give no rows.
    """
    days = history.select("EventDate").where("EventDate IS NOT NULL").distinct()
    halves = days.select("EventDate", F.row_number().over(Window.orderBy("EventDate")).alias("i")).crossJoin(F.broadcast(days.agg(F.count("*").alias("n"))))
    halves = halves.where("n >= 2").withColumn("new", F.col("i") > F.greatest(F.lit(1), F.floor(F.col("n") / 2)))
    sizes = halves.groupBy().agg(F.count_if("new").alias("n_new"), F.count_if(~F.col("new")).alias("n_old"))
    rows = history.join(halves.select("EventDate", "new"), "EventDate")
    on = lambda cond: F.countDistinct(F.when(cond, F.col("EventDate")))
    new, top = F.col("new"), F.col("Place") <= 8
    seen = rows.groupBy(key).agg(on(new).alias("a"), on(~new).alias("b"), on(new & top).alias("c"), on(~new & top).alias("d")).crossJoin(F.broadcast(sizes))
    moved = lambda x, y: F.col(x) / F.col("n_new") * 100.0 - F.col(y) / F.col("n_old") * 100.0
    both = seen.withColumns({"_p": moved("a", "b"), "_t": moved("c", "d")}).withColumn("_s", 0.7 * F.col("_p") + 0.3 * F.col("_t"))
    return both.select(key, rounded("_p").alias("DeltaTop32"), rounded("_t").alias("DeltaTop8"), F.when(F.col("_s") >= 10, "Rising").when(F.col("_s") <= -10, "Falling").otherwise("Stable").alias("Trend"))


def last_dates(history: DataFrame, n: int) -> DataFrame:
    """Rows of the newest `n` distinct event dates."""
    days = history.select("EventDate").where("EventDate IS NOT NULL").distinct().orderBy(F.desc("EventDate")).limit(n)
    return history.join(F.broadcast(days), "EventDate", "left_semi")


def in_window(rows: DataFrame, start: str, end: str, col: str = "EventDate") -> DataFrame:
    """Rows of a closed range of dates; what is no date is left out."""
    return rows.where(F.try_to_date(F.col(col).cast("string")).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def relabelled(rows: DataFrame, sentinel: str = "NEEDS_MANUAL_REVIEW") -> DataFrame:
    """The view that statistics use: the stored sentinel and empty archetypes read Unknown."""
    known = lambda c: F.when(F.col(c) == sentinel, "Unknown").otherwise(F.col(c))
    return rows.withColumn("Deck", known("Deck")).withColumn("Archetype", F.when(T.trimmed("Archetype") == "", "Unknown").otherwise(known("Archetype")))


def presence_matrix(history: DataFrame, key: str = "Deck", top: int = 10) -> DataFrame:
    """Date, key and 100 or 0: whether one of the `top` keys by entries was there."""
    keys = history.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(top).select(key)
    days = history.select("EventDate").distinct()
    there = history.join(F.broadcast(keys), key, "left_semi").select("EventDate", key).distinct().withColumn("Present", F.lit(100))
    grid = days.crossJoin(F.broadcast(keys))  # `top` keys for each date
    return grid.join(there, ["EventDate", key], "left").withColumn("Present", F.coalesce("Present", F.lit(0)))
