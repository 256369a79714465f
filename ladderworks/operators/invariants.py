"""What statistics must satisfy before they are published: tables of rules, each evaluated in one aggregation by its grain.

Violations are rows (check_id, severity, key, detail). `hard` ones withhold the tables, `fatal` ones say that the tables were
put together wrongly, `warn` ones are told. A rule whose condition is null doesn't fire.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.operators.presence import SUMMED

#: Entries of an event, the places that count as the top, and the fewest events at which equal shares mean anything.
SIZE, TOP, FEW_EVENTS = 32, 8, 6
#: Columns that must vary over a table of three rows or more, and those that are shares of the events.
VARY = ("AvgPlace", "BestPlace", "Top8Count", "Top16Count", "WinnerCount", "PresencePct", "Top32EventFreqPct", "Top8EventFreqPct", "Top16EventFreqPct", "WinnerEventFreqPct", "Top8Rate", "Top16Rate", "WinnerRate")
EVENT_SHARES = ("PresencePct", "Top32EventFreqPct", "Top8EventFreqPct", "Top16EventFreqPct", "WinnerEventFreqPct")


@dataclass(frozen=True)
class Rule:
    """Fires where `broken` is true; `detail` says what was found."""

    check: str
    broken: Column
    detail: Column
    severity: str = "hard"


def fired(rows: DataFrame, key: Column, *rules: Rule) -> DataFrame:
    """The violations of all rules in one pass over `rows`."""
    each = [F.when(r.broken, F.struct(F.lit(r.check).alias("check_id"), F.lit(r.severity).alias("severity"), key.cast("string").alias("key"), r.detail.cast("string").alias("detail"))) for r in rules]
    return rows.select(F.explode(F.array_compact(F.array(*each))).alias("v")).select("v.*")


def _listed(*columns: str | Column) -> Column:
    return F.concat_ws("/", *(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns))


def event_rules(history: DataFrame, premier: DataFrame | None = None, size: int = SIZE) -> DataFrame:
    """By event: one date, one tier, `size` rows, places 1 to `size` once each, one name for each login, no premier event.

    Rows are dealt out by event once, then grouped by event and login and by event; places are held as bits, so nothing is
    listed or counted apart.
    """
    if not 1 <= size <= 62:
        raise ValueError("an event has from 1 to 62 places")
    bit = F.when(F.col("Place").between(1, size), F.expr("shiftleft(1L, cast(Place - 1 as int))"))
    ends = [f(c).alias(f"{n}_{c}") for c in ("EventDate", "Tier") for n, f in (("min", F.min), ("max", F.max))]
    rows = history.where("EventID IS NOT NULL").select("EventID", "LoginID", "EventDate", "Tier", "Place", "Pilot").repartition("EventID")
    logins = rows.groupBy("EventID", "LoginID").agg(*ends, F.count("*").alias("rows"), F.count("Place").alias("placed"), F.bit_or(bit).alias("bits"), F.min("Pilot").alias("name"), F.max("Pilot").alias("other"))
    named = (T.trimmed("LoginID") != "") & (F.col("name") != F.col("other"))
    ends = [f(f"{n}_{c}").alias(f"{n}_{c}") for c in ("EventDate", "Tier") for n, f in (("min", F.min), ("max", F.max))]
    events = logins.groupBy("EventID").agg(*ends, F.sum("rows").alias("rows"), F.sum("placed").alias("placed"), F.bit_or("bits").alias("bits"), F.count_if(named).alias("renamed"))
    if premier is None:
        events = events.withColumn("premier", F.lit(False))
    else:
        events = events.join(premier.select("EventID").distinct().withColumn("premier", F.lit(True)), "EventID", "left")
    full = F.coalesce(F.col("bits") == (1 << size) - 1, F.lit(False)) & (F.col("placed") == size)
    return fired(
        events, F.col("EventID"),
        Rule("one_date", F.col("min_EventDate") != F.col("max_EventDate"), _listed("min_EventDate", "max_EventDate")),
        Rule("one_tier", F.col("min_Tier") != F.col("max_Tier"), _listed("min_Tier", "max_Tier")),
        Rule("rows", F.col("rows") != size, F.col("rows")),
        Rule("places", ~full, _listed("placed", F.bit_count(F.coalesce("bits", F.lit(0).cast("long"))))),
        Rule("one_name", F.col("renamed") > 0, F.col("renamed")),
        Rule("no_premier", F.col("premier"), F.lit("premier event")),
    )


def _flat(columns: list[str], few: Column) -> list[Rule]:
    """A rule for each column that has one value only, or zero, over three rows or more."""
    same = lambda c: (F.col("table_rows") >= 3) & (F.col(f"low_{c}") == F.col(f"high_{c}"))
    zero = lambda c: F.when(F.col(f"low_{c}") == 0, "zero").otherwise("constant")
    return [Rule("degenerate", same(c) & ~(few & F.lit(c in EVENT_SHARES)), F.concat(F.lit(f"{c} "), zero(c))) for c in columns]


def _ends(columns: list[str]) -> list[Column]:
    return [F.count("*").alias("table_rows"), *(f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max)))]


def presence_rules(table: DataFrame, history: DataFrame, key: str = "Deck", size: int = SIZE) -> DataFrame:
    """By tier and key, and by tier: a presence table beside the history that it was made from.

    Each row: counts of events and of entries fall with the place, shares of events are counts over the tier's events, pilots
    fit the entries, entries are the history's rows. Each tier: winners, winner events, top eights and entries are what its
    events have. Columns vary.
    """
    events = history.groupBy(T.trimmed("Tier").alias("_tier")).agg(F.countDistinct("EventID").alias("n"))
    entries = history.where(F.col(key).isNotNull()).groupBy(T.trimmed("Tier").alias("_tier"), F.col(key).alias("_key")).agg(F.count("*").alias("entries"))
    both = table.join(entries, (F.col("Tier") == F.col("_tier")) & (F.col(key) == F.col("_key")), "full").withColumns({"_tier": F.coalesce("Tier", "_tier"), "_key": F.coalesce(key, "_key")})
    both = both.join(events, "_tier", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    name, share = F.concat_ws(":", F.lit(key), "_tier", "_key"), F.col("TopPilotShare")
    off = lambda pct, count: (F.col("n") > 0) & (F.abs(F.col(pct) - F.col(count) / F.col("n") * 100) > 0.01)
    falls = lambda *columns: reduce(Column.__or__, [F.col(a) < F.col(b) for a, b in zip(columns, columns[1:], strict=False)])
    rows = fired(
        both, name,
        Rule("events_fall", falls("n", "Top32EventCount", "Top8EventCount", "WinnerEventCount"), _listed("n", "Top32EventCount", "Top8EventCount", "WinnerEventCount")),
        Rule("entries_fall", falls("Top32EntryCount", "Top8Count", "WinnerCount"), _listed("Top32EntryCount", "Top8Count", "WinnerCount")),
        Rule("pilots", F.col("DistinctPilots") > F.col("Top32EntryCount"), _listed("DistinctPilots", "Top32EntryCount")),
        Rule("pilot_share", (share < 0) | (share > 1), share),
        Rule("one_pilot", (F.col("DistinctPilots") == 1) != (share == 1), _listed("DistinctPilots", "TopPilotShare")),
        Rule("pilot_entries", F.col("entries").isNotNull() & ~F.col("Top32EntryCount").eqNullSafe(F.col("entries")), _listed(F.coalesce("Top32EntryCount", F.lit(-1)), "entries")),
        *(Rule("percent_grid", off(pct, count), F.lit(pct)) for pct, count in (("Top32EventFreqPct", "Top32EventCount"), ("Top8EventFreqPct", "Top8EventCount"), ("WinnerEventFreqPct", "WinnerEventCount"))),
    )
    vary = [c for c in VARY if c in table.columns]
    sums = both.where(F.col(key).isNotNull()).groupBy("_tier").agg(*(F.sum(c).alias(f"sum_{c}") for c in ("WinnerCount", "WinnerEventCount", "Top32EntryCount", "Top8Count")), *_ends(vary), F.first("n").alias("n"))
    due = lambda check, c, k: Rule(check, F.col(f"sum_{c}") != k * F.col("n"), _listed(f"sum_{c}", k * F.col("n")))
    tiers = fired(
        sums, F.concat_ws(":", F.lit(key), "_tier"),
        due("sum_winners", "WinnerCount", 1), due("sum_winner_events", "WinnerEventCount", 1), due("sum_entries", "Top32EntryCount", size), due("sum_top8", "Top8Count", min(size, TOP)),
        *_flat(vary, F.col("n") < FEW_EVENTS),
    )
    return rows.unionByName(tiers)


def all_rules(total: DataFrame, table: DataFrame, history: DataFrame, key: str = "Deck") -> DataFrame:
    """The ALL table: its columns vary, its counts are the tiers' sums (told only), and the tiers' events are all events."""
    counts, vary = [c for c in SUMMED if c in total.columns and c in table.columns], [c for c in VARY if c in total.columns]
    events = history.groupBy("EventID").agg(F.count_distinct("Tier").alias("tiers")).agg(F.count("EventID").alias("n_all"), F.coalesce(F.sum("tiers"), F.lit(0)).alias("n_tiers"))
    sums = table.agg(*(F.sum(c).alias(f"tiers_{c}") for c in counts))
    one = total.agg(*(F.sum(c).alias(f"all_{c}") for c in counts), *_ends(vary)).join(sums, F.lit(True)).join(events, F.lit(True))  # a row each
    told = [Rule("all_sums", ~F.col(f"all_{c}").eqNullSafe(F.col(f"tiers_{c}")), F.concat(F.lit(f"{c} "), _listed(F.coalesce(f"all_{c}", F.lit(0)), F.coalesce(f"tiers_{c}", F.lit(0)))), "warn") for c in counts]
    return fired(one, F.lit(f"{key}:ALL"), Rule("all_events", F.col("n_all") != F.col("n_tiers"), _listed("n_all", "n_tiers")), *told, *_flat(vary, F.col("n_all") < FEW_EVENTS))


def pilot_rules(pilots: DataFrame, table: DataFrame, history: DataFrame, size: int = SIZE) -> DataFrame:
    """The table of pilots: wins, top eights and entries fall, their sums are what all events have, and the winners of the
    history by deck are the winners of the tiers' tables. No pilots, no violation of the sums."""
    rows = fired(pilots, F.concat_ws(":", "Pilot", "LoginID"), Rule("pilot_falls", (F.col("Wins") > F.col("Top8")) | (F.col("Top8") > F.col("Top32")), _listed("Wins", "Top8", "Top32")))
    sums = pilots.agg(*(F.sum(c).alias(c) for c in ("Wins", "Top8", "Top32"))).join(history.agg(F.count_distinct("EventID").alias("n")), F.lit(True))  # a row each
    due = [Rule("pilot_sums", F.col(c) != k * F.col("n"), F.concat(F.lit(f"{c} "), _listed(c, k * F.col("n")))) for c, k in (("Wins", 1), ("Top8", min(size, TOP)), ("Top32", size))]
    won = history.where("Place = 1 AND Deck IS NOT NULL").groupBy("Deck").agg(F.count("*").alias("won"))
    told = table.groupBy("Deck").agg(F.sum("WinnerCount").alias("told"))
    decks = won.join(told, "Deck", "left").join(pilots.limit(1).select(F.lit(1).alias("_any")), F.lit(True))
    wins = fired(decks, F.col("Deck"), Rule("wins_by_deck", F.col("won") != F.coalesce("told", F.lit(0)), _listed("won", F.coalesce("told", F.lit(0)))))
    return reduce(DataFrame.unionByName, [rows, fired(sums, F.lit("pilots"), *due), wins])


def finals_rules(table: DataFrame, finalists: DataFrame, history: DataFrame, key: str = "Deck", size: int = SIZE) -> DataFrame:
    """The columns of the first two and four, all `fatal`: sums over the tiers, counts that fall, a final for each event."""
    name = F.concat_ws(":", F.lit(key), "Tier", key)
    falls = lambda *columns: reduce(Column.__or__, [F.col(a) < F.col(b) for a, b in zip(columns, columns[1:], strict=False)])
    entries, events = ("Top32EntryCount", "Top8Count", "Top4Count", "Top2Count", "WinnerCount"), ("Top32EventCount", "Top8EventCount", "Top4EventCount", "Top2EventCount", "WinnerEventCount")
    rows = fired(table, name, Rule("finals_entries", falls(*entries), _listed(*entries), "fatal"), Rule("finals_events", falls(*events), _listed(*events), "fatal"))
    one = table.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("WinnerCount", "Top2Count", "Top4Count", "Top8Count", "Top2EventCount")))
    one = one.join(history.agg(F.count_distinct("EventID").alias("n")), F.lit(True)).join(finalists.agg(F.count("*").alias("finals")), F.lit(True))  # a row each
    due = [Rule("finals_sum", F.col(c) != min(k, size) * F.col("n"), F.concat(F.lit(f"{c} "), _listed(c, min(k, size) * F.col("n"))), "fatal") for c, k in (("WinnerCount", 1), ("Top2Count", 2), ("Top4Count", 4), ("Top8Count", TOP))]
    more = [Rule("finals_rows", F.col("finals") != F.col("n"), _listed("finals", "n"), "fatal")]
    if key == "Deck":  # a final between two of one deck counts once
        more.append(Rule("finals_decks", ~F.col("Top2EventCount").between(F.col("n"), 2 * F.col("n")), _listed("Top2EventCount", "n"), "fatal"))
    return rows.unionByName(fired(one, F.lit(f"{key}:finals"), *due, *more))
