"""Checks of tables before they are published. Each gives rows (check_id, severity, key, detail), none if all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.functions.scoring import reachable_score
from ladderworks.operators.invariants import Rule, fired

COLUMNS = ("check_id", "severity", "key", "detail")
#: Pairs of seeds that meet in the first round.
SEEDS = ((1, 8), (4, 5), (2, 7), (3, 6))


def violations(rows: DataFrame, check: str, key: Column, detail: Column, severity: str = "hard") -> DataFrame:
    """Rows as violations of one check."""
    return rows.select(F.lit(check).alias("check_id"), F.lit(severity).alias("severity"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def union(*checks: DataFrame) -> DataFrame:
    """All violations."""
    return reduce(DataFrame.unionByName, checks)


def assert_clean(found: DataFrame, show: int = 5) -> None:
    """Raises if there is a hard violation; a few of them are shown."""
    bad = found.where("severity = 'hard'").limit(show).collect()
    if bad:
        raise AssertionError("; ".join(f"{r.check_id} {r.key}: {r.detail}" for r in bad))


def event_checks(history: DataFrame, size: int = 32) -> DataFrame:
    """Each event has one date, one tier, places 1 to `size` once each, and no login with two names. One aggregation."""
    place, key = F.col("Place"), F.col("EventID")
    different = lambda c: F.size(F.collect_set(c))  # noqa: E731  a few values an event; distinct counts would multiply the rows
    stats = history.groupBy("EventID").agg(different("EventDate").alias("dates"), different("Tier").alias("tiers"), F.count("*").alias("rows"), different("Place").alias("places"), F.min(place).alias("low"), F.max(place).alias("high"))
    names = history.where(T.trimmed("LoginID") != "").groupBy("EventID", "LoginID").agg(F.countDistinct("Pilot").alias("n")).where("n > 1")
    broken = (
        (F.col("dates") != 1, "one_date", F.col("dates")),
        (F.col("tiers") != 1, "one_tier", F.col("tiers")),
        (F.col("rows") != size, "rows", F.col("rows")),
        ((F.col("places") != F.col("rows")) | (F.col("low") != 1) | (F.col("high") != F.col("rows")), "places", F.concat_ws("/", "places", "low", "high")),
    )
    each = [F.when(cond, F.struct(F.lit(check).alias("check_id"), F.lit("hard").alias("severity"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))) for cond, check, detail in broken]
    return union(stats.select(F.inline(F.array_compact(F.array(*each)))), violations(names, "one_name", F.concat_ws(":", "EventID", "LoginID"), F.col("n")))


def no_premier(history: DataFrame, premier: DataFrame) -> DataFrame:
    """No event of the history is a premier one."""
    return violations(history.select("EventID").distinct().join(premier.select("EventID"), "EventID", "left_semi"), "no_premier", F.col("EventID"), F.lit("premier event"))


def presence_checks(table: DataFrame, key: str = "Deck") -> DataFrame:
    """Of a presence table: counts fall with the place, shares agree with counts, the sums over a tier agree with its events."""
    name = F.concat_ws(":", "Tier", key)
    falls = [F.col(a) < F.col(b) for a, b in (("Appearances", "Top16Count"), ("Top16Count", "Top8Count"), ("Top8Count", "Top4Count"), ("Top4Count", "Top2Count"), ("Top2Count", "WinnerCount"), ("Appearances", "Events"))]
    grid = F.abs(F.col("PresencePct") - F.col("Events") / F.col("n_events") * 100) > 0.01
    sums = table.groupBy("Tier").agg(F.sum("WinnerCount").alias("w"), F.sum("Top2Count").alias("t2"), F.sum("Top4Count").alias("t4"), F.sum("Top8Count").alias("t8"), F.first("n_events").alias("n"))
    return union(
        violations(table.where(reduce(Column.__or__, falls)), "monotone", name, F.concat_ws("/", "Appearances", "Top16Count", "Top8Count", "Top4Count", "Top2Count", "WinnerCount")),
        violations(table.where(grid), "percent_grid", name, F.col("PresencePct")),
        violations(table.where((F.col("DistinctPilots") > F.col("Appearances")) | (F.col("TopPilotShare") > 1)), "pilots", name, F.col("DistinctPilots")),
        violations(sums.where("w <> n OR t2 > 2 * n OR t4 > 4 * n OR t8 > 8 * n"), "tier_sums", F.col("Tier"), F.concat_ws("/", "w", "t2", "t4", "t8", "n")),
    )


def all_tier_checks(total: DataFrame, tables: DataFrame, key: str = "Deck") -> DataFrame:
    """The ALL table has the sums of the tiers."""
    sums = tables.groupBy(key).agg(F.sum("Appearances").alias("a"), F.sum("WinnerCount").alias("w"))
    off = total.join(sums, key, "full").where("NOT (coalesce(Appearances, 0) = coalesce(a, 0) AND coalesce(WinnerCount, 0) = coalesce(w, 0))")
    return violations(off, "all_sums", F.col(key), F.concat_ws("/", "Appearances", "a"))


def degenerate(table: DataFrame, columns: tuple[str, ...], least: int = 3) -> DataFrame:
    """Number columns that are constant or zero in a table of at least `least` rows."""
    one = table.agg(F.count("*").alias("n"), *(F.struct(F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c) for c in columns))
    rows = one.select("n", F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(f"`{c}`.low").alias("low"), F.col(f"`{c}`.high").alias("high")) for c in columns))).alias("c")).select("n", "c.*")
    return violations(rows.where((F.col("n") >= least) & (F.col("low") == F.col("high"))), "degenerate", F.col("name"), F.col("low"))


def league_checks(results: DataFrame, table: DataFrame, per_event: int = 31) -> DataFrame:
    """Points per event, repeated places, mixed classes, and the table's sums and points formula."""
    events = results.groupBy("EventID").agg(F.sum("LeaguePoints").alias("points"), F.countDistinct("EventClass").alias("classes"), F.count("*").alias("rows"), F.countDistinct("Place").alias("places"), F.first("EventClass").alias("class"))
    due = F.when(F.col("class") == "Premier", 2 * per_event).otherwise(per_event)
    challenge = F.col("Points") - F.col("PremierPoints")
    formula = 5 * F.col("Wins") + 4 * (F.col("Top2") - F.col("Wins")) + 3 * (F.col("Top4") - F.col("Top2")) + 2 * (F.col("Top8") - F.col("Top4")) + (F.col("Top16") - F.col("Top8"))
    total = results.agg(F.sum("LeaguePoints").alias("a")).crossJoin(table.agg(F.sum("Points").alias("b")))
    return union(
        violations(events.where(F.col("points") != due), "event_points", F.col("EventID"), F.col("points")),
        violations(events.where("classes > 1"), "mixed_class", F.col("EventID"), F.col("classes")),
        violations(events.where("places <> rows"), "repeated_place", F.col("EventID"), F.col("places")),
        violations(total.where("a <> b"), "season_sum", F.lit("season"), F.concat_ws("/", "a", "b")),
        violations(table.where((F.col("PremierPoints") == 0) & (challenge != formula)), "points_formula", F.col("Pilot"), F.col("Points")),
    )


def standings_checks(standings: DataFrame) -> DataFrame:
    """Ranks 1..n once each, and Swiss scores that the event's rounds can give (EventID, rank, score, rounds)."""
    shape = standings.groupBy("EventID").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"), F.max("rank").alias("m")).where("n <> d OR m <> n")
    score = standings.where(~reachable_score(F.col("score"), F.col("rounds")))
    return union(violations(shape, "standings_shape", F.col("EventID"), F.concat_ws("/", "n", "d", "m")), violations(score, "swiss_score", F.concat_ws(":", "EventID", "rank"), F.col("score"), "warn"))


def bracket_checks(matches: DataFrame, results: DataFrame) -> DataFrame:
    """Brackets beside the results, by event, in one aggregation of the matches with their players' places.

    Four, two and one match; if so, the first round has the first eight, the losers of the second are third and fourth, and
    first and second meet in the final. Where the matches have games, the winner has more; other scores than 2-0 and 2-1 are
    told. Where they have Swiss ranks, pairs of the first round other than SEEDS are told.
    """
    names = ("Winner", "Loser")
    ident = lambda s: T.identity_key(f"{s}LoginID", f"{s}Pilot") if s else T.identity_key("LoginID", "Pilot")
    top = results.where("Place BETWEEN 1 AND 8").groupBy("EventID", ident("").alias("id")).agg(F.min("Place").alias("Place"))
    rows = matches
    for s in names:
        of = top.select(F.col("EventID").alias("_e"), F.col("id").alias("_i"), F.col("Place").alias(f"{s}Place"))
        rows = rows.withColumn("_id", ident(s)).join(of, (F.col("EventID") == F.col("_e")) & (F.col("_id") == F.col("_i")), "left").drop("_id", "_e", "_i")
    at = lambda r: F.col("Round") == r
    bit = lambda c: F.expr(f"shiftleft(1, {c} - 1)")
    w, l = F.col("WinnerPlace"), F.col("LoserPlace")  # noqa: E741
    sums = [F.count_if(at(r)).alias(r) for r in ("QF", "SF", "F")]
    sums += [F.bit_or(F.when(at("QF"), bit("WinnerPlace"))).alias("_w"), F.bit_or(F.when(at("QF"), bit("LoserPlace"))).alias("_l"), F.count_if(at("QF") & (w.isNull() | l.isNull())).alias("_out")]
    sums += [F.bit_or(F.when(at("SF"), bit("LoserPlace"))).alias("_sf"), F.count_if(at("SF") & ~F.coalesce(l.isin(3, 4), F.lit(False))).alias("_sf_out"), F.max(F.when(at("F"), w)).alias("_first"), F.max(F.when(at("F"), l)).alias("_second")]
    games = {f"{s}Games" for s in names} <= set(matches.columns)
    if games:
        won, lost = (F.col(f"{s}Games").cast("string").try_cast("int") for s in names)
        sums += [F.count_if(~F.coalesce(won > lost, F.lit(False))).alias("_bad"), F.count_if((won > lost) & ~((won == 2) & (lost <= 1))).alias("_odd")]
    if seeds := {f"{s}SwissRank" for s in names} <= set(matches.columns):
        a, b = (F.col(f"{s}SwissRank").cast("string").try_cast("int") for s in names)
        pair = F.concat_ws("v", F.least(a, b), F.greatest(a, b))
        sums += [F.array_sort(F.collect_set(F.when(at("QF") & a.isNotNull() & b.isNotNull(), pair))).alias("_pairs")]  # four at most
    there = results.groupBy(F.col("EventID").alias("_e")).agg(F.coalesce(F.bit_or(F.when(F.col("Place").between(1, 8), bit("Place"))), F.lit(0)).alias("_top"))
    each = rows.groupBy("EventID").agg(*sums).join(there, F.col("EventID") == F.col("_e"), "left").na.fill(0, ["_w", "_l", "_sf", "_top"])
    whole = (F.col("QF") == 4) & (F.col("SF") == 2) & (F.col("F") == 1)
    seen, both = F.expr("_w | _l"), F.expr("_top & 12")
    rules = [
        Rule("bracket_shape", ~whole, F.concat_ws("/", "QF", "SF", "F")),
        Rule("bracket_top8", whole & ((F.col("_out") > 0) | (seen != F.col("_top"))), F.concat_ws("/", F.bit_count(seen), F.bit_count("_top"))),
        Rule("bracket_semifinal", whole & ((F.col("_sf_out") > 0) | (F.col("_sf") != both)), F.concat_ws("/", F.bit_count(F.expr("_sf & 12")), F.bit_count(both))),
        Rule("bracket_final", whole & ~(F.col("_first").eqNullSafe(1) & F.col("_second").eqNullSafe(2)), F.concat_ws("/", F.coalesce("_first", F.lit(0)), F.coalesce("_second", F.lit(0)))),
    ]
    if games:
        rules += [Rule("bracket_games", whole & (F.col("_bad") > 0), F.col("_bad")), Rule("bracket_score", whole & (F.col("_odd") > 0), F.col("_odd"), "warn")]
    if seeds:
        due = F.array(*(F.lit(f"{min(s)}v{max(s)}") for s in sorted(SEEDS)))
        rules.append(Rule("bracket_seeds", whole & (F.col("_pairs") != due), F.concat_ws(" ", "_pairs"), "warn"))
    return fired(each, F.col("EventID"), *rules)


def completeness(registry: DataFrame, fetched: DataFrame, kind: str = "challenge") -> DataFrame:
    """One row: events of the registry, of them fetched, and whether that is all. No registry gives null counts and no."""
    there = registry.where(F.col("kind") == kind).select("EventID").distinct()
    got = there.join(fetched.select("EventID").distinct(), "EventID", "left_semi").agg(F.count("*").alias("got"))
    both = there.agg(F.count("*").alias("n")).crossJoin(got)
    return both.select(F.when(F.col("n") > 0, F.col("n")).alias("registry_count"), F.when(F.col("n") > 0, F.col("got")).alias("fetched_count"), ((F.col("n") > 0) & (F.col("n") == F.col("got"))).alias("complete"))


def saved_mappings_check(expected: DataFrame, saved: DataFrame) -> DataFrame:
    """Every expected raw name is saved with the same target."""
    table = saved.select(T.normalize_name("raw_name").alias("_k"), F.col("canonical_name").alias("_c"))
    off = expected.join(table, T.normalize_name("raw_name") == F.col("_k"), "left").where("_c IS NULL OR _c <> canonical_name")
    return violations(off, "saved_mapping", F.col("raw_name"), F.coalesce("_c", F.lit("missing")))


def isolate(rows: DataFrame, found: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows with `columns` blank for events that have a hard violation; others aren't touched."""
    bad = found.where("severity = 'hard'").select(F.split("key", ":")[0].alias("EventID")).distinct().withColumn("_bad", F.lit(True))
    out = rows.join(bad, "EventID", "left")
    return out.withColumns({c: F.when(F.col("_bad").isNull(), F.col(c)) for c in columns}).drop("_bad")


def unknown_share(history: DataFrame) -> DataFrame:
    """Entries of unknown archetype, all entries, and the share."""
    return history.agg(F.count_if(T.is_unknown("Archetype")).alias("unknown"), F.count("*").alias("total")).withColumn("share", F.try_divide("unknown", "total"))


def unknown_rows(history: DataFrame) -> DataFrame:
    """The entries of unknown archetype."""
    return history.where(T.is_unknown("Archetype"))
