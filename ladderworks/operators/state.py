"""Changes of stored tables as functions of what is there and what is new; a sink writes the result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.functions.scoring import rounded, trend_label
from ladderworks.operators.metagame import DECK_TREND
from ladderworks.operators.ranking import ranks
from ladderworks.operators.rules import last_by_key

SENTINEL = "NEEDS_MANUAL_REVIEW"
RESULT = ("EventID", "Pilot")


def sync_window(existing: DataFrame, fresh: DataFrame, format_name: str, start: str, end: str) -> DataFrame:
    """History after a window was read again: events that were read replace their rows, all others stay.

    A deck that was resolved before stays with its event and pilot. An empty `fresh` changes nothing.
    """
    scope = (T.normalize_name("Format") == T.normalize_name(F.lit(format_name))) & F.col("EventDate").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return replace_again(existing, fresh, scope)


def replace_again(existing: DataFrame, fresh: DataFrame, scope: Column | None = None) -> DataFrame:
    """Rows of the events that were read again (within `scope`) give way to the fresh ones, but for decks resolved before."""
    ids = fresh.select("EventID").distinct().withColumn("_again", F.lit(True))
    drop = F.col("_again") if scope is None else scope & F.col("_again")
    marked = existing.join(ids, "EventID", "left").withColumn("_drop", F.coalesce(drop, F.lit(False))).drop("_again")
    sticky = marked.where(F.col("_drop") & (F.col("Deck") != SENTINEL)).groupBy(*RESULT).agg(F.max(F.struct("Deck", "Archetype")).alias("_s"))
    new = fresh.join(sticky, list(RESULT), "left").withColumns({c: F.coalesce(F.col(f"_s.{c}"), F.col(c)) for c in ("Deck", "Archetype")}).drop("_s")
    return marked.where(~F.col("_drop")).drop("_drop").unionByName(new.select(*existing.columns))


def replace_event(existing: DataFrame, event: DataFrame, key: str = "EventSlug") -> DataFrame:
    """Appends an event; rows that have one of its keys go first."""
    return existing.join(event.select(key).distinct(), key, "left_anti").unionByName(event)


def replace_week(history: DataFrame, decks: DataFrame, archetypes: DataFrame, week: int) -> DataFrame:
    """Share history with a week's rows replaced by its decks and archetypes."""
    return history.where(F.col("WeekIndex") != week).unionByName(decks.unionByName(archetypes).select(*history.columns))


def numbered_weeks(weeks: DataFrame) -> DataFrame:
    """Weeks of a rebuilt history, numbered from 1 by start and end."""
    return weeks.select("WeekStart", "WeekEnd").distinct().withColumn("WeekIndex", F.row_number().over(Window.orderBy("WeekStart", "WeekEnd")))


def rebuilt_shares(runs: DataFrame, decks: DataFrame, threshold: float = DECK_TREND) -> DataFrame:
    """Share history from all runs in one job: decks and archetypes of each week with the week's number and trend.

    `runs` has path, week_start and week_end of every run folder; they are numbered in order, also those that have no decks
    and so are skipped. `decks` has path, Deck, Archetype and Meta. A deck's trend is against the mean of the last four rows
    of its name in earlier weeks, among which an archetype of the same name counts; without any, and for archetypes, it is
    Stable. That is what adding week after week to an empty history gives.
    """
    weeks = ranks(runs, F.col("week_start"), F.col("week_end"), F.col("path"), name="WeekIndex").select("path", F.col("week_start").alias("WeekStart"), F.col("week_end").alias("WeekEnd"), "WeekIndex")
    own = decks.select("path", "Deck", "Meta", F.lit("Deck").alias("Level"))
    groups = decks.groupBy("path", F.col("Archetype").alias("Deck")).agg(rounded(F.sum("Meta"), 6).alias("Meta")).withColumn("Level", F.lit("Archetype"))
    rows = own.unionByName(groups.select(own.columns)).join(weeks, "path")
    # By number, the weeks before end one below; an archetype follows the decks of its week.
    before = Window.partitionBy("Deck").orderBy("WeekIndex", F.col("Level") == "Archetype").rowsBetween(-4, -1)
    past = F.avg("Meta").over(before)
    label = F.when(F.col("Level") == "Deck", trend_label(F.col("Meta"), F.coalesce("_past", "Meta"), threshold)).otherwise("Stable")
    return rows.withColumn("_past", past).withColumn("Trend Label", label).drop("_past", "path")


def rebuild(files: DataFrame) -> DataFrame:
    """History from event files (ordinal, EventID, EventDate, Tier, Place and more): of equal keys the last row counts.

    Files without an event id are left out where one with an id has the same date and tier.
    """
    known = files.where("EventID <> ''").select("EventDate", "Tier").distinct()
    rows = files.where("EventID <> ''").unionByName(files.where("EventID = ''").join(known, ["EventDate", "Tier"], "left_anti"))
    return last_by_key(rows, F.struct("EventID", "EventDate", "Tier", "Place"))


def upsert(existing: DataFrame, changes: DataFrame, *keys: str) -> DataFrame:
    """Rows of `existing` without those whose keys are in `changes`, and the changes."""
    return existing.join(changes.select(*keys).distinct(), list(keys), "left_anti").unionByName(changes.select(*existing.columns))


def upsert_rules(rules: DataFrame, queued: DataFrame, target: str) -> DataFrame:
    """A rule table after queued edits: by pattern and match type the last edit wins; blank ones are skipped."""
    key = F.struct(T.normalize_name("pattern").alias("p"), F.lower(T.trimmed("match_type")).alias("m"))
    edits = last_by_key(queued.where((T.trimmed("pattern") != "") & (T.trimmed(target) != "")), key).withColumn("_k", key)
    stay = rules.withColumn("_k", key).join(edits.select("_k"), "_k", "left_anti")
    return stay.select(*rules.columns).unionByName(edits.select(*rules.columns))


def upsert_mappings(mappings: DataFrame, queued: DataFrame) -> DataFrame:
    """Saved mappings after queued edits: by raw name the last edit wins; blank ones are skipped."""
    key = T.normalize_name("raw_name")
    edits = last_by_key(queued.where((T.trimmed("raw_name") != "") & (T.trimmed("canonical_name") != "")), key).withColumn("_k", key)
    return mappings.withColumn("_k", key).join(edits.select("_k"), "_k", "left_anti").select(*mappings.columns).unionByName(edits.select(*mappings.columns))


def add_missing_mappings(mappings: DataFrame, queued: DataFrame) -> DataFrame:
    """Saved mappings after edits of an older week: only raw names that aren't there yet are added."""
    key = T.normalize_name("raw_name")
    new = last_by_key(queued, key).withColumn("_k", key).join(mappings.select(key.alias("_k")), "_k", "left_anti")
    return mappings.unionByName(new.select(*mappings.columns))


def remove_mapping(mappings: DataFrame, raw_name: str) -> DataFrame:
    """Saved mappings without a raw name."""
    return mappings.where(T.normalize_name("raw_name") != T.normalize_name(F.lit(raw_name)))


def catalog(*labels: DataFrame) -> DataFrame:
    """Distinct archetypes (ordinal, archetype) of some tables: of those that differ in case the first."""
    rows = reduce(DataFrame.unionByName, [t.select("ordinal", T.trimmed("archetype").alias("archetype")) for t in labels]).where("archetype <> ''")
    return last_by_key(rows, T.normalize_name("archetype"), last=False)


def replace_archetype(rows: DataFrame, old: str, new: str, col: str = "archetype") -> DataFrame:
    """Rows with an archetype that is removed take the new one; Unknown can't be removed."""
    if old.strip().lower() == "unknown":
        raise ValueError("Unknown can't be removed")
    return rows.withColumn(col, F.when(T.normalize_name(col) == T.normalize_name(F.lit(old)), new).otherwise(F.col(col)))


def save_assignments(rows: DataFrame, rules: DataFrame, assignments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and archetype rules after decks of unknown archetype were assigned one (ordinal, deck, archetype).

    Each assignment that says something becomes an exact rule of priority 1, and the rows of its deck are changed at once.
    """
    said = assignments.where((T.trimmed("deck") != "") & ~F.lower(T.trimmed("archetype")).isin("", "unknown"))
    queued = said.select(T.trimmed("deck").alias("pattern"), T.trimmed("archetype").alias("target"), F.lit("exact").alias("match_type"), F.lit(1).alias("priority"), "ordinal")
    return assign_unknown(rows, said), upsert_rules(rules, queued, "target")


def relabel(rows: DataFrame, hits: DataFrame, archetype: str, mappings: DataFrame, aliases: DataFrame, rules: DataFrame, limit: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """An archetype for all rows that were found (ordinal, raw_deck, Deck): the stored rows, mappings, aliases and rules after it.

    Each raw name that was found is mapped to its deck and the archetype, by an exact alias and exact rules of priority 1 for
    both names; then stored rows follow, in weeks up to `limit` or in all (see `propagate`). Rows that lack a name are passed over.
    """
    found = hits.select("ordinal", T.trimmed("raw_deck").alias("raw_name"), T.trimmed("Deck").alias("canonical_name"), F.lit(archetype.strip()).alias("archetype"))
    found = found.where("raw_name <> '' AND canonical_name <> '' AND archetype <> ''")
    rule = lambda pattern, target: found.select(F.col(pattern).alias("pattern"), F.col(target).alias("target"), F.lit("exact").alias("match_type"), F.lit(1).alias("priority"), "ordinal")
    changes = last_by_key(found, T.normalize_name("raw_name"))
    return (
        propagate(rows, changes, limit), upsert_mappings(mappings, found),
        upsert_rules(aliases, rule("raw_name", "canonical_name"), "target"), upsert_rules(rules, rule("raw_name", "archetype").unionByName(rule("canonical_name", "archetype")), "target"),
    )


def assign_unknown(rows: DataFrame, assignments: DataFrame) -> DataFrame:
    """Archetypes of decks from a table (ordinal, deck, archetype), by the lower-case name; of equal names the last counts."""
    last = last_by_key(assignments, F.lower(F.trim("deck")))
    table = last.select(F.lower(F.trim("deck")).alias("_d"), F.col("archetype").alias("_a"))
    return rows.join(table, F.lower(F.trim("Deck")) == F.col("_d"), "left").withColumn("Archetype", F.coalesce("_a", "Archetype")).drop("_d", "_a")


def propagate(rows: DataFrame, changes: DataFrame, limit: Column | None = None) -> DataFrame:
    """Stored rows (row_id, source_names, Deck, Archetype, week_end) after relabelling: the first source name with a change decides.

    `changes` has raw_name, canonical_name, archetype. Weeks after `limit` stay as they are.
    """
    table = changes.select(T.normalize_name("raw_name").alias("_k"), "canonical_name", "archetype")
    open_ = rows if limit is None else rows.where(F.col("week_end") <= limit)
    hit = open_.select("row_id", F.posexplode(T.source_names("source_names")).alias("_p", "_n")).join(table, T.normalize_name("_n") == F.col("_k"))
    first = hit.groupBy("row_id").agg(F.min_by(F.struct("canonical_name", "archetype"), F.struct("_p", "canonical_name")).alias("_c"))
    return rows.join(first, "row_id", "left").withColumns({"Deck": F.coalesce("_c.canonical_name", "Deck"), "Archetype": F.coalesce("_c.archetype", "Archetype")}).drop("_c")


def apply_review(history: DataFrame, resolved: DataFrame) -> DataFrame:
    """The outcome of each resolved item (EventID, Pilot, resolved_deck): updated, not_found or ambiguous."""
    counts = history.groupBy(*RESULT).agg(F.count("*").alias("n"))
    found = resolved.join(counts, list(RESULT), "left")
    return found.select(*RESULT, "resolved_deck", F.when(F.col("n").isNull(), "not_found").when(F.col("n") > 1, "ambiguous").otherwise("updated").alias("outcome"))


def reviewed(history: DataFrame, resolved: DataFrame) -> DataFrame:
    """History after the review: unambiguous items get their deck."""
    good = apply_review(history, resolved).where("outcome = 'updated'").select(*RESULT, "resolved_deck")
    return history.join(good, list(RESULT), "left").withColumn("Deck", F.coalesce("resolved_deck", "Deck")).drop("resolved_deck")


def review_reasons(rows: DataFrame, known: DataFrame, prior: DataFrame, handled: DataFrame) -> DataFrame:
    """Rows (raw_deck, deck, archetype) that need a look, with reasons: short, unknown or uncatalogued, first seen.

    `known` has archetype, `prior` raw_deck and deck of earlier weeks, `handled` raw_name of saved mappings.
    """
    key = lambda c: T.normalize_name(c)
    has = lambda t, c, out: t.select(key(c).alias(out)).where(f"{out} <> ''").distinct().withColumn(f"_{out}", F.lit(True))
    out = rows.join(has(known, "archetype", "a"), key("archetype") == F.col("a"), "left").join(has(prior, "raw_deck", "r"), key("raw_deck") == F.col("r"), "left").join(has(prior, "deck", "d"), key("deck") == F.col("d"), "left")
    short = lambda c: (F.length(T.trimmed(c)) > 0) & (F.length(T.trimmed(c)) < 4)
    said = [F.when(short("raw_deck"), "Short Raw Name"), F.when(short("deck"), "Short Deck Name"), F.when(T.is_unknown("archetype"), "Unknown Archetype").when(F.col("_a").isNull(), "Non-catalog Archetype"), F.when((T.trimmed("raw_deck") != "") & F.col("_r").isNull(), "First Seen Raw"), F.when((T.trimmed("deck") != "") & F.col("_d").isNull(), "First Seen Deck")]
    done = out.join(handled.select(key("raw_name").alias("_h")).distinct(), key("raw_deck") == F.col("_h"), "left_anti")
    return done.select("raw_deck", "deck", "archetype", F.array_join(F.array_compact(F.array(*said)), ", ").alias("reason")).where("reason <> ''")


def bulk_relabel(rows: DataFrame, query: str, archetype: str) -> DataFrame:
    """Rows whose deck, raw name or archetype holds the query get the archetype."""
    return rows.withColumn("Archetype", F.when(matches(query), archetype).otherwise(F.col("Archetype")))


def matches(query: str, columns: tuple[str, ...] = ("Deck", "RawDeck", "Archetype")) -> Column:
    """Whether one of the columns holds the query, whatever its case."""
    return reduce(Column.__or__, [F.contains(F.lower(T.text_of(c)), F.lit(query.strip().lower())) for c in columns])


def search(rows: DataFrame, query: str, archetype: str | None = None, limit: int = 500) -> DataFrame:
    """The first rows (by ordinal) that hold the query and, if one is given, are of the archetype; none if neither is given."""
    found = rows.where(matches(query) if query.strip() or archetype else F.lit(False))
    return (found if archetype is None else found.where(T.normalize_name("Archetype") == T.normalize_name(F.lit(archetype)))).orderBy("ordinal").limit(limit)


def rescan(unresolved: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored rows after another classification (EventID, Pilot, label) of those that wait for review."""
    found = labels.where(F.col("label") != SENTINEL).select(*RESULT, "label")
    return unresolved.join(found, list(RESULT), "left").withColumn("Deck", F.when(F.col("Deck") == SENTINEL, F.coalesce("label", "Deck")).otherwise(F.col("Deck"))).drop("label")
