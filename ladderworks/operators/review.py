"""Entries that wait for review: labelled by hand, or by another look at a library that has grown meanwhile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.operators import rules as R
from ladderworks.operators import similarity as N
from ladderworks.operators.state import SENTINEL
from ladderworks.sources.scratch import cut


def relabelled(names: DataFrame, col: str, aliases: DataFrame, rules: DataFrame, mappings: DataFrame) -> DataFrame:
    """`names` with `_deck` and `_archetype` for the raw name in `col`: those of its saved mapping, else the canonical name by
    the alias rules; an archetype that the mapping lacks comes from the archetype rules for the deck."""
    mapped = R.with_mapping(names, mappings, col)
    named = R.canonical_names(mapped, aliases, col, "_canonical")
    deck = F.coalesce(F.nullif(T.trimmed("mapped_name"), F.lit("")), "_canonical")
    labelled = R.archetypes(named.withColumn("_deck", deck), rules, "_deck", "_ruled")
    known = F.when(T.trimmed("mapped_name") != "", F.nullif(T.trimmed("mapped_archetype"), F.lit("")))
    return labelled.withColumn("_archetype", F.coalesce(known, "_ruled")).drop("mapped_name", "mapped_archetype", "_canonical", "_ruled")


def apply_selections(history: DataFrame, selections: DataFrame, aliases: DataFrame, rules: DataFrame, mappings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The history after a review, and the outcome of each selection (ordinal, event_id, pilot, resolved_deck).

    An event and pilot that are once in the history get deck and archetype by the same rules as any other name; of several
    selections for one the last counts. Blank ones are skipped; `not_found` and `ambiguous` ones change nothing.
    """
    key = lambda e, p: (T.event_id(e).alias("_e"), T.trimmed(p).alias("_p"))
    there = history.groupBy(*key("EventID", "Pilot")).agg(F.count("*").alias("_n"))
    asked = selections.withColumns(dict(zip(("_e", "_p"), key("event_id", "pilot"), strict=True)))
    found = asked.join(there, ["_e", "_p"], "left")
    blank = T.trimmed("resolved_deck") == ""
    outcome = F.when(blank, "skipped").when(F.col("_n").isNull(), "not_found").when(F.col("_n") > 1, "ambiguous").otherwise("applied")
    found = found.withColumn("outcome", outcome)
    last = R.last_by_key(found.where("outcome = 'applied'").select("_e", "_p", "ordinal", T.trimmed("resolved_deck").alias("_raw")), F.struct("_e", "_p"))
    new = relabelled(last.select("_e", "_p", "_raw"), "_raw", aliases, rules, mappings).select("_e", "_p", "_deck", "_archetype")
    rows = history.withColumns(dict(zip(("_e", "_p"), key("EventID", "Pilot"), strict=True))).join(new, ["_e", "_p"], "left")
    rows = rows.withColumns({"Deck": F.coalesce("_deck", "Deck"), "Archetype": F.coalesce("_archetype", "Archetype")})
    return rows.select(*history.columns), found.select(*selections.columns, "outcome")


def _archetype_of(labels: DataFrame, rules: DataFrame, mappings: DataFrame) -> DataFrame:
    """`labels` (column label) with the archetype of the saved mapping for the label, else by the rules."""
    mapped = R.with_mapping(labels, mappings, "label")
    ruled = R.archetypes(mapped, rules, "label", "_ruled")
    return ruled.withColumn("Archetype", F.coalesce(F.nullif(T.trimmed("mapped_archetype"), F.lit("")), "_ruled")).drop("mapped_name", "mapped_archetype", "_ruled")


def rescan(history: DataFrame, cards: DataFrame, rules: DataFrame, mappings: DataFrame, *, rounds: int | None = 1, least: float = N.OTHERS) -> tuple[DataFrame, DataFrame, int]:
    """Another classification of all entries that wait for review: the history, what still waits with its reason, and the rounds.

    `history` has row_id, Place, Deck, Archetype; `cards` has row_id, item, qty for the entries whose decks are known, or one row for each
    as `similarity.packed` takes them. Every labelled entry with a deck is in the library. An entry gets the label of its two nearest if these agree and are near
    enough for its place, and the archetype of that label. With `rounds` None newly labelled entries join the library of the
    next round until nothing changes. From the second round on, only those entries are looked at again that the new ones are
    near to, or that have a near neighbour already: nothing else can have changed.
    """
    decks = cut(N.packed(cards, "row_id"))
    state = cut(history.select("row_id", "Place", F.col("Deck").alias("label")))
    open_ = cut(state.where(F.col("label") == SENTINEL).join(decks.select("row_id"), "row_id", "left_semi").select("row_id", "Place"))
    labelled = cut(state.where(F.col("label") != SENTINEL).select("row_id", "label"))
    waiting, new, done = None, None, 0
    while rounds is None or done < rounds:
        done += 1
        look = open_
        if new is not None:  # the second round and later
            own, keys = N.bags(decks.join(open_.select("row_id"), "row_id", "left_semi").withColumnRenamed("row_id", "deck_id"), "deck_id")
            fresh, _ = N.bags(decks.join(new.select("row_id"), "row_id", "left_semi").withColumnRenamed("row_id", "lib_id"), "lib_id")
            near = keys.join(N.similar_pairs(own, fresh, least).select("bag").distinct(), "bag", "left_semi").select(F.col("deck_id").alias("row_id"))
            look = cut(open_.join(near.unionByName(waiting.where("nearest IS NOT NULL").select("row_id")).distinct(), "row_id", "left_semi"))
        asked = decks.join(look.select("row_id"), "row_id", "left_semi").withColumnRenamed("row_id", "deck_id")
        library = decks.join(labelled, "row_id").withColumnRenamed("row_id", "lib_id")
        found = N.classified_at(N.labels_at(asked, library, least), look.withColumnRenamed("row_id", "deck_id"))
        found = cut(found.withColumnRenamed("deck_id", "row_id"))
        before, new = waiting, found.where("reason IS NULL").select("row_id", "label")
        left = found.where("reason IS NOT NULL")
        waiting = left if before is None else cut(left.unionByName(before.join(look.select("row_id"), "row_id", "left_anti")))
        if not new.take(1):
            break
        open_ = cut(open_.join(new, "row_id", "left_anti"))
        state = cut(state.join(new.withColumnRenamed("label", "_new"), "row_id", "left").withColumn("label", F.coalesce("_new", "label")).drop("_new"))
        labelled = cut(labelled.unionByName(new))
    told = state.join(history.where(F.col("Deck") == SENTINEL).select("row_id"), "row_id", "left_semi").where(F.col("label") != SENTINEL).select("row_id", "label")
    told = _archetype_of(told, rules, mappings).withColumnRenamed("Archetype", "_archetype")
    rows = history.join(told, "row_id", "left").withColumns({"Deck": F.coalesce("label", "Deck"), "Archetype": F.coalesce("_archetype", "Archetype")}).select(*history.columns)
    return rows, waiting, done


def review_queue(waiting: DataFrame, cards: DataFrame, entries: DataFrame) -> DataFrame:
    """What `rescan` leaves, as the table in which decks are filled in by hand (see `similarity.review_items`)."""
    named = waiting.withColumnRenamed("row_id", "deck_id")
    return N.review_items(named, N.key_items(cards.withColumnRenamed("row_id", "deck_id")), entries)


