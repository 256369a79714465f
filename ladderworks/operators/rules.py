"""Prioritised rule tables: names to canonical names, names to archetypes, raw names to saved mappings.

A rule table has `pattern`, a target, `match_type` (exact, contains, regex), `priority` and `ordinal` (its place in the
file). The first match by priority and ordinal decides. Exact rules are an equi-join on the normalised key. Contains rules
are one automaton over all their patterns, which reads each distinct name once; regex rules are only tried on names in
which the automaton finds a literal that the expression can't do without, and in order of rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants, _parser

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderworks.functions import text as T

#: Rules that travel to the executors at once; a larger table is read in blocks of so many.
BLOCK_RULES = 100_000
#: Letters that case-blind expressions take for an ASCII letter, though they aren't it in lower case.
_FOLDED = str.maketrans({"\u0131": "i", "\u0130": "i", "\u017f": "s", "\u212a": "k"})


def load_rules(rows: DataFrame, target: str) -> DataFrame:
    """Rules as read from a file (with `ordinal`): trimmed, contains and 100 as defaults, rows without pattern or target left out."""
    kind = F.lower(T.trimmed("match_type"))
    rules = rows.select(T.trimmed("pattern").alias("pattern"), T.trimmed(target).alias("target"), F.when(kind == "", "contains").otherwise(kind).alias("match_type"), F.coalesce(F.col("priority").cast("string").try_cast("int"), F.lit(100)).alias("priority"), "ordinal")
    return rules.where("pattern <> '' AND target <> ''")


def load_mappings(rows: DataFrame) -> DataFrame:
    """Saved mappings as read from a file: trimmed; rows that miss a name are left out."""
    return rows.select(*(T.trimmed(c).alias(c) for c in ("raw_name", "canonical_name", "archetype")), "ordinal").where("raw_name <> '' AND canonical_name <> ''")


def required_literal(pattern: str) -> str:
    """The longest run of ASCII characters, in lower case, that every match of the expression has in it; empty if none is known."""
    best, run = "", ""
    for kind, value in _parser.parse(pattern, re.IGNORECASE):
        if kind is _constants.LITERAL and value < 128:
            run += chr(value).lower()
            best = max(best, run, key=len)
        elif kind is _constants.AT:
            continue  # a place takes no characters
        else:
            run = ""
    return best


class _Loose:
    """The contains and regex rules of a block, as rows (pattern, key of the pattern, match_type, priority, ordinal, target)."""

    def __init__(self, rules: list[tuple[str, str, str, int, int, str]]) -> None:
        self.words = ahocorasick.Automaton()
        found: dict[str, list] = {}  # a word: the best rank and target of its contains rules, and its expressions
        self.others = []
        for pattern, key, kind, priority, ordinal, target in rules:
            if kind == "contains":
                entry = found.setdefault(key, [None, []])
                entry[0] = min(filter(None, (entry[0], (priority, ordinal, target))))
            else:
                rule = (priority, ordinal, target, pattern)
                literal = required_literal(pattern)
                (found.setdefault(literal, [None, []])[1] if literal else self.others).append(rule)
        self.always = found.pop("", [None, []])[0]  # what an empty pattern gives to every name
        for word, entry in found.items():
            self.words.add_word(word, tuple(entry))
        self.words.make_automaton()
        self.compiled: dict[str, re.Pattern] = {}

    def _holds(self, pattern: str, base: str) -> bool:
        if pattern not in self.compiled:
            self.compiled[pattern] = re.compile(pattern, re.IGNORECASE)
        return self.compiled[pattern].search(base) is not None

    def first(self, key: str, base: str) -> tuple[int, int, str] | None:
        """Rank and target of the first rule that holds for a name."""
        best, tried = self.always, list(self.others)
        if len(self.words):
            for _, (own, _) in self.words.iter(key):
                if own and (best is None or own < best):
                    best = own
            for _, (_, expressions) in self.words.iter(base.lower().translate(_FOLDED)):
                tried += expressions
        for priority, ordinal, target, pattern in sorted(set(tried)):
            if best is not None and (priority, ordinal, target) >= best:
                break
            if self._holds(pattern, base):
                return priority, ordinal, target
        return best


def _loose_matches(keyed: DataFrame, rules: list[tuple]) -> DataFrame:
    """name, priority, ordinal and target of the first of these contains and regex rules, for names (name, _key, _base) with one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loose = _Loose(rules)
        for batch in batches:
            names, keys, bases = (batch.column(c).to_pylist() for c in ("name", "_key", "_base"))
            hits = [(n, loose.first(k or "", b or "")) for n, k, b in zip(names, keys, bases, strict=True)]
            hits = [(n, *hit) for n, hit in hits if hit]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*hits, strict=True) if hits else [()] * 4, (pa.string(), pa.int32(), pa.int64(), pa.string()), strict=True)], ["name", "priority", "ordinal", "target"])

    return keyed.select("name", "_key", "_base").mapInArrow(run, "name string, priority int, ordinal long, target string")


def first_match(names: DataFrame, rules: DataFrame, *, base: Column, key: Column, pattern_key: Column) -> DataFrame:
    """`names` (distinct values in column `name`) with `target` of the first rule that matches, null if none does.

    Expressions are those of Python, whatever the case. An expression that can't be read is an error.
    """
    rank = F.struct("priority", "ordinal")
    keyed = names.withColumns({"_base": base, "_key": key})
    rules = rules.withColumns({"_pattern": pattern_key, "ordinal": F.col("ordinal").cast("long")})
    exact = rules.where("match_type = 'exact'").groupBy("_pattern").agg(F.min_by("target", rank).alias("t1"), F.min(rank).alias("r1"))
    found = keyed.join(exact, F.col("_key") == F.col("_pattern"), "left").drop("_pattern")
    loose, block = None, []
    open_ = rules.where("match_type IN ('contains', 'regex')").select("pattern", "_pattern", "match_type", "priority", "ordinal", "target")
    for r in open_.toLocalIterator():
        block.append(tuple(r))
        if len(block) == BLOCK_RULES:
            some = _loose_matches(keyed, block)
            loose, block = some if loose is None else loose.unionByName(some), []
    if block or loose is None:
        some = _loose_matches(keyed, block)
        loose = some if loose is None else loose.unionByName(some)
    best = loose.groupBy("name").agg(F.min_by("target", rank).alias("t2"), F.min(rank).alias("r2")).withColumnRenamed("name", "_name")
    both = found.join(best, F.col("name").eqNullSafe(F.col("_name")), "left").drop("_name")
    return both.withColumn("target", F.when(F.col("r2").isNull() | (F.col("r1") < F.col("r2")), F.col("t1")).otherwise(F.col("t2"))).drop("t1", "t2", "r1", "r2", "_base", "_key")


def _applied(rows: DataFrame, col: str, out: str, matched: DataFrame, fallback: Column) -> DataFrame:
    table = matched.select(F.col("name").alias("_name"), F.coalesce("target", fallback).alias(out))
    return rows.join(table, F.col(col).eqNullSafe(F.col("_name")), "left").drop("_name")


def canonical_names(rows: DataFrame, aliases: DataFrame, col: str = "Deck", out: str = "Canonical") -> DataFrame:
    """Adds the canonical name: the first alias rule, else Prowess for names with that word, else the cleaned name."""
    names = rows.select(F.col(col).alias("name")).distinct()
    base = T.clean_deck_name("name")
    matched = first_match(names, aliases, base=base, key=T.normalize_name(base), pattern_key=T.normalize_name(T.expand_camel_case("pattern")))
    return _applied(rows, col, out, matched, F.when(F.contains(T.normalize_name(base), F.lit("prowess")), "Prowess").otherwise(base))


def archetypes(rows: DataFrame, rules: DataFrame, col: str = "Deck", out: str = "Archetype") -> DataFrame:
    """Adds the archetype: the first rule, else the label of the first known word in the name, else Unknown."""
    names = rows.select(F.col(col).alias("name")).distinct()
    matched = first_match(names, rules, base=T.text_of("name"), key=T.normalize_name("name"), pattern_key=T.normalize_name("pattern"))
    return _applied(rows, col, out, matched, T.heuristic_archetype("name"))


def last_by_key(rows: DataFrame, key: Column, order: str = "ordinal", *, last: bool = True) -> DataFrame:
    """One row for each key, the last by `order` or the first."""
    place = Window.partitionBy("_k").orderBy(F.desc(order) if last else F.asc(order))
    return rows.withColumn("_k", key).withColumn("_n", F.row_number().over(place)).where("_n = 1").drop("_k", "_n")


def with_mapping(rows: DataFrame, mappings: DataFrame, col: str = "Deck") -> DataFrame:
    """Adds mapped_name and mapped_archetype of the saved mapping for a raw name; of equal keys the last wins."""
    table = last_by_key(mappings, T.normalize_name("raw_name")).select(T.normalize_name("raw_name").alias("_m"), F.col("canonical_name").alias("mapped_name"), F.col("archetype").alias("mapped_archetype"))
    return rows.join(table, T.normalize_name(col) == F.col("_m"), "left").drop("_m")


def merged_mappings(user: DataFrame, more: DataFrame) -> DataFrame:
    """The user's mappings, then those of `more` whose key isn't among them; of equal keys in `more` the first wins."""
    extra = more.join(user.select(T.normalize_name("raw_name").alias("_u")), T.normalize_name("raw_name") == F.col("_u"), "left_anti")
    return user.unionByName(last_by_key(extra, T.normalize_name("raw_name"), last=False))
