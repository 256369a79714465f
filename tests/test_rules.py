"""Rule tables beside asking every rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.operators import rules as R


def asked(name, rules):
    """The target of the first rule by priority and ordinal, over all rules."""
    key = " ".join(name.split()).lower()
    for pattern, target, kind, _, _ in sorted(rules, key=lambda r: r[3:]):
        said = " ".join(pattern.split()).lower()
        if (kind == "exact" and key == said) or (kind == "contains" and said in key) or (kind == "regex" and re.search(pattern, name, re.IGNORECASE)):
            return target
    return None


def match(spark, names, rules):
    df = spark.createDataFrame(rules, "pattern string, target string, match_type string, priority int, ordinal long")
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    found = R.first_match(rows, df, base=T.text_of("name"), key=T.normalize_name("name"), pattern_key=T.normalize_name("pattern"))
    return {r.name: r.target for r in found.collect()}


@pytest.mark.parametrize("block", [100_000, 3_001])
def test_first_of_twenty_thousand_rules(spark, monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK_RULES", block)
    rng = random.Random(1)
    letters = "abcde "
    word = lambda a, b: "".join(rng.choice(letters) for _ in range(rng.randint(a, b))).strip() or "x"
    names = list({word(4, 30).title() if i % 2 else word(4, 30) for i in range(300)}) + ["", "İstanbul Deck", "MaſK", "the King", "ıs it"]
    rules, i = [], 0
    for kind, n in (("contains", 19_000), ("exact", 900), ("regex", 100)):
        for _ in range(n):
            pattern = word(5, 9) if kind == "contains" else rng.choice(names) if kind == "exact" else rng.choice([f"^{word(3, 5)}", f"{word(3, 4)}$", f"{word(2, 3)}.*{word(2, 3)}", f"({word(3, 4)}|{word(3, 4)})", f"[ab]{word(4, 5)}", f"{word(3, 4)}+"])
            rules.append((pattern, f"t{i}", kind, rng.choice([1, 5, 5, 100]), i))
            i += 1
    rules += [("mask", "folded", "regex", 0, 100_000), ("king$", "kelvin", "regex", 0, 100_001), ("is it", "dotless", "regex", 0, 100_002), ("i.?stan", "dotted", "regex", 0, 100_003)]
    rules = [r for r in rules if r[0]]
    got = match(spark, names, rules)
    assert got == {n: asked(n, rules) for n in names}
    assert 50 < sum(v is not None for v in got.values())


def test_no_rules_and_unreadable_rules(spark):
    assert match(spark, ["a", None], []) == {"a": None, None: None}
    assert match(spark, ["a"], [("a", "A", "exact", 1, 1)]) == {"a": "A"}
    with pytest.raises(Exception, match="unterminated|missing"):
        match(spark, ["a(b"], [("(", "x", "regex", 1, 1)])


@pytest.mark.parametrize(("pattern", "literal"), [("^Old ", "old "), ("gear$", "gear"), ("ab|cd", ""), ("a?bcd", "bcd"), ("ab(cd)ef", "ab"), ("x.longer", "longer"), ("É..", ""), ("", ""), (r"\bboros", "boros"), ("(?:ab)", "ab")])
def test_literals_that_an_expression_needs(pattern, literal):
    found = R.required_literal(pattern)
    assert found == literal or (found in literal or literal in found) and all(found in m.lower() for m in re.findall(pattern, "old ab bcd gear xylonger boros abcdef", re.IGNORECASE) if isinstance(m, str))


def test_rules_apply_to_rows(spark):
    aliases = R.load_rules(spark.createDataFrame([("Ruby Storm", "Storm", "exact", "10", 1), ("burn", "Burn", "", "x", 2), ("^mono", "Mono", "regex", None, 3), (" ", "none", "exact", "1", 4)], "pattern string, t string, match_type string, priority string, ordinal long"), "t")
    rows = spark.createDataFrame([("RubyStorm",), ("Generic  Boros BURN",), ("mono burn",), ("Mono G",), ("Izzet Prowess",), ("Else",), (None,)], "Deck string")
    got = {r.Deck: r.Canonical for r in R.canonical_names(rows, aliases).collect()}
    assert got == {"RubyStorm": "Storm", "Generic  Boros BURN": "Burn", "mono burn": "Burn", "Mono G": "Mono", "Izzet Prowess": "Prowess", "Else": "Else", None: ""}
    assert rows.withColumn("n", F.lit(1)).count() == 7
