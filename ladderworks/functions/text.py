"""Scalar functions on names, labels and raw cell text. All are Column expressions that stay in generated code."""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that make a label, the first pattern that occurs decides.
ARCHETYPE_PATTERNS = (
    (r"\b(burn|zoo|prowess|aggro|humans|goblins|elves|merfolk|infect|affinity|hammer)\b", "Aggro"),
    (r"\b(midrange|rock|jund|abzan|grixis midrange|golgari)\b", "Midrange"),
    (r"\b(control|azorius|jeskai control|dimir control|uw control|esper control)\b", "Control"),
    (r"\b(combo|storm|belcher|twin|neoform|oops|creativity|ad nauseam|yawgmoth|amulet)\b", "Combo"),
    (r"\b(ramp|tron|titan|eldrazi ramp|scapeshift)\b", "Ramp"),
    (r"\b(tempo|delver|murktide)\b", "Midrange"),
    (r"\b(prison|lantern|lock)\b", "Prison"),
    (r"\b(reanimator|goryo|living end|dredge)\b", "Graveyard"),
)
#: Pairs of words of which a name must hold one each, and the label that it then gets.
KEYWORD_PAIRS = (
    ("jeskai", ("blink", "evoke"), "Jeskai Blink"),
    ("boros", ("energy",), "Boros Energy"),
    ("domain", ("zoo",), "Domain Zoo"),
    ("izzet", ("prowess", "steel"), "Prowess"),
    ("temur", ("prowess", "steel"), "Prowess"),
)
#: Labels that mean that nothing is known.
UNKNOWN_WORDS = ("", "unknown", "unkown", "n/a", "na", "none", "null", "?", "-")


def text_of(x: Column | str) -> Column:
    """The column as text, null as empty."""
    return F.coalesce((F.col(x) if isinstance(x, str) else x).cast("string"), F.lit(""))


def trimmed(x: Column | str) -> Column:
    """Without white space of any kind, the no-break space included, at both ends."""
    return F.regexp_replace(text_of(x), r"(?U)^\s+|\s+$", "")


def collapsed(x: Column | str) -> Column:
    """Trimmed, and each run of white space one space."""
    return F.trim(F.regexp_replace(text_of(x), r"(?U)\s+", " "))


def normalize_name(x: Column | str) -> Column:
    """The key by which names are compared: collapsed and lower-case."""
    return F.lower(collapsed(x))


def format_token(x: Column | str) -> Column:
    """Only a-z and 0-9, lower-case."""
    return F.regexp_replace(F.lower(text_of(x)), "[^a-z0-9]+", "")


def format_slug(x: Column | str) -> Column:
    """Lower-case words joined by hyphens."""
    return F.regexp_replace(normalize_name(x), " ", "-")


def slugify(x: Column | str) -> Column:
    """Lower-case, other characters than letters and digits as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(trimmed(x)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def expand_camel_case(x: Column | str) -> Column:
    """`RubyStorm` as `Ruby Storm`; names with a space are left alone."""
    x = text_of(x)
    return F.when(F.instr(x, " ") == 0, F.regexp_replace(x, "([a-z])([A-Z])", "$1 $2")).otherwise(x)


def clean_deck_name(x: Column | str) -> Column:
    """The name that alias rules are matched against: collapsed, without the word `generic`, camel case split."""
    return expand_camel_case(collapsed(F.regexp_replace(collapsed(x), "(?i)generic", " ")))


def parse_percent(x: Column | str, *, decimal: bool = False) -> Column:
    """A number from text such as `12,5 %`; null if it is none. `decimal`: values above 1 are percentages and are divided."""
    value = F.replace(F.replace(trimmed(x), F.lit("%"), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(value > 1, value / 100).otherwise(value) if decimal else value


def parse_count(x: Column | str) -> Column:
    """A count from text such as `1,234`: truncated, 0 if negative or none."""
    value = F.replace(trimmed(x), F.lit(","), F.lit("")).try_cast("double")
    return F.greatest(F.lit(0), F.coalesce(value.try_cast("int"), F.lit(0)))


def unescaped(x: Column) -> Column:
    """Text with its character references resolved once: numbers, and the names of HTML 4; others stay as they are."""
    pattern = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,9});"
    names = F.create_map(*(F.lit(v) for name, code in sorted(name2codepoint.items()) for v in (name, chr(code))), F.lit("apos"), F.lit("'"))

    def resolved(e: Column) -> Column:
        inner = F.substring_index(F.substr(e, F.lit(2)), ";", 1)
        code = F.when(F.startswith(F.lower(inner), F.lit("#x")), F.conv(F.substr(inner, F.lit(3)), 16, 10)).otherwise(F.substr(inner, F.lit(2))).try_cast("int")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(~F.startswith(inner, F.lit("#")), F.coalesce(F.try_element_at(names, inner), e)).when(valid, char).otherwise(e)

    parts = F.zip_with(F.split(x, pattern, -1), F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), lambda gap, e: F.concat(gap, F.when(e.isNull(), "").otherwise(resolved(e))))
    return F.when(F.contains(x, F.lit("&")), F.array_join(parts, "")).otherwise(x)


def strip_html(x: Column | str) -> Column:
    """Text between tags, character references resolved, white space and no-break spaces collapsed."""
    return collapsed(F.replace(unescaped(F.regexp_replace(text_of(x), "<[^>]*>", " ")), F.lit("\u00a0"), F.lit(" ")))


def identity_key(login: Column | str, pilot: Column | str) -> Column:
    """`id:<login>` if there is a login, else `name:<normalised name>`."""
    return F.when(trimmed(login) != "", F.concat(F.lit("id:"), trimmed(login))).otherwise(F.concat(F.lit("name:"), normalize_name(pilot)))


def event_id(x: Column | str) -> Column:
    """An id as text without the `.0` that number columns leave."""
    return F.regexp_replace(trimmed(x), r"\.0$", "")


def heuristic_archetype(x: Column | str) -> Column:
    """The label of the first pattern that occurs in the name, else Unknown."""
    out = F.lit("Unknown")
    for pattern, label in reversed(ARCHETYPE_PATTERNS):
        out = F.when(normalize_name(x).rlike(pattern), label).otherwise(out)
    return out


def keyword_archetype(x: Column | str) -> Column:
    """The label of the first pair of keywords in the name, else the name itself."""
    name, out = F.lower(text_of(x)), text_of(x)
    for first, others, label in reversed(KEYWORD_PAIRS):
        out = F.when(F.contains(name, F.lit(first)) & name.rlike("|".join(others)), label).otherwise(out)
    return out


def signature_archetype(cards: Column, signatures: Iterable[tuple[str, Iterable[str]]]) -> Column:
    """The first label one of whose signature cards is among the array `cards`, else Unknown."""
    return F.coalesce(*(F.when(F.arrays_overlap(cards, F.array(*map(F.lit, names))), F.lit(label)) for label, names in signatures), F.lit("Unknown"))


def archetype_label(x: Column | str) -> Column:
    """Reanimator counts as Graveyard, an empty label as Unknown."""
    return F.when(normalize_name(x) == "reanimator", "Graveyard").when(trimmed(x) == "", "Unknown").otherwise(trimmed(x))


def archetype_override(raw: Column | str, deck: Column | str, archetype: Column | str) -> Column:
    """Sultai Midrange is Midrange, whatever the rules say."""
    return F.when((normalize_name(raw) == "sultai midrange") | (normalize_name(deck) == "sultai midrange"), "Midrange").otherwise(text_of(archetype))


def is_code_like(x: Column | str) -> Column:
    """One to five capitals, or one to five colour letters."""
    return trimmed(x).rlike("^[A-Z]{1,5}$") | normalize_name(x).rlike("^[wubrg]{1,5}$")


def is_unknown(x: Column | str) -> Column:
    """Whether a label says that nothing is known."""
    return normalize_name(x).isin(*UNKNOWN_WORDS) | F.contains(normalize_name(x), F.lit("unknown"))


def source_names(x: Column | str) -> Column:
    """`A | B | a` as the array [A, B]: trimmed, without empty parts, the first of those that differ in case only."""
    parts = F.filter(F.transform(F.split(text_of(x), r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    seen = F.transform(F.array(parts), lambda own: F.filter(own, lambda p, i: F.array_position(F.transform(own, lambda q: F.lower(q)), F.lower(p)) == i + 1))
    return seen[0]


def event_label(tier: Column | str, event_class: Column) -> Column:
    """`C64` of a challenge as `Modern Challenge 64`; else the words of the slug in title case, RC in capitals, Premier for none."""
    tier = trimmed(tier)
    parts = F.filter(F.split(tier, r"(?U)[-_\s]+"), lambda w: w != "")
    words = F.transform(parts, lambda w: F.when(F.lower(w) == "rc", "RC").otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))))
    return F.when((event_class == "Challenge") & tier.rlike("^C[0-9]+$"), F.concat(F.lit("Modern Challenge "), F.substr(tier, F.lit(2)))).when(tier == "", "Premier").otherwise(F.array_join(words, " "))


def hex_color(x: Column | str) -> Column:
    """A colour `#rrggbb` in lower case, null if it is none."""
    return F.when(trimmed(x).rlike("^#[0-9a-fA-F]{6}$"), F.lower(trimmed(x)))


def color_map(lines: Column | str) -> Column:
    """`name=#rrggbb` lines as a map by normalised name; other lines are ignored, the last of equals wins."""
    pairs = F.transform(F.split(text_of(lines), "\n"), lambda s: F.struct(normalize_name(F.regexp_extract(s, "^([^=]*)=", 1)).alias("key"), hex_color(F.regexp_extract(s, "=(.*)$", 1)).alias("value")))
    good = F.filter(pairs, lambda p: (p["key"] != "") & p["value"].isNotNull())
    last = F.transform(F.array(good), lambda own: F.filter(own, lambda p, i: ~F.exists(F.slice(own, i + 2, F.greatest(F.size(own) - i - 1, F.lit(0))), lambda q: q["key"] == p["key"])))
    return F.map_from_entries(last[0])


def style_of(name: Column | str, palettes: Iterable[str], default: str = "classic") -> Column:
    """The palette's name in lower case, the default for one that isn't known."""
    key = normalize_name(name)
    return F.when(key.isin(*[p.lower() for p in palettes]), key).otherwise(F.lit(default))
