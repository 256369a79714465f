"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

DataFrame functions only. A pattern's matches come from regexp_extract_all and their places from the gaps that split
leaves between them, so a text is scanned twice per pattern at most, and once where a pattern doesn't occur. Patterns
start at the beginning of a run of their characters or right after the last match (\\G), and quantifiers are possessive
where nothing can follow, so that long runs cost linear time; what they match is the same as without.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spans below this score are dropped, but for those of the base kinds, which then aren't redacted. Characters before and after a span in which words of its context count.
ACCEPTED, NEAR = 0.5, 32


@dataclass(frozen=True)
class Kind:
    """What proposes a span, what must occur in a text at all, its score, and what words near it add or take away."""

    name: str
    pattern: str
    needs: str | None
    score: float
    words: str
    bonus: float
    others: str
    malus: float


#: Fixed order: the base kinds come first, whose spans always stay.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "mail|contact|write", 0.2, "example|sample|placeholder", 0.4),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", None, 0.6, r"\b(?:ip|host|server|address)", 0.3, r"version|release|section|chapter|\bv$", 0.3),
    Kind("card", r"[0-9](?:[0-9]|[\x20-][0-9])++", None, 0.7, "card|visa|credit|pay", 0.3, "isbn|tracking|serial|barcode|part no", 0.4),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, r"phone|\bcall|\btel|mobile", 0.3, "serial|invoice|order no|item no", 0.3),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", None, 0.6, "iban|account|bank|konto", 0.3, "serial|licen[cs]e|product key|part no", 0.3),
    Kind("secret", r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])[A-Za-z0-9_]{16,}+", None, 0.2, "password|passwd|token|secret|api.?key|access.?key|akia", 0.5, "sha-?[0-9]|md5|checksum|commit|digest|uuid|integrity", 0.4),
)
BASE = 4
SPAN = "struct<start: int, rank: int, end: int, kind: string, text: string, score: double>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """Whether 14 to 19 digits pass Luhn's test."""
    digits = F.reverse(_digits(text))

    def place(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, (2 * d) % 10 + F.floor(2 * d / 10)).otherwise(d).cast("int")

    n = F.length(digits)
    return F.when(n.between(14, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + place(i)) % 10 == 0).otherwise(False)


def _small_parts(text: Column) -> Column:
    value = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.split(text, r"\."), lambda p: F.when(F.length(value(p)) <= 3, value(p).cast("int") <= 255).otherwise(False))


def _mod97(text: Column) -> Column:
    """Whether the characters after the first four, then those, read as a number (A is 10) leave 1 when divided by 97."""
    plain = F.replace(text, F.lit(" "))
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4))), "(?!^)(?!$)")

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (F.when(value < 10, rest * 10).otherwise(rest * 100) + value) % 97

    return F.when(F.length(plain).between(15, 34), F.aggregate(turned, F.lit(0), step) == 1).otherwise(False)


def _confirmed(kind: Kind, text: Column) -> Column:
    checks = {"ip": _small_parts, "card": _luhn, "phone": lambda t: F.length(_digits(t)).between(10, 15), "iban": _mod97}
    return checks[kind.name](text) if kind.name in checks else text.isNotNull()


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often it stands in the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind as an array of SPAN, in order; start and end count code points, the end exclusive."""
    rank = KINDS.index(kind)
    none = F.array().cast(f"array<{SPAN}>")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)

    def step(held: Column, piece: Column) -> Column:
        gap, match = piece["gap"], piece["match"]
        start = held["at"] + F.char_length(gap)
        end = start + F.coalesce(F.char_length(match), F.lit(0))
        own = F.left(match, F.lit(4) if kind.name == "secret" else F.lit(0))
        near = F.lower(F.concat(F.right(gap, F.lit(NEAR)), own, F.lit(" "), F.left(F.coalesce(piece["after"], F.lit("")), F.lit(NEAR))))
        score = _once(near, lambda n: F.round(kind.score + F.when(n.rlike(kind.words), kind.bonus).otherwise(0.0) - F.when(n.rlike(kind.others), kind.malus).otherwise(0.0), 2))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"), match.alias("text"), score.alias("score"))
        stays = match.isNotNull() & _confirmed(kind, match) & (F.lit(rank < BASE) | (score >= ACCEPTED))
        return F.struct(end.alias("at"), F.when(stays, F.array_append(held["out"], span)).otherwise(held["out"]).alias("out"))

    def gather(held: Column, some: Column) -> Column:
        start = F.struct(held["at"].alias("at"), none.alias("out"))
        return F.aggregate(some, start, step, lambda own: F.struct(own["at"].alias("at"), F.array_append(held["out"], own["out"]).alias("out")))

    def pieces(matches: Column, between: Column) -> Column:
        return F.transform(between, lambda gap, i: F.named_struct(F.lit("gap"), gap, F.lit("match"), F.get(matches, i), F.lit("after"), F.get(between, i + 1)))

    def blocks(of: Column) -> Column:
        """Matches are gathered in blocks and blocks in an array, as adding to one long array would copy it for each match."""
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(of))).cast("int"))
        return F.transform(F.sequence(F.lit(1), F.size(of), size), lambda i: F.slice(of, i, size))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out"))
    split = _once(found, lambda matches: _once(gaps, lambda between: _once(pieces(matches, between), blocks)))
    all_spans = F.flatten(F.aggregate(split, start, gather, lambda held: held["out"]))
    occurs = F.regexp_count(text, F.lit(kind.pattern)) > 0 if kind.needs is None else F.contains(text, F.lit(kind.needs))
    return F.when(occurs, all_spans).otherwise(none)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id and `found`, all its spans by start and kind (see SPAN), with their scores.

    A null text is an empty one and has none. Rows that repeat an id or a text get their row each; an empty table gives
    an empty result. Spans of different kinds may overlap. Very long texts are searched whole.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", F.sort_array(F.concat(*(spans(F.col("text"), k) for k in KINDS))).alias("found"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `[kind]` in place of each accepted span in its text; of overlapping spans the first counts.

    All rows and columns stay, repeated ones too; null and empty texts stay as they are; an empty table stays empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = F.filter(F.sort_array(F.concat(*(spans(text, k) for k in KINDS))), lambda s: s["score"] >= ACCEPTED)

    def step(held: Column, span: Column) -> Column:
        part = F.concat(held["text"], F.substr(text, held["at"] + 1, span["start"] - held["at"]), F.lit("["), span["kind"], F.lit("]"))
        return F.when(span["start"] >= held["at"], F.struct(span["end"].alias("at"), part.alias("text"))).otherwise(held)

    done = F.aggregate(found, F.struct(F.lit(0).alias("at"), F.lit("").alias("text")), step, lambda held: F.concat(held["text"], F.substr(text, held["at"] + 1)))
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), done))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of their spans, all spans as text, their scores, and how many are accepted."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("found", lambda s: s["rank"] < BASE)
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(k.name).alias(f"n_{k.name}") for k in KINDS[:BASE]), F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"), F.array_join(F.transform("found", line), ",").alias("spans"), F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",").alias("scores"), F.size(F.filter("found", lambda s: s["score"] >= ACCEPTED)).cast("long").alias("n_accepted"))
