"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

Lines that are equal but for case and white space are one. A line's shingles are its runs of SHINGLE characters (UTF-16
units). They are exploded, hashed in generated code and reduced to a signature of SLOTS smallest hashes
(one-permutation hashing; a long line gives each slot DRAWN hashes to choose from on average, the lowest ones, which
leaves out hashes that could hardly be a slot's smallest). Twelve bands of four slots make buckets; lines that share a
bucket are candidates unless their signatures already tell them apart, or, in large buckets, the parities of their shingles: each
cell of hashes that holds an odd number of one line's shingles and an even number of the other's has one that they don't
share, which bounds their similarity from above. Candidates are verified by the Jaccard similarity of all their shingles.
Links of at least THRESHOLD make components, of which the first line stays.

In a bucket each line first meets the bucket's first one, which then has met all. Components show which of the others that
has not joined, and only lines of different components are compared after that; in a large bucket first a few at random, in rounds, and then those
that share one of their samples' rarest hashes, as any pair must that the samples don't tell apart. So no candidate is left
out, a bucket of similar lines, however large, costs few comparisons a line, and many lines that share a passage but not
more cost little.

Lines are split once and written; then they are known by 128 bits of hash, and only candidates' texts are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderworks.llm.common import boxed, components, forget, scratch

SHINGLE, THRESHOLD = 8, 0.8
SLOTS, DRAWN = 16, 2.5
#: Slots of each band: the rows, the columns and one set of diagonals of a square of four by four slots (lines of the
#: affine plane of order four, so that two bands share one slot at most). Lines of similarity 0.8 share a band with a
#: chance of 0.98, lines of 0.85 with 0.994.
BANDS = tuple(tuple(4 * x + y for x in range(4)) for y in range(4)) + tuple(tuple(4 * x + y for y in range(4)) for x in range(4)) + tuple(tuple(4 * x + (x ^ y) for x in range(4)) for y in range(4))
#: Candidates agree in so many slots at least (compared by four bits each). Pairs of similarity 0.8 do so with a chance of 0.998.
AGREE = 8
#: Smallest hashes of a line that estimate a similarity before it is computed, and how far the estimate may fall below.
SAMPLE, SLACK = 96, 0.12
#: Buckets with at most so many pairs left open compare them; others compare lines that share a rare hash. Neither leaves out a
#: pair that the other would have found.
FEW = 1_024
#: Lines of a group that `dealt_pairs` compares with each other, on average, and how often lines are dealt out at most.
GROUP, ROUNDS = 16, 2
#: Words of 64 cells each that keep the parities of a line's shingles.
WORDS = 8
#: Tables of at most so many bytes, by count and width of their rows, are broadcast; larger ones are shuffled.
BROADCAST_BYTES = 32 << 20
#: The HOT lines with the most copies are joined to their occurrences by broadcast.
HOT = 1024
SHIFT = 10**10
_NO_DOC = -(2**63)
#: White space within a line.
_INSIDE = "\t\x0b\x0c\r"


def normal(line: Column) -> Column:
    """The line in lower case, runs of white space as one space, without white space at its ends."""
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def _normal_of_lower(line: Column) -> Column:
    """`normal` for a line in lower case; most lines need no replacing, which is told at less cost."""
    odd = F.contains(line, F.lit("  "))
    for c in _INSIDE:
        odd = odd | F.contains(line, F.lit(c))
    return F.trim(F.when(odd, F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")).otherwise(line))


def _names(line: Column) -> list[Column]:
    """128 bits of hash of a normal line, which stand for it where its text isn't carried."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line (from 0), normal, h1, h2: the lines with a word. Null texts have none."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(F.split(F.lower(text_col), "\n")).alias("line", "raw"))
    return rows.select("doc_id", "line", _normal_of_lower(F.col("raw")).alias("normal")).where("normal <> ''").select("*", *_names(F.col("normal")))


def shingles(line: Column) -> Column:
    """Hashes of all shingles of a line, in order; a shorter line is one shingle."""
    at = lambda b: F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length(b) - (2 * SHINGLE - 1)), F.lit(2))
    # the bytes come in as a lambda's variable, which isn't copied for each shingle as a column would be
    return F.transform(F.array(F.encode(line, "UTF-16BE")), lambda b: F.transform(at(b), lambda i: F.xxhash64(F.substr(b, i, F.lit(2 * SHINGLE)))))[0]


def _place() -> Column:
    """Document and line as one number, in their order; a null id comes first."""
    place = F.coalesce(F.col("doc_id"), F.lit(_NO_DOC)).cast("decimal(20,0)") * F.lit(SHIFT).cast("decimal(11,0)") + F.col("line").cast("decimal(10,0)")
    return place.cast("decimal(38,0)")


def _doc(place: str) -> Column:
    """The document of a place, of which the null id is the least long."""
    return F.floor(F.col(place) / F.lit(SHIFT).cast("decimal(11,0)")).cast("long")


def _line(place: str) -> Column:
    return F.pmod(F.col(place), F.lit(SHIFT).cast("decimal(11,0)")).cast("int")


def signatures(found: DataFrame) -> DataFrame:
    """One row per distinct line of `lines`: k, h1, h2, place of its first occurrence, copies, n (shingles), m0, m1, ..., sketch.

    m0 to m15 are the signature (null: no hash in that slot); sketch holds four bits of each.
    """
    count = F.greatest(F.lit(1), F.shiftright(F.octet_length("b"), 1) - (SHINGLE - 1))
    drawn = int(SLOTS * DRAWN)
    least = F.when(F.col("n") <= drawn, F.lit(2**32)).otherwise((F.lit(float(2**32 * drawn)) / F.col("n")).cast("long"))
    rows = found.select("h1", "h2", _place().alias("place"), F.encode("normal", "UTF-16BE").alias("b")).withColumn("n", count).withColumn("least", least)
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), 2 * F.col("n") - 1, F.lit(2))).alias("i"))
    rows = rows.withColumn("h", F.xxhash64(F.substr("b", F.col("i"), F.lit(2 * SHINGLE))))
    rows = rows.select("h1", "h2", "place", "n", "i", "least", F.shiftrightunsigned("h", 32).alias("v"), F.col("h").bitwiseAND(SLOTS - 1).cast("int").alias("slot"))
    rows = rows.where("v <= least OR i = 1")  # the first shingle also counts the line
    # a filter leaves the sums alone where it doesn't hold; a case would write all of them again for each shingle
    mins = (F.expr(f"min(v) FILTER (WHERE slot = {j} AND v <= least)").alias(f"m{j}") for j in range(SLOTS))
    once = (F.expr(f"{f} FILTER (WHERE i = 1)").alias(c) for c, f in (("place", "min(place)"), ("copies", "count(*)"), ("n", "max(n)")))
    out = rows.groupBy("h1", "h2").agg(*once, *mins)
    bits = F.lit(0).cast("long")
    for j in range(SLOTS):
        bits = bits.bitwiseOR(F.shiftleft(F.coalesce(F.col(f"m{j}"), F.lit(0)).bitwiseAND(15), 4 * j))
    small = (F.shiftright(F.col(f"m{j}"), 1).cast("int").alias(f"m{j}") for j in range(SLOTS))  # below 2**31
    return out.select(F.monotonically_increasing_id().alias("k"), "h1", "h2", "place", "copies", F.col("n").cast("int").alias("n"), bits.alias("sketch"), *small)


def members(distinct: DataFrame) -> DataFrame:
    """bucket, k, n, sketch: each line in the bucket of each band. Bands without any hash, of short lines, have none."""
    keys = (F.when(F.coalesce(*(F.col(f"m{j}") for j in band)).isNotNull(), F.xxhash64(F.lit(i), *(F.coalesce(f"m{j}", F.lit(-1)) for j in band))) for i, band in enumerate(BANDS))
    return distinct.select("k", "n", "sketch", F.explode(F.array(*keys)).alias("bucket")).where("bucket is not null")


def _small(df: DataFrame, row_bytes: int) -> DataFrame:
    most = BROADCAST_BYTES // row_bytes
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def bucketed(distinct: DataFrame) -> DataFrame:
    """bucket, first, size, k, n, sketch: the lines of all buckets that hold more than one, with the bucket's first line."""
    member = members(distinct)
    shared = scratch(member.groupBy("bucket").agg(F.min("k").alias("first"), F.count("*").cast("int").alias("size")).where("size > 1"))
    return scratch(member.join(_small(shared, 64), "bucket"))


def _agree(a: str, b: str) -> Column:
    """Whether the sketches leave it open that two lines are similar."""
    off = F.col(a).bitwiseXOR(F.col(b))
    off = off.bitwiseOR(F.shiftright(off, 1))
    off = off.bitwiseOR(F.shiftright(off, 2)).bitwiseAND(0x1111111111111111)
    return F.bit_count(off) <= SLOTS - AGREE


def parities(hashes: Column) -> list[Column]:
    """p0, p1, ...: a bit for each of 64 * WORDS cells, set if an odd number of the distinct hashes falls into it."""

    def flipped(word: Column, h: Column) -> Column:
        cell = F.shiftrightunsigned(h, 6).bitwiseAND(63).cast("int")
        return word.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), cell))

    of = lambda j: F.filter(hashes, lambda h: h.bitwiseAND(WORDS - 1) == j)
    return [F.aggregate(of(j), F.lit(0).cast("long"), flipped).alias(f"p{j}") for j in range(WORDS)]


def _may_be(a: str, b: str, threshold: float) -> Column:
    """Whether sizes and parities (the `known` of two lines) allow the similarity; no pair that has it is told apart.

    Of x and y shingles, similar lines leave (1 - threshold) / (1 + threshold) * (x + y) unshared at most, and each cell of
    different parity holds one.
    """
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    off = F.lit(0)
    for j in range(WORDS):
        off = off + F.bit_count(F.col(f"{a}.p{j}").bitwiseXOR(F.col(f"{b}.p{j}")))
    return (F.least(x, y) >= threshold * F.greatest(x, y)) & ((1 + threshold) * off <= (1 - threshold) * (x + y) + 1e-6)


def first_pairs(inside: DataFrame) -> DataFrame:
    """Candidates (a, b): each line of a bucket with the bucket's first."""
    first = inside.where("k = first").select("bucket", F.col("sketch").alias("first_sketch"))
    rest = inside.where("k > first").join(first, "bucket").where(_agree("sketch", "first_sketch"))
    return rest.select(F.col("first").alias("a"), F.col("k").alias("b")).distinct()


def unmet(inside: DataFrame) -> DataFrame:
    """The lines of buckets that are left when each has met the bucket's first one: those of buckets of two have no more to meet."""
    return inside.where("k > first AND size > 2")


def texts(wanted: DataFrame, distinct: DataFrame, found: DataFrame) -> DataFrame:
    """k, normal and low (the SAMPLE smallest hashes of its shingles) of the lines with a key k in `wanted`.

    The lines are read again, from the documents that hold them first.
    """
    named = scratch(distinct.select("k", "h1", "h2", "place").join(_small(wanted, 32), "k", "left_semi"))
    holders = scratch(named.select(_doc("place").alias("holder")).distinct())
    rows = found.join(_small(holders, 32), F.coalesce("doc_id", F.lit(_NO_DOC)) == F.col("holder"), "left_semi")
    rows = rows.withColumn("place", _place()).join(_small(named, 96), ["place", "h1", "h2"])
    once = rows.groupBy("k").agg(F.first("normal").alias("normal"))
    least = F.slice(F.sort_array(F.array_distinct(shingles(F.col("normal")))), 1, SAMPLE)
    out = scratch(once.select("k", "normal", F.transform(least, lambda h: F.shiftright(h, 32).cast("int")).alias("low")))
    for df in (named, holders):
        forget(df)
    return out


def placed(rest: DataFrame, roots: DataFrame) -> DataFrame:
    """The lines of open buckets: bucket, k, sketch, root, inner (in the component of most lines of the bucket), size, pairs.

    `rest` has the lines that are `unmet`; pairs is how many of the bucket's are left to compare.
    """
    rows = scratch(rest.join(_small(roots.select(F.col("node").alias("k"), "root"), 48), "k", "left").select("bucket", "k", "sketch", F.coalesce("root", "k").alias("root")))
    sizes = rows.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("size", "root")).alias("most"), F.sum("size").alias("all"))
    main = scratch(main.select("bucket", F.col("most.root").alias("main"), ((F.col("all") - F.col("most.size")) * F.col("all")).alias("pairs"), F.col("all").alias("size")).where("pairs > 0"))
    out = scratch(rows.join(_small(main, 48), "bucket").select("bucket", "k", "sketch", "root", (F.col("root") == F.col("main")).alias("inner"), "size", "pairs"))
    forget(rows)
    forget(main)
    return out


def marks(open_: DataFrame, text: DataFrame) -> DataFrame:
    """k and known (distinct shingles n, and `parities`) of the lines in large buckets."""
    many = scratch(open_.where(F.col("pairs") > FEW).select("k").distinct())
    sets = text.select("k", "normal").join(_small(many, 32), "k", "left_semi").select("k", F.array_distinct(shingles(F.col("normal"))).alias("s"))
    out = scratch(sets.select("k", F.struct(F.size("s").alias("n"), *parities(F.col("s"))).alias("known")))
    forget(many)
    return out


def dealt_pairs(open_: DataFrame, known: DataFrame, turn: int, threshold: float) -> DataFrame:
    """Candidates (a, b) of large buckets dealt out at random into groups of some GROUP lines: those of different components.

    Most lines of a component that its first line has not joined are joined by one of these few comparisons a line.
    """
    many = open_.where(F.col("pairs") > FEW).join(_small(known, 192), "k")
    many = many.select("bucket", F.pmod(F.xxhash64(F.lit(turn), "bucket", "k"), F.ceil(F.col("size") / GROUP)).alias("part"), "k", "root", "sketch", "known")
    other = many.select(F.col("bucket").alias("same"), F.col("part").alias("same_part"), F.col("k").alias("b"), F.col("root").alias("root_b"), F.col("sketch").alias("sketch_b"), F.col("known").alias("known_b"))
    alike = (F.col("k") < F.col("b")) & (F.col("root") != F.col("root_b")) & _agree("sketch", "sketch_b") & _may_be("known", "known_b", threshold)
    return many.join(other, (F.col("bucket") == F.col("same")) & (F.col("part") == F.col("same_part")) & alike).select(F.col("k").alias("a"), "b")


def few_pairs(open_: DataFrame) -> DataFrame:
    """Candidates (a, b) of small buckets: each line outside the main component with each inside, and with each other outside once."""
    few = open_.where(F.col("pairs") <= FEW)
    own = few.where("not inner").select("bucket", F.col("k").alias("a"), F.col("root").alias("root_a"), F.col("sketch").alias("sketch_a"))
    other = few.select(F.col("bucket").alias("same"), F.col("k").alias("b"), "root", "inner", "sketch")
    apart = (F.col("root_a") != F.col("root")) & (F.col("inner") | (F.col("a") < F.col("b")))
    pairs = own.join(other, (F.col("bucket") == F.col("same")) & apart & _agree("sketch_a", "sketch"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def prefixes(text: DataFrame, threshold: float) -> DataFrame:
    """k and shingle: the rarest hashes of each line's sample, so many that two lines whose samples are `_likely` share one."""
    each = text.select("k", F.explode("low").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("often"))
    ranked = each.join(often, "shingle").groupBy("k").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("s"))
    shared = F.ceil(F.size("s") * (threshold - SLACK)).cast("int")  # so many hashes of the sample at least are in the other's
    return ranked.select("k", F.explode(F.slice("s", F.lit(1), F.size("s") - shared + 1)).alias("s")).select("k", "s.shingle")


def many_pairs(open_: DataFrame, known: DataFrame, text: DataFrame, threshold: float) -> DataFrame:
    """Candidates (a, b) of the other buckets: lines of different components that share a prefix shingle.

    Of two lines that `_likely` lets through each has one of its sample's rarest hashes among the other's, whichever buckets
    they share. So lines that have only a common passage, however many they are, hardly meet. Two lines that share several
    become a candidate at the least of them.
    """
    many = open_.where(F.col("pairs") > FEW).groupBy("k").agg(F.max("root").alias("root"), F.max("sketch").alias("sketch"), F.min("inner").alias("inner"))
    many = scratch(many.join(_small(known, 192), "k"))
    keys = scratch(prefixes(text.select("k", "low").join(_small(many.select("k"), 32), "k", "left_semi"), threshold).groupBy("k").agg(F.collect_list("shingle").alias("rare")).join(_small(many, 192), "k"))
    each = keys.select(F.explode("rare").alias("shingle"), "*")
    own = each.where("not inner").select("shingle", F.col("k").alias("a"), F.col("root").alias("root_a"), F.col("sketch").alias("sketch_a"), F.col("known").alias("known_a"), F.col("rare").alias("rare_a"))
    other = each.select(F.col("shingle").alias("same"), F.col("k").alias("b"), "root", "inner", "sketch", "known", "rare")
    apart = (F.col("root_a") != F.col("root")) & (F.col("inner") | (F.col("a") < F.col("b")))
    once = F.col("shingle") == F.array_min(F.array_intersect("rare_a", "rare"))
    pairs = own.join(other, (F.col("shingle") == F.col("same")) & apart & _agree("sketch_a", "sketch") & _may_be("known_a", "known", threshold) & once)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _likely(a: str, b: str, threshold: float) -> Column:
    """Whether two samples estimate the similarity above threshold - SLACK, three deviations."""
    least = lambda x, y: F.slice(F.sort_array(F.array_union(x, y)), 1, SAMPLE)
    shared = lambda u: F.size(F.array_intersect(u, F.array_intersect(a, b))) >= (threshold - SLACK) * F.size(u)
    return F.transform(F.array(least(a, b)), shared)[0]


def similar(pairs: DataFrame, text: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Those of the pairs (a, b) of keys k whose lines have at least that Jaccard similarity, if their samples are `_likely`."""
    side = lambda c, column, x: text.select(F.col("k").alias(c), F.col(column).alias(x))
    likely = pairs.join(side("a", "low", "low_a"), "a").join(side("b", "low", "low_b"), "b").where(_likely("low_a", "low_b", threshold)).select("a", "b")
    both = likely.join(side("a", "normal", "x"), "a").join(side("b", "normal", "y"), "b")
    sets = both.select("a", "b", F.array_distinct(shingles(F.col("x"))).alias("x"), F.array_distinct(shingles(F.col("y"))).alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return sets.where(common >= threshold * (F.size("x") + F.size("y") - common)).select("a", "b")


def fresh(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """The candidates that aren't among those tried, once each, as a table."""
    return scratch(pairs.distinct().join(_small(tried, 32), ["a", "b"], "left_anti"))


def judged(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct line of `lines`: h1, h2, place of its first occurrence, copies, first: the place of the line that stays."""
    distinct = scratch(signatures(found))
    inside = bucketed(distinct)
    met, rest = scratch(first_pairs(inside)), scratch(unmet(inside))
    forget(inside)
    wanted = scratch(met.select(F.col("a").alias("k")).unionByName(met.select(F.col("b").alias("k"))).unionByName(rest.select("k")).distinct())
    text = texts(wanted, distinct, found)
    links, tried = scratch(similar(met, text, threshold)), met
    roots = scratch(components(links))
    open_ = placed(rest, roots)
    known = marks(open_, text) if open_.where(F.col("pairs") > FEW).take(1) else None
    for turn in range(ROUNDS):
        if known is None or not open_.where(F.col("pairs") > FEW).take(1):
            break
        dealt = fresh(dealt_pairs(open_, known, turn, threshold), tried)
        links, tried = links.unionByName(scratch(similar(dealt, text, threshold))), tried.unionByName(dealt)
        forget(roots)
        forget(open_)
        roots = scratch(components(links))
        open_ = placed(rest, roots)
    candidates = few_pairs(open_)
    if known is not None and open_.where(F.col("pairs") > FEW).take(1):
        candidates = candidates.unionByName(many_pairs(open_, known, text, threshold))
    more = scratch(similar(fresh(candidates, tried), text, threshold))
    for df in (met, rest, wanted, text, open_):
        forget(df)
    if known is not None:
        forget(known)
    if more.take(1):
        forget(roots)
        roots = scratch(components(links.unionByName(more)))
    linked = distinct.select("k", "h1", "h2", "place", "copies").join(_small(roots.withColumnRenamed("node", "k"), 48), "k")
    first = linked.groupBy("root").agg(F.min("place").alias("first"))
    alone = distinct.select("k", "h1", "h2", "place", "copies").join(_small(roots.select(F.col("node").alias("k")), 32), "k", "left_anti")
    columns = ["h1", "h2", "place", "copies", "first"]
    out = scratch(alone.withColumn("first", F.col("place")).select(columns).unionByName(linked.join(first, "root").select(columns)))
    for df in (distinct, more, roots):
        forget(df)
    return out


def fuzzy_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per distinct line: doc_id and line of its first occurrence, n_copies, keep_doc, keep_line, kept.

    keep_doc and keep_line tell the first line of its component, which stays. A null id comes first and is the least long
    here. Texts without lines with a word, null texts and empty tables give no rows; rows that repeat an id count as texts
    of one document. Texts and lines of any length are compared whole.
    """
    found = scratch(lines(docs, id_col, text_col))
    rows = judged(found, threshold)
    forget(found)
    return rows.select(_doc("place").alias("doc_id"), _line("place").alias("line"), F.col("copies").alias("n_copies"), _doc("first").alias("keep_doc"), _line("first").alias("keep_line"), (F.col("place") == F.col("first")).alias("kept"))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, threshold: float, *more: Column) -> DataFrame:
    """doc_id, line, place, n_copies, first, and `more`: of every line with a word.

    Lines that occur once and are like no other tell their verdict themselves. Those with many copies are joined by
    broadcast; their occurrences then get a key of their own each, so that the other lines' join deals them out evenly.
    """
    found = scratch(lines(docs, id_col, text_col))
    verdicts = judged(found, threshold).where("copies > 1 OR place <> first").select("h1", "h2", "copies", "first")
    hot = scratch(verdicts.where("copies > 1").orderBy(F.desc("copies"), "h1", "h2").limit(HOT)).select("h1", "h2", F.col("copies").alias("hot_copies"), F.col("first").alias("hot_first"))
    every = found.select("doc_id", "line", "h1", "h2", *more).join(F.broadcast(hot), ["h1", "h2"], "left")
    every = every.withColumn("h1", F.when(F.col("hot_first").isNull(), F.col("h1")).otherwise(F.xxhash64("doc_id", "line")))
    every = every.join(verdicts, ["h1", "h2"], "left").withColumn("place", _place())
    columns = [c for c in every.columns if c not in ("h1", "h2", "copies", "first", "hot_copies", "hot_first")]
    return every.select(*columns, F.coalesce("hot_copies", "copies", F.lit(1)).cast("long").alias("n_copies"), F.coalesce("hot_first", "first", "place").alias("first"))


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per line with a word of every document: doc_id, line, n_copies, keep_doc, keep_line, kept.

    Of all occurrences of the lines of a component only the first, keep_doc and keep_line, is kept. Cases as in `fuzzy_lines`.
    """
    rows = _occurrences(docs, id_col, text_col, threshold)
    return rows.select("doc_id", "line", "n_copies", _doc("first").alias("keep_doc"), _line("first").alias("keep_line"), (F.col("place") == F.col("first")).alias("kept"))


def drop_fuzzy_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with all columns and rows, their texts without the lines that are not kept; lines without a word stay."""
    mark = F.xxhash64("line", "normal").alias("mark")
    gone = _occurrences(docs, id_col, text_col, threshold, mark).where("place <> first").groupBy(F.col("doc_id").alias("key")).agg(F.collect_set("mark").alias("gone"))
    rows = boxed(docs, id=F.col(id_col).cast("long")).join(gone.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("key")), "left")
    stays = F.filter(F.split(F.col("doc")[text_col], "\n"), lambda x, i: ~F.array_contains(F.col("gone"), F.xxhash64(i, normal(x))))
    text = F.when(F.col("gone").isNull(), F.col("doc")[text_col]).otherwise(F.array_join(stays, "\n"))
    return rows.select(F.col("doc").withField(text_col, text).alias("doc")).select("doc.*")
