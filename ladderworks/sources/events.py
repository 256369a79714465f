"""Event pages and documents: links of index pages, result tables, embedded JSON, rosters, standings and brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderworks.functions import text as T
from ladderworks.operators.similarity import BASIC_LANDS
from ladderworks.sources.scratch import once

#: Layout of an event document; numbers come as text.
EVENT = (
    "event_id STRING, player_count STRUCT<players: STRING>, final_rank ARRAY<STRUCT<loginid: STRING, rank: STRING, roundnumber: STRING>>, "
    "standings ARRAY<STRUCT<login_name: STRING, loginid: STRING, rank: STRING, score: STRING, opponentmatchwinpercentage: STRING, gamewinpercentage: STRING, opponentgamewinpercentage: STRING>>, "
    "decklists ARRAY<STRUCT<loginid: STRING, player: STRING, main_deck: ARRAY<STRUCT<qty: STRING, card_attributes: STRUCT<card_name: STRING>>>>>, "
    "brackets ARRAY<STRUCT<index: INT, matches: ARRAY<STRUCT<players: ARRAY<STRUCT<player: STRING, loginid: STRING, wins: INT, winner: BOOLEAN, seeding: INT>>>>>>"
)
#: The parts of it that matches and states need. What isn't named is passed over by the parser: the cards are most of a document.
MATCHES = (
    "event_id STRING, player_count STRUCT<players: STRING>, final_rank ARRAY<STRUCT<loginid: STRING, rank: STRING, roundnumber: STRING>>, "
    "decklists ARRAY<STRUCT<loginid: STRING, player: STRING>>, "
    "brackets ARRAY<STRUCT<index: INT, matches: ARRAY<STRUCT<players: ARRAY<STRUCT<player: STRING, loginid: STRING, wins: INT, winner: BOOLEAN, seeding: INT>>>>>>"
)
#: The parts that rosters need.
ROSTERS = (
    "event_id STRING, final_rank ARRAY<STRUCT<loginid: STRING, rank: STRING, roundnumber: STRING>>, "
    "decklists ARRAY<STRUCT<loginid: STRING, player: STRING, main_deck: ARRAY<STRUCT<qty: STRING, card_attributes: STRUCT<card_name: STRING>>>>>"
)
#: The mark of the embedded document, the links of an index page, rounds of a bracket by their index.
EMBEDDED = r"window\.MTGO\.decklists\.data\s*=\s*(\{(?:[^}]++|\}(?!;))*+\});"  # up to the first };
LINK = r'(?i)href="/decklist/([a-z0-9-]+)-(\d{4}-\d{2}-\d{2})(\d+)"'
ROUNDS = {2: "QF", 1: "SF", 0: "F"}
SIZE = 32


def index_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """slug, date and id of every event link, once each, whatever the case of the link; null dates are no dates."""
    rows = pages.select(F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(0))).alias("a")).distinct()
    part = lambda i: F.regexp_extract("a", LINK, i)
    return rows.select(part(1).alias("slug"), F.try_to_date(part(2)).alias("date"), part(3).alias("event_id"))


def registry(links: DataFrame, challenge: str, premier: str, ignored: str) -> DataFrame:
    """Links with kind and size, by patterns of slugs; an unknown slug is an error. One row per id."""
    kind = F.when(F.col("slug").rlike(challenge), "challenge").when(F.col("slug").rlike(premier), "premier").when(F.col("slug").rlike(ignored), "ignored").otherwise(F.raise_error(F.concat(F.lit("unknown slug "), F.col("slug"))))
    size = F.regexp_extract("slug", r"-(\d+)$", 1).try_cast("int")
    rows = links.withColumns({"kind": kind, "size": size})
    last = Window.partitionBy("event_id").orderBy(F.desc("date"), F.desc("slug"))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def newest_of_day(links: DataFrame) -> DataFrame:
    """Of events on one date with one size the one with the largest id."""
    return links.groupBy("date", "size").agg(F.max_by(F.struct("event_id", "slug"), F.col("event_id").cast("long")).alias("e")).select("date", "size", "e.*")


def truncated_months(links: DataFrame, stored: DataFrame, due: Column) -> DataFrame:
    """Months whose page seems cut: no link, a newest date before the day due, or fewer links than were stored (month, n_stored, due)."""
    found = links.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.max("date").alias("newest"))
    rows = stored.join(found, "month", "left")
    reason = F.when(F.col("n").isNull(), "no links").when(F.col("newest") < due, "too old").when(F.col("n") < F.col("n_stored"), "fewer links")
    return rows.withColumn("reason", reason).where("reason IS NOT NULL").select("month", "n", "n_stored", "reason")


def result_rows(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Rows of a result table: place, deck and pilot from the first three cells, where the first is a place such as 1st and the
    others aren't empty. What follows `mana cost:` in a deck's cell isn't its name."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b.*?</tr>"), F.lit(0))).alias("row", "tr"))
    cells = once(rows, td=F.transform(F.slice(F.regexp_extract_all("tr", F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), F.lit(1)), 1, 3), T.strip_html))
    place = F.regexp_extract(F.lower(F.get("td", F.lit(0))), r"^(\d+)(?:st|nd|rd|th)$", 1).try_cast("int")
    deck = F.trim(F.regexp_replace(F.get("td", F.lit(1)), r"(?i)\s*mana cost\s*:.*$", ""))
    named = once(cells.select(key, "row", "td"), c=F.struct(place.alias("place"), deck.alias("deck"), F.get("td", F.lit(2)).alias("pilot")))
    return named.select(key, "row", "c.*").where("place IS NOT NULL AND deck <> '' AND pilot <> ''")


def embedded_events(pages: DataFrame, html: str = "html", layout: str = EVENT) -> DataFrame:
    """The document embedded in each page, null where there is none; with `layout` MATCHES or ROSTERS what these need of it."""
    text = F.nullif(F.regexp_extract(html, EMBEDDED, 1), F.lit(""))
    return once(pages, event=F.from_json(text, layout))


def parse_events(text: DataFrame, col: str = "value") -> DataFrame:
    """Event documents of a text column as a struct."""
    return once(text, event=F.from_json(col, EVENT))


def cached_events(spark: SparkSession, folder: str, ids: DataFrame) -> DataFrame:
    """EventID and the document of those events that are in a folder, as `<id>.json` or else `<id>.0.json`; none is fetched.

    `event` is null where the file can't be read. The documents are files of their own, which are read whole, those of other
    events too, or rows (name, value) of the Parquet files that `sinks.write_documents` makes, or both.
    """
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select("value", name.alias("name"))
    packed = spark.read.schema("name string, value string").parquet(folder, pathGlobFilter="*.parquet").where(F.col("name").endswith(".json"))
    files = files.unionByName(packed)
    found = files.select("value", F.regexp_replace("name", r"(\.0)?\.json$", "").alias("EventID"), F.col("name").endswith(".0.json").alias("second"))
    one = found.join(ids.select(T.event_id("EventID").alias("EventID")).distinct(), "EventID", "left_semi").groupBy("EventID").agg(F.min_by("value", "second").alias("value"))
    return parse_events(one).select("EventID", "event")


def _ranks() -> Column:
    """The last entry of each login among the final ranks, as (loginid, rank)."""
    entries = F.transform("event.final_rank", lambda r: F.named_struct(F.lit("loginid"), r["loginid"], F.lit("rank"), r["rank"].try_cast("int")))
    last = lambda own: F.filter(own, lambda r, i: ~F.exists(F.slice(own, i + 2, F.greatest(F.size(own) - i - 1, F.lit(0))), lambda q: q["loginid"].eqNullSafe(r["loginid"])))
    return F.get(F.transform(F.array(F.coalesce(entries, F.expr("cast(array() as array<struct<loginid: string, rank: int>>)"))), last), F.lit(0))


def event_status(events: DataFrame, size: int = SIZE) -> DataFrame:
    """OK, ERROR with its reason, or PENDING (places, but no decklists yet), and the number of players or null, never 0 by default.

    Places are judged first: those of the logins, the last of each, must be exactly 1 to `size`.
    """
    return events.select("event", _status(size)).select(F.col("event.event_id").alias("EventID"), "s.*", F.col("event.player_count.players").try_cast("int").alias("PlayerCount"))


def _status(size: int) -> Column:
    """Status and reason of an event as a struct `s`, worked out once a row."""
    places = F.array_sort(F.array_distinct(F.transform(_ranks(), lambda r: r["rank"])))
    good = F.coalesce(places == F.sequence(F.lit(1), F.lit(size)), F.lit(False))
    n = F.greatest(F.coalesce(F.size("event.decklists"), F.lit(0)), F.lit(0))

    def judged(p: Column) -> Column:
        good, n = p["good"], p["n"]
        status = F.when(~good, "ERROR").when(n == 0, "PENDING").when(n != size, "ERROR").otherwise("OK")
        reason = F.when(~good, f"places are not 1 to {size}").when(n == 0, "no decklists").when(n != size, F.concat(n.cast("string"), F.lit(" decklists")))
        return F.struct(status.alias("status"), reason.alias("reason"))

    return F.explode(F.transform(F.array(F.struct(good.alias("good"), n.alias("n"))), judged)).alias("s")


def rosters(events: DataFrame) -> DataFrame:
    """Pilot, login, place and cards of each decklist: EventID, LoginID, Pilot, Place, cards (map of name to quantity, no basic lands)."""
    rank = F.map_from_entries(F.filter(_ranks(), lambda r: (F.coalesce(F.trim(r["loginid"]), F.lit("")) != "") & r["rank"].isNotNull()))
    rows = events.select(F.col("event.event_id").alias("EventID"), rank.alias("_rank"), F.explode("event.decklists").alias("d"))
    return rows.select("EventID", F.col("d.loginid").alias("LoginID"), F.col("d.player").alias("Pilot"), F.try_element_at("_rank", F.col("d.loginid")).alias("Place"), "d.main_deck")


def cards(rosters_: DataFrame) -> DataFrame:
    """deck_id, item and qty of each roster's deck: names in lower case with single spaces, quantities of a card summed, one
    where none is given; cards without a name and basic lands are left out. A quantity that is no number is an error."""
    rows = rosters_.select(F.concat_ws(":", "EventID", "LoginID").alias("deck_id"), F.explode("main_deck").alias("c"))
    named = rows.select("deck_id", T.normalize_name("c.card_attributes.card_name").alias("item"), F.coalesce(F.col("c.qty").cast("int"), F.lit(1)).alias("qty"))
    return named.where((F.col("item") != "") & ~F.col("item").isin(*BASIC_LANDS)).groupBy("deck_id", "item").agg(F.sum("qty").alias("qty"))


def roster_cards(events: DataFrame) -> DataFrame:
    """EventID, LoginID, Pilot, Place, item and qty: the rosters with the cards of each decklist, named and summed as by `cards`. They
    are summed in their row, so a document is read once, and no rows meet."""
    card = lambda c: F.struct(T.normalize_name(c["card_attributes"]["card_name"]).alias("item"), F.coalesce(c["qty"].cast("int"), F.lit(1)).alias("qty"))
    rows = once(rosters(events), _c=F.filter(F.transform("main_deck", card), lambda c: (c["item"] != "") & ~c["item"].isin(*BASIC_LANDS)))
    rows = rows.select("EventID", "LoginID", "Pilot", "Place", "_c", F.explode(F.array_distinct("_c.item")).alias("item"))
    total = F.aggregate(F.filter("_c", lambda c: c["item"] == F.col("item")), F.lit(0).cast("long"), lambda s, c: s + c["qty"])
    return rows.select("EventID", "LoginID", "Pilot", "Place", "item", total.alias("qty"))


def _logins(events: DataFrame) -> DataFrame:
    """Adds `_names`: names and logins of an event's decklists, in their order."""
    named = F.transform("event.decklists", lambda d: F.struct(T.normalize_name(d["player"]).alias("p"), T.trimmed(d["loginid"]).alias("l")))
    return once(events, _names=F.filter(named, lambda e: (e["p"] != "") & (e["l"] != "")))


def _resolved(rows: DataFrame, login: str, name: str) -> DataFrame:
    """Rows with `login` filled from `_names` where it is blank (of equal names the last), empty if the name isn't there either, and
    `_borrowed`: whether it was blank. A document holds all names of its event, so no rows meet."""
    found = F.try_element_at(F.filter("_names", lambda e: e["p"] == F.col("_n")), F.lit(-1))["l"]
    blank = T.trimmed(login) == ""
    return once(rows, _n=T.normalize_name(name)).withColumns({login: F.when(blank, F.coalesce(found, F.lit(""))).otherwise(T.trimmed(login)), "_borrowed": blank}).drop("_n")


def brackets(events: DataFrame) -> DataFrame:
    """Matches of each event: round, winner and loser with their seeds, and how many of the two logins (0 to 2) were blank and
    so looked up by name. A match needs two players, one of them the winner. An event has one document."""
    return _matches(_logins(events).select(F.col("event.event_id").alias("EventID"), "_names", F.explode(_pairs()).alias("m")))


def _pairs() -> Column:
    """The matches of an event with two players, one of them the winner, as (i, w, l)."""
    won = lambda m, flag: F.filter(m["players"], lambda p: F.coalesce(p["winner"], F.lit(False)) == flag)
    good = lambda m: F.coalesce((F.size(m["players"]) == 2) & (F.size(won(m, True)) == 1), F.lit(False))
    pair = lambda b: F.transform(F.filter(F.coalesce(b["matches"], F.array()), good), lambda m: F.struct(b["index"].alias("i"), won(m, True)[0].alias("w"), won(m, False)[0].alias("l")))
    return F.flatten(F.transform("event.brackets", pair))


def _matches(rows: DataFrame) -> DataFrame:
    """`m` and `_names` of each row as the columns of a match; the other columns stay."""
    kept = [c for c in rows.columns if c not in ("m", "_names")]
    name = F.coalesce(*(F.when(F.col("m.i") == i, r) for i, r in ROUNDS.items()))
    side = lambda s, c: [F.col(f"m.{s}.{f}").alias(f"{c}{n}") for f, n in (("player", "Pilot"), ("loginid", "LoginID"), ("wins", "Games"), ("seeding", "SwissRank"))]
    out = rows.select(*kept, "_names", name.alias("Round"), *side("w", "Winner"), *side("l", "Loser")).withColumns({f"{c}Pilot": T.trimmed(f"{c}Pilot") for c in ("Winner", "Loser")})
    out = _resolved(out, "WinnerLoginID", "WinnerPilot").withColumnRenamed("_borrowed", "_b")
    return _resolved(out, "LoserLoginID", "LoserPilot").withColumn("Borrowed", F.col("_b").cast("int") + F.col("_borrowed").cast("int")).drop("_b", "_borrowed", "_names")


def judged_matches(events: DataFrame, size: int = SIZE) -> DataFrame:
    """The matches of events whose status is OK, and a row for each other event and for one without a match (`matched` false):
    as `brackets`, with status, reason and matched. A document is read once for all of these."""
    judged = _logins(events.select("event", _status(size)))
    found = F.when((F.col("s.status") == "OK") & F.col("event.event_id").isNotNull(), _pairs())
    rows = judged.select(F.col("event.event_id").alias("EventID"), "s.status", "s.reason", "_names", F.explode_outer(found).alias("m"))
    return _only_matched(_matches(rows.withColumn("matched", F.col("m").isNotNull())))


def _only_matched(rows: DataFrame) -> DataFrame:
    """Null in the columns of a match where there is none."""
    kept = ("EventID", "status", "reason", "matched")
    return rows.select(*kept, *(F.when(F.col("matched"), F.col(c)).alias(c) for c in rows.columns if c not in kept))


def without_bracket(events: DataFrame) -> DataFrame:
    """Events whose document has no bracket; an empty list is none."""
    return events.where("event.event_id IS NOT NULL AND coalesce(size(event.brackets), 0) <= 0").select(F.col("event.event_id").alias("EventID"), F.lit("no bracket").alias("Reason"))


def swiss(events: DataFrame) -> DataFrame:
    """Standings of each event: login (its own, else that of the decklist of that name; without either the row is left out),
    rank, score and percentages as they are written, and whether the login was looked up. A login's last row counts."""
    rows = _logins(events).select(F.col("event.event_id").alias("EventID"), "_names", F.posexplode("event.standings").alias("_i", "s")).select("EventID", "_names", "_i", "s.*")
    out = _resolved(rows, "loginid", "login_name").drop("_names", "login_name").where("loginid <> ''")
    one = out.groupBy("EventID", F.col("loginid").alias("LoginID")).agg(F.max_by(F.struct(*(c for c in out.columns if c not in ("EventID", "loginid"))), "_i").alias("s")).select("EventID", "LoginID", "s.*")
    return one.select("EventID", "LoginID", F.col("rank").try_cast("int").alias("SwissRank"), F.col("score").try_cast("int").alias("SwissPoints"), *(T.trimmed(c).alias(n) for c, n in (("opponentmatchwinpercentage", "OMWP"), ("gamewinpercentage", "GWP"), ("opponentgamewinpercentage", "OGWP"))), F.col("_borrowed").alias("ByName"))
