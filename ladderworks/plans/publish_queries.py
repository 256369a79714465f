"""Queries of the checks that stand before publishing, on histories and tables with planted faults, and of publishing itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderworks.operators import invariants as I
from ladderworks.operators import presence as P
from ladderworks.operators import publishing
from ladderworks.plans.event_queries import _PRESENCE, PRESENCE
from ladderworks.plans.standins import H, history, query
from ladderworks.sources.scratch import cut, shared_folder

#: Entries of the events here: those of the orders with as many lines or more.
SIZE = 4
#: The window of all runs.
_WINDOW = ("1992-01-01", "1998-12-31")
_HEAD = "SELECT CAST(NULL AS VARCHAR) AS check_id, CAST(NULL AS VARCHAR) AS severity, CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS detail WHERE false"
#: The whole events as `h` and, with a fault in six of 97, as `e`.
_FULL = H.replace("WITH h AS", "WITH raw AS") + f""", h AS (SELECT * FROM raw WHERE Place <= {SIZE} AND EventID IN (SELECT EventID FROM raw GROUP BY EventID HAVING count(*) >= {SIZE})),
    e AS (SELECT * REPLACE (CASE WHEN m = 1 AND Place = 2 THEN EventDate + 1 ELSE EventDate END AS EventDate, CASE WHEN m = 4 AND Place = 1 THEN 'X' ELSE Tier END AS Tier, CASE WHEN m = 2 AND Place = 3 THEN 2 ELSE Place END AS Place,
          CASE WHEN m = 6 AND Place <= 2 THEN '1' ELSE LoginID END AS LoginID) FROM (SELECT *, CAST(EventID AS BIGINT) % 97 AS m FROM h) WHERE NOT (m = 3 AND Place = 4))
"""


def whole_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    return h.withColumn("_n", F.max("Place").over(Window.partitionBy("EventID"))).where((F.col("_n") >= SIZE) & (F.col("Place") <= SIZE)).drop("_n")


def _faulty(h: DataFrame) -> DataFrame:
    m, at = F.col("EventID").cast("long") % 97, F.col("Place")
    change = lambda cond, value, c: F.when(cond, value).otherwise(F.col(c)).alias(c)
    new = {"EventDate": change((m == 1) & (at == 2), F.date_add("EventDate", 1), "EventDate"), "Tier": change((m == 4) & (at == 1), F.lit("X"), "Tier"), "Place": change((m == 2) & (at == 3), F.lit(2), "Place"), "LoginID": change((m == 6) & (at <= 2), F.lit("1"), "LoginID")}
    return h.where(~((m == 3) & (at == 4))).withColumns(new)


def _sql(check: str, severity: str = "hard", key: str = "EventID", detail: str = "''") -> str:
    return f"SELECT '{check}' AS check_id, '{severity}' AS severity, {key} AS key, {detail} AS detail"


_EVENTS = " UNION ALL ".join((
    _sql("one_date", detail="min(EventDate) || '/' || max(EventDate)") + " FROM e GROUP BY EventID HAVING count(DISTINCT EventDate) > 1",
    _sql("one_tier", detail="min(Tier) || '/' || max(Tier)") + " FROM e GROUP BY EventID HAVING count(DISTINCT Tier) > 1",
    _sql("rows", detail="CAST(count(*) AS VARCHAR)") + f" FROM e GROUP BY EventID HAVING count(*) <> {SIZE}",
    _sql("places", detail="count(Place) || '/' || count(DISTINCT Place)") + f" FROM e GROUP BY EventID HAVING list_sort(list(Place)) <> range(1, {SIZE + 1})",
    _sql("one_name", detail="CAST(count(*) AS VARCHAR)") + " FROM (SELECT EventID, LoginID FROM e WHERE LoginID <> '' GROUP BY ALL HAVING count(DISTINCT Pilot) > 1) GROUP BY EventID",
    "SELECT DISTINCT 'no_premier', 'hard', EventID, 'premier event' FROM e WHERE m = 5",
))


@query(_FULL + _EVENTS)
def q01_event_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = whole_events(spark, sf_dir)
    return I.event_rules(_faulty(h), h.where(F.col("EventID").cast("long") % 97 == 5).select("EventID"), SIZE)


#: Planted faults of a presence table: column, where, and the value there.
_FAULTS = (
    ("WinnerCount", "Deck = 'Brand#11' AND Tier = '1-URGENT'", "Top8Count + 1"), ("WinnerEventCount", "Deck = 'Brand#12' AND Tier = '2-HIGH'", "Top8EventCount + 1"),
    ("Top8Count", "Deck = 'Brand#13' AND Tier = '3-MEDIUM'", "Top8Count + 1"), ("Top32EntryCount", "Deck = 'Brand#14' AND Tier = '5-LOW'", "Top32EntryCount + 1"),
    ("DistinctPilots", "Deck = 'Brand#15'", "Top32EntryCount + 1"), ("TopPilotShare", "Deck = 'Brand#21' AND Tier = '1-URGENT'", "1.5"),
    ("Top32EventFreqPct", "Deck = 'Brand#23'", "Top32EventFreqPct + 1"), ("Top16Count", "Tier = '5-LOW'", "0"), ("Top2Count", "Deck = 'Brand#25'", "Top8Count + 1"),
)
_PLANTED = _FULL + _PRESENCE.format(key="Deck") + ", q AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN {where} THEN {value} ELSE {c} END AS {c}" for c, where, value in _FAULTS) + ") FROM p)\n"


def _planted(table: DataFrame) -> DataFrame:
    return table.withColumns({c: F.expr(f"CASE WHEN {where} THEN {value} ELSE {c} END") for c, where, value in _FAULTS})


def _flat_sql(source: str, key: str, group: str, columns: tuple[str, ...]) -> str:
    zero = lambda c: f"CASE WHEN min({c}) = 0 THEN 'zero' ELSE 'constant' END"
    few = lambda c: f" AND any_value(n) >= {I.FEW_EVENTS}" if c in I.EVENT_SHARES else ""
    return " UNION ALL ".join(_sql("degenerate", key=key, detail=f"'{c} ' || {zero(c)}") + f" FROM {source} {group} HAVING count(*) >= 3 AND count(DISTINCT {c}) = 1{few(c)}" for c in columns)


_NAME = "'Deck:' || Tier || ':' || Deck"
_TABLE = " UNION ALL ".join((
    _sql("events_fall", key=_NAME, detail="concat_ws('/', n, Top32EventCount, Top8EventCount, WinnerEventCount)") + " FROM x WHERE WinnerEventCount > Top8EventCount OR Top8EventCount > Top32EventCount OR Top32EventCount > n",
    _sql("entries_fall", key=_NAME, detail="concat_ws('/', Top32EntryCount, Top8Count, WinnerCount)") + " FROM x WHERE WinnerCount > Top8Count OR Top8Count > Top32EntryCount",
    _sql("pilots", key=_NAME, detail="concat_ws('/', DistinctPilots, Top32EntryCount)") + " FROM x WHERE DistinctPilots > Top32EntryCount",
    _sql("pilot_share", key=_NAME, detail="CAST(TopPilotShare AS VARCHAR)") + " FROM x WHERE TopPilotShare < 0 OR TopPilotShare > 1",
    _sql("one_pilot", key=_NAME, detail="concat_ws('/', DistinctPilots, CAST(TopPilotShare AS DOUBLE))") + " FROM x WHERE (DistinctPilots = 1 AND TopPilotShare <> 1) OR (DistinctPilots <> 1 AND TopPilotShare = 1)",
    _sql("pilot_entries", key=_NAME, detail="concat_ws('/', Top32EntryCount, entries)") + " FROM x WHERE Top32EntryCount <> entries",
    *(_sql("percent_grid", key=_NAME, detail=f"'{p}'") + f" FROM x WHERE abs({p} - {c} / n * 100) > 0.01" for p, c in (("Top32EventFreqPct", "Top32EventCount"), ("Top8EventFreqPct", "Top8EventCount"), ("WinnerEventFreqPct", "WinnerEventCount"))),
    *(_sql(check, key="'Deck:' || Tier", detail=f"CAST(sum({c}) AS BIGINT) || '/' || {k} * any_value(n)") + f" FROM x GROUP BY Tier HAVING sum({c}) <> {k} * any_value(n)" for check, c, k in (("sum_winners", "WinnerCount", 1), ("sum_winner_events", "WinnerEventCount", 1), ("sum_entries", "Top32EntryCount", SIZE), ("sum_top8", "Top8Count", SIZE))),
    _flat_sql("x", "'Deck:' || Tier", "GROUP BY Tier", I.VARY),
))


@query(_PLANTED + ", x AS (SELECT q.*, n_events AS n, (SELECT count(*) FROM h WHERE h.Tier = q.Tier AND h.Deck = q.Deck) AS entries FROM q) " + _TABLE)
def q01_q02_presence_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = whole_events(spark, sf_dir)
    return I.presence_rules(_planted(P.presence(h)), h, size=SIZE)


_ALL_COUNTS = P.SUMMED
_TOTAL = """, t AS (SELECT Deck, {sums}, min(BestPlace) AS BestPlace FROM p GROUP BY Deck), y AS (SELECT * REPLACE (CASE WHEN Deck = 'Brand#11' THEN Appearances + 5 ELSE Appearances END AS Appearances, 0 AS Top16Count) FROM t)
""".format(sums=", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _ALL_COUNTS))


@query(PRESENCE.replace(H, _FULL) + _TOTAL + " UNION ALL ".join((
    "SELECT 'all_events' AS check_id, 'hard' AS severity, 'Deck:ALL' AS key, count(DISTINCT EventID) || '/' || count(DISTINCT (EventID, Tier)) AS detail FROM e HAVING count(DISTINCT EventID) <> count(DISTINCT (EventID, Tier))",
    *(_sql("all_sums", "warn", "'Deck:ALL'", f"'{c} ' || CAST(a AS BIGINT) || '/' || CAST(b AS BIGINT)") + f" FROM (SELECT sum({c}) AS a, (SELECT sum({c}) FROM p) AS b FROM y) WHERE a <> b" for c in _ALL_COUNTS),
    _flat_sql("(SELECT *, 1000 AS n FROM y)", "'Deck:ALL'", "", ("Top8Count", "Top16Count", "WinnerCount", "BestPlace")),
)))
def q03_all_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = whole_events(spark, sf_dir)
    table = P.presence(h)
    total = P.all_tiers(table).select("Deck", *_ALL_COUNTS, "BestPlace")
    wrong = {"Appearances": F.when(F.col("Deck") == "Brand#11", F.col("Appearances") + 5).otherwise(F.col("Appearances")), "Top16Count": F.lit(0).cast("long")}
    return I.all_rules(total.withColumns(wrong), table, _faulty(h))


@query(_PLANTED + f""", k AS (SELECT min(Pilot) AS Pilot, min(LoginID) AS LoginID, count(*) FILTER (Place = 1) AS Wins, count(*) AS Top8, count(*) AS Top32 FROM h GROUP BY K),
    z AS (SELECT * REPLACE (CASE WHEN Pilot = 'P3' THEN Top8 + 1 ELSE Wins END AS Wins, CASE WHEN Pilot = 'P4' THEN Top32 + 2 ELSE Top8 END AS Top8) FROM k), n AS (SELECT count(DISTINCT EventID) AS n FROM h),
    w AS (SELECT Deck, count(*) AS won FROM h WHERE Place = 1 GROUP BY Deck), g AS (SELECT Deck, CAST(sum(WinnerCount) AS BIGINT) AS told FROM q GROUP BY Deck) """.replace(", n AS (SELECT count(DISTINCT", ", m2 AS (SELECT count(DISTINCT") + " UNION ALL ".join((
    _sql("pilot_falls", key="concat_ws(':', Pilot, LoginID)", detail="concat_ws('/', Wins, Top8, Top32)") + " FROM z WHERE Wins > Top8 OR Top8 > Top32",
    *(_sql("pilot_sums", key="'pilots'", detail=f"'{c} ' || CAST(sum({c}) AS BIGINT) || '/' || {k} * any_value(n)") + f" FROM z, m2 HAVING sum({c}) <> {k} * any_value(n)" for c, k in (("Wins", 1), ("Top8", SIZE), ("Top32", SIZE))),
    _sql("wins_by_deck", key="Deck", detail="won || '/' || coalesce(told, 0)") + " FROM w LEFT JOIN g USING (Deck) WHERE won <> coalesce(told, 0)",
)))
def q01_pilot_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = whole_events(spark, sf_dir)
    pilots = P.pilot_table(h, F.col("row_id"))
    wrong = {"Wins": F.when(F.col("Pilot") == "P3", F.col("Top8") + 1).otherwise(F.col("Wins")), "Top8": F.when(F.col("Pilot") == "P4", F.col("Top32") + 2).otherwise(F.col("Top8"))}
    return I.pilot_rules(pilots.withColumns(wrong), _planted(P.presence(h)), h, SIZE)


_ENTRIES, _IN = ("Top32EntryCount", "Top8Count", "Top4Count", "Top2Count", "WinnerCount"), ("Top32EventCount", "Top8EventCount", "Top4EventCount", "Top2EventCount", "WinnerEventCount")
_falls = lambda c: " OR ".join(f"{a} < {b}" for a, b in zip(c, c[1:], strict=False))


@query(_PLANTED + ", m2 AS (SELECT count(DISTINCT EventID) AS n FROM h), f AS (SELECT count(*) AS finals FROM h WHERE Place = 1 AND CAST(EventID AS BIGINT) % 9 <> 0) " + " UNION ALL ".join((
    *(_sql(check, "fatal", _NAME, f"concat_ws('/', {', '.join(c)})") + f" FROM q WHERE {_falls(c)}" for check, c in (("finals_entries", _ENTRIES), ("finals_events", _IN))),
    *(_sql("finals_sum", "fatal", "'Deck:finals'", f"'{c} ' || CAST(sum({c}) AS BIGINT) || '/' || {k} * any_value(n)") + f" FROM q, m2 HAVING sum({c}) <> {k} * any_value(n)" for c, k in (("WinnerCount", 1), ("Top2Count", 2), ("Top4Count", 4), ("Top8Count", SIZE))),
    _sql("finals_rows", "fatal", "'Deck:finals'", "finals || '/' || n") + " FROM f, m2 WHERE finals <> n",
    _sql("finals_decks", "fatal", "'Deck:finals'", "CAST(sum(Top2EventCount) AS BIGINT) || '/' || any_value(n)") + " FROM q, m2 HAVING NOT (sum(Top2EventCount) BETWEEN any_value(n) AND 2 * any_value(n))",
)))
def q03_finals_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = whole_events(spark, sf_dir)
    finals = P.finalists(h.where(F.col("EventID").cast("long") % 9 != 0))
    return I.finals_rules(_planted(P.presence(h)), finals, h, size=SIZE)


_KIND = "CASE WHEN CAST(EventID AS BIGINT) % 10 = 0 THEN 'premier' WHEN CAST(EventID AS BIGINT) % 11 = 0 THEN 'ignored' WHEN CAST(EventID AS BIGINT) % 13 = 0 THEN 'draft' ELSE 'challenge' END"


def _registry(h: DataFrame) -> DataFrame:
    n = F.col("EventID").cast("long")
    kind = F.when(n % 10 == 0, "premier").when(n % 11 == 0, "ignored").when(n % 13 == 0, "draft").otherwise("challenge")
    return h.select("EventID", "EventDate", F.left("Tier", F.lit(1)).cast("int").alias("size"), "Tier").distinct().withColumn("kind", kind)


@query(H + f""", r AS (SELECT DISTINCT EventID, EventDate, {_KIND} AS kind FROM h), s AS (SELECT DISTINCT EventID FROM h WHERE Format = 'F' AND CAST(EventID AS BIGINT) % 6 <> 0)
    SELECT EventID, EventDate, kind, CASE kind WHEN 'challenge' THEN CASE WHEN EventID IN (SELECT EventID FROM s) THEN 'FETCHED' ELSE 'MISSING' END WHEN 'premier' THEN 'PREMIER' WHEN 'ignored' THEN 'IGNORED' ELSE 'UNKNOWN' END AS Status,
           CASE WHEN kind = 'challenge' AND EventID NOT IN (SELECT EventID FROM s) THEN 'not present in history_csv' END AS Reason FROM r""", dates="EventDate")
def j18_registry_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir)
    stored = h.where("CAST(EventID AS BIGINT) % 6 <> 0").withColumn("EventID", F.concat("EventID", F.lit(".0")))
    return publishing.registry_state(_registry(h), stored, " f ").select("EventID", "EventDate", "kind", "Status", "Reason")


@query(H + f""", r AS (SELECT DISTINCT EventID, CAST(left(Tier, 1) AS INT) AS size, {_KIND} AS kind FROM h WHERE Format = 'F'), c AS (SELECT *, CAST(EventID AS BIGINT) % 6 <> 0 AS got FROM r WHERE kind = 'challenge')
    SELECT count(*) AS registry_count, count(*) FILTER (got) AS fetched_count, count(*) FILTER (NOT got) AS n_missing, count(*) = count(*) FILTER (got) AS complete, (SELECT count(*) FROM r WHERE kind = 'premier') AS premier_count,
           (SELECT string_agg(size || ':' || n, ';' ORDER BY CAST(size AS VARCHAR)) FROM (SELECT size, count(*) FILTER (got) AS n FROM c GROUP BY size)) AS fetched_by_size FROM c""")
def q08_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = history(spark, sf_dir).where("Format = 'F'")
    state = publishing.registry_state(_registry(h), h.where("CAST(EventID AS BIGINT) % 6 <> 0"), "F")
    one = publishing.completeness(state, publishing.premier_note(_notes(h).limit(0), "F", "1992-01-01", "2002-01-01"))
    sizes = F.array_join(F.transform(F.array_sort(F.map_entries("tier_counts_fetched")), lambda e: F.concat_ws(":", e["key"], e["value"])), ";")
    return one.select("registry_count", "fetched_count", F.size("missing").cast("long").alias("n_missing"), "complete", "premier_count", sizes.alias("fetched_by_size"))


def _notes(h: DataFrame) -> DataFrame:
    return h.select(F.col("EventDate").alias("date"), F.col("Tier").alias("event_type"), F.col("EventID").alias("event_id")).distinct()


def _run(spark: SparkSession, tables: dict[str, DataFrame], checks: DataFrame, summary: DataFrame | None, name: str, **more: object) -> DataFrame:
    """The outcome of publishing, as the folder and the status show it."""
    folder = shared_folder(spark)
    out = publishing.publish(tables, checks, summary, folder, window=_WINDOW, **more)
    status = spark.read.text(f"{folder}/statistics.status.json", wholetext=True)
    field: dict[str, Column] = {c: F.get_json_object("value", f"$.{c}") for c in ("complete", "partial", "registry_count", "fetched_count", "invariant_problem_count")}
    shown = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").schema(tables["decks"].schema).parquet(f"{out.folder}/decks").count() if out.folder else 0
    return status.select(F.lit(name).alias("run"), F.lit(out.state).alias("state"), F.lit(out.reason).alias("reason"), F.lit(shown).cast("long").alias("rows_shown"), *(v.alias(c) for c, v in field.items()))


@query(PRESENCE.replace(H, _FULL) + """, a AS (SELECT count(DISTINCT EventID) AS r, count(DISTINCT EventID) FILTER (CAST(EventID AS BIGINT) % 6 <> 0) AS f, (SELECT count(*) FROM p) AS n FROM h), b AS (SELECT count(*) AS bad FROM (""" + _EVENTS.rpartition(" UNION ALL ")[0] + """))
    SELECT 'complete' AS run, 'full' AS state, '' AS reason, n AS rows_shown, 'true' AS complete, 'false' AS partial, CAST(r AS VARCHAR) AS registry_count, CAST(r AS VARCHAR) AS fetched_count, CAST(NULL AS VARCHAR) AS invariant_problem_count FROM a
    UNION ALL SELECT 'missing', 'withheld', 'incomplete', 0, 'false', 'false', CAST(r AS VARCHAR), CAST(f AS VARCHAR), NULL FROM a
    UNION ALL SELECT 'missing, allowed', 'partial', 'incomplete', n, 'false', 'true', CAST(r AS VARCHAR), CAST(f AS VARCHAR), NULL FROM a
    UNION ALL SELECT 'other window', 'withheld', 'windows differ', 0, 'false', 'false', CAST(r AS VARCHAR), CAST(r AS VARCHAR), NULL FROM a
    UNION ALL SELECT 'no registry', 'withheld', 'incomplete', 0, 'false', 'false', NULL, NULL, NULL
    UNION ALL SELECT 'faulty', 'withheld', 'checks', 0, 'false', 'false', NULL, NULL, CAST(bad AS VARCHAR) FROM b""")
def q05_q08_published_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six runs on the same events: what is to see of each, and what its status says.

    The events, and what more than one run takes of them (tables, checks, states of the registry), are written once.
    """
    h = cut(whole_events(spark, sf_dir).select("EventID", "EventDate", "Tier", "Place", "Deck", "Pilot", "LoginID"))
    tables = {"decks": cut(P.presence(h)), "finalists": cut(P.finalists(h))}
    checks = cut(I.event_rules(h, size=SIZE))
    registry = cut(h.select("EventID", "EventDate", F.lit(SIZE).alias("size"), F.lit("challenge").alias("kind")).distinct())
    note = publishing.premier_note(_notes(h).limit(0), "F", *_WINDOW)
    state = lambda stored: publishing.completeness(cut(publishing.registry_state(registry, stored.withColumn("Format", F.lit("F")), "F")), note)
    whole, some = state(h), state(h.where("CAST(EventID AS BIGINT) % 6 <> 0"))
    run = lambda name, checks=checks, summary=whole, **more: _run(spark, tables, checks, summary, name, **more)
    runs = [run("complete"), run("missing", summary=some), run("missing, allowed", summary=some, allow_partial=True), run("other window", meta_window=("1992-01-01", "1998-12-24")), run("no registry", summary=None), run("faulty", checks=I.event_rules(_faulty(h), size=SIZE))]
    return reduce(DataFrame.unionByName, runs)
