"""The business tables of the data folder in the shape of event results and market shares, and the same as SQL.

Orders are events and their lines the entries, placed by price; brands are decks, part types archetypes and suppliers
pilots, every seventh of whom has no login.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, dates: str = "") -> Callable:
    """Registers a query under its name, with SQL that gives the same rows. The columns in `dates` are given as text."""
    names = dates.split()

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = (lambda spark, sf_dir: f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in names})) if names else f
        if sql:
            ORACLES[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in names)}) FROM ({sql})" if names else sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event history. Lines meet orders by the order key, so the places need no second shuffle; parts join last."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_quantity")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_linenumber"))
    rows = lines.withColumn("Place", place).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.col("o_orderkey").cast("string").alias("EventID"), F.to_date("o_orderdate").alias("EventDate"), F.col("o_orderstatus").alias("Format"), F.col("o_orderpriority").alias("Tier"),
        F.concat(F.lit("event-"), F.col("o_orderkey").cast("string")).alias("EventSlug"), "Place", F.col("p_brand").alias("Deck"), F.col("p_type").alias("Archetype"), F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("Pilot"),
        F.when(F.col("l_suppkey") % 7 == 0, "").otherwise(F.col("l_suppkey").cast("string")).alias("LoginID"), F.col("l_quantity").alias("Games"), F.col("l_returnflag").alias("Flag"), F.col("p_name").alias("RawDeck"),
        F.when(F.col("o_orderkey") % 10 == 0, "Premier").otherwise("Challenge").alias("EventClass"), (F.col("o_orderkey") * 100 + F.col("Place")).alias("row_id"),
    )


#: The same as the start of a SQL statement: common table expression `h`.
H = """WITH h AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS EventID, CAST(o_orderdate AS DATE) AS EventDate, o_orderstatus AS Format, o_orderpriority AS Tier,
           'event-' || o_orderkey AS EventSlug,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS Place,
           p_brand AS Deck, p_type AS Archetype, 'P' || l_suppkey AS Pilot,
           CASE WHEN l_suppkey % 7 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS LoginID,
           CASE WHEN l_suppkey % 7 = 0 THEN 'name:p' || l_suppkey ELSE 'id:' || l_suppkey END AS K,
           l_quantity AS Games, l_returnflag AS Flag, p_name AS RawDeck,
           CASE WHEN o_orderkey % 10 = 0 THEN 'Premier' ELSE 'Challenge' END AS EventClass
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
"""

#: Shares by brand as SQL: common table expression `m` after `h`.
M = """, m AS (
    SELECT Deck, 100.0 * count(*) / (SELECT count(*) FROM h) AS Meta,
           count(*) FILTER (Flag = 'R') / CAST(count(*) AS DOUBLE) AS Winrate, CAST(sum(Games) AS BIGINT) AS Games, min(Archetype) AS Archetype
    FROM h GROUP BY Deck)
"""


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market share of each brand: Deck, Meta in percent, Winrate, Games and an archetype."""
    rows = history(spark, sf_dir).groupBy("Deck").agg(F.count("*").alias("n"), F.count_if(F.col("Flag") == "R").alias("w"), F.sum("Games").cast("long").alias("Games"), F.min("Archetype").alias("Archetype"))
    total = rows.agg(F.sum("n").alias("total"))
    return rows.crossJoin(F.broadcast(total)).select("Deck", (100.0 * F.col("n") / F.col("total")).alias("Meta"), (F.col("w") / F.col("n")).alias("Winrate"), "Games", "Archetype")


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two first of each order as winner and loser of a final."""
    h = history(spark, sf_dir)
    side = lambda p, c: h.where(F.col("Place") == p).select("EventID", *( ["EventDate"] if p == 1 else []), F.col("Pilot").alias(f"{c}Pilot"), F.col("LoginID").alias(f"{c}LoginID"), F.col("Deck").alias(f"{c}Deck"))
    return side(1, "Winner").join(side(2, "Loser"), "EventID").withColumn("Round", F.lit("F"))
