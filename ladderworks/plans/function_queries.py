"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderworks.functions import scoring as S
from ladderworks.functions import text as T
from ladderworks.operators import metagame as M
from ladderworks.plans.standins import H, history, query, read, shares
from ladderworks.sources import tables
from ladderworks.plans.standins import M as SHARES


def _pick(values: list[str], by: str):
    return F.element_at(F.array(*map(F.lit, values)), (F.col(by) % len(values) + 1).cast("int"))


def _picked(values: list[str], by: str) -> str:
    return "(" + "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"])[CAST({by} % {len(values)} + 1 AS INT)]"


@query(r"""SELECT p_partkey, lower(trim(regexp_replace(x, '\s+', ' ', 'g'))) AS name, regexp_replace(lower(x), '[^a-z0-9]+', '', 'g') AS token,
    replace(lower(trim(regexp_replace(x, '\s+', ' ', 'g'))), ' ', '-') AS slug, regexp_replace(regexp_replace(lower(x), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS file
    FROM (SELECT p_partkey, '  ' || upper(p_name) || chr(9) || '  ' || p_brand || ' ' AS x FROM part)""")
def f01_f02_f34_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t  "), F.col("p_brand"), F.lit(" "))
    rows = read(spark, sf_dir, "part").select("p_partkey", x.alias("x"))
    return rows.select("p_partkey", T.normalize_name("x").alias("name"), T.format_token("x").alias("token"), T.format_slug("x").alias("slug"), T.slugify("x").alias("file"))


@query(r"""SELECT p_partkey, CASE WHEN x LIKE '% %' THEN x ELSE regexp_replace(x, '([a-z])([A-Z])', '\1 \2', 'g') END AS name,
    trim(regexp_replace('Generic ' || x, '(?i)generic ', '')) = x AS same
    FROM (SELECT p_partkey, upper(a[1]) || a[2:] || CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE '' END || upper(b[1]) || b[2:] AS x
          FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part))""")
def f03_camel_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda i: F.initcap(F.split_part("p_name", F.lit(" "), F.lit(i)))
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat(part(1), F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(""), part(2)).alias("x"))
    same = T.clean_deck_name(F.concat(F.lit("Generic "), F.col("x"))) == T.expand_camel_case("x")
    return rows.select("p_partkey", T.expand_camel_case("x").alias("name"), same.alias("same"))


_NUMBERS = ["12,5 %", "55%", "0.42", "1", "abc", "", "1,234", "-7", "3.9", "99.9%"]


@query(f"""SELECT p_partkey, try_cast(t AS DOUBLE) AS pct, CASE WHEN try_cast(t AS DOUBLE) > 1 THEN try_cast(t AS DOUBLE) / 100 ELSE try_cast(t AS DOUBLE) END AS share,
    greatest(0, coalesce(CAST(trunc(try_cast(replace(trim(x), ',', '') AS DOUBLE)) AS INT), 0)) AS n
    FROM (SELECT p_partkey, x, trim(replace(replace(trim(x), '%', ''), ',', '.')) AS t FROM (SELECT p_partkey, {_picked(_NUMBERS, 'p_partkey')} AS x FROM part))""")
def f04_f05_f30_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", _pick(_NUMBERS, "p_partkey").alias("x"))
    return rows.select("p_partkey", T.parse_percent("x").alias("pct"), T.parse_percent("x", decimal=True).alias("share"), T.parse_count("x").alias("n"))


@query("SELECT p_partkey, p_size / 100.0 AS share FROM part")
def f06_whole_column_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 5 == 0, "%").otherwise("")).alias("share"))
    return M.whole_column_percent(rows, "share")


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g'),
    '&copy;', '©'), '&middot;', '·'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS t FROM pages""")
def f07_strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", T.strip_html("html").alias("t"))


_POINTS = "CASE WHEN Place = 1 THEN 5 WHEN Place = 2 THEN 4 WHEN Place <= 4 THEN 3 WHEN Place <= 8 THEN 2 WHEN Place <= 16 THEN 1 ELSE 0 END"


@query(H + f"SELECT EventID, Place, K AS key, {_POINTS} AS points, 2 * {_POINTS} AS premier FROM h")
def f08_f09_f10_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(spark, sf_dir).select("EventID", "Place", T.identity_key("LoginID", "Pilot").alias("key"), S.league_points("Place").alias("points"), S.premier_points("Place").alias("premier"))


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, month(o_orderdate) AS m, year(o_orderdate) AS y FROM orders),
    s AS (SELECT *, CASE WHEN m < 3 THEN y - 1 ELSE y END AS f FROM o),
    t AS (SELECT o_orderkey, d, CASE WHEN m BETWEEN 3 AND 5 THEN 'Spring ' || y WHEN m BETWEEN 6 AND 8 THEN 'Summer ' || y WHEN m BETWEEN 9 AND 11 THEN 'Autumn ' || y
            ELSE 'Winter ' || f || '/' || lpad(CAST((f + 1) % 100 AS VARCHAR), 2, '0') END AS season,
          CASE WHEN m BETWEEN 3 AND 5 THEN make_date(y, 3, 1) WHEN m BETWEEN 6 AND 8 THEN make_date(y, 6, 1) WHEN m BETWEEN 9 AND 11 THEN make_date(y, 9, 1) ELSE make_date(f, 12, 1) END AS a FROM s)
    SELECT o_orderkey, season, a AS starts, last_day(CAST(a + INTERVAL 2 MONTH AS DATE)) AS ends, replace(replace(season, '/', '-'), ' ', '_') AS slug FROM t""", dates="starts ends")
def f11_f12_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", S.season(F.to_date("o_orderdate")).alias("s"))
    return rows.select("o_orderkey", F.col("s.label").alias("season"), F.col("s.start").alias("starts"), F.col("s.end").alias("ends"), S.season_slug("s.label").alias("slug"))


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), s AS (SELECT *, d - CAST(dayofweek(d) AS INT) AS sunday FROM o),
    w AS (SELECT *, unnest([0, 1, 2]) AS i FROM s)
    SELECT o_orderkey, sunday, i, sunday - 7 * i - 13 AS starts, sunday - 7 * i AS ends,
           (year(sunday - 7 * i) * 12 + month(sunday - 7 * i)) - (year(sunday - 7 * i - 13) * 12 + month(sunday - 7 * i - 13)) + 1 AS months FROM w""", dates="sunday starts ends")
def f13_f14_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select("o_orderkey", S.latest_sunday(F.to_date("o_orderdate")).alias("sunday"))
    out = rows.select("o_orderkey", "sunday", F.posexplode(S.windows(F.col("sunday"), 3, 14)).alias("i", "w"))
    return out.select("o_orderkey", "sunday", "i", F.col("w.start").alias("starts"), F.col("w.end").alias("ends"), F.size(S.months_between(F.col("w.start"), F.col("w.end"))).alias("months"))


@query(H + SHARES + """SELECT Deck, CASE WHEN Meta - 4 > 0.1 THEN 'Rising' WHEN Meta - 4 < -0.1 THEN 'Falling' ELSE 'Stable' END AS trend,
    CASE WHEN Games >= 150 THEN 'Trusted' ELSE 'Sample' END AS trust FROM m""")
def f15_f17_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares(spark, sf_dir).select("Deck", S.trend_label(F.col("Meta"), F.lit(4.0), 0.1).alias("trend"), S.trust_label("Games").alias("trust"))


@query(H + SHARES + """, w AS (SELECT Deck, Winrate AS p, unnest(range(0, 6)) AS w FROM m)
    SELECT Deck, CAST(w AS INT) AS wins, round_even(factorial(5) / (factorial(CAST(w AS INT)) * factorial(CAST(5 - w AS INT))) * pow(p, w) * pow(1 - p, 5 - w) * 1e6, 0) / 1e6 AS p FROM w""")
def f18_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shares(spark, sf_dir).select("Deck", F.posexplode(S.record_probabilities(F.col("Winrate"), 5)).alias("wins", "p"))
    return rows.select("Deck", "wins", S.rounded("p", 6).alias("p"))


@query("""WITH k AS (SELECT p_partkey, CAST(round_even(p_size * 20.0, 0) AS INT) % 60 AS k FROM part)
    SELECT p_partkey, k, CASE WHEN k = 0 THEN 1.0 ELSE round_even((1 - (1000.0-k)/1000 * (999.0-k)/999 * (998.0-k)/998 * (997.0-k)/997 * (996.0-k)/996) * 1e6, 0) / 1e6 END AS open,
    CASE WHEN k = 0 THEN 0.0 ELSE round_even((1 - (1000.0-k)/1000 * (999.0-k)/999 * (998.0-k)/998 * (997.0-k)/997 * (996.0-k)/996) * 1e6, 0) / 1e6 END AS chart FROM k""")
def f19_f20_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", (S.copies(F.col("p_size") * 2.0, 1000) % 60).alias("k"))
    return rows.select("p_partkey", "k", S.rounded(S.hits_at_least_one(F.col("k"), 1000, 5), 6).alias("open"), S.rounded(S.hits_at_least_one(F.col("k"), 1000, 5, none=0.0), 6).alias("chart"))


_CHOICES = "(" + " + ".join(f"(coalesce(list_product([1000.0 - k - i FOR i IN range({5 - j})]), 1) * list_product([(k - i) * 1.0 FOR i IN range({j})]) * {w})" for j, w in ((2, 10), (3, 10), (4, 5), (5, 1))) + ") / (1000.0 * 999 * 998 * 997 * 996)"


@query(f"""WITH k AS (SELECT p_partkey, p_size - 2 AS k FROM part), c AS (SELECT p_partkey, greatest(k, 0) AS k FROM k)
    SELECT p_partkey, k, round_even(CASE WHEN k = 0 THEN 1 WHEN k = 1 THEN 0.005 ELSE {_CHOICES} END * 1e9, 0) / 1e9 AS two, CAST(0 AS DOUBLE) AS none FROM c""")
def f19_encounters_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meeting two copies or more; of one copy, or none, as many as there are."""
    rows = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") - 2).alias("k"))
    return rows.select("p_partkey", F.greatest("k", F.lit(0)).alias("k"), S.rounded(S.hits_at_least(F.col("k"), 1000, 5, 2), 9).alias("two"), S.hits_at_least(F.col("k"), 1000, 0, 2).alias("none"))


_DECKS = ["Boros Burn", "Jund Rock", "UW Control", "Ruby Storm", "Mono G Tron", "Izzet Murktide", "Lantern Prison", "Living End", "Jeskai Blink", "Izzet Prowess", "Sultai Midrange", "reanimator", "WUBRG", "Domain Zoo", "Merfolks", "  ", "Unkown", "N/A", "NA", "none", "Null", "?", "-", "nan", "mostly unknown"]


@query(rf"""WITH d AS (SELECT p_partkey, x, lower(trim(x)) AS n FROM (SELECT p_partkey, {_picked(_DECKS, 'p_partkey')} AS x FROM part))
    SELECT p_partkey, CASE WHEN regexp_matches(n, '\b(burn|zoo|prowess|aggro|humans|goblins|elves|merfolk|infect|affinity|hammer)\b') THEN 'Aggro' WHEN regexp_matches(n, '\b(midrange|rock|jund|abzan|golgari)\b') THEN 'Midrange'
        WHEN regexp_matches(n, '\b(control|azorius)\b') THEN 'Control' WHEN regexp_matches(n, '\b(combo|storm|belcher)\b') THEN 'Combo' WHEN regexp_matches(n, '\b(ramp|tron|titan)\b') THEN 'Ramp' WHEN regexp_matches(n, '\b(tempo|delver|murktide)\b') THEN 'Midrange'
        WHEN regexp_matches(n, '\b(prison|lantern|lock)\b') THEN 'Prison' WHEN regexp_matches(n, '\b(reanimator|goryo|living end|dredge)\b') THEN 'Graveyard' ELSE 'Unknown' END AS guess,
    CASE WHEN n = 'reanimator' THEN 'Graveyard' WHEN n = '' THEN 'Unknown' ELSE trim(x) END AS label, CASE WHEN n = 'sultai midrange' THEN 'Midrange' ELSE 'Other' END AS forced,
    regexp_matches(trim(x), '^[A-Z]{{1,5}}$') OR regexp_matches(n, '^[wubrg]{{1,5}}$') AS code,
    CASE WHEN n LIKE '%jeskai%' AND (n LIKE '%blink%' OR n LIKE '%evoke%') THEN 'Jeskai Blink' WHEN n LIKE '%domain%' AND n LIKE '%zoo%' THEN 'Domain Zoo' WHEN n LIKE '%izzet%' AND (n LIKE '%prowess%' OR n LIKE '%steel%') THEN 'Prowess' ELSE x END AS keyword,
    n IN ('', 'unknown', 'unkown', 'n/a', 'na', 'none', 'null', '?', '-') OR n LIKE '%unknown%' AS unknown FROM d""")
def f21_f24_f33_f42_archetypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", _pick(_DECKS, "p_partkey").alias("x"))
    return rows.select("p_partkey", T.heuristic_archetype("x").alias("guess"), T.archetype_label("x").alias("label"), T.archetype_override("x", "x", F.lit("Other")).alias("forced"), T.is_code_like("x").alias("code"), T.keyword_archetype("x").alias("keyword"), T.is_unknown("x").alias("unknown"))


@query(r"""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Modern Challenge ' || p_size WHEN 1 THEN 'Modern RC ' || upper(p_type[1]) || lower(p_type[2:]) WHEN 2 THEN 'C' || p_size WHEN 3 THEN 'Premier' WHEN 4 THEN 'Super Qualifier RC' ELSE 'C64x' END AS label,
    CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size % 3 = 0 THEN NULL ELSE '#ab' || lpad(CAST(p_size AS VARCHAR), 4, '0') END AS color,
    CASE WHEN p_size % 2 = 0 THEN 'classic' ELSE 'neon' END AS style FROM part""")
def f28_f31_f40_f41_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    m = F.col("p_partkey") % 6
    tier = F.when(m.isin(0, 2), F.concat(F.lit(" C"), size)).when(m == 1, F.concat(F.lit("modern_rc--"), F.lower("p_type"))).when(m == 3, "  ").when(m == 4, "super-qualifier rc_").otherwise("c64X")
    kind = F.when(m.isin(0, 5), "Challenge").otherwise("Premier")
    color = F.concat(F.when(F.col("p_size") % 3 == 0, "#xy").otherwise("#AB"), F.lpad(size, 4, "0"))
    style = F.when(F.col("p_size") % 2 == 0, "sepia").otherwise("Neon")
    return read(spark, sf_dir, "part").select("p_partkey", T.event_label(tier, kind).alias("label"), T.event_id(F.concat(F.col("p_partkey").cast("string"), F.lit(".0"))).alias("id"), T.hex_color(color).alias("color"), T.style_of(style, ["classic", "neon"]).alias("style"))


@query("SELECT p_partkey, p_name || ' / ' || p_brand AS names, 2 AS n FROM part")
def f32_source_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.concat(F.col("p_name"), F.lit(" | "), F.col("p_brand"), F.lit(" |  | "), F.upper("p_name"))
    names = T.source_names(x)
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(names, " / ").alias("names"), F.size(names).alias("n"))


@query("""SELECT p_partkey, p_size % 25 AS score, p_partkey % 9 AS rounds, len(list_filter(range(0, CAST(p_partkey % 9 + 1 AS BIGINT)), lambda w: p_size % 25 - 3 * w BETWEEN 0 AND p_partkey % 9 - w)) > 0 AS ok FROM part""")
def f35_reachable_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 25).alias("score"), (F.col("p_partkey") % 9).alias("rounds"))
    return rows.select("*", S.reachable_score(F.col("score"), F.col("rounds")).alias("ok"))


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, strftime(d, '%Y/%m/') || 'W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') || '_' || (d - 13) || '_to_' || d AS folder, d - 13 AS starts, d AS ends,
    CASE WHEN d + (7 - CAST(dayofweek(d) AS INT)) % 7 + 7 <= DATE '1998-06-17' + 7 THEN d + (7 - CAST(dayofweek(d) AS INT)) % 7 + 7 ELSE DATE '1998-06-14' END AS anchor FROM o""", dates="starts ends anchor")
def f36_f38_k11_run_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    rows = read(spark, sf_dir, "orders").select("o_orderkey", d.alias("d"), S.week_folder(F.date_sub(d, 13), d).alias("folder"))
    w = S.week_of_path(F.col("folder"))
    return rows.select("o_orderkey", "folder", w["week_start"].alias("starts"), w["week_end"].alias("ends"), S.next_anchor(F.col("d"), F.lit("1998-06-17").cast("date")).alias("anchor"))


@query("""WITH c AS (SELECT doc_id, list_distinct(string_split(lower(text), ' ')) AS w FROM documents)
    SELECT doc_id, CASE WHEN list_has_any(w, ['der', 'die']) THEN 'German' WHEN list_has_any(w, ['le', 'les']) THEN 'French' WHEN list_has_any(w, ['the']) THEN 'English' ELSE 'Unknown' END AS label FROM c""")
def f37_signature_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents")
    return rows.select("doc_id", T.signature_archetype(F.split(F.lower("text"), " "), [("German", ["der", "die"]), ("French", ["le", "les"]), ("English", ["the"])]).alias("label"))


@query("""SELECT event_type AS endpoint, substr(md5(event_type || '?k=' || json_extract_string(props, '$.k') || '&user=' || user_id), 1, 16) AS key, count(*) AS n FROM events GROUP BY ALL""")
def s08_cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = F.create_map(F.lit("user"), F.col("user_id").cast("string"), F.lit("k"), F.get_json_object("props", "$.k"))
    return read(spark, sf_dir, "events").select(F.col("event_type").alias("endpoint"), tables.cache_key(F.col("event_type"), params).alias("key")).groupBy("endpoint", "key").agg(F.count("*").alias("n"))
