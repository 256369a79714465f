"""The queries of this subpackage, each over a whole table of the data folder, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderworks.llm.common import scratch_root, table
from ladderworks.llm.exact_dedup import exact_copies
from ladderworks.llm.language_id import fitted, languages
from ladderworks.llm.lexical_search import ranked
from ladderworks.llm.line_dedup import line_verdicts
from ladderworks.llm.merkle import tampered
from ladderworks.llm.mixing import mixed
from ladderworks.llm.packing import packed
from ladderworks.llm.pii import digest, personal_data
from ladderworks.llm.quality_rules import quality_verdicts
from ladderworks.llm.sharding import ShardStore
from ladderworks.llm.simhash_dedup import near_groups
from ladderworks.llm.substring_dedup import without_repeats
from ladderworks.llm.url_filter import judge, labelled_urls, train


def op1_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), train(labelled_urls(spark)))


def op2_compacted_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after twelve arrivals and their compaction, read from the newest manifest."""
    store = ShardStore(spark, f"{scratch_root(spark)}/shards-{uuid.uuid4().hex}", target_bytes=64 << 20)
    store.append_arrivals(table(spark, sf_dir, "documents").withColumn("arrival", F.pmod("doc_id", F.lit(12))), "arrival")
    store.compact()
    store.vacuum()
    return store.read().select("doc_id", "lang", "source", "n_chars", F.char_length("text").cast("long").alias("length"), F.sha2("text", 256).alias("text_sha256"))


#: Weights of the domains (sources by their number, modulo four) and of languages within them.
WEIGHTS = {(f"domain{d}",): w for d, w in enumerate((4.0, 3.0, 2.0, 1.0))} | {(f"domain{d}", lang): w for d in range(4) for lang, w in (("en", 5.0), ("de", 2.0), ("fr", 2.0), ("es", 1.0))}


def mixture(docs: DataFrame, budget_share: float = 0.8) -> DataFrame:
    """Documents mixed with the weights above."""
    number = F.regexp_extract("source", "([0-9]*)$", 1).try_cast("int")
    return mixed(docs, F.concat(F.lit("domain"), F.pmod(number, F.lit(4)).cast("string")), WEIGHTS, budget_share=budget_share)


def op3_hierarchical_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixture(table(spark, sf_dir, "documents"))
    return rows.select("doc.doc_id", "domain", "doc.lang", "doc.source", "epoch", F.col("tokens").alias("n_tokens"), "taken")


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_verdicts(table(spark, sf_dir, "documents"))


def op5_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(personal_data(table(spark, sf_dir, "documents")))


def op7_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op8_exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"))


def op9_simhash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("kept", "kept_sha256")


def op11_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampered(table(spark, sf_dir, "documents"))


def op13_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by a model that has learned from three quarters of the documents; a row with a null id isn't learned from."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    docs = table(spark, sf_dir, "documents")
    return languages(docs, fitted(docs.where(~held_out))).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_url_model, op2_compacted_shards, op3_hierarchical_mixture, op4_fuzzy_lines, op5_best_two_fit, op6_personal_data, op7_quality_outliers, op8_exact_copies, op9_simhash_tree, op10_repeated_passages, op11_threshold_search, op12_merkle_manifest, op13_languages)}

ORACLES: dict[str, str] = {
    "op2_compacted_shards": "SELECT doc_id, lang, source, n_chars, length(text) AS length, sha256(text) AS text_sha256 FROM documents",
    "op8_exact_copies": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        r AS (
            SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r""",    "op10_repeated_passages": r"""
        WITH lists AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM lists),
        windows AS (
            SELECT doc_id, i, string_agg(word, ' ') OVER w AS t, count(*) OVER w AS n FROM words
            WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
        placed AS (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS place FROM windows WHERE n = 20),
        later AS (SELECT doc_id, i, place > 1 AS gone FROM placed),
        covered AS (
            SELECT words.doc_id, words.i, word,
                   coalesce(bool_or(gone) OVER (PARTITION BY words.doc_id ORDER BY words.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
            FROM words LEFT JOIN later USING (doc_id, i)),
        kept AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS t
            FROM covered GROUP BY doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM documents LEFT JOIN kept USING (doc_id)""",
    "op11_threshold_search": r"""
        WITH t AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        counts AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
        sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY ALL),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts CROSS JOIN totals WHERE term IN (SELECT term FROM asked) GROUP BY term),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id) CROSS JOIN totals GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 50""",
    "op12_merkle_manifest": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, text,
                   concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                             coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS front,
                   list_reduce(list_prepend(4294967295::BIGINT, [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
                       lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS rest
            FROM documents),
        leaves AS (
            SELECT doc_id, source, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN (xor(rest, 4294967295) & 1) = 0 THEN replace(text, chr(10), '') ELSE text END AS other,
                   sha256(front || coalesce(strlen(other) || ':' || other, '-')) AS start,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
            FROM d),
        low(source, level, i, n, node) AS (
            SELECT source, 0, i, n, leaf FROM leaves
            UNION ALL
            SELECT source, any_value(level) + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(node, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY source, i // 3),
        high(level, i, n, node, source) AS (
            SELECT 100, row_number() OVER (ORDER BY source NULLS FIRST) - 1, count(*) OVER (), node, source FROM low WHERE n = 1
            UNION ALL
            SELECT any_value(level) + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(node, '' ORDER BY i)), NULL FROM high WHERE n > 1 GROUP BY i // 3),
        nodes AS (
            SELECT source, level, i, n, node FROM low WHERE n > 1 UNION ALL SELECT NULL, level, i, n, node FROM high WHERE n > 1),
        sides AS (
            SELECT a.source, a.level, a.i, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, coalesce(string_agg(b.node, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
            FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.i // 3 = b.i // 3 GROUP BY ALL),
        folds(doc_id, leaf, source, level, i, n, node, proof) AS (
            SELECT doc_id, leaf, source, 0, i, n, start, '' FROM leaves
            UNION ALL
            SELECT doc_id, leaf, f.source, CASE WHEN f.n > 1 THEN f.level + 1 ELSE 100 END,
                   CASE WHEN f.n > 1 THEN f.i // 3 ELSE (SELECT any_value(h.i) FROM high h WHERE h.level = 100 AND h.source IS NOT DISTINCT FROM f.source) END,
                   CASE WHEN f.n > 1 THEN (f.n + 2) // 3 ELSE (SELECT count(*) FROM high h WHERE h.level = 100) END,
                   CASE WHEN f.n > 1 THEN sha256(l || node || r) ELSE node END, CASE WHEN f.n > 1 THEN proof || l || r ELSE proof END
            FROM folds f LEFT JOIN sides s ON s.level = f.level AND s.i = f.i AND s.source IS NOT DISTINCT FROM CASE WHEN f.level < 100 THEN f.source END AND f.n > 1
            WHERE f.n > 1 OR f.level < 100)
        SELECT doc_id, leaf, low.node AS subroot, high.node AS root, sha256(proof) AS proof_sha256, folds.node AS folded_root, folds.node = high.node AS verified
        FROM folds JOIN low ON low.n = 1 AND low.source IS NOT DISTINCT FROM folds.source JOIN high ON high.n = 1
        WHERE folds.level >= 100 AND folds.n = 1""",
}
