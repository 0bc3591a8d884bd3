"""One registered query per operator, over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import (byte_bpe, exact_dedup, html_text, language, mixing, pii, prefix_trie,
                         quality_rules, repair, secret_scan, simhash, token_counts, token_files)
from headway.llm.tables import scratch_folder, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page (by text, markup, address and host) and of
    every document (by text and source); the text model is fitted on a
    sample of the documents' language labels."""
    docs = table(spark, sf_dir, "documents")
    items = language.page_evidence(table(spark, sf_dir, "pages")).withColumn("kind", F.lit("page"))
    items = items.unionByName(language.document_evidence(docs).withColumn(
        "kind", F.lit("document")))
    found = language.identify(items, docs.select(F.col("doc_id").alias("id"), "text", "lang"),
                              ["kind", "id"])
    return found.select("kind", F.expr("IF(kind = 'document', id, NULL)").alias("doc_id"),
                        F.expr("IF(kind = 'page', id, NULL)").alias("page_id"), "lang", "prob",
                        "text_lang")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.page_texts(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix with weights 5, 2, 1 and a share of 150 % takes of
    every document."""
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a document's source is its repository."""
    return secret_scan.scan_report(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of its group of equal texts stays, for every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return exact_dedup.dedup_decisions(table(spark, sf_dir, "documents"),
                                       carry={"text_sha256": F.sha2(text, 256)})


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    turns = prefix_trie.turn_rows(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns)).drop("key")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage."""
    turns = table(spark, sf_dir, "conversations")
    return repair.report(turns, repair.repair(repair.damage(turns)))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and digest of every document's ids, from the ORC files
    that hold them all."""
    folder = scratch_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_files.read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", token_files.crc32_of("ids").alias("ids_crc32"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_language_id, op3_html_text, op4_source_mixing,
        op5_token_counts, op6_secret_scan, op7_quality_rules, op8_byte_bpe, op9_pii,
        op10_exact_dedup, op11_prefix_trie, op12_conversation_repair, op13_token_files)}

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

ORACLE_SQL: dict[str, str] = {
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size,
               d.doc_id IS NOT DISTINCT FROM g.keep_id
                 AND row_number() OVER (PARTITION BY d.t, d.doc_id) = 1 AS kept,
               sha256(d.t) AS text_sha256
        FROM d JOIN g USING (t)""",
    # Caps are reached in order of cap / weight: a source is capped if its
    # cap is at most its part of what the sources before it leave.
    "op4_source_mixing": f"""
        WITH d AS (SELECT doc_id, source, {_WORDS}::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, 2.0::DOUBLE * source_size AS most, [5, 2, 1][
                (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
        o AS (SELECT *, sum(most) OVER b AS held, sum(weight) OVER b AS gone,
                sum(source_size) OVER () AS total, sum(weight) OVER () AS pool FROM w
              WINDOW b AS (ORDER BY most / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        c AS (SELECT *, most <= (1.5::DOUBLE * total - coalesce(held, 0)) * weight
                / (pool - coalesce(gone, 0)) AS capped FROM o),
        r AS (SELECT any_value(total) AS total, any_value(pool) AS pool,
                coalesce(sum(most) FILTER (capped), 0) AS held,
                coalesce(sum(weight) FILTER (capped), 0) AS gone FROM c),
        t AS (SELECT source, source_size, CASE WHEN capped THEN most ELSE
                (1.5::DOUBLE * r.total - r.held)::DOUBLE * weight
                / (r.pool - r.gone)::DOUBLE END AS target FROM c, r),
        e AS (SELECT *, CASE WHEN source_size > 0
                THEN floor(target / source_size * 16777216.0::DOUBLE)::BIGINT ELSE 0 END AS each,
                ('0x' || substr(md5('0:' || coalesce(source, '')), 1, 6))::BIGINT AS off FROM t),
        k AS (SELECT d.*, e.source_size, e.target, e.each, e.off, row_number() OVER (
                PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) AS k
              FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
        n AS (SELECT *, (k * each + off) // 16777216 - ((k - 1) * each + off) // 16777216 AS copies
              FROM k)
        SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
               copies::BIGINT AS copies FROM n""",
}
