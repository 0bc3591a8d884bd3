"""From raw documents to token ids: the pipeline over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs.  All stages but
the last return the columns of documents.

1. quality rules: documents that a rule rejects go.
2. exact dedup: of equal texts, the row with the largest doc_id stays.
3. near dedup: of each SimHash group, the document with the least doc_id
   stays.
4. mixing: each remaining document is repeated (0, 1 or 2 times) as the
   mix to source weights takes it.
5. byte-level BPE: each row's token ids and character offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.llm import byte_bpe, exact_dedup, mixing, quality_rules, simhash
from headway.llm.tables import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the number of tokens."""
    return byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), out="tokens",
                           splits=False).selectExpr(
        "doc_id", "lang", "source", "size(tokens.ids) AS n_tokens", "tokens.ids AS ids",
        "tokens.start AS char_start", "tokens.end AS char_end")


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near),
          ("mixing", mixed), ("byte-level BPE", encoded)]

#: No SQL: fingerprints and token ids can't be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over all that the stage before kept."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES, 1):
        docs = stored(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
