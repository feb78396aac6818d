"""One query per operator over its whole table, and the SQL that tells the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, itq, jaccard_join, language_id, mixing, sharding, simple8b, toxicity, vptree, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to Simple-8b files in order of doc_id and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simple8b.encode_table(docs, bpe.load_spec(public_tokenizers.path("word_bpe_49k.json")), end_id=2)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt where crc32 of doc_id isn't divisible by 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    away = language_id.held_out("doc_id", 5, 0)
    model = language_id.fit(docs, ~away)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", away.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.ambiguous")


#: Weights of the sources, in turn.
WEIGHTS = [3, 1, 2]


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, WEIGHTS).select("doc_id", "mixed.size", "mixed.source_size", "mixed.target", "mixed.taken")


def bpe_digests(done: DataFrame) -> DataFrame:
    """Number and digest of ids, and digest of decoded text, of a table with ids and decoded."""
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op5_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows nearest to each row whose vec_id is divisible by 20."""
    return vptree.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20, factor=1.0)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.interleave(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), shards=8).drop("source")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels where crc32 of doc_id modulo 3 isn't 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    away = language_id.held_out("doc_id", 3, 1)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~away)
    found = toxicity.score(docs, model)
    return found.select("doc_id", away.alias("held_out"), "toxicity.score", "toxicity.predicted", "toxicity.evidence")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all pages, written to archives and read back."""
    records = warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard_join.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component and number of links of every embedding."""
    return itq.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Query] = {
    "op1_simple8b": op1_simple8b,
    "op2_language_id": op2_language_id,
    "op3_mixing": op3_mixing,
    "op4_bpe": op4_bpe,
    "op5_vptree": op5_vptree,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_itq": op10_itq,
}
ORACLES: dict[str, str] = {
    "op3_mixing": mixing.sql(WEIGHTS),
    "op5_vptree": vptree.sql(),
    "op6_sharding": sharding.sql(),
    "op8_warc": warc.sql(),
    "op9_jaccard_join": jaccard_join.sql(),
    "op10_itq": itq.sql(),
}
