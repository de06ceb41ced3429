"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabaudit.llm import bpe, exact_dedup, hard_negatives, language_id, merkle, mixing, ngram_join, packing, pii, quality, quality_rules, sharding, token_counts
from tabaudit.llm.common import text_of

Query = Callable[[SparkSession, str], DataFrame]

#: The mix of the queries: weights by the rank of the source, and the part of all words that is taken.
MIX_WEIGHTS, MIX_SHARE, MIX_MOST = [3, 1, 2], 1.5, 2
SHARDS = 8
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def earlier(docs: DataFrame):
    """Stands for the order of arrival: which rows an earlier, immutable snapshot holds. The others are the new batch."""
    return F.pmod(F.xxhash64(docs["doc_id"]), F.lit(2)) == 0


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(table(spark, sf_dir, "documents"), MIX_SHARE, MIX_MOST, mixing.repeating(MIX_WEIGHTS))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(table(spark, sf_dir, "documents"), width=4, percent=85).drop("n_links")


def op6_shard_uniformly(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_of()
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = sharding.sharded(docs, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found_personal_data(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = exact_dedup.exact_groups(docs, earlier(docs))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).drop("character_distance", "word_distance")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text, low = F.col("text").cast("string"), F.translate(F.col("text").cast("string"), UPPER, UPPER.lower())
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & (text != low)
    other = F.when(hit, merkle.leaf_digest(*[low if name == "text" else F.col(name) for name in merkle.FIELDS]))
    found = merkle.proven(merkle.leaves(docs, tampered=other))
    found = found.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    proof = F.sha2(merkle.siblings(F.col("proof")), 256)
    return found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    scaled = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.select("vec_id", label.alias("label"), F.when(hard_negatives.finite("embedding"), scaled).alias("vector"))
    return hard_negatives.mined(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_language_id, op3_pack_sequences, op4_quality_classifier, op5_ngram_join,
        op6_shard_uniformly, op7_personal_data, op8_exact_dedup, op9_token_counts, op10_quality_rules,
        op11_merkle_manifest, op12_bpe, op13_hard_negatives,
    )
}
