"""The thirteen operators as registered queries on the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm import decontam, lm, negatives, pieces, pii, quality, resample, sharding, simhash, suffix, toxicity, trie, urls
from stagewise.llm.common import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).drop("alias_group")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op8_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    # an item without an id counts in n_hit, and has no place in a list of ids
    items = F.array_sort(F.array_compact(F.array_distinct(F.transform("matches", lambda m: m["item_id"]))))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = negatives.whole_vectors(table(spark, sf_dir, "embeddings"))
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), anchors=F.col("id") % 50 == 0)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = trie.shared_openings(trie.sequences(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(trie.keyed(rebuilt))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_url_filter, op3_suffix_dedup, op4_pii, op5_toxicity, op6_quality, op7_lm,
                                    op8_resample, op9_decontaminate, op10_sentencepiece, op11_hard_negatives, op12_conversation_trie, op13_sharding, pipeline)}
