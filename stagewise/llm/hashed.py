"""Hashed n-gram counts as native Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import cut

#: ASCII white space, as a regex class.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Runs of other than ASCII white space; a null text has none."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), SPACE), lambda w: w != "")


def counted_grams(docs: DataFrame, text: Column) -> DataFrame:
    """(target, gram) of every word and word pair: the hashes that ``hashes`` and ``pairs`` give."""
    w = docs.select("target", words(text).alias("w"))
    both = F.inline(F.arrays_zip(F.col("w").alias("a"), F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))).alias("b")))
    a, b = F.xxhash64("a"), F.xxhash64("b")
    grams = w.select("target", both).select("target", F.explode(F.array(a, F.when(F.col("b").isNotNull(), F.xxhash64(a, b)))).alias("gram"))
    return grams.where("gram is not null")


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def pairs(hashes: Column, apart: int, n: Column) -> Column:
    """Hash of each hash with the one ``apart`` places on; ``n`` is the length of ``hashes``."""
    return F.when(n > apart, F.zip_with(F.slice(hashes, F.lit(1), F.greatest(n - apart, F.lit(0))), F.slice(hashes, F.lit(apart + 1), F.greatest(n - apart, F.lit(0))),
                                        lambda a, b: F.xxhash64(a, b))).otherwise(F.array().cast("array<bigint>"))


def bucket_counts(grams: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n_target, n_raw) over ``grams`` (gram long, target boolean); partial counts are at most
    one row per bucket and task."""
    return (grams.groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket"))
            .agg(F.count_if("target").alias("n_target"), F.count(F.lit(1)).alias("n_raw")))


def log_ratios(counts: DataFrame, buckets: int, alpha: float) -> DataFrame:
    """(bucket, ratio): log P_target / P_raw of every bucket, both smoothed by ``alpha``; all zero without target rows."""
    t, r = counts.agg(F.coalesce(F.sum("n_target"), F.lit(0)), F.coalesce(F.sum("n_raw"), F.lit(0))).first()
    full = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0)
    p = (F.log((F.col("n_target") + alpha) / (t + alpha * buckets)) - F.log((F.col("n_raw") + alpha) / (r + alpha * buckets)))
    return full.select("bucket", (p if t else F.lit(0.0)).alias("ratio"))


def as_array(ratios: DataFrame) -> Column:
    """The ratios by bucket as one constant array, to nine digits; as many values as there are buckets."""
    values = [f"{r['ratio']:.9f}" for r in ratios.orderBy("bucket").toLocalIterator()]
    return F.split(F.lit(",".join(values)), ",").cast("array<double>")


def total_ratio(hashes: Column, ratios: Column, buckets: int) -> Column:
    return F.aggregate(hashes, F.lit(0.0), lambda acc, h: acc + F.element_at(ratios, F.pmod(h, F.lit(buckets)).cast("int") + 1))


def sample_of(labels: DataFrame, where: Column, most: int) -> DataFrame:
    """At most ``most`` labelled doc_ids (distinct), in the order of their hash; small enough to broadcast."""
    ids = labels.where(where & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long")).distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def target_ratios(docs: DataFrame, trusted: DataFrame, grams, buckets: int, alpha: float) -> DataFrame:
    """Ratios between the n-grams of the trusted documents and those of all ``docs``.

    ``grams`` takes the frame (doc_id, text, target) to (target, gram).  All rows are counted;
    ``trusted`` is a bounded list of ids.
    """
    marked = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(trusted.select("doc_id", F.lit(True).alias("target"))), "doc_id", "left"))
    return log_ratios(cut(bucket_counts(grams(marked.na.fill(False, ["target"])), buckets), "bucket-counts"), buckets, alpha)
