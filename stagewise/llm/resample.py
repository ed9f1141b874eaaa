"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

A document's log weight is the log-likelihood of its hashed words and word
pairs under the target model less that under the raw model.  Adding Gumbel
noise to the log weights and taking the k largest samples k documents without
replacement, in proportion to their weights.  The noise is a hash of the
doc_id, so a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm import hashed
from stagewise.llm.common import cut

BUCKETS, ALPHA, TRUSTED, SHARE, SEED = 1 << 14, 1.0, 20_000, 0.8, 20_251
BINS, LAST = 4096, 10_000


def kth_largest(values: DataFrame, col: str, k: int) -> float:
    """The k-th largest of a numeric column, exactly: bins are counted and narrowed until few values are left."""
    if k < 1:
        return float("inf")
    lo, hi, n = values.agg(F.min(col), F.max(col), F.count(col)).first()
    if k >= n:
        return lo if n else float("-inf")
    c = F.col(col)
    while n > LAST and lo < hi:
        width = (hi - lo) / BINS
        b = F.least(F.floor((c - lo) / width), F.lit(BINS - 1))
        found = values.where((c >= lo) & (c <= hi)).groupBy(b.alias("b")).agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).collect()
        for r in sorted(found, key=lambda r: -r["b"]):
            if k <= r["n"]:
                break
            k -= r["n"]
        if (r["lo"], r["hi"]) == (lo, hi):
            break
        lo, hi, n = r["lo"], r["hi"], r["n"]
    if lo == hi:
        return lo
    left = values.where((c >= lo) & (c <= hi)).groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("v")).toLocalIterator()
    for v, m in left:
        k -= m
        if k <= 0:
            return v
    raise AssertionError("counts changed while they were read")


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, gumbel_key, sampled) of every row of ``docs``.

    The ``share`` of the rows with the largest keys is sampled; rows that tie
    with the last one are sampled too.  Null and wordless texts have weight 0
    and no n-grams; they are never sampled.  Rows with the same id have the
    same noise; a null doc_id counts as one id and is never trusted.  Without
    target rows every log weight is 0.  An empty table gives no rows; other
    columns are not read.
    """
    trusted = hashed.sample_of(labels, F.col("quality") == 1, TRUSTED)
    text = F.lower(F.col("text").cast("string"))
    ratios = hashed.as_array(hashed.target_ratios(docs, trusted, lambda d: hashed.counted_grams(d, text), BUCKETS, ALPHA))
    u = (F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    d = docs.select("doc_id", hashed.hashes(hashed.words(text)).alias("h1")).select("doc_id", "h1", F.size("h1").alias("n"))
    d = d.select("doc_id", "n", "h1", hashed.pairs(F.col("h1"), 1, F.col("n")).alias("h2"))
    weight = hashed.total_ratio(F.col("h1"), ratios, BUCKETS) + hashed.total_ratio(F.col("h2"), ratios, BUCKETS)
    d = d.select("doc_id", F.greatest(2 * F.col("n") - 1, F.lit(0)).cast("long").alias("n_grams"), F.round(weight, 6).alias("log_weight"))
    d = cut(d.withColumn("gumbel_key", F.when(F.col("n_grams") > 0, F.col("log_weight") - F.log(-F.log(u)))), "weights")
    least = kth_largest(d, "gumbel_key", int(share * d.count()))
    return d.withColumn("sampled", F.coalesce(F.col("gumbel_key") >= least, F.lit(False)))
