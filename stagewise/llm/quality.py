"""Quality rules: base counts and a hashed n-gram log-likelihood ratio, in native Spark columns.

The trusted target is a bounded sample of documents labelled as good; the raw
corpus is every document.  Both are multinomials over hashed words and word
pairs.  A document's score is its mean log ratio per n-gram; it passes at
``threshold`` or more.  All counts and every verdict cover whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm import hashed

BUCKETS, ALPHA, TRUSTED, THRESHOLD = 1 << 14, 0.5, 20_000, -0.12
WINDOW, SYMBOLS = 8, "[#*$%&|<>]"


def _covered(positions: Column) -> Column:
    """Words in windows that start at the sorted ``positions``."""
    gaps = F.zip_with(positions, F.slice(positions, F.lit(2), F.greatest(F.size(positions), F.lit(1))),
                      lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)


def base_counts(docs: DataFrame, *keep: str, ratio=None) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row's text, and ``ratio`` of its hashed words and word pairs."""
    ratio = ratio or (lambda h: F.lit(0.0))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    d = docs.select(*keep, hashed.words(text).alias("w"), F.when(F.contains(text, F.lit("\n")), lines).alias("lines"),
                    F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    d = d.select(*keep, hashed.hashes(F.col("w")).alias("h1"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols",
                 F.size("w").cast("long").alias("n_words"),
                 F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("long").alias("n_dup_lines"), F.size("w").alias("n"))
    n, keep = F.col("n"), (*keep, "word_chars", "n_symbols", "n_words", "n_dup_lines")
    d = d.select(*keep, "n", "h1", hashed.pairs(F.col("h1"), 1, n).alias("h2"))
    d = d.select(*keep, "n", (ratio(F.col("h1")) + ratio(F.col("h2"))).alias("ratio"), hashed.pairs(F.col("h2"), 2, n - 1).alias("h4"))
    d = d.select(*keep, "ratio", hashed.pairs(F.col("h4"), 4, n - 3).alias("h8"))
    # windows found again: sort (hash, place), mark equal neighbours, add up what the marked places cover
    placed = F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    d = d.select(*keep, "ratio", F.when(F.size(F.array_distinct("h8")) < F.size("h8"), F.sort_array(placed)).alias("s"))
    m = F.greatest(F.size("s") - 1, F.lit(0))
    same = F.zip_with(F.slice("s", F.lit(1), m), F.slice("s", F.lit(2), m), lambda a, b: a["h"] == b["h"])
    d = d.select(*keep, "ratio", "s", F.when(F.col("s").isNotNull(), same).alias("same"))
    no = F.array(F.lit(False))
    marked = F.arrays_zip(F.col("s").alias("s"), F.concat("same", no).alias("a"), F.concat(no, F.col("same")).alias("b"))
    at = F.sort_array(F.transform(F.filter(marked, lambda x: x["a"] | x["b"]), lambda x: x["s"]["i"]))
    d = d.select(*keep, "ratio", F.when(F.col("s").isNotNull(), at).alias("at"))
    return d.select(*keep, "ratio", F.coalesce(_covered(F.col("at")), F.lit(0)).cast("long").alias("n_repeat_words"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) of every row.

    Words are runs of other than ASCII white space.  ``base_failed``: under 20
    words, or over 30 % of the words in 8-word windows that occur again.
    ``kept``: not failed and a mean log ratio of ``threshold`` or more.  A null
    or wordless text has no words, fails and scores 0.  Without trusted rows
    every score is 0.  Rows are judged one by one, repeated ones too; a null
    doc_id is never trusted.  An empty table gives no rows; other columns are
    not read.
    """
    trusted = hashed.sample_of(labels, F.col("quality") == 1, TRUSTED)
    ratios = hashed.as_array(hashed.target_ratios(docs, trusted, lambda d: hashed.counted_grams(d, F.col("text")), BUCKETS, ALPHA))
    d = base_counts(docs, "doc_id", ratio=lambda h: hashed.total_ratio(h, ratios, BUCKETS))
    n = F.col("n_words")
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    d = d.withColumn("score", F.when(n > 0, F.round(F.col("ratio") / (2 * n - 1), 9)).otherwise(F.lit(0.0))).withColumn("base_failed", failed)
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"), "score")
