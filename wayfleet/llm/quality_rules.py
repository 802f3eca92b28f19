"""Quality rules: plain counts, and a hashed n-gram log-likelihood ratio of trusted target and raw corpus."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfleet.llm.common import WORD, filled, without

#: Hash buckets of the n-grams; the table of ratios has this many entries at any input size.
BUCKETS = 1 << 16
#: A document goes when its n-grams are on average less than 85 % as likely in the target as in the corpus.
THRESHOLD = math.log(0.85)


def words(text: Column) -> Column:
    """The words of a text, as an array."""
    return F.regexp_extract_all(filled(text), F.lit(WORD), F.lit(0))


def _spans(array: Column, width: int) -> Column:
    """0, 1, 2, ... for each window of this width; empty where the array is shorter."""
    return F.when(F.size(array) >= width, F.sequence(F.lit(0), F.size(array) - width)).otherwise(F.array().cast("array<int>"))


def _grams(array: Column, buckets: int) -> Column:
    """Buckets of the single words and of the pairs of neighbours."""
    one = F.transform(array, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.transform(_spans(array, 2), lambda i: F.pmod(F.xxhash64(F.get(array, i), F.get(array, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def rule_counts(docs: DataFrame) -> DataFrame:
    """Add ``_words``, ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``base_failed``."""
    text = filled(F.col("text"))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    w = F.col("_words")
    counted = docs.withColumns({
        "_words": words(F.col("text")), "_lines": lines, "n_symbols": symbols.cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
    })
    counted = counted.withColumn("_triples", F.transform(_spans(w, 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    counted = counted.withColumn("_sorted", F.when(
        F.size("_triples") > F.size(F.array_distinct("_triples")),
        F.sort_array(F.transform("_triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    s = F.col("_sorted")
    twice = F.transform(s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"]))
    covered = F.flatten(F.transform(F.array_compact(twice), lambda i: F.array(i, i + 1, i + 2)))
    repeated = F.when(s.isNull(), F.lit(0)).otherwise(F.size(F.array_distinct(covered)))
    counted = counted.withColumns({
        "n_words": F.size(w).cast("long"), "n_repeat_words": repeated.cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_lines", "_triples", "_sorted")
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.withColumn("base_failed", failed)


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> Column:
    """Log-likelihood ratio of each bucket, as one array.

    Counts cover the n-grams of every document, and of every document whose ``doc_id`` is in ``trusted``;
    both multinomials are smoothed by one per bucket. Words are counted where they are read; only
    one row per bucket and task is shuffled. Without trusted words every ratio is 0.
    """
    known = trusted.select(F.col("doc_id").alias("_known")).where("_known IS NOT NULL").distinct()
    # always a merge join: the list of trusted ids grows with the corpus, and one plan holds at every size
    marked = docs.select("doc_id", "text").join(known.hint("merge"), F.col("doc_id") == F.col("_known"), "left")
    split = marked.select(words(F.col("text")).alias("_words"), F.col("_known").isNotNull().cast("long").alias("_in"))
    grams = split.select(F.explode(_grams(F.col("_words"), buckets)).alias("_bucket"), "_in")
    counts = grams.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_raw"), F.sum("_in").alias("_target"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_bucket")).join(counts, "_bucket", "left").fillna(0)
    sums = every.agg(
        F.sum("_raw").alias("r"), F.sum("_target").alias("t"),
        F.array_sort(F.collect_list(F.struct("_bucket", "_raw", "_target"))).alias("all"),
    )
    smooth = F.lit(float(buckets))
    ratio = F.transform("all", lambda b: F.when(F.col("t") == 0, F.lit(0.0)).otherwise(
        F.log((b["_target"] + 1) / (F.col("t") + smooth)) - F.log((b["_raw"] + 1) / (F.col("r") + smooth))
    ))
    return sums.select(ratio.alias("_ratios")).scalar()


def judge(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Every document without its text, with the rule counts, ``llr`` and ``kept``.

    ``llr`` is the mean ratio of the document's words and word pairs, 0 for a text without words. A
    document is kept unless a base rule fails (under 50 words, or more than half of its words in repeated
    three-word windows) or ``llr`` is below ``threshold``. Null text has no words. Rows that repeat count
    as often as they occur and get the same verdict. Columns of the result's names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept", "_words", "_lines", "_triples", "_sorted", "_grams", "_table"]
    docs = without(docs, names)
    table = ratios(docs, trusted, buckets)
    counted = rule_counts(docs).drop("text").withColumn("_grams", _grams(F.col("_words"), buckets)).drop("_words")
    counted = counted.withColumn("_table", table)  # used once, so the optimiser reads it in place: no row holds it
    total = F.aggregate("_grams", F.lit(0.0), lambda acc, b: acc + F.get("_table", b))
    llr = F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(F.lit(0.0))
    return counted.withColumn("llr", llr).drop("_grams", "_table").withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))
