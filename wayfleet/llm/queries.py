"""The registered queries of the training-data operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm import bpe, dart_minhash, lexical, line_dedup, mixing, pii, quality_model, quality_rules, runs, sharding, topk, url_trust, word_bpe
from wayfleet.llm.common import WORD, filled, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    placed = sharding.shard(table(spark, sf_dir, "documents"), 24)
    none = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", none)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return dart_minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows by inner product for every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("double"))
    rows = vectors.where(topk.usable(F.col("embedding"))).select("vec_id", ints.alias("ints"))
    return topk.top_k(rows.where("vec_id % 20 = 0"), rows, 20)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes of every document."""
    return bpe.tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), ids=False)


def op5_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for every page."""
    judged = url_trust.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document loses to an earlier equal or near line, and its links to different lines."""
    return line_dedup.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to the mix."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, plain and disguised."""
    return pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_model.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document; documents labelled good are the trusted target."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), trusted)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of which is made periodic from some word on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.regexp_extract_all(filled(F.col("text")), F.lit(WORD), F.lit(0))
    code = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.withColumn("_code", code).withColumn("_words", F.when(F.col("_code") % 10 == 0, words))
    rows = rows.withColumn("_n", F.size("_words")).withColumn("_g", F.expr("_code div 10"))
    rows = rows.withColumn("_a", F.expr("if(_n > 0, cast(_g % _n AS int), 0)"))
    rows = rows.withColumn("_p", F.expr("cast(1 + (_n - _a) div (3 + _g % 8) AS int)"))
    # the words from the a-th on become copies of the first p of them
    again = F.expr("slice(flatten(array_repeat(slice(_words, _a + 1, _p), cast((_n - _a) div _p + 1 AS int))), 1, _n - _a)")
    periodic = F.array_join(F.concat(F.expr("slice(_words, 1, _a)"), again), " ")
    found = runs.find_runs(rows.select("doc_id", F.when(F.col("_n") > 0, periodic).otherwise(F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("from"), (-r["period"]).alias("by"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.from")).alias("start"), "best.length", (-F.col("best.by")).alias("period"),
        F.expr("1000 * best.length div -best.by").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return lexical.rank_documents(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), 50)


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    return word_bpe.tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), ids=False)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of the operators by name."""
    own = [
        op1_sharding, op2_near_dedup, op3_top_k, op4_byte_bpe, op5_url_trust, op6_line_dedup, op7_mixing,
        op8_personal_data, op9_quality_model, op10_quality_rules, op11_runs,
        op12_lexical_search, op13_word_bpe,
    ]
    return {query.__name__: query for query in own}
