"""The numbered queries over the given tables: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import (
    decontamination,
    jaccard_join,
    language_id,
    lexical_search,
    line_dedup,
    minhash_dedup,
    mixing,
    oracles,
    pii,
    quality_classifier,
    quality_rules,
    run_detection,
    suffix_dedup,
    token_counts,
)
from cartwright.session import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir)).drop("text_key")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents, revised counts of those that hold markup, and without exact copies.

    The second batch is committed twice.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text", "source", "lang")
    # A document keeps its key when its text is revised.
    docs = docs.withColumn("id", F.col("doc_id")).withColumn("doc_id", token_counts.document_key())
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit(1, token_counts.counted(docs))
    plain = docs.withColumn("text", F.regexp_replace("text", r"[#*$%&|<>]", "")).where(docs["text"].rlike(r"[#*$%&|<>]"))
    revised = materialise(token_counts.counted(plain), "revised-counts")
    rollup.commit(2, revised)
    rollup.commit(2, revised)
    # The first document of each text stays. Grouping combines copies before the shuffle, and ids are joined, not texts.
    hashed = docs.where("text IS NOT NULL").select(
        "id", F.col("doc_id").alias("key"), F.xxhash64("text").alias("hash"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    )
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    first = hashed.groupBy("hash", "sha").agg(F.min(rank).alias("first")).select("first.key")
    copies = hashed.select("key").distinct().join(first, "key", "left_anti")
    gone = copies.select(F.lit("delete").alias("op"), "key")
    versions = F.explode(F.array(*[F.lit(v) for v in token_counts.PATTERNS]))
    gone = gone.select(
        "op",
        "key",
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("lang"),
        versions.alias("version"),
        F.lit(0).cast("long").alias("tokens"),
    )
    rollup.commit(3, gone)
    return rollup.totals(3)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(documents(spark, sf_dir))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.classify(documents(spark, sf_dir), labels)


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.dedup_documents(documents(spark, sf_dir))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


def _with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the end of one text in ten repeats its first words; the hash of the id says from where and how often."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    cut = cut.withColumn("n", F.size("words"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), F.col("n") - F.col("a"))
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_detection.detect_runs(_with_periods(documents(spark, sf_dir)), "doc_id")
    longer = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    best = F.aggregate(
        "runs",
        F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, run: F.when(best.isNull() | longer(best, run), run).otherwise(best),
    )
    listed = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    listed = F.array_join(F.transform(listed, lambda run: F.concat(run, F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_pii": op2_pii,
        "op3_mixing": op3_mixing,
        "op4_quality_rules": op4_quality_rules,
        "op5_language_id": op5_language_id,
        "op6_token_counts": op6_token_counts,
        "op7_decontamination": op7_decontamination,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_line_dedup": op9_line_dedup,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_minhash_dedup": op11_minhash_dedup,
        "op12_lexical_search": op12_lexical_search,
        "op13_run_detection": op13_run_detection,
    }


def oracle_sql() -> dict[str, str]:
    """Where SQL can say it; the other queries are tested against brute force or held-out rows."""
    return dict(oracles.ORACLES)
