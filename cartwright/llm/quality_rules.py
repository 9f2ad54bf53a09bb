"""Quality rules with thresholds that adapt to each language and source.

`measure` counts words, symbols, repeated lines and repeated word windows of whole texts. The fixed base rules
follow from the counts. Everything else is adaptive: per language and source the ratios of `RATIOS` go into
quantile sketches of logarithmic buckets. Sketches merge by adding counts, in any order and with the same
result, so that small groups take the thresholds of their language and those of a small language the thresholds
of the whole corpus. A threshold is the median plus a multiple of the spread between lower quartile and median, which
bad documents don't widen while they are under half of a group. Beyond that the wider groups hold: the threshold of a
source is at most BOUND times that of its language, and that of a language at most BOUND times that of the corpus. A
document above any threshold of its group is rejected.

Defined results: a null or empty text has only zero counts and fails the base rules; null language or source form
groups of their own; repeated rows get equal verdicts; an empty table gives an empty result. Documents that
fail the base rules don't enter the sketches. The thresholds are joined by language and source, not by id, so ids
may be null or repeated, and no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm import bitmap
from cartwright.llm.text_blocks import Block, blocks
from cartwright.session import materialise

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

#: Ratio, and the least spread that counts for it: a ratio may exceed the median by SPREADS times that anyway.
RATIOS = {"symbols_per_word": 0.02, "upper_share": 0.015, "dup_line_share": 0.07, "repeat_share": 0.03, "odd_word_chars": 0.5}
SPREADS, BOUND = 5.0, 2.0
#: Relative error of a sketch; smaller values than LEAST_VALUE count as 0.
ACCURACY, LEAST_VALUE, ZERO_BUCKET = 0.02, 1e-4, -(1 << 20)
#: Documents that a group needs for thresholds of its own.
GROUP_DOCS = 200

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MEASURES = f"{COUNTS}, n_lines long, n_letters long, n_upper long"

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, dtype=bool)
_IS_UPPER[65:91] = True
_IS_LETTER = _IS_UPPER.copy()
_IS_LETTER[97:123] = True


def _repeated_words(block: Block) -> np.ndarray:
    """Words of each text that lie in a window of WINDOW words found twice or more in the text."""
    hashes, text, first = block.grams(WINDOW)
    if not len(hashes):
        return np.zeros(len(block.n_words), dtype=np.int64)
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    again = np.zeros(len(hashes), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(block.word_starts) + 1, dtype=np.int64)
    edges[first[again]] += 1
    edges[first[again] + WINDOW] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
    return covered[block.first_word[1:]] - covered[block.first_word[:-1]]


def _measure_block(texts: list[bytes]) -> list[np.ndarray]:
    block = Block(texts)
    dup, lines = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        full = [line for line in text.split(b"\n") if line.strip()]
        lines[k], dup[k] = len(full), len(full) - len(set(full))
    symbols = block.per_text(_IS_SYMBOL[block.bytes])
    # A code point has one byte that is no continuation byte.
    chars = block.per_text(~block.space & ((block.bytes & 0xC0) != 0x80))
    letters, upper = block.per_text(_IS_LETTER[block.bytes]), block.per_text(_IS_UPPER[block.bytes])
    return [block.n_words, chars, symbols, dup, _repeated_words(block), lines, letters, upper]


def measure(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """The columns `keep` of `docs` and the counts of MEASURES for each text."""
    names = [part.split()[0] for part in MEASURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            parts = [_measure_block(held) for _, held in blocks(texts)]
            columns = [np.concatenate([part[k] for part in parts]) for k in range(len(names))] if parts else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c, type=pa.int64()) for c in columns]], [*batch.schema.names[:-1], *names]
            )

    source = docs.select(*keep, F.col(text).cast("binary").alias("measured_text"))
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(name, T.LongType()) for name in names]])
    return source.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratios() -> dict[str, Column]:
    """The measures that get adaptive thresholds; large is bad."""
    per = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return {
        "symbols_per_word": per("n_symbols", "n_words"),
        "upper_share": per("n_upper", "n_letters"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "odd_word_chars": per("word_chars", "n_words"),
    }


def _bucket(value: Column) -> Column:
    """The logarithmic bucket of a value; every value of bucket b is within ACCURACY of its upper edge."""
    return F.when(value < LEAST_VALUE, F.lit(ZERO_BUCKET)).otherwise(F.ceil(F.log(value) / F.log(F.lit(1 + ACCURACY)))).cast("int")


def _edge(bucket: Column) -> Column:
    return F.when(bucket == ZERO_BUCKET, 0.0).otherwise(F.pow(F.lit(1 + ACCURACY), bucket))


def sketch_ratios(measured: DataFrame) -> DataFrame:
    """The quantile sketches: documents by language, source, ratio and bucket. Two sketches merge by adding counts."""
    entries = F.array(*[F.struct(F.lit(n).alias("ratio"), _bucket(c).alias("bucket")) for n, c in ratios().items()])
    entry = measured.where(~base_failed()).select("lang", "source", F.explode(entries).alias("e"))
    return entry.groupBy("lang", "source", "e.ratio", "e.bucket").agg(F.count(F.lit(1)).alias("docs"))


def sketch_limits(sketches: DataFrame, *keys: str, spreads: float = SPREADS) -> DataFrame:
    """The keys, the number of documents and a map of ratio to threshold, of the sketches merged by the keys."""
    merged = sketches.groupBy(*keys, "ratio", "bucket").agg(F.sum("docs").alias("docs"))
    group = Window.partitionBy(*keys, "ratio")
    upto = merged.withColumn("upto", F.sum("docs").over(group.orderBy("bucket"))).withColumn("n", F.sum("docs").over(group))
    at = lambda rank: _edge(F.min(F.when(F.col("upto") >= rank * F.col("n"), F.col("bucket"))))
    quartiles = upto.groupBy(*keys, "ratio").agg(F.max("n").alias("n"), at(0.25).alias("lower"), at(0.5).alias("middle"))
    least = F.element_at(F.create_map(*[F.lit(x) for pair in RATIOS.items() for x in pair]), F.col("ratio"))
    limit = F.col("middle") + spreads * F.greatest(least, F.col("middle") - F.col("lower"))
    # One entry per ratio.
    entries = F.collect_list(F.struct("ratio", limit.alias("limit")))
    return quartiles.groupBy(*keys).agg(F.max("n").alias("n"), F.map_from_entries(entries).alias("limits"))


def group_thresholds(measured: DataFrame, group_docs: int = GROUP_DOCS) -> DataFrame:
    """lang, source and limits (a map of ratio to threshold), from the documents that pass the base rules.

    Sketches come out of the data once; those of a language and of the corpus are merged from them.
    """
    sketches = materialise(sketch_ratios(measured), "rule-sketches")
    by_lang = sketch_limits(sketches, "lang").select(
        F.col("lang").alias("l"), F.col("n").alias("lang_n"), F.col("limits").alias("lang_limits")
    )
    corpus = sketch_limits(sketches).select("limits").scalar()
    bounded = lambda limits, wider: F.transform_values(limits, lambda name, limit: F.least(limit, BOUND * wider[name]))
    joined = sketch_limits(sketches, "lang", "source").join(by_lang, F.col("lang").eqNullSafe(F.col("l"))).withColumn("corpus", corpus)
    of_lang = F.when(F.col("lang_n") >= group_docs, bounded(F.col("lang_limits"), F.col("corpus"))).otherwise(F.col("corpus"))
    joined = joined.withColumn("of_lang", of_lang)
    own = F.when(F.col("n") >= group_docs, bounded(F.col("limits"), F.col("of_lang"))).otherwise(F.col("of_lang"))
    return joined.select("lang", "source", own.alias("limits"))


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds base_failed and kept to measured rows, joined with the thresholds of their language and source."""
    limits = limits.select(F.col("lang").alias("l"), F.col("source").alias("s"), "limits")
    good = F.lit(True)
    for name, value in ratios().items():
        good = good & (value <= F.coalesce(F.col("limits")[name], F.lit(float("inf"))))
    return (
        measured.join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & good)
        .drop("l", "s", "limits")
    )


def apply_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept for each document, which needs doc_id, text, lang and source."""
    measured = materialise(measure(docs, "text", "doc_id", "lang", "source"), "rule-measures")
    return judge(measured, materialise(group_thresholds(measured), "rule-limits"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their columns as they were.

    A verdict depends on text, language and source only, so a hash of these stands for a document while it is judged. Texts of
    kept documents are not shuffled but for the few that pass the bitmap of rejected hashes.
    """
    key = F.xxhash64("text", "lang", "source")
    measured = measure(docs.select(key.alias("key"), "lang", "source", "text"), "text", "key", "lang", "source")
    measured = materialise(measured, "rule-measures")
    judged = judge(measured, materialise(group_thresholds(measured), "rule-limits"))
    rejected = materialise(judged.where("NOT kept").select(F.col("key").alias("rejected_key")).distinct(), "rejected")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), key.alias("key"))
    maybe, rest = bitmap.split(whole, "key", rejected, "rejected_key")
    left = maybe.join(rejected, F.col("key") == F.col("rejected_key"), "left_anti")
    return rest.select("doc.*").unionByName(left.select("doc.*"))
