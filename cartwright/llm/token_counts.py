"""Token counts as delta-maintained rollups.

A batch of changes inserts, revises or deletes counts of documents. A commit turns it into signed rows: what it adds,
and what it takes back of earlier counts. The signed rows of a batch are its folder in the ledger, and their
sums by source, language and tokenizer version are its folder in the totals; a total is the sum over batches.
Both folders follow from the batch and the batches before it alone and replace those of an earlier run, so that a
batch that is committed again, after a failure or by mistake, changes nothing.

Defined results: an insert of a known document revises it; a delete of an unknown one does nothing; several changes of
one document in a batch count as the largest (a delete last); null or empty texts have 0 tokens; null sources and
languages are groups of their own; rows with a null id are one document per text hash and version. Totals
whose documents are all gone disappear.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What counts as a token in the two built-in versions.
PATTERNS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]",
}
KEYS = ["source", "lang", "version"]
LEDGER = "key string, source string, lang string, version string, tokens long, docs long, batch long"
TOTALS = "source string, lang string, version string, tokens long, docs long, batch long"


def pattern_tokens(pattern: str) -> Callable[[Column], Column]:
    return lambda text: F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def document_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.xxhash64("text").cast("string")))


def counted(docs: DataFrame, op: str = "upsert") -> DataFrame:
    """The changes (op, key, source, lang, version, tokens) that set the built-in versions' counts of `docs`."""
    counts = [F.struct(F.lit(v).alias("version"), pattern_tokens(p)(F.col("text")).alias("tokens")) for v, p in PATTERNS.items()]
    rows = docs.select(document_key().alias("key"), "source", "lang", F.explode(F.array(*counts)).alias("c"))
    return rows.select(F.lit(op).alias("op"), "key", "source", "lang", "c.version", "c.tokens")


def vocabulary_counted(docs: DataFrame, version: str, load: Callable[[], Callable[[str], int]]) -> DataFrame:
    """Changes that set counts by a tokenizer with a vocabulary; `load` runs once per task and returns the counter."""
    rows = docs.select(document_key().alias("key"), "source", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load()
        for batch in batches:
            sizes = [count(t) if t else 0 for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sizes, pa.int64())], ["key", "source", "lang", "tokens"])

    found = rows.mapInArrow(run, "key string, source string, lang string, tokens long")
    return found.select(F.lit("upsert").alias("op"), "key", "source", "lang", F.lit(version).alias("version"), "tokens")


def byte_pair_counter(path: str, pattern: str) -> Callable[[], Callable[[str], int]]:
    """A loader for `vocabulary_counted` from a file of base64 pieces and ranks; the file must be readable by every task."""

    def load() -> Callable[[str], int]:
        import base64

        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
        encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda text: len(encoding.encode_ordinary(text))

    return load


class TokenRollup:
    """The ledger and the totals below a folder that all executors share. Batches are numbered from 1."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _read(self, table: str, schema: str, batches: range) -> DataFrame:
        parts = [
            self.spark.read.schema(schema).parquet(f"{self.path}/{table}/{b}").withColumn("batch", F.lit(b).cast("long"))
            for b in batches
        ]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Writes the signed rows of a batch and their sums; the batches before it must be committed."""
        before = self._read("ledger", LEDGER, range(1, batch))
        last = Window.partitionBy("key", "version").orderBy(
            F.col("op") == "delete", F.col("tokens").desc(), F.col("source").desc(), F.col("lang").desc()
        )
        changes = changes.withColumn("nth", F.row_number().over(last)).where("nth = 1").drop("nth")
        touched = changes.select("key", "version")
        held = before.join(touched, ["key", "version"], "left_semi").groupBy("key", *KEYS)
        held = held.agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).where("docs <> 0 OR tokens <> 0")
        taken = held.select("key", *KEYS, (-F.col("tokens")).alias("tokens"), (-F.col("docs")).alias("docs"))
        added = changes.where("op <> 'delete'").select("key", *KEYS, "tokens", F.lit(1).cast("long").alias("docs"))
        signed = taken.unionByName(added).groupBy("key", *KEYS)
        signed = signed.agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).where("docs <> 0 OR tokens <> 0")
        signed.write.mode("overwrite").parquet(f"{self.path}/ledger/{batch}")
        written = self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/{batch}")
        sums = written.groupBy(*KEYS).agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
        sums.write.mode("overwrite").parquet(f"{self.path}/totals/{batch}")

    def totals(self, upto: int) -> DataFrame:
        """source, lang, version, docs and tokens after the batches 1 to `upto`; reads the sums only."""
        rows = self._read("totals", TOTALS, range(1, upto + 1)).groupBy(*KEYS)
        return rows.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0")
