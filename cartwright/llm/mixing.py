"""Mixing sources to target weights with hash thresholds.

Every document has a fixed 64-bit hash. A source whose target is q whole passes and a rest takes each document q
times, and once more those whose hash is below the source's threshold. The threshold is found without a sort:
sizes are summed by source and leading byte of the hash, the byte in which the running sum passes the rest is
the boundary, and only the documents of that boundary are summed again, by their next byte. It ends when
each boundary holds one hash, mostly after three bytes.

Defined results: a null or blank text has size 0, a null source is a source of its own (the last), repeated rows
share one hash and are taken alike, an empty table gives an empty mix. Only the named columns are read, so other
columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.session import materialise

# Weights by rank of the source, repeating, and the most passes over a source.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
WORD = r"[^\x20\x09-\x0D]+"
HASH_BYTES = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size and hash of each row: all that the mix needs of a document."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("hash"),
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_PASSES) -> DataFrame:
    """source, source_size and target, one row per source; the targets share the size of all sources.

    A source's cap is `most` times its size. In the order of cap by weight, a source is capped as long as what is
    left for it and all later ones, shared by weight, exceeds its cap. One row per source is ordered here.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights) + 1)
    cap = F.col("source_size") * F.lit(float(most))
    ranked = (
        per_source.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", cap)
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(all_rows).cast("double")
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level).withColumn("open", F.col("weight") * F.col("level") <= F.col("cap"))
    # The first source that stays below its cap sets the level for itself and all later ones.
    final = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))).over(all_rows)
    return (
        levels.withColumn("final", final["level"])
        .withColumn("target", F.least(F.col("cap"), F.col("weight") * F.coalesce(F.col("final"), F.lit(0.0))))
        .select("source", "source_size", "target")
    )


def _byte(level: int) -> Column:
    """Byte `level` of the hash, counted from the highest, as 0 to 255."""
    return F.shiftrightunsigned("hash", 64 - 8 * (level + 1)).bitwiseAND(F.lit(255).cast("long"))


def _prefix(levels: int) -> Column:
    """The `levels` highest bytes of the hash."""
    return F.shiftrightunsigned("hash", 64 - 8 * levels)


def thresholds(sizes: DataFrame, rests: DataFrame) -> DataFrame:
    """source, edge and edge_taken: documents below the hash `edge` have about `rest` words in total.

    `rests` has source and rest, 0 <= rest < size of the source. The document at the edge itself is taken
    if that comes nearer to the rest.
    """
    state = rests.where(F.col("rest") > 0).select("source", F.col("rest").alias("left"), F.lit(0).cast("long").alias("prefix"))
    found = []
    for level in range(HASH_BYTES):
        within = sizes.where(F.col("size") > 0)
        if level:
            edge = state.select(F.col("source").alias("s"), F.col("prefix").alias("p"))
            within = within.join(edge, F.col("source").eqNullSafe(F.col("s")) & (_prefix(level) == F.col("p")), "left_semi")
        sums = within.groupBy("source", _byte(level).alias("byte")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        running = Window.partitionBy("source").orderBy("byte")
        budget = state.select(F.col("source").alias("s"), "left", "prefix")
        edges = (
            sums.withColumn("upto", F.sum("words").over(running))
            .join(budget, F.col("source").eqNullSafe(F.col("s")))
            .where((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("words") <= F.col("left")))
            .select(
                "source",
                (F.col("left") - F.col("upto") + F.col("words")).alias("left"),
                (F.shiftleft("prefix", 8) + F.col("byte")).alias("prefix"),
                "words",
                "low",
                (F.col("low") == F.col("high")).alias("single"),
            )
        )
        edges = materialise(edges, "mix-edges")
        found.append(
            edges.where("single").select(
                "source", F.col("low").alias("edge"), (F.col("words") <= 2 * F.col("left")).alias("edge_taken")
            )
        )
        state = edges.where(~F.col("single")).select("source", "left", "prefix")
        if state.isEmpty():
            break
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def mix_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """One row per source: source, source_size, target, passes, edge and edge_taken. `sizes` is a written table."""
    targets = materialise(source_targets(sizes, weights, most), "mix-targets")
    passes = F.when(
        F.col("source_size") > 0, F.least(F.lit(int(most)), F.floor(F.col("target") / F.col("source_size")).cast("int"))
    ).otherwise(F.lit(0))
    plan = targets.withColumn("passes", passes).withColumn(
        "rest",
        F.when(F.col("passes") < int(most), F.col("target") - F.col("passes") * F.col("source_size")).otherwise(0.0),
    )
    edges = thresholds(sizes, plan.select("source", "rest")).withColumnRenamed("source", "s")
    plan = plan.join(edges, F.col("source").eqNullSafe(F.col("s")), "left")
    return materialise(plan.drop("s", "rest"), "mix-plan")


def apply_plan(rows: DataFrame, plan: DataFrame, source: str, size: str, key: str) -> DataFrame:
    """Adds source_size, target, copies and taken to rows that have the named source, size and hash columns.

    The plan has one row per source, so it is joined without moving the rows as long as it is small.
    """
    unsigned = lambda c: c.bitwiseXOR(F.lit(-(1 << 63)))  # noqa: E731  its signed order is the unsigned one of c
    below = (unsigned(F.col(key)) < unsigned(F.col("edge"))) | ((F.col(key) == F.col("edge")) & F.col("edge_taken"))
    copies = (F.col("passes") + F.coalesce(below, F.lit(False)).cast("int")).cast("long")
    plan = plan.withColumnRenamed("source", "plan_source")
    return (
        rows.join(plan, F.col(source).eqNullSafe(F.col("plan_source")))
        .withColumn("copies", copies)
        .withColumn("taken", F.col(size) * F.col("copies"))
        .drop("plan_source", "passes", "edge", "edge_taken")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """doc_id, source, size, hash, source_size, target, copies and taken of every document."""
    sizes = materialise(sized(docs), "mix-sizes")
    return apply_plan(sizes, mix_plan(sizes, weights, most), "source", "size", "hash")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """The documents that the mix takes: their columns, and those of `mix`, which replace any of the same name.

    `copies` says how often a document is taken. The texts are read twice and never shuffled.
    """
    added = ["size", "source_size", "target", "copies", "taken"]
    plan = mix_plan(materialise(sized(docs), "mix-sizes"), weights, most)
    kept = [c for c in docs.columns if c.lower() not in added]
    rows = docs.select(
        F.struct(*kept).alias("doc"),
        F.col("source").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", "text").alias("hash"),
    )
    return apply_plan(rows, plan, "source", "size", "hash").where("copies > 0").select("doc.*", *added)
