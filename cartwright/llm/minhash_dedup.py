"""Near-duplicate documents with HyperMinHash sketches.

A document's set holds the 64-bit hashes of its distinct word shingles. The leading bits of a hash choose one of BUCKETS buckets;
a bucket's register keeps of the smallest remaining value the number of leading zeros and the MANTISSA bits behind the
first one, 16 bits in all.

1. Bands of BAND registers are hashed; sets with an equal band are candidates. An empty bucket borrows the register of
   the first non-empty bucket in an order of its own. Two sets at the limit of 0.85 share none of the 42 bands with a
   probability of about 2e-9.
2. Each set is compared with the first set (the smallest key) of each of its bands: the share of equal registers,
   corrected for registers that are equal by chance, estimates the Jaccard similarity; pairs whose estimate is more
   than MARGIN standard errors below the limit go, the others are verified with the full sets. That is one pair a set and
   centre, so a large group of copies costs rows in proportion to its size.
3. Sets that share a band have a centre in common. The stars around a centre that are not connected by then are compared
   inside: the full sets of a star meet in one task, which estimates all pairs of different components and counts the
   shared shingles of the likely ones. A star with more than BLOCK shingles is split into pairs of blocks. Only
   links that connect something are returned, fewer than there are sets.

Links inside a connected component are not listed, so the result is the components.

Defined results: null and empty texts have an empty set, are linked with nothing and form their own component; a text of
fewer than SHINGLE words has its whole sequence as its one shingle; equal sets and repeated rows are linked; a null id is
the smallest of a component only where there is no other; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.components import components
from cartwright.llm.jaccard_join import row_key, set_key, sets_of, shingle_sets, verified
from cartwright.llm.text_blocks import mix64, multipliers
from cartwright.session import materialise

SHINGLE = 3
#: Linked: 100 * shared >= PERCENT * union.
PERCENT = 85
BUCKET_BITS, MANTISSA = 8, 10
BUCKETS, VALUE_BITS = 1 << BUCKET_BITS, 64 - BUCKET_BITS
BANDS, BAND = 42, 6
#: Standard errors by which an estimate may fall short of the limit.
MARGIN = 6.0
#: Shingles that meet in one task, of each of two blocks.
BLOCK = 1 << 20

_U = np.uint64


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers of a set of sorted shingle hashes; 0 is an empty bucket."""
    out = np.zeros(BUCKETS, dtype=np.uint16)
    if not len(shingles):
        return out
    # Sorted hashes lie bucket by bucket, the smallest value first.
    bucket = (shingles >> _U(VALUE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    value = shingles[first] & _U((1 << VALUE_BITS) - 1)
    part, exponent = np.frexp(value.astype(np.float64))
    zeros = np.clip(VALUE_BITS - exponent, 0, 62)
    mantissa = np.clip((2 * part - 1) * (1 << MANTISSA), 0, (1 << MANTISSA) - 1).astype(np.int64)
    out[bucket[first]] = 1 + (zeros << MANTISSA | mantissa)
    return out


@lru_cache(maxsize=1)
def _borrowing() -> np.ndarray:
    """Row t names for each bucket the t-th bucket from which it may borrow; each column is a permutation."""
    draws = mix64(np.arange(BUCKETS * BUCKETS, dtype=_U) + _U(1 << 40)).reshape(BUCKETS, BUCKETS)
    return np.argsort(draws, axis=0)


def bands(sketches: np.ndarray) -> np.ndarray:
    """BANDS hashes for each non-empty sketch."""
    full = sketches.copy()
    for order in _borrowing():
        open_rows = np.flatnonzero((full == 0).any(axis=1))
        if not len(open_rows):
            break
        full[open_rows] = np.where(full[open_rows] == 0, sketches[open_rows][:, order], full[open_rows])
    parts = full[:, : BANDS * BAND].reshape(-1, BANDS, BAND).astype(_U)
    return mix64((parts * multipliers(BAND, seed=11)[:BAND]).sum(axis=2, dtype=_U) + multipliers(BANDS, seed=12)[:BANDS])


def _levels(n: np.ndarray) -> np.ndarray:
    """Share of buckets whose smallest value has 0, 1, 2 ... leading zeros, for sets of n shingles."""
    load = np.maximum(1.0, n / BUCKETS)[..., None]
    zeros = np.arange(VALUE_BITS)
    return (1 - 2.0 ** -(zeros + 1)) ** load - (1 - 2.0**-zeros) ** load


def chance(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """How likely the registers of two different shingles are equal: as many leading zeros, and equal mantissas."""
    return (_levels(n_a) * _levels(n_b)).sum(axis=-1) / (1 << MANTISSA)


def likely_linked(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether the estimate of pairs of sketches, corrected for collisions, is near the limit or above it."""
    equal = ((a == b) & (a > 0)).sum(axis=-1)
    either = np.maximum(((a > 0) | (b > 0)).sum(axis=-1), 1)
    collision = chance(n_a, n_b)
    estimate = (equal / either - collision) / (1 - collision)
    limit = percent / 100
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return sizes & (estimate >= limit - MARGIN * np.sqrt(limit * (1 - limit) / either))


def _sketches(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def profiles(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, row, n, set_key and sketch of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for at in range(0, batch.num_rows, 500):
                for shingles in shingle_sets(batch.column(2).slice(at, 500).to_pylist(), size):
                    sizes.append(len(shingles))
                    keys.append(set_key(shingles))
                    sketches.append(registers(shingles).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(sketches, pa.binary())],
                ["doc_id", "row", "n", "set_key", "sketch"],
            )

    source = docs.select("doc_id", row_key().alias("row"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, source.drop("text").schema.add("n", "long").add("set_key", "long").add("sketch", "binary"))


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            found = bands(_sketches(batch.column(1)))
            keys = np.repeat(batch.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view(np.int64)), pa.array(keys)], ["band", "set_key"])


def stars(points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """centre and set_key: each set with the first set of each band that it shares. Smaller sets have no other linked set."""
    able = points.where(100 * F.col("n") >= percent * (F.col("n") + 1))
    rows = able.select("set_key", "sketch").mapInArrow(_band_rows, "band long, set_key long")
    placed = rows.withColumn("centre", F.min("set_key").over(Window.partitionBy("band")))
    return placed.where("centre <> set_key").select("centre", "set_key").distinct()


def likely_pairs(pairs: DataFrame, points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sketches allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = (batch.column(name).to_numpy() for name in ("n_a", "n_b"))
                kept = likely_linked(*(_sketches(batch.column(name)) for name in ("sketch_a", "sketch_b")), n_a, n_b, percent)
                yield batch.select(["a", "b"]).filter(pa.array(kept))

    side = lambda name: points.select(
        F.col("set_key").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}")
    )
    # The side with many different keys first; a centre with many sets is a skewed key, which Spark splits.
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long")


def _links_within(star: pa.Table, percent: int) -> pa.Table:
    """Links that connect the components of the sets that meet here, as few as do."""
    keys, component, n, side = (star.column(name).to_numpy().copy() for name in ("set_key", "component", "n", "side"))
    sketches = _sketches(star.column("sketch"))
    shingles = star.column("shingles").combine_chunks()
    offsets, ids = shingles.offsets.to_numpy().astype(np.int64), np.unique(shingles.values.to_numpy(), return_inverse=True)[1]
    offsets = offsets - offsets[0]
    one_block = star.column("left")[0].as_py() == star.column("right")[0].as_py()
    present = np.zeros(ids.max(initial=0) + 1, dtype=bool)
    found = [[], []]
    for i in range(len(keys)):
        others = np.arange(i + 1, len(keys))
        others = others[component[others] != component[i]]
        if not one_block:
            others = others[side[others] != side[i]]
        near = [
            part[likely_linked(sketches[i], sketches[part], np.full(len(part), n[i]), n[part], percent)]
            for part in (others[k : k + 2048] for k in range(0, len(others), 2048))
        ]
        others = np.concatenate([others[:0], *near])
        if not len(others):
            continue
        mine = ids[offsets[i] : offsets[i + 1]]
        present[mine] = True
        shared = np.array([np.count_nonzero(present[ids[offsets[j] : offsets[j + 1]]]) for j in others])
        present[mine] = False
        linked = others[100 * shared >= percent * (n[i] + n[others] - shared)]
        joined, first = np.unique(component[linked], return_index=True)
        found[0].extend([keys[i]] * len(first))
        found[1].extend(keys[linked[first]])
        component[np.isin(component, joined)] = component[i]
    return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})


def links_within_stars(
    star: DataFrame, labels: DataFrame, points: DataFrame, sets: DataFrame, block: int = BLOCK, percent: int = PERCENT
) -> DataFrame:
    """Links (a, b) between different components of the sets around one centre."""
    centres = star.select("centre", F.col("centre").alias("set_key")).distinct()
    members = star.unionByName(centres).join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    members = members.join(points.select("set_key", "n"), "set_key")
    members = members.select("centre", "set_key", "n", F.coalesce("label", "set_key").alias("component"))
    members = materialise(members, "star-members")
    open_stars = members.groupBy("centre").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.sum("n").alias("shingles")
    )
    open_stars = open_stars.where("low <> high").select(
        "centre", F.ceil(F.col("shingles") / F.lit(block)).cast("long").alias("n_blocks")
    )
    side = F.pmod(F.xxhash64("set_key"), F.col("n_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    dealt = members.join(open_stars, "centre").withColumn("side", side).withColumn("other", other)
    dealt = dealt.withColumn("left", F.least("side", "other")).withColumn("right", F.greatest("side", "other"))
    whole = dealt.join(points.select("set_key", "sketch"), "set_key").join(sets, "set_key")
    whole = whole.select("centre", "left", "right", "set_key", "component", "n", "side", "sketch", "shingles")
    return whole.groupBy("centre", "left", "right").applyInArrow(lambda found: _links_within(found, percent), "a long, b long")


def set_components(docs: DataFrame, table: DataFrame, block: int = BLOCK, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """node (a set key) and label of every set that is linked with another one; `table` holds the profiles."""
    known = table.where("n > 0").groupBy("set_key").agg(F.min(F.struct("row", "n", "sketch")).alias("p"))
    points = materialise(known.select("set_key", "p.row", "p.n", "p.sketch"), "sketches")
    star = materialise(stars(points, percent), "stars")
    members = star.select("set_key").unionByName(star.select(F.col("centre").alias("set_key"))).distinct()
    points = materialise(points.join(members, "set_key", "left_semi"), "candidates")
    sets = sets_of(docs, points, size).join(members, "set_key", "left_semi").dropDuplicates(["set_key"])
    sets = materialise(sets, "candidate-sets")
    pairs = star.select(F.col("centre").alias("a"), F.col("set_key").alias("b"))
    links = materialise(verified(likely_pairs(pairs, points, percent), sets, percent), "star-links")
    labels = components(links)
    more = materialise(links_within_stars(star, labels, points, sets, block, percent), "inner-links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def dedup_documents(docs: DataFrame, block: int = BLOCK, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of the component) and kept (whether it is the document's own)."""
    table = materialise(profiles(docs, size), "profiles")
    labels = set_components(docs, table, block, size, percent)
    placed = table.select("doc_id", "n", "set_key").join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    component = F.when(F.col("n") > 0, F.coalesce("label", "set_key")).alias("component")
    placed = materialise(placed.select("doc_id", F.col("n").alias("n_shingles"), component), "placed")
    smallest = placed.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    own = F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    result = placed.join(smallest, "component", "left").select("doc_id", "n_shingles", own.alias("component_id"))
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
