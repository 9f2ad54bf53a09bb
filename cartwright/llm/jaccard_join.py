"""N-gram Jaccard self-join of documents with a count-vector R-tree.

A document's set holds the hashes of its distinct word shingles. The hashes are dealt into GROUPS groups; the counts per
group are the document's point. Two sets share at most the sum of the smaller of both counts over the groups,
which drops most pairs unseen; what is left is verified with the sets.

A tree over all points cannot be shared out, as its boxes overlap in so many dimensions that a search visits most of
them. So its top is an exact directory. Documents of one size class (sizes within 100/PERCENT) deal their shingles into
more groups than two linked documents of that size can differ in, and send a fingerprint of each non-empty group:
linked documents agree in at least one such cell. Documents also send the cells of the next class. There are so many
groups that few documents fill no more of them than they can differ in; a cell of a single shingle would bring together
all documents with a common phrase.
Below the directory there are small trees:

1. Each document is paired with the first document of its cells; pairs that pass the count bound are verified. Stars of
   a first document and those it shares a cell with are done where all are connected by then, so a large group of near
   copies costs one pair a document.
2. In the stars that are left an R-tree over the points finds all pairs of different components that pass the bound.
   The points of a star meet first, and the sets of those that have a partner then verify the pairs where they meet. Only
   links that connect something are returned: their number follows that of the documents, also where most pairs of a large
   group are just below the limit. A star with more than BLOCK documents is split into pairs of blocks.

Links inside a component that is already connected are not listed, so the result is the components, exactly.

Defined results: empty or null texts have an empty set, are linked with nothing and form their own component; a text
of fewer than SHINGLE words has its whole sequence as its one shingle; repeated rows and equal sets link; a null id is the
smallest of a component only where there is no other. Sets are 64-bit hashes of shingles and a set is known by a 64-bit
hash of it.

SHINGLE and PERCENT are the contract of the query; other callers pass their own shingle size and percent.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm import bitmap
from cartwright.llm.components import components
from cartwright.llm.text_blocks import Block, blocks, mix64
from cartwright.session import materialise, materialise_alone

SHINGLE = 4
#: Linked: 100 * shared >= PERCENT * union.
PERCENT = 85
GROUPS = 256
#: Documents, and shingles of them, that meet in one task of each of two blocks.
BLOCK, BLOCK_SHINGLES = 4096, 1 << 20
LEAF, FAN = 16, 8

_U = np.uint64


def row_key() -> Column:
    """A hash of id and text; rows that differ in neither are the same row."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z in lower case."""
    for _, held in blocks(texts):
        block = Block(held, lower=True)
        hashes, text, _ = block.grams(size, short=True)
        order = np.lexsort((hashes, text))
        hashes, text = hashes[order], text[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
        hashes, text = hashes[new], text[new]
        ends = np.searchsorted(text, np.arange(len(held) + 1))
        for k in range(len(held)):
            yield hashes[ends[k] : ends[k + 1]]


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a set; 0 for the empty one."""
    if not len(shingles):
        return 0
    total = mix64(shingles).sum(dtype=_U) + _U(len(shingles))
    return int(mix64(np.array([total], dtype=_U)).view(np.int64)[0])


@lru_cache(maxsize=8)
def class_starts(percent: int = PERCENT) -> np.ndarray:
    """The least size of each size class; linked sizes are in one class or in neighbouring ones."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts)


def most_different(largest: int, percent: int = PERCENT) -> int:
    """Shingles that are in only one of two linked sets of at most `largest` shingles each."""
    return 2 * largest * (100 - percent) // (100 + percent)


@lru_cache(maxsize=1024)
def directory_groups(size_class: int, percent: int = PERCENT) -> int:
    """Groups of a class, so many that its smallest sets, too, fill more of them than linked sets can differ in.

    That is meant up to two standard deviations; the smallest sets are those of the class before that send its cells.
    """
    starts = class_starts(percent)
    k, least = most_different(int(starts[size_class + 1]) - 1, percent), int(starts[max(0, size_class - 1)])
    groups = k + 5 + k // 50
    while groups < least:
        each = least / groups
        empty = np.exp(-each)
        if groups * (1 - empty) - 2 * np.sqrt(groups * empty * (1 - (1 + each) * empty)) > k:
            break
        groups += 1 + groups // 100
    return groups


def cells(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The fingerprints of a set's cells. Two linked sets that differ have one in common.

    With k the most that linked sets of the class differ in, at most k groups differ; a set with more than
    k non-empty groups shares one of these with each linked set. A set that has no more also sends the first
    shingles by hash, of which two linked sets share one (a prefix filter). This covers the pairs of two such sets.
    """
    n, found = len(shingles), []
    starts = class_starts(percent)
    own = int(np.searchsorted(starts, n, side="right")) - 1
    for size_class in (own, own + 1) if n else ():
        k = most_different(int(starts[size_class + 1]) - 1, percent)
        if not k:
            continue
        groups = directory_groups(size_class, percent)
        group = (shingles >> _U(20)) % _U(groups)
        order = np.argsort(group, kind="stable")
        group = group[order]
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        salt = _U((size_class + 1) * 0xD1B54A32D192ED03 % (1 << 64))
        content = np.add.reduceat(mix64(shingles[order]), first)
        found.append(mix64(content + group[first] * _U(0x9E3779B97F4A7C15) + salt))
        if len(first) <= k:
            found.append(mix64(np.sort(mix64(shingles + salt + _U(1)))[: n - -(-n * percent // 100) + 1]))
    return np.concatenate(found) if found else np.zeros(0, dtype=_U)


def profiles(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, row, n, set_key and counts (the point) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, points = [], [], []
            for shingles in shingle_sets(batch.column(2).to_pylist(), size):
                sizes.append(len(shingles))
                keys.append(set_key(shingles))
                points.append(np.bincount((shingles >> _U(40)).astype(np.int64) % GROUPS, minlength=GROUPS))
            flat = pa.array(np.concatenate(points) if points else [], pa.int32())
            counts = pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1) * GROUPS, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), counts],
                ["doc_id", "row", "n", "set_key", "counts"],
            )

    source = docs.select("doc_id", row_key().alias("row"), F.col("text").cast("binary").alias("text"))
    schema = source.drop("text").schema.add("n", "long").add("set_key", "long").add("counts", T.ArrayType(T.IntegerType()))
    return source.mapInArrow(run, schema)


def _cell_rows(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(cell, set_key); equal sets of a batch are sent once."""
    for batch in batches:
        seen: set[int] = set()
        for at in range(0, batch.num_rows, 500):
            found, keys = [], []
            for shingles in shingle_sets(batch.column(0).slice(at, 500).to_pylist(), size):
                key = set_key(shingles)
                if len(shingles) and key not in seen:
                    seen.add(key)
                    found.append(cells(shingles, percent))
                    keys.append(np.full(len(found[-1]), key, dtype=np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(keys))], ["cell", "set_key"]
                )


def _shared_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by cell and set_key, those of cells with several sets, with the first set of the cell."""
    held_cell = held_key = first = None
    shared = False

    def out(cell: np.ndarray, key: np.ndarray, firsts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(key), pa.array(firsts)], ["cell", "set_key", "first"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column(0).to_numpy()
        key = batch.column(1).to_numpy()
        fresh = np.ones(len(cell), dtype=bool)
        fresh[1:] = (cell[1:] != cell[:-1]) | (key[1:] != key[:-1])
        if held_cell is not None and cell[0] == held_cell and key[0] == held_key:
            fresh[0] = False
        cell, key = cell[fresh], key[fresh]
        if not len(cell):
            continue
        # The row that was held back comes first; the last row is held back, as its cell may go on.
        if held_cell is not None:
            cell, key = np.concatenate([[held_cell], cell]), np.concatenate([[held_key], key])
        new = np.ones(len(cell), dtype=bool)
        new[1:] = cell[1:] != cell[:-1]
        start = np.maximum.accumulate(np.where(new, np.arange(len(cell)), 0))
        firsts = key[start]
        if held_cell is not None and first is not None:
            firsts[cell == held_cell] = first
        multi = np.zeros(len(cell), dtype=bool)
        multi[:-1] |= ~new[1:]
        multi |= ~new
        if held_cell is not None and shared:
            multi[0] = True
        held_cell, held_key, first, shared = int(cell[-1]), int(key[-1]), int(firsts[-1]), bool(not new[-1] or (len(cell) == 1 and shared))
        multi[-1] = False
        if multi.any():
            yield out(cell[multi], key[multi], firsts[multi])
    if shared:
        yield out(np.array([held_cell]), np.array([held_key]), np.array([first]))


def shared_cells(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """cell, set_key and first for every cell that several different sets have."""
    text = docs.select(F.col("text").cast("binary").alias("text"))
    rows = text.mapInArrow(lambda batches: _cell_rows(batches, size, percent), "cell long, set_key long")
    sorted_rows = rows.repartition("cell").sortWithinPartitions("cell", "set_key")
    return sorted_rows.mapInArrow(_shared_cells, "cell long, set_key long, first long")


def needed_overlap(n_a: Column, n_b: Column, percent: int = PERCENT) -> Column:
    """Least number of shared shingles of a linked pair, as a value to compare whole numbers with."""
    return (n_a + n_b) * F.lit(percent / (100 + percent)) - F.lit(1e-6)


def bounded_pairs(pairs: DataFrame, points: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose count vectors allow a link."""
    side = lambda name: points.select(
        F.col("set_key").alias(name), F.col("n").alias(f"n_{name}"), F.col("counts").alias(f"counts_{name}")
    )
    minima = F.aggregate(F.zip_with("counts_a", "counts_b", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.where(minima >= needed_overlap(F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that are linked."""
    side = lambda name: sets.select(F.col("set_key").alias(name), F.col("shingles").alias(f"set_{name}"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    joined = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("shared", shared)
    return joined.where(100 * F.col("shared") >= percent * union).select("a", "b")


def sets_of(docs: DataFrame, rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """set_key and shingles for the documents whose row key is in `rows` (row), and a few more.

    A bitmap of the row keys picks the texts in a pass that does not shuffle them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.build(rows, F.col("row")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.filter(pa.array(bitmap.may_hold(shared.value, batch.column(0).to_numpy())))
            for at in range(0, wanted.num_rows, 200):
                found = [s for s in shingle_sets(wanted.column(1).slice(at, 200).to_pylist(), size) if len(s)]
                if found:
                    ends = np.concatenate([[0], np.cumsum([len(s) for s in found])])
                    flat = pa.array(np.concatenate(found).view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([set_key(s) for s in found], pa.int64()),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                        ],
                        ["set_key", "shingles"],
                    )

    source = docs.select(row_key().alias("row"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, "set_key long, shingles array<long>")


class CountTree:
    """An R-tree over points of counts: leaves of LEAF points, FAN boxes to a node, packed by size and first counts.

    A box keeps the largest count per group, the least and largest size, and the component if it has only one.
    """

    def __init__(self, n: np.ndarray, counts: np.ndarray, component: np.ndarray, percent: int = PERCENT):
        self.percent = percent
        self.order = np.lexsort((counts[:, 1], counts[:, 0], n))
        if counts.max(initial=0) < 256:
            counts = counts.astype(np.uint8)
        self.n, self.counts, self.component = n[self.order], counts[self.order], component[self.order]
        alone = np.stack([self.component, self.component], axis=1)
        self.levels = [(self.counts, self.n, self.n, alone)]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            top, low, high, parts = self.levels[-1]
            at = np.arange(0, len(low), width)
            least, most = np.minimum.reduceat(parts[:, 0], at), np.maximum.reduceat(parts[:, 1], at)
            self.levels.append(
                (
                    np.maximum.reduceat(top, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.stack([least, most], axis=1),
                )
            )
            width = FAN

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of all pairs of points of different components whose bound allows a link."""
        a, b = self._possible(len(self.levels) - 1, *np.zeros((2, 1), dtype=np.int64))
        for level in range(len(self.levels) - 2, -1, -1):
            parts = [self._possible(level, *self._children(level, a[k : k + 512], b[k : k + 512])) for k in range(0, len(a), 512)]
            a, b = (np.concatenate([p[side] for p in parts]) if parts else a[:0] for side in (0, 1))
        return self.order[a], self.order[b]

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of children of the boxes a and b, each pair once."""
        width, most = LEAF if level == 0 else FAN, len(self.levels[level][1])
        left, right = np.broadcast_arrays(
            (a[:, None] * width + np.arange(width))[:, :, None], (b[:, None] * width + np.arange(width))[:, None, :]
        )
        left, right = left.ravel(), right.ravel()
        fit = (left < most) & (right < most) & (left <= right)
        return left[fit], right[fit]

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of different components whose sizes and counts allow a link."""
        top, low, high, parts = self.levels[level]
        if level == 0:
            a, b = a[a < b], b[a < b]
        fit = ~((parts[a, 0] == parts[a, 1]) & (parts[b, 0] == parts[b, 1]) & (parts[a, 0] == parts[b, 0]))
        fit &= (100 * high[a] >= self.percent * low[b]) & (100 * high[b] >= self.percent * low[a])
        a, b = a[fit], b[fit]
        minima = np.minimum(top[a], top[b]).sum(axis=1, dtype=np.int64)
        fit = (100 + self.percent) * minima >= self.percent * (low[a] + low[b])
        return a[fit], b[fit]


def _tree_pairs(found: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs of the points that meet here whose bound allows a link between components."""
    component, n, side = (found.column(name).to_numpy() for name in ("component", "n", "side"))
    counts = found.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, GROUPS)
    a, b = CountTree(n, counts, component, percent).pairs()
    if found.column("left")[0].as_py() != found.column("right")[0].as_py():
        # Two blocks meet, where pairs within one block do not count.
        a, b = a[side[a] != side[b]], b[side[a] != side[b]]
    return a, b


def _tree_members(found: pa.Table, percent: int) -> pa.Table:
    """The rows that are in some pair of the tree, without their counts."""
    return found.drop_columns("counts").take(pa.array(np.unique(np.concatenate(_tree_pairs(found, percent)))))


def _tree_links(found: pa.Table, percent: int) -> pa.Table:
    """Links that connect the components of the sets that meet here, as few as do: the pairs of the tree, verified with the sets."""
    keys, component, n = (found.column(name).to_numpy().copy() for name in ("set_key", "component", "n"))
    a, b = _tree_pairs(found, percent)
    links: list[list[int]] = [[], []]
    if len(a):
        shingles = found.column("shingles").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(shingles.value_lengths().to_numpy())])
        ids = np.unique(shingles.flatten().to_numpy(), return_inverse=True)[1]
        present = np.zeros(ids.max() + 1, dtype=bool)
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        edge = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1], [True]]))
        for i, s, e in zip(a[edge[:-1]], edge[:-1], edge[1:]):
            # Pairs that earlier links have connected need no check.
            others = b[s:e][component[b[s:e]] != component[i]]
            mine = ids[ends[i] : ends[i + 1]]
            present[mine] = True
            shared = np.array([np.count_nonzero(present[ids[ends[j] : ends[j + 1]]]) for j in others], dtype=np.int64)
            present[mine] = False
            linked = others[100 * shared >= percent * (n[i] + n[others] - shared)]
            joined, first = np.unique(component[linked], return_index=True)
            links[0].extend([keys[i]] * len(first))
            links[1].extend(keys[linked[first]])
            component[np.isin(component, joined)] = component[i]
    return pa.table({"a": pa.array(links[0], pa.int64()), "b": pa.array(links[1], pa.int64())})


def open_links(
    shared: DataFrame, labels: DataFrame, points: DataFrame, sets: DataFrame, block: int = BLOCK, percent: int = PERCENT
) -> DataFrame:
    """Links (a, b) between sets that share a cell and are in different components, as many as connect something.

    Sets that share a cell have its first set in common, so they meet around it: once, however many cells they share.
    """
    star = shared.where("set_key <> first").select("first", "set_key").distinct()
    members = star.unionByName(star.select("first", F.col("first").alias("set_key")).distinct())
    members = members.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left").join(points.select("set_key", "n"), "set_key")
    members = materialise(members.select("first", "set_key", "n", F.coalesce("label", "set_key").alias("component")), "star-components")
    stars_left = members.groupBy("first").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.greatest(F.count(F.lit(1)) / F.lit(block), F.sum("n") / F.lit(BLOCK_SHINGLES)).alias("blocks"),
    )
    stars_left = stars_left.where("low <> high").select("first", F.ceil("blocks").cast("long").alias("n_blocks"))
    side = F.pmod(F.xxhash64("set_key"), F.col("n_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    dealt = members.join(stars_left, "first").withColumn("side", side).withColumn("other", other)
    dealt = dealt.withColumn("left", F.least("side", "other")).withColumn("right", F.greatest("side", "other"))
    counts = points.select("set_key", "counts")
    met = dealt.select("first", "left", "right", "set_key", "component", "n", "side")
    # The points go first: a set is sent only where its point has a partner.
    pointed = met.join(counts, "set_key").select(*met.columns, "counts").groupBy("first", "left", "right")
    met = materialise(pointed.applyInArrow(lambda found: _tree_members(found, percent), met.schema), "tree-members")
    sets = bitmap.within(sets, "set_key", met, "set_key").dropDuplicates(["set_key"])
    whole = met.join(counts, "set_key").join(sets, "set_key").select(*met.columns, "counts", "shingles")
    return whole.groupBy("first", "left", "right").applyInArrow(lambda found: _tree_links(found, percent), "a long, b long")


def set_components(
    docs: DataFrame, table: DataFrame, block: int = BLOCK, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """node (a set key) and label of every set that is linked with another one; `table` holds the profiles."""
    shared = materialise(shared_cells(docs, size, percent), "shared-cells")
    members = shared.select("set_key").distinct()
    known = table.join(members, "set_key", "left_semi").groupBy("set_key")
    points = materialise(
        known.agg(F.min(F.struct("row", "n", "counts")).alias("p")).select("set_key", "p.row", "p.n", "p.counts"), "points"
    )
    sets = materialise(sets_of(docs, points, size), "sets")
    points = points.drop("row")
    stars = shared.where("set_key <> first").select(F.col("first").alias("a"), F.col("set_key").alias("b")).distinct()
    likely = materialise(bounded_pairs(stars, points, percent), "likely-pairs")
    paired = bitmap.within(sets, "set_key", likely.select(F.explode(F.array("a", "b")).alias("paired")), "paired")
    links = materialise(verified(likely, paired, percent), "star-links")
    labels = components(links)
    more = materialise(open_links(shared, labels, points, sets, block, percent), "tree-links")
    return labels if more.isEmpty() else components(links.unionByName(more))


def join_documents(docs: DataFrame, block: int = BLOCK, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, row, n_shingles, component and component_id of each document.

    `component` is the same for the documents of a component, component_id is its smallest doc_id.
    """
    table = materialise(profiles(docs, size), "profiles")
    labels = set_components(docs, table, block, size, percent)
    placed = table.drop("counts").join(labels.withColumnRenamed("node", "set_key"), "set_key", "left")
    placed = placed.withColumn("component", F.when(F.col("n") > 0, F.coalesce("label", "set_key")))
    placed = materialise(placed.select("doc_id", "row", F.col("n").alias("n_shingles"), "component"), "placed")
    smallest = placed.where("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = placed.join(smallest, "component", "left")
    return joined.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def copies(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """touched_id, touched_row and is_best of the rows that go or, if is_best, of which one stays."""
    placed = join_documents(docs, size=size, percent=percent).select("doc_id", "row", "n_shingles", "component")
    rows = materialise(placed.groupBy("component", "doc_id", "row").agg(F.count(F.lit(1)).alias("copies")), "rows")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"), F.col("copies"))
    best = rows.where("component IS NOT NULL").groupBy("component").agg(F.min(rank).alias("best"))
    is_best = (F.col("row") == F.col("best.row")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
    marked = rows.join(best, "component").withColumn("is_best", is_best).where("NOT is_best OR copies > 1")
    return marked.select(F.col("doc_id").alias("touched_id"), F.col("row").alias("touched_row"), "is_best")


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Of each component the row with the smallest id (then row key), and every document without words.

    The columns are those of `docs`. Fully repeated rows of a survivor are reduced to one.
    """
    touched = materialise_alone(docs.sparkSession, lambda: copies(docs, size, percent), "copies")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", row_key().alias("row"))
    maybe, rest = bitmap.split(whole, "row", touched, "touched_row")
    same = (F.col("row") == F.col("touched_row")) & F.col("doc_id").eqNullSafe(F.col("touched_id"))
    joined = maybe.join(touched, same, "left")
    kept = rest.select("doc").unionByName(joined.where("is_best IS NULL").select("doc"))
    if not touched.where("is_best").isEmpty():
        kept = kept.unionByName(joined.where("is_best").dropDuplicates(["row", "doc_id"]).select("doc"))
    return kept.select("doc.*")
