"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed for every whole text in one pass; training and scoring read only them. The trees are
fit in numpy on about SAMPLE_ROWS labelled rows: statistics are binned by quantile, every level of a tree is split by
gradient sums per node and bin, and all trees are kept as arrays of feature, threshold and value in heap
order, which score all rows of a batch level by level.

Defined results: a null or empty text has statistics of 0 and is scored like any other; without labelled rows every
score is 0.5, with rows of one label only the score is near that label; null labels are not learned; labels of repeated
ids or rows all count. The label table is joined for training only, so it never repeats or drops a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.language_id import held_out
from cartwright.llm.quality_rules import measure
from cartwright.llm.sampling import hash_sample
from cartwright.session import materialise

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 60, 4, 64
RATE, L2, LEAST_ROWS = 0.15, 5.0, 10
DECISION = 0.3


def statistics(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """The columns `keep` and an array `stats` for each text."""
    measured = measure(docs, text, *keep)
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    stats = [
        F.log1p("n_words"),
        share("word_chars", "n_words"),
        share("n_symbols", "n_words"),
        share("n_upper", "n_letters"),
        share("n_letters", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        share("n_words", "n_lines"),
        F.log1p("n_lines"),
    ]
    return measured.select(*keep, F.array(*[s.cast("double") for s in stats]).alias("stats"))


@dataclass
class BoostedTrees:
    """Complete binary trees in heap order: feature and threshold of inner nodes, value of leaves."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        margin = np.full(len(stats), self.start)
        rows = np.arange(len(stats))
        depth = int(np.log2(self.value.shape[1]))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(stats), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (stats[rows, feature[node]] > threshold[node])
            margin += value[node - (len(value) - 1)]
        return 1 / (1 + np.exp(-margin))


def fit(stats: np.ndarray, label: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> BoostedTrees:
    """Boosts the logistic loss; the order of the rows does not matter."""
    n, width = stats.shape
    mean = np.clip(label.mean(), 0.01, 0.99)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in stats.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, stats.T)], axis=1)
    start = float(np.log(mean / (1 - mean)))
    margin = np.full(n, start)
    inner, leaves = 2**depth - 1, 2**depth
    features = np.zeros((trees, inner), dtype=np.int64)
    thresholds = np.full((trees, inner), np.inf)
    values = np.zeros((trees, leaves))
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        gradient, weight = chance - label, chance * (1 - chance)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            best = np.zeros(nodes)
            slot = (node - first) * BINS
            for k in range(width):
                at = slot + binned[:, k]
                sums = [
                    np.bincount(at, weights=w, minlength=nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                    for w in (gradient, weight, None)
                ]
                (g, h, c), (all_g, all_h, all_c) = sums, [s[:, -1:] for s in sums]
                gain = g**2 / (h + L2) + (all_g - g) ** 2 / (all_h - h + L2) - all_g**2 / (all_h + L2)
                gain[(c < LEAST_ROWS) | (all_c - c < LEAST_ROWS)] = 0
                gain = gain[:, : len(edges[k])]
                if not gain.shape[1]:
                    continue
                cut = gain.argmax(axis=1)
                gained = gain[np.arange(nodes), cut]
                for i in np.flatnonzero(gained > best + 1e-9):
                    best[i] = gained[i]
                    features[tree, first + i], thresholds[tree, first + i] = k, edges[k][cut[i]]
            right = stats[np.arange(n), features[tree, node]] > thresholds[tree, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = (np.bincount(leaf, weights=w, minlength=leaves) for w in (gradient, weight))
        values[tree] = -RATE * g / (h + L2)
        margin += values[tree][leaf]
    return BoostedTrees(start, features, thresholds, values)


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> BoostedTrees | None:
    """Trees from rows of stats and label (0 or 1); None without any. All columns choose the sample, so an id spreads copies."""
    rows = hash_sample(labelled.where("label IS NOT NULL"), sample_rows, *labelled.columns).select("stats", "label").toPandas()
    if rows.empty:
        return None
    rows = rows.assign(key=rows["stats"].map(tuple)).sort_values(["key", "label"])
    return fit(np.array(rows["key"].tolist()), rows["label"].to_numpy(dtype=np.float64))


def score(table: DataFrame, model: BoostedTrees | None, decision: float = DECISION) -> DataFrame:
    """Replaces the column stats by score and predicted."""
    keep = [c for c in table.columns if c != "stats"]
    if model is None:
        scored = table.drop("stats").withColumn("score", F.lit(0.5))
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stats = batch.column(batch.num_columns - 1)
                rows = stats.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                scores = model.score(rows) if batch.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)], [*batch.schema.names[:-1], "score"])

        scored = table.select(*keep, "stats").mapInArrow(run, table.select(*keep).schema.add("score", "double"))
    return scored.withColumn("predicted", (F.col("score") >= decision).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of each document, learned from labels of ids that are not held out."""
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id"), folds, fold).alias("held_out"))
    table = materialise(statistics(docs, "text", "doc_id", "held_out"), "document-statistics")
    known = labels.where("quality IS NOT NULL").select("doc_id", F.col("quality").alias("label"))
    labelled = table.where(~F.col("held_out")).join(known, "doc_id").select("stats", "label", "doc_id")
    return score(table, train(labelled))
