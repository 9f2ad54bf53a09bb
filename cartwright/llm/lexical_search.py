"""Ranked lexical search with MaxScore and bounds on pairs of terms.

The score of a document for an item is a sum over the item's terms of weight times a saturating share of the term's
occurrences, all in whole numbers (see `weights` and `impacts`).

1. `count_terms` reads the texts once: the number of terms of each document, and how often each term of the items occurs.
   The number of documents, their length and the documents of each term follow from it.
2. `build_index` writes an index in blocks of BLOCK_DOCS documents. A block has a list of documents and impacts for each
   term with its largest impact, and for each pair of terms that are neighbours by weight in some item the list of the documents
   that hold both, with the largest sum of both impacts.
3. `search_block` takes an item's terms from the rarest on. The rest of them can add at most their bound: the least that
   the maxima of single terms and the joint maxima of pairs add up to, which is below the sum of single maxima
   wherever two terms reach theirs in different documents. Once that is below the k-th best score, no other documents are
   taken up, and documents that can't reach it any more go. Documents of the rarest pairs are scored first, so that
   the k-th best score is high early; blocks whose bound is below it are skipped.
4. The k best of some blocks bound the k-th best score of all, and so the search of all blocks. The k best of the
   blocks are ranked together.

The result is exact. Items come in blocks of about ITEM_BYTES, whose terms bound what is sent to all tasks; the index is built for
the terms of a block of items.

Defined results: a null or empty text, of a document or an item, has no terms; repeated rows are documents of their own;
repeated items are one item; equal scores rank by id, null last; an empty table gives an empty result; other columns
are not read. Terms are compared as 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.text_blocks import Block, blocks
from cartwright.session import materialise

BEST = 20
BLOCK_DOCS = 4096
ITEM_BYTES = 1 << 20
#: Blocks that give a first bound of the k-th best score.
SEED_BLOCKS = 8

#: What separates terms: the ASCII characters other than letters and digits.
SEPARATORS = np.ones(256, dtype=bool)
SEPARATORS[0x30:0x3A] = SEPARATORS[0x41:0x5B] = SEPARATORS[0x61:0x7B] = SEPARATORS[0x80:] = False

INDEX = "block long, term int, other int, best long, docs array<int>, shares array<int>"
FOUND = "item int, score long"


class Item(NamedTuple):
    """An item's different terms, as places in the sorted vocabulary, and how often it holds each."""

    terms: np.ndarray
    times: np.ndarray


def item_terms(texts: list[str | None]) -> tuple[np.ndarray, list[Item]]:
    """The sorted hashes of all terms, and the items."""
    block = Block([(t or "").encode() for t in texts], lower=True, separators=SEPARATORS)
    hashes, place = np.unique(block.word_hashes(), return_inverse=True)
    ends = block.first_word
    return hashes, [Item(*np.unique(place[s:e], return_counts=True)) for s, e in zip(ends[:-1], ends[1:])]


def count_terms(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """doc_id, n (its terms with repeats), terms and times (those of the vocabulary) of the documents that have terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in blocks(batch.column(1).to_pylist()):
                block = Block(held, lower=True, separators=SEPARATORS)
                found = block.word_hashes()
                place = np.searchsorted(hashes, found)
                place[place == len(hashes)] = 0
                hit = np.flatnonzero(hashes[place] == found) if len(hashes) else np.zeros(0, dtype=np.int64)
                keys = block.text_of_word()[hit] * max(1, len(hashes)) + place[hit]
                keys, times = np.unique(keys, return_counts=True)
                ends = np.searchsorted(keys, np.arange(len(held) + 1) * max(1, len(hashes)))
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                    for values in (keys % max(1, len(hashes)), times)
                ]
                part = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(held)), pa.array(block.n_words), *lists], ["doc_id", "n", "terms", "times"]
                )
                yield part.filter(pa.array(block.n_words > 0))

    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    counts = T.ArrayType(T.IntegerType())
    schema = source.select("doc_id").schema.add("n", "long").add("terms", counts).add("times", counts)
    return source.mapInArrow(run, schema)


def documents_of_terms(counted: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_terms)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], ["term", "docs"])

    rows = counted.select("terms").mapInArrow(run, "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    out = np.zeros(n_terms, dtype=np.int64)
    out[rows["term"].to_numpy()] = rows["docs"].to_numpy()
    return out


def weights(n_docs: int, docs: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in docs], dtype=np.int64)


def shares(times: np.ndarray, n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """The share of a term's weight that a document of n terms gets for `times` occurrences, in millionths."""
    m = 75 + (25 * n * n_docs) // max(1, n_words)
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def by_weight(item: Item, weight: np.ndarray) -> Item:
    """The item's terms, the heaviest first; terms without weight go."""
    order = np.lexsort((item.terms, -weight[item.terms]))
    order = order[weight[item.terms[order]] > 0]
    return Item(item.terms[order], item.times[order])


def neighbour_pairs(items: list[Item]) -> list[tuple[int, int]]:
    """The pairs of terms that follow each other in some item."""
    return sorted({(int(a), int(b)) for item in items for a, b in zip(item.terms, item.terms[1:])})


def _index_block(ids: pa.Array, n, doc, term, times, weight, pairs, n_docs: int, n_words: int) -> dict[str, list]:
    """The index rows of one block; doc, term and times have an entry for each term of each document."""
    share = shares(times, n[doc], n_docs, n_words)
    order = np.lexsort((doc, term))
    doc, term, share = doc[order], term[order], share[order]
    edges = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1], [True]])) if len(term) else np.zeros(1, dtype=np.int64)
    lists = {int(term[s]): (doc[s:e], share[s:e]) for s, e in zip(edges[:-1], edges[1:])}
    out: dict[str, list] = {name: [] for name in ("term", "other", "best", "docs", "shares", "ids")}

    def add(a: int, b: int, best: int, docs, shared, known) -> None:
        for name, value in zip(out, (a, b, best, docs, shared, known)):
            out[name].append(value)

    add(-1, -1, 0, None, None, ids.to_pylist())
    for a, (docs, shared) in lists.items():
        add(a, -1, int(weight[a] * shared.max()), docs.astype(np.int32), shared.astype(np.int32), None)
    for a, b in pairs:
        if a in lists and b in lists:
            both, in_a, in_b = np.intersect1d(lists[a][0], lists[b][0], assume_unique=True, return_indices=True)
            if len(both):
                joint = weight[a] * lists[a][1][in_a] + weight[b] * lists[b][1][in_b]
                add(a, b, int(joint.max()), both.astype(np.int32), None, None)
    return out


def build_index(counted: DataFrame, weight: np.ndarray, pairs: list[tuple[int, int]], n_docs: int, n_words: int) -> DataFrame:
    """The rows of INDEX and ids. Of a block, the row of term -1 has the ids of its documents, rows with `other` are pairs."""
    ids = T.ArrayType(counted.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                part = batch.slice(at, BLOCK_DOCS)
                term, times = (part.column(name).flatten().to_numpy().astype(np.int64) for name in ("terms", "times"))
                size = np.diff(part.column("terms").offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), size)
                rows = _index_block(part.column("doc_id"), part.column("n").to_numpy(), doc, term, times, weight, pairs, n_docs, n_words)
                types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(batch.schema.field("doc_id").type))
                columns = [pa.array(values, kind) for values, kind in zip(rows.values(), types)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows["term"]), block)), *columns], ["block", *rows])
                block += 1

    schema = T._parse_datatype_string(INDEX).add("ids", ids)
    return counted.mapInArrow(run, schema)


def bounds(best: np.ndarray, times: np.ndarray, joint: list[int]) -> np.ndarray:
    """The most that the terms from each place on can add. joint[i] is the largest sum of terms i and i + 1 where they meet, or 0."""
    out = np.zeros(len(best) + 2, dtype=np.int64)
    for i in range(len(best) - 1, -1, -1):
        out[i] = times[i] * best[i] + out[i + 1]
        if i + 1 < len(best):
            common = min(times[i], times[i + 1])
            together = max(best[i], best[i + 1], joint[i])
            pair = common * together + (times[i] - common) * best[i] + (times[i + 1] - common) * best[i + 1]
            out[i] = min(out[i], pair + out[i + 2])
    return out


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_block(item: Item, lists: dict, pairs: dict, weight: np.ndarray, n_docs: int, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block (places) with their scores: all that may be among the k best, whose k-th score is `least` or more.

    `lists` has documents, shares and largest impact of each term, `pairs` documents and largest joint impact.
    """
    there = [(t, q) for t, q in zip(item.terms.tolist(), item.times.tolist()) if t in lists]
    if not there:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    terms, times = [t for t, _ in there], np.array([q for _, q in there])
    best = np.array([lists[t][2] for t in terms])
    # Neighbours of the item that never meet in the block have no list; other terms that are neighbours here have no joint bound.
    known = set(zip(item.terms.tolist(), item.terms.tolist()[1:]))
    bound = lambda a, b: pairs[(a, b)][1] if (a, b) in pairs else 0 if (a, b) in known else lists[a][2] + lists[b][2]
    joint = [bound(a, b) for a, b in zip(terms, terms[1:])]
    rest = bounds(best, times, joint)
    if rest[0] < least:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def added(i: int, docs: np.ndarray) -> np.ndarray:
        """What term i adds to the score of each of the documents."""
        held, share, _ = lists[terms[i]]
        place = np.minimum(np.searchsorted(held, docs), len(held) - 1)
        return np.where(held[place] == docs, times[i] * weight[terms[i]] * share[place], 0)

    first_pair = next((pairs[p][0] for p in zip(terms, terms[1:]) if p in pairs), None)
    if first_pair is not None and len(first_pair) >= k:
        least = max(least, _kth(sum(added(i, first_pair) for i in range(len(terms))), k))
    score = np.zeros(n_docs, dtype=np.int64)
    i = 0
    while i < len(terms) and rest[i] >= least:
        docs, share, _ = lists[terms[i]]
        score[docs] += times[i] * weight[terms[i]] * share
        i += 1
        least = max(least, _kth(score, k))
    left = np.flatnonzero((score > 0) & (score + rest[i] >= least))
    scores = score[left]
    for j in range(i, len(terms)):
        scores = scores + added(j, left)
        good = scores + rest[j + 1] >= max(least, _kth(scores, k))
        left, scores = left[good], scores[good]
    return left, scores


def _search(table: pa.Table, items: list[Item], weight: np.ndarray, least: dict[int, int], k: int) -> pa.Table:
    """The k best documents of one block for each item."""
    term, other, best = (table.column(name).to_numpy() for name in ("term", "other", "best"))
    columns = {}
    for name in ("docs", "shares"):
        column = table.column(name).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        columns[name] = column.values.to_numpy().astype(np.int64), column.offsets.to_numpy()
    cut = lambda name, row: columns[name][0][columns[name][1][row] : columns[name][1][row + 1]]
    lists, pairs, ids = {}, {}, []
    for row, (a, b) in enumerate(zip(term.tolist(), other.tolist())):
        if a < 0:
            ids = table.column("ids")[row].as_py()
        elif b < 0:
            lists[a] = cut("docs", row), cut("shares", row), int(best[row])
        else:
            pairs[(a, b)] = cut("docs", row), int(best[row])
    found: list[tuple] = []
    for number, item in enumerate(items):
        docs, scores = search_block(item, lists, pairs, weight, len(ids), least.get(number, 0), k)
        if len(docs) > k:
            good = scores >= _kth(scores, k)
            docs, scores = docs[good], scores[good]
        known = [(score, ids[d]) for d, score in zip(docs.tolist(), scores.tolist())]
        known.sort(key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
        found.extend((number, score, doc) for score, doc in known[:k])
    number, score, doc = zip(*found) if found else ([], [], [])
    doc_type = table.schema.field("ids").type.value_type
    return pa.table({"item": pa.array(number, pa.int32()), "score": pa.array(score, pa.int64()), "doc_id": pa.array(doc, doc_type)})


def best_documents(index: DataFrame, items: list[Item], weight: np.ndarray, least: dict[int, int], k: int) -> DataFrame:
    """item (its number), score and doc_id of the k best documents of each item, and their rank."""
    schema = T._parse_datatype_string(FOUND).add("doc_id", index.schema["ids"].dataType.elementType)
    found = index.groupBy("block").applyInArrow(lambda table: _search(table, items, weight, least, k), schema)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_items(docs: DataFrame, texts: list[str | None], k: int) -> DataFrame:
    """item (place in `texts`), rank, doc_id and score."""
    hashes, items = item_terms(texts)
    counted = materialise(count_terms(docs, hashes), "term-counts")
    totals = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    weight = weights(totals["docs"], documents_of_terms(counted, len(hashes)))
    items = [by_weight(item, weight) for item in items]
    index = materialise(build_index(counted, weight, neighbour_pairs(items), totals["docs"], totals["words"]), "search-index")
    seeds = [r["block"] for r in index.where("term = -1").select("block").orderBy(F.xxhash64("block")).limit(SEED_BLOCKS).collect()]
    some = best_documents(index.where(F.col("block").isin(seeds)), items, weight, {}, k).where(F.col("rank") == k)
    least = {r["item"]: r["score"] for r in some.select("item", "score").collect()}
    return best_documents(index, items, weight, least, k)


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents (doc_id, text) of each item (item_id, text)."""
    items = materialise(items.select("item_id", "text").distinct().withColumn("key", F.xxhash64("item_id", "text")), "items")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = 1 + size // ITEM_BYTES
    parts = []
    for block in range(n_blocks):
        mine = items.where(F.pmod("key", F.lit(n_blocks)) == block).select("key", "text").orderBy("key").toArrow()
        texts = mine["text"].to_pylist()
        keys = items.sparkSession.createDataFrame(pa.table({"item": pa.array(range(len(texts)), pa.int32()), "key": mine["key"]}))
        parts.append(_search_items(docs, texts, k).join(keys, "item").select("key", "rank", "doc_id", "score"))
    found = reduce(DataFrame.unionByName, parts)
    return found.join(items.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
