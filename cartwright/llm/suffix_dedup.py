"""Removal of long repeated byte strings, by sorted samples of suffixes.

Every byte that lies in a string of LENGTH bytes that also starts anywhere else, in the same or another text, goes.
The start of such a string is a suffix whose first LENGTH bytes are equal to those of another one.

The sample. The string at a start holds LENGTH - GRAM + 1 grams of GRAM bytes; its sample is the leftmost of
the least by fingerprint. Equal strings have equal samples at equal places, wherever they lie, which is what a
difference cover is for, with about one sample in 130 bytes instead of two in three. Consecutive starts with
one sample form a block.

1. Samples are named by their gram and grouped; a name that occurs once has no repeated start and drops out.
2. The names are refined to the whole block, the bytes of all its strings: blocks with equal names repeat
   in full. This settles the inside of copies, however many there are.
3. The remaining starts, those of different blocks that have a sample in common, are merged: they are sorted by the
   fingerprint of their LENGTH bytes and each is compared with its neighbours.
4. The repeated starts of a text become spans.

Strings are known by 64-bit fingerprints. Results belong to a text, so that copies of a whole text need no rows of their
own. A text of LENGTH bytes or more that occurs twice goes as a whole.

Defined results: a null text is empty; texts shorter than LENGTH bytes stay; within a run of one byte all starts but
those with fewer than LENGTH bytes left repeat; ids may be null or repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm import bitmap
from cartwright.llm.text_blocks import blocks, mix64, multipliers
from cartwright.session import materialise

LENGTH = 400
GRAM = 128
#: Bytes that are fingerprinted at once; a longer text is cut, with an overlap of LENGTH - 1 bytes.
PIECE = 1 << 18
#: Texts that a task holds as Python objects at once.
SLICE = 1000
PLACE_MASK = np.uint64((1 << 22) - 1)

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.ones(1, dtype=_U)
    for _ in range(bits):
        out = np.concatenate([out, out * _U(pow(base, len(out), 1 << 64))])
    return out


class Fingerprints:
    """Fingerprints of any substring of some bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        bits = max(20, len(data).bit_length())
        values = multipliers(256, seed=400)[data]
        self.sums = np.concatenate([np.zeros(1, dtype=_U), np.cumsum(values * _powers(_BASE, bits)[: len(data)], dtype=_U)])
        self.scale = _powers(_INVERSE, bits)

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.scale[starts])

    def all_of(self, size: int) -> np.ndarray:
        """Of every substring of `size` bytes."""
        n = max(0, len(self.sums) - size)
        return mix64((self.sums[size:] - self.sums[:n]) * self.scale[:n])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values, from running minima of stretches of that width."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(_U).max, dtype=_U)
    padded[:n] = values
    stretch = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(stretch, axis=1).ravel()
    behind = np.minimum.accumulate(stretch[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Piece:
    """Consecutive bytes of one or several texts, their fingerprints and their blocks of starts."""

    def __init__(self, parts: list[tuple[int, int, bytes]], length: int):
        """`parts` has the number of a text, where in it the part begins, and the bytes."""
        data = np.frombuffer(b"".join(p[2] for p in parts), dtype=np.uint8)
        sizes = np.array([len(p[2]) for p in parts], dtype=np.int64)
        begin = np.cumsum(sizes) - sizes
        self.prints = Fingerprints(data)
        gram = min(GRAM, length)
        grams = self.prints.all_of(gram)
        # The place below the leading bits of the print makes the leftmost of equal grams the sample.
        placed = (grams & ~PLACE_MASK) | np.arange(len(grams), dtype=_U)
        sample = (sliding_minimum(placed, length - gram + 1) & PLACE_MASK).astype(np.int64)
        edges = np.zeros(len(data) + 1, dtype=np.int64)
        long_enough = sizes >= length
        edges[begin[long_enough]] += 1
        edges[begin[long_enough] + sizes[long_enough] - length + 1] -= 1
        starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        sample = sample[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = sample[1:] != sample[:-1]
        first = np.flatnonzero(new)
        self.length = length
        self.low = starts[first]
        self.n = np.diff(np.append(first, len(starts)))
        self.gram = grams[sample[first]]
        part = np.searchsorted(begin, self.low, side="right") - 1
        self.text = np.array([p[0] for p in parts], dtype=np.int64)[part]
        #: Where the block begins in its text.
        self.place = self.low - begin[part] + np.array([p[1] for p in parts], dtype=np.int64)[part]
        self.block = mix64(self.prints.at(self.low, self.low + self.n - 1 + length) + self.n.astype(_U))

    def start_prints(self, blocks_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprint of every start of the blocks, and the block of each."""
        n = self.n[blocks_]
        which = np.repeat(blocks_, n)
        starts = self.low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return self.prints.at(starts, starts + self.length), which


def pieces(texts: list[bytes | None], length: int) -> Iterator[Piece]:
    """The texts in pieces of about PIECE bytes; texts shorter than `length` have no starts and are left out."""
    for first, held in blocks(texts, PIECE):
        parts = [(first + k, 0, text) for k, text in enumerate(held) if len(text) >= length]
        if not parts:
            continue
        if len(parts) == 1 and len(parts[0][2]) > 2 * PIECE:
            k, _, text = parts[0]
            for at in range(0, len(text) - length + 1, PIECE):
                yield Piece([(k, at, text[at : at + PIECE + length - 1])], length)
        else:
            yield Piece(parts, length)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.xxhash64(whole).alias("text_key"), whole.alias("text"))


def _new_texts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Keys and texts of a batch in slices, each text of the batch once."""
    keys, first = np.unique(batch.column(0).to_numpy(), return_index=True)
    fresh = np.zeros(batch.num_rows, dtype=bool)
    fresh[first] = True
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE).filter(pa.array(fresh[at : at + SLICE]))
        yield part.column(0).to_numpy(), part.column(1).to_pylist()


def sample_blocks(texts: DataFrame, length: int) -> DataFrame:
    """gram, block, text_key, low and n of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, held in _new_texts(batch):
                for piece in pieces(held, length):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(piece.gram.view(np.int64)),
                            pa.array(piece.block.view(np.int64)),
                            pa.array(keys[piece.text]),
                            pa.array(piece.place),
                            pa.array(piece.n),
                        ],
                        ["gram", "block", "text_key", "low", "n"],
                    )

    return texts.mapInArrow(run, "gram long, block long, text_key long, low long, n long")


START = "print long, text_key long, low long, n long"


def start_rows(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The starts of the blocks `wanted` (text_key, low), and of a few others, to be merged.

    n is 1 for a start to compare. Prints that a piece holds twice are settled there: their starts are sent as runs of
    -n starts, and the print once, with n 0, for the others to compare with.
    """
    block_key = F.col("text_key").bitwiseXOR(F.col("low"))
    maps = bitmap.build(wanted, F.col("text_key")), bitmap.build(wanted, block_key)
    shared = texts.sparkSession.sparkContext.broadcast(maps)

    def rows(prints: np.ndarray, keys: np.ndarray, low: np.ndarray, n: np.ndarray | int) -> pa.RecordBatch:
        n = np.full(len(prints), n, dtype=np.int64) if isinstance(n, int) else n
        columns = [prints.view(np.int64), keys, low, n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in START.split(", ")])

    def compared(piece: Piece, keys: np.ndarray, blocks_wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = keys[piece.text]
        chosen = np.flatnonzero(bitmap.may_hold(blocks_wanted, key ^ piece.place))
        prints, which = piece.start_prints(chosen)
        if not len(prints):
            return
        n = piece.n[chosen]
        low = piece.place[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        key = key[which]
        order = np.argsort(prints, kind="stable")
        same = prints[order][1:] == prints[order][:-1]
        twice = np.zeros(len(prints), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        yield rows(prints[~twice], key[~twice], low[~twice], 1)
        if twice.any():
            seen = np.unique(prints[twice])
            yield rows(seen, np.zeros(len(seen), dtype=np.int64), np.zeros(len(seen), dtype=np.int64), 0)
            key, low = key[twice], low[twice]
            edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (low[1:] != low[:-1] + 1)]))
            size = np.diff(np.append(edge, len(key)))
            yield rows(mix64(key[edge].view(_U) + low[edge].astype(_U)), key[edge], low[edge], -size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts_wanted, blocks_wanted = shared.value
        for batch in batches:
            wanted_here = batch.filter(pa.array(bitmap.may_hold(texts_wanted, batch.column(0).to_numpy())))
            for keys, held in _new_texts(wanted_here):
                for piece in pieces(held, length):
                    yield from compared(piece, keys, blocks_wanted)

    return texts.mapInArrow(run, START)


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of starts sorted by print, the runs (text_key, low, n) of those that have an equal neighbour."""
    held = None
    equal_before = False

    def out(key: np.ndarray, low: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(low), pa.array(n)], ["text_key", "low", "n"])

    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(4)]
        done = columns[3] < 0
        if done.any():
            yield out(columns[1][done], columns[2][done], -columns[3][done])
            columns = [c[~done] for c in columns]
        if held is not None:
            columns = [np.concatenate([[h], c]) for h, c in zip(held, columns)]
        if not len(columns[0]):
            continue
        equal = columns[0][1:] == columns[0][:-1]
        repeated = np.zeros(len(columns[0]), dtype=bool)
        repeated[1:] |= equal
        repeated[:-1] |= equal
        repeated[0] |= equal_before and held is not None
        # The last row waits for its next neighbour.
        equal_before = bool(repeated[-1])
        held = [int(c[-1]) for c in columns]
        take = repeated[:-1] & (columns[3][:-1] == 1)
        if take.any():
            yield out(columns[1][:-1][take], columns[2][:-1][take], columns[3][:-1][take])
    if held is not None and equal_before and held[3] == 1:
        yield out(*[np.array([h]) for h in held[1:]])


def repeated_starts(texts: DataFrame, length: int, skip: DataFrame) -> DataFrame:
    """text_key, low and n: runs of n starts whose strings also start elsewhere. Texts in `skip` may be left out."""
    names = materialise(sample_blocks(texts, length), "sample-names")
    grams = names.groupBy(F.col("gram").alias("g")).agg(
        F.count(F.lit(1)).alias("times"), F.min("block").alias("least"), F.max("block").alias("most")
    )
    # Written first, so that the join below can split a gram that many texts have.
    grams = materialise(grams.where("times > 1").select("g", (F.col("least") != F.col("most")).alias("open")), "grams")
    named = materialise(names.join(grams, F.col("gram") == F.col("g")).drop("g"), "repeated-names")
    by_block = named.groupBy("gram", "block").agg(
        F.count(F.lit(1)).alias("times"), F.max("open").alias("open"), F.min(F.struct("text_key", "low")).alias("one")
    )
    by_block = materialise(by_block, "block-names")
    settled = named.join(by_block.where("times > 1").select("gram", "block"), ["gram", "block"], "left_semi")
    settled = settled.select("text_key", "low", "n").join(skip, "text_key", "left_anti")
    wanted = by_block.where("open").select("one.text_key", "one.low")
    starts = start_rows(texts, wanted, length).repartition("print").sortWithinPartitions("print")
    merged = starts.mapInArrow(_compare_neighbours, "text_key long, low long, n long")
    return settled.unionByName(merged.join(skip, "text_key", "left_anti"))


def text_spans(starts: DataFrame, length: int) -> DataFrame:
    """text_key, n_removed, n_spans, begins and ends: the maximal removed runs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, begins, ends = None, [], []

        def out() -> tuple:
            return key, sum(ends) - sum(begins), len(begins), begins, ends

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
            names = ["text_key", "n_removed", "n_spans", "begins", "ends"]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            rows = []
            for k, low, n in zip(*[batch.column(c).to_pylist() for c in range(3)]):
                if k != key:
                    if key is not None:
                        rows.append(out())
                    key, begins, ends = k, [], []
                high = low + n - 1 + length
                if ends and low <= ends[-1]:
                    ends[-1] = max(ends[-1], high)
                else:
                    begins.append(low)
                    ends.append(high)
            if rows:
                yield batch_of(rows)
        if key is not None:
            yield batch_of([out()])

    placed = starts.repartition("text_key").sortWithinPartitions("text_key", "low")
    return placed.mapInArrow(run, "text_key long, n_removed long, n_spans long, begins array<long>, ends array<long>")


def kept_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """text_key and kept (bytes) for the texts that have spans. A bitmap keeps the others out of the shuffle."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmap.build(spans, F.col("text_key")))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitmap.may_hold(shared.value, batch.column(0).to_numpy())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, begins, ends in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)]):
                kept.append(b"".join(text[a:b] for a, b in zip([0, *ends], [*begins, len(text)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], ["text_key", "kept"])

    chosen = texts.mapInArrow(choose, texts.schema)
    joined = chosen.join(spans, "text_key").select("text_key", "text", "begins", "ends")
    return joined.mapInArrow(cut, "text_key long, kept binary")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and text_key of each document."""
    texts = _texts(docs, text)
    whole = F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole).alias("text_key"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        F.sha2(whole, 256).alias("sha"),
    )
    rows = materialise(rows, "text-digests")
    copied = rows.where(F.col("n_bytes") >= length).groupBy("text_key").count().where("count > 1").select("text_key")
    copied = materialise(copied, "copied-texts")
    spans = materialise(text_spans(repeated_starts(texts, length, copied), length), "text-spans")
    kept = kept_texts(texts, spans).select("text_key", F.sha2("kept", 256).alias("kept_sha")).dropDuplicates(["text_key"])
    changed = spans.select("text_key", "n_removed", "n_spans").join(kept, "text_key")
    joined = rows.join(changed, "text_key", "left").join(copied.withColumn("copied", F.lit(True)), "text_key", "left")
    gone = F.coalesce("copied", F.lit(False))
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        "text_key",
    )
