"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of words with smallest period q (words q apart are identical) of at least max(LEAST_WORDS, PERIODS * q)
words that no neighbouring word extends.

1. Re-Pair: the pair of neighbouring symbols with the most occurrences in a text gets a name, until no pair occurs twice.
   A round replaces all pairs that beat both neighbours at once (more occurrences, then the larger name), so that many
   texts are compressed in a few array operations.
2. Each nonterminal has one boundary, between its two parts; the symbols that are left have one between neighbours. A
   run lies across the boundary of the lowest node of the derivation that holds it. So the runs across each boundary
   are computed once for a nonterminal, within its expansion, however often it occurs.
3. At least half of a run lies on one side of the boundary, so a gram next to the boundary comes again one period away.
   Grams of 4, 8, 16 ... words propose the periods, ever longer ones for longer periods; equal words are then extended
   to both sides. A multiple of a period that was found goes.
4. What was found is translated to all places of the nonterminal; places of one period that overlap are merged.

Defined results: a null or empty text and one without words has no runs and collapses to the empty string; repeated rows
and ids are kept as they are; an empty table gives an empty result; other columns are carried along unread. Work is
done text by text in Arrow tasks without a shuffle; blocks of texts bound the memory, and a longer text is a block of its own.
Words are compared as 64-bit hashes with the text mixed in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.text_blocks import Block, blocks, mix64

LEAST_WORDS, PERIODS = 24, 3
#: Words of the shortest gram. Half of a run is longer than its period by that many words at least, up to period 8.
GRAM = 4
#: Candidate periods that are compared at a time, and words compared at once.
CHUNK, STRIDE = 1 << 14, 32

RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))

_U = np.uint64
_LEFT, _RIGHT = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def _pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix64(left * _LEFT + mix64(right + _RIGHT))


def _counts(values: np.ndarray) -> np.ndarray:
    """How often each value occurs, value by value."""
    order = np.argsort(values)
    edge = np.flatnonzero(np.concatenate([[True], values[order][1:] != values[order][:-1], [True]]))
    size = np.diff(edge)
    counts = np.empty(len(values), dtype=np.int64)
    counts[order] = np.repeat(size, size)
    return counts


def compress(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Re-Pair over texts that lie one after the other; text k ends at ends[k] and shares no symbol with others.

    Returns name, start, boundary and end of every place of a nonterminal, and the places between symbols that are left.
    """
    start = np.arange(len(symbols))
    text = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    places: list[tuple[np.ndarray, ...]] = []
    left_over = []
    while len(symbols) > 1:
        inside = text[1:] == text[:-1]
        names = _pair_names(symbols[:-1], symbols[1:])
        # Of the overlapping pairs in a stretch of one symbol every other one counts.
        again = np.concatenate([[False], (names[1:] == names[:-1]) & inside[1:] & inside[:-1]])
        at = np.arange(len(names))
        odd = (at - np.maximum.accumulate(np.where(again, 0, at))) % 2 == 1
        able = np.flatnonzero(inside & ~odd)
        count = np.zeros(len(names) + 2, dtype=np.int64)
        count[able + 1] = _counts(names[able])
        count[count == 1] = 0
        active = count[1:-1] > 0
        busy = np.zeros(len(ends), dtype=bool)
        busy[text[:-1][active]] = True
        kept = busy[text]
        if not kept.all():
            # These texts are done: no pair occurs twice.
            done = np.flatnonzero(~kept)
            done = done[done > 0]
            left_over.append(start[done[text[done] == text[done - 1]]])
            symbols, start, text = symbols[kept], start[kept], text[kept]
            continue
        padded = np.concatenate([[_U(0)], names, [_U(0)]])
        beats = lambda other: (count[1:-1] > count[other]) | ((count[1:-1] == count[other]) & (names >= padded[other]))
        chosen = np.flatnonzero(active & beats(slice(0, -2)) & beats(slice(2, None)))
        chosen = chosen[_counts(names[chosen]) > 1]
        stop = np.concatenate([start[1:], [ends[text[-1]]]])
        stop = np.where(np.concatenate([inside, [False]]), stop, ends[text])
        places.append((names[chosen], start[chosen], start[chosen + 1], stop[chosen + 1]))
        symbols = symbols.copy()
        symbols[chosen] = names[chosen]
        stays = np.ones(len(symbols), dtype=bool)
        stays[chosen + 1] = False
        symbols, start, text = symbols[stays], start[stays], text[stays]
    empty = np.zeros(0, dtype=np.int64)
    joined = [np.concatenate(part) for part in zip(*places)] if places else [np.zeros(0, dtype=_U), empty, empty, empty]
    return *joined, np.concatenate(left_over) if left_over else empty


def _extend(words: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from places a and b on, in direction `step`, are the same; at most `room`."""
    out = np.zeros(len(a), dtype=np.int64)
    active = np.flatnonzero(room > 0)
    offsets = np.arange(STRIDE)
    last = len(words) - 1
    while len(active):
        at = out[active][:, None] + offsets
        inside = at < room[active][:, None]
        x, y = a[active][:, None] + step * at, b[active][:, None] + step * at
        same = inside & (words[np.clip(x, 0, last)] == words[np.clip(y, 0, last)])
        full = same.all(axis=1)
        out[active] += np.where(full, STRIDE, np.argmin(same, axis=1))
        active = active[full]
    return out


def _spans(words: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, lag: np.ndarray, most: int | None = None):
    """Start and end of the stretch around the word pair (at - 1, at), (at + lag) of words that are equal `lag` apart."""
    ahead, behind = high - at - lag, at - low
    if most:
        ahead, behind = np.minimum(ahead, most), np.minimum(behind, most)
    return at - _extend(words, at - 1, at + lag - 1, behind, -1), at + lag + _extend(words, at, at + lag, ahead, 1)


def _candidates(words: np.ndarray, ends: np.ndarray, low: np.ndarray, at: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """side (twice the index of the boundary, and 1 on the left), place and lag: words from `place` on may equal those `lag` later."""
    found: list[tuple[np.ndarray, ...]] = []
    size, names = GRAM, words
    for width in (1, 2):
        names = np.append(_pair_names(names[:-width], names[width:]), names[-width:])
    text_end = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    places = np.flatnonzero(np.arange(len(words)) + size <= text_end)
    most = (high - low) // PERIODS
    while len(places):
        again = _counts(names[places]) > 1
        places = places[again]
        if not len(places):
            break
        order = np.lexsort((places, names[places]))
        places_by_name = places[order]
        rank = np.cumsum(np.concatenate([[0], names[places_by_name][1:] != names[places_by_name][:-1]]))
        # Sorted by gram, then by place; `key` finds the places of a gram within a stretch.
        key = rank * (len(words) + 1) + places_by_name
        rank_of = np.full(len(words), -1, dtype=np.int64)
        rank_of[places_by_name] = rank
        least = 1 if size == GRAM else 2 * size
        largest = 4 * size - 1
        for sign, anchor in ((1, at), (-1, at - size)):
            reach = np.minimum(most, largest)
            inside = (anchor >= low) & (anchor + size <= high) & (reach >= least)
            which = np.flatnonzero(inside)
            which = which[rank_of[anchor[which]] >= 0]
            base, x, far = rank_of[anchor[which]] * (len(words) + 1), anchor[which], reach[which]
            if sign > 0:
                first, last = x + least, np.minimum(x + far, high[which] - size)
            else:
                first, last = np.maximum(x - far, low[which]), x - least
            begin, end = np.searchsorted(key, base + first), np.searchsorted(key, base + last, side="right")
            n = np.maximum(end - begin, 0)
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            other = places_by_name[np.repeat(begin, n) + offset]
            lag = np.abs(other - np.repeat(x, n))
            boundary = np.repeat(which, n)
            # The pair of places whose words are compared: the boundary and a lag later, or a lag earlier and the boundary.
            found.append((2 * boundary + (sign < 0), at[boundary] if sign > 0 else at[boundary] - lag, lag))
        # The next gram is twice as long; both of its halves come again.
        there = np.zeros(len(words) + 1, dtype=bool)
        there[places] = True
        places = places[places + 2 * size <= text_end[places]]
        places = places[there[places + size]]
        longer = names.copy()
        longer[places] = _pair_names(names[places], names[places + size])
        names, size = longer, 2 * size
    empty = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(part) for part in zip(*found)) if found else (empty, empty, empty)


def _long_enough(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    return end - begin >= np.maximum(LEAST_WORDS, PERIODS * period)


def boundary_runs(words: np.ndarray, ends: np.ndarray, low: np.ndarray, at: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """boundary (its index), start, end and smallest period of the runs at each boundary `at` within [low, high)."""
    side, place, lag = _candidates(words, ends, low, at, high)
    order = np.lexsort((lag, side))
    side, place, lag = side[order], place[order], lag[order]
    found: list[tuple[np.ndarray, ...]] = []
    most = 2 * STRIDE
    while len(lag):
        # Ever more words decide which of the many candidates can still be runs.
        if most:
            good = np.zeros(len(lag), dtype=bool)
            for k in range(0, len(lag), CHUNK):
                part = slice(k, k + CHUNK)
                b, p, q = side[part] // 2, place[part], lag[part]
                begin, end = _spans(words, low[b], high[b], p, q, most)
                good[part] = _long_enough(begin, end, q) | (p - begin == most) | (end - p - q == most)
            side, place, lag = side[good], place[good], lag[good]
            most = None if most > 2 * lag.max(initial=0) else 4 * most
        # The shortest open period on each side of a boundary is extended to its end.
        first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]])[: len(side)])
        b, q = side[first] // 2, lag[first]
        begin, end = _spans(words, low[b], high[b], place[first], q)
        good = _long_enough(begin, end, q)
        found.append((b[good], begin[good], end[good], q[good]))
        # Multiples of it that compare words of the same stretch have no stretch of their own.
        size = np.diff(np.append(first, len(lag)))
        within = (np.repeat(begin, size) <= place) & (place + lag <= np.repeat(np.where(good, end, 0), size))
        rest = ~((lag % np.repeat(q, size) == 0) & within)
        rest[first] = False
        side, place, lag = side[rest], place[rest], lag[rest]
    empty = np.zeros(0, dtype=np.int64)
    b, begin, end, q = (np.concatenate(part) for part in zip(*found)) if found else (empty,) * 4
    # One stretch has one smallest period.
    order = np.lexsort((q, end, begin, b))
    b, begin, end, q = b[order], begin[order], end[order], q[order]
    new = np.ones(len(b), dtype=bool)
    new[1:] = (b[1:] != b[:-1]) | (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    return b[new], begin[new], end[new], q[new]


def runs_of(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of texts that lie one after the other, by start, then period."""
    names, start, middle, stop, between = compress(words, ends)
    order = np.argsort(names, kind="stable")
    names, start, middle, stop = names[order], start[order], middle[order], stop[order]
    head = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, dtype=np.int64)
    places = np.diff(np.append(head, len(names)))
    text = np.searchsorted(ends, between, side="right")
    text_start = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    low = np.concatenate([start[head], text_start[text]])
    at = np.concatenate([middle[head], between])
    high = np.concatenate([stop[head], ends[text]])
    b, begin, end, period = boundary_runs(words, ends, low, at, high)
    # A nonterminal's runs move to each of its places; the boundaries between symbols have one place.
    inner = b < len(head)
    n = places[b[inner]]
    index = np.repeat(head[b[inner]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    shift = start[index] - np.repeat(low[b[inner]], n)
    begin = np.concatenate([np.repeat(begin[inner], n) + shift, begin[~inner]])
    end = np.concatenate([np.repeat(end[inner], n) + shift, end[~inner]])
    period = np.concatenate([np.repeat(period[inner], n), period[~inner]])
    # Stretches of one period that share a period's words are parts of one run.
    order = np.lexsort((begin, period))
    begin, end, period = begin[order], end[order], period[order]
    if len(begin):
        base = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) * (len(words) + 1)
        reach = np.maximum.accumulate(end + base) - base
        new = np.ones(len(begin), dtype=bool)
        new[1:] = (period[1:] != period[:-1]) | (begin[1:] > reach[:-1] - period[1:])
        head = np.flatnonzero(new)
        end = np.maximum.reduceat(end, head)
        begin, period = begin[head], period[head]
    order = np.lexsort((period, begin))
    return begin[order], end[order], period[order]


def _collapsed(text: bytes, n_words: int, drops: list[tuple[int, int]]) -> bytes:
    """The words outside the stretches `drops`, joined by one space."""
    words = text.split()
    if drops:
        gone = np.zeros(n_words + 1, dtype=np.int64)
        np.add.at(gone, [s for s, _ in drops], 1)
        np.add.at(gone, [e for _, e in drops], -1)
        words = [w for w, g in zip(words, np.cumsum(gone)) if not g]
    return b" ".join(words)


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        for first, held in blocks(texts):
            block = Block(held)
            ends = block.first_word[1:]
            salt = mix64(block.text_of_word().astype(_U) + _U(1))
            begin, end, period = runs_of(mix64(block.word_hashes() ^ salt), ends)
            text = np.searchsorted(ends, begin, side="right")
            starts = begin - block.first_word[text]
            offsets = np.searchsorted(text, np.arange(len(held) + 1))
            runs = pa.StructArray.from_arrays(
                [pa.array(starts), pa.array(end - begin), pa.array(period)], ["start", "length", "period"]
            )
            collapsed = []
            for k, raw in enumerate(held):
                mine = slice(offsets[k], offsets[k + 1])
                stops = starts[mine] + (end - begin)[mine]
                drops = list(zip((starts + period)[mine].tolist(), stops.tolist()))
                collapsed.append(_collapsed(raw, int(block.n_words[k]), drops))
            part = batch.slice(first, len(held))
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:-1],
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                [*batch.schema.names[:-1], "runs", "collapsed"],
            )


def detect_runs(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns `keep` of `docs`, the runs of each text by start, then period, and the collapsed text.

    The collapsed text keeps the first period of each run; its words are joined by one space.
    """
    source = docs.select(*keep, F.col(text).cast("binary").alias("run_text"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return source.mapInArrow(_detect, schema)
