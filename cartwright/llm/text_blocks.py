"""Word, n-gram and byte statistics of whole texts in numpy, for use inside Arrow tasks.

Texts come as bytes. A word is a run of bytes other than space and 0x09-0x0D, so no decoding is needed. The
functions work on blocks of several texts; `blocks` keeps the memory of a task near `BLOCK_BYTES` times a small
factor, and a text longer than that is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

BLOCK_BYTES = 2 << 20
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the whole value."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _multipliers(n: int, seed: int) -> np.ndarray:
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(steps + np.uint64(seed)) | np.uint64(1)


def multipliers(n: int, seed: int = 0) -> np.ndarray:
    """At least `n` fixed odd 64-bit values; the same prefix for every `n`."""
    return _multipliers(1 << max(6, (n - 1).bit_length()), seed)


def blocks(texts: list[bytes | None], most: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about `most` bytes together, with the index of the first; null reads as empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > most:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


class Block:
    """The bytes of some texts, one after the other with a line break behind each, and where their words are.

    A word is a run of bytes that are no `separators`, a flag per byte; a line break must be one.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, separators: np.ndarray = IS_SPACE):
        joined = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            self.bytes = TO_LOWER[self.bytes]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        #: Text k lies at [starts[k], starts[k + 1] - 1).
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        space = separators[self.bytes]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        self.space = space
        self.word_starts, self.word_ends = edge[0::2], edge[1::2]
        if len(self.word_ends) < len(self.word_starts):
            self.word_ends = np.append(self.word_ends, len(space))
        #: Words of text k are [first_word[k], first_word[k + 1]).
        self.first_word = np.searchsorted(self.word_starts, self.starts)
        self.n_words = np.diff(self.first_word)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text have the flag."""
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_words)), self.n_words)

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: the sum of byte times a fixed random factor of its place, mixed."""
        if not len(self.word_starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.word_ends - self.word_starts
        kept = self.bytes[~self.space].astype(np.uint64) + np.uint64(1)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        place = np.arange(len(kept), dtype=np.int64) - np.repeat(begin, lengths)
        kept *= multipliers(int(lengths.max()))[place]
        return mix64(np.add.reduceat(kept, begin) + lengths.astype(np.uint64))

    def grams(self, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first word of every run of `size` words within a text.

        With `short`, a text of 1 to `size` - 1 words gives its whole sequence as one run, of another hash.
        """
        words = self.word_hashes()
        text = self.text_of_word()
        left = self.first_word[1:][text] - np.arange(len(words))
        first = np.flatnonzero(left >= size)
        factors = multipliers(size, seed=size)
        total = np.zeros(len(first), dtype=np.uint64)
        for k in range(size):
            total += words[first + k] * factors[k]
        hashes, texts = mix64(total), text[first]
        if short:
            few = np.flatnonzero((self.n_words > 0) & (self.n_words < size))
            begin = self.first_word[:-1][few]
            sums = np.zeros(len(few), dtype=np.uint64)
            for k in range(size - 1):
                there = self.n_words[few] > k
                sums[there] += words[begin[there] + k] * multipliers(size, seed=99)[k]
            whole = mix64(sums + self.n_words[few].astype(np.uint64))
            hashes, texts, first = np.append(hashes, whole), np.append(texts, few), np.append(first, begin)
            order = np.argsort(texts, kind="stable")
            hashes, texts, first = hashes[order], texts[order], first[order]
        return hashes, texts, first
