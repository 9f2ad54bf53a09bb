"""Plain single-process versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

SPACE = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def repeated_bytes(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    data = [(t or "").encode() for t in texts]
    places: dict[bytes, int] = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    result = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if places[d[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        result.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return result


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str | None) -> str:
    """The pattern spans, by the plain patterns."""
    text = text or ""
    found = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
            found.append(("phone", m.span()))
    kinds = ["email", "ip", "card", "phone"]
    found.sort(key=lambda x: (x[1][0], kinds.index(x[0])))
    return ",".join(f"{k}:{s}:{e}" for k, (s, e) in found)


def rule_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text, tokens = text or "", words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(tokens[i : i + 5]) for i in range(len(tokens) - 4))
    covered = {i + k for i in range(len(tokens) - 4) if windows[tuple(tokens[i : i + 5])] > 1 for k in range(5)}
    return len(tokens), sum(map(len, tokens)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def shingles(text: str | None, size: int = 4) -> frozenset:
    tokens = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if 0 < len(tokens) < size:
        return frozenset([tuple(tokens)])
    return frozenset(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))


def jaccard_components(rows: list[tuple[int, str | None]], percent: int = 85, size: int = 4) -> dict[int, tuple[int, int]]:
    """doc_id to (n_shingles, component_id), over all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    ids = sorted(sets)
    for x in ids:
        shared = Counter(y for g in sets[x] for y in holders[g] if y > x)
        for y, n in shared.items():
            if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                a, b = sorted((root(x), root(y)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def similar_lines(rows: list[tuple[int, str | None]], percent: int = 80) -> dict[int, tuple[int, str]]:
    """doc_id to (lines with a word, numbers of removed lines)."""
    lines, result = [], {}
    for i, text in sorted(rows):
        own, gone = 0, []
        for number, line in enumerate((text or "").split("\n")):
            tokens = frozenset(words(line))
            if tokens:
                own += 1
                if any(100 * len(tokens & t) >= percent * len(tokens | t) for t in lines):
                    gone.append(str(number))
                lines.append(tokens)
        result[i] = (own, ",".join(gone))
    return result


def shingle_sets(texts: list[str | None], size: int) -> list[set]:
    """Lower-cased word shingles; a text of fewer words has its whole sequence."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = []
    for text in texts:
        w = words((text or "").translate(lower))
        found.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return found


def near_copies(texts: list[str | None], size: int, percent: int) -> list[int]:
    """A label per text; linked texts have the same one."""
    sets = shingle_sets(texts, size)
    label = list(range(len(texts)))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def word_runs(w: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, trying every period."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def run_row(doc_id: int | None, text: str | None) -> tuple:
    """The row of the run query but for its id."""
    w = words(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = word_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
    kept = sha(" ".join(x for i, x in enumerate(w) if i not in gone))
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, listed, kept)


def best_matches(documents: list[tuple], items: list[tuple], k: int = 20) -> list[tuple]:
    """(item_id, rank, doc_id, score) by scoring every document."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in documents]
    counted = [(doc_id, c) for doc_id, c in counted if c]
    n_docs, n_words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in set(items):
        scores = []
        for doc_id, c in counted:
            m = 75 + (25 * c.total() * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, empty, doc_id) in enumerate(sorted(scores)[:k], 1):
            found.append((item_id, rank, None if empty else doc_id, -score))
    return found
