"""Personal data in whole texts: fixed patterns, and a character tagger for the forms that they miss.

The patterns find email, ip, card and phone spans. The tagger is a BiLSTM with CRF transitions. Its labelled spans are
what the patterns find in a bounded sample of documents, each also rewritten in disguised forms (`a (at) b (dot) c`,
spaced or bracketed dots, dotted or slashed digit groups), and stretches of digits that are no personal data.

A text is tagged where a span may be: within REACH characters of a digit, an @ or a bracketed `at`. Windows of WINDOW
characters that overlap by half cover these stretches. Every window is decoded; for each character, the window
in which it lies farthest from an edge decides, over the whole text, and runs of labels become spans, which are
snapped to whole words and numbers. A span counts if it holds what its kind needs (`plausible`) and touches no span of
a pattern.

Defined results: a null or empty text has no spans; without any pattern span in the sample there is no tagger and only
the patterns count; rows are read one by one, so null or repeated ids do not matter. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.char_tagger import Tagger, encode
from cartwright.llm.sampling import hash_sample

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 10_000
#: Labelled windows that are collected for training, per kind and without a span.
SAMPLE_WINDOWS = 300
WINDOW, STEP, REACH = 64, 32, 24
#: Disguised windows per kind.
VARIANTS = 160
MOST_DIGITS = {"card": (14, 19), "phone": (10, 15)}

# Possessive quantifiers and the look-behind give the same leftmost matches in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[{<]\s?at\s?[)\]}>]", re.IGNORECASE)
_AT = re.compile(r"\s?[(\[{<]\s?at\s?[)\]}>]\s?|\s?@\s?", re.IGNORECASE)
_DOT = re.compile(r"\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\s?\.\s?", re.IGNORECASE)
_NUMBER = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_NUMBER.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Only the surroundings of an @ are looked at: the run of local characters before it and the domain behind."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        else:
            # A local part may not reach back over this @, which is no local character.
            end = max(end, at + 1)
        at = text.find("@", max(end, at + 1))


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, in order of start and then of KINDS."""
    found = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        # Without leading zeros, as the whole run may be longer than a number that can be read.
        parts = [part.lstrip("0") for part in m.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append(("ip", *m.span()))
    for kind, pattern in (("card", _CARD), ("phone", _PHONE)):
        least, most = MOST_DIGITS[kind]
        for m in pattern.finditer(text):
            if m.end() - m.start() >= least:
                digits = _digits(m.group())
                if least <= len(digits) <= most and (kind == "phone" or luhn(digits)):
                    found.append((kind, *m.span()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def plausible(kind: str, text: str) -> bool:
    """Whether a tagged piece holds what its kind needs."""
    if kind == "email":
        parts = _AT.split(text)
        labels = _DOT.split(parts[-1])
        return len(parts) == 2 and bool(parts[0]) and len(labels) > 1 and all(re.fullmatch(r"[A-Za-z0-9-]+", x) for x in labels)
    numbers = _NUMBER.findall(text)
    if kind == "ip":
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    digits = "".join(numbers)
    least, most = MOST_DIGITS[kind]
    if re.search(r"[A-Za-z]", text) or not least <= len(digits) <= most:
        return False
    return luhn(digits) if kind == "card" else text.lstrip("( ").startswith(("+", "00"))


# Labelled windows.


def disguise(kind: str, text: str, draw: np.random.Generator) -> str:
    """A written form of the piece that the patterns miss."""
    left, right = ("(", ")") if draw.random() < 0.5 else ("[", "]")
    gap = " " if draw.random() < 0.7 else ""
    if kind == "email":
        text = text.replace("@", f"{gap}{left}at{right}{gap}") if draw.random() < 0.7 else text.replace("@", " @ ")
        name, mark, domain = re.split(r"(\s?[(\[]at[)\]]\s?| @ )", text, maxsplit=1)
        return name + mark + (domain.replace(".", f"{gap}{left}dot{right}{gap}") if draw.random() < 0.6 else domain)
    if kind == "ip":
        return text.replace(".", f"{left}.{right}" if draw.random() < 0.5 else " . ")
    digits = _digits(text)
    mark = str(draw.choice([".", "/", "  "]))
    if kind == "card":
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    return f"+{gap}{digits[0]}/{digits[1:4]}/{digits[4:]}" if draw.random() < 0.5 else f"00{digits[0]} {digits[1:4]} {digits[4:]}"


def _samples(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(kind, surrounding text, start, end) of each span; kind "" for a trigger that is in no span."""
    spans = pattern_spans(text)
    for kind, start, end in spans:
        if end - start < WINDOW - 8:
            first = max(0, start - (WINDOW - end + start) // 2)
            piece = text[first : first + WINDOW]
            if not any(s < first + WINDOW and e > first and (s, e) != (start, end) for _, s, e in spans):
                yield kind, piece, start - first, end - first
    for n, m in enumerate(_TRIGGER.finditer(text)):
        first = max(0, m.start() - WINDOW // 2)
        if n % 16 == 0 and not any(s < first + WINDOW and e > first for _, s, e in spans):
            yield "", text[first : first + WINDOW], 0, 0


def labelled_windows(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[tuple[str, str, int, int]]:
    """At most SAMPLE_WINDOWS windows per kind and as many without a span, from about `sample_docs` documents."""
    sample = hash_sample(docs.select(F.col("text").cast("binary").alias("text")).where("text IS NOT NULL"), sample_docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for t in batch.column(0).to_pylist() for r in _samples(t.decode("utf-8", "replace"))]
            columns = zip(*rows) if rows else [[]] * 4
            types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["kind", "piece", "s", "e"])

    found = sample.mapInArrow(run, "kind string, piece string, s long, e long").dropDuplicates()
    chosen = Window.partitionBy("kind").orderBy(F.xxhash64("piece", "s"), "piece", "s", "e")
    rows = found.withColumn("nth", F.row_number().over(chosen)).where(F.col("nth") <= SAMPLE_WINDOWS).drop("nth").collect()
    return sorted((r["kind"], r["piece"], r["s"], r["e"]) for r in rows)


def vary(text: str, draw: np.random.Generator) -> str:
    """The piece with other digits and other letters in the same places."""
    return "".join(
        str(draw.integers(10)) if "0" <= c <= "9" else chr(97 + draw.integers(26)) if "a" <= c <= "z" and draw.random() < 0.5 else c
        for c in text
    )


def fit(windows: list[tuple[str, str, int, int]], epochs: int | None = None) -> Tagger | None:
    """A tagger trained on the windows as they are and with each span varied and disguised; None without any span.

    A kind with few spans gets more variants of each, so that all kinds have about VARIANTS windows.
    """
    counts = {kind: sum(w[0] == kind for w in windows) for kind in KINDS}
    if not any(counts.values()):
        return None
    draw = np.random.default_rng(11)
    codes, labels = [], []

    def add(kind: str, before: str, piece: str, after: str) -> None:
        before = before[max(0, len(before) - int(draw.integers(0, 40))) :]
        label = np.zeros(WINDOW, dtype=np.int64)
        if kind:
            begin, end = len(before), min(WINDOW, len(before) + len(piece))
            if begin < WINDOW:
                label[begin:end] = 2 + 2 * KINDS.index(kind)
                label[begin] -= 1
        codes.append(encode(before + piece + after, WINDOW))
        labels.append(label)

    for kind, text, start, end in windows:
        before, piece, after = text[:start], text[start:end], text[end:]
        add(kind, before, piece, after)
        for _ in range(-(-VARIANTS // counts[kind]) if kind else 0):
            add(kind, before, disguise(kind, vary(piece, draw), draw), after)
    tagger = Tagger.fresh(1 + 2 * len(KINDS))
    tagger.train(np.array(codes), np.array(labels), **({"epochs": epochs} if epochs else {}))
    return tagger


# Decoding.


def window_starts(text: str) -> list[int]:
    """Starts of the windows that cover every stretch in which a span may be."""
    stretches: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        low, high = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if stretches and low <= stretches[-1][1]:
            stretches[-1][1] = high
        else:
            stretches.append([low, high])
    return [at for low, high in stretches for at in range(low, max(low + 1, high - STEP), STEP)]


def _runs(labels: dict[int, int]) -> Iterator[tuple[str, int, int]]:
    """Spans from reconciled labels by position."""
    kind, start, last = -1, 0, -2
    for place in sorted(labels):
        label = labels[place]
        own = (label - 1) // 2 if label else -1
        if kind >= 0 and (place != last + 1 or own != kind or label % 2 == 1):
            yield KINDS[kind], start, last + 1
            kind = -1
        if own >= 0 and kind < 0:
            kind, start = own, place
        last = place
    if kind >= 0:
        yield KINDS[kind], start, last + 1


def tagged_spans(texts: list[str], tagger: Tagger, most_windows: int = 1024) -> list[list[tuple[str, int, int]]]:
    """The plausible spans that the tagger finds in each text."""
    places = [(k, at) for k, text in enumerate(texts) for at in window_starts(text)]
    result: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    central = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    votes: dict[int, dict[int, tuple[int, int]]] = {}
    for begin in range(0, len(places), most_windows):
        part = places[begin : begin + most_windows]
        paths = tagger.decode(np.stack([encode(texts[k][at : at + WINDOW], WINDOW) for k, at in part]))
        for (k, at), path in zip(part, paths):
            mine = votes.setdefault(k, {})
            for i in range(min(WINDOW, len(texts[k]) - at)):
                if central[i] > mine.get(at + i, (-1, 0))[0]:
                    mine[at + i] = (int(central[i]), int(path[i]))
    for k, mine in votes.items():
        for kind, start, end in _runs({place: label for place, (_, label) in mine.items()}):
            start, end = snap(texts[k], start, end)
            # The tagger says where; what it is must also hold what that kind needs. A run may be several pieces.
            parts = [m.span() for m in re.finditer(r"\S+", texts[k][start:end])]
            for low, high in [(start, end), *[(start + a, start + b) for a, b in parts if len(parts) > 1]]:
                kinds = [x for x in (kind, *KINDS) if plausible(x, texts[k][low:high])]
                if kinds and not (result[k] and low < result[k][-1][2]):
                    result[k].append((kinds[0], low, high))
    return result


def snap(text: str, start: int, end: int) -> tuple[int, int]:
    """The run without blanks at its ends, and with the rest of a number or word that it cuts."""
    while start < end and text[start].isspace():
        start += 1
    while end > start and text[end - 1].isspace():
        end -= 1
    if start < end:
        while start and text[start - 1].isalnum() and text[start].isalnum():
            start -= 1
        while end < len(text) and text[end].isalnum() and text[end - 1].isalnum():
            end += 1
        if text[end - 1] in ".-/( " and end < len(text) and text[end].isdigit():
            end += 1
        while end < len(text) and text[end].isdigit() and text[end - 1].isdigit():
            end += 1
    if start and text[start - 1] == "+":
        start -= 1
    return start, end


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find(docs: DataFrame, tagger: Tagger | None, text: str, *keep: str) -> DataFrame:
    """The columns `keep`, pattern spans per kind, base_sha256 of the pattern spans, all spans, and n_tagged."""
    names = [f"n_{kind}" for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(batch.num_columns - 1).to_pylist()]
            base = [pattern_spans(t) for t in texts]
            # A text whose triggers all lie in pattern spans needs no tagger.
            open_texts = [_blank(t, spans) for t, spans in zip(texts, base)] if tagger else []
            more = tagged_spans(open_texts, tagger) if tagger else [[] for _ in texts]
            spans = [sorted([*b, *m], key=lambda x: (x[1], KINDS.index(x[0]))) for b, m in zip(base, more)]
            columns = [pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64()) for kind in KINDS]
            digests = pa.array([hashlib.sha256(spell(b).encode()).hexdigest() for b in base], pa.string())
            columns += [digests, pa.array([spell(s) for s in spans], pa.string()), pa.array([len(m) for m in more], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *names, "base_sha256", "spans", "n_tagged"]
            )

    source = docs.select(*keep, F.col(text).cast("binary").alias("searched_text"))
    schema = source.drop("searched_text").schema
    for name in names:
        schema = schema.add(name, "long")
    return source.mapInArrow(run, schema.add("base_sha256", "string").add("spans", "string").add("n_tagged", "long"))


def _blank(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with its pattern spans replaced by spaces, so that the tagger looks at the rest."""
    pieces, at = [], 0
    for _, start, end in spans:
        if end > at:
            pieces += [text[at:start], " " * (end - max(at, start))]
            at = end
    return "".join([*pieces, text[at:]])


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and the findings for each document. The n_<kind> columns count pattern spans, n_tagged the others."""
    return find(docs, fit(labelled_windows(docs)), "text", "doc_id")
