"""Near copies by MinHash, ranked search and periodic runs against brute force, on whole small tables and on odd rows."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwright.llm import jaccard_join, lexical_search, minhash_dedup, queries, run_detection
from cartwright.llm.text_blocks import mix64

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, band long, component long, runs string, block long, centre long"
PROSE = "the quick brown fox jumps over a lazy dog near the old mill while rain falls on every roof of our town"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.orderBy("doc_id").collect()]


#: Nulls, empty and long texts, ties, repeated rows and ids, texts of few words.
AWKWARD = [
    (1, PROSE),
    (1, PROSE),
    (2, PROSE + " again"),
    (2, None),
    (3, ""),
    (None, PROSE.upper()),
    (None, None),
    (4, " \n\t "),
    (5, " ".join(f"{w}{n}" for n in range(400) for w in PROSE.split()) + "\n" + PROSE),
    (6, "x"),
    (7, "X"),
    (8, "a b"),
    (9, "\U0001f600 été   ok"),
    (10, "na " * 5000),
    (11, ("one two three " * 30 + "stop ") * 4),
]


def awkward(spark):
    return spark.createDataFrame([(i, t, 1, 2, "r", 3, 4) for i, t in AWKWARD], SCHEMA)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def component_rows(rows):
    """(doc_id, n_shingles, component_id, kept) by brute force."""
    label = brute.near_copies([t for _, t in rows], 3, 85)
    sets = brute.shingle_sets([t for _, t in rows], 3)
    ids = {}
    for (doc_id, _), l in zip(rows, label):
        if doc_id is not None:
            ids[l] = min(doc_id, ids.get(l, doc_id))
    component = [ids.get(l) if s else d for (d, _), l, s in zip(rows, label, sets)]
    return sorted(((d, len(s), c, d == c) for (d, _), s, c in zip(rows, sets, component)), key=str)


def test_near_copies_equal_brute_force(spark, texts):
    assert as_rows(queries.op11_minhash_dedup(spark, SMALL)) == component_rows(texts)


def test_near_copies_of_odd_rows(spark):
    assert as_rows(minhash_dedup.dedup_documents(awkward(spark))) == component_rows(AWKWARD)


def edited(rng, words, changes):
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**9)}"
    return " ".join(out)


def around_the_limit():
    """Copies with few and many changes, of short and long texts: chains, pairs just above and just below the limit."""
    rng, rows = random.Random(5), []
    for size in (8, 12, 30, 80, 200):
        base = [f"b{size}x{rng.randrange(10**6)}" for _ in range(size)]
        for changes in (0, 0, 1, 1, 1, 2, 2, 3, 4, 5, size // 20, size // 15, size // 10):
            rows.append((len(rows), edited(rng, base, changes)))
    return rows


@pytest.mark.parametrize("block", [minhash_dedup.BLOCK, 300])
def test_groups_around_the_limit(spark, block):
    rows = around_the_limit()
    got = as_rows(minhash_dedup.dedup_documents(spark.createDataFrame(rows, "doc_id long, text string"), block=block))
    assert got == component_rows(rows)
    assert 10 < len({r[2] for r in got}) < len(rows)


@pytest.mark.parametrize("block", [jaccard_join.BLOCK, 3])
def test_groups_around_the_limit_by_tree(spark, block):
    rows = around_the_limit()
    joined = jaccard_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string"), block=block)
    label = brute.near_copies([t for _, t in rows], jaccard_join.SHINGLE, jaccard_join.PERCENT)
    first = {l: min(d for (d, _), x in zip(rows, label) if x == l) for l in label}
    assert as_rows(joined.select("doc_id", "component_id")) == sorted(((d, first[l]) for (d, _), l in zip(rows, label)), key=str)


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "fox")], "item_id long, text string")
    assert minhash_dedup.dedup_documents(empty).isEmpty()
    assert lexical_search.search(empty, items).isEmpty()
    assert run_detection.detect_runs(empty, "doc_id").isEmpty()


def test_estimate_is_corrected_and_close():
    rng = np.random.default_rng(3)
    for shared, own in ((2000, 100), (500, 500), (0, 3000)):
        common = rng.integers(0, 1 << 63, shared, dtype=np.uint64) * 2
        sets = [np.unique(mix64(np.concatenate([common, rng.integers(0, 1 << 63, own, dtype=np.uint64)]))) for _ in "ab"]
        a, b = (minhash_dedup.registers(s) for s in sets)
        n = np.array([len(s) for s in sets])
        c = minhash_dedup.chance(n[:1], n[1:])[0]
        estimate = ((a == b).sum() / ((a > 0) | (b > 0)).sum() - c) / (1 - c)
        assert abs(estimate - shared / (shared + 2 * own)) < 0.12
        assert 0 < c < 0.001


def test_search_equals_brute_force(spark, texts):
    items = [tuple(r) for r in queries.benchmark(spark, SMALL).select("item_id", "text").collect()]
    assert as_rows(queries.op12_lexical_search(spark, SMALL)) == sorted(brute.best_matches(texts, items), key=str)


ITEMS = [(1, PROSE), (1, PROSE), (2, "na"), (3, None), (4, ""), (5, "unknown words only"), (6, "fox fox été X one two TWO")]


@pytest.mark.parametrize("best", [1, 3, 20])
def test_search_of_odd_rows(spark, best):
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")
    found = lexical_search.search(awkward(spark), items, k=best)
    assert as_rows(found) == sorted(brute.best_matches(AWKWARD, ITEMS, best), key=str)


def test_search_in_small_blocks(spark, texts, monkeypatch):
    """Blocks of few documents and items, with a seed of some of them: pruning drops nothing."""
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 3000)
    items = queries.benchmark(spark, SMALL)
    rows = [tuple(r) for r in items.select("item_id", "text").collect()]
    docs = queries.documents(spark, SMALL).repartition(4)
    assert as_rows(lexical_search.search(docs, items)) == sorted(brute.best_matches(texts, rows), key=str)


def test_pairs_lower_the_bound():
    """Terms that reach their maxima in different documents are bound by what they reach together."""
    best, times = np.array([100, 90, 80]), np.array([1, 1, 2])
    assert lexical_search.bounds(best, times, [190, 170])[0] == 350
    assert lexical_search.bounds(best, times, [110, 0])[0] == 110 + 160
    assert lexical_search.bounds(best, times, [110, 0])[1] == 90 + 80


def test_runs_equal_brute_force(spark, texts):
    got = as_rows(queries.op13_run_detection(spark, SMALL))
    assert got == sorted(((d, *brute.run_row(d, t)) for d, t in texts), key=str)
    assert sum(r[1] > 0 for r in got) > 5


def test_runs_of_odd_rows(spark):
    found = run_detection.detect_runs(awkward(spark), "doc_id", "text").collect()
    for row in found:
        assert [tuple(r) for r in row["runs"]] == brute.word_runs(brute.words(row["text"]))
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[10]["collapsed"] == "na" and by_id[11]["collapsed"] == "one two three stop"
    assert {len(r["runs"]) for r in found if not brute.words(r["text"])} == {0}


def some_words(rng):
    kind, n = rng.randrange(5), rng.randrange(180)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        base = [rng.randrange(4) for _ in range(rng.randrange(1, 20))]
        middle = [base[i % len(base)] for i in range(rng.randrange(120))]
        edge = [rng.randrange(50) for _ in range(rng.randrange(30))]
        return (edge + middle + edge[::-1]) * rng.randrange(1, 4)
    if kind == 2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 3:
        return ([7] * rng.randrange(60) + [8] * rng.randrange(60) + [7] * rng.randrange(60)) * rng.randrange(1, 4)
    lines = [[1, 2, 3, 4, 5, 6], [1, 2, 1, 2], [9], [3, 4, 3]]
    return [w for _ in range(n // 12) for w in rng.choice(lines) * rng.randrange(1, 12)]


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_repetitive_sequences(seed):
    rng = random.Random(seed)
    many = [some_words(rng) for _ in range(12)]
    ends = np.cumsum([len(w) for w in many])
    flat = mix64(np.array([1000 * k + x for k, w in enumerate(many) for x in w], dtype=np.uint64))
    begin, end, period = run_detection.runs_of(flat, ends)
    starts = np.concatenate([[0], ends])
    got = [[] for _ in many]
    for b, e, q in zip(begin.tolist(), end.tolist(), period.tolist()):
        k = int(np.searchsorted(ends, b, side="right"))
        got[k].append((b - int(starts[k]), e - b, q))
    assert got == [brute.word_runs(w) for w in many]
