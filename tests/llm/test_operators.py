"""The operators against brute force, on whole small tables and on rows with nulls, ties, repeats and odd columns."""

import collections
import functools
import math

import brute
import pytest
from pyspark.sql import functions as F

from cartwright.llm import (
    bitmap,
    components,
    decontamination,
    jaccard_join,
    line_dedup,
    mixing,
    oracles,
    queries,
    quality_rules,
    suffix_dedup,
    token_counts,
)
from cartwright.session import materialise, scratch_path

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over a lazy dog near the old mill while rain falls on every roof of our town"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.orderBy("doc_id").collect()]


def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and repeated ids."""
    words = PROSE.split()
    long_text = " ".join(f"{w}{n}" for n in range(400) for w in words) + "\n" + PROSE
    rows = [
        (1, PROSE, "en", "a", 1),
        (1, PROSE, "en", "a", 1),
        (1, PROSE + " again", "en", "a", 1),
        (2, None, "en", "a", 1),
        (3, "", None, None, None),
        (None, PROSE, None, "b", None),
        (None, None, None, None, None),
        (4, " \n\t ", "de", "b", 3),
        (5, long_text, "de", None, 4),
        (6, "x", "en", "a", 1),
        (7, "\U0001f600 été   ok", "fr", "c", 5),
        (8, "a" * 3000, "fr", "c", 5),
        (9, PROSE + "\n" + PROSE + "\n\n" + PROSE.replace("fox", "cat"), "en", "c", 5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(spark):
    """Extra columns with the names that the operators use themselves."""
    names = ["row", "doc", "size", "source_size", "target", "copies", "taken", "kept", "n", "hash", "set_key", "component", "removed", "own", "text_key"]
    return awkward(spark).withColumns({name: F.lit(name) for name in names})


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


# --- suffix dedup


def test_repeated_bytes_equal_brute_force(spark, texts):
    got = {r["doc_id"]: r for r in queries.op1_suffix_dedup(spark, SMALL).collect()}
    expected = brute.repeated_bytes([t for _, t in texts], 400)
    for (doc_id, _), row in zip(texts, expected):
        r = got[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == row


@pytest.mark.parametrize("length", [5, 40])
def test_repeated_bytes_of_awkward_texts(spark, length):
    docs = awkward(spark).withColumn("doc_id", F.monotonically_increasing_id())
    docs = materialise(docs, "awkward")
    ordered = docs.orderBy("doc_id").collect()
    expected = brute.repeated_bytes([r["text"] for r in ordered], length)
    got = {r["doc_id"]: r for r in suffix_dedup.dedup(docs, length=length).collect()}
    for source, row in zip(ordered, expected):
        r = got[source["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == row


def test_long_text_is_cut_into_overlapping_pieces(monkeypatch, spark):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    text = ("".join(chr(97 + n * n % 23) for n in range(700)) + "0123456789" * 9 + "".join(chr(97 + n * 7 % 19) for n in range(500))).encode()
    whole = [p for p in suffix_dedup.pieces([text], 30)]
    starts = sorted((int(place), int(n)) for p in whole for place, n in zip(p.place, p.n))
    assert sum(n for _, n in starts) == len(text) - 29
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_empty_table_has_an_empty_result(spark):
    empty = awkward(spark).limit(0)
    assert suffix_dedup.dedup(empty).count() == 0
    assert jaccard_join.join_documents(empty).count() == 0
    assert line_dedup.dedup_report(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert quality_rules.apply_rules(empty).count() == 0
    benchmark = spark.createDataFrame([(1, PROSE)], "item_id long, text string")
    assert decontamination.contaminated(empty, benchmark).count() == 0
    assert decontamination.contaminated(awkward(spark), benchmark.limit(0)).count() == 0


# --- mixing


def expected_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above a cap is shared again until none is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, None: 50}, {"a": 1, "b": 2, "c": 900, "d": 0}, {"a": 7}, {"a": 5, "b": 5, "c": 5, "d": 400}])
def test_targets_stop_at_the_cap(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    expected = expected_targets(sizes)
    assert got.keys() == expected.keys()
    assert all(math.isclose(got[s], expected[s], rel_tol=1e-9, abs_tol=1e-9) for s in got)


def test_mix_comes_near_its_targets(spark, texts):
    rows = queries.op3_mixing(spark, SMALL).collect()
    assert [(r["doc_id"], r["size"]) for r in sorted(rows)] == [(i, len(brute.words(t))) for i, t in texts]
    by_source = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        by_source[r["source"]].append(r)
    expected = expected_targets({s: sum(r["size"] for r in rs) for s, rs in by_source.items()})
    for source, rs in by_source.items():
        assert {r["source_size"] for r in rs} == {sum(r["size"] for r in rs)}
        assert math.isclose(rs[0]["target"], expected[source], rel_tol=1e-9)
        # One document decides; it is taken if that is nearer.
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= max(r["size"] for r in rs) / 2 + 1
    assert rows_of(queries.op3_mixing(spark, SMALL)) == sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == docs.count()
    copies = collections.defaultdict(set)
    for r in mixed:
        copies[(r["doc_id"], r["source"], r["size"], r["hash"])].add(r["copies"])
    assert all(len(found) == 1 for found in copies.values())
    kept = mixing.mixed_documents(clashing(spark))
    assert kept.columns[-5:] == ["size", "source_size", "target", "copies", "taken"] and "row" in kept.columns
    assert kept.where("copies < 1").isEmpty() and kept.count() == sum(r["copies"] > 0 for r in mixed)


# --- quality rules


def test_rule_counts_equal_brute_force(spark, texts):
    got = {r["doc_id"]: r for r in queries.op4_quality_rules(spark, SMALL).collect()}
    for doc_id, text in texts:
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.rule_counts(text)
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_rule_counts_of_awkward_texts(spark):
    docs = awkward(spark)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = rows_of(quality_rules.measure(docs, "text", "text"), "text", *names)
    expected = [(r["text"], *brute.rule_counts(r["text"])) for r in docs.collect()]
    assert got == sorted(expected, key=lambda r: tuple((v is not None, str(v)) for v in r))
    kept = quality_rules.keep_good(clashing(spark))
    assert kept.columns == clashing(spark).columns and 0 < kept.count() < docs.count()


def test_rules_separate_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    judged = queries.op4_quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.9 and share[0] < 0.1


def measured_rows(spark, rows):
    """Measures of documents of 100 words, 10 lines and 400 letters: id, source and what differs from a plain document."""
    plain = {"n_words": 100, "word_chars": 500, "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": 10, "n_letters": 400, "n_upper": 8}
    values = [(n, "x", source, *({**plain, **other}).values()) for n, source, other in rows]
    return spark.createDataFrame(values, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in plain))


def verdicts(measured):
    return {r["doc_id"]: r["kept"] for r in quality_rules.judge(measured, quality_rules.group_thresholds(measured)).collect()}


def test_each_rule_rejects(spark):
    bad = [{"n_symbols": 12}, {"n_upper": 60}, {"n_dup_lines": 5}, {"n_repeat_words": 18}, {"word_chars": 900}]
    rows = [(n, f"s{n % 2}", {"word_chars": 490 + n % 20}) for n in range(600)]
    got = verdicts(measured_rows(spark, rows + [(1000 + k, "s0", other) for k, other in enumerate(bad)]))
    assert [got[1000 + k] for k in range(len(bad))] == [False] * len(bad)
    assert all(got[n] for n in range(600))


@pytest.mark.parametrize("percent", [10, 30, 45, 80])
def test_a_hot_source_loses_its_junk(spark, percent):
    rows = [(n, "hot" if n < 500 else f"s{n % 2}", {"n_symbols": 50} if n < 500 and n % 100 < percent else {}) for n in range(1500)]
    got = verdicts(measured_rows(spark, rows))
    assert all(got[n] == (not other) for n, _, other in rows)


def test_thresholds_follow_the_group(spark):
    """A source whose documents all have some symbols keeps them; what is kept there is rejected elsewhere."""
    rows = [(n, "code" if n < 500 else "prose", {"n_symbols": 8 + n % 9} if n < 500 else {}) for n in range(1500)]
    got = verdicts(measured_rows(spark, [*rows, (2000, "prose", {"n_symbols": 15}), (2001, "code", {"n_symbols": 60})]))
    assert all(got[n] for n in range(1500)) and not got[2000] and not got[2001]


def test_sketches_merge_in_any_order(spark):
    values = spark.range(1000).select(F.lit("x").alias("lang"), (F.col("id") % 7).cast("string").alias("source"), (F.col("id") + 1).alias("n_symbols"))
    counts = {c: F.lit(n).cast("long") for c, n in {"n_words": 100, "word_chars": 500, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": 5, "n_letters": 400, "n_upper": 4}.items()}
    sketches = quality_rules.sketch_ratios(values.withColumns(counts))
    merged = quality_rules.sketch_limits(sketches, "lang").first()
    again = quality_rules.sketch_limits(sketches.orderBy(F.desc("bucket")).repartition(5), "lang").first()
    assert merged == again and merged["n"] == 1000
    # Median 5, lower quartile 2.5 symbols a word, within the accuracy of the sketch.
    assert abs(merged["limits"]["symbols_per_word"] - (5 + quality_rules.SPREADS * 2.5)) < 1


# --- Jaccard join


def test_components_equal_brute_force(spark, texts):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op8_jaccard_join(spark, SMALL).collect()}
    assert got == brute.jaccard_components(texts)


def near_copies(spark, groups=6, members=40, words=70):
    """Groups whose members differ from a base, and from each other, by ever more words."""
    rows = []
    for g in range(groups):
        base = [f"w{g}x{n * n % 997}" for n in range(words)]
        for m in range(members):
            changed = list(base)
            for k in range(m % 9):
                changed[(m * 13 + k * 17) % words] = f"new{m}y{k}"
            rows.append((g * 1000 + m, " ".join(changed[: words - m % 4])))
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.mark.parametrize("block", [4096, 7])
def test_components_of_near_copies(spark, block):
    """Links that no star finds come from the trees, also where a cell is split into blocks."""
    docs, rows = near_copies(spark)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join_documents(docs, block).collect()}
    assert got == brute.jaccard_components(rows)


def test_linked_sets_share_a_cell():
    """For sets of many sizes with as many differences as a link allows."""
    import numpy as np

    draw = np.random.default_rng(5)
    for size in [*range(7, 60), 100, 333, 1000]:
        for _ in range(4):
            a = np.unique(draw.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64))
            gone = 15 * size // 185
            b = np.unique(np.concatenate([a[gone:], draw.integers(0, 2**63, gone, dtype=np.int64).astype(np.uint64)]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 85 * (len(a) + len(b) - shared):
                assert len(np.intersect1d(jaccard_join.cells(a), jaccard_join.cells(b)))


def test_cells_are_fewer_than_shingles():
    """At a lower limit, too, sets fill more groups than they may differ in and send no shingle alone."""
    import numpy as np

    draw = np.random.default_rng(6)
    sent = size = 0
    for n in [*range(100, 1000, 30), 3000]:
        a = np.unique(draw.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64))
        gone = 20 * n // 181
        b = np.unique(np.concatenate([a[gone:], draw.integers(0, 2**63, gone, dtype=np.int64).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        assert 100 * shared >= 80 * (len(a) + len(b) - shared)
        cells = jaccard_join.cells(a, 80)
        assert len(np.intersect1d(cells, jaccard_join.cells(b, 80)))
        sent, size = sent + len(cells), size + len(a)
    assert sent < 0.8 * size


def test_sets_in_few_groups_share_a_cell():
    """Sets that fill few groups are found by their first shingles."""
    import numpy as np

    draw = np.random.default_rng(7)
    for n in [*range(10, 60), 300]:
        a, other = np.split(draw.permutation(1 << 20)[: 2 * n].astype(np.uint64), 2)  # all in one group
        gone = 15 * n // 186
        b = np.concatenate([a[gone:], other[:gone]])
        cells, others = jaccard_join.cells(np.sort(a)), jaccard_join.cells(np.sort(b))
        assert len(np.intersect1d(cells, others)) and len(cells) < n


def test_tree_finds_all_pairs():
    import numpy as np

    draw = np.random.default_rng(3)
    base = draw.integers(0, 4, (20, jaccard_join.GROUPS))
    counts = np.concatenate([np.maximum(base + draw.integers(-1, 2, base.shape) * (draw.random(base.shape) < 0.1), 0) for _ in range(9)])
    n, component = counts.sum(axis=1), draw.integers(0, 30, len(counts))
    got = {tuple(sorted(p)) for p in zip(*(x.tolist() for x in jaccard_join.CountTree(n, counts, component).pairs()))}
    expected = set()
    for i in range(len(n)):
        for j in range(i + 1, len(n)):
            bound = np.minimum(counts[i], counts[j]).sum()
            if component[i] != component[j] and 185 * bound >= 85 * (n[i] + n[j]) and 100 * n[i] >= 85 * n[j] and 100 * n[j] >= 85 * n[i]:
                expected.add((i, j))
    assert got == expected and len(got) > 100


def test_one_of_each_group_stays(spark):
    docs = awkward(spark)
    report = jaccard_join.join_documents(docs)
    assert report.count() == docs.count()
    assert rows_of(report.where("n_shingles = 0"), "doc_id", "component_id") == [(None, None), (2, 2), (3, 3), (4, 4)]
    kept = jaccard_join.keep_one(clashing(spark))
    assert kept.columns == clashing(spark).columns
    left = [r["text"] for r in kept.collect()]
    assert left.count(PROSE) + left.count(PROSE + " again") == 1
    assert len(left) == len({t for t in left if t and t.strip()}) + 4


def test_components_of_a_chain(spark):
    chain = spark.range(300).select((F.col("id") * 7919 % 100003).alias("a"), ((F.col("id") + 1) * 7919 % 100003).alias("b"))
    more = spark.createDataFrame([(-1, -2), (-2, -1), (5, 5)], "a long, b long")
    labels = components.components(chain.unionByName(more))
    assert labels.count() == 303 and labels.select("label").distinct().count() == 2
    assert components.components(chain.limit(0)).count() == 0


# --- line dedup


def test_removed_lines_equal_brute_force(spark, texts):
    got = {r["doc_id"]: (r["n_lines"], r["removed_lines"]) for r in queries.op9_line_dedup(spark, SMALL).collect()}
    assert got == brute.similar_lines(texts)


@pytest.mark.parametrize("tries, most", [(1, 2), (1, 50), (2, 4096)])
def test_later_rounds_miss_no_line(spark, tries, most):
    """Few lines are met in a round, so that many removed lines are found in a later one."""
    rows = []
    for n in range(120):
        rare = [f"r{n % 5}", f"q{n % 7}"]
        rows.append((n, " ".join([*rare, *[f"c{k}" for k in range(8)], f"u{n // 2}", f"v{n // 5}"]) + f"\nonly {n}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = line_dedup.removed_lines(docs, tries, most)
    got = collections.defaultdict(list)
    for r in removed.collect():
        got[r["doc"]].append(r["line"])
    expected = {i: [int(x) for x in lines.split(",") if x] for i, (_, lines) in brute.similar_lines(rows).items()}
    assert {i: sorted(lines) for i, lines in got.items()} == {i: lines for i, lines in expected.items() if lines}


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark)
    report = {(r["doc_id"], r["n_lines"], r["removed_lines"]) for r in line_dedup.dedup_report(docs).collect()}
    assert (9, 3, "0,1,3") in report and (2, 0, "") in report and (4, 0, "") in report
    assert line_dedup.dedup_report(docs).count() == docs.count()
    kept = line_dedup.drop_lines(clashing(spark))
    assert kept.columns == clashing(spark).columns
    texts = {r["doc_id"]: r["text"] for r in kept.where("doc_id > 1").collect()}
    assert 9 not in texts and texts[2] is None and texts[4] == " \n\t "
    assert kept.where("doc_id = 5").first()["n_chars"] == len(texts[5])


# --- decontamination


ITEM = "Today Anna has 12 apples and Anna gives 3 of them to Bert, so how many apples does Anna have left over at the end of the day?"


def test_reparameterised_items_are_found(spark):
    benchmark = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    swapped = ITEM.replace("Anna", "Carla").replace("Bert", "Dora").replace("12", "250").replace("3 of", "77 of")
    # One name stands for two values here, so it is no re-parameterised question.
    mixed = ITEM.replace("does Anna", "does Kim")
    filler = " ".join(f"Some words {n} of another text that says little." for n in range(20))
    docs = spark.createDataFrame(
        [(1, ITEM), (2, f"{filler} {ITEM} {filler}"), (3, f"{filler}\n{swapped}"), (4, filler), (5, None), (6, mixed), (None, ITEM), (1, ITEM)],
        "doc_id long, text string",
    )
    found = {r["doc_id"]: r for r in decontamination.contaminated(docs, benchmark).collect()}
    assert set(found) == {1, 2, 3, None}
    assert found[3]["reparameterised"] and not found[1]["reparameterised"]
    assert {r["item_id"] for r in found.values()} == {1}
    kept = decontamination.drop_contaminated(docs.withColumns({"row": F.lit(1), "item_id": F.lit(2)}), benchmark)
    assert kept.columns == ["doc_id", "text", "row", "item_id"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6]


def test_short_items_and_templates(spark):
    benchmark = spark.createDataFrame([(7, "name the capital city"), (8, "add 1 and 2 now please"), (9, "add 5 and 9 now please")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "please name the capital city today"), (2, "x add 4 and 6 now please y"), (3, "nothing")], "doc_id long, text string")
    found = rows_of(decontamination.contaminated(docs, benchmark), "doc_id", "item_id")
    assert found == [(1, 7), (2, 8)]


def test_leaks_of_the_given_tables(spark, texts):
    folder = "/root/testdata/sf0.01"
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    whole = {(d["doc_id"], i) for d in docs for i, t in items if t in (d["text"] or "")}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, folder).collect()}
    assert whole and whole <= found and len(found) <= len(whole) + 2


def held_items(spark, items, texts):
    """The rows found, by number of text and item."""
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontamination.contaminated(docs, benchmark).collect()}


def test_items_of_a_template_with_other_equal_values(spark):
    """The first item has two equal values by chance; the others are found by their own slots, and all are named."""
    item = "A train leaves the old town with {} wagons and picks up {} more at the last station before it goes over the long bridge."
    items = [item.format(*n) for n in ((3, 3), (3, 5), (4, 9), (3, 5))]
    found = held_items(spark, items, [items[1], items[0], item.format(70, 80), item.format(6, 6), items[2]])
    assert {doc for doc, _ in found} == {0, 1, 2, 3, 4} and found[(0, 1)]["item_ids"] == [1, 2, 3]
    assert found[(0, 1)]["cover"] == 1 and not found[(0, 1)]["reparameterised"] and not found[(4, 1)]["reparameterised"]
    assert found[(1, 0)]["item_ids"] == [0] and found[(2, 1)]["reparameterised"] and (2, 0) not in found


def test_names_at_sentence_starts_and_other_cases(spark):
    item = "Anna has 12 apples. Anna gives 3 of them to Bert. Bert eats 2 of these apples. Anna buys 7 more. How many apples does Anna have now?"
    german = "Der Bauer bringt am Morgen Korn zur Mühle und der Müller mahlt Mehl, das die Frau im Dorf zu Brot backt."
    swap = lambda text, *pairs: functools.reduce(lambda t, p: t.replace(*p), pairs, text)
    other = swap(item, ("Anna", "Carla"), ("Bert", "Dora"), ("12", "40"))
    # One name stands for two, at sentence starts and elsewhere.
    mixed = swap(other, ("Carla gives", "Eva gives"), ("does Carla", "does Finn"))
    texts = [item, other, item.lower(), item.upper(), german.lower(), german.upper(), mixed, "Anna has a farm. Bert has a dog."]
    found = held_items(spark, [item, german], texts)
    assert set(found) == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 1)}
    assert {key for key, r in found.items() if r["reparameterised"]} == {(1, 0)} and all(r["cover"] == 1 for r in found.values())


def test_items_of_few_words_and_long_passages(spark):
    items = ["Compute 12 + 34 - 56 * 78 and 9 / 3.", "Rare zyx", "1 2 3 4 5 6 7 8 9 10", " ".join(f"part{chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(100)), "!"]
    long = items[3].split()
    texts = [f"It says: {t} That is all." for t in items[:3]]
    texts += ["Compute 12 + 34 - 56 * 79 and 9 / 3.", "rare and zyx", "1 2 3 4 6 5 7 8 9 10"]
    texts += [" ".join(["before", *long[30:60], "after"]), " ".join(["before", *long[30:42], "after"]), "!"]
    assert set(held_items(spark, items, texts)) == {(0, 0), (1, 1), (2, 2), (6, 3)}


def test_absent_units_are_no_tokens(spark):
    """Numbers without a unit leave enough words for a template."""
    item = "Take 4 eggs, 2 spoons, 7 nuts, 5 plums."
    found = held_items(spark, [item], ["Take 9 eggs, 3 spoons, 8 nuts, 6 plums."])
    assert found[(0, 0)]["reparameterised"]


# --- token counts


def test_batches_are_additive_and_idempotent(spark):
    rollup = token_counts.TokenRollup(spark, scratch_path(spark, "rollup-test"))
    columns = "op string, key string, source string, lang string, version string, tokens long"
    batches = [
        [("upsert", "1", "a", "en", "v", 10), ("upsert", "2", "a", None, "v", 5), ("upsert", "1", "a", "en", "w", 3), ("upsert", "1", "a", "en", "v", 4)],
        [("upsert", "1", "b", "en", "v", 12), ("delete", "2", None, None, "v", 0), ("delete", "9", None, None, "v", 0), ("upsert", "3", None, "de", "v", 0)],
        [("upsert", "2", "a", "fr", "v", 7), ("delete", "1", None, None, "w", 0)],
    ]
    after = [
        [("a", None, "v", 1, 5), ("a", "en", "v", 1, 10), ("a", "en", "w", 1, 3)],
        [(None, "de", "v", 1, 0), ("a", "en", "w", 1, 3), ("b", "en", "v", 1, 12)],
        [(None, "de", "v", 1, 0), ("a", "fr", "v", 1, 7), ("b", "en", "v", 1, 12)],
    ]
    for n, rows in enumerate(batches, 1):
        for _ in range(2):  # a batch that is committed again changes nothing
            rollup.commit(n, spark.createDataFrame(rows, columns))
        got = [tuple(r) for r in rollup.totals(n).select("source", "lang", "version", "docs", "tokens").collect()]
        assert sorted(got, key=str) == sorted(after[n - 1], key=str)
    rollup.commit(2, spark.createDataFrame(batches[1], columns))
    assert rollup.totals(3).count() == 3 and rollup.totals(0).count() == 0


def test_counts_of_awkward_rows(spark):
    counts = token_counts.counted(clashing(spark)).where("version = 'words-1'").collect()
    assert len(counts) == 13 and {r["tokens"] for r in counts if r["key"] in ("2", "3", "4")} == {0}


def test_vocabulary_tokenizer(spark):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    tokenizers = pytest.importorskip("public_tokenizers")
    counter = token_counts.byte_pair_counter(path, tokenizers.PATTERN)
    rows = token_counts.vocabulary_counted(awkward(spark), "bpe", counter).where("key IN ('1', '2', '6')").collect()
    count = counter()
    assert {(r["key"], r["tokens"]) for r in rows} == {("1", count(PROSE)), ("1", count(PROSE + " again")), ("2", 0), ("6", 1)}


# --- bitmap


def test_bitmap_misses_no_key(spark):
    import numpy as np

    keys = spark.range(2000).select(F.xxhash64("id").alias("key"))
    held = bitmap.build(keys, F.col("key"))
    values = np.array([r["key"] for r in keys.collect()])
    assert bitmap.may_hold(held, values).all()
    assert bitmap.may_hold(held, np.arange(100_000, dtype=np.int64) * 2654435761).mean() < 0.01
    assert not bitmap.build(keys.limit(0), F.col("key")).any()


def test_token_counts_of_copies_without_id(spark, duck, tmp_path):
    """A copy without an id goes if its text has one, and stays as one document if not, also where its text is revised."""
    rows = [(1, "a b c", "en", "a"), (None, "a b c", "en", "b"), (None, "d | e", "en", "a"), (None, "d | e", "en", "a"), (10, "f g", "de", "a"), (9, "f g", "de", "b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(queries.op6_token_counts(spark, str(tmp_path)), "source", "lang", "version", "docs", "tokens")
    statement = oracles.ORACLES["op6_token_counts"].replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = duck.execute(f"SELECT source, lang, version, docs, tokens FROM ({statement})").fetchall()
    assert got == sorted(expected)


def test_lines_of_documents_with_text_ids(spark):
    """Ids that are no whole number come after all others."""
    rows = [("b", PROSE), ("7", PROSE + "\nanother line of words"), ("a", "nothing here is like it")]
    found = line_dedup.dedup_report(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in found} == {"b": "0", "7": "", "a": ""}


def test_places_of_unique_ids_cost_nothing(spark):
    """Only rows of an id with several different texts carry a hash of the text; removed lines are the same."""
    rows = [(1, "a b c d e"), (1, "a b c d f"), (2, "x y z"), (2, "x y z"), (None, "k l m"), (None, "x y z"), (3, "a b c d e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = line_dedup.placed(docs, line_dedup.shared_ids(docs)).collect()
    assert {(r["doc_id"], r["row"] != 0) for r in placed} == {(1, True), (2, False), (None, True), (3, False)}
    found = {(r["doc_id"], r["n_lines"], r["removed_lines"]) for r in line_dedup.dedup_report(docs).collect()}
    assert {(3, 1, "0"), (2, 1, "")} <= found


def test_shuffle_files_go_with_their_write(spark, tmp_path):
    """The setting holds for the writes only, however many run at the same time."""
    import threading

    from cartwright import session

    before = spark.conf.get(session.SHUFFLE_CLEANUP)
    both = threading.Barrier(2)

    def write():
        with session.shuffles_deleted(spark):
            both.wait(60)
            assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
            both.wait(60)

    session.run_together(write, write)
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == before
    table = session.materialise(spark.range(100).repartition(3, "id"), "test-written")
    assert table.count() == 100 and spark.conf.get(session.SHUFFLE_CLEANUP) == before
