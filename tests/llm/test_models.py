"""The trained operators: exact patterns, gradients, held-out accuracy and awkward rows."""

import hashlib
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import PROSE, SMALL, awkward, clashing

from cartwright.llm import language_id, pii, quality_classifier, queries
from cartwright.llm.char_tagger import CLASSES, Tagger
from cartwright.llm.sampling import hash_sample

LARGER = "/root/testdata/sf0.01"
CARD = "4111 1111 1111 1111"


# --- personal data


def test_pattern_spans_equal_plain_patterns(spark):
    rows = spark.read.parquet(f"{LARGER}/documents.parquet").select("text").collect()
    for r in rows:
        assert pii.spell(pii.pattern_spans(r["text"])) == brute.base_spans(r["text"])


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c x@y..z @b.c a@@b.c a@b a@b.c@d.e a@b.c.d@e.f.g _@-.-",
        "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 0001.2.3.4 1..2.3.4 9.9.9.9x1.1.1.1",
        f"{CARD} {CARD}1 4111-1111-1111-1111 4111  1111 1111 1111 1 2 3",
        "+1 (968) 555-1234 +12 +1234567890 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 ++49-170-1234567 +1(((",
        f"été x@y.z {CARD} \U0001f600 1.2.3.4",
        "1" * 5000 + "@" * 500 + "." * 500 + "+1" * 500,
        "",
    ],
)
def test_pattern_spans_of_odd_texts(text):
    assert pii.spell(pii.pattern_spans(text)) == brute.base_spans(text)


def test_gradients_of_the_tagger():
    tagger, draw = Tagger.fresh(5), np.random.default_rng(0)
    codes, labels = draw.integers(0, CLASSES, (3, 7)), draw.integers(0, 5, (3, 7))
    _, grads = tagger.gradients(codes, labels)
    for name, values in tagger.weights.items():
        place = (codes[0, 2], 3) if name == "embed" else tuple(draw.integers(0, s) for s in values.shape)
        values[place] += 1e-5
        above = tagger.gradients(codes, labels)[0]
        values[place] -= 2e-5
        below = tagger.gradients(codes, labels)[0]
        values[place] += 1e-5
        assert abs((above - below) / 2e-5 - grads[name][place]) < 1e-6


@pytest.fixture(scope="module")
def tagger(spark):
    return pii.fit(pii.labelled_windows(spark.read.parquet(f"{LARGER}/documents.parquet")))


def test_disguised_spans_are_found(tagger):
    """Held-out forms: new values in the places of other texts."""
    draw = np.random.default_rng(5)
    pieces = [("email", f"{n}.{a}@mail{d}.example.com") for d, (n, a) in enumerate([("kato", 7), ("ines", 31), ("bwalya", 5), ("oyu", 88)])]
    pieces += [("ip", f"{a}.{b}.7.9") for a, b in [(10, 200), (81, 3), (192, 168), (44, 55)]]
    pieces += [("card", "4111111111111111"), ("card", "5500005555555559"), ("phone", "+1 (212) 555-0199"), ("phone", "+1 (415) 555-0134")]
    found = 0
    for kind, piece in pieces:
        hidden = pii.disguise(kind, piece, draw)
        text = f"The words before it are {hidden} and some of them follow."
        spans = pii.tagged_spans([text], tagger)[0]
        found += any(k == kind and abs(s - text.index(hidden)) < 3 for k, s, _ in spans)
    assert found >= 8


def test_windows_are_reconciled(tagger):
    """A span that lies on the edge of windows, far into a long text, is found once."""
    text = "word " * 400 + "write to kato.7 (at) mail3.example.com today " + "word " * 400
    spans = pii.tagged_spans([text, "no data here", ""], tagger)
    assert len(spans[0]) == 1 and text[slice(*spans[0][0][1:])].startswith("kato") and spans[1:] == [[], []]


def test_clean_documents_get_no_tagged_spans(spark):
    found = queries.op2_pii(spark, SMALL).collect()
    for r in found:
        assert r["n_tagged"] == len([s for s in r["spans"].split(",") if s]) - sum(r[f"n_{k}"] for k in pii.KINDS)
    assert sum(r["n_tagged"] for r in found) <= 2


def test_personal_data_of_awkward_rows(spark):
    docs = clashing(spark)
    got = pii.detect(docs)
    assert got.count() == docs.count()
    none = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in got.collect()} == {none}
    assert pii.detect(docs.limit(0)).count() == 0
    some = pii.find(docs.limit(1).withColumn("text", F.lit(f"{PROSE} a@b.c")), None, "text", "doc_id").first()
    assert (some["n_email"], some["spans"]) == (1, f"email:{len(PROSE) + 1}:{len(PROSE) + 6}")


# --- language


def test_languages_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = queries.op5_language_id(spark, LARGER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_unseen_words_fall_back_to_grams():
    model = language_id.build_model({"x": 2, "y": 1}, [("x", "aabb", 5), ("x", "aabbcc", 2), ("y", "zzyy", 5), ("y", "zzxx", 3)])
    scorer = language_id.Scorer(model)
    assert scorer.predict(b"aabb")[0] == "x" and scorer.predict(b"zzyy zzxx")[0] == "y"
    assert scorer.predict(b"qaabq")[0] == "x" and scorer.predict(b"qzzyq")[0] == "y"
    assert scorer.predict("你好".encode())[0] == "x"  # nothing known: the most frequent language
    for none in (None, b"", b"12 345 ?!", "² ½".encode()):
        assert scorer.predict(none) == ("und", 0.0)


def test_rare_languages_are_learned(spark):
    """Each language has its own draw, and one without a word is no language of the model."""
    rows = [("x", f"common{chr(97 + n % 26)} hello{n}") for n in range(4000)] + [("y", f"seldom{chr(97 + n)} word") for n in range(20)]
    rows += [("z", f"{n} !") for n in range(50)]
    model = language_id.fit(spark.createDataFrame(rows, "lang string, text string"), sample_docs=30)
    assert model.languages == ["x", "y"]
    assert {f"seldom{chr(97 + n)}" for n in range(20)} <= set(model.words)
    drawn = language_id.hash_sample_by(spark.createDataFrame(rows, "lang string, text string"), "lang", {"x": 4000, "y": 20}, 30, "text")
    assert {"y"} <= {r["lang"] for r in drawn.collect()} <= {"x", "y"} and 20 + 10 < drawn.count() < 20 + 60


def test_language_of_awkward_rows(spark):
    docs = clashing(spark)
    got = language_id.identify(docs)
    assert got.count() == docs.count()
    assert {r["lang_pred"] for r in got.where("doc_id IN (2, 3, 4)").collect()} == {"und"}
    unlabelled = language_id.identify(awkward(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in unlabelled.collect()} == {("und", 0.0)}
    assert language_id.identify(docs.limit(0)).count() == 0


# --- quality


def test_quality_of_held_out_documents(spark):
    rows = queries.op10_quality_classifier(spark, LARGER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    held = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.85


def test_trees_fit_steps_and_ignore_row_order():
    draw = np.random.default_rng(1)
    stats = draw.random((3000, 4))
    label = ((stats[:, 0] > 0.3) ^ (stats[:, 2] > 0.6)).astype(float)
    model = quality_classifier.fit(stats, label)
    assert ((model.score(stats) > 0.5) == label).mean() > 0.98
    order = draw.permutation(3000)
    assert np.allclose(quality_classifier.fit(stats[order], label[order]).score(stats), model.score(stats))
    constant = quality_classifier.fit(np.zeros((50, 4)), np.ones(50))
    assert (constant.score(np.ones((3, 4))) > 0.9).all()


def test_copies_are_sampled_like_other_rows(spark, monkeypatch):
    """A third of the labelled rows are empty texts; about as large a share is learned, within the bound."""
    seen = []
    monkeypatch.setattr(quality_classifier, "hash_sample", lambda df, rows, *keys: seen.append(hash_sample(df, 300, *keys)) or seen[-1])
    docs = [(n, "" if n % 3 == 0 else " ".join(["word"] * (n + 1))) for n in range(3000)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert quality_classifier.classify(docs, labels).count() == 3000
    words = [r["stats"][0] for r in seen[0].collect()]
    assert 200 < len(words) < 400 and 50 < sum(w == 0 for w in words) < 150


def test_quality_of_awkward_rows(spark):
    docs = clashing(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 0), (77, 1)], "doc_id long, quality int")
    got = quality_classifier.classify(docs, labels)
    assert got.count() == docs.count() and got.where("score IS NULL OR predicted IS NULL").isEmpty()
    nothing = quality_classifier.classify(docs, labels.limit(0))
    assert {(r["score"], r["predicted"]) for r in nothing.collect()} == {(0.5, 1)}
    assert quality_classifier.classify(docs.limit(0), labels).count() == 0


def test_long_runs_of_digits():
    zeros = "0" * 5000
    assert [k for k, _, _ in pii.pattern_spans(f"at {zeros}10.1.1.1 and {zeros}.{zeros}.{zeros}.{zeros} and 9{zeros}.1.1.1")] == ["ip", "ip"]
