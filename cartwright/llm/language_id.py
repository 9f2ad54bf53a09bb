"""Language identification: words first, then ever shorter character n-grams for unseen words.

A word of the vocabulary scores by its log frequency in each language. An unseen word is cut, between boundary
marks, into n-grams of GRAM_SIZES[0] characters; if none of them is known, into shorter ones, down to single
characters. Each word counts once per occurrence; the language with the largest sum wins.

The model is fit on about SAMPLE_DOCS labelled documents of each of the LANGUAGES most frequent languages and
keeps at most WORDS words a language, so that its size is bounded. Whole texts are scored.

Defined results: `und` with score 0 for a text that is null or has no letter, and for every text if nothing could
be learned; a text whose words are all unknown in every form gets the most frequent language, with its share of the
sample as score. Ties go to the more frequent language, then the smaller name. Rows are scored one by one, so
repeated rows get equal results. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.sampling import hash_sample_by

SAMPLE_DOCS = 2000
LANGUAGES = 200
WORDS = 20_000
GRAM_SIZES = (4, 3, 2, 1)
UNKNOWN = "und"
#: Unseen words that a task remembers before it forgets them all.
MEMO_WORDS = 100_000
#: Words of a text that its score counts as independent.
SCORE_WORDS = 10

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: bytes | None) -> list[str]:
    """The runs of letters of a text, in lower case."""
    return _WORD.findall((text or b"").decode("utf-8", "replace").lower())


def grams_of(word: str, size: int) -> list[str]:
    marked = f"^{word}$" if size > 1 else word
    return [marked[i : i + size] for i in range(max(1, len(marked) - size + 1))]


@dataclass
class LanguageModel:
    """Log frequencies per language: of words, and of n-grams by size."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray

    def backoff(self, word: str) -> np.ndarray:
        for size in GRAM_SIZES:
            known = [self.grams[g] for g in grams_of(word, size) if g in self.grams]
            if known:
                return self.gram_scores[known].mean(axis=0)
        return np.zeros(len(self.languages), dtype=np.float32)


def _log_scores(counts: dict[str, np.ndarray], keys: list[str], smoothing: float) -> np.ndarray:
    table = np.array([counts[k] for k in keys], dtype=np.float64).reshape(len(keys), -1) + smoothing
    return np.log(table / table.sum(axis=0)).astype(np.float32)


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, most_words: int = WORDS) -> LanguageModel | None:
    """A model of the rows (text, lang) whose columns are not null; None without a word to learn from."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.col("text").cast("binary").alias("text"))
    labelled = labelled.where(F.col("lang") != UNKNOWN)
    docs = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not docs:
        return None
    sample = hash_sample_by(labelled, "lang", {r["lang"]: r["count"] for r in docs}, sample_docs, "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, word, n) for lang, counter in found.items() for word, n in counter.items()]
            yield pa.RecordBatch.from_pydict(
                {"lang": [r[0] for r in rows], "word": [r[1] for r in rows], "n": pa.array([r[2] for r in rows], pa.int64())},
                schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]),
            )

    counted = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    kept = counted.withColumn("nth", F.row_number().over(frequent)).where(F.col("nth") <= most_words).drop("nth").collect()
    if not kept:
        return None
    # A language without a learned word would only attract what nobody knows.
    learned = {r["lang"] for r in kept}
    return build_model({r["lang"]: r["count"] for r in docs if r["lang"] in learned}, [(r["lang"], r["word"], r["n"]) for r in kept])


def build_model(docs: dict[str, int], rows: list[tuple[str, str, int]]) -> LanguageModel:
    """A model from documents per language and (language, word, count)."""
    languages = sorted(docs, key=lambda name: (-docs[name], name))
    place = {name: i for i, name in enumerate(languages)}
    word_counts: dict[str, np.ndarray] = {}
    gram_counts: dict[str, np.ndarray] = {}
    for lang, word, n in sorted(rows):
        word_counts.setdefault(word, np.zeros(len(languages)))[place[lang]] += n
        for size in GRAM_SIZES:
            for gram in grams_of(word, size):
                gram_counts.setdefault(gram, np.zeros(len(languages)))[place[lang]] += n
    words = sorted(word_counts)
    grams = sorted(gram_counts)
    gram_scores = np.zeros((len(grams), len(languages)), dtype=np.float32)
    for size in GRAM_SIZES:
        own = [i for i, g in enumerate(grams) if len(g) == size]
        if own:
            gram_scores[own] = _log_scores(gram_counts, [grams[i] for i in own], 0.1)
    total = np.array([docs[name] for name in languages], dtype=np.float64)
    return LanguageModel(
        languages,
        np.log(total / total.sum()).astype(np.float32),
        {w: i for i, w in enumerate(words)},
        _log_scores(word_counts, words, 0.1),
        {g: i for i, g in enumerate(grams)},
        gram_scores,
    )


class Scorer:
    """Scores texts with a model; remembers the unseen words it has met."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.memo: dict[str, np.ndarray] = {}

    def _unseen(self, word: str) -> np.ndarray:
        score = self.memo.get(word)
        if score is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            score = self.memo[word] = self.model.backoff(word)
        return score

    def predict(self, text: bytes | None) -> tuple[str, float]:
        words = words_of(text)
        if not any(c.isalpha() for word in words for c in word):
            return UNKNOWN, 0.0
        total = self.model.prior.astype(np.float64)
        ids, times, known = [], [], self.model.words
        for word, n in Counter(words).items():
            i = known.get(word)
            if i is None:
                total += n * self._unseen(word)
            else:
                ids.append(i)
                times.append(n)
        if ids:
            total += np.array(times) @ self.model.word_scores[ids]
        best = int(np.argmax(total))
        near = np.exp((total - total[best]) * min(1.0, SCORE_WORDS / len(words)))
        return self.model.languages[best], float(1 / near.sum())


def predict(docs: DataFrame, model: LanguageModel | None, text: str, *keep: str) -> DataFrame:
    """The columns `keep`, lang_pred and score."""
    source = docs.select(*keep, F.col(text).cast("binary").alias("scored_text"))
    if model is None:
        return source.drop("scored_text").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    # At most LANGUAGES x WORDS words.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                [*batch.schema.names[:-1], "lang_pred", "score"],
            )

    schema = source.drop("scored_text").schema.add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the CRC of the id as text falls into the fold; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document, learned from the documents that are not held out."""
    docs = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id"), folds, fold).alias("held_out"))
    model = fit(docs.where(~F.col("held_out")))
    return predict(docs, model, "text", "doc_id", "held_out")
