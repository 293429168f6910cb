"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets the probability of a logistic model over its
words and word beginnings; the document's is their noisy-or, ``1 - prod(1 - p)``. The model is
trained from document labels alone, and afterwards tells which sentences offend.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of, slices
from tabprep.scratch import materialize

#: Bounds of the fit: documents per label, characters of one of them, features of the model.
FIT_PER_LABEL, FIT_CHARS, FIT_FEATURES = 4000, 50_000, 20_000
#: Documents a feature must be in to be learned.
MIN_DOCS = 4
#: Lengths of word beginnings that are features beside the word itself.
STEMS = (4, 5, 6)
#: Words whose weights a task keeps.
_KEPT = 1_000_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def _features(word: str) -> list[str]:
    return [word, *(f"{word[:k]}*" for k in STEMS if len(word) >= k)]


def _sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """Start, end and distinct lower-case words of each sentence that has words."""
    found = ((m.start(), m.end(), set(_WORD.findall(m.group().lower()))) for m in _SENTENCE.finditer(text))
    return [s for s in found if s[2]]


class Model:
    """Weights of features and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.words: dict[str, float] = {}

    def of_word(self, word: str) -> float:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= _KEPT:
                self.words.clear()
            known = self.words[word] = sum(self.weights.get(f, 0.0) for f in _features(word))
        return known

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """Start, end and probability of each sentence with words."""
        of = self.of_word
        return [(a, b, _sigmoid(self.bias + sum(map(of, sorted(words))))) for a, b, words in _sentences(text)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _doc_features(batches):
    """Each distinct feature of a document once, as ``(feature, toxic)``."""
    for batch in batches:
        words: list[str] = []
        labels: list[int] = []
        for text, toxic in rows_of([batch], "text", "toxic"):
            found = {f for _, _, ws in _sentences(text.decode()) for w in ws for f in _features(w)}
            words += found
            labels += [toxic] * len(found)
            if len(words) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(labels, pa.int32())], ["feature", "toxic"])
                words, labels = [], []
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(labels, pa.int32())], ["feature", "toxic"])


def _bags(batches, index):
    """Per document its label and, for each sentence, the numbers of its learned features."""
    schema = pa.schema([("toxic", pa.int32()), ("bag", pa.list_(pa.list_(pa.int32())))])
    for batch in batches:
        rows = []
        for text, toxic in rows_of([batch], "text", "toxic"):
            bag = [sorted(index[f] for w in ws for f in _features(w) if f in index) for _, _, ws in _sentences(text.decode())]
            rows.append({"toxic": toxic, "bag": bag})
        yield pa.RecordBatch.from_pylist(rows, schema)


def _train(bags: list[tuple[int, list[list[int]]]], start: np.ndarray, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the noisy-or likelihood of the labels, with a quadratic penalty."""
    labels = np.array([toxic for toxic, _ in bags], float)
    doc_of = np.repeat(np.arange(len(bags)), [len(b) for _, b in bags])
    sizes = [len(s) for _, b in bags for s in b]
    sentence_of = np.repeat(np.arange(len(sizes)), sizes)
    entries = np.array([f for _, b in bags for s in b for f in s], np.int64)
    balance = np.where(labels == 1, len(labels) / (2 * max(labels.sum(), 1)), len(labels) / (2 * max(len(labels) - labels.sum(), 1)))
    x = np.append(start, -5.0)
    first, second = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        score = np.bincount(sentence_of, x[entries], len(sizes)) + x[-1]
        p = _sigmoid(score)
        none = np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-9)), len(labels))
        some = np.maximum(-np.expm1(none), 1e-9)
        pull = balance * np.where(labels == 1, np.exp(none) / some, -1.0)
        slope = pull[doc_of] * p
        gradient = np.append(np.bincount(entries, slope[sentence_of], len(start)), slope.sum()) / len(labels)
        gradient[:-1] -= 1e-4 * x[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        x += 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return x[:-1], float(x[-1])


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    per_label: int = FIT_PER_LABEL,
    max_chars: int = FIT_CHARS,
) -> Model:
    """The sentence model, from document labels 0 and 1.

    The fit uses a bounded sample, the only thing that is broadcast and that comes to the driver besides the
    features: of each label ``per_label`` labelled ids at most, the first by a hash of the id, and of these the
    documents of up to ``max_chars`` characters. Features are words and word beginnings of ``MIN_DOCS``
    sample documents or more, the ``FIT_FEATURES`` that lean most to the label 1. Rows without an id, text or
    label are left out; an id labelled both ways counts as 1. Without a document of each label the model
    scores everything 0.
    """
    labels = labels.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(label_column).cast("int").alias("toxic"))
    labels = labels.dropna().filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    drawn = [labels.filter(F.col("toxic") == k).orderBy(*order).limit(per_label) for k in (0, 1)]
    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    # At most 2 * per_label rows of two numbers.
    sample = texts.join(F.broadcast(drawn[0].union(drawn[1])), "doc_id").filter(F.length("text") <= max_chars)
    sample = materialize(sample.select("text", "toxic"))
    taken = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(taken) < 2:
        return Model({}, -30.0)
    by_feature = (
        sample.mapInArrow(_doc_features, "feature string, toxic int")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("yes"), F.count("*").alias("n"))
        .filter(F.col("n") >= MIN_DOCS)
    )
    yes = (F.col("yes") + 0.5) / (taken[1] + 1)
    no = (F.col("n") - F.col("yes") + 0.5) / (taken[0] + 1)
    lean = F.log(yes / no)
    leaning = (lean / F.sqrt(1 / (F.col("yes") + 0.5) + 1 / (F.col("n") - F.col("yes") + 0.5))).alias("lean")
    top = by_feature.select("feature", leaning, lean.alias("odds")).filter("lean > 1").orderBy(F.desc("lean"), "feature").limit(FIT_FEATURES).collect()
    index = {r.feature: i for i, r in enumerate(top)}
    if not index:
        return Model({}, -30.0)
    handed = sample.sparkSession.sparkContext.broadcast(index)
    bags = sample.mapInArrow(lambda b: _bags(b, handed.value), "toxic int, bag array<array<int>>").collect()
    start = np.clip([r.odds for r in top], 0, 4) / 4
    weights, bias = _train([(r.toxic, r.bag) for r in sorted(bags)], start)
    return Model({f: float(w) for f, w in zip(index, weights, strict=True)}, bias)


def _score(batches, model, threshold, text, kept):
    schema = pa.schema(
        [("score", pa.float64()), ("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))]
    )
    for batch in slices(batches):
        scores, spans = [], []
        for (data,) in rows_of([batch], text):
            found = model.sentences(data.decode()) if data else []
            clean = float(np.sum(np.log1p(-np.minimum([p for _, _, p in found], 1 - 1e-12)))) if found else 0.0
            scores.append(float(-np.expm1(clean)))
            spans.append([{"start": a, "end": b, "score": float(p)} for a, b, p in found if p >= threshold])
        rest = batch.select(kept)
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, *(pa.array(c, f.type) for c, f in zip((scores, spans), schema, strict=True))], schema=pa.schema([*rest.schema, *schema])
        )


def score_toxicity(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.5, keep_text: bool = True) -> DataFrame:
    """The rows with ``score`` and ``offending`` added: the noisy-or of the sentences, and the sentences
    (character range and probability) of ``threshold`` or more.

    A null or empty text, or one without words, scores 0 and has no sentences. All rows and columns are kept,
    the text unless it is not wanted back; columns of the two names are replaced.
    """
    docs = docs.drop("score", "offending")
    handed = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index(text_column)]
    kept = [n for n in names if keep_text or n != text]
    schema = ", ".join([*(f"{n} {t}" for n, t in plain.dtypes if n in kept), "score double, offending array<struct<start:bigint,end:bigint,score:double>>"])
    found = plain.mapInArrow(lambda b: _score(b, handed.value, threshold, text, kept), schema)
    return found.toDF(*(c for c, n in zip(docs.columns, names, strict=True) if n in kept), "score", "offending")
