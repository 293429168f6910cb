"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram binds the
vectors of its letters, each rotated by its place, by multiplying them. A document bundles its
trigrams by adding them; a language's prototype bundles the unit vectors of its documents. A text
gets the language whose prototype has the largest cosine with it. The mean of all prototypes is
taken off first, since it holds what languages share and tells none apart.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import bitmap, likely, mix, rows_of, slices

UNKNOWN = "und"
DIMENSIONS = 512
#: Texts worked on together: at most so many, and so many trigrams, unless one text has more.
_BLOCK_TEXTS, _BLOCK_TRIGRAMS = 160, 1 << 19
_NO_LETTER = 0
#: Standard deviations of a random text's cosine, up to which a cosine is no likeness, and the part of the learned
#: documents of a text's length that may be less alike than it.
NOISE, OUTLIERS = 4.0, 0.01
#: By how much a text's cosine may vary with the texts that are worked on together.
ROUNDING = 1e-5


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _trigrams(text: str) -> np.ndarray:
    """Codes of letter trigrams; a run of other characters is one boundary mark."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    codes = np.concatenate(([_NO_LETTER], np.where(_letters()[codes], codes, _NO_LETTER), [_NO_LETTER])).astype(np.int64)
    kept = np.ones(len(codes), bool)
    kept[1:] = (codes[1:] != _NO_LETTER) | (codes[:-1] != _NO_LETTER)
    codes = codes[kept]
    grams = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    return grams[codes[1:-1] != _NO_LETTER]


def _letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    words = (dimensions + 63) // 64
    seeds = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(1, words + 1, dtype=np.uint64)
    bits = np.unpackbits(mix(mix(seeds)).view(np.uint8), axis=1)[:, :dimensions]
    return bits.astype(np.float32) * 2 - 1


def _gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vector of each trigram."""
    bound = None
    for place, shift in enumerate((42, 21, 0)):
        letters, at = np.unique((grams >> shift) & 0x1FFFFF, return_inverse=True)
        turned = np.roll(_letter_vectors(letters, dimensions), place, axis=1)[at]
        bound = turned if bound is None else np.multiply(bound, turned, out=bound)
    return bound


def _bundle(grams: list[np.ndarray], dimensions: int) -> np.ndarray:
    """Unit vector of each text from its trigrams; zeros for a text without any."""
    distinct, codes = np.unique(np.concatenate(grams), return_inverse=True)
    counts = np.zeros((len(grams), len(distinct)), np.float32)
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    np.add.at(counts.reshape(-1), owner * len(distinct) + codes, 1)
    bundled = np.zeros((len(grams), dimensions), np.float32)
    for at in range(0, len(distinct), 1 << 12):
        part = slice(at, at + (1 << 12))
        bundled += counts[:, part] @ _gram_vectors(distinct[part], dimensions)
    norms = np.linalg.norm(bundled, axis=1, keepdims=True)
    return bundled / np.maximum(norms, 1e-9)


def _blocks(batches, *columns):
    """Rows of the named columns, the first being the text, with their trigrams, in blocks."""
    rows, grams, held = [], [], 0
    for row in rows_of(batches, *columns):
        grams.append(_trigrams(row[0].decode() if row[0] else ""))
        rows.append(row)
        held += len(grams[-1])
        if len(rows) >= _BLOCK_TEXTS or held >= _BLOCK_TRIGRAMS:
            yield rows, grams
            rows, grams, held = [], [], 0
    if rows:
        yield rows, grams


def _partial_profiles(batches, dimensions):
    sums: dict[bytes, np.ndarray] = {}
    for rows, grams in _blocks(batches, "text", "lang"):
        for (_, lang), vector in zip(rows, _bundle(grams, dimensions), strict=True):
            sums[lang] = sums.get(lang, 0) + vector.astype(np.float64)
    for lang, vector in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang.decode()] * dimensions), pa.array(np.arange(dimensions), pa.int32()), pa.array(vector)], ["lang", "dim", "value"]
        )


class Profiles:
    """Language names and their centred unit prototypes, one row each."""

    def __init__(self, names: list[str], vectors: np.ndarray):
        self.names, self.dimensions = names, vectors.shape[1]
        norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        unit = vectors / norms
        self.units = unit.astype(np.float32)
        self.mean = unit.mean(axis=0) if len(names) > 1 else np.zeros(self.dimensions)
        centred = unit - self.mean
        self.vectors = (centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def likeness(self, grams: list[np.ndarray]) -> np.ndarray:
        """The largest cosine of each text with a prototype, nothing taken off: near 0 if it is like none."""
        return (_bundle(grams, self.dimensions) @ self.units.T).max(axis=1)

    def compare(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the best language of each text and the cosine with it."""
        bundled = _bundle(grams, self.dimensions) - self.mean.astype(np.float32)
        bundled /= np.maximum(np.linalg.norm(bundled, axis=1, keepdims=True), 1e-9)
        cosines = bundled @ self.vectors.T
        best = cosines.argmax(axis=1)
        return best, cosines[np.arange(len(best)), best]


def _learned(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """The texts that are learned from: ``text`` and ``lang``, every distinct text of a language once.

    How often a text is repeated says nothing about its language and changes nothing here. Texts are told apart by
    their hashes, and only those that may be repeated, by a bitmap of the repeated hashes, are exchanged.
    """
    labelled = docs.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).dropna()
    labelled = labelled.withColumn("h", F.xxhash64("text"))
    repeated = bitmap(labelled.groupBy("lang", "h").count().filter("count > 1"), "h")
    single = likely(labelled, "h", repeated, without=True).select("text", "lang")
    again = likely(labelled, "h", repeated).groupBy("lang", "h").agg(F.min("text").alias("text"))
    return single.union(again.select("text", "lang"))


def _length_class(grams: np.ndarray) -> int:
    return len(grams).bit_length()


def _likenesses(batches, profiles):
    for _, grams in _blocks(batches, "text"):
        classes = pa.array([_length_class(g) for g in grams], pa.int32())
        yield pa.RecordBatch.from_arrays([classes, pa.array(profiles.likeness(grams).astype(np.float64))], ["length", "value"])


def learn_floors(docs: DataFrame, profiles: Profiles, text_column: str = "text", lang_column: str = "lang") -> dict[int, float]:
    """Likeness by length class (powers of two of trigrams) up to which a text resembles no language.

    It is what chance gives a text without any likeness, about, or less where learned documents of that length
    have less: short ones cannot be told from chance. All texts that the prototypes are learned from take part; the
    quantile's rank is right to a ten-thousandth of them.
    """
    if not profiles.names:
        return {}
    found = _learned(docs, text_column, lang_column).mapInArrow(lambda b: _likenesses(b, profiles), "length int, value double")
    rows = found.groupBy("length").agg(F.percentile_approx("value", OUTLIERS).alias("low")).collect()
    noise = NOISE / profiles.dimensions**0.5
    return {r.length: min(noise, r.low) for r in rows}


def _resembling(batches, profiles, floors, text):
    noise = NOISE / profiles.dimensions**0.5
    for batch in slices(batches):
        kept: list[bool] = []
        for _, grams in _blocks([batch], text):
            lettered = [i for i, g in enumerate(grams) if len(g)]
            stays = [False] * len(grams)
            if lettered:
                for i, value in zip(lettered, profiles.likeness([grams[i] for i in lettered]), strict=True):
                    # A floor that a learned text has set is reached by that text, in whatever block it comes.
                    stays[i] = bool(value > floors.get(_length_class(grams[i]), noise) - ROUNDING)
            kept += stays
        yield batch.filter(pa.array(kept, pa.bool_()))


def resembling(docs: DataFrame, profiles: Profiles, floors: dict[int, float], text_column: str = "text") -> DataFrame:
    """The rows whose text has letters and as much likeness as its length's floor; every text is compared."""
    handed = docs.sparkSession.sparkContext.broadcast((profiles, floors))
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index(text_column)]
    return plain.mapInArrow(lambda b: _resembling(b, *handed.value, text), plain.schema).toDF(*docs.columns)


def learn_profiles(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes from texts with a language: all of them, each distinct text of a language once.

    Rows without a text or language are left out. Per language only ``dimensions`` sums come to the driver.
    """
    sums = (
        _learned(labelled, text_column, lang_column)
        .mapInArrow(lambda b: _partial_profiles(b, dimensions), "lang string, dim int, value double")
        .groupBy("lang", "dim")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    names = sorted({r.lang for r in sums})
    vectors = np.zeros((len(names), dimensions))
    at = {name: i for i, name in enumerate(names)}
    for lang, dim, value in sums:
        vectors[at[lang], dim] = value
    return Profiles(names, vectors)


def _predict(batches, profiles, text, kept):
    schema = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])
    for batch in slices(batches):
        names, scores = [], []
        for _, grams in _blocks([batch], text):
            known = [i for i, g in enumerate(grams) if len(g)] if profiles.names else []
            block_names, block_scores = [UNKNOWN] * len(grams), [0.0] * len(grams)
            if known:
                best, cosines = profiles.compare([grams[i] for i in known])
                for i, b, c in zip(known, best, cosines, strict=True):
                    block_names[i], block_scores[i] = profiles.names[b], float(np.clip(c, 0, 1))
            names += block_names
            scores += block_scores
        rest = batch.select(kept)
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema=pa.schema([*rest.schema, *schema])
        )


def identify(docs: DataFrame, profiles: Profiles, text_column: str = "text", keep_text: bool = True) -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` (the cosine, 0 at least) added.

    A null text or one without letters, or any text if no language was learned, is ``und`` with score 0. The
    score and the language depend on the text alone. All rows and columns are kept, the text unless it is not
    wanted back; columns that already have the two names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    handed = docs.sparkSession.sparkContext.broadcast(profiles)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index(text_column)]
    kept = [n for n in names if keep_text or n != text]
    schema = ", ".join([*(f"{n} {t}" for n, t in plain.dtypes if n in kept), "lang_pred string, score double"])
    found = plain.mapInArrow(lambda b: _predict(b, handed.value, text, kept), schema)
    return found.toDF(*(c for c, n in zip(docs.columns, names, strict=True) if n in kept), "lang_pred", "score")
