"""Token counts from pre-tokens.

A tokenizer of the BPE kind splits a text into pre-tokens and each of them into pieces, whatever
stands beside it. So pieces are counted once per distinct pre-token of a block of documents, the
counts are joined to each document's pre-token frequencies, and products are summed. Token ids are
never put into a list per document, and no row leaves its task. Known counts are kept between
blocks, up to a fixed number.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of

#: Pre-tokens whose counts a task keeps.
KEPT = 1_000_000
_BLOCK_BYTES = 1 << 24


def _latin_classes() -> tuple[str, str]:
    """Letters and numbers below U+0250 as parts of a character class."""
    chars = [chr(i) for i in range(0x250)]
    kinds = [unicodedata.category(c)[0] for c in chars]
    return tuple("".join(re.escape(c) for c, k in zip(chars, kinds, strict=True) if k == kind) for kind in "LN")


_L, _N = _latin_classes()
#: Texts of these characters only are normal forms already, and lower case is a matter of each character.
_SIMPLE = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")
# Fixed value: the contractions that the tokenizer file names before letters, single digits and the rest.
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t\n\r {_L}{_N}]+")


#: A text whose pre-tokens differ between kinds of rules: case, blanks, contractions, digits, signs, accents.
_PROBE = "It's  THE Year 2024,\n\n we'LL pay 3.50 for a_b -- Été d'hiver\tnaïve!? x=1"


class PieceCounter:
    """Token counts as the library gives them for a tokenizer file whose pieces do not cross pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.pieces: dict[str, int] = {}
        # The pattern above stands for the rules of one file; others are left to the library.
        self.plain = _PIECE.findall(_PROBE.lower()) == self.library_pre_tokens(_PROBE)

    def library_pre_tokens(self, text: str) -> list[str]:
        normalizer = self.tokenizer.normalizer
        normal = normalizer.normalize_str(text) if normalizer is not None else text
        if self.tokenizer.pre_tokenizer is None:
            return [normal] if normal else []
        return [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def pre_tokens(self, text: str) -> list[str]:
        if self.plain and _SIMPLE.fullmatch(text):
            return _PIECE.findall(text.lower())
        return self.library_pre_tokens(text)

    def frequencies(self, text: str) -> tuple[int, Counter]:
        """Number of special tokens, and pre-token frequencies of the rest."""
        if self.special is None or "<" not in text:
            return 0, Counter(self.pre_tokens(text))
        parts = self.special.split(text)
        found = Counter()
        for part in parts:
            found.update(self.pre_tokens(part))
        return len(parts) - 1, found

    def counts(self, texts: list[str]) -> list[int]:
        tables = [self.frequencies(t) for t in texts]
        unknown = list({w for _, table in tables for w in table if w not in self.pieces})
        if len(self.pieces) + len(unknown) > KEPT:
            self.pieces.clear()
            unknown = list({w for _, table in tables for w in table})
        for at in range(0, len(unknown), 10_000):
            part = unknown[at : at + 10_000]
            for word, encoded in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.pieces[word] = len(encoded)
        pieces = self.pieces
        return [special + sum(n * pieces[w] for w, n in table.items()) for special, table in tables]


_counters: dict[str, PieceCounter] = {}


def _count(batches, path):
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    counter = _counters[path]
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def flush():
        tokens = counter.counts([t.decode() for t in texts])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64())], schema=schema
        )

    ids, texts, held = [], [], 0
    for doc_id, text in rows_of(batches, "doc_id", "text"):
        ids.append(doc_id)
        texts.append(text or b"")
        held += len(texts[-1])
        if held >= _BLOCK_BYTES:
            yield flush()
            ids, texts, held = [], [], 0
    if ids:
        yield flush()


def token_counts(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 2048) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every row.

    ``tokenizer_path`` names a tokenizer file that every executor can read. A null text counts as empty, with
    no tokens. Strings of special tokens inside a text count as the library counts them, one each. Repeated
    rows repeat the result, a null id stays null, other columns are ignored, an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    counted = rows.mapInArrow(lambda b: _count(b, tokenizer_path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
