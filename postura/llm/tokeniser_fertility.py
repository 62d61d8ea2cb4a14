"""Quality rules from tokeniser fertility: rejection bands per language, or per script without one.

Public vocabularies show how foreign a text is to them: characters per token (two vocabularies), the
share of tokens that fall back to single bytes, and the entropy of the text's tokens relative to the
largest its length allows.  Bands around the quartiles of each group of documents, counted over all of
them, reject what lies outside, by as many interquartile ranges as ``REACH`` allows for each metric on
either side: text whose words fall into more pieces than its language's do is the commonest junk.  A
group is a language and length class; one of under ``LEAST_DOCS`` documents takes the bands of the
language over all lengths, then those of its script, and rejects nothing only where the script is as
rare.  A few plain rules come first.

Null text counts as empty: no words, so it fails the plain rules.  A null language is its script.  Texts
of under ``LEAST_TOKENS`` tokens pass, as so few say too little.  Quartiles of ties are their value; a
value on the edge of a band is inside.  Rows are judged one by one, so repeats get equal results; an
empty table gives an empty result; very long texts are read whole.  Columns of other names are ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.llm.common import map_columns, stored
from postura.llm.word_bpe import Encoder, Vocabulary, _Remembering, library_words

PIECE_FILE = "piece_bpe_32k.model"
LEAST_DOCS = 30
#: Interquartile ranges below and above the quartiles, and the least range as a share of the median.
REACH = {"piece_chars": (3.0, 4.0), "word_chars_per_token": (2.5, 4.0), "byte_share": (4.0, 4.0), "entropy": (4.0, 4.0)}
LEAST_RANGE, LEAST_WIDTH = 0.01, 0.005
#: Below so many tokens a text says too little about its fertility.
LEAST_TOKENS = 32
METRICS = tuple(REACH)

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "language string, script string, size_class int, n_tokens long, piece_chars double, word_chars_per_token double, "
    "byte_share double, entropy double"
)


#: Characters of which all letters are Latin ones.
_LATIN = re.compile("[\x00-\xa9\xab-\xb4\xb6-\xb9\xbb-\u024f]*")
_LETTERS = "etaoinshrdlcumwfgypbvkjxqzETAOINSHRDLCUMWFGYPBVKJXQZ"


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words in windows of ``width`` words that the list holds twice or more."""
    n = len(words)
    if n <= width:
        return 0
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    base = len(number)
    if base**width < 1 << 62:
        key = np.zeros(n - width + 1, np.int64)
        for k in range(width):
            key = key * base + ids[k : n - width + 1 + k]
    else:  # number the prefixes instead, one word longer each time
        key = ids[: n - width + 1]
        for k in range(1, width):
            key = np.unique(key * base + ids[k : n - width + 1 + k], return_inverse=True)[1]
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[place] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script of most letters, as the first word of their names; ``none`` without letters."""
    if _LATIN.fullmatch(text) and any(map(text.__contains__, _LETTERS)):
        return "LATIN"
    found: Counter[str] = Counter()
    for char, n in Counter(text).items():
        if char.isalpha():
            found[unicodedata.name(char, "OTHER").split()[0].split("-")[0]] += n
    return min(found, key=lambda s: (-found[s], s)) if found else "none"


class Fertility:
    def __init__(self):
        self.word = Encoder(v := Vocabulary(), library_words(v))
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE_FILE))
        size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(size)])
        self.runs = _Remembering(self._run, 250_000)

    def _run(self, run: str) -> bytes:
        ids = self.pieces.encode(run)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str, chars: int) -> tuple:
        """Tokens, characters per token by either vocabulary, byte share, relative entropy."""
        ids = np.frombuffer(b"".join(map(self.runs.__getitem__, text.split())), "<u4")
        words = len(self.word.encode(text)) // 4
        if not len(ids) or not words:
            return len(ids), None, None, None, None
        count = np.bincount(ids)
        count = count[count > 0] / len(ids)
        entropy = float(-(count * np.log2(count)).sum() / np.log2(len(ids))) if len(ids) > 1 else 0.0
        return len(ids), chars / len(ids), chars / words, float(self.is_byte[ids].mean()), entropy


def measure(docs: DataFrame) -> DataFrame:
    """``MEASURES`` of ``docs (doc_id, text, lang)``, without a shuffle."""

    def make():
        fertility = Fertility()

        def work(b: pa.RecordBatch) -> dict:
            rows = []
            for doc_id, text, lang in zip(*(b[c].to_pylist() for c in ("doc_id", "text", "lang")), strict=True):
                text = text or ""
                words = text.encode().split()  # of bytes: at ASCII white space only
                chars = len(text) - sum(map(text.count, SPACES))
                n, *metrics = fertility(text, chars)
                rows.append(
                    (
                        doc_id,
                        len(words),
                        chars,
                        sum(map(text.count, SYMBOLS)),
                        repeated_lines(text),
                        repeated_words(words),
                        lang if lang is not None else f"script {(script := script_of(text))}",
                        script if lang is None else script_of(text),
                        min(len(str(n)), 6),
                        n,
                        *metrics,
                    )
                )
            names = [part.split()[0] for part in MEASURES.split(", ")]
            return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in names}

        return work

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    return map_columns(wanted, make, MEASURES)


def bands(measures: DataFrame, *group: str) -> DataFrame:
    """``group`` and each metric's lowest and highest accepted value, as ``low_`` and ``high_``."""
    telling = measures.filter(F.col("n_tokens") >= LEAST_TOKENS)
    quartiles = telling.groupBy(*group).agg(
        F.count("*").alias("n_docs"),
        *[F.percentile_approx(m, [0.25, 0.5, 0.75], 2000).alias(m) for m in METRICS],
    )
    edges = []
    for m, (below, above) in REACH.items():
        low, mid, high = (F.col(m)[k] for k in range(3))
        width = F.greatest(high - low, LEAST_RANGE * mid, F.lit(LEAST_WIDTH))
        edges += [F.struct((low - below * width).alias("low"), (high + above * width).alias("high")).alias(m)]
    return quartiles.filter(F.col("n_docs") >= LEAST_DOCS).select(*group, F.struct(*edges).alias("band"))


def judge(docs: DataFrame) -> DataFrame:
    """The plain measures, ``base_failed``, ``kept``, and the fertility that decided."""
    measures = stored(measure(docs), "measures")
    judged, found = measures, []
    for k, group in enumerate((("language", "size_class"), ("language",), ("script",))):
        limits = stored(bands(measures, *group), "bands").withColumnRenamed("band", f"band{k}")
        judged = judged.join(limits, list(group), "left")  # of known size, so Spark chooses how
        found.append(F.col(f"band{k}"))
    band = F.coalesce(*found)
    inside = F.lit(True)
    for m in METRICS:
        inside &= F.coalesce(F.col(m).between(band[m]["low"], band[m]["high"]), F.lit(True))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ((F.col("n_tokens") < LEAST_TOKENS) | inside)).alias("kept"),
        "n_tokens",
        *METRICS,
    )
