"""Language identification by inferring each document's mixture of languages.

A language is a distribution over hashed character trigrams, counted over all learning documents.  A
document is a mixture of languages; expectation-maximisation finds the proportions, and languages
are dropped one by one while the likelihood, less a penalty for each language, does not fall.  The
prediction is the language with the largest proportion of the remaining set, the score its share.

A text is of one of the learned languages at all if its mixture explains a trigram better, by
``MARGIN`` bits on average, than a background that holds every trigram for equally likely: nonsense
and other scripts are not.  The prediction names the nearest language all the same; ``keep_identified``
keeps by this.  Trigrams that no learning text has are drawn from the background, in a share of ``UNSEEN``.

A null text, or one without a letter, is ``und`` with score 0; so is every document if nothing can
be learned (an empty table, or no labelled text).  Ties between languages go to the first in
alphabetical order.  Rows are judged one by one: repeats get equal results, nothing is shuffled but
the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.llm.common import held_out, keep_rows, map_columns, pieces

BUCKETS = 1 << 15
#: Added to each count.
SMOOTHING = 0.5
UNKNOWN = "und"
#: A trigram overlaps its neighbours, so three count as one observation.
OVERLAP = 3
ITERATIONS, CLOSE = 25, 1e-3
#: Characters hashed at once, for very long texts.
CHUNK = 1 << 20
#: Bits a trigram that a document must gain on the background to be kept, and the background's share.
MARGIN, UNSEEN = 1.0, 0.01

_LETTER = regex.compile(r"\p{L}")
_SYMBOL = regex.compile(r"[^\p{L}\p{M}\p{N}\s]")


class Trigrams:
    """Counts of a text's hashed trigrams, those around a letter; other characters are a blank."""

    def __init__(self):
        self.letter = np.array([chr(c).isalpha() for c in range(1 << 16)])

    def __call__(self, text: str) -> np.ndarray:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        padded = f" {text} ".lower()
        for at in range(0, len(padded), CHUNK):
            code = np.frombuffer(padded[at : at + CHUNK + 2].encode("utf-32-le", "replace"), "<u4")
            letter = self.letter[np.minimum(code, 0xFFFF)] | (code > 0xFFFF)
            code = np.where(letter, code, 32).astype(np.uint32)
            mixed = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA6B) + code[2:] * np.uint32(0xC2B2AE35)
            mixed ^= mixed >> np.uint32(15)
            counts += np.bincount((mixed * np.uint32(0x27D4EB2F) >> np.uint32(17))[letter[1:-1]], minlength=BUCKETS)
        return counts


@dataclass
class Languages:
    """``likelihood[bucket, language]``, each row divided by its largest value, and these values."""

    names: list[str]
    likelihood: np.ndarray
    largest: np.ndarray | None = None

    def gain(self, counts: np.ndarray, symbols: int = 0) -> float:
        """Bits a trigram by which the mixture explains a text better than the background; 0 without trigrams.

        Symbols are trigrams that both explain alike.
        """
        used = np.flatnonzero(counts)
        found = dict(self.mixture(counts))
        if not found:
            return 0.0
        share = np.array([found.get(name, 0.0) for name in self.names])
        largest = np.ones(BUCKETS) if self.largest is None else self.largest
        explained = (1 - UNSEEN) * (self.likelihood[used] @ share) * largest[used] + UNSEEN / BUCKETS
        return float(counts[used] @ np.log2(explained * BUCKETS) / (counts[used].sum() + symbols))

    def mixture(self, counts: np.ndarray) -> list[tuple[str, float]]:
        """The chosen languages and their proportions, largest first."""
        used = np.flatnonzero(counts)
        if not len(used) or not self.names:
            return []
        c, q = counts[used].astype(float), self.likelihood[used]
        total = c.sum()
        penalty = 0.5 * np.log(max(2.0, total / OVERLAP))
        chosen = np.arange(len(self.names))
        share, fit = _proportions(c, q, np.full(len(chosen), 1 / len(chosen)), total)
        while len(chosen) > 1:
            stay = np.arange(len(chosen)) != len(chosen) - 1 - int(np.argmin(share[::-1]))
            start = np.maximum(share[stay], 1e-6)
            fewer, its_fit = _proportions(c, q[:, chosen[stay]], start / start.sum(), total)
            if its_fit / OVERLAP < fit / OVERLAP - penalty:
                break
            chosen, share, fit = chosen[stay], fewer, its_fit
        return sorted(((self.names[k], float(s)) for k, s in zip(chosen, share, strict=True)), key=lambda x: (-x[1], x[0]))


def _proportions(c: np.ndarray, q: np.ndarray, share: np.ndarray, total: float) -> tuple[np.ndarray, float]:
    """Expectation-maximisation, and the log likelihood it reaches."""
    if len(share) > 1:
        for _ in range(ITERATIONS):
            new = share * ((c / (q @ share)) @ q) / total
            near = np.abs(new - share).max() < CLOSE
            share = new
            if near:
                break
    return share, float(c @ np.log(q @ share))


def learn(docs: DataFrame) -> Languages:
    """From all rows of ``docs (text, lang)`` with both values."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, held = Trigrams(), {}

        def flush():
            for lang, counts in held.items():
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used.astype("i4")), pa.array(counts[used])],
                    ["lang", "bucket", "n"],
                )
            held.clear()

        for batch in batches:
            for part in pieces(batch):
                for text, lang in zip(part["text"].to_pylist(), part["lang"].to_pylist(), strict=True):
                    if lang not in held and len(held) == 64:
                        yield from flush()
                    held[lang] = held.get(lang, 0) + trigrams(text)
        yield from flush()

    found = (
        docs.filter("text is not null and lang is not null")
        .select("text", "lang")
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most BUCKETS rows a language
    )
    names = sorted(found["lang"].unique())
    place = {name: k for k, name in enumerate(names)}
    counts = np.full((BUCKETS, len(names)), SMOOTHING)
    counts[found["bucket"].to_numpy("i8"), found["lang"].map(place).to_numpy("i8")] += found["n"].to_numpy("f8")
    share = counts / counts.sum(axis=0)
    largest = share.max(axis=1, keepdims=True) if names else np.ones((BUCKETS, 1))
    return Languages(names, share / largest, largest[:, 0])


class Judge:
    def __init__(self, model: Languages):
        self.model, self.trigrams = model, Trigrams()

    def __call__(self, text: str | None) -> list[tuple[str, float]]:
        if text is None or not _LETTER.search(text):
            return []
        return self.model.mixture(self.trigrams(text))

    def gain(self, text: str | None) -> float:
        if text is None or not _LETTER.search(text):
            return 0.0
        return self.model.gain(self.trigrams(text), len(_SYMBOL.findall(text)))


def predict(docs: DataFrame, model: Languages) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages`` of ``docs (doc_id, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language

    def make():
        judge = Judge(sent.value)

        def work(b: pa.RecordBatch) -> dict:
            found = [judge(t) for t in b["text"].to_pylist()]
            return {
                "doc_id": b["doc_id"],
                "held_out": b["held_out"],
                "lang_pred": [m[0][0] if m else UNKNOWN for m in found],
                "score": [min(1.0, m[0][1]) if m else 0.0 for m in found],
                "languages": [",".join(f"{n}:{s:.3f}" for n, s in m) for m in found],
            }

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (held_out(F.col("doc_id")) == 0).alias("held_out"))
    return map_columns(rows, make, "doc_id long, held_out boolean, lang_pred string, score double, languages string")


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(held_out(F.col("doc_id")) != 0)


def keep_identified(docs: DataFrame, model: Languages, margin: float = MARGIN) -> DataFrame:
    """The rows whose text is of one of the learned languages, or of several."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        judge = Judge(sent.value)
        return lambda b: [judge.gain(t) >= margin for t in b["text"].to_pylist()]

    return keep_rows(docs, make)
