"""Quality and toxicity from weak labels.

Overlapping heuristics vote on each document: for, against, or not at all.  Expectation-maximisation
estimates from the counts of vote patterns, over all documents, how often each heuristic votes what
in either class, and so the posterior of each pattern.  Posterior labels of a bounded sample of
documents train a linear scorer on hashed words, word beginnings, shapes and votes, which scores every
document.  Quality heuristics look at symbols, capitals, repetition, lists and sentence ends; toxicity
heuristics at words and word beginnings that nearly only toxic rows of ``labels`` use.

Bounds: ``LABELLED`` labelled rows give the word lists, ``TRAINED`` documents at most train the scorer, and
lists hold ``LISTED`` entries at most.  Votes, patterns and scores cover all documents.

Null text counts as empty.  A text without a word has quality 0 and is not kept.  Without labels no
word is listed and no document is toxic.  Repeated rows get equal scores; an empty table gives an
empty result; very long texts are read whole.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from postura.llm.common import keep_rows, map_columns, pieces, struct_type
from postura.llm.word_bpe import _Remembering

LABELLED, TRAINED, LISTED = 20_000, 6_000, 5_000
DIMENSIONS = 1 << 17
#: A listed word occurs in so many toxic sample rows at least, in this share of all of them, and this
#: share of its rows is toxic.
LEAST_ROWS, LEAST_SHARE, LEAST_PRECISION = 5, 0.01, 0.9
EPOCHS, RATE, SHRINK = 12, 0.2, 1e-5

FOR, AGAINST, NONE = "+", "-", "0"
#: Lists are of whole words and of beginnings of so many letters.
BEGINNINGS = (3, 4, 5, 6, 7)
_WORD = re.compile(r"[^\W\d_]{3,}")
SYMBOLS = "#*$%&|<>=^~{}[]\\"


def _vote(value: float, good: float, bad: float) -> str:
    """For at most ``good``, against from ``bad`` on."""
    return FOR if value <= good else AGAINST if value >= bad else NONE


def quality_votes(text: str) -> str:
    """A character for each heuristic."""
    words = text.split()
    n = len(words)
    if n < 8:
        return NONE * 8
    different = len(set(words))
    lines = [x for x in text.split("\n") if x.strip()]
    ends = sum(map(text.count, ".?!\n")) + 1
    twice = sum(map(eq, words, words[1:]))
    return "".join(
        (
            _vote(sum(map(text.count, SYMBOLS)) / n, 0.02, 0.15),
            _vote(sum(map(str.isupper, words)) / n, 0.1, 0.4),
            _vote(text.count("!!") / n, 0.005, 0.1),
            _vote(1 - different / n, 0.55, 0.85) if n < 400 else _vote(n / different, 5, 12),
            _vote(text.count(" | ") / n, 0.005, 0.05),
            _vote(1 - len(set(lines)) / len(lines), 0.1, 0.4) if len(lines) > 3 else NONE,
            _vote(n / ends, 25, 80),
            _vote(twice / n, 0.02, 0.2),
        )
    )


def terms_of(run: str) -> list[tuple[int, str]]:
    """Of a run between white space: its words, and the beginnings of longer words, by list."""
    return [t for w in _WORD.findall(run) for t in ((0, w), *((k, w[:k]) for k in BEGINNINGS if len(w) > k))]


class Lists:
    """Listed words and word beginnings, looked for in one walk over a text."""

    def __init__(self, terms: set[tuple[int, str]] = frozenset()):
        self.__setstate__(terms)

    def __getstate__(self) -> set[tuple[int, str]]:
        return self.terms

    def __setstate__(self, terms: set[tuple[int, str]]) -> None:
        self.terms = terms
        self.walk = ahocorasick.Automaton()
        for _, term in terms:
            self.walk.add_word(term, term)
        self.walk.make_automaton()

    def votes(self, low: str) -> str:
        """A character for each list: how many of it the lower-case text has, 2 for more."""
        hit = set()
        if self.terms:
            for end, term in self.walk.iter(low):
                start = end + 1 - len(term)
                if (start and low[start - 1].isalpha()) or not term:
                    continue
                longer = end + 1 < len(low) and low[end + 1].isalpha()
                found = (len(term) if longer else 0, term)
                if found in self.terms:
                    hit.add(found)
        return "".join(str(min(2, sum(kind == k for kind, _ in hit))) for k in (0, *BEGINNINGS))


def posterior(
    patterns: dict[str, int],
    start: dict[str, list[float]],
    missing: str = "",
    known: dict[str, list[int]] | None = None,
    rounds: int = 60,
) -> dict[str, float]:
    """The probability of the first class for each pattern, by expectation-maximisation.

    ``start`` gives the first guess of all classes, ``missing`` the character of no vote, which says
    nothing.  A vote's chance in each class is estimated from all documents; heuristics are taken to
    be independent within a class, so what fails in several ways needs a class for each way.
    """
    names = sorted(patterns)
    if not names:
        return {}
    n = np.array([patterns[p] for p in names], float)
    kinds = sorted({c for p in names for c in p})
    votes = np.array([[kinds.index(c) for c in p] for p in names])
    there = np.array([[c != missing for c in p] for p in names])
    share = np.array([start[p] for p in names])
    heuristics = np.arange(votes.shape[1])
    sure = np.array([(known or {}).get(p, [0] * share.shape[1]) for p in names], float)
    for _ in range(rounds):
        chance = np.empty_like(share)
        for k, weight in enumerate((share * n[:, None] + sure).T):
            table = np.full((len(heuristics), len(kinds)), 0.1)
            for h in heuristics:
                table[h] += np.bincount(votes[:, h], weights=weight * there[:, h], minlength=len(kinds))
            table /= table.sum(axis=1, keepdims=True)
            prior = (weight.sum() + 1) / (n.sum() + sure.sum() + share.shape[1])
            chance[:, k] = np.log(prior) + (np.log(table[heuristics, votes]) * there).sum(axis=1)
        new = np.exp(chance - chance.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        near = np.abs(new - share).max() < 1e-6
        share = new
        if near:
            break
    return dict(zip(names, share[:, 0].tolist(), strict=True))


def first_guess(pattern: str) -> list[float]:
    """Good, or bad in the way of each heuristic that votes against."""
    against = [c == AGAINST for c in pattern]
    if not any(against):
        return [0.95, *[0.05 / len(pattern)] * len(pattern)]
    return [0.05, *[0.95 * x / sum(against) for x in against]]


def toxic_kind(pattern: str) -> int:
    """Toxic by whole words alone (1), or by beginnings too (2)."""
    return 2 if pattern[1:].strip("0") else 1


def _places(terms: list[tuple[int, bytes]]) -> bytes:
    return struct.pack(f"<{len(terms)}i", *[zlib.crc32(t, kind) % DIMENSIONS for kind, t in terms])


class Features:
    """Places of a text's features among ``DIMENSIONS``, each once."""

    def __init__(self):
        self.runs = _Remembering(lambda run: _places([(k, t.encode()) for k, t in terms_of(run)]))
        self.votes = _Remembering(lambda vote: _places([(100 + r, vote.encode()) for r in range(4)]))

    def __call__(self, low: str, votes: str, toxic: str) -> np.ndarray:
        # Votes tell much more than a word, so each has several places; no vote has none.
        named = [f"vote {k} {c}" for k, c in enumerate(votes) if c != NONE]
        named += [f"listed {k} {c}" for k, c in enumerate(toxic)]
        found = b"".join([*map(self.runs.__getitem__, set(low.split())), *map(self.votes.__getitem__, named)])
        return np.unique(np.frombuffer(found, "<i4"))


@dataclass
class Model:
    lists: Lists
    quality: dict[str, float]
    toxic: dict[str, float]
    weights: np.ndarray  # quality, toxic

    def score(self, features: Features, text: str) -> tuple[float, float, str, str]:
        """Quality, toxicity, and the votes."""
        low = text.lower()
        votes, toxic = quality_votes(text), self.lists.votes(low)
        at = features(low, votes, toxic)
        total = self.weights[:, at].sum(axis=1) / np.sqrt(len(at)) + self.weights[:, -1]
        quality, bad = (1 / (1 + np.exp(-np.clip(total, -50, 50)))).tolist()
        return quality, bad if self.lists.terms else 0.0, votes, toxic


def _counted(df: DataFrame, tally, schema: str) -> DataFrame:
    """Rows of a counter that each task fills with ``tally(part, counter)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            rows = [(*key, n) for key, n in counts.items()]
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
            out = pa.RecordBatch.from_arrays(columns, schema=fields)
            counts.clear()
            return out

        for batch in batches:
            for part in pieces(batch):
                tally(part, counts)
                if len(counts) > 200_000:
                    yield flush()
        if counts:
            yield flush()

    fields = to_arrow_schema(struct_type(schema))
    return df.mapInArrow(run, schema)


def labelled_sample(labels: DataFrame, rows: int = LABELLED) -> dict[int, int]:
    """Toxic or not by id, of labelled rows in hash order, as many as the bound allows."""
    found = (
        labels.filter("doc_id is not null and toxic is not null")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(rows)
        .collect()
    )
    return dict(map(tuple, found))


def learn_lists(docs: DataFrame, sample: dict[int, int]) -> Lists:
    """Words and beginnings that nearly only toxic rows of the sample use."""
    if not sample:
        return Lists()
    sent = docs.sparkSession.sparkContext.broadcast(sample)  # LABELLED rows at most

    def tally(part: pa.RecordBatch, counts: Counter) -> None:
        for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
            toxic = sent.value.get(doc_id)
            if toxic is not None and text:
                counts.update((*t, toxic) for t in {t for run in set(text.lower().split()) for t in terms_of(run)})

    found = (
        _counted(docs.select("doc_id", "text"), tally, "kind int, term string, toxic int, n long")
        .groupBy("kind", "term")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
            F.sum("n").alias("n"),
        )
        .filter((F.col("bad") >= max(LEAST_ROWS, LEAST_SHARE * sum(sample.values()))) & (F.col("bad") >= LEAST_PRECISION * F.col("n")))
        .orderBy(F.desc("bad"), "kind", "term")
        .limit(LISTED)
        .collect()
    )
    return Lists({(r["kind"], r["term"]) for r in found})


def count_patterns(docs: DataFrame, lists: Lists, sample: dict[int, int]) -> list[tuple[str, str, int, int]]:
    """Quality and toxicity pattern, whether known to be toxic (else -1), and how many documents have them.

    There are 3 ** 14 patterns at most, few of which occur.
    """
    sent = docs.sparkSession.sparkContext.broadcast((lists, sample))

    def tally(part: pa.RecordBatch, counts: Counter) -> None:
        own, known = sent.value
        for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
            counts[quality_votes(text or ""), own.votes((text or "").lower()), known.get(doc_id, -1)] += 1

    counted = _counted(docs.select("doc_id", "text"), tally, "quality string, toxic string, known int, n long")
    return [tuple(r) for r in counted.groupBy("quality", "toxic", "known").agg(F.sum("n")).collect()]


def fit(x: list[np.ndarray], y: np.ndarray, seed: int = 3) -> np.ndarray:
    """Logistic regression on soft labels by stochastic gradients with adaptive rates; the last weight is the bias."""
    weights, squares = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-8)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(x)):
            at, scale = x[k], 1 / np.sqrt(len(x[k]))
            p = 1 / (1 + np.exp(-np.clip(weights[at].sum() * scale + weights[-1], -50, 50)))
            step = p - y[k]
            slope = step * scale + SHRINK * weights[at]
            squares[at] += slope * slope
            weights[at] -= RATE * slope / np.sqrt(squares[at])
            squares[-1] += step * step
            weights[-1] -= RATE * step / np.sqrt(squares[-1])
    return weights


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = labelled_sample(labels)
    lists = learn_lists(docs, sample)
    patterns = count_patterns(docs, lists, sample)
    by_quality, by_toxic, known = Counter(), Counter(), {}
    for q, t, toxic, n in patterns:
        by_quality[q] += n
        by_toxic[t] += n * (toxic < 0)
        if toxic >= 0:
            known.setdefault(t, [0, 0, 0])[toxic_kind(t) if toxic else 0] += n
    good = posterior(by_quality, {p: first_guess(p) for p in by_quality}, NONE)
    chance = {p: (0.01, 0.3, 0.95)[min(2, sum(map(int, p)))] for p in by_toxic}
    guess = {p: [1 - x, *(x * (toxic_kind(p) == k) for k in (1, 2))] for p, x in chance.items()}
    bad = {p: 1 - x for p, x in posterior(by_toxic, guess, known=known).items()}
    # The first TRAINED documents in hash order, equal rows once; a share that surely holds them is looked at.
    share = 2 * TRAINED / max(1, sum(by_quality.values()))
    sent = docs.sparkSession.sparkContext.broadcast(lists)

    def make():
        features = Features()

        def work(b: pa.RecordBatch) -> dict:
            out: dict = {"quality": [], "toxic": [], "at": []}
            for text in b["text"].to_pylist():
                low = text.lower()
                q, t = quality_votes(text), sent.value.votes(low)
                for name, value in zip(out, (q, t, features(low, q, t).tobytes()), strict=True):
                    out[name].append(value)
            return out

        return work

    turn = F.xxhash64("doc_id", "text")
    chosen = docs.filter("text is not null").filter(F.pmod(turn, F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)))
    chosen = chosen.dropDuplicates(["doc_id", "text"]).orderBy(turn, "doc_id", "text").limit(TRAINED)
    rows = map_columns(chosen, make, "quality string, toxic string, at binary").collect()
    rows.sort(key=lambda r: (r["at"], r["quality"], r["toxic"]))
    x = [np.frombuffer(r["at"], "<i4") for r in rows]
    targets = [np.array([d[r[c]] for r in rows]) for d, c in ((good, "quality"), (bad, "toxic"))]
    return Model(lists, good, bad, np.stack([fit(x, y) for y in targets]))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, quality, toxic, quality_posterior, toxic_posterior, kept`` of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers and LISTED words

    def make():
        m, features = sent.value, Features()

        def work(b: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": b["doc_id"]}
            rows = []
            for text in b["text"].to_pylist():
                text = text or ""
                if not text.split():
                    rows.append((0.0, 0.0, 0.0, 0.0, False))
                    continue
                q, t, votes, listed = m.score(features, text)
                rows.append((q, t, m.quality[votes], m.toxic[listed], q >= 0.5 and t < 0.5))
            names = ("quality", "toxic", "quality_posterior", "toxic_posterior", "kept")
            return out | {n: [r[k] for r in rows] for k, n in enumerate(names)}

        return work

    schema = "doc_id long, quality double, toxic double, quality_posterior double, toxic_posterior double, kept boolean"
    return map_columns(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of good quality that are not toxic, all columns untouched."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m, features = sent.value, Features()

        def good(text: str | None) -> bool:
            if not text or not text.split():
                return False
            q, t, _, _ = m.score(features, text)
            return q >= 0.5 and t < 0.5

        return lambda b: [good(t) for t in b["text"].to_pylist()]

    return keep_rows(docs, make)


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
