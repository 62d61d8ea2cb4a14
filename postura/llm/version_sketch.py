"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraph pieces.

A text's paragraphs, cut further at sentence ends and after ``PIECE_CHARS`` characters, are hashed
together with their occurrence number.  Each digest is added to one cell of each third of a sketch:
the cell counts, and XORs digests and their checks.  Two sketches of one size subtract cell by cell
to a sketch of just the differences, and peeling cells that hold a single digest recovers these.  If
peeling gets stuck, both texts are sketched again with four times the cells and other places.  The
likeness of two texts is one minus the recovered digests' share of all digests of both.

Null text counts as empty.  Two empty texts are alike (1).  Equal texts have equal fingerprints.
Texts of one piece that differ are unlike (0).  Documents follow each other by descending id, a null
id last, repeated ids by a hash of their text; ids are taken to be nearly unique.  A table of one
document is followed by itself; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from postura.llm.common import id_and_text, pieces, struct_type

#: Cells of the sketch that is the fingerprint; a multiple of three.
CELLS = 24
GROWTH = 4
PIECE_CHARS = 24
#: Text bytes that one range of ids should hold, and the most ranges.
RANGE_BYTES, MOST_RANGES = 6 << 20, 8192
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_PIECE = re.compile(rf"[^\n.!?]{{1,{PIECE_CHARS}}}[\n.!?]*|[\n.!?]+")


def digests(text: str) -> np.ndarray:
    """Distinct 64-bit digests of a text's pieces and their occurrence numbers."""
    found = np.fromiter(map(xxhash.xxh64_intdigest, _PIECE.findall(text)), np.uint64)
    order = np.argsort(found, kind="stable")
    placed = found[order]
    starts = np.r_[True, placed[1:] != placed[:-1]][: len(placed)]
    at = np.arange(len(placed))
    occurrence = at - np.maximum.accumulate(np.where(starts, at, 0)) if len(placed) else at
    return mixed(placed + occurrence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1)


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = x ^ np.uint64(seed * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Sketches:
    """Sketches of many texts side by side, ``m`` cells each."""

    def __init__(self, texts: int, m: int, seed: int = 0):
        self.m, self.seed = m, seed
        self.count = np.zeros(texts * m, np.int64)
        self.key = np.zeros(texts * m, np.uint64)
        self.check = np.zeros(texts * m, np.uint64)

    def places(self, text: np.ndarray, key: np.ndarray) -> list[np.ndarray]:
        third = self.m // 3
        return [
            text * self.m + j * third + (mixed(key, 3 * self.seed + j + 2) % np.uint64(third)).astype(np.int64)
            for j in range(3)
        ]

    def add(self, text: np.ndarray, key: np.ndarray, sign: np.ndarray | int = 1) -> None:
        check = mixed(key, 0)
        for at in self.places(text, key):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, key)
            np.bitwise_xor.at(self.check, at, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.m, self.seed)
        out.count, out.key, out.check = self.count - other.count, self.key ^ other.key, self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Whether each sketch came out empty, and the texts, digests and signs recovered."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            pure = (np.abs(self.count) == 1) & (mixed(self.key, 0) == self.check)
            at = np.flatnonzero(pure)
            if not len(at):
                break
            key, text = self.key[at], at // self.m
            first, second, third = self.places(text, key)
            # A digest alone in several cells is taken once, from the first of them.
            once = (at == first) | ((at == second) & ~pure[first]) | ((at == third) & ~pure[first] & ~pure[second])
            if not once.any():
                break
            sign = self.count[at][once]
            found.append((text[once], key[once], sign))
            self.add(text[once], key[once], -sign)
        empty = ~((self.count != 0) | (self.key != 0)).reshape(-1, self.m).any(axis=1)
        if not found:
            none = np.zeros(0, np.int64)
            return empty, none, none.astype(np.uint64), none
        return empty, *map(np.concatenate, zip(*found, strict=True))

    def strings(self, sizes: list[int]) -> list[str]:
        """Number of digests, then all cells (count, digests, checks)."""
        cells = np.zeros(len(self.count), [("n", "<i4"), ("key", "<u8"), ("check", "<u4")])
        cells["n"], cells["key"], cells["check"] = self.count, self.key, self.check & np.uint64(0xFFFFFFFF)
        data, step = cells.tobytes(), cells.itemsize * self.m
        return [f"{n}:{base64.b64encode(data[k * step : (k + 1) * step]).decode()}" for k, n in enumerate(sizes)]


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    text = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return text, np.concatenate(sets) if sets else np.zeros(0, np.uint64)


def sketch(sets: list[np.ndarray], m: int, seed: int = 0) -> Sketches:
    out = Sketches(len(sets), m, seed)
    out.add(*_flat(sets))
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> list[int]:
    """How many digests only one of ``a[k]``, ``b[k]`` has, recovered by peeling."""
    out = [0] * len(a)
    left, m, seed = list(range(len(a))), cells, 0
    while left:
        apart = sketch([a[k] for k in left], m, seed).minus(sketch([b[k] for k in left], m, seed))
        empty, text, _, _ = apart.peel()
        recovered = np.bincount(text.astype(np.int64), minlength=len(left))
        for k, done, n in zip(left, empty.tolist(), recovered.tolist(), strict=True):
            if done:
                out[k] = n
        left = [k for k, done in zip(left, empty.tolist(), strict=True) if not done]
        m, seed = m * GROWTH, seed + 1
        for k in [k for k in left if m > 64 * (len(a[k]) + len(b[k]) + cells)]:  # bound on hash mishaps
            out[k] = len(np.setxor1d(a[k], b[k]))
            left.remove(k)
    return out


def likeness(a: list[np.ndarray], b: list[np.ndarray]) -> list[float]:
    apart = differences(a, b)
    return [1 - d / (len(x) + len(y)) if len(x) + len(y) else 1.0 for d, x, y in zip(apart, a, b, strict=True)]


def edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _judge(ids: list, texts: list[str], following: list[str]) -> dict:
    """One row for each text but, where ``following`` is given for it, the last."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    own, new = [digests(t) for t in texts], [digests(t) for t in changed]
    # The next document is the next row as a rule, so its digests are there already.
    after = [own[k + 1] if k + 1 < len(texts) and f is texts[k + 1] else digests(f) for k, f in enumerate(following)]
    return {
        "doc_id": ids,
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": sketch(own, CELLS).strings([len(s) for s in own]),
        "edited_fingerprint": sketch(new, CELLS).strings([len(s) for s in new]),
        "near_edited": likeness(own, new),
        "near_next": likeness(own, after),
    }


def _walk(fields: pa.Schema):
    """Rows in order; each waits for the next of its range.  Copies of a next range's first row end a range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            for part in pieces(batch):
                ids, texts, following = [], [], []
                for row in zip(*(part[c].to_pylist() for c in ("range", "halo", "doc_id", "text")), strict=True):
                    if waiting is not None and waiting[0] == row[0] and not waiting[1]:
                        ids.append(waiting[2])
                        texts.append(waiting[3])
                        following.append(row[3])
                    waiting = row
                if ids:
                    columns = _judge(ids, texts, following)
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in fields], schema=fields)

    return run


def _range_of(key, bounds: list[int]):
    """How many of the falling ``bounds`` are at or above ``key``: a search by halving."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in range(len(bounds).bit_length() - 1, -1, -1)]
    held = F.lit(bounds)

    def step(low, width):
        there = F.get(held, low + width - 1)  # null beyond the end
        return F.when(there >= key, low + width).otherwise(low)

    return F.aggregate(F.lit(steps), F.lit(0), step)


def compare_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``SCHEMA`` of every document.

    Texts are shuffled once, by ranges of ids; the first row of each range is also sent to the range
    before, whose last row it follows.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key")
    )
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    wanted = min(MOST_RANGES, max(1, size // RANGE_BYTES))
    bounds: list[int] = []
    if wanted > 1:
        shares = [k / wanted for k in range(1, wanted)]
        bounds = sorted(set(rows.agg(F.percentile_approx("key", shares, 20 * wanted)).first()[0]), reverse=True)
    placed = rows.withColumn("range", _range_of(F.col("key"), bounds))
    firsts = sorted(tuple(r) for r in placed.groupBy("range").agg(F.max("key")).collect())  # a row a range
    if not firsts:
        return spark.createDataFrame([], struct_type(SCHEMA))
    before = [(key, firsts[k - 1][0]) for k, (_, key) in enumerate(firsts)]
    halo = F.broadcast(spark.createDataFrame(before, "key long, sent_to int"))  # at most MOST_RANGES rows
    here = F.struct(F.col("range").alias("range"), F.lit(0).alias("halo"))
    there = F.struct(F.col("sent_to").alias("range"), F.lit(1).alias("halo"))
    sent = placed.join(halo, "key", "left").select(
        "doc_id",
        "key",
        "text",
        F.xxhash64("text").alias("tie"),
        F.explode(F.when(F.col("sent_to").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("at"),
    )
    dealt = (
        sent.select("at.range", "at.halo", "doc_id", "key", "tie", "text")
        .repartition(len(firsts), "range")
        .sortWithinPartitions("range", "halo", F.desc("key"), "tie")
    )
    return dealt.select("range", "halo", "doc_id", "text").mapInArrow(_walk(to_arrow_schema(struct_type(SCHEMA))), SCHEMA)
