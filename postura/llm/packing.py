"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most ``capacity``.  Pieces are dealt into shards of bounded
size, and each shard is packed on several islands that start from differently perturbed best-fit
packings.  A child takes whole well-filled bins from one parent, drops the bins of the other that
hold any of their pieces, and best-fits what was displaced.  Between epochs every island's best
packing moves on to the next island of its shard.  A shard stops early once it reaches the least
number of bins that its total length allows, as no packing is better.  Bins left open at the end are
emptied, and their pieces packed once more across shards.

Null text counts as empty: a document of the end token alone.  Very long texts are cut, whole; a
piece of full length is a sequence of its own.  Repeated rows are packed as often as they occur
(pieces are told apart by their place in the checkpointed table, never by their id).  An empty table
gives an empty result.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura.llm.common import checkpointed, crc32, id_and_text, map_columns
from postura.llm.word_bpe import FILE, Encoder, Vocabulary, library_words

CAPACITY = 4096
END_ID = 1
#: Pieces in a shard, on average; islands a shard; packings an island; epochs, and children an epoch.
SHARD_ROWS, ISLANDS, PACKINGS, EPOCHS, CHILDREN = 2048, 2, 3, 2, 8
#: A bin below this share of the capacity is emptied for the last round.
OPEN = 0.98

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
STATE = "shard long, island int, bins int, square double, items binary, lengths binary, bin_of binary"
PLACES = "item long, sequence_id long, offset long, open boolean"


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, file: str = FILE) -> DataFrame:
    """``PIECES`` of every document: its ids, then the end id, cut where longer than ``capacity``."""

    def make():
        encoder = Encoder(v := Vocabulary(file), library_words(v))
        end = struct.pack("<I", END_ID)

        def work(b: pa.RecordBatch) -> dict:
            rows = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                data = encoder.encode(text) + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, crc32(part)))
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else {n: [] for n in names}

        return work

    return map_columns(id_and_text(docs), make, PIECES)


class Packing:
    """Bins as lists of item numbers, with their fill."""

    def __init__(self, bins: list[list[int]], fill: list[int]):
        self.bins, self.fill = bins, fill

    def rank(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones."""
        return len(self.bins), -float(np.square(np.array(self.fill, dtype=float)).sum())


def best_fit(packing: Packing, order: list[int], lengths: list[int], capacity: int) -> Packing:
    """``packing`` with the items of ``order`` each put where the least room is left."""
    bins, fill = packing.bins, packing.fill
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set while some bin has room r
    for b, f in enumerate(fill):
        if f < capacity:
            by_room.setdefault(capacity - f, []).append(b)
            rooms |= 1 << (capacity - f)
    for i in order:
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            held = by_room[room]
            b = held.pop()
            if not held:
                rooms &= ~(1 << room)
            bins[b].append(i)
            fill[b] += n
        else:
            b, room = len(bins), capacity
            bins.append([i])
            fill.append(n)
        if left := room - n:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return packing


def crossover(a: Packing, b: Packing, lengths: list[int], capacity: int, rng: np.random.Generator) -> Packing:
    """``a`` with well-filled bins of ``b`` injected whole."""
    fill = np.array(b.fill)
    well = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    taken = rng.choice(well, max(1, len(well) // int(rng.integers(2, 6))), replace=False).tolist()
    injected = {i for k in taken for i in b.bins[k]}
    bins, fills, displaced = [], [], []
    # The emptiest bin that stays is opened too, so that a child can end with fewer bins.
    emptiest = int(np.argmin(a.fill))
    for k, (items, f) in enumerate(zip(a.bins, a.fill, strict=True)):
        if k == emptiest or not injected.isdisjoint(items):
            displaced += [i for i in items if i not in injected]
        else:
            bins.append(list(items))
            fills.append(f)
    for k in taken:
        bins.append(list(b.bins[k]))
        fills.append(b.fill[k])
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(Packing(bins, fills), displaced, lengths, capacity)


def evolve(packings: list[Packing], lengths: list[int], capacity: int, rng: np.random.Generator) -> list[Packing]:
    """One epoch of an island: children replace the worst packing where they are better."""
    least = -(-sum(lengths) // capacity)
    n = np.array(lengths, dtype=float)
    while len(packings) < PACKINGS:
        if packings and min(p.rank()[0] for p in packings) == least:
            return packings
        stretch = 1.0 if not packings else 1 + 0.2 * rng.random(len(n))
        packings.append(best_fit(Packing([], []), np.argsort(-n * stretch, kind="stable").tolist(), lengths, capacity))
    packings.sort(key=Packing.rank)
    for _ in range(CHILDREN):
        if packings[0].rank()[0] == least:
            break
        i, j = rng.choice(len(packings), 2, replace=False)
        child = crossover(packings[i], packings[j], lengths, capacity, rng)
        if child.rank() < packings[-1].rank():
            packings[-1] = child
            packings.sort(key=Packing.rank)
    return packings


def _row(key: tuple, p: Packing, items: bytes, lengths: bytes, n: int) -> tuple:
    bin_of = np.empty(n, "<i4")
    for k, held in enumerate(p.bins):
        bin_of[held] = k
    bins, square = p.rank()
    return *key, bins, square, items, lengths, bin_of.tobytes()


def _unpacked(lengths: np.ndarray, bin_of: bytes) -> Packing:
    where = np.frombuffer(bin_of, "<i4")
    bins: list[list[int]] = [[] for _ in range(int(where.max()) + 1)]
    for i, b in enumerate(where.tolist()):
        bins[b].append(i)
    return Packing(bins, np.bincount(where, weights=lengths).astype(int).tolist())


def _first_epoch(capacity: int, seed: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("item")
        lengths = frame["length"].to_numpy("<i4")
        rng = np.random.default_rng([seed, 0, int(key[0]), int(key[1])])
        start = []
        if key[1]:  # islands but the first begin from a perturbed order
            order = np.argsort(-lengths * (1 + 0.2 * rng.random(len(lengths)))).tolist()
            start = [best_fit(Packing([], []), order, lengths.tolist(), capacity)]
        grown = evolve(start, lengths.tolist(), capacity, rng)
        items = frame["item"].to_numpy("<i8").tobytes()
        return pd.DataFrame(
            [_row(key, p, items, lengths.tobytes(), len(lengths)) for p in grown], columns=_names(STATE)
        )

    return run


def _next_epoch(capacity: int, seed: int, epoch: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bins", "square", "bin_of"])
        lengths = np.frombuffer(frame["lengths"].iloc[0], "<i4")
        rng = np.random.default_rng([seed, epoch, int(key[0]), int(key[1])])
        grown = evolve([_unpacked(lengths, x) for x in frame["bin_of"]], lengths.tolist(), capacity, rng)
        items = frame["items"].iloc[0]
        return pd.DataFrame(
            [_row(key, p, items, lengths.tobytes(), len(lengths)) for p in grown], columns=_names(STATE)
        )

    return run


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def pack_shards(items: DataFrame, shards: int, first_sequence: int, capacity: int, seed: int = 7) -> DataFrame:
    """``PLACES`` of ``items (item, length)``, dealt into ``shards`` by a hash of the item number."""
    dealt = items.select(
        F.pmod(F.xxhash64(F.col("item") + seed), F.lit(shards)).alias("shard"),
        F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"),
        "item",
        "length",
    )
    state = dealt.groupBy("shard", "island").applyInPandas(_first_epoch(capacity, seed), STATE)
    for epoch in range(1, EPOCHS):
        ranked = ["bins", "square", "bin_of"]
        elite = state.groupBy("shard", "island").agg(
            F.min_by(F.struct(*_names(STATE)[2:]), F.struct(*ranked)).alias("best")
        )
        moved = elite.select("shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "best.*")
        state = (
            state.unionByName(moved)
            .groupBy("shard", "island")
            .applyInPandas(_next_epoch(capacity, seed, epoch), STATE)
        )
    best = state.groupBy("shard").agg(
        F.min_by(F.struct("items", "lengths", "bin_of"), F.struct("bins", "square", "island", "bin_of")).alias("s")
    )

    def make():
        def work(b: pa.RecordBatch) -> dict:
            out = {"item": [], "sequence_id": [], "offset": [], "open": []}
            for shard, i, n, w in zip(*(b[c].to_pylist() for c in ("shard", "items", "lengths", "bin_of")), strict=True):
                where = np.frombuffer(w, "<i4").astype("i8")
                order = np.argsort(where, kind="stable")
                length = np.frombuffer(n, "<i4").astype("i8")[order]
                where = where[order]
                before = np.cumsum(length) - length
                starts = np.r_[True, where[1:] != where[:-1]]
                fill = np.bincount(where, weights=length)
                out["item"] += np.frombuffer(i, "<i8")[order].tolist()
                out["sequence_id"] += (first_sequence + (int(shard) << 20) + where).tolist()
                out["offset"] += (before - np.maximum.accumulate(np.where(starts, before, 0))).tolist()
                out["open"] += (fill < OPEN * capacity)[where].tolist()
            return out

        return work

    return map_columns(best.select("shard", "s.*"), make, PLACES)


def pack(docs: DataFrame, capacity: int = CAPACITY, file: str = FILE) -> DataFrame:
    """``PIECES`` with ``sequence_id`` and ``offset``."""
    table = checkpointed(pieces_of(docs, capacity, file)).withColumn("item", F.monotonically_increasing_id())
    short = table.filter(F.col("length") < capacity).select("item", "length")
    shards = max(1, -(-short.count() // SHARD_ROWS))
    # Sequence numbers: full pieces below zero; first round from 0, last round from 2 ** 61.
    places = pack_shards(short, shards, 0, capacity)
    if shards > 1:
        places = checkpointed(places)
        rest = places.filter("open").select("item").join(short, "item")
        last = pack_shards(rest, max(1, -(-rest.count() // SHARD_ROWS)), 1 << 61, capacity, seed=8)
        places = places.filter(~F.col("open")).unionByName(last)
    whole = table.filter(F.col("length") == capacity).select(
        "item", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return table.join(places.drop("open").unionByName(whole), "item").drop("item")
