"""Near-duplicate classes by order MinHash, verified by banded alignment.

A text is its five-word shingles, each labelled with its occurrence number.  For each of ``BANDS``
hash functions the two smallest shingles are kept in the order of the text; texts that agree in a
band share a bucket.  Since the order counts, buckets are sensitive to edits and moves, not just to
common words.

Equal texts are folded first.  In a bucket of ``BLOCK`` texts at most, a maximum spanning forest over
likeness as bounded below names the first pairs to verify.  A larger bucket is never paired with
itself: its most central member, found among blocks of its members, represents it, and every member is
weighed against that one.  So a group of copies, however large, becomes a class with a pair each.

What buckets miss is found exactly.  In one order of all shingles, the same for every text, two texts
alike by ``least`` have a shingle in common among the first ``n - ceil(least * n) + 1`` of each.  The
order puts shingles last that many texts share, as told by a bounded sample, which decides on the time
alone.  Texts that meet in such a shingle and are of different classes are paired, block by block where
they are many: first the likeliest pair of any two classes, then, of classes still apart, all pairs.
Only pairs that cannot be alike go unverified: shingles are counted by their last byte, and the sum of
the lesser counts bounds what two texts have in common.  Such counts say little of a long text, so its
shingles are dealt by other bits over parts of ``PART`` at most on average, and parts meet instead of
texts: two texts alike by ``least`` have a part in which they are alike by as much.  So every link between
classes is found.  The work grows with the members of a class; pairs of texts of one template, nearly
alike, are weighed all.

A pair is verified on its whole texts.  Labelled shingles are distinct, so the longest common
subsequence is the longest rising run of positions; the band is the shift that the asked likeness
allows.  Shingles kept in order over all shingles of both must reach ``LEAST``.

Verified links are joined to classes by alternating large and small stars.  A class is named by its
smallest document id.  Null text counts as empty; texts without words are alike only if equal;
shorter texts than five words are one shingle.  Repeated rows fall in one class.  A document without
id is named by a hash of its text.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from postura.llm.common import checkpointed, id_and_text, map_columns, stored, struct_type
from postura.llm.word_bpe import _Remembering

WIDTH, LEAST = 5, 0.8
BANDS, KEPT = 12, 2
#: Bytes of the signature that estimates likeness.
SIGNATURE = 256
#: Bins of the counts that bound what two texts have in common, and the count of a bin that says nothing.
BINS, FULL = 256, 255
#: Shingles of a part of a text on average, and how many more parts the next longer texts have.
PART, FINER = 1024, 4
BLOCK = 192
#: Texts of a block where all of a bucket meet.
GRID = 2048
#: Texts of the sample that tells common shingles, the fewest of them that make one, and how many are kept.
SAMPLED, OFTEN, COMMON = 8192, 3, 1 << 16
#: Shingles hashed at once, for very long texts.
CHUNK = 1 << 14

PARTS = "array<struct<part: long, n: long, spread: binary, prefix: array<long>>>"
SKETCH = f"ref long, text_key string, n long, keys array<long>, spread binary, parts {PARTS}"
PROPOSED = "key long, a long, b long, central double, n long, spread binary"

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD]
_rng = np.random.default_rng(20)
_BAND_SEEDS = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_SIGN_SEEDS = _rng.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Shingles:
    """Labelled shingle hashes of a text, in its order."""

    def __init__(self):
        self.words = _Remembering(lambda w: xxhash.xxh64_intdigest(w))

    def __call__(self, text: str) -> np.ndarray:
        words = text.lower().split()
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64)
        hashed = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        width = min(WIDTH, n)
        plain = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            plain += hashed[k : n - width + 1 + k] * np.uint64(_ODD[k])
        plain = _mix(plain)
        placed = np.sort(plain)
        if (placed[1:] != placed[:-1]).all():
            return _mix(plain)  # each occurs once
        order = np.argsort(plain, kind="stable")
        placed = plain[order]
        at = np.arange(len(placed))
        first = np.r_[True, placed[1:] != placed[:-1]]
        occurrence = np.empty(len(placed), np.uint64)
        occurrence[order] = at - np.maximum.accumulate(np.where(first, at, 0))
        return _mix(plain + occurrence * np.uint64(_ODD[0]))


def band_keys(shingles: np.ndarray) -> list[int]:
    """A key for each band: its smallest shingles, in the order of the text."""
    keys = []
    for j, seed in enumerate(_BAND_SEEDS):
        value = _mix(shingles ^ seed)
        few = {}
        for _ in range(min(KEPT, len(value))):
            at = int(value.argmin())
            few[at], value[at] = value[at], np.iinfo(np.uint64).max
        kept = np.array([few[at] for at in sorted(few)], "<u8").tobytes()
        keys.append(xxhash.xxh64_intdigest(kept, seed=j) - (1 << 63))
    return keys


def signature(shingles: np.ndarray) -> bytes:
    """The low byte of the smallest value of each of many hash functions."""
    least = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), CHUNK):
        part = shingles[at : at + CHUNK]
        value = (part[None, :] ^ _SIGN_SEEDS[:, None]) * np.uint64(_ODD[3])
        value ^= value >> np.uint64(32)
        value *= np.uint64(_ODD[4])
        least = np.minimum(least, value.min(axis=1))
    return (least & np.uint64(0xFF)).astype(np.uint8).tobytes()


def ordered_likeness(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float:
    """Shingles common in order over all shingles of both, by alignment within the band; 0 if below ``least``."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    needed = least / (1 + least) * (n + m)
    if len(i) < needed - 1e-9:
        return 0.0
    order = np.argsort(i)
    i, j = i[order], j[order]
    # Each unmatched shingle shifts by one at most.
    j = j[np.abs(i - j) <= n + m - 2 * needed + 1]
    if len(j) < 2 or (j[1:] > j[:-1]).all():
        kept = len(j)
    else:
        ends: list[int] = []
        for x in j.tolist():
            at = bisect_left(ends, x)
            ends[at : at + 1] = [x]
        kept = len(ends)
    return kept / (n + m - kept)


def prefix(shingles: np.ndarray, common: np.ndarray, shared: np.ndarray, least: float = LEAST) -> np.ndarray:
    """The first shingles in the order of all: rare ones by value, then the ``common`` by how many texts share them.

    ``common`` is sorted; ``shared`` has the texts of each.
    """
    return _first(shingles, _sharing(shingles, common, shared), least)


def _sharing(shingles: np.ndarray, common: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The texts that share each shingle, 0 if it is not ``common``."""
    if not len(common):
        return np.zeros(len(shingles), np.int64)
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    return np.where(common[at] == shingles, shared[at], 0)


def _first(shingles: np.ndarray, often: np.ndarray, least: float) -> np.ndarray:
    n = len(shingles)
    wanted = n - math.ceil(least * n - 1e-9) + 1
    if wanted >= n:
        return shingles
    if often.any():
        return shingles[np.lexsort((shingles, often))[:wanted]]
    return np.partition(shingles, wanted - 1)[:wanted]


def spread(shingles: np.ndarray) -> bytes:
    """Shingles counted by their last byte; all ``FULL`` where a count is too large."""
    counts = np.bincount((shingles & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)
    return (counts if counts.max() < FULL else np.full(BINS, FULL)).astype(np.uint8).tobytes()


def dealings(n: int, least: float = LEAST) -> list[int]:
    """The numbers of parts of a text of ``n`` shingles: those of all shorter texts that may be alike to it, and its own."""
    found, parts = [], 1
    shortest = math.ceil(least * n - 1e-9)
    while parts * PART <= shortest:
        parts *= FINER
    found.append(parts)
    while parts * PART <= n:
        parts *= FINER
        found.append(parts)
    return found


def parts_of(shingles: np.ndarray, common: np.ndarray, shared: np.ndarray, least: float = LEAST) -> list[dict]:
    """The parts of a text: a number, and size, counts and first shingles; the whole has number 1 and the text's own counts.

    Of two texts, the dealing of the shorter is one of the longer's too.  Shingles in common over all of both are at
    least as many in some part as in the whole.
    """
    found = []
    often = _sharing(shingles, common, shared)
    for many in dealings(len(shingles), least) if len(shingles) else []:
        if many == 1:
            first = _first(shingles, often, least).astype("i8")
            found.append({"part": 1, "n": None, "spread": None, "prefix": first})
            continue
        place = (shingles >> np.uint64(8)) & np.uint64(many - 1)
        order = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[order], np.arange(many + 1, dtype=np.uint64))
        for k in np.flatnonzero(np.diff(ends)).tolist():
            at = order[ends[k] : ends[k + 1]]
            own = shingles[at]
            first = _mix(_first(own, often[at], least) + np.uint64(many)).astype("i8")
            found.append({"part": many + k, "n": len(own), "spread": spread(own), "prefix": first})
    return found


def likest(n: np.ndarray, counts: np.ndarray, m: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Upper bounds of the likeness of texts with ``n`` and ``m`` shingles and such counts."""
    most = np.minimum(n, m)
    both = np.minimum(counts, other).sum(axis=-1, dtype=np.int64)
    unknown = (counts[..., 0] == FULL) | (other[..., 0] == FULL)
    both = np.where(unknown, most, np.minimum(both, most))
    return both / (n + m - both)


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that texts of a bounded sample share, sorted, and how many of them do."""
    every = max(1, math.ceil(docs.count() / SAMPLED))
    some = docs.filter(F.pmod(F.xxhash64("text_key"), F.lit(every)) == 0).dropDuplicates(["text_key"])

    def make():
        shingle = Shingles()

        def work(b: pa.RecordBatch) -> dict:
            found = [shingle(t) for t in b["text"].to_pylist()]
            return {"shingle": np.concatenate(found).astype("i8") if found else []}

        return work

    found = map_columns(some.select("text"), make, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    found = found.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "shingle").limit(COMMON).toPandas()
    common, shared = found["shingle"].to_numpy("i8").astype(np.uint64), found["n"].to_numpy("i8")
    order = np.argsort(common)
    return common[order], shared[order]


def sketches(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], least: float = LEAST) -> DataFrame:
    """``SKETCH`` of each row, and ``node``, a number for its text."""
    sent = docs.sparkSession.sparkContext.broadcast(common)  # COMMON shingles at most

    def make():
        shingle = Shingles()

        def work(b: pa.RecordBatch) -> dict:
            found = [shingle(t) for t in b["text"].to_pylist()]
            return {
                "ref": b["ref"],
                "text_key": b["text_key"],
                "n": [len(s) for s in found],
                "keys": [band_keys(s) if len(s) else [] for s in found],
                "spread": [spread(s) for s in found],
                "parts": [parts_of(s, *sent.value, least) for s in found],
            }

        return work

    made = map_columns(docs.select("ref", "text_key", "text"), make, SKETCH)
    return made.withColumn("node", F.xxhash64("text_key"))


def with_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ref, text_key, text``: a name for the row and one for the text."""
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select("doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("ref"), F.md5(F.col("text").cast("binary")).alias("text_key"), "text")


def _counts(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles and spread of rows that end in them."""
    n = np.array([r[-2] for r in rows], np.int64)
    return n, np.frombuffer(b"".join(r[-1] for r in rows), np.uint8).reshape(len(rows), BINS)


def _forest(rows: list[tuple], least: float) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over bounds of likeness."""
    n, counts = _counts(rows)
    alike = np.array([likest(n, counts, n[k], counts[k]) for k in range(len(rows))])
    edges, best, parent = [], alike[0].copy(), np.zeros(len(rows), int)
    outside = np.ones(len(rows), bool)
    outside[0] = False
    for _ in range(len(rows) - 1):
        k = int(np.argmax(np.where(outside, best, -1.0)))
        outside[k] = False
        if best[k] >= least:
            a, b = rows[k][0], rows[parent[k]][0]
            edges.append((min(a, b), max(a, b)))
        closer = alike[k] > best
        best[closer], parent[closer] = alike[k][closer], k
    return edges


def _items(column: pa.Array) -> list:
    """The values of a column; lists of numbers as arrays."""
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _by_group(df: DataFrame, group: list[str], rest: list[str], closed: Callable[[tuple, list], list], schema: str) -> DataFrame:
    """Rows that ``closed`` makes of the rows of each group, which are as many as a block or two holds."""
    fields = to_arrow_schema(struct_type(schema))

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            out = []
            keys = zip(*(batch[c].to_pylist() for c in group), strict=True)
            for key, *row in zip(keys, *(_items(batch[c]) for c in rest), strict=True):
                if key != at:
                    out += closed(at, held) if held else []
                    at, held = key, []
                held.append(tuple(row))
            if out:
                yield made(out)
        if held and (out := closed(at, held)):
            yield made(out)

    ordered = df.select(*group, *rest).repartition(*group).sortWithinPartitions(*group, rest[0])
    return ordered.mapInArrow(run, schema)


def bucketed(keyed: DataFrame) -> DataFrame:
    """``key, node, n_bucket`` of the keys that several texts have; of keys with the same texts, one."""
    own = Window.partitionBy("key")
    several = keyed.withColumn("low", F.min("node").over(own)).withColumn("high", F.max("node").over(own))
    members = stored(several.filter("low <> high").select("key", "node").distinct(), "members")
    same = [F.count("*").alias("n_bucket"), F.min("node").alias("low"), F.max("node").alias("high")]
    # Two sums of different hashes, so that other texts have another print.
    same += [F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")]
    prints = members.groupBy("key").agg(*same)
    kept = prints.groupBy("n_bucket", "low", "high", "x", "y").agg(F.min("key").alias("key"))
    return stored(members.join(stored(kept.select("key", "n_bucket"), "kept"), "key"), "buckets")


def weighed(members: DataFrame, pivots: DataFrame, least: float = LEAST) -> DataFrame:
    """``a, b``: members that may be alike to the representative of their bucket.

    ``pivots`` has ``key, pivot, pivot_n, pivot_spread``.
    """

    def make():
        def work(b: pa.RecordBatch) -> dict:
            if not b.num_rows:
                return {"a": [], "b": []}
            own, other = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint8).reshape(-1, BINS) for c in ("spread", "pivot_spread"))
            near = pa.array(likest(b["n"].to_numpy(), own, b["pivot_n"].to_numpy(), other) >= least)
            return {"a": b["a"].filter(near), "b": b["b"].filter(near)}

        return work

    met = members.join(pivots, "key").filter("node <> pivot")
    ends = [F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")]
    return map_columns(met.select(*ends, "n", "spread", "pivot_n", "pivot_spread"), make, "a long, b long")


def candidates(members: DataFrame, signs: DataFrame, least: float = LEAST) -> DataFrame:
    """``a, b``: the first pairs to verify.  ``signs`` has ``node, n, spread``."""
    members = members.join(signs, "node")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("n_bucket") / BLOCK)))

    small = BLOCK

    def closed(at: tuple, rows: list) -> list[tuple]:
        if rows[0][1] <= small:
            return [(at[0], a, b, None, None, None) for a, b in _forest(rows, least)]
        n, counts = _counts(rows)
        central = [float(likest(n, counts, n[k], counts[k]).mean()) for k in range(len(rows))]
        most = int(np.argmax(central))
        return [(at[0], rows[most][0], None, central[most], *rows[most][-2:])]

    proposed = stored(_by_group(dealt, ["key", "block"], ["node", "n_bucket", "n", "spread"], closed, PROPOSED), "proposed")
    pairs = proposed.filter("b is not null").select("a", "b")
    central = F.max(F.struct("central", "a", "n", "spread")).alias("p")
    pivots = proposed.filter("b is null").groupBy("key").agg(central).select(
        "key", F.col("p.a").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.spread").alias("pivot_spread")
    )
    return pairs.unionByName(weighed(members.filter(F.col("n_bucket") > BLOCK), pivots, least)).distinct()


def dealt_parts(own: DataFrame) -> DataFrame:
    """``node, text, n, spread, prefix`` of the parts of sketched texts; ``node`` is a number for the part, ``text`` for its text."""
    part = F.col("p.part")
    return own.select("node", "n", "spread", F.explode("parts").alias("p")).select(
        F.when(part == 1, F.col("node")).otherwise(F.xxhash64("node", part)).alias("node"),
        F.col("node").alias("text"),
        F.coalesce("p.n", "n").alias("n"),
        F.coalesce("p.spread", "spread").alias("spread"),
        F.col("p.prefix").alias("prefix"),
    )


def divided(members: DataFrame, found: DataFrame) -> DataFrame:
    """``key, node, n_bucket, root`` of the buckets that hold several classes."""
    texts = members.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = Window.partitionBy("key")
    several = texts.withColumn("low", F.min("root").over(own)).withColumn("high", F.max("root").over(own))
    return several.filter("low <> high").drop("low", "high")


def offered(texts: DataFrame, signs: DataFrame, first: bool, least: float = LEAST) -> DataFrame:
    """``a, b``: pairs of different classes of a bucket that may be alike; ``first``: the likeliest of any two classes.

    ``texts`` has parts of texts, and ``signs`` their ``node, text, n, spread``.  Every block of a bucket meets every other.
    Parts that share many buckets are paired in the one of the smallest key.
    """
    blocks = F.ceil(F.col("n_bucket") / GRID)
    before = Window.partitionBy("node").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    dealt = texts.withColumn("earlier", F.collect_list("key").over(before))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", "key"), blocks))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def closed(at: tuple, rows: list) -> list[tuple]:
        _, low, high = at
        n, counts = _counts(rows)
        number = {root: k for k, root in enumerate(sorted({r[1] for r in rows}))}
        roots, block = np.array([number[r[1]] for r in rows]), np.array([r[2] for r in rows])
        earlier = cache(lambda k: frozenset(rows[k][3].tolist()))
        out, best = [], {}
        for k in range(len(rows) - 1):
            apart = roots[k + 1 :] != roots[k]
            if low != high:
                apart &= block[k + 1 :] != block[k]
            # Sizes alone tell most pairs apart.
            apart &= np.minimum(n[k + 1 :], n[k]) >= least * np.maximum(n[k + 1 :], n[k]) - 1e-6
            others = k + 1 + np.flatnonzero(apart)
            if not len(others):
                continue
            alike = likest(n[others], counts[others], n[k], counts[k])
            for x, j in zip(alike[alike >= least].tolist(), others[alike >= least].tolist(), strict=True):
                if not earlier(k).isdisjoint(earlier(j)):
                    continue
                pair = (min(rows[k][0], rows[j][0]), max(rows[k][0], rows[j][0]))
                if not first:
                    out.append(pair)
                    continue
                of = (min(roots[k], roots[j]), max(roots[k], roots[j]))
                best[of] = max(best.get(of, (0.0, pair)), (x, pair))
        return out or [pair for _, pair in best.values()]

    rest = ["text", "root", "block", "earlier", "n", "spread"]
    return _by_group(dealt.join(signs, "node"), ["key", "low", "high"], rest, closed, "a long, b long").distinct()


def whole_texts(nodes: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text`` of ``nodes``, each once.  ``texts`` names a row of ``docs`` for each."""
    wanted = stored(nodes.distinct().join(texts.select("node", "ref", "text_key"), "node"), "wanted")
    found = docs.select("ref", "text_key", "text").join(wanted, ["ref", "text_key"])
    return stored(found.select("node", "text").dropDuplicates(["node"]), "whole", compression="zstd")


def verified(pairs: DataFrame, whole: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose whole texts are alike."""

    def make():
        shingle = Shingles()

        def work(b: pa.RecordBatch) -> dict:
            near = pa.array(
                [
                    ordered_likeness(shingle(s), shingle(t), least) >= least
                    for s, t in zip(b["text"].to_pylist(), b["other"].to_pylist(), strict=True)
                ],
                pa.bool_(),
            )
            return {"a": b["a"].filter(near), "b": b["b"].filter(near)}

        return work

    both = pairs.join(whole.select(F.col("node").alias("a"), "text"), "a").join(
        whole.select(F.col("node").alias("b"), F.col("text").alias("other")), "b"
    )
    return map_columns(both.select("a", "b", "text", "other"), make, "a long, b long").distinct()


def classes(links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node connected with each node that has a link."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        """Neighbours above a node move to its smallest neighbour; or those below, and itself."""
        around = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            around = around.filter("v < u")
        least = around.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
        moved = around.join(least, "u").filter("v > u" if large else "v < u")
        moved = moved.select(F.col("v").alias("u"), F.col("least").alias("v"))
        if not large:
            moved = moved.unionByName(least.select("u", F.col("least").alias("v")))
        return checkpointed(moved.filter("u <> v").distinct())

    edges = checkpointed(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        edges = star(star(edges, large=True), large=False)
        # Done when every node has one neighbour above none: stars alone.
        twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
        below = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
        if twice.unionByName(below).isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


class _Links:
    """Verified links, the classes they make, and the pairs that need no second trial."""

    def __init__(self, whole: DataFrame, least: float):
        self.whole, self.least = whole, least
        spark = whole.sparkSession
        self.tested = self.links = spark.createDataFrame([], "a long, b long")
        self.found = spark.createDataFrame([], "node long, root long")

    def weigh(self, pairs: DataFrame) -> None:
        """Verify the pairs that are new."""
        fresh = stored(pairs.join(self.tested, ["a", "b"], "left_anti"), "fresh")
        if fresh.isEmpty():
            return
        self.tested = self.tested.unionByName(fresh)
        new = stored(verified(fresh, self.whole, self.least), "links")
        if not new.isEmpty():
            self.links = self.links.unionByName(new)
            self._join(new)

    def _join(self, new: DataFrame) -> None:
        """Classes of the old classes' roots, and so of their members."""
        roots = self.found
        for end in ("a", "b"):
            named = roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
            new = new.join(named, end, "left").withColumn(f"{end}_root", F.coalesce(f"{end}_root", end))
        merged = classes(new.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).filter("a <> b"))
        moved = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
        old = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        # Roots of old classes that were merged are among the nodes; new ones join by themselves.
        fresh = merged.join(roots.select("node"), "node", "left_anti")
        self.found = stored(old.unionByName(fresh.select("node", "root")), "found")


def linked_texts(own: DataFrame, texts: DataFrame, docs: DataFrame, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """Verified links ``a, b`` and the classes they make, ``node, root``."""
    signs = texts.select("node", "n", "spread")
    alike = bucketed(own.select(F.explode("keys").alias("key"), "node"))
    parts = dealt_parts(own)
    near = bucketed(parts.select(F.explode("prefix").alias("key"), "node"))
    met = near.select("node").distinct()
    parts = stored(parts.drop("prefix").join(met, "node", "left_semi").dropDuplicates(["node"]), "parts")
    # Only texts that share a bucket are ever read again.
    shared = alike.select("node").unionByName(parts.select(F.col("text").alias("node")))
    state = _Links(whole_texts(shared, texts, docs), least)
    state.weigh(candidates(alike, signs, least))

    def rooted() -> DataFrame:
        """``node, root`` of the parts of texts that have links."""
        return parts.select("node", "text").join(state.found.withColumnRenamed("node", "text"), "text").select("node", "root")

    for first in (True, False):
        near = stored(divided(near.drop("root"), rooted()), "divided")
        if near.isEmpty():
            break
        state.weigh(offered(near, parts, first, least))
    return state.links, state.found


def near_duplicates(docs: DataFrame, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, text_key, ref, n_copies, n_links`` of every document.

    ``n_copies`` counts equal texts, ``n_links`` the pairs of the text that were tried and
    verified: enough to connect its class, not all that are alike, as pairs within a class are not tried again.
    """
    rows = with_keys(docs, id_col, text_col)
    own = stored(sketches(rows, common_shingles(rows), least), "sketches")
    texts = stored(
        own.groupBy("node", "text_key").agg(
            F.min("ref").alias("ref"),
            F.count("*").alias("n_copies"),
            F.max("n").alias("n"),
            F.max("spread").alias("spread"),
        ),
        "texts",
    )
    links, found = linked_texts(own, texts, rows, least)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    rooted = texts.select("node", "ref", "n_copies").join(found, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    linked = stored(rooted.join(degree, "node", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0))), "rooted")
    named = stored(linked.groupBy("root").agg(F.min("ref").alias("class_id")), "classes")
    of_text = stored(linked.join(named, "root").select("node", "class_id", "n_copies", "n_links"), "of-text")
    ids = own.select("ref", "text_key", "node")
    return ids.join(of_text, "node").select(
        F.col("ref").alias("doc_id"), "class_id", "n_copies", "n_links", "text_key"
    )


def keep_one(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` with one row of each class, all its columns untouched."""
    found = stored(near_duplicates(docs, least).withColumnRenamed("doc_id", "ref"), "near")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")))).alias("ref"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key"),
    )
    gone = stored(found.filter("ref <> class_id").select("ref", "text_key").distinct(), "gone")
    kept = rows.join(gone, ["ref", "text_key"], "left_anti")
    if not found.filter("ref = class_id").groupBy("class_id").count().filter("count > 1").isEmpty():
        # Rows that share an id: one of each class.
        named = found.select("ref", "text_key", "class_id").distinct()
        kept = kept.join(named, ["ref", "text_key"]).dropDuplicates(["class_id"])
    return kept.select("row.*")
