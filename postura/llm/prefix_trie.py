"""The trie of conversation prefixes, as numbered nodes in flat arrays.

A conversation is rebuilt from the first turns of another and its own later ones, and becomes the
row of digests of its prefixes; a node is a distinct digest.  Nodes that more than a bounded number
of conversations share (``crowded``; fewer than 131,072 however large the table) are known to all
tasks.  A conversation's first node that is not crowded names its shard, so a shard is a whole subtree
of few conversations, and a first turn or a conversation that a third of all share is divided below
its crowded nodes.

A task numbers the distinct digests of its shards by a minimal perfect hash (levels of bits: a key
whose place no other key has takes it, the rest go on to the next level; its number is the rank of
its bit).  Each number is verified against the digest itself, and each node's parent, depth and size
against all its occurrences.  Counts are scattered into arrays by number, and sums go up through the
parents' numbers in order of depth.  The crowded nodes then take up the sums of the shards below them
in the same way.  The ids that end at a crowded node are sorted by ranges of ids in many tasks and
hashed as a stream of long pieces, for a digest of one text can only be made in order.

Turns go by turn number, null first, ties by a hash of role and text.  Null role or text counts as
empty.  Rows without a conversation id belong to none and are left out.  Equal rows are so many
turns.  A conversation is one row of 24 bytes a turn.  An empty table gives an empty result.  Columns
of other names are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from postura.llm.common import map_columns, stored, struct_type

#: A rebuilt conversation takes up to ``LENT`` turns of the first of its ``FAMILY`` of ids.
FAMILY, LENT = 5, 8
#: A node is crowded with more conversations than this, or than one for every ``2 ** CROWDED_BITS`` turns.
CROWDED, CROWDED_BITS = 256, 17
#: Turns that a task works on at once, shards being kept whole; ids hashed at once.
TURNS_AT_ONCE, IDS_AT_ONCE = 1 << 18, 1 << 16

PATHS = "conv_id long, n_turns long, path binary, sizes binary"
INCIDENCES = "node binary, parent binary, depth int, size long, conv_id long"
DEALT = "shard binary, above int, depth int, conv_id long, path binary, sizes binary"
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()


def lent(conv_id: int) -> int:
    """How many turns a conversation takes from the first of its family."""
    return zlib.crc32(str(conv_id).encode()) % (LENT + 1)


def _emit(rows: list[tuple], fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
        )


def _records(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in names), strict=True)


def _rebuild(batches: Iterator[pa.RecordBatch], fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Paths of the conversations of each family, whose turns come together and in order."""
    out: list[tuple] = []
    size = 0
    names = ("family", "conv_id", "digest", "size")
    for family, members in groupby(_records(batches, names), key=itemgetter(0)):
        first: list[tuple] = []
        for conv_id, turns in groupby(members, key=itemgetter(1)):
            own = [t[2:] for t in turns]
            if conv_id == family:
                first = own[:LENT]
            h = lent(conv_id)
            digest, path = ROOT, []
            whole = first[:h] + own[h:]
            for turn, _ in whole:
                digest = hashlib.md5(digest + turn).digest()
                path.append(digest)
            out.append((conv_id, len(whole), b"".join(path), np.array([n for _, n in whole], "<i8").tobytes()))
            size += len(whole) + 1
            if size >= TURNS_AT_ONCE:
                yield from _emit(out, fields)
                out, size = [], 0
    yield from _emit(out, fields)


def rebuilt_paths(rows: DataFrame) -> DataFrame:
    """``PATHS`` of every conversation: its prefixes' digests, 16 bytes each, and its texts' sizes in bytes."""
    fields = to_arrow_schema(struct_type(PATHS))
    turns = rows.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    told = turns.select(
        (F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))).alias("family"),
        "conv_id",
        "turn",
        F.xxhash64("role", "text").alias("tie"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("digest"),
        F.octet_length("text").cast("long").alias("size"),
    )
    ordered = told.repartition("family").sortWithinPartitions("family", "conv_id", "turn", "tie", "digest")
    return ordered.mapInArrow(partial(_rebuild, fields=fields), PATHS)


def incidences(paths: DataFrame) -> DataFrame:
    """A row for each node on each conversation's path."""

    def make():
        def work(b: pa.RecordBatch) -> dict:
            out: dict[str, list] = {f.split()[0]: [] for f in INCIDENCES.split(", ")}
            for conv_id, path, sizes in zip(*(b[c].to_pylist() for c in ("conv_id", "path", "sizes")), strict=True):
                nodes = [path[k : k + 16] for k in range(0, len(path), 16)]
                out["node"] += nodes
                out["parent"] += [ROOT, *nodes[:-1]][: len(nodes)]
                out["depth"] += range(1, len(nodes) + 1)
                out["size"] += np.frombuffer(sizes, "<i8").tolist()
                out["conv_id"] += [conv_id] * len(nodes)
            return out

        return work

    return map_columns(paths, make, INCIDENCES)


class Crowded:
    """The root, at number 0, and the nodes of more than ``limit`` conversations: all that tasks share."""

    def __init__(self, paths: DataFrame, least: int = CROWDED):
        total = paths.agg(F.count("*").alias("n"), F.min("conv_id").alias("c"), F.sum("n_turns").alias("t")).first()
        self.n_convs = [total["n"]]
        limit = max(least, (total["t"] or 0) >> CROWDED_BITS)
        grouped = incidences(paths).groupBy("node").agg(
            F.count("*").alias("n"),
            F.min("conv_id").alias("c"),
            *[f(c).alias(f"{f.__name__}_{c}") for c in ("parent", "depth", "size") for f in (F.min, F.max)],
        )
        found = sorted(grouped.filter(F.col("n") > limit).collect(), key=lambda r: (r["min_depth"], r["c"], r["node"]))
        for r in found:
            _verify(r["min_parent"] == r["max_parent"] and r["min_depth"] == r["max_depth"] and r["min_size"] == r["max_size"])
        self.number = {ROOT: 0} | {bytes(r["node"]): k for k, r in enumerate(found, 1)}
        self.n_convs += [r["n"] for r in found]
        self.conv_id = [total["c"]] + [r["c"] for r in found]
        self.parent = [-1] + [self.number[bytes(r["min_parent"])] for r in found]
        self.depth = [0] + [r["min_depth"] for r in found]
        self.size = [0] + [r["min_size"] for r in found]


def _verify(holds: bool) -> None:
    if not holds:
        raise ValueError("two different prefixes have one digest")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Numbers 0 .. n - 1 for ``n`` distinct keys of two 64-bit words."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        taken = 0
        while len(keys):
            places = max(16, 2 * len(keys))
            at = self._place(keys, len(self.levels), places)
            alone = np.bincount(at, minlength=places) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - 1))
            taken += int(alone.sum())
            keys = keys[~alone[at]]

    @staticmethod
    def _place(keys: np.ndarray, level: int, places: int) -> np.ndarray:
        seed = np.uint64(0xD6E8FEB86659FD93 * (2 * level + 1) & (1 << 64) - 1)
        return (_mix(_mix(keys[:, 0] ^ seed) + keys[:, 1]) % np.uint64(places)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """A number for each key; for one that is not in the set any, or -1."""
        out = np.full(len(keys), -1)
        active = np.arange(len(keys))
        for level, (alone, number) in enumerate(self.levels):
            at = self._place(keys[active], level, len(alone))
            here = alone[at]
            out[active[here]] = number[at[here]]
            active = active[~here]
        return out


def accumulate(parent: np.ndarray, depth: np.ndarray, *sums: np.ndarray) -> None:
    """Adds each node's sums to its parent's, the deepest nodes first; parents of -1 are outside."""
    order = np.argsort(-depth, kind="stable")
    borders = np.flatnonzero(np.diff(depth[order])) + 1
    for nodes in np.split(order, borders):
        nodes = nodes[parent[nodes] >= 0]
        for values in sums:
            np.add.at(values, parent[nodes], values[nodes])


def ids_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _subtrees(rows: list[tuple], conv_id_above: list[int]) -> list[tuple]:
    """``NODES`` and the number of the crowded node above (null inside) of whole shards."""
    above, depth, conv_id = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
    keys = np.frombuffer(b"".join(r[4] for r in rows), "<u8").reshape(-1, 2)
    sizes = np.frombuffer(b"".join(r[5] for r in rows), "<i8")
    length = np.array([len(r[4]) // 16 for r in rows])
    first = np.cumsum(length) - length
    of = np.repeat(np.arange(len(rows)), length)

    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.r_[True, (keys[order][1:] != keys[order][:-1]).any(axis=1)]
    distinct = keys[order[new]]
    n = len(distinct)
    number = PerfectHash(distinct)
    digests = np.empty_like(distinct)
    digests[number(distinct)] = distinct
    slot = number(keys)
    _verify(bool((digests[slot] == keys).all()))

    before = np.r_[-1, slot[:-1]]
    before[first] = -1
    depths = depth[of] + 1 + np.arange(len(keys)) - first[of]
    parent, node_depth, size, top = (np.empty(n, np.int64) for _ in range(4))
    for node_of, value in ((parent, before), (node_depth, depths), (size, sizes), (top, above[of])):
        node_of[slot] = value
        _verify(bool((node_of[slot] == value).all()))

    n_convs = np.bincount(slot, minlength=n)
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, conv_id[of])
    n_children = np.bincount(parent[parent >= 0], minlength=n)
    n_leaves = (n_children == 0).astype(np.int64)
    saved = (n_convs - 1) * size
    accumulate(parent, node_depth, n_leaves, saved)

    ends = slot[first + length - 1]
    digest = [NOTHING] * n
    by_end = np.lexsort((conv_id, ends))
    for some in np.split(by_end, np.flatnonzero(np.diff(ends[by_end])) + 1):
        digest[ends[some[0]]] = ids_digest(conv_id[some].tolist())
    inside = parent >= 0
    parent_id = np.where(inside, least[parent], np.array(conv_id_above, np.int64)[top])
    columns = (least, node_depth, parent_id, n_convs, n_children, n_leaves, saved)
    return list(zip(*(c.tolist() for c in columns), digest, [None if i else t for i, t in zip(inside, top.tolist(), strict=True)], strict=True))


def _dealt(batches: Iterator[pa.RecordBatch], crowded, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each conversation without the crowded nodes of its path; no shard where all are."""
    number = crowded.value.number
    for batch in batches:
        out = []
        for conv_id, path, sizes in _records([batch], ("conv_id", "path", "sizes")):
            at, above = 0, 0
            while at < len(path) and (found := number.get(path[at : at + 16])) is not None:
                at, above = at + 16, found
            rest = path[at:]
            out.append((rest[:16] or None, above, at // 16, conv_id, rest, sizes[at // 2 :]))
        yield from _emit(out, fields)


def _shards(batches: Iterator[pa.RecordBatch], crowded, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    conv_id = crowded.value.conv_id
    held: list[tuple] = []
    size = 0
    names = ("shard", "above", "depth", "conv_id", "path", "sizes")
    for _, rows in groupby(_records(batches, names), key=itemgetter(0)):
        for row in rows:
            held.append(row)
            size += len(row[4]) // 16
        if size >= TURNS_AT_ONCE:
            yield from _emit(_subtrees(held, conv_id), fields)
            held, size = [], 0
    if held:
        yield from _emit(_subtrees(held, conv_id), fields)


def _pieces(batches: Iterator[pa.RecordBatch], fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids as text, each id with a comma behind it."""
    for above, rows in groupby(_records(batches, ("above", "conv_id")), key=itemgetter(0)):
        ids: list[int] = []
        for _, conv_id in rows:
            ids.append(conv_id)
            if len(ids) == IDS_AT_ONCE:
                yield from _emit([(above, ids[0], "".join(f"{i}," for i in ids))], fields)
                ids = []
        if ids:
            yield from _emit([(above, ids[0], "".join(f"{i}," for i in ids))], fields)


def _hashed(batches: Iterator[pa.RecordBatch], fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    for above, rows in groupby(_records(batches, ("above", "ids")), key=itemgetter(0)):
        digest, last = hashlib.sha256(), ""
        for _, ids in rows:
            digest.update(last.encode())
            last = ids
        digest.update(last[:-1].encode())
        yield from _emit([(above, digest.hexdigest())], fields)


def crowded_ends(ends: DataFrame) -> DataFrame:
    """``above, ends_sha256``: the digest of the sorted ids of each node."""
    piece, digest = "above int, first long, ids string", "above int, ends_sha256 string"
    ranged = ends.select("above", "conv_id").repartitionByRange("above", "conv_id").sortWithinPartitions("above", "conv_id")
    pieces = ranged.mapInArrow(partial(_pieces, fields=to_arrow_schema(struct_type(piece))), piece)
    together = pieces.repartition("above").sortWithinPartitions("above", "first")
    return together.mapInArrow(partial(_hashed, fields=to_arrow_schema(struct_type(digest))), digest)


def prefix_trie(rows: DataFrame, least: int = CROWDED) -> DataFrame:
    """``NODES`` of the rebuilt conversations."""
    spark = rows.sparkSession
    paths = stored(rebuilt_paths(rows), "paths")
    crowded = Crowded(paths, least)
    sent = spark.sparkContext.broadcast(crowded)
    dealt = paths.mapInArrow(partial(_dealt, crowded=sent, fields=to_arrow_schema(struct_type(DEALT))), DEALT)
    below = f"{NODES}, above int"
    together = dealt.filter("shard is not null").repartition("shard").sortWithinPartitions("shard", "conv_id")
    nodes = stored(
        together.mapInArrow(partial(_shards, crowded=sent, fields=to_arrow_schema(struct_type(below))), below), "nodes"
    )
    # As many rows as there are crowded nodes, at most.
    tops = nodes.filter("above is not null").groupBy("above")
    sums = tops.agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    upper = spark.createDataFrame(_upper(crowded, sums.collect()), f"above int, {NODES.rpartition(', ')[0]}")
    upper = upper.join(crowded_ends(dealt.filter("shard is null")), "above", "left")
    upper = upper.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    return nodes.drop("above").unionByName(upper.drop("above"))


def _upper(crowded: Crowded, sums: list) -> list[tuple]:
    if not crowded.n_convs[0]:
        return []
    parent, depth, size, n_convs = (
        np.array(x, np.int64) for x in (crowded.parent, crowded.depth, crowded.size, crowded.n_convs)
    )
    n = len(parent)
    n_children = np.bincount(parent[1:], minlength=n)
    n_leaves, saved = np.zeros(n, np.int64), (n_convs - 1) * size
    for row in sums:
        n_children[row["above"]] += row["n"]
        n_leaves[row["above"]] += row["leaves"]
        saved[row["above"]] += row["saved"]
    n_leaves[n_children == 0] = 1
    accumulate(parent, depth, n_leaves, saved)
    parent_id = [None] + [crowded.conv_id[p] for p in crowded.parent[1:]]
    columns = (depth, n_convs, n_children, n_leaves, saved)
    depth_, *rest = (c.tolist() for c in columns)
    return list(zip(range(n), crowded.conv_id, depth_, parent_id, *rest, strict=True))
