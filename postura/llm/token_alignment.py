"""Aligns two tokenisations of the same text, and weighs each link by how common it is in the corpus.

Both vocabularies cut the bytes of a text (with a blank before it) into tokens.  Offsets where tokens
of both end are cuts; what lies between two cuts is a group.  Groups are found by divide and conquer:
an interval looks from its middle token for an end that the other side shares, by bisecting one side
for the next end of the other in turn, first upwards, then downwards; a shared end divides it, both
halves go on, and an interval without one is a leaf, a group.  Every level works on all intervals of
all texts of a batch at once.  A very long text without cuts is walked once.

A link is a pair of token occurrences whose bytes overlap.  The count of an id pair is the number of
documents that hold it linked.  Pairs are counted in each task first.  The commonest pairs,
``HEAD`` at most, are sent to all tasks as arrays; documents' other pairs are joined with their
counts as rows.  What a document holds travels through a table in the shared folder.

Texts that are null, empty, or not what their tokens spell (a character the second vocabulary reads
as a blank, for one) have no tokens: zeros and an empty digest.  Repeated rows count as so many
documents.  Ties for the highest count of an id are all best.  An empty table gives an empty result.
Columns of other names are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from postura.llm.byte_bpe import ByteVocabulary
from postura.llm.common import id_and_text, map_columns, stored, struct_type

PIECE_FILE = "piece_bpe_32k.model"
#: Pairs sent to all tasks at most: 17 bytes each.
HEAD = 1 << 20
#: Pairs that a task holds before it passes their counts on.
HELD = 1 << 22
#: Text bytes aligned at once.
BYTES_AT_ONCE = 1 << 20

ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
)
WEIGHED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, pair long, times long"
)


class PieceVocabulary:
    """The second vocabulary: pieces with byte fallback."""

    def __init__(self, file: str = PIECE_FILE):
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def _next_shared(x: np.ndarray, own: np.ndarray, other: np.ndarray, own_to: np.ndarray, other_to: np.ndarray) -> tuple:
    """Indices in ``own`` and ``other`` of the first shared value at or above ``own[x]``, below both limits; -1 if none."""
    found = np.full(len(x), -1)
    there = np.full(len(x), -1)
    active = np.arange(len(x))
    i = x.copy()
    while len(active):
        value = own[i]
        j = np.searchsorted(other, value)
        inside = j < other_to[active]
        active, i, j, value = active[inside], i[inside], j[inside], value[inside]
        met = other[j]
        same = met == value
        found[active[same]], there[active[same]] = i[same], j[same]
        active, met = active[~same], met[~same]
        i = np.searchsorted(own, met)
        inside = i < own_to[active]
        active, i = active[inside], i[inside]
    return found, there


def _last_shared(x: np.ndarray, own: np.ndarray, other: np.ndarray, own_from: np.ndarray, other_from: np.ndarray) -> tuple:
    """The same downwards: the last shared value at or below ``own[x]``, at or above both limits."""
    found = np.full(len(x), -1)
    there = np.full(len(x), -1)
    active = np.flatnonzero(x >= own_from)
    i = x[active]
    while len(active):
        value = own[i]
        j = np.searchsorted(other, value, "right") - 1
        inside = j >= other_from[active]
        active, i, j, value = active[inside], i[inside], j[inside], value[inside]
        met = other[j]
        same = met == value
        found[active[same]], there[active[same]] = i[same], j[same]
        active, met = active[~same], met[~same]
        i = np.searchsorted(own, met, "right") - 1
        inside = i >= own_from[active]
        active, i = active[inside], i[inside]
    return found, there


def shared_cuts(a: np.ndarray, b: np.ndarray, known_a: np.ndarray, known_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the shared values of two rising arrays, given some of them, the last ones among these.

    Each interval between known cuts is divided at a shared value near its middle until it has none.
    """
    cuts_a, cuts_b = [known_a], [known_b]
    # Inside of an interval: tokens a_from .. a_to and b_from .. b_to, the ends that border it excluded.
    a_from, b_from = np.r_[0, known_a[:-1] + 1], np.r_[0, known_b[:-1] + 1]
    a_to, b_to = known_a, known_b
    while True:
        open_ = (a_from < a_to) & (b_from < b_to)
        a_from, a_to, b_from, b_to = a_from[open_], a_to[open_], b_from[open_], b_to[open_]
        if not len(a_from):
            break
        middle = (a_from + a_to) // 2
        up_a, up_b = _next_shared(middle, a, b, a_to, b_to)
        down_a, down_b = _last_shared(middle - 1, a, b, a_from, b_from)
        up, down = up_a >= 0, down_a >= 0
        cuts_a += [up_a[up], down_a[down]]
        cuts_b += [up_b[up], down_b[down]]
        # Between the cut below the middle and the one above it there is none.
        halves = (
            np.r_[a_from[down], up_a[up] + 1],
            np.r_[down_a[down], a_to[up]],
            np.r_[b_from[down], up_b[up] + 1],
            np.r_[down_b[down], b_to[up]],
        )
        order = np.argsort(halves[0], kind="stable")
        a_from, a_to, b_from, b_to = (h[order] for h in halves)
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


class Aligner:
    """Groups and links of a list of texts."""

    def __init__(self, a: ByteVocabulary, b: PieceVocabulary):
        self.a, self.b = a, b
        self.size_a = np.array([len(x) for x in a.bytes_of])
        self.size_b = np.array([len(x) for x in b.bytes_of])
        self.shift = len(b.bytes_of).bit_length()
        # Each token's number with the mark that follows it: inside a group's side, or at its end.
        self.written = np.array(
            [f"{i}," for i in range(len(a.bytes_of))]
            + [f"{i}|" for i in range(len(a.bytes_of))]
            + [f"{i}," for i in range(len(b.bytes_of))]
            + [f"{i};" for i in range(len(b.bytes_of))],
            object,
        )

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids by both vocabularies; none where the second does not spell the text, as the byte-level one always does."""
        out: list[tuple[list[int], list[int]]] = []
        bytes_of = self.b.bytes_of.__getitem__
        for text, ids_b in zip(texts, self.b.encode([t or "" for t in texts]), strict=True):
            spelt = text and b"".join(map(bytes_of, ids_b)) == f" {text}".encode()
            out.append((self.a.encode(" " + text), ids_b) if spelt else ([], []))
        return out

    def __call__(self, texts: list[str | None]) -> list[tuple]:
        """``n_a, n_b, n_groups, n_links, groups, pairs``: groups as written, the links' id pairs as numbers."""
        tokens = self.tokens(texts)
        told = [t for t in tokens if t[0]]
        if not told:
            return [(0, 0, 0, 0, "", np.zeros(0, np.int64))] * len(texts)
        n_a, n_b = np.array([len(t[0]) for t in told]), np.array([len(t[1]) for t in told])
        ids_a = np.concatenate([np.array(t[0], np.int64) for t in told])
        ids_b = np.concatenate([np.array(t[1], np.int64) for t in told])
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        cuts_a, cuts_b = shared_cuts(ends_a, ends_b, to_a - 1, to_b - 1)
        # Groups of each text; tokens of either side before each group.
        to_group = np.searchsorted(cuts_a, to_a - 1, "right")
        group_a = np.searchsorted(cuts_a, np.arange(len(ids_a)))
        group_b = np.searchsorted(cuts_b, np.arange(len(ids_b)))
        before_b = np.r_[0, cuts_b[:-1] + 1]
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[cuts_a] = last_b[cuts_b] = True
        written = np.empty(len(ids_a) + len(ids_b), np.int64)
        V, W = len(self.size_a), len(self.size_b)
        written[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + last_a * V
        written[np.arange(len(ids_b)) + cuts_a[group_b] + 1] = 2 * V + ids_b + last_b * W
        # Every stretch between neighbouring ends of either side is a link.
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # merges two sorted runs
        ends = ends[np.r_[True, ends[1:] != ends[:-1]]]
        links = ids_a[np.searchsorted(ends_a, ends)] << self.shift | ids_b[np.searchsorted(ends_b, ends)]
        to_link = np.searchsorted(ends, ends_a[to_a - 1], "right")
        out, k = [], 0
        groups = links_at = at = 0
        for has, _ in tokens:
            if not has:
                out.append((0, 0, 0, 0, "", np.zeros(0, np.int64)))
                continue
            to = int(to_a[k] + to_b[k])
            text = "".join(self.written[written[at:to]].tolist())[:-1]
            g, n = int(to_group[k]), int(to_link[k])
            out.append((int(n_a[k]), int(n_b[k]), g - groups, n - links_at, text, links[links_at:n]))
            groups, links_at, at, k = g, n, to, k + 1
        return out


def _pack(pairs: np.ndarray) -> bytes:
    """Distinct pairs, as rising differences, and how often each occurs; compressed."""
    distinct, times = np.unique(pairs, return_counts=True)
    gaps = np.diff(distinct, prepend=0).astype("<u4")
    planes = np.frombuffer(gaps.tobytes(), np.uint8).reshape(-1, 4).T.tobytes()
    data = np.uint32(len(gaps)).tobytes() + planes + times.astype("<u4").tobytes()
    return zstandard.compress(data, 1)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    gaps = np.frombuffer(raw, np.uint8, 4 * n, 4).reshape(4, n).T.copy().view("<u4")[:, 0]
    return np.cumsum(gaps, dtype=np.int64), np.frombuffer(raw, "<u4", n, 4 + 4 * n).astype(np.int64)


def align(docs: DataFrame, make_a: Callable = ByteVocabulary, make_b: Callable = PieceVocabulary) -> DataFrame:
    """``ALIGNED``: what each document holds; ``row`` tells rows apart, ``pairs`` packs its linked id pairs."""

    def make():
        aligner = Aligner(make_a(), make_b())
        row = (TaskContext.get().partitionId() << 36) - 1

        def work(b: pa.RecordBatch) -> dict:
            nonlocal row
            out: dict[str, list] = {f.split()[0]: [] for f in ALIGNED.split(", ")}
            texts = b["text"].to_pylist()
            at, held = 0, 0
            found: list[tuple] = []
            for k, text in enumerate(texts):
                held += len(text or "")
                if held >= BYTES_AT_ONCE or k + 1 == len(texts):
                    found += [(*f[:4], f[4], _pack(f[5])) for f in aligner(texts[at : k + 1])]
                    at, held = k + 1, 0
            for doc_id, (n_a, n_b, n_groups, n_links, groups, pairs) in zip(b["doc_id"].to_pylist(), found, strict=True):
                row += 1
                digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                for c, x in zip(out, (row, doc_id, n_a, n_b, n_groups, n_links, digest, pairs), strict=True):
                    out[c].append(x)
            return out

        return work

    return map_columns(id_and_text(docs), make, ALIGNED)


def pair_counts(aligned: DataFrame, shift: int) -> DataFrame:
    """``pair, n, best``: documents that hold an id pair linked, and whether no pair of its first id has more."""
    schema = "pair long, n long"
    fields = to_arrow_schema(struct_type(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            distinct, at = np.unique(np.concatenate([pair, *held]), return_inverse=True)
            weight = np.concatenate([n, np.ones(size, np.int64)])
            return distinct, np.bincount(at, weight, len(distinct)).astype(np.int64)

        for batch in batches:
            for data in batch["pairs"].to_pylist():
                held.append(_unpack(data)[0])
                size += len(held[-1])
                if size < HELD:
                    continue
                pair, n = merged()
                held, size = [], 0
                if len(pair) >= HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], schema=fields)
                    pair = n = np.zeros(0, np.int64)
        pair, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], schema=fields)

    counts = aligned.select("pairs").mapInArrow(run, schema).groupBy("pair").agg(F.sum("n").alias("n"))
    # An id has as many pairs as the second vocabulary has entries at most.
    highest = F.max("n").over(Window.partitionBy(F.shiftright("pair", shift)))
    return counts.select("pair", "n", (F.col("n") == highest).alias("best"))


def _commonest(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs, counts and best marks of all pairs of a count or more, ``most`` at most; and that count."""
    # Steps of an eighth of a doubling: a few hundred at most.
    steps = counts.groupBy(F.floor(8 * F.log2("n")).alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("n"))
    least, held = (1 << 62), 0
    for step in sorted(steps.collect(), key=lambda s: -s["step"]):
        if held + step["pairs"] > most:
            break
        held, least = held + step["pairs"], step["n"]
    rows = counts.filter(F.col("n") >= least).select("pair", "n", "best").toArrow()
    order = np.argsort(rows["pair"].to_numpy())
    pair, n, best = (rows[c].to_numpy()[order] for c in ("pair", "n", "best"))
    return pair, n, best, least


def _weigh(batches: Iterator[pa.RecordBatch], head, fields: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each document with the sums of its common pairs, and one for each other pair it holds."""
    pair, n, best = head.value
    names = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    nothing = [None] * 7
    for batch in batches:
        rows: list[list] = []
        for *own, data in zip(*(batch[c].to_pylist() for c in (*names, "pairs")), strict=True):
            held, times = _unpack(data)
            at = np.minimum(np.searchsorted(pair, held), max(len(pair) - 1, 0))
            known = pair[at] == held if len(pair) else np.zeros(len(held), bool)
            at, of_known = at[known], times[known]
            rows.append([*own[:6], int(of_known[best[at]].sum()), int((of_known * n[at]).sum()), own[6], None, None])
            for p, t in zip(held[~known].tolist(), times[~known].tolist(), strict=True):
                rows.append([own[0], *nothing, None, p, t])
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields
            )


def link_documents(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document."""
    spark = docs.sparkSession
    shift = PieceVocabulary().model.get_piece_size().bit_length()
    aligned = stored(align(docs), "aligned")
    counts = stored(pair_counts(aligned, shift), "pair-counts")
    *common, least = _commonest(counts, head)
    sent = spark.sparkContext.broadcast(tuple(common))
    fields = to_arrow_schema(struct_type(WEIGHED))
    weighed = stored(aligned.mapInArrow(partial(_weigh, head=sent, fields=fields), WEIGHED), "weighed")
    rare = counts.filter(F.col("n") < least)
    others = weighed.filter("pair is not null").select("row", "pair", "times").join(rare, "pair")
    sums = others.select(
        "row",
        F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum"),
    )
    own = weighed.filter("pair is null").drop("pair", "times")
    both = own.unionByName(sums, allowMissingColumns=True).groupBy("row")
    whole = both.agg(
        F.max("doc_id").alias("doc_id"),
        *[F.max(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
        *[F.sum(c).alias(c) for c in ("n_best", "count_sum")],
        F.max("groups_sha256").alias("groups_sha256"),
    )
    return whole.drop("row")
