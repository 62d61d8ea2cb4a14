"""Conversations as token ids with a loss mask, assembled on the level of tokens, and read back.

A turn is ``START role NEWLINE text END NEWLINE``.  Role and text are encoded separately, so no token
spans a border, and START and END are reserved ids beyond the vocabulary that are spliced between
them: nothing a text holds can become one.  In the formatted text these ids are written
``<|im_start|>`` and ``<|im_end|>``; where a text holds such a string, with any number of backslashes
after its ``<``, one more backslash is put there, and taken off on reading.  Escaping is one to one,
so each text comes back as it was.  Line ends and backslashes of a role are escaped too.

Turns are encoded where they lie, row by row, so a long conversation is dealt over tasks; only ids
are then brought together by conversation, in sorted order, and walked through as a stream.  The ids
of a conversation are returned in pieces of whole turns.  The loss mask of a piece is the running sum
of +1 where a learnt text begins and -1 where it ends.

Null role or text counts as empty.  Turns go by turn number, null first; ties by a hash of role and
text.  Equal rows are so many turns.  Rows without a conversation id are one conversation
without id.  An empty text of the assistant has no place under the mask.  An empty table gives an
empty result.  Columns of other names are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from postura.llm.byte_bpe import FILE, RANKS, ByteVocabulary
from postura.llm.common import map_columns, struct_type

START, END = "<|im_start|>", "<|im_end|>"
CONTROLS = (START, END, "<|endoftext|>")
LEARNT = "assistant"
#: A piece is closed at the end of the turn that brings it to so many ids.
PIECE_IDS = 1 << 18

ENCODED = "conv_id long, turn long, tie long, role string, n_head int, n_text int, ids binary"
FORMATTED = "conv_id long, piece int, n_turns int, ids binary, loss_mask binary"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)

_names = "|".join(regex.escape(c[1:]) for c in CONTROLS)
_CONTROL = regex.compile(rf"<(\\*)(?={_names})")
_ESCAPED = regex.compile(rf"<\\(\\*)(?={_names})")
_ROLE_ESCAPED = regex.compile(r"\\([\\n])")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1", text) if "|>" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1", text) if "|>" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


class ChatVocabulary(ByteVocabulary):
    """The byte-level vocabulary with two reserved ids behind it."""

    def __init__(self, file: str = FILE, ranks: str = RANKS):
        super().__init__(file, ranks)
        self.start, self.end = len(self.bytes_of), len(self.bytes_of) + 1
        self.bytes_of += [START.encode(), END.encode()]
        self.newline = self.encode("\n")
        #: Ids travel in the narrowest type that holds them all.
        self.packed = "<u2" if len(self.bytes_of) <= 1 << 16 else "<u4"


def encoded_turns(rows: DataFrame, file: str = FILE, ranks: str = RANKS) -> DataFrame:
    """``ENCODED`` of every turn: its ids from START to the last NEWLINE, and how many stand before and in its text."""

    def make():
        v = ChatVocabulary(file, ranks)

        def work(b: pa.RecordBatch) -> dict:
            heads, texts, ids = [], [], []
            for role, text in zip(b["role"].to_pylist(), b["text"].to_pylist(), strict=True):
                head = [v.start, *v.encode(escape_role(role) + "\n")]
                body = v.encode(escape(text))
                heads.append(len(head))
                texts.append(len(body))
                ids.append(np.array([*head, *body, v.end, *v.newline], v.packed).tobytes())
            kept = {c: b[c] for c in ("conv_id", "turn", "tie", "role")}
            return kept | {"n_head": heads, "n_text": texts, "ids": ids}

        return work

    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).withColumn("tie", F.xxhash64("role", "text"))
    return map_columns(turns, make, ENCODED)


def _piece(rows: list[tuple], packed: str) -> tuple[bytes, bytes]:
    """Ids of some turns in a row, and their loss mask."""
    ids = np.frombuffer(b"".join(r[-1] for r in rows), packed)
    lengths = np.array([len(r[-1]) for r in rows]) // np.dtype(packed).itemsize
    starts = np.cumsum(lengths) - lengths
    learnt = np.array([r[0] == LEARNT for r in rows], np.int64)
    begins = starts + [r[1] for r in rows]
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, begins, learnt)
    np.add.at(change, begins + [r[2] for r in rows], -learnt)
    return ids.astype("<u4").tobytes(), np.cumsum(change[:-1]).astype(np.uint8).tobytes()


def format_conversations(rows: DataFrame, file: str = FILE, ranks: str = RANKS) -> DataFrame:
    """``FORMATTED``: ids (little-endian, unsigned, 32 bits) and mask (a byte an id) of every conversation.

    The pieces of a conversation follow each other in its partition.
    """
    fields = to_arrow_schema(struct_type(FORMATTED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = ChatVocabulary(file, ranks).packed
        width = np.dtype(packed).itemsize
        at: tuple | None = None
        piece, held, size = 0, [], 0

        def closed() -> tuple:
            return (at[0], piece, len(held), *_piece(held, packed))

        for batch in batches:
            out, out_bytes = [], 0
            for conv_id, *row in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "n_head", "n_text", "ids")), strict=True):
                if held and (conv_id != at[0] or size >= PIECE_IDS):
                    out.append(closed())
                    out_bytes += 5 * size
                    piece = piece + 1 if conv_id == at[0] else 0
                    held, size = [], 0
                    if out_bytes > 4 << 20:
                        yield _batch(out, fields)
                        out, out_bytes = [], 0
                at = (conv_id,)
                held.append(tuple(row))
                size += len(row[-1]) // width
            if out:
                yield _batch(out, fields)
        if held:
            yield _batch([closed()], fields)

    gathered = encoded_turns(rows, file, ranks).repartition("conv_id")
    ordered = gathered.sortWithinPartitions("conv_id", "turn", "tie", "ids")
    return ordered.mapInArrow(run, FORMATTED)


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def turns_of(ids: np.ndarray, v: ChatVocabulary) -> Iterator[tuple[str, str]]:
    """Role and text of each turn, from ids alone."""
    for s, e in zip(np.flatnonzero(ids == v.start), np.flatnonzero(ids == v.end), strict=True):
        role, _, text = v.decode(ids[s + 1 : e].tolist()).partition("\n")
        yield unescape_role(role), unescape(text)


def learnt_texts(ids: np.ndarray, mask: np.ndarray, v: ChatVocabulary) -> Iterator[str]:
    """The text of each run of ids under the mask."""
    border = np.flatnonzero(np.diff(np.r_[0, mask.astype(np.int8), 0]))
    for s, e in border.reshape(-1, 2):
        yield unescape(v.decode(ids[s:e].tolist()))


def read_back(formatted: DataFrame, file: str = FILE, ranks: str = RANKS) -> DataFrame:
    """``DIGESTS`` of every conversation, from ids and mask alone.

    Pieces must follow each other as ``format_conversations`` leaves them; a stored table is to be
    repartitioned by ``conv_id`` and sorted by ``conv_id, piece`` first.
    """
    fields = to_arrow_schema(struct_type(DIGESTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = ChatVocabulary(file, ranks)
        at: tuple | None = None
        state = _Digest()
        for batch in batches:
            out = []
            for conv_id, ids, mask in zip(*(batch[c].to_pylist() for c in ("conv_id", "ids", "loss_mask")), strict=True):
                if at is not None and at[0] != conv_id:
                    out.append((at[0], *state.row()))
                    state = _Digest()
                at = (conv_id,)
                state.add(np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.uint8), v)
            if out:
                yield _batch(out, fields)
        if at is not None:
            yield _batch([(at[0], *state.row())], fields)

    return formatted.mapInArrow(run, DIGESTS)


class _Digest:
    def __init__(self, new: Callable = hashlib.sha256):
        self.turns, self.loss = new(), new()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, ids: np.ndarray, mask: np.ndarray, v: ChatVocabulary) -> None:
        self.chars += len(v.decode(ids.tolist()))
        for role, text in turns_of(ids, v):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for text in learnt_texts(ids, mask, v):
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
