"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Each pre-token is a row of symbols.  A leaf of the tree holds the rank of the pair that begins at a
position, together with the position; the root is then the leftmost pair of the lowest rank.  A
merge changes three leaves at most, each in logarithmic time, until the root holds no pair.

Null and empty texts have no ids and decode to the empty text.  Repeated rows give repeated results;
an empty table gives none.  A very long pre-token costs n log n.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postura.llm.common import id_and_text, map_columns
from postura.llm.word_bpe import FILE, Encoder, Vocabulary

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class SegmentTreeMerger:
    """Ids of one pre-token."""

    def __init__(self, v: Vocabulary):
        self.ids, self.end = v.ids, v.end
        self.bits = len(v.tokens).bit_length()
        # Two ids as one number give the pair's rank and, in the low bits, what it becomes.
        self.pairs = {
            v.ids[left] << self.bits | v.ids[right]: rank << self.bits | v.ids[left + right]
            for rank, (left, right) in enumerate(v.merges)
        }
        self.ranks = len(v.merges)

    def __call__(self, word: str) -> list[int]:
        ids, pair_of, bits = self.ids, self.pairs.get, self.bits
        symbols = [ids[c] for c in word[:-1] if c in ids]
        last = ids.get(word[-1:] + self.end)
        if last is not None:
            symbols.append(last)
        n = len(symbols)
        if n < 2:
            return symbols
        width = 1 << (n - 2).bit_length()
        at_bits = n.bit_length()
        at_mask = (1 << at_bits) - 1
        none = self.ranks << at_bits | at_mask
        tree = [none] * (2 * width)
        become = [0] * n
        low = (1 << bits) - 1
        left = symbols[0]
        for i in range(n - 1):
            right = symbols[i + 1]
            found = pair_of(left << bits | right)
            if found is not None:
                tree[width + i] = found >> bits << at_bits | i
                become[i] = found & low
            left = right
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a <= b else b

        before = list(range(-1, n))
        after = list(range(1, n + 1))
        while (least := tree[1]) != none:
            i = least & at_mask
            j = after[i]
            k = after[i] = after[j]
            merged = symbols[i] = become[i]
            symbols[j] = -1
            changed = [(i, none)]
            if k < n:
                before[k] = i
                found = pair_of(merged << bits | symbols[k])
                if found is not None:
                    changed = [(i, found >> bits << at_bits | i)]
                    become[i] = found & low
                changed.append((j, none))
            h = before[i]
            if h >= 0:
                found = pair_of(symbols[h] << bits | merged)
                if found is None:
                    changed.append((h, none))
                else:
                    changed.append((h, found >> bits << at_bits | h))
                    become[h] = found & low
            for p, value in changed:
                p += width
                if tree[p] == value:
                    continue
                tree[p] = value
                while p > 1:
                    other = tree[p ^ 1]
                    if other < value:
                        value = other
                    p >>= 1
                    if tree[p] == value:
                        break
                    tree[p] = value
        return [s for s in symbols if s >= 0]


def decode(v: Vocabulary, ids: list[int]) -> str:
    """The vocabulary file names no decoder, so tokens are joined by blanks as they are."""
    return " ".join(map(v.tokens.__getitem__, ids))


def encode_documents(docs: DataFrame, file: str = FILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids binary`` (little-endian unsigned 32 bits), row by row, without a shuffle."""

    def make():
        encoder = Encoder(v := Vocabulary(file), SegmentTreeMerger(v))
        return lambda b: {"doc_id": b["doc_id"], "ids": [encoder.encode(t) for t in b["text"].to_pylist()]}

    return map_columns(id_and_text(docs, id_col, text_col), make, "doc_id long, ids binary")


def round_trip(docs: DataFrame, file: str = FILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of each text's ids and of the text decoded from them."""

    def make():
        v = Vocabulary(file)
        encoder = Encoder(v, SegmentTreeMerger(v))

        def work(b: pa.RecordBatch) -> dict:
            out = {"doc_id": b["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in b["text"].to_pylist():
                data = encoder.encode(text)
                ids = np.frombuffer(data, "<u4").tolist()
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decode(v, ids).encode()).hexdigest())
            return out

        return work

    return map_columns(id_and_text(docs, id_col, text_col), make, SCHEMA)
