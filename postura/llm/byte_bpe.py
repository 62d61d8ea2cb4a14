"""Text to subword ids with a public byte-level vocabulary, and back.

Ids are those of the tokenizers library.  Texts whose character classes are the same in all Unicode
versions in use go through the faster rank encoder, which agrees with it there; others through the
library itself.  Strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import base64
import json

import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

from postura.llm.word_bpe import byte_alphabet

FILE, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
_PLAIN = regex.compile("[\x00-ԯ‐-‧‰-⁞]*")


class ByteVocabulary:
    def __init__(self, file: str = FILE, ranks: str = RANKS):
        self.library = Tokenizer.from_file(public_tokenizers.path(file))
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        with open(public_tokenizers.path(file), encoding="utf-8") as f:
            data = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = data["model"]["vocab"] | special
        self.bytes_of: list[bytes] = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = token.encode() if token in special else bytes(map(byte_of.__getitem__, token))
        with open(public_tokenizers.path(ranks), "rb") as f:
            by_bytes = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=by_bytes, special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        if _PLAIN.fullmatch(text):
            return self.ranks.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()
