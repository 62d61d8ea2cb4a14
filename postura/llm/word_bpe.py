"""Text to subword ids with a public vocabulary of word-ending BPE, word by word and remembered.

Normalising and splitting follow the vocabulary file: NFC, lower case per character, then
contractions, runs of letters, single digits, runs of anything else.  Where that is the same in all
Unicode versions, a text is split at once; else its white-space runs, which no pre-token crosses, are
split by the library.  A word met before is looked up.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable

import public_tokenizers
import regex
from tokenizers import Tokenizer

FILE = "word_bpe_49k.json"
#: Keys remembered per task, kind and generation, and the longest one: a bound on bytes, as a value is
#: a few bytes a character.
REMEMBERED, LONGEST = 150_000, 64

# Splitting pattern of the vocabulary file.
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# The same for ASCII in lower case.
_SPLIT_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\x0b\x0c\ra-z0-9]+")
# Below this, character classes agree between all Unicode versions in use; others go by the library.
_PLAIN = regex.compile("[\x00-ԯ]*")
# White space to str.split, but not to the vocabulary's pattern.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    def __init__(self, file: str = FILE):
        self.library = Tokenizer.from_file(public_tokenizers.path(file))
        with open(public_tokenizers.path(file), encoding="utf-8") as f:
            data = json.load(f)
        self.end = data["model"]["end_of_word_suffix"]
        self.ids: dict[str, int] = data["model"]["vocab"]
        self.merges = [tuple(m) for m in data["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = [""] * (max([*self.ids.values(), *self.special.values()]) + 1)
        for token, i in (self.ids | self.special).items():
            self.tokens[i] = token
        self.alphabet = byte_alphabet()


class _Remembering(dict):
    """Values by key, in two generations: a full one becomes the old one, and what is met again returns.

    Long keys, as texts without blanks make them, are not kept.
    """

    def __init__(self, compute: Callable, most: int = REMEMBERED):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) > LONGEST:
            return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def library_words(v: Vocabulary) -> Callable[[str], list[int]]:
    """Ids of one pre-token, by the tokenizers library."""
    tokenize = v.library.model.tokenize
    return lambda word: [t.id for t in tokenize(word)]


def _plain_words(text: str) -> list[str] | None:
    """Words of a text without doubtful characters; None for others."""
    if text.isascii():
        return _SPLIT_ASCII.findall(text.lower())
    if _PLAIN.fullmatch(text):
        return _SPLIT.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
    return None


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    ``word_ids`` turns one pre-token, written in the byte alphabet, into ids.
    """

    def __init__(self, v: Vocabulary, word_ids: Callable[[str], list[int]]):
        self.v = v
        self.word_ids = word_ids
        self.special = regex.compile("|".join(regex.escape(s) for s in v.special)) if v.special else None
        self.marks = {s[:2] for s in v.special}
        self.bytes_of = {b: c for b, c in enumerate(v.alphabet)}
        self.words = _Remembering(self._word)
        self.runs = _Remembering(self._run)

    def _packed(self, byte_word: str) -> bytes:
        ids = self.word_ids(byte_word)
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self.bytes_of)
        return self._packed(word)  # printable ASCII stands for itself

    def _run(self, run: str) -> bytes:
        words = _plain_words(run)
        if words is not None:
            return b"".join(map(self.words.__getitem__, words))
        normal = self.v.library.normalizer.normalize_str(run)
        return b"".join([self._packed(w) for w, _ in self.v.library.pre_tokenizer.pre_tokenize_str(normal)])

    def encode_run(self, run: str) -> bytes:
        """Ids of one run without white space or special tokens, not remembered: for runs met once."""
        return self._run(run)

    def _plain(self, text: str) -> bytes:
        if any(s in text for s in _SEPARATORS):
            runs = regex.split(r"\s+", text)
            return b"".join([self.runs[r] for r in runs if r])
        words = _plain_words(text)
        if words is None:
            return b"".join(map(self.runs.__getitem__, text.split()))
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special is None or not any(m in text for m in self.marks):
            return self._plain(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += [self._plain(text[at : m.start()]), struct.pack("<I", self.v.special[m[0]])]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])
