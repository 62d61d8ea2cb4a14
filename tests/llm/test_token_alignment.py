"""Alignment of two vocabularies against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from postura.llm import token_alignment
from postura.llm.byte_bpe import ByteVocabulary
from postura.llm.token_alignment import Aligner, PieceVocabulary, link_documents, shared_cuts

NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def vocabularies():
    return ByteVocabulary(), PieceVocabulary()


def brute(rows, vocabularies):
    a_of, b_of = vocabularies
    found = []
    for doc_id, text in rows:
        ids_a = a_of.library.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b_of.model.encode(text) if text else []
        bytes_a, bytes_b = (b"".join(v.bytes_of[i] for i in ids) for v, ids in ((a_of, ids_a), (b_of, ids_b)))
        if not text or bytes_a != f" {text}".encode() or bytes_b != bytes_a:
            found.append((doc_id, [], [], "", []))
            continue
        ends_a = np.cumsum([len(a_of.bytes_of[i]) for i in ids_a]).tolist()
        ends_b = np.cumsum([len(b_of.bytes_of[i]) for i in ids_b]).tolist()
        at_a, at_b = ({e: k for k, e in enumerate(ends)} for ends in (ends_a, ends_b))
        groups, i, j = [], 0, 0
        for cut in sorted({*ends_a} & {*ends_b}):
            i_to, j_to = at_a[cut] + 1, at_b[cut] + 1
            groups.append(",".join(map(str, ids_a[i:i_to])) + "|" + ",".join(map(str, ids_b[j:j_to])))
            i, j = i_to, j_to
        links, j = [], 0
        for i, end in enumerate(ends_a):
            begin = ends_a[i - 1] if i else 0
            while ends_b[j] <= begin:
                j += 1
            k = j
            while k < len(ids_b) and (ends_b[k - 1] if k else 0) < end:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        found.append((doc_id, ids_a, ids_b, ";".join(groups), links))
    n = Counter(pair for *_, links in found for pair in {*links})
    most: dict = {}
    for (a, _), count in n.items():
        most[a] = max(most.get(a, 0), count)
    return sorted(
        (
            (
                doc_id, len(ids_a), len(ids_b), groups.count(";") + 1 if groups else 0, len(links),
                sum(n[p] == most[p[0]] for p in links), sum(n[p] for p in links),
                hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            )
            for doc_id, ids_a, ids_b, groups, links in found
        ),
        key=str,
    )


def linked(df, **how):
    return sorted((tuple(r[c] for c in NAMES) for r in link_documents(df, **how).collect()), key=str)


ODD = [
    (0, None),
    (1, ""),
    (2, "a▁b"),
    (3, "  x  \n\n y\t"),
    (4, "日本語テキスト mixed <s> </s> <unk> <|endoftext|> <0x0A> \x00z"),
    (5, "a" * 300 + "1" * 900 + " " * 50),
    (6, "the same words"),
    (6, "the same words"),
    (7, "the same words"),
    (None, "The row that lost its number, écoutez l'été 😀 ẛ̣"),
    (8, "long story of many words, " * 5_000),
]


@pytest.mark.parametrize("head", [0, 20, 1 << 20])
def test_odd_texts_with_any_number_of_common_pairs(spark, vocabularies, head):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as row", "2 as pair", "'x' as n_best")
    assert linked(df, head=head) == brute(ODD, vocabularies)


def test_no_documents(spark):
    assert linked(spark.createDataFrame([], "doc_id long, text string")) == []


def test_given_documents(spark, docs, vocabularies):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    expected = brute(rows, vocabularies)
    assert linked(docs) == expected and linked(docs, head=500) == expected


def test_small_batches_count_alike(spark, docs, vocabularies, monkeypatch):
    for name, value in (("HELD", 64), ("BYTES_AT_ONCE", 500)):
        monkeypatch.setattr(token_alignment, name, value)
    some = docs.orderBy("doc_id").limit(40)
    assert linked(some) == brute([(r["doc_id"], r["text"]) for r in some.collect()], vocabularies)


@pytest.mark.parametrize("seed", range(20))
def test_cuts_of_random_borders(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 400))
    share = rng.random(2) * 0.9 + 0.05
    a, b = (np.flatnonzero(np.r_[rng.random(n) < s, True]) for s in share)
    cuts_a, cuts_b = shared_cuts(a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
    assert a[cuts_a].tolist() == b[cuts_b].tolist() == sorted({*a.tolist()} & {*b.tolist()})


def test_a_long_text_without_cuts():
    a, b = np.r_[np.arange(0, 40_000, 2), 40_001], np.r_[np.arange(1, 40_000, 2), 40_001]
    cuts_a, _ = shared_cuts(a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
    assert cuts_a.tolist() == [len(a) - 1]


def test_texts_of_a_batch_do_not_touch(vocabularies):
    aligner = Aligner(*vocabularies)
    texts = ["one two", None, "three", "x▁", "fouré"]
    assert [r[:5] for r in aligner(texts)] == [aligner([t])[0][:5] for t in texts]
