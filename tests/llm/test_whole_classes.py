"""Near-duplicate links that blocks or the first forest hide."""

from __future__ import annotations

import numpy as np

from postura.llm import order_minhash
from tests.llm.test_table_operators import brute_classes


def classes_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(rows).collect()}


def test_near_copies_among_texts_of_one_template_meet_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "BLOCK", 1)
    rng = np.random.default_rng(7)
    base = [f"word{k}" for k in rng.integers(0, 9000, 300)]
    texts = []
    for k in range(48):  # about 0.7 alike
        words = list(base)
        for at in rng.choice(300, 5, replace=False):
            words[at] = f"edit{k}x{at}"
        texts.append(" ".join(words))
    texts += [f"{t} end" for t in texts[:12]]
    found = classes_of(spark, texts)
    assert found == brute_classes(dict(enumerate(texts)))
    assert all(found[48 + k] == found[k] for k in range(12))


def test_signatures_estimate_the_likeness_of_long_texts():
    rng = np.random.default_rng(0)
    shared, *own = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (4000, 2000, 2000))
    a, b = (np.frombuffer(order_minhash.signature(np.r_[shared, x]), np.uint8) for x in own)
    assert abs((a == b).mean() - 0.5) < 0.12


def test_a_link_that_the_first_forest_leaves_out_is_found(spark):
    # The first two are 0.807 alike, all other pairs just under 0.8; estimates rank others above the link.
    rng = np.random.default_rng(18)
    base = [f"word{k}" for k in rng.integers(0, 9000, 800)]
    places = iter(rng.permutation(np.arange(5, 795, 5)).tolist())
    texts = []
    for k, n in enumerate([8, 9] + [10] * 8):
        words = list(base)
        for p in range(n):
            words[next(places)] = f"edit{k}x{p}"
        texts.append(" ".join(words))
    found = classes_of(spark, texts)
    assert found == brute_classes(dict(enumerate(texts))) == {0: 0, 1: 0, **{k: k for k in range(2, 10)}}


def test_a_link_that_the_signatures_underrate_is_found(spark):
    rng = np.random.default_rng(1570)
    base = [f"word{k}" for k in rng.integers(0, 9000, 94)]
    other = list(base)
    for at in (20, 60):
        other[at] = f"edit{at}"
    texts = [" ".join(base), " ".join(other)]
    a, b = (np.frombuffer(order_minhash.signature(order_minhash.Shingles()(t)), np.uint8) for t in texts)
    assert (a == b).mean() < 0.72  # the link is 0.8
    assert classes_of(spark, texts) == {0: 0, 1: 0}


def test_shingles_that_many_texts_share_come_last_and_alike_texts_meet():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = int(rng.integers(5, 400))
        shared, *own = (rng.integers(0, 1 << 63, k).astype(np.uint64) for k in (n, n // 9, n // 9))
        a, b = (np.r_[shared, x] for x in own)  # at 9/11 or more
        common = np.sort(shared[: n // 2])
        first = [order_minhash.prefix(x, common, np.full(len(common), 9)) for x in (a, b)]
        assert len(np.intersect1d(*first)) > 0
        assert all(len(np.intersect1d(x, common)) == 0 or len(x) > len(x_all) - n // 2 for x, x_all in zip(first, (a, b), strict=True))
        counts = [np.frombuffer(order_minhash.spread(x), np.uint8) for x in (a, b)]
        assert order_minhash.likest(len(a), counts[0], len(b), counts[1]) >= n / (len(a) + len(b) - n)


def test_long_texts_that_are_alike_meet_in_a_part():
    rng = np.random.default_rng(9)
    none = np.zeros(0, np.uint64)
    for shared in (6, 90, 440, 505, 515, 1900, 2040, 2100, 9000):
        for _ in range(8):
            base = rng.integers(0, 1 << 63, shared).astype(np.uint64)
            extra = int(shared / 0.8 - shared)
            few = int(rng.integers(0, extra + 1))
            a, b = (np.r_[base, rng.integers(0, 1 << 63, k).astype(np.uint64)] for k in (few, extra - few))
            found = []
            for s in (a, b):
                parts = {p["part"]: p for p in order_minhash.parts_of(s, none, none)}
                found.append({k: (p["n"] or len(s), p["spread"] or order_minhash.spread(s), set(p["prefix"].tolist())) for k, p in parts.items()})
            met = [k for k in found[0].keys() & found[1].keys() if not found[0][k][2].isdisjoint(found[1][k][2])]
            bounds = []
            for k in met:
                (n, x, _), (m, y, _) = found[0][k], found[1][k]
                x, y = (np.frombuffer(z, np.uint8) for z in (x, y))
                bounds.append(order_minhash.likest(n, x, m, y))
            assert max(bounds) >= order_minhash.LEAST


def test_long_texts_that_share_a_passage_are_not_paired_and_a_pair_is_offered_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = []
    for k in range(8):  # by twos, so that the passage is not a common one
        own = [f"own{k}x{j}" for j in rng.integers(0, 1 << 40, 9000)]
        texts.append(" ".join([f"shared{k // 2}x{j}" for j in range(200)] + own))
    base = [f"word{k}" for k in rng.integers(0, 9000, 400)]
    near = list(base)
    for at in range(20, 380, 40):  # 0.796 alike
        near[at] = f"edit{at}"
    texts += [" ".join(w) for w in (base, near, base[:200] + [f"other{k}" for k in range(200)])]
    rows, grouped = [], order_minhash._by_group

    def recorded(df, group, rest, closed, schema):
        out = grouped(df, group, rest, closed, schema)
        if schema == "a long, b long":
            rows.append(out.count())
        return out

    monkeypatch.setattr(order_minhash, "_by_group", recorded)
    found = classes_of(spark, texts)
    assert found == {k: k for k in range(11)}
    assert rows == [1, 1]
