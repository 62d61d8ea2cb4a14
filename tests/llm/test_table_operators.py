"""Operators on tables against brute force."""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from postura.llm import hilbert_shards, order_minhash, packing, version_sketch
from postura.llm.word_bpe import FILE


def test_packing_is_whole_gapless_and_tight(docs):
    library = Tokenizer.from_file(public_tokenizers.path(FILE))
    rows = packing.pack(docs).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for d in docs.collect():
        ids = [*library.encode(d["text"], add_special_tokens=False).ids, 1]
        own = sorted(pieces[d["doc_id"]], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"]) for r in own] == [(k, 4096 * k) for k in range(-(-len(ids) // 4096))]
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + 4096], "<u4")
            assert (r["length"], r["ids_crc32"]) == (len(part), zlib.crc32(part.tobytes()))
    for held in sequences.values():
        held.sort(key=lambda r: r["offset"])
        ends = list(itertools.accumulate(r["length"] for r in held))
        assert [r["offset"] for r in held] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(sequences) <= 1.01 * -(-sum(r["length"] for r in rows) // 4096) + 1


def test_genetic_packing_beats_or_equals_best_fit():
    rng = np.random.default_rng(0)
    lengths = rng.integers(200, 700, 90).tolist()
    first = packing.best_fit(packing.Packing([], []), sorted(range(90), key=lambda i: -lengths[i]), lengths, 1000)
    grown = packing.evolve([], lengths, 1000, rng)
    for p in grown:
        assert sorted(i for b in p.bins for i in b) == list(range(90))
        assert p.fill == [sum(lengths[i] for i in b) for b in p.bins] and max(p.fill) <= 1000
    assert grown[0].rank() <= first.rank()


def test_packing_over_several_shards_and_islands(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 900, 400).tolist()
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    rows = packing.pack_shards(items, 8, 0, 1000).collect()
    assert sorted(r["item"] for r in rows) == list(range(400))
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], lengths[r["item"]]))
    for places in held.values():
        places.sort()
        assert [o for o, _ in places] == [0, *itertools.accumulate(n for _, n in places)][:-1]
        assert sum(n for _, n in places) <= 1000


pieces = st.lists(st.sampled_from(["One. ", "Two? ", "Three!\n", "four five ", "x" * 30]), max_size=30).map("".join)


@settings(max_examples=200, deadline=None)
@given(pieces, pieces)
def test_peeling_recovers_the_differences(a, b):
    x, y = version_sketch.digests(a), version_sketch.digests(b)
    assert len(set(x.tolist())) == len(x)
    assert version_sketch.differences([x, y, x], [y, x, x]) == [len(np.setxor1d(x, y))] * 2 + [0]


def test_peeling_names_the_digests_and_their_side():
    x, y = (np.arange(1, n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for n in (100, 97))
    apart = version_sketch.sketch([x], 24).minus(version_sketch.sketch([y], 24))
    empty, _, key, sign = apart.peel()
    assert empty.all() and set(key.tolist()) == set(x[-3:].tolist()) and (sign == 1).all()


def test_versions_follow_each_other(spark, docs, monkeypatch):
    monkeypatch.setattr(version_sketch, "RANGE_BYTES", 20_000)  # many ranges
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    order = sorted(texts, reverse=True)
    rows = version_sketch.compare_versions(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        own = texts[r["doc_id"]]
        after = texts[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        edited = own[: len(own) - len(own) // 3] + after[: len(own) // 3]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, other in (("near_edited", edited), ("near_next", after)):
            x, y = version_sketch.digests(own), version_sketch.digests(other)
            assert abs(r[name] - (1 - len(np.setxor1d(x, y)) / max(1, len(x) + len(y)))) < 1e-12
    same = defaultdict(set)
    for r in rows:
        same[texts[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(x) == 1 for x in same.values())


def test_hilbert_curve_visits_neighbours(spark):
    n, bits = 3, 3
    grid = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=n)), "a int, b int, c int")
    rows = hilbert_shards.hilbert_index(grid, ["a", "b", "c"], bits, "at").orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(1 << n * bits))
    for p, q in itertools.pairwise(rows):
        assert sum(abs(p[c] - q[c]) for c in "abc") == 1


def test_shards_are_even_gapless_and_clustered(docs, monkeypatch):
    monkeypatch.setattr(hilbert_shards, "PART_ROWS", 3)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = hilbert_shards.shard_rows(docs, 7).collect()
    counts = Counter(r["shard"] for r in rows)
    assert sorted(counts) == list(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for k in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == k) == list(range(counts[k]))
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    placed = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert all(a["curve"] <= b["curve"] for a, b in itertools.pairwise(placed))


def shingles(text):
    words, seen, out = text.lower().split(), Counter(), set()
    for k in range(max(1, len(words) - 4) if words else 0):
        gram = tuple(words[k : k + 5])
        out.add((gram, seen[gram]))
        seen[gram] += 1
    return out


def brute_classes(texts):
    sets, root = {k: shingles(t) for k, t in texts.items()}, {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        near = texts[a] == texts[b]
        if not near and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) > 0:
            both = len(x & y)
            near = both >= 0.8 * (len(x) + len(y) - both) - 1e-9
        if near and find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in texts}


def test_near_duplicates_equal_brute_force(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs).collect()}
    assert found == brute_classes(texts)


def test_a_large_group_of_edited_copies_is_one_class(spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = [f"word{k}" for k in rng.integers(0, 5000, 300)]
    rows = [(0, " ".join(base))]
    for k in range(1, 120):  # each near the first, few near each other
        words = list(base)
        for at in rng.choice(300, 5, replace=False):
            words[at] = f"edit{k}x{at}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"other{x}" for x in rng.integers(0, 5000, 200))) for k in range(40)]
    found = order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute_classes(dict(rows))


def test_order_matters_to_the_alignment():
    shingle = order_minhash.Shingles()
    words = [f"w{k}" for k in range(200)]
    own = shingle(" ".join(words))
    assert order_minhash.ordered_likeness(own, own) == 1
    assert order_minhash.ordered_likeness(own, shingle(" ".join(words[100:] + words[:100]))) == 0
    assert 0.8 <= order_minhash.ordered_likeness(own, shingle(" ".join([*words[:99], "new", *words[100:]]))) < 1


def test_stars_connect_long_chains(spark):
    links = [(f"n{k:03}", f"n{k + 1:03}") for k in range(60) if k != 30] + [("z1", "z2")]
    found = {r["node"]: r["root"] for r in order_minhash.classes(spark.createDataFrame(links, "a string, b string")).collect()}
    assert all(found[f"n{k:03}"] == "n000" for k in range(1, 31))
    assert all(found[f"n{k:03}"] == "n031" for k in range(32, 61)) and found["z2"] == "z1"


@pytest.fixture(scope="module")
def staged(spark, docs, sf_dir):
    out, now = [], docs
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir).cache()
        out.append({} if stage is corpus_pipeline.pack else {r["doc_id"]: r for r in now.collect()})
    return {r["doc_id"]: r for r in docs.collect()}, out, now.collect()


def test_pipeline_stages_take_effect(spark, staged, sf_dir):
    given_rows, (told, good, single, clean, _), packed = staged
    assert set(told) >= set(good) >= set(single) == set(clean)
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    fine = [k in good for k in told if k in labels and labels[k]["quality"] == 1 and not labels[k]["toxic"]]
    assert np.mean(fine) >= 0.98
    classes = brute_classes({k: r["text"] for k, r in good.items()})
    assert set(single) == set(classes.values())
    assert not any("@" in r["text"] and ".example.com" in r["text"] for r in clean.values())
    changed = {k for k in clean if clean[k]["text"] != given_rows[k]["text"]}
    assert all("[" in clean[k]["text"] for k in changed)
    assert {r["doc_id"] for r in packed} == set(clean)


def test_run_equals_the_stages(spark, staged, sf_dir):
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(key, staged[2]))
