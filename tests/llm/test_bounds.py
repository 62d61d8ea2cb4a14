"""Bounds on memory and samples, bands, the language background, recall of near copies."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postura.llm import language_id, order_minhash, tokeniser_fertility, weak_labels, word_bpe


def test_long_keys_are_not_remembered():
    seen = word_bpe._Remembering(len, most=3)
    assert seen["x" * 1_000] == 1_000 and not seen and not seen.old
    for k in range(10):
        assert seen["y" * k] == k
    assert len(seen) <= 3 and len(seen.old) <= 3


PROBES = ["xqzv kjwq zzxq", "Привет, как твои дела сегодня вечером?", "これは日本語の文です。今日は天気がいい。", "%%%% a $$$$"]


def test_texts_of_no_learned_language_are_rejected(spark, docs):
    model = language_id.learn(docs)
    rows = spark.createDataFrame(list(enumerate(PROBES)), "doc_id long, text string")
    assert language_id.keep_identified(rows, model).count() == 0
    judge = language_id.Judge(model)
    kept = [judge.gain(r["text"]) >= language_id.MARGIN for r in docs.select("text").filter("text is not null").collect()]
    assert np.mean(kept) > 0.99


def test_gain_is_what_counting_by_hand_gives():
    share = np.zeros((language_id.BUCKETS, 2))
    share[:3] = [[0.5, 0.1], [0.5, 0.2], [0.0, 0.7]]
    largest = share.max(axis=1, keepdims=True)
    model = language_id.Languages(["x", "y"], share / np.where(largest > 0, largest, 1), largest[:, 0])
    counts = np.zeros(language_id.BUCKETS, np.int64)
    counts[0] = counts[1] = 40
    assert model.mixture(counts)[0][0] == "x"
    by_hand = np.log2((1 - language_id.UNSEEN) * 0.5 * language_id.BUCKETS + language_id.UNSEEN)
    assert model.gain(counts) == pytest.approx(by_hand, abs=1e-3)
    assert model.gain(counts, symbols=80) == pytest.approx(by_hand / 2, abs=1e-3)


def test_rows_without_id_do_not_swell_the_training_sample(spark, monkeypatch):
    monkeypatch.setattr(weak_labels, "TRAINED", 20)
    rows = [(None, "The same short text for every row that has lost its id, again and again.")] * 300
    rows += [(None, f"A text of its own, number {k}, with a few more words behind it.") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    fitted = []
    fit = weak_labels.fit
    monkeypatch.setattr(weak_labels, "fit", lambda x, y: fitted.append(len(x)) or fit(x, y))
    model = weak_labels.learn(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert fitted and max(fitted) <= 20
    assert weak_labels.judge(df, model).count() == 500


def test_posterior_of_clear_votes_is_that_of_counting():
    # Two heuristics that always agree, on two classes that never mix.
    patterns = {"++": 90, "--": 10}
    found = weak_labels.posterior(patterns, {"++": [0.9, 0.1], "--": [0.1, 0.9]}, weak_labels.NONE)
    assert found["++"] > 0.99 and found["--"] < 0.01


MEASURES = tokeniser_fertility.MEASURES


def measures(spark, groups):
    """Rows with one varying metric: language, script, size class, and the values of words' characters per token."""
    names = [part.split()[0] for part in MEASURES.split(", ")]
    rows = []
    for language, script, size, values in groups:
        for v in values:
            row = dict(zip(names, (len(rows), 50, 300, 0, 0, 0, language, script, size, 100, 2.0, v, 0.0, 0.8), strict=True))
            rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, MEASURES)


def test_bands_are_quartiles_and_reach(spark):
    values = [2.0 + k / 100 for k in range(101)]
    (band,) = tokeniser_fertility.bands(measures(spark, [("en", "LATIN", 3, values)]), "language", "size_class").collect()
    low, high = band["band"]["word_chars_per_token"]
    below, above = tokeniser_fertility.REACH["word_chars_per_token"]
    assert low == pytest.approx(2.25 - below * 0.5, abs=0.03) and high == pytest.approx(2.75 + above * 0.5, abs=0.05)


def test_small_groups_take_the_bands_of_larger_ones(spark, monkeypatch):
    common = [2.0 + k / 100 for k in range(60)]
    groups = [
        ("en", "LATIN", 3, [*common, 0.1]), ("en", "LATIN", 5, [2.2, 0.1]),  # a rare length: the language's bands
        ("xx", "LATIN", 3, [2.2, 0.1]),  # a rare language: the script's
        ("yy", "GREEK", 3, [0.1]),  # a rare script: none
    ]
    table = measures(spark, groups)
    monkeypatch.setattr(tokeniser_fertility, "measure", lambda docs: docs)
    found = {r["doc_id"]: r["kept"] for r in tokeniser_fertility.judge(table).collect()}
    rejected = {k for k, kept in found.items() if not kept}
    assert rejected == {60, 62, 64}


def test_labelled_junk_is_rejected_and_good_texts_are_kept(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").dropDuplicates(["doc_id"])
    judged = tokeniser_fertility.judge(docs).filter("not base_failed").join(labels, "doc_id")
    share = {r["quality"]: r["kept"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[0] < 0.6 and share[1] > 0.97


def known_pairs(n=240):
    """Texts and near copies of them, half among texts that share a template, with the pairs that are alike."""
    rng = np.random.default_rng(5)
    base = [f"word{k}" for k in rng.integers(0, 4000, 200)]
    texts = []
    for k in range(n):
        words = [f"own{x}" for x in rng.integers(0, 9000, 160)]
        if k % 2:
            words = list(base)
            for at in rng.choice(200, 9, replace=False):
                words[at] = f"edit{k}x{at}"
        texts.append(words)
    for k in range(0, n, 4):  # edits that leave them 0.8 to 0.95 alike
        words = list(texts[k])
        for at in rng.choice(len(words), 1 + k % 3, replace=False):
            words[at] = f"new{k}x{at}"
        texts.append(words)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("block", [16, 192])
def test_recall_of_known_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(order_minhash, "BLOCK", block)
    texts = known_pairs()
    shingle = order_minhash.Shingles()
    sets = [shingle(t) for t in texts]
    alike = [
        (i, j) for i in range(len(sets)) for j in range(i) if order_minhash.ordered_likeness(sets[i], sets[j]) >= order_minhash.LEAST
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(df).collect()}
    caught = np.mean([found[i] == found[j] for i, j in alike])
    assert len(alike) >= 50 and caught >= 0.9
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in alike:
        parent[top(i)] = top(j)
    assert all(top(i) == top(j) for i in range(len(sets)) for j in (found[i],))
