"""Every operator on nulls, empty and long texts, repeats, clashing columns and empty tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from postura.llm import (
    attention_lm,
    bpe_codec,
    disclosure,
    hilbert_shards,
    language_id,
    order_minhash,
    packing,
    tokeniser_fertility,
    version_sketch,
    weak_labels,
)
from tests.llm.conftest import LONG, ODD

LABELS = "doc_id long, quality int, toxic int"


def weak(docs):
    labels = docs.sparkSession.createDataFrame([], LABELS)
    return weak_labels.judge(docs, weak_labels.learn(docs, labels))


ROW_BY_ROW = {
    "language": lambda d: language_id.predict(d, language_id.learn(d)),
    "versions": version_sketch.compare_versions,
    "shards": hilbert_shards.shard_rows,
    "fertility": tokeniser_fertility.judge,
    "lm": attention_lm.score,
    "disclosure": disclosure.report,
    "weak": weak,
    "near": order_minhash.near_duplicates,
    "codec": bpe_codec.round_trip,
}


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_a_result_for_each_row(name, odd):
    assert ROW_BY_ROW[name](odd).count() == len(ODD)


@pytest.mark.parametrize("name", ROW_BY_ROW)
def test_an_empty_table(name, nothing):
    assert ROW_BY_ROW[name](nothing).count() == 0


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_language_of_odd_rows(odd):
    found = by_id(ROW_BY_ROW["language"](odd))
    assert [found[k]["lang_pred"] for k in (0, 1, 2, 6)] == ["und"] * 4
    assert found[5]["lang_pred"] == "en" and 0 < found[5]["score"] <= 1
    assert not found[0]["score"]


def test_codec_of_odd_rows(odd):
    found = by_id(bpe_codec.round_trip(odd))
    assert found[0]["n_tokens"] == found[1]["n_tokens"] == found[2]["n_tokens"] == 0
    assert found[0]["ids_sha256"] == found[1]["ids_sha256"]


def test_packing_of_odd_rows(odd, nothing):
    rows = packing.pack(odd).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 0) == 1  # the end alone
    assert sum(r["piece"] > 0 for r in rows if r["doc_id"] == 5) >= 3
    assert sum(r["doc_id"] == 3 for r in rows) == 2
    assert packing.pack(nothing).count() == 0


def test_rules_and_weak_labels_reject_texts_without_words(odd):
    kept = by_id(tokeniser_fertility.judge(odd))
    assert not kept[0]["kept"] and kept[0]["n_words"] == 0 and kept[5]["n_words"] > 10_000
    good = by_id(weak(odd))
    assert not good[1]["kept"] and not good[2]["kept"] and good[3]["toxic"] == 0


def test_near_duplicates_of_odd_rows(odd):
    found = order_minhash.near_duplicates(odd).collect()
    same = {r["class_id"] for r in found if r["doc_id"] in (3, 4)}
    assert same == {3}
    assert len({r["class_id"] for r in found if r["doc_id"] in (0, 1)}) == 1


def test_keeping_one_of_each_class(odd, nothing):
    kept = order_minhash.keep_one(odd)
    assert kept.columns == odd.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t, *_ in ODD})
    assert order_minhash.keep_one(nothing).count() == 0


def test_a_single_document_follows_itself(spark):
    one = spark.createDataFrame([(9, "First line.\nSecond line.")], "doc_id long, text string")
    row = version_sketch.compare_versions(one).first()
    assert row["near_next"] == 1.0 and row["n_chars"] == 24


def test_sanitising_leaves_texts_without_entities(odd):
    clean = disclosure.sanitise(odd)
    assert clean.columns == odd.columns
    assert sorted(map(str, (r["text"] for r in clean.collect()))) == sorted(str(t) for _, t, *_ in ODD)


def test_pipeline_stages_on_odd_rows(spark, odd, nothing, sf_dir):
    for docs, n in ((odd, len(ODD)), (nothing, 0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            count = out.count()
            if stage is corpus_pipeline.pack:
                assert count >= n and bool(count) == bool(n)
            else:
                assert out.columns == docs.columns
                assert count == n if stage is corpus_pipeline.disclose_nothing else min(1, n) <= count <= n


def test_pipeline_rejects_rows_without_letters(spark, odd, sf_dir):
    kept = [r["text"] for r in corpus_pipeline.language(spark, odd, sf_dir).collect()]
    assert LONG in kept and None not in kept and "" not in kept and "12345 !!! ###" not in kept
