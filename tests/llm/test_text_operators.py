"""Operators on single texts against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postura.llm import attention_lm, bpe_codec, disclosure, language_id, tokeniser_fertility, weak_labels
from postura.llm.word_bpe import FILE, Encoder, Vocabulary, library_words

V = Vocabulary()
LIBRARY = Tokenizer.from_file(public_tokenizers.path(FILE))
OWN, THEIRS = Encoder(V, bpe_codec.SegmentTreeMerger(V)), Encoder(V, library_words(V))


def check_codec(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    for encoder in (OWN, THEIRS):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
    assert bpe_codec.decode(V, want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_codec_equals_the_library(text):
    check_codec(text)


@pytest.mark.parametrize(
    "text", ["", "a" * 5000, "<|endoftext|>x<|startoftext|> <|endoftext|", "ΑΣ ὈΔΥΣΣΕΎΣ İ", "it's WE'LL 'S", "a\x1cb\x85c 12²Ⅷ", "é ́e"]
)
def test_codec_on_chosen_texts(text):
    check_codec(text)


def test_codec_query(docs):
    found = {r["doc_id"]: r for r in bpe_codec.round_trip(docs).collect()}
    for r in docs.collect():
        ids = LIBRARY.encode(r["text"], add_special_tokens=False).ids
        assert found[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_languages_are_told_on_held_out_documents(docs):
    found = language_id.predict(docs, language_id.learn(language_id.learning_rows(docs)))
    joined = found.join(docs, "doc_id").filter("held_out").select("lang", "lang_pred").collect()
    assert np.mean([a == b for a, b in joined]) >= 0.97


def test_a_mixture_has_both_languages():
    grams = language_id.Trigrams()
    texts = {"de": "der hund und die katze liegen auf dem dach ", "en": "the dog and the cat lie on top of the roof "}
    counts = np.stack([grams(t * 20) for t in texts.values()], axis=1) + 0.01
    share = counts / counts.sum(axis=0)
    model = language_id.Languages(list(texts), share / share.max(axis=1, keepdims=True))
    mixed = dict(model.mixture(grams(texts["de"] * 3 + texts["en"] * 6)))
    assert set(mixed) == {"de", "en"} and 0.5 < mixed["en"] < 0.8
    assert list(dict(model.mixture(grams(texts["de"])))) == ["de"]


words = st.lists(st.sampled_from("a b c d ee \n é".split(" ")), max_size=40).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(words)
def test_repetition_counts(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(found[k : k + 5]) for k in range(len(found) - 4))
    held = {k + j for k in range(len(found) - 4) if grams[tuple(found[k : k + 5])] > 1 for j in range(5)}
    assert tokeniser_fertility.repeated_words(text.encode().split()) == len(held)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    assert tokeniser_fertility.repeated_lines(text) == again


def test_long_vocabularies_number_prefixes():
    many = [str(k).encode() for k in range(9000)]
    assert tokeniser_fertility.repeated_words([*many, *many[:7]]) == 14


def test_fertility_keeps_good_documents(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = tokeniser_fertility.judge(docs).join(labels, "doc_id").filter("quality = 1 and not base_failed").collect()
    assert np.mean([r["kept"] for r in rows]) >= 0.99


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text)
        if passes(kind, m[0])
    ]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


TRICKY = [
    "x@y.com_z@w.com,a@b.c.d@e.f. é😀q@r.s",
    "1.2.3.4.5 001.2.3.4 256.1.1.1 0000.0.0.0 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1112 12  34 4111111111111111 9",
    "+1 (988) 555-2485 +49 30 1234567 ++1234567890- +1",
    "🙂 +1 (555) 123-4567 a.b@c-d.co.uk 10.0.0.1",
    "1 " * 20_000 + "4242424242424242",
    "a" * 30_000 + "@b" + ".c" * 9_000,
    "",
]


def test_entities_equal_the_plain_patterns(spark):
    rng = np.random.default_rng(1)
    made = ["".join(rng.choice(list("12 .-+@(a)5é"), 80)) for _ in range(300)]
    rows = list(enumerate(TRICKY + made))
    found = disclosure.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        want = plain_spans(rows[r["doc_id"]][1])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), rows[r["doc_id"]][1][:100]


def test_disclosing_terms_are_found_and_generalised(spark):
    filler = "nothing to see between these plain words of every day "
    rows = [(k, f"{filler * (k % 3)}ask Wolpertinger via boss@firm.org {'today' if k % 2 else 'again'} {k}") for k in range(6)]
    rows += [(100 + k, f"{filler}{k} today and again via the usual way to ask") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in disclosure.report(docs).collect()}
    assert all("term:" in spans[k] and "email:" in spans[k] for k in range(6))
    assert all(not spans[100 + k] for k in range(60))
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitise(docs).collect()}
    assert clean[0] == "ask [TERM] via [EMAIL] again 0"
    assert clean[100] == rows[6][1]


def test_weak_labels_against_the_given_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = weak_labels.judge(docs, weak_labels.learn(docs, labels)).select("doc_id", "kept")
    rows = judged.join(labels, "doc_id").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["kept"] for r in rows if r["quality"] == 0]
    toxic = [r["kept"] for r in rows if r["toxic"] == 1]
    assert np.mean(clean) >= 0.99
    assert np.mean(junk) <= 0.3
    assert np.mean(toxic) <= 0.5  # the small table has few toxic rows to learn rare words from


def test_posterior_finds_the_reliable_heuristic():
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.8
    votes = [np.where(rng.random(4000) < right, truth, ~truth) for right in (0.95, 0.9, 0.6)]
    patterns = Counter("".join("+" if v[k] else "-" for v in votes) for k in range(4000))
    found = weak_labels.posterior(patterns, {p: [0.9, 0.1] if p.count("+") > 1 else [0.1, 0.9] for p in patterns})
    assert found["++-"] > 0.95 and found["--+"] < 0.2 and found["+-+"] > found["-++"]


def test_lm_base_scores(docs):
    plain = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), b" "] for r in docs.collect()}
    counts = Counter()
    for k, tokens in plain.items():
        if zlib.crc32(str(k).encode()) % 5 != 1:
            counts.update(tokens)
    total, distinct = sum(counts.values()), len(counts)
    for r in attention_lm.score(docs).collect():
        tokens = plain[r["doc_id"]]
        want = sum(np.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        assert r["train_tokens"] == total and r["n_tokens"] == len(tokens)
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert abs(r["base_score"] - want) <= 1e-9 * abs(want) + 1e-9


@pytest.fixture(scope="module")
def model():
    return attention_lm.Model(np.random.default_rng(0).integers(0, 50, len(V.tokens)))


def test_lm_gradient(model):
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, attention_lm.SEEN, (3, 32)), rng.integers(0, attention_lm.CLASSES, (3, 24))
    flat = model.flat.astype("f8")

    def loss(at):
        logits = model.forward(model.views(at), x)[0]
        return float(np.mean(np.log(np.exp(logits).sum(1)) - logits[np.arange(72), y.ravel()]))

    saved, model.flat = model.flat, flat
    slope = model.slope(model.views(flat), x, y)
    model.flat = saved
    for k in np.argsort(-np.abs(slope))[[0, 5, 50, 500]]:
        up, down = flat.copy(), flat.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - slope[k]) < 1e-5


def test_lm_scores_each_token_once_and_sums_to_one(model):
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 400, n) for n in (0, 1, 23, 24, 25, 100)]
    together = model.log10(texts, 49406, 49407)
    assert np.allclose(together, [model.log10([t], 49406, 49407)[0] for t in texts], rtol=1e-4)
    # One place, computed plainly: the last token of the shortest text.
    p = model.views(model.flat)
    logits = model.forward(p, model.seen_as[np.full((1, 32), 49406)])[0][0].astype(float)
    share = np.exp(logits - logits.max())
    share /= share.sum()
    whole = share[model.class_of] * np.exp(model.within)
    assert abs(whole.sum() - 1) < 1e-6
    assert abs(np.log10(whole[49407]) - together[0]) < 1e-4


def test_lm_learns(model):
    rng = np.random.default_rng(4)
    windows = np.cumsum(rng.integers(0, 2, (400, 33)), axis=1) + 7
    before = np.abs(model.slope(model.views(model.flat), model.seen_as[windows[:, :-1]], model.class_of[windows[:, 9:]])).sum()
    after = model.trained(model.flat, windows)
    scored, model.flat = model.flat, after
    better = sum(model.log10(list(windows[:20]), 49406, 49407))
    model.flat = scored
    assert before > 0 and better > sum(model.log10(list(windows[:20]), 49406, 49407))


@pytest.mark.parametrize("size", [0, 1, 23, 24, 100, 5000])
def test_lm_learns_from_every_token_once(size):
    """Not from a window for every thousand words: each token of a text, and its end, is a target in one round."""
    ids = np.random.default_rng(size).integers(0, 400, size)
    targets = []
    for turn in range(attention_lm.ROUNDS):
        windows, own = attention_lm.training_windows(ids, 49406, 49407, turn, attention_lm.ROUNDS)
        assert windows.shape[1:] == (attention_lm.WIDTH + 1,)
        for window, n in zip(windows, own, strict=True):
            targets += window[attention_lm.WIDTH - attention_lm.STRIDE + 1 :][:n].tolist()
    assert sorted(targets) == sorted([*ids.tolist(), 49407])


def test_lm_places_after_the_end_do_not_count(model):
    windows, own = attention_lm.training_windows(np.arange(5), 49406, 49407)
    y = np.where(np.arange(attention_lm.STRIDE) < own[:, None], model.class_of[windows[:, 9:]], -1)
    other = np.where(y < 0, -1, y)
    p = model.views(model.flat)
    whole = model.slope(p, model.seen_as[windows[:, :-1]], y)
    changed = windows.copy()
    changed[0, 9 + 6 :] = 7  # what follows the end
    assert np.allclose(whole, model.slope(p, model.seen_as[changed[:, :-1]], other), atol=1e-6)
