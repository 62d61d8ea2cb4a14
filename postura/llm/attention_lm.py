"""Language-model scores from a causal self-attention model over subword ids, trained in numpy.

A text is subword ids after a start token, ending in an end token.  The model sees the last ``WIDTH``
tokens through one masked attention layer and predicts a class: the commonest tokens are a class
each, the others share one, in which a token has its share of the class's count.  Windows overlap,
and only the last ``STRIDE`` places of each are scored, so every token is scored once with at least
``WIDTH - STRIDE`` tokens of context.

Word counts, and from them token counts, come from all learning documents, and the model learns from
every token of them: each learning text is cut into windows as it is for scoring, and every window is
learned from once, a part of them in each round.  Tasks train on their own texts, and parameters are
averaged after each round.

The plain word score needs counts of words whose number grows with the corpus: words common enough
that at most ``HEAD`` are, are broadcast; the rarer ones are joined.

Null text counts as empty: the end alone.  Repeated rows get equal scores; very long texts are scored
whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from postura.llm.common import held_out, id_and_text, pieces, stored, struct_type
from postura.llm.word_bpe import FILE, Encoder, Vocabulary, library_words

WIDTH, STRIDE = 32, 24
CLASSES, SEEN, DEPTH = 128, 2048, 16
ROUNDS, BATCH, STEP = 3, 128, 0.01
HEAD = 1 << 18
#: Not a word, as it is white space: stands for the end of a document.
END_KEY = " "
#: Windows computed at once.
AT_ONCE = 128
#: Bytes of ids that a task holds before it passes them on.
HELD = 8 << 20

GATHERED = "word string, n long, ids binary"
SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, head double, score double, "
    "word string, n long"
)


# White space to str.split, but part of a word here.
_WIDE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


# A word that is surely one run and holds no special token.
_SIMPLE = re.compile("[!-;=-~]+")


def ascii_lower(text: str) -> str:
    """Only A to Z lowered."""
    return text.encode().lower().decode()


def words_of(low: str) -> list[str]:
    """What lies between ASCII white space."""
    return [w.decode() for w in low.encode().split()] if _WIDE.search(low) else low.split()


class Ids:
    def __init__(self):
        self.v = Vocabulary(FILE)
        self.encoder = Encoder(self.v, library_words(self.v))
        self.start, self.end = sorted(self.v.special.values())

    def __call__(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder.encode(text), "<u4").astype(np.int64)


def training_windows(ids: np.ndarray, start: int, end: int, turn: int = 0, turns: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Every ``turns``-th window of a text, ``WIDTH + 1`` ids each, and how many of its last ``STRIDE`` are the text's.

    All turns together have each token, and the end, as a target once.
    """
    lead, n = WIDTH - STRIDE + 1, len(ids) + 1
    blocks = -(-n // STRIDE)
    line = np.full(blocks * STRIDE + lead, start)
    line[lead : lead + n - 1] = ids
    line[lead + n - 1] = end
    at = STRIDE * np.arange(turn, blocks, turns)
    return line[at[:, None] + np.arange(WIDTH + 1)], np.minimum(n - at, STRIDE)


def gather(docs: DataFrame) -> DataFrame:
    """``GATHERED`` of learning documents: partial word counts, and the ids of each whole text, of two bytes."""
    fields = to_arrow_schema(struct_type(GATHERED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, texts = Ids(), Counter(), []

        def flush() -> pa.RecordBatch:
            words = [w.decode() for w in counts]
            empty = [None] * len(texts)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(words + empty, pa.string()),
                    pa.array([*counts.values(), *empty], pa.int64()),
                    pa.array([None] * len(words) + texts, pa.binary()),
                ],
                schema=fields,
            )
            counts.clear()
            texts.clear()
            return out

        for batch in batches:
            for part in pieces(batch):
                for text in part["text"].to_pylist():
                    low = text.encode().lower()
                    counts.update(low.split())
                    counts[END_KEY.encode()] += 1
                    texts.append(ids(low.decode()).astype("<u2").tobytes())
                if len(counts) > 200_000 or sum(map(len, texts)) > HELD:
                    yield flush()
        if counts:
            yield flush()

    return docs.select("text").mapInArrow(run, GATHERED)


def token_counts(words: DataFrame) -> np.ndarray:
    """Subword counts from word counts; a row for each id reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids()
        encoder = ids.encoder
        total = np.zeros(len(ids.v.tokens), np.int64)
        for batch in batches:
            words, n = batch["word"].to_pylist(), batch["n"].to_numpy()
            # None for the end, which is white space.
            parts = [encoder.encode_run(w) if _SIMPLE.fullmatch(w) else encoder.encode(w) for w in words]
            times = np.repeat(n, [len(p) // 4 for p in parts])
            found = np.frombuffer(b"".join(parts), "<u4")
            total += np.bincount(found, weights=times, minlength=len(total)).astype(np.int64)
            total[ids.end] += sum(k for w, k in zip(words, n.tolist(), strict=True) if w == END_KEY)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype("i4")), pa.array(total[used])], ["id", "n"])

    found = words.mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(Vocabulary(FILE).tokens), np.int64)
    out[found["id"].to_numpy("i8")] = found["n"].to_numpy("i8")
    return out


class _Adam:
    """Parameters on their way, and the moments of their gradients."""

    def __init__(self, flat: np.ndarray):
        self.flat, self.steps = flat.copy(), 0
        self.first, self.second = np.zeros_like(flat), np.zeros_like(flat)

    def step(self, g: np.ndarray) -> None:
        self.steps += 1
        self.first += 0.1 * (g - self.first)
        self.second += 0.01 * (g * g - self.second)
        self.flat -= STEP * (self.first / (1 - 0.9**self.steps)) / (np.sqrt(self.second / (1 - 0.99**self.steps)) + 1e-6)


class Model:
    """Parameters as one flat vector, with views by name."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        self.class_of = np.full(len(counts), CLASSES - 1)
        self.class_of[order[: CLASSES - 1]] = np.arange(CLASSES - 1)
        self.seen_as = np.arange(len(counts)) % (SEEN // 2) + SEEN // 2
        self.seen_as[order[: SEEN // 2]] = np.arange(SEEN // 2)
        rest = counts[order[CLASSES - 1 :]] + 0.5
        self.within = np.zeros(len(counts))
        self.within[order[CLASSES - 1 :]] = np.log(rest / rest.sum())
        self.shapes = {
            "see": (SEEN, DEPTH),
            "place": (WIDTH, DEPTH),
            "query": (DEPTH, DEPTH),
            "key": (DEPTH, DEPTH),
            "value": (DEPTH, DEPTH),
            "out": (DEPTH, CLASSES),
            "bias": (CLASSES,),
        }
        self.flat = np.random.default_rng(5).normal(0, 0.2, sum(map(np.prod, self.shapes.values()))).astype("f4")
        share = np.bincount(self.class_of, weights=counts + 0.5, minlength=CLASSES)
        self.views(self.flat)["bias"][:] = np.log(share / share.sum())
        self.mask = np.where(np.arange(WIDTH) > np.arange(WIDTH - STRIDE, WIDTH)[:, None], -1e9, 0).astype("f4")

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            size = int(np.prod(shape))
            out[name] = flat[at : at + size].reshape(shape)
            at += size
        return out

    def forward(self, p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Logits of the last ``STRIDE`` places of windows of seen ids, and what the gradient needs."""
        n = len(x)
        h = p["see"][x] + p["place"]
        flat = h.reshape(-1, DEPTH)
        key, value = (flat @ p["key"]).reshape(n, WIDTH, DEPTH), (flat @ p["value"]).reshape(n, WIDTH, DEPTH)
        own = np.ascontiguousarray(h[:, WIDTH - STRIDE :])
        query = (own.reshape(-1, DEPTH) @ p["query"]).reshape(n, STRIDE, DEPTH)
        weight = np.matmul(query, key.transpose(0, 2, 1))
        weight *= DEPTH**-0.5
        weight += self.mask
        weight -= weight.max(-1, keepdims=True)
        np.exp(weight, out=weight)
        weight /= weight.sum(-1, keepdims=True)
        mixed = np.matmul(weight, value) + own
        # The bias as one more row of the matrix saves a pass over the logits.
        wide = np.ones((n * STRIDE, DEPTH + 1), mixed.dtype)
        wide[:, :DEPTH] = mixed.reshape(-1, DEPTH)
        logits = wide @ np.vstack([p["out"], p["bias"]])
        return logits, h, key, value, query, weight, mixed

    def slope(self, p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient of the mean cross-entropy of classes ``y`` at the last places of ``x``; negative ones do not count."""
        logits, h, key, value, query, weight, mixed = self.forward(p, x)
        d = np.exp(logits - logits.max(1, keepdims=True))
        d /= d.sum(1, keepdims=True)
        d[np.arange(len(d)), y.ravel()] -= 1
        counted = y.ravel() >= 0
        d[~counted] = 0
        d /= max(1, counted.sum())
        flat = np.zeros_like(self.flat)
        g = self.views(flat)
        g["out"][:] = mixed.reshape(-1, DEPTH).T @ d
        g["bias"][:] = d.sum(0)
        dm = (d @ p["out"].T).reshape(mixed.shape)
        dw = np.matmul(dm, value.transpose(0, 2, 1))
        ds = weight * (dw - (dw * weight).sum(-1, keepdims=True)) * np.float32(DEPTH**-0.5)
        dq = np.matmul(ds, key).reshape(-1, DEPTH)
        dk = np.matmul(ds.transpose(0, 2, 1), query).reshape(-1, DEPTH)
        dv = np.matmul(weight.transpose(0, 2, 1), dm).reshape(-1, DEPTH)
        seen, own = h.reshape(-1, DEPTH), h[:, WIDTH - STRIDE :].reshape(-1, DEPTH)
        g["query"][:], g["key"][:], g["value"][:] = own.T @ dq, seen.T @ dk, seen.T @ dv
        dh = (dk @ p["key"].T + dv @ p["value"].T).reshape(h.shape)
        dh[:, WIDTH - STRIDE :] += (dq @ p["query"].T).reshape(dm.shape) + dm
        g["place"][:] = dh.sum(0)
        places = x.reshape(-1, 1) * DEPTH + np.arange(DEPTH)
        g["see"][:] = np.bincount(places.ravel(), weights=dh.ravel(), minlength=SEEN * DEPTH).reshape(SEEN, DEPTH)
        return flat

    def trained(self, flat: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Parameters after one pass of Adam steps over windows of ids."""
        adam = _Adam(flat)
        for at in range(0, len(windows), BATCH):
            some = windows[at : at + BATCH]
            self._step(adam, some, np.full(len(some), STRIDE))
        return adam.flat

    def _step(self, adam: _Adam, some: np.ndarray, own: np.ndarray) -> None:
        """A step on windows, of each of which ``own`` of the last places count."""
        y = np.where(np.arange(STRIDE) < own[:, None], self.class_of[some[:, WIDTH - STRIDE + 1 :]], -1)
        adam.step(self.slope(self.views(adam.flat), self.seen_as[some[:, :-1]], y))

    def learned(self, texts: Iterable[np.ndarray], start: int, end: int, turn: int = 0) -> tuple[np.ndarray, int]:
        """Parameters after one of ``ROUNDS`` parts of the windows of ``texts``, and how many these are."""
        adam, windows = _Adam(self.flat), 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for ids in texts:
            # Short texts have one window: their own ids say whose turn they are.
            held.append(training_windows(ids, start, end, (turn + zlib.crc32(ids.tobytes())) % ROUNDS, ROUNDS))
            windows, waiting = windows + len(held[-1][1]), waiting + len(held[-1][1])
            if waiting >= BATCH:
                some, own = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = waiting // BATCH * BATCH
                for at in range(0, whole, BATCH):
                    self._step(adam, some[at : at + BATCH], own[at : at + BATCH])
                held, waiting = [(some[whole:], own[whole:])], waiting - whole
        if waiting:
            self._step(adam, *(np.concatenate(x) for x in zip(*held, strict=True)))
        return adam.flat, windows

    def log10(self, texts: list[np.ndarray], start: int, end: int) -> list[float]:
        """The log10 probability of each text of ids and its end."""
        if not texts:
            return []
        p, lead = self.views(self.flat), WIDTH - STRIDE + 1
        blocks = [-(-(len(t) + 1) // STRIDE) for t in texts]
        sizes = np.array(blocks) * STRIDE + lead
        offsets = np.cumsum(sizes) - sizes
        line = np.full(sizes.sum(), start)
        for t, at in zip(texts, offsets.tolist(), strict=True):
            line[at + lead : at + lead + len(t)] = t
            line[at + lead + len(t)] = end
        owner = np.repeat(np.arange(len(texts)), blocks)
        first = np.concatenate([at + STRIDE * np.arange(b) for at, b in zip(offsets.tolist(), blocks, strict=True)])
        stop = (offsets + lead + [len(t) + 1 for t in texts])[owner]
        seen, classes, within = self.seen_as[line], self.class_of[line], self.within[line]
        total = np.zeros(len(texts))
        for k in range(0, len(first), AT_ONCE):
            begin = first[k : k + AT_ONCE, None]
            logits = self.forward(p, seen[begin + np.arange(WIDTH)])[0]
            target = begin + np.arange(lead, WIDTH + 1)
            chosen = logits[np.arange(len(logits)), classes[target].ravel()].astype(float)
            np.exp(logits, out=logits)
            value = (chosen - np.log(logits.sum(1)) + within[target].ravel()).reshape(target.shape)
            value[target >= stop[k : k + AT_ONCE, None]] = 0
            np.add.at(total, owner[k : k + AT_ONCE], value.sum(1))
        return (total / np.log(10)).tolist()


def train(model: Model, texts: DataFrame, start: int, end: int, rounds: int = ROUNDS) -> Model:
    """Rounds of local training on the ``ids`` of each task's texts, and averaging weighted by windows."""
    spark = texts.sparkSession
    schema = "part int, weight double, flat binary"
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def local(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            found = (np.frombuffer(x.as_buffer(), "<u2") for batch in batches for x in batch["ids"])
            flat, n = sent.value.learned(found, start, end, turn)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([TaskContext.get().partitionId() % 32], pa.int32()),
                        pa.array([float(n)]),
                        pa.array([(flat * np.float64(n)).tobytes()]),
                    ],
                    ["part", "weight", "flat"],
                )

        def added(frame: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(x) for x in frame["flat"])
            return pd.DataFrame(
                {"part": frame["part"][:1], "weight": [frame["weight"].sum()], "flat": [total.tobytes()]}
            )

        # At most 32 sums reach the driver, however many tasks there are.
        found = texts.mapInArrow(local, schema).groupBy("part").applyInPandas(added, schema).toPandas()
        if not len(found):
            continue
        found = found.sort_values("part")
        model.flat = (sum(np.frombuffer(x) for x in found["flat"]) / found["weight"].sum()).astype("f4")
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), (held_out(F.col("doc_id")) == 1).alias("held_out")
    )
    gathered = stored(gather(rows.filter(~F.col("held_out"))), "gathered")
    words = stored(
        gathered.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    learned, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    model = Model(token_counts(words))
    start, end = sorted(Vocabulary(FILE).special.values())
    model = train(model, gathered.filter("ids is not null").select("ids"), start, end)

    # Counts by quarter octave: the lowest count that leaves at most HEAD words above it.
    octaves = words.groupBy(F.floor(4 * F.log2("n")).alias("o")).agg(F.count("*").alias("k"), F.min("n").alias("low"))
    above, least = 0, None
    for _, k, low in sorted(map(tuple, octaves.collect()), reverse=True):
        if above + k > HEAD:
            break
        above, least = above + k, low
    common = words.filter(F.col("n") >= least).collect() if least is not None else []
    head = {r["word"]: float(np.log10(r["n"] + 0.5)) for r in common}
    sent = docs.sparkSession.sparkContext.broadcast((model, head))  # HEAD words at most
    fields = to_arrow_schema(struct_type(SCORED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = sent.value
        ids = Ids()
        row = TaskContext.get().partitionId() << 33
        ends = counts.get(END_KEY)
        for batch in batches:
            for part in pieces(batch):
                texts = [ascii_lower(t) for t in part["text"].to_pylist()]
                scores = own.log10([ids(t) for t in texts], ids.start, ids.end)
                first, sums, tail = row + 1, [], ([], [], [])  # the tail: row, word, times
                for text in texts:
                    row += 1
                    words = words_of(text)
                    total, known = ends or 0.0, int(ends is not None)
                    rare = {} if ends is not None else {END_KEY: 1}
                    for word, n in Counter(words).items():
                        at = counts.get(word)
                        if at is None:
                            rare[word] = n
                        else:
                            total += n * at
                            known += n
                    tail[0].extend([row] * len(rare))
                    tail[1].extend(rare)
                    tail[2].extend(rare.values())
                    sums.append((len(words) + 1, known, total))
                n_tokens, known, total = zip(*sums, strict=True) if sums else ((), (), ())
                whole = (range(first, row + 1), part["doc_id"], part["held_out"], n_tokens, known, total, scores)
                own_columns = [pa.array(c, f.type) for c, f in zip(whole, fields, strict=False)]
                own_columns += [pa.nulls(len(texts), f.type) for f in list(fields)[7:]]
                yield pa.RecordBatch.from_arrays(own_columns, schema=fields)
                rows_of, words_in, times = (pa.array(c, fields.field(f).type) for c, f in zip(tail, ("row", "word", "n"), strict=True))
                missing = [pa.nulls(len(rows_of), f.type) for f in list(fields)[1:7]]
                yield pa.RecordBatch.from_arrays([rows_of, *missing, words_in, times], schema=fields)

    scored = stored(rows.mapInArrow(run, SCORED), "scored")
    rare = words.filter(F.col("n") < least) if least is not None else words
    tail = (
        scored.filter("word is not null")
        .select("row", "word", F.col("n").alias("times"))
        .join(rare, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail"),
            F.sum(F.when(F.col("n").isNull(), 0).otherwise(F.col("times"))).alias("tail_known"),
        )
    )
    per_token = float(np.log10(learned + 0.5 * (distinct + 1)))
    return (
        scored.filter("word is null")
        .drop("word", "n")
        .join(tail, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
            F.lit(learned).cast("long").alias("train_tokens"),
            (F.col("head") + F.coalesce("tail", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
            "score",
        )
    )
