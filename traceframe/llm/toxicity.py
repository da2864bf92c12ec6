"""Toxicity by subword-bag embeddings, averaged into a linear softmax.

A word is the bag of its byte n-grams and itself, each hashed to a row of one embedding
table; a word's vector is the mean of its rows, a window's the mean of its words, and a
two-class softmax reads it. A word that has just been said counts once. Table and softmax are trained together in numpy, so a
misspelling never seen shares most of its rows with the word it comes from.

Texts are read whole, in overlapping windows of ``WINDOW`` words; a document is as toxic as
its worst window, so one insult in a long text is not averaged away. In training the
windows of a document weigh by their own probability (only some windows of a toxic text are
toxic), and a last logistic fit carries the worst window's logit to a document probability.

For a fixed model, a word adds one number, so scoring a document is a lookup per word and a
running sum.

Defined cases: a null or empty text, or one without words, has the logit of an empty window;
words are runs of letters and digits (all signs beyond ASCII count as letters), case
is folded; rows that repeat an id are scored each for itself; labels that are null,
or contradict each other for one id, are not learned; without both labels in the training
rows the score is the share of toxic ones (0 without any); other columns are ignored.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from traceframe.llm.common import slices

SAMPLE_DOCS = (5000, 2000)  # clean and toxic training documents,
SAMPLE_BYTES = (12 << 20, 6 << 20)  # and bytes of their texts: the bounds on what the training task reads
BUCKETS, WIDTH = 1 << 18, 8
DECAY = 6e-5
GRAMS = (3, 4, 5, 6)
WINDOW, STEP = 32, 16
SCALE = 32.0
ROUNDS = 100
LIMIT = 0.7
SOME = 1 << 18  # tokens of the training texts that are turned into floats at a time

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_PRIME = np.uint64(0x100000001B3)


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_FOLD).split()


def subwords(vocabulary: list[bytes], chunk: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram of every word, number of n-grams per word), words in order."""
    parts = [_subwords(vocabulary[i : i + chunk]) for i in range(0, len(vocabulary), chunk)] or [_subwords([])]
    return np.concatenate([b for b, _ in parts]), np.concatenate([c for _, c in parts])


def _subwords(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    marked = b"".join(b"<" + w + b">" for w in vocabulary)
    sizes = np.fromiter((len(w) + 2 for w in vocabulary), np.int64, len(vocabulary))
    codes = np.frombuffer(marked, np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.repeat(np.cumsum(sizes), sizes)
    place = np.arange(len(codes))
    owner = np.repeat(np.arange(len(vocabulary)), sizes)
    rolled = np.zeros(len(codes), np.uint64)
    found, owners = [], []
    for n in range(1, min(max(GRAMS), len(codes)) + 1):
        rolled[: len(codes) - n + 1] = rolled[: len(codes) - n + 1] * _PRIME + codes[n - 1 :]
        if n in GRAMS:
            whole = (place + n) <= ends
            found.append((rolled[whole] ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40))
            owners.append(owner[whole])
    # The word itself: a hash of all its codes.
    starts = np.cumsum(sizes) - sizes
    power = np.cumprod(np.full(int(sizes.max(initial=1)), _PRIME, np.uint64))
    within = place - np.repeat(starts, sizes)
    full = np.add.reduceat(codes * power[within], starts) if len(vocabulary) else np.zeros(0, np.uint64)
    found.append(full * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40))
    owners.append(np.arange(len(vocabulary)))
    who, bucket = np.concatenate(owners), np.concatenate(found).astype(np.int64) % BUCKETS
    order = np.argsort(who, kind="stable")
    return bucket[order].astype(np.int32), np.bincount(who, minlength=len(vocabulary))


def window_starts(n: int) -> np.ndarray:
    """First words of the windows over n words: every word is in one, the last ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STEP), n - WINDOW)


def counted(ids: np.ndarray) -> np.ndarray:
    """1 for a word that is not among the ``WINDOW`` words before it, else 0: a bag holds a word once."""
    order = np.argsort(ids, kind="stable")
    out = np.ones(len(ids))
    out[order[1:][(ids[order[1:]] == ids[order[:-1]]) & (np.diff(order) < WINDOW)]] = 0
    return out


def window_means(values: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(1)
    total = np.concatenate([[0.0], np.cumsum(values)])
    first = window_starts(len(values))
    last = np.minimum(first + WINDOW, len(values))
    return (total[last] - total[first]) / (last - first)


@dataclass
class Model:
    per_bucket: np.ndarray  # embedding table times the difference of the softmax rows
    bias: float
    slope: float  # from the worst window's logit
    shift: float  # to the document's
    constant: float | None = None  # score without both labels

    def word_values(self, vocabulary: list[bytes]) -> np.ndarray:
        if not vocabulary:
            return np.zeros(0)
        buckets, counts = subwords(vocabulary)
        ends = np.cumsum(counts)
        return np.add.reduceat(self.per_bucket[buckets], ends - counts) / counts

    def score(self, values: np.ndarray) -> float:
        worst = self.bias + SCALE * window_means(values).max()
        return float(1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -50, 50))))


MODEL = pa.schema([("per_bucket", pa.binary()), *((c, pa.float64()) for c in ("bias", "slope", "shift", "constant"))])


class _Adam:
    def __init__(self, *shapes: tuple[int, ...]):
        self.first = [np.zeros(s, np.float32) for s in shapes]
        self.second = [np.zeros(s, np.float32) for s in shapes]
        self.t = 0

    def steps(self, grads: list[np.ndarray], rate: float) -> list[np.ndarray]:
        """Steps to subtract; the gradients are used up."""
        self.t += 1
        for m, v, g in zip(self.first, self.second, grads, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            np.square(g, out=g)
            g *= 0.01
            v += g
            np.divide(v, 1 - 0.99**self.t, out=g)
            np.sqrt(g, out=g)
            g += 1e-8
            np.divide(m, g, out=g)
            g *= rate / (1 - 0.9**self.t)
        return grads


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def train(texts: list[str], labels: list[int], rounds: int = ROUNDS, toxic_share: float | None = None) -> Model:
    """Fit table, softmax and document scale. ``toxic_share`` is that of the rows sampled from."""
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS), 0.0, 0.0, 0.0, constant=float(y.mean()) if len(y) else 0.0)
    ids: dict[bytes, int] = {}
    own = []
    for i, text in enumerate(texts):
        own.append(np.array([ids.setdefault(w, len(ids)) for w in words(text)], np.int32))
        texts[i] = ""  # only the words' numbers are held from here on
    buckets, counts = subwords(list(ids))
    n_words = len(ids)
    del ids
    ends = np.cumsum(counts)
    # Words are taken some thousands at a time, so that temporary arrays stay small.
    parts = [(a, b, ends[a] - counts[a], ends[b - 1]) for a, b in ((i, min(n_words, i + 20_000)) for i in range(0, n_words, 20_000))]
    firsts = [window_starts(len(d)) for d in own]
    base = np.cumsum([0] + [len(d) for d in own])
    per_doc = np.array([len(f) for f in firsts])
    doc = np.repeat(np.arange(len(own)), per_doc)
    first = np.concatenate([f + b for f, b in zip(firsts, base[:-1], strict=True)])
    last = np.minimum(first + WINDOW, base[1:][doc])
    size = np.maximum(last - first, 1)
    tokens, bag = np.concatenate(own), np.concatenate([counted(d).astype(np.float32) for d in own])
    del own, firsts
    spans = [(a, min(a + SOME, len(tokens))) for a in range(0, len(tokens), SOME)]
    closing, closes = np.unique(last, return_inverse=True)
    mark, edge = y[doc], np.cumsum(per_doc) - per_doc

    draw = np.random.default_rng(7)
    table = draw.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    rows = draw.normal(0, 0.5, (2, WIDTH)).astype(np.float32)  # of the softmax
    bias = np.zeros(2, np.float32)
    adam = _Adam(table.shape, rows.shape, bias.shape)
    share = np.array([1 / (2 * (y == 0).sum()), 1 / (2 * (y == 1).sum())])[y.astype(int)][doc]

    def logits() -> np.ndarray:
        per_bucket = table @ (rows[1] - rows[0])
        value = np.concatenate([np.add.reduceat(per_bucket[buckets[c:d]], ends[a:b] - counts[a:b] - c) / counts[a:b] for a, b, c, d in parts])
        total = np.zeros(len(tokens) + 1)
        for a, b in spans:
            np.multiply(value[tokens[a:b]], bag[a:b], out=total[a + 1 : b + 1])
        np.cumsum(total, out=total)
        return bias[1] - bias[0] + SCALE * (total[last] - total[first]) / size

    for i in range(rounds):
        p = _sigmoid(logits())
        even = 1 / per_doc[doc]
        keen = p / (np.add.reduceat(p, edge)[doc] + 1e-12)
        focus = min(1.0, i / (rounds / 3))  # first all windows of a document alike, then its worst
        blend = np.where(mark == 1, (1 - focus) * even + focus * keen, 0.5 * even + 0.5 * keen)
        g = share * blend * (p - mark)
        # Gradient per token: a running sum of what starts and ends there.
        flow = np.bincount(first, SCALE * g / size, len(tokens) + 1)
        flow[closing] -= np.bincount(closes, SCALE * g / size)
        np.cumsum(flow, out=flow)
        flow[:-1] *= bag
        per_word = np.zeros(n_words)
        for a, b in spans:  # added up in the order of the tokens, whatever the spans
            np.add.at(per_word, tokens[a:b].astype(np.intp), flow[a:b])
        del flow
        share_of_row = per_word / counts
        per_bucket = np.zeros(BUCKETS, np.float32)
        for a, b, c, d in parts:
            per_bucket += np.bincount(buckets[c:d], np.repeat(share_of_row[a:b], counts[a:b]), BUCKETS)
        way = rows[1] - rows[0]
        to_way = per_bucket @ table
        pull = np.outer(per_bucket, way)
        pull += np.float32(DECAY) * table
        grads = [pull, np.stack([-to_way, to_way]) + np.float32(1e-5) * rows, np.array([-g.sum(), g.sum()], np.float32)]
        for part, step in zip((table, rows, bias), adam.steps(grads, 0.05 if i < rounds * 2 // 3 else 0.015), strict=True):
            part -= step

    worst = np.maximum.reduceat(logits(), edge)
    prior = toxic_share if toxic_share else float(y.mean())
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    slope, shift = _logistic(worst, y, weight)
    return Model((table @ (rows[1] - rows[0])).astype(float), float(bias[1] - bias[0]), slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted one-dimensional logistic fit with a small pull to slope 1, by Newton steps."""
    design = np.stack([x, np.ones_like(x)], 1)
    at = np.array([1.0, 0.0])
    pull = np.diag([0.5, 0.05])
    for _ in range(30):
        p = _sigmoid(design @ at)
        slope = design.T @ (weight * (p - y)) + pull @ (at - np.array([1.0, 0.0]))
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + pull
        at = at - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, sample_docs: tuple[int, int] = SAMPLE_DOCS, rounds: int = ROUNDS, sample_bytes: tuple[int, int] = SAMPLE_BYTES) -> Model:
    """Train on labelled documents (clean, toxic) in the order of a hash of their id, up to ``sample_docs`` or ``sample_bytes``.

    ``docs`` has doc_id, text; ``labels`` has doc_id, toxic. Only ids, sizes and labels are ordered,
    then the chosen texts are read whole by one task, one row per id. Texts of any length can be chosen:
    the first of each label always is, the others as long as the texts before them leave room.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high"))
    marked = marked.where("toxic = high").select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    known = docs.where("text is not null").groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("bytes")).join(marked, "doc_id")
    ranked = known.withColumn("draw", F.xxhash64(F.lit("toxicity"), "doc_id"))
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [ranked.where(F.col("toxic") == t).orderBy("draw", "doc_id").limit(sample_docs[t]) for t in (0, 1)]
    chosen = []
    for p, room in zip(picked, sample_bytes, strict=True):
        used = 0
        for r in p.select("doc_id", "toxic", "bytes").collect():
            if used == 0 or used + r["bytes"] <= room:
                chosen.append((r["doc_id"], r["toxic"]))
                used += r["bytes"]
    if not chosen:
        return train([], [])
    spark = docs.sparkSession
    sent = F.broadcast(spark.createDataFrame(chosen, "doc_id long, toxic int"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(sent, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    share = total.get(1, 0) / max(1, sum(total.values()))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted((r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic")), strict=True)), key=lambda r: r[:2])
        texts, marks = [r[1] for r in found], [r[2] for r in found]
        found.clear()
        model = train(texts, marks, rounds, share)
        yield pa.RecordBatch.from_pylist([vars(model) | {"per_bucket": model.per_bucket.tobytes()}], MODEL)
        _give_back()

    # The bounded sample is learned from in a task, so that the driver holds neither texts nor gradients.
    fitted = rows.coalesce(1).mapInArrow(learn, "per_bucket binary, bias double, slope double, shift double, constant double").collect()[0]
    return Model(**fitted.asDict() | {"per_bucket": np.frombuffer(fitted["per_bucket"])})


def _give_back() -> None:
    """Hand memory that the training has freed back to the system, where the C library can: the worker goes on."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class WordValues:
    """Values of the words seen so far in a worker, refilled when it has grown large."""

    def __init__(self, model: Model):
        self.model, self.places, self.values = model, {}, np.zeros(0)

    def learn(self, seen: set[bytes]) -> None:
        fresh = list(seen - self.places.keys())
        if len(self.places) + len(fresh) > VALUES_KEPT:
            self.places, self.values, fresh = {}, np.zeros(0), list(seen)
        self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh)), strict=True))
        self.values = np.concatenate([self.values, self.model.word_values(fresh)])

    def scores(self, texts: list[str | None]) -> list[float]:
        if self.model.constant is not None:
            return [self.model.constant] * len(texts)
        cut = [words(t) if t else [] for t in texts]
        self.learn(set().union(*cut))
        out = []
        for own in cut:
            ids = np.fromiter(map(self.places.__getitem__, own), np.int64, len(own))
            out.append(self.model.score(self.values[ids] * counted(ids)))
        return out


VALUES_KEPT = 400_000
_KNOWN: dict[str, WordValues] = {}


def toxicity(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``is_toxic``; rows stay where they are.

    Columns of these names in ``docs`` are replaced.
    """
    kept = docs.drop("toxicity", "is_toxic")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = f"{docs.sparkSession.sparkContext.applicationId}-{sent._jbroadcast.id()}"
    schema = T.StructType([*kept.schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("is_toxic", T.BooleanType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[key] = WordValues(sent.value)
        known = _KNOWN[key]
        for batch in batches:
            at = batch.schema.get_field_index("text")
            sizes = pc.binary_length(batch.column(at)).to_pylist() if batch.num_rows else []
            for a, b in slices([n or 0 for n in sizes]):
                part = batch.slice(a, b - a)
                found = known.scores(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.float64()), pa.array([x >= limit for x in found], pa.bool_())], names=[*part.schema.names, "toxicity", "is_toxic"]
                )

    return kept.mapInArrow(score, schema)
