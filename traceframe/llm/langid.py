"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text byte by byte in both directions, labels every position with a
probability per language, and a document's probability is the mean over its positions. It
is trained in numpy by backpropagation through time on a bounded sample.

A text is read whole. Long texts are cut into segments of ``SEGMENT`` bytes that start
with an empty state, so all segments of a batch advance together as one matrix; a language
shows within a few words, so the state need not reach further.

Defined cases: a text that is null or has no letter is ``und`` with score 0; any other text,
however short or long, gets a learned language; a text that is not in a learned language
gets the nearest one with a low score; without any labelled training text every text is
``und``; rows that repeat an id are predicted each for itself; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from traceframe.llm.common import slices

SAMPLE_DOCS = 400  # training documents of each language, of fewer languages than below
SAMPLE_BYTES = 2000  # bytes of a training text that are read, from its middle
LANGUAGES = 64  # with more, the documents of so many are shared among all, and steps grow
SEGMENT = 128
STATE = 8  # units in each direction
STEPS, BATCH, TRAIN_LENGTH = 260, 192, 48

UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """0.5 + 0.5 * tanh(x / 2), in place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


@dataclass
class Network:
    """Weights of both directions and of the output layer.

    inputs: direction x byte x (update, reset, candidate) units, bias included;
    gates, new: recurrent weights; out: (both states + 1) x languages.
    """

    inputs: np.ndarray
    gates: np.ndarray
    new: np.ndarray
    out: np.ndarray
    languages: list[str]

    def states(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Hidden states (time x rows x both directions) of byte columns (time x rows)."""
        time, rows = codes.shape
        held = np.empty((time, rows, 2 * STATE), np.float32)
        for d in range(2):
            state = np.zeros((rows, STATE), np.float32)
            mine = slice(d * STATE, (d + 1) * STATE)
            for t in range(time) if d == 0 else range(time - 1, -1, -1):
                into = self.inputs[d].take(codes[t], axis=0)
                both = _sigmoid(into[:, : 2 * STATE] + state @ self.gates[d])
                fresh = np.tanh(into[:, 2 * STATE :] + (both[:, STATE:] * state) @ self.new[d])
                fresh -= state
                fresh *= both[:, :STATE]
                if d == 1:  # the empty end of a row leaves the state as it is
                    fresh *= mask[t][:, None]
                state = state + fresh
                held[t, :, mine] = state
        return held

    def probabilities(self, held: np.ndarray) -> np.ndarray:
        z = held @ self.out[:-1] + self.out[-1]
        z -= z.max(axis=-1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=-1, keepdims=True)
        return z


def _gradients(net: Network, codes: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time of the mean cross entropy over all positions."""
    time, rows = codes.shape
    zero = np.zeros((rows, STATE), np.float32)
    held = np.empty((time, rows, 2 * STATE), np.float32)
    saved: list[dict[int, tuple]] = [{}, {}]
    for d in range(2):
        state = zero
        for t in range(time) if d == 0 else range(time - 1, -1, -1):
            into = net.inputs[d].take(codes[t], axis=0)
            both = _sigmoid(into[:, : 2 * STATE] + state @ net.gates[d])
            update, reset = both[:, :STATE], both[:, STATE:]
            fresh = np.tanh(into[:, 2 * STATE :] + (reset * state) @ net.new[d])
            saved[d][t] = (state, update, reset, fresh)
            state = state + update * (fresh - state)
            held[t, :, d * STATE : (d + 1) * STATE] = state
    p = net.probabilities(held)
    p[:, np.arange(rows), labels] -= 1
    p /= time * rows
    flat = held.reshape(-1, 2 * STATE)
    d_out = np.vstack([flat.T @ p.reshape(-1, p.shape[-1]), p.sum(axis=(0, 1))[None]])
    d_held = p @ net.out[:-1].T
    d_inputs, d_gates, d_new = np.zeros_like(net.inputs), np.zeros_like(net.gates), np.zeros_like(net.new)
    for d in range(2):
        back = zero
        for t in range(time - 1, -1, -1) if d == 0 else range(time):
            state, update, reset, fresh = saved[d][t]
            back = back + d_held[t][:, d * STATE : (d + 1) * STATE]
            to_fresh = back * update * (1 - fresh * fresh)
            to_update = back * (fresh - state) * update * (1 - update)
            through = to_fresh @ net.new[d].T
            to_reset = through * state * reset * (1 - reset)
            d_new[d] += (reset * state).T @ to_fresh
            to_both = np.hstack([to_update, to_reset])
            d_gates[d] += state.T @ to_both
            all_in = np.hstack([to_both, to_fresh])
            np.add.at(d_inputs[d], codes[t], all_in)
            back = back * (1 - update) + through * reset + to_both @ net.gates[d].T
    return [d_inputs, d_gates, d_new, d_out]


def train(texts: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 11) -> Network | None:
    """Fit a network by Adam on random stretches of the texts, languages drawn alike often."""
    languages = sorted(set(labels))
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    n = len(languages)
    net = Network(
        draw.normal(0, 0.3, (2, 256, 3 * STATE)).astype(np.float32),
        draw.normal(0, 0.3, (2, STATE, 2 * STATE)).astype(np.float32),
        draw.normal(0, 0.3, (2, STATE, STATE)).astype(np.float32),
        draw.normal(0, 0.3, (2 * STATE + 1, n)).astype(np.float32),
        languages,
    )
    if n == 1:
        return net
    by_name: dict[str, list[np.ndarray]] = {name: [] for name in languages}
    for text, name in zip(texts, labels, strict=True):
        if text:
            by_name[name].append(np.frombuffer(text, np.uint8))
    own = list(by_name.values())
    steps = max(steps, -(-steps * n // LANGUAGES))
    parts = [net.inputs, net.gates, net.new, net.out]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, steps + 1):
        codes = np.full((TRAIN_LENGTH, BATCH), 0x20, np.uint8)
        names = draw.integers(0, n, BATCH)
        for i, name in enumerate(names):
            text = own[name][draw.integers(len(own[name]))]
            start = draw.integers(max(1, len(text) - TRAIN_LENGTH + 1))
            piece = text[start : start + TRAIN_LENGTH]
            codes[: len(piece), i] = piece
        rate = 0.02 if step < steps * 0.7 else 0.005
        for part, m, v, g in zip(parts, first, second, _gradients(net, codes, names), strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def predict(net: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, mean probability of its positions) of every whole text."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    rows = [i for i, t in enumerate(texts) if has_letter(t)]
    if net is None or not rows:
        return out
    coded = [texts[i].encode("utf-8", "replace") for i in rows]
    sizes = np.array([len(c) for c in coded])
    segments = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(rows)), segments)
    # Rows padded to whole segments, then one matrix of segments.
    flat = np.frombuffer(b"".join(c.ljust(k * SEGMENT, b" ") for c, k in zip(coded, segments, strict=True)), np.uint8).reshape(-1, SEGMENT)
    ends = np.full(len(flat), SEGMENT)
    last = np.cumsum(segments) - 1
    ends[last] = sizes - (segments - 1) * SEGMENT
    total = np.zeros((len(rows), len(net.languages)))
    together = max(1, min(2048, 2048 * LANGUAGES // len(net.languages)))  # segments, for a bounded matrix
    for a in range(0, len(flat), together):
        codes = np.ascontiguousarray(flat[a : a + together].T)
        mask = (np.arange(SEGMENT)[:, None] < ends[a : a + together]).astype(np.float32)
        found = net.probabilities(net.states(codes, mask))
        np.add.at(total, owner[a : a + together], np.einsum("trl,tr->rl", found, mask))
    mean = total / sizes[:, None]
    best = mean.argmax(axis=1)
    for i, b, m in zip(rows, best, mean, strict=True):
        out[i] = (net.languages[b], float(min(1.0, m[b])))
    return out


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, steps: int = STEPS) -> Network | None:
    """Train on all labelled languages, on at most ``sample_docs`` documents of each.

    With more than ``LANGUAGES`` languages, as many documents as of those are shared among all,
    one of each at least. Chosen by a hash of their id; of each, ``SAMPLE_BYTES`` bytes from its middle are read.
    """
    known = docs.where("lang is not null and text is not null").where(F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    each = max(1, min(sample_docs, sample_docs * LANGUAGES // max(1, len(counts))))
    middle = F.substring(F.col("text"), F.greatest(F.lit(1), ((F.length("text") - SAMPLE_BYTES) / 2).cast("int")), F.lit(SAMPLE_BYTES))
    ready = known.select("doc_id", "lang", middle.alias("text"), F.xxhash64(F.lit("language"), "doc_id", "lang").alias("draw"))

    def least(rows: DataFrame) -> list[tuple[str, str]]:
        place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
        found = rows.withColumn("place", place).where(F.col("place") <= each).select("lang", "place", "text").collect()
        return [(r["lang"], r["text"]) for r in sorted(found, key=lambda r: (r["lang"], r["place"]))]

    # A slice by hash, large enough for the sample.
    slices_ = [(lang, int(min(1.0, max(4 * each, 50) / n) * 1_000_000)) for lang, n in counts.items()]
    share = F.broadcast(docs.sparkSession.createDataFrame(slices_, "lang string, share int"))
    chosen = least(ready.join(share, "lang").where(F.pmod("draw", F.lit(1_000_000)) <= F.col("share")))
    missing = sorted(counts.keys() - {lang for lang, _ in chosen})  # rows that repeat one doc_id may all fall outside
    if missing:
        chosen += least(ready.where(F.col("lang").isin(missing)))
    labels, texts = [lang for lang, _ in chosen], [text.encode("utf-8", "replace") for _, text in chosen]
    return train(texts, labels, steps)


def language(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred, score of every whole text; no rows move."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            sizes = pc.binary_length(texts).to_pylist() if batch.num_rows else []
            for a, b in slices([n or 0 for n in sizes], 1 << 20):
                found = predict(sent.value, texts[a:b].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [ids[a:b], pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(label, "doc_id long, lang_pred string, score double")
