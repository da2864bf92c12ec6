"""Removing lines that many documents share, by probing minimal perfect hashes.

Tasks split their texts into lines and hash the keys (stripped, A-Z folded) of lines that are long
enough to 128 bits. Per hash, the documents that hold it are counted with map-side
combination, so that a line that stands in a third of all documents is one row per task. The distinct
hashes that reach the limit are dealt into shards, and a task per shard builds a
minimal perfect hash: in level after level of bits every key that has its bit for itself keeps
it, the rest goes on to the next level; the number of bits set before a key's own is its place. At
that place stand a fingerprint of 64 bits, the number of documents and the largest id.

Documents then probe the arrays: a line is split and hashed again, its bit looked up, its
fingerprint compared (a line that is not indexed passes with probability 2**-64), its count and
largest id decide. Nothing is joined by line and no text is shuffled.

The arrays of all shards are sent to the executors while they weigh at most ``sent_bytes``
(measured). Beyond that the shards stay where they are and hashes come to them: keys that stand in
so many documents that one shard would be overrun, at most ``HOT_KEYS`` of them by counting, are
sent as a small index; all other hashes are dealt by shard, probed in its task, and what is to
go returns as one list per document.

Defined cases: a null or empty text is one empty line; rows that share a doc_id are one document in
counting; a row without doc_id is no document: it is not counted and keeps its lines; a text whose
lines all go becomes the empty text; an empty table gives no rows; other columns stay, and those
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from traceframe.llm.common import Scratch, fresh, slices

SPACE = " \t\n\v\f\r"
SHARD_KEYS = 50_000
SENT_BYTES = 96 << 20
SHARD_TEXT = 64 << 20  # text whose lines are probed in one task, where hashes come to the shards
HOT_KEYS = 10_000
LEVEL_ROOM = 2  # bits per key that is left, in each level
INDEX = "shard int, n_keys long, sizes array<long>, bits binary, prints binary, counts binary, lasts binary"
RESULTS = [("n_lines", T.LongType()), ("n_dropped", T.LongType()), ("kept", T.StringType())]


def split_lines(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(all lines, the text each belongs to, lines per text)."""
    lists = pc.split_pattern(pc.fill_null(text, "").cast(pa.large_string()), "\n")
    return pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy(), pc.list_value_length(lists).to_numpy()


def hashed(lines: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lines whose key has at least ``min_chars`` code points, and the keys' hashes as (n, 2) words."""
    long_enough = np.flatnonzero(pc.greater_equal(pc.binary_length(lines), min_chars).to_numpy(zero_copy_only=False))
    keys = pc.ascii_trim(lines.take(pa.array(long_enough)), characters=SPACE)
    enough = pc.greater_equal(pc.utf8_length(keys), min_chars)
    keys = pc.ascii_lower(pc.filter(keys, enough)).cast(pa.large_binary())
    digests = b"".join(map(xxhash.xxh3_128_digest, keys.to_pylist()))
    return long_enough[enough.to_numpy(zero_copy_only=False)], np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of batches that hold a bounded amount of text."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for a, b in slices(sizes):
                yield batch.slice(a, b - a)


def _line_hashes(docs: DataFrame, min_chars: int, but: tuple | None = None) -> DataFrame:
    """hi, lo, doc_id: one row per document (row) and distinct long line, without those in the sent index ``but``."""

    def emit(batches):
        for part in _parts(batches):
            lines, parents, _ = split_lines(part.column("text"))
            at, words = hashed(lines, min_chars)
            if but:
                new = _held(*but).find(words)[0] == 0
                at, words = at[new], words[new]
            rows = pd.DataFrame({"hi": words[:, 0].astype(np.int64), "lo": words[:, 1].astype(np.int64), "row": parents[at]}).drop_duplicates()
            ids = part.column("doc_id").take(pa.array(rows["row"].to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(rows["hi"].to_numpy()), pa.array(rows["lo"].to_numpy()), ids], names=["hi", "lo", "doc_id"])

    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(emit, "hi long, lo long, doc_id long")


def frequent_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """hi, lo, n_docs, last_doc of every line key that at least ``min_docs`` documents hold."""
    pairs = _line_hashes(docs, min_chars)
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1").limit(1).count():  # rows that share an id count once
        pairs = pairs.distinct()
    return pairs.groupBy("hi", "lo").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")).where(F.col("n_docs") >= min_docs)


def _mixed(hi: np.ndarray, lo: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of (hi, lo) for a level."""
    with np.errstate(over="ignore"):
        x = lo + hi * np.uint64(2 * level + 3) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits of each level, whole words; the bits; the place of every key) for distinct keys."""
    left, sizes, bits = np.arange(len(hi)), [], []
    place, start = np.zeros(len(hi), np.int64), 0
    while len(left):
        size = -(-LEVEL_ROOM * len(left) // 64) * 64
        at = (_mixed(hi[left], lo[left], len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        place[left[own]] = start + at[own]  # the bit; turned into a rank below
        sizes.append(size)
        bits.append(alone)
        start += size
        left = left[~own]
    whole = np.concatenate(bits) if bits else np.zeros(0, bool)
    return np.array(sizes, np.int64), whole, (np.cumsum(whole) - 1)[place] if len(hi) else place


def _build_shard(key, table):
    hi, lo = (table.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo"))
    sizes, bits, place = build(hi, lo)
    order = np.argsort(place)
    packed = lambda values: pa.array([values.tobytes()], pa.binary())
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()), "n_keys": pa.array([len(hi)], pa.int64()), "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())),
            "bits": packed(np.packbits(bits, bitorder="little")), "prints": packed(lo[order]),
            "counts": packed(np.minimum(table.column("n_docs").to_numpy(), 0xFFFFFFFF).astype(np.uint32)[order]), "lasts": packed(table.column("last_doc").to_numpy()[order]),
        }
    )


def shard_of(hi: np.ndarray, shards: int) -> np.ndarray:
    return ((hi >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)


def index_lines(frequent: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard of the keys in ``frequent``."""
    # The shift is of the unsigned word, the remainder of a number below 2**48.
    return frequent.withColumn("shard", F.pmod(F.shiftrightunsigned("hi", 16), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(_build_shard, INDEX)


class LineIndex:
    """The arrays of some shards, joined so that lines of all of them are probed at once."""

    def __init__(self, rows: list, shards: int):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.shards = shards
        levels = max((len(r["sizes"]) for r in rows), default=0)
        self.sizes = np.zeros((shards, levels), np.int64)
        self.starts = np.zeros((shards, levels), np.int64)
        bits = 0
        for r in rows:
            own = np.array(r["sizes"], np.int64)
            self.sizes[r["shard"], : len(own)] = own
            self.starts[r["shard"], : len(own)] = bits + np.cumsum(own) - own
            bits += int(own.sum())
        gather = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows] or [np.zeros(0, kind)])
        self.words = gather("bits", np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.prints, self.counts, self.lasts = gather("prints", np.uint64), gather("counts", np.uint32), gather("lasts", np.int64)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, largest id) of every hash; 0 documents for those that are not indexed."""
        counts, lasts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        hi, lo = words[:, 0], words[:, 1]
        shard = shard_of(hi, self.shards)
        left = np.arange(len(words))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[shard[left], level]
            left, size = left[size > 0], size[size > 0]  # a shard without this level ends the search
            if not len(left):
                break
            bit = self.starts[shard[left], level] + (_mixed(hi[left], lo[left], level) % size.astype(np.uint64)).astype(np.int64)
            word, within = bit >> 6, (bit & 63).astype(np.uint64)
            held = self.words[word]
            found = (held >> within) & np.uint64(1) == 1
            at = self.before[word[found]] + np.bitwise_count(held[found] & ((np.uint64(1) << within[found]) - np.uint64(1)))
            own = left[found]
            same = self.prints[at] == lo[own]
            counts[own[same]], lasts[own[same]] = self.counts[at[same]], self.lasts[at[same]]
            left = left[~found]
        return counts, lasts


_KNOWN: dict[str, LineIndex] = {}


def _held(key: str, sent, shards: int) -> LineIndex:
    """The sent index, put together once per worker."""
    if key not in _KNOWN:
        if len(_KNOWN) > 1:
            _KNOWN.clear()
        _KNOWN[key] = LineIndex(sent.value, shards)
    return _KNOWN[key]


def _send(index: DataFrame, shards: int) -> tuple:
    """Broadcast the rows of an index whose size was measured or is bounded by counting: (key, broadcast, shards)."""
    rows = [r.asDict() for r in index.collect()]
    context = index.sparkSession.sparkContext
    sent = context.broadcast(rows)
    return f"{context.applicationId}-{sent._jbroadcast.id()}", sent, shards


def _rewrite(docs: DataFrame, sent: tuple, min_chars: int, min_docs: int, listed: str | None = None) -> DataFrame:
    """Drop the lines that the sent index, or a row's own list of hashes, condemns."""
    kept = docs.drop(*[name for name, _ in RESULTS])
    names = [c for c in kept.columns if c != listed]
    schema = T.StructType([*[kept.schema[c] for c in names], *[T.StructField(name, kind) for name, kind in RESULTS]])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _held(*sent)
        for part in _parts(batches):
            lines, parents, n_lines = split_lines(part.column("text"))
            at, words = hashed(lines, min_chars)
            ids = part.column("doc_id").cast(pa.int64())
            named = ids.is_valid().to_numpy(zero_copy_only=False)[parents[at]]
            own = pc.fill_null(ids, 0).to_numpy()[parents[at]]
            counts, lasts = index.find(words)
            stays = np.ones(len(lines), bool)
            stays[at[named & (counts >= min_docs) & (own < lasts)]] = False
            if listed:
                told = part.column(listed)
                flat = pc.list_flatten(told)
                gone = pd.MultiIndex.from_arrays([pc.list_parent_indices(told).to_numpy(), pc.struct_field(flat, [0]).to_numpy(), pc.struct_field(flat, [1]).to_numpy()])
                here = pd.MultiIndex.from_arrays([parents[at], words[:, 0].astype(np.int64), words[:, 1].astype(np.int64)])
                stays[at[here.isin(gone)]] = False
            left = np.bincount(parents[stays], minlength=part.num_rows)
            lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int64()), pc.filter(lines, pa.array(stays)))
            text = pc.binary_join(lists, pa.scalar("\n", lines.type)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(n_lines, pa.int64()), pa.array(n_lines - left, pa.int64()), text], schema=_arrow(part, names))

    return kept.mapInArrow(probe, schema)


def _arrow(part: pa.RecordBatch, names: list[str]) -> pa.Schema:
    return pa.schema([*[part.schema.field(c) for c in names], ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])


def _condemned(docs: DataFrame, index: DataFrame, sent: tuple, shards: int, min_chars: int, min_docs: int) -> DataFrame:
    """doc_id, hashes: the lines each document loses beside those of the sent index, found in one task per shard."""
    lines = _line_hashes(docs, min_chars, sent).withColumn("shard", F.pmod(F.shiftrightunsigned("hi", 16), F.lit(shards)).cast("int"))

    def probe(_, rows, arrays):
        found = LineIndex(arrays.to_pylist(), shards) if arrays.num_rows and rows.num_rows else None
        if found is None:
            return rows.slice(0, 0).select(["doc_id", "hi", "lo"])
        words = np.stack([rows.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo")], axis=1)
        counts, lasts = found.find(words)
        return rows.select(["doc_id", "hi", "lo"]).filter(pa.array((counts >= min_docs) & (rows.column("doc_id").to_numpy() < lasts)))

    gone = lines.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probe, "doc_id long, hi long, lo long")
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("hi", "lo")).alias("__gone"))


def drop_shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, sent_bytes: int = SENT_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` with n_lines (before), n_dropped and kept (the text that is left).

    A line goes if at least ``min_docs`` documents hold its key and one of them has a larger doc_id.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    frequent = scratch.save(frequent_lines(docs, min_chars, min_docs), "frequent")
    total, held = frequent.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    shards = max(1, -(-total // shard_keys))
    index = scratch.save(index_lines(frequent, shards), "index")
    weight = index.agg(F.coalesce(F.sum(sum(F.octet_length(c) for c in ("bits", "prints", "counts", "lasts"))), F.lit(0))).first()[0]
    if weight <= sent_bytes:
        return _rewrite(docs, _send(index, shards), min_chars, min_docs)
    # A key held by more than held / HOT_KEYS documents: there are at most HOT_KEYS of them.
    hot = F.col("n_docs") > max(1, held // HOT_KEYS)
    sent = _send(index_lines(frequent.where(hot), 1), 1)
    text_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    shards = max(shards, -(-text_bytes // SHARD_TEXT))
    rest = scratch.save(index_lines(frequent.where(~hot), shards), "rest")
    gone = scratch.save(_condemned(docs, rest, sent, shards, min_chars, min_docs), "gone")
    none = F.array().cast(gone.schema["__gone"].dataType)
    own, told = fresh("__id", docs), fresh("__gone", docs)
    listed = docs.withColumn(own, F.col("doc_id").cast("long")).join(gone.select(F.col("doc_id").alias(own), F.col("__gone").alias(told)), own, "left").drop(own)
    return _rewrite(listed.withColumn(told, F.coalesce(told, none)), sent, min_chars, min_docs, told)
