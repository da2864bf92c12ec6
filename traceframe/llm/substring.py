"""Removal of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

A byte is removed if some string of ``LENGTH`` bytes that covers it also starts in a document
with a smaller doc_id. Strings are judged on the input, so a document's result does not depend on
what is removed elsewhere.

Equal strings must meet in one task without sending every string. So each window of
``LENGTH`` bytes is named by its anchor, the least hash of the ``GRAM``-byte strings inside:
equal windows have equal anchors, and neighbouring windows mostly share one, so a run of
windows is one fragment of text.

1. Copies: of equal texts the first stays, the others go whole. Only first ones go on.
2. Per task, every anchor is reduced to its least and greatest doc_id; what all tasks found
   is added up per hash range. An anchor of one document alone names no repeat. The others are
   marked in a bit map of bounded size; a bit shared by chance costs work, not results.
3. Fragments with a marked anchor are dealt by it. Equal fragments of one task leave only
   those of the least document: the later ones are repeats as a whole. So a passage that a
   third of all documents share is a few rows per task.
4. In a hash range, equal fragments are reduced once more. Anchors with several different
   fragments go into one text, of which the Burrows-Wheeler transform is built: backward
   extension by one symbol, breadth first, splits intervals of suffixes and so derives common
   prefixes by increasing value; it stops at ``LENGTH``, and suffixes not parted by then start
   with the same window.
   An anchor whose fragments weigh more than ``SUFFIX_BYTES`` is taken out of its range. Its
   windows are dealt one by one, by a digest: counted with their least document, which every
   task reduces first; windows that stand in very many places are then sent to all executors.
5. Removed ranges are joined to their documents and cut out.

Defined cases: a null text is empty; texts shorter than the window lose nothing; a row without
a doc_id is compared with none and loses nothing; rows that share a doc_id are not
repeats of each other, whatever their texts; bytes are compared as they are, so a
multi-byte sign may be cut; an empty table gives no rows; other columns are ignored.

What one task holds is bounded: an anchor with many different fragments around it (the places
where a shared passage begins or ends) is dealt by windows, so its fragments need not meet.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from traceframe.llm.common import SLICE_BYTES, Scratch, slices

LENGTH = 50
GRAM = 20
RUN = 256  # most windows in a fragment
HASH_BITS = 40
FLUSH_BYTES = 24 << 20  # text behind one emission of anchors by a task
FRAGMENT_BYTES = 8 << 20  # and of fragments
RANGE_BYTES = 16 << 20  # text behind one hash range
MAP_BITS = 30  # the bit map has at most 2**30 bits
SENT_ROWS = 1_000_000  # rows sent to all executors once counted; more are joined by a shuffle
SENT_BYTES = 64 << 20
TRANSFORM_BYTES = 1 << 19  # text of one transform, or that of one anchor
SUFFIX_BYTES = 4 << 20  # weight of an anchor from which it is dealt by windows
ENTRY_BYTES = 64  # weight of a fragment's place, besides its text
FREQUENT = 10_000  # places of a window from which it is sent to all executors, not shuffled
WINDOWS = 1 << 16  # windows in a batch
BLOCK = 1 << 14  # windows hashed at a time

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MASK = np.uint64((1 << HASH_BITS) - 1)

SIDE = (LENGTH - GRAM) // 2  # a window has so many bytes on one side of its gram at least


# --- anchors --------------------------------------------------------------------------


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place, by doubling the length hashed."""
    h = codes.astype(np.uint64) + np.uint64(1)
    by_size = {1: h}
    size, factor = 1, np.uint64(0x100000001B3)
    while size * 2 <= GRAM:
        h = h[:-size] * factor + h[size:]
        size *= 2
        factor = np.uint64(int(factor) ** 2 & 0xFFFFFFFFFFFFFFFF)
        by_size[size] = h
    have = size
    for part in sorted(by_size, reverse=True):
        while have + part <= GRAM:
            tail = by_size[part][have:]
            n = len(codes) - have - part + 1
            h = h[:n] * _ODD + tail[:n]
            have += part
    h ^= h >> np.uint64(32)
    h *= _ODD
    h ^= h >> np.uint64(29)
    return h >> np.uint64(64 - HASH_BITS)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size, low = 1, values
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return low if size == width else np.minimum(low[: len(values) - width + 1], low[width - size :])


def _in_blocks(codes: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` a block of ``codes`` at a time, joined; it gives one value for every ``width`` codes in a row."""
    n = max(0, len(codes) - width + 1)
    out = np.empty(n, np.uint64)
    for a in range(0, n, BLOCK):  # arrays of one block stay in the processor's cache
        out[a : a + BLOCK] = of(codes[a : min(n, a + BLOCK) + width - 1])
    return out


def runs(joined: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, document, first byte in ``joined``, windows) of all runs of windows with one anchor.

    ``ends`` are the ends of documents of at least LENGTH bytes each.
    """
    if not len(joined):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    least = _in_blocks(joined, LENGTH, lambda codes: _sliding_min(_gram_hashes(codes), LENGTH - GRAM + 1))
    # A run ends where the minimum changes, a document begins, or windows would reach over its end.
    fresh = np.ones(len(least), bool)
    np.not_equal(least[1:], least[:-1], out=fresh[1:])
    fresh[ends[:-1]] = True
    fresh[ends[:-1] - LENGTH + 1] = True
    head = np.flatnonzero(fresh)
    long = np.diff(head, append=len(least))
    doc = np.searchsorted(ends, head, "right")
    inside = head + LENGTH <= ends[doc]
    head, long, doc = head[inside], long[inside], doc[inside]
    value = least[head]
    if long.max() > RUN:  # cut long runs
        pieces = -(-long // RUN)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        long = np.minimum(RUN, np.repeat(long, pieces) - step * RUN)
        head = np.repeat(head, pieces) + step * RUN
        value, doc = np.repeat(value, pieces), np.repeat(doc, pieces)
    return _name(value), doc, head, long


def _name(hashes: np.ndarray) -> np.ndarray:
    """Minima are small numbers; a multiplication spreads them over the whole range again."""
    return (hashes * _ODD) & _MASK


class _Texts:
    """Documents of a batch slice that are long enough, joined."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        kept = [(i, t) for i, t in zip(ids, texts, strict=True) if i is not None and t is not None and len(t) >= LENGTH]
        self.ids = np.array([i for i, _ in kept], np.int64)
        self.crcs = np.array([zlib.crc32(t) for _, t in kept], np.int64)
        self.bytes = b"".join(t for _, t in kept)
        self.ends = np.cumsum([len(t) for _, t in kept]) if kept else np.zeros(0, np.int64)
        self.starts = self.ends - np.diff(self.ends, prepend=0) if kept else self.ends
        self.anchor, self.doc, self.at, self.windows = runs(np.frombuffer(self.bytes, np.uint8), self.ends)


def _slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[_Texts]:
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
        for a, b in slices(sizes, SLICE_BYTES):
            yield _Texts(ids[a:b].to_pylist(), texts[a:b].to_pylist())


def _flushes(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[_Texts]]:
    held, size = [], 0
    for part in _slices_of(batches):
        held.append(part)
        size += len(part.bytes)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, each as the differences from its least value in the fewest bytes that hold them."""
    out = [len(arrays[0]).to_bytes(4, "little")]
    for a in arrays:
        low = int(a.min()) if len(a) else 0
        span = int(a.max()) - low if len(a) else 0
        width = 1 if span < 1 << 8 else 2 if span < 1 << 16 else 4 if span < 1 << 32 else 8
        out += [low.to_bytes(8, "little", signed=True), bytes([width]), (a.astype(np.int64) - low).astype(f"<u{width}").tobytes()]
    return zstandard.compress(b"".join(out), 1)


def _unpack(data: bytes, n: int) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    size, at, out = int.from_bytes(raw[:4], "little"), 4, []
    for _ in range(n):
        low, width = int.from_bytes(raw[at : at + 8], "little", signed=True), raw[at + 8]
        out.append(np.frombuffer(raw, f"<u{width}", size, at + 9).astype(np.int64) + low)
        at += 9 + width * size
    return out


def _emit_anchors(bits: int):
    """Per flush and hash range: anchors with their least and greatest document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _flushes(batches, FLUSH_BYTES):
            anchor = np.concatenate([p.anchor for p in parts])
            docs = np.concatenate([p.ids[p.doc] for p in parts])
            if not len(anchor):
                continue
            order = np.argsort(anchor, kind="stable")
            anchor, docs = anchor[order], docs[order]
            head = np.nonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))[0]
            own, low, high = anchor[head], np.minimum.reduceat(docs, head), np.maximum.reduceat(docs, head)
            place = (own >> np.uint64(HASH_BITS - bits)).astype(np.int64)
            cut = np.nonzero(np.concatenate([[True], place[1:] != place[:-1]]))[0]
            rows, data = place[cut].tolist(), []
            for a, b in zip(cut, [*cut[1:], len(own)], strict=True):
                first = int(own[a])
                data.append(_pack(np.diff(own[a:b].astype(np.int64), prepend=first), low[a:b], high[a:b] - low[a:b]) + first.to_bytes(8, "little"))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(data, pa.binary())], names=["place", "data"])

    return emit


def _mark_shared(bits: int, map_bits: int):
    """Slice of the bit map for one hash range."""

    def mark(group: pa.Table) -> pa.Table:
        anchors, lows, highs = [], [], []
        for data in group.column("data").to_pylist():
            step, low, more = _unpack(data[:-8], 3)
            anchors.append(np.cumsum(step) + int.from_bytes(data[-8:], "little"))
            lows.append(low)
            highs.append(low + more)
        anchor, low, high = map(np.concatenate, (anchors, lows, highs))
        order = np.argsort(anchor, kind="stable")
        anchor = anchor[order]
        head = np.nonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))[0]
        shared = anchor[head][np.minimum.reduceat(low[order], head) < np.maximum.reduceat(high[order], head)]
        slots = (shared >> (HASH_BITS - map_bits)) & ((1 << (map_bits - bits)) - 1)
        held = np.zeros(1 << (map_bits - bits), np.uint8)
        held[slots] = 1
        return pa.table({"place": group.column("place")[:1].cast(pa.int32()), "bits": pa.array([zstandard.compress(np.packbits(held).tobytes(), 1)], pa.binary())})

    return mark


# --- fragments ------------------------------------------------------------------------


def _ranges_row(ids: np.ndarray, crcs: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Removed ranges, united per document: place null, doc_id, crc, data (start and end of each as u32)."""
    order = np.lexsort((start, crcs, ids))
    ids, crcs, start, end = ids[order], crcs[order], start[order], end[order]
    cut = np.flatnonzero(_fresh(ids) | _fresh(crcs))
    # Each document's ranges are set behind those of the one before, out of their reach.
    apart = int(end.max(initial=0)) + 1
    behind = np.repeat(np.arange(len(cut)), np.diff(cut, append=len(ids))) * apart
    start, end = united(start + behind, end + behind)
    owner = start // apart
    pairs = np.stack([start, end], 1) - (owner * apart)[:, None]
    offsets = 8 * np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(cut)))])
    data = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(pairs.astype("<u4"))])
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(cut), pa.int32()), pa.array(ids[cut], pa.int64()), pa.array(crcs[cut], pa.int64()), data, pa.nulls(len(cut), pa.int64())],
        names=["place", "doc_id", "crc", "data", "most"],
    )


def _fresh(values: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before it."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


def united(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges ordered by start, with those that touch or overlap joined."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    fresh = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[fresh], reach[np.concatenate([np.nonzero(fresh)[0][1:] - 1, [len(start) - 1]])]


def _first_documents(code: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Least document of every text, by its number."""
    least = np.full(int(code.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, code, docs)
    return least


def _emit_fragments(bits: int, sent):
    """Fragments with a marked anchor, packed per flush and hash range; and ranges already known to be repeats."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        map_bits, held = sent.value
        for parts in _flushes(batches, FRAGMENT_BYTES):
            rows: list[tuple[np.ndarray, ...]] = []
            texts: list[bytes] = []
            for p in parts:
                slot = p.anchor >> np.uint64(HASH_BITS - map_bits)
                marked = np.flatnonzero((held[(slot >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (slot & np.uint64(7)).astype(np.uint8))) & 1)
                at, doc = p.at[marked], p.doc[marked]
                size = p.windows[marked] + (LENGTH - 1)
                rows.append((p.anchor[marked].astype(np.int64), p.ids[doc], p.crcs[doc], at - p.starts[doc], size))
                texts += [p.bytes[a:b] for a, b in zip(at.tolist(), (at + size).tolist(), strict=True)]
            if not texts:
                continue
            anchor, docs, crcs, start, size = map(np.concatenate, zip(*rows, strict=True))
            code = pa.array(texts, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            later = docs > _first_documents(code, docs)[code]
            if later.any():
                yield _ranges_row(docs[later], crcs[later], start[later], (start + size)[later])
            first = np.flatnonzero(~later)
            place = anchor >> (HASH_BITS - bits)
            first = first[np.lexsort((code[first], place[first]))]  # a text determines its anchor
            once = np.where(_fresh(code[first]), size[first], 0)  # places of one text follow each other
            cut = np.flatnonzero(_fresh(place[first]))
            data, most = [], []
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(first)], strict=True):
                own = first[a:b]
                text = b"".join([texts[i] for i in own[once[a:b] > 0].tolist()])
                data.append(_packed(anchor[own], docs[own], crcs[own], start[own], once[a:b], text))
                most.append(int(_weighed(anchor[own], once[a:b])[1].max()))
            none = pa.nulls(len(data), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(place[first[cut]], pa.int32()), none, none, pa.array(data, pa.binary()), pa.array(most, pa.int64())], names=["place", "doc_id", "crc", "data", "most"])

    return emit


def _packed(anchor: np.ndarray, doc: np.ndarray, crc: np.ndarray, start: np.ndarray, size: np.ndarray, text: bytes) -> bytes:
    head = _pack(anchor, doc, crc, start, size)
    return len(head).to_bytes(4, "little") + head + zstandard.compress(text, 1)


def _packed_fragments(rows: list[tuple[int, int, int, int, bytes]]) -> bytes:
    columns = (np.array(x, np.int64) for x in (*zip(*(r[:4] for r in rows), strict=True), [len(r[4]) for r in rows]))
    return _packed(*columns, b"".join(r[4] for r in rows))


def _heads(data: bytes) -> list[np.ndarray]:
    """anchor, doc, crc, start and bytes of text of packed fragments."""
    return _unpack(data[4 : 4 + int.from_bytes(data[:4], "little")], 5)


def _weights(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of packed fragments and what the fragments of each weigh."""
    anchor, _, _, _, long = _heads(data)
    return _weighed(anchor, long)


def _weighed(anchor: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, at = np.unique(anchor, return_inverse=True)
    return own, np.bincount(at, long + ENTRY_BYTES).astype(np.int64)


def _fragments(data: bytes) -> Iterator[tuple[int, int, int, int, bytes]]:
    size = int.from_bytes(data[:4], "little")
    anchor, doc, crc, start, long = (x.tolist() for x in _heads(data))
    text, at, last = zstandard.decompress(data[4 + size :]), 0, b""
    for a, d, c, s, n in zip(anchor, doc, crc, start, long, strict=True):
        if n:  # the places that follow without a text share it
            last, at = text[at : at + n], at + n
        yield a, d, c, s, last


def _resolve(group: pa.Table) -> pa.Table:
    """Removed ranges among all fragments of a hash range."""
    heads, whole, known = [], [], 0
    for data in group.column("data").to_pylist():
        anchor, doc, crc, start, long = _heads(data)
        raw = zstandard.decompress(data[4 + int.from_bytes(data[:4], "little") :])
        # The places that follow without a text share it.
        offsets = np.concatenate([[0], np.cumsum(long[long > 0])])
        whole.append(pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]))
        heads.append((anchor, doc, crc, start, known + np.cumsum(long > 0) - 1))
        known += len(offsets) - 1
    anchors, docs, crcs, start, text = map(np.concatenate, zip(*heads, strict=True))
    coded = pa.concat_arrays(whole).dictionary_encode()
    del whole, heads
    code = coded.indices.to_numpy().astype(np.int64)[text]
    texts = coded.dictionary
    size = np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset))
    least = _first_documents(code, docs)
    later = docs > least[code]
    done = [(docs[later], crcs[later], start[later], start[later] + size[code[later]])]
    # What is left stands in the least document of its text; its places follow each other by text.
    first = np.flatnonzero(~later)
    first = first[np.argsort(code[first], kind="stable")]
    places = np.searchsorted(code[first], np.arange(len(texts) + 1))
    own = anchors[first[places[:-1]]]
    kept = _with_context(texts, own, least)
    cut = [0, *(np.flatnonzero(_fresh(own[kept]))[1:]).tolist(), len(kept)] if len(kept) else [0]
    weight = np.concatenate([[0], np.cumsum(size[kept])])
    a = 0
    for b, after in zip(cut[1:], [*cut[2:], 0], strict=True):  # whole anchors, until there is text enough
        if after and weight[b] - weight[a] < TRANSFORM_BYTES:
            continue
        some = kept[a:b]
        a = b
        which, low, high = _by_transform(texts.take(pa.array(some)).to_numpy(zero_copy_only=False).tolist(), least[some])
        which = some[which]
        many = places[which + 1] - places[which]
        at = first[np.repeat(places[which] - np.cumsum(many) + many, many) + np.arange(many.sum())]
        done.append((docs[at], crcs[at], start[at] + np.repeat(low, many), start[at] + np.repeat(high, many)))
    return pa.Table.from_batches([_ranges_row(*map(np.concatenate, zip(*done, strict=True)))]).select(["doc_id", "crc", "data"])


def _with_context(texts: pa.Array, anchors: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Fragments that can share a window with one of another document, ordered by anchor.

    A window reaches over a gram of the anchor's hash, and ``SIDE`` bytes to its left or to its right at
    least. So fragments with a common window have a gram there in common as well, at the same
    distance from the anchor's. Hashes that meet by chance cost work, not results.
    """
    order = np.argsort(anchors, kind="stable")
    group = np.cumsum(_fresh(anchors[order])) - 1
    low, high = np.full(len(docs), np.iinfo(np.int64).max), np.full(len(docs), np.iinfo(np.int64).min)
    np.minimum.at(low, group, docs[order])
    np.maximum.at(high, group, docs[order])
    order = order[(low < high)[group]]
    if not len(order):
        return order
    own = texts.take(pa.array(order))
    ends = np.frombuffer(own.buffers()[1], np.int64, len(own) + 1, 8 * own.offset)
    joined = np.frombuffer(own.buffers()[2], np.uint8, ends[-1] - ends[0], ends[0])
    ends = ends[1:] - ends[0]
    hashes = _in_blocks(joined, GRAM, _gram_hashes)
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(hashes)]
    at = np.flatnonzero(_name(hashes) == anchors[order].astype(np.uint64)[owner])
    begin = ends - np.diff(ends, prepend=0)
    inside = at + GRAM <= ends[owner[at]]
    left = at[inside & (at - SIDE >= begin[owner[at]])]
    right = at[inside & (at + SIDE + GRAM <= ends[owner[at]])]
    key = np.concatenate([hashes[left - SIDE] << np.uint64(1), (hashes[right + SIDE] << np.uint64(1)) + np.uint64(1)])
    who = np.concatenate([owner[left], owner[right]])
    name = anchors[order].astype(np.uint64)[who]
    by = np.lexsort((key, name))
    key, name, who = key[by], name[by], who[by]
    head = np.flatnonzero(_fresh(key) | _fresh(name))
    doc = docs[order][who]
    several = np.minimum.reduceat(doc, head) < np.maximum.reduceat(doc, head)
    kept = np.zeros(len(order), bool)
    kept[who[np.repeat(several, np.diff(head, append=len(who)))]] = True
    return order[kept]


def _by_transform(fragments: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragment, start and end of the ranges of its windows that also start in a fragment of a smaller document."""
    again = repeated(fragments, docs)
    which = np.repeat(np.arange(len(again)), [len(x) for x in again])
    at = np.concatenate(again)
    behind = which * (max(map(len, fragments)) + 1)
    start, end = united(at + behind, at + behind + LENGTH)
    which = start // (max(map(len, fragments)) + 1)
    behind = which * (max(map(len, fragments)) + 1)
    return which, start - behind, end - behind


# --- anchors with many fragments ------------------------------------------------------


def heavy_anchors(emitted: DataFrame, limit: int) -> tuple[list[int], set[int]]:
    """Ranges with anchors whose fragments weigh more than ``limit``, and those anchors.

    The heaviest anchors of a range's rows add up to no less than its heaviest anchor, so other
    ranges are not opened. An anchor found has ``limit`` bytes of text, so they are few.
    """
    sums = emitted.where("place is not null").groupBy("place").agg(F.sum("most").alias("most")).where(F.col("most") > limit)
    places = [r["place"] for r in sums.collect()]  # one row per RANGE_BYTES of text at most
    if not places:
        return [], set()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, data in zip(batch.column("place"), batch.column("data"), strict=True):
                anchor, weight = _weights(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([place.as_py()] * len(anchor), pa.int32()), pa.array(anchor, pa.int64()), pa.array(weight, pa.int64())], names=["place", "anchor", "n"])

    weighed = emitted.where(F.col("place").isin(places)).select("place", "data").mapInArrow(weigh, "place int, anchor long, n long")
    found = weighed.groupBy("place", "anchor").agg(F.sum("n").alias("n")).where(F.col("n") > limit).collect()
    return sorted({r["place"] for r in found}), {r["anchor"] for r in found}


def without_anchors(emitted: DataFrame, places: list[int], heavy: set[int]) -> DataFrame:
    """place, data of all fragments but those of ``heavy`` anchors."""
    packed = emitted.where("place is not null").select("place", "data")
    if not places:
        return packed
    sent = emitted.sparkSession.sparkContext.broadcast(heavy)

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, data in zip(batch.column("place"), batch.column("data"), strict=True):
                out, last = [], b""
                for a, d, c, s, text in _fragments(data.as_py()):
                    if a not in sent.value:
                        out.append((a, d, c, s, b"" if text is last else text))
                    last = text
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([place.as_py()], pa.int32()), pa.array([_packed_fragments(out)], pa.binary())], names=["place", "data"])

    light = ~F.col("place").isin(places)
    return packed.where(light).unionByName(packed.where(~light).mapInArrow(leave, "place int, data binary"))


def by_windows(emitted: DataFrame, places: list[int], heavy: set[int], scratch: Scratch, frequent: int) -> DataFrame:
    """doc_id, crc, data: ranges of windows in fragments of ``heavy`` anchors that a smaller document has as well."""
    sent = emitted.sparkSession.sparkContext.broadcast(heavy)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ids, crcs, ats = [], [], [], []

        def dealt() -> pa.RecordBatch:
            columns = [pa.array(names, pa.binary()), *(pa.array(x, pa.int64()) for x in (ids, crcs, ats))]
            return pa.RecordBatch.from_arrays(columns, names=["window", "doc_id", "crc", "at"])

        for batch in batches:
            for data in batch.column("data"):
                last, own = b"", []
                for a, d, c, s, text in _fragments(data.as_py()):
                    if a not in sent.value:
                        continue
                    if text is not last:
                        last, own = text, [hashlib.blake2b(text[i : i + LENGTH], digest_size=16).digest() for i in range(len(text) - LENGTH + 1)]
                    names += own
                    ids += [d] * len(own)
                    crcs += [c] * len(own)
                    ats += range(s, s + len(own))
                    if len(names) >= WINDOWS:
                        yield dealt()
                        names, ids, crcs, ats = [], [], [], []
        yield dealt()

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, crcs, at = (batch.column(c).to_numpy() for c in ("doc_id", "crc", "at"))
            yield _ranges_row(ids, crcs, at, at + LENGTH).select(["doc_id", "crc", "data"])

    windows = emitted.where(F.col("place").isin(places)).select("data").mapInArrow(deal, "window binary, doc_id long, crc long, at long")
    least = windows.groupBy("window").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    least = scratch.save(least.select("window", "n", "low"), "windows")
    # Windows that stand in many places are few: no key of the shuffled join has more than ``frequent`` rows.
    often = F.broadcast(least.where(F.col("n") > frequent).select("window", F.col("low").alias("often")))
    marked = windows.join(often, "window", "left")
    known = marked.where("often < doc_id").select("doc_id", "crc", "at")
    others = marked.where("often is null").drop("often").join(least.where(F.col("n") <= frequent), "window").where("low < doc_id").select("doc_id", "crc", "at")
    return known.unionByName(others).mapInArrow(unite, "doc_id long, crc long, data binary")


# --- Burrows-Wheeler transform --------------------------------------------------------


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by their first ``depth`` symbols (below 512) at least, by prefix doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(7):  # seven symbols of nine bits
        key = (key << 9) | padded[i : i + n]
    order = np.argsort(key)  # suffixes with equal keys may stand in any order
    ordered = key[order]
    bits = n.bit_length()
    size = 7
    while size < depth:
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(_fresh(ordered)) - 1
        later = np.zeros(n, np.int64)
        later[: max(0, n - size)] = rank[size:] + 1
        key = (rank << bits) | later
        if 3 * bits < 64:  # numbers are sorted faster than an index of them
            ordered = np.sort((key << bits) | np.arange(n))
            order = ordered & ((1 << bits) - 1)
            ordered >>= bits
        else:
            order = np.argsort(key)
            ordered = key[order]
        size *= 2
    return order


def bounded_prefixes(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True where a suffix shares fewer than ``length`` symbols with the one before it in order.

    Breadth-first backward extension. An interval of suffixes that start with a string w
    is extended by each symbol that stands before them; the extended string's interval ends
    where the common prefix is as long as w, if no shorter string ended there before. So
    values come by increasing length, and the search stops at ``length``.
    """
    n = len(symbols)
    narrow = symbols.astype(np.uint16)  # numpy orders short numbers by radix
    before = narrow[order - 1]  # the transform; the first suffix is preceded by the last symbol
    begins = narrow[order]  # first symbol of the suffix at a place
    step = np.empty(n, np.int64)  # place of a suffix extended by the symbol before it
    step[np.argsort(before, kind="stable")] = np.arange(n)
    bits = max(1, n.bit_length())
    ends = np.zeros(n + 1, bool)
    ends[0] = ends[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        size = high - low
        if not len(size):
            break
        single = size == 1  # one suffix is extended by one symbol
        alone, low, size = step[low[single]], low[~single], size[~single]
        owner = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(owner)) + np.repeat(low - np.cumsum(size) + size, size)
        # Extended suffixes stand by symbol, so their places in order are grouped by it.
        key = np.sort((owner << bits) | step[place])
        owner, to = key >> bits, key & ((1 << bits) - 1)
        symbol = begins[to]
        fresh = (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
        first = np.concatenate([alone, to[:1], to[1:][fresh]])
        last = np.concatenate([alone, to[:-1][fresh], to[-1:]]) + 1
        fresh = ~ends[last]
        low, high = first[fresh], last[fresh]
        ends[high] = True
    return ends[:n]


def repeated(fragments: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For every fragment, where windows start that a fragment of a smaller document has as well."""
    sizes = np.array([len(f) for f in fragments])
    # Symbol 0 parts fragments, so that no window that counts reaches over an end.
    symbols = np.frombuffer(b"".join(f + b"\0" for f in fragments), np.uint8).astype(np.int64) + 1
    bounds = np.cumsum(sizes + 1)
    symbols[bounds - 1] = 0
    owner = np.repeat(np.arange(len(fragments)), sizes + 1)
    order = suffix_order(symbols, LENGTH + 1)
    group = np.cumsum(bounded_prefixes(symbols, order, LENGTH))
    whole = (bounds[owner] - 1 - np.arange(len(symbols)) >= LENGTH)[order]
    place, group = order[whole], group[whole]
    if not len(place):
        return [np.zeros(0, np.int64)] * len(fragments)
    doc = docs[owner[place]]
    head = np.nonzero(np.concatenate([[True], group[1:] != group[:-1]]))[0]
    least = np.repeat(np.minimum.reduceat(doc, head), np.diff(head, append=len(group)))
    found = np.sort(place[least < doc])
    cut = np.searchsorted(found, bounds - sizes - 1)
    return [x - s for x, s in zip(np.split(found, cut[1:]), bounds - sizes - 1, strict=True)]


# --- whole ----------------------------------------------------------------------------


def _small(df: DataFrame, rows: int, size: int) -> DataFrame:
    return F.broadcast(df) if rows <= SENT_ROWS and size <= SENT_BYTES else df


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, copy, ranges in zip(batch.column("text"), batch.column("copy").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
            whole = text.as_py() or b""
            if copy:
                start, end = np.array([0]), np.array([len(whole)])
            elif ranges:
                pairs = np.frombuffer(b"".join(ranges), "<u4").reshape(-1, 2).astype(np.int64)
                start, end = united(*pairs[np.argsort(pairs[:, 0])].T)
            else:
                start = end = np.zeros(0, np.int64)
            kept, at = hashlib.sha256(), 0
            for a, b in zip(start.tolist(), end.tolist(), strict=True):
                kept.update(whole[at:a])
                at = b
            kept.update(whole[at:])
            out.append((len(whole), int((end - start).sum()), len(start), kept.hexdigest(), start.tolist(), end.tolist()))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"])


def remove_repeats(docs: DataFrame, anchor_bytes: int = SUFFIX_BYTES, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends (removed byte ranges) of every row.

    Anchors whose fragments weigh more than ``anchor_bytes`` are dealt by windows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    named = whole.where("doc_id is not null").where(F.octet_length("text") >= LENGTH)
    digests = scratch.save(named.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.crc32("text").alias("crc"), F.octet_length("text").cast("long").alias("n")), "digests")
    firsts = digests.groupBy("sha").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = scratch.save(digests.join(firsts, "sha").where("doc_id > first").select("doc_id", "crc").distinct(), "copies")
    total = digests.agg(F.sum("n").alias("n")).first()["n"] or 0
    n_copies = copies.count()
    sent_copies = _small(copies, n_copies, 16 * n_copies)
    rest = named.withColumn("crc", F.crc32("text")).join(sent_copies, ["doc_id", "crc"], "left_anti").select("doc_id", "text")

    bits = max(1, (total // RANGE_BYTES).bit_length())  # hash ranges: a power of two
    map_bits = min(MAP_BITS, max(bits + 3, (total // 4).bit_length()))
    anchors = rest.mapInArrow(_emit_anchors(bits), "place int, data binary")
    marks = anchors.groupBy("place").applyInArrow(_mark_shared(bits, map_bits), "place int, bits binary")
    held = np.zeros(1 << (map_bits - 3), np.uint8)
    width = 1 << (map_bits - bits - 3)
    for row in scratch.save(marks, "marks").toLocalIterator():  # 2**map_bits bits at most
        held[row["place"] * width : (row["place"] + 1) * width] = np.frombuffer(zstandard.decompress(bytes(row["bits"])), np.uint8)
    sent = spark.sparkContext.broadcast((map_bits, held))

    emitted = scratch.save(rest.mapInArrow(_emit_fragments(bits, sent), "place int, doc_id long, crc long, data binary, most long"), "fragments")
    sent.unpersist()
    places, heavy = heavy_anchors(emitted, anchor_bytes)
    resolved = without_anchors(emitted, places, heavy).groupBy("place").applyInArrow(_resolve, "doc_id long, crc long, data binary")
    ranges = emitted.where("place is null").select("doc_id", "crc", "data").unionByName(resolved)
    if heavy:
        ranges = ranges.unionByName(by_windows(emitted, places, heavy, scratch, frequent))
    ranges = scratch.save(ranges.groupBy("doc_id", "crc").agg(F.collect_list("data").alias("ranges")), "ranges")  # per document
    sizes = ranges.agg(F.count("*").alias("rows"), F.sum(F.aggregate("ranges", F.lit(0), lambda a, x: a + F.octet_length(x) + 8)).alias("size")).first()

    keyed = whole.withColumn("crc", F.crc32("text"))
    joined = keyed.join(sent_copies.withColumn("copy", F.lit(True)), ["doc_id", "crc"], "left").join(_small(ranges, sizes["rows"], sizes["size"] or 0), ["doc_id", "crc"], "left")
    return joined.select("doc_id", "text", (F.coalesce("copy", F.lit(False)) & (F.octet_length("text") >= LENGTH)).alias("copy"), "ranges").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>"
    )
