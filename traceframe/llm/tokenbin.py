"""Token ids in binary files, coded by a static range asymmetric numeral system.

Documents are encoded with a public tokenizer, an end id is appended, and the ids of all
documents in ascending doc_id order are cut into blocks of whole documents. One table of
frequencies, counted over all ids, codes every block independently: ``LANES`` interleaved
coder states take the ids in turn, so a block is encoded and decoded as rows of a matrix. A
block starts with a header and a checksum of its ids, and holds a checkpoint every
``CHECKPOINT`` rows (coder states and place in the stream), so parts of a large block can be
decoded in parallel.

Files: ``frequencies`` (id, frequency; they add up to ``TOTAL``), ``blocks`` (part, first:
place of its first id in the part, doc_ids, counts, data: one row per block), ``parts``
(part, start, ids: ids before the part and in it). A part is a range of doc_id, in ascending
order, so parts are written and read independently.

Block data, little endian: magic "RANS", u32 ids, u32 crc32 of the ids as u32, u32 words,
u32 checkpoints; per checkpoint u32 row, u32 word and LANES u64 states; then words (u32).
Decoding starts at the last checkpoint, whose states are the coder's final ones, and goes up.

Defined cases: a null or empty text has the end id alone; rows with a null doc_id are left out,
as their place is not defined; rows that repeat a doc_id follow each other, ordered by a
digest of their text; an empty table gives empty files and no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenizers import Tokenizer

from traceframe.llm.common import Scratch, slices

END_ID = 2
LANES = 2048
TOTAL_BITS = 20  # frequencies add up to 2**20
TOTAL = 1 << TOTAL_BITS
CHECKPOINT = 256  # rows of LANES ids
BLOCK_IDS = 1 << 20  # a block is closed once it holds so many
PART_IDS = 8 << 20  # ids behind one part
TEXT_BYTES = 4 << 20  # text whose pieces are looked up together
KEPT_WORDS = 1_600_000  # pieces of text remembered by a worker
LOW = 1 << 31  # states stay in [2**31, 2**63)
MAGIC = b"RANS"


# --- tokenizing -----------------------------------------------------------------------


#: Signs that this module and the tokenizer may not both take for white space.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ODD_ASCII = "\x1c\x1d\x1e\x1f"

#: Full stop or comma that ends a piece but does not follow a letter.
_APART = re.compile(r"[.,](?<![a-z\xdf-\xf6\xf8-\u024f][.,])(?:\s|$)")

#: Letters and then ASCII signs without an apostrophe: two pieces for the tokenizer.
_TAILED = re.compile(r"([a-z\xdf-\xf6\xf8-\u024f]+)([!-&(-/:-@\[-`{-~]+)")

#: Byte-level vocabularies write bytes that are no visible sign as the code points from 256 on, in order.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SIGN_OF_BYTE = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}

#: Words on which the model alone must agree with the whole tokenizer.
_TRIAL = ["a", "hello", "zebrafinch", "z\xfcrich", "stra\xdfe", "\xe9\xe8\xea", "\u65e5\u672c\u8a9e", "qzx" * 15]


class Words:
    """Ids (u32, little endian) per piece of text between white space.

    The tokenizer drops white space and never joins over it, so every distinct piece goes
    through the library once. It also lower-cases and parts letters from signs, so this is done
    first, which leaves fewer pieces. A piece of letters is one word for the library's model, which is
    asked directly (if it agrees with the whole tokenizer on some trial words). Texts with
    unusual spaces, a capital sigma or a dotted capital I go to the library whole, and so do those in which lower-casing
    makes or spoils a special token, as '<|EndOfText|>' is none.

    Two generations of pieces are kept; one not met while the younger fills up is dropped.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.direct = self.words(_TRIAL) == self.library(_TRIAL)

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of letters by the model alone."""
        tokenize = self.model.tokenize
        found = [[t.id for t in tokenize(p if p.isascii() else p.encode("utf-8").decode("latin-1").translate(_SIGN_OF_BYTE))] for p in pieces]
        whole = array("I", chain.from_iterable(found)).tobytes()
        ends = accumulate(map(len, found))
        return [whole[4 * (end - len(ids)) : 4 * end] for ids, end in zip(found, ends, strict=True)]

    def learn(self, fresh: set[str]) -> None:
        """Ids of pieces that the younger generation does not hold."""
        if len(self.ids) + len(fresh) > KEPT_WORDS // 2:
            self.older, self.ids = self.ids, {}
        known = fresh & self.older.keys()
        self.ids.update((p, self.older[p]) for p in known)
        fresh = fresh - known
        signs = [p for p in fresh if not p.isalpha()]
        tailed = {p: m.groups() for p in signs if (m := _TAILED.fullmatch(p))}
        whole = fresh.difference(tailed).union(*tailed.values()).difference(self.ids)
        letters = [p for p in whole if self.direct and p.isalpha() and (p.isascii() or unicodedata.is_normalized("NFC", p))]
        others = list(whole.difference(letters))
        self.ids.update(zip(letters, self.words(letters), strict=True))
        self.ids.update(zip(others, self.library(others), strict=True))
        self.ids.update((p, self.ids[a] + self.ids[b]) for p, (a, b) in tailed.items())

    def plain(self, text: str | None) -> str | None:
        """A text whose pieces are those between its white space, or None if the library must have it whole."""
        if not text:
            return ""
        if any(c in text for c in _ODD_ASCII) if text.isascii() else "\u03a3" in text or "\u0130" in text or _ODD_SPACE.search(text):
            return None
        plain = text.lower()
        if any(plain.count(t) != text.count(t) for t in self.special):
            return None
        if not _APART.search(plain):
            plain = plain.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n").replace(",\n", " ,\n")
            if plain[-1:] in (".", ","):
                plain = f"{plain[:-1]} {plain[-1]}"
        return plain

    def encode(self, texts: list[str | None]) -> list[bytes]:
        plain = [self.plain(t) for t in texts]
        # Pieces at the ends of a text may be empty, which has no ids.
        cut = pc.ascii_split_whitespace(pa.array([p or "" for p in plain], pa.large_string()))
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.ids.get, distinct))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        if unknown:
            self.learn({distinct[i] for i in unknown})
            for i in unknown:
                found[i] = self.ids[distinct[i]]
        # Ids of the distinct pieces, one after the other, are gathered in the order of all pieces.
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = coded.indices.to_numpy()
        own = sizes.take(which)
        ends = np.concatenate([[0], np.cumsum(own)])
        shift = (np.cumsum(sizes) - sizes).take(which) - ends[:-1]
        ids = np.frombuffer(b"".join(found), "<u4").take(np.arange(ends[-1]) + np.repeat(shift, own))
        bounds = ends[cut.offsets.to_numpy()].tolist()
        return [
            ids[a:b].tobytes() if p is not None else self.library([text])[0]
            for text, p, a, b in zip(texts, plain, bounds[:-1], bounds[1:], strict=True)
        ]


_WORDS: dict[str, Words] = {}


def _words(path: str) -> Words:
    if path not in _WORDS:
        _WORDS.clear()
        _WORDS[path] = Words(path)
    return _WORDS[path]


def tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, digest, n, ids (with the end id) of every whole text; ``unpacked`` reads ids."""
    end = np.array([END_ID], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _words(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.binary_length(texts).to_pylist() if batch.num_rows else []
            for a, b in slices([n or 0 for n in sizes], TEXT_BYTES):
                found = [np.frombuffer(x + end, "<u4") for x in coder.encode(texts[a:b].to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:b], batch.column("digest")[a:b], pa.array([len(x) for x in found], pa.int64()), pa.array(map(packed, found), pa.binary())],
                    names=["doc_id", "digest", "n", "ids"],
                )

    return docs.mapInArrow(encode, "doc_id long, digest long, n long, ids binary")


def packed(ids: np.ndarray) -> bytes:
    """Ids as u16, or after a zero byte as u32 if one needs it."""
    return ids.astype("<u2").tobytes() if ids.max(initial=0) < 1 << 16 else b"\0" + ids.astype("<u4").tobytes()


def unpacked(ids: bytes) -> np.ndarray:
    """Ids of one document; an odd length marks 32-bit numbers."""
    return np.frombuffer(ids, "<u4", offset=1) if len(ids) % 2 else np.frombuffer(ids, "<u2").astype(np.uint32)


# --- coding ---------------------------------------------------------------------------


def scaled(counts: dict[int, int]) -> dict[int, int]:
    """Frequencies that add up to ``TOTAL``, at least 1 for every id that occurs."""
    if not counts:
        return {}
    if len(counts) > TOTAL:
        raise ValueError("more ids than the frequency table can hold")
    every = sum(counts.values())
    free = TOTAL - len(counts)
    exact = {i: n * free / every for i, n in counts.items()}
    out = {i: 1 + int(x) for i, x in exact.items()}
    left = TOTAL - sum(out.values())
    for i in sorted(exact, key=lambda i: (int(exact[i]) - exact[i], i))[:left]:
        out[i] += 1
    return out


class Table:
    """Frequency, start and slot of ids for coding; a state at or over ``limit`` gives up 32 bits first."""

    def __init__(self, frequencies: dict[int, int]):
        ids = np.array(sorted(frequencies), np.int64)
        own = np.array([frequencies[i] for i in ids.tolist()], np.int64)
        size = int(ids.max(initial=0)) + 1
        self.frequency, self.start, self.limit = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.frequency[ids] = own
        self.start[ids] = np.cumsum(own) - own
        # With one id alone the limit would be 2**63, which no state reaches.
        self.limit[ids] = np.where(own < TOTAL, own << (63 - TOTAL_BITS), np.iinfo(np.int64).max)
        self.slot = np.repeat(ids.astype(np.int32), own)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """Code ids; the last row is padded with the first id of the block."""
    rows = -(-len(ids) // LANES)
    whole = np.full(rows * LANES, ids[0], np.int64)
    whole[: len(ids)] = ids
    grid = whole.reshape(rows, LANES)
    state = np.full(LANES, LOW, np.int64)
    words: list[np.ndarray] = []
    n = 0
    marks = []
    # Rows are coded from the last to the first, so that decoding goes from first to last.
    for r in range(rows - 1, -1, -1):
        own = grid[r]
        full = np.flatnonzero(state >= table.limit.take(own))
        if len(full):
            some = state.take(full)
            words.append((some & 0xFFFFFFFF).astype("<u4"))
            n += len(full)
            state[full] = some >> 32
        f = table.frequency.take(own)
        # state // f * TOTAL + state % f + start, with one division of positive numbers
        state += (state.view(np.uint64) // f.view(np.uint64)).view(np.int64) * (TOTAL - f) + table.start.take(own)
        if r % CHECKPOINT == 0:
            marks.append((r, n, state.astype("<u8").tobytes()))
    stream = np.concatenate(words) if words else np.zeros(0, "<u4")
    head = MAGIC + struct.pack("<4I", len(ids), zlib.crc32(ids.astype("<u4").tobytes()), len(stream), len(marks))
    return head + b"".join(struct.pack("<2I", r, at) + state for r, at, state in reversed(marks)) + stream.tobytes()


class Block:
    """A coded block; ``decode`` gives ids of all rows or of the stretch between checkpoints."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block")
        self.n, self.crc, words, marks = struct.unpack_from("<4I", data, 4)
        at, size = 20, 8 + 8 * LANES
        self.marks = []
        for i in range(marks):
            row, word = struct.unpack_from("<2I", data, at + i * size)
            self.marks.append((row, word, np.frombuffer(data, "<u8", LANES, at + i * size + 8).astype(np.int64)))
        self.stream = np.frombuffer(data, "<u4", words, at + marks * size)
        self.rows = -(-self.n // LANES)

    def stretch(self, i: int, table: Table) -> np.ndarray:
        """Ids from checkpoint i to the next one, on its own."""
        row, word, state = self.marks[i]
        last = self.marks[i + 1][0] if i + 1 < len(self.marks) else self.rows
        out = np.empty((last - row, LANES), np.uint32)
        state = state.copy()
        for r in range(last - row):
            slot = state & (TOTAL - 1)
            ids = table.slot.take(slot)
            out[r] = ids
            state >>= TOTAL_BITS
            state *= table.frequency.take(ids)
            state += slot
            state -= table.start.take(ids)
            short = np.flatnonzero(state < LOW)
            if len(short):
                state[short] = (state.take(short) << 32) | self.stream[word - len(short) : word]
                word -= len(short)
        return out.reshape(-1)[: self.n - row * LANES]

    def decode(self, table: Table) -> np.ndarray:
        ids = np.concatenate([self.stretch(i, table) for i in range(len(self.marks))]) if self.marks else np.zeros(0, np.uint32)
        if zlib.crc32(ids.astype("<u4").tobytes()) != self.crc:
            raise ValueError("checksum of a block does not match its ids")
        return ids


# --- files ----------------------------------------------------------------------------


_BLOCKS = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("data", pa.binary())])


def write(docs: DataFrame, path: str, tokenizer: str, part_ids: int = PART_IDS) -> None:
    """Encode all texts and write the files below ``path``.

    Texts are encoded where they are read; their ids are then range-partitioned by doc_id, so
    what is shuffled is ids once. A task codes one part and holds one block at a time.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    stored = scratch.save(tokens(own, tokenizer), "ids")

    counts = stored.select("ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    frequencies = scaled({r["id"]: r["n"] for r in counts.collect()})  # one row per id of the vocabulary
    spark.createDataFrame(sorted(frequencies.items()), "id long, frequency long").coalesce(1).write.parquet(f"{path}/frequencies")
    sent = spark.sparkContext.broadcast(frequencies)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, part = Table(sent.value), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        ids: list[int] = []
        first = total = 0

        def block() -> pa.RecordBatch:
            row = {"part": [part], "first": [first], "doc_ids": [ids], "counts": [[len(x) for x in held]], "data": [encode_block(np.concatenate(held), table)]}
            return pa.RecordBatch.from_pydict(row, schema=_BLOCKS)

        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                held.append(unpacked(raw.as_py()))
                ids.append(doc)
                total += len(held[-1])
                if total >= BLOCK_IDS:
                    yield block()
                    first, total, held, ids = first + total, 0, [], []
        if held:
            yield block()

    every = stored.agg(F.sum("n").alias("n")).first()["n"] or 0
    ordered = stored.drop("n").repartitionByRange(max(1, -(-every // part_ids)), "doc_id", "digest").sortWithinPartitions("doc_id", "digest").select("doc_id", "ids")
    blocks = ordered.mapInArrow(code, "part int, first long, doc_ids array<long>, counts array<long>, data binary")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")

    sums = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids")).orderBy("part").collect()
    starts, at = [], 0  # one row per part
    for r in sums:
        starts.append((r["part"], at, r["ids"]))
        at += r["ids"]
    spark.createDataFrame(starts, "part int, start long, ids long").coalesce(1).write.parquet(f"{path}/parts")
    scratch.drop(stored)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of ids in a task."""
    held = np.zeros(1 << 16, np.int64)
    for batch in batches:
        texts = batch.column("ids")
        sizes = pc.binary_length(texts).to_pylist() if batch.num_rows else []
        for a, b in slices(sizes):
            own = np.bincount(np.concatenate([unpacked(raw) for raw in texts[a:b].to_pylist()]))
            if len(own) > len(held):
                held = np.pad(held, (0, len(own) - len(held)))
            held[: len(own)] += own
    found = np.nonzero(held)[0]
    yield pa.RecordBatch.from_pydict({"id": found.astype(np.int64), "n": held[found]})


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids of every document, from the files alone."""
    frequencies = {r["id"]: r["frequency"] for r in spark.read.parquet(f"{path}/frequencies").collect()}  # as many as the vocabulary
    sent = spark.sparkContext.broadcast(frequencies)
    parts = spark.read.parquet(f"{path}/parts").select("part", "start")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(sent.value)
        for batch in batches:
            for start, docs, counts, data in zip(*(batch.column(c).to_pylist() for c in ("start", "doc_ids", "counts")), batch.column("data"), strict=True):
                ids = Block(data.as_py()).decode(table).astype("<u4")
                ends = np.cumsum(counts)
                own = [ids[e - n : e].tobytes() for e, n in zip(ends, counts, strict=True)]
                columns = [docs, start + ends - np.array(counts), counts, [zlib.crc32(x) for x in own]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(own, pa.binary())], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    blocks = spark.read.parquet(f"{path}/blocks").join(F.broadcast(parts), "part")  # a part has millions of ids, so parts are few
    placed = blocks.select((F.col("start") + F.col("first")).alias("start"), "doc_ids", "counts", "data")
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
