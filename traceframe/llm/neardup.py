"""Near duplicates by MinHash bands, sequential Bayesian verification and exact sets.

1. A text is cut into words and its distinct n-word shingles are hashed; a signature holds
   ``HASHES`` minima. Documents with the same shingle set are one class and go on as one
   representative, so copies cost one row each and no pairs.
2. Signatures are cut into bands. In every bucket of a band, the most central member (the
   one whose buckets hold most rows) is the hub and the others are candidates of the hub: a
   bucket of n rows makes n - 1 pairs.
3. A candidate pair is compared hash batch by hash batch. It is dropped as soon as the
   posterior probability, from a flat prior, that its similarity reaches the threshold is
   below ``MISS``; survivors are confirmed on their full shingle sets.
4. Confirmed links are joined into components. In buckets whose members still stand in several
   components, the members outside the largest one are compared with all of other
   components, in blocks inside tasks: pairs that the posterior cannot rule out are tested on
   sets of 32-bit hashes, which can only overrate a pair. What is left leaves the task and is
   confirmed on the full sets. So no link between components is lost. A bucket with few such
   members moves each row once or a few times; a family too loose to be linked at all is
   compared block by block, and its rows move as often as it has blocks.

Defined cases: a null text, an empty one and one without words have no shingles, are linked
with nothing and kept; a text with fewer words than a shingle has one shingle, the whole
sequence; rows that repeat a doc_id are treated row by row under that id; rows with a null
doc_id are left out, as they could not be named; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from traceframe.llm.common import Scratch, slices

HASHES = 128
ROWS = 4  # hashes in a band; a pair of similarity 0.8 shares none of 32 bands with probability 5e-8
BATCH = 16  # hashes compared before the next decision
MISS = 1e-7  # posterior below which a pair is dropped
SENT_IDS = 1_000_000  # ids sent to all executors (8 MB); more are joined by a shuffle
BLOCK = 1024  # members of a bucket compared with as many others in one task
BLOCK_BYTES = 64 << 20  # of their sets

_SEEDS = np.random.default_rng(20240229).integers(1, 2**63, size=(2, HASHES), dtype=np.uint64)
_A, _B = _SEEDS[0] | np.uint64(1), _SEEDS[1]


class _WordHashes(dict):
    """Hash per word; emptied when it grows large, which changes no value."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; words end at ASCII white space, A-Z are folded."""
    words = text.lower().split()  # bytes.lower folds A-Z only, bytes.split cuts at \\x20 and \\x09-\\x0D
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ hashes[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over a set, as 32-bit numbers."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(best, (shingles[i : i + 512, None] * _A + _B).min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def least_matches(threshold: float, miss: float = MISS) -> dict[int, int]:
    """For every number of hashes compared: the fewest matches that keep a pair.

    With m of n hashes equal and a flat prior, the similarity is Beta(m + 1, n - m + 1); its
    tail above the threshold is a binomial sum: P(Binomial(n + 1, threshold) <= m).
    """
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                out[n] = m
                break
    return out


def _survivors(left: np.ndarray, right: np.ndarray, keep: dict[int, int]) -> np.ndarray:
    """Which row pairs of two signature matrices stay after all batches; most leave after the first."""
    alive = np.arange(len(left))
    match = np.zeros(len(left), np.int64)
    for n in range(BATCH, HASHES + 1, BATCH):
        match[alive] += (left[alive, n - BATCH : n] == right[alive, n - BATCH : n]).sum(axis=1)
        alive = alive[match[alive] >= keep[n]]
        if not len(alive):
            break
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def profiles(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the shingle set, null without any), sig."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, sigs = [], [], []
            for value in batch.column("text"):
                found = shingle_hashes(value.as_py() or b"", words)
                counts.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sigs.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "sig"],
            )

    return docs.mapInArrow(build, "doc_id long, n_shingles long, set_key binary, sig binary")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, hashes: the full shingle set as sorted 64-bit numbers."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            sizes = [len(t.as_buffer() or b"") if t.is_valid else 0 for t in texts]
            for a, b in slices(sizes):
                sets = [shingle_hashes(t.as_py() or b"", words).tobytes() for t in texts[a:b]]
                yield pa.RecordBatch.from_arrays([ids[a:b], pa.array(sets, pa.binary())], names=["doc_id", "hashes"])

    return docs.mapInArrow(build, "doc_id long, hashes binary")


def _bands(reps: DataFrame) -> DataFrame:
    """bucket, band, doc: one row per band; the band's number is part of the bucket's hash."""
    width = 4 * ROWS
    cut = F.array(*[F.xxhash64(F.lit(i), F.substring("sig", 1 + i * width, width)) for i in range(HASHES // ROWS)])
    return reps.select(F.posexplode(cut).alias("band", "bucket"), F.col("doc_id").alias("doc"))


def _screened(pairs: DataFrame, reps: DataFrame, keep: dict[int, int]) -> DataFrame:
    """Pairs (doc, other) that the sequential test keeps."""
    sigs = reps.select("doc_id", "sig")
    both = pairs.join(sigs.select(F.col("doc_id").alias("doc"), F.col("sig").alias("sig_a")), "doc").join(
        sigs.select(F.col("doc_id").alias("other"), F.col("sig").alias("sig_b")), "other"
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                stay = _survivors(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")), keep)
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("other")], names=["doc", "other"]).filter(pa.array(stay))

    return both.select("doc", "other", "sig_a", "sig_b").mapInArrow(test, "doc long, other long")


def _sets_of(ids: DataFrame, texts: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """Full sets of the documents with these ids; few ids are sent, so that texts need not move."""
    own = scratch.save(ids.distinct(), "ids")
    few = own.count() <= SENT_IDS
    return scratch.save(_sets(texts.join(F.broadcast(own) if few else own, "doc_id", "left_semi"), words), "sets")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union.

    Only the texts of documents in pairs are cut again; a hub's set meets its candidates in a
    join that Spark splits where one hub is frequent.
    """
    sets = _sets_of(pairs.select(F.explode(F.array("doc", "other")).alias("doc_id")), texts, words, scratch)
    both = pairs.join(sets.select(F.col("doc_id").alias("doc"), F.col("hashes").alias("a")), "doc").join(
        sets.select(F.col("doc_id").alias("other"), F.col("hashes").alias("b")), "other"
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = []
            for x, y in zip(batch.column("a"), batch.column("b"), strict=True):
                a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                least, most = sorted((len(a), len(b)))
                common = 0 if 100 * least < percent * most else len(np.intersect1d(a, b, assume_unique=True))
                stay.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("other")], names=["doc", "other"]).filter(pa.array(stay, pa.bool_()))

    return both.select("doc", "other", "a", "b").mapInArrow(test, "doc long, other long").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component: the smallest node that links (doc, other) reach, for nodes in links.

    Every round gives each node the least label among its neighbours and then jumps to the
    label of that label; tables are written between rounds.
    """
    edges = scratch.save(links.select("doc", "other").union(links.select("other", "doc")).distinct(), "edges")
    labels = scratch.save(edges.groupBy(F.col("doc").alias("node")).agg(F.least(F.min("other"), F.col("doc")).alias("component")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "other"), "other").groupBy(F.col("doc").alias("node")).agg(F.min("component").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        # A label's own smaller neighbour label is passed on to all that carry it.
        root = spread.groupBy("old").agg(F.min("component").alias("root"))
        hooked = spread.join(root, "old").select("node", "old", F.least("component", "root").alias("component"))
        jumped = hooked.join(labels.select(F.col("node").alias("component"), F.col("component").alias("next")), "component", "left").select(
            "node", "old", F.least("component", F.coalesce("next", "component")).alias("component")
        )
        stored = scratch.save(jumped, "labels")
        if stored.where("component < old").limit(1).count() == 0:
            return stored.select("node", "component")
        labels = stored.select("node", "component")


def _shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Upper halves of the hashes, still in order and as many: what was equal stays equal."""
    for batch in batches:
        short = [(np.frombuffer(x.as_py(), np.uint64) >> np.uint64(32)).astype(np.uint32).tobytes() for x in batch.column("hashes")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(short, pa.binary())], names=["doc", "short"])


def _rest(buckets: DataFrame, reps: DataFrame, labels: DataFrame, keep: dict[int, int], texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of different components in one bucket that short sets cannot rule out.

    ``buckets`` has bucket, band, doc of all buckets with more than two rows; the only pair of a
    smaller one was its hub's. Only members outside the bucket's largest component, its strays, are
    compared with all others: strays and members are dealt into blocks of ``BLOCK`` rows and
    ``BLOCK_BYTES`` of sets, and every block of strays meets every block of members. A pair is
    tested in the first band it shares.
    """
    placed = buckets.join(labels.select(F.col("node").alias("doc"), "component"), "doc", "left").select(
        "bucket", "band", "doc", F.coalesce("component", "doc").alias("component")
    )
    parts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("bucket").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.count("*").alias("parts")).where("parts > 1").drop("parts")
    open_ = placed.join(mixed, "bucket").withColumn("stray", F.col("component") != F.col("main")).drop("main")
    open_ = scratch.save(open_.join(reps.select(F.col("doc_id").alias("doc"), (F.col("n_shingles") * 4 + HASHES * 4).alias("bytes")), "doc"), "open")
    blocks_of = lambda n, held: F.greatest(F.ceil(n / BLOCK), F.ceil(held / BLOCK_BYTES), F.lit(1)).cast("int")
    sizes = open_.groupBy("bucket").agg(
        blocks_of(F.count_if("stray"), F.sum(F.when(F.col("stray"), F.col("bytes")).otherwise(0))).alias("stray_blocks"), blocks_of(F.count("*"), F.sum("bytes")).alias("blocks")
    )
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n: F.pmod(F.xxhash64("doc"), F.col(n)).cast("int")
    sized = open_.join(sizes, "bucket")
    fields = ["bucket", "band", "doc", "component", "stray"]
    dealt = (
        sized.select(*fields, F.lit(False).alias("asks"), F.explode(every("stray_blocks")).alias("i"), own("blocks").alias("j"))
        .unionByName(sized.where("stray").select(*fields, F.lit(True).alias("asks"), own("stray_blocks").alias("i"), F.explode(every("blocks")).alias("j")))
    )
    short = _sets_of(open_.select(F.col("doc").alias("doc_id")), texts, words, scratch).mapInArrow(_shorten, "doc long, short binary")
    known = reps.select(F.col("doc_id").alias("doc"), "sig").join(short, "doc")
    signed = dealt.join(known, "doc").select(*fields, "asks", "i", "j", "sig", "short")

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        band, asks, stray = group.column("band")[0].as_py(), *(group.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "stray"))
        docs, parts, sigs = group.column("doc").to_numpy(), group.column("component").to_numpy(), _signatures(group.column("sig"))
        sets = [np.frombuffer(x.as_py(), np.uint32) for x in group.column("short")]
        sizes = np.array([len(x) for x in sets])
        # Places before the band: a pair that is equal in a whole earlier band is tested there.
        earlier = sigs[:, : band * ROWS].reshape(len(docs), band, ROWS)
        a, b = np.nonzero(asks)[0], np.nonzero(~asks)[0]
        found = []
        for i in a:
            other = b[(parts[b] != parts[i]) & ((docs[b] > docs[i]) | ~stray[b])]  # two strays meet twice
            ratio = 100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i])
            other = other[ratio]
            if len(other):
                other = other[_survivors(np.broadcast_to(sigs[i], (len(other), HASHES)), sigs[other], keep)]
            if len(other) and band:
                other = other[~(earlier[other] == earlier[i]).all(axis=2).any(axis=1)]
            for o in other:
                place = np.searchsorted(sets[i], sets[o])
                common = int((sets[i][np.minimum(place, sizes[i] - 1)] == sets[o]).sum())
                if 100 * common >= percent * (sizes[i] + sizes[o] - common):
                    found.append((min(docs[i], docs[o]), max(docs[i], docs[o])))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"doc": pairs[:, 0], "other": pairs[:, 1]})

    return signed.groupBy("bucket", "i", "j").applyInArrow(compare, "doc long, other long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document.

    Documents are linked if 100 * intersection >= percent * union of their sets of shingles of
    ``words`` words; component_id is the smallest id that links reach.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    keep = least_matches(percent / 100)
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    every = scratch.save(profiles(texts, words), "profiles")
    classes = every.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = scratch.save(classes, "classes")
    signed = every.where("set_key is not null").join(classes.withColumnRenamed("rep", "doc_id"), ["set_key", "doc_id"], "left_semi")
    reps = scratch.save(signed.dropDuplicates(["doc_id", "set_key"]).select("doc_id", "sig", "n_shingles"), "representatives")

    bands = _bands(reps)
    full = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = scratch.save(bands.join(full, "bucket"), "buckets")  # bucket, band, doc, n
    central = buckets.groupBy("doc").agg(F.sum("n").alias("degree"))
    ranked = buckets.join(central, "doc")
    hub = ranked.groupBy("bucket").agg(F.min_by("doc", F.struct(-F.col("degree"), F.col("doc"))).alias("hub"))
    pairs = (
        buckets.join(hub, "bucket").where("doc <> hub")
        .select(F.least("doc", "hub").alias("doc"), F.greatest("doc", "hub").alias("other")).distinct()
    )
    tried = scratch.save(_screened(pairs, reps, keep), "screened")
    links = scratch.save(_confirmed(tried, texts, words, percent, scratch), "links")
    labels = components(links, scratch)

    more = scratch.save(_rest(buckets.where("n > 2").select("bucket", "band", "doc"), reps, labels, keep, texts, words, percent, scratch), "rest")
    fresh = more.join(tried, ["doc", "other"], "left_anti")
    late = scratch.save(_confirmed(fresh, texts, words, percent, scratch), "late-links")
    if late.limit(1).count():
        labels = components(links.union(late), scratch)

    named = classes.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component")
    )
    out = every.join(named, "set_key", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
