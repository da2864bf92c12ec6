"""Benchmark decontamination with one Aho-Corasick automaton over item windows.

Every distinct benchmark word is one letter of the automaton's alphabet, every window of
``window`` consecutive item words is one pattern. A document is cut into words once, mapped
to that alphabet (a word no item has is a letter no pattern has) and scanned once; the end
of a match is a word number, which is carried back to offsets of the original text.

Defined cases: a null or empty text has no words; a null, empty or word-free item has no
windows, an item shorter than the window is one window; equal windows of several items name
all of them; windows of an item without an id are hit like any other, but no item is named;
rows that repeat a doc_id are scanned each for itself; a null doc_id is kept; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

WINDOW = 10
#: A word before letters are folded.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Item words behind one automaton (about 60 bytes for each word of each window in a worker).
#: A larger benchmark is dealt over several automata, each with a scan of its own.
AUTOMATON_WORDS = 200_000

# Separators become spaces, A-Z become lower case; the bytes of all other code points stay.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("digest", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
        T.StructField("hit_words", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))),
    ]
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_windows(item_words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not item_words:
        return []
    return [tuple(item_words[i : i + window]) for i in range(max(1, len(item_words) - window + 1))]


class Automaton:
    """Windows of items over an alphabet of words."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        patterns: dict[str, tuple[int, set[str]]] = {}
        self.letters: dict[bytes, str] = {}
        for item, text in items:
            for w in item_windows(words(text), window):
                key = "".join(self._letter(x) for x in w)
                patterns.setdefault(key, (len(w), set()))[1].update([item] if item is not None else [])
        self.machine = ahocorasick.Automaton()
        for key, value in patterns.items():
            self.machine.add_word(key, value)
        self.empty = not patterns
        if not self.empty:
            self.machine.make_automaton()

    def _letter(self, word: bytes) -> str:
        n = len(self.letters) + 1  # 0 stands for all words that no item has
        return self.letters.setdefault(word, chr(n if n < 0xD800 else n + 0x800))

    def scan(self, text: bytes) -> tuple[int, list[list[int]], set[str], bytes]:
        """Words of the text, runs [first, last] of hit words, items found, folded text."""
        folded = text.translate(_FOLD)
        own = folded.split()
        runs: list[list[int]] = []
        found: set[str] = set()
        if not self.empty and own:
            get = self.letters.get
            coded = "".join([get(w, "\0") for w in own])
            spans = []
            for end, (size, names) in self.machine.iter(coded):
                spans.append((end - size + 1, end))
                found |= names
            for first, last in sorted(spans):
                if runs and first <= runs[-1][1] + 1:
                    runs[-1][1] = max(runs[-1][1], last)
                else:
                    runs.append([first, last])
        return len(own), runs, found, folded


def offsets(text: bytes, folded: bytes, runs: list[list[int]]) -> list[dict]:
    """Code-point offsets in the original text of runs of words; the end is exclusive."""
    places = [m.span() for m in _WORD.finditer(folded)]
    out, at, seen = [], 0, 0
    for first, last in runs:
        begin, end = places[first][0], places[last][1]
        seen += len(text[at:begin].decode("utf-8", "replace"))
        size = len(text[begin:end].decode("utf-8", "replace"))
        out.append({"start": seen, "end": seen + size})
        at, seen = end, seen + size
    return out


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, items, window: int) -> Automaton:
    """One per worker process, kept for the tasks that follow."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(items.value, window)
    return _BUILT[key]


def _scan_part(docs: DataFrame, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    key = f"{docs.sparkSession.sparkContext.applicationId}-{sent._jbroadcast.id()}"
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    run = pa.struct([("first", pa.int64()), ("last", pa.int64())])

    def scan(batches):
        machine = _automaton(key, sent, window)
        for batch in batches:
            counts, hits, items_, spans, found_runs = [], [], [], [], []
            for value in batch.column("text"):
                text = value.as_py() or b""
                n, runs, found, folded = machine.scan(text)
                counts.append(n)
                hits.append(sum(b - a + 1 for a, b in runs))
                items_.append(sorted(found))
                spans.append(offsets(text, folded, runs) if runs else [])
                found_runs.append([{"first": a, "last": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array(items_, pa.list_(pa.string())), pa.array(spans, pa.list_(kind)), pa.array(found_runs, pa.list_(run))],
                names=SCHEMA.fieldNames(),
            )

    return docs.mapInArrow(scan, SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_words: int = AUTOMATON_WORDS) -> DataFrame:
    """One row per document: doc_id, digest (of id and text), n_words, n_hit, items (sorted as strings), spans, contaminated.

    The benchmark is measured first. Up to ``automaton_words`` words it is one automaton and
    the documents are scanned once without a shuffle; beyond, items are dealt by a hash over as many automata as the bound asks for and the hits of a document's scans
    are joined. No more than one automaton's items are ever at the driver.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("digest"), F.col("text").cast("binary").alias("text"))
    items = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // (2 * automaton_words)))  # a word and its separator are 2 bytes at least
    if parts > 1:
        n = items.agg(F.sum(F.regexp_count(F.col("text").cast("string"), F.lit(WORD))).alias("n")).first()["n"]
        parts = max(1, -(-n // automaton_words))
    if parts == 1:
        scanned = _scan_part(texts, _collected(items), window).drop("hit_words")
    else:
        dealt = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
        scans = [_scan_part(texts, _collected(dealt.where(F.col("part") == p).select("item", "text")), window) for p in range(parts)]
        scanned = _joined(scans, parts)
    return scanned.withColumn("contaminated", F.col("n_hit") > 0)


def _collected(items: DataFrame) -> list[tuple[str, bytes]]:
    return [(r["item"], bytes(r["text"])) for r in items.collect()]


def _joined(scans: list[DataFrame], parts: int) -> DataFrame:
    """Scans of the same documents by several automata: hit runs are united by word number.

    Rows are told apart by id and a digest of the text; rows that agree in both have equal
    results and come out as often as they came in.
    """
    merged = reduce(DataFrame.unionByName, scans).groupBy("doc_id", "digest", "n_words").agg(
        F.count("*").alias("copies"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("hit_words"))).alias("hit_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    united = lambda col, a, b, touch: F.expr(
        f"aggregate({col}, cast(array() as array<struct<{a}:bigint,{b}:bigint>>), (acc, x) -> "
        f"case when size(acc) > 0 and x.{a} <= element_at(acc, -1).{b} + {touch} then "
        f"concat(slice(acc, 1, size(acc) - 1), array(named_struct('{a}', element_at(acc, -1).{a}, '{b}', greatest(element_at(acc, -1).{b}, x.{b})))) "
        f"else concat(acc, array(x)) end)"
    )
    merged = merged.withColumn("hit_words", united("hit_words", "first", "last", 1)).withColumn("spans", united("spans", "start", "end", 0))
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda acc, x: acc + x["last"] - x["first"] + 1)
    each = F.explode(F.sequence(F.lit(1), (F.col("copies") / parts).cast("int"))).alias("copy")
    return merged.select("doc_id", "digest", "n_words", n_hit.alias("n_hit"), "items", "spans", each).drop("copy")
