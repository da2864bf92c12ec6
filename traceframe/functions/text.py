"""Text expressions: tokens, terms, chunks, file names, record rendering."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

# Default English stop words. Any other list can be passed to
# `terms`; it should hold lower-case words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are was "
    "were be been being have has had having do does did doing a an the and but "
    "if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both "
    "each few more most other some such no nor not only own same so than too "
    "very can will just should now"
).split()

# Letters, digits and underscore of any script, two or more.
WORD = r"[\p{L}\p{N}_]{2,}"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def kept_words(text: Column, stop_words: list[str] | None = None) -> Column:
    """Words without stop words."""
    stop = STOP_WORDS if stop_words is None else stop_words
    # A long list of literals becomes a hash set.
    return F.filter(words(text), lambda w: ~w.isin(*stop)) if stop else words(text)


def terms(text: Column, stop_words: list[str] | None = None) -> Column:
    """Words without stop words, then every pair of words that are now neighbours."""
    # Each kept list is turned into pairs by zipping it with its own tail.
    return F.transform(F.array(kept_words(text, stop_words)), _with_pairs)[0]


def _with_pairs(kept: Column) -> Column:
    pairs = F.zip_with(kept, F.slice(kept, 2, F.greatest(F.size(kept), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(kept, F.filter(pairs, lambda p: p.isNotNull()))


# Chunk length, overlap and the separators in order of preference.
CHUNK_SIZE, CHUNK_OVERLAP = 500, 50
SLICE_BYTES, SLICE_ROWS = 2 << 20, 500  # texts that a task cuts at one time, or one longer text
SEPARATORS = (". ", ".\n", "\n\n", "\n")


def chunk_spans(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Iterator[tuple[int, int]]:
    """Where the chunks of a text begin and end.

    A chunk that does not reach the end of the text ends after a separator if one of the
    preferred kind begins in its second half; the places of all separators are found once
    and each end is picked from them by bisection. The next chunk begins ``overlap`` earlier.
    """
    places = {s: [m.start() for m in re.finditer(f"(?={re.escape(s)})", text)] for s in SEPARATORS}

    def preferred(begin: int) -> int:
        for sign, found in places.items():
            last = bisect_right(found, begin + size - len(sign))
            if last and found[last - 1] > begin + size // 2:
                return found[last - 1] + len(sign)
        return begin + size

    begin = 0
    while begin < len(text):
        end = preferred(begin) if begin + size < len(text) else begin + size
        yield begin, end
        begin = end - overlap


def chunk_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Chunks without outer white space; a text that fits in one chunk stays as it is."""
    if len(text) <= size:
        return [text]
    stripped = (text[a:b].strip() for a, b in chunk_spans(text, size, overlap))
    return [piece for piece in stripped if piece]


def chunker(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, drop_contained_tail: bool = False):
    """Arrow function text -> array of chunks."""
    if not 0 <= overlap < size // 2:
        raise ValueError("overlap must be smaller than half the chunk size")

    def pieces(text: str | None) -> list[str] | None:
        own = None if text is None else chunk_text(text, size, overlap)
        return own[:-1] if drop_contained_tail and own and len(own) > 1 and own[-2].endswith(own[-1]) else own

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            at = held = 0
            sizes = pc.fill_null(pc.binary_length(batch), 0).to_pylist()
            # Texts and their chunks are Python strings for a slice of the batch at a time.
            for i, n in enumerate([*sizes, SLICE_BYTES]):
                if i > at and (i == len(sizes) or i - at == SLICE_ROWS or held + n > SLICE_BYTES):
                    yield pa.array([pieces(t) for t in batch[at:i].to_pylist()], pa.list_(pa.string()))
                    at, held = i, 0
                held += n

    return split


def file_id(path: Column) -> Column:
    """The part of a file stem after its last underscore."""
    stem = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
    return F.element_at(F.split(stem, "_"), -1)


def known(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("Unknown"))


def record_lines(title: str | None, entries: list[tuple[str, Column]]) -> Column:
    """A record as text: an optional title line, then ``label: value`` lines."""
    lines = [F.lit(title)] if title else []
    lines += [F.concat(F.lit(f"{label}: "), known(value)) for label, value in entries]
    return F.concat_ws("\n", *lines)


def map_lines(title: str, entries: Column) -> Column:
    """A titled block with one ``  - key: value`` line per map entry, in key order."""
    rows = F.array_sort(F.map_entries(entries))
    lines = F.transform(rows, lambda e: F.concat(F.lit("  - "), e["key"], F.lit(": "), e["value"].cast("string")))
    return F.when(entries.isNotNull(), F.concat_ws("\n", F.lit("\n" + title), lines))
