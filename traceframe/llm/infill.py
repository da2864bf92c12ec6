"""Fill-in-the-middle texts by a pipeline of Arrow array functions.

A text is cut into lines that keep their line break. Two hashes of the row's id choose where the prefix
ends and where the middle ends; a third decides whether the text is transformed at all, a
fourth in which order its parts stand. All texts of a batch go through the same few array
calls: split into lists of units, flatten with the parent of each unit, number the units of a
parent, filter by role, rebuild a list per parent and role, join the pieces. Rows stay where
they are: no shuffle.

``restored`` is the way back, as a column expression: a transformed text holds each marker once,
since texts that hold a marker stay plain, and no marker can arise across the border of a
piece and a marker (it would have to start inside a piece with ``<`` and go on with the ``<`` of
the marker, or start inside a marker with ``>`` or a letter).

Defined cases: a null or empty text is plain, has no units and the empty text as output; a row without
an id hashes as if its id were the empty text; repeated rows are transformed alike; a text
without a line break is one unit; an empty table gives no rows; other columns stay, and those
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from traceframe.llm.common import fresh, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ANY_MARK = "<[PSM]>"
RESULTS = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output", "string")]


def draws(key: str, seed: int | str, n: int = 4) -> list[Column]:
    """The first ``n`` groups of eight hex digits of sha256("seed:key") as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def _joined(units: pa.Array, parents: np.ndarray, mask: np.ndarray, rows: int) -> pa.Array:
    """The units that ``mask`` takes, joined per parent."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(parents[mask], minlength=rows))])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pc.filter(units, pa.array(mask)))
    return pc.binary_join(lists, pa.scalar("", units.type))


def transform(text: pa.Array, h: list[np.ndarray], percent: int, spm_percent: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of every text; ``h`` are four arrays of hashes."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    rows = len(text)
    pieces = pc.split_pattern(text, "\n")
    flat, parents = pc.list_flatten(pieces), pc.list_parent_indices(pieces).to_numpy()
    per_row = pc.list_value_length(pieces).to_numpy()
    ordinal = np.arange(len(flat)) - (np.cumsum(per_row) - per_row)[parents]
    last = ordinal == per_row[parents] - 1
    # The piece after the last line break is a unit only if it holds something.
    n = per_row - np.bincount(parents[last & (pc.binary_length(flat).to_numpy() == 0)], minlength=rows)
    units = pc.binary_join_element_wise(flat, pc.if_else(pa.array(last), pa.scalar("", flat.type), pa.scalar("\n", flat.type)), pa.scalar("", flat.type))

    cuts = np.stack([h[0] % (n + 1), h[1] % (n + 1)])
    low, high = cuts.min(axis=0), cuts.max(axis=0)
    marked = pc.or_(pc.or_(pc.match_substring(text, PREFIX), pc.match_substring(text, SUFFIX)), pc.match_substring(text, MIDDLE))
    plain = (n == 0) | marked.to_numpy(zero_copy_only=False) | (h[2] % 100 >= percent)
    spm = h[3] % 100 < spm_percent

    moved = ~plain[parents]
    head, tail = ordinal < low[parents], ordinal >= high[parents]
    prefix, suffix, middle = (_joined(units, parents, moved & role, rows) for role in (head, tail, ~head & ~tail))
    mark = {m: pa.scalar(m, text.type) for m in (PREFIX, SUFFIX, MIDDLE, "")}
    psm = pc.binary_join_element_wise(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle, mark[""])
    other = pc.binary_join_element_wise(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle, mark[""])
    output = pc.if_else(pa.array(plain), text, pc.if_else(pa.array(spm), other, psm))
    form = pc.if_else(pa.array(plain), "plain", pc.if_else(pa.array(spm), "spm", "psm"))
    count = lambda part: pc.if_else(pa.array(plain), pa.scalar(None, pa.int64()), pc.utf8_length(part).cast(pa.int64()))
    return [pa.array(n, pa.int64()), form, count(prefix), count(middle), output.cast(pa.string())]


def fill_in_middle(docs: DataFrame, seed: int | str = 7, key: str = "doc_id", percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """``docs`` with n (units), form (plain, psm or spm), prefix_chars, middle_chars and output.

    ``percent`` of the texts are transformed, ``spm_percent`` of those in the order suffix, prefix, middle.
    """
    kept = docs.drop(*[name for name, _ in RESULTS])
    names = [fresh(f"__h{i}", kept) for i in range(4)]
    ready = kept.select("*", *[h.alias(name) for h, name in zip(draws(key, seed), names, strict=True)])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(name, T._parse_datatype_string(kind)) for name, kind in RESULTS]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index("text")
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
            for a, b in slices(sizes):
                part = batch.slice(a, b - a)
                h = [part.column(name).to_numpy() for name in names]
                found = transform(part.column(at), h, percent, spm_percent)
                own = part.drop_columns(names)
                yield pa.RecordBatch.from_arrays([*own.columns, *found], names=[*own.schema.names, *[name for name, _ in RESULTS]])

    return ready.mapInArrow(cut, schema)


def restored(output: Column, form: Column) -> Column:
    """The text from which ``output`` was made."""
    parts = F.split(output, ANY_MARK, -1)
    piece = lambda i: F.get(parts, F.lit(i))
    # Piece 0 is what stands before the first marker: nothing.
    return F.when(form == "psm", F.concat(piece(1), piece(3), piece(2))).when(form == "spm", F.concat(piece(2), piece(3), piece(1))).otherwise(output)
