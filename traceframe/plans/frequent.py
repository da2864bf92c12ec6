"""The most frequent terms of a corpus, from local lists, a bound and an exact recount.

Every task counts the terms of its rows into local lists of bounded size, which are stored once. A
sum over the leading terms of all lists gives a least count that the k-th term surely has; a term
that stays below that count divided by the number of lists in every list cannot reach it. Only
terms above that threshold somewhere are candidates, and only their counts are added up over all
lists. What is shuffled grows with lists times k, not with the number of rare terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from traceframe.session import cut_lineage

LIST_ROWS = 1_000_000  # rows counted into one local list, a bound on the memory of a task
LIST_BYTES = 32 << 20  # bytes of their terms, for terms of any length
FOLD_ROWS = 250_000  # rows taken from a batch at a time; a longer document waits for its end
SENT_TERMS = 1_000_000  # candidates that may be sent to all executors; beyond it they meet by a shuffle

_SCHEMA = pa.schema([("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64()), ("top", pa.bool_())])


def _flat(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Rows (doc, term) of a batch, ``FOLD_ROWS`` or one longer row at a time; a row may hold an array of terms."""
    terms = batch.column("term")
    if not pa.types.is_list(terms.type):
        yield pa.Table.from_batches([batch])
        return
    ends = np.cumsum(pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + FOLD_ROWS, side="right")))
        part = batch.slice(at, upto - at)
        own = part.column("term")
        yield pa.table({"doc": part.column("doc").take(pc.list_parent_indices(own)), "term": pc.list_flatten(own).cast(pa.string())})
        at = upto


def _counted(codes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, occurrences, documents) of codes whose documents stand in order."""
    order = np.argsort(codes, kind="stable")
    codes, docs = codes[order], docs[order]
    new = np.diff(codes, prepend=codes[:1] - 1) != 0
    heads = np.flatnonzero(new)
    first = new | (np.diff(docs, prepend=docs[:1]) != 0)  # a document's first occurrence of a code
    return codes[heads], np.diff(heads, append=len(codes)), np.add.reduceat(first, heads, dtype=np.int64) if len(heads) else heads


def _by_term(rows: pa.Table, pairs: bool = False) -> pa.Table:
    """Counts (term, tf, df) of whole documents given as rows (doc, term), those of a document side by side."""
    coded = rows.column("term").combine_chunks().dictionary_encode()
    own, names, docs = coded.indices.to_numpy(), coded.dictionary, rows.column("doc").to_numpy()
    code, tf, df = _counted(own, docs)
    out = pa.table({"term": names.take(pa.array(code)), "tf": tf, "df": df})
    if not pairs:
        return out
    joined = docs[1:] == docs[:-1]
    both, tf, df = _counted((own[:-1].astype(np.int64) * len(names) + own[1:])[joined], docs[1:][joined])
    left, right = (names.take(pa.array(c)) for c in np.divmod(both, max(1, len(names))))
    return pa.concat_tables([out, pa.table({"term": pc.binary_join_element_wise(left, right, " "), "tf": tf, "df": df})])


def _finished(local: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    """One local list, its ``k`` leading terms marked, and a row without a term that stands for the list."""
    leading = pc.select_k_unstable(local, k, [("tf", "descending"), ("term", "ascending")])
    top = np.zeros(local.num_rows, bool)
    top[leading.to_numpy()] = True
    yield from local.append_column("top", pa.array(top)).cast(_SCHEMA).to_batches(max_chunksize=65_536)
    yield pa.RecordBatch.from_pydict({"term": [None], "tf": [0], "df": [0], "top": [False]}, schema=_SCHEMA)


def local_lists(occurrences: DataFrame, k: int, list_rows: int | None = None, pairs: bool = False) -> DataFrame:
    """Local counts (term, tf, df, top) of rows (doc, term), see ``most_frequent``."""
    list_rows = list_rows or LIST_ROWS
    list_rows, list_bytes = (max(1, list_rows // 2), LIST_BYTES // 4) if pairs else (list_rows, LIST_BYTES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n, size = [], 0, 0
        for rows in (r for batch in batches for r in _flat(batch) if r.num_rows):
            waiting.append(rows)
            n, size = n + rows.num_rows, size + rows.nbytes
            if (n < list_rows and size < list_bytes) or waiting[0].column("doc")[0] == rows.column("doc")[-1]:
                continue
            table = pa.concat_tables(waiting)
            # The last document may go on in the next batch.
            docs = table.column("doc").to_numpy()
            whole = int(np.searchsorted(docs, docs[-1]))
            waiting = [table.slice(whole)]
            n, size = waiting[0].num_rows, waiting[0].nbytes
            yield from _finished(_by_term(table.slice(0, whole), pairs), k)
            del table
        if waiting:
            yield from _finished(_by_term(pa.concat_tables(waiting), pairs), k)

    return occurrences.select("doc", "term").mapInArrow(count, "term string, tf long, df long, top boolean")


def candidates(lists: DataFrame, k: int) -> DataFrame:
    """Terms (term) that may be among the ``k`` most frequent of stored lists: all others surely are not."""
    n_lists = lists.filter(F.col("term").isNull()).count()
    leading = lists.filter("top").groupBy("term").agg(F.sum("tf").alias("n")).orderBy(F.col("n").desc()).limit(k)
    sure = leading.agg(F.min("n")).first()[0] or 0
    # A term with at most threshold - 1 in each list has less than ``sure`` in all.
    threshold = max(1, -(-sure // max(1, n_lists)))
    seen = lists.filter(F.col("term").isNotNull() & (F.col("tf") >= threshold)).groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("c"))
    return seen.filter(F.col("n") + (n_lists - F.col("c")) * (threshold - 1) >= sure).select("term")


def most_frequent(occurrences: DataFrame, k: int, list_rows: int | None = None, pairs: bool = False) -> DataFrame:
    """The ``k`` most frequent terms (term, corpus_tf, df) of rows (doc, term), ties by term.

    ``doc`` is a number that grows within a partition and is the same for all rows of a
    document, which lie next to each other; terms are not null. A row may also hold an array
    of terms. With ``pairs``, every two neighbours of a document, joined by a space, are a term too; its
    other terms have no space then. ``df`` counts documents.
    """
    lists = cut_lineage(local_lists(occurrences, max(1, k), list_rows, pairs), "term-lists")
    wanted = cut_lineage(candidates(lists, max(1, k)), "term-candidates")
    chosen = F.broadcast(wanted) if wanted.count() <= SENT_TERMS else wanted
    return (
        lists.join(chosen, "term")
        .groupBy("term")
        .agg(F.sum("tf").alias("corpus_tf"), F.sum("df").alias("df"))
        .orderBy(F.col("corpus_tf").desc(), "term")
        .limit(k)
    )
