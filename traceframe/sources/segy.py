"""SEG-Y files: IBM and IEEE floats and 4, 2 and 1 byte integers, with extended text headers.

Reading: files are listed by Spark, folders are walked down, and any path Spark can resolve
will do; small files are packed into partitions by their size. A file above ``WHOLE_BYTES``, or all of
them if ``split_bytes`` is given, is read by byte ranges: the reader of a range takes the layout
from the file's header and yields the traces that begin inside it. A stream takes files as
they arrive, whole or by ranges, each once.

An index (``index_segy``) holds, per byte range, the least and largest value of every header.
A reader that is given one opens only the ranges that a filter's headers leave possible, and
decodes the samples of the traces that fit; ``headers_only`` skips samples altogether. Writing: each task
writes one file per file number it receives, under a name of its own; the commit gives the
files their names, so a repeated task leaves nothing behind.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from traceframe.functions.hashing import three_way_label
from traceframe.schemas import BRONZE, conform

# The published layout, as byte offsets and field positions.
TEXT_BYTES, BINARY_BYTES, TRACE_HEADER_BYTES = 3200, 400, 240
HEADER_BYTES = TEXT_BYTES + BINARY_BYTES
INTERVAL_AT, SAMPLES_AT, FORMAT_AT, EXTENDED_AT = 3216, 3220, 3224, 3504
IBM_FLOAT, IEEE_FLOAT = 1, 5
# Sample type of every format code that is read; IBM floats are taken as their bits.
SAMPLE_TYPES = {IBM_FLOAT: ">u4", 2: ">i4", 3: ">i2", IEEE_FLOAT: ">f4", 8: ">i1"}
FIELDS = {
    "field_record": 8,
    "trace_number": 12,
    "cdp_x": 180,
    "cdp_y": 184,
    "inline": 188,
    "crossline": 192,
}
SAMPLE_COUNT_AT, SAMPLE_INTERVAL_AT = 114, 116

SCHEMA = (
    "file_id string, trace_id bigint, trace_data array<double>, num_samples bigint, sample_rate double, "
    "inline bigint, crossline bigint, cdp_x bigint, cdp_y bigint, field_record bigint, trace_number bigint"
)
HEADER_SCHEMA = SCHEMA.replace("trace_data array<double>, ", "")
HEADER_ORDER = ["inline", "crossline", "cdp_x", "cdp_y", "field_record", "trace_number"]
BATCH_BYTES = 16 << 20
WHOLE_BYTES = 256 << 20  # a file up to this size is one row of a scan
LAST = [*"0123456789", "[!0-9]"]  # last character of a file's name: every name fits one


INDEX_SCHEMA = "path string, size bigint, start bigint, stop bigint, low array<bigint>, high array<bigint>"
INDEX_ARROW = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("size", "start", "stop")], *[(c, pa.list_(pa.int64())) for c in ("low", "high")]])
INDEXED = ["trace_id", *HEADER_ORDER]  # whole numbers known of every trace without its samples
FAR_APART = 64 << 10  # headers of longer traces are read one by one, where samples are skipped
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and place of a path, by its scheme."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path[5:]}"
    return pafs.FileSystem.from_uri(path if urlparse(path).scheme else f"file://{os.path.abspath(path)}")


def _prefix(path: str, root: str) -> str:
    """What a place on the file system of ``path`` needs to be opened again: scheme and, if not part of the place, authority."""
    uri = urlparse(path)
    if uri.scheme in ("", "file"):
        return ""
    inside = root == uri.netloc or root.startswith(f"{uri.netloc}/")  # a bucket
    return f"{uri.scheme}://" if inside or not uri.netloc else f"{uri.scheme}://{uri.netloc}"


def _listed(path: str) -> list[tuple[str, int]]:
    """(path, size) of one SEG-Y file or of all in a folder and below, but for attempts of writers."""
    fs, root = _open(path)
    info = fs.get_file_info(root)
    found = [info] if info.type == pafs.FileType.File else []
    if info.type == pafs.FileType.Directory:
        found = [f for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if f.path.endswith(".sgy") and "/_" not in f.path[len(root) :]]
    prefix = _prefix(path, root)
    return sorted((prefix + f.path, f.size) for f in found)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark would give it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


@dataclass
class Layout:
    """Where traces are in a file, from its header."""

    samples: int
    interval: int
    code: int
    begin: int  # first byte of the first trace

    @classmethod
    def of(cls, head: bytes, name: str) -> Layout:
        interval, samples, code = (struct.unpack_from(">H", head, at)[0] for at in (INTERVAL_AT, SAMPLES_AT, FORMAT_AT))
        extended = struct.unpack_from(">h", head, EXTENDED_AT)[0]
        if code not in SAMPLE_TYPES:
            raise ValueError(f"{name}: sample format {code} is not supported")
        if extended < 0:
            raise ValueError(f"{name}: an unknown number of extended headers is not supported")
        return cls(samples, interval, code, HEADER_BYTES + TEXT_BYTES * extended)

    @property
    def step(self) -> int:
        return TRACE_HEADER_BYTES + np.dtype(SAMPLE_TYPES[self.code]).itemsize * self.samples

    def values(self, rows: np.ndarray) -> np.ndarray:
        found = rows[:, TRACE_HEADER_BYTES:].copy().view(SAMPLE_TYPES[self.code])
        return ibm_float(found) if self.code == IBM_FLOAT else found.astype(np.float64)


def ibm_float(bits: np.ndarray) -> np.ndarray:
    """Sign bit, exponent of 16 with bias 64, and a 24-bit fraction."""
    word = bits.astype(np.int64)
    size = (word & 0xFFFFFF) / 2.0**24 * 16.0 ** (((word >> 24) & 0x7F) - 64)
    return np.where(word >> 31, -size, size)


def _stem_id(path: str) -> str:
    return path.rsplit("/", 1)[-1].rsplit(".", 1)[0].split("_")[-1]


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    stop: int


@dataclass
class Written(WriterCommitMessage):
    files: list


def _ranges(path: str, size: int, split_bytes: int) -> list[ByteRange]:
    return [ByteRange(path, at, min(at + split_bytes, size)) for at in range(HEADER_BYTES, size, split_bytes)]


_TESTS = {
    EqualTo: lambda x, v: x == v,
    EqualNullSafe: lambda x, v: x == v,
    GreaterThan: lambda x, v: x > v,
    GreaterThanOrEqual: lambda x, v: x >= v,
    LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: np.isin(x, list(v)),
}


@dataclass
class HeaderTest:
    """A filter on one whole-number header."""

    column: str
    test: Filter

    @classmethod
    def of(cls, test: Filter) -> HeaderTest | None:
        if type(test) not in _TESTS or len(test.attribute) != 1 or test.attribute[0] not in INDEXED:
            return None
        values = test.value if isinstance(test, In) else [test.value]
        return cls(test.attribute[0], test) if all(isinstance(v, int) for v in values) else None

    def holds(self, values: np.ndarray) -> np.ndarray:
        return _TESTS[type(self.test)](values, self.test.value)

    def possible(self, low: int, high: int) -> bool:
        """Whether a value from ``low`` to ``high`` can pass."""
        value = self.test.value
        if isinstance(self.test, (GreaterThan, GreaterThanOrEqual)):
            return bool(self.holds(np.int64(high)))
        if isinstance(self.test, (LessThan, LessThanOrEqual)):
            return bool(self.holds(np.int64(low)))
        return any(low <= v <= high for v in (value if isinstance(self.test, In) else [value]))


class SegyReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int, index: list | None = None, headers_only: bool = False):
        self.path, self.split_bytes, self.headers_only = path, split_bytes, headers_only
        self.index = index or []  # (path, size, start, stop, low, high)
        self.tests: list[HeaderTest] = []

    def pushFilters(self, filters):  # noqa: N802
        """Filters on headers are applied here, to ranges and then to traces; others are Spark's."""
        for f in filters:
            test = HeaderTest.of(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)

    def partitions(self) -> list[ByteRange]:
        """Ranges of the listed files; those of the index that no trace can pass are left out.

        Only sizes are looked at here. A file whose size is not the index's is cut anew.
        """
        files = _listed(self.path)
        if not files:
            raise ValueError(f"no SEG-Y files at {self.path}")
        known: dict[tuple[str, int], list] = {}
        for path, size, start, stop, low, high in self.index:
            known.setdefault((path, size), []).append((start, stop, low, high))
        out = []
        for path, size in files:
            if (path, size) not in known:
                out += _ranges(path, size, self.split_bytes)
            for start, stop, low, high in sorted(known.get((path, size), [])):
                if all(t.possible(low[INDEXED.index(t.column)], high[INDEXED.index(t.column)]) for t in self.tests):
                    out.append(ByteRange(path, start, stop))
        return out or [ByteRange(files[0][0], HEADER_BYTES, HEADER_BYTES)]  # a range without traces

    def read(self, part: ByteRange):
        yield from read_range(part, self.tests, self.headers_only)


def read_range(part: ByteRange, tests: list[HeaderTest] | None = None, headers_only: bool = False) -> Iterator[pa.RecordBatch]:
    """Traces that begin in [start, stop) and pass the tests; samples are decoded of those only."""
    fs, path = _open(part.path)
    with fs.open_input_file(path) as f:
        layout = Layout.of(f.read_at(HEADER_BYTES, 0), part.path)
        first = max(0, -(-(part.start - layout.begin) // layout.step))
        last = -(-(part.stop - layout.begin) // layout.step)
        step = TRACE_HEADER_BYTES if headers_only else layout.step
        per_batch = max(1, BATCH_BYTES // layout.step)
        for at in range(first, last, per_batch):
            n = min(per_batch, last - at)
            if headers_only and layout.step > FAR_APART:
                data = b"".join(f.read_at(step, layout.begin + i * layout.step) for i in range(at, at + n))
            else:
                data = f.read_at(n * layout.step, layout.begin + at * layout.step)
                if len(data) == n * layout.step and headers_only:
                    data = np.frombuffer(data, np.uint8).reshape(n, layout.step)[:, :step].tobytes()
            if len(data) != n * step:
                raise ValueError(f"{part.path}: truncated trace")
            yield _batch(data, n, layout, at, _stem_id(part.path), tests or [], headers_only)


def _batch(data: bytes, n: int, layout: Layout, first: int, name: str, tests: list[HeaderTest] | tuple = (), headers_only: bool = False) -> pa.RecordBatch:
    rows = np.frombuffer(data, dtype=np.uint8).reshape(n, -1)
    numbers = {"trace_id": np.arange(first, first + n, dtype=np.int64)}
    for c in HEADER_ORDER:
        numbers[c] = rows[:, FIELDS[c] : FIELDS[c] + 4].copy().view(">i4").astype(np.int64).ravel()
    fits = np.ones(n, bool)
    for t in tests:
        fits &= t.holds(numbers[t.column])
    if not fits.all():
        rows, n, numbers = rows[fits], int(fits.sum()), {c: v[fits] for c, v in numbers.items()}
    samples = layout.samples
    columns = {"file_id": pa.array([name] * n, pa.string()), "trace_id": pa.array(numbers["trace_id"])}
    if not headers_only:
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * samples)
        columns["trace_data"] = pa.ListArray.from_arrays(offsets, pa.array(layout.values(rows).ravel()))
    columns |= {"num_samples": pa.array(np.full(n, samples, dtype=np.int64)), "sample_rate": pa.array(np.full(n, layout.interval / 1e6)), **{c: pa.array(numbers[c]) for c in HEADER_ORDER}}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


class SegyWriter(DataSourceArrowWriter):
    """Rows of a task, already grouped by file number and in trace order, to files.

    A task writes into a folder of its own; ``commit`` moves the files of the tasks that
    count, after removing earlier SEG-Y files if the write is to overwrite.
    """

    def __init__(self, path: str, prefix: str, overwrite: bool):
        self.path, self.prefix, self.overwrite = path, prefix, overwrite

    def write(self, batches) -> Written:
        fs, root = _open(self.path)
        own = f"{root}/_attempt-{uuid.uuid4().hex}"
        done: list[str] = []
        current, out, samples = None, None, None
        try:
            for batch in batches:
                numbers = batch.column("file_no").to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero(np.diff(numbers)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(numbers)]) if len(numbers) else []:
                    rows = batch.slice(a, b - a)
                    if numbers[a] != current:
                        if out is not None:
                            out.close()
                        current, samples = int(numbers[a]), int(rows.column("num_samples")[0].as_py())
                        done.append(f"{own}/{self.prefix}_{current:03d}.sgy")
                        fs.create_dir(own, recursive=True)
                        out = fs.open_output_stream(done[-1])
                        out.write(_file_header(current, samples, rows.column("sample_rate")[0].as_py()))
                    out.write(_traces(rows, samples))
        finally:
            if out is not None:
                out.close()
        return Written(files=done)

    def commit(self, messages) -> None:
        fs, root = _open(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        names = [f.rsplit("/", 1)[-1] for f in files]
        if len(names) != len(set(names)):
            raise ValueError("a file number was split over tasks: write through write_segy()")
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for old in fs.get_file_info(pafs.FileSelector(root)):
                if old.path.endswith(".sgy"):
                    fs.delete_file(old.path)
        for f, name in zip(files, names):
            fs.move(f, f"{root}/{name}")
        self._clear(fs, root)

    def abort(self, messages) -> None:
        fs, root = _open(self.path)
        self._clear(fs, root)

    @staticmethod
    def _clear(fs: pafs.FileSystem, root: str) -> None:
        """Remove what attempts have left, also those that were repeated."""
        for left in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if left.path.rsplit("/", 1)[-1].startswith("_attempt-"):
                fs.delete_dir(left.path)


def _file_header(number: int, samples: int, rate: float) -> bytes:
    lines = [f"C 1 file {number}", f"C 2 samples {samples}", f"C 3 rate {rate}"]
    text = "".join(line.ljust(80) for line in lines).ljust(TEXT_BYTES)
    head = bytearray(text.encode("cp500") + bytes(BINARY_BYTES))
    struct.pack_into(">H", head, INTERVAL_AT, round(rate * 1e6))
    struct.pack_into(">H", head, SAMPLES_AT, samples)
    struct.pack_into(">H", head, FORMAT_AT, IEEE_FLOAT)
    return bytes(head)


def _traces(rows: pa.RecordBatch, samples: int) -> bytes:
    """Headers and samples of many traces as one array of bytes."""
    data = rows.column("trace_data")
    if pc.any(pc.not_equal(pc.list_value_length(data), samples)).as_py() or data.null_count:
        raise ValueError("all traces of a file must have the same length")
    n = rows.num_rows
    out = np.zeros((n, TRACE_HEADER_BYTES + 4 * samples), np.uint8)

    def put(at: int, values: np.ndarray, kind: str) -> None:
        width = np.dtype(kind).itemsize
        out[:, at : at + width] = values.astype(kind).view(np.uint8).reshape(n, width)

    position = rows.column("position").to_numpy(zero_copy_only=False)
    for column, at in FIELDS.items():
        missing = position + 1 if column == "trace_number" else 0
        own = rows.column(column)
        put(at, np.where(np.asarray(own.is_null()), missing, pc.fill_null(own, 0).to_numpy(zero_copy_only=False)), ">i4")
    put(SAMPLE_COUNT_AT, np.full(n, samples), ">u2")
    put(SAMPLE_INTERVAL_AT, np.round(rows.column("sample_rate").to_numpy(zero_copy_only=False) * 1e6), ">u2")
    values = data.flatten().to_numpy(zero_copy_only=False).reshape(n, samples)
    out[:, TRACE_HEADER_BYTES:] = values.astype(">f4").view(np.uint8).reshape(n, 4 * samples)
    return out.tobytes()


class SegySource(DataSource):
    """``spark.read.format("segy").load(path)``; options ``split_bytes``, ``headers_only`` and ``index`` (a folder of ``index_segy``)."""

    @classmethod
    def name(cls) -> str:
        return "segy"

    def _headers_only(self) -> bool:
        return self.options.get("headers_only", "false").lower() == "true"

    def schema(self) -> str:
        return HEADER_SCHEMA if self._headers_only() else SCHEMA

    def reader(self, schema: StructType) -> SegyReader:
        index = _load_index(self.options["index"]) if "index" in self.options else []
        return SegyReader(self.options["path"], int(self.options.get("split_bytes", 128 << 20)), index, self._headers_only())

    def writer(self, schema: StructType, overwrite: bool) -> SegyWriter:
        return SegyWriter(self.options["path"], self.options.get("prefix", "traces"), overwrite)


def _load_index(folder: str) -> list:
    """The rows of an index: one per byte range, a few hundred bytes each."""
    fs, root = _open(folder)
    rows = []
    for f in fs.get_file_info(pafs.FileSelector(root)):
        if f.path.endswith(".parquet"):
            rows += pq.read_table(f.path, filesystem=fs).to_pylist()
    return [(r["path"], r["size"], r["start"], r["stop"], r["low"], r["high"]) for r in rows]


def _spread_ranges(files: DataFrame, split_bytes: int) -> DataFrame:
    """(path, size, start, stop) of files (path, length), dealt out evenly."""
    starts = F.sequence(F.lit(HEADER_BYTES).cast("long"), F.greatest(F.col("length") - 1, F.lit(HEADER_BYTES)), F.lit(split_bytes).cast("long"))
    ranges = files.select("path", F.col("length").alias("size"), F.explode(starts).alias("start"))
    return ranges.withColumn("stop", F.least(F.col("start") + split_bytes, F.col("size")))


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop")), strict=True):
            yield from read_range(ByteRange(path, start, stop))


def index_segy(spark: SparkSession, path: str, folder: str, split_bytes: int = 8 << 20) -> DataFrame:
    """Write the index of all files at ``path`` into ``folder``: the ranges of each header, per byte range.

    One task per some ranges reads headers only; the result has one row per range.
    """
    files = spark.createDataFrame(_listed(qualified(spark, path)), "path string, length long")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                low, high = np.full(len(INDEXED), np.iinfo(np.int64).max), np.full(len(INDEXED), np.iinfo(np.int64).min)
                for found in read_range(ByteRange(row["path"], row["start"], row["stop"]), headers_only=True):
                    if found.num_rows:
                        values = np.stack([found.column(c).to_numpy() for c in INDEXED])
                        low, high = np.minimum(low, values.min(axis=1)), np.maximum(high, values.max(axis=1))
                out.append({**row, "low": low.tolist(), "high": high.tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=INDEX_ARROW)

    ranges = _spread_ranges(files, split_bytes)
    ranges.repartition(2 * spark.sparkContext.defaultParallelism).mapInArrow(measure, INDEX_SCHEMA).write.mode("overwrite").parquet(folder)
    return spark.read.schema(INDEX_SCHEMA).parquet(folder)


def register(spark: SparkSession) -> None:
    spark.conf.set(PUSHDOWN, "true")  # a reader that takes filters is refused without it
    spark.dataSource.register(SegySource)


def read_segy(spark: SparkSession, path: str, split_bytes: int | None = None, index: str | None = None, headers_only: bool = False) -> DataFrame:
    """Traces of one file or of all files in a folder and below, in one scan.

    Files up to ``WHOLE_BYTES`` are rows of a binary scan, which Spark packs into
    partitions; larger ones, or all with ``split_bytes``, are read by byte ranges. With ``index``,
    a folder that ``index_segy`` wrote, filters on headers decide which ranges are opened.
    ``headers_only`` gives all columns but the samples.
    """
    register(spark)
    place = qualified(spark, path)
    by_range = spark.read.format("segy").option("split_bytes", split_bytes or 128 << 20)
    if index:
        by_range = by_range.option("index", qualified(spark, index))
    if split_bytes or index or headers_only:
        return by_range.option("headers_only", str(headers_only).lower()).load(place)
    try:
        files = _binary(spark.read).load(place)
        sizes = files.agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("most")).first()  # names and sizes only
    except AnalysisException:
        raise ValueError(f"no SEG-Y files at {path}") from None
    if not sizes["n"]:
        raise ValueError(f"no SEG-Y files at {path}")
    if sizes["most"] > WHOLE_BYTES:
        return by_range.load(place)
    return files.select("path", "content").mapInArrow(_whole_files, SCHEMA)


def _binary(reader, names: str = "*.sgy"):
    return reader.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true")


def stream_segy(spark: SparkSession, path: str, split_bytes: int | None = None, files_per_batch: int | None = None, names: str = "*.sgy") -> DataFrame:
    """Traces of files as they arrive in a folder or below, of those that ``names`` fits.

    Spark's file source remembers which files it has taken, so a restart from its checkpoint
    neither loses nor repeats one; ``files_per_batch`` bounds a batch. Files come whole, on any file
    system Spark knows, or with ``split_bytes`` as byte ranges that are dealt over the tasks.
    """
    source = _binary(spark.readStream, names).schema("path string, modificationTime timestamp, length long, content binary")
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    files = source.load(qualified(spark, path))
    if not split_bytes:
        return files.select("path", "content").mapInArrow(_whole_files, SCHEMA)
    return _spread_ranges(files.select("path", "length"), split_bytes).repartition(2 * spark.sparkContext.defaultParallelism).mapInArrow(_read_ranges, SCHEMA)


def _whole_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            data = memoryview(content.as_buffer())
            layout = Layout.of(bytes(data[:HEADER_BYTES]), path)
            n, rest = divmod(len(data) - layout.begin, layout.step)
            if rest:
                raise ValueError(f"{path}: truncated trace")
            per_batch = max(1, BATCH_BYTES // layout.step)
            for at in range(0, n, per_batch):
                some = min(per_batch, n - at)
                start = layout.begin + at * layout.step
                yield _batch(data[start : start + some * layout.step], some, layout, at, _stem_id(path))


def read_bronze(spark: SparkSession, path: str, seed: str = "42") -> DataFrame:
    """Raw files to the bronze schema in one call; the class of a trace is drawn by its file and number."""
    return to_bronze(read_segy(spark, path), seed)


def to_bronze(traces: DataFrame, seed: str = "42") -> DataFrame:
    """Read traces, a table or a stream, in the bronze schema."""
    return conform(traces.withColumn("class_label", three_way_label(seed, "file_id", "trace_id")), BRONZE)


def stream_to_bronze(spark: SparkSession, path: str, out: str, files_per_batch: int | None = None, seed: str = "42") -> DataFrame:
    """Take all files that have arrived and were not taken before into the bronze table at ``out``; gives the whole table.

    A batch of few files costs the driver about as much as one of many and leaves most cores idle,
    so several streams run side by side, each for the names of one ``LAST`` character and with a
    checkpoint and a part of the table of its own. A name always meets the same checkpoint.
    """
    schema, running = None, []
    try:
        for i, last in enumerate(LAST):
            stream = to_bronze(stream_segy(spark, path, files_per_batch=files_per_batch, names=f"*{last}.sgy"), seed)
            schema = stream.schema
            writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint/{i}").trigger(availableNow=True)
            running.append(writer.start(f"{out}/bronze/{i}"))
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:  # the others, if one failed
            query.stop()
    return reduce(DataFrame.union, [spark.read.schema(schema).parquet(f"{out}/bronze/{i}") for i in range(len(LAST))])


WRITE_COLUMNS = ["file_no", "position", "trace_data", "num_samples", "sample_rate", *HEADER_ORDER]


def write_segy(df: DataFrame, path: str, position: str, prefix: str = "traces", mode: str = "overwrite") -> None:
    """Write rows with ``file_no`` as SEG-Y of IEEE floats, one file per number.

    ``overwrite`` removes the SEG-Y files that are there, ``append`` adds to them.

    Rows of one number meet in one task in ``position`` order; a file holds a
    fixed number of traces, so a task never gets an unbounded group.
    """
    register(df.sparkSession)
    rows = df.withColumn("position", F.col(position).cast("long")).select(*WRITE_COLUMNS)
    (
        rows.repartition("file_no")
        .sortWithinPartitions("file_no", "position")
        .write.format("segy")
        .option("prefix", prefix)
        .mode(mode)
        .save(qualified(df.sparkSession, path))
    )
