"""Files, layers and streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from traceframe.schemas import BRONZE, conform
from traceframe.session import shared_folder
from traceframe.sources import roles, segy, tables
from traceframe.streaming import counters, monitors

SF = "/root/testdata/sf0.001"


def test_shared_folder_uses_the_configured_one(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(base)


def test_segy_bytes(spark, tmp_path):
    rows = roles.traces(spark, SF).withColumn("file_no", F.floor(F.col("trace_id") / 100).cast("long"))
    segy.write_segy(rows, str(tmp_path), "trace_id", prefix="survey_x")
    files = sorted(p.name for p in tmp_path.glob("*.sgy"))
    assert files == [f"survey_x_{i:03d}.sgy" for i in range(5)]
    data = (tmp_path / files[0]).read_bytes()
    assert len(data) == 3600 + 100 * (240 + 4 * 64)
    assert int.from_bytes(data[3216:3218], "big") == 4000
    assert int.from_bytes(data[3220:3222], "big") == 64
    assert int.from_bytes(data[3224:3226], "big") == 5
    one = segy.read_segy(spark, str(tmp_path / files[2])).orderBy("trace_id").first()
    want = roles.traces(spark, SF).filter("trace_id = 200").first()
    assert one.file_id == "002" and one.trace_data == want.trace_data and one.inline == want.inline


def _file(code: int, samples: bytes, count: int, extended: int = 0) -> bytes:
    head = bytearray(3600)
    head[3216:3218], head[3220:3222], head[3224:3226] = (2000).to_bytes(2, "big"), count.to_bytes(2, "big"), code.to_bytes(2, "big")
    head[3504:3506] = extended.to_bytes(2, "big")
    return bytes(head) + bytes(3200 * extended) + bytes(240) + samples


@pytest.mark.parametrize(
    ("code", "samples", "want"),
    [
        # IBM floats: 118.625 negated is the textbook example, 0x41100000 is 1.
        (1, bytes.fromhex("c276a000" "41100000" "00000000" "40800000"), [-118.625, 1.0, 0.0, 0.5]),
        (2, b"".join(v.to_bytes(4, "big", signed=True) for v in (-70000, 2, 0, 1 << 30)), [-70000.0, 2.0, 0.0, float(1 << 30)]),
        (3, b"".join(v.to_bytes(2, "big", signed=True) for v in (-300, 2, 0, 32767)), [-300.0, 2.0, 0.0, 32767.0]),
        (5, bytes.fromhex("c0000000" "3f800000" "00000000" "3e800000"), [-2.0, 1.0, 0.0, 0.25]),
        (8, b"".join(v.to_bytes(1, "big", signed=True) for v in (-128, 2, 0, 127)), [-128.0, 2.0, 0.0, 127.0]),
    ],
)
@pytest.mark.parametrize("extended", [0, 2])
def test_segy_sample_formats(spark, tmp_path, code, samples, want, extended):
    (tmp_path / "a_7.sgy").write_bytes(_file(code, samples, 4, extended))
    for options in ({}, {"split_bytes": 100}):
        rows = segy.read_segy(spark, str(tmp_path), **options).collect()
        assert [(r.file_id, r.trace_id, r.num_samples, r.sample_rate, r.trace_data) for r in rows] == [("7", 0, 4, 0.002, want)]


def test_segy_rejects_what_it_cannot_read(spark, tmp_path):
    (tmp_path / "a_1.sgy").write_bytes(_file(4, bytes(16), 4))
    with pytest.raises(Exception, match="not supported"):
        segy.read_segy(spark, str(tmp_path)).count()
    (tmp_path / "a_1.sgy").write_bytes(_file(5, bytes(15), 4))
    with pytest.raises(Exception, match="truncated"):
        segy.read_segy(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="no SEG-Y files"):
        segy.read_segy(spark, str(tmp_path / "nothing")).count()


def test_segy_overwrites(spark, tmp_path):
    rows = roles.traces(spark, SF).withColumn("file_no", F.floor(F.col("trace_id") / 100).cast("long"))
    segy.write_segy(rows, str(tmp_path), "trace_id")
    segy.write_segy(rows.where("file_no = 1"), str(tmp_path), "trace_id")
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["traces_001.sgy"]
    segy.write_segy(rows.where("file_no = 2"), str(tmp_path), "trace_id", mode="append")
    assert segy.read_segy(spark, str(tmp_path)).count() == 200


def test_layer_schema_is_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="missing"):
        tables.write_layer(spark.range(3), str(tmp_path / "x"), BRONZE)
    with pytest.raises(FileNotFoundError):
        tables.read_layer(spark, str(tmp_path), "absent")
    df = roles.traces(spark, SF)
    assert conform(df.drop("class_label"), BRONZE, ("class_label",)).columns == df.columns[:-1]
    with pytest.raises(ValueError, match="unexpected"):
        conform(df.withColumn("more", F.lit(1)), BRONZE)


def test_batch_suffixes(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_batch(spark, str(tmp_path / "x.txt"))
    with pytest.raises(ValueError):
        tables.read_batch(spark, str(tmp_path / "x.csv"))


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.txt").write_text("three")
    got = {r.source: r.content for r in tables.read_texts(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "one\ntwo", "b.txt": "three"}


def _arrivals(spark, folder, order=(0, 1, 2, 3)):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=7 * i), "a" if i % 3 else "b", i / 1000) for i in range(400)]
    schema = "event_id bigint, ts timestamp, predicted_class string, latency double"
    for place, n in enumerate(order):
        spark.createDataFrame(rows[n * 100 : n * 100 + 100], schema).coalesce(1).write.parquet(f"{folder}/{place}")
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 2, 0)])
@pytest.mark.parametrize("form", ["counts", "histogram"])
def test_backfill_equals_batch(spark, tmp_path, form, order):
    """Files in any order, days apart: without a watermark nothing is late."""
    whole = _arrivals(spark, str(tmp_path / "in"), order)
    stream = counters.stream_table(spark, str(tmp_path / "in" / "*"), whole.schema, files_per_batch=1)
    if form == "counts":
        updates, keys, want = counters.counted_stream(stream, None), ["window_start", "predicted_class"], counters.prediction_counts(whole)
    else:
        updates, keys, want = counters.histogram_stream(stream, None), ["window_start"], counters.latency_histogram(whole)
    counters.run_available(updates, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.select("batch").distinct().count() > 1
    got = counters.current_state(stored, keys).select(*want.columns)
    rounded = lambda df: sorted(
        tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()
    )
    assert rounded(got) == rounded(want)


def test_late_rows_are_dropped(spark, tmp_path):
    whole = _arrivals(spark, str(tmp_path / "in"))
    source = counters.stream_table(spark, str(tmp_path / "in" / "*"), whole.schema, files_per_batch=1)
    counters.run_available(counters.counted_stream(source, "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    late = spark.createDataFrame([(999, datetime(2024, 1, 1), "late", 0.5)], whole.schema)
    late.coalesce(1).write.parquet(str(tmp_path / "in" / "9"))
    source = counters.stream_table(spark, str(tmp_path / "in" / "*"), whole.schema, files_per_batch=1)
    run = counters.run_available(counters.counted_stream(source, "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp"))
    run.awaitTermination()
    assert counters.late_rows(run) == 1
    assert spark.read.parquet(str(tmp_path / "out")).filter("predicted_class = 'late'").count() == 0


def test_drift_monitor_reports_per_batch(spark, tmp_path):
    spark.range(200).select(F.col("id").cast("double").alias("x")).coalesce(1).write.parquet(str(tmp_path / "in/0"))
    spark.range(200).select((F.col("id") + 500).cast("double").alias("x")).coalesce(1).write.parquet(str(tmp_path / "in/1"))
    reference = spark.range(200).select(F.col("id").cast("double").alias("x"))
    stream = counters.stream_table(spark, str(tmp_path / "in" / "*"), "x double", files_per_batch=1)
    monitors.drift_monitor(stream, reference, ["x"], str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("features_drifted").collect()
    assert sorted(r[0] for r in got) == [0, 1]


def test_cumulative_drift_of_a_stream_stays_within_its_error(spark, tmp_path):
    from traceframe.operators.drift import feature_drift_of

    def values(seed, n, shift=0.0):
        gaps = F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 50 == 1, F.lit(float("nan")))
        x = gaps.otherwise(F.randn(seed) + shift)
        return spark.range(n).select(x.alias("x"), F.floor(F.rand(seed) * 4).cast("double").alias("few"), F.lit(None).cast("double").alias("none"))

    parts = [values(1, 3000), values(2, 6000, 0.02), values(3, 12000, 0.2)]
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    reference = values(9, 20000)
    stream = counters.stream_table(spark, str(tmp_path / "in" / "*"), "x double, few double, none double", files_per_batch=1)
    out, place, columns = str(tmp_path / "out"), str(tmp_path / "cp"), ["x", "few", "none"]
    for size in (64, monitors.SKETCH_SIZE):
        monitors.cumulative_drift_monitor(stream, reference, columns, f"{out}{size}", f"{place}{size}", size, method="series").awaitTermination()
        stored = spark.read.parquet(f"{out}{size}")
        assert stored.select("batch").distinct().count() == 3
        got = {r.feature: r for r in counters.current_state(stored, ["feature"]).collect()}
        # A column without values has no row, as in the exact form.
        assert sorted(got) == ["few", "x"]
        arrived = spark.read.parquet(str(tmp_path / "in" / "*"))
        for r in feature_drift_of(reference, arrived, columns, method="series").collect():
            mine = got[r.feature]
            assert (mine.n_reference, mine.n_current) == (r.n_reference, r.n_current)
            assert abs(mine.ks_statistic - r.ks_statistic) <= mine.ks_error
            assert not mine.certain or mine.drifted == r.drifted


def test_sketches_that_hold_all_values_lose_one_step(spark):
    from traceframe.operators.drift import feature_drift_of

    a = spark.range(300).select((F.col("id") % 40).cast("double").alias("x"))
    b = spark.range(200).select((F.col("id") % 50).cast("double").alias("x"))
    got = monitors.sketch_drift(monitors.sketches(a, ["x"]), monitors.sketches(b, ["x"])).first()
    exact = feature_drift_of(a, b, ["x"]).first()
    assert got.ks_error == pytest.approx(1 / monitors.GRID)
    assert got.ks_statistic == pytest.approx(exact.ks_statistic, abs=1 / monitors.GRID) and got.drifted == exact.drifted
    assert monitors.sketches(a.limit(0), ["x"]).count() == 0


def test_validated_ingest_keeps_every_row(spark, tmp_path):
    gappy = roles.gappy_traces(spark, SF)
    gappy.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = counters.stream_table(spark, str(tmp_path / "in"), gappy.schema, files_per_batch=1)
    monitors.validated_ingest(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == gappy.count()
    assert got.filter("outcome = 'valid'").filter(F.col("trace_data").isNull()).count() == 0


def _segy_folder(spark, tmp_path, n=400):
    from traceframe.operators import sampling

    rows = spark.range(n).select(
        F.col("id").alias("trace_id"), F.lit("x").alias("file_id"), F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: (i * F.col("id")).cast("double")).alias("trace_data"),
        F.lit(30).cast("long").alias("num_samples"), F.lit(0.004).alias("sample_rate"), (F.col("id") / 25).cast("long").alias("inline"), (F.col("id") % 25).alias("crossline"),
        F.col("id").alias("cdp_x"), F.col("id").alias("cdp_y"), F.col("id").alias("field_record"), F.col("id").alias("trace_number"),
    )
    folder = str(tmp_path / "raw")
    segy.write_segy(sampling.number_files(rows, "trace_id", 100), folder, "trace_id")
    return folder


def test_segy_index_prunes_ranges(spark, tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, StringStartsWith

    folder, index = _segy_folder(spark, tmp_path), str(tmp_path / "index")
    rows = segy.index_segy(spark, folder, index, split_bytes=6000)
    assert rows.count() > 20
    loaded = segy._load_index(index)
    whole = segy.SegyReader(folder, 6000, loaded)
    other = StringStartsWith(("file_id",), "0")
    assert list(whole.pushFilters([other])) == [other] and len(whole.partitions()) == len(loaded)
    for tests, low, high in (([EqualTo(("inline",), 7)], 7, 7), ([GreaterThan(("inline",), 12), LessThanOrEqual(("inline",), 13)], 13, 13), ([In(("inline",), (2, 3))], 2, 3)):
        reader = segy.SegyReader(folder, 6000, loaded)
        assert list(reader.pushFilters(tests)) == []
        parts = reader.partitions()
        assert len(parts) < len(loaded) / 2
        got = [i for p in parts for b in reader.read(p) for i in b.column("inline").to_pylist()]
        assert len(got) == 25 * (high - low + 1) and low <= min(got) and max(got) <= high
    nothing = segy.SegyReader(folder, 6000, loaded)
    assert list(nothing.pushFilters([EqualTo(("inline",), 99)])) == [] and [b for p in nothing.partitions() for b in nothing.read(p)] == []
    found = segy.read_segy(spark, folder, index=index).where("inline in (2, 3) and crossline > 20 and trace_id < 90")
    assert sorted(r.cdp_x for r in found.collect()) == [i for i in range(400) if i // 25 in (2, 3) and i % 25 > 20 and i % 100 < 90]
    assert sorted(r.trace_data[1] for r in found.collect()) == sorted(2.0 * r.cdp_x for r in found.collect())
    # A file that the index does not know as it is now is read whole.
    more = spark.range(100, 103).select(F.col("id").alias("trace_id"), F.array(F.lit(1.0)).alias("trace_data"), F.lit(1).cast("long").alias("num_samples"), F.lit(0.004).alias("sample_rate"), F.lit(2).cast("long").alias("inline"), *[F.lit(24).cast("long").alias(c) for c in ("crossline", "cdp_x", "cdp_y", "field_record", "trace_number")], F.lit(9).alias("file_no"))
    segy.write_segy(more, folder, "trace_id", mode="append")
    assert segy.read_segy(spark, folder, index=index).where("inline = 2 and crossline = 24").count() == 4


@pytest.mark.parametrize("long", [1 << 20, 1])
def test_segy_headers_and_nested_folders(spark, tmp_path, monkeypatch, long):
    monkeypatch.setattr(segy, "FAR_APART", long)
    folder = _segy_folder(spark, tmp_path)
    found = segy.read_segy(spark, str(tmp_path), headers_only=True)
    assert "trace_data" not in found.columns and found.agg(F.sum("cdp_x")).first()[0] == sum(range(400))
    assert segy.read_segy(spark, str(tmp_path)).count() == segy.read_segy(spark, str(tmp_path), split_bytes=5000).count() == 400
    assert segy._prefix("hdfs://host:9000/a/b", "/a/b") == "hdfs://host:9000" and segy._prefix("s3://bucket/a", "bucket/a") == "s3://" and segy._prefix(folder, folder) == ""


@pytest.mark.parametrize("split", [None, 5000])
def test_segy_stream_takes_each_file_once(spark, tmp_path, split):
    folder = _segy_folder(spark, tmp_path)
    out, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def run():
        stream = segy.to_bronze(segy.stream_segy(spark, folder, split, files_per_batch=3))
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.parquet(out)

    first = run()
    want = segy.read_bronze(spark, folder)
    assert first.count() == 400 and first.exceptAll(want.select(first.columns)).count() == 0
    assert run().count() == 400  # a restart repeats nothing
    rows = want.withColumn("file_no", F.lit(50)).where("file_id = '001'")
    segy.write_segy(rows, folder, "trace_id", prefix="late", mode="append")
    again = run()
    assert again.count() == 500 and again.where("file_id = '050'").count() == 100


def test_segy_streams_run_side_by_side(spark, tmp_path, monkeypatch):
    """One stream took all files two by two, so its batches followed each other by the hundred."""
    from traceframe.checks import files

    vectors = spark.range(4000).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float"), F.lit(0.5).cast("float")).alias("embedding"), F.col("id").cast("int").alias("label"))
    vectors.write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(files, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    found = files.segy_stream_to_bronze(spark, str(tmp_path))
    assert found.count() == 4000 and found.exceptAll(files.segy_to_bronze(spark, str(tmp_path))).count() == 0
    checkpoint = tmp_path / "segy-stream/checkpoint"
    assert max(len([n for n in f.iterdir() if n.name.isdigit()]) for f in checkpoint.rglob("commits")) == 2  # four names of each digit
    taken = [n.read_text().count("\"path\"") for f in checkpoint.rglob("sources") for n in (f / "0").iterdir() if n.name.isdigit()]
    assert sum(taken) == 40 and max(taken) == 2


def test_segy_streams_take_each_name_once(spark, tmp_path):
    folder, out = _segy_folder(spark, tmp_path), str(tmp_path / "out")
    other = segy.read_bronze(spark, folder).where("file_id = '001'").withColumn("file_no", F.lit(7))
    segy.write_segy(other, str(tmp_path / "more"), "trace_id")
    below = tmp_path / "below"
    for source, name in (("raw", "a"), ("more", "b")):
        (below / name).mkdir(parents=True)
        for f in sorted((tmp_path / source).glob("*.sgy")):
            (below / name / f.name.replace("_007", "_007x").replace("_002", "_é")).write_bytes(f.read_bytes())
    taken = segy.stream_to_bronze(spark, str(below), out, files_per_batch=3)
    want = segy.read_bronze(spark, str(below))
    assert taken.count() == want.count() == 500 and want.exceptAll(taken.select(want.columns)).count() == 0
    assert {"007x", "é"} <= {r.file_id for r in taken.select("file_id").distinct().collect()}
    assert segy.stream_to_bronze(spark, str(below), out).count() == 500  # a restart repeats nothing
    (below / "late_12.sgy").write_bytes((tmp_path / "more/traces_007.sgy").read_bytes())
    assert segy.stream_to_bronze(spark, str(below), out).where("file_id = '12'").count() == 100
    (below / "cut_3.sgy").write_bytes((tmp_path / "more/traces_007.sgy").read_bytes()[:-1])
    with pytest.raises(Exception, match="truncated"):
        segy.stream_to_bronze(spark, str(below), out)
    assert not spark.streams.active
