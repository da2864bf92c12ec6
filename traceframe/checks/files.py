from pyspark.sql import functions as F

from traceframe.checks.registry import query
from traceframe.operators import sampling
from traceframe.session import shared_folder
from traceframe.sources import roles, segy

_SEGY_SQL = f"""WITH {roles.TRACES_SQL}
SELECT format('{{:03d}}', trace_id // 100) AS file_id, trace_id % 100 AS trace_id, num_samples, sample_rate, inline, crossline, cdp_x, cdp_y,
  field_record, trace_number, round(list_sum(trace_data), 5) AS sample_sum FROM traces"""


def _written(spark, sf) -> str:
    folder = shared_folder(spark, "segy")
    numbered = sampling.number_files(roles.traces(spark, sf), "trace_id", 100)
    segy.write_segy(numbered, folder, "trace_id")
    return folder


def _read(spark, folder, **options):
    total = F.aggregate("trace_data", F.lit(0.0), lambda a, x: a + x)
    return segy.read_segy(spark, folder, **options).withColumn("sample_sum", F.round(total, 5)).drop("trace_data")


@query("segy_round_trip", _SEGY_SQL)
def segy_round_trip(spark, sf):
    """All traces to files of 100, then all files in one scan."""
    return _read(spark, _written(spark, sf))


@query("segy_split_read", _SEGY_SQL)
def segy_split_read(spark, sf):
    """The same files read in byte ranges that cut through traces."""
    return _read(spark, _written(spark, sf), split_bytes=10_000)


@query("segy_filtered_read", _SEGY_SQL + " WHERE inline BETWEEN 3 AND 9 AND crossline < 20 AND trace_id % 100 >= 5")
def segy_filtered_read(spark, sf):
    """Through an index of headers: only byte ranges in which the filter can hold are opened."""
    folder = _written(spark, sf)
    index = shared_folder(spark, "segy-index")
    segy.index_segy(spark, folder, index, split_bytes=10_000)
    return _read(spark, folder, index=index).where("inline between 3 and 9 and crossline < 20 and trace_id >= 5")


@query(
    "segy_headers",
    f"""WITH {roles.TRACES_SQL}
SELECT format('{{:03d}}', trace_id // 100) AS file_id, trace_id % 100 AS trace_id, num_samples, sample_rate, inline, crossline, cdp_x, cdp_y,
  field_record, trace_number FROM traces""",
)
def segy_headers(spark, sf):
    """All headers, without samples."""
    return segy.read_segy(spark, _written(spark, sf), headers_only=True)


_BRONZE_SQL = f"""WITH {roles.TRACES_SQL}, u AS (SELECT *, format('{{:03d}}', trace_id // 100) AS f, trace_id % 100 AS t FROM traces),
c AS (SELECT *, ('0x' || substr(md5('42:' || f || ':' || t), 1, 8))::UBIGINT::DOUBLE / 4294967296.0 AS r FROM u)
SELECT f AS file_id, t AS trace_id, num_samples, sample_rate, CAST(CASE WHEN r < 0.5 THEN 0 WHEN r < 0.8 THEN 1 ELSE 2 END AS BIGINT) AS class_label,
  round(list_sum(trace_data), 5) AS sample_sum FROM c"""


def _bronze(df):
    total = F.aggregate("trace_data", F.lit(0.0), lambda a, x: a + x)
    return df.select("file_id", "trace_id", "num_samples", "sample_rate", "class_label", F.round(total, 5).alias("sample_sum"))


@query("segy_to_bronze", _BRONZE_SQL)
def segy_to_bronze(spark, sf):
    """Raw files to rows of the bronze schema in one call."""
    return _bronze(segy.read_bronze(spark, _written(spark, sf)))


@query("segy_stream_to_bronze", _BRONZE_SQL)
def segy_stream_to_bronze(spark, sf):
    """The same as streams of files, two to a batch, into a bronze table."""
    folder, out = _written(spark, sf), shared_folder(spark, "segy-stream")
    return _bronze(segy.stream_to_bronze(spark, folder, out, files_per_batch=2))
