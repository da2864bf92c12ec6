"""Use all cores for heavy row-local work on a scan that has few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a plain scan if it has fewer splits than two per core.

    A table that is read in many splits is returned as it is, so large inputs
    never pay for a shuffle; one that fits in a handful of splits is small
    compared with the cluster, and its rows are dealt out before the work.
    Only for scans and projections of scans: asking for the splits of a plan
    with a shuffle would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= 2 * cores:
        return scan
    return scan.repartition(2 * cores)
