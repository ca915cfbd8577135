"""Export layout: the wide table clustered and sorted by uid."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# Aim for export files of about this size (compressed Parquet).
EXPORT_FILE_BYTES = 256 << 20


def partitions_for(size_bytes: int, target_bytes: int = EXPORT_FILE_BYTES) -> int:
    """Range partitions for an input of ``size_bytes`` on disk."""
    return max(1, math.ceil(size_bytes / target_bytes))


def cluster_by_uid(wide: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Range-partition on uid and sort inside each partition.

    The on-disk equivalent of a table ordered by uid: each output file
    holds one contiguous, sorted uid range, so readers filtering on uid skip
    files by their min/max statistics. uid is unique in the wide table, so
    the ranges are even (Spark samples the bounds).
    """
    n = num_partitions or int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wide.repartitionByRange(n, "uid").sortWithinPartitions("uid")
