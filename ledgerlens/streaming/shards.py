"""A callback per shard file: each call sees one whole file.

Files are packed into tasks by Spark's own file planning, told not to cut a file: a
task reads its files one after the other, and rows are handed on when the file
changes.  A file beyond ``max_bytes`` is refused by name before anything runs, which
bounds what one call holds.
"""

from __future__ import annotations

from typing import Callable, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.profile_store import listing
from ledgerlens.sources.io import PARQUET_SUFFIXES

_FILE = "_shard_file"


class ShardTooLarge(ValueError):
    """A shard file is larger than one call may hold."""


def map_shards(spark: SparkSession, folder: str, fn: Callable, schema, columns: Optional[Sequence[str]] = None,
               max_bytes: int = 1 << 30, limit_files: Optional[int] = None,
               suffixes: Sequence[str] = PARQUET_SUFFIXES) -> DataFrame:
    """``fn(frame)`` of every shard's rows as one pandas frame, rows in file order; the frames it returns.

    columns: those read (absent ones come as NULL); limit_files: the first N files in path order.
    """
    files = listing(spark, folder, suffixes).orderBy("path").collect()[:limit_files]
    large = [f"{f.path} ({f.length} bytes)" for f in files if f.length > max_bytes]
    if large:
        raise ShardTooLarge(f"more than max_bytes={max_bytes}: {', '.join(large)}")
    if not files:
        return spark.createDataFrame([], schema)
    # a session of its own, so that other scans are still cut; a split holds the largest file at least
    whole = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        whole.conf.set(key, spark.conf.get(key))
    largest = str(max(f.length for f in files) + 1)
    whole.conf.set("spark.sql.files.maxPartitionBytes", str(max(int(largest), 128 << 20)))
    whole.conf.set("spark.sql.files.openCostInBytes", largest)
    whole.conf.set("spark.sql.files.minPartitionNum", "1")
    df = whole.read.option("basePath", folder).option("mergeSchema", "true").parquet(*[f.path for f in files])
    if columns is not None:
        types = dict(df.dtypes)
        df = df.select(*[F.col(c) if c in types else F.lit(None).cast("string").alias(c) for c in columns])
    df = df.select("*", F.col("_metadata.file_path").alias(_FILE))

    def run(frames):
        import pandas as pd
        name, held = None, []
        for pdf in frames:
            for file, rows in pdf.groupby(_FILE, sort=False):          # one or two files in a batch
                if file != name and held:
                    yield fn(pd.concat(held, ignore_index=True).drop(columns=_FILE))
                    held = []
                name = file
                held.append(rows)
        if held:
            yield fn(pd.concat(held, ignore_index=True).drop(columns=_FILE))

    return df.mapInPandas(run, schema)
