"""Readers and writers.

Reads go through ``spark.read`` so column projection and filters reach the
parquet scan; shard discovery is the data source's file index, never a Python
loop over files.
"""

from __future__ import annotations

import json
from typing import Iterable, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARQUET_SUFFIXES = (".parquet", ".pq")
LABEL_SCHEMA = "id string, flag tinyint"


def resolve_columns(available: Sequence[str], needed: Sequence[str] = (),
                    prefixes: Sequence[str] = ()) -> list:
    """Requested columns that exist, plus every column of the prefix families, sorted."""
    have = set(available)
    out = {c for c in needed if c in have}
    out |= {c for c in available if any(c.startswith(p) for p in prefixes)}
    return sorted(out)


def scan_parquet(spark: SparkSession, path: str, columns: Optional[Sequence[str]] = None,
                 merge_schema: bool = False, prefixes: Sequence[str] = ()) -> DataFrame:
    """Parquet file or folder; ``columns`` (+ ``prefixes`` families) keeps only present
    columns, so the scan's read schema is pruned to them."""
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    if columns is not None or prefixes:
        keep = set(resolve_columns(df.columns, columns or (), prefixes))
        df = df.select(*[c for c in df.columns if c in keep])
    return df


def scan_sample_head(spark: SparkSession, path: str, n: int, order_by: Optional[Sequence[str]] = None,
                     columns: Optional[Sequence[str]] = None) -> DataFrame:
    """First ``n`` rows: ordered by ``order_by`` (a top-n, no full sort) or any ``n`` rows."""
    df = scan_parquet(spark, path, columns)
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def _glob_for(suffixes: Iterable[str]) -> str:
    sfx = [s.lstrip(".") for s in suffixes]
    return "*.{" + ",".join(sfx) + "}" if len(sfx) > 1 else f"*.{sfx[0]}"


def list_shards(spark: SparkSession, folder: str, suffixes: Sequence[str] = PARQUET_SUFFIXES) -> list:
    """Sorted shard paths under ``folder`` (file-system listing only, no data read)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(path, True)
    out = []
    while it.hasNext():
        p = it.next().getPath().toString()
        if p.lower().endswith(tuple(suffixes)):
            out.append(p)
    return sorted(out)


def scan_shards(spark: SparkSession, folder: str, suffixes: Sequence[str] = PARQUET_SUFFIXES,
                merge_schema: bool = True, with_path: bool = True,
                limit_files: Optional[int] = None) -> DataFrame:
    """All shards under ``folder`` with any of ``suffixes``, schemas merged by name.

    ``source_file`` is the file of each row (hidden ``_metadata`` column);
    ``limit_files`` reads only the first N shards in path order.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if limit_files is not None:
        paths = list_shards(spark, folder, suffixes)[:limit_files]
        df = reader.option("basePath", folder).parquet(*paths)
    else:
        df = (reader.option("pathGlobFilter", _glob_for(suffixes)).option("recursiveFileLookup", "false")
              .parquet(folder))
    if with_path:
        df = df.withColumn("source_file", F.col("_metadata.file_path"))
    return df


def scan_csv_labels(spark: SparkSession, path: str, schema: str = LABEL_SCHEMA,
                    rename: Optional[dict] = None) -> DataFrame:
    """Label CSV with header and forced types; ``flag`` renamed to ``target``."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    missing = {"id", "flag"} - set(df.columns)
    if missing:
        raise KeyError(f"label file lacks {sorted(missing)}")
    for a, b in (rename or {"flag": "target"}).items():
        df = df.withColumnRenamed(a, b)
    return df


def scan_by_suffix(spark: SparkSession, path: str, csv_schema: Optional[str] = None) -> DataFrame:
    """Dispatch on the extension: parquet / pq / csv; anything else is an error."""
    low = path.lower().rstrip("/")
    if low.endswith(PARQUET_SUFFIXES):
        return spark.read.parquet(path)
    if low.endswith(".csv"):
        r = spark.read.option("header", True)
        return (r.schema(csv_schema) if csv_schema else r.option("inferSchema", True)).csv(path)
    raise ValueError(f"unsupported input type: {path}")


def shard_inventory(spark: SparkSession, folder: str, suffixes: Sequence[str] = PARQUET_SUFFIXES) -> DataFrame:
    """File count, total bytes and largest file; the file contents are never read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", _glob_for(suffixes))
             .option("recursiveFileLookup", "true").load(folder).select("path", "length"))
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"),
                     F.max("length").alias("max_bytes"), F.max_by("path", "length").alias("largest_file"))


def shard_profile(df: DataFrame, expected: Sequence[str], shard_col: str = "shard") -> DataFrame:
    """Per shard: rows and the NULL rate of every expected column.

    A column a shard lacks reads as NULL under merged schemas, so it shows as
    100 % missing.  Output rows: (shard, n_rows, column, null_rate).
    """
    cols = [c for c in expected]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        x = F.col(c) if c in df.columns else F.lit(None)
        aggs.append(F.avg(x.isNull().cast("double")).alias(f"nr__{c}"))
    g = df.groupBy(shard_col).agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"nr__{c}").alias("null_rate")) for c in cols])
    return g.select(shard_col, "n_rows", F.explode(arr).alias("x")).select(shard_col, "n_rows", "x.*")


def sink_parquet(df: DataFrame, path: str, mode: str = "overwrite", max_records: int = 1_000_000,
                 partition_by: Optional[Sequence[str]] = None) -> str:
    w = (df.write.mode(mode).option("compression", "snappy").option("maxRecordsPerFile", max_records))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite", limit: Optional[int] = None) -> str:
    """CSV with header; ``limit`` writes a preview of that many rows."""
    out = df.limit(limit) if limit else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def sink_json_report(spark: SparkSession, report, path: str) -> str:
    """A metrics DataFrame, or a small dict of scalars, written as JSON lines."""
    if isinstance(report, DataFrame):
        report.write.mode("overwrite").json(path)
    else:
        payload = json.dumps(report, default=str, sort_keys=True)
        spark.createDataFrame([(payload,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path

