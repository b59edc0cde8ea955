"""Shards whose column types differ, read as one table by a widening rule.

Only footers are read to learn the types, several files at a time.  A column's type
is the narrowest that holds all its shards' types: integers the widest integer,
an integer and a float (or two floats) double unless all are float, equal types
themselves, anything else string.  Files of one schema are read together and cast
before the union, so values are read in the types they were written in.  A column
that a shard's footer lacks is absent there, which is not the same as NULL.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Dict, Iterable, List, Optional, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.io import PARQUET_SUFFIXES, list_shards

INTS = ("tinyint", "smallint", "int", "bigint")
FLOATS = ("float", "double")


def wider(types: Iterable[str]) -> str:
    """The type that holds all of ``types``."""
    seen = set(types)
    if len(seen) == 1:
        return next(iter(seen))
    if seen <= set(INTS):
        return max(seen, key=INTS.index)
    if seen <= {*INTS, *FLOATS}:
        return "double"
    return "string"


def shard_types(spark: SparkSession, folder: str, suffixes: Sequence[str] = PARQUET_SUFFIXES, workers: int = 16,
                limit_files: Optional[int] = None) -> Dict[str, Dict[str, str]]:
    """path -> column -> type, from the footers."""
    paths = list_shards(spark, folder, suffixes)[:limit_files]
    one = inheritable_thread_target(spark)(lambda p: dict(spark.read.parquet(p).dtypes))
    with ThreadPoolExecutor(workers) as pool:
        return dict(zip(paths, pool.map(one, paths)))


def widened_types(types: Dict[str, Dict[str, str]]) -> Dict[str, str]:
    """column -> type over all shards, columns in the order in which they first appear."""
    by: Dict[str, List[str]] = {}
    for cols in types.values():
        for c, t in cols.items():
            by.setdefault(c, []).append(t)
    return {c: wider(ts) for c, ts in by.items()}


def absent_columns(spark: SparkSession, types: Dict[str, Dict[str, str]], expected: Sequence[str]) -> DataFrame:
    """(path, column) for every expected column that a shard's footer lacks."""
    rows = [(p, c) for p, cols in types.items() for c in expected if c not in cols]
    return spark.createDataFrame(rows, "path string, column string")


def scan_widened(spark: SparkSession, folder: str, suffixes: Sequence[str] = PARQUET_SUFFIXES,
                 types: Optional[Dict[str, Dict[str, str]]] = None) -> DataFrame:
    """All shards under ``folder`` in the widened types, with ``source_file``; absent columns are NULL."""
    types = types or shard_types(spark, folder, suffixes)
    target = widened_types(types)
    groups: Dict[tuple, List[str]] = {}
    for path, cols in types.items():
        groups.setdefault(tuple(cols.items()), []).append(path)
    frames = []
    for cols, paths in groups.items():
        have = dict(cols)
        rows = spark.read.parquet(*paths)
        frames.append(rows.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in target.items()],
                                  F.col("_metadata.file_path").alias("source_file")))
    return reduce(DataFrame.unionByName, frames)
