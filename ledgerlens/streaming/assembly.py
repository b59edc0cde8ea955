"""Incremental dataset assembly: latest record -> features -> label, per micro-batch.

The assembled table is keyed by borrower and cut into ``buckets`` by a hash of the
id.  A micro-batch reads the buckets its borrowers fall into, folds its rows into
their latest records, makes base features and joins labels for them, and writes new
versions of these buckets under ``data/v=<batch>``.  Buckets in which no record
changed keep their old files; so do all the others.

A commit, ``commits/c=<batch>``, names the version of every bucket, with rows,
labelled rows and the value ranges of its integer columns, plus one row of
counters.  It is written after the data and counts only with its ``_SUCCESS``
marker, so readers see a batch wholly or not at all.  A batch run again after a
failure writes the same files again; one that is committed already changes nothing.
Value ranges are merged from the commit, so column types follow the whole table
without reading it.

Rows without ``rn`` are dropped, as in ``latest_record``; a record that arrives again
unchanged does not count as a change; labels are joined when a bucket is written; a
column that is new in a batch is NULL for older buckets.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, IntegerType, LongType, ShortType, StructType

from ledgerlens.config import FeatureConfig
from ledgerlens.operators.assemble import join_labels_left, latest_record
from ledgerlens.plans.datasets import ids_first
from ledgerlens.plans.features import features_base
from ledgerlens.session import delete, materialize
from ledgerlens.streaming.incremental import _fs

BUCKET, KNOWN = "_bucket", "_known"
_INTS = (ByteType, ShortType, IntegerType, LongType)
COMMIT_SCHEMA = ("bucket int, version long, rows long, matched long, lo map<string,bigint>, hi map<string,bigint>, "
                 "batch long, batches long, schema string, raw string")


@dataclass
class Commit:
    batch: int
    batches: int                                  # micro-batches that changed something
    schema: StructType                            # columns of the data files
    raw: list                                     # names of the shard columns among them
    buckets: dict = field(default_factory=dict)   # bucket -> {version, rows, matched, lo, hi}

    @property
    def written(self) -> int:
        return sum(b["rows"] for b in self.buckets.values())

    @property
    def matched(self) -> int:
        return sum(b["matched"] for b in self.buckets.values())


def _commit_path(out_dir: str, batch: int) -> str:
    return os.path.join(out_dir, "commits", f"c={batch:09d}")


def _data_path(out_dir: str, version: int, bucket: Optional[int] = None) -> str:
    path = os.path.join(out_dir, "data", f"v={version:09d}")
    return path if bucket is None else os.path.join(path, f"{BUCKET}={bucket}")


def commits(spark: SparkSession, out_dir: str) -> list[int]:
    """Batches committed to the end, oldest first (one listing)."""
    p, fs = _fs(spark, os.path.join(out_dir, "commits", "c=*", "_SUCCESS"))
    return sorted(int(x.getPath().getParent().getName()[2:]) for x in fs.globStatus(p) or [])


def read_commit(spark: SparkSession, out_dir: str, batch: int) -> Commit:
    """One row per bucket and one of counters: bounded by the number of buckets."""
    rows = spark.read.schema(COMMIT_SCHEMA).json(_commit_path(out_dir, batch)).collect()
    head = next(r for r in rows if r.bucket is None)
    return Commit(head.batch, head.batches, StructType.fromJson(json.loads(head.schema)), json.loads(head.raw),
                  {r.bucket: {k: r[k] for k in ("version", "rows", "matched", "lo", "hi")}
                   for r in rows if r.bucket is not None})


def _write_commit(spark: SparkSession, out_dir: str, c: Commit) -> None:
    rows = [(k, b["version"], b["rows"], b["matched"], b["lo"], b["hi"], None, None, None, None)
            for k, b in sorted(c.buckets.items())]
    rows.append((None, None, None, None, None, None, c.batch, c.batches, c.schema.json(), json.dumps(c.raw)))
    (spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1).write.mode("overwrite")
     .json(_commit_path(out_dir, c.batch)))


def _read_buckets(spark: SparkSession, out_dir: str, c: Commit, only: Optional[Sequence[int]] = None) -> Optional[DataFrame]:
    paths = [_data_path(out_dir, b["version"], k) for k, b in sorted(c.buckets.items()) if only is None or k in only]
    return spark.read.schema(c.schema).parquet(*paths) if paths else None


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _put(spark: SparkSession, out_dir: str, version: int, table: DataFrame) -> tuple[StructType, dict]:
    """Write ``table`` by bucket; (file schema, bucket -> statistics and ``fresh``, its rows not known before)."""
    path = _data_path(out_dir, version)
    table.repartition(F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    back = spark.read.schema(table.schema).parquet(path)
    schema = StructType([f for f in table.schema.fields if f.name not in (BUCKET, KNOWN)])
    whole = [f.name for f in schema.fields if isinstance(f.dataType, _INTS) and f.name != "id"]
    pairs = lambda fn: F.map_from_arrays(F.array(*[F.lit(c) for c in whole]),
                                         F.array(*[fn(c).cast("bigint") for c in whole]))
    stats = back.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.count("target").alias("matched"),
        F.sum(1 - F.col(KNOWN)).alias("fresh"),
        *([pairs(F.min).alias("lo"), pairs(F.max).alias("hi")] if whole else
          [F.lit(None).alias("lo"), F.lit(None).alias("hi")])).collect()
    return schema, {r[BUCKET]: {"version": version, "rows": r["rows"], "matched": r["matched"], "lo": r["lo"] or {},
                                "hi": r["hi"] or {}, "fresh": r["fresh"]} for r in stats}


def _sweep(spark: SparkSession, out_dir: str, keep: int) -> None:
    """Delete all but the newest ``keep`` commits and the bucket versions that these do not name."""
    done = commits(spark, out_dir)
    for old in done[:-keep]:
        delete(spark, _commit_path(out_dir, old))
    used = {(b["version"], k) for c in done[-keep:] for k, b in read_commit(spark, out_dir, c).buckets.items()}
    p, fs = _fs(spark, os.path.join(out_dir, "data", "v=*", f"{BUCKET}=*"))
    for x in fs.globStatus(p) or []:
        at = x.getPath()
        version, bucket = int(at.getParent().getName()[2:]), int(at.getName().split("=")[1])
        if (version, bucket) not in used and version <= done[-1]:
            fs.delete(at, True)
    versions = {v for v, _ in used}
    p, fs = _fs(spark, os.path.join(out_dir, "data", "v=*"))
    for x in fs.globStatus(p) or []:
        if int(x.getPath().getName()[2:]) not in versions and int(x.getPath().getName()[2:]) <= done[-1]:
            fs.delete(x.getPath(), True)


def _featured(rows: DataFrame, labels: DataFrame, cfg: FeatureConfig) -> DataFrame:
    out = join_labels_left(features_base(rows, cfg), labels)
    paym = [c for c in out.columns if c.startswith("enc_paym_")]
    return out.withColumns({c: F.col(c).cast("short") for c in paym}) if paym else out


def fold_batch(batch: DataFrame, batch_id: int, out_dir: str, labels: DataFrame, buckets: int = 64,
               tiebreak: Sequence[str] = (), cfg: FeatureConfig = FeatureConfig(), keep_commits: int = 2) -> Commit:
    """Fold one micro-batch into the assembled table and commit it (see the module's text)."""
    spark = batch.sparkSession
    done = commits(spark, out_dir)
    if batch_id in done:
        return read_commit(spark, out_dir, batch_id)
    before = [b for b in done if b < batch_id]
    prior = read_commit(spark, out_dir, before[-1]) if before else Commit(-1, 0, StructType(), [])
    new = materialize(latest_record(batch.filter(F.col("id").isNotNull()), tiebreak=tiebreak)
                      .withColumn(BUCKET, _bucket(buckets)))
    raw = [*prior.raw, *[c for c in batch.columns if c not in prior.raw]]
    touched = [r[0] for r in new.select(BUCKET).distinct().collect()]                 # at most ``buckets`` numbers
    rows = new.withColumn(KNOWN, F.lit(0))
    old = _read_buckets(spark, out_dir, prior, touched)
    if old is not None:
        # known last: of two equal records the known one stays, so nothing counts as changed
        types = dict(batch.dtypes)
        old = old.select(*[F.col(c).cast(types.get(c, dict(old.dtypes)[c])) for c in prior.raw])
        rows = (old.withColumns({BUCKET: _bucket(buckets), KNOWN: F.lit(1)})
                .unionByName(rows, allowMissingColumns=True))
    last = latest_record(rows.select(*[c for c in raw if c in rows.columns], BUCKET, KNOWN), tiebreak=tiebreak)
    commit = Commit(batch_id, prior.batches, prior.schema, raw, dict(prior.buckets))
    if touched:
        schema, made = _put(spark, out_dir, batch_id, _featured(last, labels, cfg))
        changed = {k: b for k, b in made.items() if b.pop("fresh")}
        for k in set(made) - set(changed):
            delete(spark, _data_path(out_dir, batch_id, k))
        commit.buckets.update(changed)
        commit.schema = schema
        commit.batches += bool(changed)
    _write_commit(spark, out_dir, commit)
    _sweep(spark, out_dir, max(2, keep_commits))
    return commit


def assemble_stream(spark: SparkSession, shard_dir: str, out_dir: str, checkpoint: str, schema, labels: DataFrame,
                    buckets: int = 64, tiebreak: Sequence[str] = (), cfg: FeatureConfig = FeatureConfig(),
                    files_per_trigger: int = 4, glob: str = "*.parquet", once: bool = True,
                    keep_commits: int = 2) -> Optional[Commit]:
    """Fold the shard files under ``shard_dir`` as they arrive; the newest commit, or None before the first."""
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", files_per_trigger).parquet(shard_dir))
    named = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    stream = stream.select(*named)               # without columns made from folder names

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, batch_id, out_dir, labels, buckets, tiebreak, cfg, keep_commits)

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    writer.start().awaitTermination()
    done = commits(spark, out_dir)
    return read_commit(spark, out_dir, done[-1]) if done else None


def read_assembled(spark: SparkSession, out_dir: str, commit: Optional[Commit] = None) -> DataFrame:
    """The assembled table at its newest commit (or the given one): borrowers with features and target.

    Integer columns are int where the committed ranges fit, else bigint; booleans tinyint.
    """
    c = commit or read_commit(spark, out_dir, commits(spark, out_dir)[-1])
    df = _read_buckets(spark, out_dir, c)
    if df is None:
        return spark.createDataFrame([], c.schema)
    out = {}
    for f in c.schema.fields:
        if f.name in ("id", "target") or f.name.startswith("enc_paym_"):
            continue
        if isinstance(f.dataType, BooleanType):
            out[f.name] = F.col(f.name).cast("tinyint")
        elif isinstance(f.dataType, _INTS):
            ends = [x for b in c.buckets.values() for x in ((b["lo"] or {}).get(f.name), (b["hi"] or {}).get(f.name))
                    if x is not None]
            fits = not ends or (min(ends) >= -2 ** 31 and max(ends) < 2 ** 31)
            out[f.name] = F.col(f.name).cast("int" if fits else "bigint")
    return ids_first(df.withColumns(out) if out else df)


def counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch, written, matched, batches) of every commit that is kept."""
    rows = [(c.batch, c.written, c.matched, c.batches)
            for c in (read_commit(spark, out_dir, b) for b in commits(spark, out_dir))]
    return spark.createDataFrame(rows, "batch long, written long, matched long, batches long")
