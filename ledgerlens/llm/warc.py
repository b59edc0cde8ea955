"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC
records (about ``frame_bytes`` of them), followed by a seek table in a skippable
frame (the public seekable format: sizes of every frame, their number, a magic
number).  A reader finds any frame from the last bytes of the file, and the
index names, for each record id, its bundle, frame and offset inside the frame.

``write_bundles``  one streaming pass per partition; a bundle is written under a
    name of its task attempt and closed before its index rows are handed out, so
    only bundles named by the index count and a lost executor's files are ignored.
``read_bundles``   frames from the seek tables, dealt out evenly, each read,
    decompressed and parsed on its own; digests of payloads are checked.
``read_record``    one record by its index entry: one seek, one frame.

Payload: the html as UTF-8 (null: empty).  Of the records with equal payloads
(SHA-256) of at least ``min_revisit`` bytes, those with the smallest page_id are
responses, the others revisits without payload; smaller payloads are all
responses.  Null page_ids are never the smallest; a group of nulls only is all
responses.  Repeated rows (of one page_id and payload, null ids too) give as many
records with ids of their own; a revisit names its response's record id where that
is one record, its page_id always.  Null urls have no target header;
an empty table gives no bundle and an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import save
from ledgerlens.session import scratch_dir

# fixed values of the seekable format and of WARC 1.1
SKIPPABLE_MAGIC, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
INDEX = ("page_id long, record_id string, bundle string, frame long, frame_offset long, frame_bytes long, "
         "record_offset long, record_bytes long")


def _fs(path: str):
    """(file system, path) of a folder in the shared store, local or remote."""
    from pyarrow import fs
    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def record_id(page_id, digest: str, place: str = "") -> str:
    """``place`` (bundle and number in it) tells the records of repeated rows apart."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}{place and ":" + place}')}>"


def make_record(page_id, url, payload: bytes, digest: str, first, date: str, name: str, sole: bool = True) -> bytes:
    """One WARC record called ``name``; ``first`` is the response's page_id for a revisit, else None, and
    ``sole`` says that this response is one record, so that its id is known."""
    http = HTTP.format(len(payload)).encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}",
            f"WARC-Record-ID: {name}", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"Refers-To-Page-ID: {first}"]
        if sole:
            head.append(f"WARC-Refers-To: {record_id(first, digest)}")
    block = http + payload if first is None else http
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records in a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at offset {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield at, head, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def parse_page(head: dict[str, str], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest, kind = head["WARC-Payload-Digest"].removeprefix("sha256:"), head["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    number = lambda k: int(head[k]) if k in head else None
    return {"page_id": number("Page-ID"), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": number("Refers-To-Page-ID"),
            "payload": payload if kind == "response" else None}


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", c, d) for c, d in sizes)
    foot = struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body) + len(foot)) + body + foot


def read_seek_table(f, size: int) -> list[tuple[int, int]]:
    """(offset, compressed bytes) of every frame, from the end of an open bundle."""
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n)
    out, at = [], 0
    for c, _ in struct.iter_unpack("<II", f.read(8 * n)):
        out.append((at, c))
        at += c
    return out


def with_revisits(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, first, sole, repeated): ``first`` is set for revisits, ``sole`` says
    whether that response is one row, ``repeated`` whether (page_id, digest) comes more than once.

    Payload groups are formed on digests alone; html moves once, keyed by
    (page_id, digest), so a payload shared by a third of the pages is spread out.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    p = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    keys = (pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.length(payload).alias("n"))
            .groupBy("page_id", "digest").agg(F.max("n").alias("n"), F.count("*").alias("rows")))
    firsts = (keys.where(F.col("n") >= min_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("c"),
                   F.min_by("rows", "page_id").alias("first_rows"))
              .where("c > 1 and first is not null").select("digest", "first", "first_rows"))
    marks = (keys.join(firsts, "digest", "left")
             .withColumn("first", F.expr("case when page_id is null or page_id <> first then first end"))
             .where("first is not null or rows > 1")
             .select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first",
                     (F.col("first_rows") == 1).alias("sole"), (F.col("rows") > 1).alias("repeated")))
    return p.join(marks, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left").drop("p", "d")


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = 1 << 20, level: int = 3,
                  min_revisit: int = 100, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``folder``; the saved index, one row per record."""
    root = folder.rstrip("/")

    def write(batches):
        import zstandard
        fs, base = _fs(root)
        task = TaskContext.get()
        name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}.warc.zst"
        out = squeeze = None
        sizes, frame, entries, at, n_records = [], bytearray(), [], 0, 0

        def flush():
            nonlocal at, frame, entries
            data = squeeze.compress(bytes(frame))
            out.write(data)
            rows = [(pid, rid, name, len(sizes), at, len(data), o, n) for pid, rid, o, n in entries]
            sizes.append((len(data), len(frame)))
            at += len(data)
            frame, entries = bytearray(), []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5])],
                names=["page_id", "record_id", "bundle", "frame", "frame_offset", "frame_bytes", "record_offset", "record_bytes"])

        done = []
        for b in batches:
            for row in range(b.num_rows):
                page_id, url, payload, digest, first, sole, repeated = (c[row].as_py() for c in b.columns)
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    squeeze = zstandard.ZstdCompressor(level=level)
                rid = record_id(page_id, digest, f"{name}:{n_records}" if repeated else "")
                rec = make_record(page_id, url, payload, digest, first, date, rid, bool(sole))
                entries.append((page_id, rid, len(frame), len(rec)))
                n_records += 1
                frame += rec
                if len(frame) >= frame_bytes:
                    done.append(flush())
        if out is not None:
            if frame:
                done.append(flush())
            out.write(seek_table(sizes))
            out.close()
        yield from done

    ready = with_revisits(pages, min_revisit).select("page_id", "url", "payload", "digest", "first", "sole", "repeated")
    return save(ready.mapInArrow(write, INDEX), "warc-index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, parsed: what ``parse_page`` gives."""
    root = folder.rstrip("/")

    def frames(batches):
        fs, base = _fs(root)
        for b in batches:
            for name in b.column(0).to_pylist():
                path = f"{base}/{name}"
                with fs.open_input_file(path) as f:
                    t = read_seek_table(f, fs.get_file_info(path).size)
                yield pa.RecordBatch.from_pydict({"bundle": [name] * len(t), "at": [o for o, _ in t],
                                                  "size": [c for _, c in t]})

    def parse(batches):
        import zstandard
        fs, base = _fs(root)
        squeeze = zstandard.ZstdDecompressor()
        for b in batches:
            for name, at, size in zip(*(c.to_pylist() for c in b.columns)):
                with fs.open_input_file(f"{base}/{name}") as f:
                    f.seek(at)
                    data = squeeze.decompress(f.read(size))
                rows = [parse_page(h, block) for _, h, block in parse_records(data)]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]))

    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (index.select("bundle").distinct().mapInArrow(frames, "bundle string, at long, size long")
            .repartition(n)
            .mapInArrow(parse, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                               "refers_to long, payload binary"))


def read_record(folder: str, entry) -> dict:
    """One record by its index row, reading only its frame."""
    import zstandard
    fs, base = _fs(folder.rstrip("/"))
    with fs.open_input_file(f"{base}/{entry['bundle']}") as f:
        f.seek(entry["frame_offset"])
        data = zstandard.ZstdDecompressor().decompress(f.read(entry["frame_bytes"]))
    part = data[entry["record_offset"]:entry["record_offset"] + entry["record_bytes"]]
    _, head, block = next(parse_records(part))
    return parse_page(head, block)


def new_folder(spark: SparkSession) -> str:
    return scratch_dir(spark, f"warc-{uuid.uuid4().hex}")
