r"""Deterministic sharded WARC writer and its reader.

Records are range-sorted by key into shards cut at every ``RECORDS``-th record (exact row
numbers, so shards do not depend on the number of partitions); records of one key, or without
key, stay in one shard, which they can make larger; it is still written as a stream.  A shard is
written as a stream: one gzip member a record, rolled to a new file when the
compressed size reaches ``roll_bytes``; headers, record ids and digests are
made anew from the rows.  Files appear under temporary names and are renamed
when complete; the manifest, written last, names the files that count.  A
repeated or speculative task writes equal bytes under equal names.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more, the one with
the smallest key holds the payload and the others are revisits of it; which
payloads repeat is found on slim rows by digest.

Defined results: null payloads are empty; a null key sorts first, has no key
header and is never referred to; records with equal keys, or without, are written one by
one under ids of their own (a revisit refers to the key's first); an empty table gives an empty manifest;
extra columns are not written.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nestgate.llm.common import row_numbers, saved
from nestgate.session import scratch_path

RECORDS = 4096
ROLL_BYTES = 64 << 20
MIN_REVISIT = 100
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
# Names of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
KEY, TO_KEY = "X-Record-Key", "X-Refers-To-Key"
MANIFEST = "file string, shard long, part int, records long, bytes long, sha256 string"


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark gives it, so that the executors write where Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def store(uri: str):
    """File system and path of a qualified folder; any store that Arrow knows (``s3a`` is its ``s3``)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def record_id(key: str | None, copy: int = 0) -> str:
    """Id of the ``copy``-th record of a key (records without key are copies of none)."""
    if key is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'record without key {copy}')}>"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{key}' + f'#{copy}' * (copy > 0))}>"


def record(key: str | None, url: str | None, payload: bytes, refers_to: str | None, copy: int = 0) -> bytes:
    """One WARC record."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(key, copy)}", f"WARC-Date: {DATE}",
             "WARC-Target-URI: " + (quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:record:{key}"),
             "Content-Type: application/http;msgtype=response",
             f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
             f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if key is not None:
        lines.append(f"{KEY}: {key}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"{TO_KEY}: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _File:
    """One archive file under a temporary name."""

    def __init__(self, files, folder: str, shard: int, part: int):
        self.files, self.folder, self.shard, self.part = files, folder, shard, part
        self.name = f"shard-{shard:08d}-{part:05d}.warc.gz"
        self.temporary = f"{folder}/.{self.name}.{uuid.uuid4().hex}.tmp"
        self.out = files.open_output_stream(self.temporary, compression=None)
        self.records = self.bytes = 0
        self.digest = hashlib.sha256()

    def add(self, raw: bytes) -> None:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(raw) + packer.flush()
        self.out.write(member)
        self.digest.update(member)
        self.records += 1
        self.bytes += len(member)

    def close(self) -> dict:
        from pyarrow import fs

        self.out.close()
        final = f"{self.folder}/{self.name}"
        if self.files.get_file_info(final).type != fs.FileType.NotFound:
            self.files.delete_file(final)               # of an earlier attempt, with equal bytes
        self.files.move(self.temporary, final)
        return {"file": self.name, "shard": self.shard, "part": self.part, "records": self.records,
                "bytes": self.bytes, "sha256": self.digest.hexdigest()}


def write_archives(df: DataFrame, out: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   records: int = RECORDS, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the archives of ``df`` under ``out``; returns the manifest (also at ``out/manifest``)."""
    spark = df.sparkSession
    out = qualified(spark, out)
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    slim = df.select(F.col(key).alias("key"), F.sha2(body, 256).alias("digest"), F.length(body).alias("n"))
    numbered, total = row_numbers(slim, [F.col("key"), F.col("digest")], "row_no")
    # one key for each shard
    firsts = [r[0] for r in numbered.filter((F.col("row_no") % records == 0) & (F.col("row_no") > 0))
              .orderBy("row_no").select("key").collect()]
    cuts = np.array([k for k in firsts if k is not None])
    twice = (numbered.filter(F.col("n") >= MIN_REVISIT).groupBy("digest")
             .agg(F.min("key").alias("first"), F.count("*").alias("c")).filter("c > 1").select("digest", "first"))
    revisits = (numbered.filter(F.col("n") >= MIN_REVISIT).join(twice, "digest")
                .filter(~F.col("key").eqNullSafe(F.col("first")) & F.col("first").isNotNull())
                .select("key", "digest", "first"))

    @F.pandas_udf("long")
    def after(s: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, s.to_numpy(), side="right"))

    def shard_of(k: Column) -> Column:
        if not len(cuts):
            return F.lit(0).cast("long")
        return F.when(k.isNull(), F.lit(0)).otherwise(after(F.coalesce(k, F.lit(cuts[0].item()))))

    # what a record needs besides its row comes in the same shuffle, just before the row
    rows = df.select(F.col(key).alias("key"), F.sha2(body, 256).alias("digest"), F.lit(1).alias("kind"),
                     F.lit(None).cast("string").alias("first"), F.col(url).cast("string").alias("url"), body.alias("body"))
    notes = revisits.distinct().select("key", "digest", F.lit(0).alias("kind"), F.col("first").cast("string").alias("first"),
                                       F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("body"))
    order = ["shard", "key", "digest", "kind", "url"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.unionByName(notes).withColumn("shard", shard_of(F.col("key")))
             .repartition(n, "shard").sortWithinPartitions(*order)
             .select("shard", F.col("key").cast("string").alias("key"), "digest", "kind", "first", "url", "body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = store(out)
        files.create_dir(folder, recursive=True)
        done, now, note = [], None, None
        last, copy = "", 0                                   # records of one key follow each other in one shard
        for b in batches:
            for shard, k, digest, kind, first, u, raw in zip(*(b.column(i).to_pylist() for i in range(7))):
                if kind == 0:
                    note = (k, digest, first)
                    continue
                if now is not None and (now.shard != shard or now.bytes >= roll_bytes):
                    part = now.part + 1 if now.shard == shard else 0
                    done.append(now.close())
                    now = _File(files, folder, shard, part)
                elif now is None:
                    now = _File(files, folder, shard, 0)
                last, copy = (shard, k), copy + 1 if last == (shard, k) else 0
                now.add(record(k, u, raw, note[2] if note and note[:2] == (k, digest) else None, copy))
        if now is not None:
            done.append(now.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema(
                [("file", pa.string()), ("shard", pa.int64()), ("part", pa.int32()), ("records", pa.int64()),
                 ("bytes", pa.int64()), ("sha256", pa.string())]))

    manifest = saved(dealt.mapInArrow(run, MANIFEST))
    if (written := manifest.agg(F.sum("records")).first()[0] or 0) != total:
        raise RuntimeError(f"{written} of {total} records were written")
    manifest.coalesce(1).write.mode("overwrite").json(f"{out}/manifest")     # a row for each file; commits the archives
    return spark.read.schema(MANIFEST).json(f"{out}/manifest")


def members(stream, piece: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    rest = b""
    while rest or (rest := stream.read(piece)):
        unpacker, parts = zlib.decompressobj(31), []
        while True:
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
            if unpacker.eof:
                break
            if not (rest := stream.read(piece)):
                raise ValueError("an archive ends inside a record")
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """Fields of one record, with its digests verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    block = rest[:n]
    if lines[0] != "WARC/1.1" or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    if fields["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    return {"key": fields.get(KEY), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": fields.get(TO_KEY), "url": fields["WARC-Target-URI"],
            "payload": payload if fields["WARC-Type"] == "response" else None}


def read_archives(spark: SparkSession, out: str, with_payload: bool = False) -> DataFrame:
    """Records of the archives that the manifest under ``out`` names; damaged files raise."""
    out = qualified(spark, out)
    manifest = spark.read.schema(MANIFEST).json(f"{out}/manifest")
    names = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    kinds = "key string, payload_bytes long, payload_digest string, record_type string, refers_to string, url string"
    if with_payload:
        names, kinds = [*names, "payload"], kinds + ", payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = store(out)
        schema = pa.schema([(x, pa.int64() if x == "payload_bytes" else pa.binary() if x == "payload" else pa.string())
                            for x in names])
        for b in batches:
            for name, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, seen = [], 0
                with files.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for raw in members(stream):
                        seen += 1
                        row = parse(raw)
                        rows.append({x: row[x] for x in names})
                        if len(rows) >= 500:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                if seen != records:
                    raise ValueError(f"{name} has {seen} of {records} records")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file", "records").repartition(n, "file").mapInArrow(run, kinds)


def page_records(pages: DataFrame, out: str | None = None) -> DataFrame:
    """Query form: archives of all pages, read back."""
    spark = pages.sparkSession
    out = out or scratch_path(spark, "warc")
    kind = pages.schema["page_id"].dataType
    write_archives(pages, out)
    return read_archives(spark, out).select(
        F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


WARC_SQL = f"""
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, strlen(body) as n, sha256(body) as digest from p),
f as (select digest, min(page_id) as first from d where n >= {MIN_REVISIT} group by 1)
select page_id, n::bigint as payload_bytes, d.digest as payload_digest,
  case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from d left join f on d.digest = f.digest and d.n >= {MIN_REVISIT}
"""
