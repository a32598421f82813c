"""Deterministic sharded WARC writer and its reader.

Records are dealt to shards by ranges of page_id and sorted, so that the same rows
give the same archives byte for byte, whatever the partitions of the input. The bounds
of the ranges come from the ids with the smallest hashes, ``PER_SHARD`` a shard: a
bounded sample that only sets how even the shards are. Each record is a gzip member
with headers and digests made anew; a file is closed when its compressed size reaches
``roll_bytes``. Tasks write under temporary names that hold their attempt; the manifest
lists the files of the attempts that counted; the commit moves those to their names and
marks the folder at the end. Repeating the commit does no harm, and a reader goes by the
manifest alone, so lost executors and second attempts leave no trace.

Of records with equal payloads of at least ``least_bytes``, the one with the largest
page_id is a response and the others are revisits of it. Which they are is found on
(page_id, digest) alone; the texts are shuffled once, together with these marks. Only
counts of equal digests meet in one place, after map-side sums.

Null payloads are empty, a null url is ``about:blank``. Rows repeated with the largest
id are all responses. Null ids come first and revisit an equal record that has an id.
Other columns are not written. Without pages the manifest has no file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import parts_for, same

PER_SHARD = 40
SHARD_BYTES = 64 << 20
ROLL_BYTES = 16 << 20
LEAST_BYTES = 1000
#: Fixed by the WARC 1.1 specification.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("roll", T.IntegerType()),
    T.StructField("temporary", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("records", T.LongType()), T.StructField("bytes", T.LongType()),
    T.StructField("sha256", T.StringType()),
])
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
])
EXTENDED = T.StructType([*RECORD.fields, T.StructField("url", T.StringType()),
                         T.StructField("payload", T.BinaryType())])


@dataclass(frozen=True)
class Archive:
    """A folder all executors reach, by any address that Arrow's file systems know."""

    folder: str
    date: str = "1970-01-01T00:00:00Z"
    roll_bytes: int = ROLL_BYTES
    level: int = 6

    def at(self, name: str) -> tuple[pafs.FileSystem, str]:
        address = re.sub(r"^file:/+", "file:///", f"{self.folder}/{name}")
        return pafs.FileSystem.from_uri(address)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"WARC-Block-Digest: {_sha1(block)}",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                date: str) -> bytes:
    """A response, or a revisit of page ``refers_to`` whose payload is left out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("X-Refers-To-Page-Id", str(refers_to))]
    return _record(fields, http + (payload if refers_to is None else b""))


class Roller:
    """Writes gzip members to files of one shard and starts a new file at ``roll_bytes``."""

    def __init__(self, archive: Archive, shard: int, attempt: int):
        self.archive, self.shard, self.attempt = archive, shard, attempt
        self.roll, self.out, self.done = 0, None, []

    def _open(self) -> None:
        self.temporary = f"_temporary/{self.attempt}/{self.shard:05d}-{self.roll:05d}"
        files, path = self.archive.at(self.temporary)
        files.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.size, self.records, self.digest = files.open_output_stream(path), 0, 0, hashlib.sha256()
        name = f"part-{self.shard:05d}-{self.roll:05d}.warc.gz"
        self._member(_record([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", self.archive.date),
            ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
        ], b"format: WARC File Format 1.1\r\n"))

    def _member(self, record: bytes) -> None:
        packer = zlib.compressobj(self.archive.level, zlib.DEFLATED, 31)
        for part in (packer.compress(record), packer.flush()):
            self.out.write(part)
            self.digest.update(part)
            self.size += len(part)

    def write(self, record: bytes) -> None:
        if self.out is None:
            self._open()
        self._member(record)
        self.records += 1
        if self.size >= self.archive.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.done.append({
            "shard": self.shard, "roll": self.roll, "temporary": self.temporary,
            "name": f"part-{self.shard:05d}-{self.roll:05d}.warc.gz", "records": self.records,
            "bytes": self.size, "sha256": self.digest.hexdigest()})
        self.out, self.roll = None, self.roll + 1


def shard_bounds(pages: DataFrame, shards: int) -> np.ndarray:
    """Lower bounds of shards 1.. from the ids with the smallest hashes."""
    ids = pages.where(F.col("page_id").isNotNull()).select("page_id").distinct()
    drawn = np.sort(ids.orderBy(F.xxhash64("page_id"), "page_id").limit(PER_SHARD * shards).toPandas()["page_id"]
                    .to_numpy(np.int64))
    at = np.arange(1, shards) * len(drawn) // shards
    return np.unique(drawn[at]) if len(drawn) else drawn


def revisit_marks(digests: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the records that repeat another one's payload."""
    repeated = digests.where(F.col("size") >= least_bytes).groupBy("digest").agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return digests.join(repeated, "digest").where(
        ~same(F.col("page_id"), F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, archive: Archive, shard_bytes: int = SHARD_BYTES,
                   least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes all pages below ``archive.folder`` and returns the manifest of what was committed."""
    from pyspark.sql.pandas.types import to_arrow_schema

    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.sha1(payload).alias("digest"),
                        F.lit(1).alias("kind"), "url", payload.alias("payload"), F.lit(None).cast("long").alias("refers_to"))
    total = rows.agg(F.sum(F.length("payload"))).first()[0] or 0
    bounds = shard_bounds(rows, max(1, -(-total // shard_bytes)))
    marks = revisit_marks(rows.select("page_id", "digest", F.length("payload").alias("size")), least_bytes)
    both = rows.unionByName(marks.withColumn("kind", F.lit(0)), allowMissingColumns=True)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        shard = np.zeros(len(ids), np.int32)
        shard[known] = np.searchsorted(bounds, ids[known].to_numpy(np.int64), side="right")
        return pd.Series(shard)

    dealt = both.withColumn("shard", shard_of("page_id")).repartitionById(
        len(bounds) + 1, F.col("shard")).sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_first(), "digest", "kind", "url")
    arrow = to_arrow_schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, mark = None, None
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                shard, page_id = columns["shard"][i].as_py(), columns["page_id"][i].as_py()
                digest = columns["digest"][i].as_py()
                if columns["kind"][i].as_py() == 0:
                    mark = (page_id, digest, columns["refers_to"][i].as_py())
                    continue
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        roller.close()
                        yield pa.RecordBatch.from_pylist(roller.done, schema=arrow)
                    roller = Roller(archive, shard, attempt)
                refers_to = mark[2] if mark and mark[:2] == (page_id, digest) else None
                roller.write(page_record(page_id, columns["url"][i].as_py(), columns["payload"][i].as_py(), digest,
                                         refers_to, archive.date))
        if roller is not None:
            roller.close()
            yield pa.RecordBatch.from_pylist(roller.done, schema=arrow)

    manifest = f"{archive.folder}/_manifest"
    dealt.mapInArrow(run, MANIFEST).write.parquet(manifest)
    listed = pages.sparkSession.read.schema(MANIFEST).parquet(manifest)
    commit(listed, archive)
    return listed


def spread(manifest: DataFrame, task_bytes: int = ROLL_BYTES) -> DataFrame:
    """The files of ``manifest`` dealt to as many tasks as hold ``task_bytes`` each, and at least as the session has.

    The number is given, so the few bytes of names are not joined to one partition.
    """
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    return manifest.repartition(parts_for(manifest, total, task_bytes), "name")


def commit(manifest: DataFrame, archive: Archive) -> None:
    """Moves the listed files to their names, then marks the folder. May be repeated."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, target = archive.at(row["name"])
                source = archive.at(row["temporary"])[1]
                if files.get_file_info(source).type == pafs.FileType.File:
                    files.move(source, target)
                held = files.get_file_info(target)
                if held.type != pafs.FileType.File or held.size != row["bytes"]:
                    raise OSError(f"{row['name']} is not complete")
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    moved = spread(manifest).mapInArrow(move, "n long").agg(F.sum("n")).first()[0] or 0
    files, path = archive.at("_COMMITTED")
    with files.open_output_stream(path) as out:
        out.write(f"{moved}\n".encode())
    files, path = archive.at("_temporary")
    if files.get_file_info(path).type == pafs.FileType.Directory:
        files.delete_dir(path)


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of one archive file."""
    unpacked = gzip.GzipFile(fileobj=stream)
    while True:
        line = unpacked.readline()
        if not line:
            return
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := unpacked.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            fields[key.lower()] = value.strip()
        block = unpacked.read(int(fields["content-length"]))
        if unpacked.read(4) != b"\r\n\r\n" or _sha1(block) != fields["warc-block-digest"]:
            raise ValueError(f"damaged record {fields.get('warc-record-id')}")
        yield fields, block


def parsed(fields: dict[str, str], block: bytes) -> dict | None:
    """Row of a page's record, None for the record about the file."""
    if fields["warc-type"] == "warcinfo":
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?mi)^Content-Length: (\d+)", head)[1])
    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    if fields["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload {fields['warc-record-id']}")
    number = lambda key: int(fields[key]) if key in fields else None
    return {"page_id": number("x-page-id"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": number("x-refers-to-page-id"),
            "url": fields["warc-target-uri"], "payload": payload}


def read_archives(manifest: DataFrame, archive: Archive, payloads: bool = False) -> DataFrame:
    """A row for each page's record in the files of ``manifest``, whole files to a task."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = EXTENDED if payloads else RECORD
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = archive.at(name)
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for record in read_records(stream):
                        row = parsed(*record)
                        if row is None:
                            continue
                        rows.append(row)
                        size += row["payload_bytes"] if payloads else 100
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return spread(manifest.select("name", "bytes")).select("name").mapInArrow(run, schema)
