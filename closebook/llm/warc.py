"""Deterministic sharded WARC archives: write range-sorted records, roll files by compressed size, read them back.

1. A first scan takes every payload's size and SHA-256. Of records with equal payloads of at least ``LEAST_REVISIT``
   bytes, the least id's is the response; the others become revisits that refer to it. Digests are counted by
   (digest, salt) before they are counted by digest, so that a payload that a third of all records share is never
   gathered in one task.
2. Shards are ranges of (id, digest). Their bounds are quantiles of a sample of keys that is chosen by hash: the same
   rows give the same shards in every run, however Spark deals them. Their number follows the bytes up to
   ``MOST_SHARDS``; beyond, shards grow. Payloads are shuffled once, together with the short rows that say which
   records are revisits; sorted by key, those come just before the records they speak of.
3. A shard's records are written in order, each as a gzip member of its own, into files that are closed when they
   reach ``file_bytes``. Headers, record ids and digests are made anew from the rows. Files are written under names
   that only their task attempt knows.
4. Commit: Spark stores one manifest row per segment of a file, of successful attempts only. Tasks then rename the
   files that the manifest names, which may be repeated; last, the manifest itself is renamed to ``MANIFEST``.
   Without it there is no archive; a run that fails leaves nothing that a reader would take.

Readers take the segments from the manifest, so that a large file is read by several tasks, and check every block
digest and every segment's number of records.

Defined cases: a null payload is empty; null ids come first and are never referred to, so equal payloads of null ids
alone are all responses; rows that repeat the least id of a payload are all responses (rows
of one id and payload are written by one task, one after another); a null url gives no target header;
characters of a url beyond printable ASCII are percent-encoded as UTF-8; an empty table gives an archive without
records; a folder that holds an archive is refused; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from closebook.llm.common import ARROW_ROWS, prepared, settings, store
from closebook.sources.storage import filesystem

LEAST_REVISIT = 100
SALTS = 64
SHARD_BYTES = 16 << 20
MOST_SHARDS = 65_536
SAMPLES_PER_SHARD = 20
FILE_BYTES = 128 << 20
SEGMENT_BYTES = 8 << 20
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PREFIX = "pages"
MANIFEST = "_MANIFEST"
# Payloads can be long, and many lie in one Arrow batch.
ROWS_TOGETHER = "200"

ENTRY = "shard long, temporary string, name string, at long, bytes long, records long, first_id long, last_id long"
RECORD = "page_id long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"

# Fixed values of the format (WARC 1.1): names and order of the lines of a record.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a shared folder as tasks can open it, and the path in it."""
    if "://" in path:
        return arrow_fs.FileSystem.from_uri(path)
    return arrow_fs.LocalFileSystem(), path.removeprefix("file:")


def target(url: str | None) -> str | None:
    """The url as a header may hold it."""
    return None if url is None else quote(url, safe="".join(map(chr, range(0x21, 0x7F))))


def _record(kind: str, name: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
        ("WARC-Date", DATE),
        *fields,
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{key}: {value}\r\n" for key, value in lines if value is not None)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _id_name(page_id: int | None, digest: str) -> str:
    return f"page:{page_id}:{digest}"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with the payload, or a revisit without it."""
    page = None if page_id is None else str(page_id)
    fields = [("WARC-Target-URI", target(url)), ("X-Page-ID", page), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("X-Payload-Length", str(len(payload)))]
    if refers_to is None:
        block = HTTP % len(payload) + payload
        return _record("response", _id_name(page_id, digest), [*fields, ("Content-Type", "application/http; msgtype=response")], block)
    origin = uuid.uuid5(uuid.NAMESPACE_URL, _id_name(refers_to, digest))
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{origin}>"), ("X-Refers-To-Page-ID", str(refers_to))]
    return _record("revisit", "revisit of " + _id_name(page_id, digest), fields, b"")


def info_record(name: str) -> bytes:
    block = b"software: closebook\r\nformat: WARC File Format 1.1\r\n"
    return _record("warcinfo", f"file:{name}", [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


def member(record: bytes) -> bytes:
    """A record as a gzip member; the same bytes in every run."""
    return gzip.compress(record, LEVEL, mtime=0)


class ShardWriter:
    """Writes one shard's records into rolled files and keeps their manifest rows."""

    def __init__(self, fs: arrow_fs.FileSystem, folder: str, shard: int, file_bytes: int, segment_bytes: int):
        self.fs, self.folder, self.shard = fs, folder, shard
        self.file_bytes, self.segment_bytes = file_bytes, segment_bytes
        self.entries: list[tuple] = []
        self.files, self.out = 0, None

    def write(self, page_id: int | None, record: bytes) -> None:
        data = member(record)
        if self.out is not None and self.size + len(data) > self.file_bytes:
            self.close()
        if self.out is None:
            self._open()
        if self.size - self.begin >= self.segment_bytes:
            self._segment()
        if not self.records:
            self.first = page_id
        self.out.write(data)
        self.last = page_id
        self.size += len(data)
        self.records += 1

    def _open(self) -> None:
        self.name = f"{PREFIX}-{self.shard:05d}-{self.files:05d}.warc.gz"
        self.temporary = f"{self.name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
        data = member(info_record(self.name))
        self.out.write(data)
        self.size = self.begin = len(data)
        self.records, self.first, self.last = 0, None, None

    def _segment(self) -> None:
        size = self.size - self.begin
        self.entries.append((self.shard, self.temporary, self.name, self.begin, size, self.records, self.first, self.last))
        self.begin, self.records, self.first, self.last = self.size, 0, None, None

    def close(self) -> None:
        if self.out is not None:
            self._segment()
            self.out.close()
            self.out, self.files = None, self.files + 1


def payload_of(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def slim(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """``page_id, digest, bytes`` of every record."""
    payload = payload_of(F.col(html))
    return pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes")
    )


def revisits(keys: DataFrame) -> DataFrame:
    """``page_id, digest, refers_to`` of the records whose payload another record of a lesser id holds."""
    salted = keys.where(F.col("bytes") >= LEAST_REVISIT).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy("digest", "salt").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    # At most SALTS parts of a digest meet here, then each part of a shared payload gets the least id of all.
    whole = parts.groupBy("digest").agg(F.min("least").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
    shared = whole.where("n > 1 and first is not null").select("digest", "first", F.explode("salts").alias("salt"))
    found = salted.join(shared, ["digest", "salt"]).where("page_id is null or page_id > first")
    return found.select("page_id", "digest", F.col("first").alias("refers_to")).distinct()


def shard_bounds(keys: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[tuple[int, str]]:
    """First keys of all shards but the first: quantiles of a sample that only depends on the keys."""
    rows, size = keys.agg(F.count("*"), F.sum("bytes")).first()
    shards = min(-(-(size or 0) // shard_bytes), MOST_SHARDS, rows)
    if shards < 2:
        return []
    one_in = max(rows // (shards * SAMPLES_PER_SHARD), 1)
    id_ = F.coalesce("page_id", F.lit(-(1 << 63)))
    chosen = keys.where(F.pmod(F.xxhash64("page_id", "digest"), F.lit(one_in)) == 0).select(id_.alias("id"), "digest")
    sample = sorted((row["id"], row["digest"]) for row in chosen.collect())
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)}) if sample else []


def with_shard(rows: DataFrame, bounds: list[tuple[int, str]]) -> DataFrame:
    """The number of the range that a row's (page_id, digest) lies in; at most ``MOST_SHARDS`` bounds go to the tasks."""
    ids = np.array([b[0] for b in bounds], dtype=np.int64)
    digests = np.array([b[1] for b in bounds], dtype="U64")

    @F.pandas_udf("int")
    def shard(page_id, digest):
        own = page_id.to_numpy(dtype=np.int64)
        place = np.searchsorted(ids, own, "left")
        equal = np.flatnonzero((place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == own)) if len(ids) else []
        for i in equal:  # bounds of the same id are told apart by the digest
            stop = np.searchsorted(ids, own[i], "right")
            place[i] += np.searchsorted(digests[place[i] : stop], digest.iloc[i], "right")
        return type(page_id)(place.astype(np.int32))

    return rows.withColumn("shard", shard(F.coalesce("page_id", F.lit(-(1 << 63))), F.col("digest")))


def write_warc(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Write the archive of all rows into the folder ``path``, which must not hold one yet."""
    spark = prepared(pages.sparkSession)
    fs, folder = filesystem(spark, path)
    manifest_path = filesystem(spark, f"{path}/{MANIFEST}")[1]
    if fs.exists(manifest_path):
        raise FileExistsError(f"{path} holds an archive")
    temporary = f"{path}/_temporary"
    fs.mkdirs(filesystem(spark, temporary)[1])

    keys = store(slim(pages, page_id, html), "warc-keys")
    bounds = shard_bounds(keys, shard_bytes)
    payload = payload_of(F.col(html))
    records = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.sha2(payload, 256).alias("digest"), F.lit(None).cast("long").alias("refers_to"),
        F.col(url).cast("string").alias("url"), payload.alias("payload"),
    )
    nothing = [F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload")]
    marks = revisits(keys).select("page_id", "digest", "refers_to", *nothing)
    key = [F.col("page_id").asc_nulls_first(), F.col("digest")]
    rows = with_shard(records.unionAll(marks), bounds).repartitionById(len(bounds) + 1, "shard")
    rows = rows.sortWithinPartitions("shard", *key, F.col("refers_to").asc_nulls_last(), F.col("url").asc_nulls_first())
    with settings(spark, {ARROW_ROWS: ROWS_TOGETHER}):
        manifest = store(rows.mapInArrow(_writer(temporary, file_bytes, segment_bytes), ENTRY), "warc-manifest")
        renamed = manifest.select("temporary", "name").distinct().mapInArrow(_renamer(temporary, path), "name string")
        renamed.count()
    manifest.drop("temporary").write.parquet(f"{temporary}/{MANIFEST}")
    if not fs.rename(filesystem(spark, f"{temporary}/{MANIFEST}")[1], manifest_path):
        raise OSError(f"could not commit {path}")
    fs.delete(filesystem(spark, temporary)[1], True)


def _writer(temporary: str, file_bytes: int, segment_bytes: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(temporary)
        writer, mark = None, None
        for batch in batches:
            names = ["shard", "page_id", "digest", "refers_to", "url", "payload"]
            columns = [batch.column(n) for n in names]
            for i in range(batch.num_rows):
                shard, page_id, digest, refers_to, url, payload = (c[i].as_py() for c in columns)
                if writer is None or writer.shard != shard:
                    if writer is not None:
                        writer.close()
                        yield _entries(writer)
                    writer = ShardWriter(fs, folder, shard, file_bytes, segment_bytes)
                if payload is None:
                    mark = (page_id, digest, refers_to)
                    continue
                origin = mark[2] if mark is not None and mark[:2] == (page_id, digest) else None
                writer.write(page_id, page_record(page_id, url, payload, digest, origin))
        if writer is not None:
            writer.close()
            yield _entries(writer)

    return write


def _entries(writer: ShardWriter) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in ENTRY.split(", ")]
    columns = zip(*writer.entries) if writer.entries else [[]] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _renamer(temporary: str, path: str):
    """Give written files their names; a file that already has its name stays, so that a repeated task does no harm."""

    def rename(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(path)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist(), strict=True):
                there = fs.get_file_info([f"{folder}/_temporary/{old}", f"{folder}/{new}"])
                if there[0].type != arrow_fs.FileType.NotFound:
                    fs.move(f"{folder}/_temporary/{old}", f"{folder}/{new}")
                elif there[1].type == arrow_fs.FileType.NotFound:
                    raise FileNotFoundError(f"neither {old} nor {new} is there")
            yield pa.record_batch([batch.column("name")], names=["name"])

    return rename


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The committed archive's records; without ``payloads`` that column is null, though read and checked."""
    prepared(spark)
    fs, manifest = filesystem(spark, f"{path}/{MANIFEST}")
    if not fs.exists(manifest):
        raise FileNotFoundError(f"{path} holds no committed archive")
    segments = spark.read.parquet(f"{path}/{MANIFEST}").select("name", "at", "bytes", "records")
    some = spark.conf.get("spark.sql.shuffle.partitions")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, folder = file_system(path)
        for batch in batches:
            for segment in batch.to_pylist():
                with own.open_input_file(f"{folder}/{segment['name']}") as file:
                    yield from _batches(records_of(file, segment), payloads)

    # Segments are of equal size: dealt by hash, tasks get about as many bytes.
    return segments.repartition(int(some), "name", "at").mapInArrow(read, RECORD)


def records_of(file, segment: dict, step: int = 1 << 20) -> Iterator[dict]:
    """The records of a segment, member by member; a wrong digest or number of records fails."""
    file.seek(segment["at"])
    left, rest, found = segment["bytes"], b"", 0
    while left or rest:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not rest:
                rest = file.read(min(step, left))
                left -= len(rest)
                if not rest:
                    raise ValueError(f"{segment['name']} ends within a record")
            parts.append(inflate.decompress(rest))
            rest = inflate.unused_data
        found += 1
        yield parsed(b"".join(parts))
    if found != segment["records"]:
        raise ValueError(f"{segment['name']} holds {found} of {segment['records']} records")


def parsed(record: bytes) -> dict:
    """A record's columns; its block digest and, in responses, its payload digest must be right."""
    head, block = record.split(b"\r\n\r\n", 1)
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a record")
    fields = dict(line.decode().split(": ", 1) for line in lines[1:])
    block = block[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError("a block digest is wrong")
    payload = block.split(b"\r\n\r\n", 1)[1] if fields["WARC-Type"] == "response" else None
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    if payload is not None and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError("a payload digest is wrong")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"), "uri": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-ID"), "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


_KINDS = {"page_id": pa.int64(), "uri": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(),
          "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}


def _batches(records: Iterable[dict], payloads: bool, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0
    for record in records:
        if not payloads:
            record["payload"] = None
        size += 200 + len(record["payload"] or b"")
        waiting.append(record)
        if size >= most:
            yield _rows(waiting)
            waiting, size = [], 0
    if waiting:
        yield _rows(waiting)


def _rows(records: list[dict]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[n] for r in records], k) for n, k in _KINDS.items()], names=list(_KINDS))
