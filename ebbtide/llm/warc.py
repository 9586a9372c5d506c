"""Deterministic sharded WARC archives, and their reader.

Records are range-sorted into shards by splitters from a sample of keys that is drawn by hash, so that
the same rows always give the same shards. A shard's task writes one file after the other, beginning a new one
when the compressed size passes a limit. Headers, digests and record ids are made anew from the
payload, and the date is a parameter, so that equal input gives equal bytes.

Of records with equal payloads one is the response and the others revisit it. Which one is decided on digests
alone, without payloads; that small row travels to the shard just ahead of the record's own.

Every file is written under a temporary name of its own. Only the manifest, a table that Spark commits
once per task, says which of them count; a last step gives those their final names and may be repeated. What a
lost executor or a second attempt left behind is in no manifest and never read.

Defined results: a null payload is empty. Null keys sort first and count as the smallest; a null target
address is written as empty. Rows that are equal in key and payload are one response (if theirs is the largest key)
and revisits. An empty table gives an empty manifest and no files.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm.frames import mapped, named, place_among, stored, task_keys

#: A file is closed once it has so many compressed bytes.
ROLL = 32 << 20
#: Uncompressed bytes per shard, the most shards, and sampled keys per shard (all go to the driver).
SHARD_BYTES, MOST_SHARDS, SAMPLES = 64 << 20, 4096, 32
DATE = "2000-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6f0b1f8e-43f5-5c0e-9d53-9d5b3c1f2a77")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "shard int, file int, name string, temporary string, records long, bytes long, sha256 string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if folder.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), urlparse(folder).path
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (pyarrow.fs.LocalFileSystem(), folder)


def record_id(key: object, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{key}|{digest}|{copy}')}>"


def record(key, uri: str, payload: bytes, digest: str, size: int, copy: int, refers_to, date: str) -> bytes:
    """One record, its own gzip member. ``refers_to`` is None, or the (key, uri) that a revisit refers to."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to else 'response'}",
        f"WARC-Record-ID: {record_id(key, digest, copy)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_one_line(uri)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"X-Key: {'' if key is None else _one_line(str(key))}",
    ]
    if refers_to:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to[0], digest, 0)}",
            f"X-Refers-To-Key: {'' if refers_to[0] is None else _one_line(str(refers_to[0]))}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _one_line(text: str | None) -> str:
    return "".join(c if c >= " " else "%%%02X" % ord(c) for c in text or "")


class _Files:
    """The files of one task, each under a name that no other attempt uses."""

    def __init__(self, folder: str, roll: int) -> None:
        self.store, self.path = _filesystem(folder)
        self.roll, self.attempt, self.out = roll, uuid.uuid4().hex, None
        self.shard, self.number = None, 0

    def write(self, shard: int, data: bytes) -> Iterator[tuple]:
        if shard != self.shard:
            yield from self.close()
            self.shard, self.number = shard, 0
        if self.out is None:
            self.temporary = f"_temporary/{self.attempt}-{shard:05d}-{self.number:05d}"
            self.out = self.store.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.records, self.size, self.sha = 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sha.update(data)
        self.records, self.size = self.records + 1, self.size + len(data)
        if self.size >= self.roll:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.out = None
            name = f"shard-{self.shard:05d}-{self.number:05d}.warc.gz"
            yield self.shard, self.number, name, self.temporary, self.records, self.size, self.sha.hexdigest()
            self.number += 1


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


_MANIFEST_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
_MANIFEST_NAMES = [part.split()[0] for part in MANIFEST.split(", ")]


def _writer(folder: str, roll: int, least: int, date: str):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, decided = _Files(folder, roll), None
        for batch in batches:
            done = []
            columns = [batch.column(c) for c in ("shard", "key", "digest", "kind", "winner", "uri", "payload")]
            for row in zip(*columns, strict=True):
                shard, key, digest, kind, winner, uri = (v.as_py() for v in row[:-1])
                if kind == 0:
                    decided, copy = winner, 0
                    continue
                payload = (row[-1].as_py() or "").encode()
                bare = base64.b32encode(bytes(digest)).decode()
                first = copy == 0 and decided == key
                refers_to = None if first or len(payload) < least else (decided, None)
                data = record(key, uri, payload, bare, len(payload), copy, refers_to, date)
                done += files.write(shard, data)
                copy += 1
            yield _rows(done, _MANIFEST_NAMES, _MANIFEST_TYPES)
        yield _rows(list(files.close()), _MANIFEST_NAMES, _MANIFEST_TYPES)

    return write


def _bounds(keys: DataFrame, shards: int, total: int) -> list:
    """Ascending keys that cut the rows (``key``, ``size``) into shards of similar size."""
    chance = F.greatest("size", F.lit(1)) * F.lit(shards * SAMPLES / max(total, 1))
    draw = F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    sample = [r[0] for r in keys.where(F.col("key").isNotNull() & (draw < chance)).select("key").orderBy("key").collect()]
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)}) if sample else []


def write(
    pages: DataFrame,
    folder: str,
    key: str,
    uri: str,
    payload: str,
    least: int = 0,
    roll: int = ROLL,
    shard_bytes: int = SHARD_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Writes a record for every row into ``folder``, which all executors reach; gives the manifest.

    Payloads of fewer than ``least`` bytes are responses, all of them."""
    text = F.coalesce(named(pages, payload), F.lit(""))
    digest = F.unhex(F.sha1(text.cast("binary")))
    rows = pages.select(
        named(pages, key).alias("key"),
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
        named(pages, uri).cast("string").alias("uri"),
        text.alias("payload"),
    )
    light = stored(rows.select("key", "digest", "size"), "warc-keys")
    total = light.agg(F.sum(F.col("size") + 512)).first()[0] or 0
    shards = min(max(1, math.ceil(total / shard_bytes)), MOST_SHARDS)
    bounds = _bounds(light, shards, total)
    among = F.array(*map(F.lit, bounds)) if bounds else F.array().cast(T.ArrayType(light.schema["key"].dataType))
    shard = F.when(F.col("key").isNull(), 0).otherwise(place_among(among, F.col("key"), len(bounds))).alias("shard")
    # One small row per key and digest says who is the response.
    pairs = light.select("key", "digest").distinct()
    winners = pairs.groupBy("digest").agg(F.max("key").alias("winner"))
    said = pairs.join(winners, "digest").select(
        shard, "key", "digest", F.lit(0).alias("kind"), "winner", F.lit(None).cast("string").alias("uri"), F.lit(None).cast("string").alias("payload")
    )
    kind = light.schema["key"].dataType.simpleString()
    records = rows.select(shard, "key", "digest", F.lit(1).alias("kind"), F.lit(None).cast(kind).alias("winner"), "uri", "payload")
    # A shard is a task: dealt by the hash of their number, several shards would share one.
    tasks = len(bounds) + 1
    numbers = F.array(*map(F.lit, task_keys(pages.sparkSession, tasks))).cast("array<bigint>")
    dealt = said.unionByName(records).repartition(tasks, F.get(numbers, "shard"))
    ordered = dealt.sortWithinPartitions("shard", "key", "digest", "kind", "uri")
    _make_folder(f"{folder}/_temporary")
    manifest = stored(mapped(ordered, _writer(folder, roll, least, date), MANIFEST), "warc-manifest")
    return commit(manifest, folder)


def _make_folder(folder: str) -> None:
    store, path = _filesystem(folder)
    store.create_dir(path, recursive=True)


def _renamer(folder: str):
    def rename(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _filesystem(folder)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                final, source = f"{path}/{name}", f"{path}/{temporary}"
                if store.get_file_info(source).type != pyarrow.fs.FileType.NotFound:
                    store.move(source, final)
                elif store.get_file_info(final).type == pyarrow.fs.FileType.NotFound:
                    raise FileNotFoundError(final)
            yield batch

    return rename


def commit(manifest: DataFrame, folder: str) -> DataFrame:
    """Gives the files of a manifest their final names; done twice, it changes nothing. The manifest is kept beside them."""
    files = manifest.repartition("name")
    mapped(files, _renamer(folder), MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return manifest.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


# -- reading ----------------------------------------------------------------------------------------

RECORD = "key string, uri string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    left = b""
    while True:
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            data = left or stream.read(1 << 20)
            left = b""
            if not data:
                if out:
                    raise ValueError("a record is cut off")
                return
            out.append(unpacker.decompress(data))
        left = unpacker.unused_data
        yield b"".join(out)


def parsed(member: bytes) -> tuple:
    """A record's row, after its digests were made again and compared."""
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if first != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or f"sha1:{base32_sha1(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"broken payload {fields['WARC-Record-ID']}")
    refers_to = fields.get("X-Refers-To-Key") or None
    return fields["X-Key"] or None, fields["WARC-Target-URI"], kind, digest, size, refers_to, payload if kind == "response" else None


def _reader(folder: str, with_payload: bool):
    names = [part.split()[0] for part in RECORD.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    used = slice(0, len(names) if with_payload else len(names) - 1)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _filesystem(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for member in members(stream):
                        rows.append(parsed(member)[used])
                        size += len(member) if with_payload else 256
                        if size >= 4 << 20:
                            yield _rows(rows, names[used], types[used])
                            rows, size = [], 0
                yield _rows(rows, names[used], types[used])

    return read


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all files in the folder's manifest; a file is one task."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("name")
    schema = RECORD if with_payload else RECORD.rpartition(", ")[0]
    return mapped(manifest.repartition("name"), _reader(folder, with_payload), schema)
