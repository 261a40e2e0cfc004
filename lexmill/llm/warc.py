"""Deterministic sharded WARC archives and their reader.

Writer: records are range-sorted by id into shards whose bounds come from exact
sums of bytes over ranges of ids, so the same input always gives the same files.
Ranges over the target are divided again until they fit, wherever the ids lie;
only a single id over the target is cut by digest.  A task writes
each of its shards in order, one gzip member per record with headers and
digests made anew, and rolls to the next file when the compressed size reaches
``roll_bytes``.  Files get temporary names that no other attempt shares; the
manifest lists those of the attempts that counted, they are renamed, and then
the manifest itself is committed.  Readers open only what the manifest lists.

Of records with equal payloads one is the response and the others are revisit
records without content, whose payloads are not shuffled either.  Defined cases:
null payload is empty; a very long payload is one record and must fit a worker;
null url gives a record without target; ids are numbers, as others cannot be cast
to long; a null id sorts first, and many of them are cut by digest; rows that repeat
the id of the response are responses too, and rows that repeat have record ids
of their own; an empty table gives an empty manifest and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_counted, materialize, partitions, shared_dir

#: Ranges of one pass of sums about, and shards at most.
HISTOGRAM, MOST_SHARDS = 4096, 100_000
SHARD_BYTES = 64 << 20
ROLL_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
LEVEL = 3
MANIFEST = "file string, temporary string, records long, bytes long, sha256 string"


def _files(url: str):
    """File system and path of a URL that all executors reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(url)


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: object, digest: str, copy: int = 0) -> str:
    """Id of the first record of a page and payload, or of a later copy of it."""
    name = f"{page_id}|{digest}|{copy}" if copy else f"{page_id}|{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record_bytes(page_id: object, url: str | None, payload: bytes, refers_to: object, revisit: bool, digest: str | None = None, length: int | None = None, copy: int = 0) -> bytes:
    """One uncompressed WARC record; a revisit has digest and length in place of the payload."""
    digest, length = digest or _digest(payload), len(payload) if length is None else length
    block = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest, copy)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    head += [f"X-Payload-Length: {length}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{_digest(block)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # no name and no time in its header
    return packer.compress(data) + packer.flush()


class _ShardFile:
    """One file in the making, under a name no other attempt uses."""

    def __init__(self, directory: str, shard: int, number: int) -> None:
        self.system, self.root = _files(directory)
        self.name = f"shard-{shard:06d}-{number:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        self.system.create_dir(posixpath.join(self.root, "_temporary"), recursive=True)
        self.stream = self.system.open_output_stream(posixpath.join(self.root, self.temporary), compression=None)
        self.records = self.size = 0
        self.sum = hashlib.sha256()

    def add(self, member: bytes) -> None:
        self.stream.write(member)
        self.sum.update(member)
        self.records += 1
        self.size += len(member)

    def close(self) -> tuple[str, str, int, int, str]:
        self.stream.close()
        return self.name, self.temporary, self.records, self.size, self.sum.hexdigest()


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(5)], names=["file", "temporary", "records", "bytes", "sha256"])


def _range_sums(sizes: DataFrame, starts: np.ndarray) -> np.ndarray:
    """Bytes of each range of ids; range k begins at ``starts[k]`` and ends before the next one."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(starts, batch.column(0).to_numpy(zero_copy_only=False), "right") - 1
            found, inverse = np.unique(at, return_inverse=True)
            sums = np.zeros(len(found), dtype=np.int64)
            np.add.at(sums, inverse, batch.column(1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(sums)], names=["range", "bytes"])

    result = np.zeros(len(starts), dtype=np.int64)
    for row in sizes.mapInArrow(ranges, "range long, bytes long").groupBy("range").agg(F.sum("bytes").alias("bytes")).collect():
        result[row["range"]] = row["bytes"]
    return result


def shard_starts(sizes: DataFrame, shard_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First id, first shard and number of shards of each range, from a materialised table (id, bytes); null ids stand before the least id.

    Some ranges share a shard; a range of several shards holds a single id.
    """
    low, high, total, nulls = sizes.agg(F.min("id"), F.max("id"), F.sum("bytes"), F.count_if(F.col("id").isNull())).first()
    if total is None:
        return (np.zeros(1, dtype=np.int64),) * 2 + (np.ones(1, dtype=np.int64),)
    low, high = (0, 0) if low is None else (low, high)
    if nulls:
        low = max(low - 1, -(1 << 63))
        sizes = sizes.withColumn("id", F.coalesce("id", F.lit(low).cast("long")))
    shard_bytes = max(shard_bytes, total // MOST_SHARDS)
    ranges, sums = [(int(low), int(high) + 1)], np.array([total], dtype=np.int64)
    while heavy := sum(size > shard_bytes and b - a > 1 for (a, b), size in zip(ranges, sums.tolist(), strict=True)):
        parts, finer = max(2, HISTOGRAM // heavy), []
        for (a, b), size in zip(ranges, sums.tolist(), strict=True):
            step = -(-(b - a) // parts) if size > shard_bytes else b - a
            finer += [(x, min(x + step, b)) for x in range(a, b, step)]
        sums = _range_sums(sizes, np.array([a for a, _ in finer], dtype=np.int64))
        ranges = [r for r, size in zip(finer, sums.tolist(), strict=True) if size]
        sums = sums[sums > 0]
    starts = [a for a, _ in ranges]
    cuts = np.maximum(1, -(-sums // shard_bytes))
    first, shard, filled = np.zeros(len(starts), dtype=np.int64), 0, 0
    for k, (size, many) in enumerate(zip(sums.tolist(), cuts.tolist(), strict=True)):
        if filled and (many > 1 or filled + size > shard_bytes):
            shard, filled = shard + 1, 0
        first[k] = shard
        filled += size
        if many > 1:
            shard, filled = shard + many, 0
    return np.array(starts, dtype=np.int64), first, cuts


def with_shards(records: DataFrame, sizes: DataFrame, shard_bytes: int) -> DataFrame:
    """Add ``shard`` to records with page_id and sha1; null ids go first."""
    starts, first, cuts = shard_starts(sizes, shard_bytes)
    names = records.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(names.index("page_id")).cast(pa.int64()).fill_null(int(starts[0])).to_numpy(zero_copy_only=False)
            at = np.maximum(np.searchsorted(starts, ids, "right") - 1, 0)
            cut = batch.column(names.index("cut")).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first[at] + cut % cuts[at])], names=[*names, "shard"])

    return records.mapInArrow(place, T.StructType([*records.schema.fields, T.StructField("shard", T.LongType())]))


def write_warc(pages: DataFrame, directory: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", keep: str = "largest", min_revisit_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives and commit them; returns the manifest."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(f"`{payload_col}`"), F.lit("")), "UTF-8")
    records = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload")).withColumns({"sha1": F.sha1("payload"), "length": F.length("payload").cast("long")})
    digests = materialize(records.select("page_id", "sha1", "length"))
    pick = F.max if keep == "largest" else F.min
    equal = digests.where(F.col("length") >= min_revisit_bytes).groupBy("sha1").agg(pick("page_id").alias("response"), F.count("*").alias("n"))
    equal = materialize(equal.where("n > 1"))
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("response")), F.lit(False)) & F.col("response").isNotNull()
    sizes = join_counted(digests, equal, "sha1", "n", "left")
    sizes = materialize(sizes.select(F.col("page_id").alias("id"), (F.when(revisit, 0).otherwise(F.col("length")) + 500).alias("bytes")))
    records = join_counted(records, equal, "sha1", "n", "left").withColumn("revisit", revisit)
    records = records.select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "sha1", "length", "response", "revisit", F.crc32("sha1").alias("cut"))
    records = with_shards(records, sizes, shard_bytes)
    sorted_records = records.repartition(partitions(spark), "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "sha1", "url").select("shard", "page_id", "url", "payload", "response", "revisit", "sha1", "length")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        out: _ShardFile | None = None
        last, copy = None, 0
        for batch in batches:
            for shard, page_id, url, body, response, is_revisit, sha1, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is not None and (shard != at[0] or out.size >= roll_bytes):
                    yield _manifest_batch([out.close()])
                    out = None
                if out is None:
                    at = (shard, at[1] + 1 if at is not None and at[0] == shard else 0)
                    out = _ShardFile(directory, *at)
                last, copy = (page_id, sha1), copy + 1 if last == (page_id, sha1) else 0
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                out.add(_gzip_member(record_bytes(page_id, url, body or b"", response, is_revisit, digest, length, copy)))
        if out is not None:
            yield _manifest_batch([out.close()])

    manifest = materialize(sorted_records.mapInArrow(write, MANIFEST))

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _files(directory)
        for batch in batches:
            for name, temporary in zip(batch.column("file").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                old, new = posixpath.join(root, temporary), posixpath.join(root, name)
                if system.get_file_info(old).type.name != "NotFound":  # else an earlier attempt has renamed it
                    system.move(old, new)
            yield batch

    manifest = materialize(manifest.mapInArrow(commit, MANIFEST))
    manifest.drop("temporary").orderBy("file").coalesce(1).write.mode("overwrite").json(f"{directory}/manifest")
    return manifest.drop("temporary")


def _members(stream) -> Iterator[bytes]:
    """Decompressed gzip members, one at a time."""
    packer, parts = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            parts.append(packer.decompress(data))
            data = packer.unused_data
            if packer.eof:
                yield b"".join(parts)
                packer, parts = zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("the archive ends inside a record")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record; digests are checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if "sha1:" + _digest(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else b""
    if fields["WARC-Type"] == "response" and "sha1:" + _digest(payload) != fields["WARC-Payload-Digest"]:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    return fields, payload


def read_warc(spark: SparkSession, directory: str, *, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, url, record_type, payload_bytes, payload_digest, refers_to (and payload)."""
    manifest = spark.read.schema("file string, records long, bytes long, sha256 string").json(f"{directory}/manifest")
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType())])
    if with_payload:
        schema = schema.add("payload", T.BinaryType())
    names, kinds = schema.names, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _files(directory)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows: list[tuple] = []
                with system.open_input_stream(posixpath.join(root, name), compression=None) as stream:
                    for record in _members(stream):
                        fields, payload = parse_record(record)
                        page, ref = fields.get("X-Page"), fields.get("X-Refers-To-Page")
                        rows.append((int(page) if page else None, fields.get("WARC-Target-URI"), fields["WARC-Type"], int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"][5:], int(ref) if ref else None, payload))
                        if len(rows) == 1000 or with_payload and len(rows) == 50:
                            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)
                            rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)

    return manifest.select("file").repartition(partitions(spark)).mapInArrow(read, schema)


def archive_dir(spark: SparkSession) -> str:
    """A new folder for archives in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
