"""Web archives in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding some whole WARC records, closed by a skippable frame
with the seek table (compressed and raw size of every frame) and its footer, as in the public seekable format. A plain
Zstandard reader reads a bundle from front to back; with the table, or with the index of records that writing returns
(bundle, frame and offset within the frame's raw bytes), one record costs one frame.

Each task writes bundles of its own into a shared folder under names that no other attempt uses, and returns the index
rows; the index is written once by Spark, so files of lost or repeated attempts are in no index and are never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.session import scratch_path, stable

SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
#: Payloads below this are stored again rather than referred to.
SMALL = 100
MOST_TASKS = 50_000
DATE = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = "page_id long, record_id string, path string, frame long, frame_start long, frame_size long, offset long, size long"
RECORD_SCHEMA = (
    "page_id long, record_id string, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a URI; Spark's names of S3 are taken as well."""
    return pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def record_name(page_id: int | None, digest: str, kind: str = "page") -> str:
    """The same in every run; rows that repeat have records of one name."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}/{page_id}/{digest}')}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit has the HTTP header only and names the record that has the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = record_name(page_id, digest, "revisit" if revisit else "page")
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        headers.append(f"X-Page-Id: {page_id}")
    if url is not None:
        # Line ends and other control characters would break the header.
        headers.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        headers.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        headers.append(f"WARC-Refers-To: {record_name(refers_to, digest)}")
        headers.append(f"X-Refers-To-Page: {refers_to}")
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, size, headers, block)`` of each record of a frame."""
    at = 0
    while at < len(raw):
        head = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:head].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        start = head + 4
        end = start + int(headers["Content-Length"])
        if raw[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} does not end")
        yield at, end + 4 - at, headers, raw[start:end]
        at = end + 4


@dataclass
class Bundle:
    """A bundle being written: whole records in, index entries out."""

    stream: pa.NativeFile
    frame_bytes: int
    level: int
    frames: list[tuple[int, int]] = field(default_factory=list)
    index: list[tuple[int | None, str, int, int, int]] = field(default_factory=list)
    held: list[bytes] = field(default_factory=list)
    held_bytes: int = 0
    raw_bytes: int = 0

    def add(self, page_id: int | None, name: str, record: bytes) -> None:
        self.index.append((page_id, name, len(self.frames), self.held_bytes, len(record)))
        self.held.append(record)
        self.held_bytes += len(record)
        self.raw_bytes += len(record)
        if self.held_bytes >= self.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if self.held:
            packed = zstandard.ZstdCompressor(level=self.level).compress(b"".join(self.held))
            self.stream.write(packed)
            self.frames.append((len(packed), self.held_bytes))
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self.end_frame()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.stream.close()


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """``(start, compressed size, raw size)`` of each frame of a bundle."""
    size = file.size()
    number, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end")
    entry = 12 if flags & 0x80 else 8
    table = file.read_at(number * entry, size - 9 - number * entry)
    frames, start = [], 0
    for n in range(number):
        packed, raw = struct.unpack_from("<II", table, n * entry)
        frames.append((start, packed, raw))
        start += packed
    return frames


def deduplicated(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, revisit, refers_to`` of every page.

    Of equal payloads of at least ``SMALL`` bytes the smallest page id has the response (every row of it, where rows
    repeat; a null id counts as the largest), the others revisit it. Only the digest and id of pages are grouped; the
    payloads are dealt out once by (id, digest), so many copies of one payload do not meet in a task.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    names = stable(rows.where(F.octet_length("payload") >= SMALL).select("page_id", "digest"))
    first = names.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    first = first.where("n > 1 and refers_to is not null").select("digest", "refers_to")
    revisits = (
        names.join(first, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to")
        .distinct()
    )
    same = rows["page_id"].eqNullSafe(revisits["_id"]) & (rows["digest"] == revisits["_digest"])
    joined = rows.join(revisits.hint("shuffle_hash"), same, "left")
    return joined.select("page_id", "url", "payload", "digest", F.col("refers_to").isNotNull().alias("revisit"), "refers_to")


def write_archives(
    pages: DataFrame, folder: str, frame_bytes: int = 1 << 20, bundle_bytes: int = 1 << 28, level: int = 3
) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) into bundles below ``folder``; returns their index.

    The index is kept beside the bundles, as Parquet in ``index``; :func:`read_index` reads it again at any time.
    ``folder`` is a URI that all executors reach and pyarrow can write to. Null html is an empty payload, a null url
    leaves the target out, a null page id is kept as such; other columns are not looked at. An empty table writes no
    bundle and gives an empty index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        bundle, name = None, ""

        def closed() -> pa.RecordBatch:
            bundle.close()
            starts = [0]
            for packed, _ in bundle.frames:
                starts.append(starts[-1] + packed)
            ids, names, frames, offsets, sizes = zip(*bundle.index)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(names, pa.string()),
                    pa.array([f"{folder}/{name}"] * len(ids), pa.string()),
                    pa.array(frames, pa.int64()),
                    pa.array([starts[n] for n in frames], pa.int64()),
                    pa.array([bundle.frames[n][0] for n in frames], pa.int64()),
                    pa.array(offsets, pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["page_id", "record_id", "path", "frame", "frame_start", "frame_size", "offset", "size"],
            )

        for batch in batches:
            fields = (batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))
            for row in zip(*fields):
                page_id, url, payload, digest, refers_to, revisit = (x.as_py() for x in row)
                if bundle is None:
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(system.open_output_stream(f"{root}/{name}", compression=None), frame_bytes, level)
                record = record_bytes(page_id, url, payload, digest, refers_to, revisit)
                bundle.add(page_id, record.split(b"\r\n", 3)[2].decode().removeprefix("WARC-Record-ID: "), record)
                if bundle.raw_bytes >= bundle_bytes:
                    yield closed()
                    bundle = None
        if bundle is not None:
            yield closed()

    deduplicated(pages).mapInArrow(run, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of the bundles below a folder."""
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def _records(found: list[tuple[dict[str, str], bytes]], payloads: bool) -> pa.RecordBatch:
    rows = []
    for headers, block in found:
        http, payload = block.split(b"\r\n\r\n", 1)
        size = int(http.rsplit(b": ", 1)[1])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        revisit = headers["WARC-Type"] == "revisit"
        if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not match its digest")
        page_id, to = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
        url = headers.get("WARC-Target-URI")
        rows.append(
            {
                "page_id": None if page_id is None else int(page_id),
                "record_id": headers["WARC-Record-ID"],
                "url": None if url is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)) if int(m[1], 16) < 128 else m[0], url),
                "payload_bytes": size,
                "payload_digest": digest,
                "record_type": headers["WARC-Type"],
                "refers_to": None if to is None else int(to),
                "payload": payload if payloads and not revisit else None,
            }
        )
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(names, types))))


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles that ``index`` names, read frame by frame along the seek tables.

    Payloads are checked against their digests. A revisit has no payload of its own; ``payload_bytes`` and
    ``payload_digest`` are those of the full payload. ``payloads=False`` leaves the payloads out of the result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, at = file_system(path)
                with system.open_input_file(at) as file:
                    for start, packed, raw in seek_table(file):
                        frame = unpack.decompress(file.read_at(packed, start), max_output_size=raw)
                        yield _records([(headers, block) for _, _, headers, block in parse_records(frame)], payloads)

    paths = index.select("path").distinct()
    # The list of bundles is small, so it would be read by one task: it is dealt out by number, a bundle to a task.
    tasks = max(min(paths.count(), MOST_TASKS), 1)
    numbered = paths.repartitionByRange(tasks, "path") if tasks > 1 else paths
    return numbered.mapInArrow(run, RECORD_SCHEMA)


def read_records(index: DataFrame) -> DataFrame:
    """The records of some rows of an index, each by unpacking its frame alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        last, frame = None, b""
        for batch in batches:
            for row in batch.to_pylist():
                if last != (row["path"], row["frame"]):
                    system, at = file_system(row["path"])
                    with system.open_input_file(at) as file:
                        frame = unpack.decompress(file.read_at(row["frame_size"], row["frame_start"]))
                    last = (row["path"], row["frame"])
                record = frame[row["offset"] : row["offset"] + row["size"]]
                yield _records([(headers, block) for _, _, headers, block in parse_records(record)], True)

    ordered = index.repartition("path", "frame").sortWithinPartitions("path", "frame", "offset")
    return ordered.mapInArrow(run, RECORD_SCHEMA)


def archive_pages(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` as read back from freshly written bundles."""
    folder = scratch_path(pages.sparkSession, "warc")
    records = read_archives(write_archives(pages, folder), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
