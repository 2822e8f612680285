"""WARC archives as single Zstandard frames with a shared dictionary in front."""

from __future__ import annotations

import io
import struct
import uuid
from urllib.parse import quote

import hashlib

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import ID_ROWS, in_batches, named, rows, shared_folder, slices, stored

#: Equal payloads from this size on are archived once; the others refer to it.
REVISIT_BYTES = 100
#: Records a dictionary is built from at most (the first by hash of the id), bytes of each, and its size.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 600, 16_384, 65_536
#: An archive is closed after so many bytes; the next begins with the dictionary again.
ARCHIVE_BYTES = 16_000_000
#: Fixed values of the archive formats: magic of the dictionary's skippable frame, profile of a revisit.
_MAGIC, _ZSTD = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS, _NO_ID = 0x7469_6465_6D69_4C6C, 0x7469_6465_6D69_4C6D


def record_uri(page_id: int | None) -> str:
    high, low = (_NO_ID, 0) if page_id is None else (_IDS, page_id & (2**64 - 1))
    return f"<urn:uuid:{uuid.UUID(int=high << 64 | low)}>"


def page_of(uri: str) -> int | None:
    value = uuid.UUID(uri[1:-1].removeprefix("urn:uuid:")).int
    low = value & (2**64 - 1)
    return None if value >> 64 == _NO_ID else low - (low >> 63 << 64)


def record(page_id, url, payload: bytes, digest: str, refers_to=None, revisit: bool = False, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record: an HTTP response with its payload, or the headers of one that was archived before."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Refers-To: {record_uri(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from archived records; the records themselves if they are too few to train on."""
    if len(samples) >= 32:
        try:
            return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def opening(dictionary: bytes) -> bytes:
    """The leading skippable frame; the dictionary inside is compressed by itself."""
    inner = zstandard.ZstdCompressor(level=10).compress(dictionary)
    return struct.pack("<II", _MAGIC, len(inner)) + inner


def records(archive: bytes):
    """(headers, block) of every record of an archive: dictionary first, then all frames as one stream."""
    view, dictionary = memoryview(archive), None
    if len(view) >= 8 and struct.unpack("<I", view[:4])[0] == _MAGIC:
        size = struct.unpack("<I", view[4:8])[0]
        inner = bytes(view[8: 8 + size])
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(inner) if inner[:4] == _ZSTD else inner)
        view = view[8 + size:]
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(view, read_across_frames=True), 1 << 20)
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline().strip()):
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record ends early")
        yield headers, block


#: Name of the table of archives in their folder, and its columns.
MANIFEST, _LISTED = "manifest", "path string, records long, bytes long"
_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def _writer(folder: str, dictionary: bytes):
    def run(batches):
        target, root = fs.FileSystem.from_uri(folder)
        packed = zstandard.ZstdCompressionDict(dictionary)
        packed.precompute_compress(level=3)
        compressor, front = zstandard.ZstdCompressor(dict_data=packed), opening(dictionary)
        # Names are this attempt's own; only those of attempts that Spark commits get into the manifest.
        task, attempt, number = TaskContext.get(), uuid.uuid4().hex, 0
        parts, size = [], 0

        def close():
            nonlocal number, parts, size
            name = f"part-{task.partitionId():06d}-{attempt}-{number:04d}.warc.zst"
            with target.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(front)
                for part in parts:
                    out.write(part)
            closed = rows(_MANIFEST, [name], [len(parts)], [size + len(front)])
            number, parts, size = number + 1, [], 0
            return closed

        for batch in slices(batches, column="html"):
            columns = [named(batch, c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to", "revisit")]
            for page_id, url, html, digest, refers_to, revisit in zip(*columns):
                parts.append(compressor.compress(record(page_id, url, (html or "").encode(), digest, refers_to, bool(revisit))))
                size += len(parts[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
        if parts:
            yield close()

    return run


def _payload(pages: DataFrame):
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write a record per page; returns the folder of the archives and their manifest ``(path, records, bytes)``.

    Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest page_id is a response
    and the others revisits of it, which hold no payload. Digests are grouped without the payloads, and only the
    revisits go back to the pages. Archives bear names of the attempt that wrote them, and the manifest, a table in
    ``folder``, lists those of committed attempts: what lost or repeated attempts leave behind is never read. Paths in
    it are names within ``folder``. Archives are written through Arrow's file systems, so ``folder`` must be one of theirs.

    Null html is an empty payload, a null url leaves out the target. Rows with a null page_id are never referred to
    while an id with that payload exists, and rows that repeat a page_id with one payload are all responses if it is
    the smallest. Empty table: no archives. Other columns are ignored.
    """
    spark = in_batches(pages).sparkSession
    folder = folder or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    target, root = fs.FileSystem.from_uri(folder)
    target.create_dir(root, recursive=True)
    keyed = pages.select("page_id", F.sha2(_payload(pages), 256).alias("digest"), F.octet_length(_payload(pages)).alias("size"))
    first = stored(
        keyed.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to"), "first",
    )
    if first.count() <= ID_ROWS // 8:
        first = F.broadcast(first)
    digest = F.sha2(_payload(pages), 256).alias("digest")
    joined = pages.select("page_id", "url", "html", digest).join(first, "digest", "left").withColumn(
        "revisit", F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    )
    start = F.substring("html", 1, SAMPLE_BYTES).alias("html")
    # Ids are chosen first, so that no task sends payloads that are not among the chosen.
    chosen = pages.select(F.col("page_id").alias("_id")).where("_id IS NOT NULL").distinct().orderBy(F.xxhash64("_id"), "_id").limit(SAMPLES)
    sample = pages.join(F.broadcast(chosen), F.col("page_id") == F.col("_id"), "left_semi").select("page_id", "url", start).limit(2 * SAMPLES).collect()
    texts = [record(r.page_id, r.url, (r.html or "").encode(), "0" * 64) for r in sample]
    joined.mapInArrow(_writer(folder, trained(texts)), _LISTED).write.parquet(f"{folder}/{MANIFEST}")
    return folder, spark.read.schema(_LISTED).parquet(f"{folder}/{MANIFEST}")


_READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def _reader(folder: str):
    def contents(batch):
        if "content" in batch.schema.names:
            yield from (c.as_buffer().to_pybytes() for c in named(batch, "content"))
            return
        source, root = fs.FileSystem.from_uri(folder)
        for name in named(batch, "path").to_pylist():
            with source.open_input_stream(f"{root}/{name}", compression=None) as stream:
                yield stream.read()

    def run(batches):
        for batch in batches:
            for content in contents(batch):
                yield from _read(content)

    return run


def _read(content: bytes):
    out, held = [], 0
    for head, block in records(content):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rpartition(b"Content-Length: ")[2])
        revisit = head["WARC-Type"] == "revisit"
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest()
        if not revisit and (digest != head["WARC-Payload-Digest"].removeprefix("sha256:") or len(payload) != size):
            raise ValueError(f"payload of {head['WARC-Record-ID']} is damaged")
        out.append((
            page_of(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), None if revisit else payload, size, digest,
            head["WARC-Type"], page_of(head["WARC-Refers-To"]) if revisit else None,
        ))
        held += len(payload)
        if held > 4_000_000:
            yield rows(_READ, *zip(*out))
            out, held = [], 0
    if out:
        yield rows(_READ, *zip(*out))


def read_archives(spark, folder: str) -> DataFrame:
    """Every record: ``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to``; digests are checked.

    The archives are those of the folder's manifest, which tasks open by name; of a folder without one, all ``*.warc.zst``.
    """
    source, root = fs.FileSystem.from_uri(folder)
    if source.get_file_info(f"{root}/{MANIFEST}").type == fs.FileType.Directory:
        listed = spark.read.schema(_LISTED).parquet(f"{folder}/{MANIFEST}")
        tasks = max(1, min(listed.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
        files = listed.select("path").repartition(tasks, "path")
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    return files.mapInArrow(
        _reader(folder), "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archived(pages: DataFrame) -> DataFrame:
    """Write the archives and read them back: a row per page, without the payload."""
    folder, manifest = write_archives(pages)
    if manifest.isEmpty():
        return pages.sparkSession.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_archives(pages.sparkSession, folder).drop("url", "payload")
