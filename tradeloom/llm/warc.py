"""WARC archives of individually compressed records that share a dictionary.

Each archive is built from records in memory: a Zstandard dictionary is made
from them and put in a leading skippable frame, then each record is a frame of
its own. Readers take the dictionary from the archive. Equal payloads are kept
once: the others are revisit records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.runtime import ship, slices, stored, utf8
from tradeloom.session import new_folder

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:page:"
#: A dictionary is made from evenly spread records of up to a hundred times its size.
DICTIONARY_BYTES, ARCHIVE_BYTES = 32 << 10, 16 << 20
MANIFEST = "path string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def record(page_id: int | None, url: str | None, payload: bytes, n: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record. A revisit has the HTTP header of the full payload, without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    name = f"{RECORD_URN}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    header = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}"]
    if url is not None:
        header.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    header.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        header += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{RECORD_URN}{refers_to}>"]
        payload = b""
    header += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}", "", ""]
    return "\r\n".join(header).encode() + http + payload + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """Of records spread evenly; of too few to learn from, their beginning as it is."""
    step = max(1, sum(map(len, records)) // (100 * size))
    samples = records[::step]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 4), samples, d=8, k=200)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> bytes:
    learned = dictionary(records)
    data = learned.as_bytes()
    packer = zstandard.ZstdCompressor(level=3, dict_data=learned, write_checksum=True, write_content_size=True)
    return b"".join([DICTIONARY_FRAME.to_bytes(4, "little"), len(data).to_bytes(4, "little"), data, *(packer.compress(r) for r in records)])


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of each record of an archive, one record in memory at a time."""
    magic = int.from_bytes(stream.read(4), "little")
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    learned = zstandard.ZstdCompressionDict(stream.read(int.from_bytes(stream.read(4), "little")))
    with zstandard.ZstdDecompressor(dict_data=learned).stream_reader(stream, read_across_frames=True) as plain:
        held = b""
        while True:
            while (end := held.find(b"\r\n\r\n")) < 0:
                more = plain.read(1 << 16)
                if not more:
                    if held:
                        raise ValueError("the archive ends within a record")
                    return
                held += more
            lines = held[:end].decode().split("\r\n")
            header = dict(line.split(": ", 1) for line in lines[1:])
            stop = end + 4 + int(header["Content-Length"])
            parts, have = [held], len(held)
            while have < stop + 4:
                more = plain.read(max(1 << 16, stop + 4 - have))
                if not more:
                    raise ValueError("the archive ends within a record")
                parts.append(more)
                have += len(more)
            held = b"".join(parts)
            if lines[0] != "WARC/1.1" or held[stop : stop + 4] != b"\r\n\r\n":
                raise ValueError("a record is not where its predecessor ends")
            yield header, held[end + 4 : stop]
            held = held[stop + 4 :]


def _page(urn: str | None) -> int | None:
    return int(urn[len(RECORD_URN) + 1 : -1]) if urn and urn.startswith(f"<{RECORD_URN}") else None


def write_archives(pages: DataFrame, folder: str | None = None, revisit_from: int = 1000, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every row as a record; returns the manifest (path, records, bytes) of the archives.

    Of records with equal payloads of at least ``revisit_from`` bytes, the largest id is the response. Smaller ones
    are all responses. A null payload is empty. Rows that share the largest id are all responses; a null id is a
    revisit where a page with an id has its payload, else a response. Only archives in the manifest count: those of
    a task that was lost have other names and are not listed. Payloads are shuffled once, by their digest.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = (folder or new_folder(spark, "warc")).rstrip("/")
    html = utf8(F.col(html_col))
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("payload"), F.sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("n"))
    first = named.where(F.col("n") >= revisit_from).groupBy("digest").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and winner is not null").drop("copies")
    # Stored, it joins as a plain exchange, so that adaptive execution can split the pages of a payload with many copies.
    first = stored(first, "winners")
    decided = named.join(first, "digest", "left").withColumn("refers_to", F.when(~F.col("winner").eqNullSafe(F.col("page_id")), F.col("winner")))
    decided = decided.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "n", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _filesystem(folder)
        held, size, made = [], 0, []

        def flush() -> None:
            data, name = archive(held), f"part-{uuid.uuid4().hex}.warc.zst"
            store.create_dir(top, recursive=True)
            with store.open_output_stream(f"{top}/{name}", compression=None) as out:
                out.write(data)
            made.append((f"{folder}/{name}", len(held), len(data)))

        for batch in slices(batches, "payload", ARCHIVE_BYTES):
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "n", "digest", "refers_to")), strict=True):
                held.append(record(*row, date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["path", "records", "bytes"])

    return stored(decided.mapInArrow(run, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the listed archives: id, url, length and SHA-1 of the full payload, type, refers_to, payload.

    A response's length and digest are those of the bytes that were read, and must be the header's. A revisit has
    those of its header and a null payload. An archive is one task's work, of bounded size.
    """
    ship(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = (("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()))

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, size, n = [], 0, 0
                store, name = _filesystem(path)
                with store.open_input_stream(name, compression=None) as stream:
                    for header, block in parse(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
                        if header["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"{path}: a payload is not what its header says")
                        kept = payload if with_payload and header["WARC-Type"] == "response" else None
                        found.append((_page(header["WARC-Record-ID"]), header.get("WARC-Target-URI"), length, digest, header["WARC-Type"], _page(header.get("WARC-Refers-To")), kept))
                        size, n = size + len(kept or b""), n + 1
                        if size > ARCHIVE_BYTES or len(found) >= 10_000:
                            yield batch_of(found)
                            found, size = [], 0
                if n != expected:
                    raise ValueError(f"{path}: {n} records, not {expected}")
                yield batch_of(found)

    tasks = max(1, min(manifest.count(), 10_000))
    return manifest.select("path", "records").repartition(tasks).mapInArrow(run, RECORDS)
