"""WARC archives compressed with Zstandard and a dictionary per file.

A file starts with a skippable frame that carries the dictionary; every record
is one frame compressed with it, so records are read and checked one by one.
Pages with equal payloads are stored once: the others are revisit records, whose
block is the HTTP header alone and which name the record they repeat.
"""

from __future__ import annotations

import base64
import hashlib
import os
import posixpath
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, one_task_each, scratch_path
from .token_files import _open_store

#: Fixed values of the formats: magic number of the dictionary's skippable frame,
#: of a Zstandard frame and of a dictionary; the profile of a revisit; a fixed date.
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10


class WarcError(ValueError):
    """A file or record that breaks the format."""


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def uid(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(value: str) -> str | None:
    if not value.startswith("<urn:page:") or not value.endswith(">"):
        raise WarcError(f"record id {value!r}")
    return value[10:-1] or None


def _quoted(url: str | None) -> str:
    return urllib.parse.quote(url or "about:blank", safe="%/:=&?~#+!$,;'@()*[]")


def record(page_id: object, url: str | None, payload: bytes | None, digest: str, refers_to: object = None, is_revisit: bool = False, size: int | None = None) -> bytes:
    """The bytes of a response record, or of a revisit of the page ``refers_to``, which needs the payload's ``size`` only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (len(payload) if size is None else size)
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {uid(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_quoted(url)}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1(block)}"]
    if is_revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {uid(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, bytes | None]:
    """(headers, HTTP header block, payload) of one record, checked against its lengths and digests.

    The payload of a revisit is None.
    """
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise WarcError(f"record starts with {raw[:20]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"header line {line!r}")
        headers[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name}")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(rest) - 4} bytes, header says {n}")
    block = rest[:n]
    if "warc-block-digest" in headers and headers["warc-block-digest"] != f"sha1:{sha1(block)}":
        raise WarcError("block digest")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("no end of the HTTP header")
    if headers["warc-type"] == "revisit":
        if payload:
            raise WarcError("revisit with a payload")
        return headers, http, None
    if payload_length(http) != len(payload):
        raise WarcError("HTTP length")
    if "warc-payload-digest" in headers and headers["warc-payload-digest"] != f"sha1:{sha1(payload)}":
        raise WarcError("payload digest")
    return headers, http, payload


def payload_length(http: bytes) -> int:
    for line in http.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    raise WarcError("no HTTP length")


def _train(samples: list[bytes], size: int) -> bytes:
    """A dictionary from the first records of a file; their own bytes where too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Writer:
    def __init__(self, uri: str, dictionary: bytes, level: int = 3) -> None:
        self._fs, self._path = _open_store(uri)
        self._fs.create_dir(posixpath.dirname(self._path), recursive=True)
        self._temp = f"{self._path}.{os.getpid()}-{os.urandom(4).hex()}"
        self._out = self._fs.open_output_stream(self._temp, compression=None)
        stored = zstandard.ZstdCompressor(level=9).compress(dictionary) if dictionary else b""
        self._out.write(struct.pack("<II", SKIPPABLE, len(stored)) + stored)
        self._zstd = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary), write_checksum=True)

    def add(self, raw: bytes) -> None:
        self._out.write(self._zstd.compress(raw))

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._temp, self._path)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    trained = data[:4] == struct.pack("<I", DICTIONARY)
    return zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def read_archive(uri: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The raw records of an archive, one frame each.

    The dictionary comes from the leading skippable frame, where it may itself be
    a Zstandard frame. Raises ``WarcError`` on a file that ends early or holds
    anything else.
    """
    store, path = _open_store(uri)
    with store.open_input_stream(path, compression=None) as f:
        head = f.read(8)
        if len(head) < 8 or struct.unpack("<I", head[:4])[0] != SKIPPABLE:
            raise WarcError("no dictionary frame")
        size = struct.unpack("<I", head[4:])[0]
        stored = f.read(size)
        if len(stored) != size:
            raise WarcError("dictionary cut off")
        if stored[:4] == struct.pack("<I", FRAME):
            stored = zstandard.ZstdDecompressor().decompress(stored, max_output_size=1 << 30)
        zstd = zstandard.ZstdDecompressor(dict_data=_dictionary(stored))
        left = b""
        while True:
            if not left:
                left = f.read(chunk)
                if not left:
                    return
            frame, parts = zstd.decompressobj(), []
            while True:
                parts.append(frame.decompress(left))
                if frame.eof:
                    left = frame.unused_data
                    break
                left = f.read(chunk)
                if not left:
                    raise WarcError("record cut off")
            yield b"".join(parts)


def _lightened(min_bytes: int):
    """Adds digest and size; payloads go from rows that must be revisits, their batch having a copy with a larger page_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids, urls, payloads, keys = (c.to_pylist() for c in part.columns)
                largest: dict[str, object] = {}
                for key, page_id in zip(keys, ids, strict=True):
                    if page_id is not None and (key not in largest or largest[key] < page_id):
                        largest[key] = page_id
                found = {key: (sha1(p), len(p)) for key, p in dict(zip(keys, payloads, strict=True)).items()}
                sent = [p if found[key][1] < min_bytes or key not in largest or page_id == largest[key] else None for p, key, page_id in zip(payloads, keys, ids, strict=True)]
                digest, size = zip(*map(found.__getitem__, keys), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sent, pa.binary()), part.column(3), pa.array(digest, pa.string()), pa.array(size, pa.int64())], names=["page_id", "url", "payload", "key", "digest", "size"])

    return run


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, sample_bytes: int = SAMPLE_BYTES, dictionary_bytes: int = DICTIONARY_BYTES) -> DataFrame:
    """Writes one archive per partition; returns part, uri, records.

    Payloads are the html in UTF-8, null being empty. Of equal payloads of at
    least ``min_bytes`` bytes the record with the largest page_id is the response
    and the others revisit it. A group whose page_ids are all null, and rows that
    repeat the largest one, have no single such record: all those are responses.
    Copies are found from digests and lengths alone, aggregated before any
    shuffle; html travels once, without that of rows which a batch shows to be
    revisits, and a payload with many copies is dealt out to several tasks by
    adaptive skew handling. Each file's dictionary is trained on its first
    ``sample_bytes``.
    """
    id_type = pages.schema["page_id"].dataType
    payload = F.coalesce("html", F.lit("")).cast("binary")
    light = pages.select("page_id", F.sha2(payload, 256).alias("key"), F.octet_length(payload).alias("size"))
    copies = light.groupBy("key").agg(F.max("page_id").alias("keep"), F.count("*").alias("n"), F.first("size").alias("size"))
    copies = copies.filter(f"n > 1 and size >= {int(min_bytes)}").select("key", "keep")
    carried = T.StructType([T.StructField("page_id", id_type), T.StructField("url", T.StringType()), T.StructField("payload", T.BinaryType()), T.StructField("key", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("size", T.LongType())])
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("key")).mapInArrow(_lightened(min_bytes), carried)
    marked = rows.join(copies, "key", "left").select("page_id", "url", "payload", "digest", "size", F.when(F.col("page_id").eqNullSafe(F.col("keep")), None).otherwise(F.col("keep")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, writer, waiting, held, n = TaskContext.get().partitionId(), None, [], 0, 0
        uri = f"{folder}/part-{part:06d}.warc.zst"

        def start() -> Writer:
            out = Writer(uri, _train(waiting, dictionary_bytes))
            for x in waiting:
                out.add(x)
            return out

        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                for page_id, url, payload, digest, size, refers_to in zip(*(c.to_pylist() for c in batch.slice(lo, 128).columns), strict=True):
                    raw = record(page_id, url, payload, digest, refers_to, refers_to is not None, size)
                    n += 1
                    if writer:
                        writer.add(raw)
                        continue
                    waiting.append(raw)
                    held += len(raw)
                    if held >= sample_bytes:
                        writer, waiting = start(), []
        if n:
            (writer or start()).close()
            yield pa.RecordBatch.from_pydict({"part": [part], "uri": [uri], "records": [n]})

    return materialise(marked.mapInArrow(run, "part long, uri string, records long"), "archives")


def read_records(manifest: DataFrame, id_type: T.DataType) -> DataFrame:
    """page_id, payload, payload_bytes, payload_digest, record_type, refers_to per record, checked.

    A revisit has no payload of its own; its length and digest are those that its
    headers give for the full payload.
    """
    fields = [("page_id", T.StringType()), ("payload", T.BinaryType()), ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("record_type", T.StringType()), ("refers_to", T.StringType())]
    schema = T.StructType([T.StructField(n, k) for n, k in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(schema)

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out_schema, strict=True)], schema=out_schema)

        for batch in batches:
            for uri, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size, seen = [], 0, 0
                for raw in read_archive(uri):
                    headers, http, payload = parse(raw)
                    refers = headers.get("warc-refers-to")
                    rows.append((_page(headers["warc-record-id"]), payload, payload_length(http), headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"], _page(refers) if refers else None))
                    seen, size = seen + 1, size + len(raw)
                    if size >= 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                if seen != n:
                    raise WarcError(f"{uri}: {seen} records, {n} written")
                if rows:
                    yield batch_of(rows)

    back = one_task_each(manifest).select("uri", "records").mapInArrow(run, schema)
    return back.withColumns({"page_id": F.col("page_id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the archives, reads them back, and returns one row per page without payloads.

    An empty table writes no archive and gives no rows. Columns besides page_id,
    url and html are not read.
    """
    manifest = write_archives(pages, folder or scratch_path(pages.sparkSession, "warc"), **options)
    return read_records(manifest, pages.schema["page_id"].dataType).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
