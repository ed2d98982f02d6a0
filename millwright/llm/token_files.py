"""Token ids in Arrow stream files of equal-length sequences.

A file is one Arrow IPC stream. Its batches hold ``rows`` sequences each (the
last may hold fewer) in two columns: ``tokens``, a fixed-size list of unsigned
integers, and ``mask``, a fixed-size list of booleans that are false on padding.
All full batches encode to the same number of bytes, so sequence i lies in the
message at head + (i // rows) * batch bytes and is read from a memory map
without copying. A second stream beside it lists the documents with their
lengths, in order.
"""

from __future__ import annotations

import io
import os
import posixpath
import urllib.parse
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, one_task_each, scratch_path
from .tokens import encoder, text_slices

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Chunks whose ids a worker keeps; 16-bit ids take little room.
CACHE_CHUNKS = 900_000
LENGTH = 2048
ROWS = 256
#: Texts encoded at once, and their characters: the more, the fewer distinct chunks are looked up for each.
TEXTS, SIZE = 3072, 12 << 20


def _open_store(uri: str):
    """(file system, path) for a URI or a plain path."""
    from pyarrow import fs

    parts = urllib.parse.urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path or uri
    return fs.FileSystem.from_uri(uri)


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    return pa.schema([("tokens", pa.list_(pa.field("item", kind, nullable=False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length))])


class Writer:
    """Appends documents; ``close`` publishes both files under their final names."""

    def __init__(self, uri: str, length: int, rows: int, width: int, doc_type: pa.DataType) -> None:
        self._fs, self._path = _open_store(uri)
        self._fs.create_dir(posixpath.dirname(self._path), recursive=True)
        self._temp = f"{self._path}.{os.getpid()}-{os.urandom(4).hex()}"
        self._length, self._rows, self._width = length, rows, width
        self._kind = {2: pa.uint16(), 4: pa.uint32()}[width]
        self._schema = _schema(length, self._kind).with_metadata({"length": str(length), "rows": str(rows)})
        self._out = self._fs.open_output_stream(self._temp, compression=None)
        self._stream = pa.ipc.new_stream(self._out, self._schema)
        self._doc_schema = pa.schema([("doc_id", doc_type), ("n_tokens", pa.int64())])
        self._doc_out = self._fs.open_output_stream(f"{self._temp}.docs", compression=None)
        self._doc_stream = pa.ipc.new_stream(self._doc_out, self._doc_schema)
        self._buffer, self._docs = bytearray(), []
        self.tokens = self.documents = 0

    def add(self, doc_id, ids: bytes) -> None:
        n = len(ids) // self._width
        self._docs.append((doc_id, n))
        self.tokens += n
        self.documents += 1
        self._buffer += ids
        step = self._length * self._rows * self._width
        while len(self._buffer) >= step:
            self._batch(bytes(self._buffer[:step]), self._rows)
            del self._buffer[:step]
        if len(self._docs) >= 8192:
            self._list()

    def _batch(self, raw: bytes, rows: int) -> None:
        whole = rows * self._length
        real = len(raw) // self._width
        mask = np.zeros(whole, bool)
        mask[:real] = True
        bits = pa.py_buffer(np.packbits(mask, bitorder="little").tobytes())
        tokens = pa.Array.from_buffers(self._kind, whole, [None, pa.py_buffer(raw + bytes(whole * self._width - len(raw)))])
        flags = pa.Array.from_buffers(pa.bool_(), whole, [None, bits])
        columns = [pa.FixedSizeListArray.from_arrays(a, type=self._schema.field(i).type) for i, a in enumerate((tokens, flags))]
        self._stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=self._schema))

    def _list(self) -> None:
        if self._docs:
            self._doc_stream.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self._docs, strict=True), self._doc_schema, strict=True)], schema=self._doc_schema))
            self._docs = []

    def close(self) -> None:
        if self._buffer:
            self._batch(bytes(self._buffer), -(-len(self._buffer) // (self._length * self._width)))
        self._list()
        for x in (self._stream, self._out, self._doc_stream, self._doc_out):
            x.close()
        self._fs.move(f"{self._temp}.docs", f"{self._path}.docs")
        self._fs.move(self._temp, self._path)


class Reader:
    """Random access to the sequences of one file."""

    def __init__(self, uri: str) -> None:
        self._fs, self._path = _open_store(uri)
        local = self._fs.type_name == "local"
        source = pa.memory_map(self._path) if local else self._fs.open_input_file(self._path)
        self._source = source
        head = pa.ipc.open_stream(source)
        self.schema = head.schema
        meta = {k.decode(): int(v) for k, v in head.schema.metadata.items()}
        self.length, self._rows = meta["length"], meta["rows"]
        self._size = source.size()
        buffer = io.BytesIO()
        pa.ipc.new_stream(buffer, head.schema).close()
        self._head = len(buffer.getvalue()) - 8  # without the end mark
        self._step = None
        if self._size > self._head + 8:
            source.seek(self._head)
            pa.ipc.read_message(source)
            self._step = source.tell() - self._head
        self._at, self._batch = None, None

    def batches(self) -> Iterator[pa.RecordBatch]:
        self._source.seek(0)
        yield from pa.ipc.open_stream(self._source)

    def _load(self, k: int) -> pa.RecordBatch:
        if k != self._at:
            self._source.seek(self._head + k * self._step)
            self._batch, self._at = pa.ipc.read_record_batch(pa.ipc.read_message(self._source), self.schema), k
        return self._batch

    def __len__(self) -> int:
        if self._step is None:
            return 0
        last = -(-(self._size - self._head - 8) // self._step) - 1
        return last * self._rows + self._load(last).num_rows

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens, as a view of the file, and mask of sequence i."""
        batch, row = self._load(i // self._rows), i % self._rows
        tokens = batch.column(0).values.to_numpy(zero_copy_only=True)[row * self.length : (row + 1) * self.length]
        mask = batch.column(1).values.slice(row * self.length, self.length).to_numpy(zero_copy_only=False)
        return tokens, mask

    def documents(self) -> Iterator[tuple[object, int]]:
        with self._fs.open_input_stream(f"{self._path}.docs", compression=None) as f:
            for batch in pa.ipc.open_stream(f):
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, length: int = LENGTH, rows: int = ROWS, width: int = 2) -> DataFrame:
    """Writes files in ascending doc_id order and returns their manifest.

    Manifest columns: part, uri, documents, tokens, start (ids in earlier files).
    Texts are dealt out once by doc_id range and encoded where they are written.
    ``width`` is the bytes of an id in the files: 2 holds vocabularies of up to
    65,536 ids. A task that runs again writes the same names anew. A null text
    is empty, null doc_ids come last, rows that repeat are written one by one. Long
    texts are written as they come, sequence by sequence; an empty table writes no
    file. Other columns are not read, whatever their names.
    """
    import public_tokenizers

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        part, encode, out = TaskContext.get().partitionId(), encoder(path, leading=True, width=width, cache_entries=CACHE_CHUNKS), None
        end, uri = np.array([end_id], f"<u{width}").tobytes(), f"{folder}/part-{part:06d}.arrows"
        for ids, texts in text_slices(batches, TEXTS, SIZE):
            out = out or Writer(uri, length, rows, width, to_arrow_type(id_type))
            for doc_id, raw in zip(ids, encode(texts), strict=True):
                out.add(doc_id, raw + end)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "uri": [uri], "documents": [out.documents], "tokens": [out.tokens]})

    order = F.col("doc_id").asc_nulls_last()
    rows_in_order = docs.select("doc_id", "text").repartitionByRange(order).sortWithinPartitions(order, "text")
    files = materialise(rows_in_order.mapInArrow(run, "part long, uri string, documents long, tokens long"), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame, id_type: T.DataType) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) per document, from the files."""
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out_schema = to_arrow_schema(schema)
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader, at, rows, size = Reader(uri), start, [], 0
                source, now, pos = reader.batches(), np.empty(0, "<u4"), 0
                for doc_id, n in reader.documents():
                    parts, missing = [], n
                    while missing:
                        if pos == len(now):
                            now, pos = _real(next(source)), 0
                        parts.append(now[pos : pos + missing].tobytes())
                        got = min(missing, len(now) - pos)
                        pos, missing = pos + got, missing - got
                    rows.append((doc_id, at, n, b"".join(parts)))
                    at, size = at + n, size + 4 * n
                    if size >= 8 << 20:
                        yield _rows(rows, out_schema)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, out_schema)

    return one_task_each(manifest).select("uri", "start").mapInArrow(run, schema)


def _real(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of a batch without padding, as 32-bit integers."""
    tokens, mask = batch.column(0).values, batch.column(1).values
    ids = tokens.to_numpy(zero_copy_only=True)
    if mask.true_count < len(mask):
        ids = ids[mask.to_numpy(zero_copy_only=False)]
    return ids.astype("<u4")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def round_trip(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Writes the token files, reads them back, and returns a digest per document.

    One row per row of ``docs``: doc_id, start, n_tokens, ids_crc32; an empty table
    gives none. Each file is read in a task of its own.
    """
    manifest = write_tokens(docs, folder or scratch_path(docs.sparkSession, "tokens"), **options)
    back = read_tokens(manifest, docs.schema["doc_id"].dataType)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
