"""Grace hash deduplication on complete content.

Each task hashes its records into an open-addressing table that compares whole
contents. Once the table is full, records of further contents go to spill files
by digest, and each file is treated the same way one level down. A first pass
does this per input partition, so a text with any number of copies leaves one
representative per partition; the representatives are then dealt out by digest
and pass through a second table. Membership never gathers in one task: a row
joins its own partition's representative.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, tidy

MEMORY_BYTES = 96 << 20
FANOUT = 16

_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_RUNS = re.compile(rb"  +")


def normalised(text: str | None) -> bytes:
    """UTF-8 with each run of ASCII white space replaced by one space; null is empty."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_TO_SPACE)
    return _RUNS.sub(b" ", raw) if b"  " in raw else raw


class OpenTable:
    """Open addressing with linear probing; a slot holds a digest, a content and a state."""

    def __init__(self) -> None:
        self._slots: list[list | None] = [None] * 1024
        self.bytes = self.used = 0

    def _find(self, digest: bytes, content: bytes) -> int:
        mask = len(self._slots) - 1
        i = int.from_bytes(digest[-8:], "little") & mask
        while (s := self._slots[i]) is not None and not (s[0] == digest and s[1] == content):
            i = (i + 1) & mask
        return i

    def get(self, digest: bytes, content: bytes) -> list | None:
        return self._slots[self._find(digest, content)]

    def add(self, digest: bytes, content: bytes, state: object) -> list:
        if 2 * self.used >= len(self._slots):
            old, self._slots = self._slots, [None] * (4 * len(self._slots))
            for s in filter(None, old):
                self._slots[self._find(s[0], s[1])] = s
        entry = self._slots[self._find(digest, content)] = [digest, content, state]
        self.used += 1
        self.bytes += len(content) + 200
        return entry

    def __iter__(self) -> Iterator[list]:
        return filter(None, self._slots)


def grace(records: Iterable[tuple[bytes, bytes, object]], start, merge, memory: int = MEMORY_BYTES, fanout: int = FANOUT) -> Iterator[tuple[str, object, object]]:
    """Folds records (digest, content, value) of equal content.

    ``start(n, value)`` makes the state of the n-th distinct content and
    ``merge(state, value)`` changes it. Yields ("member", state, value) for each
    record as it comes, and ("group", digest, state) for each content when its
    state is complete. A table takes new contents up to ``memory`` bytes, at
    least one; copies of what it holds never spill, so every level gets smaller
    even if all contents share a digest. Spill files live in a folder of the
    task, which goes when the task ends, however it ends.
    """
    n = 0
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        waiting: list[tuple[int, Path | None]] = [(0, None)]
        while waiting:
            level, path = waiting.pop()
            table, files, salt = OpenTable(), {}, level.to_bytes(4, "little")
            for digest, content, value in records if path is None else _read(path):
                entry = table.get(digest, content)
                if entry is None:
                    if table.bytes >= memory:
                        to = hashlib.blake2b(digest, digest_size=2, salt=salt).digest()
                        b = int.from_bytes(to, "little") % fanout
                        if b not in files:
                            files[b] = open(Path(folder, f"{level}-{b}-{len(waiting)}-{n}"), "wb")  # noqa: SIM115
                        pickle.dump((digest, content, value), files[b], protocol=5)
                        continue
                    entry = table.add(digest, content, start(n, value))
                    n += 1
                else:
                    merge(entry[2], value)
                yield "member", entry[2], value
            for digest, _, state in table:
                yield "group", digest, state
            if path is not None:
                path.unlink()
            for f in files.values():
                f.close()
                waiting.append((level + 1, Path(f.name)))


def _read(path: Path) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _less(a: tuple, b: tuple) -> bool:
    """Order by doc_id, null last, then by place."""
    return (a[0] is None, a[0] or 0, a[1:]) < (b[0] is None, b[0] or 0, b[1:])


class _Out:
    """Rows gathered into record batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 4096, size: int = 16 << 20) -> None:
        self.schema, self.rows, self.size = schema, rows, size
        self.data, self.bytes = [], 0

    def add(self, row: tuple, size: int = 64) -> bool:
        self.data.append(row)
        self.bytes += size
        return len(self.data) >= self.rows or self.bytes >= self.size

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.data, strict=True)) or [()] * len(self.schema)
        self.data, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def _local(extra: int, out_schema: pa.Schema, memory: int):
    """First pass: rows (doc_id, text, extra columns) of one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, out = TaskContext.get().partitionId(), _Out(out_schema)

        def records():
            at = 0
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    columns = [c.to_pylist() for c in batch.slice(lo, 512).columns]
                    for row in zip(*columns, strict=True):
                        content = normalised(row[1])
                        yield hashlib.sha256(content).digest(), content, (row[0], at, row)
                        at += 1

        def start(n, value):
            return [n, 1, value]

        def merge(state, value):
            state[1] += 1
            if _less(value[:2], state[2][:2]):
                state[2] = value

        nothing = (None,) * (2 + extra)
        for kind, a, b in grace(records(), start, merge, memory):
            if kind == "member":
                full = out.add((pid, a[0], b[0], b[1], None, None, *nothing[: 2 + extra]))
            else:
                doc_id, place, row = b[2]
                full = out.add((pid, b[0], doc_id, place, b[1], a, *row), 64 + 2 * len(row[1] or ""))
            if full:
                yield out.take()
        if out.data:
            yield out.take()

    return run


def _global(out_schema: pa.Schema, memory: int):
    """Second pass: representatives (pid, slot, doc_id, place, n, text) of one digest range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(out_schema)

        def records():
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    columns = [c.to_pylist() for c in batch.slice(lo, 512).columns]
                    for pid, slot, doc_id, place, n, digest, text in zip(*columns, strict=True):
                        yield digest, normalised(text), (doc_id, pid, place, slot, n)

        def start(_, value):
            return [value[4], value[:3], [(value[1], value[3])]]

        def merge(state, value):
            state[0] += value[4]
            state[2].append((value[1], value[3]))
            if _less(value[:3], state[1]):
                state[1] = value[:3]

        for kind, a, b in grace(records(), start, merge, memory):
            if kind == "group":
                size, (keep, keep_pid, keep_place), places = b
                for pid, slot in places:
                    if out.add((pid, slot, keep, keep_pid, keep_place, size, a.hex())):
                        yield out.take()
        if out.data:
            yield out.take()

    return run


def _passes(docs: DataFrame, extra: list[str], memory: int) -> tuple[DataFrame, DataFrame, list[str]]:
    from pyspark.sql.pandas.types import to_arrow_schema

    names = ["pid", "slot", "doc", "place", "n", "digest"]
    kinds = [T.LongType(), T.LongType(), docs.schema["doc_id"].dataType, T.LongType(), T.LongType(), T.BinaryType()]
    own = [f"c{i}" for i in range(2 + len(extra))]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)] + [T.StructField(n, docs.schema[c].dataType) for n, c in zip(own, ["doc_id", "text", *extra], strict=True)])
    rows = docs.select("doc_id", "text", *[f"`{c}`" for c in extra])
    first = materialise(rows.mapInArrow(tidy(_local(len(extra), to_arrow_schema(schema), memory)), schema), "grace")
    final = T.StructType([T.StructField("pid", T.LongType()), T.StructField("slot", T.LongType()), T.StructField("keep_id", kinds[2]), T.StructField("keep_pid", T.LongType()), T.StructField("keep_place", T.LongType()), T.StructField("group_size", T.LongType()), T.StructField("sha", T.StringType())])
    reps = first.filter("digest is not null").select("pid", "slot", "doc", "place", "n", "digest", "c1").repartition(F.col("digest"))
    return first, reps.mapInArrow(tidy(_global(to_arrow_schema(final), memory)), final), own


def exact_duplicates(docs: DataFrame, memory: int = MEMORY_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    Texts are equal if they are after replacing each run of ASCII white space by
    one space; null is empty. The smallest doc_id stays; a null doc_id comes after
    all others, and of rows that repeat the smallest doc_id exactly one is kept.
    ``group_size`` counts rows. Only doc_id and text are read. An empty table
    gives no rows.
    """
    first, groups, _ = _passes(docs, [], memory)
    members = first.filter("digest is null").select("pid", "slot", "doc", "place")
    return members.join(groups, ["pid", "slot"]).select(
        F.col("doc").alias("doc_id"),
        "keep_id",
        "group_size",
        ((F.col("pid") == F.col("keep_pid")) & (F.col("place") == F.col("keep_place"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, memory: int = MEMORY_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns and original texts.

    Same rule as ``exact_duplicates``. The representatives carry their rows, so
    dropped rows are read once and never shuffled.
    """
    extra = [c for c in docs.columns if c not in ("doc_id", "text")]
    first, groups, own = _passes(docs, extra, memory)
    winners = groups.filter("pid = keep_pid").select("pid", "slot", "keep_pid", "keep_place").distinct()
    rows = first.filter("digest is not null").join(winners, ["pid", "slot"]).filter("place = keep_place")
    by_name = dict(zip(["doc_id", "text", *extra], own, strict=True))
    return rows.select(*[F.col(by_name[c]).alias(c) for c in docs.columns])
