"""Packing token ids into fixed windows by minimum bin slack.

Whole windows are cut off long documents. What remains of each document waits in
a pool; for every window a bitset dynamic programme over the multiset of waiting
lengths finds the sum closest to the capacity, and walking its steps backwards
gives how many pieces of each length to take. Each task packs its own partition,
so nothing is shuffled and the pool, not the input, bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import trim
from .tokens import encoder, text_slices

WINDOW = 2048
POOL_PIECES = 4096
VOCABULARY = "word_bpe_49k.json"
END_ID = 1


def best_fill(counts: dict[int, int], capacity: int, first: int | None = None) -> dict[int, int]:
    """Copies of each length whose sum is the largest within ``capacity``.

    ``first`` is a length of which one copy must be used. Bit s of ``reach`` says
    that a sum of s is possible. Copies of a length enter in bundles of 1, 2, 4,
    ... so that a step is one shift; the bits before each step are kept for the
    walk back. The search ends as soon as the capacity itself is reached.
    """
    reach, full, steps = 1, (1 << (capacity + 1)) - 1, []
    taken: dict[int, int] = {}
    if first is not None:
        reach, taken[first] = 1 << first, 1
    top = 1 << capacity
    room = capacity - (first or 0)
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left = min(counts[length] - taken.get(length, 0), capacity // length)
        bundle = 1
        while left > 0 and not reach & top:
            k = min(bundle, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & full
            left -= k
            bundle *= 2
        if reach & top:
            break
    at = reach.bit_length() - 1
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            taken[length] = taken.get(length, 0) + k
            at -= length * k
    return taken


class Pool:
    """Waiting pieces by length; gives out full windows."""

    def __init__(self, window: int) -> None:
        self.window, self.by_length, self.counts, self.pieces = window, {}, {}, 0

    def add(self, piece: tuple, length: int) -> None:
        self.by_length.setdefault(length, []).append(piece)
        self.counts[length] = self.counts.get(length, 0) + 1
        self.pieces += 1

    def pop(self, length: int) -> tuple:
        self.pieces -= 1
        self.counts[length] -= 1
        piece = self.by_length[length].pop()
        if not self.counts[length]:
            del self.counts[length], self.by_length[length]
        return piece

    def fill(self) -> tuple[list[tuple], int]:
        """The pieces of the next window and their total; it holds the longest piece."""
        chosen = best_fill(self.counts, self.window, max(self.counts))
        out = [self.pop(length) for length, k in chosen.items() for _ in range(k)]
        return out, sum(length * k for length, k in chosen.items())


def windows(pieces: Iterator[tuple[int, int, int]], window: int, pool_pieces: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) from pieces no longer than ``window``.

    A window that the waiting pieces cannot fill is completed with the head of the
    longest of them. What is left at the end is cut at powers of two, which need
    no padding.
    """
    pool = Pool(window)

    def drain(until: int) -> Iterator[list[tuple]]:
        while pool.pieces > until:
            chosen, total = pool.fill()
            if total < window and pool.counts:
                doc, start, length = pool.pop(max(pool.counts))
                gap = window - total
                head = min(gap, length)
                chosen.append((doc, start, head))
                if length > head:
                    pool.add((doc, start + head, length - head), length - head)
                total += head
            if total == window or pool.counts:
                yield chosen
            else:
                yield from _powers(chosen, total)

    for piece in pieces:
        if piece[2] == window:
            yield [piece]
        else:
            pool.add(piece, piece[2])
            if pool.pieces >= pool_pieces:
                yield from drain(pool_pieces // 2)
    yield from drain(0)


def _powers(chosen: list[tuple], total: int) -> Iterator[list[tuple]]:
    queue = list(reversed(chosen))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out = []
        while room:
            doc, start, length = queue.pop()
            k = min(room, length)
            out.append((doc, start, k))
            room -= k
            if length > k:
                queue.append((doc, start + k, length - k))
        yield out


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, end_id: int = END_ID, pool_pieces: int = POOL_PIECES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers. A
    document is its text's ids and then ``end_id``; a null or empty text is just
    that id. Every id lies in exactly one piece; pieces of a sequence follow each
    other without a gap. A sequence is full or its length is a power of two, so
    none needs padding. ``sequence_id`` is the partition's number times 2^32 plus
    a running number. Rows that repeat are packed one by one, a null doc_id stays
    null, an empty table gives no rows, other columns are not read.
    """
    import public_tokenizers

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        encode, out_schema = encoder(path, leading=False), to_arrow_schema(schema)
        end = np.array([end_id], "<u4").tobytes()
        waiting: dict[int, list] = {}  # documents with ids that no window holds yet: [doc_id, tokens, ids left, ids]

        def pieces():
            n = 0
            for ids, texts in text_slices(batches):
                for doc_id, raw in zip(ids, encode(texts), strict=True):
                    raw += end
                    tokens = len(raw) // 4
                    waiting[n] = [doc_id, tokens, tokens, raw]
                    for start in range(0, tokens, window):
                        yield n, start, min(window, tokens - start)
                    n += 1

        sequence, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for chosen in windows(pieces(), window, pool_pieces):
            offset = 0
            for n, start, length in chosen:
                doc = waiting[n]
                rows.append((doc[0], start, length, doc[3][4 * start : 4 * (start + length)], doc[1], sequence, offset))
                offset += length
                doc[2] -= length
                if not doc[2]:
                    del waiting[n]
            sequence += 1
            size += offset
            if size >= 1 << 20:
                yield _batch(rows, out_schema)
                rows, size = [], 0
        if rows:
            yield _batch(rows, out_schema)
        del rows
        trim()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
