"""Jaccard self-join on word shingles with a token-group matrix.

Documents with equal shingle sets are one set. Similar sets are put into groups
whose members are linked to each other, and the matrix says which groups hold a
shingle. A query set can only link into a group that holds enough of its
shingles, so only such groups are opened.

The matrix is stored by its rows, shingle to groups, and only on rare shingles:
in any fixed order of the shingles two sets with Jaccard similarity t share c
of their first |X| - ceil(t |X|) + c. The order is by a sketch of fixed size that
counts the shingles which recur within a block of documents, so that common
passages come last; it steers cost only, the result is exact for any sketch. A
candidate group's full union is formed when its texts are at hand, and bounds
each query's overlap before any member is compared.

Only components are asked for, so two groups need one link, not all of them, and
groups already in one component need none. A matrix row pairs its groups with the
first few of them: a first round compares each group with the one of these that
it shares most with, the second with the rest of them, the third any two groups
of a long row, and each round leaves out groups that are in one component.

Before texts travel, parity bitmaps of the sets (about two bits per shingle) bound
each overlap from above: sets that differ in more bits than links allow are out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_scratch, materialise, stored, tidy
from .components import connected_components, merged_components
from .shingles import Shingler, overlap, set_id
from .tokens import text_slices

WORDS = 5
#: Similarity as hundredths, so that the test stays in integers.
PERCENT = 75
#: Cells of the count sketch and pieces in which it travels; both fixed.
CELL_BITS, SLICES = 21, 64
#: Sets held at once while a task forms groups, and the most members of a group.
BLOCK_SETS, GROUP_SETS = 4096, 32
#: First groups of a matrix row that all its groups are paired with; longer rows come again in the third round.
LEADS = 8
#: Rare shingles that linked sets share at least, if they have so many in common at all.
LEAST_SHARED = 4
#: Shingles of a block in which recurring ones are counted.
BLOCK_SHINGLES = 1 << 20
#: Groups of a matrix row that meet in one task in the third round; longer rows are cut into pairs of blocks.
ROW_BLOCK = 1024
#: Bits of the filter that spares texts of unasked documents the way; fixed.
FILTER_BITS = 23


def links(inter: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * inter >= percent * (a + b - inter) and inter > 0


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """The fewest shingles that a set of n shares with any set that it links with."""
    return -(-percent * n // 100)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """The fewest rare shingles that a set of n shares with any set that it links with and that needs no fewer."""
    return min(LEAST_SHARED, least_overlap(n, percent))


def _recurring(sets: list[np.ndarray], cells: np.ndarray) -> None:
    """Adds the counts of shingles that stand in more than one of ``sets``."""
    x, n = np.unique(np.concatenate(sets), return_counts=True)
    x, n = x[n > 1], n[n > 1]
    np.add.at(cells, (x >> np.uint64(64 - CELL_BITS)).astype(np.int64), n.astype(np.uint32))


def _profile(words: int):
    """(doc_id, text) to one row per document, and the task's sketch in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, cells = Shingler(words), np.zeros(1 << CELL_BITS, np.uint32)
        block, size, any_row = [], 0, False
        for ids, texts in text_slices(batches):
            sets = list(shingler.sets(texts))
            block += sets
            size += sum(map(len, sets))
            if size >= BLOCK_SHINGLES:
                _recurring(block, cells)
                block, size = [], 0
            k = len(ids)
            yield _rows(ids, [len(s) for s in sets], [set_id(s) if len(s) else None for s in sets], [None] * k, [None] * k)
            any_row = True
        if block:
            _recurring(block, cells)
        if any_row:
            for i, part in enumerate(np.split(cells, SLICES)):
                yield _rows([None], [None], [None], [i], [zlib.compress(np.minimum(part, 65535).astype("<u2").tobytes(), 1)])

    return run


def _rows(ids, n, sid, piece, blob) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(piece, pa.int32()), pa.array(blob, pa.binary())], names=["doc_id", "n", "sid", "piece", "blob"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the slices of sketches, slice by slice of a partition."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zlib.decompress(blob), "<u2").astype(np.int64)
            sums[piece] = sums[piece] + part if piece in sums else part
    if sums:
        yield pa.RecordBatch.from_pydict({"piece": pa.array(list(sums), pa.int32()), "blob": pa.array([zlib.compress(np.minimum(v, 2**32 - 1).astype("<u4").tobytes()) for v in sums.values()], pa.binary())})


def _sketch(profile: DataFrame) -> np.ndarray:
    """The sketch of all documents: 2^CELL_BITS counts, whatever the size of the input."""
    parts = profile.filter("piece is not null").select("piece", "blob").repartition(SLICES, "piece").mapInArrow(tidy(_added), "piece int, blob binary")
    out = np.zeros((SLICES, (1 << CELL_BITS) // SLICES), np.uint32)
    for row in parts.collect():
        out[row[0]] = np.frombuffer(zlib.decompress(bytes(row[1])), "<u4")
    return out.ravel()


def rare_first(s: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of which any set that links with s must share ``least_shared`` within its own such part."""
    keep = len(s) - least_overlap(len(s), percent) + least_shared(len(s), percent)
    count = sketch[(s >> np.uint64(64 - sketch.size.bit_length() + 1)).astype(np.int64)]
    return s[np.lexsort((s, count))[:keep]]


def parity(s: np.ndarray) -> bytes:
    """A bitmap that holds, per bit, whether an odd number of shingles falls on it."""
    bits = max(64, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(n: int, a: bytes, m: int, b: bytes, percent: int = PERCENT) -> bool:
    """Whether sizes and parity bitmaps of two sets leave a link possible.

    Sets that link share at least percent / (100 + percent) of their sizes' sum,
    so they differ in at most the rest, and so do their bitmaps.
    """
    if 100 * min(n, m) < percent * max(n, m):
        return False
    most = n + m - 2 * -(-percent * (n + m) // (100 + percent))
    x, y, size = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * min(len(a), len(b))
    x, y = _folded(x, 8 * len(a), size), _folded(y, 8 * len(b), size)
    return (x ^ y).bit_count() <= most


def _folded(x: int, bits: int, to: int) -> int:
    while bits > to:
        bits //= 2
        x = (x >> bits) ^ (x & ((1 << bits) - 1))
    return x


class Groups:
    """Groups of the sets that one task holds at a time."""

    def __init__(self, percent: int, sketch: np.ndarray, part: int, block: int) -> None:
        self.percent, self.sketch, self.base = percent, sketch, part << 39 | block << 13
        self.index: dict[int, int] = {}
        self.seen: set[int] = set()
        self.lead: list[tuple[int, np.ndarray]] = []
        self.members: list[list[tuple[int, int, bytes]]] = []
        self.shingles: list[set[int]] = []
        self.beside: list[tuple[int, int]] = []
        self.weight: list[int] = []

    def name(self, g: int) -> int:
        """The task, its block and a running number: near numbers take few bytes in a shuffle."""
        return self.base | g

    def add(self, sid: int, s: np.ndarray) -> None:
        if sid in self.seen:
            return
        self.seen.add(sid)
        rare = rare_first(s, self.sketch, self.percent).tolist()
        hits: dict[int, int] = {}
        for x in rare:
            if (g := self.index.get(x)) is not None:
                hits[g] = hits.get(g, 0) + 1
        home = None
        for g in sorted(hits, key=hits.get, reverse=True)[:4]:  # more would only move work between rounds
            lead = self.lead[g][1]
            if links(overlap(s, lead), len(s), len(lead), self.percent):
                home = g
                break
        if home is None or len(self.members[home]) >= GROUP_SETS:
            if home is not None:
                self.beside.append((len(self.lead), home))
            home = len(self.lead)
            self.lead.append((sid, s))
            self.members.append([])
            self.shingles.append(set())
            self.weight.append(1)
        self.members[home].append((sid, len(s), parity(s)))
        if least_shared(len(s), self.percent) < LEAST_SHARED:
            self.weight[home] = LEAST_SHARED  # too small to share so many: one is enough
        self.shingles[home].update(rare)
        for x in rare:
            self.index[x] = home

    def batches(self) -> Iterator[pa.RecordBatch]:
        """Rows (shingle, gid, weight), then (gid, sid, size, bitmap) of members, then (gid, gid) of linked groups."""
        names = [self.name(g) for g in range(len(self.lead))]
        for lo in range(0, len(names), 512):
            part = range(lo, min(lo + 512, len(names)))
            sizes = [len(self.shingles[g]) for g in part]
            token = np.concatenate([np.fromiter(self.shingles[g], np.uint64, len(self.shingles[g])) for g in part])
            gid = np.repeat(np.array([names[g] for g in part], np.int64), sizes)
            yield _entries(0, token.view(np.int64), gid, np.repeat(np.array([self.weight[g] for g in part], np.int32), sizes))
        rows = [(names[g], *m) for g, own in enumerate(self.members) for m in own]
        for lo in range(0, len(rows), 4096):
            a, b, n, bits = zip(*rows[lo : lo + 4096], strict=True)
            yield _entries(1, np.array(a, np.int64), np.array(b, np.int64), n, bits)
        if self.beside:
            yield _entries(2, np.array([names[g] for g, _ in self.beside], np.int64), np.array([names[h] for _, h in self.beside], np.int64))


def _entries(kind: int, a: np.ndarray, b: np.ndarray, n=None, bits=None) -> pa.RecordBatch:
    nothing = pa.nulls(len(a), pa.int32()) if n is None else pa.array(n, pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a), pa.array(b), nothing, pa.nulls(len(a), pa.binary()) if bits is None else pa.array(bits, pa.binary())], names=["kind", "a", "b", "n", "bits"])


def _group(words: int, percent: int, sketch) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shingler, part, block, held, size = Shingler(words), TaskContext.get().partitionId(), 0, None, 0
        for ids, texts in text_slices(batches):
            for doc_id, s in zip(ids, shingler.sets(texts), strict=True):
                if doc_id is None or not len(s):
                    continue
                if held is None:
                    held, size = Groups(percent, sketch.value, part, block), 0
                held.add(set_id(s), s)
                size += len(s)
                if len(held.seen) >= BLOCK_SETS or size >= 4 << 20:
                    yield from held.batches()
                    held, block = None, block + 1
        if held:
            yield from held.batches()

    return run


ROWS = "kind byte, a long, b long, n int, bits binary"
SHARED = "kind byte, a long, b long, n int, bits binary, lead long, first boolean, far boolean"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matrix rows sorted by shingle and gid to the shingles that several groups hold; other kinds pass.

    Each group of a shingle meets the first ``LEADS`` groups before it: b is the
    group, n the larger of the two weights, ``first`` marks one row per group.
    ``far`` marks rows of shingles with more than ``LEADS`` + 1 groups, of which
    not all pairs are made; ``lead`` of their first row is the row's first group.
    What is carried from batch to batch is at most ``LEADS`` + 1 entries.
    """
    held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    done = 0  # entries of the held shingle whose rows are already out

    def rows(a, b, w, skip: int) -> Iterator[pa.RecordBatch]:
        start = np.append(True, a[1:] != a[:-1])
        first = np.maximum.accumulate(np.where(start, np.arange(len(a)), 0))
        rank = np.arange(len(a)) - first
        far = np.diff(np.append(np.flatnonzero(start), len(a)))[np.cumsum(start) - 1] > LEADS + 1
        fresh = np.arange(len(a)) >= skip
        for j in range(LEADS):
            at = np.flatnonzero((rank > j) & fresh)
            if not len(at):
                return
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(at), np.int8)), pa.array(a[at]), pa.array(b[at]), pa.array(np.maximum(w[at], w[first[at] + j])), pa.nulls(len(at), pa.binary()), pa.array(b[first[at] + j]), pa.array(np.full(len(at), j == 0)), pa.array(far[at])],
                names=["kind", "a", "b", "n", "bits", "lead", "first", "far"],
            )

    for batch in batches:
        kind = batch.column(0).to_numpy()
        others = batch.filter(pa.array(kind != 0))
        if others.num_rows:
            k = others.num_rows
            yield pa.RecordBatch.from_arrays([*others.columns, pa.nulls(k, pa.int64()), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.bool_())], names=["kind", "a", "b", "n", "bits", "lead", "first", "far"])
        batch = batch.filter(pa.array(kind == 0))
        if not batch.num_rows:
            continue
        a, b, w = (np.concatenate([x, batch.column(i).to_numpy()]) for i, x in zip((1, 2, 3), held, strict=True))
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        a, b, w = a[new], b[new], w[new]
        tail = int(np.flatnonzero(np.append(True, a[1:] != a[:-1]))[-1])
        upto = len(a) if len(a) - tail > LEADS + 1 else tail
        if upto:
            yield from rows(a[:upto], b[:upto], w[:upto], done)
        more = upto == len(a)
        held = tuple(x[tail : tail + LEADS + 2] if more else x[tail:] for x in (a, b, w))
        if more and len(a) - tail > LEADS + 2:
            held = tuple(np.append(x, y[-1]) for x, y in zip(held, (a, b, w), strict=True))  # the last entry tells repeats
        done = len(held[0]) if more else 0
    if len(held[0]) > done:
        yield from rows(*held, done)


def _bits(lists: pa.ChunkedArray) -> list[int]:
    """Each list of one table as a set of bits; an element that only one list holds has no bit."""
    column = lists.combine_chunks()
    flat, at = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.append(0, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    bit = np.cumsum(times > 1) - 1
    out = []
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        of = place[lo:hi]
        on = np.zeros(int(bit[-1]) + 1 if len(bit) else 0, bool)
        on[bit[of[times[of] > 1]]] = True
        out.append(int.from_bytes(np.packbits(on, bitorder="little").tobytes(), "little"))
    return out


def _across(percent: int):
    """Groups of one matrix row, or of two blocks of it, to the pairs of unlike components that may link.

    ``before`` holds the smaller shingles of the group's other open rows. Groups
    that meet in several rows are a pair in the first of these only, so each pair
    is formed and bounded once; only what the bitmaps leave is passed on.
    """

    def run(row: pa.Table) -> pa.Table:
        gid, part, side = (row.column(c).to_pylist() for c in ("gid", "part", "side"))
        sets = [[(m["n"], m["bits"]) for m in own] for own in row.column("members").to_pylist()]
        before = _bits(row.column("before"))
        two, found = any(side), []
        for i in range(len(gid)):
            for j in range(i):
                if part[i] == part[j] or (two and side[i] == side[j]) or before[i] & before[j]:
                    continue
                if any(may_link(n, a, m, b, percent) for n, a in sets[i] for m, b in sets[j]):
                    found.append((min(gid[i], gid[j]), max(gid[i], gid[j])))
        g, h = zip(*found, strict=True) if found else ((), ())
        return pa.table({"g": pa.array(g, pa.int64()), "h": pa.array(h, pa.int64())})

    return run


def _bounded(percent: int):
    """(gid, members, gid, members) of candidate pairs to those that sizes and bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, h = [], []
            for lo in range(0, batch.num_rows, 256):
                for x, of_x, y, of_y in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns), strict=True):
                    if any(may_link(a["n"], a["bits"], b["n"], b["bits"], percent) for a in of_x for b in of_y):
                        g.append(x)
                        h.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(h, pa.int64())], names=["g", "h"])

    return run


def _asked_only(bitmap):
    """Rows whose doc_id the fixed-size filter does not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(bitmap.value, bitorder="little").view(bool)
        for batch in batches:
            yield batch.filter(pa.array(bits[batch.column(0).to_numpy()])).select(["doc_id", "text"])

    return run


def _filtered(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` without most documents that ``ids`` lacks, by a bitmap of fixed size."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    words = ids.select(place.alias("p")).groupBy(F.floor(F.col("p") / 32).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 32 as int)))").alias("v"))
    found = words.toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 5), "<u4")
    bitmap[found.w.to_numpy(np.int64)] = found.v.to_numpy(np.int64).astype("<u4")
    held = texts.sparkSession.sparkContext.broadcast(bitmap.view(np.uint8))
    rows = texts.filter("doc_id is not null").select(place.alias("p"), "doc_id", "text")
    return rows.mapInArrow(tidy(_asked_only(held)), "doc_id long, text string")


def group_link(a: dict[int, np.ndarray], b: dict[int, np.ndarray], percent: int = PERCENT) -> tuple[int, int] | None:
    """A link between two groups (set name to set), or None if there is none.

    Each query set of the smaller group is held against the union of the other
    first; the group is opened only for queries that the union leaves a chance.
    """
    if len(a) > len(b):
        found = group_link(b, a, percent)
        return found and found[::-1]
    for sid in a:
        if sid in b:
            return sid, sid
    one = len(b) == 1
    union = next(iter(b.values())) if one else np.unique(np.concatenate(list(b.values())))
    for sid, q in a.items():
        if overlap(q, union) < least_overlap(len(q), percent):
            continue
        for other, s in b.items():
            small, large = sorted((len(q), len(s)))
            if 100 * small >= percent * large and links(overlap(q, s), len(q), len(s), percent):
                return sid, other
    return None


def _open(words: int, percent: int):
    """(gid, texts, gid, texts) of candidate pairs to the links found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held = Shingler(words), {}

        def compared(rows: list[tuple]) -> pa.RecordBatch:
            """Linked groups among some pairs; all their texts are shingled at once, those of the last pairs are at hand."""
            nonlocal held
            members = {gid: own for g, of_g, h, of_h in rows for gid, own in ((g, of_g), (h, of_h))}
            new = [(gid, m["sid"], m["text"]) for gid, own in members.items() if gid not in held for m in own]
            held = {gid: held.get(gid, {}) for gid in members}
            for (gid, sid, _), s in zip(new, shingler.sets([t for _, _, t in new]), strict=True):
                if set_id(s) == sid:
                    held[gid][sid] = s
            found = [(g, h) for g, _, h, _ in rows if group_link(held[g], held[h], percent)]
            a, b = np.array(found, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(a)), pa.array(np.ascontiguousarray(b))], names=["u", "v"])

        for batch in batches:
            rows, size = [], 0
            for lo in range(0, batch.num_rows, 32):
                for row in zip(*(c.to_pylist() for c in batch.slice(lo, 32).columns), strict=True):
                    rows.append(row)
                    size += sum(len(m["text"] or "") for own in (row[1], row[3]) for m in own)
                    if size >= 2 << 20 or len(rows) >= 512:
                        yield compared(rows)
                        rows, size = [], 0
            if rows:
                yield compared(rows)

    return run


def shingle_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    A set holds the distinct shingles of ``words`` words; a text with fewer words
    has its whole sequence as its one shingle, an empty or null text has none and
    links with nothing. Two sets link if 100 * intersection >= percent * union.
    ``component_id`` is the smallest doc_id reachable by links, itself included.
    A row without a doc_id links with nothing and has a null component. Rows that
    repeat a doc_id have the component of their own text. Only doc_id and text
    are read; an empty table gives no rows. Sets are compared by 64-bit hashes of
    their shingles.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profile = materialise(texts.mapInArrow(tidy(_profile(words)), "doc_id long, n long, sid long, piece int, blob binary"), "profile")
    rows = profile.filter("piece is null").select("doc_id", "n", "sid")
    known = rows.filter("doc_id is not null and sid is not null")
    owners = known.groupBy("sid").agg(F.min("doc_id").alias("first"))
    of_set = set_components(texts, owners, spark.sparkContext.broadcast(_sketch(profile)), words, percent)
    linked = known.join(of_set, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("doc_id is null or sid is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.union(alone)


def one_per_component(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its smallest doc_id, with all columns.

    Rows without a doc_id or without words stay. Rows that repeat the kept doc_id
    all stay; exact copies are another operator's work.
    """
    found = shingle_components(docs, words, percent)
    gone = found.filter("component_id != doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")


def set_components(texts: DataFrame, owners: DataFrame, sketch, words: int, percent: int) -> DataFrame:
    """sid, component_id: the smallest doc_id of the component of each set; ``owners`` has sid, first (doc_id)."""
    made = texts.mapInArrow(tidy(_group(words, percent, sketch)), ROWS)
    made = made.repartition("a").sortWithinPartitions("a", "b").mapInArrow(tidy(_shared), SHARED)
    made = materialise(made, "matrix")
    members = made.filter("kind = 1").select(F.col("a").alias("gid"), F.col("b").alias("sid"), "n", "bits")
    inside = made.filter("kind = 2").select(F.col("a").alias("u"), F.col("b").alias("v"))
    shared = made.filter("kind = 0").select(F.col("a").alias("token"), F.col("b").alias("gid"), "lead", F.col("n").alias("w"), "first", "far")

    def both_sides(pairs: DataFrame, of: DataFrame) -> DataFrame:
        left = of.select(F.col("gid").alias("g"), F.col("members").alias("of_g"))
        right = of.select(F.col("gid").alias("h"), F.col("members").alias("of_h"))
        return pairs.join(left, "g").join(right, "h").select("g", "of_g", "h", "of_h")

    def groups(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("g").alias("gid")).union(pairs.select("h")).distinct()

    def marks(asked: DataFrame) -> DataFrame:
        return members.join(asked, "gid").groupBy("gid").agg(F.collect_list(F.struct("sid", "n", "bits")).alias("members"))

    def bounded(pairs: DataFrame) -> DataFrame:
        return both_sides(pairs, marks(groups(pairs))).mapInArrow(tidy(_bounded(percent)), "g long, h long")

    def opened(pairs: DataFrame) -> DataFrame:
        """Links (gid, gid) found in pairs of groups that bitmaps do not rule out."""
        left, left_path = stored(pairs, "bounded")
        where, where_path = stored(members.select("gid", "sid").join(groups(left), "gid").join(owners, "sid").select("gid", "sid", F.col("first").alias("doc_id")), "asked")
        load = where.join(_filtered(texts, where), "doc_id").groupBy("gid").agg(F.collect_list(F.struct("sid", "text")).alias("members"))
        load, load_path = stored(load, "members")
        found = materialise(both_sides(left, load).mapInArrow(tidy(_open(words, percent)), "u long, v long"), "found")
        for path in (left_path, where_path, load_path):
            drop_scratch(texts.sparkSession, path)
        return found

    first = shared.groupBy(F.col("lead").alias("g"), F.col("gid").alias("h")).agg(F.sum("w").alias("s")).filter(F.col("s") >= LEAST_SHARED)
    first = materialise(first, "pairs")
    best = first.groupBy("h").agg(F.max_by("g", F.struct("s", "g")).alias("g")).select("g", "h")
    same = members.groupBy("sid").agg(F.min("gid").alias("v"))
    same = members.select("sid", F.col("gid").alias("u")).join(same, "sid").select("u", "v").filter("u != v")
    parts = materialise(connected_components(inside.union(same).union(opened(bounded(best)))), "parts")

    def part_of(name: str, parts: DataFrame) -> DataFrame:
        return parts.select(F.col("node").alias(name), F.col("component").alias(f"{name}_part"))

    rest = first.select("g", "h").join(part_of("g", parts), "g", "left").join(part_of("h", parts), "h", "left")
    rest = rest.filter("coalesce(g_part, g) != coalesce(h_part, h)").select("g", "h")
    parts = materialise(merged_components(parts, opened(bounded(rest))), "parts")
    far = shared.filter("first and far")
    far = far.select("token", "gid").union(far.select("token", "lead").distinct())
    far = far.join(part_of("gid", parts), "gid", "left").select("token", "gid", F.coalesce("gid_part", "gid").alias("part"))
    mixed = far.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("gid")).alias("held_by")).filter("lo != hi")
    mixed = mixed.groupBy("held_by", "n").agg(F.min("token").alias("token")).select("token", "n")  # shingles of one passage have the same row
    entries = materialise(far.join(mixed, "token"), "open")
    blocks = F.ceil(F.col("n") / ROW_BLOCK).cast("int")
    cells = entries.withColumn("own", F.pmod(F.xxhash64("gid"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cells = cells.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}).withColumn("side", (F.col("own") != F.col("lo")).cast("int"))
    rows_of = entries.groupBy("gid").agg(F.collect_list("token").alias("tokens"))
    cells = cells.join(marks(entries.select("gid").distinct()), "gid").join(rows_of, "gid")
    cells = cells.withColumn("before", F.filter("tokens", lambda t: t < F.col("token"))).select("token", "lo", "hi", "gid", "part", "side", "members", "before")
    across = cells.groupBy("token", "lo", "hi").applyInArrow(_across(percent), "g long, h long")
    parts = merged_components(parts, opened(across))
    at = members.groupBy("sid").agg(F.min("gid").alias("gid")).join(owners, "sid")
    named = at.join(parts.withColumnRenamed("node", "gid"), "gid", "left").select("sid", "first", F.coalesce("component", "gid").alias("part"))
    smallest = named.groupBy("part").agg(F.min("first").alias("component_id"))
    return named.join(smallest, "part").select("sid", "component_id")
