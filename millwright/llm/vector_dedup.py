"""Near-duplicate vectors by Euclidean p-stable hashing.

Unit vectors are projected on random Gaussian directions, shifted and quantised;
a table's key is the tuple of its quantised projections. Vectors of one label
that share a key in any table are compared by exact cosine. A pair counts in the
first table where its keys agree, so counts need no list of pairs, and a bucket
passes on only a spanning forest of its links. Buckets beyond a block are split
into pairs of blocks, each its own task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise
from .components import connected_components

THRESHOLD = 0.93
#: With these, two unit vectors at cosine 0.93 share one of the keys with probability 0.997,
#: at 0.96 with 0.9998; unrelated ones share a given key with probability 0.003.
TABLES, PROJECTIONS, WIDTH = 18, 8, 2.0
BLOCK = 2048
SEED = 20240101


class Hasher:
    """The keys of unit vectors: one 64-bit integer per table."""

    def __init__(self, dim: int, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, seed: int = SEED) -> None:
        rng = np.random.default_rng([seed, dim])
        self._planes = rng.standard_normal((dim, tables * projections)) / width
        self._shift = rng.random(tables * projections)
        self._mix = rng.integers(1, 1 << 62, (tables, projections), dtype=np.int64) * 2 + 1
        self._shape = (-1, tables, projections)

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        cells = np.floor(unit @ self._planes + self._shift).astype(np.int64).reshape(self._shape)
        with np.errstate(over="ignore"):
            key = (cells * self._mix).sum(axis=2)
            return key ^ (key >> 29)


def _vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, vector in double precision) of the rows that can link: no null, finite, not zero."""
    for i, x in enumerate(column):
        if not x.is_valid or len(x) == 0 or x.values.null_count:
            continue
        v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(v).all() and v.any():
            yield i, v


def _classes(kind: str):
    """(vec_id, label, embedding) to (vec_id, label, class key, vector in its own precision); both null where nothing can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raws = [None] * batch.num_rows, [None] * batch.num_rows
            labels = batch.column(1).to_pylist()
            ids = batch.column(0)
            for i, v in _vectors(batch.column(2)):
                if labels[i] is None or not ids[i].is_valid:
                    continue
                raws[i] = (v + 0.0).astype(kind).tobytes()
                keys[i] = hashlib.blake2b(raws[i], digest_size=16, key=str(labels[i]).encode()[:64]).digest()
            yield pa.RecordBatch.from_arrays([ids, pa.array(labels, batch.schema.field(1).type), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())], names=["vec_id", "label", "class", "raw"])

    return run


def _units(raws: list[bytes], dim: int, kind: str) -> np.ndarray:
    """Unit vectors in double precision."""
    v = np.frombuffer(b"".join(raws), kind).astype(np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _keys(kind: str, options: dict):
    """(class, label, vector) to (label, table, key, class), one row per table; vectors stay behind."""
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                cls, label, raw = (c.to_pylist() for c in batch.slice(lo, 1024).columns)
                dims = np.array([len(u) // width for u in raw])
                for dim in np.unique(dims):
                    rows = np.flatnonzero(dims == dim)
                    h = hashers.setdefault(int(dim), Hasher(int(dim), **options))
                    keys = h(_units([raw[i] for i in rows], int(dim), kind))
                    k, tables = len(rows), keys.shape[1]
                    pick = lambda x: [x[i] for i in rows for _ in range(tables)]  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pick(label), batch.schema.field(1).type), pa.array(np.tile(np.arange(tables, dtype=np.int32), k)), pa.array(keys.ravel()), pa.array(pick(cls), pa.binary())],
                        names=["label", "table", "key", "class"],
                    )

    return run


class Forest:
    """Union-find over small integers; ``join`` tells whether two sets became one."""

    def __init__(self, n: int) -> None:
        self._up = list(range(n))

    def root(self, i: int) -> int:
        up = self._up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self._up[max(i, j)] = min(i, j)
        return i != j


def bucket_links(units: np.ndarray, keys: np.ndarray, m: np.ndarray, table: int, side: np.ndarray, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links per vector, weighted by copies, and a forest, of one bucket or pair of blocks.

    ``side`` is all 0 for a bucket or a block with itself; for two blocks it is 0
    and 1, and only pairs across count.
    """
    n = len(units)
    counts, forest, edges = np.zeros(n, np.int64), Forest(n), []
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if side.any() else left
    for lo in range(0, len(left), 512):
        rows = left[lo : lo + 512]
        near = units[rows] @ units[right].T >= threshold
        i, j = np.nonzero(near)
        i, j = rows[i], right[j]
        keep = i < j if right is left else np.ones(len(i), bool)
        i, j = i[keep], j[keep]
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            if table:
                new = ~(keys[a, :table] == keys[b, :table]).any(axis=1)
                a, b = a[new], b[new]
            np.add.at(counts, a, m[b])
            np.add.at(counts, b, m[a])
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                if forest.join(x, y):
                    edges.append((x, y))
    return counts, edges


def _compare(threshold: float, kind: str, options: dict):
    """One group (label, table, key, blocks) to link counts and forest edges."""
    width = np.dtype(kind).itemsize

    def run(group: pa.Table) -> pa.Table:
        cls, raw = group.column("class").to_pylist(), group.column("raw").to_pylist()
        m, side = group.column("m").to_numpy(), group.column("side").to_numpy()
        table, out = group.column("table")[0].as_py(), []
        dims = np.array([len(u) // width for u in raw])
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            if len(rows) < 2:
                continue
            units = _units([raw[i] for i in rows], int(dim), kind)
            keys = Hasher(int(dim), **options)(units)
            counts, edges = bucket_links(units, keys, m[rows], table, side[rows], threshold)
            out += [(cls[rows[i]], None, int(counts[i])) for i in np.flatnonzero(counts)]
            out += [(cls[rows[i]], cls[rows[j]], 0) for i, j in edges]
        a, b, n = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(n, pa.int64())})

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, **options) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Two vectors link if their labels are equal and not null, they have as many
    components, and their cosine in double precision is at least ``threshold``
    (found with the probability of the hashing, never below the threshold).
    Vectors that are null, empty, zero, or hold null or non-finite components,
    and rows with a null label or vec_id, link with nothing: n_links 0, a
    component of their own, kept unless the vec_id is null. Equal vectors are
    one class that always links; rows that repeat a vec_id count as vectors of
    their own. Other columns are not read; an empty table gives no rows.
    ``options`` go to ``Hasher``.
    """
    fields = vectors.schema
    schema = T.StructType([T.StructField("vec_id", fields["vec_id"].dataType), T.StructField("label", fields["label"].dataType), T.StructField("class", T.BinaryType()), T.StructField("raw", T.BinaryType())])
    kind = "<f4" if isinstance(fields["embedding"].dataType.elementType, T.FloatType) else "<f8"
    rows = materialise(vectors.select("vec_id", "label", "embedding").mapInArrow(_classes(kind), schema), "vectors")
    able = rows.filter("class is not null")
    classes = able.groupBy("class", "label").agg(F.count("*").alias("m"), F.min("vec_id").alias("first"), F.first("raw").alias("raw"))
    classes = materialise(classes, "classes")
    label_type = fields["label"].dataType
    keyed = classes.select("class", "label", "raw").mapInArrow(_keys(kind, options), T.StructType([T.StructField("label", label_type), T.StructField("table", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("class", T.BinaryType())]))
    keyed = materialise(keyed, "keyed")
    sizes = keyed.groupBy("label", "table", "key").agg(F.count("*").alias("size")).filter("size > 1")
    keyed = keyed.join(sizes, ["label", "table", "key"])
    blocks = F.ceil(F.col("size") / block)
    own = F.pmod(F.xxhash64("class"), blocks).cast("int")
    cells = keyed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    cells = cells.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    cells = cells.withColumn("side", F.when(F.col("own") == F.col("lo"), 0).otherwise(1))
    cells = cells.drop("label").join(classes.select("class", "label", "m", "raw"), "class")  # vectors go to shared buckets only
    found = cells.groupBy("label", "table", "key", "lo", "hi").applyInArrow(_compare(threshold, kind, options), "a binary, b binary, n long")
    found = materialise(found, "links")
    links = found.filter("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    parts = connected_components(found.filter("b is not null").select("a", "b"))
    whole = classes.join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    smallest = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    info = whole.join(smallest, "component").join(links, "class", "left").select("class", "component_id", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    linked = able.select("vec_id", "class").join(info, "class").select("vec_id", "n_links", "component_id")
    alone = rows.filter("class is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    done = linked.union(alone)
    return done.select("vec_id", "n_links", F.col("component_id").cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
