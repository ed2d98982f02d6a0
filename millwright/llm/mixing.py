"""Mixing sources to target weights, as one declarative plan.

A golden-ratio sequence of points falls on the cumulative target shares of the
sources; each point is a slot of the training order. Ranking a source's slots
says which block of that source's shuffled word stream a slot takes, and blocks
hold equally many words. Everything below is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialise

#: The unit interval has 2^31 steps; STEP is the odd number next to 2^31 / golden ratio.
UNIT = 1 << 31
STEP = 1327217885

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 1024
OVERALL = 1.5
CAP = 2


def words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """A key that is never null: '' for null, else '=' and the source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def keyed(doc_id: Column, source: Column, text: Column, seed: str) -> list[Column]:
    """doc_id, src, size and key of a document; key, the md5 of seed and doc_id, shuffles its source."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    return [doc_id.alias("doc_id"), _source_key(source).alias("src"), words(text).alias("size"), F.md5(F.concat(F.lit(f"{seed}:"), name)).alias("key")]


def sized(docs: DataFrame, seed: str, rows_per_bucket: int = 1000) -> DataFrame:
    """doc_id, src, size, key, bucket: one row per document with its place in the shuffle.

    ``bucket`` is a prefix of the key, long enough that a source holding all rows
    still has about ``rows_per_bucket`` rows in each.
    """
    rows = materialise(docs.select(*keyed(F.col("doc_id"), F.col("source"), F.col("text"), seed)), "sized")
    n, digits = rows.count(), 1
    while 16**digits * rows_per_bucket < n and digits < 8:
        digits += 1
    return rows.withColumn("bucket", F.substring("key", 1, digits))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, overall: float = OVERALL, cap: int = CAP) -> DataFrame:
    """src, source_size, target: the share of each source after capping.

    Sources by code point, null last, take the weights in turn. The water level
    is the common words-per-weight of the sources below their cap: with sources
    ordered by cap / weight it is the first level that its own source bears.
    The input is one row per source, already aggregated.
    """
    by_source = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("src") == "", "src")
    turn = (F.row_number().over(order) - 1) % len(weights)
    by_source = by_source.select("src", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long").alias("w"))
    level = Window.orderBy(cap * F.col("source_size") / F.col("w"), "src")
    before, everything = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = by_source.select(
        "*",
        (F.sum("source_size").over(everything) * overall - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_left"),
        F.row_number().over(level).alias("rank"),
    )
    lam = F.col("left") / F.col("w_left")
    holds = lam <= cap * F.col("source_size") / F.col("w")
    bar = F.min(F.when(holds, F.struct("rank", lam.alias("lam")))).over(everything)["lam"]
    return sums.select("src", "source_size", "w", F.least((cap * F.col("source_size")).cast("double"), F.coalesce(bar, F.lit(0.0)) * F.col("w")).alias("target"))


def bucket_starts(rows: DataFrame) -> DataFrame:
    """src, bucket, base: the words before a bucket in its source's shuffled stream."""
    totals = rows.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("src", "bucket", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("base"))


def placed(rows: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Adds ``pos``: the words before a document in its source's shuffled stream.

    Sums per bucket come first, so no window holds more than a bucket. ``starts``
    has them if they are known; its further columns are added as well.
    """
    starts = bucket_starts(rows) if starts is None else starts
    inner = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = rows.withColumn("run", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return run.join(starts, ["src", "bucket"]).withColumn("pos", F.col("base") + F.col("run")).drop("base", "run", "key")


def schedule(shares: DataFrame, block_words: int = BLOCK_WORDS, slots_per_chunk: int = 1024) -> DataFrame:
    """slot, src, rank: which source, and which block of its stream, each slot takes.

    ``shares`` has src and take (words). Slot i draws the point i * STEP mod 2^31.
    The few slots that the sequence owes a source at its end follow after the
    rest; slots beyond a source's need are left out. Ranks are taken per chunk of
    slots and offset by the counts of earlier chunks, so a source with most of
    the slots is never ranked in one window.
    """
    spark = shares.sparkSession
    cum = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    need = shares.select("src", F.ceil(F.col("take") / block_words).alias("slots")).filter("slots > 0")
    need = materialise(need.select("src", "slots", F.sum("slots").over(cum).alias("upto")), "slots")
    n, sources = need.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()
    cell = max(1, UNIT // (4 * max(sources, 1)))
    bound = lambda c: F.floor(c.cast("double") * UNIT / max(n, 1)).cast("long")
    spans = need.select("src", bound(F.col("upto") - F.col("slots")).alias("lo"), bound(F.col("upto")).alias("hi"))
    spans = spans.select("*", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.greatest("hi", F.col("lo") + 1) - 1) / cell))).alias("cell"))
    points = spark.range(n).select(F.col("id").alias("slot"), ((F.col("id") % UNIT) * STEP % UNIT).alias("at"))
    points = points.select("slot", "at", F.floor(F.col("at") / cell).alias("cell"))
    hits = points.join(spans, "cell").filter("at >= lo and at < hi").select("slot", "src", F.floor(F.col("slot") / slots_per_chunk).alias("chunk"))
    counts = hits.groupBy("src", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("src", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("src", "chunk").orderBy("slot")
    ranked = hits.withColumn("r", F.row_number().over(inside) - 1).join(base, ["src", "chunk"]).select("slot", "src", (F.col("base") + F.col("r")).alias("rank"))
    kept = ranked.join(need.select("src", "slots"), "src").filter("rank < slots").select("slot", "src", "rank")
    got = counts.groupBy("src").agg(F.sum("n").alias("got"))
    owed = need.join(got, "src", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < slots")
    tail = owed.select((F.lit(n) + F.col("upto") - F.col("slots")).alias("base"), "src", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank"))
    return kept.union(tail.select((F.col("base") + F.col("rank")).alias("slot"), "src", "rank"))


def readings(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """One row per reading of the stream that reaches a document; ``at`` has the words read before it."""
    w = rows.filter("size > 0").join(shares.select("src", "source_size", "take"), "src").filter("take > pos")
    w = w.withColumn("pass", F.explode(F.sequence(F.lit(0), F.floor((F.col("take") - 1 - F.col("pos")) / F.col("source_size")).cast("int"))))
    return w.withColumn("at", F.col("pos") + F.col("pass") * F.col("source_size"))


def pieces(rows: DataFrame, shares: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The word spans of each document by block of its source's stream.

    The stream is read again from its start once it ends, so a document has one
    occurrence per reading; the last reading stops after ``take`` words.
    """
    w = readings(rows, shares)
    w = w.withColumn("end", F.least(F.col("at") + F.col("size"), F.col("take")))
    w = w.withColumn("rank", F.explode(F.sequence(F.floor(F.col("at") / block_words), F.floor((F.col("end") - 1) / block_words))))
    lo, hi = F.greatest("at", F.col("rank") * block_words), F.least("end", (F.col("rank") + 1) * block_words)
    return w.select("src", "rank", "pos", "doc_id", "size", "pass", (lo - F.col("at")).alias("from_word"), (hi - lo).alias("n_words"))


def plan(docs: DataFrame, seed: str = "mix", **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(placed documents, shares, mix): the mix has slot, src, rank, pos, doc_id, from_word, n_words."""
    weights, overall, cap = options.get("weights", WEIGHTS), options.get("overall", OVERALL), options.get("cap", CAP)
    block = options.get("block_words", BLOCK_WORDS)
    rows = sized(docs, seed)
    shares = materialise(targets(rows, weights, overall, cap).withColumn("take", F.floor("target").cast("long")), "shares")
    at = materialise(placed(rows), "placed")
    mixed = pieces(at, shares, block).join(schedule(shares, block), ["src", "rank"])
    return at, shares, mixed


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document with the words the mix takes of it.

    Columns doc_id, size, source_size, target, taken. A null text has no words, a
    null source is a source of its own, empty documents are taken 0 times, an
    empty table gives no rows. Rows that repeat a doc_id count one by one. Other
    columns of ``docs`` are not read, whatever their names.
    """
    at, shares, mixed = plan(docs.select("doc_id", "text", "source"), **options)
    taken = mixed.groupBy("src", "pos").agg(F.sum("n_words").alias("taken"))
    full = at.filter("size > 0").join(taken, ["src", "pos"], "left").select("doc_id", "src", "size", "taken")
    rows = full.union(at.filter("size = 0").select("doc_id", "src", "size", F.lit(0).cast("long")))
    return rows.join(shares.select("src", "source_size", "target"), "src").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """The documents as the mix takes them and in its order, with the columns of ``docs``.

    A document appears once per reading of its source's stream that reaches it.
    Where a reading stops inside a document, that occurrence keeps the words
    before the stop. ``n_chars``, if there, is recomputed for cut texts. Empty
    documents hold no words to take. Rows are sorted by the slot of the block in
    which an occurrence begins; they are not split where a block ends. Whole rows
    travel to the bucket that places them, where the slots of its documents are
    looked up, and then to their place in the order: partition k holds the k-th
    equal part of the slots.
    """
    columns = docs.columns
    small = sized(docs.select("doc_id", "text", "source"), seed)
    digits = len(small.select(F.min("bucket")).first()[0] or "0")
    weights, overall, cap = options.get("weights", WEIGHTS), options.get("overall", OVERALL), options.get("cap", CAP)
    shares = materialise(targets(small, weights, overall, cap).withColumn("take", F.floor("target").cast("long")), "shares")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")).select("doc", *keyed(F.col("doc.doc_id"), F.col("doc.source"), F.col("doc.text"), seed))
    rank = F.floor(F.col("at") / options.get("block_words", BLOCK_WORDS))
    starts = materialise(bucket_starts(small), "starts")
    begun = materialise(readings(placed(small, starts), shares).select("src", "bucket", rank.alias("rank")).distinct(), "begun")
    order = materialise(schedule(shares, options.get("block_words", BLOCK_WORDS)), "order")
    slots = begun.join(order, ["src", "rank"]).groupBy("src", "bucket").agg(F.map_from_entries(F.collect_list(F.struct("rank", "slot"))).alias("slots"))
    slots = materialise(starts.join(slots, ["src", "bucket"]), "bucket-slots")
    at = placed(whole.withColumn("bucket", F.substring("key", 1, digits)), slots)
    w = readings(at, shares).withColumn("slot", F.element_at("slots", rank)).drop("slots")
    w = w.withColumn("n", F.least("size", F.col("take") - F.col("at")).cast("int"))
    text = F.col("doc.text")
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)), 1, F.col("n")), "")
    whole_doc = F.col("n") == F.col("size")
    w = w.withColumn("cut", F.when(whole_doc, text).otherwise(head))
    out = {c: F.col(f"doc.`{c}`").alias(c) for c in columns} | {"text": F.col("cut").alias("text")}
    if "n_chars" in out:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(whole_doc, F.col("doc.n_chars")).otherwise(F.length("cut").cast(kind)).alias("n_chars")
    spark = docs.sparkSession
    n = max(order.count(), 1)  # the few slots owed to sources come after the n-th
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = w.select("slot", "at", F.struct(*[out[c] for c in columns]).alias("row"))
    w = w.repartitionById(parts, F.least(F.floor(F.col("slot") * parts / n), F.lit(parts - 1)).cast("int")).sortWithinPartitions("slot", "at")
    return w.select(*[F.col(f"row.`{c}`") for c in columns])
