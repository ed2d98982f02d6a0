"""Document quality from heuristic labellers that are trusted as far as they agree.

Each labeller votes good, bad or abstains. Expectation-maximisation over the
counts of vote patterns of all documents estimates how accurate each labeller is
and how likely each pattern means a good document. Those posteriors, as soft
labels, train a linear scorer on hashed features of a bounded sample of texts;
the scorer then grades every document. No hand-made label is used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, materialise
from .tokens import text_slices

GOOD, BAD, ABSTAIN = 1, 0, 2
#: Common words of four languages, with which running text is full.
STOPWORDS = frozenset(
    """a an and are as at be by for from in is it of on or that the this to was with
    das den der die ein eine für im in ist mit nicht sich und von zu auf
    au avec dans de des du en est et la le les par pas pour que qui sur un une
    al con de del el en la las lo los no para por que se su un una y""".split()
)
#: Bits of the scorer's hash; texts that it is fitted on, at most about this many.
HASH_BITS, SAMPLE_ROWS = 14, 8_000

_SYMBOLS = re.compile(r"[#$%&*@~^|<>{}\[\]\\=_+]")
_WORDS = re.compile(r"[^\W\d_]+")
_RUNS = [(re.compile(p), r) for p, r in ((r"[A-ZÀ-Þ]", "A"), (r"[^\W\d_A]", "a"), (r"\d", "9"))]


def variety(tokens: list[str], window: int = 2000) -> float:
    """Mean share of distinct words over all windows of ``window`` words, so that length does not count.

    The last window reaches back to be as long as the others; it weighs as much
    as the words that no window before it has.
    """
    n, total = len(tokens), 0.0
    for lo in range(0, n, window):
        at = max(min(lo, n - window), 0)
        part = tokens[at : at + window]
        total += len(set(part)) / len(part) * min(window, n - lo)
    return total / max(n, 1)


def measures(text: str) -> dict[str, float]:
    """The numbers that labellers and scorer look at."""
    tokens = text.split()
    n, chars = len(tokens), max(len(text), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    repeats = sum(map(eq, tokens, tokens[1:]))
    upper = sum(map(str.isupper, tokens))
    alpha = sum(map(len, _WORDS.findall(text)))
    ends = sum(x.rstrip()[-1] in ".!?…\"'”»:;" for x in lines)
    return {
        "words": n,
        "symbols": len(_SYMBOLS.findall(text)) / chars,
        "stutter": repeats / max(n - 1, 1),
        "capitals": upper / max(n, 1),
        "letters": alpha / chars,
        "exclaim": (text.count("!") + text.count("?")) / max(n, 1),
        "stop": sum(map(STOPWORDS.__contains__, text.lower().split())) / max(n, 1),
        "length": sum(map(len, tokens)) / max(n, 1),
        "same_lines": 1 - len(set(lines)) / max(len(lines), 1),
        "ends": ends / max(len(lines), 1),
        "variety": variety(tokens),
        "pieces": (tokens.count("|") + tokens.count("•") + tokens.count(">")) / max(n, 1),
    }


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


def _bad(sign: bool) -> int:
    return BAD if sign else ABSTAIN


#: Labellers by name; each maps measures to a vote. Most only ever accuse, two also vouch.
LABELLERS = {
    "few words": lambda m: _bad(m["words"] < 3),
    "symbols": lambda m: _bad(m["symbols"] > 0.05),
    "stutter": lambda m: _bad(m["stutter"] > 0.15),
    "capitals": lambda m: _bad(m["capitals"] > 0.4 and m["words"] > 5),
    "letters": lambda m: _bad(m["letters"] < 0.65),
    "shouting": lambda m: _bad(m["exclaim"] > 0.2),
    "stop words": lambda m: _vote(m["words"] >= 8 and m["stop"] < 0.08, m["stop"] > 0.12),
    "word length": lambda m: _bad(m["words"] >= 5 and not 2.5 <= m["length"] <= 11),
    "repeated lines": lambda m: _bad(m["same_lines"] > 0.3),
    "line ends": lambda m: _vote(m["ends"] < 0.3, m["ends"] > 0.7),
    "variety": lambda m: _bad(m["words"] >= 50 and m["variety"] < 0.2),
    "pieces": lambda m: _bad(m["pieces"] > 0.1),
}
VOUCHING = ("stop words", "line ends")
#: Beliefs that the estimate starts from, as chances of the votes bad, good
#: and abstain for bad and for good documents, and how many documents they count as.
ACCUSER, VOUCHER, BELIEF = ((0.35, 0.001, 0.649), (0.02, 0.001, 0.979)), ((0.5, 0.2, 0.3), (0.05, 0.65, 0.3)), 20.0


def votes(m: dict[str, float]) -> int:
    """The labellers' votes as one number in base 3, the first labeller last."""
    out = 0
    for f in LABELLERS.values():
        out = 3 * out + f(m)
    return out


def patterns(codes: np.ndarray) -> np.ndarray:
    """Votes per row and labeller."""
    k = len(LABELLERS)
    return np.stack([codes // 3 ** (k - 1 - j) % 3 for j in range(k)], axis=1) if len(codes) else np.empty((0, k), int)


def estimate(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good per pattern, accuracy table, prior of good) by expectation-maximisation.

    The table has, per labeller and class (bad, good), the chances of the votes
    bad, good and abstain. It starts from the belief that accusations are rare and
    seldom wrong, and keeps that belief as some documents' worth of evidence, so
    that the classes do not swap.
    """
    v, n = patterns(codes), counts.astype(float)
    k = len(LABELLERS)
    start = np.array([VOUCHER if name in VOUCHING else ACCUSER for name in LABELLERS])
    table, prior = start.copy(), 0.8
    posterior = np.full(len(codes), prior)
    for _ in range(rounds if len(codes) else 0):
        log = np.log(table)
        good = np.log(prior) + sum(log[j, 1, v[:, j]] for j in range(k))
        bad = np.log(1 - prior) + sum(log[j, 0, v[:, j]] for j in range(k))
        new = 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))
        moved, posterior = np.abs(new - posterior).max(), new
        weight = np.stack([n * (1 - posterior), n * posterior])
        prior = float(np.clip((weight[1].sum() + 0.8) / (n.sum() + 1), 1e-4, 1 - 1e-4))
        for j in range(k):
            for c in (0, 1):
                table[j, c] = np.bincount(v[:, j], weight[c], 3) + BELIEF * start[j, c]
                table[j, c] /= table[j, c].sum()
        if moved < 1e-9:
            break
    return posterior, table, prior


def shape(token: str) -> str:
    """'Word.' is 'Aa.', 'WORD!!' is 'A!', '12' is '9': classes of characters, runs once."""
    for pattern, to in _RUNS:
        token = pattern.sub(to, token)
    return re.sub(r"(.)\1+", r"\1", token)[:6]


class Hashed:
    """Hashed features of a text: shapes of tokens, their pairs, common words, measures by step."""

    def __init__(self, bits: int = HASH_BITS, cache_entries: int = 300_000) -> None:
        self._mask, self._cache, self._most = (1 << bits) - 1, {}, cache_entries

    def _bucket(self, name: str) -> int:
        import zlib

        return zlib.crc32(name.encode("utf-8", "surrogatepass")) & self._mask

    def __call__(self, text: str, m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, values); values of the text's own features have length 1 as a vector."""
        tokens, cache = text.split(), self._cache
        if len(cache) > self._most:
            cache.clear()
        for t in set(tokens).difference(cache):
            low = t.lower()
            cache[t] = self._bucket("w" + low if low in STOPWORDS else "s" + shape(t))
        own = np.fromiter(map(cache.__getitem__, tokens), np.int64, len(tokens))
        pairs = (own[:-1] * 31 + own[1:] + 7) & self._mask
        counts = np.bincount(np.concatenate([own, pairs, own[:-1][own[:-1] == own[1:]] ^ 1]), minlength=0) if len(own) else np.empty(0, int)
        where = np.flatnonzero(counts)
        value = np.sqrt(counts[where])
        value = value / max(np.sqrt((value**2).sum()), 1e-9)
        steps = [self._bucket(f"m{k}{min(9, int(10 * x)) if k not in ('words', 'length', 'symbols') else int(np.log2(1 + x * (200 if k == 'symbols' else 1)))}") for k, x in m.items()]
        return np.append(where, steps), np.append(value, np.full(len(steps), 0.3))


class Linear:
    """Logistic regression on hashed features, fitted by averaged stochastic steps."""

    def __init__(self, bits: int = HASH_BITS) -> None:
        self.weights, self.bias = np.zeros(1 << bits), 0.0

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], soft: np.ndarray, passes: int = 8, rate: float = 0.5, decay: float = 1e-5) -> Linear:
        w, b = self.weights.copy(), 0.0
        total, total_b, seen, rng = np.zeros_like(w), 0.0, 0, np.random.default_rng(3)
        for p in range(passes):
            for i in rng.permutation(len(rows)):
                at, x = rows[i]
                step = rate / (1 + p) * (soft[i] - 1 / (1 + np.exp(-np.clip(w[at] @ x + b, -30, 30))))
                np.add.at(w, at, step * x)
                b += step
            w *= 1 - decay
            total, total_b, seen = total + w, total_b + b, seen + 1
        if seen:
            self.weights, self.bias = total / seen, total_b / seen
        return self

    def score(self, row: tuple[np.ndarray, np.ndarray]) -> float:
        at, x = row
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ x + self.bias, -30, 30))))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) to key, votes and hashed features, of bounded size; a key repeats within a batch once at most."""
    features = held("quality", Hashed)
    for keys, texts in text_slices(batches):
        rows = []
        for key, t in dict(zip(keys, texts, strict=True)).items():
            m = measures(t)
            at, x = features(t, m)
            rows.append((key, votes(m), at.astype("<u2").tobytes(), x.astype("<f4").tobytes()))
        key, code, at, x = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(code, pa.int64()), pa.array(at, pa.binary()), pa.array(x, pa.binary())], names=["key", "votes", "at", "x"])


def quality(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> DataFrame:
    """doc_id, votes, posterior, score, kept: one row per row of ``docs``.

    ``posterior`` is what the labellers' votes say, ``score`` the scorer's grade
    (1: good), ``kept`` whether it reaches ``threshold``. Vote patterns, at most
    3 to the number of labellers, are counted over all documents; the scorer is
    fitted on about ``sample_rows`` different texts at most, chosen by a hash of the
    text, of which only hashed features come to the driver. A null text is empty, and empty texts are bad.
    Repeated rows each give a row, other columns are not read, an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_slices(batches):
            yield pa.RecordBatch.from_pydict({"votes": pa.array([votes(measures(t or "")) for t in texts], pa.int64())})

    counted = docs.select("doc_id", "text").mapInArrow(count, "votes long").groupBy("votes").agg(F.count("*").alias("n"))
    found = materialise(counted, "votes").toPandas().sort_values("votes")
    codes, n = found.votes.to_numpy(), found.n.to_numpy()
    posterior, _, _ = estimate(codes, n)
    by_code = dict(zip(codes.tolist(), posterior.tolist(), strict=True))
    share = min(1.0, sample_rows / max(int(n.sum()), 1))
    text = F.coalesce("text", F.lit(""))
    chosen = docs.select(F.xxhash64(text).alias("key"), text.alias("text")).filter(F.pmod("key", F.lit(1 << 20)) < int(share * (1 << 20)))
    few = chosen.mapInArrow(_sampled, "key long, votes long, at binary, x binary").groupBy("key").agg(F.min(F.struct("votes", "at", "x")).alias("row"))
    few = few.select("key", "row.*").toPandas().sort_values("key")
    rows = [(np.frombuffer(at, "<u2").astype(np.int64), np.frombuffer(x, "<f4").astype(float)) for at, x in zip(few["at"], few["x"], strict=True)]
    soft = [by_code.get(v, 0.5) for v in few["votes"].tolist()]
    model = Linear().fit(rows, np.array(soft))
    sent = spark.sparkContext.broadcast((by_code, model))
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("votes", T.LongType()), T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scorer = sent.value
        features = held("quality", Hashed)
        for batch in batches:
            code, post, score = [], [], []
            for _, part in text_slices([batch]):
                for t in part:
                    m = measures(t or "")
                    code.append(votes(m))
                    post.append(known.get(code[-1], 0.5))
                    score.append(scorer.score(features(t or "", m)) if m["words"] else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(code, pa.int64()), pa.array(post, pa.float64()), pa.array(score, pa.float64())], names=schema.names)

    out = docs.select("doc_id", "text").mapInArrow(grade, schema)
    return out.withColumn("kept", F.col("score") >= threshold)
