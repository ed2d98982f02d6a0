"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features are rates per document: words of a fixed lexicon and of one induced from
labelled training rows, how close they stand to the second person, capitals,
punctuation and obfuscation. Fitting uses a bounded sample of labelled rows on
the driver; every row of every document is then scored where it lies.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, materialise, trim
from .tokens import text_slices

#: At most about this many labelled rows are fitted on, whatever their length.
SAMPLE_ROWS = 8_000
SAMPLE_PARTS = 24
TREES, DEPTH, RATE, BINS, LEAF = 60, 3, 0.2, 48, 5

#: Words of insult in four languages, and the second person in them.
LEXICON = frozenset(
    """asshole bastard bitch clown coward creep crap cretin damn degenerate disgusting dumb dumbass fool freak fuck fucking
    garbage hate idiot idiotic imbecile jerk kill liar lazy loser lunatic moron moronic pathetic pig psycho retard retarded
    rubbish scum scumbag shit shut sick slut stupid sucker suck sucks trash twat ugly vermin whore worthless
    abschaum arschloch dumm dummkopf ekelhaft hurensohn idioten miststück müll schwachkopf trottel wertlos widerlich
    abruti connard crétin débile dégoûtant enculé imbécile minable ordure pourriture salaud salope stupide
    basura cabrón cobarde escoria estúpido estúpida imbécil inútil mierda patético perdedor puta tonto tonta""".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros".split())
#: Characters that stand in for letters.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e"})

_LETTERS = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_][*#%]+[^\W\d_]")
_STRETCHED = re.compile(r"(.)\1{2,}")
LEX, LEARNT, PERSON, CAPS, HIDDEN, MASKED, STRETCHED, MOSTLY, OFTEN = (1 << i for i in range(9))
FEATURES = ("lexicon", "lexicon_count", "learnt", "learnt_count", "learnt_kinds", "mostly", "mostly_count", "often", "often_count", "densest", "person", "near_person", "capitals", "capital_letters", "exclaim", "question", "punctuation", "hidden", "masked", "stretched", "digits", "log_words")


def units(word: str) -> list[str]:
    """What a learnt lexicon may hold of a word: itself, as '=word', and its beginnings."""
    return ["=" + word, *[word[:k] for k in (4, 5, 6) if len(word) >= k]]


def _words(text: str) -> set[str]:
    return {w for t in set(text.lower().split()) for w in _LETTERS.findall(t)}


def unlike(word_sets: list[set[str]], triples: int = 8) -> list[int]:
    """Which texts remain when those that share a triple of minimum hashes with an earlier one go.

    Copies with small changes share words that have nothing to do with their label.
    """
    rng = np.random.default_rng(11)
    factors = rng.integers(1, 1 << 62, 3 * triples, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    seen, kept = set(), []
    for i, words in enumerate(word_sets):
        if not words:
            continue
        base = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
        low = np.array([((base * f) >> np.uint64(20)).min() for f in factors])
        keys = {(k, *low[3 * k : 3 * k + 3].tolist()) for k in range(triples)}
        if not keys & seen:
            kept.append(i)
        seen |= keys
    return kept


def induce_lexicon(sets: list[set[str]], toxic: np.ndarray, least: int = 5) -> dict[str, int]:
    """Units that mark toxic texts, given as sets of words: 3 for almost always, 2 for mostly, 1 for often.

    Counted are texts, toxic or not, that hold a unit, copies left out. A unit must
    stand in ``least`` toxic texts, in twice as many to count as often or mostly.
    """
    keep = unlike(sets)
    positive = Counter(u for i in keep if toxic[i] for u in {u for w in sets[i] for u in units(w)})
    wanted = {u for u, n in positive.items() if n >= least}
    negative = Counter(u for i in keep if not toxic[i] for u in {u for w in sets[i] for u in units(w) if u in wanted})
    out = {}
    for u in wanted:
        share = positive[u] / (positive[u] + negative[u])
        if share >= 0.97:
            out[u] = 3
        elif positive[u] >= 2 * least and share >= 0.5:
            out[u] = 2 if share >= 0.75 else 1
    return out


class Featurizer:
    """Texts to rows of ``FEATURES``."""

    def __init__(self, learnt: dict[str, int] | None = None, cache_entries: int = 200_000) -> None:
        self.learnt = learnt or {}
        self._flags: dict[str, int] = {}
        self._most = cache_entries

    def _plain(self, word: str) -> int:
        out = LEX * (word in LEXICON) | PERSON * (word in SECOND_PERSON)
        strength = max((self.learnt.get(u, 0) for u in units(word)), default=0)
        return out | (0, OFTEN, MOSTLY, LEARNT)[strength]

    def flags(self, token: str) -> int:
        low, out = token.lower(), 0
        words = _LETTERS.findall(low)
        for w in words:
            out |= self._plain(w)
        letters = sum(map(len, words))
        if letters >= 3 and token.isupper():
            out |= CAPS
        if not out & (LEX | LEARNT) and (len(low) != letters or not low.isascii()):
            folded = "".join(c for c in unicodedata.normalize("NFKD", low.strip(".,;:!?\"'()").translate(STAND_INS)) if c.isalpha())
            if len(folded) >= 4 and self._plain(folded) & (LEX | LEARNT):
                out |= HIDDEN
        if _MASKED.search(low):
            out |= MASKED
        if _STRETCHED.search(low):
            out |= STRETCHED
            once = _STRETCHED.sub(r"\1", low)
            if any(self._plain(w) & (LEX | LEARNT) for w in _LETTERS.findall(once)):
                out |= HIDDEN
        return out

    def row(self, text: str) -> list[float]:
        tokens = text.split()
        cache, n = self._flags, len(tokens)
        new = set(tokens).difference(cache)
        for t in new:
            cache[t] = self.flags(t)
        marks = np.fromiter(map(cache.__getitem__, tokens), np.int16, n)
        if len(cache) > self._most:  # the first words stay, being the frequent ones
            for t in new:
                del cache[t]
        used = np.flatnonzero(marks)
        marks = marks[used]
        count = lambda bit: int(((marks & bit) > 0).sum())
        bad = used[(marks & (LEX | LEARNT | HIDDEN)) > 0]
        person = used[(marks & PERSON) > 0]
        near = 0
        if len(bad) and len(person):
            at = np.searchsorted(person, bad)
            gap = np.minimum(np.abs(bad - person[np.minimum(at, len(person) - 1)]), np.abs(bad - person[np.maximum(at - 1, 0)]))
            near = int((gap <= 5).sum())
        densest = int((np.searchsorted(bad, bad + 50) - np.arange(len(bad))).max()) if len(bad) else 0
        kinds = len({tokens[i].lower().strip(".,;:!?") for i in used[(marks & LEARNT) > 0]})
        words, chars = max(n, 1), max(len(text), 1)
        upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        marks_of = sum(map(text.count, "*#%&$@~^"))
        return [
            1000 * count(LEX) / words, count(LEX), 1000 * count(LEARNT) / words, count(LEARNT), kinds, 1000 * count(MOSTLY) / words, count(MOSTLY), 1000 * count(OFTEN) / words, count(OFTEN), densest, 1000 * count(PERSON) / words, near,
            1000 * count(CAPS) / words, 1000 * upper / chars, 1000 * text.count("!") / chars, 1000 * text.count("?") / chars, 1000 * marks_of / chars,
            1000 * count(HIDDEN) / words, 1000 * count(MASKED) / words, 1000 * count(STRETCHED) / words, 1000 * sum(map(text.count, "0123456789")) / chars, float(np.log1p(n)),
        ]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.row(t or "") for t in texts], np.float64).reshape(-1, len(FEATURES))


def featurizer(learnt: dict[str, int]) -> Featurizer:
    """This Python worker's featurizer for a lexicon, whose cache serves all its tasks."""
    return held(("toxicity", zlib.crc32(repr(sorted(learnt.items())).encode())), lambda: Featurizer(learnt))


@dataclass
class Boosted:
    """Gradient boosting of small regression trees on logistic loss.

    A tree is kept as arrays over its nodes in heap order: feature (-1 in a
    leaf), threshold (values at most it go left) and value.
    """

    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, leaf: int = LEAF, l2: float = 1.0) -> Boosted:
        p = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        if len(y) < 2 * leaf or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
        rare = [np.unique(c[c > 0])[: bins // 2] for c in x.T]
        cuts = [np.unique(np.append(c, np.append(r, 0.0))) for c, r in zip(cuts, rare, strict=True)]
        codes = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, x.T, strict=True)])
        width = max(len(c) for c in cuts) + 1
        margin = np.full(len(y), self.base)
        for _ in range(trees):
            prob = 1 / (1 + np.exp(-margin))
            grad, hess = y - prob, prob * (1 - prob)
            nodes = (1 << (depth + 1)) - 1
            feature, threshold, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
            place = np.zeros(len(y), np.int64)
            for node in range(nodes):
                rows = np.flatnonzero(place == node)
                if not len(rows):
                    continue
                g, h = grad[rows], hess[rows]
                value[node] = rate * g.sum() / (h.sum() + l2)
                if node >= nodes // 2 or len(rows) < 2 * leaf:
                    continue
                best = (1e-6, -1, 0)
                score = g.sum() ** 2 / (h.sum() + l2)
                for j, cut in enumerate(cuts):
                    if not len(cut):
                        continue
                    c = codes[j, rows]
                    gl, hl, nl = (np.cumsum(np.bincount(c, w, width))[: len(cut)] for w in (g, h, None))
                    gain = gl**2 / (hl + l2) + (g.sum() - gl) ** 2 / (h.sum() - hl + l2) - score
                    gain[(nl < leaf) | (len(rows) - nl < leaf)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, k)
                if best[1] >= 0:
                    feature[node], threshold[node] = best[1], cuts[best[1]][best[2]]
                    place[rows] = 2 * node + 1 + (codes[best[1], rows] > best[2])
            self.trees.append((feature, threshold, value))
            margin += value[place]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, threshold, value in self.trees:
            place = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(feature) + 1)) - 1):
                f = feature[place]
                inner = f >= 0
                right = x[np.arange(len(x)), np.maximum(f, 0)] > threshold[place]
                place = np.where(inner, 2 * place + 1 + right, place)
            out += value[place]
        return out


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (margin, probability) of the best increasing fit, by pooling adjacent violators.

    A pool's probability is (positives + 1/2) / (rows + 1), so none is 0 or 1.
    """
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []  # positives, rows, lowest and highest margin
    for m, v in zip(margin[order], y[order], strict=True):
        if pools and pools[-1][3] == m:
            pools[-1][0] += v
            pools[-1][1] += 1
        else:
            pools.append([float(v), 1.0, m, m])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            a, b = pools[-2], pools.pop()
            pools[-1] = [a[0] + b[0], a[1] + b[1], a[2], b[3]]
    x = np.array([v for p in pools for v in (p[2], p[3])])
    p = np.array([(p[0] + 0.5) / (p[1] + 1) for p in pools for _ in range(2)])
    return x, np.maximum.accumulate(p)


@dataclass
class Model:
    learnt: dict[str, int]
    trees: Boosted
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, features: np.ndarray) -> np.ndarray:
        if not len(features):
            return np.empty(0)
        m = self.trees.margin(features)
        if not len(self.knots[0]):
            return 1 / (1 + np.exp(-m))
        return np.interp(m, *self.knots)


#: Quarters of the labelled texts, and the quarters whose lexicon they are seen with.
FOLDS = (((0,), (1, 2)), ((1, 2), (0,)), ((3,), (0, 1, 2)))


def quarter(text: str) -> int:
    """One of four parts, by a hash of the text: three grow trees, the last calibrates."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) >> 8 & 3


def fold_lexicons(sets: list[set[str]], y: np.ndarray, quarters: np.ndarray) -> list[dict[str, int]]:
    """The lexicon that each quarter is seen with.

    The lexicon for the trees' own rows comes from the other half of them, so that
    trees see it as it acts on new texts.
    """
    out = [{} for _ in range(4)]
    for parts, source in FOLDS:
        rows = np.flatnonzero(np.isin(quarters, source))
        learnt = induce_lexicon([sets[i] for i in rows], y[rows])
        for part in parts:
            out[part] = learnt
    return out


def grown(x: np.ndarray, y: np.ndarray, quarters: np.ndarray, learnt: dict[str, int]) -> Model:
    """A model from features of labelled texts, calibrated on the last quarter if it has both classes."""
    grow, last = quarters < 3, quarters == 3
    trees = Boosted().fit(x[grow], y[grow])
    both = last.any() and y[last].min() != y[last].max()
    return Model(learnt, trees, isotonic(trees.margin(x[last]), y[last]) if both else (np.empty(0), np.empty(0)))


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    """A model from labelled texts at hand.

    With no rows, or one class, the score is the smoothed share of toxic rows.
    """
    y, sets = np.asarray(toxic, float), [_words(t) for t in texts]
    quarters = np.array([quarter(t) for t in texts], np.int64)
    x = np.zeros((len(texts), len(FEATURES)))
    for part, learnt in enumerate(fold_lexicons(sets, y, quarters)):
        rows = np.flatnonzero(quarters == part)
        x[rows] = Featurizer(learnt)([texts[i] for i in rows])
    return grown(x, y, quarters, induce_lexicon(sets, y))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts to their quarters and distinct words."""
    for keys, texts in text_slices(batches):
        found = [(quarter(t), " ".join(sorted(_words(t)))) for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([q for q, _ in found], pa.int32()), pa.array([w for _, w in found], pa.string())], names=["key", "quarter", "words"])


def _seen_with(lexicons):
    """Labelled texts to their features, each with the lexicon of its quarter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_quarter = [Featurizer(learnt, 50_000) for learnt in lexicons.value]
        for keys, texts in text_slices(batches):
            rows = [by_quarter[quarter(t)].row(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(rows, pa.list_(pa.float64()))], names=["key", "x"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from about ``rows`` labelled rows at most; whole texts stay on the executors.

    The driver gets each sampled text's distinct words and then its features.
    """
    spark = docs.sparkSession
    chosen = sample(docs, labels, rows)
    bags = chosen.select("key", "text").repartition(SAMPLE_PARTS).mapInArrow(_bags, "key string, quarter int, words string")
    found = bags.join(F.broadcast(chosen.select("key", "toxic")), "key").toPandas()
    found = found.assign(at=[zlib.crc32(k.encode()) for k in found.key]).sort_values(["at", "key"]).reset_index(drop=True)
    one: dict[str, str] = {}  # each word is held once
    sets = [{one.setdefault(w, w) for w in words.split()} for words in found.pop("words")]
    y, quarters = (found.toxic.to_numpy(float) > 0).astype(float), found.quarter.to_numpy(np.int64)
    lexicons = spark.sparkContext.broadcast(fold_lexicons(sets, y, quarters))
    seen = chosen.select("key", "text").repartition(SAMPLE_PARTS).mapInArrow(_seen_with(lexicons), "key string, x array<double>").toPandas()
    x = dict(zip(seen.key, seen.x, strict=True))
    features = np.array([x[k] for k in found.key], np.float64).reshape(-1, len(FEATURES))
    model = grown(features, y, quarters, induce_lexicon(sets, y))
    lexicons.unpersist()
    del sets, one, found, seen, x
    trim()
    return model


def held_out(doc_id):
    """Whether labels of a row are kept from fitting: crc32 of doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """key, text, toxic: labelled rows outside the held-out fold, chosen by a hash of doc_id, one per doc_id.

    Chosen ids, at most about ``rows``, are broadcast, so documents are filtered
    where they lie. Several labels of one doc_id count as their largest; of several
    texts the one with the smallest hash is taken, before anything is shuffled.
    """
    usable = labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = usable.count()
    share = min(1.0, rows / max(n, 1))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = chosen.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    found = found.groupBy(F.col("label_id").cast("string").alias("key")).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least"), F.max("toxic").alias("toxic"))
    return materialise(found.select("key", F.col("least.text").alias("text"), "toxic"), "labelled")


def scores(docs: DataFrame, model: Model, below: float | None = None) -> DataFrame:
    """doc_id and score per document; with ``below``, the whole rows that score less."""
    columns = docs.columns if below is not None else ["doc_id", "text"]
    i_id, i_text = columns.index("doc_id"), columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = featurizer(model.learnt)
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column(i_id), batch.column(i_text)], names=["doc_id", "text"])
            done = [model.score(featurize(texts)) for _, texts in text_slices([pair])]
            score = np.concatenate(done) if done else np.empty(0)
            if below is None:
                yield pa.RecordBatch.from_arrays([pair.column(0), pa.array(score)], names=["doc_id", "score"])
            else:
                yield batch.filter(pa.array(score < below))
        trim()

    rows = docs.select(*[f"`{c}`" for c in columns])
    if below is not None:
        return rows.mapInArrow(run, rows.schema)
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``.

    The score depends on the text alone; an empty or null text scores like any
    text without words. Rows that repeat are scored alike. A null doc_id is not
    held out. Other columns are not read; an empty table gives no rows.
    """
    out = scores(docs, fitted(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns.

    A null or empty text scores like any text without words; repeated rows stay or
    go together; a null doc_id has no label; other columns pass through, whatever
    their names; an empty table gives no rows. Without usable labels the score is
    a constant below one half, and every row stays.
    """
    return scores(docs, fitted(docs, labels), threshold)
