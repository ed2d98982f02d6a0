"""Operators against brute force on small tables with nulls, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millwright.llm import common, exact_dedup, mixing, ngram_join, packing, token_files, tokens, vector_dedup, warc
from millwright.llm.components import connected_components, merged_components
from millwright.llm.shingles import Shingler

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, pid string, src string, Size string, members string"


def documents(spark, rows):
    """(doc_id, text, source) with columns whose names clash with internal ones."""
    full = [(i, t, "en", s, len(t or ""), "k", "p", "s", "z", "m") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(n))


AWKWARD = [
    (1, "a b  c", "x"), (2, "a\tb c", "x"), (3, None, None), (4, "", "y"), (5, " ", "y"), (5, "a b c", "x"), (5, "a b c", "x"),
    (None, "a b c", None), (7, "Ünï cödé 　x", "Z"), (8, prose(1, 3000), "x"), (9, prose(1, 3000), "x"), (10, "<|endoftext|> hi", "y"), (11, "\n\n", "é"),
]


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup(spark):
    got = exact_dedup.exact_duplicates(documents(spark, AWKWARD).repartition(3)).collect()
    assert len(got) == len(AWKWARD)
    groups = {}
    for i, t, _ in AWKWARD:
        groups.setdefault(normal(t), []).append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == min((i for i in ids if i is not None), default=None)
    for sha in by_sha:
        assert sum(r["kept"] for r in got if r["text_sha256"] == sha) == 1
    stays = exact_dedup.deduplicated(documents(spark, AWKWARD).repartition(3))
    assert stays.columns == documents(spark, AWKWARD).columns and stays.count() == len(groups)
    assert exact_dedup.exact_duplicates(documents(spark, [])).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.booleans()), max_size=120), st.integers(1, 4000), st.integers(2, 5))
def test_grace_spills_and_stays_right(items, memory, fanout):
    content = lambda k: b"%d" % k * (k + 1)
    digest = lambda k, same: b"\0" * 32 if same else hashlib.sha256(b"%d" % k).digest()
    same = any(s for _, s in items)  # then all digests are equal, and only contents tell
    records = [(digest(k, same), content(k), n) for n, (k, _) in enumerate(items)]
    groups, members = [], 0
    for kind, _, state in exact_dedup.grace(records, lambda n, v: [v], lambda s, v: s.append(v), memory, fanout):
        if kind == "group":
            groups.append(sorted(state))
        else:
            members += 1
    want = {}
    for n, (k, _) in enumerate(items):
        want.setdefault(k, []).append(n)
    assert members == len(items) and sorted(groups) == sorted(want.values())


def test_mix(spark):
    rows = [(i, prose(i, 1 + i % 40), f"s{i % 7}" if i % 11 else None) for i in range(300)] + [(1000, None, "s1"), (1001, "", "s1"), (5, prose(5, 6), "s5"), (5, prose(5, 6), "s5"), (1002, prose(2, 5000), "huge")]
    got = mixing.mix(documents(spark, rows), block_words=64).collect()
    assert len(got) == len(rows)
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((i, size(t)) for i, t, _ in rows)
    total, by_source = {}, {}
    for _, t, s in rows:
        total[s] = total.get(s, 0) + size(t)
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, share, open_sources = 1.5 * sum(total.values()), dict.fromkeys(total, 0.0), set(total)
    for _ in range(100):  # reshare until none is above
        w = sum(weights[s] for s in open_sources)
        for s in open_sources:
            share[s] = left * weights[s] / w
        full = {s for s in open_sources if share[s] > 2 * total[s]}
        if not full:
            break
        for s in full:
            share[s] = 2 * total[s]
            left -= share[s]
        open_sources -= full
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source.setdefault((r["source_size"], round(r["target"], 6)), []).append(r["taken"])
    assert sorted(by_source) == sorted((total[s], round(share[s], 6)) for s in total)
    for (_, target), taken in by_source.items():
        assert abs(sum(taken) - target) <= 1
    assert sorted(got) == sorted(mixing.mix(documents(spark, rows).repartition(5), block_words=64).collect())
    out = mixing.mixed_documents(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + size(r["text"])
        assert r["n_chars"] == len(r["text"])
    want = {}
    for r in got:
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    assert words == {i: n for i, n in want.items() if n}
    assert mixing.mix(documents(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, None, None)])).collect()] == [0]


def test_mixed_documents_come_in_slot_order(spark):
    docs = documents(spark, [(i, prose(i, 1 + i % 40), f"s{i % 7}" if i % 11 else None) for i in range(300)] + [(1002, prose(2, 5000), "huge")])
    _, _, mixed = mixing.plan(docs, block_words=64)
    starts = sorted((r["slot"], r["pass"], r["pos"], r["doc_id"]) for r in mixed.filter("from_word = 0").collect())
    out = [r["doc_id"] for r in mixing.mixed_documents(docs.repartition(5), block_words=64).collect()]
    assert out == [s[3] for s in starts] and len(out) > 300


def test_schedule_spreads_sources(spark):
    shares = spark.createDataFrame([("=a", 5000), ("=b", 3000), ("=c", 70)], "src string, take long")
    rows = sorted((r["slot"], r["src"], r["rank"]) for r in mixing.schedule(shares, 10, slots_per_chunk=16).collect())
    assert len({s for s, _, _ in rows}) == len(rows) == 807
    for src, n in (("=a", 500), ("=b", 300), ("=c", 7)):
        own = [r for s, x, r in rows if x == src]
        assert own == list(range(n))  # ranks follow the slots
        first = sum(1 for s, x, _ in rows[:400] if x == src)
        assert abs(first - 400 * n / 807) <= 6


def brute_components(rows):
    sets = []
    for _, t, _ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    lowest = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            lowest[find(i)] = min(lowest.get(find(i), d), d)
    return sorted(((d, len(s), None if d is None else lowest[find(i)]) for i, ((d, _, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def family(base, changes, copies, first):
    r, out = random.Random(base), []
    words = prose(base, 120).split()
    for k in range(copies):
        w = list(words)
        for _ in range(changes):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        out.append((first + k, " ".join(w), "s"))
    return out


@pytest.mark.parametrize("partitions", [1, 5])
def test_ngram_join(spark, partitions):
    passage = prose(99, 60)
    shared = [(900 + k, passage + " " + prose(500 + k, 80), "s") for k in range(30)]
    rows = AWKWARD + family(1, 3, 40, 100) + family(2, 5, 40, 200) + family(3, 2, 10, 300) + shared + [(950, passage.upper(), "s"), (951, passage, "s"), (952, "one two", "s"), (953, "ONE two", "s")]
    got = ngram_join.shingle_components(documents(spark, rows).repartition(partitions))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows)
    stays = ngram_join.one_per_component(documents(spark, rows))
    gone = {d for d, _, c in brute_components(rows) if d != c}
    assert sorted(r["doc_id"] or -1 for r in stays.select("doc_id").collect()) == sorted(d or -1 for d, _, _ in rows if d not in gone)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.shingle_components(documents(spark, [])).count() == 0
    assert ngram_join.shingle_components(documents(spark, [(1, None, None)])).collect() == [(1, 0, 1)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abAB é\n\t", max_size=60), max_size=12))
def test_shingles(texts):
    want = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        want.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    got = list(Shingler().sets(texts))
    assert [len(s) for s in got] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_long_text_in_segments(monkeypatch):
    from millwright.llm import shingles

    text = prose(4, 3000)
    whole = next(Shingler().sets([text]))
    monkeypatch.setattr(shingles, "SEGMENT", 1000)
    assert np.array_equal(next(Shingler().sets([text])), whole)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=20), st.integers(0, 59))
def test_bitmaps_lose_no_link(a, more, drop):
    b = set(sorted(a)[drop:]) | more
    if not b or not ngram_join.links(len(a & b), len(a), len(b)):
        return
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    assert ngram_join.may_link(len(x), ngram_join.parity(x), len(y), ngram_join.parity(y))


def brute_rows(a, b):
    rows = {}
    for t, g in zip(a, b, strict=True):
        if g not in rows.setdefault(t, []):
            rows[t].append(g)
    far = {t: len(own) > ngram_join.LEADS + 1 for t, own in rows.items()}
    return {(t, g, own[j], j == 0, far[t]) for t, own in rows.items() for k, g in enumerate(own) for j in range(min(k, ngram_join.LEADS))}


@pytest.mark.parametrize("step", range(1, 30))
def test_shared_rows_across_batches(step):
    a = [1, 2, 2, 2, 2, 3, 5, 5, 5] + [6] * 9 + [7] * 10 + [8] * 25 + [9] * 25 + [10]
    b = [7, 1, 2, 2, 9, 4, 1, 2, 3, *range(9), *range(10), *range(25), *range(12), *range(11, 24), 1]
    k = len(a)
    rows = pa.RecordBatch.from_arrays([pa.array([0] * k, pa.int8()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([1] * k, pa.int32()), pa.nulls(k, pa.binary())], names=["kind", "a", "b", "n", "bits"])
    batches = [rows.slice(i, step) for i in range(0, k, step)]
    got = [r for out in ngram_join._shared(iter(batches)) for r in out.to_pylist()]
    assert len(got) == len(brute_rows(a, b))
    assert {(r["a"], r["b"], r["lead"], r["first"], r["far"]) for r in got} == brute_rows(a, b)


def test_members_pass_between_matrix_rows():
    own = [(0, 1, 5, 1, None), (1, 1, 77, 3, b"x"), (0, 1, 6, 4, None), (2, 2, 3, None, None)]
    rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*own, strict=True), (pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["kind", "a", "b", "n", "bits"])
    got = [r for out in ngram_join._shared(iter([rows])) for r in out.to_pylist()]
    assert sorted((r["kind"], r["a"], r["b"], r["n"], r["lead"]) for r in got if r["kind"]) == [(1, 1, 77, 3, None), (2, 2, 3, None, None)]
    assert [(r["a"], r["b"], r["n"], r["lead"]) for r in got if not r["kind"]] == [(1, 6, 4, 5)]


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=20), st.integers(0, 59), st.integers(0, 9))
def test_linked_sets_share_rare_shingles(a, more, drop, seed):
    b = set(sorted(a)[drop:]) | more
    if not b or not ngram_join.links(len(a & b), len(a), len(b)):
        return
    sketch = np.random.default_rng(seed).integers(0, 3, 1 << 8).astype(np.uint32)
    x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
    common = np.intersect1d(ngram_join.rare_first(x, sketch, 75), ngram_join.rare_first(y, sketch, 75))
    assert len(common) >= min(ngram_join.least_shared(len(x)), ngram_join.least_shared(len(y)))


@pytest.mark.parametrize("leads, block", [(1, 1024), (2, 1024), (1, 8)])
def test_long_matrix_rows(spark, monkeypatch, leads, block):
    monkeypatch.setattr(ngram_join, "LEADS", leads)
    monkeypatch.setattr(ngram_join, "ROW_BLOCK", block)
    passage = prose(71, 40)
    rows = [(k, passage + " " + prose(600 + k // 2, 11), "s") for k in range(60)]
    got = ngram_join.shingle_components(documents(spark, rows).repartition(4))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(-9, 9), min_size=1), min_size=2, max_size=8))
def test_groups_meet_in_one_row(tokens_of):
    met = []
    for token in range(-9, 10):
        here = [g for g, own in enumerate(tokens_of) if token in own]
        bits = ngram_join.parity(np.arange(8, dtype=np.uint64))
        row = [{"gid": g, "part": g, "side": 0, "members": [{"sid": g, "n": 8, "bits": bits}], "before": [t for t in tokens_of[g] if t < token]} for g in here]
        schema = pa.schema([("gid", pa.int64()), ("part", pa.int64()), ("side", pa.int32()), ("members", pa.list_(pa.struct([("sid", pa.int64()), ("n", pa.int32()), ("bits", pa.binary())]))), ("before", pa.list_(pa.int64()))])
        met += [(r["g"], r["h"]) for r in ngram_join._across(75)(pa.Table.from_pylist(row, schema)).to_pylist()]
    assert sorted(met) == [(g, h) for g in range(len(tokens_of)) for h in range(g + 1, len(tokens_of)) if tokens_of[g] & tokens_of[h]]


def test_components_merge_with_unknown_nodes(spark):
    parts = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5)], "node long, component long")
    edges = spark.createDataFrame([(2, 9), (9, 8), (20, 21)], "u long, v long")
    assert dict(merged_components(parts, edges).collect()) == {1: 1, 2: 1, 5: 5, 6: 5, 8: 1, 9: 1, 20: 20, 21: 20}


def test_components(spark):
    r = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(5, 5), (None, 1)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", "u") for i, v, lab in rows], "vec_id long, embedding array<float>, label int, class string, unit string")


@pytest.mark.parametrize("block", [2048, 16])
def test_vectors(spark, block):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((30, 24))
    rows = []
    for k in range(240):
        v = base[k % 30] + rng.standard_normal(24) * (0.25 if k % 2 else 0.1)
        rows.append((k, [float(np.float32(x)) for x in v], k % 2))
    rows += [(k, rows[0][1], 0) for k in range(300, 360)] + [(400, None, 1), (401, [0.0] * 24, 1), (402, [float("nan")] * 24, 1), (403, [None] * 24, 1), (404, rows[0][1], None), (405, [], 0), (406, [1.0, 2.0], 0), (None, rows[0][1], 0), (0, rows[0][1], 0), (407, [float("inf")] * 24, 0)]
    got = {}
    for r in vector_dedup.near_vectors(vectors(spark, rows), block=block).collect():
        got.setdefault(r["vec_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    able = [(i, np.array(v, np.float64), lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {}
    for n, (i, v, lab) in enumerate(able):
        links[n] = [m for m, (j, w, other) in enumerate(able) if m != n and lab == other and len(v) == len(w) and v @ w >= 0.93 * np.sqrt(v @ v) * np.sqrt(w @ w)]
    total, found = sum(map(len, links.values())), 0
    for n, (i, _, _) in enumerate(able):
        mine = max(r["n_links"] for r in got[i])
        assert mine <= len(links[n])
        found += mine
    assert found >= 0.97 * total
    for i in (400, 401, 402, 403, 404, 405, 406, 407):
        assert (got[i][0]["n_links"], got[i][0]["component_id"], got[i][0]["kept"]) == (0, i, True)
    assert got[None][0]["n_links"] == 0 and not got[None][0]["kept"]
    assert {r["component_id"] for k in range(300, 360) for r in got[k]} == {0} and not got[300][0]["kept"]
    assert vector_dedup.near_vectors(vectors(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), min_size=1, max_size=8), st.integers(40, 90))
def test_best_fill_is_best(counts, capacity):
    sums = {0}
    for length, k in counts.items():
        sums = {s + length * j for s in sums for j in range(k + 1) if s + length * j <= capacity}
    chosen = packing.best_fill(counts, capacity)
    assert all(0 < k <= counts[n] for n, k in chosen.items())
    assert sum(n * k for n, k in chosen.items()) == max(sums)
    first = max(counts)
    assert packing.best_fill(counts, capacity, first).get(first, 0) >= 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80), st.integers(2, 30))
def test_windows_hold_each_id_once(lengths, pool):
    pieces = [(k, 0, n) for k, n in enumerate(lengths)]
    out = list(packing.windows(iter(pieces), 64, pool))
    for w in out:
        total = sum(n for _, _, n in w)
        assert total <= 64 and total & (total - 1) == 0
    spans = sorted((k, a, a + n) for w in out for k, a, n in w)
    at = {}
    for k, a, b in spans:
        assert at.get(k, 0) == a
        at[k] = b
    assert at == dict(enumerate(lengths))


def ids_of(vocabulary, text, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_pack(spark):
    rows = list({i: (i, t, s) for i, t, s in AWKWARD}.values())
    got = packing.digest(packing.pack(documents(spark, rows).repartition(2))).collect()
    want = {i: ids_of(packing.VOCABULARY, t, 1) for i, t, _ in rows}
    seen = {}
    for r in sorted(got, key=lambda r: r["start"]):
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids) and r["start"] == seen.get(r["doc_id"], 0)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        seen[r["doc_id"]] = r["start"] + r["length"]
    assert seen == {i: len(x) for i, x in want.items()}
    by_sequence = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by_sequence.get(r["sequence_id"], 0)
        by_sequence[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n <= 2048 and n & (n - 1) == 0 for n in by_sequence.values())
    assert packing.pack(documents(spark, [])).count() == 0


TEXTS = st.lists(st.text(alphabet="ab'sZ1 \n\t\x1c\x85　é!́<|>", max_size=30), max_size=6)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 20))
def test_chunked_encoding_is_the_library_s(texts, entries):
    import public_tokenizers

    for name, leading in ((packing.VOCABULARY, False), (token_files.VOCABULARY, True)):
        e = tokens.Encoder(public_tokenizers.path(name), leading, cache_entries=entries)
        for _ in range(2):
            assert e([*texts, "a<|endoftext|> b", None]) == [e.whole(t) for t in [*texts, "a<|endoftext|> b", ""]]


def test_token_files(spark, tmp_path):
    rows = AWKWARD[:6] + AWKWARD[8:]
    docs = documents(spark, rows).repartition(3)
    manifest = token_files.write_tokens(docs, f"file://{tmp_path}", length=64, rows=4)
    got = token_files.read_tokens(manifest, docs.schema["doc_id"].dataType).collect()
    want, start = [], 0
    for i, t in sorted((i, t) for i, t in ((i, t or "") for i, t, _ in rows)):
        ids = ids_of(token_files.VOCABULARY, t, 0)
        want.append((i, start, len(ids), ids.tobytes()))
        start += len(ids)
    assert sorted((r[0], r[1], r[2], bytes(r[3])) for r in got) == want
    stream = np.concatenate([np.frombuffer(w[3], "<u4") for w in want])
    for part in manifest.orderBy("part").collect():
        f = token_files.Reader(part["uri"])
        assert len(f) == -(-part["tokens"] // 64)
        for i in (*range(len(f)), 0):
            ids, mask = f.sequence(i)
            lo = part["start"] + 64 * i
            real = min(64, part["start"] + part["tokens"] - lo)
            assert mask.sum() == real and np.array_equal(ids[:real], stream[lo : lo + real]) and not ids[real:].any()
            assert not ids.flags.owndata
    assert token_files.round_trip(documents(spark, [])).count() == 0


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", "p") for i, u, h in rows], "page_id long, url string, html string, key string, payload string")


def test_warc_round_trip(spark):
    rows = [(i, f"http://h/{i}?q= é", f"<p>page {i % 40} {'x' * (i % 40)}") for i in range(120)] + [(200, None, None), (201, "u", ""), (202, "u", "<p>" * 50_000), (None, "u", "null id"), (203, "u", "null id"), (204, "a", "twice"), (204, "b", "twice")]
    got = warc.round_trip(pages(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows)
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    html = {i: h or "" for i, _, h in rows}
    for r in got:
        h = html[r["page_id"]]
        keep = last[h]
        assert r["payload_bytes"] == len(h.encode()) and r["payload_digest"] == warc.sha1(h.encode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == keep else ("revisit", keep))
    some = {r["page_id"]: r["record_type"] for r in warc.round_trip(pages(spark, rows), min_bytes=30).collect()}
    assert some[0] == "response" and some[39] == "revisit"
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_warc_checks(tmp_path):
    raw = warc.record(1, "u", b"abc", warc.sha1(b"abc"))
    assert warc.parse(raw)[2] == b"abc"
    for bad in (raw[:-1], raw.replace(b"abc", b"abd"), raw.replace(b"WARC/1.1", b"WARC/9"), raw.replace(b"Content-Length: 3", b"Content-Length: 4"), raw.replace(b"WARC-Date", b"X-Date")):
        with pytest.raises((warc.WarcError, ValueError)):
            warc.parse(bad)
    path = str(tmp_path / "x.warc.zst")
    for dictionary in (b"", b"some raw content", warc._train([raw] * 200, 4096)):
        w = warc.Writer(path, dictionary)
        for _ in range(3):
            w.add(raw)
        w.close()
        assert list(warc.read_archive(path, chunk=7)) == [raw] * 3
    data = open(path, "rb").read()
    for cut in (data[:-3], data[:6], b"\0" * 20):
        open(path, "wb").write(cut)
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(path))


SPACES = " \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u1680\u180e\u2000\u2005\u200a\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=SPACES + "aé€あ\U0001f600", max_size=12), max_size=8))
def test_chunks_are_those_of_the_pattern(texts):
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    begins = ends - [len(r) for r in raw] if raw else np.empty(0, np.int64)
    data = b"".join(raw)
    if data:
        at = [*tokens.chunk_starts(data, begins[begins < ends]).tolist(), len(data)]
        whole = re.compile(rf"[{tokens._WS}]*[^{tokens._WS}]+|[{tokens._WS}]+").findall
        assert [data[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)] == [c for t in texts for c in whole(t)]


def test_texts_are_encoded_without_a_search_per_chunk():
    """Chunks are cut, told apart and put together as columns, a few steps a call."""
    import public_tokenizers

    e = tokens.Encoder(public_tokenizers.path(token_files.VOCABULARY), leading=True)
    texts = [prose(k, 200) + SPACES + "é　 x." for k in range(20)] + [None, "", "\n", "a<|endoftext|> b"]
    e._split = None  # the pattern that would be searched text by text
    assert e(texts) == [e.whole(t or "") for t in texts]
    assert e([]) == [] and e([None, ""]) == [b"", b""] and e(["<|endoftext|>"]) == [e.whole("<|endoftext|>")]


def test_scratch_tables_are_plain_files(spark):
    """No checksum file and so no helper process for each part of a scratch table."""
    df, path = common.stored(spark.range(100).repartition(3), "plain")
    names = os.listdir(path.removeprefix("file://"))
    assert df.count() == 100 and sum(n.startswith("part-") for n in names) == 3
    assert not [n for n in names if n.endswith(".crc")]


def test_workers_give_back_what_they_hold(monkeypatch):
    """A tidied task begins without another operator's cache and returns memory, Arrow's too, when it ends."""
    steps = []
    monkeypatch.setattr(common, "trim", lambda: steps.append("trim"))
    common.held("cache", lambda: [0])
    out = common.tidy(lambda batches: (steps.append((b, dict(common._HELD))) or b for b in batches))(iter([1, 2]))
    assert list(out) == [1, 2] and steps == ["trim", (1, {}), (2, {}), "trim"]
    monkeypatch.undo()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: steps.append("pool")})())
    common.trim()
    assert steps[-1] == "pool"
