"""Learnt operators by held-out accuracy, page text by known articles, the pipeline by brute force."""

from __future__ import annotations

import os
import random
import re

import numpy as np
import pytest

from millwright.llm import html_extract, quality, toxicity

from .test_small_operators import AWKWARD, brute_components, documents, normal, prose


def toxic_corpus(n, seed):
    r, rows = random.Random(seed), []
    for i in range(n):
        words = prose(10_000 * seed + i, r.randint(20, 200)).split()
        y = i % 8 == 0
        if y:
            for _ in range(4):
                words[r.randrange(len(words))] = r.choice(["zzgrob", "zzgrobly", "idiot", "qqnast"])
        rows.append((" ".join(words), int(y)))
    return rows


def test_toxicity_learns_words_and_calibrates():
    train, test = toxic_corpus(1200, 1), toxic_corpus(400, 2)
    model = toxicity.fit([t for t, _ in train], np.array([y for _, y in train]))
    s = model.score(toxicity.Featurizer(model.learnt)([t for t, _ in test]))
    y = np.array([y for _, y in test])
    assert ((s >= 0.5) == y).mean() > 0.97 and s.min() >= 0 and s.max() <= 1
    assert np.array_equal(s, model.score(toxicity.Featurizer(model.learnt)([t for t, _ in test])))


def test_copies_do_not_make_a_lexicon():
    r = random.Random(1)
    copies = [prose(5, 100) + f" idiot moron {prose(900 + k, 3)}" for k in range(30)]
    clean = [prose(50 + k, r.randint(30, 120)) for k in range(200)]
    found = toxicity.induce_lexicon([toxicity._words(t) for t in copies + clean], np.array([1] * 30 + [0] * 200))
    assert not found


def test_obfuscation_is_seen():
    f = toxicity.Featurizer()
    for token in ("1d1ot", "id!ot", "st*pid"):
        assert f.flags(token) & (toxicity.HIDDEN | toxicity.MASKED)
    assert f.flags("idiooooot!") & toxicity.STRETCHED and not f.flags("ordinary")


def test_kinds_are_counted_over_the_whole_text():
    f = toxicity.Featurizer({"=badword": 3, "=otherbad": 3, "=thirdbad": 3})
    kinds = lambda text: f.row(text)[4]
    assert kinds("badword " * 300 + "otherbad thirdbad") == 3 == kinds("badword otherbad thirdbad")


def test_isotonic_is_increasing():
    rng = np.random.default_rng(1)
    m = rng.random(300)
    x, p = toxicity.isotonic(m, (rng.random(300) < m).astype(float))
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= 0).all() and 0 < p[0] < p[-1] < 1


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(documents(spark, AWKWARD), labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.toxicity(documents(spark, []), labels.limit(0)).count() == 0
    assert toxicity.clean_documents(documents(spark, AWKWARD), labels).columns == documents(spark, AWKWARD).columns


def test_quality(spark):
    # running text in its usual dress, and four kinds of junk
    def good(i):
        w = prose(i, 60).split()
        for k in range(0, 60, 3):
            w[k] = ("the", "and", "of")[k % 9 // 3]
        return "\n".join(" ".join(w[k : k + 15]).capitalize() + "." for k in range(0, 60, 15))

    junk = [lambda i: " ".join(w + "###" for w in prose(i, 60).split()), lambda i: " ".join(w.upper() + "!!" for w in prose(i, 60).split()), lambda i: " ".join(w for w in prose(i, 6).split() for _ in range(20)), lambda i: " | ".join(prose(i, 60).split())]
    rows = [(i, good(i), "s") for i in range(300)] + [(1000 + i, junk[i % 4](i), "s") for i in range(60)] + [(2000, None, None), (2001, "", "s")]
    got = {r["doc_id"]: r for r in quality.quality(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert np.mean([got[i]["kept"] for i in range(300)]) > 0.98
    assert np.mean([got[1000 + i]["kept"] for i in range(60)]) < 0.05
    assert not got[2000]["kept"] and not got[2001]["kept"]
    assert quality.quality(documents(spark, [])).count() == 0


ARTICLE = "<h1>Title {i}</h1><p>First &amp; foremost {a}.<p>Second\n  <b>bold</b> {b}"
SITES = {
    "semantic": "<html><head><title>t{i}</title><script>var x='</p>{i}'</script></head><body><nav><a href=/>home{i}</a></nav><header>Site</header><article>{art}<div class=comments><p>comment {b}</div></article><aside>side {i}</aside><footer>&copy; {i}</footer>",
    "bare": "<body><div class='x1'><a href=/a>One</a> <a href=/b>Two</a></div><div class=x2>{art}</div><div class=x3>Subscribe to our letter</div><form><input><p>search {i}</form><div id=cookie-notice>cookies {i}</div><div style='display:none'>hidden {i}</div>",
}


@pytest.mark.parametrize("site", SITES)
def test_main_text(spark, site):
    rows, want = [], {}
    for i in range(12):
        a, b = prose(i, 40), prose(100 + i, 40)
        html = SITES[site].replace("{art}", ARTICLE).format(i=i, a=a, b=b)
        rows.append((i, f"http://{site}.example/{i}", html))
        want[i] = f"Title {i}\nFirst & foremost {a}.\nSecond bold {b}"
    rows += [(50, None, None), (51, f"http://{site}.example/x", ""), (None, f"http://{site}.example/y", "<p>")]
    got = html_extract.main_texts(spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, html string, host string, part string")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == want.get(r["page_id"], "") and r["n_chars"] == len(r["text"])


def test_copies_of_an_article_are_not_a_template():
    page = SITES["semantic"].replace("{art}", ARTICLE).format(i=1, a=prose(1, 50), b=prose(2, 50))
    assert all(prose(1, 50) in t for t in html_extract.extract([page] * 10))


def test_template_nests():
    names = html_extract.Interner()
    pages = [html_extract.parse(f"<body><ul>{'<li><i>'  + str(k) + '</i></li>' * 1}{'<li><i>z</i></li>' * k}</ul><p>{prose(k, 9)}</p>", names) for k in range(1, 7)]
    template = html_extract.deduce(pages)
    assert len(template) == 2 and template[1].parent == 0


def test_head_without_end_tag():
    page = "<html><head><title>t</title><meta name=a>{body}<article><p>text"
    for body in ("<body>", "<body class=x>", "", "<div>"):
        assert html_extract.extract([page.format(body=body)]) == ["text"]
    assert html_extract.extract(["<head><style>p {}</style><noscript>off</noscript><p>text</p>"]) == ["text"]
    assert html_extract.extract(["<head><title>t</title>text <b>bold</b>"]) == ["text bold"]


def test_no_part_of_the_article_is_dropped():
    one = lambda page: html_extract.extract([page])[0]
    assert one("<main><h1>Title</h1><p>Lead</p><article>body of the whole page</article></main>") == "Title\nLead\nbody of the whole page"
    assert one("<article><p>the larger part</p></article><article><p>smaller</p></article>") == "the larger part\nsmaller"
    assert one("<article><p>text</p><ul><li><a href=/1>First source</a><li><a href=/2>Second</a></ul></article>") == "text\nFirst source\nSecond"
    assert one("<main><p>text</p><article class=comment>no</article><article class='teaser x'><p>more</p></article></main>") == "text"
    assert one("<div><ul><li><a href=/1>Home</a></ul><p>text</p></div>") == "text"


#: Sites without a telling element name, class or id; text in {} changes from page to page, [] marks the article.
PLAIN = {
    "wrapped": "<body><div class=q1>Our paper since 1900</div><div class=q7>Visitor {n} since Monday</div><div class=q2>[<h1>{t}</h1><p>{a}<p>{b}]</div><div class=q3>{short}</div><div class=q4>Subscribe to our letter</div>",
    "title beside": "<body><div class=z><div>Today {n} readers came here</div>[<h1>{t}</h1><div class=q2><p>{a}<p>{b}</div>]</div><table><tr><td>{short}</table>",
    "flat": "<body><p class=q1>Page number {n} of the paper</p><b class=z>x</b>[<p class=q5>{a}</p><p class=q5>{b}</p>]<p class=q8>{n}</p>",
    "misnamed": "<body><div class='sidebar widget'>[<h2>{t}</h2><p>{a}<p>{b}]</div><div class=q3>{short}</div>",
    "misplaced": "<body><article><p>{short}</article><div class=q2>[<p>{a}<p>{b}]</div>",
}


def plain_pages(site, n, seed=0):
    for i in range(n):
        parts = {"n": 1000 + 17 * i, "t": prose(seed + 7 * i + 1, 5), "a": prose(seed + 7 * i + 2, 60 + i), "b": prose(seed + 7 * i + 3, 40), "short": prose(seed + 7 * i + 4, 8)}
        source = PLAIN[site]
        article = re.findall(r"{(\w+)}", source[source.index("[") : source.index("]")])
        yield source.replace("[", "").replace("]", "").format(**parts), "\n".join(parts[k] for k in article)


@pytest.mark.parametrize("site", PLAIN)
def test_slots_decide(site, monkeypatch):
    pages, want = zip(*plain_pages(site, 14), strict=True)
    assert html_extract.extract(list(pages)) == list(want)
    monkeypatch.setattr(html_extract, "deduce", lambda pages: [])
    assert html_extract.extract(list(pages)) != list(want)


def test_long_comments_outside_the_article():
    page = "<body><div class=q1><p>{a}<p>{b}</div><div id=comments><p>{c}</div>"
    pages = [page.format(a=prose(i, 50), b=prose(40 + i, 20), c=prose(90 + i, 30 * (i % 3))) for i in range(9)]
    assert html_extract.extract(pages) == [f"{prose(i, 50)}\n{prose(40 + i, 20)}" for i in range(9)]


def test_main_text_is_the_same_for_any_partitioning(spark):
    rows = [(1000 * h + i, f"http://{h}.example/{i}", html) for h, site in enumerate(PLAIN) for i, (html, _) in enumerate(plain_pages(site, 30 + 40 * h, 5000 * h))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = [{r["page_id"]: r["text"] for r in html_extract.main_texts(pages.repartition(*by)).collect()} for by in ((1,), (6, "page_id"), (3, "html"))]
    assert texts[0] == texts[1] == texts[2] and len(texts[0]) == len(rows)
    assert texts[0] == {1000 * h + i: text for h, site in enumerate(PLAIN) for i, (_, text) in enumerate(plain_pages(site, 30 + 40 * h, 5000 * h))}


def test_variety_is_that_of_the_whole_text():
    varied, looped = [f"w{i}" for i in range(2000)], ["a", "b"] * 1000
    votes_bad = lambda words: quality.LABELLERS["variety"](quality.measures(" ".join(words))) == quality.BAD
    assert votes_bad(varied + looped * 10) and not votes_bad(looped + varied * 10)
    assert quality.variety(varied[:100]) == 1 and quality.variety(varied + varied[:1]) == 1 and quality.variety([]) == 0
    assert quality.variety(looped + varied[:1000]) == pytest.approx((2000 * 2 / 2000 + 1000 * 1002 / 2000) / 3000)


@pytest.mark.parametrize("partitions", [1, 7])
def test_every_page_of_a_host_has_its_template(spark, partitions):
    page = "<body><div class=x1>Our paper since 1900</div><div class=x2><p>{a}</p></div><div class=x3>All rights are ours</div>"
    rows = [(100 * h + i, f"http://h{h}.example/{i}", page.format(a=prose(100 * h + i, 30))) for h, n in enumerate((3, 4, 9, 65, 66, 67, 131)) for i in range(n)]
    got = html_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(partitions)).collect()
    assert {(r["page_id"], r["text"]) for r in got} == {(i, prose(i, 30)) for i, _, _ in rows} and len(got) == len(rows)


def test_chunks(monkeypatch):
    sizes = lambda n, html="": [len(c) for c in html_extract.chunks(iter([(i, "", html, "h", 0) for i in range(n)]))]
    assert sizes(64) == [64] and sizes(66) == [66] and sizes(67) == [64, 3] and sizes(130) == [64, 66]
    monkeypatch.setattr(html_extract, "CHUNK_CHARS", 10)
    assert sizes(8, "x" * 20) == [3, 5] and sizes(2, "x" * 20) == [2]


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as p

    docs = p.table(spark, SF, "documents")
    names = [n for n, _ in p.STAGES]
    assert len(names) == 5 and p.ORACLE_SQL is None
    held = {}
    for k, (name, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
        held[name] = [r.asDict() for r in out.collect()]
        docs = spark.createDataFrame(out.collect(), out.schema)
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(p.table(spark, SF, "documents"), p.table(spark, SF, "labels")).collect()}
    assert {r["doc_id"] for r in held["toxicity"]} == {i for i, s in scores.items() if s < 0.5}
    first = {}
    for r in sorted(held["toxicity"], key=lambda r: r["doc_id"]):
        first.setdefault(normal(r["text"]), r["doc_id"])
    assert {r["doc_id"] for r in held["exact dedup"]} == set(first.values())
    rows = [(r["doc_id"], r["text"], r["source"]) for r in held["exact dedup"]]
    assert {r["doc_id"] for r in held["near dedup"]} == {d for d, _, c in brute_components(rows) if d == c}
    texts = {r["doc_id"]: r["text"] for r in held["near dedup"]}
    assert all(texts[r["doc_id"]].lstrip().startswith(r["text"].strip()[:50]) for r in held["source mix"])
    per_doc = {}
    for r in held["packing"]:
        per_doc[r["doc_id"]] = per_doc.get(r["doc_id"], 0) + r["length"]
    assert set(per_doc) == {r["doc_id"] for r in held["source mix"]}


@pytest.mark.parametrize("empty", [True, False])
def test_pipeline_of_awkward_tables(spark, tmp_path, empty):
    import corpus_pipeline as p

    rows = [] if empty else [(1, None, "en", None, None, "x"), (2, "", "en", "a", 0, "x"), (None, "some words here", "en", "a", 15, "x"), (3, "some words here", None, "a", 15, None), (3, "some words here", None, "a", 15, None), (4, "other words " * 9000, "en", "b", 108000, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([] if empty else [(4, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = p.run(spark, str(tmp_path)).collect()
    assert bool(got) != empty and {r["doc_id"] for r in got} <= {3, 4, None}
    assert all(r["length"] > 0 and r["offset"] + r["length"] <= 2048 for r in got)


def test_mix_stage_keeps_the_order_of_the_slots(spark):
    from millwright.llm import mixing

    rows = [(k, prose(k, 30 + k % 50), "abc"[k % 3]) for k in range(400)]
    docs = documents(spark, rows)
    sizes = {d: len(t.split()) for d, t, _ in rows}
    mixed = mixing.mixed_documents(docs, block_words=64).rdd.mapPartitionsWithIndex(lambda k, part: [(k, r["doc_id"], r["text"]) for r in part]).collect()
    at, shares, _ = mixing.plan(docs, block_words=64)
    order = {(r["src"], r["rank"]): r["slot"] for r in mixing.schedule(shares, 64).collect()}
    readings = sorted((order[r["src"], r["at"] // 64], r["at"], r["doc_id"]) for r in mixing.readings(at, shares).collect())
    assert [d for _, d, _ in mixed] == [d for _, _, d in readings] and sorted(k for k, _, _ in mixed) == [k for k, _, _ in mixed]
    whole = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    taken = {}
    for _, d, text in mixed:
        taken[d] = taken.get(d, 0) + len(text.split())
        assert len(text.split()) <= sizes[d]
    assert taken == {d: n for d, n in whole.items() if n}


def test_estimate_maximises_the_likelihood():
    """Expectation-maximisation against the same steps written row by row."""
    r = np.random.default_rng(5)
    k = len(quality.LABELLERS)
    truth = r.random(300) < 0.8
    votes = np.full((300, k), quality.ABSTAIN)
    for j in range(k):
        hit = r.random(300) < 0.4
        votes[hit & ~truth, j] = quality.BAD
        if j in (6, 9):
            votes[hit & truth, j] = quality.GOOD
    codes, counts = np.unique((votes * 3 ** np.arange(k)[::-1]).sum(axis=1), return_counts=True)
    posterior, table, prior = quality.estimate(codes, counts, rounds=400)
    start = np.array([quality.VOUCHER if name in quality.VOUCHING else quality.ACCUSER for name in quality.LABELLERS])
    good_now = [posterior[list(codes).index(c)] for c in (votes * 3 ** np.arange(k)[::-1]).sum(axis=1)]
    assert prior == pytest.approx((sum(good_now) + 0.8) / 301, abs=1e-6)
    for j in range(k):
        for c in (0, 1):
            weight = [quality.BELIEF * start[j, c, v] + sum((g if c else 1 - g) for g, row in zip(good_now, votes, strict=True) if row[j] == v) for v in range(3)]
            assert table[j, c] == pytest.approx(np.array(weight) / sum(weight), abs=1e-6)
    assert np.mean((np.array(good_now) > 0.5) == truth) > 0.9


def test_one_tree_is_the_best_split():
    """A stump against all splits tried one by one."""
    r = np.random.default_rng(8)
    x, y = r.integers(0, 6, (200, 3)).astype(float), None
    y = (x[:, 1] > 2).astype(float) * (r.random(200) < 0.9)
    model = toxicity.Boosted().fit(x, y, trees=1, depth=1, rate=1.0, bins=200, leaf=1, l2=1.0)
    feature, threshold, value = model.trees[0]
    p = y.mean()
    g, h = y - p, np.full(200, p * (1 - p))

    def gain(j, cut):
        left = x[:, j] <= cut
        part = [g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left)]
        return sum(part)

    tried = {(j, cut): gain(j, cut) for j in range(3) for cut in range(6) if 0 < (x[:, j] <= cut).sum() < 200}
    assert (feature[0], threshold[0]) == max(tried, key=tried.get)
    left = x[:, feature[0]] <= threshold[0]
    assert value[1] == pytest.approx(g[left].sum() / (h[left].sum() + 1)) and value[2] == pytest.approx(g[~left].sum() / (h[~left].sum() + 1))


def test_isotonic_is_the_best_increasing_fit():
    y = np.array([0, 1, 0, 0, 1, 1, 0, 1.0])
    x, p = toxicity.isotonic(np.arange(8.0), y)
    pools = [(0, 1), (1, 4), (4, 7), (7, 8)]
    means = [y[a:b].mean() for a, b in pools]
    assert means == sorted(means)
    assert p[::2] == pytest.approx([(y[a:b].sum() + 0.5) / (b - a + 1) for a, b in pools]) and x[::2].tolist() == [a for a, _ in pools]


def test_fitting_samples_are_bounded_by_rows_only(spark):
    rows = [(f"d{i}", t, "s") for i, (t, _) in enumerate(toxic_corpus(400, 3))]
    long = " ".join(prose(9, 200) for _ in range(30)) + " zzgrob idiot qqnast"
    rows += [("long", long, "s")] + [("again", "the same text of the same row", "s")] * 200
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    labels = spark.createDataFrame([(f"d{i}", y) for i, (_, y) in enumerate(toxic_corpus(400, 3))] + [("long", 1), ("again", 0)], "doc_id string, toxic int")
    chosen = toxicity.sample(docs, labels).collect()
    assert len({r["key"] for r in chosen}) == len(chosen) <= 402 and max(len(r["text"]) for r in chosen if r["key"] != "long") < len(long)
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    assert all(0 <= s <= 1 for s in got.values())
    few = toxicity.toxicity(docs, labels.limit(30))
    assert few.filter("score < 0 or score > 1").count() == 0 and few.count() == len(rows)
    graded = {r["doc_id"]: r["kept"] for r in quality.quality(docs, sample_rows=50).collect()}
    assert len(graded) == 402


def test_recall_of_the_hashing():
    from millwright.llm import vector_dedup

    r = np.random.default_rng(4)
    a = r.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.normal(size=(4000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    hasher = vector_dedup.Hasher(64)
    for cosine, least in ((0.93, 0.99), (0.96, 0.999)):
        near = cosine * a + np.sqrt(1 - cosine**2) * b
        assert (hasher(a) == hasher(near)).any(axis=1).mean() >= least
