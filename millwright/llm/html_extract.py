"""Main text of web pages by deducing the templates of their hosts.

Pages of one host are read as streams of tags and words, each named by its path
of open elements. Tokens with the same vector of occurrences over the pages form
an equivalence class; a class is valid if its tokens come in one order in every
page, and valid classes nest into each other's slots to make the template. What
the template does not explain is left in its slots.

Slots decide what is article: those whose content changes from page to page and
is prose. The article is the deepest element, standing once in every page, whose
slots hold most of that prose; text outside it, text that is mostly template, and
slots of a few words are furniture that changes from page to page. Element names
and words in classes count where slots do not speak: inside the article, where
article or main elements hold most of the prose anyway, and on hosts with too few
pages for a template.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

#: Pages that share one deduction, and the fewest unlike pages it needs.
CHUNK_PAGES, LEAST_PAGES = 64, 3
#: Characters that end a chunk early.
CHUNK_CHARS = 16 << 20

#: Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split()
)
FURNITURE = frozenset("nav footer aside form script style noscript template iframe head title button select textarea svg canvas object menu dialog search noembed noframes xmp".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CLOSES_ITS_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
KEEPS_OPEN = frozenset("article aside body div dl fieldset figure footer form header main nav ol section table td th ul blockquote html".split())
#: Words in class, id or role that name page furniture.
FURNITURE_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist respond
    disqus consent cookie cookies gdpr notice notices alert popup popover modal overlay dialog footer foot header masthead topbar toolbar
    hidden menu menubar nav navbar navigation navigationbar pager pagination promo promoted promotion related recommended recommendations
    search searchbox share sharing sidebar sidenav side skip social sponsor sponsored subscribe subscription newsletter signup login
    tagcloud tags toc widget widgets copyright legal complementary contentinfo replies reply discussion feedback""".split()
)
#: Words in class, id or role of articles that only point to another page.
TEASER_WORDS = frozenset("teaser teasers".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


@dataclass
class Element:
    name: str
    path: int
    furniture: bool  # by element name, or hidden
    named: int  # path of the outermost element that class, id or role call furniture, or -1
    main: int  # path of the outermost article or main element, or -1
    teaser: bool  # in one that is marked as a teaser of another page
    header: bool


@dataclass
class Block:
    """A run of text between block-level tags."""

    words: list[str]
    path: int
    furniture: bool
    named: int
    main: int
    teaser: bool
    linked: int  # characters inside links
    heading: int  # level, or 0
    header: bool


@dataclass
class Page:
    tokens: list[int]  # tags in page order; -1 - k stands for the words of block k
    blocks: list[Block]


def _attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(raw)}


def _words(attributes: dict[str, str]) -> set[str]:
    """The words of class, id and role."""
    named = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    return set(_NAMES.findall(_CAMEL.sub(r"\1 \2", named).lower()))


def _is_furniture(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is no article by its name, or hidden."""
    if name in FURNITURE or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return "style" in attributes and bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes["style"]))


def _is_named_furniture(name: str, attributes: dict[str, str]) -> bool:
    """Whether class, id or role of an element call it furniture."""
    if name in ("body", "html", "main"):
        return False
    words = _words(attributes)
    if name == "article":
        words -= {"hidden", "tags", "side", "notice", "alert", "legal", "feedback", "discussion"}
    return bool(words & FURNITURE_WORDS)


class Interner(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def parse(source: str, names: Interner) -> Page:
    """Tags and text blocks of one page; ``names`` numbers paths and path-qualified tags."""
    tokens, blocks = [], []
    stack = [Element("", names["", 0], False, -1, -1, False, False)]
    parts: list[tuple[str, bool]] = []
    links = 0

    def flush() -> None:
        if not parts:
            return
        words, linked = "".join(t for t, _ in parts).split(), sum(len(t) for t, a in parts if a)
        top = stack[-1]
        parts.clear()
        if words:
            tokens.append(-1 - len(blocks))
            heading = max((int(e.name[1]) for e in stack[-3:] if e.name in ("h1", "h2", "h3", "h4", "h5", "h6")), default=0)
            blocks.append(Block(words, top.path, top.furniture, top.named, top.main, top.teaser, linked, heading, top.header))

    def close(k: int) -> None:
        nonlocal links
        for e in stack[k:]:
            links -= e.name == "a"
        del stack[k:]

    def leave_head(name: str) -> None:
        """Closes a head without an end tag before what cannot stand in one."""
        if stack[-1].name == "head" and name not in IN_HEAD or name == "body":
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name in ("head", "template")), None)
            if k is not None and stack[k].name == "head":
                flush()
                close(k)

    at, skip_to = 0, None
    lower = None
    while at < len(source):
        m = _TOKEN.match(source, at)
        if m is None:  # a tag that never ends
            break
        at = m.end()
        end, name, raw, text = m[1], m[2], m[3], m[4]
        if text is not None:
            if stack[-1].name == "head" and text.strip():
                leave_head("")
            parts.append((html.unescape(text) if "&" in text else text, links > 0))
            continue
        if name is None:
            continue
        name = name.lower()
        if end:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), None)
            if name in BLOCKS:
                flush()
            if k is not None:
                if name in BLOCKS or not any(e.name in KEEPS_OPEN for e in stack[k + 1 :]):
                    tokens.append(names["/", stack[k].path])
                    close(k)
            continue
        leave_head(name)
        if name in BLOCKS:
            flush()
            if name not in ("html", "body"):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == "p":
                        close(i)
                        break
                    if stack[i].name in KEEPS_OPEN or stack[i].name in ("li", "dd", "dt"):
                        break
        if name in CLOSES_ITS_LIKE:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in CLOSES_ITS_LIKE[name]:
                    close(i)
                    if name != "tr":
                        break
                elif stack[i].name in ("ul", "ol", "dl", "table", "select", "menu"):
                    break
        if name == "br" or name == "wbr":
            parts.append((" " if name == "br" else "", False))
            continue
        attributes = _attributes(raw) if raw.strip(" /") else {}
        top = stack[-1]
        kind = f"{name}.{attributes.get('class', '')}"
        path = names[kind, top.path]
        tokens.append(names["<", path])
        if name in VOID:
            continue
        if name in RAW:
            if lower is None:
                lower = source.lower()
            to = lower.find(f"</{name}", at)
            skip_to = source.find(">", to) + 1 if to >= 0 else len(source)
            at = skip_to or len(source)
            continue
        furniture = top.furniture or _is_furniture(name, attributes) or (name == "header" and top.main < 0)
        named = path if top.named < 0 and attributes and _is_named_furniture(name, attributes) else top.named
        marked = not furniture and named < 0 and (name in ("article", "main") or attributes.get("role") in ("main", "article") or attributes.get("itemprop") == "articleBody")
        teaser = top.teaser or (marked and not TEASER_WORDS.isdisjoint(_words(attributes)))
        links += name == "a"
        stack.append(Element(name, path, furniture, named, path if marked and top.main < 0 else top.main, teaser, top.header or (name == "header" and top.main >= 0)))
    flush()
    return Page(tokens, blocks)


def unlike(pages: list[Page]) -> list[Page]:
    """Pages of which none shares most of its words with one before it.

    Copies of one article would make their article look like a template.
    """
    kept: list[Page] = []
    sizes: list[int] = []
    holders: dict[str, list[int]] = defaultdict(list)
    for page in pages:
        own = set(chain.from_iterable(b.words for b in page.blocks if not b.furniture and b.named < 0))
        shared = Counter(chain.from_iterable(map(holders.__getitem__, own & holders.keys())))
        if all(2 * k <= min(len(own), sizes[i]) for i, k in shared.items()):
            for t in own:
                holders[t].append(len(kept))
            kept.append(page)
            sizes.append(len(own))
    return kept


@dataclass
class EquivalenceClass:
    tokens: list  # in template order: numbers of tags, (word, path) of words
    parent: int | None = None
    slot: int = 0


def _stream(page: Page, frequent: set[str]) -> Iterator[tuple[int, object]]:
    """(place, token) of a page's tags and of those words that are frequent, by path."""
    at = 0
    for t in page.tokens:
        if t >= 0:
            yield at, t
            at += 1
        else:
            block = page.blocks[-1 - t]
            if not frequent.isdisjoint(block.words):
                for k, w in enumerate(block.words):
                    if w in frequent:
                        yield at + k, (w, block.path)
            at += len(block.words)


def deduce(pages: list[Page], least: int = LEAST_PAGES) -> list[EquivalenceClass]:
    """The template of pages: valid equivalence classes, each nested in a slot of its parent.

    A class has two tokens or more that stand equally often in each page, and in
    most pages at all. Tokens out of the class's order are left out of it. A
    class that fits in no single slot of a larger one stays out of the template.
    """
    n = len(pages)
    if n < least:
        return []
    bar = max(n // 2, least - 1)
    of_words = Counter(chain.from_iterable(set(chain.from_iterable(b.words for b in page.blocks)) for page in pages))
    frequent = {w for w, k in of_words.items() if k > bar}
    streams = [list(_stream(page, frequent)) for page in pages]
    most = Counter(chain.from_iterable({t for _, t in stream} for stream in streams))
    places: dict[object, list[list[int]]] = {t: [[] for _ in range(n)] for t, k in most.items() if k > bar}
    for i, stream in enumerate(streams):
        for at, t in stream:
            if t in places:
                places[t][i].append(at)
    by_vector: dict[tuple[int, ...], list] = defaultdict(list)
    for t, where in places.items():
        by_vector[tuple(map(len, where))].append(t)
    found = []
    for vector, tokens in sorted(by_vector.items(), key=lambda x: (x[0] != (1,) * n, -len(x[1]))):
        sample = next(i for i, v in enumerate(vector) if v)
        tokens.sort(key=lambda t: places[t][sample][0])
        ordered: list = []
        for t in tokens:
            before = places[ordered[-1]] if ordered else None
            after_first = places[ordered[0]] if ordered else None
            ok = before is None or all(
                b < a and (k + 1 == len(page_t) or a < first[k + 1])
                for page_b, page_t, first in zip(before, places[t], after_first, strict=True)
                for k, (b, a) in enumerate(zip(page_b, page_t, strict=True))
            )
            if ok:
                ordered.append(t)
        if len(ordered) > 1:
            found.append(EquivalenceClass(ordered))
    template: list[EquivalenceClass] = []
    for c in found:
        home = None
        for k in range(len(template) - 1, -1, -1):
            slots = {_slot(template[k], places, i, at) for t in (c.tokens[0], c.tokens[-1]) for i in range(n) for at in places[t][i]}
            if len(slots) == 1 and None not in slots:
                home = (k, slots.pop())
                break
        if home or not template:
            c.parent, c.slot = home or (None, 0)
            template.append(c)
    return template


def _slot(c: EquivalenceClass, places, page: int, at: int) -> int | None:
    """The slot of class ``c`` in which a place of a page lies: 1 after its first token, and so on."""
    starts = places[c.tokens[0]][page]
    k = int(np.searchsorted(starts, at, "right")) - 1
    if k < 0:
        return None
    row = [places[t][page][k] for t in c.tokens]
    s = int(np.searchsorted(row, at, "right"))
    return s if s < len(c.tokens) else None


@dataclass
class Judgement:
    """What the slots of a template say about a host's pages."""

    fixed: set = field(default_factory=set)  # (word, path) of template words
    article: int | None = None  # path of the element that holds the article; None: article and main elements do
    around: tuple[int, ...] = ()  # that path and the paths of the elements around it
    counters: set = field(default_factory=set)  # paths of slots with a few words that change


#: Share of the host's prose that an article's element holds, and words of a slot that is prose.
ARTICLE_SHARE, SLOT_WORDS = 2 / 3, 4


def ancestors(names: Interner) -> list[tuple[int, ...]]:
    """For each path its chain of paths, itself first; empty for tags."""
    out: list[tuple[int, ...]] = []
    for k, (kind, parent) in enumerate(names):
        out.append(() if kind in ("<", "/") else (k, *out[parent]) if k else (k,))
    return out


def _explained(b: Block, fixed: set) -> bool:
    """Whether the template explains a block: a heading in whole, other text for more than half."""
    known = sum((w, b.path) in fixed for w in b.words)
    return known == len(b.words) if b.heading else 2 * known > len(b.words)


def _mostly_links(b: Block) -> bool:
    return b.linked * 10 > 8 * sum(map(len, b.words)) and not b.heading


def judge(pages: list[Page], names: Interner) -> Judgement | None:
    """The slots of the pages' template, or None where they have none.

    ``pages`` are unlike each other. Prose counts by words left in slots, menus and
    mostly fixed blocks aside, whatever class, id or role call them. Where the
    deepest element that holds the article lies in an article or main element, the
    outermost such element is the article; where it is the body only, slots do not
    tell, and article and main elements decide if they hold half of the prose.
    """
    template = deduce(pages)
    if not template:
        return None
    out = Judgement({t for c in template for t in c.tokens if isinstance(t, tuple)})
    once = set.intersection(*({t for t, k in Counter(t for t in page.tokens if t >= 0).items() if k == 1} for page in pages))
    chains, kinds = ancestors(names), [kind for kind, _ in names]
    unique = {path for path in range(len(chains)) if chains[path] and names.get(("<", path), -1) in once}
    prose, marked, outermost = Counter(), 0, set()
    slots: dict[int, list[int]] = defaultdict(list)
    for page in pages:
        for b in page.blocks:
            if b.furniture or (b.header and not b.heading) or _explained(b, out.fixed) or _mostly_links(b):
                continue
            prose[b.path] += len(b.words)
            if b.main >= 0:
                outermost.add(b.main)
                marked += len(b.words) * (not b.teaser and b.named < 0)
            if b.path in unique and not b.heading:
                slots[b.path].append(len(b.words))
    total, below = prose.total(), Counter()
    for path, words in prose.items():
        for up in chains[path]:
            below[up] += words
    holders = [path for path, words in below.items() if path in unique and words >= ARTICLE_SHARE * total]
    article = max(holders, key=lambda path: len(chains[path]), default=None)
    if article is None or kinds[article].split(".")[0] in ("html", "body") and 2 * marked >= total:
        return out
    out.article = next((path for path in chains[article] if path in outermost), article)
    out.around = chains[out.article]
    if out.article not in outermost:
        out.counters = {path for path, words in slots.items() if sum(words) < SLOT_WORDS * len(words)}
    return out


def main_text(page: Page, judged: Judgement | None, chains: list[tuple[int, ...]]) -> str:
    """The text left in the slots of the article, one line per block.

    Inside the article, and wherever the slots do not tell, elements that class, id
    or role call furniture are left out, and so are teasers next to other articles.
    A page without the host's article element is read as if there were no template
    but its fixed words. A title of the first level may stand outside the article.
    """
    judged = judged or Judgement()
    blocks = [b for b in page.blocks if not b.furniture and (b.named < 0 or b.named in judged.around) and (b.heading or not b.header) and not _explained(b, judged.fixed)]
    if judged.article is not None and any(judged.article in chains[b.path] for b in blocks):
        blocks = [b for b in blocks if judged.article in chains[b.path] or b.heading == 1]
        blocks = [b for b in blocks if (b.main >= 0 or not _mostly_links(b)) and b.path not in judged.counters]
        return _joined([b for b in blocks if not b.teaser] or blocks)
    if inside := [b for b in blocks if b.main >= 0]:
        return _joined([b for b in inside if not b.teaser] or inside)
    return _joined([b for b in blocks if not _mostly_links(b)])


def _joined(blocks: list[Block]) -> str:
    return "\n".join(" ".join(b.words) for b in blocks)


def extract(sources: list[str | None]) -> list[str]:
    """Main texts of pages that share a host; null counts as empty."""
    names = Interner()
    pages = [parse(s or "", names) for s in sources]
    judged = judge(unlike(pages), names)
    chains = ancestors(names)
    return [main_text(p, judged, chains) for p in pages]


def _host(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (url) to (host, n), several rows a host where a task has very many hosts."""
    counts: Counter[str] = Counter()
    out = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["host", "n"])
    for batch in batches:
        counts.update(map(_host, batch.column(0).to_pylist()))
        if len(counts) > 1 << 16:
            yield out()
            counts.clear()
    yield out()


def host_parts(pages: DataFrame) -> dict[str, int]:
    """Parts of the hosts with two chunks or more and over 1/1024 of all pages, so 1,023 hosts at most."""
    per_host = materialise(pages.select("url").mapInArrow(_counted, "host string, n long").groupBy("host").agg(F.sum("n").alias("n")), "hosts")
    total = per_host.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return {r["host"]: r["n"] // CHUNK_PAGES for r in per_host.filter((F.col("n") >= 2 * CHUNK_PAGES) & (F.col("n") * 1024 > total)).collect()}


def _dealt(parts: dict[str, int]):
    """Adds host and part to rows (page_id, url, html, hash): a host's pages go to its ``parts`` by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts = [_host(url) for url in batch.column(1).to_pylist()]
            part = [h % parts.get(host, 1) for host, h in zip(hosts, batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(hosts, pa.string()), pa.array(part, pa.int64()), batch.column(3)], names=["page_id", "url", "html", "host", "part", "hash"])

    return run


def chunks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Rows (page_id, url, html, host, part, ...), sorted by host and part, in lists that share a deduction.

    A list is full at ``CHUNK_PAGES`` pages, or at 16 MB if it has enough pages
    for a template. It is passed on only once the next list has enough as well, so
    a short tail of a part joins the list before it.
    """
    held, key, size, full = [], None, 0, 0
    for row in rows:
        if held and row[3:5] != key:
            yield held
            held, size, full = [], 0, 0
        key = row[3:5]
        held.append(row)
        size += len(row[2] or "")
        if not full and (len(held) >= CHUNK_PAGES or size >= CHUNK_CHARS and len(held) >= LEAST_PAGES):
            full = len(held)
        elif full and len(held) == full + LEAST_PAGES:
            yield held[:full]
            held = held[full:]
            size = sum(len(r[2] or "") for r in held)
            full = len(held) if size >= CHUNK_CHARS else 0
    if held:
        yield held


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host and part to (page_id, url, text), a chunk of a part at a time."""
    kinds = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            kinds[:] = [batch.schema.field(0).type]
            for lo in range(0, batch.num_rows, 128):
                yield from zip(*(c.to_pylist() for c in batch.slice(lo, 128).columns), strict=True)

    for held in chunks(rows()):
        texts = extract([r[2] for r in held])
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in held], kinds[0]), pa.array([r[1] for r in held], pa.string()), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``.

    A null or empty html, and a page without an article, has an empty text. Pages
    without a readable host share the empty host. Hosts with fewer than three
    unlike pages give no template; their slots are judged by element names alone.
    All other pages share a deduction with two pages of their host at least,
    however the table is partitioned; copies of one page may stand together.
    White space inside a block becomes one space, blocks are joined by a line
    feed; nothing else of the article is dropped, whatever its length. Repeated
    rows each give a row, a null page_id stays null, other columns are not read,
    an empty table gives no rows.
    """
    kind = pages.schema["page_id"].dataType
    dealt = T.StructType([T.StructField("page_id", kind), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("host", T.StringType()), T.StructField("part", T.LongType()), T.StructField("hash", T.LongType())])
    hashed = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html"))
    rows = hashed.mapInArrow(_dealt(host_parts(pages)), dealt).repartition("host", "part").sortWithinPartitions("host", "part", "page_id", "hash")
    out = rows.mapInArrow(_extracted, T.StructType([dealt["page_id"], dealt["url"], T.StructField("text", T.StringType())]))
    return out.withColumn("n_chars", F.length("text").cast("long"))
