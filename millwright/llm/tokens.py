"""Token ids by the tokenizers library, with a cache of white-space separated chunks.

Both vocabularies split text before their merges, and no split unit ever spans
the change from a non-space to a space character. A text is therefore encoded
chunk by chunk, each distinct chunk once while the cache holds it. Texts that
hold an added token's string are encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from .common import held

#: The characters with the Unicode property White_Space.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Those beyond ASCII in UTF-8.
_WS_LONG = [c.encode() for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]

_MARKS = ".,;:!?#$%&*()|\"-+=/@^~"
#: Stands between parts that are encoded in one string; parts that hold it are encoded alone.
_BAR = "|"
_JOINED = 128
#: Characters whose lower case or composition may depend on others; texts without them are lower-cased at once.
_UNSAFE = re.compile(r"[^\x00-\x7f\xa1-\xff\u0152\u0153\u2010-\u201f\u2026\u20ac]").search


class Encoder:
    """Texts to little-endian id bytes.

    ``leading`` keeps white space in front of each chunk, for vocabularies whose
    units carry it; without it white space is dropped and case folded, for those
    that do so.
    """

    def __init__(self, path: str, leading: bool, width: int = 4, cache_entries: int = 600_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._cache: dict[str, bytes] = {}
        self._most, self._missed = cache_entries, 0
        self._folds, self._width = not leading, width
        self._split = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+" if leading else rf"[^{_WS}]+").findall
        added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added))).search if added else lambda _: None
        self._many = getattr(self._tokenizer, "encode_batch_fast", self._tokenizer.encode_batch)
        self._bar = f" {_BAR}" if leading else f" {_BAR} "
        bar = self._tokenizer.encode(self._bar, add_special_tokens=False).ids
        self._bar_id = bar[0] if len(bar) == 1 else None
        #: Parts that end where the bar begins and begin where it ends.
        self._joins = re.compile(rf"[{_WS}][^{_BAR}]*[^{_BAR}{_WS}]" if leading else rf"[^{_BAR}]+").fullmatch

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self._width}").tobytes()

    def whole(self, text: str) -> bytes:
        return self._pack(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _parts(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of distinct parts, many to a string with bars between them."""
        out, alone = {}, parts
        if self._bar_id is not None:
            joined = list(filter(self._joins, parts))
            alone = list(set(parts).difference(joined)) if len(joined) < len(parts) else []
            blocks = [joined[i : i + _JOINED] for i in range(0, len(joined), _JOINED)]
            for lo in range(0, len(blocks), 64):
                some = blocks[lo : lo + 64]
                for block, e in zip(some, self._many([self._bar.join(x) for x in some], add_special_tokens=False), strict=True):
                    ids = np.array(e.ids, f"<u{self._width}")
                    ends = [*(np.flatnonzero(ids == self._bar_id) * self._width).tolist(), ids.nbytes]
                    raw, at = ids.tobytes(), 0
                    if len(ends) != len(block):  # no such bar: not met, but nothing may rest on it
                        alone += block
                        continue
                    for part, end in zip(block, ends, strict=True):
                        out[part] = raw[at:end]
                        at = end + self._width
        for lo in range(0, len(alone), 20_000):
            some = alone[lo : lo + 20_000]
            out.update((part, self._pack(e.ids)) for part, e in zip(some, self._many(some, add_special_tokens=False), strict=True))
        return out

    def _missing(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks that the cache lacks.

        A chunk is encoded as the word and the marks after it, in lower case where
        the vocabulary has no other. A letter followed by marks ends a unit of both
        vocabularies; the apostrophe, which may belong to the word, is none of
        these marks.
        """
        words = [chunk.rstrip(_MARKS) for chunk in chunks]
        words = [chunk if len(word) == len(chunk) or not word or not word[-1].isalpha() else word for chunk, word in zip(chunks, words, strict=True)]
        marks = [chunk[len(word) :] for chunk, word in zip(chunks, words, strict=True)]
        if self._folds:
            words = [word.lower() if word.isascii() else word for word in words]
        need = {*words, *marks}
        need.discard("")
        known = dict(zip(need, map(self._cache.get, need), strict=True))
        new = self._parts([part for part, ids in known.items() if ids is None])
        known.update(new)
        known[""] = b""
        out = {chunk: known[word] + known[mark] for chunk, word, mark in zip(chunks, words, marks, strict=True)}
        if len(self._cache) < self._most:
            self._cache.update(new)
            self._cache.update(out)
        return out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; null counts as empty.

        The distinct chunks of one call are looked up in the cache once. Frequent
        chunks come early, so a full cache keeps what it has; if misses keep
        coming it starts afresh.
        """
        if not self._folds:
            return self._in_columns(texts)
        folded = [(t or "").lower() if not _UNSAFE(t or "") else t or "" for t in texts]
        chunks = [None if self._added(t) else self._split(t) for t in folded]
        here = self._known(set().union(*[row for row in chunks if row is not None]))
        return [self.whole(t or "") if row is None else b"".join(map(here.__getitem__, row)) for t, row in zip(texts, chunks, strict=True)]

    def _known(self, distinct) -> dict[str, bytes]:
        """Ids of distinct chunks, from the cache or made."""
        here = dict(zip(distinct, map(self._cache.get, distinct), strict=True))
        missing = [chunk for chunk, ids in here.items() if ids is None]
        if len(self._cache) >= self._most:
            self._missed += len(missing)
            if self._missed > 8 * self._most:
                self._cache.clear()
                self._missed = 0
        here.update(self._missing(missing))
        return here

    def _in_columns(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text whose chunks keep their white space: cut, told apart and put together as columns."""
        whole = {i: self.whole(t) for i, t in enumerate(texts) if t and self._added(t)}
        raw = [b"" if i in whole or not t else t.encode() for i, t in enumerate(texts)]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        data = b"".join(raw)
        if not data:
            return [whole.get(i, b"") for i in range(len(texts))]
        begins = ends - [len(r) for r in raw]
        at = chunk_starts(data, begins[begins < ends])
        chunks = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)).dictionary_encode()
        distinct = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._known(distinct)
        out = pa.array(list(map(known.__getitem__, distinct)), pa.large_binary()).take(chunks.indices)
        _, bounds, ids = out.buffers()
        bounds = np.frombuffer(bounds, np.int64, len(at) + 1)
        ids = memoryview(ids if ids is not None else b"")
        cuts = bounds[np.searchsorted(at, np.append(begins, len(data)))].tolist()
        return [whole[i] if i in whole else bytes(ids[lo:hi]) for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


def chunk_starts(data: bytes, begins: np.ndarray) -> np.ndarray:
    """Where chunks begin in UTF-8 texts that stand end to end: at each text, and at white space after anything else."""
    codes = np.frombuffer(data, np.uint8)
    space = (codes == 32) | ((codes - np.uint8(9)) < 5)
    leads = np.flatnonzero((codes == 0xC2) | ((codes - np.uint8(0xE1)) < 3))
    for c in _WS_LONG if len(leads) else ():
        here = leads[codes[leads] == c[0]]
        for k in range(1, len(c)):
            here = here[codes[here + k] == c[k]]
        for k in range(len(c)):
            space[here + k] = True
    edge = space.copy()
    edge[1:] &= ~space[:-1]
    edge[begins] = True
    return np.flatnonzero(edge)


def encoder(path: str, leading: bool, width: int = 4, cache_entries: int = 600_000) -> Encoder:
    """The encoder of this Python worker, whose cache serves all its tasks."""
    return held(("encoder", path, leading, width, cache_entries), lambda: Encoder(path, leading, width, cache_entries))


def text_slices(batches, rows: int = 1024, size: int = 4 << 20):
    """(doc ids, texts) of record batches (doc_id, text, ...), a few MB of text at a time."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        lo = 0
        while lo < batch.num_rows:
            hi, total = lo, 0
            part = texts.slice(lo, rows).to_pylist()
            for t in part:
                total += len(t or "")
                hi += 1
                if total >= size:
                    break
            yield ids.slice(lo, hi - lo).to_pylist(), part[: hi - lo]
            lo = hi
