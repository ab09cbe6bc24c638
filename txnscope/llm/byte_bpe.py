"""Token ids of a byte-level BPE tokenizer file, as the tokenizers library gives them.

The pre-tokenizer never joins a character with white space behind it, so a text's ids
are those of its units (white space, then other characters) one after another.  Units
are cut and numbered as Arrow arrays over the texts' bytes, so only the distinct units of
a call become strings.  A worker keeps the ids of the units it has seen in a bounded
cache, which keeps those that come again when it is full, and gives only new pre-tokens
of new units to the library's model.
"""

from __future__ import annotations

import json
import re
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import regex

# fixed values: the code points with the Unicode property White_Space
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WHITE_BYTE = np.isin(np.arange(256), [c for c in _WHITE if c < 0x80])
_WIDE_WHITE = re.compile(b"|".join(re.escape(chr(c).encode()) for c in _WHITE if c >= 0x80))
# fixed value: the pre-token pattern of byte-level BPE vocabularies
_PRE_TOKEN = regex.compile(r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# the same of ASCII text
_ASCII_PRE_TOKEN = re.compile(r"""'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+""", re.ASCII)
# bytes that print stand for themselves, the others for code points from 256 on
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SYMBOL = {b: b for b in _SHOWN} | {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
_SHOWN_AS = np.array([_SYMBOL[b] for b in range(256)], dtype="<u2")
CACHE_UNITS = 500_000


class ByteBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        made = json.loads(self.library.to_str())
        pre, added = made["pre_tokenizer"] or {}, made["added_tokens"]
        plain = made["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("expected a byte-level tokenizer without normalizer or prefix space")
        self.vocabulary = self.library.get_vocab_size()
        self.added = re.compile("(" + "|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))) + ")") if added else None
        self.special = {t["content"]: self.library.token_to_id(t["content"]) for t in added}
        self.clear()

    def clear(self) -> None:
        """An empty cache but for the added tokens, which come first."""
        self.index: dict[str, int] = {}
        self.begin, self.size, self.again = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=bool)
        self.pool, self.used = np.zeros(1 << 18, dtype=np.uint32), 0
        self.add(list(self.special), np.array(list(self.special.values()), dtype=np.uint32), np.ones(len(self.special), dtype=np.int64))

    def units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(the units of all texts one after another, where each text begins and the last one ends among them)."""
        parts, whole, edges = texts, [], np.arange(len(texts) + 1)
        if self.added is not None and any(map(self.added.search, texts)):
            cut = [self.added.split(t) for t in texts]  # the added tokens are at the odd places
            edges = np.cumsum([0] + [len(c) for c in cut])
            parts = list(chain.from_iterable(cut))
            whole = [int(at) + k for at, c in zip(edges, cut) for k in range(1, len(c), 2)]
        offsets, raw = _content(pa.array(parts, pa.large_string()))
        white = _WHITE_BYTE[raw]
        for found in _WIDE_WHITE.finditer(raw):
            white[found.start():found.end()] = True
        starts = np.zeros(len(raw) + 1, dtype=bool)
        starts[1:-1] = white[1:] & ~white[:-1]
        starts[offsets] = True
        for k in whole:
            starts[offsets[k] + 1:offsets[k + 1]] = False
        starts[-1] = False
        begins = np.flatnonzero(starts)
        return _strings(np.append(begins, len(raw)), raw), np.searchsorted(begins, offsets[edges])

    def words(self, units: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """(the units in an order of their own, their pre-tokens one after another, how many each has).

        A unit of white space and then other characters shares no pre-token with the one before, so many are cut at once.
        """
        if not len(units):
            return units, units, np.zeros(0, dtype=np.int64)
        offsets, raw = _content(units)
        joins, wide = _WHITE_BYTE[raw[offsets[:-1]]] & ~_WHITE_BYTE[raw[offsets[1:] - 1]], np.maximum.reduceat(raw, offsets[:-1]) >= 0x80
        ends_wide = np.flatnonzero(joins & (raw[offsets[1:] - 1] >= 0x80))
        joins[ends_wide] = [not _WIDE_WHITE.fullmatch(raw[max(a, b - 3):b]) and not _WIDE_WHITE.fullmatch(raw[max(a, b - 2):b])
                            for a, b in zip(offsets[ends_wide].tolist(), offsets[ends_wide + 1].tolist())]
        groups, flat, counts = [], [], []
        for which, pattern in ((joins & ~wide, _ASCII_PRE_TOKEN), (joins & wide, _PRE_TOKEN)):
            some = units.take(pa.array(np.flatnonzero(which)))
            upto, text = _content(some)
            found = pa.array(pattern.findall(text.tobytes().decode()), pa.large_string())
            counts.append(np.diff(np.searchsorted(_content(found)[0][1:], upto[1:], side="right"), prepend=0))
            groups.append(some)
            flat.append(found)
        odd = units.take(pa.array(np.flatnonzero(~joins)))
        cut = [_PRE_TOKEN.findall(u) for u in _listed(odd)]
        counts.append(np.fromiter(map(len, cut), dtype=np.int64, count=len(cut)))
        flat.append(pa.array(list(chain.from_iterable(cut)), pa.large_string()))
        return pa.concat_arrays([*groups, odd]), pa.concat_arrays(flat), np.concatenate(counts)

    def model_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, how many each has) of pre-tokens, from the library's model, which reads the library's byte symbols."""
        offsets, raw = _content(words)
        shown = _SHOWN_AS[raw].tobytes().decode("utf-16-le")
        edges = offsets.tolist()
        tokens = list(map(self.library.model.tokenize, [shown[a:b] for a, b in zip(edges, edges[1:])]))
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        return np.fromiter(map(attrgetter("id"), chain.from_iterable(tokens)), dtype=np.uint32, count=int(sizes.sum())), sizes

    def add(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, at = len(self.index), self.used
        room = len(self.begin)
        while room < n + len(units):
            room *= 2
        if room > len(self.begin):
            self.begin, self.size, self.again = (np.concatenate([x, np.zeros(room - len(x), dtype=x.dtype)]) for x in (self.begin, self.size, self.again))
        self.reserve(len(ids))
        self.pool[at:at + len(ids)] = ids
        self.begin[n:n + len(units)], self.size[n:n + len(units)], self.again[n:n + len(units)] = at + np.cumsum(sizes) - sizes, sizes, False
        self.used = at + len(ids)
        self.index.update(zip(units, range(n, n + len(units))))

    def reserve(self, more: int) -> None:
        if len(self.pool) < self.used + more:
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), more), dtype=np.uint32)])

    def gather(self, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.cumsum(sizes)
        return self.pool[np.repeat(begin - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def learn(self, units: pa.Array) -> None:
        """Adds the ids of units the cache does not have; the library's model gets each pre-token that is no unit of the cache, once."""
        units, flat, counts = self.words(units)
        numbered = flat.dictionary_encode()
        inverse, distinct = numbered.indices.to_numpy(), numbered.dictionary
        at = self.look_up(_listed(distinct))
        begin, sizes = self.begin[at], self.size[at]
        new = np.flatnonzero(at < 0)
        ids, many = self.model_ids(distinct.take(pa.array(new)))
        self.reserve(len(ids))
        self.pool[self.used:self.used + len(ids)] = ids  # read by the next lines, then written over
        begin[new], sizes[new] = self.used + np.cumsum(many) - many, many
        each = np.concatenate([[0], np.cumsum(sizes[inverse])])
        edges = np.concatenate([[0], np.cumsum(counts)])
        self.add(_listed(units), self.gather(begin[inverse], sizes[inverse]), np.diff(each[edges]))

    def forget(self) -> None:
        """Empties the cache but for units that came again in a later call, at most half of ``CACHE_UNITS``."""
        own = len(self.special)
        kept = own + np.flatnonzero(self.again[own:len(self.index)])[:CACHE_UNITS // 2]
        ids, sizes, names = self.gather(self.begin[kept], self.size[kept]), self.size[kept], list(self.index)
        names = [names[i] for i in kept.tolist()]
        self.clear()
        self.add(names, ids, sizes)

    def look_up(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.get, units, repeat(-1)), dtype=np.int64, count=len(units))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts, one after another."""
        units, bounds = self.units(texts)
        numbered = units.dictionary_encode()
        inverse, distinct = numbered.indices.to_numpy(), numbered.dictionary
        names = _listed(distinct)
        at = self.look_up(names)
        new = np.flatnonzero(at < 0)
        if len(new) and len(self.index) + len(new) > CACHE_UNITS:
            self.forget()
            at = self.look_up(names)
            new = np.flatnonzero(at < 0)
        self.again[at[at >= 0]] = True
        if len(new):
            self.learn(distinct.take(pa.array(new)))
            at[new] = self.look_up([names[i] for i in new.tolist()])
        at = at[inverse]
        sizes = self.size[at]
        return self.gather(self.begin[at], sizes), np.concatenate([[0], np.cumsum(sizes)])[bounds]


def _content(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of large strings without nulls."""
    if not len(array):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, raw = array.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return edges - edges[0], data[edges[0]:edges[-1]]


def _strings(edges: np.ndarray, raw: np.ndarray) -> pa.Array:
    """Large strings that lie one after another in ``raw``."""
    return pa.Array.from_buffers(pa.large_string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw)])


def _listed(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


_encoders: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = 1 << 20):
    """(batch, its texts) in slices of about ``size`` bytes of text."""
    texts = batch.column(column).to_pylist()
    lo = held = 0
    for hi, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield batch.slice(lo, hi + 1 - lo), texts[lo:hi + 1]
            lo, held = hi + 1, 0
    if lo < len(texts):
        yield batch.slice(lo), texts[lo:]
