"""Substring deduplication with one FM-index for each shard of candidate segments.

A window is ``window`` consecutive words of one text; a word goes if it is covered by a window
whose words also start earlier (smaller id, or same id and earlier start).  Streaming every
text through an index of every shard would grow with the square of the corpus, so windows
meet by content.  A window's anchor is the smallest hash of its ``gram``-word runs; equal
windows have equal anchors, and neighbouring windows mostly share one, so that a run of them
is one segment of text.

1. Texts are dealt into parts by a hash of the row.  Each part lists its anchors once; an
   anchor found in one place only cannot belong to a repeated window and is left behind.
2. Each part sends its distinct segments with the other anchors to the anchor's shard, each
   once, with its smallest place (id, start), however many copies it has.  An anchor in ``HOT_PARTS`` parts or more (a common
   passage next to many different texts) is spread: its windows go by their own hash.
3. A shard indexes its distinct segments and streams their windows through backward search.
   Rows of one interval are one window: the earliest place of all is its first.  One bit a
   window goes back: whether the part's first occurrence is the first of all.
4. Each part marks the covered words of its texts; a segment at the place that was sent takes the
   bits returned, one at any other place starts earlier elsewhere.

The texts are shuffled once (their exchange is used by every step that reads them).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.fm_index import FMIndex
from txnscope.llm.tables import bounded_batches, keyed, pieces_for, relaxed
from txnscope.llm.words import column_bytes, compact, gram_hashes, gram_starts, hash_spans, mix, word_spans

GRAM = 8
HOT_PARTS = 48
PART_MB = 3.0  # of files, twice that or so of text


class Part:
    """The texts of one part, in order of (key, text), as words, windows and runs of windows with one anchor."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        self.table = table.sort_by([("key", "ascending"), ("text", "ascending")])
        self.window, self.gram, self.reach = window, gram, window - gram + 1
        self.keys = self.table.column("key").to_numpy()
        buf, offsets = column_bytes(self.table.column("text"))
        starts, ends, self.first = word_spans(buf, offsets)
        self.hashes = hash_spans(buf, starts, ends)
        self.buf, self.starts, self.ends = compact(buf, starts, ends)
        self.text, self.begin = gram_starts(self.first, window)  # of each window
        self.grams = gram_hashes(self.hashes, gram)
        smallest, span = self.grams, 1
        while span < self.reach and len(smallest):
            step = min(span, self.reach - span)
            smallest = np.minimum(smallest[:-step], smallest[step:])
            span += step
        self.anchor = smallest[self.begin]
        new = np.ones(len(self.anchor), dtype=bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.text[1:] != self.text[:-1])
        self.run = np.flatnonzero(new)  # first window of each run
        self.count = np.diff(np.append(self.run, len(self.anchor)))  # its windows

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(distinct anchors, whether one occurs in this part more than once)."""
        near = np.zeros(len(self.grams) + 1, dtype=np.int64)
        for d in range(1, self.reach + 1):  # the anchor twice in a run: some windows of the run may be equal
            near[:max(0, len(self.grams) - d)] |= self.grams[:-d] == self.grams[d:]
        upto = np.concatenate([[0], np.cumsum(near)])
        begin = self.begin[self.run]
        again = upto[np.minimum(begin + self.count + self.reach - 1, len(near))] > upto[begin]
        found, inverse, times = np.unique(self.anchor[self.run], return_inverse=True, return_counts=True)
        return found, (times > 1) | (np.bincount(inverse, weights=again, minlength=len(found)) > 0)

    def places(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, first word's number in its text) of windows."""
        text = self.text[windows]
        return self.keys[text], self.begin[windows] - self.first[text]

    def cut(self, repeated: np.ndarray, hot: np.ndarray, shards: int) -> "Segments":
        """The runs whose anchor is among ``repeated`` (sorted); each window of a hot one is a run of its own."""
        place = np.minimum(np.searchsorted(repeated, self.anchor[self.run]), max(0, len(repeated) - 1))
        keep = repeated[place] == self.anchor[self.run] if len(repeated) else np.zeros(len(self.run), dtype=bool)
        run, count, is_hot = self.run[keep], self.count[keep], hot[place[keep]]
        pieces = np.where(is_hot, count, 1)
        owner = np.repeat(np.arange(len(run)), pieces)
        nth = np.arange(len(owner)) - (np.cumsum(pieces) - pieces)[owner]
        at, many = run[owner] + nth, np.where(is_hot, 1, count)[owner]
        route = self.anchor[at]
        single = is_hot[owner]
        if single.any():
            route[single] = gram_hashes(self.hashes, self.window)[self.begin[at[single]]]
        low, high = self.starts[self.begin[at]], self.ends[self.begin[at] + many + self.window - 2]
        view, known = self.buf.tobytes(), {}
        segment = np.fromiter((known.setdefault(view[s:e], len(known)) for s, e in zip(low.tolist(), high.tolist())), dtype=np.int64, count=len(at))
        keys, starts = self.places(at)
        order = np.lexsort((starts, keys, segment))
        occurrence = order[np.flatnonzero(np.diff(segment[order], prepend=-1))]
        head = occurrence[segment]
        fresh = (keys == keys[head]) & (starts == starts[head])
        return Segments(at, many, segment, fresh, list(known), occurrence, (mix(route[occurrence]) % np.uint64(shards)).astype(np.int32))


@dataclass
class Segments:
    at: np.ndarray  # first window of each run
    many: np.ndarray  # its windows
    segment: np.ndarray  # its segment
    fresh: np.ndarray  # whether it has the place (key, start) of the segment's first in the part
    texts: list[bytes]  # distinct segments
    occurrence: np.ndarray  # the run of each with the smallest place
    shard: np.ndarray  # the shard of each

    def by_shard(self):
        """(shard, its segments in a fixed order)."""
        order = np.argsort(self.shard, kind="stable")
        edge = np.flatnonzero(np.diff(self.shard[order], prepend=-1))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(order)]):
            yield int(self.shard[order[a]]), order[a:b]


def first_places(segments: list[tuple[int, list[bytes], np.ndarray, np.ndarray]], window: int) -> list[np.ndarray]:
    """For each part's (part, segments, keys, starts): one byte a window, 1 if no equal window starts earlier.

    The distinct segments of all parts are indexed; windows found in two or more places are grouped by their
    interval, and the earliest occurrence of a group is its first.
    """
    known: dict[bytes, int] = {}
    entry = [known.setdefault(t, len(known)) for _, texts, _, _ in segments for t in texts]
    entry = np.array(entry, dtype=np.int64)
    key = np.concatenate([k for _, _, k, _ in segments])
    start = np.concatenate([s for _, _, _, s in segments])
    order = np.lexsort((start, key, entry))
    earliest = order[np.flatnonzero(np.diff(entry[order], prepend=-1))]  # of each distinct segment
    # words as numbers, 0 between segments
    words = (b" \n ".join(known) + b" \n").split(b" ")
    symbols, names = pd.factorize(np.array(words, dtype=object))
    zero = int(np.flatnonzero(names == b"\n")[0])
    symbols = np.where(symbols == zero, 0, np.where(symbols == 0, zero, symbols)).astype(np.int64)
    stop = np.flatnonzero(symbols == 0)
    begin = np.concatenate([[0], stop[:-1] + 1])
    windows = stop - begin - window + 1
    owner = np.repeat(np.arange(len(known)), windows)
    offset = np.arange(len(owner)) - (np.cumsum(windows) - windows)[owner]
    index = FMIndex(symbols, len(names), window)
    matched, row = index.matching(symbols, begin[owner] + offset + window - 1, window)
    w_key, w_start = key[earliest][owner], start[earliest][owner] + offset
    shared = np.flatnonzero(matched == window)
    if len(shared):
        order = shared[np.lexsort((w_start[shared], w_key[shared], row[shared]))]
        new = np.diff(row[order], prepend=-1) != 0
        head = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        w_key[order], w_start[order] = w_key[head], w_start[head]
    out, at = [], 0
    before = np.cumsum(windows) - windows
    for _, texts, k, s in segments:
        own = entry[at:at + len(texts)]
        at += len(texts)
        of = np.repeat(np.arange(len(own)), windows[own])
        nth = np.arange(len(of)) - (np.cumsum(windows[own]) - windows[own])[of]
        place = before[own][of] + nth
        out.append(((w_key[place] == k[of]) & (w_start[place] == s[of] + nth)).astype(np.uint8))
    return out


def _longs(cells: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(c, dtype=kind) for c in cells.to_pylist()]


def remove_repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """``df`` with its text replaced by the kept words (joined by one space) and n_words, n_removed, removed.

    ``removed`` lists the runs of words that went, as (start, end) word numbers of the input.  A null or empty text
    becomes empty; a text with fewer words than the window keeps all (its white space becomes one space).  A null id
    sorts first.  Rows that repeat an id are texts of their own: windows that start at the same word of equal ids do
    not remove each other, so whole copies under one id are kept.  Columns of ``df`` that bear a result's name
    are replaced by it; an empty table gives no rows.
    """
    gram = max(1, min(GRAM, window))
    bounded_batches(df.sparkSession)
    light = [c for c in df.columns if c != text_col]
    parts = shards = pieces_for(df, PART_MB)
    texts = keyed(df, id_col, text_col).select(
        F.pmod(F.xxhash64("key", "text"), F.lit(parts)).cast("int").alias("part"), "key", "text",
        F.struct(F.lit(0).alias("_"), *[F.col(f"row.`{c}`") for c in light]).alias("row"))

    def list_anchors(table: pa.Table) -> pa.Table:
        found, again = Part(table, window, gram).anchors()
        shard = (mix(found) % np.uint64(shards)).astype(np.int32)
        order = np.argsort(shard, kind="stable")
        edge = np.flatnonzero(np.diff(shard[order], prepend=-1))
        cuts = [order[a:b] for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(order)])]
        return pa.table({"shard": pa.array(shard[order[edge]]), "part": pa.array([table.column("part")[0].as_py()] * len(edge), pa.int32()),
                         "anchors": pa.array([found[c].tobytes() for c in cuts], pa.binary()), "again": pa.array([again[c].tobytes() for c in cuts], pa.binary())})

    def find_repeated(table: pa.Table) -> pa.Table:
        each = _longs(table.column("anchors"), "<u8")
        anchors, again = np.concatenate(each), np.concatenate(_longs(table.column("again"), "?"))
        found, inverse, times = np.unique(anchors, return_inverse=True, return_counts=True)
        wanted = ((times > 1) | (np.bincount(inverse, weights=again) > 0))[inverse]
        hot, edge = (times >= HOT_PARTS)[inverse], np.cumsum([0] + [len(e) for e in each])
        out = [(p, anchors[a:b][wanted[a:b]], hot[a:b][wanted[a:b]]) for p, a, b in zip(table.column("part").to_pylist(), edge, edge[1:])]
        out = [o for o in out if len(o[1])]
        return pa.table({"part": pa.array([p for p, _, _ in out], pa.int32()), "shard": pa.array([-1] * len(out), pa.int32()),
                         "data": pa.array([a.tobytes() for _, a, _ in out], pa.binary()), "hot": pa.array([h.tobytes() for _, _, h in out], pa.binary())})

    def cut(left: pa.Table, right: pa.Table) -> tuple[Part, Segments]:
        part = Part(left, window, gram)
        right = right.filter(pc.equal(right.column("shard"), -1))
        repeated = np.concatenate([np.zeros(0, "<u8"), *_longs(right.column("data"), "<u8")])
        hot = np.concatenate([np.zeros(0, bool), *_longs(right.column("hot"), "?")])
        order = np.argsort(repeated)
        return part, part.cut(repeated[order], hot[order], shards)

    def send_segments(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            part, segments = cut(left, right)
            keys, starts = part.places(segments.at[segments.occurrence])
            number = left.column("part")[0].as_py()
            for shard, own in segments.by_shard():
                out.append((shard, number, b"\n".join([segments.texts[i] for i in own.tolist()]), keys[own].tobytes(), starts[own].tobytes()))
        columns = list(zip(*out)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["shard", "part", "segments", "keys", "starts"])

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        sent = [(p, t.split(b"\n"), k, s) for p, t, k, s in zip(table.column("part").to_pylist(), table.column("segments").to_pylist(),
                                                               _longs(table.column("keys"), "<i8"), _longs(table.column("starts"), "<i8"))]
        flags = first_places(sent, window)
        return pa.table({"part": table.column("part"), "shard": table.column("shard"), "data": pa.array([np.packbits(f).tobytes() for f in flags], pa.binary()),
                         "hot": pa.nulls(len(flags), pa.binary())})

    row_type = texts.schema["row"].dataType.simpleString()

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        part, segments = cut(left, right)
        answers = dict(zip(right.column("shard").to_pylist(), right.column("data").to_pylist()))
        size = np.zeros(len(segments.texts), dtype=np.int64)
        size[segments.segment] = segments.many
        before = np.cumsum(size) - size
        first = np.zeros(int(size.sum()), dtype=bool)
        for shard, own in segments.by_shard():
            bits = np.unpackbits(np.frombuffer(answers[shard], dtype=np.uint8))
            of = np.repeat(own, size[own])
            nth = np.arange(len(of)) - np.repeat(np.cumsum(size[own]) - size[own], size[own])
            first[before[of] + nth] = bits[:len(of)]
        run = np.repeat(np.arange(len(segments.at)), segments.many)
        nth = np.arange(len(run)) - (np.cumsum(segments.many) - segments.many)[run]
        gone = ~first[before[segments.segment[run]] + nth] | ~segments.fresh[run]
        begin = part.begin[segments.at[run[gone]] + nth[gone]]
        edges = np.zeros(len(part.starts) + 1, dtype=np.int64)
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + window, -1)
        covered = np.cumsum(edges[:-1]) > 0
        kept = part.buf[np.repeat(~covered, part.ends - part.starts + 1)].tobytes()
        upto = np.concatenate([[0], np.cumsum(np.where(covered, 0, part.ends - part.starts + 1))])
        bounds = upto[part.first]
        texts_kept = [kept[a:max(a, b - 1)] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        removed = np.concatenate([[0], np.cumsum(covered)])
        spans: list[list[dict]] = [[] for _ in texts_kept]
        owner = np.repeat(np.arange(len(texts_kept)), np.diff(part.first))
        at = np.flatnonzero(covered)
        if len(at):
            new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(owner[at], prepend=-1) != 0))
            for a, b in zip(new.tolist(), [*new[1:].tolist(), len(at)]):
                text = int(owner[at[a]])
                spans[text].append({"start": int(at[a] - part.first[text]), "end": int(at[b - 1] + 1 - part.first[text])})
        return pa.table([relaxed(part.table.column("row")), pa.array(texts_kept, pa.binary()).cast(pa.string()), pa.array(np.diff(part.first)), pa.array(removed[part.first[1:]] - removed[part.first[:-1]]),
                         pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["row", "kept", "n_words", "n_removed", "removed"])

    def keep_or_none(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows:
            return keep(left, right)
        return pa.table([relaxed(left.column("row")), pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.int64()),
                         pa.array([], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["row", "kept", "n_words", "n_removed", "removed"])

    by_part = texts.groupBy("part")
    listed = by_part.applyInArrow(list_anchors, "shard int, part int, anchors binary, again binary")
    repeated = listed.groupBy("shard").applyInArrow(find_repeated, "part int, shard int, data binary, hot binary")
    sent = by_part.cogroup(repeated.groupBy("part")).applyInArrow(send_segments, "shard int, part int, segments binary, keys binary, starts binary")
    answered = sent.groupBy("shard").applyInArrow(search, "part int, shard int, data binary, hot binary")
    out = by_part.cogroup(repeated.union(answered).groupBy("part")).applyInArrow(
        keep_or_none, f"row {row_type}, kept string, n_words long, n_removed long, removed array<struct<start:int,end:int>>")
    columns = [F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in ("n_words", "n_removed", "removed")]
    return out.select(*columns, "n_words", "n_removed", "removed")
