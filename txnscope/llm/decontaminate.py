"""Benchmark decontamination by a BM25 index of test items with block-max WAND.

Test items are short and indexed by their words with BM25 impacts, each list cut into
blocks of items with the block's largest impact.  A document is read as passages of two
strides (a stride is the longest of all items, so every item lies whole in
some passage).  A passage is the query: an item's score is its BM25 score for the
passage's words over that for its own words.  All items at or above ``threshold`` are
retrieved: words are taken in item order, a pivot needs list bounds that reach the
threshold, block bounds are tried before any item is scored.  Then the item is verified: the
passage must hold the stated share of the question's shingles, and of the answer's.

The index covers at most ``INDEX_ITEMS`` items at a time; more are searched in further
passes over the documents.  Scores do not depend on the cut: the items with each word, the mean
length and the stride are taken once over all items.  With one index the words of all documents
stay where they are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.tables import bounded_batches, keyed, relaxed, with_columns
from txnscope.llm.words import column_bytes, gram_hashes, hash_spans, text_bytes, word_spans
from txnscope.plans.frames import materialize

INDEX_ITEMS = 4_000
INDEX_BYTES = 8 << 20  # of item texts
COARSE = 32  # wide blocks of an index, whose bounds are taken for all passages at once
BLOCK = 16  # items a block of a posting list spans
K1, B = 1.2, 0.75
SHINGLE = 5

# lower case (A-Z); ASCII marks part words
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[0x41:0x5B] += 0x20
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 0x20
_END = re.compile(r"(?<=[.!?])\s+")
_HITS, _HITS_DDL = pa.list_(pa.struct([("item", pa.int64()), ("score", pa.float64())])), "array<struct<item:long,score:double>>"


def plain_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the normalised words, index of each text's first)."""
    buf = _PLAIN[buf]
    starts, ends, first = word_spans(buf, offsets)
    return hash_spans(buf, starts, ends), first


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's sentences but the last, and the last; an item of one sentence is all question."""
    parts = _END.split(text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def _shingles(words: np.ndarray) -> np.ndarray:
    """Distinct hashes of runs of five words, or of all words if there are fewer."""
    return np.unique(gram_hashes(words, min(SHINGLE, len(words)))) if len(words) else np.zeros(0, dtype=np.uint64)


@dataclass
class Whole:
    """What scores need to know of all items (those with words)."""

    items: int
    mean: float  # words an item
    longest: int  # words of the longest


class Index:
    """Posting lists of a block of items, with impacts as shares of each item's own score.

    ``frequency`` holds the number of items with each word of the block; without it and ``whole`` the block is all items.
    """

    def __init__(self, ids: list[int], texts: list[str], frequency: dict[int, int] | None = None, whole: Whole | None = None):
        words, first = plain_words(*text_bytes(texts))
        own = [words[a:b] for a, b in zip(first, first[1:])]
        keep = [i for i, w in enumerate(own) if len(w)]  # items without words cannot be found
        own = [own[i] for i in keep]
        self.ids = [ids[i] for i in keep]
        counts = [Counter(w.tolist()) for w in own]
        mine = Counter(t for c in counts for t in c)
        frequency = mine if frequency is None else frequency
        if whole is None:
            whole = Whole(len(own), float(np.mean([len(w) for w in own])) if own else 1.0, max([0, *(len(w) for w in own)]))
        self.stride = max(SHINGLE, whole.longest)
        self.terms = np.array(sorted(mine), dtype=np.uint64)
        place = {t: k for k, t in enumerate(self.terms.tolist())}
        self.lists: list[tuple[list[int], list[float]]] = [([], []) for _ in place]
        for i, c in enumerate(counts):
            scores = {t: np.log1p((whole.items - frequency[t] + 0.5) / (frequency[t] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(own[i]) / whole.mean)) for t, n in c.items()}
            total = sum(scores.values())
            for t, s in scores.items():
                items, impacts = self.lists[place[t]]
                items.append(i)
                impacts.append(float(s / total))
        self.top = np.array([max(impacts) for _, impacts in self.lists])
        self.blocks: list[dict[int, float]] = []
        for items, impacts in self.lists:
            most: dict[int, float] = {}
            for i, s in zip(items, impacts):
                most[i // BLOCK] = max(most.get(i // BLOCK, 0.0), s)
            self.blocks.append(most)
        self.coarse = np.zeros((len(self.lists), COARSE), dtype=np.float32)  # largest impacts over wide blocks
        for t, (items, impacts) in enumerate(self.lists):
            np.maximum.at(self.coarse[t], np.array(items) * COARSE // max(1, len(own)), np.array(impacts, dtype=np.float32))
        sides = [question_and_answer(texts[i]) for i in keep]
        words, first = plain_words(*text_bytes([s for pair in sides for s in pair]))
        parts = [_shingles(words[a:b]) for a, b in zip(first, first[1:])]
        lengths = np.diff(first).tolist()
        self.sides = [((parts[2 * i], lengths[2 * i]), (parts[2 * i + 1], lengths[2 * i + 1])) for i in range(len(own))]
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.terms >> np.uint64(48)).astype(np.int64)] = True

    def term_ids(self, words: np.ndarray) -> np.ndarray:
        """Index of each word's list, -1 for words of no item."""
        out = np.full(len(words), -1, dtype=np.int64)
        at = np.flatnonzero(self.maybe[(words >> np.uint64(48)).astype(np.int64)])
        if len(at):
            place = np.minimum(np.searchsorted(self.terms, words[at]), len(self.terms) - 1)
            known = self.terms[place] == words[at]
            out[at[known]] = place[known]
        return out

    def search(self, terms: list[int], threshold: float, low: int = 0, high: int = 1 << 62) -> list[tuple[int, float]]:
        """Block-max WAND over the items from ``low`` to before ``high``: (item, score) of all whose score reaches the threshold."""
        top, lists, blocks = self.top, self.lists, self.blocks
        reach = threshold - 1e-9  # of bounds, whose sums depend on the order of the words
        cursors = []
        for t in terms:
            items = lists[t][0]
            p = bisect_left(items, low)
            if p < len(items) and items[p] < high:
                cursors.append([items[p], p, t])
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += top[t]
                if bound >= reach:
                    pivot = k
                    break
            if pivot < 0:
                return found  # what is left cannot reach the threshold
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(blocks[t].get(block, 0.0) for _, _, t in cursors[:pivot + 1]) < reach:
                # no item up to the block's end can reach it, unless a further list takes part
                target = min([(block + 1) * BLOCK, *(c[0] for c in cursors[pivot + 1:])])
                moved = range(pivot + 1)
            else:
                if cursors[0][0] == item:
                    score = fsum(lists[t][1][p] for i, p, t in cursors[:pivot + 1])
                    if score >= threshold:
                        found.append((item, score))
                    target = item + 1
                else:
                    target = item
                moved = range(pivot + 1)
            for k in moved:
                at, p, t = cursors[k]
                if at < target:
                    items = lists[t][0]
                    p = bisect_left(items, target, p)
                    cursors[k] = [items[p], p, t] if p < len(items) and items[p] < high else None
            cursors = [c for c in cursors if c is not None]
        return found

    def verified(self, item: int, grams: list[np.ndarray], share: float) -> bool:
        """Whether a passage (its sorted shingle hashes by length) holds the share of the question's and of the answer's."""
        for shingles, length in self.sides[item]:
            if len(shingles):
                passage = grams[min(SHINGLE, length)]
                at = np.minimum(np.searchsorted(passage, shingles), max(0, len(passage) - 1))
                if not len(passage) or (passage[at] == shingles).mean() < share:
                    return False
        return True

    def matches(self, words: np.ndarray, first: np.ndarray, threshold: float, share: float) -> list[dict[int, float]]:
        """{item: best score} of each text."""
        out: list[dict[int, float]] = [{} for _ in range(len(first) - 1)]
        if not len(self.terms) or not len(words):
            return out
        terms = self.term_ids(words)
        bound = np.where(terms >= 0, self.top[np.maximum(terms, 0)], 0.0)
        upto = np.concatenate([[0.0], np.cumsum(bound)])
        counts = np.diff(first)
        passages = np.where(counts > 0, np.maximum(1, -(-counts // self.stride) - 1), 0)
        text = np.repeat(np.arange(len(counts)), passages)
        nth = np.arange(len(text)) - (np.cumsum(passages) - passages)[text]
        begin = first[:-1][text] + nth * self.stride
        end = np.minimum(begin + 2 * self.stride, first[1:][text])
        crude = np.flatnonzero(upto[end] - upto[begin] >= threshold - 1e-6)  # repeated words count each
        if not len(crude):
            return out
        size = (end - begin)[crude]
        nth = np.repeat(np.arange(len(crude)), size)
        own = terms[np.arange(len(nth)) - (np.cumsum(size) - size)[nth] + begin[crude][nth]]
        pair = np.unique((nth * len(self.terms) + own)[own >= 0])  # distinct words of each passage
        nth, own = pair // len(self.terms), pair % len(self.terms)
        edge = np.flatnonzero(np.diff(nth, prepend=-1))
        bounds = np.add.reduceat(self.coarse[own], edge, axis=0) if len(edge) else np.zeros((0, COARSE))
        stop = np.append(edge[1:], len(nth))
        # without a wide block that can reach the threshold there is no pivot
        wide, n = bounds >= threshold - 1e-4, len(self.ids)
        for i in np.flatnonzero(wide.any(axis=1)).tolist():
            k = int(crude[nth[edge[i]]])
            a, b, own_terms = int(begin[k]), int(end[k]), own[edge[i]:stop[i]]
            listed = own_terms.tolist()
            hits = [hit for c in np.flatnonzero(wide[i]).tolist()
                    for hit in self.search(listed, threshold, -(-c * n // COARSE), -(-(c + 1) * n // COARSE))]
            if hits:
                grams = [np.zeros(0, dtype=np.uint64)] + [np.unique(gram_hashes(words[a:b], n)) for n in range(1, SHINGLE + 1)]
                best = out[text[k]]
                for item, score in hits:
                    if score > best.get(item, 0.0) and self.verified(item, grams, share):
                        best[item] = score
        return out


def _item_words(batches):
    """(item, id, text) with n_words and the distinct words."""
    for batch in batches:
        words, first = plain_words(*column_bytes(batch.column("text")))
        terms = [np.unique(words[a:b]).view(np.int64) for a, b in zip(first, first[1:])]
        yield pa.record_batch([*batch.columns, pa.array(np.diff(first), pa.int64()), pa.array(terms, pa.list_(pa.int64()))], names=["item", "id", "text", "n_words", "terms"])


def indexes(items: DataFrame, id_col: str, text_col: str):
    """Yields indexes of at most ``INDEX_ITEMS`` items and ``INDEX_BYTES`` of text (or one longer item) each; null texts and texts without words are in none."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    rows = rows.select(F.monotonically_increasing_id().alias("item"), "id", "text").mapInArrow(_item_words, "item long, id long, text string, n_words long, terms array<long>")
    rows = materialize(rows.where("n_words > 0"), "benchmark-items")
    count, total, longest = rows.agg(F.count("*"), F.sum("n_words"), F.max("n_words")).first()
    whole = Whole(count, total / count if count else 1.0, longest or 0)
    each = rows.select("item", F.explode("terms").alias("term"))
    # Spark sizes exploded words and packed lists too low to broadcast them: of a left join that can only be the counts, grouped by then
    found = each.join(each.groupBy("term").agg(F.count("*").alias("n")), "term", "left").groupBy("item").agg(F.collect_list(F.struct("term", "n")).alias("found"))
    rows = rows.join(found.hint("merge"), "item").orderBy("id", "text").select("id", "text", F.col("found.term").alias("terms"), F.col("found.n").alias("counts"))
    ids, texts, frequency, held = [], [], {}, 0
    for row in rows.toLocalIterator():  # one partition at a time; the test items are the stated query set
        size = len(row["text"].encode("utf-8", "surrogatepass"))
        if ids and (len(ids) == INDEX_ITEMS or held + size > INDEX_BYTES):
            yield Index(ids, texts, frequency, whole)
            ids, texts, frequency, held = [], [], {}, 0
        ids.append(row["id"])
        texts.append(row["text"])
        frequency.update((t % (1 << 64), n) for t, n in zip(row["terms"], row["counts"]))
        held += size
    yield Index(ids, texts, frequency, whole)


def one_pass(index: Index, threshold: float, share: float, keep: str, only_hits: bool):
    """A function over Arrow batches (``keep``, text[, known]): ``keep`` with item_ids and best_score, those of ``known`` included."""
    def run(batches):
        for batch in batches:
            buf, offsets = column_bytes(batch.column("text"))
            known = batch.column("known").to_pylist() if "known" in batch.schema.names else None
            lo = 0
            while lo < batch.num_rows:  # about 1 MB of text at a time
                hi = min(batch.num_rows, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (1 << 20))) - 1))
                words, first = plain_words(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                merged: list[dict[int, float]] = [{} for _ in range(hi - lo)]
                for best, found in zip(merged, index.matches(words, first, threshold, share)):
                    for item, score in found.items():
                        name = -1 if index.ids[item] is None else index.ids[item]
                        best[name] = max(score, best.get(name, 0.0))
                if known is not None:
                    for best, earlier in zip(merged, known[lo:hi]):
                        for hit in earlier or ():
                            best[hit["item"]] = max(hit["score"], best.get(hit["item"], 0.0))
                out = pa.table([relaxed(batch.column(keep).slice(lo, hi - lo)), pa.array([[{"item": i, "score": b[i]} for i in sorted(b)] for b in merged], _HITS)], names=[keep, "hits"])
                if only_hits:
                    out = out.filter(pa.array([bool(b) for b in merged], pa.bool_()))
                yield from out.to_batches()
                lo = hi

    return run


def find_benchmark(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                   threshold: float = 0.65, share: float = 0.8) -> DataFrame:
    """``df`` with item_ids (ascending), best_score and contaminated.

    A null or empty text has no items; a null item id is listed as null's stand-in -1; repeated rows are judged each;
    without items no row is contaminated; columns of ``df`` that bear a result's name are replaced by it.

    One index is held at a time.  The passes before the last write only the texts with hits, by their SHA-256, and the
    last takes these in; with items for one index there is one pass and no shuffle.
    """
    bounded_batches(df.sparkSession)
    rows = keyed(df, id_col, text_col).select("row", "text")
    built = indexes(items, item_id, item_text)
    index, earlier = next(built), None
    for following in built:
        marked = rows.select(F.sha2("text", 256).alias("mark"), "text")
        hits = marked.mapInArrow(one_pass(index, threshold, share, "mark", True), f"mark string, hits {_HITS_DDL}").dropDuplicates(["mark"])
        hits = materialize(hits, "benchmark-hits")
        earlier = hits if earlier is None else earlier.union(hits)
        index = following
    if earlier is not None:
        earlier = earlier.groupBy("mark").agg(F.flatten(F.collect_list("hits")).alias("known"))  # a row for each pass at most
        rows = rows.withColumn("mark", F.sha2("text", 256)).join(earlier, "mark", "left").select("row", "text", "known")
    out = rows.mapInArrow(one_pass(index, threshold, share, "row", False), f"row {rows.schema['row'].dataType.simpleString()}, hits {_HITS_DDL}")
    ids, scores = F.transform("hits", lambda h: h["item"]), F.transform("hits", lambda h: h["score"])
    return with_columns(out, df.columns, item_ids=ids, best_score=F.coalesce(F.array_max(scores), F.lit(0.0)), contaminated=F.size("hits") > 0)
