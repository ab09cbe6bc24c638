"""SimHash near-duplicates, found by pigeonring filtering.

Fingerprint: words of the lower-cased (A-Z) text, shingles of ``shingle`` words, XXH64
(seed 42) of each; a bit is 1 if it is set in over half of the hashes.  A text with fewer
words is one shingle, one without words has fingerprint zero.  Two fingerprints link at
``distance`` or fewer differing bits.

Search: 64 bits are cut into m = distance + 1 (at least 3) consecutive segments on a ring.  If two
fingerprints differ in at most ``distance`` bits, some start i exists from which every
chain of l segments differs in at most l * distance / m bits: none in the
first, at most one in the first two, and so on.  The first two steps of the chain are
met by equality: a row for each start with both segments, and rows with one bit of the
second segment cleared.  Rows that meet in a bucket are then filtered by the longer
chains and by the whole distance.  A bucket gives a spanning forest of its links, not
all pairs; components are joined by alternating star contraction.

Nodes are the distinct fingerprints, so ids may repeat or be null; a component's id is taken
from its rows afterwards.  Buckets hold distinct fingerprints only, so copies weigh nothing.  A bucket of over
``block`` rows is cut into blocks by a hash, and each pair of blocks is one group.

Spark sizes a table by its file and its columns, not by the rows that an explode or packed copies make of it, and would
send through the driver what looks small.  So what grows with the corpus meets in merge joins, or stands on the left of a
join whose right side is grouped (only that one can be broadcast, by the size it then has).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm import components
from txnscope.llm.tables import NO_ID, bounded_batches, keyed, relaxed, with_columns
from txnscope.llm.words import column_bytes, compact, word_spans
from txnscope.plans.frames import materialize

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def fingerprints_of(buf: np.ndarray, offsets: np.ndarray, shingle: int) -> np.ndarray:
    """uint64 fingerprint of each text."""
    starts, ends, first = word_spans(buf, offsets)
    packed, starts, ends = compact(_LOWER[buf], starts, ends)
    words = np.diff(first)
    counts = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    out = np.zeros(len(counts), dtype=np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    if not len(text):
        return out
    before = np.cumsum(counts) - counts
    begin = np.arange(len(text)) - before[text] + first[:-1][text]
    last = np.minimum(begin + shingle, first[1:][text]) - 1
    view, digest = memoryview(packed.tobytes()), xxhash.xxh64_intdigest
    filled = np.flatnonzero(counts)
    half = counts[filled][:, None]
    ones = np.zeros((len(filled), 64), dtype=np.int64)
    cut = 1 << 16  # shingles at a time: 64 bytes each when unpacked
    rank = np.cumsum(counts > 0) - 1
    for a in range(0, len(text), cut):
        b = min(len(text), a + cut)
        hashes = np.array([digest(view[s:e], 42) for s, e in zip(starts[begin[a:b]].tolist(), ends[last[a:b]].tolist())], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owner = rank[text[a:b]]
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        ones[owner[edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int32)
    bits = (2 * ones > half).astype(np.uint8)
    out[filled] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``keyed`` rows with ``fp`` (long) added; a null text is empty."""
    return _fingerprinted(keyed(df, id_col, text_col).select("key", "text"), shingle).select("key", "fp")


def _fingerprinted(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows``, with ``fp`` (long) in place of ``text``."""
    bounded_batches(rows.sparkSession)
    kept = [c for c in rows.columns if c != "text"]

    def run(batches):
        for batch in batches:
            buf, offsets = column_bytes(batch.column("text"))
            out, lo = [], 0
            while lo < batch.num_rows:  # about 2 MB of text at a time
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + (2 << 20))) - 1)
                hi = min(hi, batch.num_rows)
                out.append(fingerprints_of(buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], shingle))
                lo = hi
            fp = np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)
            yield pa.record_batch([*[relaxed(batch.column(c)) for c in kept], pa.array(fp.view(np.int64))], names=[*kept, "fp"])

    return rows.mapInArrow(run, ", ".join([*[f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept], "fp long"]))


def segment_bounds(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments, distance + 1 and at least three, as even as can be."""
    m = max(3, distance + 1)
    edges = [round(i * 64 / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def chain_viable(x: np.ndarray, segments: list[tuple[int, int]], distance: int, start: int) -> np.ndarray:
    """Whether each difference mask keeps every chain from ``start`` within its share of the budget."""
    m = len(segments)
    ok, total = np.ones(len(x), dtype=bool), np.zeros(len(x), dtype=np.int64)
    for step in range(m):
        shift, width = segments[(start + step) % m]
        total += np.bitwise_count((x >> np.uint64(shift)) & np.uint64((1 << width) - 1))
        ok &= total * m <= (step + 1) * distance
    return ok


def bucket_rows(fps: DataFrame, distance: int) -> DataFrame:
    """(bucket, fp, rep): for each start, both first segments of the chain, and again with each set bit of the second cleared."""
    segments = segment_bounds(distance)
    m = len(segments)
    keys = []
    for i in range(m):
        (s, w), (s2, w2) = segments[i], segments[(i + 1) % m]
        one = F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1))
        two = F.shiftrightunsigned("fp", s2).bitwiseAND(F.lit((1 << w2) - 1))
        head = F.lit(i << 56).bitwiseOR(F.shiftleft(one, w2))
        keys.append(head.bitwiseOR(two))
        keys += [F.when(two.bitwiseAND(F.lit(1 << b)) != 0, head.bitwiseOR(two.bitwiseAND(F.lit(((1 << w2) - 1) ^ (1 << b))))) for b in range(w2)]
    return fps.select("fp", "rep", F.explode(F.array_compact(F.array(*keys))).alias("bucket"))


def _forest(fp: np.ndarray, rep: np.ndarray, start: int, segments, distance: int) -> list[tuple[int, int]]:
    """Links that connect what the bucket's links connect: breadth first, each row compared until it is reached."""
    edges, left = [], np.arange(len(fp))
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            here = frontier.pop()
            x = fp[left] ^ fp[here]
            near = np.flatnonzero(chain_viable(x, segments, distance, start))
            if len(near):
                near = near[np.bitwise_count(x[near]) <= distance]
                hit = left[near]
                if len(hit):
                    edges += [(int(rep[here]), int(r)) for r in rep[hit]]
                    frontier += hit.tolist()
                    keep = np.ones(len(left), dtype=bool)
                    keep[near] = False
                    left = left[keep]
    return edges


def links(fps: DataFrame, distance: int, block: int = 1 << 14) -> DataFrame:
    """(a, b): links between class representatives that span every component of the link graph."""
    if distance == 0:
        return fps.sparkSession.createDataFrame([], "a long, b long")
    segments = segment_bounds(distance)
    rows = bucket_rows(fps, distance)
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda j: F.least(j, mine).cast("long") * 1000003 + F.greatest(j, mine))
    rows = rows.join(sizes.hint("merge"), "bucket").select("bucket", "fp", "rep", F.explode(F.when(blocks == 1, F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("pair"))
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "bucket", "pair").sortWithinPartitions("bucket", "pair", "rep")

    def run(batches):
        carry = None
        for batch in batches:
            frame = batch.to_pandas()
            carry = frame if carry is None else pd.concat([carry, frame], ignore_index=True)
            bucket, pair = carry["bucket"].to_numpy(), carry["pair"].to_numpy()
            if len(carry) and (bucket[0], pair[0]) != (bucket[-1], pair[-1]):  # the last group may go on
                last = np.flatnonzero((bucket != bucket[-1]) | (pair != pair[-1]))[-1] + 1
                yield from forests(carry[:last])
                carry = carry[last:].reset_index(drop=True)
        if carry is not None and len(carry):
            yield from forests(carry)

    def forests(frame):
        bucket, pair = frame["bucket"].to_numpy(), frame["pair"].to_numpy()
        fp, rep = frame["fp"].to_numpy().view(np.uint64), frame["rep"].to_numpy()
        edge = np.flatnonzero(np.diff(bucket) | np.diff(pair)) + 1
        begin, end = np.r_[0, edge], np.r_[edge, len(frame)]
        two = begin[end - begin == 2]  # most groups: one comparison each, all at once
        x, origin, ok = fp[two] ^ fp[two + 1], bucket[two] >> 56, np.zeros(len(two), dtype=bool)
        for k in range(len(segments)):
            ok[origin == k] = chain_viable(x[origin == k], segments, distance, k)
        ok &= np.bitwise_count(x) <= distance
        found = list(zip(rep[two[ok]].tolist(), rep[two[ok] + 1].tolist()))
        for s, e in zip(begin[end - begin > 2].tolist(), end[end - begin > 2].tolist()):
            found += _forest(fp[s:e], rep[s:e], int(bucket[s]) >> 56, segments, distance)
        if found:
            a, b = np.array(found, dtype=np.int64).T
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).query("a != b").drop_duplicates(), preserve_index=False)

    return rows.mapInArrow(run, "a long, b long").distinct()


def _components(df: DataFrame, id_col: str, text_col: str, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """((key, fp) of each row, (fp, component) of each fingerprint); ``component`` is the smallest fingerprint reached over links."""
    marked = materialize(fingerprint(df, id_col, text_col, shingle), "simhash")
    fps = materialize(marked.select("fp").distinct().withColumn("rep", F.col("fp")), "simhash-distinct")
    labels = components.connected(materialize(links(fps, distance), "simhash-links"))
    return marked, fps.join(labels.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("component"))


def _least_keys(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(component, key): the smallest id of each component, ``NO_ID`` if none of its rows has one."""
    first = F.min(F.struct((F.col("key") == NO_ID).alias("none"), "key"))
    least = marked.groupBy("fp").agg(first.alias("first")).join(labels.hint("merge"), "fp")
    return least.groupBy("component").agg(F.min("first")["key"].alias("key"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """(key, fp, component_id) for each row of ``df``.

    ``key`` is the id (``NO_ID`` for null), ``fp`` the fingerprint as a long, ``component_id`` the smallest id among the
    rows that can be reached over links (``NO_ID`` if none of them has an id).  Null and empty texts have fingerprint zero
    and are linked like any other; rows that repeat an id are each listed and not linked by it (components whose
    smallest id is the same bear the same ``component_id``); an empty table gives no rows.
    """
    marked, labels = _components(df, id_col, text_col, shingle, distance)
    labels = materialize(labels, "simhash-labels")
    least = _least_keys(marked, labels).withColumnRenamed("key", "component_id")
    ids = labels.join(least, "component", "left").select("fp", "component_id")  # each component has one
    return marked.join(ids.hint("merge"), "fp")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """``df`` with one row of each component: the one with the smallest id, null last (of rows that repeat it, the smallest text)."""
    marked, labels = _components(df, id_col, text_col, shingle, distance)
    labels = materialize(labels, "simhash-labels")
    chosen = materialize(_least_keys(marked, labels), "simhash-chosen")
    rows = keyed(df, id_col, text_col)
    repeated = marked.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    single = rows.join(chosen.join(repeated, "key", "left_anti").hint("merge"), "key", "left_semi")
    # a key of several rows does not tell which of them is in the component: their fingerprints do
    several = rows.join(chosen.join(repeated, "key", "left_semi").select("key").hint("merge"), "key", "left_semi")
    several = _fingerprinted(several.select("row", "key", F.col("text").alias("words"), "text"), shingle)
    tied = several.join(labels.hint("merge"), "fp").join(chosen.hint("merge"), ["component", "key"], "left_semi").groupBy("component").agg(F.min_by("row", "words").alias("row"))
    return with_columns(single.select("row").unionByName(tied.select("row")), df.columns)
