"""Document fingerprints by one-permutation MinHash.

Each shingle (``shingle`` words; a text with fewer words is one shingle) is hashed once.
The high bits of the hash name a bin, which keeps its smallest hash.  An empty bin takes
its value from a filled one by optimal densification: bin i tries the bins of a fixed
random sequence (a universal hash of i and the attempt) until one is filled, so equal bins
stay equal with the chance of the similarity.  ``bits`` low bits of each bin are packed;
the likeness removes the chance 2**-bits that different values agree in them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscope.llm.tables import NO_ID, bounded_batches, keyed, pieces_for
from txnscope.llm.words import gram_hashes, hash_spans, mix, text_bytes, word_spans
from txnscope.plans.frames import materialize

BINS, BITS, SHINGLE = 256, 8, 5
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(texts: list[str | bytes], bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> np.ndarray:
    """(text, bin) -> low bits; the row of a text without words is all zero (``filled`` tells it from others)."""
    buf, offsets = text_bytes(texts)
    starts, ends, first = word_spans(buf, offsets)
    hashes = hash_spans(buf, starts, ends)
    words = np.diff(first)
    counts = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    text = np.repeat(np.arange(len(counts)), counts)
    begin = np.arange(len(text)) - (np.cumsum(counts) - counts)[text] + first[:-1][text]
    grams = np.empty(len(text), dtype=np.uint64)
    long = words[text] >= shingle
    if long.any():
        grams[long] = gram_hashes(hashes, shingle)[begin[long]]
    for n in range(1, shingle):
        short = words[text] == n
        if short.any():
            grams[short] = gram_hashes(hashes, n)[begin[short]]
    table = np.full(len(counts) * bins, _FREE, dtype=np.uint64)
    np.minimum.at(table, text * bins + (grams >> np.uint64(32)).astype(np.int64) % bins, mix(grams ^ np.uint64(0x5851F42D4C957F2D)))
    return densified(table.reshape(-1, bins), bins) & np.uint64((1 << bits) - 1)


def densified(table: np.ndarray, bins: int) -> np.ndarray:
    """Fills empty bins; rows without any filled bin become zero."""
    hollow = (table == _FREE).all(axis=1)
    table[hollow] = 0
    row, empty = np.nonzero(table == _FREE)
    out, attempt = table.copy(), 0
    while len(row):
        attempt += 1
        donor = (mix(empty.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt * 0xD6E8FEB86659FD93 % (1 << 64))) >> np.uint64(32)).astype(np.int64) % bins
        value = table[row, donor]
        hit = value != _FREE
        out[row[hit], empty[hit]] = value[hit]
        row, empty = row[~hit], empty[~hit]
    return out


def packed_bytes(signature: np.ndarray, bits: int = BITS) -> list[bytes]:
    """The low bits of each row, bin after bin."""
    cells = np.unpackbits(signature.astype(">u8").view(np.uint8).reshape(*signature.shape, 8), axis=2)[:, :, 64 - bits:]
    return [row.tobytes() for row in np.packbits(cells.reshape(len(signature), -1), axis=1)]


def packed(signature: np.ndarray, bits: int = BITS) -> list[str]:
    """The same in hexadecimal digits."""
    return [row.hex() for row in packed_bytes(signature, bits)]


def likeness(a: np.ndarray, b: np.ndarray, has_a: np.ndarray, has_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated similarity of rows: the share of equal bins without what chance adds; texts without words are alike."""
    equal = (a == b).mean(axis=1)
    chance = 2.0 ** -bits
    out = np.clip((equal - chance) / (1 - chance), 0.0, 1.0)
    return np.where(has_a & has_b, out, (has_a == has_b).astype(float))


def _has_words(texts: list[str]) -> np.ndarray:
    buf, offsets = text_bytes(texts)
    return np.diff(word_spans(buf, offsets)[2]) > 0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE) -> DataFrame:
    """(key, fingerprint) of each row: ``bins`` x ``bits`` bits in hexadecimal digits; no shuffle.

    A null or empty text has a fingerprint of zeros; equal texts have equal fingerprints whatever their ids.
    """
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                texts = batch.column("text").slice(lo, 200).to_pylist()
                yield pa.record_batch([batch.column("key").slice(lo, 200), pa.array(packed(signatures(texts, bins, bits, shingle), bits), pa.string())], names=["key", "fingerprint"])

    return keyed(df, id_col, text_col).select("key", "text").mapInArrow(run, "key long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


# binary until the last step: half the size of digits
RESULT = [("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
          ("near_edited", pa.float64()), ("near_next", pa.float64())]
RESULT_DDL = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compared(texts: list[str], following: list[str]) -> list[pa.Array]:
    """The result columns of texts whose next texts are ``following``."""
    changed = [edited(a, b) for a, b in zip(texts, following)]
    n = len(texts)
    signs, has = signatures(texts + changed + following[-1:]), _has_words(texts + changed + following[-1:])
    own, altered = slice(0, n), slice(n, 2 * n)
    if following[:-1] == texts[1:]:  # consecutive rows: the next texts' signatures are there already
        after = np.r_[1:n, 2 * n]
        after_signs, after_has = signs[after], has[after]
    else:
        after_signs, after_has = signatures(following), _has_words(following)
    columns = [[len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed], packed_bytes(signs[own]), packed_bytes(signs[altered]),
               likeness(signs[own], signs[altered], has[own], has[altered]), likeness(signs[own], after_signs, has[own], after_has)]
    return [pa.array(c, t) for c, (_, t) in zip(columns, RESULT)]


def edit_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The next document is that of the next id (ties: by a hash of the text); the first comes after the last.  The texts
    are dealt once, by ranges of ids; a range's last row meets the next range's first row by a join of only these.
    A null text is empty, a null id comes first, a single row is its own next, an empty table gives no rows, other
    columns are not read.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    rows = keyed(df, id_col, text_col).select("key", "text")
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(pieces_for(rows, 8.0), "key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    names = [n for n, _ in RESULT]

    def run(batches):
        from pyspark import TaskContext

        part, key, held, size, first = TaskContext.get().partitionId(), [], [], 0, True

        def out(keys, columns, kind, texts):
            n = len(keys)
            return pa.record_batch([pa.array(keys, pa.int64()), *columns, pa.array([part] * n, pa.int32()), pa.array([kind] * n, pa.string()), pa.array(texts, pa.string())],
                                   names=["key", *names, "part", "kind", "text"])

        def edge(k, kind, text):
            return out([k], [pa.nulls(1, t) for _, t in RESULT], kind, [text])

        for batch in batches:
            for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                if first:
                    yield edge(k, "first", text)
                    first = False
                key.append(k)
                held.append(text)
                size += len(text)
                if len(held) > 1 and (len(held) > 300 or size > 1 << 19):
                    yield out(key[:-1], compared(held[:-1], held[1:]), "row", [None] * (len(key) - 1))
                    key, held, size = key[-1:], held[-1:], len(text)
        if len(held) > 1:
            yield out(key[:-1], compared(held[:-1], held[1:]), "row", [None] * (len(key) - 1))
        if held:
            yield edge(key[-1], "last", held[-1])

    done = materialize(dealt.mapInArrow(run, f"key long, {RESULT_DDL}, part int, kind string, text string"), "edit-likeness")
    firsts, lasts = (done.where(F.col("kind") == k).select("part", "key", "text") for k in ("first", "last"))
    parts = firsts.select("part")  # a number for each range
    after = parts.withColumn("next", F.lead("part").over(Window.orderBy("part"))).withColumn("least", F.min("part").over(Window.partitionBy())) \
        .select("part", F.coalesce("next", "least").alias("next"))
    pairs = lasts.join(after, "part").join(firsts.select(F.col("part").alias("next"), F.col("text").alias("following")), "next").select("key", "text", "following")

    def seam(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                yield pa.record_batch([row.column("key"), *compared(row.column("text").to_pylist(), row.column("following").to_pylist())], names=["key", *names])

    everything = done.where("kind = 'row'").select("key", *names).union(pairs.mapInArrow(seam, f"key long, {RESULT_DDL}"))
    digits = [F.lower(F.hex(n)).alias(n) if pa.types.is_binary(t) else F.col(n) for n, t in RESULT]
    return everything.select(F.when(F.col("key") != NO_ID, F.col("key")).alias(id_col), *digits)
