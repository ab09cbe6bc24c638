"""Token ids as static range asymmetric numeral system (rANS) streams.

Layout: a Parquet table with a row for each block (``part``, ``block``, ``payload``), in
ascending id order by (part, block), beside a one-row table with the frequency table that
all blocks share.  A payload is independent of all others and holds, little-endian:

    magic  u32 | tokens u32 | lanes u32 | entries u32 | checkpoints u32 | words u32 | crc32 of the ids u32
    entries      x (key i64, offset u64, tokens u64, total u64)   a document, or the part of it that the block holds
    checkpoints  x (step u32, word u32, lanes x state u64)   a decoder can start at each; the first is step 0
    words        x u32

Token i is coded by lane i mod lanes; all lanes move in step, so a block is decoded by array
operations, and intervals between checkpoints can be decoded apart.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnscope.llm.byte_bpe import encoder, slices
from txnscope.llm.tables import NO_ID, bounded_batches, keyed, pieces_for
from txnscope.plans.frames import materialize
from txnscope.session import scratch_path

MAGIC = 0x53414E52
LOW = np.uint64(1 << 31)
BLOCK_TOKENS = 1 << 18
LANES = 1024
CHECKPOINT_STEPS = 128
ENTRY = [("key", "<i8"), ("offset", "<u8"), ("n", "<u8"), ("total", "<u8")]
_HEAD = struct.Struct("<7I")


class Frequencies:
    """Frequencies that add up to 2**bits, each symbol that occurs at least 1."""

    def __init__(self, symbols: np.ndarray, scaled: np.ndarray, bits: int):
        self.symbols, self.scaled, self.bits = symbols.astype(np.uint32), scaled.astype(np.uint64), bits
        self.upto = np.concatenate([[0], np.cumsum(scaled)]).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(symbols), dtype=np.int32), scaled.astype(np.int64))
        self.index = np.zeros(int(symbols.max()) + 1 if len(symbols) else 1, dtype=np.int64)
        self.index[symbols] = np.arange(len(symbols))

    @classmethod
    def scaled_from(cls, symbols: np.ndarray, counts: np.ndarray) -> "Frequencies":
        if not len(symbols):
            return cls(symbols, counts.astype(np.int64), 16)
        bits = max(16, int(len(symbols) - 1).bit_length() + 2)
        size = 1 << bits
        share = counts * ((size - len(counts)) / max(1, counts.sum()))
        scaled = 1 + np.floor(share).astype(np.int64)
        rest = size - int(scaled.sum())
        scaled[np.argsort(-(share - np.floor(share)), kind="stable")[:rest]] += 1
        if int(scaled.sum()) != size:
            scaled[int(np.argmax(scaled))] += size - int(scaled.sum())
        return cls(symbols, scaled, bits)


def encode_block(ids: np.ndarray, entries: list[tuple[int, int, int, int]], table: Frequencies, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
    """The payload of one block; ``entries`` are (key, ids before, ids here, ids in all) of documents."""
    lanes = max(1, min(lanes, len(ids) // 64))
    steps = -(-len(ids) // lanes)
    at = np.full(steps * lanes, int(np.argmax(table.scaled)), dtype=np.int64)  # padding: the cheapest symbol
    at[:len(ids)] = table.index[ids]
    at = at.reshape(steps, lanes)
    bits, reach = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, LOW, dtype=np.uint64)
    words, marks, written = [], [], 0
    for step in range(steps - 1, -1, -1):
        freq, start = table.scaled[at[step]], table.upto[at[step]]
        full = (state >> reach) >= freq
        if full.any():
            words.append(state[full].astype(np.uint32))
            written += len(words[-1])
            state[full] >>= np.uint64(32)
        high = state // freq
        state = (high << bits) + (state - high * freq) + start
        if step % every == 0:
            marks.append((step, written, state.copy()))
    head = _HEAD.pack(MAGIC, len(ids), lanes, len(entries), len(marks), written, zlib.crc32(ids.astype("<u4").tobytes()))
    listed = np.array(entries, dtype=ENTRY).tobytes()
    checkpoints = b"".join(struct.pack("<2I", step, written - upto) + at_step.astype("<u8").tobytes() for step, upto, at_step in reversed(marks))
    return head + listed + checkpoints + (np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b"")


def read_head(payload: bytes) -> tuple[dict, np.ndarray, list[tuple[int, int, np.ndarray]], np.ndarray]:
    """(head, entries, checkpoints, words) of a payload."""
    magic, n, lanes, entries, marks, words, crc = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at = _HEAD.size
    listed = np.frombuffer(payload, dtype=ENTRY, count=entries, offset=at)
    at += listed.nbytes
    checkpoints = []
    for _ in range(marks):
        step, word = struct.unpack_from("<2I", payload, at)
        checkpoints.append((step, word, np.frombuffer(payload, dtype="<u8", count=lanes, offset=at + 8)))
        at += 8 + 8 * lanes
    return {"tokens": n, "lanes": lanes, "crc": crc}, listed, checkpoints, np.frombuffer(payload, dtype="<u4", count=words, offset=at)


def decode_steps(words: np.ndarray, checkpoint: tuple[int, int, np.ndarray], stop: int, table: Frequencies) -> np.ndarray:
    """Symbols of the steps from a checkpoint up to ``stop``, one row a step."""
    step, word, state = checkpoint
    state, bits, mask = state.astype(np.uint64), np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    out = np.empty((max(0, stop - step), len(state)), dtype=np.int32)
    for row in range(len(out)):
        slot = state & mask
        at = table.slot[slot.astype(np.int64)]
        out[row] = at
        state = table.scaled[at] * (state >> bits) + slot - table.upto[at]
        low = np.flatnonzero(state < LOW)
        if len(low):
            state[low] = (state[low] << np.uint64(32)) | words[word:word + len(low)].astype(np.uint64)
            word += len(low)
    return table.symbols[out]


def decode_block(payload: bytes, table: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """(entries, ids) of a block; raises where the checksum differs."""
    head, entries, checkpoints, words = read_head(payload)
    steps = -(-head["tokens"] // head["lanes"])
    stops = [c[0] for c in checkpoints[1:]] + [steps]
    parts = [decode_steps(words, c, stop, table).ravel() for c, stop in zip(checkpoints, stops)]
    ids = np.concatenate(parts)[:head["tokens"]] if parts else np.zeros(0, dtype=np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != head["crc"]:
        raise ValueError("a block's checksum differs")
    return entries, ids


def _cells(raw: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary cells that lie one after another in ``raw``."""
    if len(raw) >= 1 << 31:
        return pa.array([raw[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary())
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw)])


def token_rows(df: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(key, n_tokens, ids, counted): the ids with the end id, 2 bytes each where the vocabulary allows it, else 4.

    ``counted`` is null but in the last row of each task, which has no other values: the ids that the task has
    written (u32) and then how often (u64 each), so that nobody reads the ids again to count them.
    """
    bounded_batches(df.sparkSession)
    rows = keyed(df, id_col, text_col).select("key", "text")

    def run(batches):
        library = encoder(tokenizer)
        size = max(library.vocabulary, end_id + 1)
        kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        total = np.zeros(size, dtype=np.uint64)
        names = ["key", "n_tokens", "ids", "counted"]
        for batch in batches:
            for part, texts in slices(batch):
                found, offsets = library.encode(texts)
                edges = offsets + np.arange(len(offsets))
                ids = np.full(int(edges[-1]), end_id, dtype=kind)
                within = np.ones(len(ids), dtype=bool)
                within[edges[1:] - 1] = False
                ids[within] = found
                total += np.bincount(ids, minlength=size).astype(np.uint64)
                yield pa.record_batch([part.column("key"), pa.array(np.diff(edges)), _cells(ids.view(np.uint8), edges * kind.itemsize),
                                       pa.nulls(len(texts), pa.binary())], names=names)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                   pa.array([at.astype("<u4").tobytes() + total[at].astype("<u8").tobytes()])], names=names)

    return rows.mapInArrow(run, "key long, n_tokens long, ids binary, counted binary")


def _wide(cell: bytes, n: int) -> np.ndarray:
    return np.frombuffer(cell, dtype="<u2" if len(cell) == 2 * n else "<u4")


def frequencies(tokens: DataFrame) -> Frequencies:
    """The shared table, from the counts that the tasks left (as many rows as the vocabulary has ids)."""
    def run(batches):
        for batch in batches:
            for cell in batch.column("counted").to_pylist():
                n = len(cell) // 12
                yield pa.record_batch([pa.array(np.frombuffer(cell, dtype="<u4", count=n).astype(np.int64)),
                                       pa.array(np.frombuffer(cell, dtype="<u8", offset=4 * n).astype(np.int64))], names=["id", "n"])

    counted = tokens.select("counted").where(F.col("counted").isNotNull())
    rows = counted.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    return Frequencies.scaled_from(np.array([r["id"] for r in rows], dtype=np.int64), np.array([r["n"] for r in rows], dtype=np.float64))


def write_ids(df: DataFrame, tokenizer: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes every row's ids to ``path``/blocks and ``path``/table.

    A null text is the end id alone, a null id ``NO_ID`` (first), repeated rows are written each, an empty table
    gives no blocks; other columns are not read.
    """
    spark = df.sparkSession
    tokens = materialize(token_rows(df, tokenizer, end_id, id_col, text_col), "token-ids")
    table = frequencies(tokens)
    rows = tokens.where(F.col("counted").isNull()).select("key", "n_tokens", "ids")
    parts = pieces_for(tokens, 16.0)
    ordered = rows.repartitionByRange(parts, "key", "n_tokens").sortWithinPartitions("key", "n_tokens", "ids")

    def run(batches):
        from pyspark import TaskContext

        part, block, held, entries, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for key, n, cell in zip(*(batch.column(c).to_pylist() for c in ("key", "n_tokens", "ids"))):
                ids, at = _wide(cell, n), 0
                while at < n:
                    take = min(n - at, BLOCK_TOKENS - size)
                    held.append(ids[at:at + take])
                    entries.append((key, at, take, n))
                    at, size = at + take, size + take
                    if size == BLOCK_TOKENS:
                        yield row(part, block, held, entries)
                        block, held, entries, size = block + 1, [], [], 0
        if size:
            yield row(part, block, held, entries)

    def row(part, block, held, entries):
        ids = np.concatenate(held).astype(np.uint32)
        payload = encode_block(ids, entries, table)
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([payload], pa.binary())],
                               names=["part", "block", "n_tokens", "payload"])

    ordered.mapInArrow(run, "part int, block int, n_tokens long, payload binary").write.parquet(f"{path}/blocks")
    spark.createDataFrame([(table.symbols.tolist(), table.scaled.astype(np.int64).tolist(), table.bits)], "symbols array<long>, scaled array<long>, bits int") \
        .write.parquet(f"{path}/table")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(key, start, offset, n_tokens, total, ids_crc32[, ids]) of every document, or part of one that spans blocks, decoded.

    ``start`` counts all ids before the document, ``offset`` those of the document before this part.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    saved = spark.read.parquet(f"{path}/table").first()
    table = Frequencies(np.array(saved["symbols"], dtype=np.int64), np.array(saved["scaled"], dtype=np.int64), saved["bits"])
    sizes = blocks.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each part file
    part_start = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    block_start = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.join(parts.withColumn("before", F.coalesce(part_start, F.lit(0))), "part") \
        .select("part", "block", (F.col("before") + F.coalesce(block_start, F.lit(0))).alias("block_start"))
    names = ["key", "offset", "n_tokens", "total", "in_block", "ids_crc32", "part", "block"] + ["ids"] * with_ids

    def run(batches):
        for batch in batches:
            for part, block, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "payload"))):
                entries, ids = decode_block(payload, table)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                ends = np.cumsum(entries["n"].astype(np.int64))
                begins = ends - entries["n"].astype(np.int64)
                for lo in range(0, len(entries), 2000):
                    some = entries[lo:lo + 2000]
                    cells = [raw[4 * a:4 * b] for a, b in zip(begins[lo:lo + 2000].tolist(), ends[lo:lo + 2000].tolist())]
                    columns = [*(pa.array(some[c].astype(np.int64)) for c in ("key", "offset", "n", "total")), pa.array(begins[lo:lo + 2000]),
                               pa.array([zlib.crc32(c) for c in cells], pa.int64()), pa.array([part] * len(some), pa.int32()), pa.array([block] * len(some), pa.int32())]
                    if with_ids:
                        columns.append(pa.array([bytes(c) for c in cells], pa.binary()))
                    yield pa.record_batch(columns, names=names)

    bounded_batches(spark, rows=8)
    decoded = blocks.select("part", "block", "payload").mapInArrow(
        run, "key long, offset long, n_tokens long, total long, in_block long, ids_crc32 long, part int, block int" + ", ids binary" * with_ids)
    return decoded.join(starts, ["part", "block"]).withColumn("start", F.col("block_start") + F.col("in_block") - F.col("offset")).drop("block_start", "in_block", "part", "block")


def joined_crc(parts: list[tuple[int, int, int]]) -> int:
    """CRC-32 of the parts (offset, ids, crc) of a document one after another, without their bytes."""
    crc = 0
    for _, n, own in sorted(parts):
        zeros = bytes(4 * n)  # the effect of what is before on the checksum is linear
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ own
    return crc


def round_trip_digest(df: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row, from the files that ``write_ids`` has written."""
    spark = df.sparkSession
    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex[:12]}")
    write_ids(df, tokenizer, path, end_id, id_col, text_col)
    read = materialize(read_ids(spark, path, with_ids=False), "token-digests")
    whole = read.where("n_tokens = total").select("key", "start", "n_tokens", "ids_crc32")
    join = F.udf(lambda parts: joined_crc([tuple(p) for p in parts]), "long")  # only documents that span blocks
    spanning = read.where("n_tokens < total").groupBy("key", "start", "total").agg(F.collect_list(F.struct("offset", "n_tokens", "ids_crc32")).alias("parts")) \
        .select("key", "start", F.col("total").alias("n_tokens"), join("parts").alias("ids_crc32"))
    return whole.union(spanning).select(F.when(F.col("key") != NO_ID, F.col("key")).alias(id_col), "start", "n_tokens", "ids_crc32")
