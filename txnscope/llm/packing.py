"""Best-fit packing with large-item matching.

Documents become pieces of at most ``capacity`` tokens.  What is packed is the histogram
of piece lengths, which the capacity bounds, so the plan is made in one place whatever
the corpus: pieces over a third of the capacity pair at most two to a sequence, each with
the longest that still fits; smaller ones go, longest first, into the tightest gap.  Runs
of equal sequences are planned as one.  A piece finds its place by its rank among the
pieces of its length; ranks come from counts by (length, salt), so a length that holds
most rows is spread over many tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscope.llm.byte_bpe import encoder, slices
from txnscope.llm.tables import NO_ID, bounded_batches, keyed
from txnscope.plans.frames import materialize


def pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of each document's ids with the end id.

    Only longer documents are cut; all their pieces but the first have ``capacity`` tokens.
    """
    bounded_batches(df.sparkSession)
    rows = keyed(df, id_col, text_col).select("key", "text")

    def run(batches):
        library = encoder(tokenizer)
        for batch in batches:
            for part, texts in slices(batch):
                ids, offsets = library.encode(texts)
                out = []
                for key, a, b in zip(part.column("key").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    first = (len(own) - 1) % capacity + 1
                    edges = [0, *range(first, len(own) + 1, capacity)]
                    for k, (s, e) in enumerate(zip(edges, edges[1:])):
                        raw = own[s:e].tobytes()
                        out.append((key, k, s, e - s, zlib.crc32(raw), raw if with_ids else None))
                columns = list(zip(*out))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["key", "piece", "start", "length", "ids_crc32", "ids"]
                n = 6 if with_ids else 5
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns[:n], types)], names=names[:n])

    return rows.mapInArrow(run, "key long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(how many sequences, [(length, how many in each), ...]), ...] that hold each length as often as the histogram says."""
    left = {n: c for n, c in histogram.items() if c}
    bins: list[list] = []  # [sequences, contents, gap]
    gaps: dict[int, list[int]] = {}

    def add(count: int, contents: list, gap: int) -> None:
        gaps.setdefault(gap, []).append(len(bins))
        bins.append([count, contents, gap])

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        for b in large:
            if not left[a]:
                break
            if b > a or a + b > capacity or not left[b]:
                continue
            if a == b:
                pairs = left[a] // 2
                left[a] -= 2 * pairs
                if pairs:
                    add(pairs, [(a, 2)], capacity - 2 * a)
            else:
                pairs = min(left[a], left[b])
                left[a] -= pairs
                left[b] -= pairs
                add(pairs, [(a, 1), (b, 1)], capacity - a - b)
        if left[a]:
            add(left[a], [(a, 1)], capacity - a)
            left[a] = 0
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[n]
        for gap in range(n, capacity):
            if not count:
                break
            each = gap // n
            for k in gaps.pop(gap, ()):
                there, contents, _ = bins[k]
                whole = min(there, count // each)  # sequences that take as many as fit
                rest = min(count - whole * each, each - 1) if whole < there else 0  # one takes what is then left
                bins[k][0] = 0
                for many, inside in ((whole, each), (int(rest > 0), rest), (there - whole - (rest > 0), 0)):
                    if many:
                        add(many, contents + [(n, inside)] * (inside > 0), gap - inside * n)
                count -= whole * each + rest
        each = capacity // n
        if count // each:
            add(count // each, [(n, each)], capacity - n * each)
        if count % each:
            add(1, [(n, count % each)], capacity - n * (count % each))
    return [(many, contents) for many, contents, _ in bins if many]


def places(planned: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, how many in each, offset), by length and rank."""
    out, ranks, sequence = [], {}, 0
    for many, contents in planned:
        offset = 0
        for length, each in contents:
            out.append((length, ranks.get(length, 0), sequence, each, offset))
            ranks[length] = ranks.get(length, 0) + many * each
            offset += length * each
        sequence += many
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(table: DataFrame, capacity: int) -> DataFrame:
    """``table`` (key, piece, start, length, ...) with sequence_id and offset: no sequence holds over ``capacity``, none has gaps.

    An empty table stays empty.  Rows that repeat (key, piece) are packed each.
    """
    spark = table.sparkSession
    table = materialize(table, "pieces")
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = table.withColumn("salt", F.pmod(F.xxhash64("key", "piece", "start"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    at = places(plan(histogram, capacity))
    within = Window.partitionBy("length", "salt").orderBy("key", "piece", "start")
    ranked = salted.withColumn("in_salt", F.row_number().over(within) - 1).join(before, ["length", "salt"]) \
        .withColumn("rank", (F.col("before") + F.col("in_salt")).cast("long")).drop("salt", "before", "in_salt")
    columns = table.columns

    def run(batches):
        wide = np.int64(1) << np.int64(48)
        order = at[:, 0] * wide + at[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = at[np.searchsorted(order, length * wide + rank, side="right") - 1] if len(length) else at[:0]
            nth = rank - row[:, 1]
            yield pa.record_batch([*(batch.column(c) for c in columns), pa.array(row[:, 2] + nth // np.maximum(1, row[:, 3])),
                                   pa.array(row[:, 4] + nth % np.maximum(1, row[:, 3]) * length)], names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in table.dtypes)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(df: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset) for every piece of every row.

    A null or empty text is its end id alone; a null id stays null; repeated rows are packed each; other columns
    of ``df`` are not read.
    """
    packed = pack(pieces(df, tokenizer, end_id, capacity, id_col, text_col, with_ids), capacity)
    return packed.withColumn("key", F.when(F.col("key") != NO_ID, F.col("key"))).withColumnRenamed("key", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_tokens): the ids of each sequence, from pieces packed ``with_ids``."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(inside, F.lit(b""), lambda all_ids, x: F.concat(all_ids, x["ids"])).alias("ids"),
        F.sum("length").alias("n_tokens"))
