"""Vector code compression: product codebooks refined under Drake-Hamerly adaptive bounds.

Each vector is cut into equal consecutive parts, and each part position has its own
codebook.  For each part of each vector a table keeps the nearest entry with an upper
bound of its distance, the ``b`` next entries in order with a lower bound for each, and
one outer lower bound for all entries left.  When the entries move, the bounds widen by
how far; a part whose upper bound stays below every lower bound keeps its entry without
a comparison.  Others are compared as far down the order as the bounds demand, in exact
integers (Drake and Hamerly, "Accelerated k-means with adaptive distance bounds", 2012).
``b`` starts at a quarter of the entries and shrinks to what the last round used.

A round is one pass: it reads the table of blocks (components and bounds) and writes the
next one, with the blocks' component sums as columns of their own, from which Spark adds
up the new entries; the driver sees only the codebooks.  The table before the last goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnscope.llm.vectors import Scratch, finite, integers, matrix, packed, squared_distances, unpacked

BLOCK = 4096
_FAR = (1 << 31) - 1
#: of all (vector, part) pairs, at most this share may need more bounds than are kept
_SPARE = 0.01


def _below(squares: np.ndarray) -> np.ndarray:
    """A lower bound of the root, safe against its rounding."""
    return np.maximum(np.floor(np.sqrt(squares.astype(np.float64))).astype(np.int64) - 1, 0)


def _above(squares: np.ndarray) -> np.ndarray:
    return np.ceil(np.sqrt(squares.astype(np.float64))).astype(np.int64) + 1


class Bounds:
    """Bounds of one part position for the rows of a block (all int64 while in use)."""

    def __init__(self, nearest, upper, order, lower, outer):
        self.nearest, self.upper, self.order, self.lower, self.outer = nearest, upper, order, lower, outer

    @classmethod
    def fresh(cls, x: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
        """Exact bounds from all distances."""
        squares = squared_distances(x, entries)
        order = np.argsort(squares, axis=1, kind="stable")  # equal distances: the lower index first
        ranked = np.take_along_axis(squares, order, axis=1)
        outer = _below(ranked[:, b + 1]) if b + 1 < len(entries) else np.full(len(x), _FAR, dtype=np.int64)
        return cls(order[:, 0], _above(ranked[:, 0]), order[:, 1:b + 1], _below(ranked[:, 1:b + 1]), outer)

    def shrink(self, b: int) -> None:
        if b < self.order.shape[1]:
            self.outer = np.minimum(self.outer, self.lower[:, b:].min(axis=1))
            self.order, self.lower = self.order[:, :b], self.lower[:, :b]

    def moved(self, x: np.ndarray, entries: np.ndarray, drift: np.ndarray) -> np.ndarray:
        """Follow entries that moved by at most ``drift``; returns how many bounds each row needed (b + 1: all entries)."""
        b = self.order.shape[1]
        self.upper = self.upper + drift[self.nearest]
        self.lower = self.lower - drift[self.order]
        self.outer = np.where(self.outer >= _FAR, _FAR, self.outer - drift.max(initial=0))
        # tail[z]: lower bound of all entries from place z on
        tail = np.minimum.accumulate(np.concatenate([self.lower, self.outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
        needed = np.zeros(len(x), dtype=np.int64)
        open_rows = np.flatnonzero(self.upper >= tail[:, 0])
        if not len(open_rows):
            return needed
        own = x[open_rows].astype(np.int64) - entries[self.nearest[open_rows]]
        self.upper[open_rows] = _above((own * own).sum(axis=1))
        needed[open_rows] = (self.upper[open_rows, None] >= tail[open_rows]).sum(axis=1)
        for z in range(1, b + 1):
            rows = np.flatnonzero(needed == z)
            if len(rows):
                self._compare(rows, z, x, entries)
        rows = np.flatnonzero(needed == b + 1)
        if len(rows):
            new = Bounds.fresh(x[rows], entries, b)
            self.nearest[rows], self.upper[rows], self.outer[rows] = new.nearest, new.upper, new.outer
            self.order[rows], self.lower[rows] = new.order, new.lower
        return needed

    def _compare(self, rows: np.ndarray, z: int, x: np.ndarray, entries: np.ndarray) -> None:
        """Exact distances to the nearest entry so far and the first ``z`` of the order; the rest cannot be nearer."""
        some = np.concatenate([self.nearest[rows, None], self.order[rows, :z]], axis=1)
        diff = entries[some] - x[rows, None, :].astype(np.int64)
        squares = (diff * diff).sum(axis=2)
        by_index = np.argsort(some, axis=1)
        some, squares = np.take_along_axis(some, by_index, 1), np.take_along_axis(squares, by_index, 1)
        ranks = np.argsort(squares, axis=1, kind="stable")
        some, squares = np.take_along_axis(some, ranks, 1), np.take_along_axis(squares, ranks, 1)
        self.nearest[rows], self.upper[rows] = some[:, 0], _above(squares[:, 0])
        self.order[rows, :z], self.lower[rows, :z] = some[:, 1:], _below(squares[:, 1:])


def _sums(x: np.ndarray, nearest: np.ndarray, k: int) -> np.ndarray:
    """(k, 1 + width): count and component sums by entry."""
    out = np.empty((k, 1 + x.shape[1]), dtype=np.int64)
    hot = np.zeros((k, len(x)), dtype=np.float64)
    hot[nearest, np.arange(len(x))] = 1.0
    out[:, 0] = np.bincount(nearest, minlength=k)
    if len(x) * float(np.abs(x).max(initial=0)) < 1 << 53:
        out[:, 1:] = (hot @ x.astype(np.float64)).astype(np.int64)
    else:
        out[:, 1:] = 0
        np.add.at(out[:, 1:], nearest, x.astype(np.int64))
    return out


class _Table:
    """Layout of the table of blocks: ids, carried columns, components, bounds, and what a round adds up."""

    def __init__(self, df: DataFrame, id_col: str, carry: list[str], parts: int, k: int, dims: int):
        self.carry, self.parts, self.k, self.dims, self.width = carry, parts, k, dims, dims // parts
        types = {f.name: f.dataType for f in df.schema.fields}
        self.schema = T.StructType([T.StructField("ids", T.ArrayType(T.LongType()))]
                                   + [T.StructField(f"carry_{i}", T.ArrayType(types[c])) for i, c in enumerate(carry)]
                                   + [T.StructField(n, T.BinaryType()) for n in ("x", "nearest", "upper", "order", "lower", "outer")]
                                   + [T.StructField("sums", T.ArrayType(T.LongType())), T.StructField("needed", T.ArrayType(T.LongType()))])
        from pyspark.sql.pandas.types import to_arrow_schema

        self.arrow = to_arrow_schema(self.schema)

    def row(self, kept: list, x: np.ndarray, bounds: list[Bounds], needed: np.ndarray) -> pa.RecordBatch:
        sums = np.concatenate([_sums(x[:, p * self.width:(p + 1) * self.width], bounds[p].nearest, self.k) for p in range(self.parts)])
        cells = [*kept, packed(x, np.int32), packed([q.nearest for q in bounds], np.uint8), packed([q.upper for q in bounds], np.int32),
                 packed([q.order for q in bounds], np.uint8), packed([np.maximum(q.lower, -_FAR) for q in bounds], np.int32),
                 packed([np.maximum(q.outer, -_FAR) for q in bounds], np.int32), sums.ravel(), needed]
        return pa.RecordBatch.from_arrays([pa.array([c], type=f.type) if not isinstance(c, pa.Array)
                                           else pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c).cast(f.type)
                                           for c, f in zip(cells, self.arrow)], schema=self.arrow)

    def read(self, batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, list[Bounds]]:
        x = unpacked(batch.column("x")[i], np.int32, -1, self.dims)
        n, p = len(x), self.parts
        nearest = unpacked(batch.column("nearest")[i], np.uint8, p, n).astype(np.int64)
        upper, outer = (unpacked(batch.column(c)[i], np.int32, p, n).astype(np.int64) for c in ("upper", "outer"))
        order = unpacked(batch.column("order")[i], np.uint8, -1).astype(np.int64)
        lower = unpacked(batch.column("lower")[i], np.int32, -1).astype(np.int64)
        b = len(order) // (p * n)
        order, lower = order.reshape(p, n, b), lower.reshape(p, n, b)
        return x, [Bounds(nearest[q], upper[q], order[q], lower[q], outer[q]) for q in range(p)]


def _lists(batch: pa.RecordBatch, columns: list[str], i: int) -> list[pa.Array]:
    return [batch.column(c)[i].values for c in columns]


def _first(df: DataFrame, table: _Table, codebooks: np.ndarray, id_col: str, vector_col: str, scale: int, b: int) -> DataFrame:
    """Blocks with the bounds of the first round."""
    columns = [id_col, *table.carry]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = matrix(batch.column("vector"), table.dims, scale)
            for at in range(0, len(kept), BLOCK):
                rows, part = kept[at:at + BLOCK], x[at:at + BLOCK]
                bounds = [Bounds.fresh(part[:, p * table.width:(p + 1) * table.width], codebooks[p], b) for p in range(table.parts)]
                needed = np.zeros(table.k + 1, dtype=np.int64)
                yield table.row([batch.column(j).take(pa.array(rows)) for j in range(len(columns))], part, bounds, needed)

    named = [F.col(f"`{c}`").alias(f"c{i}") if i else F.col(f"`{c}`").cast("long").alias("c0") for i, c in enumerate(columns)]
    return df.select(*named, F.col(f"`{vector_col}`").alias("vector")).mapInArrow(build, table.schema)


def _next(blocks: DataFrame, table: _Table, codebooks: np.ndarray, drift: np.ndarray, b: int) -> DataFrame:
    """The same blocks with bounds that follow the moved entries."""
    columns = ["ids", *[f"carry_{i}" for i in range(len(table.carry))]]

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, bounds = table.read(batch, i)
                needed = np.zeros(table.k + 1, dtype=np.int64)
                for p, q in enumerate(bounds):
                    q.shrink(b)
                    used = q.moved(x[:, p * table.width:(p + 1) * table.width], codebooks[p], drift[p])
                    needed += np.bincount(used, minlength=table.k + 1)
                yield table.row(_lists(batch, columns, i), x, bounds, needed)

    return blocks.mapInArrow(advance, table.schema)


def _added(blocks: DataFrame, column: str, size: int) -> np.ndarray:
    """Sum of a list column of fixed size over all blocks (added up in the tasks first)."""
    rows = blocks.select(F.posexplode(column)).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    out = np.zeros(size, dtype=np.int64)
    for r in rows:
        out[r["pos"]] = r["total"]
    return out


def fewer_bounds(needed: np.ndarray, b: int, least: int) -> int:
    """The number of bounds to keep on: as many as all but ``_SPARE`` of the parts used, not under ``least``, never more than now."""
    total = int(needed.sum())
    for fewer in range(least, b):
        if needed[fewer + 1:].sum() <= _SPARE * total:
            return fewer
    return b


def train_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", carry: tuple[str, ...] = (), scale: int = 4096,
                parts: int = 8, entries: int = 16, rounds: int = 6) -> tuple[DataFrame, np.ndarray]:
    """(codes, codebooks): codes has ``id_col``, the carried columns, ``code`` (two hex digits a part) and ``error``.

    Components are floor(scale * x).  Entries start as the parts of the ``entries`` kept vectors with the smallest ids
    (null ids last, equal ids by components).  Ties go to the lower index; unused entries stay.

    Odd rows: a null vector or one with a null, NaN or infinite component goes, and so does one whose length is not
    that of the first kept vector (smallest id among those with a length that divides into ``parts``).  Fewer kept
    vectors than ``entries`` make smaller codebooks; none make an empty result.  Repeated ids and null ids keep
    their rows.  Components are held within ``component_limit``.  Other columns of ``df`` do not matter.
    """
    spark = df.sparkSession
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    v, key = F.col(f"`{vector_col}`"), F.col(f"`{id_col}`")
    usable = finite(df, vector_col, parts=parts).select(key.cast("long").alias("id"), v.cast("array<double>").alias("v"))
    seeds = usable.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    carried = [F.col(f"`{c}`") for c in carry]
    if not seeds:
        empty = df.where("false").select(key, *carried, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), dtype=np.int64)
    dims = len(seeds[0]["v"])
    seeds = usable.where(F.size("v") == dims).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    first = integers(np.array([s["v"] for s in seeds], dtype=np.float64), scale).astype(np.int64)
    codebooks = np.ascontiguousarray(first.reshape(len(seeds), parts, dims // parts).transpose(1, 0, 2))
    k = len(seeds)
    table = _Table(df, id_col, list(carry), parts, k, dims)
    least, b = min(max(1, k // 8), k - 1), min(max(1, k // 4), k - 1)
    scratch = Scratch(spark, "codebooks")
    path, blocks = scratch.write(_first(df, table, codebooks, id_col, vector_col, scale, b))
    for _ in range(rounds):
        sums = _added(blocks, "sums", parts * k * (1 + table.width)).reshape(parts, k, 1 + table.width)
        counts = sums[:, :, :1]
        new = np.where(counts > 0, sums[:, :, 1:] // np.maximum(counts, 1), codebooks)
        drift = _above(((new - codebooks) ** 2).sum(axis=2)) * (new != codebooks).any(axis=2)
        needed = _added(blocks, "needed", k + 1)
        b = fewer_bounds(needed, b, least) if needed.any() else b
        codebooks = new
        old = path
        path, blocks = scratch.write(_next(blocks, table, codebooks, drift, b))
        scratch.drop(old)
    return _codes(blocks, table, codebooks, id_col, df), codebooks


def _codes(blocks: DataFrame, table: _Table, codebooks: np.ndarray, id_col: str, df: DataFrame) -> DataFrame:
    """One row for each vector: its entries in hex and its squared error."""
    types = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField("id", T.LongType()), *[T.StructField(f"carry_{i}", types[c]) for i, c in enumerate(table.carry)],
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    columns = ["ids", *[f"carry_{i}" for i in range(len(table.carry))]]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = unpacked(batch.column("x")[i], np.int32, -1, table.dims).astype(np.int64)
                nearest = unpacked(batch.column("nearest")[i], np.uint8, table.parts, len(x))
                error = np.zeros(len(x), dtype=np.int64)
                for p in range(table.parts):
                    diff = x[:, p * table.width:(p + 1) * table.width] - codebooks[p][nearest[p]]
                    error += (diff * diff).sum(axis=1)
                digits = np.ascontiguousarray(nearest.T).tobytes().hex()
                step = 2 * table.parts
                codes = [digits[j:j + step] for j in range(0, len(digits), step)]
                yield pa.RecordBatch.from_arrays([*_lists(batch, columns, i), pa.array(codes, pa.string()), pa.array(error)],
                                                 names=[f.name for f in schema.fields])

    out = blocks.select(*columns, "x", "nearest").mapInArrow(spell, schema)
    return out.select(F.col("id").alias(id_col), *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(table.carry)], "code", "error")


def codebooks_digest(codebooks: np.ndarray) -> str:
    """Hex SHA-256 of all entries' components in decimal by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def code_digest(df: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (errors over equal labels, nulls together) and the digest of the codebooks."""
    codes, codebooks = train_codes(df, carry=("label",))
    by_label = codes.groupBy(F.col("label").alias("same")).agg(_long_sum("error").alias("label_error"))
    out = codes.join(by_label, codes.label.eqNullSafe(by_label.same))
    return out.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"))


def _long_sum(column: str):
    """Exact sum, held at the largest long."""
    return F.least(F.sum(F.col(column).cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")


def oracle_sql(scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The contract in SQL: plain rounds over all distances."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {scale}) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, label, p, list_slice(v, p * (len(v) // {parts}) + 1, (p + 1) * (len(v) // {parts})) AS s
  FROM kept, range({parts}) AS r(p)),
c0 AS MATERIALIZED (
  SELECT p, CAST(dense_rank() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS j, s AS c
  FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""]
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (
  SELECT vec_id, label, p, s, min({{'d': d, 'j': j}}) AS m
  FROM (SELECT cut.vec_id, cut.label, cut.p, cut.s, c{t}.j,
               CAST(list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM cut JOIN c{t} ON cut.p = c{t}.p)
  GROUP BY vec_id, label, p, s)""")
        if t < rounds:
            steps.append(f"""
s{t} AS MATERIALIZED (
  SELECT p, j, list(q ORDER BY i) AS c
  FROM (SELECT p, m.j AS j, i, CAST((sum(s[i]) - ((sum(s[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS q
        FROM a{t}, range(1, 1 + (SELECT max(len(s)) FROM cut)) AS r(i) GROUP BY p, m.j, i)
  GROUP BY p, j),
c{t + 1} AS MATERIALIZED (
  SELECT c{t}.p, c{t}.j, coalesce(s{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN s{t} ON c{t}.p = s{t}.p AND c{t}.j = s{t}.j)""")
    return f"""WITH {','.join(steps)},
codes AS (
  SELECT vec_id, label, string_agg(printf('%02x', m.j), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes, digest"""
