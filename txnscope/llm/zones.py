"""Centroid clustering over zone maps: blocks of a Hilbert order with min/max boxes.

Vectors are sorted along a Hilbert curve through a coarse grid, so that neighbours on the
curve are near in space, and cut into blocks; each block keeps the smallest and largest
value of every component.  From a box, the least and the greatest distance of each
centroid to any vector in it follow; a centroid whose least distance is above another's
greatest one cannot be nearest to any vector of the block.  Only the centroids left are
compared with the block's vectors, exactly and all at once.  The grid and the order
decide only how many centroids are left, never the result.

The blocks are written once; a round reads them and returns one row of sums for each
cluster and task, so the driver sees the centroids and their sums only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.tables import pieces_for
from txnscope.llm.vectors import Scratch, finite, integers, matrix, packed, squared_distances, unpacked

BLOCK = 256
GRID_BITS = 2


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows: coordinates below 2**bits) on the Hilbert curve, as rows of bytes in order.

    The transposed form of the index comes from undoing the curve's rotations bit by bit (J. Skilling, 2004);
    its bits are then interleaved, the first coordinate's highest bit first.
    """
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(dims):
            flipped = (x[i] & q) != 0
            swap = np.where(flipped, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flipped, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    carry = np.zeros(x.shape[1], dtype=np.uint32)
    for level in range(bits - 1, 0, -1):
        carry ^= np.where(x[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= carry
    planes = np.stack([(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]).astype(np.uint8)
    return np.packbits(planes.reshape(bits * dims, -1).T, axis=1)


def box_bounds(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) squared distance of each centroid to a point of the box."""
    below, above = low[None, :] - centroids, centroids - high[None, :]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    return (near * near).sum(axis=1), (far * far).sum(axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector of the box, ascending."""
    least, greatest = box_bounds(low.astype(np.int64), high.astype(np.int64), centroids)
    return np.flatnonzero(least <= greatest.min())


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's nearest centroid; ties go to the smaller number."""
    some = candidates(low, high, centroids)
    squares = squared_distances(x, centroids[some])
    at = squares.argmin(axis=1)
    return some[at], squares[np.arange(len(x)), at]


def _ordered_blocks(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int, seeds: np.ndarray) -> DataFrame:
    """Kept vectors in Hilbert order, one row a block."""
    cuts = np.sort(seeds, axis=0)[[(len(seeds) * (i + 1)) >> GRID_BITS for i in range((1 << GRID_BITS) - 1)]]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = matrix(batch.column("vector"), dims, scale)
            cells = (x[None, :, :] >= cuts[:, None, :]).sum(axis=0)
            keys = hilbert_keys(cells, GRID_BITS) if len(x) else []
            yield pa.RecordBatch.from_arrays([pa.array([bytes(k) for k in keys], pa.binary()), batch.column("id").take(pa.array(kept, pa.int64())),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["place", "id", "x"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cells = batch.column("id"), batch.column("x")
            for at in range(0, batch.num_rows, BLOCK):
                x = unpacked(b"".join(cells.slice(at, BLOCK).to_pylist()), np.int32, -1, dims)
                yield pa.RecordBatch.from_arrays([pa.array([ids.slice(at, BLOCK).to_pylist()], pa.list_(pa.int64())), pa.array([packed(x, np.int32)]),
                                                  pa.array([packed(x.min(axis=0), np.int32)]), pa.array([packed(x.max(axis=0), np.int32)])],
                                                 names=["ids", "x", "low", "high"])

    source = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    placed = source.mapInArrow(place, "place binary, id long, x binary")
    # copies of one vector share a place: the hash of the id lets the ranges divide them
    spread = placed.repartitionByRange(pieces_for(df, 64), "place", F.xxhash64("id"))
    return spread.sortWithinPartitions("place").select("id", "x").mapInArrow(cut, "ids array<long>, x binary, low binary, high binary")


def _round_sums(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (count, component sums)} of the vectors nearest to each centroid."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                x = unpacked(batch.column("x")[i], np.int32, -1, dims)
                low, high = (unpacked(batch.column(c)[i], np.int32, dims) for c in ("low", "high"))
                some = candidates(low, high, centroids)
                if len(some) == 1:
                    counts[some[0]] += len(x)
                    sums[some[0]] += x.sum(axis=0, dtype=np.int64)
                    continue
                at = some[squared_distances(x, centroids[some]).argmin(axis=1)]
                counts += np.bincount(at, minlength=k)
                for j in np.unique(at):
                    sums[j] += x[at == j].sum(axis=0, dtype=np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "sums"])

    parts = blocks.select("x", "low", "high").mapInArrow(add, "cluster int, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims)])
    return {r["cluster"]: (r["n"], [r[f"s{i}"] for i in range(dims)]) for r in total.collect()}


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, scale: int = 64, k: int = 16,
            rounds: int = 3, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """(assigned, centroids): assigned has ``id_col``, ``cluster`` and ``distance`` (squared) of every kept vector.

    Components are floor(scale * x).  Centroids start as the ``k`` kept vectors with the smallest SHA-256 of
    ``<seed>:<id>`` in that order (null ids last, equal ids by components); a round replaces each non-empty one by
    the floor of its vectors' mean.  Ties go to the smaller number.

    Odd rows: a null vector, one without exactly ``dims`` components, or one with a null, NaN or infinite component
    goes.  Fewer kept vectors than ``k`` make as many centroids; none make an empty result.  Repeated and null ids
    keep their rows.  Components are held within ``component_limit``.  Other columns of ``df`` do not matter.
    """
    key = F.col(f"`{id_col}`").cast("long")
    start = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    usable = finite(df, vector_col, dims).select(start.alias("h"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    first = usable.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    if not first:
        empty = df.where("false").select(key.alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, np.zeros((0, dims), dtype=np.int64)
    centroids = integers(np.array([r["v"] for r in first], dtype=np.float64), scale).astype(np.int64)
    scratch = Scratch(df.sparkSession, "zones")
    _, blocks = scratch.write(_ordered_blocks(df, id_col, vector_col, dims, scale, centroids))
    for _ in range(rounds):
        for j, (n, sums) in _round_sums(blocks, centroids).items():
            centroids[j] = [s // n for s in sums]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = unpacked(batch.column("x")[i], np.int32, -1, dims)
                at, square = nearest(x, *(unpacked(batch.column(c)[i], np.int32, dims) for c in ("low", "high")), centroids)
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(at.astype(np.int32)), pa.array(square)],
                                                 names=["id", "cluster", "distance"])

    assigned = blocks.mapInArrow(assign, "id long, cluster int, distance long")
    return assigned.select(F.col("id").alias(id_col), "cluster", "distance"), centroids


def cluster_digest(df: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, the inertia of the cluster and of all, and the digest of the final centroid."""
    assigned, centroids = cluster(df)
    if not len(centroids):
        return assigned.select("*", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
    _, written = Scratch(df.sparkSession, "zones-assigned").write(assigned)
    top = (1 << 63) - 1
    sums = {r["cluster"]: int(r["total"]) for r in written.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    by_cluster = F.array(*[F.lit(min(sums.get(j, 0), top)).cast("long") for j in range(len(centroids))])
    return written.select("vec_id", "cluster", "distance", F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
                          F.lit(min(sum(sums.values()), top)).cast("long").alias("inertia"),
                          F.get(F.array(*[F.lit(d) for d in digests]), F.col("cluster")).alias("centroid_sha256"))


def oracle_sql(dims: int = 64, scale: int = 64, k: int = 16, rounds: int = 3, seed: int = 1) -> str:
    """The contract in SQL: plain rounds over all distances."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {scale}) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS INTEGER) AS j, v AS c
  FROM (SELECT * FROM kept ORDER BY sha256('{seed}:' || vec_id) LIMIT {k}))"""]
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (
  SELECT vec_id, v, min({{'d': d, 'j': j}}) AS m
  FROM (SELECT vec_id, v, j, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept, c{t})
  GROUP BY vec_id, v)""")
        if t < rounds:
            steps.append(f"""
s{t} AS MATERIALIZED (
  SELECT j, list(q ORDER BY i) AS c
  FROM (SELECT m.j AS j, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS q
        FROM a{t}, range(1, {dims + 1}) AS r(i) GROUP BY m.j, i)
  GROUP BY j),
c{t + 1} AS MATERIALIZED (SELECT c{t}.j, coalesce(s{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN s{t} ON c{t}.j = s{t}.j)""")
    return f"""WITH {','.join(steps)}
SELECT vec_id, m.j AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON m.j = c{rounds}.j"""
