"""Bootstrap confidence intervals.

Rows are never exploded × replicates:

* row bootstrap of a confusion-based metric: the four confusion cells are
  computed once; each replicate draws a multinomial sample of the cells
  (exactly the distribution of resampling rows with replacement);
* other bootstraps weigh rows: rows alike are one row with its number, and a row
  (or a whole entity) gets a Poisson count for each replicate.  The counts of all
  replicates are drawn inside the Arrow batch and added to one sum per replicate,
  so a task returns B rows however many it reads;
* average precision needs the order of scores: rows are cut into ranges of the
  score, and two passes (totals of a range, then sums inside it) draw the same
  counts.

Random draws are seeded from a hash of (key, seed), so results do
not depend on partitioning, retries or the number of executors.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnscope.plans.frames import materialize, with_scalars
from txnscope.plans.prefix import prefix_sum

DRAW_ROWS = 500          # rows whose counts are drawn at once (× B numbers)
RANGE_ROWS = 50_000      # rows of one score range
MANY = 1e6               # means above it are drawn row by row
GUIDE_CELLS = 4096       # cells of the table of a distribution function
FEW_SCORES = 1000        # distinct scores whose sums a task keeps for every replicate
OPEN_GROUPS = 100        # groups a task sums before it hands on what it has


def _mix(z: np.ndarray) -> np.ndarray:
    """Bits of a 64-bit counter spread by multiplications and shifts (SplitMix64's last step; fixed values)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _poisson_steps(mean: float) -> tuple[int, np.ndarray]:
    """(least count, distribution function from there on); the counts left out have less than 1e-20 together."""
    mode, wide = int(mean), int(12 * mean ** 0.5) + 40
    low = max(0, mode - wide)
    with np.errstate(divide="ignore"):
        up = np.cumsum(np.log(mean) - np.log(np.arange(mode + 1, mode + wide + 1)))
        down = np.cumsum(np.log(np.arange(mode, low, -1)) - np.log(mean))[::-1]
    weight = np.exp(np.concatenate([down, [0.0], up]))
    return low, np.cumsum(weight / weight.sum())


def _places(steps: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """``np.searchsorted(steps, uniform, side="right")``; for many numbers by a table of cells of [0, 1), and a search where a step lies in the cell."""
    if uniform.size < 16 * GUIDE_CELLS:
        return np.searchsorted(steps, uniform, side="right")
    edges = np.arange(GUIDE_CELLS + 1) / GUIDE_CELLS
    first = np.searchsorted(steps, edges[:-1], side="right")
    split = first != np.searchsorted(steps, np.nextafter(edges[1:], 0.0), side="right")
    cell = (uniform * GUIDE_CELLS).astype(np.int64)
    out = first[cell]
    search = split[cell]
    out[search] = np.searchsorted(steps, uniform[search], side="right")
    return out


def poisson_matrix(seeds: np.ndarray, mean: np.ndarray, b: int) -> np.ndarray:
    """(rows, B) counts; count j of row i is Poisson(mean[i]) at the uniform number (53 bits) that the row's hash and j name.

    Rows of one mean share the steps of its distribution function; a mean over ``MANY`` stands for as many rows,
    so those rows are few, and each has a generator.
    """
    replicate = _mix(np.arange(1, b + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    uniform = (_mix(seeds.astype(np.uint64)[:, None] ^ replicate) >> np.uint64(11)) * 2.0 ** -53
    out = np.empty(uniform.shape, dtype=np.int64)
    for m in np.unique(mean[mean <= MANY]):
        low, steps = _poisson_steps(float(m))
        at = mean == m
        out[at] = low + np.minimum(_places(steps, uniform[at]), len(steps) - 1)
    for i in np.flatnonzero(~(mean <= MANY)):  # a mean that is no number is an error there
        out[i] = np.random.Generator(np.random.Philox(key=int(seeds[i]))).poisson(mean[i], b)
    return out


def replicates(spark, b: int) -> DataFrame:
    """Replicate ids 0..B-1 (a parameter table; size = B)."""
    return spark.range(b).select(F.col("id").cast("int").alias("rep"))


def weighted(df: DataFrame, key: list[str], seed: int, mean=None, times=None) -> DataFrame:
    """Add what a draw needs: each row counts ``times`` · Poisson(``mean``), seeded by the hash of ``key``."""
    return df.withColumn("_h", F.xxhash64(*[F.col(k) for k in key], F.lit(seed))) \
        .withColumn("_mean", (F.lit(1.0) if mean is None else F.col(mean)).cast("double")) \
        .withColumn("_times", (F.lit(1.0) if times is None else F.col(times)).cast("double"))


def _draw_chunks(pdf: pd.DataFrame, b: int):
    """(slice, counts) of the rows, ``DRAW_ROWS`` at a time."""
    seeds = pdf["_h"].to_numpy(dtype=np.int64).view(np.uint64)
    mean, times = pdf["_mean"].to_numpy(), pdf["_times"].to_numpy()
    for lo in range(0, len(pdf), DRAW_ROWS):
        part = slice(lo, lo + DRAW_ROWS)
        yield part, poisson_matrix(seeds[part], mean[part], b) * times[part, None]


def bootstrap_sums(df: DataFrame, sums: list[str], b: int, by: list[str] | None = None) -> DataFrame:
    """(by, rep, sums): weighted sums of the columns for every replicate of a ``weighted`` table.

    A task keeps B sums for each of at most ``OPEN_GROUPS`` groups; partial sums are added afterwards."""
    by = by or []
    x = df.select(*by, *[F.col(c).cast("double").alias(c) for c in sums], "_h", "_mean", "_times")
    schema = ", ".join([*[f"`{c}` {x.schema[c].dataType.simpleString()}" for c in by], "rep int", *[f"`{c}` double" for c in sums]])

    def table(open_groups):
        for head, total in open_groups.values():
            out = pd.DataFrame(total, columns=sums)
            out.insert(0, "rep", np.arange(b, dtype=np.int32))
            for c in by:
                out[c] = [head[c]] * b
            yield out[[*by, "rep", *sums]]

    def run(batches):
        open_groups: dict = {}
        for pdf in batches:
            groups = pdf.groupby(by, dropna=False, sort=False) if by else [((), pdf)]
            for key, rows in groups:
                key = tuple("null" if pd.isna(k) else (k,) for k in key)
                if key not in open_groups:
                    if len(open_groups) >= OPEN_GROUPS:
                        yield from table(open_groups)
                        open_groups = {}
                    open_groups[key] = ({c: rows[c].iloc[0] for c in by}, np.zeros((b, len(sums))))
                values = rows[sums].to_numpy(dtype=np.float64)
                for part, w in _draw_chunks(rows, b):
                    open_groups[key][1][:] += w.T @ values[part]
        yield from table(open_groups)

    return x.mapInPandas(run, schema).groupBy(*by, "rep").agg(*[F.sum(c).alias(c) for c in sums])


def ap_draws(df: DataFrame, score: str, b: int, name: str = "ap", label: str = "y") -> DataFrame:
    """(rep, ap): step average precision of every replicate of a ``weighted`` table (null scores are left out).

    Ranges are cut by (score, hash), so a score that many rows share is spread too: a range reports its first
    and last score apart, and these are joined with the neighbours' before they count."""
    from txnscope.plans.frames import materialize

    x = df.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("pos"),
                                                  F.lit(1.0).alias("n"), "_h", "_mean", "_times")
    x = materialize(x, "bootstrap-rows")
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), x.count() // RANGE_ROWS + 1)
    x = materialize(x.repartitionByRange(ranges, F.col("s").desc(), "_h").withColumn("part", F.spark_partition_id()), "bootstrap-ranges")
    before = Window.partitionBy("rep").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bootstrap_sums(x, ["n", "pos"], b, ["part"]).select(
        "part", "rep", *[F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(c) for c in ("n", "pos")])

    def inside(rows: pd.DataFrame, offset: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("s", ascending=False, kind="stable")
        offset = offset.sort_values("rep")
        n, pos = offset["n"].to_numpy(), offset["pos"].to_numpy()
        score_of, label_of = rows["s"].to_numpy(), rows["pos"].to_numpy()
        middle, ends = np.zeros((3, b)), []  # n, pos and the precision sum of the scores between the ends
        open_score, open_sums = None, None

        def close():
            nonlocal n, pos
            n, pos = n + open_sums[0], pos + open_sums[1]
            if not ends:
                ends.append((0, open_score, *open_sums))
                return
            middle[:2] += open_sums
            middle[2] += open_sums[1] * pos / np.maximum(n, 1.0)

        for part, w in _draw_chunks(rows, b):
            at = score_of[part]
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            for i, sums in zip(starts, zip(np.add.reduceat(w, starts), np.add.reduceat(w * label_of[part, None], starts))):
                if open_score is not None and open_score != at[i]:
                    close()
                    open_sums = np.zeros((2, b))
                open_sums = np.stack(sums) + (open_sums if open_score == at[i] else 0.0)
                open_score = at[i]
        ends.append((2, open_score, *open_sums))
        out = [pd.DataFrame({"seq": q, "s": s, "rep": np.arange(b), "n": e0, "pos": e1, "ap": 0.0}) for q, s, e0, e1 in ends]
        out.append(pd.DataFrame({"seq": 1, "s": np.nan, "rep": np.arange(b), "n": middle[0], "pos": middle[1], "ap": middle[2]}))
        return pd.concat(out).assign(part=rows["part"].iloc[0])[["part", "seq", "s", "rep", "n", "pos", "ap"]]

    sums = x.groupBy("part").cogroup(offsets.groupBy("part")).applyInPandas(
        inside, "part int, seq int, s double, rep int, n double, pos double, ap double")
    upto = Window.partitionBy("rep").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("n_cum", F.sum("n").over(upto)).withColumn("pos_cum", F.sum("pos").over(upto))
    steps = sums.groupBy("rep", "s").agg(F.sum("pos").alias("pos"), F.sum("ap").alias("ap"),
                                         F.max("n_cum").alias("n_cum"), F.max("pos_cum").alias("pos_cum"))
    step = F.when(F.col("s").isNull() | F.isnan("s"), F.col("ap")).when(F.col("n_cum") > 0, F.col("pos") * F.col("pos_cum") / F.col("n_cum")).otherwise(0.0)
    total = F.sum("pos")
    return steps.groupBy("rep").agg(F.when(total > 0, F.sum(step) / total).alias(name))


CELLS = ("tp", "fp", "fn", "neg")


def with_cells(df: DataFrame, pred: str | Column, label: str = "y", suffix: str = "") -> DataFrame:
    """Add 0/1 confusion columns of a prediction."""
    p = F.col(pred) if isinstance(pred, str) else pred
    y = F.col(label)
    for c, when in zip(CELLS, ((p == 1) & (y == 1), (p == 1) & (y == 0), (p == 0) & (y == 1), y == 0)):
        df = df.withColumn(c + suffix, F.when(when, 1.0).otherwise(0.0))
    return df


def cell_metrics(suffix: str = "") -> dict[str, Column]:
    """Precision (0 without alerts), recall, F1 and false-positive rate from summed cells."""
    tp, fp, fn, neg = (F.col(c + suffix) for c in CELLS)
    return {"precision": F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0), "recall": F.when(tp + fn > 0, tp / (tp + fn)),
            "f1": F.when(tp + fn > 0, 2 * tp / (2 * tp + fp + fn)), "fpr": F.when(neg > 0, fp / neg)}


# ----------------------------------------------------------------- M13
def bootstrap_f1_cells(cells: DataFrame, b: int = 2000, seed: int = 0) -> DataFrame:
    """Row bootstrap of F1 from the confusion cells (tp, fp, fn, tn).

    Each replicate is a multinomial draw of n rows over the four cells.
    Replicates without positives are skipped (effective B is reported).
    Returns per-replicate F1 values (column ``f1``) and the replicate id."""
    x = with_scalars(replicates(cells.sparkSession, b), cells.select("tp", "fp", "fn", "tn"))

    def draw(batches):
        for pdf in batches:
            out = []
            for rep, tp, fp, fn, tn in pdf[["rep", "tp", "fp", "fn", "tn"]].itertuples(index=False):
                n = tp + fp + fn + tn
                rng = np.random.default_rng([seed, int(rep)])
                c = rng.multinomial(n, np.array([tp, fp, fn, tn], dtype=float) / n)
                if c[0] + c[2] == 0:
                    continue
                den = 2 * c[0] + c[1] + c[2]
                out.append((int(rep), 2 * c[0] / den if den else 0.0))
            yield pd.DataFrame(out, columns=["rep", "f1"])
    return x.mapInPandas(draw, "rep int, f1 double")


def ci_summary(draws: DataFrame, value: str, point: DataFrame | None = None) -> DataFrame:
    """Percentile 95 % interval, population sd (numpy default), minimum distinguishable
    difference 2·sd and the effective number of replicates."""
    # one row per replicate (B is a parameter), so the in-memory percentile is bounded
    s = draws.agg(F.percentile(value, [0.025, 0.975]).alias("_q"), F.stddev_pop(value).alias("sd"),
                  F.count(F.lit(1)).alias("effective_b"))
    s = s.select(F.col("_q")[0].alias("ci_lo"), F.col("_q")[1].alias("ci_hi"), "sd",
                 (2 * F.col("sd")).alias("min_distinguishable"), "effective_b")
    return with_scalars(point, s) if point is not None else s


# ------------------------------------------------------------ M14 / M16
def paired_draws(df: DataFrame, score_a: str, score_b: str, at_a: float, at_b: float, label: str = "y",
                 b: int = 1000, seed: int = 1) -> DataFrame:
    """M14 + D10: precision, recall, F1 (scores at ``at_a`` and ``at_b``) and AP of two scores on the same Poisson
    resamples of the rows: (rep, <metric>_a, <metric>_b).  Rows are collapsed to (score_a, score_b, label) first;
    replicates without positives are left out."""
    from txnscope.plans.frames import materialize

    g = df.groupBy(F.col(score_a).cast("double").alias("sa"), F.col(score_b).cast("double").alias("sb"),
                   F.col(label).alias("y")).agg(F.count(F.lit(1)).cast("double").alias("c"))
    g = materialize(weighted(g, ["sa", "sb", "y"], seed, mean="c"), "bootstrap-groups")
    x = with_cells(with_cells(g, (F.col("sa") >= at_a).cast("int"), suffix="_a"), (F.col("sb") >= at_b).cast("int"), suffix="_b")
    cells = bootstrap_sums(x, [c + m for m in ("_a", "_b") for c in CELLS], b)
    out = cells.select("rep", *[v.alias(k + m) for m in ("_a", "_b") for k, v in cell_metrics(m).items() if k != "fpr"])
    for m, s in (("_a", "sa"), ("_b", "sb")):
        out = out.join(ap_draws(g, s, b, "ap" + m), "rep")
    return out.where(F.col("ap_a").isNotNull() & F.col("ap_b").isNotNull())


def paired_difference(draws: DataFrame, a: str, b: str, observed: DataFrame) -> DataFrame:
    """Observed difference, percentile CI of a − b over shared replicates,
    P(a > b) and whether the CI includes zero.  ``observed`` has one row with a, b."""
    d = draws.withColumn("_d", F.col(a) - F.col(b))
    s = d.agg(F.percentile("_d", [0.025, 0.975]).alias("_q"),
              F.avg((F.col("_d") > 0).cast("double")).alias("p_a_better"),
              F.count(F.lit(1)).alias("effective_b"))
    s = s.select(F.col("_q")[0].alias("ci_lo"), F.col("_q")[1].alias("ci_hi"), "p_a_better",
                 "effective_b").withColumn("includes_zero", (F.col("ci_lo") <= 0) & (F.col("ci_hi") >= 0))
    o = observed.select((F.col(a) - F.col(b)).alias("observed_diff"))
    return with_scalars(o, s)


# ------------------------------------------------------------- M15 / P3
def cluster_bootstrap(df: DataFrame, key: str, pred: str = "p", label: str = "y", b: int = 1000, seed: int = 2,
                      group: str | None = None, score: str | None = None) -> DataFrame:
    """Precision, recall, F1 and false-positive rate of replicates that resample whole entities (one
    Poisson(1) count an entity), optionally inside each group; with ``score`` also AP, without groups.
    Replicates without positives are left out."""
    gcols = [group] if group else []
    per = with_cells(df, pred, label).groupBy(*gcols, key).agg(*[F.sum(c).alias(c) for c in CELLS])
    sums = bootstrap_sums(weighted(per, [key], seed), list(CELLS), b, gcols)
    out = sums.where(F.col("tp") + F.col("fn") > 0).select(*gcols, "rep", *[v.alias(k) for k, v in cell_metrics().items()])
    if score and not group:
        rows = df.groupBy(key, F.col(score).cast("double").alias("s"), F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("c"))
        rows = materialize(rows.where(F.col("s").isNotNull()), "entity-scores")
        scores = [r["s"] for r in rows.select("s").distinct().limit(FEW_SCORES + 1).collect()]
        few = 0 < len(scores) <= FEW_SCORES and not any(np.isnan(scores))
        out = out.join(entity_ap(rows, key, sorted(scores), b, seed) if few else ap_draws(weighted(rows, [key], seed, times="c"), "s", b), "rep")
    return out


def entity_ap(rows: DataFrame, key: str, scores: list[float], b: int, seed: int) -> DataFrame:
    """(rep, ap) as ``ap_draws`` gives them for whole entities, from rows (key, s, y, c) with few distinct ``scores`` (ascending).

    An entity's counts are drawn once, not once for each of its scores; what a task keeps is a sum for every
    score and replicate."""
    cell = F.struct("s", F.col("y").cast("double").alias("pos"), F.col("c").cast("double").alias("c"))
    x = weighted(rows.groupBy(key).agg(F.collect_list(cell).alias("cells")), [key], seed).select("_h", "cells")
    of = np.array(scores)

    def run(batches):
        total = np.zeros((b, 2 * len(of)))
        for batch in batches:
            cells = batch.column("cells")
            ends = cells.offsets.to_numpy() - cells.offsets[0].as_py()
            s, pos, c = (np.asarray(cells.flatten().field(k).to_numpy(zero_copy_only=False), dtype=np.float64) for k in ("s", "pos", "c"))
            at, owner = np.searchsorted(of, s), np.repeat(np.arange(len(cells)), np.diff(ends))
            seeds = batch.column("_h").to_numpy().view(np.uint64)
            for lo in range(0, len(cells), DRAW_ROWS):
                hi = min(lo + DRAW_ROWS, len(cells))
                part = slice(ends[lo], ends[hi])
                held = np.zeros((hi - lo, 2 * len(of)))
                np.add.at(held, (owner[part] - lo, at[part]), c[part])
                np.add.at(held, (owner[part] - lo, at[part] + len(of)), c[part] * pos[part])
                total += poisson_matrix(seeds[lo:hi], np.ones(hi - lo), b).astype(np.float64).T @ held
        n, pos = total[:, :len(of)].ravel(), total[:, len(of):].ravel()
        yield pa.record_batch([pa.array(np.repeat(np.arange(b, dtype=np.int32), len(of))), pa.array(np.tile(of, b)), pa.array(n), pa.array(pos)],
                              names=["rep", "s", "n", "pos"])

    sums = x.mapInArrow(run, "rep int, s double, n double, pos double").groupBy("rep", "s").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    down = Window.partitionBy("rep").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    steps = sums.select("rep", "s", "pos", F.sum("n").over(down).alias("n_cum"), F.sum("pos").over(down).alias("pos_cum"))
    step = F.when(F.col("n_cum") > 0, F.col("pos") * F.col("pos_cum") / F.col("n_cum")).otherwise(0.0)
    total = F.sum("pos")
    return steps.groupBy("rep").agg(F.when(total > 0, F.sum(step) / total).alias("ap"))


def group_gap(draws: DataFrame, group: str, metric: str, observed: DataFrame) -> DataFrame:
    """Gap between the observed highest and lowest group of a metric; its 95 % CI
    from the per-replicate difference of those two groups (independent groups,
    paired by replicate id); distinguishable when the lower bound is above zero."""
    ext = observed.agg(F.max_by(group, metric).alias("_hi_g"), F.min_by(group, metric).alias("_lo_g"),
                       (F.max(metric) - F.min(metric)).alias("observed_gap"))
    d = with_scalars(draws, ext)
    per = d.groupBy("rep").agg(
        (F.max(F.when(F.col(group) == F.col("_hi_g"), F.col(metric))) -
         F.max(F.when(F.col(group) == F.col("_lo_g"), F.col(metric)))).alias("_gap"))
    per = per.where(F.col("_gap").isNotNull())
    s = per.agg(F.percentile("_gap", [0.025, 0.975]).alias("_q"), F.count(F.lit(1)).alias("effective_b"))
    s = s.select(F.lit(metric).alias("metric"), F.col("_q")[0].alias("ci_lo"),
                 F.col("_q")[1].alias("ci_hi"), "effective_b")
    out = with_scalars(s, ext.select(F.col("_hi_g").cast("string").alias("highest_group"),
                                     F.col("_lo_g").cast("string").alias("lowest_group"), "observed_gap"))
    return out.withColumn("distinguishable", F.col("ci_lo") > 0)


def confusion_cells(df: DataFrame, pred: str | Column, label: str = "y") -> DataFrame:
    p = F.col(pred) if isinstance(pred, str) else pred
    y = F.col(label)
    return df.agg(*[F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(n) for n, c in (
        ("tp", (p == 1) & (y == 1)), ("fp", (p == 1) & (y == 0)),
        ("fn", (p == 0) & (y == 1)), ("tn", (p == 0) & (y == 0)))])


# ------------------------------------------------------------------- O9
def _hash01(*cols) -> Column:
    """Uniform in [0, 1) from a 64-bit hash of the given columns."""
    return (F.xxhash64(*cols).bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)


def weighted_sample(df: DataFrame, weight: str, m: int, id_col: str, seed: int = 11,
                    ranges: int | None = None) -> DataFrame:
    """M draws with replacement, row i drawn with probability w_i / W (exact).

    Rows get cumulative intervals [start, start + w) from a distributed prefix sum;
    draw j falls at u_j·W.  Rows and draws are cut into the same value ranges; inside
    a range each draw takes the last row starting at or before it (as-of lookup with
    an ordered window), and every range also receives the row covering its lower
    boundary, so no draw crosses a range.  Returns the drawn rows with ``draw_id``."""
    spark = df.sparkSession
    p = ranges or max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    rows = df.where(F.col(weight) > 0).withColumn("_w", F.col(weight).cast("double"))
    # totals, cuts, keys and carry read the intervals: written once
    rows = materialize(prefix_sum(rows.select(id_col, "_w"), id_col, ["_w"])
                       .select(id_col, "_w", (F.col("_w_cum") - F.col("_w")).alias("_start")), "weighted-rows")
    total = rows.agg(F.sum("_w").alias("_W"))
    cuts = rows.agg(F.percentile_approx("_start", [i / p for i in range(1, p)], 10000).alias("_cuts"))
    rng = lambda c: F.size(F.filter("_cuts", lambda x: x <= c))
    r = with_scalars(rows, cuts).withColumn("_r", rng(F.col("_start")))
    draws = with_scalars(with_scalars(spark.range(m).withColumnRenamed("id", "draw_id"), total), cuts)
    draws = draws.withColumn("_u", _hash01(F.col("draw_id"), F.lit(seed)) * F.col("_W")) \
        .withColumn("_r", rng(F.col("_u")))
    # row covering the lower boundary of each range = last row of the earlier ranges
    last = r.groupBy("_r").agg(F.max_by(F.struct("_start", id_col), "_start").alias("_l"))
    from pyspark.sql import Window
    wl = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(F.col("_r"), F.last("_l", True).over(wl).alias("_c")).where(F.col("_c").isNotNull()) \
        .select("_r", F.col("_c._start").alias("_k"), F.col(f"_c.{id_col}").alias("_row"))
    keys = (r.select("_r", F.col("_start").alias("_k"), F.col(id_col).alias("_row"))
            .unionByName(carry).withColumn("draw_id", F.lit(None).cast("long"))
            .unionByName(draws.select("_r", F.col("_u").alias("_k"), F.lit(None).cast(dict(df.dtypes)[id_col]).alias("_row"),
                                      "draw_id")))
    w = Window.partitionBy("_r").orderBy("_k", F.col("draw_id").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    hit = keys.withColumn("_pick", F.last("_row", True).over(w)).where(F.col("draw_id").isNotNull())
    return hit.select("draw_id", F.col("_pick").alias(id_col)).join(df, id_col)


def move_share(df: DataFrame, col: str, src: str, dst: str, share: float, id_col: str,
               seed: int = 5) -> DataFrame:
    """Move round(share·n_src) rows from category ``src`` to ``dst``, chosen by hash
    rank (exact quota from a distributed prefix count)."""
    x = df.withColumn("_is", (F.col(col) == src).cast("long")) \
        .withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)).cast("double"))
    src_rows = prefix_sum(x.where(F.col("_is") == 1), "_h", ["_is"], tie=[id_col], hashed=True)
    n = x.agg(F.sum("_is").alias("_n"))
    src_rows = with_scalars(src_rows, n).withColumn(
        col, F.when(F.col("_is_cum") <= F.round(F.col("_n") * share), F.lit(dst)).otherwise(F.col(col))) \
        .drop("_is_cum", "_n")
    return x.where(F.col("_is") == 0).unionByName(src_rows).drop("_is", "_h")
