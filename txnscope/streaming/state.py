"""Per-client running history as event-time state (Q1–Q3, Q6, Q8, Q9).

Rows wait in time slots of their client until the watermark has passed the end of
the slot; then a slot's rows are emitted in (ts, txn_id) order of their client.  So rows that
arrive in any order within the watermark's delay give the batch features (F1–F5),
whatever the files or micro-batches.  Clients are dealt to buckets by hash, and a bucket is
a state key: (n, mean, m2, last time) of its clients, advanced by a slot at a time, and one
packed entry for each waiting (slot, arrival).  At most the clients and one slot of one bucket
(or small slots up to 100,000 rows) are in memory.

A row that comes behind the watermark is released at once.  It is late only if its
client's clock is past it already: then it is emitted with ``late = true`` from the
current state and does not advance it (the clock never moves back).

Odd rows: a row without a time never waits and is late; a row without an amount moves
the clock only, its z is null; a row without an id is a mark that moves the watermark
(``source.end_feed``) and is not emitted; a null client is a client.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txnscope.operators.history import Z_LIMIT
from txnscope.streaming.source import without_marks

# the processor travels by value: workers that start a state runner need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: slots of a bucket with fewer rows than this are released together
SMALL_SLOTS = 100_000
#: buckets that clients are dealt to by hash; fixed value: a running stream keeps its checkpoint's buckets
BUCKETS = 512

OUTPUT_SCHEMA = T.StructType([
    T.StructField("txn_id", T.LongType()), T.StructField("client_id", T.LongType()),
    T.StructField("ts", T.TimestampType()), T.StructField("amount", T.DoubleType()),
    T.StructField("gap_hours", T.DoubleType()), T.StructField("prior_count", T.LongType()),
    T.StructField("prior_mean", T.DoubleType()), T.StructField("prior_sd", T.DoubleType()),
    T.StructField("z_amount", T.DoubleType()), T.StructField("z_amount_abs", T.DoubleType()),
    T.StructField("known", T.BooleanType()), T.StructField("late", T.BooleanType()),
])


def features_from_state(n: int, mean: float, m2: float, last_us, amount: float, ts_us: int,
                        z_limit: float = Z_LIMIT):
    """Features of one transaction from the state *before* it (shared helper)."""
    prior_mean = mean if n > 0 else amount
    sd = math.sqrt(max(m2, 0.0) / (n - 1)) if n > 1 else 0.0
    z = max(-z_limit, min(z_limit, (amount - prior_mean) / sd)) if sd > 0 else 0.0
    gap = (ts_us - last_us) / 3_600_000_000.0 if last_us is not None else None
    return gap, n, prior_mean, sd, z, abs(z)


def slot_features(state: tuple, ts_us: np.ndarray, amount: np.ndarray, z_limit: float = Z_LIMIT) -> tuple:
    """Features of a slot's rows (sorted by time, none before the state's last time) and the state after them.

    The running moments of the slot come from cumulative sums about a pivot (the client's mean, or the
    first amount) and are merged with the state's by the pairwise formula for count, mean and squared deviations.
    """
    n0, mean0, m20, last = state
    has = ~np.isnan(amount)
    pivot = mean0 if n0 else (amount[has][0] if has.any() else 0.0)
    d = np.where(has, amount - pivot, 0.0)
    # entry i: sums over the rows before row i; the last entry: over all rows
    k = np.concatenate([[0], np.cumsum(has)])
    s1 = np.concatenate([[0.0], np.cumsum(d)])
    s2 = np.concatenate([[0.0], np.cumsum(d * d)])
    mean_k = s1 / np.maximum(k, 1)
    m2_k = np.maximum(s2 - s1 * mean_k, 0.0)
    n = n0 + k
    mean = np.where(n > 0, pivot + s1 / np.maximum(n, 1), 0.0)
    m2 = m20 + m2_k + mean_k * mean_k * n0 * k / np.maximum(n, 1)  # mean_k is the distance to the state's mean
    prior_n, prior_mean = n[:-1], np.where(n[:-1] > 0, mean[:-1], amount)
    sd = np.where(prior_n > 1, np.sqrt(m2[:-1] / np.maximum(prior_n - 1, 1)), 0.0)
    z = np.where(sd > 0, np.clip((amount - prior_mean) / np.where(sd > 0, sd, 1.0), -z_limit, z_limit), np.where(has, 0.0, np.nan))
    gap_us = np.diff(ts_us, prepend=ts_us[0] if last is None else last).astype(float)
    if last is None:
        gap_us[0] = np.nan
    after = (int(n[-1]), float(mean[-1]), float(m2[-1]), int(ts_us[-1]))
    return (gap_us / 3_600_000_000.0, prior_n, prior_mean, sd, z), after


#: state of a bucket: its clients side by side, a packed array a column; ``nobody`` marks the null client
HELD = {"client": np.int64, "nobody": np.bool_, "n": np.int64, "mean": np.float64, "m2": np.float64, "last": np.int64}
#: a waiting entry: the rows of one slot that came together
WAITING = {"us": np.int64, "id": np.int64, "amount": np.float64, "client": np.int64, "nobody": np.bool_}
NEW_CLIENT = (0, 0.0, 0.0, None)


class ClientHistoryProcessor(StatefulProcessor):
    """Rows wait by slot; a slot behind the watermark is emitted in order and advances the state of its clients.

    The state key is a bucket of clients: calls, state reads and Arrow batches are paid for a bucket, not for a client."""

    def __init__(self, slot_ms: int):
        self.slot_ms = slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("history", ", ".join(f"{c} binary" for c in HELD))
        self.waiting = handle.getMapState("waiting", "slot bigint, arrival bigint", ", ".join(f"{c} binary" for c in WAITING))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = self._held()
        for r in initialState.itertuples(index=False):
            if pd.notna(r.last_us):
                held[None if r.nobody else int(r.client)] = (int(r.n), float(r.mean), float(r.m2), int(r.last_us))
        self._hold(held)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            timeless = pdf["us"].isna().to_numpy()
            if timeless.any():
                yield self._read_only(pdf[timeless])
                pdf = pdf[~timeless]
            if pdf.empty:
                continue
            columns = {c: pdf[c].to_numpy(dtype=t) for c, t in WAITING.items()}
            slot = columns["us"] // (self.slot_ms * 1000)
            arrival = uuid.uuid4().int >> 65  # a name of its own: no entry is read to add to it
            for s in np.unique(slot):
                at = slot == s
                self.waiting.updateValue((int(s), arrival), tuple(c[at].tobytes() for c in columns.values()))
            self._wake_after(int(slot.min()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # all slots that are due go with the first timer, oldest first, whatever the order of the timers
        end = timerValues.getCurrentWatermarkInMs() // self.slot_ms
        waiting = [(int(s), int(a)) for s, a in self.waiting.keys()]
        due = [p for p in waiting if p[0] < end]
        if len(due) < len(waiting):
            self._wake_after(min(s for s, _ in waiting if s >= end))
        if not due:
            return
        held = self._held()
        for us, ids, amount, client, nobody in self._take(due):
            parts = []
            for part in self._runs(client, nobody):
                who = None if nobody[part.start] else int(client[part.start])
                state = held.get(who, NEW_CLIENT)
                # the rows are in time order: those behind the client's clock come first
                on = part.start if state[3] is None else part.start + int(np.searchsorted(us[part], state[3]))
                if on > part.start:
                    behind = slice(part.start, on)
                    parts.append((behind, self._late(state, us[behind], amount[behind]), True))
                if on < part.stop:
                    ahead = slice(on, part.stop)
                    features, held[who] = slot_features(state, us[ahead], amount[ahead])
                    parts.append((ahead, features, False))
            yield self._rows(us, ids, amount, client, nobody, parts)
        self._hold(held)

    def _wake_after(self, slot: int) -> None:
        """A timer for the oldest waiting slot is enough; it fires once the watermark is past its time."""
        self.handle.registerTimer((slot + 1) * self.slot_ms - 1)

    def _held(self) -> dict:
        """(n, mean, m2, last time) of the bucket's clients; the null client is None."""
        packed = self.state.get()
        if packed is None:
            return {}
        client, nobody, *moments = (np.frombuffer(v, t).tolist() for v, t in zip(packed, HELD.values()))
        return {None if no else c: m for c, no, m in zip(client, nobody, zip(*moments))}

    def _hold(self, held: dict) -> None:
        if held:
            columns = [[0 if c is None else c for c in held], [c is None for c in held], *zip(*held.values())]
            self.state.update(tuple(np.array(c, dtype=t).tobytes() for c, t in zip(columns, HELD.values())))

    def _take(self, due: list[tuple]) -> Iterator[tuple]:
        """Rows of the due slots by client and (time, id), one slot or several small ones at a time; they wait no longer."""
        held, n = [], 0
        due = sorted(due)
        for i, entry in enumerate(due):
            held.append(self.waiting.getValue(entry))
            self.waiting.removeKey(entry)
            n += len(held[-1][0]) // 8
            last_of_slot = i + 1 == len(due) or due[i + 1][0] != entry[0]
            if i + 1 == len(due) or (last_of_slot and n >= SMALL_SLOTS):
                us, ids, amount, client, nobody = (np.frombuffer(b"".join(c[j] for c in held), t) for j, t in enumerate(WAITING.values()))
                held, n = [], 0
                order = np.lexsort((amount, ids, us, client, nobody))
                yield us[order], ids[order], amount[order], client[order], nobody[order]

    @staticmethod
    def _runs(client: np.ndarray, nobody: np.ndarray) -> list[slice]:
        """The rows of each client, side by side."""
        starts = np.flatnonzero(np.r_[True, (client[1:] != client[:-1]) | (nobody[1:] != nobody[:-1])]).tolist()
        return [slice(a, b) for a, b in zip(starts, [*starts[1:], len(client)])]

    @staticmethod
    def _late(state, us, amount) -> tuple:
        """Each row by itself against the state as it is."""
        n, mean, m2, last = state
        k = len(us)
        prior = np.full(k, mean) if n else amount
        sd = math.sqrt(max(m2, 0.0) / (n - 1)) if n > 1 else 0.0
        z = np.clip((amount - prior) / sd, -Z_LIMIT, Z_LIMIT) if sd > 0 else np.where(np.isnan(amount), np.nan, 0.0)
        gap = np.full(k, np.nan) if last is None else (us - last) / 3_600_000_000.0
        return gap, np.full(k, n), prior, np.full(k, sd), z

    def _read_only(self, pdf: pd.DataFrame) -> pd.DataFrame:
        held = self._held()
        pdf = pdf.sort_values(["nobody", "client"])
        ids, amount, client, nobody = (pdf[c].to_numpy(dtype=WAITING[c]) for c in ("id", "amount", "client", "nobody"))
        us, parts = np.zeros(len(pdf), np.int64), []
        for part in self._runs(client, nobody):
            n, mean, m2, _ = held.get(None if nobody[part.start] else int(client[part.start]), NEW_CLIENT)
            parts.append((part, self._late((n, mean, m2, None), us[part], amount[part]), True))
        out = self._rows(us, ids, amount, client, nobody, parts)
        out["ts"] = pd.NaT
        return out

    @staticmethod
    def _rows(us, ids, amount, client, nobody, parts) -> pd.DataFrame:
        """Output of (rows, features, late) parts that follow one another."""
        gap, n, mean, sd, z = (np.concatenate(c) for c in zip(*(features for _, features, _ in parts)))
        late = np.repeat([is_late for _, _, is_late in parts], [p.stop - p.start for p, _, _ in parts])

        def nullable(x):
            return pd.arrays.FloatingArray(np.nan_to_num(x), np.isnan(x))

        return pd.DataFrame({
            "txn_id": ids, "client_id": pd.arrays.IntegerArray(client.copy(), nobody.copy()), "ts": us.astype("datetime64[us]"),
            "amount": nullable(amount), "gap_hours": nullable(gap), "prior_count": n.astype(np.int64), "prior_mean": nullable(mean),
            "prior_sd": sd, "z_amount": nullable(z), "z_amount_abs": nullable(np.abs(z)), "known": n > 0, "late": late})

    def close(self) -> None:
        pass


def initial_state(history: DataFrame, key: str = "client_id", ts: str = "ts",
                  amount: str = "amount") -> DataFrame:
    """Q2: per-client (n, mean, m2, last time) from a history table (one aggregate)."""
    return history.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.avg(amount).alias("mean"),
        (F.var_pop(amount) * F.count(F.lit(1))).alias("m2"),
        F.unix_micros(F.max(F.col(ts).cast("timestamp"))).alias("last_us"))


def stream_history_features(stream: DataFrame, init: DataFrame | None = None, key: str = "client_id",
                            delay: str | None = "2 days", slot: str = "2 days", buckets: int = BUCKETS) -> DataFrame:
    """Q1 (+ Q2 bootstrap, Q3 unknown clients, Q6 event-time order, Q9 late flag).

    ``delay``: how far behind the newest row a row may arrive and still be in order (None: the stream has
    its watermark on ``ts`` already).  ``slot``: rows are released by the slot, so it adds at most its length to
    the wait and bounds what is in memory.  ``buckets``: state keys that the clients are dealt to; it must stay as it
    is for the life of a checkpoint.
    """
    slot_ms = int(pd.Timedelta(slot) / pd.Timedelta("1ms"))
    marked = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay) if delay else stream
    rows = without_marks(marked, "txn_id")
    # a plain number for the time: rows behind the watermark reach the processor, which alone judges what is late
    g = rows.select(F.col("txn_id").alias("id"), *_client(key, buckets), F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
                    F.col("amount").cast("double").alias("amount")).groupBy("bucket")
    if init is not None:
        init = init.select(*_client(key, buckets), "n", "mean", "m2", "last_us").groupBy("bucket")
    return g.transformWithStateInPandas(
        statefulProcessor=ClientHistoryProcessor(slot_ms), outputStructType=OUTPUT_SCHEMA,
        outputMode="Append", timeMode="EventTime", initialState=init)


def _client(key: str, buckets: int) -> list[Column]:
    """Bucket, id and null flag of a row's client; none is null, so ids stay whole numbers on their way through pandas."""
    client = F.col(key).cast("long")
    return [F.pmod(F.xxhash64(client), F.lit(buckets)).cast("int").alias("bucket"), F.coalesce(client, F.lit(0).cast("long")).alias("client"),
            client.isNull().alias("nobody")]


def snapshot_features(requests: DataFrame, snapshot: DataFrame, key: str = "client_id") -> DataFrame:
    """Q4: read-only scoring: features from a fixed state snapshot (stream–static left
    join); the state is not advanced, so repeated requests get equal features."""
    j = requests.join(snapshot, key, "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    sd = F.when(n > 1, F.sqrt(F.greatest(F.col("m2"), F.lit(0.0)) / (n - 1))).otherwise(F.lit(0.0))
    pm = F.when(n > 0, F.col("mean")).otherwise(F.col("amount"))
    z = F.when(sd > 0, F.greatest(F.lit(-Z_LIMIT), F.least(F.lit(Z_LIMIT), (F.col("amount") - pm) / sd))) \
        .otherwise(F.lit(0.0))
    gap = (F.unix_micros(F.col("ts").cast("timestamp")) - F.col("last_us")) / 3_600_000_000.0
    return j.select("txn_id", key, "ts", "amount", gap.alias("gap_hours"), n.alias("prior_count"),
                    pm.alias("prior_mean"), sd.alias("prior_sd"), z.alias("z_amount"),
                    F.abs(z).alias("z_amount_abs"), F.col("n").isNotNull().alias("known"))
