"""Structured Streaming queries.

Each query replays ``events`` as time-sliced files, runs the stream to
completion (availableNow) and returns the sink contents.  The oracle is the
batch answer: stream results must equal the batch features.
"""

from pyspark.sql import functions as F

from txnscope.catalog.q_history import history_raw_sql, history_sql
from txnscope.catalog.registry import query
from txnscope.plans.frames import materialize
from txnscope.sources import txn_events
from txnscope.streaming import source as S
from txnscope.streaming import state as Q

MID = "2024-01-16"
# rows wait by the length of a slice of the replay
SLOT = "5 days"
FEATURES = ["txn_id", "client_id", "gap_hours", "prior_count", "prior_mean", "prior_sd",
            "z_amount", "z_amount_abs"]


def _events(spark, sf_dir):
    return txn_events(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def _replay(spark, df, name, slice_days=5, per_trigger=3, ends=False):
    path = S.new_run_dir(spark, name)
    return path, S.read_slices(spark, f"{path}/in", df.schema), S.time_slices(df, "ts", f"{path}/in", slice_days, per_trigger, ends=ends)


@query("q1_streaming_history_parity", history_sql("txn_events"))
def q1(spark, sf_dir):
    """Q1 + Q6 + A9: per-client event-time state in transformWithStateInPandas over a
    file stream: rows are released in order as the watermark passes; features equal the batch expanding windows."""
    path, s, feed = _replay(spark, _events(spark, sf_dir), "q1", ends=True)
    out = S.run_to_table(Q.stream_history_features(s, slot=SLOT), f"{path}/run", feed=feed)
    return out.select(*FEATURES)


BOOT_SQL = f"""
SELECT txn_id, client_id, r6(gap_hours) AS gap_hours, prior_count, r6(prior_mean) AS prior_mean,
       r6(prior_sd) AS prior_sd, r6(z_amount) AS z_amount, r6(z_amount_abs) AS z_amount_abs,
       prior_count > 0 AS known
FROM ({history_raw_sql('txn_events')}) WHERE ts >= TIMESTAMP '{MID}'
"""


@query("q2_q3_stream_from_bootstrapped_state", BOOT_SQL)
def q2(spark, sf_dir):
    """Q2 + Q3: state bootstrapped from history before the cut (initialState), stream of
    the rest; equals the batch windows; clients without history are 'unknown'."""
    ev = _events(spark, sf_dir)
    cut = F.lit(MID).cast("timestamp")
    init = Q.initial_state(ev.where(F.col("ts") < cut))
    path, s, feed = _replay(spark, ev.where(F.col("ts") >= cut), "q2", ends=True)
    out = S.run_to_table(Q.stream_history_features(s, init, slot=SLOT), f"{path}/run", feed=feed)
    return out.select(*FEATURES, "known")


SNAP_SQL = f"""
WITH h AS (SELECT client_id, count(*) AS n, avg(amount) AS mu, stddev_samp(amount) AS sd, max(ts) AS last_ts
           FROM txn_events WHERE ts < TIMESTAMP '{MID}' GROUP BY client_id),
r AS (SELECT e.txn_id, e.client_id, e.amount, e.ts, coalesce(h.n, 0) AS n, h.mu, h.sd, h.last_ts
      FROM txn_events e LEFT JOIN h ON e.client_id = h.client_id WHERE e.ts >= TIMESTAMP '{MID}'),
f AS (SELECT *, CASE WHEN n > 0 THEN mu ELSE amount END AS pm, CASE WHEN n > 1 THEN sd ELSE 0.0 END AS psd FROM r)
SELECT txn_id, client_id, r6((epoch_us(ts) - epoch_us(last_ts)) / 3600000000.0) AS gap_hours, n AS prior_count,
       r6(pm) AS prior_mean, r6(psd) AS prior_sd,
       r6(CASE WHEN psd > 0 THEN greatest(-10.0, least(10.0, (amount - pm) / psd)) ELSE 0.0 END) AS z_amount,
       r6(abs(CASE WHEN psd > 0 THEN greatest(-10.0, least(10.0, (amount - pm) / psd)) ELSE 0.0 END)) AS z_amount_abs,
       n > 0 AS known
FROM f
"""


@query("q4_read_only_snapshot_scoring", SNAP_SQL)
def q4(spark, sf_dir):
    """Q4: read-only scoring: stream–static join to a state snapshot; the state is not
    advanced, so every request of a client sees the same history."""
    ev = _events(spark, sf_dir)
    cut = F.lit(MID).cast("timestamp")
    snap = Q.initial_state(ev.where(F.col("ts") < cut))
    path, s, feed = _replay(spark, ev.where(F.col("ts") >= cut), "q4")
    out = S.run_to_table(Q.snapshot_features(s, snap), f"{path}/run", feed=feed)
    return out.select(*FEATURES, "known")


OPS_SQL = """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n,
       r6(avg(CASE WHEN code >= 90 THEN 1.0 ELSE 0.0 END)) AS alert_rate, r6(avg(code / 100.0)) AS mean_score
FROM txn_events GROUP BY 1
"""


@query("q7_streaming_daily_operations", OPS_SQL)
def q7(spark, sf_dir):
    """Q7 + N7: tumbling one-day windows with a watermark: rows, alert rate, mean score
    (update mode, upserted per window)."""
    ev = _events(spark, sf_dir).withColumn("score", F.col("code") / 100.0) \
        .withColumn("alert", (F.col("code") >= 90).cast("double"))
    path, s, feed = _replay(spark, ev, "q7")
    agg = (s.withWatermark("ts", "2 days").groupBy(F.window("ts", "1 day"))
           .agg(F.count(F.lit(1)).alias("n"), F.avg("alert").alias("alert_rate"),
                F.avg("score").alias("mean_score"))
           .select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n", "alert_rate",
                   "mean_score"))
    return S.run_upserts(agg, f"{path}/run", ["day"], feed)


@query("q8_retry_safe_dedup", history_sql("txn_events"))
def q8(spark, sf_dir):
    """Q8: resent transactions (a data-defined subset sent twice, the copies in a later
    slice) are dropped with dropDuplicatesWithinWatermark before the state, so history
    does not advance twice; features equal the batch ones."""
    ev = _events(spark, sf_dir)
    path = S.new_run_dir(spark, "q8")
    s = S.read_slices(spark, f"{path}/in", ev.schema)
    s = s.withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["txn_id"])
    resent = ev.where((F.col("category") == "view") & (F.col("code") < 10))

    def feed():
        yield from S.time_slices(ev, "ts", f"{path}/in", 5, 3)
        yield S.deliver(resent, f"{path}/in", "resent")
        yield S.end_feed(spark, f"{path}/in", ev.schema)

    out = S.run_to_table(Q.stream_history_features(s, delay=None, slot=SLOT), f"{path}/run", feed=feed())
    return out.select(*FEATURES)


LATE_SQL = """
WITH held AS (SELECT * FROM txn_events WHERE code = 7),
kept AS (SELECT client_id, max(ts) AS mx FROM txn_events WHERE code <> 7 GROUP BY client_id)
SELECT h.txn_id, h.client_id FROM held h JOIN kept k ON h.client_id = k.client_id WHERE h.ts < k.mx
"""


@query("q9_late_rows_side_output", LATE_SQL)
def q9(spark, sf_dir):
    """Q9: rows held back and delivered after newer rows of the same client are flagged
    late, emitted to the side output and do not move the client clock back."""
    ev = _events(spark, sf_dir)
    path = S.new_run_dir(spark, "q9")
    s = S.read_slices(spark, f"{path}/in", ev.schema)

    def feed():
        yield from S.time_slices(ev.where(F.col("code") != 7), "ts", f"{path}/in", 5, 3, ends=True)
        yield S.deliver(ev.where(F.col("code") == 7), f"{path}/in", "held")  # strictly after all others

    out = S.run_to_table(Q.stream_history_features(s, slot=SLOT), f"{path}/run", feed=feed())
    return out.where("late").select("txn_id", "client_id")


SLIDE_SQL = """
WITH b AS (SELECT client_id, time_bucket(INTERVAL 12 HOUR, ts) AS b0 FROM txn_events),
w AS (SELECT client_id, b0 AS ws FROM b UNION ALL SELECT client_id, b0 - INTERVAL 12 HOUR FROM b)
SELECT client_id, strftime(ws, '%Y-%m-%d %H:%M') AS window_start, count(*) AS n FROM w GROUP BY ALL
"""


@query("q10_sliding_activity_per_client", SLIDE_SQL)
def q10_slide(spark, sf_dir):
    """Q10: one-day windows sliding every 12 hours: rows per client (streaming, upserts)."""
    path, s, feed = _replay(spark, _events(spark, sf_dir), "q10s")
    agg = (s.withWatermark("ts", "2 days").groupBy("client_id", F.window("ts", "1 day", "12 hours"))
           .agg(F.count(F.lit(1)).alias("n"))
           .select("client_id", F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("window_start"), "n"))
    return S.run_upserts(agg, f"{path}/run", ["client_id", "window_start"], feed)


SESSION_SQL = """
WITH o AS (SELECT client_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE
                                      THEN 1 ELSE 0 END AS brk FROM txn_events WINDOW w AS (PARTITION BY client_id ORDER BY ts)),
s AS (SELECT client_id, ts, sum(brk) OVER (PARTITION BY client_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT client_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end, count(*) AS n
FROM s GROUP BY client_id, sid
"""


def session_activity(df, gap: str = "30 minutes"):
    """Sessions per client: events closer than ``gap`` belong to one session (end =
    last event + gap).  Works on batch and on watermarked streams."""
    return (df.groupBy("client_id", F.session_window("ts", gap))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("client_id",
                    F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"),
                    F.date_format("session_window.end", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_end"), "n"))


@query("q10_session_windows", SESSION_SQL)
def q10_session(spark, sf_dir):
    """Q10: session windows (30-minute gap) per client, the streaming form of client
    episodes (append mode): a session is emitted once the watermark has passed its end, the
    last open ones when the end of the feed pushes the watermark past all rows."""
    path, s, feed = _replay(spark, _events(spark, sf_dir), "q10w", ends=True)
    return S.run_to_table(session_activity(S.without_marks(s.withWatermark("ts", "2 days"), "txn_id")), f"{path}/run", feed=feed)


# ------------------------------------------------------------------ Q5 / N9
MODEL_COLS = ["amount", "prior_count", "gap_hours", "z_amount_abs", "is_outlier", "key_te"]


def _fit_scoring(spark, sf_dir):
    """Preprocessor + logistic model fitted on the history before the cut (batch)."""
    from txnscope.operators import encode as J
    from txnscope.operators import models as L
    from txnscope.operators.history import history_features
    from txnscope.sources.raw import raw_transactions

    raw = raw_transactions(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    hist = raw.where(F.col("ts") < F.lit(MID).cast("timestamp"))
    # every fitted parameter reads the features, the fit and its threshold the model columns: each is written once
    h = materialize(history_features(hist).withColumn("prior_count", F.col("prior_count").cast("double")), "scoring-history")
    pp = J.fit_preprocessor(h, "client_id", "category", ["amount", "prior_count", "gap_hours", "z_amount_abs"])
    pp.columns = MODEL_COLS
    x = materialize(pp.transform(h).select("y", *MODEL_COLS), "scoring-table")
    model = L.pipeline("logistic", MODEL_COLS).fit(x)
    thr = L.chosen_threshold(L.score(model, x)).collect()[0][0]
    return raw, hist, pp, model, thr


def _contract(df):
    from txnscope.functions import rules as R
    return R.split_valid(df, {
        "amount_negative": F.col("amount") < 0,
        "terminal_out_of_range": ~F.col("terminal").between(0, 12),
        "sex_unknown": ~F.col("sex").isin("F", "M")})


def _score(features_df, pp, model, thr, also=()):
    from txnscope.functions import rules as R
    from txnscope.operators import models as L
    x = pp.transform(features_df.withColumn("prior_count", F.col("prior_count").cast("double")))
    s = L.score(model, x)
    return s.select("txn_id", "client_id", "score", (F.col("score") >= thr).alias("alert"),
                    R.alert_action(F.col("score"), thr).alias("action"), *also)


def scoring_stream(spark, sf_dir):
    """Q5: raw requests → contract → streaming history state (bootstrapped) →
    preprocessor → model → policy → JSON-lines log.  Returns (log, batch twin, rejected)."""
    raw, hist, pp, model, thr = _fit_scoring(spark, sf_dir)
    new = raw.where(F.col("ts") >= F.lit(MID).cast("timestamp"))
    path = S.new_run_dir(spark, "q5")
    stream = S.read_slices(spark, f"{path}/in", new.schema)
    valid, rejected = _contract(stream)
    feats = Q.stream_history_features(valid, Q.initial_state(hist), slot=SLOT)
    # late rows are scored too, read-only from the client's current state, and marked
    scored = _score(feats, pp, model, thr, ["late"])
    log = S.run_to_table(scored, f"{path}/run", feed=S.time_slices(new, "ts", f"{path}/in", 5, 3, ends=True), fmt="json",
                         schema="txn_id long, client_id long, score double, alert boolean, action string, late boolean")
    # batch twin: same contract, batch history windows over history ∪ new, same model
    from txnscope.operators.history import history_features
    bvalid, _ = _contract(raw)
    bfeat = history_features(hist.unionByName(bvalid.where(F.col("ts") >= F.lit(MID).cast("timestamp"))))
    batch = _score(bfeat.where(F.col("ts") >= F.lit(MID).cast("timestamp")), pp, model, thr)
    _, brej = _contract(new)
    return log, batch, brej


@query("q5_end_to_end_scoring_stream")
def q5(spark, sf_dir):
    """Q5 + B21 + B24 + A6: end-to-end scoring stream; actions per day-part of the log."""
    log, _, rej = scoring_stream(spark, sf_dir)
    g = log.groupBy("action").agg(F.count(F.lit(1)).alias("rows"), F.avg("score").alias("mean_score"))
    r = rej.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("rejected").alias("action"), "rows",
                                                         F.lit(None).cast("double").alias("mean_score"))
    return g.unionByName(r)


PARITY_SQL = f"""
WITH raw AS ({{raw}}),
v AS (SELECT * FROM raw WHERE ts >= TIMESTAMP '{MID}' AND amount >= 0 AND terminal BETWEEN 0 AND 12 AND sex IN ('F', 'M'))
SELECT CAST(count(*) AS BIGINT) AS rows_a, CAST(count(*) AS BIGINT) AS rows_b, CAST(0 AS BIGINT) AS only_in_a,
       CAST(0 AS BIGINT) AS only_in_b, CAST(0 AS BIGINT) AS mismatch_score, CAST(0 AS BIGINT) AS mismatch_action
FROM v
"""


def _parity_sql():
    from txnscope.sources.raw import RAW_TRANSACTIONS_SQL
    return PARITY_SQL.replace("{raw}", RAW_TRANSACTIONS_SQL)


@query("n9_online_offline_parity", _parity_sql())
def n9(spark, sf_dir):
    """N9 + C10: the streaming scoring log reconciled row by row with the batch twin
    (same contract, batch windows, same model): no missing rows, no differing scores
    (tolerance 1e-9) or actions."""
    from txnscope.operators.quality import reconcile
    log, batch, _ = scoring_stream(spark, sf_dir)
    return reconcile(log, batch, ["txn_id"], ["score", "action"], tol=1e-9)
