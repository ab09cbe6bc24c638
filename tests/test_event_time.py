"""Event-time state: slots behind the watermark, in order, whatever the order of arrival."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

COLUMNS = "txn_id long, client_id long, ts timestamp, amount double"


@pytest.mark.parametrize("amounts", ["skewed", "constant", "far from zero", "with gaps"])
@pytest.mark.parametrize("before", [(0, 0.0, 0.0, None), (5, 10.0, 3.0, 0)])
def test_slot_features_equal_one_row_at_a_time(amounts, before):
    from txnscope.streaming.state import features_from_state, slot_features

    rng = np.random.default_rng(3)
    amount = {"skewed": rng.lognormal(3, 1, 120), "constant": np.full(40, 7.3), "far from zero": rng.normal(1e6, 0.1, 80),
              "with gaps": np.where(rng.random(90) < 0.3, np.nan, rng.normal(50, 9, 90))}[amounts]
    us = np.sort(rng.integers(1, 60, len(amount))) * 10 ** 9
    cut = len(us) // 3
    first, between = slot_features(before, us[:cut], amount[:cut])
    second, after = slot_features(between, us[cut:], amount[cut:])
    gap, n_prior, mean_prior, sd_prior, z_prior = (np.concatenate(p) for p in zip(first, second))
    n, mean, m2, last = before
    for i, (t, a) in enumerate(zip(us, amount)):
        g, c, m, sd, z, _ = features_from_state(n, mean, m2, last, float(a), int(t))
        assert n_prior[i] == c and sd_prior[i] == pytest.approx(sd, rel=1e-6, abs=1e-9)
        assert np.isnan(gap[i]) if g is None else gap[i] == pytest.approx(g)
        if np.isnan(a):
            assert np.isnan(z_prior[i])
        else:
            assert mean_prior[i] == pytest.approx(m, rel=1e-12) and z_prior[i] == pytest.approx(z, rel=1e-5, abs=1e-6)
            n += 1
            d = a - mean
            mean += d / n
            m2 += d * (a - mean)
        last = int(t)
    assert after[0] == n and after[3] == last and after[2] == pytest.approx(m2, rel=1e-6, abs=1e-9)


def test_shuffled_feed_equals_batch(spark):
    """Eight slices dealt by a hash of the id, not by time: all within the delay, so none is late."""
    from txnscope.operators.history import history_features
    from txnscope.sources import txn_events
    from txnscope.streaming import source as S
    from txnscope.streaming import state as Q

    ev = txn_events(spark, SF_SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    path = S.new_run_dir(spark, "shuffled")
    stream = S.read_slices(spark, f"{path}/in", ev.schema)

    def feed():
        for i in range(8):
            S.deliver(ev.where(F.pmod(F.xxhash64("txn_id"), F.lit(8)) == i), f"{path}/in", f"{i + 1:06d}")
            if i == 4:
                yield i
        S.end_feed(spark, f"{path}/in", ev.schema)
        yield 8

    out = S.run_to_table(Q.stream_history_features(stream, delay="40 days"), f"{path}/run", feed=feed())
    assert out.where("late").count() == 0
    batch = history_features(ev)
    both = out.alias("s").join(batch.alias("b"), "txn_id", "full")
    assert both.count() == ev.count()
    for c in ("gap_hours", "prior_count", "prior_mean", "prior_sd", "z_amount"):
        far = F.abs(F.col(f"s.{c}") - F.col(f"b.{c}")) > 1e-6 * (1 + F.abs(F.col(f"b.{c}")))
        assert both.where(far | (F.col(f"s.{c}").isNull() != F.col(f"b.{c}").isNull())).count() == 0, c


def test_rows_wait_for_the_watermark_and_late_rows_do_not_move_the_clock(spark):
    from txnscope.streaming import source as S
    from txnscope.streaming import state as Q

    def rows(*cells):
        return spark.createDataFrame([(i, c, t, a) for i, c, t, a in cells], "txn_id long, client_id long, ts string, amount double") \
            .withColumn("ts", F.col("ts").cast("timestamp"))

    path = S.new_run_dir(spark, "waiting")
    schema = rows((1, 1, None, 0.0)).schema
    stream = S.read_slices(spark, f"{path}/in", schema)

    def run(feed):
        out = S.run_to_table(Q.stream_history_features(stream, delay="1 day", slot="1 day"), f"{path}/run", feed=feed)
        return {r["txn_id"]: r for r in out.collect()}

    def deliver(name, *cells):
        S.deliver(rows(*cells), f"{path}/in", name)
        yield name

    # arrival order is not time order; the watermark comes to the start of the 9th
    out = run(deliver("a", (3, 1, "2024-01-05 10:00:00", 30.0), (1, 1, "2024-01-03 10:00:00", 10.0), (2, 1, "2024-01-04 10:00:00", 20.0),
                      (4, 1, "2024-01-09 10:00:00", 40.0), (5, 2, "2024-01-10 00:00:00", 5.0), (6, None, "2024-01-03 00:00:00", 1.0),
                      (7, None, "2024-01-04 00:00:00", None), (8, 1, None, 12.0)))
    # client 1's last row and client 2 wait; a null client is a client; no amount: z is null; no time: late at once
    assert set(out) == {1, 2, 3, 6, 7, 8}
    assert [out[i]["prior_count"] for i in (1, 2, 3, 6, 7)] == [0, 1, 2, 0, 1]
    assert out[3]["prior_mean"] == 15.0 and out[3]["gap_hours"] == 24.0
    assert out[7]["z_amount"] is None and out[7]["gap_hours"] == 24.0
    assert [i for i in sorted(out) if out[i]["late"]] == [8] and out[8]["ts"] is None

    # behind the watermark: 10 is behind client 1's clock, 11 is not, 12 is the first of its client
    out = run(deliver("b", (10, 1, "2024-01-04 23:00:00", 99.0), (11, 1, "2024-01-06 10:00:00", 50.0), (12, 3, "2024-01-02 00:00:00", 7.0)))
    assert [i for i in sorted(out) if out[i]["late"]] == [8, 10]
    assert out[10]["prior_count"] == 3 and out[10]["prior_mean"] == 20.0
    assert out[11]["prior_count"] == 3 and out[11]["prior_mean"] == 20.0 and out[11]["gap_hours"] == 24.0
    assert out[12]["prior_count"] == 0 and not out[12]["known"]

    def end():
        yield S.end_feed(spark, f"{path}/in", schema)

    out = run(end())
    assert len(out) == 11 and None not in out  # the mark itself is not emitted
    assert out[4]["prior_count"] == 4 and out[4]["prior_mean"] == 27.5 and out[4]["gap_hours"] == 72.0
    assert not out[5]["late"] and not out[4]["late"]
