"""Findings on size: steps that read their input once, on rows built here."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F


def _orders(spark, path, n=400):
    day = F.lit(dt.datetime(1997, 1, 1)) + F.make_dt_interval(days=(F.col("id") * 7 % 900).cast("int"))
    spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 23).alias("o_custkey"), F.when(F.col("id") % 2 == 0, "F").otherwise("O").alias("o_orderstatus"),
                          (F.col("id") * 37 % 1000 + 0.5).alias("o_totalprice"), day.cast("timestamp_ntz").alias("o_orderdate"),
                          F.when(F.col("id") % 6 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority")).write.parquet(f"{path}/orders.parquet")
    spark.range(23).select(F.col("id").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"), F.lit(1).alias("c_nationkey")).write.parquet(f"{path}/customer.parquet")
    spark.range(1).select(F.lit(1).alias("n_nationkey"), F.lit(2).alias("n_regionkey")).write.parquet(f"{path}/nation.parquet")


def test_model_table_is_fitted_on_written_rows(spark, tmp_path):
    from txnscope.catalog import q_models as M

    _orders(spark, tmp_path)
    x = M._build_model_table(spark, str(tmp_path))
    # features and split are written: no step of the fit goes back to the orders
    assert x.inputFiles() and not [f for f in x.inputFiles() if str(tmp_path) in f]
    assert {r["split"]: r["count"] for r in x.groupBy("split").count().collect()} == {"fit": 256, "validation": 64, "test": 80}
    assert x.select("txn_id").distinct().count() == 400


def test_entity_ap_draws_once_per_entity(spark, monkeypatch):
    from txnscope.operators import resample as B

    def table(n):
        return spark.range(n).select((F.col("id") % 37).alias("client"), (F.col("id") * 13 % 11).cast("double").alias("score"),
                                     (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 5 == 0).cast("int").alias("p"))

    df = table(900).unionByName(table(40).withColumn("client", F.lit(None).cast("long")))
    asked = []
    whole = B.ap_draws
    monkeypatch.setattr(B, "ap_draws", lambda *a, **k: asked.append(1) or whole(*a, **k))
    few = B.cluster_bootstrap(df, "client", b=30, score="score").orderBy("rep").toPandas()
    assert not asked  # counts are drawn per client, not per client and score
    monkeypatch.setattr(B, "FEW_SCORES", 5)
    rows = B.cluster_bootstrap(df, "client", b=30, score="score").orderBy("rep").toPandas()
    assert asked and list(few.columns) == list(rows.columns) and len(few) == 30
    assert np.allclose(few.to_numpy(), rows.to_numpy(), rtol=1e-12)


def test_places_equal_a_search():
    from txnscope.operators import resample as B

    u = np.random.default_rng(5).integers(0, 1 << 53, 200_000) * 2.0 ** -53
    for mean in (0.3, 1.0, 40.0):
        steps = B._poisson_steps(mean)[1]
        at = np.concatenate([u, steps[steps < 1], np.arange(B.GUIDE_CELLS) / B.GUIDE_CELLS])
        assert (B._places(steps, at) == np.searchsorted(steps, at, side="right")).all()


def test_state_is_kept_by_bucket_of_clients(spark):
    from txnscope.operators.history import history_features
    from txnscope.streaming import source as S
    from txnscope.streaming import state as Q

    big = (1 << 53) + 1  # a null client beside it must not round it
    ev = spark.range(900).select(F.col("id").alias("txn_id"), F.when(F.col("id") % 300 == 7, F.lit(None)).otherwise(F.col("id") % 300 + big).cast("long").alias("client_id"),
                                 F.timestamp_seconds(1_700_000_000 + F.col("id") * 61).alias("ts"), (F.col("id") * 17 % 101 + 0.5).alias("amount"))
    path = S.new_run_dir(spark, "buckets")
    stream = S.read_slices(spark, f"{path}/in", ev.schema)
    S.deliver(ev, f"{path}/in", "a")
    S.end_feed(spark, f"{path}/in", ev.schema)
    with S.state_provider(spark):
        q = Q.stream_history_features(stream, buckets=4).writeStream.format("parquet").option("checkpointLocation", f"{path}/ck") \
            .option("path", f"{path}/out").trigger(availableNow=True).start()
        q.awaitTermination()
    # 300 clients: one state row a bucket is left when all have left their slots
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 12
    both = spark.read.parquet(f"{path}/out").alias("s").join(history_features(ev).alias("b"), "txn_id")
    assert both.count() == 900
    for c in ("client_id", "prior_count", "gap_hours", "prior_mean", "prior_sd"):
        same = F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) | (F.abs(F.col(f"s.{c}") - F.col(f"b.{c}")) < 1e-9)
        far = both.where(~F.coalesce(same, F.lit(False)))
        assert (far.where("s.client_id is not null") if c != "client_id" else far).count() == 0, c
    nobody = both.where("s.client_id is null").orderBy("txn_id").select("txn_id", "s.prior_count", "s.prior_mean").collect()
    assert [tuple(r) for r in nobody] == [(7, 0, 18.5), (307, 1, 18.5), (607, 2, (18.5 + 307 * 17 % 101 + 0.5) / 2)]


def test_search_fits_several_at_once_on_narrow_folds(spark, monkeypatch):
    import threading

    from txnscope.operators import models as L

    df = spark.range(240).select(F.col("id").alias("txn_id"), (F.col("id") % 4 == 0).cast("int").alias("y"), F.lit(1.0).alias("w"),
                                 (F.col("id") * 7 % 31).cast("double").alias("a"), F.lit("wide").alias("note"))
    seen, threads = [], set()
    write, make = L.materialize, L.pipeline
    monkeypatch.setattr(L, "materialize", lambda d, n: seen.append(d.columns) or write(d, n))
    monkeypatch.setattr(L, "pipeline", lambda *a, **k: threads.add(threading.get_ident()) or make(*a, **k))
    settings = [{"regParam": 0.0}, {"regParam": 0.1}]
    many = L.search(df, ["a"], "logistic", settings).orderBy("setting").collect()
    assert "note" not in seen[0] and len(threads) > 1
    one = L.search(df, ["a"], "logistic", settings, at_once=1).orderBy("setting").collect()
    assert [r["rank"] for r in many] == [r["rank"] for r in one] and len(many) == 2
    for a, b in zip(many, one):
        assert abs(a["mean_ap"] - b["mean_ap"]) < 1e-9 and abs(a["mean_train_ap"] - b["mean_train_ap"]) < 1e-9


def test_model_table_is_written_in_small_tasks(spark, tmp_path, monkeypatch):
    from txnscope.catalog import q_models as M
    from txnscope.plans import frames

    _orders(spark, tmp_path)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before, seen = [spark.conf.get(n) for n in names], []
    build = M._build_model_table
    monkeypatch.setattr(M, "_build_model_table", lambda *a: seen.append([spark.conf.get(n) for n in names]) or build(*a))
    monkeypatch.setattr(frames, "PIECE", 200)
    monkeypatch.setattr(frames, "SHUFFLED", 500)
    small, _ = M.model_data(spark, str(tmp_path))
    assert int(seen[0][0]) > 20 and seen[0][1] == "500b"  # by the size of the files
    assert [spark.conf.get(n) for n in names] == before
    monkeypatch.undo()
    whole = build(spark, str(tmp_path))
    assert small.count() == 400 and small.drop("w", "key_te").exceptAll(whole.drop("w", "key_te")).count() == 0


def test_synthetic_rows_and_folds_are_written_once(spark):
    from txnscope.catalog import q_models as M
    from txnscope.operators.encode import smote_approx

    df = spark.range(300).select(F.col("id").alias("txn_id"), (F.col("id") % 30 == 0).cast("int").alias("y"), F.lit(1.0).alias("w"),
                                 (F.col("id") * 7 % 31).cast("double").alias("a"), F.lit("wide").alias("note"))
    out = smote_approx(df, "txn_id", ["a"], ratio=0.1)
    # no rows pass through a join, so none through the driver, each time a fit reads them
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 319 and out.where("txn_id IS NULL AND y = 1 AND a BETWEEN 0 AND 30").count() == 19
    folds = M.written_folds(df, ["a"])
    assert set(folds.columns) == {"txn_id", "y", "w", "a", "fold"} and folds.inputFiles()
    assert {(r["fold"], r["y"]): r["count"] for r in folds.groupBy("fold", "y").count().collect()} == {(0, 0): 97, (1, 0): 97, (2, 0): 96, (0, 1): 4, (1, 1): 3, (2, 1): 3}
