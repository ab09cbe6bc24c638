"""Closed-form, property and invariance tests (no SQL oracle needed)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_psi_closed_form(spark):
    from txnscope.operators.drift import psi_state
    from txnscope.operators.stats import psi_terms

    def psi(ref, new):
        df = spark.createDataFrame(list(zip(ref, new)), "r double, n double")
        return df.agg(F.sum(psi_terms(F.col("r"), F.col("n")))).collect()[0][0]

    assert psi([0.2, 0.3, 0.5], [0.2, 0.3, 0.5]) == pytest.approx(0.0, abs=1e-12)
    small = psi([.33, .34, .33], [.30, .34, .36])
    large = psi([.33, .34, .33], [.05, .15, .80])
    assert 0 < small < large
    states = spark.createDataFrame([(0.05,), (0.15,), (0.40,)], "p double") \
        .select(psi_state(F.col("p"), F.lit(False)).alias("s")).collect()
    assert [r.s for r in states] == ["stable", "moderate", "severe"]


def test_monotone_counter_is_structural(spark):
    from txnscope.operators.drift import drift_table, freeze_reference

    ref = spark.range(2000).select((F.col("id") % 400).cast("double").alias("a"),
                                   (F.col("id") % 400).cast("double").alias("b"))
    new = ref.select((F.col("a") + 200).alias("a"), (F.col("b") + 200).alias("b"))
    t = drift_table(freeze_reference(ref, ["a", "b"]), new, ["a", "b"], monotone=["b"]) \
        .orderBy("variable").collect()
    assert t[0].psi == pytest.approx(t[1].psi, rel=1e-12)
    assert t[0].state == "severe" and t[1].state == "structural"


def test_welford_online_equals_offline(spark):
    from txnscope.operators.history import history_features
    from txnscope.streaming.state import features_from_state

    amounts = [100, 250, 90, 400, 120, 310]
    rows = [(i, 1, f"2025-01-0{i + 1} 10:00:00", float(a)) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "txn_id long, client_id long, ts string, amount double") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    batch = history_features(df).orderBy("txn_id").collect()
    n, mean, m2, last = 0, 0.0, 0.0, None
    for i, a in enumerate(amounts):
        t = (i + 1) * 86_400_000_000
        gap, pc, pm, sd, z, za = features_from_state(n, mean, m2, last, float(a), t)
        b = batch[i]
        assert pc == b.prior_count == i
        assert pm == pytest.approx(b.prior_mean, rel=1e-9)
        assert sd == pytest.approx(b.prior_sd, rel=1e-9)
        assert za == pytest.approx(b.z_amount_abs, rel=1e-9, abs=1e-12)
        n += 1
        d = a - mean
        mean += d / n
        m2 += d * (a - mean)
        last = t


def test_contract_rejects_and_accepts(spark):
    from txnscope.functions import rules as R

    df = spark.createDataFrame([(1, -5.0, 3, "F"), (2, 10.0, 99, "M"), (3, 10.0, 3, "Q"), (4, 0.0, 3, "F")],
                               "id long, amount double, terminal int, sex string")
    valid, rejected = R.split_valid(df, {"amount_negative": F.col("amount") < 0,
                                         "terminal_out_of_range": ~F.col("terminal").between(0, 12),
                                         "sex_unknown": ~F.col("sex").isin("F", "M")})
    assert [r.id for r in valid.collect()] == [4]
    rej = {r.id: r.reasons for r in rejected.collect()}
    assert rej == {1: ["amount_negative"], 2: ["terminal_out_of_range"], 3: ["sex_unknown"]}


@pytest.mark.parametrize("chunk_hours", [1.0, 24.0, 24.0 * 365])
def test_chunked_history_equals_single_window(spark, chunk_hours):
    from txnscope.operators.history import history_features, history_features_single_window
    from txnscope.sources import txn_orders

    t = txn_orders(spark, SF_SMALL)
    a = {r.txn_id: r for r in history_features(t, chunk_hours=chunk_hours).collect()}
    b = {r.txn_id: r for r in history_features_single_window(t).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k].prior_count == b[k].prior_count
        assert a[k].prior_mean == pytest.approx(b[k].prior_mean, rel=1e-9)
        assert a[k].prior_sd == pytest.approx(b[k].prior_sd, rel=1e-7, abs=1e-7)
        assert (a[k].gap_hours is None) == (b[k].gap_hours is None)


def _brute_ap(scores, labels):
    order = sorted(set(scores), reverse=True)
    P = sum(labels)
    ap, tp, n = 0.0, 0, 0
    for s in order:
        pos = sum(1 for x, y in zip(scores, labels) if x == s and y == 1)
        cnt = sum(1 for x in scores if x == s)
        tp += pos
        n += cnt
        ap += pos / P * tp / n
    return ap


@pytest.mark.parametrize("ranges", [1, 3, 7])
def test_average_precision_partition_invariant(spark, ranges):
    from txnscope.operators.metrics import curve
    from txnscope.sources import scored_lines

    s = scored_lines(spark, SF_SMALL).select("score_i", "y")
    pdf = s.toPandas()
    expected = _brute_ap(pdf.score_i.tolist(), pdf.y.tolist())
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        c = curve(s.repartition(ranges), "score_i", "y")
        got = c.agg((F.sum(F.col("pos") * F.col("tp") / F.col("alerts")) / F.max("total_pos"))).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == pytest.approx(expected, rel=1e-12)


def test_bootstrap_f1_matches_published_spread(spark):
    from txnscope.operators.resample import bootstrap_f1_cells, ci_summary

    cells = spark.createDataFrame([(130, 65, 109, 38200)], "tp long, fp long, fn long, tn long")
    s = ci_summary(bootstrap_f1_cells(cells, 2000, seed=0), "f1").collect()[0]
    assert s.sd == pytest.approx(0.028, abs=0.003)
    assert s.ci_lo < 2 * 130 / (2 * 130 + 65 + 109) < s.ci_hi
    assert s.effective_b == 2000


@pytest.mark.parametrize("mean", [1.0, 1e3, 1e6])
def test_poisson_counts_follow_the_law_at_every_mean(mean):
    from txnscope.operators.resample import poisson_matrix

    seeds = np.arange(1, 401, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    w = poisson_matrix(seeds, np.full(400, mean), 250)
    n = w.size
    assert abs(w.mean() - mean) < 5 * math.sqrt(mean / n)
    assert abs(w.var() / mean - 1) < 5 * math.sqrt((2 + 1 / mean) / n)
    skew = ((w - w.mean()) ** 3).mean() / w.std() ** 3
    assert abs(skew - mean ** -0.5) < 0.05 + 5 * math.sqrt(6 / n)
    assert (w == poisson_matrix(seeds, np.full(400, mean), 250)).all()


@pytest.mark.parametrize("ranges", [1, 7])
def test_bootstrap_average_precision_equals_brute_force(spark, ranges, monkeypatch):
    """AP of each replicate from the score ranges equals AP of the weighted rows: ties over several ranges, nulls."""
    from txnscope.operators import resample as B

    rng = np.random.default_rng(3)
    rows = [(i, float(v) if i % 17 else None, int(y)) for i, (v, y) in
            enumerate(zip(np.where(rng.random(300) < 0.4, 5, rng.integers(0, 30, 300)), rng.random(300) < 0.3))]
    df = B.weighted(spark.createDataFrame(rows, "id long, s double, y int"), ["id"], 9)
    monkeypatch.setattr(B, "DRAW_ROWS", 13)
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = {r.rep: r.ap for r in B.ap_draws(df, "s", 20).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    p = df.where("s IS NOT NULL").toPandas()
    w = B.poisson_matrix(p["_h"].to_numpy().view(np.uint64), p["_mean"].to_numpy(), 20)
    for rep in range(20):
        ap = 0.0
        for s in p["s"].unique():
            above = p["s"] >= s
            n, pos = w[above, rep].sum(), (w[above, rep] * p["y"][above]).sum()
            ap += (w[p["s"] == s, rep] * p["y"][p["s"] == s]).sum() * pos / n if n else 0.0
        assert got[rep] == pytest.approx(ap / (w[:, rep] * p["y"]).sum(), abs=1e-9)


def test_bootstrap_sums_match_closed_form_spread(spark):
    """Sums over entities with one Poisson(1) count each: mean Σx, variance Σx²; groups apart, null group kept."""
    from txnscope.operators import resample as B

    rows = [(i, "a" if i % 3 else None, float(1 + i % 5)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g string, x double").repartition(5)
    got = B.bootstrap_sums(B.weighted(df, ["id"], 4), ["x"], 2000, ["g"]).toPandas()
    for g, part in got.groupby("g", dropna=False):
        x = np.array([v for _, k, v in rows if (k is None) == (g is None or g != g) and (k is None or k == g)])
        assert len(part) == 2000
        assert abs(part["x"].mean() - x.sum()) < 5 * math.sqrt((x ** 2).sum() / 2000)
        assert part["x"].var() == pytest.approx((x ** 2).sum(), rel=0.2)


def test_one_hot_has_no_category_limit(spark):
    """5,000 categories: a sparse indicator each but for the first; unseen and null are zeros."""
    from txnscope.operators import encode as J

    names = [f"c{i:05d}" for i in range(5000)]
    train = spark.createDataFrame([(n,) for n in names + names[:10]] + [(None,)], "c string")
    table = J.category_table(train, "c")
    assert sorted(r["index"] for r in table.collect()) == list(range(4999))
    assert J.fit_categories(train, "c") == names
    new = spark.createDataFrame([("c00000",), ("c00001",), ("c04999",), ("other",), (None,)], "c string")
    index = {r["category"]: r["index"] for r in table.collect()}
    for r in J.one_hot_sparse(new, "c", table, "v").collect():
        assert r.v.size == 4999
        assert list(r.v.indices) == ([index[r.c]] if r.c in index else [])


def test_rolling_fold_agrees_with_the_monthly_sums(spark):
    from txnscope.operators import split as K

    rows = [(f"2001-{m:02d}-{d:02d} 00:00:00", (m + d) % 2) for m in (1, 2, 3, 5, 6) for d in range(1, 2 + m)]
    df = spark.createDataFrame(rows, "t string, y int").select(F.col("t").cast("timestamp").alias("ts"), "y")
    got = {(r.fold, r.role): (r.rows, r.positives) for r in K.rolling_origin(df, "ts", "2001-02").collect()}
    want = {}
    for fold in ("2001-02", "2001-03", "2001-05", "2001-06"):
        for r in K.rolling_fold(df, "ts", fold).groupBy("role").agg(F.count("*").alias("n"), F.sum("y").alias("p")).collect():
            want[fold, r.role] = (r.n, r.p)
    assert got == want


def test_ks_statistic_and_pvalue(spark):
    from txnscope.operators.stats import ks_two_sample

    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 400), rng.normal(0.3, 1, 300)
    da = spark.createDataFrame([(float(x),) for x in a], "v double")
    db = spark.createDataFrame([(float(x),) for x in b], "v double")
    r = ks_two_sample(da, db, "v").collect()[0]
    grid = np.sort(np.concatenate([a, b]))
    d = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) -
                      np.searchsorted(np.sort(b), grid, "right") / len(b)))
    assert r.ks_d == pytest.approx(d, abs=1e-12)
    en = math.sqrt(len(a) * len(b) / (len(a) + len(b)))
    q = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * (en * d) ** 2) for k in range(1, 101))
    assert r.ks_pvalue == pytest.approx(q, rel=1e-9)


def test_splits_are_disjoint_with_exact_quotas(spark):
    from txnscope.operators import split as K
    from txnscope.sources import txn_orders

    t = txn_orders(spark, SF_SMALL)
    s = K.stratified_split(t, "txn_id", "y", [("train", 0.8), ("test", 0.2)])
    assert s.count() == t.count() == s.select("txn_id").distinct().count()
    for r in s.groupBy("y").agg(F.count(F.lit(1)).alias("n"),
                                F.sum((F.col("split") == "test").cast("int")).alias("te")).collect():
        assert r.te == r.n - round(r.n * 0.8)
    g = K.group_kfold(t, "client_id", 5)
    assert K.fold_disjoint(g, "client_id").collect()[0][0] == 0


def test_top_contributions_sorted_and_labelled(spark):
    from txnscope.operators.segments import top_contributions

    df = spark.createDataFrame([([("a", 0.5), ("b", -2.0), ("c", 1e-9), ("d", 1.0)],)],
                               "c array<struct<variable:string, contribution:double>>")
    r = df.select(top_contributions(F.col("c"), 2).alias("t")).collect()[0].t
    assert [(x.variable, x.direction) for x in r] == [("b", "lowers"), ("d", "raises")]


def test_schema_diff():
    from txnscope.operators.drift import schema_diff

    class _F:
        def __init__(self, n, t):
            self.name, self.dataType = n, type("T", (), {"simpleString": lambda s, t=t: t})()

    class _DF:
        schema = type("S", (), {"fields": [_F("a", "double"), _F("c", "int")]})()

    issues = {(d["column"], d["issue"]) for d in schema_diff(_DF(), [("a", "double"), ("b", "int")])}
    assert issues == {("b", "missing"), ("c", "unexpected")}


def test_empty_input_metrics(spark):
    from txnscope.operators.metrics import confusion, ranking_summary

    e = spark.createDataFrame([], "score double, y int, p int")
    r = ranking_summary(e, "score", "y").collect()
    assert len(r) == 1 and r[0].average_precision is None
    c = confusion(e, "p", "y").collect()[0]
    assert c.precision == 0.0 and c.recall is None


def test_linear_attributions_are_additive(spark):
    import __spark_entry__ as E

    r = E.queries()["l15_l16_linear_attributions"](spark, SF_SMALL).collect()
    assert max(x.max_additivity_error for x in r) < 1e-9
    assert sum(x.share for x in r) == pytest.approx(1.0, abs=1e-5)


def brute_force_shapley(x: np.ndarray, plan: dict, p: int) -> np.ndarray:
    """Exact Shapley values of the path-dependent expectation by enumerating feature
    subsets (2^p); for tests on small models only."""
    from itertools import combinations

    from txnscope.operators import attribution as AT

    def value(S):
        tot = 0.0
        for v, feats in plan["leaves"]:
            prod = v
            for f, z, conds in feats:
                if f in S:
                    ok = all(bool(AT._branch(np.array([x[f]]), t, s)[0]) for t, s in conds)
                    prod *= 1.0 if ok else 0.0
                else:
                    prod *= z
            tot += prod
        return tot

    phi = np.zeros(p)
    allf = list(range(p))
    for i in allf:
        rest = [f for f in allf if f != i]
        for k in range(p):
            w = math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p)
            for S in combinations(rest, k):
                s = set(S)
                phi[i] += w * (value(s | {i}) - value(s))
    return phi


def test_tree_attributions_additive_and_exact_shapley(spark):
    """Base + Σ contributions = the model margin (1e-9), and each row's values equal
    Shapley values of the cover-weighted path expectation found by subset enumeration."""
    from txnscope.catalog.q_models import _parts, model_data
    from txnscope.operators import attribution as AT
    from txnscope.operators import models as L

    x, cols = model_data(spark, SF_SMALL)
    fit, _, test = _parts(x)
    for kind, kw in (("gbt", {"maxIter": 5, "maxDepth": 3}), ("forest", {"numTrees": 4, "maxDepth": 3})):
        m = L.pipeline(kind, cols, weight="w", **kw).fit(fit)
        c = AT.tree_contributions(m, test, cols, ["txn_id"]).toPandas()
        assert len(c) == test.count()
        assert (c.shap_margin - c.margin).abs().max() < 1e-9
        plan = AT.compile_paths(m)
        used = sorted({f for _, fe in plan["leaves"] for f, _, _ in fe})
        sub = {"leaves": [(v, [(used.index(f), z, cd) for f, z, cd in fe]) for v, fe in plan["leaves"]],
               "base": plan["base"]}
        X = np.array(test.select(*[F.col(f"`{k}`").cast("double") for k in cols]).limit(4).collect(),
                     dtype=float)
        phi = AT.shap_matrix(X, plan)
        blocks = AT.plan_blocks(plan, 3)
        assert len(blocks) > 1
        assert np.abs(sum(AT.shap_matrix(X, {"leaves": k}) for k in blocks) - phi).max() < 1e-12
        for r in range(len(X)):
            bf = brute_force_shapley(X[r, used], sub, len(used))
            assert np.abs(bf - phi[r, used]).max() < 1e-9
            assert np.abs(np.delete(phi[r], used)).max(initial=0.0) == 0.0


def test_tree_attribution_query(spark):
    import __spark_entry__ as E

    r = E.queries()["l15_l16_tree_attributions"](spark, SF_SMALL).collect()
    assert max(x.max_additivity_error for x in r) < 1e-9
    assert sum(x.share for x in r) == pytest.approx(1.0, abs=1e-5)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_exact_quantiles_match_numpy_for_any_partitioning(spark, parts):
    """Distributed exact quantiles equal numpy's linear rule per group, with ties, nulls,
    a hot group holding most rows, and any number of value ranges."""
    from txnscope.plans.quantile import exact_quantiles

    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("hot", 3000), ("a", 40), ("b", 1), ("c", 2)):
        vals = np.round(rng.gamma(2.0, 50.0, n), 0)   # many ties
        rows += [(g, float(v) if i % 11 else None) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    ps = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.975, 1.0]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.g: r._q for r in exact_quantiles(df, "v", ps, by=["g"]).collect()}
        glob = exact_quantiles(df, "v", ps).collect()[0]._q
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for g in ("hot", "a", "b", "c"):
        vals = np.array([v for gg, v in rows if gg == g and v is not None])
        if len(vals) == 0:
            assert g not in got
            continue
        assert np.allclose(got[g], np.quantile(vals, ps), rtol=0, atol=1e-9)
    allv = np.array([v for _, v in rows if v is not None])
    assert np.allclose(glob, np.quantile(allv, ps), rtol=0, atol=1e-9)


def test_smote_approx(spark):
    from txnscope.operators.encode import smote_approx

    rows = [(i, float(i % 7), float(i * i % 11), 0) for i in range(400)] + [(1000 + i, 100.0 + i, 50.0 - 2 * i, 1) for i in range(7)]
    df = spark.createDataFrame(rows, "txn_id long, a double, b double, y int")
    out = smote_approx(df, "txn_id", ["a", "b"], ratio=0.1).toPandas()
    made = out[out.txn_id.isna()]
    assert len(out) == 407 + 33 and len(made) == 40 - 7 and set(made.y) == {1}
    # every column of the seven falls with the same line, so all places between neighbours are on it
    assert (abs(made.b - (50 - 2 * (made.a - 100))) < 1e-9).all() and made.a.between(100, 106).all()
    assert made.a.nunique() > 25
    again = smote_approx(df.repartition(5), "txn_id", ["a", "b"], ratio=0.1).toPandas()
    assert sorted(made.a.round(9)) == sorted(again[again.txn_id.isna()].a.round(9))
    one = smote_approx(df.where("y = 0 OR txn_id = 1000"), "txn_id", ["a", "b"], ratio=0.1).where("txn_id IS NULL").toPandas()
    assert len(one) == 39 and set(one.a) == {100.0}
    assert smote_approx(df.where("y = 0"), "txn_id", ["a", "b"]).count() == 400
    assert smote_approx(df, "txn_id", ["a", "b"], ratio=0.01).count() == 407


def test_drawn_settings():
    from txnscope.operators.models import drawn_settings

    space = {"a": [1, 2, 3], "b": [0.1, 0.2]}
    got = drawn_settings(space, 4)
    assert len({tuple(sorted(s.items())) for s in got}) == 4 and got == drawn_settings(space, 4)
    assert len(drawn_settings(space, 100)) == 6


def test_isolation_trees_draw_their_own_rows(spark):
    from txnscope.operators.anomaly import fit_isolation_forest

    df = spark.range(1000).select("id", (F.col("id") % 97).cast("double").alias("x"), F.rand(3).alias("z"))
    roots = fit_isolation_forest(df, ["x", "z"], "id", trees=12, sample=64).where("node = 0").toPandas()
    assert sorted(roots.tree) == list(range(12)) and set(roots["size"]) == {64}
    small = fit_isolation_forest(df.limit(20), ["x", "z"], "id", trees=5, sample=64).where("node = 0").toPandas()
    assert len(small) == 5 and set(small["size"]) == {20}


def test_rolling_months_follow_the_data(spark):
    from txnscope.catalog.q_models import rolling_months

    def of(*rows):
        return rolling_months(spark.createDataFrame(rows, "ts string, y int").withColumn("ts", F.to_timestamp("ts")), "ts")

    assert of(("1990-11-03", 0), ("1990-11-04", 1), ("1990-12-01", 0), ("1991-01-05", 0), ("1991-02-01", 1), ("1991-04-01", 0)) == ["1991-01", "1991-02"]
    assert of(("1990-11-03", 0), ("1990-12-01", 1), ("1991-01-05", 0), ("1991-02-01", 1)) == ["1991-02"]
    assert of(("1990-11-03", 0)) == []


def _plain_fill(rows):
    """rows of one key in order -> for each its nearest value back, else ahead."""
    out, seen = [], None
    for i, v in enumerate(rows):
        seen = v if v is not None else seen
        out.append(seen if seen is not None else next((x for x in rows[i:] if x is not None), None))
    return out


def test_fill_carries_over_chunks(spark):
    import random

    from txnscope.operators.history import fill_within_key

    rnd = random.Random(5)
    rows = []
    for i in range(600):
        key = rnd.choice(["hot", "hot", "hot", "b", None])
        hour = rnd.choice([None, rnd.randrange(0, 900), 40])
        rows.append((i, key, hour, rnd.choice([None, None, None, None, None, None, "x", "y", "z"]) if key != "b" else None))
    df = spark.createDataFrame(rows, "txn_id long, client_id string, hour long, v string").withColumn(
        "ts", F.when(F.col("hour").isNotNull(), F.timestamp_seconds(F.col("hour") * 3600 + 1_700_000_000)))
    expected = {}
    for key in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is None, r[2] or 0, r[0]))
        expected.update({r[0]: v for r, v in zip(mine, _plain_fill([r[3] for r in mine]))})
    for hours in (1.0, 24.0, 1e6):
        out = fill_within_key(df, ["v"], chunk_hours=hours)
        assert out.columns == df.columns
        assert {r["txn_id"]: r["v"] for r in out.collect()} == expected
    assert fill_within_key(df.limit(0), ["v"]).count() == 0


def test_profile_carries_moments_and_modes_over_chunks(spark):
    import random
    import statistics

    from txnscope.operators.history import client_profile_features, expanding_mode, prior_moments

    rnd = random.Random(6)
    rows = [(i, rnd.choice([1, 1, 1, 2, None]), rnd.randrange(0, 500), rnd.choice([None, 1e6 + rnd.random(), 1e6 - 3.5]), rnd.choice([0, 1, 2, 2, None]),
             rnd.random() < 0.3) for i in range(400)]
    df = spark.createDataFrame(rows, "txn_id long, client_id long, hour long, amount double, code int, flag boolean").withColumn(
        "ts", F.timestamp_seconds(F.col("hour") * 3600 + 1_700_000_000))
    expected = {}
    for key in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(mine):
            codes = [m[4] for m in mine[:i] if m[4] is not None]
            mode = min(set(codes), key=lambda c: (-codes.count(c), c)) if codes else None
            expected[r[0]] = (mode, [m[3] for m in mine[:i] if m[3] is not None], [m[5] for m in mine[:i]])
    for hours in (1.0, 24.0, 1e6):
        got = {r["txn_id"]: r for r in expanding_mode(prior_moments(df, {"a": "amount"}, chunk_hours=hours), "code", "mode", chunk_hours=hours).collect()}
        for i, (mode, values, _) in expected.items():
            assert got[i]["mode"] == mode and got[i]["a_n"] == len(values)
            if values:
                assert got[i]["a_mean"] == pytest.approx(statistics.fmean(values), rel=1e-12)
                assert got[i]["a_m2"] == pytest.approx(len(values) * statistics.pvariance(values), rel=1e-6, abs=1e-6)
    for r in client_profile_features(df, flag="flag").collect():
        _, values, flags = expected[r["txn_id"]]
        assert (r["running_mean"] is None) == (not values) and (r["running_cv"] is None) == (len(values) < 2)
        assert r["running_flag_share"] == (pytest.approx(sum(flags) / len(flags)) if flags else None)


def test_nearest_in_time_over_chunks(spark):
    import random

    from txnscope.operators.joins import nearest_in_time

    rnd = random.Random(7)
    a = [(i, rnd.choice([1, 1, 2, 3]), rnd.randrange(0, 400)) for i in range(200)]
    b = [(i, rnd.choice([1, 2]), rnd.randrange(0, 400)) for i in range(12)]

    def table(rows):
        return spark.createDataFrame(rows, "txn_id long, client_id long, day int").withColumn("ts", F.date_add(F.lit("2020-01-01").cast("date"), F.col("day")))

    expected = {i: min((abs(d - e) for _, k2, e in b if k2 == k), default=None) for i, k, d in a}
    for days in (1, 30, 100_000):
        out = nearest_in_time(table(a), table(b), "client_id", "ts", "txn_id", chunk_days=days)
        assert {r["txn_id"]: r["days_to_nearest"] for r in out.collect()} == expected


def test_hot_client_uses_a_task_for_each_chunk(spark):
    """The rows of one client with all rows lie in many tasks."""
    from txnscope.operators.history import client_profile_features, fill_within_key

    df = spark.range(20_000).select(F.col("id").alias("txn_id"), (F.col("id") - F.col("id")).alias("client_id"), F.timestamp_seconds(F.col("id") * 3600).alias("ts"),
                                    F.when(F.col("id") == 7, "x").alias("v"), F.col("id").cast("double").alias("amount"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (fill_within_key(df, ["v"]), client_profile_features(df)):
            tasks = out.groupBy(F.spark_partition_id()).count().collect()
            assert len(tasks) > 1 and max(r["count"] for r in tasks) < 20_000 // 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_robustness_schemes_finish(spark):
    """Every scheme gives a row, with the F1 of the fold's rule beside the model's."""
    from txnscope.catalog.q_models import robustness

    rows = {r["scheme"]: r for r in robustness(spark, "/root/testdata/sf0.001").collect()}
    assert set(rows) == {"random", "group", "temporal", "rolling"}
    assert all(0 <= r[c] <= 1 for r in rows.values() for c in ("f1", "rule_f1", "oracle_f1") if r[c] is not None)
    assert all(r["oracle_f1"] >= r["f1"] - 1e-9 for r in rows.values())


def test_distinct_counts_without_expand(spark):
    import contextlib
    import io

    from txnscope.operators.quality import distinct_counts, distinct_sketches, sketch_counts

    rows = [(1, "a", 0.0, None, ["x, y"], b"\x00"), (1, "b", -0.0, None, ["x", "y"], b"0"), (None, "a", float("nan"), None, None, None), (2, "", float("nan"), None, [], b"")]
    df = spark.createDataFrame(rows, "`i.d` long, s string, f double, n string, a array<string>, b binary")
    expected = {"i.d": 2, "s": 3, "f": 2, "n": 0, "a": 3, "b": 3}
    out = distinct_counts(df)
    assert {r["column"]: r["n_distinct"] for r in out.collect()} == expected
    assert {r["n_distinct"] for r in distinct_counts(df.limit(0)).collect()} == {0}
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain()
    assert "Expand" not in text.getvalue()
    merged = sketch_counts(distinct_sketches(df.limit(2)).unionByName(distinct_sketches(df)))
    assert {r["column"]: r["n_distinct"] for r in merged.collect()} == expected
    wide = spark.range(50_000).select(F.col("id"), (F.col("id") % 7000).alias("m"))
    for r in sketch_counts(distinct_sketches(wide.where("id < 30000")).unionByName(distinct_sketches(wide.where("id >= 20000")))).collect():
        assert r["n_distinct"] == pytest.approx({"id": 50_000, "m": 7000}[r["column"]], rel=0.04)


def test_materialize_once_follows_its_input(spark, tmp_path):
    from txnscope.plans.frames import materialize_once

    folder = str(tmp_path / "in")

    def total(n):
        spark.range(n).write.mode("overwrite").parquet(folder)

    def read():
        return materialize_once(spark, ("once-test", folder), lambda: spark.read.parquet(folder)).count()

    total(3)
    assert read() == 3 == read()
    total(5)
    assert read() == 5
