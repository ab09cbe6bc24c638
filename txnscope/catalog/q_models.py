"""Model, comparison and lifecycle queries.

Models are stochastic or iterative, so these are rows-only checks; the
invariants are exercised in tests.  The model table is the J13-preprocessed
``txn_orders`` with a stratified 64/16/20 split, written once to the shared
checkpoint folder (lineage cut) before the iterative fits.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import functions as F

from txnscope.catalog.q_prep import SPLIT3, features
from txnscope.catalog.registry import query
from txnscope.plans.frames import materialize, materialize_once, shuffles_by_size
from txnscope.operators import attribution as AT
from txnscope.operators import drift as N
from txnscope.operators import encode as J
from txnscope.operators import models as L
from txnscope.operators import segments as G
from txnscope.operators import split as K
from txnscope.operators.metrics import confusion, curve, best_f1_threshold, ranking_summary
from txnscope.operators.order import chronological_cut
from txnscope.plans.frames import with_scalars
from txnscope.sources import files as A
from txnscope.sources import load
from txnscope.sources import registry as REG
from txnscope.streaming.source import new_run_dir

NUMERIC = ["amount", "prior_count", "gap_hours"]


def _build_model_table(spark, sf_dir):
    # the split reads the features, and every fitted parameter reads the split: each is written once
    f = materialize(features(spark, sf_dir).withColumn("prior_count", F.col("prior_count").cast("double")), "model-features")
    s = materialize(K.stratified_split(f, "txn_id", "y", SPLIT3), "model-split")
    fit = s.where(F.col("split") == "fit")
    pp = J.fit_preprocessor(fit, "client_id", "category", NUMERIC)
    return J.with_weight(pp.transform(s), J.class_weights(fit))


def model_data(spark, sf_dir):
    """(table with split + model columns, model column list).  Built and written once
    per session and input folder; the model queries all read the same table."""
    with shuffles_by_size(load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")):
        x = materialize_once(spark, ("model-table", sf_dir), lambda: _build_model_table(spark, sf_dir))
    cols = NUMERIC + ["is_outlier", "key_te"] + sorted(c for c in x.columns if c.startswith("cat_"))
    return x, cols


def _parts(x):
    return (x.where(F.col("split") == "fit"), x.where(F.col("split") == "validation"),
            x.where(F.col("split") == "test"))


def fit_and_report(name, kind, x, cols, **kw):
    fit, val, test = _parts(x)
    m = L.pipeline(kind, cols, **kw).fit(fit)
    thr = L.chosen_threshold(L.score(m, val))
    sv, st = L.score(m, val), L.score(m, test)
    at_thr = L.evaluate(with_scalars(st, thr), F.col("threshold"))
    at_05 = L.evaluate(st, 0.5).select(F.col("f1").alias("f1_at_0_5"))
    v = L.evaluate(with_scalars(sv, thr), F.col("threshold")).select(F.col("f1").alias("f1_validation"))
    return with_scalars(with_scalars(with_scalars(at_thr, at_05), v), thr).withColumn("model", F.lit(name)), m


# the rows of each part as ``stratified_split`` deals them
PARTS_SQL = f"""
h AS (SELECT txn_id, y, CAST({J.hash_order_sql('txn_id', 42)} AS DOUBLE) AS h FROM txn_orders),
rk AS (SELECT txn_id, y, row_number() OVER (PARTITION BY y ORDER BY h, txn_id) AS r, count(*) OVER (PARTITION BY y) AS n FROM h),
parts AS (SELECT txn_id, y, CASE WHEN r <= round(n * 0.64) THEN 'fit' WHEN r <= round(n * 0.8) THEN 'validation' ELSE 'test' END AS split FROM rk)"""
BASELINE_SQL = f"""
WITH {PARTS_SQL},
rate AS (SELECT avg(y) AS rate FROM parts WHERE split = 'fit'),
p AS (SELECT 'constant' AS model, y, 0 AS p FROM parts WHERE split = 'test'
      UNION ALL SELECT 'stratified_random', y, CAST({J.hash60_sql('txn_id', 4242)} % 1000000 / 1000000 < rate AS INT) FROM parts, rate WHERE split = 'test'),
c AS (SELECT model, count(*) FILTER (WHERE p = 1 AND y = 1) AS tp, count(*) FILTER (WHERE p = 1 AND y = 0) AS fp,
             count(*) FILTER (WHERE p = 0 AND y = 1) AS fn, count(*) FILTER (WHERE p = 0 AND y = 0) AS tn, count(*) AS n FROM p GROUP BY model)
SELECT model, tp, fp, fn, tn, n, r6((tp + tn) / n) AS accuracy, r6(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END) AS precision,
       r6(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END) AS recall, r6(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END) AS f1,
       r6((tp + fp) / n) AS alert_rate FROM c
"""


@query("l1_l2_baselines", BASELINE_SQL)
def baselines(spark, sf_dir):
    """L1 constant majority and L2 stratified random baselines on test."""
    x, _ = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    rate = fit.agg(F.avg("y")).collect()[0][0]
    a = confusion(L.constant_baseline(test), "p").withColumn("model", F.lit("constant"))
    b = confusion(L.stratified_random_baseline(test, rate), "p").withColumn("model", F.lit("stratified_random"))
    return a.unionByName(b)


@query("l3_logistic_regression")
def logistic(spark, sf_dir):
    """L3: logistic regression plain, class-weighted and elastic net; threshold chosen on
    validation, metrics on test (and F1 at 0.5)."""
    x, cols = model_data(spark, sf_dir)
    out = [fit_and_report("logistic", "logistic", x, cols)[0],
           fit_and_report("logistic_weighted", "logistic", x, cols, weight="w")[0],
           fit_and_report("logistic_elastic_net", "logistic", x, cols, weight="w", regParam=0.01,
                          elasticNetParam=0.5)[0]]
    return reduce(lambda a, b: a.unionByName(b), out)


@query("l4_linear_svm_weighted")
def svm(spark, sf_dir):
    """L4: class-weighted linear SVM (margin score)."""
    x, cols = model_data(spark, sf_dir)
    return fit_and_report("linear_svm", "svm", x, cols, weight="w")[0]


@query("l5_l6_decision_tree_leaf_rules")
def tree(spark, sf_dir):
    """L5 + L6: readable tree (depth 3, leaves >= 100 rows); leaf rule table on test."""
    x, cols = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    m = L.pipeline("tree", cols, weight="w").fit(fit)
    return L.leaf_rules(m.stages[-1], test, cols)


@query("l5_decision_tree_variants")
def tree_variants(spark, sf_dir):
    """The tree free, limited in depth, and readable: test metrics, F1 on the rows it was fitted on, depth, leaves."""
    x, cols = model_data(spark, sf_dir)
    out = []
    for name, kw in (("free", {"maxDepth": 30, "minInstancesPerNode": 1}), ("depth_6", {"maxDepth": 6, "minInstancesPerNode": 1}), ("readable", {})):
        r, m = fit_and_report(name, "tree", x, cols, weight="w", **kw)
        own = L.evaluate(L.score(m, _parts(x)[0]), 0.5).select(F.col("f1").alias("f1_fit_at_0_5"))
        t = m.stages[-1]
        out.append(with_scalars(r, own).withColumn("depth", F.lit(t.depth)).withColumn("leaves", F.lit((t.numNodes + 1) // 2)))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("l7_random_forest_balanced")
def forest(spark, sf_dir):
    """Class-balanced random forest."""
    x, cols = model_data(spark, sf_dir)
    return fit_and_report("random_forest", "forest", x, cols, weight="w", numTrees=100, maxDepth=6)[0]


@query("l8_gradient_boosted_trees")
def gbt(spark, sf_dir):
    """Gradient-boosted trees with positive-class weight and row subsampling."""
    x, cols = model_data(spark, sf_dir)
    return fit_and_report("gbt", "gbt", x, cols, weight="w", maxIter=20)[0]


@query("l10_l11_cross_validated_grid")
def grid(spark, sf_dir):
    """L10 + L11: stratified 3-fold validation curve over the regularisation of a weighted
    logistic regression: step AP on held-out and training folds."""
    x, cols = model_data(spark, sf_dir)
    t = L.search(_parts(x)[0], cols, "logistic", [{"regParam": r} for r in (0.0, 0.001, 0.01, 0.1, 1.0)])
    return t.withColumn("reg_param", F.get_json_object("setting", "$.regParam").cast("double")).drop("setting")


@query("l10_randomised_search")
def random_search(spark, sf_dir):
    """Six random settings of a forest, each on three stratified folds, ranked by held-out AP."""
    x, cols = model_data(spark, sf_dir)
    space = {"numTrees": [10, 20], "maxDepth": [4, 6, 8], "minInstancesPerNode": [1, 3, 5], "subsamplingRate": [0.2, 0.4, 0.6]}
    return L.search(_parts(x)[0], cols, "forest", L.drawn_settings(space, 6))


def written_folds(fit, cols, k=3):
    """What a fit reads of the rows, dealt to ``k`` stratified folds and written once."""
    with shuffles_by_size(fit):
        return materialize(K.stratified_kfold(fit.select("txn_id", "y", "w", *cols), "txn_id", k, name="fold"), "folds")


def oof_scores(folds, cols, k=3, kind="logistic", weight="w", made=lambda f, train: train):
    """Scored rows of every fold; ``made`` gives the rows to fit on from the fold's number and the other folds' rows."""
    parts = []
    for f in range(k):
        m = L.pipeline(kind, cols, weight=weight).fit(made(f, folds.where(F.col("fold") != f)))
        parts.append(L.score(m, folds.where(F.col("fold") == f)))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("l12_out_of_fold_predictions")
def oof(spark, sf_dir):
    """Out-of-fold scores on the fit part (3 folds): AP and rows per fold."""
    x, cols = model_data(spark, sf_dir)
    s = oof_scores(written_folds(_parts(x)[0], cols), cols)
    per = s.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))
    return with_scalars(per, ranking_summary(s, "score", "y").select("average_precision"))


@query("l13_global_importance")
def importance(spark, sf_dir):
    """Gradient-boosted tree importances, ranked, with the top-3 share."""
    x, cols = model_data(spark, sf_dir)
    m = L.pipeline("gbt", cols, weight="w", maxIter=20).fit(_parts(x)[0])
    return L.importances(m, cols)


GROUPS = {"amount": ["amount", "is_outlier"], "history": ["prior_count", "gap_hours"],
          "client_encoding": ["key_te"]}


@query("l14_permutation_importance")
def perm(spark, sf_dir):
    """AP drop on test when a variable group is shuffled across rows (5 repeats)."""
    x, cols = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    m = L.pipeline("logistic", cols, weight="w").fit(fit)
    groups = dict(GROUPS, category=[c for c in cols if c.startswith("cat_")])
    return L.permutation_importance(m, test, groups, "txn_id")


@query("l15_l16_linear_attributions")
def attributions(spark, sf_dir):
    """L15 + L16: exact additive attributions of a linear model (margin = base + Σ
    contributions; the max additivity error is reported) and the global table."""
    x, cols = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    m = L.pipeline("logistic", cols, weight="w").fit(fit)
    c = L.linear_contributions(m, fit, test, cols)
    err = c.select((F.col("base") + F.aggregate("contributions", F.lit(0.0),
                                                lambda acc, s: acc + s["contribution"]) - F.col("margin"))
                   .alias("_e")).agg(F.max(F.abs("_e")).alias("max_additivity_error"))
    return with_scalars(L.global_attribution(c), err)


@query("l15_l16_tree_attributions")
def tree_attributions(spark, sf_dir):
    """L15 + L16 on the boosted model: exact per-row tree attributions in log-odds for
    every test row, the global mean-|contribution| table, the max additivity error
    against the model's own margin, and how often each variable is a top-5 reason (X5)."""
    x, cols = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    m = L.pipeline("gbt", cols, weight="w", maxIter=20).fit(fit)
    c = materialize(AT.tree_contributions(m, test, cols, ["txn_id"]), "tree-attributions")
    err = c.agg(F.max(F.abs(F.col("shap_margin") - F.col("margin"))).alias("max_additivity_error"))
    top = c.select(F.explode(G.top_contributions(F.col("contributions"), 5)).alias("t")) \
        .groupBy(F.col("t.variable").alias("variable")).agg(F.count(F.lit(1)).alias("top5_rows"))
    g = L.global_attribution(c).join(top, "variable", "left") \
        .withColumn("top5_rows", F.coalesce("top5_rows", F.lit(0)))
    return with_scalars(g, err)


@query("l17_combined_detectors")
def combined(spark, sf_dir):
    """Union of the model's alerts and a history-anomaly detector (|z| >= 3):
    coverage, alert volume, precision, share of misses rescued."""
    x, cols = model_data(spark, sf_dir)
    fit, val, test = _parts(x)
    m = L.pipeline("logistic", cols, weight="w").fit(fit)
    thr = L.chosen_threshold(L.score(m, val))
    t = with_scalars(L.score(m, test), thr)
    t = t.withColumn("p1", (F.col("score") >= F.col("threshold")).cast("int")) \
        .withColumn("p2", (F.col("z_amount_abs") >= 3).cast("int"))
    return L.combine_detectors(t, "p1", "p2")


@query("l18_ablation")
def ablation(spark, sf_dir):
    """Refit without each variable group; test AP and its change."""
    x, cols = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    groups = dict(GROUPS, category=[c for c in cols if c.startswith("cat_")])
    rows = []
    for g, drop in [("none", [])] + list(groups.items()):
        keep = [c for c in cols if c not in drop]
        m = L.pipeline("logistic", keep, weight="w").fit(fit)
        rows.append(ranking_summary(L.score(m, test), "score", "y").select(
            F.lit(g).alias("dropped"), "average_precision", "roc_auc"))
    u = reduce(lambda a, b: a.unionByName(b), rows)
    base = u.where(F.col("dropped") == "none").select(F.col("average_precision").alias("_b"))
    return with_scalars(u, base).withColumn("ap_change", F.col("average_precision") - F.col("_b")).drop("_b")


@query("l19_collinear_block_coefficients")
def collinear(spark, sf_dir):
    """Standardised logistic coefficients with and without the collinear amount block."""
    x, cols = model_data(spark, sf_dir)
    fit = _parts(x)[0]
    std = J.fit_standardizer(fit, cols)
    z = J.apply_standardizer(fit, cols, std)
    out = []
    for name, use in (("with_block", cols), ("without_block", [c for c in cols if c != "is_outlier"])):
        m = L.pipeline("logistic", use).fit(z)
        out.append(L.importances(m, use).select(F.lit(name).alias("fit"), "variable", "value"))
    return out[0].unionByName(out[1])


def _model_table(x, cols):
    fit, val, test = _parts(x)
    rows = []
    for name, kind, cx, kw in (("logistic", "logistic", 1, {}), ("tree", "tree", 2, {}),
                               ("forest", "forest", 3, {"numTrees": 30, "maxDepth": 6}),
                               ("gbt", "gbt", 4, {"maxIter": 20})):
        m = L.pipeline(kind, cols, weight="w", **kw).fit(fit)
        for part, d in (("fit", fit), ("validation", val), ("test", test)):
            rows.append(ranking_summary(L.score(m, d), "score", "y").select(
                F.lit(name).alias("model"), F.lit(cx).alias("complexity"), F.lit(part).alias("part"),
                "average_precision"))
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("m17_m18_model_choice_and_overfit")
def choice(spark, sf_dir):
    """AP on fit / validation / test per model with over-fit gaps; M17: the chosen
    model (best validation AP; a simpler model within 0.01 wins)."""
    x, cols = model_data(spark, sf_dir)
    t = _model_table(x, cols)
    w = t.groupBy("model", "complexity").pivot("part", ["fit", "validation", "test"]).agg(
        F.first("average_precision"))
    w = w.withColumn("gap_fit_validation", F.col("fit") - F.col("validation")) \
        .withColumn("gap_validation_test", F.col("validation") - F.col("test"))
    chosen = L.choose_model(w.withColumnRenamed("validation", "average_precision"),
                            "average_precision", 0.01).select(F.col("model").alias("_chosen"))
    return with_scalars(w, chosen).withColumn("chosen", F.col("model") == F.col("_chosen")).drop("_chosen")


@query("m19_imbalance_techniques")
def imbalance(spark, sf_dir):
    """M19 + J11: out-of-fold AP, F1 at the best threshold and recall at 0.5 with no treatment, class weights,
    1:10 undersampling and approximate 1:10 SMOTE (inside each training part)."""
    x, cols = model_data(spark, sf_dir)
    fit = _parts(x)[0]
    folds = written_folds(fit, cols)
    scored = {"none": oof_scores(folds, cols, weight=None), "weights": oof_scores(folds, cols, weight="w")}
    with shuffles_by_size(fit):
        # an undersampled row belongs to a training part where one of the part's rows has its id
        homes = folds.groupBy("txn_id").agg(F.min("fold").alias("_low"), F.max("fold").alias("_high"))
        under = materialize(J.undersample(fit.select("txn_id", "y", *cols), "txn_id", "y", 10.0).join(homes.hint("merge"), "txn_id"), "undersampled")

    def smote(f, train):
        with shuffles_by_size(train):
            return J.smote_approx(train, "txn_id", cols, ratio=0.1)

    scored["undersample_1_10"] = oof_scores(folds, cols, weight=None, made=lambda f, train: under.where((F.col("_low") != f) | (F.col("_high") != f)))
    scored["smote_1_10"] = oof_scores(folds, cols, weight=None, made=smote)
    out = []
    for name, s in scored.items():
        s = materialize(s.select("y", "score"), "imbalance-scores")
        r = ranking_summary(s, "score", "y").select(F.lit(name).alias("technique"), "average_precision", "roc_auc", "positives", "negatives")
        best = best_f1_threshold(curve(s, "score", "y")).select(F.col("f1").alias("best_f1"))
        at = L.evaluate(s, 0.5).select(F.col("recall").alias("recall_at_0_5"))
        out.append(with_scalars(with_scalars(r, best), at))
    return reduce(lambda a, b: a.unionByName(b), out)


#: rolling test months of M20, and folds that are fitted at the same time
ROLLING_MONTHS, FOLDS_AT_ONCE = 2, 4


def _pooled(scheme, scored):
    """One row of M20 from scored test rows that carry their ``threshold`` and the prediction of their fold's rule."""
    ap = ranking_summary(scored, "score", "y").select("average_precision", "positives", "negatives")
    oracle = best_f1_threshold(curve(scored, "score", "y")).select(F.col("f1").alias("oracle_f1"))
    f1 = confusion(scored.withColumn("_p", (F.col("score") >= F.col("threshold")).cast("int")), "_p", "y").select("f1")
    rule = confusion(scored, "rule", "y").select(F.col("f1").alias("rule_f1"))
    return with_scalars(with_scalars(with_scalars(ap, oracle), f1), rule).withColumn("scheme", F.lit(scheme)).withColumn(
        "ap_over_prevalence", F.col("average_precision") / (F.col("positives") / (F.col("positives") + F.col("negatives"))))


def rolling_months(df, ts, label="y", last=None):
    """The months that can be test months (all, or the ``last`` few): rows in the month before it, and both classes in the months before that."""
    got = df.groupBy(F.date_format(ts, "yyyy-MM").alias("m")).agg(F.min(label).alias("low"), F.max(label).alias("high")).orderBy("m").collect()
    out = []
    for k in range(2, len(got)):
        (year, month), before = map(int, got[k].m.split("-")), got[:k - 1]
        previous = f"{year - (month == 1):04d}-{(month - 2) % 12 + 1:02d}"
        if got[k - 1].m == previous and min(r.low for r in before) == 0 and max(r.high for r in before) == 1:
            out.append(got[k].m)
    return out[-last:] if last else out


def _scored_fold(cols, rules, train, threshold, test):
    """Scored test rows of one fold, written: y, score, the threshold of the ``threshold`` rows and the best rule's prediction."""
    m = L.pipeline("logistic", cols, weight="w").fit(train)
    best = G.rule_selection(train, train, rules).where("selected").select(F.col("rule").alias("_best"))
    x = with_scalars(with_scalars(L.score(m, test), L.chosen_threshold(L.score(m, threshold))), best)
    rule = F.coalesce(*[F.when(F.col("_best") == n, c.cast("int")) for n, c in rules.items()])
    return materialize(x.select("y", "score", "threshold", rule.alias("rule")), "scored-fold")


def robustness_table(base, cols, rules, months=ROLLING_MONTHS, at_once=FOLDS_AT_ONCE):
    """M20 for any model table with txn_id, client_id, ts, y, w and ``cols``; ``rules`` maps names to conditions.
    ``months`` is the number of last test months of the rolling scheme (None: every month that the data allow)."""
    folds = materialize(K.group_kfold(base, "client_id", 5), "client-folds")
    random = materialize(K.stratified_split(base, "txn_id", "y", [("train", 0.8), ("test", 0.2)]), "random-split")
    temporal = K.temporal_split(base, "ts", [("train", "1999-12")], "test")

    def split(t):
        return t.where(F.col("split") == "train"), t.where(F.col("split") == "train"), t.where(F.col("split") == "test")

    # (train, rows that choose the threshold, test) of every fold; the metrics are pooled over a scheme's test parts
    jobs = [("random", *split(random)), ("temporal", *split(temporal))]
    jobs += [("group", folds.where(F.col("fold") != k), folds.where(F.col("fold") != k), folds.where(F.col("fold") == k)) for k in range(5)]
    for month in rolling_months(base, "ts", last=months):
        f = K.rolling_fold(base, "ts", month)
        jobs.append(("rolling", *[f.where(F.col("role") == r) for r in ("train", "threshold", "test")]))
    with ThreadPoolExecutor(at_once) as pool:
        scored = list(pool.map(lambda job: _scored_fold(cols, rules, *job[1:]), jobs))
    names = list(dict.fromkeys(j[0] for j in jobs))
    parts = {n: reduce(lambda a, b: a.unionByName(b), [s for j, s in zip(jobs, scored) if j[0] == n]) for n in names}
    return reduce(lambda a, b: a.unionByName(b), [_pooled(n, p) for n, p in parts.items()])


@query("m20_robustness_schemes")
def robustness(spark, sf_dir):
    """AP / prevalence, F1 at the chosen threshold, F1 of the rule that is best on train, and oracle F1 on test, for a
    random split, five client-grouped folds, a temporal split and the last rolling-origin months (K5: train on the
    months before the previous one, which gives the threshold)."""
    x, cols = model_data(spark, sf_dir)
    high, outlier = F.col("amount") > 50000, F.col("is_outlier") == 1
    rules = {"high_amount": high, "outlier": outlier, "any_of": high | outlier, "all_of": high & outlier}
    return robustness_table(x.drop("split"), cols, rules)


@query("m21_threshold_comparison")
def thresholds(spark, sf_dir):
    """F1 on test at 0.5, at the validation-chosen threshold and at the test oracle
    threshold; loss due to the threshold choice only."""
    x, cols = model_data(spark, sf_dir)
    fit, val, test = _parts(x)
    m = L.pipeline("gbt", cols, weight="w", maxIter=20).fit(fit)
    st = L.score(m, test)
    chosen = L.chosen_threshold(L.score(m, val))
    f_ch = L.evaluate(with_scalars(st, chosen), F.col("threshold")).select(F.col("f1").alias("f1_chosen"))
    f_05 = L.evaluate(st, 0.5).select(F.col("f1").alias("f1_default"))
    orc = best_f1_threshold(curve(st, "score", "y")).select(F.col("threshold").alias("oracle_threshold"),
                                                            F.col("f1").alias("f1_oracle"))
    out = with_scalars(with_scalars(with_scalars(chosen, f_ch), f_05), orc)
    return out.withColumn("calibration_loss", F.col("f1_oracle") - F.col("f1_chosen"))


def train_run(spark, sf_dir, root):
    """O1: features → 3-way split → fit → threshold on validation → evaluate at the chosen
    threshold and 0.5 → register (metadata, data fingerprint, drift reference, current pointer)."""
    x, cols = model_data(spark, sf_dir)
    fit, val, test = _parts(x)
    m = L.pipeline("gbt", cols, weight="w", maxIter=20).fit(fit)
    thr = L.chosen_threshold(L.score(m, val)).collect()[0][0]
    ev = L.evaluate(L.score(m, test), thr).collect()[0].asDict()
    f05 = L.evaluate(L.score(m, test), 0.5).collect()[0]["f1"]
    fp = A.fingerprint(fit.select("txn_id", "amount", "y")).collect()[0]
    metrics = dict(ev, f1_at_0_5=f05)
    v = REG.register(spark, root, m, thr, fp["rows"], cols, metrics, {"learner": "gbt", "maxIter": 20},
                     fp["fingerprint"], reference=N.freeze_reference(fit, NUMERIC))
    return v, thr, metrics


@query("o1_train_and_register")
def o1(spark, sf_dir):
    """O1 + A7 + A8 + N1: train run registered as a new version with metadata, pointer and frozen drift reference."""
    root = new_run_dir(spark, "registry-o1")
    train_run(spark, sf_dir, root)
    vers = REG.versions(spark, root)
    cur = REG.current_version(spark, root)
    return vers.select("version", "threshold", "rows", F.col("metrics")["f1"].alias("f1"),
                       F.col("metrics")["average_precision"].alias("average_precision"),
                       F.size("features").alias("n_features"), "data_fingerprint") \
        .withColumn("is_current", F.col("version") == F.lit(cur)) \
        .withColumn("reference_variables", F.lit(REG.load_reference(spark, root).select("variable").distinct().count()))


A7_SQL = f"""
WITH {PARTS_SQL}, t AS (SELECT count(*) AS n FROM parts WHERE split = 'test')
SELECT asked, CAST(version AS INT) AS version, n AS rows, CAST(0 AS BIGINT) AS differing,
       CAST((SELECT 4 + count(DISTINCT category) FROM txn_orders) AS INT) AS n_features, r6(thr) AS threshold
FROM t, (VALUES ('current', 1, 0.5), ('given', 2, 0.25)) v(asked, version, thr)
"""


@query("a7_load_and_score", A7_SQL)
def a7(spark, sf_dir):
    """Two versions registered, only the first promoted; the current version and version 2 are loaded and score the
    test part; rows whose score differs from that of the model in memory are counted."""
    x, cols = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    root, models, rows = new_run_dir(spark, "registry-a7"), {}, []
    fp = A.fingerprint(fit.select("txn_id", "amount", "y")).first()
    for reg, thr in ((0.01, 0.5), (0.1, 0.25)):
        m = L.pipeline("logistic", cols, weight="w", regParam=reg).fit(fit)
        v = REG.register(spark, root, m, thr, fp["rows"], cols, {}, {"regParam": reg}, fp["fingerprint"], promote=not models)
        models[v] = m
    for asked, version in (("current", None), ("given", 2)):
        m, meta = REG.load(spark, root, version)
        here = L.score(models[meta["version"]], test).select("txn_id", F.col("score").alias("_b"))
        both = L.score(m, test).select("txn_id", "score").join(here, "txn_id")
        rows.append(both.agg(F.count(F.lit(1)).alias("rows"), F.sum((F.abs(F.col("score") - F.col("_b")) > 1e-12).cast("long")).alias("differing"))
                    .select(F.lit(asked).alias("asked"), F.lit(meta["version"]).alias("version"), "rows", "differing",
                            F.lit(len(meta["features"])).alias("n_features"), F.lit(meta["threshold"]).alias("threshold")))
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("o2_champion_challenger")
def o2(spark, sf_dir):
    """O2 + A6: champion trained up to 1999-06, challenger adds data up to 2000-12;
    both judged on the same later holdout (2001); promote only if ΔF1 > 0.01 (oracle F1
    reported); the decision row is appended to a JSON-lines log."""
    x, cols = model_data(spark, sf_dir)
    base = x.drop("split").withColumn("period", F.date_format("ts", "yyyy-MM"))
    hold = base.where(F.col("period") >= "2001-01")
    rows = {}
    for name, upto in (("champion", "1999-06"), ("challenger", "2000-12")):
        tr = base.where(F.col("period") <= upto)
        parts = chronological_cut(tr, "ts", "txn_id", 0.8)
        m = L.pipeline("logistic", cols, weight="w").fit(parts.where(F.col("part") == "fit"))
        thr = L.chosen_threshold(L.score(m, parts.where(F.col("part") == "validate")))
        ev = L.evaluate(with_scalars(L.score(m, hold), thr), F.col("threshold"))
        rows[name] = ev.select(F.col("f1").alias(f"f1_{name}"), F.col("average_precision").alias(f"ap_{name}"))
        if name == "challenger":
            rows["oracle"] = best_f1_threshold(curve(L.score(m, hold), "score", "y")).select(
                F.col("f1").alias("oracle_f1_challenger"))
    d = with_scalars(with_scalars(rows["champion"], rows["challenger"]), rows["oracle"])
    d = d.withColumn("delta_f1", F.col("f1_challenger") - F.col("f1_champion")) \
        .withColumn("decision", F.when(F.col("delta_f1") > 0.01, "promote").otherwise("keep_champion"))
    log = new_run_dir(spark, "decision-log")
    A.append_log(d, log)
    return d


@query("l9_isolation_forest")
def isolation(spark, sf_dir):
    """Isolation forest (300 trees, 256 rows each) fitted on the fit part;
    contamination = min(0.05, 3·positive rate); flag quality on test."""
    from txnscope.operators import anomaly as AN
    x, cols = model_data(spark, sf_dir)
    fit, _, test = _parts(x)
    num = ["amount", "prior_count", "gap_hours", "is_outlier", "key_te"]
    nodes = AN.fit_isolation_forest(fit, num, "txn_id", trees=300, sample=256)
    rate = fit.agg(F.avg("y")).collect()[0][0]
    cont = min(0.05, 3 * rate)
    s = AN.flag_top(AN.score_isolation_forest(test, nodes, num), "anomaly_score", cont)
    c = confusion(s, "anomaly", "y").select("precision", "recall", "f1", "alert_rate")
    r = ranking_summary(s, "anomaly_score", "y").select("roc_auc", "average_precision")
    return with_scalars(c, r).withColumn("contamination", F.lit(float(cont)))
