"""Neighbour-based mutual information against all distances."""

import math

import numpy as np
import pytest

GRID = 1e-6


def psi(n: int) -> float:
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def by_all_distances(x, y, k=3):
    x = np.round(np.asarray(x) / GRID).astype(np.int64)
    y = np.asarray(y)
    keep = np.isin(y, [c for c in set(y.tolist()) if (y == c).sum() > 1])
    x, y = x[keep], y[keep]
    terms = []
    for i in range(len(x)):
        others = np.sort(np.abs(x[(y == y[i]) & (np.arange(len(x)) != i)] - x[i]))
        d, kd = others[min(k, len(others)) - 1], min(k, len(others))
        gaps = np.abs(x - x[i])
        if d == 0:
            kd, m = (gaps[y == y[i]] == 0).sum(), (gaps == 0).sum()
        else:
            m = (gaps < d).sum()
        terms.append(psi(kd) - psi((y == y[i]).sum()) - psi(m))
    return max(0.0, psi(len(x)) + float(np.mean(terms)))


@pytest.mark.parametrize("block", [3, 7, 100_000])
def test_neighbour_information_equals_all_distances(spark, block):
    from txnscope.operators.stats import neighbour_information

    rng = np.random.default_rng(11)
    n = 400
    y = (rng.random(n) < 0.1).astype(int)
    y[:1] = 2  # a class with one row is left out
    cols = {"apart": rng.normal(0, 1, n) + 3 * y, "cents": np.round(rng.gamma(2, 2, n), 1), "whole": rng.integers(0, 4, n) * 1.0,
            "one": np.zeros(n), "unrelated": rng.normal(0, 1, n)}
    rows = [(int(y[i]), *[float(v[i]) for v in cols.values()]) for i in range(n)]
    df = spark.createDataFrame(rows, ["y", *cols]).repartition(5)
    got = {r["variable"]: r["mutual_info"] for r in neighbour_information(df, list(cols), block=block).collect()}
    assert set(got) == set(cols)
    for c, v in cols.items():
        assert got[c] == pytest.approx(by_all_distances(v, y), abs=1e-9), c
    assert got["apart"] > 0.1 and got["one"] == pytest.approx(0, abs=1e-9)


def test_neighbour_information_odd_rows(spark):
    from txnscope.operators.stats import neighbour_information

    df = spark.createDataFrame([(0, 1.0), (0, None), (0, float("nan")), (1, 5.0), (1, 5.5), (None, 9.0)], "y int, a double")
    got = neighbour_information(df, ["a"]).collect()
    assert got[0]["mutual_info"] == pytest.approx(by_all_distances([1.0, 0, 0, 5.0, 5.5], [0, 0, 0, 1, 1]), abs=1e-9)
    assert neighbour_information(df.where("false"), ["a"]).count() == 0
    assert neighbour_information(df.where("y = 1 AND a = 5.0"), ["a"]).count() == 0
    with pytest.raises(ValueError):
        neighbour_information(df, ["a"], block=2)


def test_digamma(spark):
    from pyspark.sql import functions as F
    from txnscope.operators.stats import digamma

    for r in spark.range(1, 2000, 37).select("id", digamma(F.col("id")).alias("psi")).collect():
        assert math.isclose(r["psi"], psi(r["id"]), abs_tol=1e-11)
