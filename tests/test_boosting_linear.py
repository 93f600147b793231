"""Grouped boosted trees and linear models from moments."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from larder.operators import boosting as B
from larder.operators import linear as L


def plain_trees(rows, trees, depth, rate, edges, penalty=1.0):
    """Exact greedy trees on binned values; returns the predictions of the rows."""
    bins = [[None if v is None else sum(v > e for e in cuts) for v, cuts in zip(x, edges)] for x, _ in rows]
    start = round(sum(y for _, y in rows) / len(rows), 6)
    p = [start] * len(rows)
    for _ in range(trees):
        r = [round(y - q, 6) for (_, y), q in zip(rows, p)]

        def grow(mine, level):
            g, n = sum(r[i] for i in mine), len(mine)
            best = None
            if level < depth:
                for f in range(len(edges)):
                    for cut in sorted({bins[i][f] for i in mine if bins[i][f] is not None}):
                        for left_missing in (True, False):
                            left = [i for i in mine if (bins[i][f] <= cut if bins[i][f] is not None else left_missing)]
                            right = [i for i in mine if i not in set(left)]
                            if not left or not right:
                                continue
                            half = lambda part: sum(r[i] for i in part) ** 2 / (len(part) + penalty)  # noqa: B023, E731
                            gain = round(half(left) + half(right) - g * g / (n + penalty), 6)
                            key = (gain, -f, -cut, left_missing)
                            if gain > 1e-6 and (best is None or key > best[0]):
                                best = (key, left, right)
            if best is None:
                for i in mine:
                    p[i] += rate * g / (n + penalty)
                return
            grow(best[1], level + 1)
            grow(best[2], level + 1)

        grow(list(range(len(rows))), 0)
    return p


def test_trees_equal_plain_greedy_ones_in_every_group(spark):
    rng = random.Random(3)
    data, edges = [], [[1.5, 3.5, 5.5], [0.2, 0.4, 0.6, 0.8]]
    for g in range(3):
        for i in range(60 if g else 200):
            x = [None if rng.random() < 0.15 else float(rng.randint(0, 7)), None if rng.random() < 0.1 else rng.random()]
            y = float(rng.randint(0, 20) + (5 if x[0] is None else 0) + (g * 3 if (x[1] or 0) > 0.5 else 0))
            data.append((g, i, *x, y, [2, 3, 1][g], [2, 1, 3][g]))
    df = spark.createDataFrame(data, "g int, i int, a double, b double, y double, n_estimators int, max_depth int")
    model = B.fit_boosted(df.repartition(4), ["a", "b"], "y", ["g"], ["i"], {**B.DEFAULTS, "learning_rate": 0.5}, edges)
    got = {(r["g"], r["i"]): r["prediction"] for r in B.score_boosted(model, df).collect()}
    for g in range(3):
        mine = [r for r in data if r[0] == g]
        want = plain_trees([((r[2], r[3]), r[4]) for r in mine], [2, 3, 1][g], [2, 1, 3][g], 0.5, edges)
        assert np.allclose([got[g, r[1]] for r in mine], want, atol=1e-5)
    unknown = spark.createDataFrame([(9, 1.0, 1.0), (None, 1.0, 1.0)], "g int, a double, b double")
    assert {r["prediction"] for r in B.score_boosted(model, unknown).collect()} == {None}


def test_small_groups_grow_in_tasks_as_by_histograms(spark, monkeypatch):
    rng = random.Random(9)
    rows = []
    for g in range(70):
        for i in range([1, 3, 30, 90][g % 4]):
            x = [None if rng.random() < 0.1 else float(rng.randint(0, 9)) for _ in range(3)]
            rows.append((f"g{g}" if g else None, i, *x, round(rng.random() * 50 + (x[0] or 20.0), 2), g % 5, 1 + g % 4, 0.6 + g % 2 * 0.4))
    df = spark.createDataFrame(rows, "g string, i int, a double, b double, c double, y double, n_estimators int, max_depth int, subsample double")
    def trees():
        model = B.fit_boosted(df.repartition(3), ["a", "b", "c"], "y", ["g"], ["i"], {**B.DEFAULTS, "colsample_bytree": 0.6})
        return sorted(model.trees.collect())
    monkeypatch.setattr(B, "SMALL_ROWS", 0)
    want = trees()
    monkeypatch.setattr(B, "SMALL_ROWS", 40)
    assert len(want) == 69 and trees() == want
    monkeypatch.setattr(B, "SMALL_ROWS", 90)
    monkeypatch.setattr(B, "_one_tree", None)  # no level of a tree is a job of its own
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)  # groups that lie across batches
    try:
        assert trees() == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bins_count_the_edges_below(spark):
    edges = [[-1.0, 0.0, 2.5], [], [float(i) for i in range(31)]]
    values = [None, float("nan"), -0.0, 0.0, -1.0, -0.5, 2.5, 3.0, 30.0, 31.0, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v, v, v) for v in values], "a double, b double, c double").select("*", B.binned(["a", "b", "c"], edges).alias("bins"))
    for r in df.collect():
        missing = r["a"] is None or math.isnan(r["a"])
        assert r["bins"] == [None if missing else sum(r["a"] > e for e in cuts) for cuts in edges]
    # the edges of a feature are one constant, not an expression each
    assert df._jdf.queryExecution().optimizedPlan().toString().count(">") < 31


def test_histograms_leave_a_task_as_sums(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.choice([None, "u", "v"]), rng.randrange(4, 8), f"{rng.uniform(-9e11, 9e11):.6f}", [rng.choice([None, 0, 1, 40_000]), rng.randrange(3)]) for _ in range(3_000)]
    df = spark.createDataFrame(rows, "k0 string, node int, r string, bins array<int>").withColumn("r", F.col("r").cast(B.RESIDUAL)).coalesce(1)
    want = {}
    for k, node, r, bins in rows:
        for f, b in enumerate(bins):
            g, n = want.get((k, node, f, b), (Decimal(0), 0))
            want[k, node, f, b] = (g + Decimal(r), n + 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 200)
    try:
        for most, parts in ((B.HELD_SUMS, len(want)), (50, None)):
            monkeypatch.setattr(B, "HELD_SUMS", most)
            made = df.mapInArrow(B._histogram(1, 2), "k0 string, node int, feature int, bin int, high bigint, low bigint, n bigint").collect()
            got = {}
            for r in made:
                g, n = got.get(tuple(r[:4]), (Decimal(0), 0))
                got[tuple(r[:4])] = (g + (r["high"] * (1 << B.LOW_BITS) + r["low"]) / Decimal(10**6), n + r["n"])
            assert got == want and parts in (None, len(made))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_missing_values_carry_a_signal(spark):
    rng = random.Random(5)
    rows = [(i, None if i % 3 == 0 else rng.random(), rng.random(), 50.0 if i % 3 == 0 else 10.0 + rng.random()) for i in range(600)]
    rows += [(i, float("nan"), 0.5, 50.0) for i in range(600, 630)] + [(700, 0.1, 0.1, None)]
    df = spark.createDataFrame(rows, "i int, a double, noise double, y double")
    model = B.fit_boosted(df, ["noise", "a"], "y", defaults={**B.DEFAULTS, "n_estimators": 12, "max_depth": 2, "learning_rate": 0.5})
    scored = B.score_boosted(model, df).where("y is not null")
    assert scored.agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0] < 2.5
    assert scored.count() == 630


def test_samples_are_drawn_by_hash(spark):
    df = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 7 * 3 + F.col("id") % 5).cast("double").alias("y"))
    few = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.6, "colsample_bytree": 0.5}
    one = B.fit_boosted(df, ["a", "b"], "y", row_key=["id"], defaults=few)
    two = B.fit_boosted(df.repartition(7), ["a", "b"], "y", row_key=["id"], defaults=few)
    assert one.trees.collect() == two.trees.collect()
    used = [{n["feature"] for n in tree if n and n["feature"] is not None} for tree in one.trees.first()["trees"]]
    assert all(len(u) <= 1 for u in used) and set().union(*used) == {0, 1}  # one column per tree, not always the same
    mean = df.agg(F.avg("y")).first()[0]
    off = B.score_boosted(one, df).agg(F.avg(F.abs(F.col("y") - F.col("prediction"))), F.avg(F.abs(F.col("y") - mean))).first()
    assert off[0] < off[1] * 0.6


def test_flat_and_tiny_groups(spark):
    df = spark.createDataFrame([("one", 1.0, 5.0), ("flat", 1.0, 2.0), ("flat", 2.0, 2.0), ("gaps", None, 1.0), ("gaps", None, 3.0), (None, 1.0, 1.0)], "g string, a double, y double")
    model = B.fit_boosted(df, ["a"], "y", ["g"], defaults={**B.DEFAULTS, "n_estimators": 2, "max_depth": 2})
    got = {r["g"]: r["prediction"] for r in B.score_boosted(model, df).collect()}
    assert got == {"one": 5.0, "flat": 2.0, "gaps": 2.0, None: None}
    none = B.fit_boosted(df.limit(0), ["a"], "y", ["g"])
    assert none.trees.collect() == [] and B.score_boosted(none, df).where("prediction is not null").count() == 0


# ---------------------------------------------------------------- linear


def linear_rows(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 50, (n, 3)).astype(float)
    y = np.round(3 + 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=n), 4)
    return x, y


def test_moments_give_least_squares(spark):
    x, y = linear_rows()
    rows = [(*map(float, a), float(b), i % 4) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0, 1.0, 0), (1.0, 1.0, 1.0, None, 0)], "a double, b double, c double, y double, fold int")
    model = L.fit_linear(df, ["a", "b", "c"], "y")
    want = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]
    assert np.allclose([model.intercept, *model.coefficients], want) and model.n == len(y)
    assert L.score_linear(model, df).where("a is null").first()["prediction"] is None
    twice = L.fit_linear(df.withColumn("d", F.col("a") * 2).withColumn("k", F.lit(7.0)), ["a", "d", "k", "b"], "y")
    assert twice.coefficients[1] == 0.0 and twice.coefficients[2] == 0.0  # told by the others, and constant
    with pytest.raises(ValueError):
        L.fit_linear(df.limit(0), ["a"], "y")


def test_moments_are_exact_and_multiplied_in_lots(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "u", "v"]), rng.choice([None, 1, 2]), rng.uniform(-1e9, 1e9), rng.choice([0.0, -0.0, 1e-6, -7.5])) for _ in range(9_000)]
    df = spark.createDataFrame([*rows, ("u", 1, None, 1.0)], "g string, h int, a double, y double").coalesce(1)
    made = L.moments(df, ["a"], "y", ["g", "h"])
    # a row leaves the scan once per batch and group, not as a decimal product per pair of columns
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
    got = {(r["g"], r["h"]): L.as_moments(r, ["a"], "y") for r in made.collect()}
    six = Decimal("0.000001")
    want = {}
    with localcontext() as exact:
        exact.prec = 60
        for g, h, a, y in rows:
            a, y = (Decimal(repr(v)).quantize(six, ROUND_HALF_UP) for v in (a, y))
            n, *sums = want.get((g, h), (0, 0, 0, 0, 0, 0))
            want[g, h] = (n + 1, *(s + v for s, v in zip(sums, (a, y, a * a, a * y, y * y))))
    assert len(got) == 9
    assert {k: (m.n, *m.sums, m.products[0][0], m.products[0][1], m.products[1][1]) for k, m in got.items()} == want


@pytest.mark.parametrize("expanding", [True, False])
def test_folds_by_algebra_equal_fits_of_their_own(spark, expanding):
    x, y = linear_rows(300, 2)
    rows = [(*map(float, a), float(b), i // 75) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double, fold int")
    models = {"one": ["b"], "all": ["a", "b", "c"]}
    got = {(r["model"], r["fold"]): r for r in L.cross_validate_linear(df, models, "y", "fold", [0, 1, 2, 3, 4], expanding).collect()}
    fold = np.array([r[4] for r in rows])
    for name, cols in {"one": [1], "all": [0, 1, 2]}.items():
        for f in range(4):
            train = fold < f if expanding else fold != f
            if not train.any():
                assert got[name, f]["error"] == "no rows to train on" and got[name, f]["MAE"] is None
                continue
            design = np.column_stack([np.ones(len(y)), x[:, cols]])
            b = np.linalg.lstsq(design[train], y[train], rcond=None)[0]
            off = y[fold == f] - design[fold == f] @ b
            row = got[name, f]
            assert row["n"] == 75 and row["error"] is None
            assert math.isclose(row["MAE"], np.abs(off).mean(), rel_tol=1e-9) and math.isclose(row["RMSE"], math.sqrt((off**2).mean()), rel_tol=1e-9)
            assert math.isclose(row["R2"], 1 - (off**2).sum() / ((y[fold == f] - y[fold == f].mean()) ** 2).sum(), rel_tol=1e-9)
        assert got[name, 4]["error"] == "no rows to test"
