"""Series, ranks, bins and splits against pandas and brute force on small tables, hot groups included."""

import random
import tempfile
import time
from datetime import date, timedelta

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.operators import features as X
from larder.operators import ordered as O
from larder.operators import splits as T
from larder.session import materialize

SCHEMA = "id string, day date, tie long, x double"


def table(n=600, seed=1, hot=0.7, days=12):
    """One id holds most rows and one of its days is crowded; some ids, days and values are NULL."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", None])
        day = date(2024, 1, 1) + timedelta(days=3 if rng.random() < 0.5 else rng.randrange(days))
        out.append((key, day, i * 7 % n, rng.choice([None, float(rng.randrange(20))])))
    return out


def expected(data, exclude_current=False):
    pdf = pd.DataFrame(data, columns=["id", "day", "tie", "x"]).sort_values(["id", "day", "tie"], na_position="last")
    g = pdf.groupby("id", sort=False)["x"]
    pdf["lag1"], pdf["lag3"] = g.shift(1), g.shift(3)
    past = (lambda s: s.shift(1)) if exclude_current else (lambda s: s)
    pdf["mean"] = pdf.groupby("id", sort=False)["x"].transform(lambda s: past(s).rolling(5, min_periods=2).mean())
    return {r.tie: tuple(None if pd.isna(v) else round(v, 9) for v in (r.lag1, r.lag3, r.mean)) for r in pdf.itertuples()}


@pytest.mark.parametrize("hot_rows", [20, 60, 10**6])
@pytest.mark.parametrize("exclude", [False, True])
def test_lags_and_means_equal_pandas(spark, hot_rows, exclude):
    data = table()
    df = spark.createDataFrame(data, SCHEMA)
    got = X.add_lag_rolling(df, ["id"], ["day", "tie"], "x", (1, 3), (5,), exclude, hot_rows)
    out = {r["tie"]: tuple(None if v is None else round(v, 9) for v in (r["lag_x_1"], r["lag_x_3"], r["rmean_x_5"])) for r in got.collect()}
    want = expected(data, exclude)
    known = {r[2] for r in data if r[0] is not None}
    assert len(out) == len(data)
    assert all(out[t] == want[t] for t in known)
    assert all(out[t] == (None, None, None) for t in out.keys() - known)


def test_sparse_chunks_reach_back_over_many_days(spark):
    data = [("hot", date(2024, 1, 1) + timedelta(days=i // 2), i, float(i)) for i in range(60)]
    df = spark.createDataFrame(data, SCHEMA)
    got = X.add_lag_rolling(df, ["id"], ["day", "tie"], "x", (28,), (), hot_rows=5)
    assert all(r["lag_x_28"] == (r["x"] - 28 if r["x"] >= 28 else None) for r in got.collect())


def test_future_rows_equal_the_union(spark):
    data = table(200)
    df = spark.createDataFrame(data, SCHEMA).filter("id is not null")
    start = F.lit("2024-01-08").cast("date")
    history, future = df.filter(F.col("day") < start), df.filter(F.col("day") >= start).drop("x")
    got = X.add_lag_rolling_future(future, history, ["id"], ["day", "tie"], "x", lags=(1,), rolls=(3,))
    whole = X.add_lag_rolling(df.withColumn("x", F.when(F.col("day") < start, F.col("x"))), ["id"], ["day", "tie"], "x", (1,), (3,))
    cols = ["tie", "lag_x_1", "rmean_x_3"]
    assert rows(got.select(*cols)) == rows(whole.filter(F.col("day") >= start).select(*cols))


@pytest.mark.parametrize("hot_rows", [15, 10**6])
def test_positions(spark, hot_rows):
    data = table(300)
    got = O.positions(spark.createDataFrame(data, SCHEMA), ["id"], ["day", "tie"], hot_rows=hot_rows).collect()
    for key in ("hot", "a", "b"):
        mine = sorted((r["day"], r["tie"]) for r in got if r["id"] == key)
        assert {(r["day"], r["tie"]): (r["pos"], r["n"]) for r in got if r["id"] == key} == {k: (i + 1, len(mine)) for i, k in enumerate(mine)}
    assert all(r["pos"] is None for r in got if r["id"] is None)


def test_global_positions(spark):
    data = table(300)
    got = O.positions(spark.createDataFrame(data, SCHEMA), [], ["day", "tie"], hot_rows=20).collect()
    order = sorted((r["day"], r["tie"]) for r in got)
    assert all(order[r["pos"] - 1] == (r["day"], r["tie"]) and r["n"] == 300 for r in got)


@pytest.mark.parametrize("values", [[1.5, -3.0, 0.0, 2.5, 1e9, 2.5, 2.5, None], [7.0], [float(i * i % 97) for i in range(80)]])
def test_exact_quantiles(spark, values):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v, None) for v in values], "v double, empty double")
    got = O.quantile_values(df, ["v", "empty"], probs)
    assert got.keys() == {"v"}
    assert got["v"] == pytest.approx(list(pd.Series(values, dtype=float).quantile(probs)))


@pytest.mark.parametrize("values", [[1.0] * 15 + [5.0] * 5, [3.0] * 4, [float(i % 11) for i in range(50)], [0.1 * i for i in range(33)]])
def test_qcut_and_ranks_equal_pandas(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    s = pd.Series(values)
    bins = pd.qcut(s, 5, labels=False, duplicates="drop")
    if bins.dropna().nunique() < 2:
        bins = pd.qcut(s, 2, labels=False, duplicates="drop")
    got = {r["i"]: r["bin"] for r in X.qcut(df, "v", 5).collect()}
    assert [got[i] for i in range(len(values))] == list(bins.fillna(0).astype(int))
    pct = s.rank(method="average", pct=True)
    ranked = X.percent_rank_average(df, "v")
    shares = {r["i"]: r["pct"] for r in ranked.collect()}
    assert [shares[i] for i in range(len(values))] == pytest.approx(list(pct))
    cut = {r["i"]: r["bin"] for r in X.equal_width_bins(ranked, "pct", 5).collect()}
    assert [cut[i] for i in range(len(values))] == list(pd.cut(pct, 5, labels=False, include_lowest=True))


def test_label_codes_and_events(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "k string")
    assert rows(X.code_table(df, "k")) == [("a", 0), ("b", 1), ("c", 2)]
    codes = spark.createDataFrame([("fair", 0), ("none", 1)], "event_name string, code int")
    asked = spark.createDataFrame([(" FAIR",), ("none",), ("unseen",)], "event_name string")
    got = {r["event_key"]: (r["event_code"], r["event_flag"], r["canonical_name"]) for r in X.event_codes(asked, codes).collect()}
    assert got == {"fair": (0, 1.0, "fair"), "none": (1, 0.0, "none"), "unseen": (1, 1.0, "none")}


def test_last_known_keeps_null(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("b", 1, 3.0)], "k string, t int, v double")
    assert rows(X.last_known(df, ["k"], ["t"], ["v"])) == [("a", None), ("b", 3.0)]


def test_splits_are_complete_and_disjoint(spark):
    df = spark.createDataFrame(table(300), SCHEMA)
    for out in (T.hash_split(df, ["tie"], 0.3), T.group_split(df, "id", 0.4), T.time_split(df, "day", 0.2)):
        assert out.count() == 300
        assert {r[0] for r in out.select("split").distinct().collect()} <= {"train", "test"}
    groups = T.group_split(df, "id", 0.4).groupBy("id").agg(F.countDistinct("split").alias("n"))
    assert groups.filter("n > 1").count() == 0
    late = T.time_split(df, "day", 0.2)
    assert late.filter("split = 'test'").agg(F.min("day")).first()[0] > late.filter("split = 'train'").agg(F.max("day")).first()[0]


def test_tail_split_rounds_up(spark):
    df = spark.createDataFrame([("a", date(2024, 1, 1), i, 0.0) for i in range(30)] + [("b", date(2024, 1, 1), i, 0.0) for i in range(7)], SCHEMA)
    for hot_rows in (3, 1000):
        test = T.tail_split(df, ["id"], ["day", "tie"], 0.1, hot_rows=hot_rows).filter("split = 'test'")
        assert rows(test.select("id", "tie")) == [("a", 27), ("a", 28), ("a", 29), ("b", 6)]


def test_folds(spark):
    df = spark.createDataFrame(table(100), SCHEMA).filter("x is not null")
    n = df.count()
    sizes = [r["count"] for r in T.stratified_kfold(df, "x", ["tie"], 4).groupBy("fold").count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 5
    blocks = T.time_series_blocks(df, ["day", "tie"], 3, hot_rows=10).collect()
    z = n // 4
    counts = {b: sum(r["block"] == b for r in blocks) for b in range(4)}
    assert counts == {0: n - 3 * z, 1: z, 2: z, 3: z}
    last = {b: max((r["day"], r["tie"]) for r in blocks if r["block"] == b) for b in range(4)}
    first = {b: min((r["day"], r["tie"]) for r in blocks if r["block"] == b) for b in range(4)}
    assert all(last[b] < first[b + 1] for b in range(3))


def test_large_groups_are_split_without_a_shuffle_of_their_rows(spark):
    rng = random.Random(8)
    data = []
    for i in range(900):
        key = rng.choice(["a", "a", "a", "b", "b", "c", None])
        day = rng.choice([None, *[date(2024, 1, 1 + k) for k in range(12)], *[date(2024, 1, 5)] * 9])
        data.append((key, day, i % 400 if i % 9 else None, i, 0.3 if key == "a" else 0.1))
    df = spark.createDataFrame(data, "k string, d date, t int, u int, share double")
    want = T.tail_split(df, ["k"], ["d", "t", "u"], F.col("share"), hot_rows=None)
    for least in (1, 50, 300):
        got = T.tail_split(df, ["k"], ["d", "t", "u"], F.col("share"), hot_rows=least)
        assert rows(got) == rows(want)
    floor = {n: T.tail_split(df, ["k"], ["d", "t", "u"], 0.15, floor_train=True, hot_rows=n) for n in (None, 50)}
    assert rows(floor[None]) == rows(floor[50])
    df.write.mode("overwrite").parquet(at := tempfile.mkdtemp(prefix="larder-split-"))
    cut = T.tail_split(spark.read.parquet(at).where("k = 'a'"), ["k"], ["d", "t", "u"], 0.3, hot_rows=300)
    tree = cut._jdf.queryExecution().optimizedPlan().toString()
    # the only windows are over the day on which the test begins and over the groups that are not large
    assert tree.count("Window") <= 4 and "LeftAnti" in tree


def test_written_tables_leave_no_shuffles(spark):
    def held():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}

    before = held()
    made = materialize(spark.range(5_000).groupBy((F.col("id") % 1_000).alias("k")).count())
    for _ in range(50):
        if not held() - before:
            break
        time.sleep(0.2)
    assert not held() - before and made.count() == 1_000
