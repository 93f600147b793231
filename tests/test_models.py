"""Metrics, encoders, models and jobs."""

from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.operators import encode as E
from larder.operators import metrics as M
from larder.operators import models as D
from larder.plans import catalog_models
from larder.plans import forecast as B
from larder.plans import jobs as J
from larder.sources import sinks
from larder.sources.tables import DEFAULT_PARAMS, with_params

SMALL = {**DEFAULT_PARAMS, "n_estimators": 3, "max_depth": 3, "learning_rate": 0.5, "subsample": 1.0}


def test_regression_metrics_edges(spark):
    df = spark.createDataFrame(
        [("one", 2.0, 1.0), ("flat", 3.0, 3.0), ("flat", 3.0, 3.0), ("off", 3.0, 2.0), ("off", 3.0, 3.0), ("zero", 0.0, 1.0), ("zero", 0.0, 1.0)],
        "g string, y double, p double",
    )
    got = {r["g"]: r for r in M.regression_metrics(df, "y", "p", ["g"]).collect()}
    assert got["one"]["R2"] is None and got["one"]["MAPE"] == 50.0
    assert got["flat"]["R2"] == 1.0 and got["off"]["R2"] == 0.0
    assert got["zero"]["MAPE"] is None and got["zero"]["MAE"] == 1.0


def test_class_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 3), (2, 2)], "t int, c int")
    cells = M.confusion(df, "t", "c", [0, 1, 2, 3]).collect()
    assert len(cells) == 16 and sum(r["n"] for r in cells) == 5
    report = {r["label"]: r for r in M.class_report(df, "t", "c").collect()}
    assert report[3]["support"] == 0 and report[3]["f1"] == 0.0 and report[1]["precision"] == 0.5
    summary = M.class_summary(M.class_report(df, "t", "c")).first()
    assert summary["accuracy"] == pytest.approx(3 / 4)  # the prediction 3 is outside the true classes
    assert summary["macro_recall"] == pytest.approx((0.5 + 0.5 + 1 + 0) / 4)
    only = M.class_report(df.filter("t = 0 and c = 0"), "t", "c", labels=[0, 1])
    assert rows(only.select("label", "support")) == [(0, 1), (1, 0)]


def test_histogram_counts_every_row(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("r"))
    got = M.histogram(df, "r", 10)
    assert got.agg(F.sum("n"), F.max("bin"), F.min("bin")).first()[:] == (101, 10, 1)
    assert M.histogram(df.select(F.lit(2.0).alias("r")), "r", 10).agg(F.sum("n")).first()[0] == 101


def test_encoders_on_gaps_and_unseen(spark):
    df = spark.createDataFrame([(1.0, 5.0, None, "a"), (3.0, 5.0, None, "b"), (None, 5.0, None, None), (5.0, 5.0, None, "b")], "x double, flat double, empty double, c string")
    got = E.numeric_features(df, ["x", "flat"]).collect()
    assert got[2]["x"] == pytest.approx(0.0) and all(r["flat"] == 0.0 for r in got)
    assert E.medians(df, ["x", "empty"]) == {"x": 3.0, "empty": None}
    assert E.modes(df, ["c"]) == {"c": "b"}
    model = E.feature_pipeline(df, ["x", "empty"], ["c"]).fit(df)
    vec = model.transform(spark.createDataFrame([(1.0, None, "never")], "x double, empty double, c string")).first()["features"]
    assert vec.size == 5 and list(vec)[2:] == [0.0, 0.0, 0.0]  # levels a, b, missing


def planted(spark, n=400):
    data = [(f"P{i % 4}", date(2024, 1, 1) + timedelta(days=i // 4), i, float(10 * (i % 4) + i % 7)) for i in range(n)]
    df = spark.createDataFrame(data, "product_id string, date date, row_no long, quantity_sold double")
    return df.withColumns(
        {
            "category": F.when(F.col("product_id") < "P2", "x").otherwise("y"), "unit_price": F.lit(1.0), "discount": F.lit(0.1),
            "discount_price": F.lit(0.9), "shelf_life": F.lit(7.0), "holiday": F.lit(0), "event": F.lit(0),
            "event_name": F.when(F.dayofmonth("date") < 4, "Fair").otherwise(None),
            "expiry_date": F.date_add("date", 7),
        }
    )


def test_fit_save_load(spark, tmp_path):
    df = planted(spark)
    model = D.fit(df, D.ModelSpec("forest", trees=5, depth=6), "quantity_sold", ["unit_price", "row_no"], ["product_id"], scale=True)
    scored = D.score(model, df)
    mae = M.regression_metrics(scored, "quantity_sold", "prediction").first()["MAE"]
    mean = df.agg(F.avg("quantity_sold")).first()[0]
    base = df.agg(F.avg(F.abs(F.col("quantity_sold") - mean))).first()[0]
    assert mae < base / 2
    sinks.save_model(model, str(tmp_path / "m"))
    again = D.score(sinks.load_model(str(tmp_path / "m")), df)
    assert rows(again.select("row_no", "prediction")) == rows(scored.select("row_no", "prediction"))
    names = [r["feature"] for r in D.importances(model, df).collect()]
    assert len(names) == 6 and any("P1" in n for n in names)


def test_fit_spreads_rows_that_a_task_cannot_hold(spark, monkeypatch):
    df = planted(spark).coalesce(1)
    assert D.spread_rows(df, 9) is df
    monkeypatch.setattr(D, "LEAST_TASK_ROWS", 50)
    monkeypatch.setattr(D, "TASK_BYTES", 50 * 200)
    spread = D.spread_rows(df, 12)
    assert spread.rdd.getNumPartitions() == 8 and spread.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).max() <= 60
    assert rows(spread) == rows(df)
    spread.unpersist()
    held = []
    grown = D.spread_rows
    monkeypatch.setattr(D, "spread_rows", lambda r, width: held.append((width, grown(r, width).rdd.getNumPartitions())) or grown(r, width))
    model = D.fit(df, D.ModelSpec("forest", trees=2, depth=3), "quantity_sold", ["unit_price"], ["product_id"])
    assert held == [(5, 7)] and D.score(model, df).count() == 400


def test_forecast_products(spark):
    short = planted(spark).filter("row_no = 1").withColumn("product_id", F.lit("short"))
    df = planted(spark).unionByName(short)
    params = spark.createDataFrame([("P0", 0.2)], "product_id string, test_size double")
    got = B.forecast_products(df, params, "2024-06-01", 3, ["date", "row_no"], defaults=SMALL).collect()
    assert len(got) == 4 * 3 and {r["product_id"] for r in got} == {"P0", "P1", "P2", "P3"}
    assert min(r["date"] for r in got) == date(2024, 6, 2) and all(r["MAE"] is not None for r in got)
    assert B.trend_forecast(df, "2024-06-01", 3, ["date", "row_no"]).count() == 12


def test_forecast_event(spark):
    short = planted(spark).filter("row_no = 1").withColumn("product_id", F.lit("short"))
    cal = spark.createDataFrame(
        [(1, "Fair", date(2024, 6, 5), date(2024, 6, 7), 3), (2, "Fair", date(2024, 7, 1), date(2024, 7, 1), 1), (3, "Other", date(2024, 7, 1), date(2024, 7, 9), 9)],
        "row_id int, event_name string, start_date date, end_date date, duration_days int",
    )
    params = spark.createDataFrame([], "product_id string, test_size double")
    out = B.forecast_event(planted(spark).unionByName(short), cal, " fair", params, ["date", "row_no"], defaults=SMALL)
    got = out["forecast"].collect()
    assert len(got) == 4 * 4 and {r["window_index"] for r in got} == {1, 2}
    for key in {(r["product_id"], r["window_index"]) for r in got}:
        mine = [r for r in got if (r["product_id"], r["window_index"]) == key]
        assert mine[0]["window_total_forecast"] == pytest.approx(sum(r["forecast_quantity_sold"] for r in mine))
    summary = {r["product_id"]: r["error"] for r in out["metrics"].collect()}
    assert summary["short"].startswith("Not enough history (<5 rows)") and summary["P0"] is None
    assert out["event_metrics"].count() == 4


def test_event_frame_of_many_windows(spark, monkeypatch):
    last = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("b", 2)], "product_id string, shelf_life int")
    days = [(i * 7 % 40, "Fair" if i % 5 else " fair ", date(2024, 1, 1 + i % 20), date(2024, 1, 1 + (i * 3) % 25), 3) for i in range(40)]
    cal = spark.createDataFrame([*days, (99, "Other", date(2024, 7, 1), date(2024, 7, 9), 9)], "row_id int, event_name string, start_date date, end_date date, duration_days int")
    codes = spark.createDataFrame([("fair", 4), ("none", 1)], "event_name string, code int")
    columns = B.event_frame(last, cal, "FAIR", codes)
    assert isinstance(B.requested_windows(cal, "FAIR"), list)
    want = sorted(map(str, columns.collect()))
    monkeypatch.setattr(B, "FEW_WINDOWS", 7)
    many = B.event_frame(last, cal, "FAIR", codes)
    assert not isinstance(B.requested_windows(cal, "FAIR"), list) and many.schema.simpleString() == columns.schema.simpleString()
    assert sorted(map(str, many.collect())) == want and len(want) > 4 * 20
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    turned = spark.createDataFrame([(i, "Fair", date(2024, 1, 2), date(2024, 1, 1), 1) for i in range(9)], cal.schema)
    for table in (turned, turned.limit(3), turned.limit(0)):
        with pytest.raises(ValueError):
            B.event_frame(last, table, "fair", codes)
    with pytest.raises(ValueError):
        B.event_frame(last, cal, "fair", codes, manual_start="no day")
    assert B.event_frame(last, cal, "unheard", codes, manual_start="2024-03-01").count() == 4


def test_discount_and_weather_jobs(spark):
    df = planted(spark).withColumns(
        {"discount": (F.col("row_no") % 4 * 10).cast("double"), "product": F.col("product_id"), "total": F.lit(1.0), "temperature_min": F.col("row_no") % 9 * 1.0}
    )
    models, metrics = J.train_discount(df, {"forest": D.ModelSpec("forest", trees=3, depth=4)}, ["row_no"])
    assert {r["metric"] for r in metrics.collect()} == {
        "MAE", "RMSE", "R2", "MAPE", "accuracy", "macro_precision", "macro_recall", "macro_f1", "precision", "recall", "f1"
    }
    assert J.score_discount(models["forest"], df).filter("predicted_discount is not null").count() == 400
    trained = J.train_weather(df.withColumn("holiday", (F.col("row_no") % 2).cast("int")), {"lin": D.LINEAR}, ["row_no"])
    assert "holiday_1" in trained["features"] and "holiday_0" not in trained["features"]
    outlook = spark.createDataFrame([(date(2024, 6, 1), 3.0), (date(2024, 6, 2), 4.0)], "date date, temperature_min double")
    product = df.filter("row_no < 3").select("product_id", "unit_price", "discount", "discount_price", "total", "shelf_life", "holiday", "event")
    assert J.score_weather(trained["models"]["lin"], product, outlook, trained).count() == 6


def test_waste_job(spark):
    df = planted(spark).select("product_id", "category", "date", "row_no", "shelf_life", (F.col("quantity_sold") - 8).alias("waste_product_quantity"))
    out = J.train_waste(df, {"gbt": D.ModelSpec("gbt", trees=2, depth=3)}, ["row_no"], ids=["product_id"], order=["date", "row_no"])
    assert out["cv"].count() == 2 and out["cv"].filter("error is not null").count() == 0
    assert "lag_waste_product_quantity_7" in out["schema"]["generated_lag_parts"]
    future = df.filter("row_no > 380").drop("waste_product_quantity", "category")
    got = J.score_waste(out["models"]["gbt"], future, out["schema"], df.filter("row_no <= 380"), ["date", "row_no"], as_int=True)
    assert got.count() == 19 and dict(got.dtypes)["predicted_wastage"] == "int"
    with pytest.raises(ValueError):
        J.score_waste(out["models"]["gbt"], future, out["schema"], future, ["date", "row_no"])


def test_failing_fold_is_a_row(spark):
    df = planted(spark).withColumn("fold", F.lit(0))
    got = D.cross_validate(df, {"lin": D.LINEAR}, "quantity_sold", ["row_no"], folds=[0, 1]).collect()
    assert all(r["error"] and r["MAE"] is None for r in got)  # nothing to train on, nothing to test on


def test_every_product_gets_a_model_of_the_published_size(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(catalog_models.B, "forecast_products", lambda sales, params, *a, defaults, **kw: asked.append((params, defaults)))

    class Tables:
        canonical = spark.createDataFrame([(1, "10%")], "product_id int, discount string")
        params = spark.createDataFrame([("a", 0.2, 8, 3), ("b", 0.3, 200, 9)], "brand string, test_size double, n_estimators int, max_depth int")

        def table(self, name):
            return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "p_partkey int, p_brand string")

    catalog_models.m4c(Tables())
    (params, defaults), = asked
    sizes = with_params(Tables().table("part").select(F.col("p_partkey").alias("product_id")), params, defaults=defaults)
    got = {r["product_id"]: (r["test_size"], r["n_estimators"], r["max_depth"], r["learning_rate"]) for r in sizes.collect()}
    assert got == {1: (0.2, 120, 5, 0.01), 2: (0.3, 200, 9, 0.01), 3: (0.1, 120, 5, 0.01)}


def test_waste_table_is_joined_once_for_all_that_read_it(spark):
    day = date(2024, 1, 1)
    sold = [(day + timedelta(days=i % 5), f"p{i % 3}", "c" if i % 7 else None, day + timedelta(days=9 + i % 2), float(i % 4) if i % 6 else None, i % 2, 0, 8, "5-LOW" if i % 3 else "1-URGENT") for i in range(60)]

    class Tables:
        sales = spark.createDataFrame(sold, "dt date, product string, category string, expiry date, quantity_sold double, event int, holiday int, shelf_life int, priority string")

    made = catalog_models.waste_series(Tables())
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    want = catalog_models.waste_input(Tables()).withColumn("row_no", F.xxhash64(*catalog_models.WASTE_KEY))
    assert rows(made) == rows(want) and made.count() > 20
