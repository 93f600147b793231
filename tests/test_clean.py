"""Edge rows of parsing, naming, filters and sources."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.functions import scalars as S
from larder.operators import clean as P
from larder.sources import sinks, tables


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build("x").alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("31/02/2024", None), ("5-3-2024", date(2024, 3, 5)), ("05/03/2024", date(2024, 3, 5)),
        ("2024-03-05", date(2024, 3, 5)), (" 05-03-2024 ", date(2024, 3, 5)), ("soon", None), (None, None),
    ],
)
def test_parse_date(spark, text, want):
    assert one(spark, text, S.parse_date) == want


@pytest.mark.parametrize("text, want", [("12%", 12.0), ("12", 12.0), (" 12 %", 12.0), (None, None), ("n/a", None), ("nan", None)])
def test_percent(spark, text, want):
    assert one(spark, text, S.percent) == want


def test_percent_share(spark):
    assert one(spark, "10%", lambda c: S.percent(c, 100)) == pytest.approx(0.1)


def test_date_text_keeps_unparseable_text(spark):
    assert one(spark, " soon ", lambda c: S.date_text(S.parse_date(c), c)) == "soon"


def test_half_even_and_whole(spark):
    got = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double").select(S.whole("x")).collect()
    assert [r[0] for r in got] == [0, 2, 2, 0]


def test_leap_day_with_year(spark):
    df = spark.createDataFrame([(date(2024, 2, 29), 2025), (date(2024, 2, 29), 2028), (date(2024, 2, 29), None)], "d date, y int")
    assert [r[0] for r in df.select(S.with_year("d", "y")).collect()] == [None, date(2028, 2, 29), date(2024, 2, 29)]


def test_null_date_is_no_month_start(spark):
    parts = S.time_parts("d")
    got = spark.createDataFrame([(None,)], "d date").select(parts["is_month_start"], parts["is_month_end"]).first()
    assert tuple(got) == (0, 0)


def test_names():
    assert P.canonical_name("  Sales Date (UTC) ") == "sales_date_utc"
    assert P.canonical_name("Événement", ascii_only=False) == "événement"
    assert P.detect(["order_date", "x"], ["date", "order_date"]) == "order_date"
    assert P.detect(["my_date_col"], ["date"]) == "my_date_col"
    assert P.detect(["my_date_col"], ["date"], substring=False) is None


def test_date_column_found_by_content(spark):
    df = spark.createDataFrame([("a", "01-02-2024"), ("b", "3/2/2024"), ("c", "x"), ("d", "2024-01-01"), ("e", "1-1-2024")], "k string, w string")
    assert P.find_date_column(df) == "w"
    with pytest.raises(ValueError):
        P.find_date_column(df.select("k"))


def test_conform_align_and_defaults(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert P.conform(df, ["s", "zz", "n"]).columns == ["s", "n"]
    assert P.conform(df, ["s", "zz"], "blank").first()["zz"] == ""
    assert P.conform(df, ["s", "zz"], "null").first()["zz"] is None
    assert P.align(df, ["n", "zz"], 0.0).first()["zz"] == 0.0
    assert P.default_columns(df, {"shelf_life": 30.0, "n": 5}).first().asDict() == {"n": 1, "s": "a", "shelf_life": 30.0}
    assert P.roles(df, exclude=["n"]) == ([], ["s"])
    with pytest.raises(ValueError):
        P.require_columns(df, ["missing"])


def test_min_history_drops_short_and_null_groups(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(4)] + [(None, i) for i in range(9)], "k string, v int")
    assert {r["k"] for r in P.min_history(df, ["k"], 5).collect()} == {"a"}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Milk", "Dairy", "05-03-2024", "3", None)], ", ".join(f"{c} string" for c in tables.STOCK_COLUMNS))
    sinks.write_table(df, str(tmp_path / "stock"), "csv")
    back = tables.read_table(spark, str(tmp_path / "stock"), tables.STOCK_COLUMNS)
    assert rows(back) == rows(df)
    sinks.write_table(df, str(tmp_path / "p"))
    assert rows(tables.read_table(spark, str(tmp_path / "p"), fmt="parquet")) == rows(df)


def test_params_file_and_missing_file(spark, tmp_path):
    path = tmp_path / "params.json"
    path.write_text(
        '[{"product_id": "A", "tran_parameter": {"test_size": 0.9, "estimators": 7}}, {"product_id": "B"},'
        ' {"product_id": "A", "tran_parameter": {"max_depth": 2}}]'
    )
    params = tables.read_params(spark, str(path))
    products = spark.createDataFrame([("A",), ("B",), ("C",)], "product_id string")
    got = {r["product_id"]: r for r in tables.with_params(products, params).collect()}
    assert got["A"]["max_depth"] == 2 and got["A"]["n_estimators"] == 120  # the last entry counts
    assert got["B"]["n_estimators"] == 120 and got["C"]["test_size"] == pytest.approx(0.1)
    none = tables.read_params(spark, str(tmp_path / "absent.json"))
    assert none.count() == 0
    assert tables.with_params(products, none).filter("max_depth = 5").count() == 3


def test_weather_document(spark):
    doc = (
        '{"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_min": [1, 2], "temperature_2m_max": [3, 4],'
        ' "temperature_2m_mean": [2, 3], "rain_sum": [0.5, null], "snowfall_sum": [0, 0]}}'
    )
    got = rows(tables.weather_rows(spark.createDataFrame([(doc,)], "j string"), "j"))
    assert got == [(date(2024, 1, 1), 1.0, 3.0, 2.0, 0.5, 0.0), (date(2024, 1, 2), 2.0, 4.0, 3.0, None, 0.0)]


def test_typed_sales(spark):
    raw = spark.createDataFrame([("05-03-2024", "7", "10%", None, "x"), ("bad", "x", "n/a", "1", "0")], "date string, quantity_sold string, discount string, holiday string, event string")
    got = P.typed_sales(raw).collect()
    assert got[0].asDict() == {"date": date(2024, 3, 5), "quantity_sold": 7.0, "discount": 0.1, "holiday": 0, "event": 0}
    assert got[1].asDict() == {"date": None, "quantity_sold": None, "discount": None, "holiday": 1, "event": 0}


def test_metric_and_split_writers(spark, tmp_path):
    df = spark.createDataFrame([("gbt", "MAE", 1.5)], "model string, metric string, value double")
    sinks.write_metrics(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).select("value").first()[0] == 1.5
    sinks.write_split(df.withColumn("split", F.lit("test")), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).filter("split = 'test'").count() == 1
