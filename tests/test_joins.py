"""Waste, weather and calendar joins on edge rows."""

from datetime import date

import pytest
from conftest import rows

from larder.operators import calendar as C
from larder.operators import waste as W
from larder.operators.weather import join_weather

SALES = "date date, expiry_date date, category string, product string, event int, holiday int, shelf_life int, quantity_sold double"
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 9)


def sales(spark):
    return spark.createDataFrame(
        [
            (D1, D3, "dairy", "milk", 0, 0, 7, 2.0), (D1, D3, "dairy", "milk", 0, 0, 7, 3.0), (D2, D3, "dairy", "milk", 1, 0, 7, 4.0),
            (D2, D3, "dairy", "curd", 0, 0, 7, None), (D2, None, "dairy", "milk", 0, 0, 7, 9.0), (D2, D3, None, "milk", 0, 0, 7, 9.0),
        ],
        SALES,
    )


def test_sold_by_expiry(spark):
    got = W.sold_by_expiry(sales(spark)).select("product", "date", "event", "total_quantity_sold", "remaining_shelf_life")
    assert rows(got) == [("curd", D2, 0, 0.0, 7), ("milk", D1, 0, 9.0, 8), ("milk", D2, 1, 9.0, 7)]
    assert rows(W.sum_by_expiry(sales(spark)).select("product", "total_quantity_sold")) == [("curd", 0.0), ("milk", 9.0)]


def test_waste_modes_and_duplicate_stock(spark):
    sold = W.sold_by_expiry(sales(spark))
    stock = spark.createDataFrame([("milk", "dairy", D3, "12", 5), ("milk", "dairy", D3, "9", 6)], "product string, category string, expiry_date date, quantity string, event int")
    got = W.waste_table(sold, stock)
    assert got.columns == list(W.WASTE_COLUMNS)
    assert sorted(r["waste_product_quantity"] for r in got.filter("product = 'milk'").collect()) == [0.0, 0.0, 3.0, 3.0]
    assert {r["event"] for r in got.filter("product = 'milk'").collect()} == {0, 1}  # the sales side's column
    assert got.filter("product = 'curd'").first()["waste_product_quantity"] is None
    legacy = W.waste_table(sold, stock, "legacy")
    assert sorted(r["waste_product_quantity"] for r in legacy.filter("product = 'milk'").collect()) == [0.0, 0.0, 12.0, 12.0]
    with pytest.raises(ValueError):
        W.waste_table(sold, stock, "other")


def test_weather_join_matches_null_days(spark):
    left = spark.createDataFrame([(D1, 1), (D2, 2), (None, 3)], "date date, q int")
    weather = spark.createDataFrame([(D1, 5.0), (None, 7.0)], "date date, rain double")
    assert rows(join_weather(left, weather), "q") == [(D1, 1, 5.0), (D2, 2, None), (None, 3, 7.0)]


CAL = [
    ("Fair", "01-01-2024", "03-01-2024", None), ("Fair", "2/1/2024", "2/1/2024", None), ("Back", "05-01-2024", "01-01-2024", None),
    ("Open", "29-02-2024", None, "2025"), ("Long", "30-12-2023", None, None),
]


def calendar(spark, bad=False):
    extra = [("Junk", "n/a", None, None)] if bad else []
    return spark.createDataFrame([(*r, "4" if r[0] == "Long" else None) for r in CAL + extra], "`Holidays/Event` string, `Start Date` string, `End Date` string, Year string, `Duration (days)` string")


def test_load_calendar(spark):
    cal = C.load_calendar(calendar(spark), bad_start="drop")
    got = {(r["event_name"], r["start_date"]): (r["end_date"], r["duration_days"]) for r in cal.collect()}
    assert got[("Fair", D1)] == (date(2024, 1, 3), 3)
    assert got[("Back", date(2024, 1, 5))] == (D1, -3)
    assert got[("Long", date(2023, 12, 30))] == (date(2024, 1, 2), 4)
    assert not any(name == "Open" for name, _ in got)  # 29 Feb does not exist in 2025


def test_unreadable_start_fails(spark):
    with pytest.raises(Exception, match="readable start date"):
        C.load_calendar(calendar(spark, bad=True)).collect()
    with pytest.raises(ValueError):
        C.load_calendar(calendar(spark).drop("Start Date"))


def test_calendar_joins_agree(spark):
    cal = C.load_calendar(calendar(spark), bad_start="drop")
    left = spark.createDataFrame([(D1, 1), (D2, 2), (D3, 3), (None, 4)], "date date, q int")
    a = C.join_calendar(left, cal.select("event_name", "start_date", "end_date"))
    b = C.join_calendar_interval(left, cal.select("event_name", "start_date", "end_date"))
    assert rows(a.select("q", "event_name")) == [(1, "Fair"), (1, "Long"), (2, "Fair"), (2, "Fair"), (2, "Long")]
    assert rows(a.select("q", "event_name")) == rows(b.select("q", "event_name"))


def test_sales_with_events(spark):
    raw = spark.createDataFrame([("1/1/2024", "P1", "whenever"), ("junk", "P2", "2024-02-01")], "`Order Date` string, `product id` string, Expiry string")
    out = C.sales_with_events(raw, calendar(spark, bad=True))
    assert out.columns == list(C.EVENT_SALES_COLUMNS)
    assert [(r["date"], r["expiry_date"], r["unit_price"], r["event_name"]) for r in out.collect()] == [("01-01-2024", "whenever", "", "Fair")]


def test_typical_duration_takes_smallest_mode(spark):
    cal = spark.createDataFrame([("Fair ", 3), ("fair", 2), ("FAIR", 3), ("fair", 2), ("x", 9)], "event_name string, duration_days int")
    assert rows(C.typical_duration(cal)) == [("fair", 2), ("x", 9)]


def test_shuffles_follow_the_size_of_the_tables(spark, sf_dir, monkeypatch):
    from larder import session
    from larder.plans.views import Views

    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    Views(spark, sf_dir)
    assert spark.conf.get(session.PARTS, None) is None
    monkeypatch.setattr(session, "PART_BYTES", 10_000)
    try:
        df = Views(spark, sf_dir).moves.groupBy("product_id").count()
        assert int(spark.conf.get(session.PARTS)) > 5 * own and spark.conf.get(session.ADVISORY) == session.TASK_SHUFFLE
        assert df.count() > 0
    finally:
        monkeypatch.undo()
        Views(spark, sf_dir)
    assert spark.conf.get(session.PARTS, None) is None and spark.conf.get("spark.sql.shuffle.partitions") == str(own)


def test_scans_of_large_tables_are_cut_small(spark, sf_dir, monkeypatch, tmp_path):
    from larder import session
    from larder.plans.views import Views

    own = spark.conf.get(session.SPLIT)
    for i in range(6):
        spark.range(1_000).repartition(1).write.parquet(f"{tmp_path}/t/{i}")
    table = lambda: spark.read.parquet(f"{tmp_path}/t/*")
    Views(spark, sf_dir)
    assert spark.conf.get(session.SPLIT) == own
    monkeypatch.setattr(session, "PART_BYTES", 10_000)
    monkeypatch.setattr(session, "TASK_FILES", 9 << 20)
    few = "spark.sql.files.minPartitionNum"
    spark.conf.set(few, "1")
    try:
        assert table().rdd.getNumPartitions() == 1
        Views(spark, sf_dir)
        Views(spark, sf_dir)
        # a file counts as 4 MB more than it has, so three go together
        assert table().rdd.getNumPartitions() == 2
    finally:
        spark.conf.unset(few)
        monkeypatch.undo()
        Views(spark, sf_dir)
    assert spark.conf.get(session.SPLIT) == own and spark.conf.get(session.SPLIT_SIZED, None) is None
