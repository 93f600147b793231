"""Files, saved models, importances, many levels and crowded tie-breaks."""

import json
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from larder.operators import clean as C
from larder.operators import encode as E
from larder.operators import importance as P
from larder.operators import linear as L
from larder.operators import ordered as O
from larder.sources import sinks, tables


def test_broken_lines_are_kept_and_marked(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text('a,b\n1,x\n2\n3,y,z\n"4,5",q\n')
    got = {r["a"]: r for r in tables.read_table(spark, str(tmp_path / "t"), ["a", "b"], corrupt="bad").cache().collect()}
    assert got["1"]["bad"] is None and got["4,5"]["b"] == "q"
    assert got["2"]["bad"] == "2" and got["2"]["b"] is None and got["3"]["bad"] == "3,y,z"


def test_partitions_are_replaced_and_half_writes_refused(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "a#/ x"), (2, "b"), (3, None)], "v int, k string")
    sinks.replace_partitions(df, path, ["k"])
    sinks.replace_partitions(spark.createDataFrame([(9, "b"), (8, "new")], "v int, k string"), path, ["k"])
    assert rows(sinks.read_committed(spark, path).select("v", "k")) == rows(spark.createDataFrame([(1, "a#/ x"), (9, "b"), (3, None), (8, "new")], "v int, k string"))
    with pytest.raises(ValueError, match="other columns"):
        sinks.replace_partitions(df.withColumn("v", F.col("v").cast("string")), path, ["k"])
    assert sinks.read_committed(spark, path).count() == 4  # the refused write changed nothing
    (tmp_path / "p" / sinks.MARKER).unlink()
    with pytest.raises(ValueError, match="no committed table"):
        sinks.read_committed(spark, path)
    sinks.replace_partitions(df, path, ["k"])  # a write that broke off is repeated
    assert sinks.read_committed(spark, path).count() == 4


def test_saved_side_and_metrics(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test"), (3, "test")], "v int, split string")
    sinks.write_split(df, str(tmp_path / "s"))
    assert sorted(r["v"] for r in sinks.read_split(spark, str(tmp_path / "s"), "test").collect()) == [2, 3]
    m = spark.createDataFrame([("a", None), ("b", 1.5)], "model string, value double")
    sinks.write_metrics(m, str(tmp_path / "m"))
    assert rows(sinks.read_metrics(spark, str(tmp_path / "m"), m.schema)) == rows(m)


def test_linear_models_check_their_features(spark, tmp_path):
    df = spark.createDataFrame([(float(i), i % 3, 2.0 * i + 1) for i in range(30)], "a double, b int, y double")
    model = L.fit_linear(df, ["a", "b"], "y")
    sinks.save_linear(model, df, str(tmp_path / "m"), "y")
    assert sinks.load_linear(spark, str(tmp_path / "m"), df) == model
    with pytest.raises(ValueError, match="missing: b"):
        sinks.load_linear(spark, str(tmp_path / "m"), df.drop("b"))
    with pytest.raises(ValueError, match="another kind.*: b"):
        sinks.load_linear(spark, str(tmp_path / "m"), df.withColumn("b", F.lit("x")))


def entries(n):
    return [{"product_id": f"P{i}", "tran_parameter": {"estimators": i, "test_size": 0.2}} for i in range(n)]


@pytest.mark.parametrize("text", [
    json.dumps(entries(500)), json.dumps(entries(500), indent=3), "[" + ",".join(json.dumps(e) for e in entries(500)) + "]\n",
    json.dumps([{**e, "tran_parameter": e["tran_parameter"], "note": "x"} for e in entries(500)]),
    json.dumps([dict(reversed(e.items())) for e in entries(500)]),  # parameters before the product: read whole
    json.dumps([{**e, "product_id": e["product_id"]} if e["product_id"] != "P7" else {"product_id": "P}7", "tran_parameter": {"estimators": 7}} for e in entries(500)]),
])
def test_parameter_lists_in_every_layout(spark, tmp_path, text):
    path = tmp_path / "params.json"
    path.write_text(text)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r["product_id"]: r["n_estimators"] for r in tables.read_params(spark, str(path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(got) == 500 and all(n == int(p.strip("P}")) for p, n in got.items())


def test_last_parameter_entry_wins_across_splits(spark, tmp_path):
    path = tmp_path / "params.json"
    many = entries(300) + [{"product_id": f"P{i}", "tran_parameter": {"estimators": 1000 + i}} for i in range(300)] + [{"product_id": "P1"}]
    path.write_text(json.dumps(many))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        read = tables.read_params(spark, str(path))
        got = {r["product_id"]: r["n_estimators"] for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got.pop("P1") is None and all(n == 1000 + int(p[1:]) for p, n in got.items()) and len(got) == 299


def test_literal_rows_and_headers(spark):
    like = spark.createDataFrame([], "a int, b string")
    assert rows(tables.literal_rows(spark, [{"a": 1}, {"b": "x"}], like)) == rows(spark.createDataFrame([(1, None), (None, "x")], "a int, b string"))
    with pytest.raises(ValueError, match="c"):
        tables.literal_rows(spark, [{"c": 1}], like)
    assert [C.canonical_name(n) for n in (" Net--Price (EUR) ", "__a__b__", "Größe")] == ["net_price_eur", "a_b", "gr_e"]
    assert C.canonical_name(" Größe__ (m²)", ascii_only=False) == "größe_m²"


def test_shuffled_features_are_permutations(spark):
    rng = random.Random(1)
    data = [(i, None if i % 11 == 0 else float(i), rng.random(), 3.0 * i) for i in range(500)]
    df = spark.createDataFrame(data, "id int, a double, noise double, y double")
    got = P.shuffled(df, ["a", "noise"], ["id"], buckets=4).collect()
    assert sorted((r["a__shuffled"] is None, r["a__shuffled"] or 0) for r in got) == sorted((r["a"] is None, r["a"] or 0) for r in got)
    assert sum(r["a"] == r["a__shuffled"] for r in got) < 60
    again = P.shuffled(df.repartition(6), ["a", "noise"], ["id"], buckets=4).collect()
    assert {r["id"]: r["noise__shuffled"] for r in again} == {r["id"]: r["noise__shuffled"] for r in got}
    model = L.fit_linear(df, ["a", "noise"], "y")
    scores = {r["feature"]: r["importance"] for r in P.permutation_importance(df.where("a is not null"), model.predict, ["a", "noise"], "y", ["id"]).collect()}
    assert scores["a"] > 100 and abs(scores["noise"]) < 1


def test_large_buckets_are_shuffled_in_pieces(spark, monkeypatch):
    rng = random.Random(2)
    data = [(i // 2, None if i % 7 == 0 else i % 5, rng.random()) for i in range(600)]  # each key twice
    df = spark.createDataFrame(data, "id int, a int, noise double")
    whole = P.shuffled(df, ["a", "noise"], ["id"], buckets=3)
    assert not re.search(r"_piece", whole._jdf.queryExecution().toString())
    monkeypatch.setattr(P, "BUCKET_ROWS", 16)
    cut = P.shuffled(df, ["a", "noise"], ["id"], buckets=3)
    by = re.findall(r"Exchange hashpartitioning\(([^)]*)", cut._jdf.queryExecution().executedPlan().toString())
    assert any("_piece" in b for b in by) and not any("_bucket" in b and "_piece" not in b for b in by)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_many_levels_without_a_driver_list(spark):
    df = spark.range(100_000).select(F.format_string("Product %07d", F.col("id") % 99_999).alias("c"), "id")
    levels = E.level_table(df, "c").cache()
    assert levels.count() == 99_999 and levels.agg(F.max("index")).first()[0] == 99_998
    asked = spark.createDataFrame([("Product 0000000",), ("Product 0099998",), ("never",), (None,)], "c string")
    got = {r["c"]: r["v"] for r in E.sparse_one_hot(asked, "c", levels, "v").collect()}
    assert got["Product 0000000"].indices.tolist() == [0] and got["Product 0099998"].indices.tolist() == [99_998]
    assert got["never"].numNonzeros() == 0 and got[None].numNonzeros() == 0 and got[None].size == 99_999
    first = {r["c"]: r["v"] for r in E.sparse_one_hot(asked, "c", levels, "v", drop_first=True).collect()}
    assert first["Product 0000000"].numNonzeros() == 0 and first["Product 0099998"].indices.tolist() == [99_997] and first[None].size == 99_998
    levels.unpersist()


def test_names_with_one_prefix_are_spread(spark):
    df = spark.range(200_000).select(F.format_string("Product %07d", "id").alias("c"))
    ranged = O.text_buckets(df, [], "c")
    sizes = [r["count"] for r in ranged.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 200_000 / len(sizes) * 2
    got = O.running_counts(df, "c").where("index <> before or total <> 200000").count()
    assert got == 0


def test_one_tie_value_that_holds_a_day(spark):
    rng = random.Random(2)
    data = [(f"2024-01-0{rng.randint(1, 2)}", rng.choice([5, 5, 5, 5, 7, None, 2]), i % 2000, i) for i in range(4000)]
    df = spark.createDataFrame(data, "d string, t int, u int, i int").withColumn("d", F.to_date("d"))
    cut = O.split_hot(df, [], ["d", "t", "u", "i"], 50.0)
    sizes = [r["count"] for r in cut.groupBy("_day", "_part").count().collect()]
    assert max(sizes) < 400  # two days by one value each held over 1,100
    got = O.positions(df, [], ["d", "t", "u", "i"], hot_rows=50).collect()
    want = sorted(got, key=lambda r: (r["d"], r["t"] is not None, r["t"] or 0, r["u"], r["i"]))
    assert [r["pos"] for r in want] == list(range(1, 4001))
