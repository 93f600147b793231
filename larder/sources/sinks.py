"""Writers: tables, metric tables, split tables and fitted models.

``replace_partitions`` and ``read_committed`` belong together: a table is readable only while its marker lies beside
its files, and the marker goes before a write begins and comes back, with the schema in it, when the write is done. A
reader meets a whole table or an error, never half a write.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.linear import Linear

MARKER = "_larder_committed"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite a table. CSV has a header and no index; parquet is the form for intermediates."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric rows as JSON lines. The table has a row per model and fold or class, so one file will do."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """A table with its split column, laid out so that one side can be read alone."""
    write_table(df, path, partition_by=(split,))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _marker(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MARKER}")
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Write a partitioned table, replacing only the partitions that ``df`` has rows for.

    Further writes must bring the same columns and types; a first write that broke off may be repeated.
    """
    spark = df.sparkSession
    marker, files = _marker(spark, path)
    if files.exists(marker):
        held = committed_schema(spark, path)
        got = {f.name: f.dataType for f in df.schema.fields}
        if got != {f.name: f.dataType for f in held.fields}:
            raise ValueError(f"the table at {path} has other columns or types")
        files.delete(marker, False)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    out = files.create(marker, True)
    out.write(bytearray(json.dumps({"schema": df.schema.jsonValue(), "format": fmt}).encode("utf-8")))
    out.close()


def _committed(spark: SparkSession, path: str) -> dict:
    marker, files = _marker(spark, path)
    if not files.exists(marker):
        raise ValueError(f"no committed table at {path}")
    stream = files.open(marker)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def committed_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(_committed(spark, path)["schema"])


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``replace_partitions`` with the types that were written; an error while a write is under way."""
    held = _committed(spark, path)
    reader = spark.read.schema(T.StructType.fromJson(held["schema"])).format(held["format"])
    return (reader.option("header", True) if held["format"] == "csv" else reader).load(path)


def read_split(spark: SparkSession, path: str, side: str, split: str = "split", schema: T.StructType | None = None) -> DataFrame:
    """One side of a table of ``write_split``; the files of the other side are not opened."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(F.col(split) == side)


def read_metrics(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_linear(model: Linear, df: DataFrame, path: str, target: str) -> None:
    """A linear model with the names and types of the columns it was fitted on."""
    kinds = dict(df.dtypes)
    row = (list(model.features), [kinds[c] for c in model.features], list(model.coefficients), model.intercept, model.n, target)
    schema = "features array<string>, types array<string>, coefficients array<double>, intercept double, n bigint, target string"
    df.sparkSession.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(path)


def load_linear(spark: SparkSession, path: str, rows: DataFrame | None = None) -> Linear:
    """A saved linear model. If the rows to be scored are given, their columns must fit the model: a missing feature or one
    of another kind (text for a number, say) is an error that names it."""
    schema = "features array<string>, types array<string>, coefficients array<double>, intercept double, n bigint, target string"
    row = spark.read.schema(schema).json(path).first()
    if row is None:
        raise ValueError(f"no model at {path}")
    if rows is not None:
        kinds = dict(rows.dtypes)
        missing = [c for c in row["features"] if c not in kinds]
        if missing:
            raise ValueError(f"features are missing: {', '.join(missing)}")
        other = [c for c, kind in zip(row["features"], row["types"], strict=True) if (kind == "string") != (kinds[c] == "string")]
        if other:
            raise ValueError(f"features of another kind than the model's: {', '.join(other)}")
    return Linear(tuple(row["features"]), row["intercept"], tuple(row["coefficients"]), row["n"])
