"""Helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.session import materialize, tune

WORD_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what separates words once A-Z count as a-z


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back: cuts the lineage and survives executors."""
    return materialize(df)


def forget(*frames: DataFrame) -> None:
    """Delete tables made by ``saved`` that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("larder-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(hadoop).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is. ``lower`` does the same, faster, where all is ASCII."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def raw_words(text: Column) -> Column:
    """The runs of digits, ASCII letters and characters beyond ASCII, not lower-cased; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def free(df: DataFrame, *names: str) -> list[str]:
    """Inner names that no column of the table has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


SMALL = 500_000


def small(df: DataFrame) -> DataFrame:
    """For a table on disk: with a broadcast hint if it is counted to have at most ``SMALL`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= SMALL else df


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``name``: the position (from 0) of each row in its group, by a range sort over all tasks. Only one
    count per group and partition goes through a window, so a group may span any number of partitions."""
    ranged = saved(
        df.repartitionByRange(*[F.col(c) for c in group + order]).sortWithinPartitions(*group, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", 33))
    )
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)] + [F.col("_part").alias("_p")]
    first = ranged.groupBy(*keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each partition, and one more for each group that begins in it
    starts = small(saved(first.select("*", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))))
    same = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]]
    number = (F.col("_at") - F.col("_first") + F.col("_before")).alias(name)
    return ranged.join(starts, same).select(*df.columns, number)
