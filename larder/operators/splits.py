"""Train/test splits and folds.

Random assignment is a seeded md5 of the row key, so a lost executor that recomputes its rows puts
each of them on the same side again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.scalars import as_col, hash_text, hash_unit, hash_word
from larder.operators.clean import ceil_share
from larder.operators.features import qcut
from larder.operators.ordered import HOT_ROWS, date_quantile, hot_groups, positions, running_counts, size_limit
from larder.session import materialize


def side(test: Column) -> Column:
    return F.when(test, F.lit("test")).otherwise(F.lit("train"))


def hash_split(df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Random split by row key: a narrow operation."""
    return df.withColumn("split", side(hash_unit(key, seed) < test_size))


def time_split(df: DataFrame, date: str, test_size: float = 0.2) -> DataFrame:
    """Rows after the date quantile test, the rest train; undated rows are on neither side."""
    cutoff = date_quantile(df, date, 1.0 - test_size).first()["cutoff"]
    return df.filter(F.col(date).isNotNull()).withColumn("split", side(F.unix_date(date) > F.lit(cutoff)))


def group_split(df: DataFrame, group: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Whole groups on one side: groups in md5 order, the last ceil(share * groups) test."""
    hashed = df.select(group).distinct().withColumn("_h", hash_text([group], seed))
    ranked = running_counts(hashed, "_h").select("_h", (F.col("before") + 1).alias("_r"), F.col("total").alias("_g"))
    sides = hashed.join(ranked, "_h").select(
        F.col(group).alias("_group"), side(F.col("_r") > F.col("_g") - ceil_share("_g", test_size)).alias("split")
    )
    return df.join(sides, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def tail_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    test_size: Column | float = 0.1,
    floor_train: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Chronological split per group: the last ceil(share * n) rows test. ``floor_train`` rounds the
    training rows down instead.

    Rows of hot groups are not shuffled: the counts of a group's days tell the side of all rows but those of the day
    on which the test begins, and only these are numbered.
    """
    share = F.lit(test_size) if isinstance(test_size, float) else test_size
    n = F.col("_size")
    train_rows = F.floor(n * (1 - share) + F.lit(1e-9)) if floor_train else n - ceil_share("_size", share)
    limit = None if hot_rows is None else size_limit(df, keys, hot_rows)
    out = [*df.columns, "split"]

    def numbered(rows: DataFrame) -> DataFrame:
        placed = positions(rows, keys, order, pos="_pos", total="_size", hot_rows=None)
        return placed.withColumn("split", side(F.col("_pos") > train_rows)).select(*out)

    if limit is None:
        return numbered(df)
    hot = hot_groups(df, keys, limit)
    # undated rows come first, as NULL sorts first
    large = df.join(hot, list(keys), "left_semi").withColumn("_on", F.coalesce(F.col(order[0]), F.lit("0001-01-01").cast("date")))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_on").rowsBetween(Window.unboundedPreceding, -1)
    counts = large.groupBy(*keys, "_on").agg(F.count(F.lit(1)).alias("_held"))
    days = counts.withColumns({"_prior": F.coalesce(F.sum("_held").over(earlier), F.lit(0)), "_size": F.sum("_held").over(group)})
    placed = large.join(materialize(days), [*keys, "_on"])
    sure = F.when(F.col("_prior") + F.col("_held") <= train_rows, "train").when(F.col("_prior") >= train_rows, "test")
    cut = positions(placed.where(sure.isNull()), [*keys, "_on"], order, pos="_pos", total="_of", hot_rows=hot_rows)
    cut = cut.withColumn("split", side(F.col("_prior") + F.col("_pos") > train_rows))
    clear = placed.where(sure.isNotNull()).withColumn("split", sure)
    return clear.select(*out).unionByName(cut.select(*out)).unionByName(numbered(df.join(hot, list(keys), "left_anti")))


def kfold(df: DataFrame, key: Sequence[str], folds: int, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", (hash_word(key, seed) % folds).cast("int"))


def group_kfold(df: DataFrame, group: str, folds: int, seed: int = 42) -> DataFrame:
    return kfold(df, [group], folds, seed)


def stratified_kfold(df: DataFrame, target: str, key: Sequence[str], folds: int, bins: int = 5, seed: int = 42) -> DataFrame:
    """Folds of equal size inside each target bin: rows in md5 order, dealt out in turn.

    A bin is a fixed share of the table, so its rows are numbered in chunks of equal hash prefix.
    """
    hashed = qcut(df, target, bins, "_bin").withColumn("_h", hash_text(key, seed))
    placed = positions(
        hashed, ["_bin"], ["_h", *key], pos="_pos", total="_n", chunk=F.substring("_h", 1, 3)
    )
    return placed.withColumn("fold", ((F.col("_pos") - 1) % folds).cast("int")).drop("_bin", "_h", "_pos", "_n")


def time_series_blocks(df: DataFrame, order: Sequence[str], folds: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Block 0..folds by global row order; fold f tests block f and trains on all lower blocks.

    Each test block has n // (folds + 1) rows, the remainder goes to block 0.
    """
    placed = positions(df, [], order, pos="_pos", total="_n", hot_rows=hot_rows)
    size = F.floor(F.col("_n") / (folds + 1))
    ahead = F.col("_pos") - (F.col("_n") - size * folds)
    block = F.when(size > 0, F.greatest(F.ceil(ahead / size), F.lit(0)))
    return placed.withColumn("block", F.coalesce(block, F.lit(0)).cast("int")).drop("_pos", "_n")


def fold_sides(df: DataFrame, fold: int, column: str = "fold", expanding: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one fold; expanding folds train on the past only."""
    train = F.col(column) < fold if expanding else F.col(column) != fold
    return df.filter(train), df.filter(as_col(column) == fold)
