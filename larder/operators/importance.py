"""Permutation importance: how much worse a model predicts when one feature is shuffled.

Rows are dealt by hash into buckets. Inside a bucket each feature has a hash order of its own, and a row takes the
feature's value from the next row in that order (the last from the first): a permutation that every engine and every
re-run draws alike. Buckets of up to ``BUCKET_ROWS`` rows shuffle all features in the same tasks after one shuffle of
the table. Larger ones are cut into pieces of that size along the hash order of each feature; the last row of a piece
takes its value from a short table of the pieces' first rows. One aggregate gives all errors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.scalars import hash_text, hash_word
from larder.session import materialize

BUCKET_ROWS = 50_000


def shuffled(df: DataFrame, features: Sequence[str], key: Sequence[str], seed: int = 42, buckets: int | None = None) -> DataFrame:
    """The table with a column ``<feature>__shuffled`` for each feature.

    Rows of equal keys are ordered by their features, so they are interchangeable.
    """
    n = df.count()
    if buckets is None:
        buckets = max(1, n // BUCKET_ROWS)
    pieces = max(1, math.ceil(n / (buckets * BUCKET_ROWS)))
    rows = df.withColumn("_bucket", hash_word(key, seed) % buckets)
    heads = None
    if pieces > 1:
        words = [f"_word{i}" for i in range(len(features))]
        worded = materialize(rows.withColumns({w: hash_word(key, seed + 1 + i) for i, w in enumerate(words)}))
        heads = first_rows(worded, features, key, seed, words, pieces)
        rows = worded.drop(*words)
    out = {}
    for i, c in enumerate(features):
        place = ["_bucket"]
        if heads is not None:
            place.append("_piece")
            nexts = heads.where(F.col("_feature") == i).select(*place, F.struct(F.col("_next").getField(c).alias("v")).alias("_after"))
            rows = rows.withColumn("_piece", _piece(hash_word(key, seed + 1 + i), pieces)).join(nexts, place, "left")
        order = Window.partitionBy(*place).orderBy(hash_text(key, seed + 1 + i), *[F.col(f) for f in features])
        # offset rows by position: a null value of the next row must not fall back to the first
        nxt = F.lead(F.struct(F.col(c).alias("v"))).over(order)
        if heads is not None:
            rows = rows.withColumn(f"{c}__shuffled", F.coalesce(nxt, "_after").getField("v")).drop("_piece", "_after")
            continue
        first = F.first(F.struct(F.col(c).alias("v"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        out[f"{c}__shuffled"] = F.coalesce(nxt, first).getField("v")
    return rows.withColumns(out).drop("_bucket")


def _piece(word: Column, pieces: int) -> Column:
    """The piece of a bucket that a row lies in: equal ranges of the first 32 bits of its hash, so it grows with the hash."""
    return F.floor(word * pieces / F.lit(4294967296.0))


def first_rows(rows: DataFrame, features: Sequence[str], key: Sequence[str], seed: int, words: Sequence[str], pieces: int) -> DataFrame:
    """(_bucket, _feature, _piece, _next): the features of the row that follows a piece in the feature's order, the
    bucket's first row after its last piece. The least words are found first; only rows that have them are compared."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_feature"), F.col(w).alias("_word")) for i, w in enumerate(words)])).alias("_at")
    piece = _piece(F.col("_word"), pieces).alias("_piece")
    least = materialize(rows.select("_bucket", each).select("_bucket", "_at.*").groupBy("_bucket", "_feature", piece).agg(F.min("_word").alias("_word")))
    near = rows.select("_bucket", F.struct(*features).alias("_row"), F.struct(*key).alias("_key"), each).select("_bucket", "_row", "_key", "_at.*")
    near = near.join(least, ["_bucket", "_feature", "_word"])
    texts = F.array(*[hash_text([F.col("_key").getField(k) for k in key], seed + 1 + i) for i in range(len(features))])
    first = near.groupBy("_bucket", "_feature", "_piece").agg(F.min(F.struct(F.get(texts, F.col("_feature")).alias("_hash"), "_row")).getField("_row").alias("_row"))
    order = Window.partitionBy("_bucket", "_feature").orderBy("_piece")
    begin = F.first("_row").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return materialize(first.select("_bucket", "_feature", "_piece", F.coalesce(F.lead("_row").over(order), begin).alias("_next")))


def permutation_importance(
    df: DataFrame, predict: Callable[[Mapping[str, Column]], Column], features: Sequence[str], target: str, key: Sequence[str],
    seed: int = 42, buckets: int | None = None,
) -> DataFrame:
    """(feature, rmse, shuffled_rmse, importance): the error with the feature as it is and shuffled, and their difference.

    ``predict`` gives the prediction from a column per feature. Rows without a target or a prediction don't count.
    """
    plain = {c: F.col(c) for c in features}
    kept = materialize(df.where(F.col(target).isNotNull()).select(*dict.fromkeys([*features, target, *key])))
    ready = shuffled(kept, features, key, seed, buckets)

    def rmse(p: Column) -> Column:
        return F.sqrt(F.avg((F.col(target).cast("double") - p) * (F.col(target).cast("double") - p)))

    errors = ready.agg(rmse(predict(plain)).alias("rmse"), *[rmse(predict(plain | {c: F.col(f"{c}__shuffled")})).alias(c) for c in features])
    tall = errors.unpivot(["rmse"], list(features), "feature", "shuffled_rmse")
    return tall.select("feature", "rmse", "shuffled_rmse", (F.col("shuffled_rmse") - F.col("rmse")).alias("importance"))
