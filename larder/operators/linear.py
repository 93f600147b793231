"""Least squares from moments: one scan adds up products of columns, whatever the number of models and folds.

``moments`` adds up counts, sums and products of features and target per group, exactly: a task multiplies limbs of whole
numbers, the sums of tasks meet as decimals in an aggregate. Everything else is arithmetic on that small table. A model on some of the features uses a part of the matrix,
the training side of a fold is a difference or a running total of fold moments, and squared errors of a model on a
fold follow from the fold's moments without a second look at the rows. Only the mean absolute error needs one more
scan, shared by all folds and models.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.session import materialize

NUMBER = "decimal(18,6)"
SUM = T.DecimalType(38, 12)
LIMB_ROWS = 1 << 12  # products of 20 + 20 bits over so many rows keep one bit of a double's 53 free
#: a feature is left out if, given those before it, less than this share of its own spread remains
LEAST_SPREAD = 1e-10


@dataclass(frozen=True)
class Linear:
    """A fitted plane; features that the others determine have the coefficient 0."""

    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    n: int

    def predict(self, columns: Mapping[str, Column] | None = None) -> Column:
        """The prediction of a row, from its columns or those given; NULL where a feature is."""
        x = columns or {c: F.col(c) for c in self.features}
        terms = [F.lit(b) * x[c].cast("double") for c, b in zip(self.features, self.coefficients, strict=True)]
        return reduce(add, terms, F.lit(self.intercept))


@dataclass(frozen=True)
class Moments:
    """Counts, sums and sums of products of the columns (features first, the target last) over some rows."""

    columns: tuple[str, ...]
    n: int
    sums: tuple[Decimal, ...]
    products: tuple[tuple[Decimal, ...], ...]

    def __add__(self, other: Moments) -> Moments:
        return self._with(other, 1)

    def __sub__(self, other: Moments) -> Moments:
        return self._with(other, -1)

    def _with(self, other: Moments, sign: int) -> Moments:
        if self.columns != other.columns:
            raise ValueError("moments of different columns")
        return Moments(
            self.columns,
            self.n + sign * other.n,
            tuple(a + sign * b for a, b in zip(self.sums, other.sums, strict=True)),
            tuple(tuple(a + sign * b for a, b in zip(x, y, strict=True)) for x, y in zip(self.products, other.products, strict=True)),
        )

    def spread(self, i: int, j: int) -> float:
        """Sum of products around the means, exact up to the last division."""
        return float(self.products[i][j] - self.sums[i] * self.sums[j] / self.n) if self.n else 0.0


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def moments(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``n``, ``sums`` and ``products`` (upper triangle by rows) as arrays of decimals.

    Rows with a NULL feature or target take no part.
    """
    columns = [*features, target]
    k, x = len(columns), [F.col(c).cast(NUMBER) for c in columns]
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in x])
    keys = [f"k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(by, keys, strict=True)], *[c.alias(f"x{i}") for i, c in enumerate(x)], known.alias("known"))
    rows = rows.where("known").drop("known")
    totals = [T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(SUM)), T.StructField("products", T.ArrayType(SUM))]
    parts = rows.mapInArrow(_adder(len(by), k), T.StructType([*rows.schema.fields[: len(by)], *totals]))
    made = parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(k)],
        *[F.sum(F.col("products")[q]).alias(f"p{q}") for q in range(len(_pairs(k)))],
    )
    return made.select(
        *[F.col(n).alias(c) for c, n in zip(by, keys, strict=True)], F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.array(*[F.col(f"s{i}").cast(SUM) for i in range(k)]).alias("sums"), F.array(*[F.col(f"p{q}").cast(SUM) for q in range(len(_pairs(k)))]).alias("products"),
    )


def _adder(by: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that adds up sums and products of the rows of each batch and group: a row per group, exact.

    A number in millionths is cut into three limbs of 20 bits. Products of limbs summed over ``LIMB_ROWS`` rows stay below
    2^53, so one product of matrices of doubles is exact; whole numbers of any size put the limbs together again.
    """
    pairs, shift = _pairs(k), [0, 20, 40]

    def decimals(values: list[list[int]], scale: int) -> pa.Array:
        with localcontext() as exact:
            exact.prec = 100
            return pa.array([[Decimal(v).scaleb(-scale) for v in row] for row in values], pa.list_(pa.decimal128(38, 12)))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            x = np.stack([millionths(batch.column(by + i)) for i in range(k)], axis=1)
            limbs = np.concatenate([x & 0xFFFFF, (x >> 20) & 0xFFFFF, x >> 40, np.ones((len(x), 1), np.int64)], axis=1).astype(np.float64)
            group = pa.table([batch.column(i) for i in range(by)], names[:by])
            first, where = group_rows(group, len(x))
            counts, sums, products = [], [], []
            for mine in np.split(limbs[np.argsort(where, kind="stable")], np.cumsum(np.bincount(where))[:-1]) if len(first) > 1 else [limbs]:
                n, one, two = len(mine), [0] * k, [0] * len(pairs)
                for lot in (mine[i : i + LIMB_ROWS] for i in range(0, n, LIMB_ROWS)):
                    square = (lot.T @ lot).astype(np.int64).tolist()
                    one = [v + sum(square[-1][a * k + i] << s for a, s in enumerate(shift)) for i, v in enumerate(one)]
                    two = [v + sum(square[a * k + i][b * k + j] << s + t for a, s in enumerate(shift) for b, t in enumerate(shift)) for v, (i, j) in zip(two, pairs, strict=True)]
                counts.append(n), sums.append(one), products.append(two)
            own = group.take(pa.array(first)).combine_chunks()
            out = pa.table([*own.columns, pa.array(counts, pa.int64()), decimals(sums, 6), decimals(products, 12)], [*names[:by], "n", "sums", "products"])
            yield from out.combine_chunks().to_batches()

    return add_up


def millionths(column: pa.Array) -> np.ndarray:
    """The whole numbers behind a decimal(18,6) column without nulls: the low halves of its 128-bit values."""
    return np.frombuffer(column.buffers()[1], np.int64)[2 * column.offset : 2 * (column.offset + len(column)) : 2]


def group_rows(keys: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each group and the group of each row; a NULL is a value of its own."""
    code = np.zeros(n, np.int64)
    for column in keys.columns:
        own = column.combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        code = np.unique(code * (int(own.max()) + 1) + own, return_inverse=True)[1]
    _, first, where = np.unique(code, return_index=True, return_inverse=True)
    return first, where


def as_moments(row, features: Sequence[str], target: str) -> Moments:
    """A row of ``moments`` as a value."""
    columns = (*features, target)
    k = len(columns)
    square = [[Decimal(0)] * k for _ in range(k)]
    for (i, j), value in zip(_pairs(k), row["products"], strict=True):
        square[i][j] = square[j][i] = value or Decimal(0)
    return Moments(columns, row["n"], tuple(v or Decimal(0) for v in row["sums"]), tuple(map(tuple, square)))


def nothing(features: Sequence[str], target: str) -> Moments:
    k = len(features) + 1
    return Moments((*features, target), 0, (Decimal(0),) * k, ((Decimal(0),) * k,) * k)


def solve(m: Moments, features: Sequence[str] | None = None) -> Linear:
    """The least-squares plane on some of the columns, by elimination on the centred products."""
    if m.n < 1:
        raise ValueError("no rows to train on")
    chosen = tuple(features if features is not None else m.columns[:-1])
    at = [m.columns.index(c) for c in chosen]
    y = len(m.columns) - 1
    k = len(at)
    g = [[m.spread(i, j) for j in [*at, y]] for i in at]
    own = [g[i][i] for i in range(k)]
    used = []
    for p in range(k):
        if not g[p][p] > LEAST_SPREAD * own[p]:
            for row in g:
                row[p] = 0.0
            g[p] = [0.0] * (k + 1)
            continue
        used.append(p)
        for r in range(k):
            if r != p and g[r][p]:
                ratio = g[r][p] / g[p][p]
                g[r] = [a - ratio * b for a, b in zip(g[r], g[p], strict=True)]
    b = [g[p][k] / g[p][p] if p in used else 0.0 for p in range(k)]
    mean = [float(m.sums[i] / m.n) for i in at]
    intercept = float(m.sums[y] / m.n)
    for x, c in zip(mean, b, strict=True):
        intercept -= c * x
    return Linear(chosen, intercept, tuple(b), m.n)


def fit_linear(df: DataFrame, features: Sequence[str], target: str) -> Linear:
    """Ordinary least squares by one aggregate; one row of moments reaches the driver."""
    return solve(as_moments(moments(df, features, target).first(), features, target))


def score_linear(model: Linear, df: DataFrame, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, model.predict())


def squared_error(model: Linear, m: Moments) -> tuple[float, float]:
    """Sum of squared errors and of squared deviations from the mean of the target on the rows of ``m``."""
    at = [m.columns.index(c) for c in model.features]
    y, b = len(m.columns) - 1, [Decimal(c) for c in model.coefficients]
    a = Decimal(model.intercept)
    # sum of (y - a - bx)^2, term by term
    total = m.products[y][y] - 2 * a * m.sums[y] + a * a * m.n
    for i, c in zip(at, b, strict=True):
        total += 2 * c * (a * m.sums[i] - m.products[i][y])
        for j, d in zip(at, b, strict=True):
            total += c * d * m.products[i][j]
    return max(0.0, float(total)), m.spread(y, y)


def cross_validate_linear(
    df: DataFrame, models: dict[str, Sequence[str]], target: str, fold: str = "fold", folds: Sequence[int] = (1, 2), expanding: bool = True,
) -> DataFrame:
    """(model, fold, n, MAE, RMSE, R2, error) of linear models on feature sets, all folds and models in two scans.

    The first scan adds up moments per fold. Training moments are the total less the fold's own or, with
    ``expanding``, those of all lower folds. A fold that can't be trained or tested is a row with its error.
    """
    spark = df.sparkSession
    every = list(dict.fromkeys(c for features in models.values() for c in features))
    df = materialize(df.select(fold, *every, target))
    rows = {r[fold]: as_moments(r, every, target) for r in moments(df.where(F.col(fold).isNotNull()), every, target, [fold]).collect()}
    empty = nothing(every, target)
    fitted: dict[tuple[str, int], Linear] = {}
    errors: dict[tuple[str, int], str] = {}
    for f in folds:
        train = sum((m for g, m in rows.items() if (g < f if expanding else g != f)), empty)
        for name, features in models.items():
            try:
                fitted[name, f] = solve(train, features)
                if f not in rows:
                    errors[name, f] = "no rows to test"
            except ValueError as err:
                errors[name, f] = str(err)
    good = [key for key in fitted if key not in errors]
    # the second scan: every row meets the models of its fold, of which there are few
    sums = {}
    if good:
        known = reduce(lambda a, b: a & b, [F.col(c).cast(NUMBER).isNotNull() for c in [*every, target]])
        tests = df.where(known & F.col(fold).isin([f for f in folds if f in rows]))
        off = [
            F.avg(F.when(F.col(fold) == f, F.abs(F.col(target).cast("double") - fitted[name, f].predict()))).alias(f"m{i}") for i, (name, f) in enumerate(good)
        ]
        sums = dict(zip(good, tests.agg(*off).first(), strict=True))
    out = []
    for f in folds:
        for name in models:
            key = (name, f)
            if key in errors:
                out.append((name, f, rows[f].n if f in rows else 0, None, None, None, errors[key]))
                continue
            n = rows[f].n
            wrong, around = squared_error(fitted[key], rows[f])
            r2 = None if n < 2 else 1 - wrong / around if around > 0 else float(wrong == 0)
            out.append((name, f, n, sums[key], (wrong / n) ** 0.5, r2, None))
    return spark.createDataFrame(out, "model string, fold int, n bigint, MAE double, RMSE double, R2 double, error string")
