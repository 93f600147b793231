"""Exact k-means over integer vectors with geometrically tightened distance bounds.

Every vector carries its cluster, an upper bound of the distance to its own centroid and a lower bound of the distance
to any other. When centroids move, the upper bound grows by the way its centroid went. The lower bound need not shrink
by the longest way that another centroid went: all vectors of a cluster lie in the sphere around its old centroid
whose radius is the largest upper bound. Seen in the plane through that centre and the line on which another centroid
moved from p to q, a point x at the angle t from the midpoint m of p and q, measured from the direction of movement,
has |x - p| - |x - q| <= |p - q| cos t, as the hyperbola through x with the foci p and q lies inside its asymptotes, or
<= 0 where t is a right angle or more. The sphere fills the angles from its centre's angle less asin(radius / |centre - m|) on, so the
cosine of that one angle bounds the loss for the whole cluster. A vector whose upper bound stays under its lower bound
keeps its cluster without a look at its components; any other is ambiguous and is compared with all centroids in exact
integers, lower number first on ties.

Each round is one narrow pass: it reads the vectors and their state from the written table of the last round, writes
the next one, and adds up, per task and cluster, only what changed sides. Those signed sums are added by Spark in
integers of any size; the driver sees a bounded number of rows per cluster. No vector is shuffled.

Defined results: vectors that are null, of another length or hold null or non-finite components take no part; the start
vectors are those of the smallest digests, equal digests (repeated ids) ordered by components, null ids last; with
fewer vectors than clusters there are fewer clusters; an empty cluster keeps its centroid; repeated rows count each;
an empty table gives no row. Components whose squares might not fit 64 bits are carried as text and always compared exactly; a distance or
sum that a long can't hold is null. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import forget, saved

LONG = (1 << 63) - 1
LOTS = 32
SLACK = 1e-9  # on bounds, far above the rounding of doubles
STATE = (
    "vec_id bigint, x array<int>, wide array<string>, cluster int, upper double, lower double, distance bigint, "
    "part int, n bigint, sums array<string>, radius double, inertia string, scanned bigint"
)


@dataclass(frozen=True)
class Step:
    """What a pass needs: the centroids, and how far the bounds of each cluster's vectors loosen."""

    centroids: list[list[int]]
    drift: list[float] | None = None
    loosen: list[float] | None = None
    last: bool = False


def narrow_limit(dims: int) -> int:
    """Components under it have squared distances that fit 62 bits."""
    return 1 << (62 - max(0, dims - 1).bit_length()) // 2 - 1


def whole(values: np.ndarray, scale: int) -> list[int]:
    """floor(scale * v), exact for every finite double."""
    out = []
    for v in values.tolist():
        top, bottom = v.as_integer_ratio()
        out.append(top * scale // bottom)
    return out


def _float(v: int) -> float:
    try:
        return float(v)
    except OverflowError:
        return math.inf if v > 0 else -math.inf


def _floats(values: np.ndarray) -> np.ndarray:
    return values.astype(float) if values.dtype != object else np.array([_float(v) for v in values.tolist()])


def exact_distances(x: list[int], centroids: list[list[int]]) -> list[int]:
    return [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]


class Pass:
    """One round over the vectors of a task."""

    def __init__(self, step: Step, dims: int):
        self.step, self.dims, self.k = step, dims, len(step.centroids)
        self.narrow = all(abs(v) < narrow_limit(dims) for c in step.centroids for v in c)
        self.matrix = np.array(step.centroids, np.int64) if self.narrow else None
        self.n, self.inertia, self.scanned = [0] * self.k, [0] * self.k, 0
        self.sums = [[0] * dims for _ in range(self.k)]
        self.radius = np.zeros(self.k)

    def squared(self, x: np.ndarray) -> np.ndarray:
        """Exact squared distances to all centroids; whole numbers of any size where a centroid is wide."""
        if self.narrow:
            out = np.empty((len(x), self.k), np.int64)
            for j, c in enumerate(self.matrix):
                apart = x - c
                out[:, j] = np.einsum("ij,ij->i", apart, apart)
            return out
        return np.array([exact_distances(row, self.step.centroids) for row in x.tolist()], object).reshape(len(x), self.k)

    def _count(self, clusters: np.ndarray, x: np.ndarray, sign: int) -> None:
        for j in np.unique(clusters).tolist():
            if j < 0:
                continue
            mine = clusters == j
            self.n[j] += sign * int(mine.sum())
            self.sums[j] = [a + sign * b for a, b in zip(self.sums[j], x[mine].sum(axis=0).tolist(), strict=True)]

    def ordinary(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        """New cluster, bounds and, in the last pass, squared distance of vectors without large components."""
        if self.step.drift is not None:
            upper = upper + np.array(self.step.drift)[cluster]
            lower = lower - np.array(self.step.loosen)[cluster]
        doubtful = np.nonzero(~(upper < lower))[0]
        self.scanned += len(doubtful)
        if len(doubtful):
            cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
            seen = x[doubtful]
            found = self.squared(seen)
            best = found.argmin(axis=1)  # the first of equals
            rows = np.arange(len(seen))
            near = found[rows, best]
            upper[doubtful] = np.sqrt(_floats(near)) * (1 + SLACK)
            if self.k > 1:
                others = found.copy()
                others[rows, best] = found.max(axis=1) + 1 if not self.narrow else np.iinfo(np.int64).max
                lower[doubtful] = np.sqrt(_floats(others.min(axis=1))) * (1 - SLACK)
            else:
                lower[doubtful] = math.inf
            moved = cluster[doubtful] != best
            self._count(cluster[doubtful][moved], seen[moved], -1)
            self._count(best[moved], seen[moved], 1)
            cluster[doubtful] = best
        np.maximum.at(self.radius, cluster, upper)
        if not self.step.last:
            return cluster, upper, lower, None
        if self.narrow:
            apart = x - self.matrix[cluster]
            distance = np.einsum("ij,ij->i", apart, apart).tolist()
        else:
            distance = [exact_distances(row, [self.step.centroids[j]])[0] for row, j in zip(x.tolist(), cluster.tolist(), strict=True)]
        for j, d in zip(cluster.tolist(), distance, strict=True):
            self.inertia[j] += d
        return cluster, upper, lower, distance

    def wide(self, x: list[int], cluster: int) -> tuple[int, int]:
        """New cluster and squared distance of a vector with large components."""
        self.scanned += 1
        found = exact_distances(x, self.step.centroids)
        best = found.index(min(found))
        if best != cluster:
            for j, sign in ((cluster, -1), (best, 1)):
                if j >= 0:
                    self.n[j] += sign
                    self.sums[j] = [a + sign * b for a, b in zip(self.sums[j], x, strict=True)]
        if self.step.last:
            self.inertia[best] += found[best]
        return best, found[best]

    def totals(self) -> pa.RecordBatch:
        """A row per cluster with what changed in this task."""
        rows = [
            {"part": j, "n": self.n[j], "sums": [str(v) for v in self.sums[j]], "radius": float(self.radius[j]), "inertia": str(self.inertia[j]), "scanned": self.scanned if j == 0 else 0}
            for j in range(self.k)
        ]
        return pa.RecordBatch.from_pylist([{name: row.get(name) for name in ARROW.names} for row in rows], schema=ARROW)


ARROW = pa.schema(
    [
        ("vec_id", pa.int64()), ("x", pa.list_(pa.int32())), ("wide", pa.list_(pa.string())), ("cluster", pa.int32()), ("upper", pa.float64()),
        ("lower", pa.float64()), ("distance", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string())),
        ("radius", pa.float64()), ("inertia", pa.string()), ("scanned", pa.int64()),
    ]
)


def _lists(matrix: np.ndarray, present: np.ndarray) -> pa.Array:
    """A list column with the matrix's rows where ``present``, null elsewhere."""
    ends = np.concatenate([[0], np.cumsum(np.where(present, matrix.shape[1], 0))]).astype(np.int32)
    offsets = pa.array(ends, mask=np.concatenate([~present, [False]]), type=pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel().astype(np.int32)))


def _batch(ids: pa.Array, x: np.ndarray, narrow: np.ndarray, wide: dict[int, list[int]], work: Pass, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> pa.RecordBatch:
    """The next state of a batch; ``x`` holds the rows where ``narrow``, ``wide`` the others by their place."""
    size, last = len(ids), work.step.last
    distance: list[int | None] = [None] * size
    at = np.nonzero(narrow)[0]
    if len(at):
        got, upper[at], lower[at], far = work.ordinary(x.astype(np.int64), cluster[at], upper[at], lower[at])
        cluster[at] = got
        if last:
            for i, d in zip(at.tolist(), far, strict=True):
                distance[i] = d
    for i, row in wide.items():
        cluster[i], far = work.wide(row, int(cluster[i]))
        upper[i], lower[i] = math.inf, 0.0
        distance[i] = far if last else None
    columns = {
        "vec_id": ids,
        "x": _lists(x, narrow),
        "wide": pa.array([[str(v) for v in wide[i]] if i in wide else None for i in range(size)] if wide else [None] * size, pa.list_(pa.string())),
        "cluster": pa.array(cluster.astype(np.int32)),
        "upper": pa.array(upper),
        "lower": pa.array(lower),
        "distance": pa.array([d if d is not None and d <= LONG else None for d in distance], pa.int64()),
    }
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(size, f.type) for f in ARROW], schema=ARROW)


def _first_pass(kept: DataFrame, step: Step, dims: int, scale: int) -> DataFrame:
    """State of all vectors (vec_id, e) after a full scan, and the sums of the clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Pass(step, dims)
        for batch in batches:
            size = len(batch)
            if not size:
                continue
            e = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(size, dims)
            narrow = (np.abs(e) * scale < narrow_limit(dims) - 1).all(axis=1)
            x = np.floor(e[narrow] * scale).astype(np.int64)
            wide = {i: whole(e[i], scale) for i in np.nonzero(~narrow)[0].tolist()}
            yield _batch(batch.column(0), x, narrow, wide, work, np.full(size, -1), np.full(size, np.inf), np.zeros(size))
        yield work.totals()

    return kept.mapInArrow(run, STATE)


def _next_pass(state: DataFrame, step: Step, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Pass(step, dims)
        for batch in batches:
            size = len(batch)
            if not size:
                continue
            lists = batch.column(1)
            narrow = ~lists.is_null().to_numpy(zero_copy_only=False)
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            wide = {i: [int(v) for v in batch.column(2)[i].as_py()] for i in np.nonzero(~narrow)[0].tolist()}
            held = [batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5)]
            yield _batch(batch.column(0), x, narrow, wide, work, held[0].astype(np.int64), held[1].copy(), held[2].copy())
        yield work.totals()

    return state.where("part is null").select("vec_id", "x", "wide", "cluster", "upper", "lower").mapInArrow(run, STATE)


def _summed(state: DataFrame) -> list[dict]:
    """Per cluster what all tasks changed: at most ``LOTS`` rows of each reach the driver."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        sums = [str(sum(map(int, column))) for column in zip(*rows["sums"], strict=True)]
        return pd.DataFrame(
            {"part": [rows["part"].iloc[0]], "n": [rows["n"].sum()], "sums": [sums], "radius": [rows["radius"].max()], "inertia": [str(sum(map(int, rows["inertia"])))], "scanned": [rows["scanned"].sum()]}
        )

    parts = state.where("part is not null").select("part", "n", "sums", "radius", "inertia", "scanned")
    lots = parts.withColumn("lot", F.pmod(F.xxhash64("sums", "radius", "inertia"), F.lit(LOTS)))
    kinds = "part int, n bigint, sums array<string>, radius double, inertia string, scanned bigint"
    out: dict[int, dict] = {}
    for row in lots.groupBy("part", "lot").applyInPandas(add, kinds).collect():
        one = out.setdefault(row["part"], {"n": 0, "sums": [0] * len(row["sums"]), "radius": 0.0, "inertia": 0, "scanned": 0})
        one["n"] += row["n"]
        one["sums"] = [a + int(b) for a, b in zip(one["sums"], row["sums"], strict=True)]
        one["radius"] = max(one["radius"], row["radius"])
        one["inertia"] += int(row["inertia"])
        one["scanned"] += row["scanned"]
    return [out[j] for j in sorted(out)]


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each centroid went, and per cluster the most that any other centroid can have come nearer to one of the
    vectors within ``radius`` of its old centroid."""
    k = len(old)
    way = np.sqrt(((new - old) ** 2).sum(axis=1))
    loss = np.zeros(k)
    for j in range(k):
        if not way[j] > 0:
            continue
        w = old - (old[j] + new[j]) / 2
        far = np.sqrt((w**2).sum(axis=1))
        safe = np.where(far > 0, far, 1.0)
        centre = np.clip(w @ (new[j] - old[j]) / way[j] / safe, -1, 1)  # cosine of the centre's angle
        reach = np.minimum(radius / safe, 1)  # sine of half the angle that the sphere fills
        edge = np.sqrt(1 - reach**2)
        # angle difference of centre and sphere, 0 where the sphere reaches over the line itself
        cosine = np.where((far <= radius) | (centre >= edge), 1.0, centre * edge + np.sqrt(1 - centre**2) * reach)
        bound = way[j] * np.clip(cosine + 1e-6, 0, 1)
        bound[j] = 0
        loss = np.maximum(loss, bound)
    return way * (1 + SLACK), loss * (1 + SLACK)


def _drift(old: list[list[int]], new: list[list[int]], radius: list[float]) -> tuple[list[float], list[float]]:
    a, b = (np.array([[_float(v) for v in c] for c in m]) for m in (old, new))
    if max(np.abs(a).max(), np.abs(b).max()) > 1e100:  # squares may overflow: give up the bounds for this round
        return [math.inf] * len(old), [math.inf] * len(old)
    way, loss = loosening(a, b, np.array(radius))
    return way.tolist(), loss.tolist()


def digest_of(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def kmeans(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
    vec_id: str = "vec_id", embedding: str = "embedding", report: list | None = None,
) -> tuple[DataFrame, list[dict]]:
    """(vec_id, cluster, distance) of every vector that takes part, and per cluster its centroid, count and inertia.

    ``report``, if given, receives per pass how many vectors were scanned exactly.
    """
    e = F.col("e")
    source = vectors.select(vectors[vec_id].cast("bigint").alias("vec_id"), vectors[embedding].cast("array<double>").alias("e"))
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    kept = source.where((F.size(e) == dims) & finite)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = kept.orderBy(drawn.asc_nulls_last(), e).limit(k).collect()
    if not start:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    centroids = [whole(np.array(row["e"], float), scale) for row in start]
    state = saved(_first_pass(kept, Step(centroids, last=rounds == 0), dims, scale))
    summed = _summed(state)
    if report is not None:
        report.append(summed[0]["scanned"])
    totals = [{"n": s["n"], "sums": s["sums"]} for s in summed]
    for done in range(rounds):
        moved = [[v // t["n"] for v in t["sums"]] if t["n"] else c for t, c in zip(totals, centroids, strict=True)]
        drift, loosen = _drift(centroids, moved, [s["radius"] for s in summed])
        # once no centroid moves, the remaining rounds would change nothing
        still = moved == centroids
        centroids = moved
        before, state = state, saved(_next_pass(state, Step(centroids, drift, loosen, last=still or done + 1 == rounds), dims))
        forget(before)
        summed = _summed(state)
        if report is not None:
            report.append(summed[0]["scanned"])
        for t, s in zip(totals, summed, strict=True):
            t["n"] += s["n"]
            t["sums"] = [a + b for a, b in zip(t["sums"], s["sums"], strict=True)]
        if still:
            break
    clusters = [{"centroid": c, "n": t["n"], "inertia": s["inertia"]} for c, t, s in zip(centroids, totals, summed, strict=True)]
    return state.where("part is null").select("vec_id", "cluster", "distance"), clusters


def digest(vectors: DataFrame, **options) -> DataFrame:
    """Per vector its cluster and distance, with the cluster's and the whole inertia and the digest of its centroid."""
    rows, clusters = kmeans(vectors, **options)
    fits = lambda v: v if v <= LONG else None
    total = sum(c["inertia"] for c in clusters)
    facts = [(j, fits(c["inertia"]), fits(total), digest_of(c["centroid"])) for j, c in enumerate(clusters)]
    table = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # one row per cluster
    return rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
