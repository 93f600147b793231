"""SimHash near-duplicates: vantage-point tree over fingerprints, exact within the bit distance.

Equal fingerprints are one point. A tree of vantage points and median radii is fitted on a bounded sample
(``SAMPLE`` fingerprints, at most 2**``MAX_DEPTH`` leaves) and only decides where points go. Each point is stored
in one leaf. It also visits, as a query, every leaf that the triangle bound can't rule out: at a vantage point at
distance d with radius r it goes inside if d - k <= r and outside if d + k > r. So each leaf sees all pairs within k
bits that one of its points has a part in, and the links are complete whatever the sample was. A leaf compares in
blocks and returns a spanning set of its links, never all pairs of a dense group. Leaves over the row limit are cut
into bounded pieces that each meet all queries of the leaf.

Defined results: null and empty texts have no words and fingerprint zero, linked as any other; a text with fewer
words than a shingle is one shingle; repeated rows share a fingerprint and a class; a null doc_id is kept as a row, and
takes part as a document without a number (component_id is the smallest non-null id, null if there is none); extra
columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import free, saved
from larder.llm.components import components

SEED = 42
SAMPLE = 65_536  # fingerprints that the tree is fitted on
LEAF = 1_024  # points for each leaf that the depth aims at
MAX_DEPTH = 14
BATCH = 16_384  # points that are routed in one go
PIECE = 16_384  # points of a leaf that are compared in one go
SPACE = re.compile(rb"[\x20\x09-\x0D]+")
UPPER = bytes(range(65, 91))
FOLD = bytes.maketrans(UPPER, UPPER.lower())


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of each shingle of the text, repeats included."""
    words = SPACE.split((text or "").encode().translate(FOLD))
    words = [w for w in words if w]
    if not words:
        return np.empty(0, np.uint64)
    line, count = b" ".join(words), len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    if count <= 1:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: count - 1])).tolist()
    return np.fromiter([digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64, count)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is one if it is set in over half the hashes; zero without hashes."""
    totals = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        totals += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * totals > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tie, fp): a digest of the text, and the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.fromiter((fingerprint(shingle_hashes(t, size)) for t in batch.pop("_text")), np.uint64, len(batch))
            yield batch.assign(fp=found.view(np.int64))

    source = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.xxhash64(docs[text].cast("string")).alias("tie"), docs[text].cast("string").alias("_text"))
    return source.mapInPandas(run, "doc_id bigint, tie bigint, fp bigint")


def fit_tree(sample: np.ndarray, depth: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete tree in level order; a radius of -1 sends all points outside."""
    size = (1 << depth) - 1
    points, radii = np.zeros(size, np.uint64), np.full(size, -1, np.int64)
    rng = np.random.default_rng(seed)
    held = {0: sample}
    for node in range(size):
        here = held.pop(node, sample[:0])
        if len(here) >= 8:
            tries = here[rng.integers(0, len(here), 8)]
            spread = np.bitwise_count(here[:256, None] ^ tries[None, :]).astype(np.int64)
            best = int(np.argmax(spread.var(axis=0)))  # the widest spread splits with the thinnest border
            far = np.bitwise_count(here ^ tries[best]).astype(np.int64)
            points[node], radii[node] = tries[best], int(np.median(far))
            inside = far <= radii[node]
            held[2 * node + 1], held[2 * node + 2] = here[inside], here[~inside]
    return points, radii


def _route(fps: np.ndarray, points: np.ndarray, radii: np.ndarray, depth: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, whether the row is stored there) for all leaves that a row must see."""
    rows, nodes, own = np.arange(len(fps)), np.zeros(len(fps), np.int64), np.ones(len(fps), bool)
    for _ in range(depth):
        r = radii[nodes]
        far = np.bitwise_count(fps[rows] ^ points[nodes]).astype(np.int64)
        home = far <= r
        see_in, see_out = (far - bits <= r) & (r >= 0), (far + bits > r) | (r < 0)
        rows = np.concatenate((rows[see_in], rows[see_out]))
        nodes, own = np.concatenate((2 * nodes[see_in] + 1, 2 * nodes[see_out] + 2)), np.concatenate(((own & home)[see_in], (own & ~home)[see_out]))
    return rows, nodes - len(points), own


def _leaf_links(stored: np.ndarray, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links between the queries and the stored points. Passing the stored points as the
    first queries links them to each other."""
    everyone = np.concatenate((stored, queries))
    parent = np.arange(len(everyone))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out_a, out_b = [], []
    step = max(1, (1 << 21) // len(stored))
    for at in range(0, len(queries), step):
        who, to = np.nonzero(np.bitwise_count(queries[at : at + step, None] ^ stored[None, :]) <= bits)
        apart = queries[at + who] != stored[to]
        who, to = who[apart] + at + len(stored), to[apart]
        cuts = np.concatenate(([0], np.nonzero(np.diff(who))[0] + 1, [len(who)])) if len(who) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine, near = root(who[a]), to[a:b]
            for j in near[parent[near] != mine]:
                other = root(j)
                if other != mine:
                    parent[max(mine, other)] = min(mine, other)
                    mine = min(mine, other)
                    out_a.append(everyone[who[a]])
                    out_b.append(everyone[j])
                parent[j] = mine
    return np.array(out_a, np.uint64), np.array(out_b, np.uint64)


def fingerprint_links(points: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b): links that join all fingerprints (column fp, distinct) within so many bits of each other."""
    count = points.count()
    depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, count) / LEAF))))
    share = min(1.0, 1.2 * SAMPLE / max(1, count))
    mixed = F.pmod(F.xxhash64(F.lit(SEED), "fp"), F.lit(1 << 20))
    drawn = points.where(mixed < int(share * (1 << 20))).select("fp").limit(SAMPLE).collect()
    vantage, radii = fit_tree(np.sort(np.array([r["fp"] for r in drawn], np.int64)).view(np.uint64), depth)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:  # a row for each leaf that has any of the batch's points
            fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for at in range(0, len(fps), BATCH):
                part = fps[at : at + BATCH]
                rows, leaf, own = _route(part, vantage, radii, depth, bits)
                key = 2 * leaf + np.where(own, 0, 1)
                order = np.argsort(key, kind="stable")
                heads = np.unique(key[order], return_index=True)
                packed = part[rows[order]].astype("<u8")
                ends = np.append(heads[1][1:], len(order))
                yield pd.DataFrame({"leaf": (heads[0] // 2).astype(np.int32), "seen": (heads[0] % 2).astype(np.int32), "fps": [packed[a:b].tobytes() for a, b in zip(heads[1], ends, strict=True)]})

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come by leaf, stored points first: those are held, the points that only visit go by
        def found(queries: np.ndarray, pieces: list[np.ndarray]) -> Iterator[pd.DataFrame]:
            for piece in pieces:
                a, b = _leaf_links(piece, queries, bits)
                if len(a):
                    yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        leaf, waiting, pieces = None, [], []

        def settle() -> Iterator[pd.DataFrame]:
            if waiting:
                full = np.concatenate(waiting)
                waiting.clear()
                pieces.extend(full[at : at + PIECE] for at in range(0, len(full), PIECE))
                for i, piece in enumerate(pieces):
                    yield from found(piece, pieces[i:])

        for batch in batches:
            for row in zip(batch["leaf"], batch["seen"], batch["fps"], strict=True):
                if row[0] != leaf:
                    yield from settle()
                    pieces.clear()
                    leaf = row[0]
                points_here = np.frombuffer(row[2], "<u8")
                if row[1]:
                    yield from settle()
                    yield from found(points_here, pieces)
                else:
                    waiting.append(points_here)
        yield from settle()

    routed = points.select("fp").mapInPandas(route, "leaf int, seen int, fps binary")
    by_leaf = routed.repartition("leaf").sortWithinPartitions("leaf", "seen")
    return by_leaf.mapInPandas(link, "a bigint, b bigint").distinct()


def classes(docs: DataFrame, size: int = 3, bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, tie, fp and component_id of every document."""
    prints = saved(fingerprints(docs, size, doc_id, text))
    points = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    linked = components(fingerprint_links(points, bits))
    known = points.join(linked, points["fp"] == linked["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    smallest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = known.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(by_print, "fp")


def near_duplicates(docs: DataFrame, size: int = 3, bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id that links of
    at most ``bits`` differing bits reach."""
    return classes(docs, size, bits, doc_id, text).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, size: int = 3, bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of each class with the smallest id (then text digest; a null id only where there is no other),
    with all its columns."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("first")
    stay = saved(classes(docs, size, bits, doc_id, text).groupBy("component").agg(first).select("first.doc_id", "first.tie"))
    row, tie, keep, with_ = free(docs, "_id", "_tie", "_keep", "_with")
    named = docs.withColumns({tie: F.xxhash64(F.col(text).cast("string")), row: F.col(doc_id).cast("bigint")})
    kept = named.join(stay.toDF(keep, with_), (F.col(tie) == F.col(with_)) & F.col(row).eqNullSafe(F.col(keep)), "left_semi")
    return kept.dropDuplicates([row, tie]).select(*docs.columns)
