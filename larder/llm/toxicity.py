"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of labelled rows (about ``MAX_TOXIC`` and ``MAX_CLEAN``, drawn by a hash of the id;
all rows where there are fewer). The terms are words and word beginnings of 4 to 6 characters; those that go with
the label in the examples by a chi-square test make the vocabulary (at most ``MAX_TERMS``; what a term has to reach
shrinks with few examples). Examples with similar
main terms are neighbours in the index, which keeps the largest weight of each term in each block of examples: a
query adds these to a bound for each block, reads blocks in falling order of the bound and stops once no block can
hold a nearer example, so the K nearest are exact (ties: the smaller doc_id). Their votes, weighted by similarity
and by how much of each class was sampled, are mapped to a score by isotonic regression on the examples
themselves, each one left out of its own neighbours. The scoring pass reads every whole text once and shuffles
nothing; what it gets sent is bounded by the parameters above.

Defined results: texts without a vocabulary term (null and empty ones too) have no neighbours and get the share of
toxic rows among such examples; without labelled rows the score is 0. Repeated rows get equal scores. A null doc_id
has held_out false and is never an example. Of several labels for a document the largest counts. Columns other than
the ones named are not read; label, lang, source and doc_id never enter a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import saved

MAX_TOXIC, MAX_CLEAN = 6_000, 12_000
MAX_TERMS = 4_096
# a term must be in a quarter of as many examples as there are toxic ones (3 at least) and reach a fifth of the largest
# chi-square that the examples allow, up to these figures
LEAST_DF, LEAST_CHI2, LEAST_RATIO = 8, 25.0, 4.0
NEAREST = 15
BLOCK = 64
CALIBRATE = 4_000
REJECT = 0.7
PREFIXES = (4, 5, 6)
WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    """The word and its beginnings; a beginning ends with a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


class Index:
    """Examples as unit vectors in an inverted index with a maximum for each term and block."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray, ids: np.ndarray, toxic: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], weights: tuple[float, float]):
        self.vocabulary, self.idf, self.class_weight = vocabulary, idf, weights
        main = [(int(t[np.argmax(w)]), -float(w.max()), int(i)) for (t, w), i in zip(vectors, ids, strict=True)]
        order = sorted(range(len(main)), key=main.__getitem__)
        self.ids, self.toxic = ids[order], toxic[order]
        self.blocks = -(-len(order) // BLOCK)
        self.bound = np.zeros((len(idf), self.blocks))
        at = np.concatenate([np.full(len(vectors[i][0]), p) for p, i in enumerate(order)] or [np.empty(0, int)]).astype(np.int64)
        term = np.concatenate([vectors[i][0] for i in order] or [np.empty(0, int)]).astype(np.int64)
        weight = np.concatenate([vectors[i][1] for i in order] or [np.empty(0)])
        np.maximum.at(self.bound, (term, at // BLOCK), weight)
        by = np.lexsort((at, term))
        self.at, self.weight = at[by], weight[by]
        # postings of term t in block b: starts[t * blocks + b] to the next start
        self.starts = np.searchsorted(term[by] * self.blocks + self.at // BLOCK, np.arange(len(idf) * self.blocks + 1))
        self.prior, self.steps = 0.0, (np.array([0.0]), np.array([0.0]))

    def vector(self, words: list[str], known: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray] | None:
        """Unit TF-IDF vector of a text's words; none without a vocabulary term. known: terms by word seen so far."""
        counts: Counter[int] = Counter()
        for word, n in Counter(words).items():
            terms = known.get(word)
            if terms is None:
                if len(known) > 400_000:
                    known.clear()
                terms = known[word] = tuple(self.vocabulary[t] for t in terms_of(word) if t in self.vocabulary)
            for t in terms:
                counts[t] += n
        if not counts:
            return None
        terms = np.array(sorted(counts))
        weights = (1 + np.log([counts[t] for t in terms.tolist()])) * self.idf[terms]
        return terms, weights / np.sqrt((weights**2).sum())

    def nearest(self, vector: tuple[np.ndarray, np.ndarray], skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(example, similarity) of the nearest, nearest first; skip: an example's position to leave out."""
        terms, weights = vector
        bounds = weights @ self.bound[terms]
        found_at, found, kth = np.empty(0, np.int64), np.empty(0), 0.0
        todo = np.argsort(-bounds, kind="stable")
        size, at = 4, 0
        while at < len(todo) and bounds[todo[at]] > 0 and bounds[todo[at]] >= kth - 1e-9:
            blocks = todo[at : at + size]
            blocks = blocks[(bounds[blocks] >= kth - 1e-9) & (bounds[blocks] > 0)]
            sums: dict[int, np.ndarray] = {}
            for b in blocks.tolist():
                sums[b] = np.zeros(BLOCK)
                for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
                    s, e = self.starts[t * self.blocks + b], self.starts[t * self.blocks + b + 1]
                    if s < e:
                        sums[b][self.at[s:e] - b * BLOCK] += w * self.weight[s:e]
            here = np.concatenate([b * BLOCK + np.arange(BLOCK) for b in sums])
            scores = np.concatenate(list(sums.values()))
            keep = scores > 0
            if skip is not None:
                keep &= here != skip
            found_at, found = np.concatenate((found_at, here[keep])), np.concatenate((found, np.round(scores[keep], 12)))
            best = np.lexsort((self.ids[found_at], -found))[:NEAREST]
            found_at, found = found_at[best], found[best]
            kth = found[-1] if len(found) == NEAREST else 0.0
            at, size = at + size, size * 2
        return found_at, found

    def vote(self, vector: tuple[np.ndarray, np.ndarray], skip: int | None = None) -> tuple[float, np.ndarray]:
        """Share of the weighted votes for toxic, and the examples that voted."""
        at, near = self.nearest(vector, skip)
        if not len(at):
            return self.prior, at
        weight = near**2 * np.where(self.toxic[at] == 1, self.class_weight[1], self.class_weight[0])
        return float(weight[self.toxic[at] == 1].sum() / weight.sum()), at

    def score(self, vector: tuple[np.ndarray, np.ndarray] | None) -> tuple[float, np.ndarray]:
        if vector is None or not len(self.ids):
            return self.prior, np.empty(0, np.int64)
        vote, at = self.vote(vector)
        return float(np.interp(vote, *self.steps)), at


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function nearest to the points, as knots to interpolate between."""
    knots, where = np.unique(x, return_inverse=True)
    mass, total = np.bincount(where, w), np.bincount(where, w * y)
    pools: list[list[float]] = []
    for k, m, t in zip(knots, mass, total, strict=True):
        pools.append([k, k, m, t])
        while len(pools) > 1 and pools[-2][3] / pools[-2][2] >= pools[-1][3] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    xs, ys = [], []
    for low, high, m, t in pools:
        xs += [low, high] if high > low else [low]
        ys += [t / m] * (2 if high > low else 1)
    return np.array(xs), np.array(ys)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Index:
    """An index fitted on labelled rows that are not held out."""
    spark = docs.sparkSession
    known = labels.select(labels[doc_id].alias("_id"), labels[label].cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y"))
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    share = [min(1.0, limit / max(1, counts.get(y, 0))) for y, limit in ((0, MAX_CLEAN), (1, MAX_TOXIC))]
    drawn = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("example")), F.lit(1_000_000)) < F.when(F.col("_y") == 1, int(share[1] * 1e6)).otherwise(int(share[0] * 1e6))
    # the ids are a sample of a bounded size, so they may be broadcast
    chosen = docs.select(docs[doc_id].alias("_id"), docs[text].cast("string").alias("_text")).join(F.broadcast(known.where(drawn)), "_id")
    examples = saved(chosen.dropDuplicates(["_id"]).select(F.col("_id").cast("bigint").alias("_id"), "_y", "_text"))

    def count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pd.DataFrame:
            names = list(seen[0].keys() | seen[1].keys())
            out = pd.DataFrame({"term": names, "clean": [seen[0][t] for t in names], "toxic": [seen[1][t] for t in names]})
            seen[0].clear(), seen[1].clear()
            return out

        for batch in batches:
            for y, t in zip(batch["_y"], batch["_text"], strict=True):
                words = set(WORD.findall((t or "").lower()))
                seen[y].update({x for w in words for x in terms_of(w)})
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield flush()
        yield flush()

    sizes = {r["_y"]: r["count"] for r in examples.groupBy("_y").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not toxic:
        return Index({}, np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64), [], (1.0, 1.0))
    total = examples.mapInPandas(count_terms, "term string, clean bigint, toxic bigint").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    n, df = float(clean + toxic), a + b
    expected = df * toxic / n
    chi2 = (a - expected) ** 2 * n * n / (df * (n - df + 1e-9) * toxic * max(clean, 1) / n)
    ratio = ((a + 0.5) / (toxic + 1.0)) / ((b + 0.5) / (clean + 1.0))
    least_df, least_chi2 = min(LEAST_DF, max(3, -(-toxic // 4))), min(LEAST_CHI2, n / 5)
    terms = total.withColumn("df", df).withColumn("chi2", chi2).where((df >= least_df) & (F.col("chi2") >= least_chi2) & ((ratio >= LEAST_RATIO) | (ratio <= 1 / LEAST_RATIO)))
    best = terms.orderBy(F.desc("chi2"), "term").limit(MAX_TERMS).select("term", "df").collect()
    vocabulary = {r["term"]: i for i, r in enumerate(best)}
    idf = np.array([np.log((n + 1) / (r["df"] + 1)) + 1 for r in best])
    empty = Index(vocabulary, idf, np.empty(0, np.int64), np.empty(0, np.int64), [], (1.0, 1.0))

    def to_vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            made = [empty.vector(WORD.findall((t or "").lower()), seen) for t in batch["_text"]]
            yield pd.DataFrame({"id": batch["_id"], "y": batch["_y"], "t": [v[0].tolist() if v else [] for v in made], "w": [v[1].tolist() if v else [] for v in made]})

    rows = sorted(examples.mapInPandas(to_vectors, "id bigint, y int, t array<int>, w array<double>").collect())
    with_terms = [r for r in rows if r["t"]]
    # one drawn row stands for so many rows of its class
    stands = (counts.get(0, 0) / max(1, clean), counts.get(1, 0) / max(1, toxic))
    vectors = [(np.array(r["t"], np.int64), np.array(r["w"])) for r in with_terms]
    index = Index(vocabulary, idf, np.array([r["id"] for r in with_terms], np.int64), np.array([r["y"] for r in with_terms], np.int64), vectors, stands)
    bare = [r["y"] for r in rows if not r["t"]]
    mass = sum(stands[y] for y in bare)
    index.prior = sum(stands[y] for y in bare if y) / mass if mass else counts.get(1, 0) / sum(counts.values())
    place = {int(i): p for p, i in enumerate(index.ids)}
    step = max(1, len(with_terms) // CALIBRATE)
    tried = [(index.vote(v, place[r["id"]])[0], r["y"], stands[r["y"]]) for r, v in list(zip(with_terms, vectors, strict=True))[::step]]
    if tried:
        index.steps = isotonic(*(np.array(x, dtype=float) for x in zip(*tried, strict=True)))
    return index


def score(docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the kept columns, held_out, score, predicted and evidence (the nearest examples' ids)."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(index))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, seen = Index.__new__(Index), {}
        vars(model).update(sent.value)
        for batch in batches:
            made = [model.score(model.vector(WORD.findall((t or "").lower()), seen)) for t in batch.pop("_text")]
            yield batch.assign(score=[s for s, _ in made], evidence=[model.ids[at].tolist() for _, at in made])

    source = docs.select(docs[doc_id].alias("doc_id"), *keep, docs[text].cast("string").alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    scored = source.mapInPandas(run, f"{kinds}, score double, evidence array<bigint>")
    return scored.select("doc_id", *keep, held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, index: Index, text: str = "text") -> DataFrame:
    """The documents that score below the limit, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(vars(index))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, seen = Index.__new__(Index), {}
        vars(model).update(sent.value)
        for texts in batches:
            yield pd.Series([model.score(model.vector(WORD.findall((t or "").lower()), seen))[0] for t in texts], dtype="float64")

    scored = F.pandas_udf(run, "double")(docs[text].cast("string"))
    return docs.where(scored < REJECT)
