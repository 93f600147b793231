"""Phrase collocations by marginalising the longest windows.

Every word occurrence opens exactly one window: the word and the words that follow it in its piece, in as many lead
columns as the longest phrase has words, padded by '' behind the piece's end. Only these windows are counted. The
count of a shorter phrase is the sum over all windows that begin with it, so ROLLUP over the counted windows gives
the counts of all shorter prefixes down to the total of the language, and no other n-grams are ever exploded.

A task numbers the words of some documents, shifts the numbers into lead columns and counts equal windows in sorted
order, a bounded number of words at a time; what leaves it are windows with counts, so a frequent phrase is a few rows
per task. They are dealt out by their first two words, so windows that share them meet: phrases of two words and more
are summed where they lie, each pair once for itself and its first word, and ROLLUP over the words sums totals. Later tables hold phrases of at least ``least`` occurrences only. The best of a language are
picked in two steps, so that no task sees more than a bounded number of rows per lot.

Defined results: null texts are empty, a null language is 'und'; very long texts count whole; repeated rows count
each; equal scores are ordered by count, then by the bytes of the phrase; an empty table gives no row. Only the named
columns are read. Scores are exact integers: products are made in 38 decimal digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import saved

# piece ends become line feeds, tabs become spaces; all are single bytes in UTF-8
MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
HELD_WORDS = 2_000_000
BATCH_ROWS = 100_000
LOTS = 64


class _Numbers(dict):
    """Numbers of one language's words, drawn from a list that all languages share."""

    def __init__(self, words: list[bytes], langs: list[int], lang: int):
        super().__init__({b"\n": 0, b"": -1})
        self.words, self.langs, self.lang = words, langs, lang

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return number


class _Held:
    """Windows of the documents seen since the last emptying."""

    def __init__(self, longest: int):
        self.longest = longest
        self.reset()

    def reset(self) -> None:
        self.words: list[bytes] = [b""]  # number 0 ends a piece, and pads
        self.langs: list[int] = [0]
        self.names: list[str] = []
        self.numbers: dict[str, _Numbers] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: str) -> None:
        numbers = self.numbers.get(lang)
        if numbers is None:
            numbers = self.numbers[lang] = _Numbers(self.words, self.langs, len(self.names))
            self.names.append(lang)
        tokens = text.encode("utf-8").lower().translate(MARKS).replace(b"\n", b" \n ").split(b" ")
        tokens.append(b"\n")
        part = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
        self.parts.append(part[part >= 0])
        self.size += len(self.parts[-1])

    def counted(self) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, f) of all held windows, the padding left off."""
        first = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)
        base, columns = len(self.words), [first]
        for i in range(1, self.longest):
            lead = np.append(first[i:], np.zeros(min(i, len(first)), np.int64))
            lead = np.where(columns[-1] == 0, 0, lead)  # behind the end of a piece is padding only
            columns.append(lead)
        opens = first > 0
        columns = [c[opens] for c in columns]
        if not len(columns[0]):
            return
        # numbers in one integer as far as 63 bits go; beyond, equal heads are numbered anew
        key, room = columns[0], base
        for lead in columns[1:]:
            if room * base >= 1 << 63:
                heads, key = np.unique(key, return_inverse=True)
                room = len(heads)
            key, room = key * base + lead, room * base
        _, at, count = np.unique(key, return_index=True, return_counts=True)
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        names, langs = pa.array(self.names, pa.string()), np.array(self.langs)
        for start in range(0, len(at), BATCH_ROWS):
            rows = at[start : start + BATCH_ROWS]
            lang = names.take(pa.array(langs[columns[0][rows]]))
            phrase = words.take(pa.array(columns[0][rows]))
            for c in columns[1:]:
                word = words.take(pa.array(c[rows]))
                phrase = pc.if_else(pc.equal(word, ""), phrase, pc.binary_join_element_wise(phrase, word, " "))
            yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(count[start : start + BATCH_ROWS])], names=["lang", "phrase", "f"])


def counted_windows(docs: DataFrame, longest: int = 3, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, f): windows of word occurrences with as many of the following words as the piece has, and how often
    each was met (a row per task and some million words). Words hold no spaces, so the text says which they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(longest)
        for batch in batches:
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.add(name, words.as_py())
                if held.size >= HELD_WORDS:
                    yield from held.counted()
                    held.reset()
        yield from held.counted()

    source = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")), F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"))
    return source.mapInArrow(run, "lang string, phrase string, f bigint")


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 1, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, f) of all phrases of 1 to ``longest`` words with at least ``least`` occurrences, and (lang, n)
    with all word occurrences."""
    if longest < 2:
        raise ValueError("a phrase has two words at least")
    head = lambda n: F.substring_index("phrase", " ", n)
    dealt = counted_windows(docs, longest, text, lang).repartition("lang", head(2)).select("lang", head(2).alias("pair"), "phrase", "f")
    parts = []
    # phrases of two words and more are summed without a shuffle, as all windows that share two words lie together; the
    # filter names the count, so it can't slip below the shuffle, which all levels read, and splits only frequent phrases
    frequent = lambda phrase, m: F.when(F.col("f") >= least, F.size(F.split(phrase, " ")) == m).otherwise(False)
    for m in range(longest, 2, -1):
        level = dealt.groupBy("lang", "pair", (head(m) if m < longest else F.col("phrase")).alias("phrase")).agg(F.sum("f").alias("f"))
        parts.append(level.where(frequent("phrase", m)).select("lang", "phrase", F.lit(m).alias("m"), "f"))
    # a pair is summed once: it counts for its first word, and by itself where it is frequent
    pairs = dealt.groupBy("lang", "pair").agg(F.sum("f").alias("f"))
    word = F.struct(F.substring_index("pair", " ", 1).alias("phrase"), F.lit(1).alias("m"))
    itself = F.struct(F.col("pair").alias("phrase"), F.lit(2).alias("m"))
    short = pairs.select("lang", "f", F.inline(F.when(frequent("pair", 2), F.array(word, itself)).otherwise(F.array(word))))
    short = short.groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f"))
    only = lambda m: short.where(F.when(F.col("f") > 0, F.col("m") == m).otherwise(False))
    parts.append(only(2).select("lang", "phrase", "m", "f"))
    # words, their languages and all: a rolled-up word is null
    sums = only(1).select("lang", F.col("phrase").alias("w1"), "f").rollup("lang", "w1").agg(F.sum("f").alias("f"))
    known = sums.where(F.col("lang").isNotNull() & ((F.col("f") >= least) | F.col("w1").isNull()))
    parts.append(known.select("lang", F.coalesce("w1", F.lit("")).alias("phrase"), F.col("w1").isNotNull().cast("int").alias("m"), "f"))
    counts = saved(reduce(DataFrame.unionByName, parts))
    return counts.where("m > 0"), counts.where("m = 0").select("lang", F.col("f").alias("n"))


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def cut_scores(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the cut that scores lowest, the earliest on ties."""
    words, k = F.split("phrase", " "), F.col("k")
    cuts = candidates.select("lang", "phrase", "a", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part(words, F.lit(1), k).alias("first"), _part(words, k + 1, F.col("m") - k).alias("rest")
    )
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    big = "decimal(20,0)"
    both = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    score = F.expr(f"(cast(a as {big}) * cast(a as {big}) * 1000000) div (cast(l as {big}) * cast(r as {big}))")
    best = both.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")


def outside_longer(candidates: DataFrame, share: int = 50) -> DataFrame:
    """Candidates that no longer candidate contains with at least ``share`` per cent of their occurrences."""
    words = F.split("phrase", " ")
    spans = candidates.where("m > 2").select("lang", "a", words.alias("w"), "m", F.explode(F.sequence(F.lit(2), F.col("m") - 1)).alias("size"))
    parts = spans.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("size") + 1)).alias("start"))
    within = parts.groupBy("lang", _part(F.col("w"), F.col("start"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    joined = candidates.join(within, ["lang", "phrase"], "left")
    return joined.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def best_per_language(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank, by score, count and phrase."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    lots = scored.withColumn("lot", F.pmod(F.xxhash64("phrase"), F.lit(LOTS)))
    held = lots.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "lot").orderBy(*order))).where(F.col("rank") <= top)
    ranked = held.drop("lot", "rank").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases whose words stand together most tellingly."""
    counts, totals = phrase_counts(docs, longest, least, text, lang)
    candidates = counts.where("m > 1").withColumnRenamed("f", "a")
    scored = cut_scores(outside_longer(candidates, share), counts)
    ranked = best_per_language(scored, top).join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
