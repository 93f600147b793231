"""Benchmark decontamination with a positional inverted index, in DataFrame functions only.

A window is a run of ``length`` item words (the whole item if it has fewer). The corpus frequency of every
benchmark term is counted first; windows with a term that the corpus lacks can't occur. For each other window the
postings (term, document, position) of its two rarest terms are stored as the index. The lists of the rarest term,
moved by the term's offset in the window, are intersected with those of the second; what is left is checked word
by word at its place, with ``slop`` 0 as exact phrase, with more as proximity match: every term within ``slop`` words
of its place.

The benchmark side (terms, windows) and the names of the candidate documents (two numbers each) are broadcast only while
they are counted to be at most ``SMALL`` rows; beyond that the joins are ordinary ones. Postings of a frequent term lie in many tasks, and no list of a term is collected.

Defined results: null and empty texts and items have no words, windows or hits. A repeated document row has its own
result row, equal to its twin's. A null doc_id is a document like any other. Items without an id count for hits but
not as items; equal items are all reported. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import SMALL, WORD_BREAK, ascii_lower, forget, free, raw_words, saved, small


def _split(text: Column) -> Column:
    """Words as written, at raw places: a text that begins or ends outside a word has an empty first or last."""
    return F.split(F.coalesce(text, F.lit("")), WORD_BREAK, -1)


def _word_count(words: Column) -> Column:
    edge = F.when(F.element_at(words, 1) == "", 1).otherwise(0) + F.when((F.size(words) > 1) & (F.element_at(words, -1) == ""), 1).otherwise(0)
    return (F.size(words) - edge).cast("bigint")


def windows(items: DataFrame, length: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, terms, item_id): every window of every item; window is the terms joined by spaces."""
    words = items.select(items[item_id].cast("string").alias("item_id"), raw_words(ascii_lower(items[text].cast("string"))).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - length + 1, F.lit(1)))
    cut = words.withColumn("start", F.explode(starts)).select("item_id", F.slice("words", F.col("start"), F.lit(length)).alias("terms"))
    return cut.select(F.array_join("terms", " ").alias("window"), "terms", "item_id").distinct()


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, whole text and the pair of columns that names a row (repeated rows share it)."""
    text_col = docs[text].cast("string")
    return docs.select(docs[doc_id].alias("doc_id"), text_col.alias("text"), F.coalesce(docs[doc_id].cast("bigint"), F.lit(-(2**63))).alias("_d"), F.xxhash64(text_col).alias("_t"))


def term_postings(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, _d, _t, pos) of each occurrence of a term."""
    every = rows.select("_d", "_t", F.posexplode(_split(F.col("text"))).alias("pos", "word")).where("word <> ''")
    return every.select("_d", "_t", "pos", ascii_lower(F.col("word")).alias("term")).join(small(terms), "term")


def occurrences(docs: DataFrame, items: DataFrame, length: int = 10, slop: int = 0, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(_d, _t, hits) per document with matches, hits an array of (start, n, window), start the raw place of the
    first word; and the table of windows. Proximity matches (slop > 0) have the place their rarest term asks for."""
    rows = keyed(docs, doc_id, text)
    wins = saved(windows(items, length, item_id, item_text))
    spread = wins.select("window", F.posexplode("terms").alias("offset", "term")).distinct()
    terms = saved(spread.select("term").distinct())
    counted = saved(term_postings(rows, terms).groupBy("term").agg(F.count("*").alias("n")))
    ranked = spread.join(counted, "term", "left").groupBy("window").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))).alias("by"))
    able = ranked.where(F.col("by")[0]["n"] > 0)
    last = F.least(F.size("by"), F.lit(2)) - 1
    anchors = saved(able.select("window", F.size("by").alias("n"), F.col("by")[0]["term"].alias("term"), F.col("by")[0]["offset"].alias("off"), F.get("by", last)["term"].alias("term2"), F.get("by", last)["offset"].alias("off2")))
    rare = saved(anchors.select("term").unionAll(anchors.select(F.col("term2").alias("term"))).distinct())
    index = saved(term_postings(rows, rare))

    first = index.join(small(anchors), "term").select("_d", "_t", (F.col("pos") - F.col("off")).alias("start"), "n", "window", "term2", "off2").where("start >= 0" if not slop else "true")
    second = index.select("_d", "_t", F.col("pos").alias("pos2"), F.col("term").alias("term2"))
    if slop:
        first = first.withColumn("move", F.explode(F.sequence(F.lit(-slop), F.lit(slop))))
        near = first.withColumn("pos2", F.col("start") + F.col("off2") + F.col("move")).drop("move")
    else:
        near = first.withColumn("pos2", F.col("start") + F.col("off2"))
    both = near.join(second, ["_d", "_t", "pos2", "term2"], "left_semi").select("_d", "_t", "start", "n", "window")
    # hits of one document, a bounded list: it has no more starts than words
    grouped = saved(both.distinct().groupBy("_d", "_t").agg(F.collect_list(F.struct("start", "n", "window")).alias("hits")))

    # texts without a candidate stay where they are, as long as the names of the others are few
    names = grouped.select("_d", "_t")
    asked = rows.join(F.broadcast(names), ["_d", "_t"], "left_semi") if names.count() <= SMALL else rows
    # cut into words below the aggregate: a projection above it would be moved into the test and cut the text for each hit
    cut = asked.select("_d", "_t", _split(ascii_lower(F.col("text"))).alias("words"))
    texts = cut.join(grouped.hint("shuffle_hash"), ["_d", "_t"]).dropDuplicates(["_d", "_t"])
    if slop:
        def fits(h: Column) -> Column:
            asked = F.split(h["window"], " ")
            return F.forall(F.transform(asked, lambda t, i: F.array_contains(F.slice(F.col("words"), F.greatest(h["start"] + i - slop, F.lit(0)) + 1, F.lit(2 * slop + 1)), t)), lambda ok: ok)
    else:
        def fits(h: Column) -> Column:
            return F.array_join(F.slice(F.col("words"), h["start"] + 1, h["n"]), " ") == h["window"]
    done = saved(texts.select("_d", "_t", F.filter("hits", fits).alias("hits"))).where(F.size("hits") > 0)
    forget(terms, counted, anchors, rare, index, grouped)
    return done, wins


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and _d, _t, the row's name."""
    found, wins = occurrences(docs, items, length, 0, doc_id, text, item_id, item_text)
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))))
    hits = found.select("_d", "_t", F.size(covered).cast("bigint").alias("n_hit"))
    said = found.select("_d", "_t", F.explode(F.array_distinct(F.transform("hits", lambda h: h["window"]))).alias("window"))
    of_items = said.join(small(wins), "window").select("_d", "_t", "item_id").where("item_id is not null").distinct()
    listed = of_items.groupBy("_d", "_t").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    per_row = saved(hits.join(listed, ["_d", "_t"], "left").select("_d", "_t", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"), F.coalesce(F.array_join("items", ","), F.lit("")).alias("items")))
    rows = keyed(docs, doc_id, text).select("doc_id", "_d", "_t", _word_count(_split(F.col("text"))).alias("n_words"))
    joined = rows.join(per_row, ["_d", "_t"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "_d", "_t")


def decontaminate(docs: DataFrame, items: DataFrame, length: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any window of the items; all columns as they are."""
    found, _ = occurrences(docs, items, length, 0, doc_id, text)
    d, t = free(docs, "_d", "_t")
    marked = docs.withColumns({d: F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))), t: F.xxhash64(F.col(text).cast("string"))})
    return marked.join(found.select(F.col("_d").alias(d), F.col("_t").alias(t)), [d, t], "left_anti").select(*docs.columns)
