"""Removal of repeated byte strings with suffix arrays built by a difference cover.

A byte goes if a string of ``length`` bytes (a window) that covers it also starts somewhere else, in the same text or
another. Windows are first dealt into buckets by content: a window's bucket is the least, by hash, of its 64-byte runs,
so equal windows share a bucket wherever they stand. Neighbouring windows of a bucket make a block. Buckets seen once
can't hold a repeat; equal blocks are repeats throughout and one of them stands for all. For what is left, buckets with
different blocks, a suffix array is built by a distributed difference cover, bucket by bucket in as many tasks as
there are: triples of 8-byte words at two of every three places are sorted and named, the names are sorted as triples
again (24, 72, 216 bytes), the remaining suffixes are merged in by the ranks of those that follow them, and neighbours
in the order are compared over ``length`` bytes.

Nothing is collected: a task holds some buckets of at most ``MOST`` different blocks. The windows of larger buckets are
compared by 128-bit names, counted before the shuffle, so a passage in any number of contexts stays distributed. Lists
kept per document are bounded by its length.

Defined results: null and empty texts have no bytes and no spans; texts shorter than the window are kept; all rows
of a repeated text lose it whole if it has a window; a row is named by its doc_id and text, so repeated rows and null ids
work as others do. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import SMALL, forget, free, saved

LENGTH = 200
MOST = 4_000  # different blocks of a bucket that one task compares
BATCH = 1_500_000  # bytes of blocks that are sorted together
GRAM = 64  # bytes of the string that names a window's bucket
SEGMENT = 1 << 19  # bytes that are hashed in one go
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A well mixed 64-bit hash of each run of ``gram`` (a power of two) bytes."""
    h, size, factor = data.astype(np.uint64) + np.uint64(1), 1, MULTIPLY
    while size < gram:
        h = h[:-size] * factor + h[size:]
        factor = factor * factor
        size *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def blocks(data: bytes, lengths: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Windows of ``length`` bytes inside each of the strings that data is made of, grouped by the least of the hashes
    of their ``gram``-byte runs: (string, start, windows, key, sign) for each run of neighbouring windows with
    the same least run. Equal windows have equal keys, wherever they stand; equal blocks have equal signs."""
    none = tuple(np.empty(0, np.int64) for _ in range(5))
    if len(data) < length:
        return none
    with np.errstate(over="ignore"):
        hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    width, low = length - gram + 1, np.uint64((1 << 20) - 1)
    least, size = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    at = (least & low).astype(np.int64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)[: len(at)]
    inside = np.arange(len(at)) + length <= ends[owner]
    change = np.ones(len(at), bool)
    change[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
    heads = np.nonzero(change)[0]
    counts = np.diff(np.append(heads, len(at)))
    kept = inside[heads]
    heads, counts = heads[kept], counts[kept]
    if not len(heads):
        return none
    digest = xxhash.xxh3_64_digest
    signs = np.frombuffer(b"".join([digest(data[a : a + n]) for a, n in zip(heads.tolist(), (counts + length - 1).tolist(), strict=True)]), ">u8")
    who = owner[heads]
    return who, heads - (ends - lengths)[who], counts, hashes[at[heads]].view(np.int64), signs.astype(np.uint64).view(np.int64)


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the keys, equal for equal ones."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else 0
    return ranks


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)


def _merged(places: np.ndarray, kind: np.ndarray, symbol: np.ndarray, rank: np.ndarray, step: int) -> np.ndarray:
    """The order of all places, given symbols and the ranks of those of kind 1 and 2. A place of kind 0 meets kind 1 by
    its symbol and the rank that follows, and kind 2 by two symbols and the rank after them."""
    zero, one, two = (places[kind == k] for k in range(3))
    pairs = np.zeros(len(symbol), np.int64)
    ahead = np.concatenate((zero, two))
    pairs[ahead] = _dense(_pair(symbol[ahead], symbol[ahead + step]))
    with_one, with_two = (lambda p: _pair(symbol[p], rank[p + step])), (lambda p: _pair(pairs[p], rank[p + 2 * step]))
    zero = zero[np.argsort(with_one(zero), kind="stable")]
    both = np.concatenate((one, two))
    both = both[np.argsort(rank[both], kind="stable")]
    of_one, of_two = np.sort(with_one(one)), np.sort(with_two(two))
    at_zero = np.arange(len(zero)) + np.searchsorted(of_one, with_one(zero)) + np.searchsorted(of_two, with_two(zero))
    before = np.zeros(len(both), np.int64)
    is_two = np.zeros(len(symbol), bool)
    is_two[two] = True
    second = is_two[both]
    before[~second] = np.searchsorted(with_one(zero), with_one(both[~second]), side="right")
    before[second] = np.searchsorted(np.sort(with_two(zero)), with_two(both[second]), side="right")
    everyone = np.concatenate((zero, both))
    return everyone[np.argsort(np.concatenate((at_zero, np.arange(len(both)) + before)), kind="stable")]


def sorted_places(data: bytes, wanted: np.ndarray) -> np.ndarray:
    """The wanted places of data in the order of the suffixes that start there, true over the first 216 bytes."""
    room = 2 * 216 + 64
    raw = np.frombuffer(data + bytes(room), np.uint8)
    n = len(data) + room - 8
    words = np.lib.stride_tricks.sliding_window_view(raw, 8)[:n].copy().view(">u8").ravel().astype(np.uint64)
    everywhere = np.arange(len(data))
    if len(data) * 2 // 3 >= 1 << 21:
        raise ValueError("more places than names")
    # names of 24, 72 and 216 bytes, each at two of three places of the one before
    step, places, names = 8, everywhere, []
    symbol = None
    for level in range(3):
        kind = (places // step) % 3
        sample = places[kind > 0]
        named = np.zeros(n + 2 * 216, np.int64)
        if symbol is None:
            order = np.lexsort((words[sample + 16], words[sample + 8], words[sample]))
            by = sample[order]
            fresh = np.ones(len(by), bool)
            fresh[1:] = (words[by[1:]] != words[by[:-1]]) | (words[by[1:] + 8] != words[by[:-1] + 8]) | (words[by[1:] + 16] != words[by[:-1] + 16])
            named[by] = np.cumsum(fresh)
        else:
            named[sample] = _dense((symbol[sample] << 42) | (symbol[sample + step] << 21) | symbol[sample + 2 * step])
        names.append((places, kind, symbol, step))
        step, places, symbol = step * 3, sample, named
    rank = symbol
    for places, kind, symbol, step in reversed(names[1:]):
        order = _merged(places, kind, symbol, rank, step)
        rank = np.zeros_like(rank)
        rank[order] = np.arange(1, len(order) + 1)
    kind = (wanted // 8) % 3
    symbol = np.zeros(n + 2 * 216, np.int64)
    needed = np.unique(np.concatenate((wanted, wanted + 8)))
    symbol[needed] = _dense(words[needed])
    return _merged(wanted, kind, symbol, rank, 8)


def repeats(data: bytes, wanted: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the wanted places begin a string of ``length`` (at most 216) bytes that begins at another, too. All
    lie at least as far from the end of data."""
    order = sorted_places(data, wanted)
    raw = np.frombuffer(data, np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(raw, 8)
    same = np.arange(len(order) - 1)
    # prefixes of neighbours, eight bytes at a time; the last eight may overlap
    for at in [*range(0, length - 8, 8), length - 8]:
        same = same[(words[order[same] + at] == words[order[same + 1] + at]).all(axis=1)]
    found = np.zeros(len(data), bool)
    found[order[same]] = found[order[same + 1]] = True
    return found[wanted]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    text_col = docs[text].cast("string")
    return docs.select(docs[doc_id].alias("doc_id"), text_col.alias("text"), F.coalesce(docs[doc_id].cast("bigint"), F.lit(-(2**63))).alias("_d"), F.xxhash64(text_col).alias("_t"))


def spans(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """(_d, _t, starts, ends): the maximal runs of bytes to remove, for each document that has any; a saved table."""
    if not 2 * GRAM <= length <= 216:
        raise ValueError(f"the length must lie between {2 * GRAM} and 216")
    rows = _rows(docs, doc_id, text)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(held: list) -> pd.DataFrame:
            who, start, n, key, sign = blocks(b"".join(x[2] for x in held), np.array([len(x[2]) for x in held]), length)
            first = np.array([x[3] for x in held], np.int64)
            return pd.DataFrame({"_d": np.array([x[0] for x in held], np.int64)[who], "_t": np.array([x[1] for x in held], np.int64)[who], "start": start + first[who], "n": n.astype(np.int32), "key": key, "sign": sign})

        for batch in batches:
            held, size = [], 0
            for d, t, x in zip(batch["_d"], batch["_t"], batch["text"], strict=True):
                whole = x.encode()
                for at in range(0, max(1, len(whole) - length + 1), SEGMENT):  # a longer text in segments that share a window less one byte
                    part = whole[at : at + SEGMENT + length - 1] if len(whole) > SEGMENT else whole
                    if len(part) >= length:
                        held.append((d, t, part, at))
                        size += len(part)
                    if size >= SEGMENT or len(whole) <= SEGMENT and size + len(whole) > SEGMENT:
                        yield flush(held)
                        held, size = [], 0
                    if len(whole) <= SEGMENT:
                        break
            if held:
                yield flush(held)

    long_enough = rows.where(F.octet_length("text") >= length).select("_d", "_t", "text")
    dealt = saved(long_enough.mapInPandas(deal, "_d bigint, _t bigint, start bigint, n int, key bigint, sign bigint"))
    # on disk first, so that the join below meets two plain exchanges and can split a key that very many blocks have
    shared = saved(dealt.groupBy("key").agg(F.count("*").alias("seen"), F.min("sign").alias("low"), F.max("sign").alias("high")).where("seen > 1").select("key", (F.col("low") != F.col("high")).alias("mixed")))
    # dealt out anew, so that equal blocks lie in many files and the join with their class can split them, too
    again = saved(dealt.join(shared, "key").hint("rebalance"))
    forget(dealt, shared)
    # in a bucket of one block every row is a copy; only buckets of several must be told apart by block
    mixed = again.where("mixed")
    classes = saved(mixed.groupBy("key", "sign").agg(F.count("*").alias("copies"), F.min(F.struct("_d", "_t", "start", "n")).alias("at")))
    copied = mixed.join(classes.where("copies > 1").select("key", "sign"), ["key", "sign"], "left_semi")
    whole = again.where("not mixed").select("_d", "_t", "start", "n").unionByName(copied.select("_d", "_t", "start", "n"))

    sizes = classes.groupBy("key").agg(F.count("*").alias("different"), F.min("copies").alias("fewest")).where("fewest = 1").select("key", "different")
    open_ = classes.join(sizes, "key").select("key", "different", "copies", "at._d", "at._t", "at.start", "at.n")
    asked = open_.groupBy("_d", "_t").agg(F.collect_list(F.struct("key", "different", "copies", "start", "n")).alias("asked"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, t, x, asked in zip(batch["_d"], batch["_t"], batch["text"], batch["asked"], strict=True):
                whole = x.encode()
                out += [(a["key"], a["different"], a["copies"], d, t, a["start"], a["n"], whole[a["start"] : a["start"] + a["n"] + length - 1]) for a in asked]
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=parts)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=parts)

    parts = ["key", "different", "copies", "_d", "_t", "start", "n", "bytes"]
    # repeated rows have the same name: each asks for its part, one is enough
    texts = rows.select("_d", "_t", "text").join(asked.hint("shuffle_hash"), ["_d", "_t"]).dropDuplicates(["_d", "_t"])
    cuts = saved(texts.mapInPandas(cut, "key bigint, different bigint, copies bigint, _d bigint, _t bigint, start bigint, n int, bytes binary"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def settle(held: list) -> pd.DataFrame:
            sizes = np.array([len(x[5]) for x in held], np.int64)
            n = np.array([x[4] for x in held], np.int64)
            begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            block = np.repeat(np.arange(len(held)), n)
            inside = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
            found = repeats(b"".join(x[5] for x in held), begins[block] + inside, length)
            found &= np.array([x[1] for x in held])[block] == 1  # the others are repeats as a whole
            edge = np.diff(np.concatenate(([False], found, [False])).astype(np.int8))
            # runs of windows, cut where a block ends
            cutting = np.concatenate(([True], block[1:] != block[:-1])) if len(block) else np.empty(0, bool)
            heads = np.nonzero(found & (cutting | (edge[:-1] == 1)))[0]
            if not len(heads):
                return pd.DataFrame({"_d": [], "_t": [], "start": [], "n": []}).astype(np.int64)
            stops = np.nonzero(found & np.concatenate((cutting[1:] | (edge[1:-1] == -1), [True])))[0]
            who = block[heads]
            start = np.array([x[3][2] for x in held], np.int64)
            return pd.DataFrame({"_d": np.array([x[3][0] for x in held], np.int64)[who], "_t": np.array([x[3][1] for x in held], np.int64)[who], "start": start[who] + inside[heads], "n": stops - heads + 1})

        held, size, key = [], 0, None
        for batch in batches:
            for k, copies, d, t, start, n, data in zip(batch["key"], batch["copies"], batch["_d"], batch["_t"], batch["start"], batch["n"], batch["bytes"], strict=True):
                if k != key and size >= BATCH:
                    yield settle(held)
                    held, size = [], 0
                key = k
                held.append((k, copies, None, (d, t, start), n, data))
                size += len(data)
        if held:
            yield settle(held)

    few = cuts.where(F.col("different") <= most).drop("different").repartition("key").sortWithinPartitions("key")
    partly = few.mapInPandas(compare, "_d bigint, _t bigint, start bigint, n bigint")

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for copies, d, t, start, n, data in zip(batch["copies"], batch["_d"], batch["_t"], batch["start"], batch["n"], batch["bytes"], strict=True):
                made = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[i : i + length]) for i in range(n)]), ">i8").astype(np.int64).reshape(-1, 2)
                yield pd.DataFrame({"a": made[:, 0], "b": made[:, 1], "copies": copies, "_d": d, "_t": t, "start": start + np.arange(n)})

    singly = cuts.where(F.col("different") > most).drop("different", "key").mapInPandas(name, "a bigint, b bigint, copies bigint, _d bigint, _t bigint, start bigint")
    often = singly.groupBy("a", "b").agg(F.count("*").alias("seen")).where("seen > 1")
    by_name = singly.where("copies = 1").join(often, ["a", "b"], "left_semi").select("_d", "_t", "start", F.lit(1).cast("bigint").alias("n"))

    found = whole.select("_d", "_t", "start", F.col("n").cast("bigint").alias("n")).unionByName(partly).unionByName(by_name)
    grouped = found.groupBy("_d", "_t").agg(F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("n") + length - 1).alias("end")))).alias("runs"))

    def join_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            firsts, lasts = [], []
            for runs in batch["runs"]:
                a, b = np.array([r["start"] for r in runs], np.int64), np.array([r["end"] for r in runs], np.int64)
                reach = np.maximum.accumulate(b)
                gap = np.concatenate(([True], a[1:] > reach[:-1]))
                firsts.append(a[gap].tolist())
                lasts.append(reach[np.concatenate((gap[1:], [True]))].tolist())
            yield pd.DataFrame({"_d": batch["_d"], "_t": batch["_t"], "starts": firsts, "ends": lasts})

    merged = saved(grouped.mapInPandas(join_runs, "_d bigint, _t bigint, starts array<bigint>, ends array<bigint>"))
    forget(again, classes, cuts)
    return merged


def _kept(whole: bytes, starts, ends) -> bytes:
    if starts is None:
        return whole
    at = [0, *ends]
    return b"".join([whole[a:b] for a, b in zip(at, [*starts, len(whole)], strict=True)])


def _with_spans(docs: DataFrame, length: int, doc_id: str, text: str) -> tuple[DataFrame, str, str]:
    """The documents with the first and last bytes of their spans, in columns of the names returned."""
    found = spans(docs, length, doc_id, text)
    d, t, starts, ends = free(docs, "_d", "_t", "starts", "ends")
    rows = docs.withColumns({d: F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63))), t: F.xxhash64(F.col(text).cast("string"))})
    # broadcast only if all spans, not only the rows that hold them, are few
    few = (found.agg(F.sum(F.size("starts"))).first()[0] or 0) <= SMALL
    named = found.toDF(d, t, starts, ends)
    return rows.join(F.broadcast(named) if few else named, [d, t], "left"), starts, ends


def digest(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    import hashlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for x, starts, ends in zip(batch["text"], batch["starts"], batch["ends"], strict=True):
                whole = (x or "").encode()
                kept = _kept(whole, starts, ends)
                out.append((len(whole), len(whole) - len(kept), 0 if starts is None else len(starts), hashlib.sha256(kept).hexdigest()))
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])], axis=1)

    joined, _, _ = _with_spans(docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text")), length, "doc_id", "text")
    return joined.select("doc_id", "text", "starts", "ends").mapInPandas(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their texts less the repeated bytes; a character that is cut in two goes whole. Texts that
    lose nothing are as they were; all columns stay."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if x is None else _kept(x.encode(), s, e).decode("utf-8", "ignore") for x, s, e in zip(batch["text"], batch["starts"], batch["ends"], strict=True)])

    joined, starts, ends = _with_spans(docs, length, doc_id, text)
    shorter = F.pandas_udf(run, "string")(F.struct(F.col(text).cast("string").alias("text"), F.col(starts).alias("starts"), F.col(ends).alias("ends")))
    return joined.withColumn(text, F.when(F.col(starts).isNull(), F.col(text)).otherwise(shorter)).select(*docs.columns)
