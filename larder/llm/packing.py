"""Packing token sequences by non-negative least squares over length combinations.

Documents are tokenized where they lie; each is cut into full windows and one rest. Only the histogram of rest
lengths (at most ``window`` - 1 numbers, whatever the corpus) goes to the driver. There, all pairs and triples of
lengths at hand that fill a window exactly are enumerated (about ``window`` squared / 12), their repeat counts solved by
non-negative least squares against the histogram and rounded down; further rounds do the same with what remains as long
as that places pieces, and the last rests are packed greedily, longest first with the longest that still fits. The
outcome is a short list of recipes (lengths and how often); a piece finds its sequence by its number among the pieces of
its length.

Defined results: null and empty texts have only the end id; repeated rows are packed each for itself; documents are
taken in the order of doc_id, text digest within a length; an empty table gives no piece. Only the named columns are
read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import numbered, saved

# fixed values: the vocabulary's own split of a text, with the commonest case first, and the characters that all
# libraries class alike; texts with others, or with what may be a control string, go to the tokenizer itself
PRETOKEN = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+$|\s+(?!\S)|\s"
ODD = r"[^\t\n\r\x20-\x7E¡-ɏ‐-‧€]|<\|"
END = 0


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes, equal to those of the vocabulary's own library: tiktoken
    merges by the ranks of the same vocabulary, several times as fast."""

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer, self.odd = Tokenizer.from_file(path), re.compile(ODD).search
        # the file writes each byte as a printable character: itself, or the next free one from 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.merge = tiktoken.Encoding("ranks", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> bytes:
        if self.odd(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("I", self.merge(text)).tobytes()


def token_pieces(docs: DataFrame, vocabulary: str, window: int, doc_id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, tie[, ids]): each document cut into full windows and a rest."""
    if window < 2 or window & (window - 1):
        raise ValueError("the window must be a power of two")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = Encoder(vocabulary), np.array([END], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for i, t, tie in zip(batch["doc_id"].astype(object), batch["_text"], batch["tie"], strict=True):
                made = (encoder.encode(t) if t else b"") + end
                n = len(made) // 4
                for start in range(0, n, window):
                    part = made[4 * start : 4 * (start + window)]
                    out.append((None if pd.isna(i) else int(i), start, len(part) // 4, zlib.crc32(part), n, tie, *([part] if ids else [])))
            if out:
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "tie", *(["ids"] if ids else [])]
    text_col = docs[text].cast("string")
    source = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("_text"), F.xxhash64(text_col).alias("tie"))
    return source.mapInPandas(run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, tie bigint" + (", ids binary" if ids else ""))


def combinations(left: np.ndarray, window: int) -> np.ndarray:
    """All pairs and triples of lengths that are left and fill the window, longest first; a pair ends with 0."""
    have = np.nonzero(left)[0]
    there = left > 0
    there[0] = True  # no third length
    found = [np.empty((0, 3), np.int64)]
    for a in have.tolist():
        b = have[(have <= a) & (a + have <= window)]
        c = window - a - b
        fills = (c <= b) & there[c]
        found.append(np.stack([np.full(int(fills.sum()), a), b[fills], c[fills]], axis=1))
    return np.concatenate(found)


def least_squares(combos: np.ndarray, target: np.ndarray, passes: int = 400, wide: int = 4096) -> np.ndarray:
    """Non-negative repeat counts whose summed lengths come nearest to the histogram, by coordinate descent: each pass
    takes the steepest coordinates that share no length, so all of them may move at once, each to its own best."""
    a, b, c = combos.T
    norms = 3.0 - (c == 0) + 2 * ((a == b).astype(int) + ((b == c) & (c > 0))) + 2 * ((a == c) & (c > 0))
    x, rest = np.zeros(len(combos)), target.astype(float)
    rest[0] = 0
    for _ in range(passes if len(combos) else 0):
        step = np.maximum(-x, (rest[a] + rest[b] + rest[c]) / norms)
        size = np.abs(step)
        if size.max() < 0.25:
            break
        top = np.argpartition(-size, wide)[:wide] if len(size) > wide else np.arange(len(size))
        top = top[np.argsort(-size[top], kind="stable")]
        used, chosen = {0}, []
        for j, parts in zip(top.tolist(), combos[top].tolist(), strict=True):
            own = {n for n in parts if n}
            if used.isdisjoint(own):
                used |= own
                chosen.append(j)
        x[chosen] += step[chosen]
        np.subtract.at(rest, combos[chosen], step[chosen][:, None])
        rest[0] = 0
    return x


def recipes(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use every piece of the histogram (count by length) exactly once."""
    left, out = histogram.astype(np.int64).copy(), []
    placed = True
    while placed:
        placed = False
        combos = combinations(left, window)
        solved = least_squares(combos, left)
        for j in np.argsort(-solved, kind="stable").tolist():
            if solved[j] < 1 - 1e-6:
                break
            recipe = tuple(n for n in combos[j].tolist() if n)
            where, n = np.unique(recipe, return_counts=True)
            times = int(min(np.floor(solved[j] + 1e-6), (left[where] // n).min()))
            if times > 0:
                out.append((recipe, times))
                left[where] -= times * n
                placed = True
    while left.any():
        used, room, recipe = left.copy(), window, []
        while room > 0:
            fits = np.nonzero(used[: room + 1])[0]
            if not len(fits):
                break
            recipe.append(int(fits[-1]))
            used[fits[-1]] -= 1
            room -= int(fits[-1])
        where, n = np.unique(recipe, return_counts=True)
        times = int((left[where] // n).min())
        out.append((tuple(recipe), times))
        left[where] -= times * n
    return out


def pack(docs: DataFrame, vocabulary: str, window: int = 1024, doc_id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids, if asked
    for). Sequences are padded to the window unless their length is a power of two."""
    pieces = saved(token_pieces(docs, vocabulary, window, doc_id, text, ids))
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    plan = [((window,), int(histogram[window]))] if histogram[window] else []
    histogram[window] = 0
    plan += recipes(histogram, window)
    # for each length: from which number on its pieces go to which recipe, sequence and offset
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken, base = np.zeros(window + 1, np.int64), 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            slots.setdefault(length, []).append((int(taken[length]), base, offset))
            taken[length] += times
            offset += length
        base += times
    bins = {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in slots.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number, length = batch.pop("number").to_numpy(np.int64), batch["length"].to_numpy(np.int64)
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for k in np.unique(length).tolist():
                rows = np.nonzero(length == k)[0]
                first, begins, offsets = bins[k]
                at = np.searchsorted(first, number[rows], side="right") - 1
                sequence[rows], offset[rows] = begins[at] + number[rows] - first[at], offsets[at]
            yield batch.assign(sequence_id=sequence, offset=offset)

    order = numbered(pieces, ["length"], ["doc_id", "tie", "start"], "number").drop("tie")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in order.schema.fields if f.name != "number")
    return order.mapInPandas(place, kinds + ", sequence_id bigint, offset bigint")
