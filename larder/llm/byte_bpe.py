"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens by the vocabulary's pattern. A pre-token that is a token of its own is one id; any
other is merged: its bytes form a linked list, each neighbouring pair that is a token lies in the bucket of its
rank, and a bitmap over all ranks, with a bitmap over its words and so on up to one word, gives the lowest rank in
use by find-first-set at each level. A bucket is worked off from its leftmost position on; a position whose pair has
changed since it was put there is stale and skipped. Each merge touches two pairs, so a pre-token of any length takes
time in proportion to it, where a search for the lowest pair after each merge takes the square. All new pre-tokens of
some documents go through one queue, and a bucket is merged as one array: pre-tokens don't touch each other, and of
pairs that overlap the left one goes first. That is the order of single merges as long as no pair that comes up with a
made token outranks the bucket at hand; where one does (seldom, in any vocabulary that was trained by merges), the
pre-token is merged again, position by position.

The work is narrow: documents are encoded where they lie, no shuffle; a worker process holds the vocabulary and a memo
of short pre-tokens of bounded size.

Defined results: null and empty texts have no ids; a text of any length is encoded whole; repeated rows are encoded
each for itself; strings that look like special tokens are ordinary text; an empty table gives no row. All columns of
the input are kept; a column that is called like a new one is replaced by it.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = 256
MEMO_CHARS, MEMO_SIZE = 48, 250_000
CHARS = 1 << 22

# Characters (first-last, hexadecimal) that the pattern engine here counts as letters or numbers while
# the vocabulary's own library, which knows an earlier Unicode, counts them as unassigned.
LATER = """
0558-0558 058B-058C 088F-088F 0C5C-0C5C 0CDC-0CDC 208F-208F 209D-209F A7CE-A7CF A7D2-A7D2 A7D4-A7D4 A7DD-A7DD A7E2-A7E2 A7F1-A7F1 AB6C-AB6D
107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A-11B0A 11DB0-11DDB 11DE0-11DE9 11DF1-11DF1 1246F-1246F 12475-1247F 12550-12686
16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168-1B168
1D6A6-1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF
2B73A-2B73F 2B81E-2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
UNASSIGNED = chr(0x10FFFF)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file with a base64 token and a number per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


class RankQueue:
    """Buckets of positions by rank; the lowest rank comes first."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list] = {}
        self.levels: list[list[int]] = []
        while not self.levels or len(self.levels[-1]) > 1:
            ranks = -(-max(1, ranks) // WORD)
            self.levels.append([0] * ranks)
        self.down = self.levels[::-1]

    def open(self, rank: int, positions: list) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = positions
        for words in self.levels:
            bit, rank = rank % WORD, rank // WORD
            before = words[rank]
            words[rank] = before | 1 << bit
            if before:
                return

    def take(self) -> tuple[int, list]:
        """The lowest rank and its bucket, which is no longer in the queue."""
        rank = 0
        for words in self.down:
            word = words[rank]
            rank = rank * WORD + (word & -word).bit_length() - 1
        at = rank
        for words in self.levels:
            bit, at = at % WORD, at // WORD
            words[at] = left = words[at] ^ 1 << bit
            if left:
                break
        return rank, self.buckets.pop(rank)


class Codec:
    """Encoder and decoder of one vocabulary. Ids travel as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.later = regex.compile("[" + "".join(f"{chr(int(a, 16))}-{chr(int(b, 16))}" for a, b in (r.split("-") for r in LATER.split())) + "]")
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.tokens = {rank: token for token, rank in ranks.items()}
        # a byte that no UTF-8 text holds stands between pre-tokens; no token of several bytes may hold it
        self.wall = next(bytes([b]) for b in (0xFF, 0xFE, 0xF8, 0xC0) if not any(b in t for t in ranks if len(t) > 1))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # the pairs that are tokens, as numbers; ``none`` stands for what merges with nothing
        self.none = max(ranks.values(), default=0) + 1
        found = {ranks[t[:k]] * self.none + ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        self.pairs = np.array(sorted(found), np.int64)
        self.made = np.array([found[p] for p in self.pairs.tolist()] + [-1], np.int64)
        # ranks of tokens that are part of a token of a lower rank
        lower = {part for key, r in found.items() for part in divmod(key, self.none) if r < part}
        self.early = np.zeros(self.none, bool)
        self.early[list(lower)] = True
        self.byte = np.array([ranks.get(bytes([b]), self.none) for b in range(256)], np.int64)
        self.byte[self.wall[0]] = self.none

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        if text.isascii() or self.later.search(text) is None:
            return self.pieces(text)
        out, at = [], 0
        for piece in self.pieces(self.later.sub(UNASSIGNED, text)):
            out.append(text[at : at + len(piece)])
            at += len(piece)
        return out

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, -1 for none."""
        if not len(self.pairs):
            return np.full(len(left), -1)
        key = np.where(right < self.none, left * self.none + right, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.made[at], -1)

    def _put(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        ends = [*(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        start, buckets = 0, self.queue.buckets
        for rank, end in zip(ranks[[0, *ends[:-1]]].tolist(), ends, strict=True):
            if rank in buckets:
                buckets[rank].append(positions[start:end])
            else:
                self.queue.open(rank, [positions[start:end]])
            start = end

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token."""
        out = [packed([self.ranks[p]]) if p in self.ranks else b"" for p in pieces]
        todo = [i for i, ids in enumerate(out) if not ids and pieces[i]]
        if not todo:
            return out
        data = np.frombuffer(self.wall.join(pieces[i] for i in todo), np.uint8)
        n, none = len(data), self.none
        starts = np.concatenate([[0], np.cumsum([len(pieces[i]) + 1 for i in todo])])[:-1]
        # a token is named by its first byte; ``after`` holds where the next one begins, ``pair`` the rank of the
        # token made with the next one (-1: none, or the token is no more); place n stands before and behind all
        token = np.append(self.byte[data], none)
        after, before = np.minimum(np.arange(1, n + 2), n), np.arange(-1, n)
        before[0] = n
        pair = np.append(self.joined(token[:-1], token[1:]), -1)
        fresh = np.zeros(n + 1, bool)
        again: set[int] = set()

        def doubt(positions: np.ndarray) -> None:
            again.update((np.searchsorted(starts, positions, side="right") - 1).tolist())

        held = np.flatnonzero(pair >= 0)
        if len(held):
            self._put(pair[held], held)
        while self.queue.buckets:
            rank, parts = self.queue.take()
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            at = np.sort(at[pair[at] == rank])  # others are stale
            if not len(at):
                continue
            gone = after[at]
            overlap = gone[:-1] == at[1:]
            if overlap.any():
                place = np.arange(len(at))
                run = np.maximum.accumulate(np.where(np.append(False, overlap), 0, place))
                at = at[(place - run) % 2 == 0]
                gone = after[at]
            end = after[gone]
            after[at], before[end] = end, at
            if self.early[rank]:
                # between two merges side by side, the first made token meets the second's first part
                beside = np.flatnonzero(end[:-1] == at[1:])
                met = self.joined(np.full(len(beside), rank), token[at[beside + 1]])
                doubt(at[beside][(met >= 0) & (met < rank)])
            token[at], token[gone] = rank, none
            pair[gone] = -1
            fresh[at] = True
            left = before[at]
            left = left[~fresh[left]]
            fresh[at] = False
            at = np.concatenate([at, left])
            made = self.joined(token[at], token[after[at]])
            pair[at] = made
            good = made >= 0
            if good.any():
                made, at = made[good], at[good]
                if self.early[rank]:
                    doubt(at[made < rank])
                self._put(made, at)
        alive = token[:n] < none
        ids = token[:n][alive].astype("<u4").tobytes()
        ends = (np.cumsum(np.add.reduceat(alive, starts)) * 4).tolist()
        for i, start, end in zip(todo, [0, *ends[:-1]], ends, strict=True):
            out[i] = ids[start:end]
        for place in again:
            out[todo[place]] = packed(self.merge_by_position(pieces[todo[place]]))
        return out

    def merge_by_position(self, piece: bytes) -> list[int]:
        """Ids of one pre-token whose made pairs may outrank the others."""
        rank_of, queue, n = self.ranks.get, self.queue, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [rank_of(piece[i : i + 2], -1) if i + 1 < n else -1 for i in range(n)]

        def put(rank: int, position: int) -> None:
            if rank in queue.buckets:
                queue.buckets[rank].append(position)
            elif rank >= 0:
                queue.open(rank, [position])

        for i, rank in enumerate(pair):
            put(rank, i)
        while queue.buckets:
            rank, bucket = queue.take()
            bucket = sorted(i for i in bucket if pair[i] == rank)
            if not bucket:
                continue
            if len(bucket) > 1:
                queue.open(rank, bucket[1:])
            i = bucket[0]
            gone = after[i]
            after[i] = end = after[gone]
            pair[gone] = -1
            if end < n:
                before[end] = i
            pair[i] = rank_of(piece[i : after[end]], -1) if end < n else -1
            put(pair[i], i)
            left = before[i]
            if left >= 0:
                pair[left] = rank_of(piece[left:end], -1)
                put(pair[left], left)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        split, memo = [self.split(t) for t in texts], self.memo
        unknown = []
        for pretoken in set().union(*split).difference(memo):
            known = self.older.get(pretoken)
            if known is None:
                unknown.append(pretoken)
            else:
                memo[pretoken] = known
        for pretoken, ids in zip(unknown, self.merge([p.encode("utf-8") for p in unknown]), strict=True):
            memo[pretoken] = ids
        out = [b"".join(map(memo.__getitem__, s)) for s in split]
        # long pre-tokens are not kept; a full memo becomes the older one, whose entries come back when met again
        for pretoken in unknown:
            if len(pretoken) > MEMO_CHARS:
                del memo[pretoken]
        if len(memo) > MEMO_SIZE:
            self.memo, self.older = {}, memo
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, unpacked(ids)))


def together(texts: Iterable[str | None], chars: int = CHARS) -> Iterator[list[str]]:
    """The texts in order, in lists that end once they hold ``chars`` characters."""
    some, size = [], 0
    for t in texts:
        some.append(t or "")
        size += len(some[-1])
        if size >= chars:
            yield some
            some, size = [], 0
    if some:
        yield some


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, kept by the worker process for the next tasks."""
    return Codec(read_ranks(path), pattern)


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()


LITTLE = array("I", [1]).tobytes() == b"\x01\x00\x00\x00"


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _with_columns(df: DataFrame, source: str, out: list[str], make: Callable[[], Callable[[list], Iterator[tuple[bytes, ...]]]]) -> DataFrame:
    """All columns of the table, and the columns ``out`` (bytes), made from a batch's values by a function that ``make``
    sets up in the task. The other columns pass as they are."""
    kept = [f for f in df.schema.fields if f.name not in out]
    names = [*[f.name for f in kept], *out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in batches:
            made = list(convert(batch.column(batch.num_columns - 1)))
            columns = [pa.array([m[i] for m in made], pa.binary()) for i in range(len(out))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=names)

    # under plain inner names, so that any column name will do
    given = df.select(*[F.col(_quoted(f.name)).alias(f"c{i}") for i, f in enumerate(kept)], F.col(_quoted(source)).alias("value"))
    return given.mapInArrow(run, T.StructType([*kept, *[T.StructField(c, T.BinaryType()) for c in out]]))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The table with its token ids as bytes (little-endian unsigned 32-bit) in ``ids``."""

    def make():
        own = codec(ranks, pattern)
        return lambda texts: ((made,) for some in together(v.as_py() for v in texts) for made in own.encode_all(some))

    return _with_columns(docs, text, [ids], make)


def decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The table with the bytes that its ids stand for in ``out``."""

    def make():
        own = codec(ranks, pattern)
        return lambda values: ((own.decode(v.as_py() or b""),) for v in values)

    return _with_columns(encoded, ids, [out], make)


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: the ids, and the bytes that these ids stand for."""

    def make():
        own = codec(ranks, pattern)
        return lambda texts: ((made, own.decode(made)) for some in together(v.as_py() for v in texts) for made in own.encode_all(some))

    return _with_columns(docs, text, [ids, out], make)


def digest(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: the number of ids and the digests of the ids and of what they decode to."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return round_trip(source, ranks, pattern).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
