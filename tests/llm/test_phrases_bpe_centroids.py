"""Collocations, byte-level BPE and centroid clustering against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from fixtures import documents, empty
from pyspark.sql import functions as F

from larder.llm import byte_bpe, centroids, collocations

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---------------------------------------------------------------- collocations


def plain_collocations(rows, longest, least, share, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                for s in range(len(words) - m + 1):
                    counts[lang, tuple(words[s : s + m])] += 1
    found = {key: f for key, f in counts.items() if len(key[1]) > 1 and f >= least}
    out = []
    for (lang, words), a in found.items():
        m = len(words)
        longer = [f for (other, w), f in found.items() if other == lang and len(w) > m and any(w[i : i + m] == words for i in range(len(w) - m + 1))]
        if any(100 * f >= share * a for f in longer):
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, m)]
        score, k = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return result


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations_equal_a_plain_count(spark, longest):
    rng = random.Random(longest)
    words = ["New", "york", "city", "a", "b", "ü", "\U0001f600", "ﬀ", "x\x00y", "ÄB"]
    rows = []
    for i in range(240):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "\x0b", "\r", ";"]) for _ in range(rng.randint(0, 30)))
        rows.append((i, None if i % 40 == 0 else "New York city " * (i % 3) + text, None if i % 7 == 0 else f"l{i % 3}", "clash"))
    rows += [rows[5], (300, "", "l0", "x"), (301, "the same pair " * 400, "l1", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string").withColumns({"w1": F.lit("q"), "n": F.lit(1), "f": F.lit(2)})
    want = plain_collocations([(r[2], r[1]) for r in rows], longest, 10, 50, 20)
    got = collocations.collocations(docs.repartition(5), longest, 10, 50, 20)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and want


def test_collocations_of_odd_tables(spark):
    assert collocations.collocations(empty(spark)).collect() == []
    docs = documents(spark)
    want = plain_collocations([(r.lang, r.text) for r in docs.collect()], 3, 2, 50, 50)
    assert sorted(tuple(r) for r in collocations.collocations(docs, 3, 2, 50, 50).collect()) == sorted(want)


def test_windows_are_read_once_for_pairs_and_words(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(collocations, "saved", lambda df: kept.append(df) or df)
    docs = spark.createDataFrame([("a b c d. e", "x"), ("a b c", "x")], "text string, lang string")
    counts, totals = collocations.phrase_counts(docs, 3, 2)
    want = [("a", 1), ("a b", 2), ("a b c", 3), ("b", 1), ("b c", 2), ("c", 1)]
    assert sorted(tuple(r) for r in counts.collect()) == [("x", phrase, m, 2) for phrase, m in want]
    assert [tuple(r) for r in totals.collect()] == [("x", 8)]
    kept[0].collect()
    final = kept[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # one shuffle of windows, read for triples and once more for pairs and words together
    reads = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line]
    assert len(reads) == 2 and sum("ReusedExchange" in line for line in reads) == 1


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("e", "a", 1, 4_000_000_000_000), ("e", "b", 1, 4_000_000_000_001), ("e", "a b", 2, 3_999_999_999_999)], "lang string, phrase string, m int, f long"
    )
    got = collocations.cut_scores(counts.where("m > 1").withColumnRenamed("f", "a"), counts).first()
    assert got["score"] == 1_000_000 * 3_999_999_999_999**2 // (4_000_000_000_000 * 4_000_000_000_001)


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_codec_equals_the_library(ranks, library):
    rng = random.Random(2)
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    alphabets = ["ab ", "the of and ", "aAbB'sll 12", "éüßñ x", "日本語 の", "\U0001f600‍ x", "\n\t \r\x0b\x85\xa0 \x1c ", "<|endoftext|>", "\x00\x01\x7f", "ŀ²½Ⅷ٣ 9", "ᾳ̈́ a"]
    texts = ["", " ", "  a", "a  ", "\n\n x", "aaaaaaaaaaaaaaaaaaaaaaaa", "'s't're've'm'll'd", "<|endoftext|>"]
    texts += ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 200))) for _ in range(400)]
    texts += ["".join(rng.choice(a) for _ in range(3000)) for a in alphabets]
    texts += ["".join(chr(c) for c in (rng.randrange(0x110000) for _ in range(300)) if not 0xD800 <= c < 0xE000) for _ in range(40)]
    for text in texts:
        ids = codec.encode(text)
        assert byte_bpe.unpacked(ids) == library(text), text[:60]
        assert codec.decode(ids) == text.encode()
    assert not codec.queue.buckets and not any(any(level) for level in codec.queue.levels)


def test_characters_that_the_library_does_not_know(ranks):
    # a vocabulary in which a character merges with its neighbour wherever the pattern leaves them together
    rng = random.Random(5)
    ends = [int(x, 16) for r in byte_bpe.LATER.split() for x in r.split("-")]
    some = sorted({*ends, *[c + d for c in ends for d in (-1, 1)], *range(0x80, 0x300), *[rng.randrange(0x80, 0x40000) for _ in range(3000)]})
    some = [chr(c) for c in some if not 0xD800 <= c < 0xE000]
    table = {bytes([i]): i for i in range(256)}
    for ch in some:
        for prefix in (b"", b"x", b"1", b"!", b"\n"):
            whole = prefix + ch.encode()
            for k in range(2, len(whole) + 1):
                table.setdefault(whole[:k], len(table))
    codec = byte_bpe.Codec(table, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("toy", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
    for ch in some:
        for text in ("x" + ch + "x", "1" + ch, "!" + ch + "! ", "\n" + ch, " " + ch + " x"):
            assert byte_bpe.unpacked(codec.encode(text)) == library(text), hex(ord(ch))


def test_long_pretokens_take_linear_time(ranks, library):
    import time

    codec, rng = byte_bpe.Codec(ranks, public_tokenizers.PATTERN), random.Random(3)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000))
    start = time.perf_counter()
    assert byte_bpe.unpacked(codec.encode(long)) == library(long)
    assert byte_bpe.unpacked(codec.encode("a" * 100_000)) == library("a" * 100_000)
    assert time.perf_counter() - start < 20


def test_merging_where_longer_tokens_have_lower_ranks():
    # no trained vocabulary looks like this: made pairs outrank those that wait, so the queue must go back
    rng = random.Random(8)
    for _ in range(60):
        tokens = {bytes([c]) for c in b"abc"} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 4))) for _ in range(12)}
        order = sorted(tokens)
        rng.shuffle(order)
        table = {t: i * 70 for i, t in enumerate(order)}
        codec = byte_bpe.Codec(table, ".+")
        asked, wanted = [], []
        for _ in range(20):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 30)))
            parts = [piece[i : i + 1] for i in range(len(piece))]
            while piece not in table:
                pairs = [(table[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in table]
                if not pairs:
                    break
                _, i = min(pairs)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            want = [table[piece]] if piece in table else [table[p] for p in parts]
            assert codec.merge([piece]) == [byte_bpe.packed(want)]
            wanted.append(byte_bpe.packed(want))
            asked.append(piece)
        assert codec.merge(asked) == wanted  # in one queue


def test_encode_and_decode_tables(spark, library):
    docs = documents(spark).withColumns({"_v": F.lit("kept"), "ids": F.lit(1), "a.b": F.lit(2), "big": F.lit((1 << 60) + 1)})
    docs = docs.unionByName(docs.limit(1).withColumns({"big": F.lit(None).cast("long")}))
    coded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN)
    rows = back.collect()
    assert len(rows) == docs.count() and back.columns == [c for c in docs.columns if c != "ids"] + ["ids", "decoded"]
    for r in rows:
        assert byte_bpe.unpacked(bytes(r["ids"])) == library(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode() and r["_v"] == "kept" and r["big"] in (None, (1 << 60) + 1)
    both = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert both.columns == back.columns and Counter(map(str, both.collect())) == Counter(map(str, rows))
    got = byte_bpe.digest(docs, RANKS, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    made = Counter(tuple(r) for r in got.collect())
    want = Counter()
    for r in docs.collect():
        ids = np.array(library(r["text"] or ""), "<u4")
        want[r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert made == want
    assert byte_bpe.digest(empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []


# ---------------------------------------------------------------- centroids


def plain_kmeans(rows, k, rounds, dims, scale, seed):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e):
            kept.append((i, [int(v.as_integer_ratio()[0] * scale // v.as_integer_ratio()[1]) for v in e], list(e)))
    name = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[2])
    means = [x for _, x, _ in sorted(kept, key=name)[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(means))
    for _ in range(rounds):
        groups = {}
        for _, x, _ in kept:
            groups.setdefault(near(x)[1], []).append(x)
        means = [[sum(v) // len(groups[j]) for v in zip(*groups[j])] if j in groups else c for j, c in enumerate(means)]
    out = [(i, *near(x)[::-1]) for i, x, _ in kept]
    fits = lambda v: v if v < 1 << 63 else None
    inertia = Counter()
    for _, j, d in out:
        inertia[j] += d
    return [
        (i, j, fits(d), fits(inertia[j]), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, means[j])).encode()).hexdigest()) for i, j, d in out
    ]


def vectors(n, dims, seed, groups=5):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, dims))
    return [(i, (middles[i % groups] + rng.normal(size=dims) * 0.5).astype(np.float32).astype(float).tolist()) for i in range(n)]


def check_kmeans(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"x": F.lit(1), "cluster": F.lit("a"), "e": F.lit(2), "n": F.lit(3)})
    got = centroids.digest(df.repartition(3), **options)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    plain = plain_kmeans(rows, options["k"], options["rounds"], options["dims"], options["scale"], options["seed"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain, key=str)


def test_kmeans_equals_plain_rounds(spark):
    rows = vectors(300, 6, 1)
    rows += rows[:40] + [(None, [0.5] * 6), (None, None), (900, None), (901, []), (902, [1.0] * 5), (903, [1.0, None] + [0.0] * 4), (904, [math.nan] * 6), (905, [math.inf] * 6), (906, [-0.0] * 6)]
    check_kmeans(spark, rows, k=8, rounds=10, dims=6, scale=1024, seed=3)
    check_kmeans(spark, rows, k=1, rounds=2, dims=6, scale=1024, seed=3)
    check_kmeans(spark, rows[:5], k=8, rounds=3, dims=6, scale=1024, seed=3)


def test_kmeans_with_ties_and_equal_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(200)]
    check_kmeans(spark, rows, k=6, rounds=10, dims=3, scale=1, seed=3)
    check_kmeans(spark, [(i % 3, [1.0, 2.0]) for i in range(30)], k=4, rounds=5, dims=2, scale=7, seed=3)


def test_kmeans_with_large_components(spark):
    rows = vectors(60, 4, 5) + [(100, [1e12, 0.0, 3.5, -1.0]), (101, [1e300, 1.0, 1.0, 1.0]), (102, [-1e300, 1e-300, 0.0, 2.0]), (103, [1.7e308] * 4), (104, [3e5, 1.0, 1.0, 1.0])]
    check_kmeans(spark, rows, k=5, rounds=6, dims=4, scale=1024, seed=3)


def test_empty_tables_have_no_clusters(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.digest(none).collect() == []
    assert centroids.kmeans(none)[1] == []


def test_bounds_hold_and_spare_scans(spark):
    rng = np.random.default_rng(6)
    for _ in range(200):
        old = rng.normal(size=(4, 3)) * 10
        new = old + rng.normal(size=(4, 3)) * rng.choice([0.01, 1, 10])
        radius = rng.random(4) * rng.choice([0.1, 2, 20])
        way, loss = centroids.loosening(old, new, radius)
        assert (loss <= way.max() * (1 + 1e-6)).all()
        for i in range(4):
            x = rng.normal(size=(200, 3))
            x = old[i] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius[i] * rng.random((200, 1))
            before = np.linalg.norm(x[:, None] - old[None], axis=2)
            after = np.linalg.norm(x[:, None] - new[None], axis=2)
            assert (np.delete(before - after, i, axis=1) <= loss[i] + 1e-9).all()
    # against the plain full drift, the geometric bound is smaller for far clusters
    old = np.array([[0.0, 0.0], [100.0, 0.0]])
    assert centroids.loosening(old, old + [[0, 0], [0, 5.0]], np.array([3.0, 3.0]))[1][0] < 0.5
    report: list[int] = []
    rows = spark.createDataFrame(vectors(2000, 8, 7, 4), "vec_id long, embedding array<double>")
    centroids.kmeans(rows, 4, 10, 8, 1024, 3, report=report)
    assert report[0] == 2000 and report[-1] < 400
