"""SimHash classes, repeated byte strings, packing and sharding against plain versions."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from fixtures import documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from larder.llm import packing, sharding, simhash, suffixes
from larder.llm.components import components


def plain_fingerprint(text):
    import re

    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def test_near_duplicates(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    by = plain_components(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for d, p in prints:
        if d is not None:
            least[by[p]] = min(least.get(by[p], d), d)
    want = sorted((str(d), f"{p:016x}", str(least.get(by[p]))) for d, p in prints)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs).collect()) == want
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns and one.count() == len(set(by.values()))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_tree_finds_every_link(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(8):
            fps.add(int(c) ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 5))))
    dense = int(centres[0])
    fps |= {dense ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(40)}
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "LEAF", 64)
    monkeypatch.setattr(simhash, "PIECE", 100)
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    links = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.fingerprint_links(frame).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    linked = set(links) | {(b, a) for a, b in links}
    want = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    assert plain_components(fps, lambda a, b: (a, b) in linked) == want
    assert len(links) < 40 * len(fps)  # no pair list of the dense group


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 900), st.integers(0, 700), st.integers(0, 40)), min_size=1, max_size=6), st.integers(1, 4))
def test_suffix_array(parts, letters):
    rng = np.random.default_rng(letters)
    base = bytes(rng.integers(97, 97 + letters, 1600, dtype=np.uint8))
    data = b"".join(base[a : a + n] + bytes(rng.integers(97, 123, x, dtype=np.uint8)) for a, n, x in parts) + base[:220]
    wanted = np.arange(len(data) - 199)
    order = suffixes.sorted_places(data, wanted).tolist()
    assert sorted(order) == wanted.tolist() and all(data[a : a + 200] <= data[b : b + 200] for a, b in zip(order[:-1], order[1:], strict=True))
    seen = Counter(data[i : i + 200] for i in wanted)
    assert suffixes.repeats(data, wanted).tolist() == [seen[data[i : i + 200]] > 1 for i in wanted]


def plain_kept(all_bytes):
    seen = Counter(x[i : i + 200] for x in all_bytes for i in range(len(x) - 199))
    for x in all_bytes:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - 199):
            if seen[x[i : i + 200]] > 1:
                gone[i : i + 200] = True
        yield len(x), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), bytes(b for b, g in zip(x, gone, strict=True) if not g)


@pytest.mark.parametrize("most", [4000, 1])
def test_repeated_bytes(spark, most, monkeypatch):
    docs = documents(spark)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    plain = list(plain_kept([x for _, x in rows]))
    want = sorted((str(d), n, gone, runs, hashlib.sha256(kept).hexdigest()) for (d, _), (n, gone, runs, kept) in zip(rows, plain, strict=True))
    found = suffixes.spans
    monkeypatch.setattr(suffixes, "spans", lambda d, n, i, t: found(d, n, i, t, most))
    monkeypatch.setattr(suffixes, "SEGMENT", 10_000)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.digest(docs).collect()) == want
    if most > 1:
        cut = suffixes.without_repeats(docs)
        assert cut.columns == docs.columns
        assert sorted((r.text or "") for r in cut.collect()) == sorted(kept.decode("utf-8", "ignore") for *_, kept in plain)
        assert suffixes.digest(empty(spark)).count() == 0


def test_packing(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs, plain = documents(spark), Tokenizer.from_file(path)
    rows = packing.pack(docs, path, 64, ids=True).collect()
    want = Counter(((r.doc_id), (*plain.encode(r.text or "", add_special_tokens=False).ids, 0)) for r in docs.collect())
    # pieces of equal rows can't be told apart, so their ids are compared by place
    pieces = Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    expected = Counter((d, s, len(ids[s : s + 64]), zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes()), len(ids)) for (d, ids), n in want.items() for _ in range(n) for s in range(0, len(ids), 64))
    assert pieces == expected and all(len(r.ids) == 4 * r.length for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 64
    assert len(sequences) <= sum(r.length for r in rows) / 64 * 1.1 + 2
    assert packing.pack(empty(spark), path, 64).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=63, max_size=63))
def test_recipes_use_every_piece_once(counts):
    histogram = np.array([0, *counts, 0])
    used = np.zeros(65, int)
    for lengths, times in packing.recipes(histogram, 64):
        assert sum(lengths) <= 64 and times > 0
        for n in lengths:
            used[n] += times
    assert (used == histogram).all()


def test_sharding(spark):
    docs = documents(spark)
    for table, shards in ((docs, 5), (docs, 24), (spark.createDataFrame([(i, "same") for i in range(200)] + [(i, f"t{i % 40}") for i in range(200, 300)], "doc_id long, text string"), 6)):
        rows = sharding.assign(table, shards).collect()
        held = [(r.doc_id, r.text) for r in table.collect()]
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in held)
        sizes = Counter(r.shard for r in rows)
        assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
        for s in sizes:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    where = {}
    for r in rows:
        where.setdefault(r.text_crc32, Counter())[r.shard] += 1
    whole = sum(len(c) == 1 for c in where.values())
    assert whole >= 0.8 * len(where)  # few groups are cut
    assert sharding.assign(empty(spark), 24).count() == 0


def test_groups_go_whole_while_a_shard_has_room(spark, monkeypatch):
    groups = [(g, n) for g in range(10) for n in range(22)] + [(10, n) for n in range(320)] + [(100 + i // 3, i) for i in range(210)]
    rows = [(i, f"text {g}") for i, (g, _) in enumerate(groups)] + [(1000 + i, f"alone {i}") for i in range(960 - len(groups))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for few in (sharding.FEW, 3):  # at once, and in rounds
        monkeypatch.setattr(sharding, "FEW", few)
        monkeypatch.setattr(sharding, "SPLIT", 64 if few > 3 else 4)
        got = sharding.assign(docs, 24).collect()
        assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
        assert set(Counter(r.shard for r in got).values()) == {40}
        where = {}
        for r in got:
            where.setdefault(r.text_crc32, set()).add(r.shard)
        on = lambda g: len(where[zlib.crc32(f"text {g}".encode())])
        assert [on(g) for g in range(11)] == [1] * 10 + [8]
        assert [on(g) for g in range(100, 170)] == [1] * 70


def test_labels_follow_the_current_placement(spark):
    """Two hubs want shard 0, which has room for the rest of one; the other hub's label moves on in a later round."""
    start = [(g, 7, s, at) for g in "ab" for s, at in ((0, 3), (1, 2), (2, 2))]
    now = sharding.saved(spark.createDataFrame(start, "group string, n long, shard int, at long"))
    room, trace = [4, 9, 9], []
    end = sorted(map(tuple, sharding.propagate(now, room, trace=trace).collect()))
    assert len(end) == 2 and all(n == at == 7 for _, n, _, at in end) and len(trace) >= 2
    assert len({s for _, _, s, _ in end}) == 2  # both started with most votes for shard 0
    assert any(n != at for _, n, _, at in trace[0])  # one round can't serve both
    before, after = [6, 4, 4], [sum(at for _, _, s, at in end if s == x) for x in range(3)]
    assert room == [r + b - a for r, b, a in zip([4, 9, 9], before, after, strict=True)] and min(room) >= 0


def test_propagation_under_tight_quotas(spark):
    rng = np.random.default_rng(9)
    start, shards = [], 6
    for g in range(400):
        n = int(rng.integers(2, 7))
        for s, at in sorted(Counter(rng.integers(0, shards, n).tolist()).items()):
            start.append((f"g{g}", n, s, at))
    held = [sum(at for _, _, s, at in start if s == x) for x in range(shards)]
    for slack in (40, 0, -3):  # room to spare, none, and one shard that holds too much
        room = [slack] * shards if slack >= 0 else [slack, *[1] * (shards - 1)]
        table = spark.createDataFrame(start, "group string, n long, shard int, at long")
        free, trace = list(room), []
        end = [tuple(r) for r in sharding.propagate(sharding.saved(table), free, trace=trace).collect()]
        total = Counter()
        for g, _, _, at in end:
            total[g] += at
        assert {(g, total[g]) for g in total} == {(g, n) for g, n, _, _ in start}
        now = [sum(at for _, _, s, at in end if s == x) for x in range(shards)]
        assert free == [r + h - x for r, h, x in zip(room, held, now, strict=True)]
        assert all(f >= min(r, 0) for f, r in zip(free, room, strict=True))
        whole = sum(n == at for _, n, _, at in end)
        assert whole >= (400 if slack == 40 else 300), (slack, whole, len(trace))
    docs = [(f"g{g}", i) for g, n in {(g, n) for g, n, _, _ in start} for i in range(n)]
    table = spark.createDataFrame([(i, g) for i, (g, _) in enumerate(sorted(docs))], "doc_id long, text string")
    got = sharding.assign(table, 5).collect()  # every document is linked
    sizes = Counter(r.shard for r in got)
    assert sorted(r.doc_id for r in got) == list(range(len(docs))) and max(sizes.values()) - min(sizes.values()) <= 1
    where = {}
    for r in got:
        where.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(x) > 1 for x in where.values()) <= 10  # only what must be torn for equal counts


def test_place_cuts_only_what_does_not_fit():
    room = {s: 100 for s in range(4)}
    made = sharding.place([(g, 60) for g in "abcde"], {"a": {2: 9}}, room)
    assert made[0] == ("a", 0, 60, 2) and sum(end - first for _, first, end, _ in made) == 300
    assert Counter(g for g, _, _, _ in made) == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 2}
    assert min(room.values()) >= 0 and sum(room.values()) == 100
