"""Balanced sharding by label propagation over linked documents, in DataFrame functions only.

Documents with equal texts are linked. The links of a group go through a hub for the group, never between all pairs.
Groups above 1/``SPLIT`` of a shard (so of a bounded number) are seeded first, one after another from the largest: each
goes whole to the shard with most votes among those with room for all of it; only if none has, as for each group of more
than a shard, is it cut, and then into the fullest possible parts. All other documents begin with a shard drawn from their
ids by the room that is left. Then labels propagate in rounds: a join with the current placement counts anew how many
documents of each group lie where, each hub takes the shard with most of them among those with room for the rest, and its
other documents ask to move there. Quotas let in, by a hash, as many as a shard has room for after those that leave it in
the same round. What a round moved changes the votes of the next. Rounds go on until nothing moves; groups that are then
still cut (few: those that no quota could serve) are placed one after another, whole wherever a shard has room. At the
end the counts are made equal (law ``rows``: at most one apart): over-full shards give up rows, which are unlinked ones
while they have any, to the shards with free slots.

Votes, demands and counts are combined before each shuffle; what reaches the driver are totals per pair of shards and
hash bucket and the sizes and votes of boundedly many groups. Slots, and the rows of a cut group, are numbered by a range
sort over all tasks, so one group of any size is spread over many tasks.

Defined results: a null text has size 8, CRC 0 and no links; empty texts are equal texts; repeated rows and null ids are
rows like others; fewer rows than shards leave shards empty. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import SMALL, forget, numbered, saved

SPLIT = 16  # a group of more than this part of a shard is large
FEW = 2_000  # so many groups that are still cut are placed at a time
BUCKETS = 100
ROUNDS = 40  # whatever is cut after so many is placed one after another, too
DRAWS = 1_000


def place(groups: list[tuple[str, int]], votes: dict[str, dict[int, int]], room: dict[int, int]) -> list[tuple[str, int, int, int]]:
    """(group, first, end, shard) for the rows of each group by their numbers; takes the room that it uses. Groups go by
    votes, or to the shard they fill most if that cuts less."""

    def attempt(by_votes: bool) -> tuple[list[tuple[str, int, int, int]], dict[int, int]]:
        free, out = dict(room), []
        for group, n in sorted(groups, key=lambda g: (-g[1], g[0])):
            said, at = votes.get(group, {}), 0
            while at < n:
                fits = [s for s in free if free[s] >= n - at]
                if fits:
                    key = (lambda s: (said.get(s, 0), -free[s], -s)) if by_votes else (lambda s: (-free[s], said.get(s, 0), -s))
                else:
                    fits, key = list(free), lambda s: (free[s], said.get(s, 0), -s)
                shard = max(fits, key=key)
                take = min(free[shard], n - at)
                out.append((group, at, at + take, shard))
                free[shard] -= take
                at += take
        return out, free

    out, free = min((attempt(True), attempt(False)), key=lambda made: len(made[0]))
    room.update(free)
    return out


def quotas(asked: np.ndarray, room: list[int]) -> list[int]:
    """For each shard, how many hash buckets of those that ask for it may come, so that no more come than it has room for
    after those that leave it. asked: documents by wanted shard, bucket and present shard."""
    shards, buckets, _ = asked.shape
    cut = [buckets] * shards
    come, leave = asked.sum(axis=(1, 2)), asked.sum(axis=(0, 1))
    while True:
        excess = [come[s] - leave[s] - max(room[s], 0) if come[s] else 0 for s in range(shards)]
        worst = int(np.argmax(excess))
        if excess[worst] <= 0:
            return cut
        cut[worst] -= 1
        come[worst] -= asked[worst, cut[worst]].sum()
        leave -= asked[worst, cut[worst]]


def propagate(now: DataFrame, room: list[int], rounds: int = ROUNDS, trace: list[list[tuple]] | None = None) -> DataFrame:
    """Rounds of label propagation over (group, n, shard, at), ``at`` of a group's ``n`` documents in a shard; a saved
    table of the same kind. room: free places by shard, kept up to date. trace: gets each round's placement."""
    shards, idle = len(room), 0
    for turn in range(rounds):
        free = _by_shard(dict(enumerate(room)))
        places = max(1, sum(max(r, 0) for r in room))
        spare = [s for s in range(shards) for _ in range(-(-10 * shards * max(room[s], 0) // places))]
        held = {r["shard"]: r["at"] for r in now.groupBy("shard").agg(F.sum("at").alias("at")).collect()}
        # whole groups leave a shard that holds more than it may, as many as are too many
        too_many = _by_shard({s: -(-BUCKETS * -room[s] // held[s]) if room[s] < 0 and s in held else 0 for s in range(shards)})
        draw = F.xxhash64("group", F.lit(turn))
        key = F.struct(free >= F.col("n") - F.col("at"), F.col("at"), F.xxhash64("group", "shard", F.lit(turn)))
        label = F.max_by("shard", key)
        hubs = now.groupBy("group").agg(label.alias("want"), F.count("*").alias("parts"))
        if spare:
            other = F.element_at(F.array(*map(F.lit, spare)), F.pmod(draw, F.lit(len(spare))).cast("int") + 1)
            crowded = (F.col("parts") == 1) & (F.pmod(F.xxhash64("group", F.lit("out"), F.lit(turn)), F.lit(BUCKETS)) < too_many)
            # a hub that nobody could follow in the last round tries a shard that has room for all
            lost = (F.col("parts") > 1) & F.lit(idle > 0) & (_by_shard(dict(enumerate(room)), other) >= F.col("n"))
            want = F.when(crowded | lost, other).otherwise(F.col("want"))
        else:
            want = F.col("want")
        bucket = F.pmod(F.xxhash64("group", "shard", F.lit(turn), F.lit("in")), F.lit(BUCKETS)).cast("int")
        votes = now.join(hubs, "group").select("group", "n", "shard", "at", want.alias("want"), bucket.alias("bucket"))
        votes = saved(votes)
        asked = np.zeros((shards, BUCKETS, shards), np.int64)
        for r in votes.where("want <> shard").groupBy("want", "bucket", "shard").agg(F.sum("at").alias("at")).collect():
            asked[r["want"], r["bucket"], r["shard"]] = r["at"]
        cut = quotas(asked, room)
        moved = sum(asked[s, : cut[s]].sum(axis=0) for s in range(shards))
        for s in range(shards):
            room[s] += int(moved[s]) - int(asked[s, : cut[s]].sum())
        goes = F.col("bucket") < _by_shard(dict(enumerate(cut)), F.col("want"))
        after = saved(votes.groupBy("group", "n", F.when(goes, F.col("want")).otherwise(F.col("shard")).alias("shard")).agg(F.sum("at").alias("at")))
        forget(votes, now)
        now = after
        if trace is not None:
            trace.append(sorted(map(tuple, now.collect())))
        idle = 0 if moved.sum() else idle + 1
        if idle and (idle > 1 or not asked.sum()):
            break
    return now


def _by_shard(numbers: dict[int, int], shard: Column | None = None) -> Column:
    """The number of a row's shard, or of the given one."""
    return F.element_at(F.array(*[F.lit(numbers.get(s, 0)).cast("bigint") for s in range(len(numbers))]), (F.col("shard") if shard is None else shard) + 1)


def assign(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, linked (its text is not alone)."""
    text_col = docs[text].cast("string")
    rows = saved(docs.select(
        docs[doc_id].alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 8).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text_col), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.md5(text_col).alias("group"),
        F.pmod(F.xxhash64(docs[doc_id].cast("string"), F.xxhash64(text_col)), F.lit(shards)).cast("int").alias("shard"),
        F.pmod(F.xxhash64(docs[doc_id].cast("string"), F.xxhash64(text_col), F.lit("draw")), F.lit(DRAWS)).cast("int").alias("draw"),
    ))
    total = rows.count()
    target = {s: total // shards + (1 if s < total % shards else 0) for s in range(shards)}
    room = dict(target)

    groups = saved(rows.where("group is not null").groupBy("group").agg(F.count("*").alias("n")).where("n > 1"))
    linked = saved(rows.join(groups, "group").select("doc_id", "size", "text_crc32", "group", "n", "shard", "draw"))
    alone = rows.join(groups.select("group"), "group", "left_anti").select("doc_id", "size", "text_crc32", F.lit(None).cast("string").alias("group"), "shard")
    large = F.col("n") * SPLIT > max(1, total // shards)

    def place_all(some: DataFrame) -> list[tuple[str, int, int, int]]:
        said: dict[str, dict[int, int]] = {}
        sizes: dict[str, int] = {}
        for r in some.collect():
            sizes[r["group"]] = r["n"]
            said.setdefault(r["group"], {})[r["shard"]] = r["at"]
        return place(list(sizes.items()), said, room)

    pieces = place_all(linked.where(large).groupBy("group", "n", "shard").agg(F.count("*").alias("at")))
    # documents of small groups begin where there is room
    free = sum(room.values())
    begins = [s for s in range(shards) for _ in range(room[s] * DRAWS // max(1, free))] or [0]
    begin = F.element_at(F.array(*map(F.lit, begins)), F.col("draw") % len(begins) + 1)
    now = saved(linked.where(~large).groupBy("group", "n", begin.alias("shard")).agg(F.count("*").alias("at")))
    for r in now.groupBy("shard").agg(F.sum("at").alias("at")).collect():
        room[r["shard"]] -= r["at"]
    left = [room[s] for s in range(shards)]
    now = propagate(now, left)
    room.update(enumerate(left))
    waiting = now.where("at < n")
    while True:
        chosen = saved(waiting.select("group", "n").distinct().orderBy(F.desc("n"), "group").limit(FEW).select("group"))
        some = now.join(F.broadcast(chosen), "group")
        for r in some.groupBy("shard").agg(F.sum("at").alias("at")).collect():
            room[r["shard"]] += r["at"]
        # a shard that holds too much has no room, and what it holds too much is not there for others
        short = {s: n for s, n in room.items() if n < 0}
        room.update({s: 0 for s in short})
        made = place_all(some)
        room.update(short)
        pieces += made
        after, last = saved(now.join(F.broadcast(chosen), "group", "left_anti")), len({m[0] for m in made}) < FEW
        forget(now, chosen)
        now, waiting = after, after.where("at < n")
        if last:
            break
    listed = rows.sparkSession.createDataFrame(pieces, "group string, first long, end long, to int")
    # a few pieces for each large group, and the small ones that came last
    hint = F.broadcast if len(pieces) <= SMALL else (lambda df: df)
    several = listed.where("first > 0").select("group").distinct()
    columns = ["doc_id", "size", "text_crc32", "group"]
    kept = [linked.join(hint(listed.join(several, "group", "left_anti")), "group"), linked.where(~large).join(now.select("group", F.col("shard").alias("to")), "group")]
    rows_of_torn = numbered(linked.drop("draw").join(hint(several), "group", "left_semi"), ["group"], ["doc_id", "text_crc32", "size", "shard"], "at")
    kept.append(rows_of_torn.join(hint(listed), "group").where("at >= first and at < end"))
    moved = [k.select(*columns, F.col("to").alias("shard"), F.lit(0).alias("alone")) for k in kept]
    settled = reduce(DataFrame.unionByName, moved, alone.withColumn("alone", F.lit(1)))

    # linked rows first, group by group, so what an over-full shard gives up are rows without links while it has any
    order = numbered(settled, ["shard"], ["alone", "group", "doc_id", "text_crc32", "size"], "slot")
    order = saved(order)
    have = {r["shard"]: r["count"] for r in order.groupBy("shard").count().collect()}
    stays = F.col("slot") < _by_shard(target)
    over = numbered(order.where(~stays).drop("slot"), [], ["group", "shard", "doc_id", "text_crc32", "size"], "spare")
    shard_col, slot_col, before = F.lit(0), F.lit(0).cast("bigint"), 0
    for s in range(shards):
        first = min(have.get(s, 0), target[s])
        gap = target[s] - first
        inside = (F.col("spare") >= before) & (F.col("spare") < before + gap)
        shard_col, slot_col = F.when(inside, F.lit(s)).otherwise(shard_col), F.when(inside, F.col("spare") - before + first).otherwise(slot_col)
        before += gap
    refilled = over.withColumn("shard", shard_col).withColumn("slot", slot_col).drop("spare")
    forget(rows, groups, linked, now)
    result = order.where(stays).unionByName(refilled)
    return result.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"), (F.col("alone") == 0).alias("linked"))
