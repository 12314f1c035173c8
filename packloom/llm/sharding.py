"""Minimax contiguous partition: ordered atomic groups are cut into shards of the smallest feasible capacity.

A capacity is feasible if filling shards greedily in order, each as far as it holds, needs no more shards than
there are; a group above the capacity has a shard alone, so that one huge group doesn't raise the capacity of all others (the
largest shard is as small as it can be either way). The smallest feasible capacity is found by binary search.

Greedy filling leaves the last shards small. Among the cuts that keep the capacity, those are taken that make the smallest shard largest: each shard
may begin where the greedy walk begins it, or at one of the ``NEAR`` boundaries nearest to its equal share of the sum.

The greedy walk only asks for the last group boundary up to a value. The driver knows the boundaries by bins of equal width, each
with its least and largest boundary; a walk with lower and one with upper bounds bracket the answer, and only bins in which
the two still differ are split further, by one aggregation each round. What the driver holds is bounded by the number of
shards and bins, and the result is exact.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.llm._order import ranked
from packloom.llm._store import alone, cut

SHARDS = 40
BINS = 4096
SPLIT = 64
#: Boundaries beside each equal share among which the cuts are chosen.
NEAR = 33


class _Known:
    """What is known of the boundaries: disjoint bins in order as (least, largest, count), and the end."""

    def __init__(self, bins: list[tuple[int, int, int]], total: int):
        self.bins = sorted([*bins, (total, total, 1)])
        self.least = [b[0] for b in self.bins]

    def jump(self, v: int, capacity: int, low: bool) -> int:
        """A lower or an upper bound of the farthest boundary that a shard from ``v`` reaches."""
        to = v + capacity
        i = bisect.bisect_right(self.least, to) - 1
        least, largest, count = self.bins[i]
        got = largest if largest <= to else least if low or count <= 2 else to
        if got > v:
            return got
        if v < largest and count > 2 and v != least:  # somewhere within this bin
            return v if low else largest
        if v < largest:
            return largest if count <= 2 or not low else v
        return self.bins[min(i + 1, len(self.bins) - 1)][0]

    def walk(self, capacity: int, shards: int, low: bool) -> list[int]:
        path = [0]
        for _ in range(shards):
            path.append(self.jump(path[-1], capacity, low))
        return path

    def smallest(self, shards: int, total: int, low: bool) -> int:
        a, b = 0, total
        while a + 1 < b:
            mid = (a + b) // 2
            if self.walk(mid, shards, low)[-1] >= total:
                b = mid
            else:
                a = mid
        return b


def minimax_cuts(boundaries: DataFrame, total: int, shards: int = SHARDS, bins: int = BINS, split: int = SPLIT) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and where the shards begin (the first at 0).

    ``boundaries`` has a column ``start``: the running sum at which each group begins, 0 included.
    """
    if total <= 0:
        return 0, [0]

    def binned(width: int, parents: tuple[int, list[int]] | None) -> dict[int, tuple[int, int, int]]:
        rows = boundaries.withColumn("bin", F.expr(f"start DIV {width}L"))
        if parents:
            rows = rows.where(F.expr(f"start DIV {parents[0]}L").isin(parents[1]))
        got = rows.groupBy("bin").agg(F.min("start").alias("a"), F.max("start").alias("b"), F.countDistinct("start").alias("n"))
        return {r.bin: (r.a, r.b, r.n) for r in got.collect()}

    width = max(1, -(-total // bins))
    coarse, fine = {width: binned(width, None)}, width
    while True:
        known = _Known([b for level in coarse.values() for b in level.values()], total)
        lo, hi = known.smallest(shards, total, False), known.smallest(shards, total, True)
        near, far = known.walk(lo, shards, True), known.walk(hi, shards, False)
        if lo == hi and near == far:
            return hi, sorted({x for x in far if x < total})
        # Bins with inner boundaries that a walk may still end in or start from.
        unclear = set()
        for i in range(len(near) - 1):
            for a, b in ((near[i], far[i]), (near[i] + lo, far[i] + hi)):
                for at in coarse[fine]:
                    least, largest, count = coarse[fine][at]
                    if count > 2 and least <= b and largest >= a:
                        unclear.add(at)
        if not unclear:
            raise AssertionError("every boundary is known, yet the walks differ")
        finer = max(1, fine // split)
        coarse[finer] = binned(finer, (fine, sorted(unclear)))
        coarse[fine] = {k: v for k, v in coarse[fine].items() if k not in unclear}
        fine = finer


def level_cuts(boundaries: DataFrame, total: int, capacity: int, greedy: list[int], shards: int = SHARDS, near: int = NEAR) -> list[int]:
    """Where the shards begin if the smallest is to be as large as the choice allows; none is above the capacity that isn't a group alone in ``greedy``."""
    if total <= 0 or shards < 2:
        return greedy
    share = total / shards
    k = F.round(F.col("start") / share).cast("int")
    rows = boundaries.select("start").withColumn("k", k).where((F.col("k") > 0) & (F.col("k") < shards))
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("k").orderBy(F.abs(F.col("start") - F.col("k") * share), "start"))).where(F.col("rank") <= near)
    path = [*greedy, *[total] * (shards + 1 - len(greedy))]
    may: list[set[int]] = [{0}, *({x} for x in path[1:shards]), {total}]
    for r in rows.select("k", "start").collect():
        may[r.k].add(r.start)
    best, back = {0: total + 1}, []
    for i in range(1, shards + 1):
        now, came = {}, {}
        for v in sorted(may[i]):
            for u, least in best.items():
                if u <= v and (v - u <= capacity or (u, v) == (path[i - 1], path[i])) and min(least, v - u) > now.get(v, -1):
                    now[v], came[v] = min(least, v - u), u
        back.append(came)
        best = now
    cuts = [total]
    for came in reversed(back):
        cuts.append(came[cuts[-1]])
    return sorted({x for x in cuts if x < total})


def minimax_shards(rows: DataFrame, group: list[str], within: list[str], size: str, shards: int = SHARDS) -> tuple[DataFrame, int]:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard), and the capacity. A group above the capacity is a shard larger than it.

    Groups are rows of equal ``group`` columns and are never cut; they are laid out in the order of those columns (nulls first), and within a
    group by ``within``. ``size`` must be positive. An empty table gives no rows.
    """
    placed = cut(ranked(rows, [*group, *within], size, "__pos", "__before"))
    starts = cut(placed.groupBy(*group).agg(F.min("__before").alias("start")).select("start"))
    total = placed.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    capacity, cuts = minimax_cuts(starts, total, shards)
    cuts = level_cuts(starts, total, capacity, cuts, shards)
    shard = F.lit(0)
    for at in cuts[1:]:
        shard = shard + F.when(F.col("__before") >= at, 1).otherwise(0)
    placed = placed.withColumn("shard", shard.cast("int"))
    first = {r.shard: r.p for r in placed.groupBy("shard").agg(F.min("__pos").alias("p")).collect()}
    base = F.element_at(F.create_map(*[F.lit(x) for kv in (first or {0: 0}).items() for x in kv]), F.col("shard"))
    return placed.withColumn("slot", F.col("__pos") - base).drop("__pos", "__before"), capacity


@alone
def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text and 16), text_crc32, law (``bytes``), shard, slot and grown_shard (null) of every row.

    Rows of equal text are one group (null texts are one, apart from empty ones), repeated rows too; groups are ordered by their smallest doc_id, those of one smallest
    doc_id by a hash of the text. Null texts have no bytes and the crc32 of nothing. Null doc_ids come first within their group, a group without any other comes first. Very long
    texts are only hashed and measured. An empty table gives no rows; other columns don't matter.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.when(F.col("text").isNull(), "").otherwise(F.sha2(text, 256))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        key.alias("text_key"),
    )
    shared = rows.groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut(shared.select("text_key", "first_id"))  # a table of its own: the join with a hot text can be split
    rows = rows.join(shared, "text_key", "left").withColumn("first_id", F.coalesce("first_id", "doc_id"))
    rows = rows.select("doc_id", "size", "text_crc32", "first_id", F.xxhash64("text_key").alias("text_hash"))  # narrow: the order's keys are sampled
    out, _ = minimax_shards(rows, ["first_id", "text_hash"], ["doc_id"], "size", shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
