"""Sharding by a minimax contiguous partition of ordered atomic groups.

Equal texts are one group and stay together. Groups are ordered by a digest of
the text; a binary search finds the smallest capacity with which a greedy check
needs no more than the wanted shards, and the order is cut under that capacity.
The driver never sees the groups: it looks ends of groups up in a summary of at
most ``MOST_BLOCKS`` blocks of bytes, and blocks that a cut may fall into are
split again until the cuts are exact.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ranked_within, table, written

SHARDS = 24
MOST_BLOCKS = 1 << 15
_DIGEST = 32  # hexadecimal digits of the text's SHA-256 that order the groups


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, digest``: UTF-8 bytes plus ``overhead``; a null text has none and is a group of its own."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"), F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), F.coalesce(F.substring(F.sha2(text, 256), 1, _DIGEST), F.lit("")).alias("digest"))


def group_ends(sizes: DataFrame, rows_a_part: int = 20_000) -> DataFrame:
    """``digest, size, end`` of each group: bytes of all groups up to it, in order of digest.

    A running sum in two steps: over the buckets of leading digits, then within
    each bucket. Digests are uniform, so buckets are even whatever the texts.
    """
    groups = written(sizes.groupBy("digest").agg(F.sum("size").alias("size")), "groups")
    bits = min(20, max(0, (groups.count() // rows_a_part).bit_length()))
    leading = F.coalesce(F.conv(F.substring("digest", 1, 5), 16, 10).cast("long"), F.lit(0))
    dealt = groups.withColumn("bucket", F.shiftright(leading, 20 - bits))
    before = dealt.groupBy("bucket").agg(F.sum("size").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = F.sum("size").over(Window.partitionBy("bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("inside", inside).join(before, "bucket").select("digest", "size", (F.col("before") + F.col("inside")).alias("end"))


class Ends:
    """Ends of groups as far as they are known; between two known ones a gap may hide more."""

    def __init__(self, frame: DataFrame, most_blocks: int = MOST_BLOCKS):
        self.frame, self.most = frame, most_blocks
        row = frame.agg(F.max("end"), F.max("size")).first()
        self.total, self.largest = row[0] or 0, row[1] or 0
        self.known, self.open = [0, self.total], [self.total > 0]  # open[i]: of the gap before known[i + 1]
        if self.total:
            self.refine([(0, self.total)])

    def refine(self, ranges: list[tuple[int, int]]) -> None:
        """Splits the gaps of disjoint ranges whose bounds are known ends; one Spark job.

        At most about ``most`` rows come back, and the ends in closed gaps of the
        ranges, which are known already.
        """
        spans = [(bisect_right(self.known, a), bisect_right(self.known, b)) for a, b in ranges]  # known[i:j] are the ends in a range
        longest = max(self.known[k] - self.known[k - 1] for i, j in spans for k in range(i, j) if self.open[k - 1])
        step = max(1, min(-(-sum(b - a for a, b in ranges) // self.most), longest // 2))  # a gap is always split
        inside = F.lit(False)
        for a, b in ranges:
            inside |= (F.col("end") > a) & (F.col("end") <= b)
        rows = self.frame.where(inside).groupBy(F.floor(F.col("end") / F.lit(step)).alias("block")).agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n")).collect()
        hidden = {r.block: r.n for r in rows}
        firsts = {r.first for r in rows}
        points = {*firsts, *(r.last for r in rows), *(self.known[k] for i, j in spans for k in range(i, j))}
        for x in points:
            hidden[x // step] -= 1
        kept = dict(zip(self.known[1:], self.open, strict=True))
        kept |= {x: x not in firsts and hidden[x // step] > 0 for x in points}  # so a gap that stays open is within a block
        self.known = [0, *sorted(kept)]
        self.open = [kept[x] for x in self.known[1:]]

    def bounds(self, x: int) -> tuple[int, int]:
        """The last known end up to x, and the last that there might be."""
        if x >= self.total:
            return self.total, self.total
        i = bisect_right(self.known, x) - 1
        return self.known[i], x if self.open[i] else self.known[i]

    def floor(self, x: int) -> int:
        """The last end up to x, exactly."""
        while True:
            low, high = self.bounds(x)
            if low == high:
                return low
            i = bisect_right(self.known, x) - 1
            self.refine([(self.known[i], self.known[i + 1])])

    def around(self, places: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """For each given closed interval the stretch from the first to the last open gap that it touches.

        Stretches that meet are put together. Closed gaps between open ones are in
        them, so there are no more stretches than intervals, however many gaps
        there are: a condition with a part for each gap overflows the driver's stack.
        """
        out: list[tuple[int, int]] = []
        for low, high in sorted(places):
            i, j = bisect_right(self.known, low) - 1, bisect_right(self.known, high) - 1
            if gaps := [k for k in range(i, min(j, len(self.open) - 1) + 1) if self.open[k]]:
                a, b = self.known[gaps[0]], self.known[gaps[-1] + 1]
                if out and a <= out[-1][1]:
                    out[-1] = (out[-1][0], max(b, out[-1][1]))
                else:
                    out.append((a, b))
        return out


def _greedy(ends: Ends, capacity: int, shards: int, hopeful: bool) -> list[int] | None:
    """Cuts that a greedy fill makes with the known (or the possible) ends; None if it needs more shards."""
    cuts, at = [], 0
    for _ in range(shards):
        nxt = ends.bounds(at + capacity)[hopeful]
        if nxt <= at:
            return None
        cuts.append(at := nxt)
        if at >= ends.total:
            return cuts
    return None


def _smallest(ends: Ends, shards: int, hopeful: bool, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if _greedy(ends, mid, shards, hopeful) else (mid + 1, high)
    return low


def smallest_capacity(ends: Ends, shards: int) -> int:
    """The smallest capacity for which the greedy check needs at most ``shards`` shards."""
    low, high = max(ends.largest, -(-ends.total // shards)), ends.largest + -(-ends.total // shards)
    while True:
        if not _greedy(ends, high, shards, False):
            sure = high  # feasible whatever hides: a shard that can't take the next group has total / shards
        else:
            sure = _smallest(ends, shards, False, low, high)
        may = _smallest(ends, shards, True, low, sure)
        if may == sure:
            return sure
        least, most = _greedy_cuts(ends, may, shards, 0), _greedy_cuts(ends, sure, shards, 1)
        todo = ends.around(list(zip(least, most, strict=True)))
        if not todo:
            return sure
        ends.refine(todo)
        low, high = may, sure


def _greedy_cuts(ends: Ends, capacity: int, shards: int, which: int) -> list[int]:
    out, at = [], 0
    for _ in range(shards):
        out.append(at := ends.bounds(at + capacity)[which])
    return out


def cuts_under(ends: Ends, capacity: int, shards: int) -> list[int]:
    """Ends to cut at: each shard near an equal part of what is left, none over the capacity.

    A plain greedy fill would leave the last shards empty where one group is
    larger than an equal part. A cut nearer to the equal part is taken only if the
    rest still fits the shards that are left.
    """
    if not ends.total:
        return []
    equal = [k * ends.total // shards for k in range(1, shards)]
    near = 2 * (ends.total // ends.most + 1)
    if todo := ends.around([(max(0, x - near), min(ends.total, x + near)) for x in equal]):
        ends.refine(todo)

    def fits(at: int, left: int) -> bool:
        for _ in range(left):
            if at >= ends.total:
                return True
            at = ends.floor(at + capacity)
        return at >= ends.total

    cuts, at = [], 0
    for left in range(shards, 1, -1):
        if at >= ends.total:
            break
        part = at + -(-(ends.total - at) // left)
        low = ends.floor(part)
        i = bisect_right(ends.known, part)
        high = ends.known[min(i, len(ends.known) - 1)]
        choices = sorted((c for c in (low, high) if at < c <= at + capacity), key=lambda c: (abs(c - part), c))
        at = next((c for c in choices if fits(c, left - 1)), None) or ends.floor(at + capacity)
        cuts.append(at)
    return cuts


def shard_of(digest: Column, bounds: list[str]) -> Column:
    """The shard of a digest: how many of the cuts' digests come before it."""
    out = F.lit(0)
    for b in bounds:
        out = out + (digest > b).cast("int")
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row.

    Equal texts share a shard (null texts too); the largest shard is as small as
    contiguous groups allow. ``slot`` counts a shard's rows from 0, by id within
    hashed parts. Repeated rows get slots of their own. With fewer groups than
    shards some shards stay empty.
    """
    sizes = written(document_sizes(docs, id_col, text_col), "sizes")
    ends = Ends(written(group_ends(sizes), "ends"), most_blocks)
    bounds: list[str] = []
    if ends.total:
        cuts = [c for c in cuts_under(ends, smallest_capacity(ends, shards), shards) if c < ends.total]
        bounds = sorted(r.digest for r in ends.frame.where(F.col("end").isin(cuts)).select("digest").collect())
    placed = sizes.withColumn("shard", shard_of(F.col("digest"), bounds)).drop("digest")
    return ranked_within(placed, "shard", ["doc_id"]).withColumnRenamed("rank", "slot")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document; the law is ``bytes``."""
    found = shard_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))
