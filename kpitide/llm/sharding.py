"""Shards of nearly equal size: a minimax contiguous partition of ordered atomic groups.

Rows with equal texts are one group, which no cut parts. Groups are ordered by the digest of their text, and cut into as many stretches as
there are shards so that the largest stretch is as small as it can be: a binary search over the capacity of a shard, where a capacity
is tried by filling shards greedily. Within that capacity each cut then lies at the group's end nearest to its equal share. A group
as large as a shard's share of what is left, such as a text that a third of all rows hold, is a shard of its own, ahead of the order.

A greedy pass needs few places of the order only, so the driver never holds the groups. It holds sums by the first digits of the digest, and
a stretch of the order in which a pass may end is summed by one digit more until the place is known exactly. The number of sums follows
from the number of shards, not from the rows.

Everything is DataFrame functions. Sizes and digests are taken once and written to the shared folder; texts are not shuffled. The slots of a shard are
numbered in buckets of rows, so that a shard or a group with a third of all rows is many tasks.

Null texts count as empty ones, with which they form a group. Rows with a null or repeated id are rows like others. An empty table gives
no rows; with fewer groups than shards some shards stay empty. Other columns are not touched.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpitide.llm.common import written

OVERHEAD = 16  # bytes a row counts beside its text
DIGITS = 32  # hexadecimal, of the digest
FIRST_DIGITS = 3
BUCKETS = 256
BEYOND = "g"  # sorts after all digests


def _bytes(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def digest(text: str) -> Column:
    """The digest of a text, by which groups are told apart and ordered."""
    return F.substring(F.sha2(_bytes(text), 256), 1, DIGITS)


def sized(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, size, text_crc32, digest, row``: one row per row, with a number of its own once it is written."""
    return docs.select(
        F.col(key).alias("id"),
        (F.octet_length(_bytes(text)) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(_bytes(text)).alias("text_crc32"),
        digest(text).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )


Span = tuple[int, int]  # the least and the largest place that something can be at


class Order:
    """What is known of the groups in their order: bytes and numbers of groups by the first digits of their digests.

    A place is a number of bytes from the start; places between groups are ends. Asked for an end in a stretch of several groups, it
    answers with a span, and notes that the stretch is to be looked into.
    """

    def __init__(self, nodes: list[tuple[str, int, int]]):
        self.wanted: set[str] = set()
        self._set(nodes)

    def _set(self, nodes: list[tuple[str, int, int]]) -> None:
        self.nodes = sorted(nodes)
        self.ends, at = [], 0
        for _, size, _ in self.nodes:
            at += size
            self.ends.append(at)
        self.total = at

    def refine(self, children: list[tuple[str, int, int]]) -> None:
        self._set([n for n in self.nodes if n[0] not in self.wanted] + children)
        self.wanted = set()

    def _around(self, x: int) -> tuple[int, int, bool]:
        """The known ends before and after a place, and whether no end lies between them."""
        if x <= 0 or x >= self.total:
            at = 0 if x <= 0 else self.total
            return at, at, True
        i = bisect_right(self.ends, x)
        before = self.ends[i - 1] if i else 0
        return (before, before, True) if before == x else (before, self.ends[i], self.nodes[i][2] == 1)

    def want(self, low: int, high: int) -> None:
        """Look into all stretches that such places lie in."""
        for i in range(bisect_right(self.ends, low), min(bisect_left(self.ends, high) + 1, len(self.ends))):
            if self.nodes[i][2] > 1:
                self.wanted.add(self.nodes[i][0])

    def below(self, x: Span) -> Span:
        """The last end at or before a place."""
        before, _, _ = self._around(x[0])
        last, _, exact = self._around(x[1])
        return before, last if exact else x[1]

    def above(self, x: Span) -> Span:
        """The first end at or after a place."""
        _, first, exact = self._around(x[0])
        return first if exact else x[0], self._around(x[1])[1]

    def nearest(self, x: int) -> Span:
        before, after, exact = self._around(x)
        if not exact:
            self.want(x, x)
            return before, after
        return (before, before) if x - before <= after - x else (after, after)

    def reach(self, capacity: int, shards: int) -> Span:
        """How far greedily filled shards come."""
        at = (0, 0)
        for _ in range(shards):
            at = self.below((at[0] + capacity, at[1] + capacity))
        return at

    def capacity(self, shards: int) -> Span:
        """The smallest capacity with which the shards hold everything."""

        def least(fits: Callable[[int], bool]) -> int:
            low, high = -(-self.total // shards), self.total
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if fits(middle) else (middle + 1, high)
            return low

        low = least(lambda c: self.reach(c, shards)[1] >= self.total)
        high = least(lambda c: self.reach(c, shards)[0] >= self.total)
        if low < high:
            a = b = 0
            for _ in range(shards):
                self.want(a + low, b + high)
                a, b = self.below((a + low, a + low))[0], self.below((b + high, b + high))[1]
        return low, high

    def cuts(self, capacity: int, shards: int) -> list[Span]:
        """Ends that part the order into shards of at most the capacity, each as near to its equal share as that allows."""
        last = [(self.total, self.total)]  # the first place each cut can be at, from the last cut to the first
        for _ in range(shards - 1):
            low, high = last[-1]
            last.append(self.above((low - capacity, high - capacity)))
        found, at = [], (0, 0)
        for j in range(1, shards):
            least, full = last[shards - j], self.below((at[0] + capacity, at[1] + capacity))
            near = self.nearest(j * self.total // shards)
            at = tuple(max(least[i], min(near[i], full[i])) for i in (0, 1))
            found.append(at)
            if at[0] < at[1]:
                self.want(least[0] - 1, least[1])
                self.want(full[0], full[1])
        return found

    def first_digits(self, end: int) -> str:
        """What the digests after an end begin with."""
        i = bisect_right(self.ends, end) if end else 0
        return self.nodes[i][0] if i < len(self.nodes) else BEYOND


@dataclass(frozen=True)
class Plan:
    """Where groups go: ``alone`` are digests with shards of their own, the first ones; ``cuts`` part the order of the others."""

    alone: tuple[str, ...]
    cuts: tuple[str, ...]
    capacity: int  # of the shards of the order

    def shard(self, digests: Column) -> Column:
        passed = F.size(F.filter(F.array(*[F.lit(c) for c in self.cuts]), lambda c: c <= digests)) if self.cuts else F.lit(0)
        out = passed + len(self.alone)
        for n, own in enumerate(self.alone):
            out = F.when(digests == own, n).otherwise(out)
        return out.cast("int")


def _summed(groups: DataFrame, prefix: Column) -> list[tuple[str, int, int]]:
    sums = groups.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return [(r["prefix"], r["bytes"], r["n"]) for r in sums.where("prefix is not null").collect()]


def _one_digit_more(wanted: set[str]) -> Column:
    """The first digits of a digest, one more than those of the wanted stretch it is in; null if it is in none."""
    out = F.lit(None).cast("string")
    for digits in sorted({len(p) for p in wanted}):
        here = F.substring("digest", 1, digits).isin(sorted(p for p in wanted if len(p) == digits))
        out = F.when(here, F.substring("digest", 1, digits + 1)).otherwise(out)
    return out


def plan(rows: DataFrame, shards: int) -> Plan:
    """The cuts for rows ``size, digest``."""
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[str] = []
    for r in groups.orderBy(F.desc("bytes"), "digest").limit(shards).collect():
        left = shards - len(alone)
        if left == 1 or r["bytes"] * left < total:
            break
        alone.append(r["digest"])
        total -= r["bytes"]
    others = groups.where(~F.col("digest").isin(alone)) if alone else groups
    order = Order(_summed(others, F.substring("digest", 1, FIRST_DIGITS)))
    left = shards - len(alone)
    while True:
        low, high = order.capacity(left)
        cuts = order.cuts(low, left) if low == high else []
        if not order.wanted:
            return Plan(tuple(alone), tuple(order.first_digits(at) for at, _ in cuts), low)
        order.refine(_summed(others, _one_digit_more(order.wanted)))


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, size, text_crc32, digest, shard, slot`` of each row; slots count from 0 in each shard."""
    rows = written(sized(docs, key, text), "shard-rows")
    made = plan(rows, shards)
    bucket = F.pmod(F.xxhash64("row"), F.lit(BUCKETS)).cast("int")
    placed = rows.withColumn("shard", made.shard(F.col("digest"))).withColumn("bucket", bucket)
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row")) - 1
    numbered = placed.withColumn("within", within).join(before, ["shard", "bucket"])
    slot = (F.col("before") + F.col("within")).cast("bigint")
    return numbered.select("id", "size", "text_crc32", "digest", "shard", slot.alias("slot"))


def write(docs: DataFrame, path: str, shards: int, tasks: int = 1, key: str = "doc_id", text: str = "text") -> Plan:
    """Write the rows, texts and all, into one folder per shard (``shard=n``), each in up to ``tasks`` files. A column named shard is replaced."""
    rows = written(sized(docs, key, text), "shard-rows")
    made = plan(rows, shards)
    dealt = docs.withColumn("shard", made.shard(digest(text))).withColumn("_part", F.pmod(F.xxhash64(key), F.lit(tasks)))
    dealt.repartition(shards * tasks, "shard", "_part").drop("_part").write.mode("overwrite").partitionBy("shard").parquet(path)
    return made
