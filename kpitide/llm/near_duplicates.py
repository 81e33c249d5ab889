"""Jaccard join on word shingles with size-banded tiles and bitmap signatures.

The set of a text is its distinct shingles of ``words`` words. Two sets link if ``den * intersection >= num * union``.

Tiles. Sets are banded by size, and the space of shingle hashes is cut into as many slices as two linked sets of a band can differ in
shingles, and some more. Two linked sets are then equal on at least one slice that is full enough (two shingles, or one where slices are
small); a tile is a band, a slice and what a set holds of it, and sets meet in a tile only then. A set near the lower end of its band
also enters the band below. A common passage or line fills whole slices of few texts, so it makes no large tile. A set with too few
full slices is sliced once more in another way, as is any it could link with.

Within a tile the members are first held against one leader. Links join members to components, and only tiles that still hold
several components go on: with other leaders, and then with every pair from different components, in blocks. Before shingles are
compared, bitmaps of hashed shingles bound the overlap from above: each bit that differs is a shingle only one of the two has. What passes is
decided by intersecting the sorted shingles themselves.

Equal sets are one node from the start (copies before the shuffle, too), so copies are never compared, however many there are.

Null and empty texts and texts of blanks alone have an empty set and link with nothing. Texts with fewer words than a shingle have one shingle, the
whole. Each row is returned with the size of its own set; rows with the same id are one document and share a component. Rows with a
null id are left out. Other columns are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpitide.llm.common import released, written
from kpitide.llm.components import components

LEAST_BITS = 1024
BITMAP_BYTES_AT_ONCE = 1 << 21
BAND_RATIO = 1.5
SLICINGS = 4
LEADER_ROUNDS = 4
WORTH_A_ROUND = 0.05  # share of a round's pairs that must link for another round of leaders
BLOCK = 512
SALTS = 16
PAIRS_AT_ONCE = 200_000
SEEN_AT_ONCE = 1_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    size = min(words, len(tokens))
    out = np.full(len(tokens) - size + 1, size, np.uint64)  # a short text's only shingle differs from any full one
    for i in range(size):
        out = mix(out * ODD + hashed[i : len(hashed) - size + 1 + i])
    return np.unique(out)


def bitmap(found: np.ndarray) -> bytes:
    """For each of two bits or more a shingle, up to the next power of two: whether an odd number of shingles falls on it.

    A shingle that only one of two sets has changes one bit, however full the sets are.
    """
    bits = max(LEAST_BITS, 1 << (2 * len(found) - 1).bit_length()) if len(found) else LEAST_BITS
    falls = (mix(found + ODD) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(falls, minlength=bits) & 1).astype(np.uint8)).tobytes()


def differing(maps: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits maps number ``x`` and ``y`` differ. The wider of two is folded: its parts, added up, are the narrower one of its set."""
    size = np.array([len(m) for m in maps])
    least = np.minimum(size[x], size[y])
    out = np.empty(len(x), np.int64)
    for width in np.unique(least):
        at = np.flatnonzero(least == width)
        step = max(1, BITMAP_BYTES_AT_ONCE // int(width))
        for lo in range(0, len(at), step):
            some = at[lo : lo + step]
            used, place = np.unique(np.concatenate([x[some], y[some]]), return_inverse=True)
            rows = np.stack([np.bitwise_xor.reduce(np.frombuffer(maps[i], np.uint64).reshape(-1, width // 8), axis=0) for i in used])
            out[some] = np.bitwise_count(rows[place[: len(some)]] ^ rows[place[len(some) :]]).sum(axis=1)
    return out


@dataclass(frozen=True)
class Rule:
    """``words`` to a shingle; linked if den * intersection >= num * union."""

    words: int
    num: int
    den: int

    def bands(self, size: int) -> list[tuple[int, int, int]]:
        """(band, largest and smallest size in it) of the band of a size, and of the one below if it holds sizes that can link."""
        ends = band_ends(self, size)
        own = int(np.searchsorted(ends, size))
        least = -(-self.num * size // self.den)
        below = [own - 1] if own and least <= ends[own - 1] else []
        return [(b, int(ends[b]), int(ends[b - 1]) + 1 if b else 1) for b in (own, *below)]

    def slices(self, end: int, low: int) -> tuple[int, int, int]:
        """Of a band of sizes ``low`` to ``end``: most shingles in which linked sets can differ if the smaller is of the band, the number
        of slices, and the least number of shingles in a slice that counts."""
        return _slices((self.den - self.num) * end // self.num, low)

    def could(self, overlap: np.ndarray, both: np.ndarray) -> np.ndarray:
        """Whether an overlap is enough; ``both``: the sizes of the two sets added."""
        return self.den * overlap >= self.num * (both - overlap)


@lru_cache(maxsize=1024)
def _slices(differ: int, low: int) -> tuple[int, int, int]:
    """So many slices that nearly every set has more full ones than linked sets can differ in."""
    for full in (2, 1) if differ else ():
        for slices in range(differ + 1, 3 * differ + 4):
            mean = low / slices
            thin = slices * math.exp(-mean) * (1 + (mean if full == 2 else 0))
            if slices - differ - 1 >= thin + 4 * math.sqrt(thin):
                return differ, slices, full
    return differ, differ + 1 + bool(differ), 1


@lru_cache(maxsize=64)
def _ends(num: int, den: int, upto: int) -> np.ndarray:
    out, low = [], 1
    while not out or out[-1] < upto:
        high = max(low * den // num, int(low * BAND_RATIO) if low > 8 else 0)
        out.append(high)
        low = high + 1
    return np.array(out, np.int64)


def band_ends(rule: Rule, size: int) -> np.ndarray:
    return _ends(rule.num, rule.den, 1 << max(16, size.bit_length()))


def tiles(found: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of the tiles of a set."""
    out = []
    for band, end, low in rule.bands(len(found)) if len(found) else []:
        differ, slices, full = rule.slices(end, low)
        for slicing in range(SLICINGS + 1):
            tag = np.uint64((band * 16 + slicing) * 2 + 1)
            if slicing == SLICINGS:  # too few full slices each time
                out.append(mix(np.array([tag], np.uint64) * ODD))
                break
            own = found if slicing == 0 else np.sort(mix(found ^ mix(np.array([slicing], np.uint64))))
            at = ((own >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            content = np.add.reduceat(mix(own), first)
            counts = np.diff(np.append(first, len(own))) >= full
            out.append(mix(content ^ mix(at[first] * np.uint64(0x100000) + tag))[counts])
            if counts.sum() > differ:
                break
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def sets(docs: DataFrame, rule: Rule, key: str, text: str) -> DataFrame:
    """``id, n, h1, h2, bits``: size, hash and bitmap of each text's set."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, high, low, bits = [], [], [], []
            for t in b.column(1):
                found = shingles(t.as_py(), rule.words)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                sizes.append(len(found))
                high.append(int.from_bytes(digest[:8], "big", signed=True))
                low.append(int.from_bytes(digest[8:], "big", signed=True))
                bits.append(bitmap(found))
            columns = [b.column(0), pa.array(sizes, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "h1", "h2", "bits"])

    there = docs.where(F.col(key).isNotNull()).select(key, text)
    return there.mapInArrow(run, f"id {dict(docs.dtypes)[key]}, n bigint, h1 bigint, h2 bigint, bits binary")


def tile_rows(docs: DataFrame, rule: Rule, key: str, text: str) -> DataFrame:
    """``tile, same, id``: the tiles of each text; ``same`` is a hash of its set. A task passes on equal sets once."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        names = ["tile", "same", "id"]
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                some = b.slice(lo, 1000)
                keys, counts, same = [], [], []
                for t in some.column(1):
                    found = shingles(t.as_py(), rule.words)
                    h = xxhash.xxh3_64_intdigest(found.tobytes())
                    own = np.empty(0, np.uint64) if h in seen else tiles(found, rule)
                    seen.add(h)
                    if len(seen) > SEEN_AT_ONCE:
                        seen.clear()
                    keys.append(own)
                    counts.append(len(own))
                    same.append(h)
                rows = np.repeat(np.arange(len(counts)), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(keys).view(np.int64)),
                        pa.array(np.array(same, np.uint64).view(np.int64)[rows]),
                        some.column(0).take(pa.array(rows)),
                    ],
                    names=names,
                )

    there = docs.where(F.col(key).isNotNull()).select(key, text)
    return there.mapInArrow(run, f"tile bigint, same bigint, id {dict(docs.dtypes)[key]}")


def shared_tiles(rows: DataFrame) -> DataFrame:
    """``tile, leader, id``: the rows of tiles in which different sets meet, with the smallest id there; equal sets once.

    A tile is renamed to a hash of the sets in it, as near copies share many tiles: where the same sets meet again, they are the same tile.
    """
    kind = dict(rows.dtypes)["id"]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not held:
            return
        tile, same, ids = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((ids, same, tile))
        tile, same, ids = tile[order], same[order], ids[order]
        del order
        new = np.append(True, (tile[1:] != tile[:-1]) | (same[1:] != same[:-1]))
        tile, same, ids = tile[new], same[new], ids[new]
        first = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
        sizes = np.diff(np.append(first, len(tile)))
        leader = np.repeat(np.minimum.reduceat(ids, first), sizes)
        name = mix(np.bitwise_xor.reduceat(mix(same.view(np.uint64) + ODD), first) ^ mix(sizes.astype(np.uint64)))
        del tile, same, new
        once = np.zeros(len(first), bool)
        once[np.unique(name, return_index=True)[1]] = True
        keep = np.repeat((sizes > 1) & once, sizes)
        tile, leader, ids = np.repeat(name.view(np.int64), sizes)[keep], leader[keep], ids[keep]
        for lo in range(0, len(tile), 100_000):
            part = slice(lo, lo + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (tile, leader, ids)], names=["tile", "leader", "id"])

    return rows.repartition("tile").mapInArrow(run, f"tile bigint, leader {kind}, id {kind}")


def verified(pairs: DataFrame, known: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Those of ``a, b`` that link. ``known``: sizes and bitmaps, ``texts``: ``id, text`` of all ids concerned."""

    def sides(side: str) -> DataFrame:
        return known.select(F.col("id").alias(side), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits"))

    kind = dict(pairs.dtypes)["a"]

    @released
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sizes = b.column(2).to_numpy() + b.column(4).to_numpy()
            row = np.arange(b.num_rows)
            apart = differing(b.column(3).to_pylist() + b.column(5).to_pylist(), row, row + b.num_rows)
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(rule.could((sizes - apart) // 2, sizes)))

    with_bits = pairs.join(sides("a"), "a").join(sides("b"), "b").select("a", "b", "a_n", "a_bits", "b_n", "b_bits")
    passed = written(with_bits.mapInArrow(bounded, f"a {kind}, b {kind}"), "jaccard-passed")

    # The leader's text comes once, then the texts of all it is held against. A leader of many is dealt out to as many tasks as it fills, each
    # with its text. Who needs which text is settled first, so that texts are joined once.
    busy = passed.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("tasks"))
    own = busy.select("a", F.lit(0).alias("kind"), F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"))
    salt = F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("salt")
    other = passed.join(busy, "a").select("a", F.lit(1).alias("kind"), "b", salt)
    rows = own.unionByName(other).join(texts, F.col("b") == texts["id"]).select("a", "salt", "kind", "b", "text")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "kind").select("a", "kind", "b", "text")

    @released
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.empty(0, np.uint64)
        for batch in batches:
            keep_a, keep_b = [], []
            for a, side, b, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingles(t, rule.words)
                if side == 0:
                    mine = found
                    continue
                # Both are sorted: the places of one in the other.
                at = np.minimum(np.searchsorted(mine, found), len(mine) - 1)
                shared = int((mine[at] == found).sum()) if len(mine) else 0
                if rule.could(shared, len(mine) + len(found)) and shared:
                    keep_a.append(a)
                    keep_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(keep_a, batch.schema.field(0).type), pa.array(keep_b, batch.schema.field(2).type)], names=["a", "b"])

    return rows.mapInArrow(exact, f"a {kind}, b {kind}")


def block_pairs(members: DataFrame, known: DataFrame, rule: Rule) -> DataFrame:
    """Pairs ``a, b`` from different components of a tile whose bitmaps allow a link. ``members``: ``tile, id, component``."""
    kind = dict(members.dtypes)["id"]
    counted = members.join(members.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "tile")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = counted.join(known.select("id", "n", "bits"), "id").withColumn("own", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})

    @released
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        tile, i, j, own, ids, comp, n = (table.column(c).to_numpy() for c in range(7))
        order = np.lexsort((own, j, i, tile))
        tile, i, j, own, ids, comp, n = (x[order] for x in (tile, i, j, own, ids, comp, n))
        bits = table.column(7).take(pa.array(order)).to_pylist()
        new = np.append(True, (tile[1:] != tile[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(tile))
        at_group = np.cumsum(new) - 1
        # Within a block a row meets those after it; of two blocks the first, which comes first, meets the second.
        second = start + np.add.reduceat((own == i).astype(np.int64), start)
        same = i == j
        first_met = np.where(same, np.arange(len(tile)) + 1, second[at_group])
        met = np.where(same | (own == i), end[at_group] - first_met, 0)
        rows = np.flatnonzero(met > 0)
        upto = np.cumsum(met[rows])
        lo = 0
        while lo < len(rows):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS_AT_ONCE)))
            some, count = rows[lo:hi], met[rows[lo:hi]]
            x = np.repeat(some, count)
            y = np.repeat(first_met[some] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            apart = comp[x] != comp[y]
            x, y = x[apart], y[apart]
            both = n[x] + n[y]
            could = rule.could((both - differing(bits, x, y)) // 2, both)
            a, b = ids[x[could]], ids[y[could]]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])
            lo = hi

    placed = placed.select("tile", "i", "j", "own", "id", "component", "n", "bits").repartition("tile", "i", "j")
    return placed.mapInArrow(work, f"a {kind}, b {kind}").distinct()


def joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """``id, component`` after more links ``a, b`` between the ids."""
    of_a = labels.select(F.col("id").alias("a"), F.col("component").alias("a_component"))
    of_b = labels.select(F.col("id").alias("b"), F.col("component").alias("b_component"))
    between = more.join(of_a, "a").join(of_b, "b").select(F.col("a_component").alias("a"), F.col("b_component").alias("b"))
    merged = components(between).select(F.col("id").alias("component"), F.col("component").alias("_merged"))
    out = labels.join(merged, "component", "left").select("id", F.coalesce("_merged", "component").alias("component"))
    return written(out, "jaccard-labels")


def nodes(known: DataFrame) -> DataFrame:
    """``id, node`` of each id: the smallest id with an equal set. Ids of a frequent set are dealt to ``SALTS`` tasks: each has a first id there, and these the first of all."""
    salted = known.select("id", "n", "h1", "h2", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    of_set = ["n", "h1", "h2"]
    first = salted.groupBy(*of_set, "salt").agg(F.min("id").alias("first"))
    of_id = salted.join(first, [*of_set, "salt"]).select(*of_set, "first", "id")
    node = first.groupBy(*of_set).agg(F.min("first").alias("node"))
    of_first = first.join(node, of_set).select(*of_set, "first", "node").distinct()
    return of_id.join(of_first, [*of_set, "first"]).select("id", "node").distinct()


def group(docs: DataFrame, rule: Rule, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component``: size of each text's set, and the smallest id it can reach by links."""
    known = written(sets(docs, rule, key, text), "jaccard-sets")
    of_node = written(nodes(known.where("n > 0")), "jaccard-nodes")

    shared = written(shared_tiles(tile_rows(docs, rule, key, text)), "jaccard-tiles")
    of_id = of_node.select(F.col("id").alias("_id"), "node")
    members = shared.join(of_id, shared["id"] == of_id["_id"]).select("tile", "leader", F.col("node").alias("id"))
    leaders = of_node.select(F.col("id").alias("leader"), F.col("node").alias("a"))
    members = written(members.join(leaders, "leader").select("tile", "a", "id").distinct(), "jaccard-members")

    ids = written(members.select("id").distinct(), "jaccard-ids")
    # Both by shuffle at any size, as the ids are too many to broadcast in a large table.
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(ids.hint("merge"), "id", "left_semi")
    texts = written(texts, "jaccard-texts")
    some = written(known.join(ids.hint("merge"), "id", "left_semi").select("id", "n", "bits"), "jaccard-some")

    tried = members.where("a != id").select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()
    tried = written(tried, "jaccard-pairs")
    links = written(verified(tried, some, texts, rule), "jaccard-links")
    labels = joined(ids.select("id", F.col("id").alias("component")), links)
    places = members.select("tile", "id").distinct()
    turn, n_links, n_pairs = 0, links.count(), tried.count()
    while True:
        open_rows = places.join(labels, "id")
        mixed = open_rows.groupBy("tile").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
        places = written(open_rows.join(mixed, "tile").select("tile", "id", "component", "low", "high"), "jaccard-open")
        if places.isEmpty():
            break
        leaders_again = turn < LEADER_ROUNDS and n_links > WORTH_A_ROUND * n_pairs
        if leaders_again:  # one member of the first or last component, by turns, against the other components
            side = "high" if turn % 2 else "low"
            at = places.where(F.col("component") == F.col(side)).groupBy("tile").agg(F.max("id").alias("head"))
            pairs = places.where(F.col("component") != F.col(side)).join(at, "tile").select(F.least("head", "id").alias("a"), F.greatest("head", "id").alias("b")).distinct()
        else:
            pairs = block_pairs(places.select("tile", "id", "component"), some, rule)
        pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
        more = written(verified(pairs, some, texts, rule), "jaccard-links")
        turn, n_links, n_pairs = turn + 1, more.count(), pairs.count()
        if n_links:
            labels = joined(labels, more)
        if not leaders_again:
            break
        tried = tried.unionByName(pairs)
        places = places.select("tile", "id")

    of_component = labels.select(F.col("id").alias("node"), "component")
    found = of_node.join(of_component, "node", "left").groupBy("id").agg(F.min(F.coalesce("component", "node")).alias("component"))
    return known.select("id", F.col("n").alias("n_shingles")).join(found, "id", "left").select(
        "id", "n_shingles", F.coalesce("component", "id").alias("component")
    )


def first_of_each(docs: DataFrame, rule: Rule, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, one of each group; rows with a null id stay. Their columns are unchanged."""
    found = group(docs, rule, key, text)
    gone = written(found.where("id != component").select(F.col("id").alias(key)), "jaccard-gone")
    return docs.join(gone, key, "left_anti").select(*docs.columns)
