"""Jaccard join, near vectors, neighbours and components against plain versions."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpitide.llm import near_duplicates, near_vectors, neighbours
from kpitide.llm.components import components
from tests.llm import edge


def smallest(nodes, pairs):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def plain_groups(rows, rule):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        n = rule.words
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())
    ids, pairs = sorted(sets), []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and rule.den * shared >= rule.num * len(sets[a] | sets[b]):
                pairs.append((a, b))
    found = smallest(ids, pairs)
    return {i: (len(sets[i]), found[i]) for i in ids}


def texts():
    random.seed(3)
    letters = list("abcdefg") + [str(k) for k in range(40)]
    common = [str(k) for k in range(40)]
    rows = []
    for _ in range(60):
        base = random.choices(letters, k=random.choice([3, 4, 5, 6, 7, 9, 12, 20, 30, 60, 150]))
        for _ in range(random.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3])):
                copy[random.randrange(len(copy))] = random.choice("xyzuvw")
            if random.random() < 0.15:
                copy = common + copy[: random.randrange(1, 20)]
            rows.append((3 * len(rows), " ".join(copy).upper() if random.random() < 0.2 else " ".join(copy)))
    base = [f"w{k}" for k in range(120)]
    for k in range(90):  # a group of near copies, many of which do not link directly
        copy = list(base)
        for _ in range(random.choice([1, 2, 4])):
            copy[random.randrange(len(copy))] = f"q{random.randrange(10**6)}"
        rows.append((10_000 + k, " ".join(copy)))
    return rows + [(90_001, None), (90_002, ""), (90_003, " \t"), (90_004, "É é")]


@pytest.mark.parametrize("rule", [near_duplicates.Rule(4, 85, 100), near_duplicates.Rule(5, 4, 5)])
def test_groups_equal_all_pairs(spark, rule):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.id: (r.n_shingles, r.component) for r in near_duplicates.group(docs, rule).collect()}
    assert found == plain_groups(rows, rule)


@pytest.mark.parametrize("rule", [near_duplicates.Rule(4, 85, 100), near_duplicates.Rule(5, 4, 5)])
def test_linked_sets_always_share_a_tile(rule):
    rng = np.random.default_rng(1)
    for size in [*range(1, 60), 100, 333, 1000]:
        for _ in range(6):
            one = np.unique(rng.integers(0, 1 << 63, size, dtype=np.int64).astype(np.uint64) * np.uint64(2))
            gone = int(rng.integers(0, size // 3 + 1))
            new = rng.integers(0, 1 << 63, int(rng.integers(0, size // 3 + 1)), dtype=np.int64).astype(np.uint64) * np.uint64(2)
            two = np.unique(np.concatenate([rng.permutation(one)[gone:], new]))
            shared, union = len(np.intersect1d(one, two)), len(np.union1d(one, two))
            if shared and rule.den * shared >= rule.num * union:
                assert len(np.intersect1d(near_duplicates.tiles(one, rule), near_duplicates.tiles(two, rule)))
                maps = [near_duplicates.bitmap(one), near_duplicates.bitmap(two)]
                bits = int(near_duplicates.differing(maps, np.array([0]), np.array([1]))[0])
                assert (len(one) + len(two) - bits) // 2 >= shared


def test_group_edges(spark):
    rule = near_duplicates.Rule(5, 4, 5)
    kept = near_duplicates.first_of_each(edge.docs(spark), rule)
    assert kept.columns == edge.docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 3, 5, 6, 7, 8]
    assert near_duplicates.group(edge.empty(spark), rule).count() == 0


def test_blocks_find_what_leaders_missed(spark):
    rule = near_duplicates.Rule(4, 85, 100)
    rows = texts()
    docs = spark.createDataFrame(rows, "id bigint, text string")
    known = near_duplicates.sets(docs, rule, "id", "text").where("n > 50")
    members = known.select(F.lit(1).cast("bigint").alias("tile"), "id", F.col("id").alias("component"))
    pairs = {(r.a, r.b) for r in near_duplicates.block_pairs(members, known, rule).collect()}
    sets = {i: near_duplicates.shingles(t, 4) for i, t in rows}
    ids = [r.id for r in known.select("id").collect()]
    for a in ids:
        for b in ids:
            shared = len(np.intersect1d(sets[a], sets[b]))
            if a < b and 100 * shared >= 85 * (len(sets[a]) + len(sets[b]) - shared):
                assert (a, b) in pairs
    assert all(a < b for a, b in pairs)


def test_components(spark):
    random.seed(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(random.randrange(80), random.randrange(80)) for _ in range(50)] + [(500, 500 + i) for i in range(1, 40)]
    nodes = {x for p in pairs for x in p if p[0] != p[1]}
    found = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {k: v for k, v in smallest({x for p in pairs for x in p}, pairs).items() if k in nodes}


VECTORS = "vec_id bigint, embedding array<float>, label int, id int, score double"


def vector_rows():
    rng = np.random.default_rng(2)
    rows = []
    for c in range(40):
        base = rng.normal(size=16)
        for _ in range(int(rng.choice([1, 1, 2, 30]))):
            rows.append((len(rows), [float(x) for x in base + rng.normal(size=16) * 0.08], int(c % 3), 1, 0.1))
    n = len(rows)
    nan, inf = float("nan"), float("inf")
    rows += [(n, None, 1, 1, 0.1), (n + 1, [0.0] * 16, 1, 1, 0.1), (n + 2, [nan] + [1.0] * 15, 1, 1, 0.1), (n + 3, [inf] + [1.0] * 15, 1, 1, 0.1), (n + 4, [None] + [1.0] * 15, 1, 1, 0.1), (n + 5, [1.0, 2.0], 1, 1, 0.1)]
    rows += [(n + 6, rows[0][1], None, 1, 0.1), (n + 7, rows[0][1], rows[0][2], 1, 0.1), (n + 8, [], 1, 1, 0.1)]
    return rows, n


def test_near_vectors(spark):
    rows, n = vector_rows()
    found = {r.id: (r.n_links, r.component) for r in near_vectors.links(spark.createDataFrame(rows, VECTORS), 0.93).collect()}
    good = [r for r in rows if r[0] < n or r[0] == n + 7]
    units = {r[0]: np.float32(r[1]).astype(float) / np.linalg.norm(np.float32(r[1]).astype(float)) for r in good}
    pairs = [(a[0], b[0]) for a in good for b in good if a[0] < b[0] and a[2] == b[2] and units[a[0]] @ units[b[0]] >= 0.93]
    number = defaultdict(int)
    for a, b in pairs:
        number[a] += 1
        number[b] += 1
    expected = smallest([r[0] for r in rows], pairs)
    assert found == {r[0]: (number[r[0]], expected[r[0]]) for r in rows}
    assert near_vectors.links(spark.createDataFrame([], VECTORS), 0.93).count() == 0


def test_neighbours(spark):
    rows, n = vector_rows()
    df = spark.createDataFrame(rows, VECTORS)
    found = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, 5).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    good = {r[0]: np.float32(r[1]).astype(float) for r in rows if r[0] < n or r[0] in (n + 6, n + 7)}
    hits = total = 0
    for q in (i for i in good if i % 20 == 0):
        best = sorted((-float((good[q] * good[i]).sum()), i) for i in good if i != q)[:5]
        mine = sorted(found[q])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        for _, i, s in mine:
            assert s == pytest.approx(float((good[q] * good[i]).sum()), abs=1e-12) and i != q
        hits += len({i for _, i in best} & {i for _, i, _ in mine})
        total += 5
    assert set(found) == {i for i in good if i % 20 == 0}
    assert hits >= 0.9 * total
    assert neighbours.search(spark.createDataFrame([], VECTORS), F.lit(True), 5).count() == 0


def test_near_vectors_with_a_third_of_the_rows_equal(spark, monkeypatch):
    rng = np.random.default_rng(6)
    hot = rng.normal(size=16)
    rows = [(i, [float(x) for x in (hot if i % 3 == 0 else hot + rng.normal(size=16) * 0.08 if i % 3 == 1 else rng.normal(size=16))], int(i % 7 == 0), 1, 0.1) for i in range(600)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    units = np.array([np.float32(r[1]).astype(float) for r in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows])
    linked = (units @ units.T >= 0.93) & (labels[:, None] == labels) & ~np.eye(len(rows), dtype=bool)
    expected = smallest(range(len(rows)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked), strict=True) if a < b])
    met, real = spark.sparkContext.accumulator(0), near_vectors.near_codes

    def counted(batches):
        held = [b for b in batches if b.num_rows]
        met.add(sum(b.num_rows for b in held))
        yield from real(iter(held))

    monkeypatch.setattr(near_vectors, "near_codes", counted)
    for block in (near_vectors.BLOCK, 16):  # the second cuts most buckets into tiles
        monkeypatch.setattr(near_vectors, "BLOCK", block)
        before = met.value
        found = {r.id: (r.n_links, r.component) for r in near_vectors.links(df, 0.93).collect()}
        assert found == {i: (int(linked[i].sum()), expected[i]) for i in range(len(rows))}
        if block > 16:  # 402 different vectors of a label, not 600
            assert met.value - before == 402 * 12 * 18


def all_products(rows, asked, k):
    good = {i: np.float32(v).astype(float) for i, v in rows}
    out = {}
    for q in asked:
        scores = sorted((-float((good[q] * v).sum()), i) for i, v in good.items() if i != q)
        out[q] = [i for _, i in scores[:k]]
    return out


def test_neighbours_with_a_third_of_the_rows_equal(spark):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=16)
    rows = [(i, [float(x) for x in (hot if i % 3 == 0 else 0.6 * hot + rng.normal(size=16) if i % 3 == 1 else rng.normal(size=16))]) for i in range(1500)]
    df = spark.createDataFrame([(i, v, 0, 1, 0.1) for i, v in rows], VECTORS).repartition(4)
    expected = all_products(rows, [i for i, _ in rows if i % 20 == 0], 20)
    found = defaultdict(list)
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0, 20).collect():
        found[r.query_id].append((r.rank, r.vec_id))
    assert {q: len(x) for q, x in found.items()} == dict.fromkeys(expected, 20)
    for kind in (0, 1, 2):
        some = [q for q in expected if q % 3 == kind]
        recall = sum(len({i for _, i in found[q]} & set(expected[q])) for q in some) / (20 * len(some))
        assert recall >= 0.95, (kind, recall)


@pytest.mark.parametrize("n", [1, 5, 21, 30])
def test_neighbours_of_a_small_table_are_all_there(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(n)]
    df = spark.createDataFrame([(i, v, 0, 1, 0.1) for i, v in rows], VECTORS)
    found = {(r.query_id, r.rank): r.vec_id for r in neighbours.search(df, F.lit(True), 20).collect()}
    expected = all_products(rows, range(n), 20)
    assert found == {(q, k): i for q, ids in expected.items() for k, i in enumerate(ids, 1)}


def test_hilbert_curve_visits_neighbours():
    points = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    keys = neighbours.hilbert_keys(points, 3)
    assert sorted(keys) == list(range(512))
    ordered = points[np.argsort(keys)]
    assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()


def test_bitmaps_part_large_sets_just_below_the_threshold():
    """Pairs of sets of 2,000 shingles with an overlap from a little below the threshold to a little above it."""
    rule = near_duplicates.Rule(words=4, num=85, den=100)
    rng = np.random.default_rng(1)
    maps, sizes, overlap = [], [], []
    for k in range(300):
        n = int(rng.integers(1900, 2100))
        own = rng.integers(0, 2**63, n).astype(np.uint64)
        kept = int(n * rng.uniform(0.86, 0.98))
        other = np.concatenate([own[:kept], rng.integers(0, 2**63, max(0, int(rng.integers(1900, 2100)) - kept)).astype(np.uint64)])
        maps += [near_duplicates.bitmap(np.unique(own)), near_duplicates.bitmap(np.unique(other))]
        sizes.append(n + len(other))
        overlap.append(kept)
    x = np.arange(0, len(maps), 2)
    sizes, overlap = np.array(sizes), np.array(overlap)
    bound = (sizes - near_duplicates.differing(maps, x, x + 1)) // 2
    links, passed = rule.could(overlap, sizes), rule.could(bound, sizes)
    assert (bound >= overlap).all() and links.sum() > 50 and not (links & ~passed).any() and passed.sum() < 2 * links.sum()


def test_bitmaps_of_different_widths():
    rng = np.random.default_rng(2)
    a, b = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (400, 700))
    b[:390] = a[:390]
    maps = [near_duplicates.bitmap(x) for x in (a, np.unique(b), np.empty(0, np.uint64))]
    assert [len(m) * 8 for m in maps] == [1024, 2048, 1024]
    apart = near_duplicates.differing(maps, np.array([0, 1, 0, 2]), np.array([1, 0, 2, 2]))
    assert apart[0] == apart[1] <= 320 and apart[0] > 200 and apart[3] == 0 and apart[2] <= 400
