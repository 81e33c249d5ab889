"""Ranked search, hard negatives and shards against plain versions, and the two queries that SQL can express against their SQL."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpitide.llm import hard_negatives, lexical, sharding
from kpitide.llm.queries import QUERIES, SQL
from tests.compare import DATA, connect, differences
from tests.llm import edge

SMALL = str(DATA / "sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, name, sf):
    sf_dir = str(DATA / sf)
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], connect(sf_dir)) == []


# Ranked search


def split(text):
    lowered = (text or "").translate({65 + i: 97 + i for i in range(26)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k):
    docs = [(i, split(t)) for i, t in docs if i is not None and split(t)]
    N, L = len(docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, words in docs for t in set(words))
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(split(t))
    out = []
    for item, terms in asked.items():
        found = []
        for i, words in docs:
            tf, m = Counter(words), 50 + (50 * len(words) * N) // L
            weight = {t: math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) for t in terms}
            s = sum(weight[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in terms if t in tf)
            if s > 0:
                found.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def ranked(spark, docs, items, k, kind="bigint"):
    d = spark.createDataFrame(docs, f"doc_id {kind}, text string, id int, score double, item string, rank int, term string")
    i = spark.createDataFrame(items, "item_id bigint, text string, id int, doc_id string")
    return sorted(tuple(r) for r in lexical.search(d, i, k).collect())


def word_rows(seed=5, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Été", "中文", "A1", "x-y", "İ"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 40))) for _ in range(n)]
    return texts + [None, "", "!!", texts[0], texts[0], "w1 " * 5000], words, rng


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_a_plain_one(spark, monkeypatch, small):
    if small:  # several blocks of items, few documents at a time, few candidates held
        monkeypatch.setattr(lexical, "ITEM_BYTES", 300)
        monkeypatch.setattr(lexical, "CELLS", 500)
        monkeypatch.setattr(lexical, "HELD", 10)
    texts, words, rng = word_rows()
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "w1 w2"), (7, texts[9]), (7, texts[9])]
    items = [(i, " ".join(rng.sample(words, rng.randrange(1, 12)))) for i in range(25)] + [(3, "w1 w29"), (None, "w1"), (90, None), (91, ".."), (92, "nowhere")]
    got = ranked(spark, [(*d, 1, 0.5, "a", 2, "t") for d in docs], [(*i, 1, "z") for i in items], 7)
    assert got == plain_search(docs, items, 7)


def test_search_of_text_ids_ties_and_nothing(spark):
    docs = [(i, t, 1, 0.5, "a", 2, "t") for i, t in [("b", "q r"), ("a", "q r"), ("c", "q r"), ("d", "s")]]
    assert [r[:3] for r in ranked(spark, docs, [(1, "q", 1, "z")], 2, "string")] == [(1, 1, "a"), (1, 2, "b")]
    assert ranked(spark, [], [(1, "q", 1, "z")], 2) == [] and ranked(spark, docs, [], 2, "string") == []
    found = lexical.search(edge.docs(spark), spark.createDataFrame([(1, "one word3 été")], "item_id int, text string"), 50).collect()
    assert {r["id"] for r in found} == {3, 4, 5, 6, 9} and len(found) == 6


def test_sets_are_shared_and_add_up():
    rng = random.Random(2)
    items = [sorted(rng.sample(range(60), rng.randrange(1, 25))) for _ in range(80)] + [list(range(10)), list(range(10)), []]
    found = lexical.share(items, 60)
    held = [set(np.flatnonzero(found.of_term == n).tolist()) if n < found.first else None for n in range(found.first)]
    for a, b in found.pairs:
        assert not held[a] & held[b]
        held.append(held[a] | held[b])
    for own, sets in zip(items, found.items):
        parts = [held[n] for n in sets]
        known = {t for t in own}
        assert set().union(*parts) & {t for o in items for t in o} == known and sum(map(len, parts)) == len(set().union(*parts))
    assert found.additions < 0.8 * sum(max(0, len(o) - 1) for o in items)


# Hard negatives


def plain_negatives(rows, positives=5, negatives=3):
    size = Counter(len(v) for _, v, _ in rows if v is not None).most_common()
    size = max((n, s) for s, n in size)[1] if size else 0
    fine = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows if None not in (i, l, v) and len(v) == size and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, v in fine:
        if i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in fine if j != i]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            fit = sorted(x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(i, p, r, j, -s, -t) for r, (t, j, _) in enumerate(fit, 1)]
    return sorted(out)


def negatives(spark, rows):
    df = spark.createDataFrame([(*r, 1, "c", 0.5, 3) for r in rows], "vec_id bigint, embedding array<float>, label int, id int, cell string, norm double, part int")
    found = hard_negatives.mine(df, F.col("id") % 50 == 0, 5, 3, (50, 95), F.col("label"), lambda x: F.floor(256 * x))
    return sorted(tuple(r) for r in found.collect())


def vector_rows(seed, n=700, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    out = []
    for i in range(n):
        v = centres[rng.integers(8)] * rng.uniform(0.2, 3) + rng.normal(size=dim) * rng.choice([0.02, 0.5])
        out.append((i * 5, [float(np.float32(x)) for x in v], int(rng.integers(4))))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_negatives_equal_a_plain_search(spark, monkeypatch, seed):
    if seed == 2:  # many parts and slices, few scores at a time
        monkeypatch.setattr(hard_negatives, "PART", 1)
        monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 20)
        monkeypatch.setattr(hard_negatives, "CELLS_AT_ONCE", 500)
    rows = vector_rows(seed)
    rows += [(i, rows[3][1], rows[3][2]) for i in range(10_001, 10_400)]  # more than a third are equal
    rows += [(20_000 + 50 * k, rows[3][1], k % 4) for k in range(5)]
    nan, inf = float("nan"), float("inf")
    rows += [(50, None, 1), (100, [1.0] * 6, None), (None, [1.0] * 6, 1), (150, [nan] + [1.0] * 5, 1), (200, [inf] * 6, 1), (250, [None] * 6, 1), (350, [1.0] * 5, 1)]
    rows += [(30_000, [0.0] * 6, 1), (30_001, [0.0] * 6, 2), (30_002, [0.001] * 6, 1), rows[0], rows[0], (0, rows[1][1], 3)]
    assert negatives(spark, rows) == plain_negatives(rows)


def test_negatives_of_few_rows(spark):
    assert negatives(spark, []) == []
    assert negatives(spark, [(0, [1.0, 0.0], 1)]) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.1], 2), (3, [0.9, 0.1], 2), (4, [-1.0, 0.0], 1), (6, [0.0, 0.0], 2)]
    assert negatives(spark, rows) == plain_negatives(rows) != []


def test_bounds_hold_and_part_clustered_vectors(spark):
    rng = np.random.default_rng(4)
    x = np.round(256 * (np.repeat(np.eye(8), 40, axis=0) + rng.normal(size=(320, 8)) * 0.05)).astype(np.int64)
    points = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "id bigint, label int, vec array<bigint>")
    references = hard_negatives.learn(points, 8)
    placed = hard_negatives.with_angles(points, references, 8).cache()
    cells = hard_negatives.Cells(placed, len(references))
    rows = sorted(placed.collect(), key=lambda r: r["id"])
    own, norms = np.array([r["angles"] for r in rows]), np.array([r["norm"] for r in rows])
    low, high = cells.bounds(own, norms)
    scores = x @ x.T
    for c, cell in enumerate(cells.cell):
        inside = [i for i, r in enumerate(rows) if r["cell"] == cell]
        assert (scores[:, inside].min(axis=1) >= low[:, c]).all() and (scores[:, inside].max(axis=1) <= high[:, c]).all()
    reached = (high >= 0.5 * norms.mean() ** 2).mean()
    assert reached < 0.5
    a, b = np.array([r["angle"] for r in rows]), np.array([r["cell"] for r in rows])
    for cell in set(b.tolist()):
        at = np.flatnonzero(b == cell)
        near = hard_negatives._window(a[at], norms[at], own[:, cell], norms, np.full(320, 40_000.0), np.full(320, 60_000.0), cell)
        assert near[(scores[:, at] >= 40_000) & (scores[:, at] <= 60_000)].all()


# Shards


def plain_capacity(sizes, shards):
    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    low = max([-(-sum(sizes) // shards), *sizes]) if sizes else 0
    return next(c for c in range(low, sum(sizes) + 1) if fits(c))


def shard_rows(spark, texts, shards, ids=None, monkey=None):
    rows = [(i, t, 1, "s", 5, "d") for i, t in zip(ids or range(len(texts)), texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, size int, shard string, row int, digest string")
    return docs, sharding.assign(docs, shards).collect()


def check_shards(rows, texts, shards):
    assert len(rows) == len(texts) and Counter(len((t or "").encode()) + 16 for t in texts) == Counter(r["size"] for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    of_text = defaultdict(set)
    for r in rows:
        of_text[r["digest"]].add(r["shard"])
    assert all(len(s) == 1 for s in of_text.values()) and len(of_text) == len({t or "" for t in texts})
    return Counter({s: sum(r["size"] for r in rows if r["shard"] == s) for s in slots})


@pytest.mark.parametrize(("n", "shards", "digits"), [(500, 7, 1), (500, 40, 1), (60, 40, 3), (2000, 40, 1), (3, 40, 3), (1, 1, 3), (200, 1, 1)])
def test_shards_are_as_equal_as_can_be(spark, monkeypatch, n, shards, digits):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    rng = random.Random(n + shards)
    texts = [f"{i} " + "x" * int(rng.paretovariate(1.2) * 20) for i in range(n)] + ["copy"] * (n // 3)
    _, rows = shard_rows(spark, texts, shards)
    bytes_of = check_shards(rows, texts, shards)
    groups = Counter()
    for r in rows:
        groups[r["digest"]] += r["size"]
    rest, left, alone = dict(groups), shards, []
    for d, size in sorted(groups.items(), key=lambda g: (-g[1], g[0])):
        if left == 1 or size * left < sum(rest.values()):
            break
        alone.append(rest.pop(d))
        left -= 1
    capacity = plain_capacity([rest[d] for d in sorted(rest)], left)
    assert all(bytes_of[s] == size for s, size in enumerate(alone))
    assert max((b for s, b in bytes_of.items() if s >= len(alone)), default=0) <= capacity
    if len(rest) > 20 * left:
        small = min(bytes_of[s] for s in range(len(alone), shards))
        assert small >= capacity - 2 * max(rest.values())


def test_a_text_of_a_third_of_all_rows_has_a_shard(spark):
    texts = ["hot " * 30] * 400 + [f"text {i} of some length" * 3 for i in range(800)] + [None, "", None]
    _, rows = shard_rows(spark, texts, 10, ids=[1] * len(texts))
    bytes_of = check_shards(rows, texts, 10)
    rest = [b for s, b in bytes_of.items() if s]
    assert bytes_of[0] == 400 * 136 and len(rest) == 9 and max(rest) < 1.05 * min(rest)


def test_shards_of_nothing_and_of_edge_rows(spark):
    assert sharding.assign(edge.empty(spark), 4).collect() == []
    rows = sharding.assign(edge.docs(spark), 4).collect()
    check_shards(rows, [r[1] for r in edge.rows()], 4)


def test_written_shards_hold_all_rows(spark, tmp_path):
    texts = [f"text {i % 50}" for i in range(300)]
    docs, rows = shard_rows(spark, texts, 5)
    sharding.write(docs, str(tmp_path / "out"), 5, tasks=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["shard"], r["text"]) for r in back.collect()) == sorted((r["id"], r["shard"], texts[r["id"]]) for r in rows)


def test_shards_need_no_python(spark):
    plan = QUERIES["op13_shards"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
