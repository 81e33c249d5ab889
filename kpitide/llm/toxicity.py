"""Toxicity classifier regularised with counterfactuals.

Features are the different words of a text and the beginnings of its words (four to seven letters). A beginning gives one more feature
for each of ``SHARES`` that its words reach among the different words of the text. The features that differ most between the two labels are kept, and a logistic regression is fitted to them. For each labelled sentence
that names a group of people a counterfactual is made by putting other groups' names in its place; the square of
the difference between the two scores (before the logistic function) is added to the loss. So a group's name can carry little weight of its own,
and a neutral sentence about the group is not taken for a toxic one.

The fit uses at most ``SAMPLE`` labelled rows, taken by a hash of their id; everything else covers all rows.

Rows without a label are not learned from. Null and empty texts have no features and get the score of the intercept. If there
is no labelled row of both kinds, every score is 0. Other columns are not touched. A document with several labels counts with each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 10_000
FEATURES = 4096
BITS = 22
LEAST_TEXTS = 4
RIDGE = 2e-5
COUNTERFACTUAL = 1.0
TOXIC_WEIGHT = 2.0  # of a toxic row in the loss
STEPS = 500
ROWS_AT_ONCE = 500
PREDICT_FROM = 0.7
KEPT = 300_000
PREFIXES = (4, 5, 6, 7)
SHARES = (0.01, 0.03)
WORD = re.compile(r"[^\W\d_]+")

# Names of groups of people; a word is replaced by the others of its line.
GROUPS = (
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "foreigner", "refugee", "citizen"),
    ("immigrants", "foreigners", "refugees", "citizens"),
    ("old", "young", "elderly"),
    ("deaf", "blind", "disabled"),
)
SWAPS = {w: tuple(o for o in line if o != w) for line in GROUPS for w in line}


MASK = (1 << BITS) - 1


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word."""
    found = [word, *(word[:k] + "-" for k in PREFIXES if len(word) > k)]
    return tuple(zlib.crc32(x.encode()) & MASK for x in found)


def at_share(feature, level: int):
    """The feature that a beginning has enough words for ``SHARES[level]``."""
    return (feature * 2654435761 + (level + 1) * 40503) & MASK


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> np.ndarray:
    base, counts = np.unique(np.fromiter((f for w in words for f in word_features(w)), np.int64), return_counts=True)
    more = [at_share(base[counts >= share * len(words)], level) for level, share in enumerate(SHARES)]
    return np.unique(np.concatenate([base, *more]))


def counterfactuals(words: set[str]) -> list[set[str]]:
    """The same words with each group name replaced: one variant for each place in the lines of ``GROUPS``."""
    named = [w for w in words if w in SWAPS]
    if not named:
        return []
    most = max(len(SWAPS[w]) for w in named)
    return [words - set(named) | {SWAPS[w][i % len(SWAPS[w])] for w in named} for i in range(most)]


@dataclass
class Model:
    weights: dict[int, float]
    intercept: float

    def score(self, words: set[str], known: dict[str, tuple[int, ...]]) -> float:
        """``known`` keeps the features of a word that have a weight, or whose shares have one."""
        weights = self.weights
        counts: Counter[int] = Counter()
        for w in words:
            useful = known.get(w)
            if useful is None:
                useful = tuple(f for f in word_features(w) if f in weights or any(at_share(f, i) in weights for i in range(len(SHARES))))
                if len(known) >= KEPT:
                    known.clear()
                known[w] = useful
            if useful:
                counts.update(useful)
        seen = set(counts)
        for f, n in counts.items():
            seen.update(at_share(f, i) for i, share in enumerate(SHARES) if n >= share * len(words))
        z = self.intercept + sum(weights[f] for f in sorted(seen & weights.keys()))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def sample_of(labelled: DataFrame, key: str, at_most: int = SAMPLE) -> DataFrame:
    """About ``at_most`` rows at most, chosen by the hash of the id, so that the choice does not depend on order or partitions."""
    n = labelled.count()
    if n <= at_most:
        return labelled
    share = F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000))
    return labelled.where(share < int(0.97e6 * at_most / n))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", at_most: int = SAMPLE) -> Model | None:
    """Model of the label. Features are made in tasks; those of the sample, a bounded number of rows, come to the driver."""
    wanted = sample_of(labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, label), key, at_most)
    rows = docs.select(key, text).join(wanted, key).select(key, label, text)

    lists, nested = pa.list_(pa.int32()), pa.list_(pa.list_(pa.list_(pa.int32())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(lo, ROWS_AT_ONCE)
                own, swapped = [], []
                for t in b.column(2):
                    words = words_of(t.as_py())
                    found = features_of(words)
                    own.append(found.astype(np.int32))
                    swapped.append([change(found, features_of(v)) for v in counterfactuals(words)])
                ends = pa.array(np.cumsum([0, *map(len, own)]), pa.int32())
                features = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(own)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1).cast(pa.int32()), features.cast(lists), pa.array(swapped, nested)], names=["id", "label", "own", "swapped"]
                )

    schema = f"id {dict(rows.dtypes)[key]}, label int, own array<int>, swapped array<array<array<int>>>"
    local = rows.mapInArrow(run, schema).toArrow()
    order = np.argsort(local.column("id").to_numpy(), kind="stable")
    labels_of = local.column("label").to_numpy()[order]
    own_column, swapped_column = local.column("own").combine_chunks(), local.column("swapped").combine_chunks()
    own = [own_column[int(i)].values.to_numpy() for i in order]
    swapped = [swapped_column[int(i)].as_py() for i in order]
    return fit_local(labels_of, own, swapped)


def change(found: np.ndarray, variant: np.ndarray) -> list[list[int]]:
    """The features that a counterfactual has besides those of its sentence, and those it lacks."""
    return [np.setdiff1d(variant, found).tolist(), np.setdiff1d(found, variant).tolist()]


def fit_local(labels: np.ndarray, own: list[np.ndarray], swapped: list[list[list[list[int]]]]) -> Model | None:
    """``own``: features of each sentence; ``swapped``: the ``change`` to each of its counterfactuals."""
    y = (np.asarray(labels) == 1).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    n1, n0 = y.sum(), (1 - y).sum()
    toxic, clean = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for found, label in zip(own, y, strict=True):
        (toxic if label else clean)[found] += 1
    total = toxic + clean
    gap = np.abs(toxic / n1 - clean / n0) / np.sqrt((total / len(y)) * (1 - total / len(y)) + 1e-4)
    gap[total < min(LEAST_TEXTS, max(1, len(y) // 50))] = 0
    best = np.argsort(-gap, kind="stable")[:FEATURES]
    best = best[gap[best] > 0]
    place = np.full(1 << BITS, -1)
    place[best] = np.arange(len(best))

    def columns(found: np.ndarray) -> np.ndarray:
        at = place[np.asarray(found, np.int64)] if len(found) else np.empty(0, np.int64)
        return at[at >= 0]

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        cols = [columns(r) for r in rows]
        return np.repeat(np.arange(len(rows)), [len(c) for c in cols]), np.concatenate(cols) if cols else np.empty(0, np.int64)

    row, col = matrix(own)
    # A counterfactual differs from its sentence in few features: those that come count +1, those that go -1.
    delta_row, delta_col, delta_sign, n_delta = [], [], [], 0
    for variants in swapped:
        for come, go in variants:
            for cols, sign in ((columns(come), 1.0), (columns(go), -1.0)):
                delta_row.append(np.full(len(cols), n_delta))
                delta_col.append(cols)
                delta_sign.append(np.full(len(cols), sign))
            n_delta += 1
    d_row, d_col, d_sign = (np.concatenate(x) if x else np.empty(0) for x in (delta_row, delta_col, delta_sign))
    d_row, d_col = d_row.astype(np.int64), d_col.astype(np.int64)

    weight = np.where(y == 1, TOXIC_WEIGHT, 1.0) / len(y)
    w, b = np.zeros(len(best)), float(np.log(n1 / n0))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = b + np.bincount(row, w[col], minlength=len(y))
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weight
        gradient = np.bincount(col, error[row], minlength=len(w)) + RIDGE * w
        if n_delta:
            change = np.bincount(d_row, d_sign * w[d_col], minlength=n_delta)
            gradient += COUNTERFACTUAL * 2 / n_delta * np.bincount(d_col, d_sign * change[d_row], minlength=len(w))
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.99 * vb + 0.01 * error.sum() ** 2
        rate = 0.1 * (1 - step / (STEPS + 1))
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        b -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-6)
    return Model({int(f): float(x) for f, x in zip(best, w, strict=True)}, float(b))


def top_features(model: Model, texts: list[str], k: int = 10) -> list[tuple[str, float]]:
    """The heaviest words of some texts, to look into a model."""
    weight = Counter({w: sum(model.weights.get(f, 0.0) for f in word_features(w)) for t in texts for w in words_of(t)})
    return weight.most_common(k)


def scored(model: Model | None, column: pa.Array, known: dict[str, tuple[int, ...]]) -> list[float]:
    return [0.0 if model is None else model.score(words_of(t.as_py()), known) for t in column]


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` (0 to 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scored(model, b.column(1), known), pa.float64())], names=["_key", "_score"])

    schema = f"_key {dict(docs.dtypes)[key]}, _score double"
    return docs.select(key, text).mapInArrow(run, schema).toDF(key, "score")


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", at_least: float = PREDICT_FROM) -> DataFrame:
    """The rows that score below ``at_least``, their columns unchanged. Only texts go to Python, and one bit of each comes back."""
    model = fit(docs, labels, key, text, label)

    def fine(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, tuple[int, ...]] = {}
        for column in columns:
            yield pa.array([x < at_least for x in scored(model, column, known)], pa.bool_())

    return docs.where(F.arrow_udf(fine, "boolean")(F.col(text)))
