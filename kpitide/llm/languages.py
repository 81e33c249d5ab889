"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A run of three letters is bound into one vector: the product of its letters' vectors,
each shifted by its place. The bundle (sum) of a text's runs is its profile, and the bundle of all texts of a
language that language's prototype. A text gets the language whose prototype has the largest cosine with its profile.

Binding is a function of the run alone, so a text is counted run by run first and each different run is bound once per group of texts.
Letters other than a to z share the remaining slots by a hash; what stands between words is one slot of its own.

Rows whose language is null are not learned from. A null text, or one without a letter, is ``und`` with score 0. Between equally near
languages the first in alphabetical order wins. If nothing could be learned, every text is ``und``. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 40
DIMENSIONS = 1024
SEED = 20240
TEXTS_AT_ONCE = 96
RUNS_AT_ONCE = 2048
UNKNOWN = "und"
REJECT_AT = 0.0
RUNS = SLOTS**3


@lru_cache(maxsize=1)
def slots() -> np.ndarray:
    """Slot of each code point: 0 for what is no letter, 1 to 26 for a to z, the others by a hash."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = 27 + (c * 2654435761 >> 12) % (SLOTS - 27)
    for i in range(26):
        out[ord("a") + i] = i + 1
    return out


@lru_cache(maxsize=1)
def letter_vectors() -> np.ndarray:
    """The vectors of a slot as the first, second and third of a run."""
    letters = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (SLOTS, DIMENSIONS))
    return np.stack([np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters])


def bound_runs(runs: np.ndarray) -> np.ndarray:
    """The vectors of runs of three slots."""
    first, second, third = letter_vectors()
    return first[runs // SLOTS**2] * second[runs // SLOTS % SLOTS] * third[runs % SLOTS]


def run_counts(text: str | None) -> np.ndarray | None:
    """How often each run of three occurs; None if the text has no letter."""
    if not text:
        return None
    found = slots()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    found = found[np.append(True, (found[1:] != 0) | (found[:-1] != 0))]  # one slot between words, however wide the gap
    if not found.any():
        return None
    found = np.concatenate([[0], found, [0]]).astype(np.int32)
    return np.bincount((found[:-2] * SLOTS + found[1:-1]) * SLOTS + found[2:], minlength=RUNS)


def bundled(counts: np.ndarray, kind: type) -> np.ndarray:
    """The bundles of rows of run counts. The runs go in blocks, as their vectors take much more room than their table when they are no bytes."""
    used = np.flatnonzero(counts.any(axis=0))
    out = np.zeros((len(counts), DIMENSIONS), kind)
    for lo in range(0, len(used), RUNS_AT_ONCE):
        some = used[lo : lo + RUNS_AT_ONCE]
        out += counts[:, some].astype(kind) @ bound_runs(some).astype(kind)
    return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each language. A task adds up the runs of its texts; the driver gets one vector per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for t, of in zip(b.column(0), b.column(1), strict=True):
                found = run_counts(t.as_py())
                if found is not None:
                    name = of.as_py()
                    counts[name] = found if name not in counts else counts[name] + found
        names, bundles = [], []
        for name, found in counts.items():
            names.append(name)
            bundles.append(bundled(found[None, :], np.float64)[0].astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bundles, pa.list_(pa.int64()))], names=["lang", "bundle"])

    bundles = docs.where(F.col(lang).isNotNull()).select(text, lang).mapInArrow(run, "lang string, bundle array<bigint>")
    summed = bundles.select("lang", F.posexplode("bundle").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for row in summed.collect():  # DIMENSIONS numbers per language
        out.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["i"]] = row["x"]
    return dict(sorted(out.items()))


def judge(prototypes: dict[str, np.ndarray]) -> Callable[[pa.Array], tuple[list[str], list[float]]]:
    """A function from texts to their languages and scores."""
    names = list(prototypes)
    matrix = np.array([v / (np.linalg.norm(v) or 1.0) for v in prototypes.values()]).reshape(len(names), DIMENSIONS)

    def of(column: pa.Array) -> tuple[list[str], list[float]]:
        counts = np.zeros((TEXTS_AT_ONCE, RUNS), np.float32)
        langs, scores = [], []
        for lo in range(0, len(column), TEXTS_AT_ONCE):
            texts = column.slice(lo, TEXTS_AT_ONCE).to_pylist()
            there = np.zeros(len(texts), bool)
            for i, t in enumerate(texts):
                found = run_counts(t)
                there[i] = found is not None
                counts[i] = 0 if found is None else found
            profiles = bundled(counts[: len(texts)], np.float32)
            norms = np.linalg.norm(profiles, axis=1)
            cosines = (profiles / np.where(norms > 0, norms, 1.0)[:, None]).astype(float) @ matrix.T
            for i in range(len(texts)):
                if there[i] and names:
                    best = int(np.argmax(cosines[i]))
                    langs.append(names[best])
                    scores.append(float(min(max(cosines[i, best], 0.0), 1.0)))
                else:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
        return langs, scores

    return of


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score`` (the cosine, at least 0)."""
    of = judge(prototypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = of(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["_key", "_lang", "_score"])

    schema = f"_key {dict(docs.dtypes)[key]}, _lang string, _score double"
    return docs.select(key, text).mapInArrow(run, schema).toDF(key, "lang_pred", "score")


def accepted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", reject_at: float = REJECT_AT) -> DataFrame:
    """The rows whose text is near one of the languages of the table itself, their columns unchanged. All rows if no language could be learned.

    Only texts go to Python, and one bit of each comes back.
    """
    prototypes = learn(docs, text, lang)
    if not prototypes:
        return docs
    of = judge(prototypes)

    def near(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([name != UNKNOWN and x > reject_at for name, x in zip(*of(column), strict=True)], pa.bool_())

    return docs.where(F.arrow_udf(near, "boolean")(F.col(text)))
