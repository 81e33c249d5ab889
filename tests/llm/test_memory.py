"""What the operators' tasks hold in a Python worker."""

import tracemalloc

import numpy as np
import pyarrow as pa

from kpitide.llm import common, languages, near_duplicates

MB = 1 << 20


def test_a_worker_keeps_no_vector_of_every_run():
    languages.slots()
    of = languages.judge({"a": np.ones(languages.DIMENSIONS)})
    tracemalloc.start()
    langs, _ = of(pa.array(["some words of a text", None]))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert langs == ["a", languages.UNKNOWN] and held < 32 * MB  # the vectors of all runs are 62 MB


def test_bitmaps_are_compared_in_small_pieces():
    rng = np.random.default_rng(1)
    maps = [rng.bytes(1024) for _ in range(64)]
    x, y = rng.integers(0, 64, 40_000), rng.integers(0, 64, 40_000)
    tracemalloc.start()
    found = near_duplicates.differing(maps, x, y)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    bits = np.unpackbits(np.frombuffer(b"".join(maps), np.uint8).reshape(64, -1), axis=1)
    assert (found[:200] == (bits[x[:200]] != bits[y[:200]]).sum(axis=1)).all() and peak < 24 * MB


def test_released_passes_all_on():
    assert list(common.released(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3] and not list(common.released(iter)(iter([])))
