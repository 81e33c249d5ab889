"""Removal of passages that other documents have too, by hashed runs of sentences.

A text is cut into sentences at line ends and after ``. ! ?``. Every run of at least two consecutive sentences is compared, however short (``RUN_WORDS``
is 0). Only the pairs of neighbours are hashed: where a longer run is repeated, so are its pairs, and they cover the same sentences. A sentence
of ``LONG_WORDS`` words is a run by itself, as it is about as long as a passage; the sentences around it may be cut off. Runs are joined over all
documents; of each run the first place stays (smallest id, then first in the text). White space does not count in the comparison.

What other places cover is decided by whole spans: runs that share a sentence are one span, and a span of ``SPAN_WORDS`` words or more is removed. Shorter
spans are stock phrases, which stay: over 10,000 documents spans of 9 words alone are a quarter of all, and from 15 words on hardly any document
comes in with a lower floor (1,738 documents lose text with 15, 1,685 with 20, 1,869 with 12, 4,153 with none).

A passage that begins and ends in the middle of sentences is found by the whole sentences in it, if there are two. A
document repeats a run at most once in the shuffle: further places in the same text are known without it. Documents are
counted per run by partial sums, so a run that a third of the documents have is no large group anywhere.

Null and empty texts, and texts without a run, stay as they are. A text may be left empty; its row stays. Ids must be unique; a row
with a null id is not compared. Other columns stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpitide.llm.common import released, written

RUN_WORDS = 0  # words that a run of several sentences must have: with more, what is left of a passage in foreign text would stay
LONG_WORDS = 40
SPAN_WORDS = 15
TEXTS_AT_ONCE = 500
BREAK = re.compile(r"(?<=[.!?])\s+|\n\s*")


def sentences(text: str) -> list[str]:
    """Sentences with the white space after them; together they are the text."""
    out, begin = [], 0
    for m in BREAK.finditer(text):
        if m.end() > begin:
            out.append(text[begin : m.end()])
            begin = m.end()
    if begin < len(text):
        out.append(text[begin:])
    return out


def runs(parts: list[str]) -> list[tuple[int, int, str]]:
    """(first sentence, number of sentences, text) of each run, in order."""
    bare = [" ".join(words) for words in map(str.split, parts)]
    sizes = [b.count(" ") + 1 if b else 0 for b in bare]
    n, found = len(parts), set()
    total, end = 0, 0
    for i in range(n):  # words of sentences i up to end
        while end < n and (total < RUN_WORDS or end - i < 2):
            total += sizes[end]
            end += 1
        if sizes[i] >= LONG_WORDS:
            found.add((i, 1))
        elif total >= RUN_WORDS and end - i >= 2:
            found.add((i, end - i))
        total -= sizes[i]
    total, begin = 0, n
    for j in range(n - 1, -1, -1):  # words of sentences begin up to j
        while begin > 0 and (total < RUN_WORDS or j - begin < 1):
            begin -= 1
            total += sizes[begin]
        if sizes[j] < LONG_WORDS and total >= RUN_WORDS and j - begin >= 1:
            found.add((begin, j - begin + 1))
        total -= sizes[j]
    return [(i, k, "\x1f".join(bare[i : i + k])) for i, k in sorted(found) if sizes[i]]  # white space before the first sentence is none


def long_spans(parts: list[str], covered: Iterable[tuple[int, int]]) -> set[int]:
    """The sentences to go: of covered runs, (first sentence, number of sentences), those that make up a span that is long enough."""
    gone: set[int] = set()
    begin = end = 0

    def close() -> None:
        if sum(len(parts[i].split()) for i in range(begin, end)) >= SPAN_WORDS:
            gone.update(range(begin, end))

    for first, size in sorted(covered):
        if first < end:
            end = max(end, first + size)
        else:
            close()
            begin, end = first, first + size
    close()
    return gone


def run_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, h, c, first, size, again``: hash of each run of each text. ``again``: the text had it before."""

    @released
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "h", "c", "first", "size", "again"]
        types = [None, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
        for b in (some.slice(lo, TEXTS_AT_ONCE) for some in batches for lo in range(0, some.num_rows, TEXTS_AT_ONCE)):
            place, columns = [], [[] for _ in range(5)]
            for row, t in enumerate(b.column(1)):
                seen: set[bytes] = set()
                for first, size, run in runs(sentences(t.as_py() or "")):
                    digest = xxhash.xxh3_128_digest(run.encode())
                    values = (int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:12], "big", signed=True), first, size, digest in seen)
                    seen.add(digest)
                    place.append(row)
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
            ids = b.column(0).take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, types[1:], strict=True))], names=names)

    kind = dict(docs.dtypes)[key]
    there = docs.where(F.col(key).isNotNull()).select(key, text)
    return there.mapInArrow(work, f"id {kind}, h bigint, c int, first int, size int, again boolean")


def covered(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, spans``: the runs to be removed from each document that has any, as (first sentence, number of sentences)."""
    found = written(run_table(docs, key, text), "passage-runs")
    once = found.where(~F.col("again"))
    firsts = once.groupBy("h", "c").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    repeated = firsts.where(F.col("n") > 1).select("h", "c", "first_id").hint("shuffle_hash")
    elsewhere = once.join(repeated, ["h", "c"]).where(F.col("id") != F.col("first_id"))
    spans = elsewhere.select("id", "first", "size").unionByName(found.where("again").select("id", "first", "size"))
    return spans.groupBy("id").agg(F.collect_set(F.struct("first", "size")).alias("spans"))


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with long enough covered spans cut out of their texts, and ``n_sentences`` and ``n_removed`` at the end."""
    spans = covered(docs, key, text)
    others = [c for c in docs.columns if c not in (key, text)]
    inner = [f"_{i}" for i in range(len(others))]
    rows = docs.select(key, text, *others).toDF("_key", "_text", *inner)
    joined = rows.join(spans, rows["_key"] == spans["id"], "left").select("_key", "_text", "spans", *inner)

    @released
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_key", "_text", *inner, "_n", "_removed"]
        for b in batches:
            texts, counts, removed = [], [], []
            for t, gone in zip(b.column(1), b.column(2), strict=True):
                t, gone = t.as_py(), gone.as_py()
                parts = sentences(t or "")
                drop = long_spans(parts, ((s["first"], s["size"]) for s in gone or ()))
                texts.append("".join(p for i, p in enumerate(parts) if i not in drop) if drop else t)
                counts.append(len(parts))
                removed.append(len(drop))
            made = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), *b.columns[3:], *made], names=names)

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in ("_key", "_text", *inner)] + ["_n bigint", "_removed bigint"])
    out = joined.mapInArrow(work, schema).toDF(key, text, *others, "n_sentences", "n_removed")
    return out.select(*docs.columns, "n_sentences", "n_removed")
