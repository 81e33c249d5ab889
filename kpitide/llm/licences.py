"""Licence scan with a positional index of rare words.

Templates are short licence texts. The index holds, for each of their words, the templates and places where it stands. Document frequencies of
these words are counted over the whole table first. A file is looked up by its licence words, rarest first: each place
of a word in the file and each of its postings propose a start of a template, and the proposals of a template's rarest words are
intersected. At a start that remains, the template's key phrase must stand word by word, and enough of the other
words must be in place. Templates that are nothing but their key phrase are found at every place where it stands.

Words are runs of letters a to z, digits and letters beyond ASCII, with A to Z lowered. Null texts are scanned as empty ones: no words, no
labels, score 0. Other columns are not touched.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RAREST = 4  # words of a template that have to agree on its start
COVER = 0.8


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrase: str
    base: bool = False


# Licence texts and labels.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", base=True),
    Template("gpl", "general public license", "general public license", base=True),
    Template("reserved", "all rights reserved", "all rights reserved", base=True),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Template("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
)


@dataclass(frozen=True)
class Prepared:
    template: Template
    words: tuple[bytes, ...]
    key: tuple[bytes, ...]
    key_at: int
    rare: tuple[int, ...]  # places of the rarest words


class Index:
    """Postings of the templates' words, with document frequencies of the corpus."""

    def __init__(self, frequency: dict[bytes, int], documents: int, templates: tuple[Template, ...] = TEMPLATES):
        self.idf: dict[bytes, float] = {}
        self.prepared: list[Prepared] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t in templates:
            for w in t.text.encode().split():
                self.idf[w] = math.log((documents + 1) / (frequency.get(w, 0) + 1))
        for number, t in enumerate(templates):
            words, key = tuple(t.text.encode().split()), tuple(t.key_phrase.encode().split())
            key_at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
            rare = sorted(range(len(words)), key=lambda i: (-self.idf[words[i]], i))[:RAREST]
            self.prepared.append(Prepared(t, words, key, key_at, tuple(sorted(rare))))
            for i in rare:
                self.postings[words[i]].append((number, i))

    def scan(self, words: list[bytes]) -> tuple[dict[int, list[int]], dict[str, float]]:
        """Starts of the base templates (by place of the key phrase), and how well each label fits."""
        places: dict[bytes, list[int]] = {}
        for at, w in enumerate(words):
            if w in self.postings:
                places.setdefault(w, []).append(at)
        starts: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
        for w in sorted(places, key=lambda w: (-self.idf[w], w)):  # rarest first
            for number, offset in self.postings[w]:
                for at in places[w]:
                    if at >= offset:
                        starts[number][at - offset] += 1
        base: dict[int, list[int]] = {}
        fits: dict[str, float] = {}
        for number, votes in starts.items():
            p = self.prepared[number]
            need = len(p.rare) if p.template.base else max(1, math.ceil(COVER * len(p.rare)))
            for start, n in votes.items():
                at = start + p.key_at
                if n < need or tuple(words[at : at + len(p.key)]) != p.key:
                    continue
                cover = sum(a == b for a, b in zip(p.words, words[start : start + len(p.words)], strict=False)) / len(p.words)
                if cover >= COVER:
                    fits[p.template.label] = max(fits.get(p.template.label, 0.0), cover)
                    if p.template.base:
                        base.setdefault(number, []).append(start)
        return base, fits


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []


def frequencies(docs: DataFrame, text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> tuple[dict[bytes, int], int]:
    """How many texts have each template word, and how many texts there are. The driver gets one number per template word."""
    vocabulary = frozenset(w for t in templates for w in t.text.encode().split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        n = 0
        for b in batches:
            for t in b.column(0):
                n += 1
                for w in vocabulary.intersection(words_of(t.as_py())):
                    counts[w] += 1
        names = ["", *(w.decode() for w in counts)]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([n, *counts.values()], pa.int64())], names=["word", "n"])

    found = docs.select(text).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r["word"]: r["n"] for r in found.collect()}
    return {w.encode(): n for w, n in counts.items() if w}, counts.get("", 0)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    frequency, documents = frequencies(docs, text, templates)
    index = Index(frequency, documents, templates)
    kind = dict(docs.dtypes)[key]
    names = ["_key", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                words = words_of(t.as_py())
                base, fits = index.scan(words)
                places = [s for starts in base.values() for s in starts]
                of_base = sorted({index.prepared[n].template.label for n in base})
                rows.append((len(words), len(places), min(places, default=None), max(places, default=None), ",".join(of_base), ",".join(sorted(fits)), max(fits.values(), default=0.0)))
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, types, strict=True))], names=names)

    schema = f"_key {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("_key", key)
