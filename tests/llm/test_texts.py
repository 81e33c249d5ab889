"""Language profiles, BPE, toxicity, licences, passages and packing."""

import hashlib
import itertools
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kpitide.llm import bpe, languages, licences, packing, passages, toxicity
from tests.llm import edge

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SIGNS = list("ab'stlvedrmΣς  \n\t\x0b\x1c\x85\xa0 é١½Ⅷ中字\U0001f600́İ!?-_0129 <|>") + ["<|endoftext|>", "<|startoftext|>", "'ll", "'re", "\r\n", "   "]


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def odd_texts(n):
    random.seed(4)
    return ["".join(random.choice(SIGNS) for _ in range(random.randint(0, 40))) for _ in range(n)] + ["ab" * 3000, "z" * 200]


def test_bpe_equals_the_library():
    codec, other = bpe.Codec(BYTES), library(BYTES)
    texts = odd_texts(3000)
    for text, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert ids == other.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text
    assert codec.decode([255, 254]) == other.decode([255, 254], skip_special_tokens=False)


def test_one_tree_and_many_side_by_side_agree():
    codec = bpe.Codec(BYTES)
    for word in ("a", "ab", "aaaaaaa", "hello", "internationalization", "xyzxyzxyz"):
        alone = codec.merger.encode(codec.of_byte[np.frombuffer(word.encode(), np.uint8)].tolist())
        together, count = codec.side_by_side.encode(codec.of_byte[np.frombuffer(word.encode(), np.uint8)], np.array([len(word)]))
        assert alone == together.tolist() and count[0] == len(alone)


def test_word_codec_equals_the_library():
    codec, other = bpe.WordCodec(WORDS), library(WORDS)
    texts = odd_texts(3000)
    for text, ids in zip(texts, codec.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def test_bpe_tables(spark):
    docs = edge.docs(spark)
    encoded = bpe.encode(docs, BYTES)
    decoded = {r.doc_id: r.text for r in bpe.decode(encoded, BYTES).collect()}
    assert decoded == {r[0]: r[1] or "" for r in edge.rows()}
    for r in bpe.round_trip(docs, BYTES).collect():
        assert r.decoded_sha256 == hashlib.sha256(decoded[r.doc_id].encode()).hexdigest()
    assert bpe.round_trip(edge.empty(spark), BYTES).count() == 0


def test_languages(spark):
    text = {"aa": "bako tami kolo", "bb": "zrix qwez xwyz"}
    train = [(i, text[k] * 3, k) for i in range(20) for k in text]
    docs = spark.createDataFrame(train, "doc_id bigint, text string, lang string")
    prototypes = languages.learn(docs)
    asked = spark.createDataFrame([(1, "tami bako"), (2, "qwez zrix"), (3, None), (4, "12 !")], "doc_id bigint, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in languages.predict(asked, prototypes).collect()}
    assert found[1][0] == "aa" and found[2][0] == "bb" and found[3] == found[4] == ("und", 0.0)
    # By hand: bind, bundle and compare without counting first.
    letters = np.random.default_rng(languages.SEED).choice(np.array([-1, 1], np.int8), (languages.SLOTS, languages.DIMENSIONS)).astype(int)

    def profile(t):
        slots = [0, *(languages.slots()[ord(c)] for c in t), 0]
        return sum(np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[c] for a, b, c in zip(slots, slots[1:], slots[2:], strict=False))

    mine = profile("tami bako")
    for name, prototype in prototypes.items():
        assert np.allclose(prototype, 20 * profile(text[name] * 3))
    best = max(mine @ p / np.linalg.norm(mine) / np.linalg.norm(p) for p in prototypes.values())
    assert found[1][1] == pytest.approx(best, abs=1e-5)
    assert languages.learn(edge.empty(spark)) == {}
    assert languages.accepted(edge.docs(spark)).columns == edge.docs(spark).columns
    kept = {r.doc_id for r in languages.accepted(edge.docs(spark)).collect()}
    assert kept >= {4, 7} and not kept & {0, 1, 2, 8}  # no letter, no language
    assert {r.lang_pred for r in languages.predict(edge.docs(spark), {}).collect()} == {"und"}


def test_toxicity(spark):
    random.seed(2)
    words = [f"wort{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = random.choices(words, k=20) + (["vileword" if i % 8 else "grimly" + random.choice("abc")] if bad else [])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad), 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame([*labels, (9999, 1, 0), (1, None, 0), (None, 1, 1)], "doc_id bigint, toxic int, quality int")
    model = toxicity.fit(docs, table)
    asked = spark.createDataFrame([(1, "wort1 wort2 vileword"), (2, "wort3 wort5 wort9"), (3, None), (4, "")], "doc_id bigint, text string")
    score = {r.doc_id: r.score for r in toxicity.score(asked, model).collect()}
    assert score[1] > 0.7 > 0.5 > score[2] and score[3] == score[4]
    assert toxicity.fit(docs, table.limit(0)) is None
    assert {r.score for r in toxicity.score(edge.docs(spark), None).collect()} == {0.0}
    kept = toxicity.accepted(edge.docs(spark), table)
    assert kept.columns == edge.docs(spark).columns and kept.count() == len(edge.rows())


def test_counterfactuals_take_weight_off_group_names():
    random.seed(3)
    own, labels, swapped = [], [], []
    for i in range(600):
        bad = i % 3 == 0
        words = set(random.choices([f"w{k}" for k in range(40)], k=8))
        if bad:
            words |= {"nasty"} if random.random() < 0.7 else set()
            words |= {"muslim"} if random.random() < 0.6 else set()  # a bias of the data
        elif random.random() < 0.02:
            words |= {"muslim"}
        own.append(toxicity.features_of(words))
        labels.append(int(bad))
        swapped.append([toxicity.change(own[-1], toxicity.features_of(v)) for v in toxicity.counterfactuals(words)])
    plain = toxicity.fit_local(np.array(labels), own, [[] for _ in own])
    fair = toxicity.fit_local(np.array(labels), own, swapped)
    neutral = {"w1", "w2", "muslim"}
    assert fair.score(neutral, {}) < plain.score(neutral, {})
    assert fair.score({"w1", "nasty"}, {}) > 0.7


def test_licences(spark):
    rows = [
        (1, "Licensed under CC BY-NC 4.0. cc by"), (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, None), (4, "general public all rights license reserved"), (5, "ALL RIGHTS RESERVED. All Rights Reserved"), (6, "Licensed under the Apache License, Version 2.0."),
    ]
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (found[1].n_base, found[1].first_word, found[1].last_word, found[1].labels) == (2, 2, 7, "cc-by,cc-by-nc")
    assert (found[2].base_labels, found[2].labels, found[2].first_word) == ("gpl", "gpl,gpl-3", 7)
    assert (found[3].n_words, found[3].labels, found[3].score, found[3].first_word) == (0, "", 0.0, None)
    assert (found[4].n_base, found[4].base_labels) == (0, "")
    assert (found[5].n_base, found[5].first_word, found[5].last_word) == (2, 0, 3)
    assert found[6].labels == "apache-2.0" and found[6].n_base == 0 and 0 < found[6].score <= 1
    assert licences.scan(edge.docs(spark)).count() == len(edge.rows()) and licences.scan(edge.empty(spark)).count() == 0


def test_no_language_learned_keeps_all(spark):
    rows = [(1, "some words here", None), (2, None, None), (3, "12 34", None), (4, "andere Worte", None)]
    kept = languages.accepted(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert sorted((r.doc_id, r.text, r.lang) for r in kept.collect()) == rows


def plain_removal(rows):
    """Remove covered sentences with plain dictionaries."""
    of_run = defaultdict(list)
    for doc, text in sorted(rows, key=lambda r: r[0]):
        parts = passages.sentences(text or "")
        bare = [" ".join(p.split()) for p in parts]
        size = [len(b.split()) for b in bare]
        spans = set()
        for i in range(len(parts)):
            if size[i] >= passages.LONG_WORDS:
                spans.add((i, 1))
                continue
            for k in range(2, len(parts) - i + 1):
                if sum(size[i : i + k]) >= passages.RUN_WORDS:
                    spans.add((i, k))
                    break
            for k in range(2, i + 2):
                if sum(size[i - k + 1 : i + 1]) >= passages.RUN_WORDS:
                    spans.add((i - k + 1, k))
                    break
        for i, k in sorted(spans):
            of_run[tuple(bare[i : i + k])].append((doc, i, k))
    joined = defaultdict(lambda: defaultdict(set))  # of a document, sentences that a covered run joins to others
    for places in of_run.values():
        for doc, i, k in sorted(places)[1:]:
            for x in range(i, i + k):
                joined[doc][x].update(range(i, i + k))
    gone = defaultdict(set)
    for doc, text in rows:
        words = [len(p.split()) for p in passages.sentences(text or "")]
        for x in joined[doc]:
            span, grown = {x}, True
            while grown:
                more = set().union(*(joined[doc][y] for y in span))
                grown, span = more != span, more
            if sum(words[y] for y in span) >= passages.SPAN_WORDS:
                gone[doc] |= span
    return {doc: "".join(p for i, p in enumerate(passages.sentences(text or "")) if i not in gone[doc]) for doc, text in rows}


def test_passages_equal_plain_removal(spark):
    random.seed(5)

    def sentence():
        return " ".join(random.choice("abcdefgh") + str(random.randrange(50)) for _ in range(random.choice([1, 3, 8, 15, 45]))) + random.choice([". ", "! ", "\n"])

    shared = ["".join(sentence() for _ in range(5)) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [sentence() for _ in range(random.randrange(8))]
        for _ in range(random.choice([0, 0, 1, 2])):
            parts.insert(random.randrange(len(parts) + 1), random.choice(shared))
        rows.append((i, "".join(parts)))
    rows += [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r.text or "" for r in passages.remove(docs).collect()}
    assert found == plain_removal(rows)
    for text in (r[1] or "" for r in rows):
        assert "".join(passages.sentences(text)) == text
    out = passages.remove(edge.docs(spark))
    assert out.columns == [*edge.docs(spark).columns, "n_sentences", "n_removed"] and out.count() == len(edge.rows())
    assert passages.remove(edge.empty(spark)).count() == 0


def test_passages_that_stand_in_mid_sentence(spark):
    first = " ".join(f"a{k}" for k in range(31)) + ". "
    middle, last = "B0 b1 b2 b3 b4 b5. ", " ".join(f"c{k}" for k in range(16)) + "."
    passage = first + middle + last  # 53 words; within foreign sentences the last two sentences have 22
    rows = [(1, "Own one. " + passage + " Own two."), (2, "Foreign words go on " + passage + " Other end."), (3, "More of it " + passage + " The third."), (4, "\n\nShort it is."), (5, "\n\nShort it is.")]
    rows += [(6, "Not yet. Yes now. And then."), (7, "So far. Yes now. And then. Or so.")]
    three = "One two three four five six. Seven eight nine ten eleven. Twelve thirteen fourteen fifteen."
    rows += [(8, "Begin here. " + three + " End."), (9, "Other start. " + three + " Stop."), (10, "Gg. Gg."), (11, "Gg. Gg.")]
    found = {r.doc_id: (r.text, r.n_removed) for r in passages.remove(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1] == (rows[0][1], 0)
    assert found[2] == ("Foreign words go on " + first + "Other end.", 2)
    assert found[3] == ("More of it " + first + "The third.", 2)
    assert found[4] == found[5] == ("\n\nShort it is.", 0)
    assert found[6][1] == 0 and found[7] == (rows[6][1], 0)  # stock phrases stay
    assert found[8][1] == 0 and found[9] == ("Other start. Stop.", 3)  # each pair is short, the span is not
    assert found[10] == found[11] == ("Gg. Gg.", 0)


def test_words_made_of_few_parts_are_kept_as_those_parts():
    """Signs beside a word do not make it a new one: 90,000 different words between blanks, 301 different parts."""
    codec, other = bpe.WordCodec(WORDS), library(WORDS)
    parts = ["".join(p) for p in itertools.islice(itertools.product("abcdefg", repeat=3), 300)]
    texts = [" ".join(f"{a}-{b}" for b in parts) for a in parts]
    list(codec.encode_all(texts[:1]))
    tracemalloc.start()
    try:
        before, _ = tracemalloc.get_traced_memory()
        coded = [hashlib.sha256(ids).digest() for ids in codec.encode_all(texts)]
        after, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert after - before < 1 << 20
    assert coded == [hashlib.sha256(np.array(other.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).digest() for t in texts]


@pytest.mark.parametrize("limits", [{"KEPT": 40}, {"LONG_KEPT": 60}, {"CHARS_AT_ONCE": 1}, {"ROWS_SIDE_BY_SIDE": 3}])
def test_kept_words_that_are_dropped_change_nothing(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(bpe, name, value)
    words = ["unbelievably", "\u043f\u0440\u0435\u0434\u043f\u0440\u0438\u043d\u0438\u043c\u0430\u0442\u0435\u043b\u044c", "x" * 23, "x" * 24, "y" * 29, "z" * 70, "\u03a3\u03a3\n", "a\u0301", "\x1c"]
    random.seed(8)
    texts = odd_texts(60) + [" ".join(random.choice([*words, *SIGNS]) for _ in range(30)) for _ in range(60)]
    byte, word = bpe.Codec(BYTES), bpe.WordCodec(WORDS)
    bytes_library, words_library = library(BYTES), library(WORDS)
    for _ in range(2):
        for lo in range(0, len(texts), 7):
            some = texts[lo : lo + 7]
            assert list(byte.encode_all(some)) == [e.ids for e in bytes_library.encode_batch(some, add_special_tokens=False)]
            found = [np.frombuffer(ids, "<u4").tolist() for ids in word.encode_all(some)]
            assert found == [e.ids for e in words_library.encode_batch(some, add_special_tokens=False)]


def test_places_of_equal_keys():
    places, names = bpe.Places(10), np.arange(400)
    keys = np.repeat(np.uint64(7), 400)
    places.put(keys[:300], np.arange(300, dtype=np.int32))
    found = places.find(keys, lambda some, rows: (names[rows] == names[some]))
    assert found.tolist() == [*range(300), *[-1] * 100]


def check_packing(pieces, texts, window, end_id=1):
    other = library(WORDS)
    expected = Counter()
    for doc, text in texts:
        expected[(doc, tuple([*(other.encode(text, add_special_tokens=False).ids if text else []), end_id]))] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, some in by_doc.items():
        whole = [ids for (d, ids), n in expected.items() if d == doc for _ in range(n)]
        assert sum(r.length for r in some) == sum(map(len, whole))
        if len(whole) == 1:
            at = 0
            for r in sorted(some, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(whole[0])
                assert np.frombuffer(r.ids, "<u4").tolist() == list(whole[0][at : at + r.length])
                at += r.length
            assert at == len(whole[0])
    for some in by_sequence.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= window
    assert set(by_doc) == {doc for doc, _ in texts}
    return sum(r.length for r in pieces) / (len(by_sequence) * window)


def test_packing(spark):
    random.seed(6)
    texts = [(i, " ".join(random.choice(["cat", "dog's", "unbelievably", "42"]) for _ in range(random.choice([0, 1, 5, 30, 90, 200])))) for i in range(600)]
    texts += [(1000 + i, "cat dog cat") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(7)
    pieces = packing.pack(docs, WORDS, window=64).collect()
    assert check_packing(pieces, texts, 64) > 0.99
    assert check_packing(packing.pack(edge.docs(spark), WORDS).collect(), [(r[0], r[1]) for r in edge.rows()], packing.WINDOW) > 0.8
    assert packing.pack(edge.empty(spark), WORDS).count() == 0


def test_combinations_are_used_as_least_squares_says():
    counts = np.zeros(64, np.int64)
    counts[[20, 44, 10, 27]] = [100, 60, 80, 40]  # 20+44, 27+27+10, 44+10+10, ...
    shapes = packing.combinations(counts)
    assert all(sum(s) == 64 for s in shapes)
    x = packing.solve(counts, shapes)
    assert (x >= 0).all()
    times = packing.rounded(counts, shapes, x)
    used = np.zeros(64, np.int64)
    for s, n in zip(shapes, times, strict=True):
        for length in s:
            used[length] += n
    assert (used <= counts).all()
    plan = packing.Plan(counts)
    assert sorted(plan.place(20, i)[0][:2] for i in range(100)) == sorted({plan.place(20, i)[0][:2] for i in range(100)})


