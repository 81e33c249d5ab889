"""Byte-level BPE, encoding and decoding, with a segment tree over adjacent pair ranks.

A text is cut into pre-tokens, and each pre-token starts as its bytes. The leaves of a segment tree hold the rank of
each adjacent pair (none if the pair has no merge), each inner node the lower of its two. The root therefore
gives the leftmost pair of the lowest rank; merging it changes three leaves, each in logarithmic time. A pre-token of any
length, such as a text without blanks, is encoded in n log n steps.

New words of up to ``SHORT`` bytes are merged side by side, one tree per row of an array, each step for all words that can still
merge; longer ones one by one. Both take the same steps. Texts are cut and their words looked up a few million letters at
a time. Each task keeps about ``KEPT`` words it has encoded, in arrays, and ``LONG_KEPT`` bytes of long ones; this only saves time.

Null texts are encoded as empty ones. Empty texts give no ids and decode to the empty text. Other columns are not touched.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KEPT = 1_000_000
SHORT = 63  # bytes
ROWS_SIDE_BY_SIDE = 8192
PACKED = 23  # bytes of a word that fit into three integers beside its length
LONG_KEPT = 16 << 20  # bytes of words that are longer than PACKED
CHARS_AT_ONCE = 2_000_000
NO_MERGE = 1 << 62
POSITION_BITS = 32
POSITION_MASK = (1 << POSITION_BITS) - 1
PAIR_BITS = 20

LETTER, NUMBER, BLANK, OTHER, BORDER = range(5)
# Unicode's White_Space. Python's own \s has four control characters more.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, BLANK or OTHER of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
    out[[ord(c) for c in BLANKS]] = BLANK
    return out


def kinds_of(points: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Class of each code point of texts one after the other; there is a stand-in at each of ``borders``."""
    kind = classes()[points]
    kind[borders] = BORDER
    return kind


def run_starts(kind: np.ndarray) -> np.ndarray:
    start = np.ones(len(kind), bool)
    start[1:] = kind[1:] != kind[:-1]
    start[kind == BORDER] = True
    return start


def part_contractions(start: np.ndarray, points: np.ndarray, kind: np.ndarray) -> None:
    """Let 's 't 'm 'd 're 've 'll stand alone where a run starts with the quote."""
    quote = np.flatnonzero((points == 0x27) & start & (kind == OTHER))
    if not len(quote):
        return
    padded = np.concatenate([np.where(kind == BORDER, 0, points), np.zeros(3, points.dtype)])
    first, second = padded[quote + 1], padded[quote + 2]
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (first == ord(a)) & (second == ord(b))
    start[quote[one | two] + 1] = False
    for at in (quote[one] + 2, quote[two] + 3):
        start[at[at < len(start)]] = True


def pre_token_starts(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pre-tokens start.

    A pre-token is a run of letters, of numbers or of other signs, each with the one blank before it, or a contraction
    that no such run reaches, or a run of white space without the blank that goes to the next word.
    """
    start = run_starts(kind)
    following = np.append(kind[1:], BORDER)
    last_blank = np.flatnonzero((kind == BLANK) & (following != BLANK) & (following != BORDER))
    start[last_blank] = True
    start[last_blank[points[last_blank] == 0x20] + 1] = False
    part_contractions(start, points, kind)
    return start


def word_starts(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pre-tokens start if white space is dropped: runs of letters or other signs, single numbers, contractions."""
    start = run_starts(kind)
    start[kind == NUMBER] = True
    part_contractions(start, points, kind)
    return start


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in such vocabularies: itself if printable, else one above 255."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)}
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class Merger:
    """Merges one sequence of symbols by rank."""

    def __init__(self, ranks: dict[int, int], merged: list[int]):
        self.ranks = ranks
        self.merged = merged

    def encode(self, ids: list[int]) -> list[int]:
        n = len(ids)
        if n < 2:
            return ids
        ranks, merged = self.ranks, self.merged
        ids = ids[:]
        leaves = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [NO_MERGE] * (2 * leaves)
        for i in range(n - 1):
            rank = ranks.get(ids[i] << PAIR_BITS | ids[i + 1])
            if rank is not None:
                tree[leaves + i] = rank << POSITION_BITS | i
        for node in range(leaves - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        alive = [True] * n

        def put(i: int, key: int) -> None:
            node = leaves + i
            tree[node] = key
            while node > 1:
                other = tree[node ^ 1]
                if other < key:
                    key = other
                node >>= 1
                if tree[node] == key:
                    return
                tree[node] = key

        def pair_key(i: int, j: int) -> int:
            rank = ranks.get(ids[i] << PAIR_BITS | ids[j])
            return NO_MERGE if rank is None else rank << POSITION_BITS | i

        while (root := tree[1]) < NO_MERGE:
            i = root & POSITION_MASK
            j = after[i]
            ids[i] = merged[root >> POSITION_BITS]
            alive[j] = False
            k = after[j]
            after[i] = k
            if j < n - 1:
                put(j, NO_MERGE)
            if k < n:
                before[k] = i
                put(i, pair_key(i, k))
            else:
                put(i, NO_MERGE)
            h = before[i]
            if h >= 0:
                put(h, pair_key(h, i))
        return [x for x, lives in zip(ids, alive, strict=True) if lives]


def mixed(keys: np.ndarray) -> np.ndarray:
    """Keys whose low bits depend on all bits."""
    keys = keys * np.uint64(0x9E3779B97F4A7C15)
    return keys ^ keys >> np.uint64(32)


class Places:
    """A hash table of row numbers, with open addressing. It is told by its caller whether the row it found is the one looked for."""

    def __init__(self, size: int):
        self.slots = np.full(1 << max(10, (3 * size).bit_length()), -1, np.int32)

    def find(self, keys: np.ndarray, same: Callable[[np.ndarray | slice, np.ndarray], np.ndarray]) -> np.ndarray:
        """Row of each key, or -1. ``same(some, rows)``: whether those of the keys are the ones of these rows."""
        mask = np.uint64(len(self.slots) - 1)
        slot = (keys & mask).astype(np.int64)
        found = self.slots.take(slot)
        wrong = np.flatnonzero((found >= 0) & ~same(slice(None), found))
        while len(wrong):
            slot[wrong] = step = slot[wrong] + 1 & int(mask)
            found[wrong] = row = self.slots[step]
            wrong = wrong[(row >= 0) & ~same(wrong, row)]
        return found

    def put(self, keys: np.ndarray, rows: np.ndarray) -> None:
        """Add different rows; equal keys may repeat. Fewer rows than slots."""
        mask = len(self.slots) - 1
        slot = (keys & np.uint64(mask)).astype(np.int64)
        while len(rows):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = rows[free]
            left = self.slots[slot] != rows
            slot, rows = slot[left] + 1 & mask, rows[left]


class SideBySide:
    """The same merging for many short sequences at once."""

    def __init__(self, ranks: dict[int, int], merged: list[int], none: int):
        self.pairs = Places(len(ranks))
        self.keys = np.fromiter(ranks, np.int64, len(ranks))
        self.pairs.put(mixed(self.keys.astype(np.uint64)), np.arange(len(ranks), dtype=np.int32))
        self.rank = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.merged = np.array(merged, np.int32)
        self.none = none  # an id that no merge has

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << PAIR_BITS | right
        found = self.pairs.find(mixed(key.astype(np.uint64)), lambda some, place: self.keys[place] == key[some])
        return np.where(found >= 0, self.rank[found] << POSITION_BITS | at, NO_MERGE)

    def encode(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``symbols`` one after the other. Returns the merged ids one after the other, and how many each sequence has."""
        ends = np.cumsum(lengths)
        parts, count = [], np.empty(len(lengths), np.int64)
        leaves = 1 << int(lengths.max()).bit_length()
        for lo in range(0, len(lengths), ROWS_SIDE_BY_SIDE):
            some = lengths[lo : lo + ROWS_SIDE_BY_SIDE]
            last = ends[lo + len(some) - 1]
            ids, count[lo : lo + len(some)] = self._encode(symbols[ends[lo] - some[0] : last], some, leaves)
            parts.append(ids)
        return np.concatenate(parts), count

    def _encode(self, symbols: np.ndarray, lengths: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
        rows, width = len(lengths), leaves + 1
        starts = np.cumsum(lengths) - lengths
        put = ragged(np.arange(rows) * width, lengths)
        ids = np.full(rows * width, self.none, np.int32)
        ids[put] = symbols
        alive = np.zeros(rows * width, bool)
        alive[put] = True
        after = np.tile(np.minimum(np.arange(1, width + 1, dtype=np.int32), width - 1), rows)
        before = np.tile(np.arange(-1, width - 1, dtype=np.int32), rows)
        tree = np.full((rows, 2 * leaves), NO_MERGE, np.int64)
        flat = tree.reshape(-1)
        pair = np.ones(len(put), bool)
        pair[starts + lengths - 1] = False  # the last symbol of a row has none after it
        put = put[pair]
        row = put // width
        column = put - row * width
        flat[row * (2 * leaves) + leaves + column] = self._leaf(ids[put], ids[put + 1], column)
        size = leaves
        while size > 1:
            level = tree[:, size : 2 * size]
            size //= 2
            tree[:, size : 2 * size] = np.minimum(level[:, ::2], level[:, 1::2])
        active = np.arange(rows)
        while True:
            root = flat[active * (2 * leaves) + 1]
            going = root < NO_MERGE
            active, root = active[going], root[going]
            if not len(active):
                break
            cell, base = active * width, active * (2 * leaves)
            i = root & POSITION_MASK
            j = after[cell + i]
            k = after[cell + j]
            ids[cell + i] = new = self.merged[root >> POSITION_BITS]
            alive[cell + j] = False
            after[cell + i] = k
            before[cell + k] = i
            h = before[cell + i]
            has = np.flatnonzero(h >= 0)
            at = h[has]
            leaf = self._leaf(np.concatenate([new, ids[cell[has] + at]]), np.concatenate([ids[cell + k], new[has]]), np.concatenate([i, at]))
            first = np.concatenate([base, base[has], base])
            inner = np.concatenate([i, at, j]) + leaves
            flat[first + inner] = np.concatenate([leaf, np.full(len(j), NO_MERGE)])
            for _ in range(leaves.bit_length() - 1):
                inner >>= 1
                below = first + 2 * inner
                flat[first + inner] = np.minimum(flat[below], flat[below + 1])
        return ids[alive], np.add.reduce(alive.reshape(rows, width), axis=1, dtype=np.int64)


class Words:
    """Encoded words in arrays, found by their packed bytes, or by a dictionary if they are longer. The arrays have room to spare; the first ``size`` and ``n_ids`` entries count."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.size = self.n_ids = self.long_bytes = 0
        self.long: dict[bytes, int] = {}
        self.places = Places(0)
        self.keys = np.empty(1, np.uint64)
        self.packed = np.empty((1, 3), np.uint64)
        self.first = np.empty(1, np.int64)
        self.count = np.empty(1, np.int64)
        self.ids = np.empty(1, np.int32)

    def find(self, keys: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Place of each word, or -1."""

        def same(some: np.ndarray | slice, rows: np.ndarray) -> np.ndarray:
            equal = self.packed.take(rows, axis=0) == packed[some]
            return equal[:, 0] & equal[:, 1] & equal[:, 2]

        return self.places.find(keys, same)

    def add(self, keys: np.ndarray, packed: np.ndarray, ids: np.ndarray, count: np.ndarray) -> int:
        """Add words that are not there; their places are the one returned and those after it."""
        place, end = self.size, self.size + len(keys)
        self.keys, self.packed = with_room(self.keys, place, len(keys)), with_room(self.packed, place, len(keys))
        self.first, self.count = with_room(self.first, place, len(keys)), with_room(self.count, place, len(keys))
        self.keys[place:end], self.packed[place:end] = keys, packed
        self.first[place:end], self.count[place:end] = self.n_ids + np.cumsum(count) - count, count
        self.ids = with_room(self.ids, self.n_ids, len(ids))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.size, self.n_ids = end, self.n_ids + len(ids)
        unplaced = place
        if 2 * end > len(self.places.slots):
            self.places, unplaced = Places(end), 0
        self.places.put(self.keys[unplaced:end], np.arange(unplaced, end, dtype=np.int32))
        return place

    def add_long(self, words: list[bytes], ids: np.ndarray, count: np.ndarray) -> None:
        """The same for words of more than ``PACKED`` bytes. Their packed bytes have size 0, which none of the others has."""
        keys = np.array([hash(w) for w in words], np.int64).astype(np.uint64)
        place = self.add(keys, np.zeros((len(words), 3), np.uint64), ids, count)
        self.long.update(zip(words, range(place, self.size), strict=True))
        self.long_bytes += sum(map(len, words))


def with_room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or a longer one with its first ``used`` entries, that holds ``more`` after them."""
    if used + more <= len(array):
        return array
    out = np.empty((max(2 * used, used + more), *array.shape[1:]), array.dtype)
    out[:used] = array[:used]
    return out


def pack(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of words of up to ``PACKED`` bytes, and their number, in three integers. ``data`` has 24 bytes to spare."""
    at = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    out = np.empty((len(first), 3), np.uint64)
    for part in range(3):
        out[:, part] = at[first + 8 * part] & masks[np.clip(size - 8 * part, 0, 8)]
    out[:, 2] |= size.astype(np.uint64) << np.uint64(56)
    return out


def different(keys: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one of each word is, and which of these each word is."""
    _, example, which = np.unique(keys, return_index=True, return_inverse=True)
    if not (packed[example][which] == packed).all():  # two words with the same key
        _, example, which = np.unique(packed, axis=0, return_index=True, return_inverse=True)
    return example, which.ravel()


def ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (``count`` of them), for each entry, one after the other."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


class Vocabulary:
    """A byte-level BPE vocabulary in its JSON form. ``suffix`` marks the last letter of each word, if there is one."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE":
            raise ValueError(f"{path} is not a BPE vocabulary")
        vocab = model["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        suffix = model["end_of_word_suffix"] or ""
        self.of_byte = np.array([vocab[c] for c in letters], np.int32)
        self.of_last_byte = np.array([vocab[c + suffix] for c in letters], np.int32)
        ranks, merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ranks.setdefault(vocab[a] << PAIR_BITS | vocab[b], rank)
            merged.append(vocab[a + b])
        self.merger = Merger(ranks, merged)
        self.side_by_side = SideBySide(ranks, merged, (1 << PAIR_BITS) - 1)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take part of the text around them")
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token.removesuffix(suffix))
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.decimal = [str(i) for i in range(size)]
        self.words = Words()

    def _merge(self, data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as bytes, one after the other, and how many each has."""
        leaves = np.where(size <= SHORT, 1 << np.ceil(np.log2(size + 1)).astype(np.int64), 0)
        parts, count = [], np.zeros(len(size), np.int64)
        order = []
        for width in np.unique(leaves):
            some = np.flatnonzero(leaves == width)
            if width:
                symbols = self.of_byte[data[ragged(first[some], size[some])]]
                symbols[np.cumsum(size[some]) - 1] = self.of_last_byte[data[first[some] + size[some] - 1]]
                ids, count[some] = self.side_by_side.encode(symbols, size[some])
            else:
                each = []
                for w in some:
                    symbols = self.of_byte[data[first[w] : first[w] + size[w]]]
                    symbols[-1] = self.of_last_byte[data[first[w] + size[w] - 1]]
                    each.append(self.merger.encode(symbols.tolist()))
                ids, count[some] = np.array([i for x in each for i in x], np.int32), [len(x) for x in each]
            parts.append(ids)
            order.append(some)
        if not parts:
            return np.empty(0, np.int32), count
        order, ids = np.concatenate(order), np.concatenate(parts)
        sizes = count[order]
        begin = np.empty(len(order), np.int64)
        begin[order] = np.cumsum(sizes) - sizes
        return ids[ragged(begin, count)], count

    def _stream(self, joined: str, points: np.ndarray, borders: np.ndarray, start: np.ndarray, dropped: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and where those of each text end. Pre-tokens that start at a dropped letter are left out."""
        data = np.frombuffer(joined.encode() + bytes(24), np.uint8)
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(points))
        keep = ~dropped[starts]
        starts, ends = starts[keep], ends[keep]
        if len(data) - 24 == len(points):  # a byte for each letter
            first, size = starts, ends - starts
        else:
            widths = 1 + (points > 0x7F).view(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)
            offset = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
            first = offset[starts]
            size = offset[ends] - first
        count = np.zeros(len(first), np.int64)
        begin = np.zeros(len(first), np.int64)

        small = np.flatnonzero(size <= PACKED)
        packed = pack(data, first[small], size[small])
        odd = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
        keys = packed[:, 0] * odd[0] + packed[:, 1] * odd[1] + packed[:, 2] * odd[2]
        keys ^= keys >> np.uint64(29)
        words = self.words
        if words.long_bytes > LONG_KEPT:
            words.clear()
        place = words.find(keys, packed)
        new = np.flatnonzero(place < 0)
        example, which = different(keys[new], packed[new])
        if words.size and words.size + len(example) > KEPT:
            words.clear()
            new = np.arange(len(small))
            example, which = different(keys, packed)
        if len(new):
            example = new[example]
            ids, made = self._merge(data, first[small[example]], size[small[example]])
            place[new] = words.add(keys[example], packed[example], ids, made) + which
        begin[small], count[small] = words.first[place], words.count[place]
        large = np.flatnonzero(size > PACKED)
        if len(large):
            raw = data.tobytes()
            each = [raw[a : a + n] for a, n in zip(first[large].tolist(), size[large].tolist(), strict=True)]
            at = {w: i for w, i in zip(each, large.tolist(), strict=True) if w not in words.long}
            some = np.fromiter(at.values(), np.int64, len(at))
            words.add_long(list(at), *self._merge(data, first[some], size[some]))
            place = np.fromiter(map(words.long.__getitem__, each), np.int64, len(each))
            begin[large], count[large] = words.first[place], words.count[place]
        stream = words.ids[ragged(begin, count)]
        per_text = np.searchsorted(starts, borders)  # pre-tokens before the end of each text
        return stream, np.concatenate([[0], np.cumsum(count)])[per_text]


    def _parts(self, text: str) -> list[str]:
        """The text at added tokens: plain text at even places, an added token at odd ones."""
        if any(t in text for t in self.added):
            return self.at_added.split(text)
        return [text]

    def encode_all(self, texts: list[str | None]) -> Iterator[list[int] | bytes]:
        """Ids of each text, a few million letters at a time."""
        first = 0
        while first < len(texts):
            size, last = 0, first
            while last < len(texts) and (size < CHARS_AT_ONCE or last == first):
                size += len(texts[last] or "")
                last += 1
            split = [self._parts(t or "") for t in texts[first:last]]
            plain = self._texts([p for parts in split for p in parts[::2]])
            for parts in split:
                out = next(plain)
                for added in parts[1::2]:
                    out += self.special[added]
                    out += next(plain)
                yield out
            first = last


class Codec(Vocabulary):
    """Encoder and decoder that keep every byte of a text."""

    def __init__(self, path: str):
        super().__init__(path)
        spec = self.spec
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        self.special = {t: [i] for t, i in self.added.items()}

    def _texts(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each of some texts without added tokens."""
        joined = "\n".join(texts) + "\n"
        borders = np.cumsum([len(t) + 1 for t in texts]) - 1
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        kind = kinds_of(points, borders)
        stream, ends = self._stream(joined, points, borders, pre_token_starts(points, kind), kind == BORDER)
        begin = 0
        for end in ends.tolist():
            yield stream[begin:end].tolist()
            begin = end

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_all([text]))

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int] | None) -> str:
        return self.decode_bytes(ids or []).decode("utf-8", errors="replace")


class WordCodec(Vocabulary):
    """Encoder of a vocabulary with word ends: lower case, white space dropped. Ids come as bytes, four for each, low byte first."""

    def __init__(self, path: str):
        super().__init__(path)
        normalizers = [n["type"] for n in (self.spec["normalizer"] or {}).get("normalizers", [])]
        if normalizers != ["NFC", "Replace", "Lowercase"] or not self.spec["model"]["end_of_word_suffix"]:
            raise ValueError(f"{path} is not a lower-case vocabulary with word ends")
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in self.added.items()}

    def _texts(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each of some texts without added tokens."""
        joined = "\n".join([t.replace("\n", " ") for t in texts]) + "\n"
        # Such vocabularies lower letter by letter, without the sigma at a word's end.
        joined = unicodedata.normalize("NFC", joined).replace("\u03a3", "\u03c3").lower()
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        borders = np.flatnonzero(points == 0x0A)
        kind = kinds_of(points, borders)
        stream, ends = self._stream(joined, points, borders, word_starts(points, kind), (kind == BORDER) | (kind == BLANK))
        coded, begin = stream.astype("<u4").tobytes(), 0
        for end in (4 * ends).tolist():
            yield coded[begin:end]
            begin = end


@lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per process and vocabulary."""
    return Codec(path)


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``, an array of token ids, for each text."""
    schema = pa.schema([pa.field("key", pa.int64()), pa.field("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            ids = list(c.encode_all(b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(ids, schema.field(1).type)], schema=schema)

    return docs.select(key, text).mapInArrow(run, "key bigint, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text``, special tokens kept. Null ids give the empty text."""
    schema = pa.schema([pa.field("key", pa.int64()), pa.field("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            texts = [c.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(texts, pa.string())], schema=schema)

    return encoded.select(key, ids).mapInArrow(run, "key bigint, text string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the ids of each text and of the text decoded from those ids, without moving either out of the task.

    ``key, n_tokens, ids_sha256`` (of the decimal ids joined by commas) and ``decoded_sha256`` (of the decoded text in UTF-8).
    """
    fields = [("key", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary)
        for b in batches:
            counts, of_ids, of_text = [], [], []
            for ids in c.encode_all(b.column(1).to_pylist()):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            columns = [b.column(0).cast(pa.int64()), *(pa.array(x, f[1]) for x, f in zip((counts, of_ids, of_text), fields[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    out = docs.select(key, text).mapInArrow(run, "key bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
