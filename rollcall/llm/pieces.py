"""Texts cut into the pieces that a byte-level BPE tokenizer encodes one by one, and tables of pieces.

Both public vocabularies in use cut a text into contractions, runs of letters, numbers and runs of other characters
before they merge bytes, so a piece's ids never depend on its neighbours. Texts are cut here with numpy over
slices of a few megabytes; classes of characters are asked of the tokenizer itself, so they are its own at any Unicode
version. Python sees a piece only when no table knows it.

A long text is cut where a letter is followed by one space and a letter: no rule of either vocabulary looks across
such a place, so memory does not grow with the text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from rollcall.llm.wordnum import SLICE_BYTES, U64, mix64, text_bytes

#: Classes of characters.
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 255

# Ranges of code points whose class the tokenizer is asked for, and ranges that hold letters only.
_ASKED = ((0, 0x3400), (0xF900, 0x10000), (0x1F000, 0x1FB00))
_ALL_LETTERS = ((0x3400, 0x4DB6), (0x4E00, 0x9FF0), (0xAC00, 0xD7A4))

#: Code points below this have a class; texts with others, or with unknown ones, go through the tokenizer whole.
CLASSED = 0x1FB00

#: Bytes of a piece that fit into a key; longer pieces are kept by their bytes.
KEY_BYTES = 15

_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)

_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[ord("a") : ord("z") + 1] = True
_ASCII_LETTER[ord("A") : ord("Z") + 1] = True

# The letters after an apostrophe that both vocabularies split off with it.
_CONTRACTIONS_1 = [ord(c) for c in "stmd"]
_CONTRACTIONS_2 = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


def char_classes(pre_tokenizer) -> np.ndarray:
    """The class of code points, found by how the tokenizer cuts probes of two characters."""
    points = [c for begin, end in _ASKED for c in range(begin, end)]
    classes = np.full(CLASSED, UNKNOWN, np.uint8)
    classes[points] = SPACE
    for begin, end in _ALL_LETTERS:
        classes[begin:end] = LETTER
    for first, kind in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
        probe = "".join(f"{first}{chr(c)}\n" for c in points)
        for _, (begin, end) in pre_tokenizer.pre_tokenize_str(probe):
            if begin % 3 == 0 and end - begin == 2:
                classes[points[begin // 3]] = kind
    classes[ord("\n")] = SPACE
    return classes


def segments(raw: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(text, first byte) of stretches that can be cut alone: whole texts, or parts of very long ones."""
    texts, begins = [], []
    lengths = np.diff(offsets)
    for k in np.flatnonzero(lengths > limit):
        at, end = int(offsets[k]), int(offsets[k + 1])
        while end - at > limit:
            found = _safe_place(raw, at + limit // 2, end)
            if found is None:
                break
            texts.append(k)
            begins.append(found)
            at = found
    text = np.concatenate([np.arange(len(lengths)), np.array(texts, np.int64)])
    begin = np.concatenate([offsets[:-1], np.array(begins, np.int64)])
    order = np.lexsort((begin, text))
    return text[order], begin[order]


def _safe_place(raw: np.ndarray, at: int, end: int) -> int | None:
    """The first place from ``at`` on with a space between two ASCII letters."""
    while at + 2 < end:
        part = raw[at : min(end, at + 4096)]
        hits = np.flatnonzero(_ASCII_LETTER[part[:-2]] & (part[1:-1] == 0x20) & _ASCII_LETTER[part[2:]])
        if len(hits):
            return at + int(hits[0]) + 1
        at += 4094
    return None


class Cutter:
    """Cuts slices of texts into pieces.

    ``join_space``: a piece takes one space before it, and white space makes pieces of its own; otherwise white space is
    dropped and numbers are single characters. ``lower``: code points to cut and key instead of the text's own.
    Texts with a character of class UNKNOWN or with one of ``specials`` are not cut.
    """

    def __init__(
        self,
        classes: np.ndarray,
        join_space: bool,
        lower: np.ndarray | None = None,
        specials: tuple[str, ...] = (),
    ):
        self.classes, self.join_space, self.lower = classes, join_space, lower
        self.specials = [s.encode() for s in specials]

    def cut(self, raw: np.ndarray, begins: np.ndarray) -> Pieces:
        """``raw``: bytes of consecutive segments, ``begins``: where each begins."""
        text = raw.tobytes()
        points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")
        n_segments = len(begins)
        ends = np.append(begins[1:], len(raw))
        if len(points) == len(raw):
            first, last = begins, ends
        else:
            leads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            first, last = leads[begins], leads[ends]
        kinds = self.classes[np.minimum(points, CLASSED - 1)]
        kinds[points >= CLASSED] = UNKNOWN
        whole = np.zeros(n_segments, bool)
        strange = np.flatnonzero(kinds == UNKNOWN)
        if len(strange):
            whole[np.searchsorted(last, strange, side="right")] = True
        for special in self.specials:
            at = text.find(special)
            while at >= 0:
                whole[np.searchsorted(ends, at, side="right")] = True
                at = text.find(special, at + 1)
        if self.lower is not None:
            points = self.lower[np.minimum(points, CLASSED - 1)]
            raw = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le", "replace").encode(), np.uint8)
        starts = self._starts(points, kinds, first[first < last])
        owner = np.searchsorted(last, starts, side="right")
        stops = np.append(starts[1:], len(points))
        keep = ~whole[owner] if whole.any() else np.ones(len(starts), bool)
        if not self.join_space:
            keep &= kinds[starts] != SPACE
        if not keep.all():
            starts, stops, owner = starts[keep], stops[keep], owner[keep]
        if len(points) != len(raw):
            sizes = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            place = np.concatenate([[0], np.cumsum(sizes)])
            starts, stops = place[starts], place[stops]
        return Pieces(raw, starts, stops - starts, owner, np.flatnonzero(whole))

    def _starts(self, points: np.ndarray, kinds: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Places (in code points) where a piece starts."""
        n = len(points)
        if not n:
            return np.zeros(0, np.int64)
        opens = np.ones(n, bool)
        opens[1:] = kinds[1:] != kinds[:-1]
        edge = np.zeros(n + 3, bool)
        edge[firsts] = True
        edge[n:] = True
        opens |= edge[:n]
        if not self.join_space:
            opens |= kinds == NUMBER
        marks = np.flatnonzero(points == 39)
        if len(marks):
            self._split_contractions(points, kinds, edge, marks, opens)
        if self.join_space:
            # The last white space before a visible character stands alone or, if a space, goes with that character.
            space = kinds == SPACE
            final = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n])
            opens[final] = True
            opens[final[points[final] == 0x20] + 1] = False
        return np.flatnonzero(opens)

    def _split_contractions(self, points, kinds, edge, marks, opens) -> None:
        before = np.maximum(marks - 1, 0)
        starts_here = kinds[before] != OTHER
        if self.join_space:
            starts_here &= points[before] != 0x20
        marks = marks[edge[marks] | starts_here]
        after = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = after[marks + 1], after[marks + 2]
        short = np.isin(one, _CONTRACTIONS_1) & ~edge[marks + 1]
        long = np.zeros(len(marks), bool)
        for a, b in _CONTRACTIONS_2:
            long |= (one == a) & (two == b)
        long &= ~edge[marks + 1] & ~edge[marks + 2]
        for chosen, width in ((marks[short], 2), (marks[long], 3)):
            opens[chosen + 1] = False
            beyond = chosen + width
            opens[beyond[beyond < len(opens)]] = True


class Pieces:
    """Pieces of a slice: first byte, bytes and segment of each; ``whole`` segments are not cut."""

    def __init__(self, raw, starts, lengths, owner, whole):
        self.raw, self.starts, self.lengths, self.owner, self.whole = raw, starts, lengths, owner, whole

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two words that hold all bytes and the length of each short piece; the last result marks short ones."""
        return span_keys(self.raw, self.starts, self.lengths)


def span_keys(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact 128-bit keys of byte spans of at most KEY_BYTES, zeros for longer ones, and which spans are short."""
    padded = np.zeros(len(raw) + 16, np.uint8)
    padded[: len(raw)] = raw
    words = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), shape=(len(raw) + 9,), strides=(1,))
    short = lengths <= KEY_BYTES
    size = np.where(short, lengths, 0)
    low = words[starts] & _MASKS[np.minimum(size, 8)]
    high = words[starts + np.minimum(size, 8)] & _MASKS[np.maximum(size - 8, 0)]
    return low, high | (size.astype(np.uint64) << U64(56)), short


def key_bytes(low: np.ndarray, high: np.ndarray) -> list[bytes]:
    """The spans of keys."""
    both = np.stack([low, high], axis=1).astype("<u8").tobytes()
    return [both[16 * k : 16 * k + both[16 * k + 15]] for k in range(len(low))]


class PieceTable:
    """An open-addressing hash table from exact keys to small numbers, looked up for whole arrays at once."""

    def __init__(self, expected: int = 1024):
        bits = max(10, int(2 * expected).bit_length())
        self.mask = U64((1 << bits) - 1)
        self.low, self.high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.value = np.full(1 << bits, -1, np.int32)
        self.size = 0

    def _place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix64(low ^ (high * U64(0x9E3779B97F4A7C15))) & self.mask

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for unknown ones."""
        at = self._place(low, high)
        found = self.value[at]
        same = (self.low[at] == low) & (self.high[at] == high)
        left = np.flatnonzero(~same & (found >= 0))
        while len(left):
            at[left] = (at[left] + U64(1)) & self.mask
            here = at[left]
            found[left] = self.value[here]
            same = (self.low[here] == low[left]) & (self.high[here] == high[left])
            left = left[~same & (found[left] >= 0)]
        return found

    def add(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> None:
        """Distinct keys that are not in the table."""
        if 2 * (self.size + len(low)) > len(self.value):
            used = self.value >= 0
            old = self.low[used], self.high[used], self.value[used]
            self.__init__(2 * (self.size + len(low)))
            self._insert(*old)
        self._insert(low, high, value)

    def _insert(self, low, high, value) -> None:
        self.size += len(low)
        at = self._place(low, high)
        left = np.arange(len(low))
        while len(left):
            free = self.value[at[left]] < 0
            _, winner = np.unique(at[left[free]], return_index=True)
            chosen = left[free][winner]
            self.low[at[chosen]], self.high[at[chosen]] = low[chosen], high[chosen]
            self.value[at[chosen]] = value[chosen]
            left = np.setdiff1d(left, chosen, assume_unique=True)
            at[left] = (at[left] + U64(1)) & self.mask

    def items(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.value >= 0)
        return self.low[used], self.high[used], self.value[used]


def distinct_keys(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each different key, and the number of each key among the different ones."""
    _, first, number = np.unique(mix64(low ^ mix64(high)), return_index=True, return_inverse=True)
    if (low == low[first[number]]).all() and (high == high[first[number]]).all():
        return first, number
    # Two keys share a hash: order by the keys themselves.
    order = np.lexsort((low, high))
    turns = np.ones(len(low), bool)
    turns[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    number = np.empty(len(low), np.int64)
    number[order] = np.cumsum(turns) - 1
    return order[turns], number


class PieceLookup:
    """Numbers of pieces by tiers: a shared table first, then this worker's cache, then ``encode`` for new ones.

    ``encode`` gets different pieces as bytes and returns a number for each. The cache is emptied when it holds
    more than ``limit`` pieces or more than ``limit_bytes`` of long ones; ``forget`` is called then.
    """

    def __init__(
        self,
        encode: Callable[[list[bytes]], list[int]],
        shared: PieceTable | None = None,
        limit: int = 500_000,
        limit_bytes: int = 32 << 20,
        forget: Callable[[], None] = lambda: None,
    ):
        self.encode, self.shared, self.forget = encode, shared, forget
        self.limit, self.limit_bytes = limit, limit_bytes
        self._empty()

    def _empty(self) -> None:
        self.cache, self.long, self.long_bytes = PieceTable(), {}, 0

    def numbers(self, pieces: Pieces) -> np.ndarray:
        if self.cache.size > self.limit or self.long_bytes > self.limit_bytes:
            self._empty()
            self.forget()
        low, high, short = pieces.keys()
        found = self.shared.find(low, high) if self.shared is not None else np.full(len(low), -1, np.int32)
        missing = np.flatnonzero((found < 0) & short)
        if len(missing):
            found[missing] = self.cache.find(low[missing], high[missing])
            new = missing[found[missing] < 0]
            if len(new):
                first, number = distinct_keys(low[new], high[new])
                own_low, own_high = low[new[first]], high[new[first]]
                values = np.array(self.encode(key_bytes(own_low, own_high)), np.int32)
                self.cache.add(own_low, own_high, values)
                found[new] = values[number]
        if not short.all():
            self._long_numbers(pieces, np.flatnonzero(~short), found)
        return found

    def _long_numbers(self, pieces: Pieces, places: np.ndarray, found: np.ndarray) -> None:
        text = pieces.raw
        spans = [
            text[b : b + n].tobytes()
            for b, n in zip(pieces.starts[places].tolist(), pieces.lengths[places].tolist(), strict=True)
        ]
        new = [s for s in dict.fromkeys(spans) if s not in self.long]
        if new:
            self.long.update(zip(new, self.encode(new), strict=True))
            self.long_bytes += sum(map(len, new)) + 100 * len(new)
        found[places] = [self.long[s] for s in spans]


def slices_of(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, begin of each segment in them, text number of each segment) for slices of a text column."""
    raw, offsets = text_bytes(column)
    text, begin = segments(raw, offsets, limit)
    ends = np.append(begin[1:], len(raw))
    first = 0
    while first < len(text):
        last = max(first + 1, int(np.searchsorted(ends, begin[first] + limit, side="right")))
        yield raw[begin[first] : ends[last - 1]], begin[first:last] - begin[first], text[first:last]
        first = last


def special_strings(tokenizer_json: str) -> tuple[str, ...]:
    """Strings that a tokenizer takes out of a text before it cuts it."""
    return tuple(t["content"] for t in json.loads(tokenizer_json).get("added_tokens", []))
