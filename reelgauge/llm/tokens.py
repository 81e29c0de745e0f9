"""Token ids of whole texts, by the tokenizers library.

White space always ends a pre-token in both kinds of vocabulary used here, so a
text is cut before single spaces and line feeds between two other characters,
and a sign that ends such a piece after an ASCII letter is a piece of its own.
Each distinct piece is encoded once by the library and remembered. The ids are
those of the whole text; longer runs of white space stay inside a piece. Texts
that hold an added token of the vocabulary, such as ``<|endoftext|>``, are
encoded whole.

Pieces of at most 15 bytes are cut, looked up and laid out for all texts of a
call at once: their bytes and length are two 64-bit numbers, compared exactly.
Longer ones go through a dict.
"""

from __future__ import annotations

import gc
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from reelgauge.llm.shared import release

#: Pieces remembered by one worker, and the characters of those above ``SHORT`` bytes.
REMEMBERED = 400_000
REMEMBERED_CHARS = 4_000_000
SHORT = 15
#: One space, then Latin letters and signs that stay one character each when lower-cased and composed.
_LATIN = re.compile(" [!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]+")
#: The letters of these alone: one pre-token, whatever follows.
_WORD = re.compile(" [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
_SIGNS = ".,;:!?"

_BYTE = np.arange(256)
_SEAMS = np.isin(_BYTE, [10, 32])
_SHOWN = ~np.isin(_BYTE, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
_LETTERS = np.isin(_BYTE, list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_LOW_BYTES = np.array([2 ** (8 * min(n, 8)) - 1 for n in range(SHORT + 1)], np.uint64)
_HIGH_BYTES = np.array([2 ** (8 * max(n - 8, 0)) - 1 for n in range(SHORT + 1)], np.uint64)

#: The character byte-level models write for a byte: itself if it shows, else one from 256 on.
_SHOWS = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
_HIDDEN = [x for x in range(256) if x not in _SHOWS]
_WRITTEN = {x: chr(x) for x in _SHOWS} | {x: chr(256 + n) for n, x in enumerate(_HIDDEN)}


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _blank(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Are these three bytes white space?"""
    general = (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
    return general | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80)


def _two(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Are these two?"""
    return (a == 0xC2) & ((b == 0x85) | (b == 0xA0))


def _seams(data: np.ndarray, n: int) -> np.ndarray:
    """Places of single spaces and line feeds between two characters that show; ``data`` goes on after ``n``."""
    at = np.flatnonzero(_SEAMS[data[:n]])
    before, after = data[at - 1], data[at + 1]
    good = _SHOWN[before] & _SHOWN[after]
    odd = np.flatnonzero(good & (after >= 0x80))
    a, b, c = (data[at[odd] + k] for k in (1, 2, 3))
    good[odd[_two(a, b) | _blank(a, b, c)]] = False
    odd = np.flatnonzero(good & (before >= 0x80))
    a, b, c = (data[at[odd] - k] for k in (3, 2, 1))
    good[odd[_two(b, c) | _blank(a, b, c)]] = False
    return at[good]


def _written(held: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` from place ``n`` on, in a longer array if it is too short."""
    if n + len(more) > len(held):
        held = np.concatenate([held[:n], np.zeros(n // 2 + len(more), held.dtype)])
    held[n : n + len(more)] = more
    return held


class _Table:
    """Numbers of short pieces by their two words of bytes."""

    def __init__(self, most: int):
        self.bits = max(8, int(2 * most).bit_length())
        self.low, self.high = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.uint64)
        self.place = np.full(1 << self.bits, -1, np.int32)
        self.room = (1 << self.bits) * 3 // 4

    def _slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = low * np.uint64(0x9E3779B97F4A7C15) ^ high * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """-1 for unknown ones."""
        slot = self._slots(low, high)
        at = self.place[slot].astype(np.int64)
        left = np.flatnonzero((at >= 0) & ((self.low[slot] != low) | (self.high[slot] != high)))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.place) - 1)
            here = slot[left]
            at[left] = self.place[here]
            left = left[(at[left] >= 0) & ((self.low[here] != low[left]) | (self.high[here] != high[left]))]
        return at

    def add(self, low: np.ndarray, high: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of unknown pieces, from ``base``, and which piece was the first of each number."""
        slot, at = self._slots(low, high), np.zeros(len(low), np.int64)
        left, firsts, known = np.arange(len(low)), [], base
        while len(left):
            free = left[self.place[slot[left]] < 0]
            self.place[slot[free]] = free
            won = free[self.place[slot[free]] == free]
            self.low[slot[won]], self.high[slot[won]] = low[won], high[won]
            self.place[slot[won]] = np.arange(known, known + len(won))
            known += len(won)
            firsts.append(won)
            here = slot[left]
            same = (self.low[here] == low[left]) & (self.high[here] == high[left])
            at[left[same]] = self.place[here[same]]
            left = left[~same]
            slot[left] = (slot[left] + 1) & (len(self.place) - 1)
        return at, np.concatenate([np.zeros(0, np.int64), *firsts])


class Encoder:
    """Encodes texts to one flat array of ids and the number of ids of each text."""

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        # The library works on what stands between two special tokens by itself.
        self.mark, self.mark_id = "<|endoftext|>", self.tokenizer.token_to_id("<|endoftext|>")
        self.lowers = self.tokenizer.normalizer is not None
        # Added tokens are found anywhere in a text, in capitals too if they are looked for after lowering.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = tuple(x.content for x in added)
        self.added_low = tuple(x.content.lower() for x in added if x.normalized) if self.lowers else ()
        words = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(words.values()) + 1, np.int64)
        for word, number in words.items():  # byte-level models write one character for a byte
            self.bytes_of[number] = len(word.removesuffix("</w>") if self.lowers else word)
        # A sign cut off is one id whatever stands before it.
        self.signs = np.isin(_BYTE, [ord(x) for x in _SIGNS if len(self.tokenizer.encode(x, add_special_tokens=False).ids) == 1])
        self.written = _WRITTEN | {32: "\0" if self.lowers else "\0" + _WRITTEN[32]}
        self.calls = 0
        self.remembered, self.missed = remembered, 0.0  # kept pieces stay about below this bound
        self._forget()

    def _forget(self) -> None:
        self.table, self.long, self.characters = _Table(self.remembered), {}, 0
        # Ids of all pieces in a row, where those of each begin, how many they are; the first ``kept`` pieces stay.
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.kept = self.kept_ids = 0

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of any pieces, many of them in one call of the library."""
        text = self.mark.join([*pieces, ""])
        if self.mark_id is None or text.count("<|") > len(pieces):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(ids == self.mark_id)
        return ids[ids != self.mark_id], np.diff(ends, prepend=-1) - 1

    def _run(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that may simply stand one after the other; cut by their bytes."""
        text = "".join(pieces)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        if self.lowers:  # the space goes
            sizes = [(len(x) if x.isascii() else len(x.lower().encode())) - 1 for x in pieces]
        else:
            sizes = [len(x) if x.isascii() else len(x.encode()) for x in pieces]
        ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes), side="left") + 1
        return ids, np.diff(ends, prepend=0)

    def _words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for a space and letters alone: what the pre-tokenizer makes of them is known, the model gets it at once."""
        text = "".join(pieces)
        written = (text.lower() if self.lowers else text).encode().decode("latin-1").translate(self.written)
        tokenize = self.tokenizer.model.tokenize
        found = [[x.id for x in tokenize(word)] for word in written.split("\0")[1:]]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _learn(self, pieces: list[str], whole: set[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of distinct pieces in any order, and where those of each piece begin and how many they are."""
        lowers = self.lowers
        words, easy, odd, added = [], [], [], []  # easy: one space, then only characters that show
        for number, x in enumerate(pieces):
            if x in whole:
                added.append(number)
            elif _WORD.fullmatch(x):
                words.append(number)
            elif _LATIN.fullmatch(x) if lowers else x[0] == " " and len(x) > 1 and x.isprintable() and x.rfind(" ") == 0:
                easy.append(number)
            else:
                odd.append(number)
        flats, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for work, group in ((self._words, words), (self._run, easy), (self._ids, odd), (self._whole, added)):
            for start in range(0, len(group), 512):
                flat, lengths = work([pieces[x] for x in group[start : start + 512]])
                flats.append(flat)
                counts.append(lengths)
        order, made = np.array(words + easy + odd + added, np.int64), np.concatenate(counts)
        starts, lengths = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        starts[order], lengths[order] = np.cumsum(made) - made, made
        return np.concatenate(flats), starts, lengths

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has; None counts as empty."""
        gc.disable()  # many small lists, none of them in a cycle
        try:
            found = self._encode(texts)
        finally:
            gc.enable()
        if self.missed > 0.3:
            self._forget()  # texts of another kind
        self.calls += 1
        if self.calls % 16 == 1:
            release()
        return found

    def _has_added(self, text: str) -> bool:
        if any(x in text for x in self.added):
            return True
        return bool(self.added_low) and any(x in text.lower() for x in self.added_low)

    def _cut(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, set[str], np.ndarray]:
        """Where pieces begin, texts that hold an added token, and where these begin; ``edges`` are those of all texts."""
        n = int(edges[-1])
        edge = np.zeros(n + 1, bool)
        edge[edges] = True
        cut = edge[:n].copy()
        seams = _seams(data, n)
        cut[seams[~edge[seams + 1]]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        last = ends - 1
        cut[last[self.signs[data[last]] & _LETTERS[data[last - 1]] & (last > starts)]] = True
        whole, places = set(), []
        if self._has_added(data[:n].tobytes().decode()):
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if self._has_added(text := data[start:end].tobytes().decode()):
                    whole.add(text)
                    places.append(start)
                    cut[start + 1 : end] = False
        return np.flatnonzero(cut), whole, np.array(places, np.int64)

    def _encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = pc.fill_null(column.cast(pa.large_string()), "")
        edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        n = int(edges[-1] - edges[0])
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        data = np.zeros(n + 24, np.uint8)  # numbers are read beyond the end
        data[:n] = np.frombuffer(column.buffers()[2], np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        starts, whole, apart = self._cut(data, edges)
        ends = np.append(starts[1:], n)
        sizes = ends - starts
        is_short = sizes <= SHORT
        is_short[np.searchsorted(starts, apart)] = False
        eights = np.ndarray((n + 16,), "<u8", data, strides=(1,))
        short = np.flatnonzero(is_short)
        begins, size = starts[short], sizes[short]
        low = eights[begins] & _LOW_BYTES[size]
        high = eights[begins + 8] & _HIGH_BYTES[size] | size.astype(np.uint64) << np.uint64(56)

        at = np.empty(len(starts), np.int64)
        found = self.table.find(low, high)
        unknown = np.flatnonzero(found < 0)
        base, n_new = self.kept, 0
        full = base > self.remembered or base + len(unknown) > self.table.room
        self.missed = len(unknown) / len(starts) if full else 0.0
        pieces: list[str] = []
        if len(unknown):
            # Full: rare pieces of this call go again, the frequent ones came early.
            table = _Table(len(unknown)) if full else self.table
            found[unknown], firsts = table.add(low[unknown], high[unknown], base)
            new = short[unknown[firsts]]
            pieces = [data[a:b].tobytes().decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            n_new = len(pieces)
        at[short] = found
        long: dict[str, int] = {}
        for number in np.flatnonzero(~is_short).tolist():
            piece = data[starts[number] : ends[number]].tobytes().decode()
            place = self.long.get(piece)
            if place is None and (place := long.get(piece)) is None:
                place = long[piece] = base + len(pieces)
                pieces.append(piece)
            at[number] = place

        n, n_ids = self.kept, self.kept_ids
        # Short pieces and long ones apart: either may be remembered without the other.
        for group, known in ((pieces[:n_new], {}), (pieces[n_new:], long)):
            if not group:
                continue
            flat, begins, lengths = self._learn(group, whole)
            self.flat = _written(self.flat, n_ids, flat)
            self.starts, self.lengths = _written(self.starts, n, begins + n_ids), _written(self.lengths, n, lengths)
            n, n_ids = n + len(group), n_ids + len(flat)
            characters = sum(map(len, known))
            if not full and self.characters + characters <= REMEMBERED_CHARS:
                self.kept, self.kept_ids, self.characters = n, n_ids, self.characters + characters
                self.long.update(known)
        lengths = self.lengths[at]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.starts[at] - before[:-1], lengths) + np.arange(int(before[-1]))]
        return ids, np.diff(before[np.searchsorted(starts, edges)])


@lru_cache(maxsize=4)
def encoder(vocabulary: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(vocabulary)


def chunks(texts: list[str | None] | pa.Array, characters: int = 1_000_000):
    """Runs of rows with about so many characters (bytes of an Arrow column), as (start, end)."""
    start, seen = 0, 0
    columnar = isinstance(texts, pa.Array)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist() if columnar else [len(x or "") for x in texts]
    for number, size in enumerate(sizes):
        seen += size
        if seen >= characters:
            yield start, number + 1
            start, seen = number + 1, 0
    if start < len(texts):
        yield start, len(texts)
