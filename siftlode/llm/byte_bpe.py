"""Token ids of whole texts by a byte-level BPE of the ``tokenizers`` library.

Such a tokenizer cuts a text into pieces by character class and encodes each piece by itself. Pieces repeat,
so they are found with whole-array operations here and looked up by hash; the library encodes those
that are not yet known to the worker. Texts with characters of unassigned classes or strings of added tokens go to the library whole.
"""

from __future__ import annotations

import os
import unicodedata
from functools import cache

import numpy as np

from siftlode.llm.textvec import mix

_U = np.uint64
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)
#: Entries of the lookup by hash, and ids kept for it before it starts anew.
SLOTS, POOL = 1 << 19, 1 << 21
#: New pieces given to the library at a time.
BATCH = 1 << 12


@cache
def classes() -> np.ndarray:
    """The class of every code point: letters, numbers, white space, others; unassigned ones are unknown."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = LETTER
        elif kind[0] == "N":
            out[c] = NUMBER
        elif kind == "Cn":
            out[c] = UNKNOWN
    out[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return out


def piece_starts(points: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces start: runs of a class, a blank joining the run after it, and English contractions."""
    n = len(points)
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    start[begins] = True
    within = np.ones(n, bool)
    within[begins] = False
    # the last white character before a run stands alone, or joins it if it is a blank
    runs = np.flatnonzero(start & (kind != SPACE) & within)
    runs = runs[kind[runs - 1] == SPACE]
    start[runs - 1] = True
    start[runs[points[runs - 1] == 0x20]] = False
    # an apostrophe that starts a piece, before s t m d re ve ll
    quote = np.flatnonzero(start & (points == 0x27))
    quote = quote[quote + 1 < n]
    quote = quote[within[quote + 1] & (kind[quote + 1] == LETTER)]
    if len(quote):
        padded = np.concatenate([points, [0, 0]])
        same = np.concatenate([within, [False, False]])
        one, two = padded[quote + 1], np.where(same[quote + 2], padded[quote + 2], 0)
        long = ((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)
        short = np.isin(one, [0x73, 0x74, 0x6D, 0x64])
        for hit, size in ((quote[short], 1), (quote[long], 2)):
            start[hit + 1] = False
            after = hit + 1 + size
            after = after[after < n]
            start[after[within[after]]] = True
    return np.flatnonzero(start)


class Encoder:
    """Ids of many texts at a time; keeps the ids of pieces it has met, within fixed memory."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # their strings in a text are cut out before all else
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(SLOTS, _U)
        self.at = np.zeros(SLOTS, np.int64)
        self.size = np.zeros(SLOTS, np.int32)
        self.pool = np.zeros(POOL, np.int32)
        self.used = 0

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _pieces(self, texts: list[str]) -> list[list[int]]:
        """Ids of single pieces: those without white space but for a leading blank go together, a line feed between."""
        plain = [i for i, x in enumerate(texts) if not x.isspace() and len(x.split()) == 1 and x.split()[0] == x.removeprefix(" ")]
        out: list[list[int]] = [[]] * len(texts)
        known: set[int] = set()
        if len(self.feed) == 1:
            # the library's encodings are large, so that few pieces are encoded at a time
            for lo in range(0, len(plain), BATCH):
                run = plain[lo : lo + BATCH]
                ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(texts[i] for i in run)], add_special_tokens=False)[0].ids, np.int32)
                cuts = np.flatnonzero(ids == self.feed[0]).tolist()
                for i, a, b in zip(run, [-1, *cuts], [*cuts, len(ids)], strict=True):
                    out[i] = ids[a + 1 : b]
            known.update(plain)
        rest = [i for i in range(len(texts)) if i not in known]
        for i, ids in zip(rest, self._library([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def encode(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of each) for texts in UTF-8 one after another."""
        text = data.decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        raw = np.frombuffer(data, np.uint8)
        # code points before each byte offset
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets]
        kind = classes()[points]
        if (kind == UNKNOWN).any() or any(t in text for t in self.added):
            whole = self._library([text[a:b] for a, b in zip(before, before[1:], strict=False)])
            return np.array([i for ids in whole for i in ids], np.int32), np.array([len(ids) for ids in whole], np.int64)
        starts = piece_starts(points, kind, before)
        ends = np.append(starts[1:], len(points))
        h = self._hashes(points, starts, ends)
        ids, sizes = self._ids(h, points, starts, ends)
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(total[np.searchsorted(starts, before)])

    @staticmethod
    def _hashes(points, starts, ends) -> np.ndarray:
        up, down = _powers(len(points))
        total = np.zeros(len(points) + 1, _U)
        np.cumsum((points.astype(_U) + _U(1)) * up[: len(points)], out=total[1:])
        h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15))
        return np.maximum(h, _U(1))

    def _ids(self, h, points, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        slot = (h & _U(SLOTS - 1)).astype(np.int64)
        missing = np.flatnonzero(self.key[slot] != h)
        if not len(missing):
            return self._gather(self.pool, self.at[slot], self.size[slot])
        unique, first, back = np.unique(h[missing], return_index=True, return_inverse=True)
        wanted = missing[first]
        raw = points.tobytes()
        new = self._pieces([raw[4 * a : 4 * b].decode("utf-32-le") for a, b in zip(starts[wanted].tolist(), ends[wanted].tolist(), strict=True)])
        size = np.array([len(x) for x in new], np.int32)
        flat = np.concatenate([np.asarray(x, np.int32) for x in new])
        at = np.concatenate([[0], np.cumsum(size)[:-1]])
        # pieces known before and new ones, side by side
        ends_of_pool = self.used
        pool = np.concatenate([self.pool[:ends_of_pool], flat])
        where, sizes = self.at[slot], self.size[slot]
        where[missing], sizes[missing] = at[back] + ends_of_pool, size[back]
        out = self._gather(pool, where, sizes)
        if self.used + len(flat) > POOL:
            self._forget()
        if len(flat) <= POOL:
            s = (unique & _U(SLOTS - 1)).astype(np.int64)
            self.key[s], self.at[s], self.size[s] = unique, at + self.used, size
            # of two new pieces with one slot the later is kept; all three arrays agree on it
            self.pool[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
        return out

    @staticmethod
    def _gather(pool, at, size) -> tuple[np.ndarray, np.ndarray]:
        total = np.cumsum(size, dtype=np.int64)
        index = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(at - (total - size), size)
        return pool[index], size.astype(np.int64)


_kept: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_kept.get("up", ())) <= n:
        for name, base in (("up", 0x5851F42D4C957F2D), ("down", pow(0x5851F42D4C957F2D, -1, 1 << 64))):
            p = np.full(max(n, 1 << 20) + 1, base, _U)
            p[0] = 1
            _kept[name] = np.multiply.accumulate(p)
    return _kept["up"], _kept["down"]


@cache
def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return Encoder(path)
