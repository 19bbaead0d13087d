"""Runs of periodic words, from an enhanced suffix array.

The words of a text are sorted as suffixes, with the length of the common prefix of neighbours. An interval of
suffixes that share exactly ``depth`` words holds all places of a repeat. A square of that period that the next
word does not prolong is a pair of suffixes ``depth`` words apart in different children of the interval, so the
suffixes of all children but the largest are enough: each looks up the ranks of its two partners. The squares
are then moved to the left as long as words agree, and those that end up at the same stretch are one run.

Texts are sorted many at a time in one array, with symbols of their own, so that nothing is shared between two texts.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm import textvec as tv

#: Words of the shortest run.
LEAST = 12
#: Pairs looked up, and places compared, at a time.
BLOCK = 1 << 16

NAMES = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
_SCHEMA = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in NAMES)


def agreement(t: np.ndarray, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """On how many places in succession ``t`` agrees from ``a`` and from ``b`` on, going by ``step`` (1 or -1).

    Both ends of ``t`` are marks that agree with nothing else.
    """
    out, last = np.zeros(len(a), np.int64), len(t) - 1
    for lo in range(0, len(a), BLOCK):
        live, width = np.arange(lo, min(lo + BLOCK, len(a))), 8
        while len(live):
            ahead = (out[live, None] + np.arange(width)) * step
            differ = t[np.clip(a[live, None] + ahead, 0, last)] != t[np.clip(b[live, None] + ahead, 0, last)]
            first = differ.argmax(1)
            stop = differ[np.arange(len(live)), first]
            out[live] += np.where(stop, first, width)
            live = live[~stop]
            width = min(4 * width, max(8, (8 * BLOCK) // max(1, len(live))))
    return out


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, ranks of the suffixes), by doubling the length that ranks tell apart; settled suffixes are left alone."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    places, keys, length = np.arange(n), symbols[order], 0
    while len(places):
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        head = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        rank[order[places]] = head
        alone = new & np.concatenate([new[1:], [True]])
        places, length = places[~alone], max(1, 2 * length)
        suffixes = order[places]
        keys = rank[suffixes] * (n + 1) + rank[np.minimum(suffixes + length, n)] + 1
        by = np.argsort(keys, kind="stable")
        order[places], keys = suffixes[by], keys[by]
    return order, rank[:n]


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in order.

    Where the words before both agree, it is one less than that of the place before. The others are compared word by word,
    which takes n log n steps at most over all.
    """
    n = len(symbols)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = n
    t = np.concatenate([[-2], symbols, [-1]])
    at = np.arange(n)
    compared = np.flatnonzero((t[at] != t[before]) | (before == n) | (before == 0))
    lengths = np.zeros(n, np.int64)
    lengths[compared] = agreement(t, compared + 1, before[compared] + 1, 1)
    known = np.zeros(n, np.int64)
    known[compared] = compared
    known = np.maximum.accumulate(known)
    lengths = lengths[known] - (at - known)
    return lengths[order]


def intervals(prefixes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(depth, first, last) of each interval of suffixes that share words, and for each place the interval that it parts (or -1)."""
    depth, first, last, parted, stack = [], [], [], [], []
    for j, v in enumerate([*prefixes.tolist(), 0]):
        left = j - 1
        while stack and depth[stack[-1]] > v:
            k = stack.pop()
            last[k], left = j - 1, first[k]
        if v and not (stack and depth[stack[-1]] == v):
            stack.append(len(depth))
            depth.append(v)
            first.append(left)
            last.append(0)
        parted.append(stack[-1] if v else -1)
    return np.array(depth, np.int64), np.array(first, np.int64), np.array(last, np.int64), np.array(parted[:-1], np.int64)


def _small_children(depth, first, last, parted):
    """(interval, first, end) of the children of all intervals, but for one largest child of each."""
    places = np.flatnonzero(parted >= 0)
    owner = np.concatenate([np.arange(len(depth)), parted[places]])
    start = np.concatenate([first, places])
    by = np.lexsort((start, owner))
    owner, start = owner[by], start[by]
    heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    end = np.concatenate([start[1:], [0]])
    tails = np.concatenate([heads[1:], [len(owner)]]) - 1
    end[tails] = last[owner[tails]] + 1
    size = end - start
    largest = np.flatnonzero(size == np.maximum.reduceat(size, heads)[owner])
    keep = np.ones(len(owner), bool)
    keep[largest[np.concatenate([[True], owner[largest][1:] != owner[largest][:-1]])]] = False
    return owner[keep], start[keep], end[keep]


def squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of all squares that the next word does not prolong, by end, then period; each once."""
    n = len(symbols)
    order, rank = suffix_ranks(symbols)
    depth, first, last, parted = intervals(common_prefixes(symbols, order))
    found = [np.empty((0, 2), np.int64)]
    if len(depth):
        t = np.concatenate([symbols, [-1]])
        owner, start, end = _small_children(depth, first, last, parted)
        ends = np.cumsum(end - start)
        lo = 0
        while lo < len(owner):
            base = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
            size = (end - start)[lo:hi]
            child = np.repeat(np.arange(lo, hi), size)
            i = order[start[child] + np.arange(len(child)) - np.repeat(ends[lo:hi] - size - base, size)]
            k = owner[child]
            d = depth[k]
            for left in (i, i - d):
                right = left + d
                other = right if left is i else left
                inside = (left >= 0) & (right < n)
                place = rank[np.clip(other, 0, n - 1)]
                inside &= (place >= first[k]) & (place <= last[k])
                inside &= t[np.clip(right, 0, n)] != t[np.clip(right + d, 0, n)]
                found.append(np.stack([right + d, d], 1)[inside])
            lo = hi
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[:, 0], pairs[:, 1]


def runs(symbols: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs with ``least`` symbols or more, by start, then period. Symbols are integers from 0 on."""
    got = [np.empty((0, 3), np.int64)]
    if len(symbols) > 1:
        end, period = squares(symbols)
        t = np.concatenate([[-2], symbols, [-1]])
        while len(end):
            # of the squares with one end, the shortest is no power; what it reaches to the left takes its powers along
            head = np.concatenate([[True], end[1:] != end[:-1]])
            e, q = end[head], period[head]
            start = e - 2 * q - agreement(t, e - 2 * q, e - q, -1)
            got.append(np.stack([start, e - start, q], 1))
            group = np.cumsum(head) - 1
            left = ~head & ((period % q[group] != 0) | (end - 2 * period < start[group]))
            end, period = end[left], period[left]
    out = np.concatenate(got)
    out = out[out[:, 1] >= least]
    out = out[np.lexsort((out[:, 2], out[:, 0]))]
    return out[:, 0], out[:, 1], out[:, 2]


def _looped(first: np.ndarray, number: np.ndarray, ids: list) -> np.ndarray:
    """For each word the one that stands in its place: itself, but in the tenth of documents whose id's crc32 ends in 0 a loop from some word on."""
    source = np.arange(int(number.sum()))
    for row, doc in enumerate(ids):
        n = int(number[row])
        h = zlib.crc32(str(doc).encode()) if doc is not None and n else 1
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[first[row] + a : first[row] + n] = first[row] + a + np.arange(n - a) % p
    return source


def _chunk(ids: list, data: np.ndarray, offsets: np.ndarray, looped: bool) -> list[tuple]:
    starts, ends = tv.spans(data, offsets, tv.NOT_WHITE)
    owner = tv.owners(offsets, starts)
    first, number = tv.counts_by_text(owner, len(ids))
    if looped:
        source = _looped(first, number, ids)
        starts, ends = starts[source], ends[source]
    words = tv.hashes(data, starts, ends)
    # a symbol stands for a word of one text
    _, symbols = np.unique(tv.mix(words + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True)
    start, length, period = runs(symbols)

    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = np.cumsum(cover)[:-1] == 0
    # all kept words, each with a blank behind it
    size = (ends - starts)[kept] + 1
    till = np.cumsum(size)
    text = np.full(int(till[-1]) if len(till) else 0, 32, np.uint8)
    inside = np.repeat(starts[kept] - (till - size), size) + np.arange(len(text))
    word = np.ones(len(text), bool)
    word[till - 1] = False
    text[word] = data[inside[word]]
    bounds = np.concatenate([[0], till])[np.searchsorted(np.flatnonzero(kept), np.concatenate([first, [len(starts)]]))]

    of_run = owner[start] if len(start) else np.empty(0, np.int64)
    cut = np.searchsorted(of_run, np.arange(len(ids) + 1))
    out = []
    for row, doc in enumerate(ids):
        lo, hi = int(cut[row]), int(cut[row + 1])
        s, m, q = (start[lo:hi] - first[row]).tolist(), length[lo:hi].tolist(), period[lo:hi].tolist()
        best = min(zip([-x for x in m], s, q, strict=True), default=None)
        told = "".join(f"{a},{b},{c}\n" for a, b, c in zip(s, m, q, strict=True))
        whole = text[bounds[row] : max(bounds[row], bounds[row + 1] - 1)]
        longest = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        out.append((doc, hi - lo, *longest, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(whole).hexdigest()))
    return out


def periodic_runs(docs: DataFrame, looped: bool = False) -> DataFrame:
    """Row by row: ``doc_id``, ``n_runs``, the longest run's ``start``, ``length``, ``period`` and ``exponent_milli``, ``runs_sha256`` and ``collapsed_sha256``.

    Words are runs of bytes other than 20 and 09-0D and are numbered from 0; they count as equal if their 64-bit hashes are. A run is a stretch of
    at least 12 words and two periods that cannot be prolonged. ``collapsed_sha256`` is the hash of the text that keeps of each run its first period.
    Of runs with equal lengths the first is the longest, then that with the smaller period. Null, empty and blank texts have no runs: nulls and the
    hashes of the empty string. With ``looped``, a tenth of the documents, by their ids, gets a loop first; a null id gets none.
    Rows that repeat are each returned, other columns are ignored, and an empty table gives an empty result. Rows are worked on a mebibyte
    of text at a time; a longer text is one piece and takes some 150 bytes of memory a word.
    """

    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            for lo, hi, data, offsets in tv.chunks(b.column(1)):
                cols = list(zip(*_chunk(ids[lo:hi], data, offsets, looped), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n.endswith("sha256") else pa.int64()) for n, c in zip(NAMES, cols, strict=True)], list(NAMES))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)
