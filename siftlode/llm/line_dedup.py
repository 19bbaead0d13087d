"""Fuzzy line de-duplication.

A line's normal form is its sequence of lower-case words (ASCII letters, digits and all non-ASCII characters; a
character of a script written without blanks is a word of its own). Equal forms make one class. Classes whose words' edit
similarity reaches the bound are linked, and of each connected group only the first occurrence stays, by document id and
line number.

Candidates share a key: a run of one to six words. Runs that few lines are expected to have, and that hold no shorter such run, stand in
one order for all lines, the rarest first; a line's keys are its first ones, as many as the edits that the bound allows cannot all
touch (no edit touches more than q runs of q words, none within another, so each counts 1/q). Of two linked lines that whose keys end first
in the order has one that the other has whole, and among its keys too (prefix filter over runs), so that no linked pair is missed. A line with too few such runs has its single words as well. How rare a run is
is guessed from the words of a bounded sample of lines, and runs that many of these share come last: the guess decides how
many keys there are, and no result. SimHash blocks in their place find few such lines: at similarity 0.8 a fifth of the bits differ,
so that no block wide enough to tell lines apart stays whole. The README has the recall of both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm import textvec as tv
from siftlode.llm.components import link_all
from siftlode.llm.toxicity import WORD
from siftlode.llm.workspace import Workspace, checked_join, fresh, small_batches

_U = np.uint64
#: First bytes of characters that may be words of their own.
_LEAD = tv.table([0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0])
#: Words of the longest run that may be a key, of the shortest line that may be like another, and lines that a rare run is expected in.
LONGEST, LEAST, RARE = 6, 4, 8
#: Lines that the guesses come from, about, their words at most, bits of the words' places, and how many of the lines make a run a common one.
SAMPLE, WIDEST, BITS, COMMON = 20_000, 1_000, 20, 8
#: Steps of a doubling in which frequencies are told.
STEPS = 16
#: Words of the lines for each bucket of keys, keys that are packed at a time, and the mark of a place in a line that is not known.
BUCKET, PACKED, NOWHERE = 1 << 20, 1 << 19, 0xFFFF
#: Rows that are held against one another at a time, and pairs of them that are kept.
WAITING, AT_ONCE = 1 << 14, 1 << 18
#: Members of a key whose pairs are all made where the keys meet, those whose pairs are all held against sketches, and bits of a sketch.
FEW, MANY, SKETCH = 16, 1024, 256
_PLACE = _U(0x9E3779B97F4A7C15)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; characters of scripts without blanks (Thai to Burmese, Khmer, Kana, Han, full width) are cut out of the runs."""
    starts, ends = tv.spans(data, offsets, WORD)
    lead = np.flatnonzero(_LEAD[data])
    lead = lead[lead + 2 < len(data)]
    first, second = data[lead], data[lead + 1]
    alone = (first >= 0xE3) & (first <= 0xE9) | (first == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    alone |= (first == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second >= 0x9E) & (second <= 0x9F)) | (first == 0xEF) & (second >= 0xBC) | (first == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    lead = lead[alone]
    if not len(lead):
        return starts, ends
    after = lead + 3 + (data[lead] == 0xF0)
    return np.union1d(starts, np.concatenate([lead, np.setdiff1d(after, ends)])), np.union1d(ends, np.concatenate([after, np.setdiff1d(lead, starts)]))


def _lines(texts):
    """By chunk: first row, texts, and per line with words: text, line number in it, first word, words; word hashes."""
    newline = tv.table([10])
    for lo, hi, data, offsets in tv.chunks(texts):
        starts, ends = _words(data, offsets)
        h = tv.hashes(tv.LOWER[data], starts, ends)
        breaks = np.flatnonzero(newline[data])
        text = tv.owners(offsets, starts)
        # lines are numbered through the chunk: one more at each break and each text
        through = np.searchsorted(breaks, starts) + text
        at = np.flatnonzero(np.diff(through, prepend=-1))
        owner = text[at]
        number = through[at] - owner - np.searchsorted(breaks, offsets[owner])
        yield lo, hi - lo, owner, number, at, np.diff(at, append=len(h)), h


def _nodes(h: np.ndarray, at: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash of each line's form."""
    ends = np.cumsum(words)
    place = np.arange(ends[-1]) - np.repeat(ends - words, words)
    flat = h[np.repeat(at, words) + place]
    return tv.mix(np.add.reduceat(tv.mix(flat + place.astype(_U) * _PLACE), ends - words) + words.astype(_U))


class Guess:
    """How many lines a run is expected in, by the logarithm of its words' frequencies, and the hashes of runs that many lines share."""

    def __init__(self, rate: np.ndarray, total: int):
        self.rate, self.total, self.common = rate, total, np.empty(0, _U)

    @classmethod
    def of(cls, words: np.ndarray, numbers: np.ndarray, every: int) -> Guess:
        """From sampled lines (their words one after another, and how many each has), one of ``every``."""
        count = np.bincount((_spread(words) >> _U(64 - BITS)).astype(np.int64), minlength=1 << BITS)
        guess = cls(np.rint(STEPS * np.log2((count + 1.0) * every)).astype(np.int32), round(STEPS * np.log2(max(1, len(words)) * float(every))))
        for _ in range(LONGEST):
            # runs longer than those found common so far may be common as well
            key, number = np.unique(line_keys(words, numbers, guess)[1], return_counts=True)
            new = np.setdiff1d(key[number >= COMMON], guess.common)
            if not len(new):
                break
            guess.common = np.union1d(guess.common, new)
        return guess

    def knows(self, key: np.ndarray) -> np.ndarray:
        """Whether each is common."""
        if not len(self.common):
            return np.zeros(len(key), bool)
        return self.common[np.minimum(np.searchsorted(self.common, key), len(self.common) - 1)] == key


def _spread(words: np.ndarray) -> np.ndarray:
    return tv.mix(words.astype(_U) + _U(1))


def _runs(h: np.ndarray, left: np.ndarray, rate: np.ndarray, guess: Guess):
    """(place, key, words, rank) of the runs that may be keys, by size; none but a single word of the last kind touches a shorter one whole.

    left: words from each place to the end of its line.
    """
    n, run, expected, inside = len(h), h.copy(), rate.copy(), np.zeros(len(h), bool)
    for q in range(1, LONGEST + 1):
        if q > 1:
            run[: n - q + 1] = run[: n - q + 1] * _PLACE + h[q - 1 :]
            expected[: n - q + 1] += rate[q - 1 :] - guess.total
        at = np.flatnonzero((left >= q) & ~inside & ((expected <= STEPS * np.log2(RARE)) | (q == LONGEST)))
        key = tv.mix(run[at] + _U(q))
        common = guess.knows(key)
        if q < LONGEST:
            at, key, common = at[~common], key[~common], common[~common]
        yield at, key, q, (q + common << 16) + np.clip(expected[at] + (1 << 15), 0, (1 << 16) - 1)
        inside[at] = True
        # from here on: a shorter run lies between a place and one word further
        inside[:-1] |= inside[1:].copy()


def line_keys(words: np.ndarray, numbers: np.ndarray, guess: Guess) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of lines given by their words' 32-bit hashes, one line after another, and numbers of words; by line."""
    return placed_keys(words, numbers, guess)[:2]


def placed_keys(words: np.ndarray, numbers: np.ndarray, guess: Guess) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with the place of the key's first word in its line, ``NOWHERE`` if the line has the run more than once or far behind."""
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, _U), np.empty(0, np.int64)
    h, ends = _spread(words), np.cumsum(numbers)
    line_of = np.repeat(np.arange(len(numbers)), numbers)
    rate = guess.rate[(h >> _U(64 - BITS)).astype(np.int64)]
    # the edits that tell a line from the longest that it may be like
    edits = 5 * numbers // 4 // 5
    place, key, size, rank = zip(*((at, key, np.full(len(at), q), rank) for at, key, q, rank in _runs(h, ends[line_of] - np.arange(len(h)), rate, guess)), strict=True)
    place, key, size, rank = (np.concatenate(x) for x in (place, key, size, rank))
    # each run counts 1/size: those of a line that an edit touches count one together at most
    worth = 60 // size
    bare = np.bincount(line_of[place], worth, minlength=len(numbers)) <= 60 * edits
    single = np.zeros(len(h), bool)
    single[place[size == 1]] = True
    more = np.flatnonzero(bare[line_of] & ~single)
    alone = np.bincount(line_of[single], minlength=len(numbers))
    place, key = np.concatenate([place, more]), np.concatenate([key, tv.mix(h[more] + _U(1))])
    worth, rank = np.append(worth, np.full(len(more), 60)), np.append(rank, (LONGEST + 2 << 16) + rate[more] + (1 << 15))
    late = np.arange(len(place)) >= len(place) - len(more)
    line = line_of[place]
    order = np.lexsort((rank.astype(_U) << _U(44) | key >> _U(20), line))
    line, key, worth, late, place = line[order], key[order], worth[order], late[order], place[order]
    again = (line[1:] == line[:-1]) & (key[1:] == key[:-1])
    place = np.minimum(place - (ends - numbers)[line], NOWHERE)
    place[(np.append(again, False) | np.append(False, again))[: len(place)]] = NOWHERE
    before = lambda x: (c := np.cumsum(x)) - x - np.append(0, c)[np.searchsorted(line, np.arange(len(numbers)))][line]
    # single words of the last kind touch the runs before them, so that they count with the other single words alone
    own = np.where(late, 60 * (before(late.astype(np.int64)) + alone[line]) <= 60 * edits[line], before(np.where(late, 0, worth)) <= 60 * edits[line])
    own &= (numbers[line] >= LEAST) & ~np.append(False, again)[: len(line)]
    return line[own], key[own], place[own]


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_key, line_no, node) per line of at least ``min_words`` words; node hashes the form."""

    def run(batches):
        for b in batches:
            for lo, _, owner, number, at, words, h in _lines(b.column(2)):
                own = np.flatnonzero(words >= min_words)
                if not len(own):
                    continue
                rows = pa.array(owner[own] + lo)
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(number[own]), pa.array(tv.signed(_nodes(h, at[own], words[own])))], ["doc_id", "text_key", "line_no", "node"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, "doc_id long, text_key long, line_no long, node long")


def form_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(node, words, form, sketch) of one of the equal lines of about a mebibyte of text: the form's words as 32-bit hashes, and a bit for each word that changes with it."""

    def run(batches):
        for b in batches:
            for _, _, _, _, at, words, h in _lines(b.column(2)):
                own = np.flatnonzero(words >= min_words)
                if not len(own):
                    continue
                node, one = np.unique(_nodes(h, at[own], words[own]), return_index=True)
                at, words = at[own][one], words[own][one]
                ends = np.cumsum(words)
                flat = (h[np.repeat(at - (ends - words), words) + np.arange(ends[-1])] >> _U(32)).astype("<u4")
                form = pa.Array.from_buffers(pa.binary(), len(node), [None, pa.py_buffer((4 * np.append(0, ends)).astype("<i4")), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([pa.array(tv.signed(node)), pa.array(words), form, _sketches(flat, words)], ["node", "words", "form", "sketch"])

    return docs.select("doc_id", "text_key", "text").mapInArrow(run, "node long, words long, form binary, sketch binary")


def _sketches(words: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """Of lines given by their words: a word that is added or taken away changes one bit."""
    out, ends, lo = [], np.cumsum(numbers), 0
    for lo in range(0, len(numbers), 1024):
        n = len(numbers[lo : lo + 1024])
        own = words[ends[lo] - numbers[lo] : ends[lo + n - 1]]
        at = np.repeat(np.arange(n) * SKETCH, numbers[lo : lo + n]) + (own.astype(np.int64) * 0x9E3779B1 >> 20) % SKETCH
        out.append(np.packbits(np.bincount(at, minlength=n * SKETCH).astype(np.uint8) & 1))
    return pa.Array.from_buffers(pa.binary(), len(numbers), [None, pa.py_buffer((SKETCH // 8 * np.arange(len(numbers) + 1)).astype("<i4")), pa.py_buffer(np.concatenate(out))])


def _bits(column: pa.Array) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(x.as_py() for x in column), "<u8").reshape(len(column), SKETCH // 64)


def _flat(forms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of forms one after another, and how many each has."""
    number = np.array([len(x.as_buffer()) // 4 for x in forms], np.int64)
    return np.frombuffer(b"".join(x.as_py() for x in forms), "<u4"), number


def guessed(forms: DataFrame, nodes: int) -> Guess:
    """From a bounded sample of different lines."""
    every = max(1, nodes // SAMPLE)
    rows = forms.filter((F.pmod("node", F.lit(every)) == 0) & (F.col("words") <= WIDEST)).select("form").limit(2 * SAMPLE).toArrow()
    return Guess.of(*_flat(rows.column(0).combine_chunks()), every)


def keyed(forms: DataFrame, guess: Guess, buckets: int) -> DataFrame:
    """(bucket, base, common, keys, rest): the keys of forms, packed by bucket; those that many lines are known to share go to any bucket."""
    told = forms.sparkSession.sparkContext.broadcast((guess.rate, guess.total, guess.common))
    names = ["bucket", "base", "common", "keys", "rest"]

    def packed(base: int, parts: list, own: Guess, turn: int):
        line, key, place, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        common = own.knows(key)
        bucket = ((key >> _U(48)) * _U(buckets) >> _U(16)).astype(np.uint16)
        for often in (False, True):
            mine = np.flatnonzero(common == often)
            if not len(mine):
                continue
            if often:
                cut, which = np.array([0, len(mine)]), [turn % buckets]
            else:
                mine = mine[np.argsort(bucket[mine], kind="stable")]
                there = bucket[mine]
                cut = np.append(np.flatnonzero(np.append(True, there[1:] != there[:-1])), len(there))
                which = there[cut[:-1]].tolist()
            rows = []
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                at = mine[lo:hi]
                step = np.diff(line[at], prepend=0).astype("<u2")
                rest = step.tobytes() + size[at].astype("<u4").tobytes() + place[at].astype("<u2").tobytes()
                k = key[at]
                rows.append((k.astype("<u4").tobytes() + (k >> _U(32)).astype("<u2").tobytes() + ((k >> _U(48)).astype("<u2").tobytes() if often else b""), zstandard.compress(rest, 1)))
            keys, rest = (pa.array(x, pa.binary()) for x in zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(np.full(len(which), base)), pa.array(np.full(len(which), often)), keys, rest], names)

    def run(batches):
        own = Guess(*told.value[:2])
        own.common = told.value[2]
        base, after, parts, number, turn = 0, -1, [], 0, 0
        for b in batches:
            for lo, hi, *_ in tv.chunks(b.column(1), 1 << 20):
                piece = b.slice(lo, hi - lo)
                ids = np.asarray(piece.column(0))
                words, size = _flat(piece.column(1))
                line, key, place = placed_keys(words, size, own)
                # ids stand in the rows as what they are beyond the first, so that they must follow one another
                for first, last in _consecutive(ids):
                    if parts and (ids[first] != after or number > PACKED or ids[last] - base > 0xFFFF):
                        yield from packed(base, parts, own, turn)
                        parts, number, turn = [], 0, turn + 1
                    if not parts:
                        base, turn = int(ids[first]), turn or int(ids[first]) % buckets
                    after = ids[last] + 1
                    l, r = np.searchsorted(line, [first, last + 1])
                    parts.append((ids[line[l:r]] - base, key[l:r], place[l:r], size[line[l:r]]))
                    number += r - l
        if parts:
            yield from packed(base, parts, own, turn)

    return forms.select("id", "form").mapInArrow(run, "bucket int, base long, common boolean, keys binary, rest binary")


def _consecutive(ids: np.ndarray):
    """First and last place of the stretches of ids that follow one another, of no more than 2**15."""
    cut = np.flatnonzero(np.append(True, np.diff(ids) != 1))
    for lo, hi in zip(cut.tolist(), np.append(cut[1:], len(ids)).tolist(), strict=True):
        for at in range(lo, hi, 1 << 15):
            yield at, min(hi, at + (1 << 15)) - 1


def _places(row: dict) -> tuple[np.ndarray, ...]:
    """(key, node, size, place) of a packed row."""
    rest = zstandard.decompress(row["rest"])
    n = len(rest) // 8
    key = np.frombuffer(row["keys"], "<u4", n).astype(_U) | np.frombuffer(row["keys"], "<u2", n, 4 * n).astype(_U) << _U(32)
    key |= (np.frombuffer(row["keys"], "<u2", n, 6 * n) if row["common"] else np.full(n, row["bucket"])).astype(_U) << _U(48)
    node = row["base"] + np.cumsum(np.frombuffer(rest, "<u2", n).astype(np.int64))
    return key, node, np.frombuffer(rest, "<u4", n, 2 * n).astype(np.int64), np.frombuffer(rest, "<u2", n, 6 * n).astype(np.int64)


def _room(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Edits that the bound allows between lines of so many words."""
    return np.floor(np.maximum(n, m) * (1 - similarity) + 1e-9).astype(np.int64)


def _pairs(key: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray | None, similarity: float, bits: np.ndarray | None = None, comp: np.ndarray | None = None, side: np.ndarray | None = None):
    """Pairs of places, by key: two members of one key, of different components and sides, where lengths, places of the key and sketches leave room for their edits."""
    at, d = np.arange(len(key)), 1
    while len(at):
        at = at[at + d < len(key)]
        at = at[key[at] == key[at + d]]
        x = at if comp is None else at[comp[at] != comp[at + d]]
        if side is not None:
            x = x[(side[x] < 0) | (side[x] != side[x + d])]
        y = x + d
        room, unlike = _room(size[x], size[y], similarity), np.abs(size[x] - size[y])
        least = unlike
        if place is not None:
            shift = place[x] - place[y]
            # edits before the key and behind it; where a place is not known, the lengths alone
            least = np.where((place[x] == NOWHERE) | (place[y] == NOWHERE), unlike, np.abs(shift) + np.abs(size[x] - size[y] - shift))
        own = np.flatnonzero((least <= room) & (node[x] != node[y]))
        if bits is not None and len(own):
            own = own[np.bitwise_count(bits[x[own]] ^ bits[y[own]]).sum(1) <= 2 * room[own] - unlike[own]]
        if len(own):
            yield x[own], y[own]
        d += 1


def _grouped(first: np.ndarray, number: np.ndarray, node: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, node, size), each once: the members of keys by their key's first member and the power of two that its number of members reaches.

    Lines that are like one another share many keys, which so become one group or two, with all of their pairs.
    """
    key = tv.mix(first.astype(_U) << _U(6) | np.log2(number).astype(_U))
    order = np.lexsort((node, key))
    key, node, size = key[order], node[order], size[order]
    new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
    return key[new], node[new], size[new]


def met(packed: DataFrame, buckets: int, similarity: float) -> DataFrame:
    """(key, a, b, size): the pairs of keys with few members, their key null, ``size`` 0 for those with a key's first member; the members ``a`` of keys with more, ``b`` null.

    Keys with more members that have the first of them in common, and about as many, are one.
    """
    names = ["key", "a", "b", "size"]

    def members(key, node, size):
        for lo in range(0, len(key), 1 << 16):
            k, a, n = (x[lo : lo + (1 << 16)] for x in (key, node, size))
            yield pa.RecordBatch.from_arrays([pa.array(tv.signed(k)), pa.array(a), pa.nulls(len(k), pa.int64()), pa.array(n)], names)

    def found(parts: list):
        key, node, size, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((node, key))
        key, node, size, place = key[order], node[order], size[order], place[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        number = np.diff(start, append=len(key))
        first, number = np.repeat(start, number), np.repeat(number, number)
        large = np.flatnonzero(number > FEW)
        yield from members(*_grouped(node[first[large]], number[large], node[large], size[large]))
        few = np.flatnonzero((number > 1) & (number <= FEW))
        first = first[few] == few
        key, node, size, place = key[few], node[few], size[few], place[few]
        every = [(node[x], node[y], ~first[x]) for x, y in _pairs(key, node, size, place, similarity)]
        if every:
            # members stand by node, so that a < b
            a, b, later = (np.concatenate(x) for x in zip(*every, strict=True))
            order = np.lexsort((later, b, a))
            a, b, later = a[order], b[order], later[order]
            new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            a, b, later = a[new], b[new], later[new].astype(np.int64)
            for lo in range(0, len(a), 1 << 16):
                n = len(a[lo : lo + (1 << 16)])
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), *(pa.array(x[lo : lo + n]) for x in (a, b, later))], names)

    def run(batches):
        parts: dict[int, list] = {}
        for b in batches:
            for row in b.to_pylist():
                places = _places(row)
                if row["common"]:
                    yield from members(*places[:3])
                else:
                    parts.setdefault(row["bucket"], []).append(places)
        for bucket in list(parts):
            yield from found(parts.pop(bucket))

    return packed.repartitionById(buckets, F.col("bucket")).mapInArrow(run, "key long, a long, b long, size long")


def sketched(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the pairs of different components of rows ``(key, left, node, size, comp, sketch)``, those of a key one after another, whose lengths and sketches leave room for their edits.

    left: null, or on which side the row is, of a key whose pairs are those of two sides.
    """

    def found(table: pa.Table):
        key, node, size, comp = (table.column(c).to_numpy() for c in ("key", "node", "size", "comp"))
        side = table.column("left").fill_null(-1).to_numpy()
        bits = _bits(table.column("sketch").combine_chunks())
        parts, number = [], 0
        for x, y in _pairs(key, node, size, None, similarity, bits, comp, side):
            parts.append(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])]))
            number += len(x)
            if number > AT_ONCE:
                parts, number = [np.unique(np.concatenate(parts, 1), axis=1)], 0
                if parts[0].shape[1] > AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(e) for e in parts.pop()], ["a", "b"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(e) for e in np.unique(np.concatenate(parts, 1), axis=1)], ["a", "b"])

    def run(batches):
        kept: list = []
        for b in batches:
            kept.append(b)
            if sum(map(len, kept)) < WAITING:
                continue
            table = pa.Table.from_batches(kept)
            key = table.column(0).to_numpy()
            # the last key may go on in the next batch
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from found(table.slice(0, cut))
                kept = table.slice(cut).to_batches()
        if sum(map(len, kept)):
            yield from found(pa.Table.from_batches(kept))

    return rows.mapInArrow(run, "a long, b long")


def sifted(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the pairs of rows ``(a, b, na, nb, sa, sb)`` whose sizes and sketches leave room for their edits."""

    def run(batches):
        for b in batches:
            n, m = np.asarray(b.column(2)), np.asarray(b.column(3))
            unlike = np.bitwise_count(_bits(b.column(4)) ^ _bits(b.column(5))).sum(1)
            yield b.select(["a", "b"]).filter(pa.array(unlike <= 2 * _room(n, m, similarity) - np.abs(n - m)))

    return rows.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def edit_distance(a: list, b: list) -> int:
    """Levenshtein distance of two sequences, in one bit-parallel pass over the second."""
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return len(a) + len(b)
    where: dict = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = full, 0, len(a)  # rises and falls down the column
    for y in b:
        match = where.get(y, 0)
        diagonal = ((match & up) + up ^ up) | match | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        distance += (right_up & top > 0) - (right_down & top > 0)
        right_up = right_up << 1 | 1
        up = (right_down << 1 | ~(diagonal | right_up)) & full
        down = right_up & diagonal & full
    return distance


def similar(rows: DataFrame, bound: float) -> DataFrame:
    """The pairs ``(a, b)`` of rows with ``left_form`` and ``right_form`` whose edit similarity reaches the bound."""

    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        room = int((1 - bound) * max(len(x), len(y)) + 1e-9)
        if abs(len(x) - len(y)) > room:
            return False
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        front = int(differ[0]) if len(differ) else n
        x, y = x[front:], y[front:]
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[len(x) - n :][::-1] != y[len(y) - n :][::-1])
        back = int(differ[0]) if len(differ) else n
        x, y = x[: len(x) - back].tolist(), y[: len(y) - back].tolist()
        # so many edits turn one rest into the other, whatever they are
        if max(len(x), len(y)) <= room:
            return True
        short, long = (x, y) if len(x) < len(y) else (y, x)
        known = set(short)
        # every word of the longer that the other lacks costs an edit
        return sum(w not in known for w in long) <= room and edit_distance(x, y) <= room

    def run(batches):
        for b in batches:
            forms = ([np.frombuffer(x.as_buffer(), "<u4") for x in b.column(c)] for c in ("left_form", "right_form"))
            yield b.select(["a", "b"]).filter(pa.array([linked(x, y) for x, y in zip(*forms, strict=True)], pa.bool_()))

    return rows.mapInArrow(run, "a long, b long")


def repeated_lines(docs: DataFrame, similarity: float = 0.8, min_words: int = 1) -> DataFrame:
    """(doc_id, text_key, lines): the numbers of the lines that repeat an earlier one, for rows ``(doc_id, text_key, text)``."""
    if not 0.8 <= similarity <= 1:
        raise ValueError("the keys are made for similarities of 0.8 to 1")
    ws = Workspace(docs.sparkSession, "line-dedup")
    small_batches(ws.spark)
    # dealt first: few equal ones are left in a task, so that sorting them before they are sent is lost work
    forms = form_table(docs, max(min_words, LEAST)).repartition("node").dropDuplicates(["node"]).withColumn("id", F.monotonically_increasing_id())
    forms = ws.write(forms, "forms")
    ws.settle()
    lines = ws.write(line_table(docs, min_words), "lines")
    place = F.struct("doc_id", "text_key", "line_no")
    classes = lines.select("node", place.alias("place")).groupBy("node").agg(F.min("place").alias("first"), F.count("*").alias("n"))

    def side(end: str, *columns) -> DataFrame:
        return forms.select(F.col("id").alias(end), *(F.col(c).alias(name) for c, name in columns))

    def verify(pairs: DataFrame, step: str) -> DataFrame:
        rows = pairs.join(side("a", ("words", "na"), ("sketch", "sa")), "a").join(side("b", ("words", "nb"), ("sketch", "sb")), "b")
        near = ws.write(sifted(rows, similarity), f"near-{step}")
        ws.settle()
        wanted = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        some = checked_join(forms, wanted, "id", "left_semi", 32 * near.count()).select("id", "form")
        # all words of both, so that a pair is judged by edit similarity alone
        rows = near.join(some.toDF("a", "left_form"), "a").join(some.toDF("b", "right_form"), "b")
        return similar(rows.select("a", "b", "left_form", "right_form"), similarity)

    def fits(n, m):
        """No more edits than the bound allows, so no larger difference of lengths."""
        return F.abs(n - m) <= F.floor(F.greatest(n, m) * F.lit(1 - similarity) + 1e-9)

    nodes, words = forms.agg(F.count("*"), F.sum("words")).first()
    buckets = max(1, min((1 << 16) - 1, (words or 0) // BUCKET))
    shared = ws.write(met(keyed(forms, guessed(forms, nodes), buckets), buckets, similarity), "met")
    ws.settle()
    large = ws.write(shared.filter("b is null").select("key", F.col("a").alias("node"), "size").distinct(), "large")
    few = ws.write(shared.filter("b is not null").groupBy("a", "b").agg(F.min("size").alias("turn")), "few")
    ws.drop("met")
    ws.settle()

    def others(rest: DataFrame) -> DataFrame:
        """The pairs of different components of keys with many members; those with very many are dealt to blocks, which meet two by two."""
        number = rest.groupBy("key").agg(F.count("*").alias("n"))
        many = rest.join(number, "key").join(side("node", ("sketch", "sketch")), "node")
        blocks = F.ceil(F.col("n") / MANY).cast("int")
        many = many.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        pair = F.when(blocks == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
        left = F.when(F.col("own") != F.col("other"), (F.col("own") < F.col("other")).cast("int"))
        many = many.select(pair.alias("key"), left.alias("left"), "node", "size", "comp", "sketch")
        return sketched(many.repartition("key").sortWithinPartitions("key"), similarity)

    labels = link_all(ws, large, few, others, verify, fits).join(side("node", ("node", "form_node")), "node").select(F.col("form_node").alias("node"), "comp")
    labels = ws.write(labels, "labels")
    ws.settle()
    ranked = classes.join(labels, "node", "left").filter("n > 1 or comp is not null").select("node", F.coalesce("comp", "node").alias("comp"), "first")
    ranked = ws.write(ranked, "ranked")
    keep = ranked.join(ranked.groupBy("comp").agg(F.min("first").alias("keep")), "comp").select("node", "keep")
    keep = ws.write(keep, "keep")
    extra = checked_join(lines.select("node", "doc_id", "text_key", "line_no"), keep, "node", "inner", 48 * keep.count()).filter(~place.eqNullSafe(F.col("keep")))
    extra = ws.write(extra.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("lines")), "extra")
    ws.keep("extra")
    return extra


def dedup_lines(docs: DataFrame, similarity: float = 0.8, min_words: int = 1) -> DataFrame:
    """All columns of ``docs``, ``text`` without the repeated lines, and ``n_lines``, ``n_dropped`` and ``n_left`` (lines with words).

    Lines end at line feeds. Lines of fewer than ``min_words`` words, by default those without any, always stay. Null texts stay null. Of
    equal or linked lines that stays which is first by (doc_id, text hash, line number), a null id before all others; rows with
    equal id and text count as one and get the same text. Columns named like the added ones are replaced; all others, whatever their
    names, are kept. An empty table gives an empty result. Equal lines are found by 64-bit hashes. The columns must not be named alike.
    """
    own = docs.drop("n_lines", "n_dropped", "n_left")
    key, row, drop, n = fresh(own.columns, "key", "row", "drop", "n")
    keyed = own.withColumn(key, F.xxhash64("text"))
    base = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(key).alias("text_key"), "text")
    extra = repeated_lines(base, similarity, min_words)
    total = extra.agg(F.sum(8 * F.size("lines") + 64)).first()[0] or 0
    drops = extra.select(F.xxhash64("doc_id", "text_key").alias(row), F.col("lines").alias(drop))
    both = checked_join(keyed.withColumn(row, F.xxhash64(F.col("doc_id").cast("long"), key)), drops, row, "left", total)
    lines = F.split("text", "\n", -1)
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(drop, i.cast("long"))), "\n")
    text = F.when(F.col(drop).isNull(), F.col("text")).otherwise(left)
    dropped = F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop))
    whole = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    named = both.select(*(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in own.columns), whole.alias(n), dropped.alias("n_dropped"))
    return named.withColumn("n_lines", F.col(n)).withColumn("n_left", F.col("n_lines") - F.col("n_dropped")).drop(n)
