"""Packing token sequences into fixed lengths by vector bin packing.

A bin has room for ``length`` tokens, ``segments`` pieces and ``loss`` loss-bearing tokens. The next piece for
the open bin is the one, of a window of waiting pieces, that fits and whose demand has the largest dot product
with what is left of the bin, both as shares of its limits. Each task packs the documents it reads, in
windows, so that nothing is shuffled or gathered; a sequence's id names its task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm import textvec as tv
from siftlode.llm.byte_bpe import encoder

#: Limits of a sequence, and how many pieces wait at a time.
LENGTH, SEGMENTS, WINDOW = 1024, 128, 256


class Packer:
    """Fills one bin after another from a window of waiting pieces.

    Pieces are (key, tokens, loss-bearing tokens). With ``cut``, a piece that does not fit is cut to fill the bin; its loss
    is then its tokens. ``placed`` gets (key, start in the piece, tokens, bin, offset in the bin).
    """

    def __init__(self, length: int, segments: int, loss: int, cut: bool, window: int = WINDOW):
        self.limit = np.array([length, loss], float)
        self.segments, self.cut, self.window = segments, cut, window
        self.size = np.zeros((2 * window, 2))
        self.start = np.zeros(2 * window, np.int64)
        self.key: list = [None] * (2 * window)
        self.n = 0
        self.bin = 0
        self.placed: list[tuple] = []
        self._open()

    def _open(self) -> None:
        self.left, self.count, self.fill = self.limit.copy(), self.segments, 0

    def add(self, key, tokens: int, loss: int) -> None:
        self.size[self.n] = tokens, loss
        self.start[self.n], self.key[self.n] = 0, key
        self.n += 1
        if self.n == 2 * self.window:
            while self.n > self.window:
                self._step()

    def _take(self, i: int, tokens: int) -> None:
        self.placed.append((self.key[i], int(self.start[i]), tokens, self.bin, self.fill))
        self.fill += tokens
        self.count -= 1
        self.left[0] -= tokens
        if tokens < self.size[i, 0]:
            self.left[1] -= tokens
            self.size[i] -= tokens
            self.start[i] += tokens
            return
        self.left[1] -= self.size[i, 1]
        self.n -= 1
        self.size[i], self.start[i], self.key[i] = self.size[self.n], self.start[self.n], self.key[self.n]

    def _step(self) -> None:
        waiting = self.size[: self.n]
        gain = waiting @ (self.left / self.limit**2)
        # pieces take one segment each, whichever is chosen
        gain[(waiting > self.left).any(1)] = -1
        i = int(gain.argmax())
        if gain[i] >= 0 and self.count:
            self._take(i, int(waiting[i, 0]))
        elif self.cut and self.count and (room := int(self.left.min())) > 0:
            self._take(int(waiting[:, 0].argmax()), room)
        else:
            self._next()
        if not self.left[0] or not self.count:
            self._next()

    def _next(self) -> None:
        if self.count < self.segments:
            self.bin += 1
            self._open()

    def finish(self) -> None:
        while self.n:
            self._step()

    def closed(self) -> list[tuple]:
        """The pieces of the bins that are full, once."""
        out = [p for p in self.placed if p[3] < self.bin]
        self.placed = [p for p in self.placed if p[3] == self.bin]
        return out


def _split_last(pieces: list[tuple]) -> list[tuple]:
    """The pieces of an unfinished bin over bins whose lengths are powers of two, so that none needs padding."""
    if not pieces:
        return []
    out, at, at_bin = [], 0, pieces[0][3]
    total = sum(p[2] for p in pieces)
    rooms = [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
    room = rooms.pop(0) if rooms else 0
    for key, start, tokens, _, _ in pieces:
        while tokens:
            if at == room:
                room, at, at_bin = rooms.pop(0), 0, at_bin + 1
            n = min(tokens, room - at)
            out.append((key, start, n, at_bin, at))
            start, tokens, at = start + n, tokens - n, at + n
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, segments: int = SEGMENTS, loss: int | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, and ``ids`` on request.

    A document is the ids of its text and ``end_id`` (a null or empty text: that alone). Full sequences are cut from its front; the rest is
    packed with others', cut where it fills a bin, and all its tokens bear loss. Each id lies in one piece. The last sequence of a task is
    split into lengths of powers of two. Rows with a null or repeated id are packed like others, each a document. Equal input partitions give
    equal rows. An empty table gives an empty result. ``length`` is a power of two.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    loss = loss or length

    def run(batches):
        encode = encoder(tokenizer_path).encode
        task = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        packer, waiting, full = Packer(length, segments, loss, True), {}, 0
        number = 0

        def rows(pieces):
            cols = [[] for _ in range(8)]
            for doc, start, ids, total, sequence, offset in pieces:
                for col, x in zip(cols, (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, ids if with_ids else None), strict=True):
                    col.append(x)
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
            if with_ids:
                arrays.append(tv.list_array(np.concatenate(cols[7]) if cols[7] else np.empty(0, np.int32), [len(x) for x in cols[7]], pa.int32()))
            return pa.RecordBatch.from_arrays(arrays, [*names, *["ids"] * with_ids])

        def settled(placed):
            for key, start, n, at, offset in placed:
                doc, ids, base, total, _ = waiting[key]
                yield doc, base + start, ids[start : start + n], total, task | at << 1, offset
                waiting[key][4] -= n
                if not waiting[key][4]:
                    del waiting[key]

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for lo, _, data, offsets in tv.chunks(b.column(1)):
                flat, sizes = encode(data.tobytes(), offsets)
                out, at = [], 0
                for doc, size in zip(doc_ids[lo:], sizes.tolist(), strict=False):
                    ids = np.append(flat[at : at + size], np.int32(end_id))
                    at, total = at + size, size + 1
                    whole = total - total % length
                    for start in range(0, whole, length):
                        # sequences of one piece have odd ids
                        out.append((doc, start, ids[start : start + length], total, task | full << 1 | 1, 0))
                        full += 1
                    if total > whole:
                        waiting[number] = [doc, ids[whole:].copy(), whole, total, total - whole]
                        packer.add(number, total - whole, total - whole)
                        number += 1
                out.extend(settled(packer.closed()))
                if out:
                    yield rows(out)
        packer.finish()
        placed = [*packer.closed(), *_split_last(packer.placed)]
        if placed:
            yield rows(list(settled(placed)))

    schema = ", ".join(f"{n} long" for n in names) + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def pack_examples(examples: DataFrame, length: int = LENGTH, segments: int = SEGMENTS, loss: int | None = None) -> DataFrame:
    """Instruction examples ``(example_id, tokens, loss_tokens)`` with ``sequence_id`` and ``offset``, none cut.

    Null counts are 0. An example beyond a limit by itself gets a sequence of its own, to be trimmed or dropped by the caller.
    """
    loss = loss or length

    def run(batches):
        task = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        packer, alone, rows = Packer(length, segments, loss, False), 0, []

        def batch(got):
            ids, tokens, losses, sequence, offset = ([r[i] for r in got] for i in range(5))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, tokens, losses, sequence, offset)], ["example_id", "tokens", "loss_tokens", "sequence_id", "offset"])

        def settled():
            done, packer.placed = packer.placed, []
            return [(*key, task | at << 1, offset) for key, _, _, at, offset in done]

        for b in batches:
            rows = []
            for key in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if key[1] > length or key[2] > loss:
                    rows.append((*key, task | alone << 1 | 1, 0))
                    alone += 1
                else:
                    packer.add(key, key[1], key[2])
            rows += settled()
            if rows:
                yield batch(rows)
        packer.finish()
        if packer.placed:
            yield batch(settled())

    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c)
    chosen = examples.select(F.col("example_id").cast("long").alias("example_id"), zero("tokens"), zero("loss_tokens"))
    return chosen.mapInArrow(run, "example_id long, tokens long, loss_tokens long, sequence_id long, offset long")
