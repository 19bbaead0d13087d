import hashlib
import random
import zlib

import numpy as np
import pytest

from siftlode.llm import media_jpeg as mj


def padded(raw):
    return raw + b" " * (max(1, -(-len(raw) // 192)) * 192 - len(raw))


def test_round_trip():
    rng = random.Random(4)
    texts = [b"", b"a", b" " * 192, bytes(range(256)) * 5, b"\x80" * 700, b"\xff" * 1000, rng.randbytes(10_000), "é漢😀".encode() * 300, b"\x80" * 63 + b"x" + b"\x80" * 400]
    texts += [rng.randbytes(rng.randint(0, 900)) for _ in range(60)]
    files = mj.encode(texts)
    for text, file, image in zip(texts, files, mj.decode(files), strict=True):
        assert mj.payload(image) == (padded(text), len(text))
        assert file[:2] == b"\xff\xd8" and file[-2:] == b"\xff\xd9"
        assert np.array_equal(mj.thumbnail(image).ravel()[: len(padded(text)) // 192], np.clip(128 + (np.frombuffer(padded(text), np.uint8)[::192].astype(int) - 128) // 8, 0, 255))


class Bits:
    """A plain writer of codes, one bit at a time, of other layouts than the operator writes."""

    def __init__(self):
        self.bits = ""

    def put(self, table, symbol, extra="", codes=None):
        self.bits += table[symbol] + extra

    def done(self):
        self.bits += "1" * (-len(self.bits) % 8)
        return bytes(int(self.bits[i : i + 8], 2) for i in range(0, len(self.bits), 8)).replace(b"\xff", b"\xff\x00")


def slow_file(width, height, components, units, per_unit, interval, rng):
    """A baseline file with sampling factors and long restart intervals, and its blocks."""
    dc_bits = {s: 4 for s in range(12)}
    ac_bits = {r << 4 | s: 8 for r in range(16) for s in range(1, 11)} | {0: 8, 0xF0: 8}
    tables = [{s: format(c, f"0{n}b") for s, c, n in mj.codes(mj.huffman_segment(b))} for b in (dc_bits, ac_bits)]
    order = [i for i, (a, d) in enumerate(components) for _ in range(a * d)] if len(components) > 1 else [0]
    assert len(order) == per_unit
    blocks, scan, w, last = [], b"", Bits(), [0] * len(components)
    for u in range(units):
        if interval and u and u % interval == 0:
            scan += w.done() + bytes([0xFF, 0xD0 + (u // interval - 1) % 8])
            w, last = Bits(), [0] * len(components)
        for c in order:
            block = [rng.randint(-900, 900)] + [rng.choice([0, 0, 0, 0, 1, -1, 5, -300]) if rng.random() < 0.3 else 0 for _ in range(63)]
            blocks.append(block)
            for k, v in enumerate(block):
                if k == 0:
                    v, last[c] = v - last[c], v
                    run = 0
                elif v == 0:
                    run += 1
                    continue
                s = abs(v).bit_length()
                extra = format(v if v > 0 else v + (1 << s) - 1, f"0{s}b") if s else ""
                if k == 0:
                    w.put(tables[0], s, extra)
                    continue
                while run > 15:
                    w.put(tables[1], 0xF0)
                    run -= 16
                w.put(tables[1], run << 4 | s, extra)
                run = 0
            if run:
                w.put(tables[1], 0)
    frame = b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([len(components)]) + b"".join(bytes([i + 1, a << 4 | d, 0]) for i, (a, d) in enumerate(components))
    seg = mj._segment
    out = b"\xff\xd8" + seg(0xE0, b"JFIF\0") + seg(0xDB, b"\x00" + bytes([16] * 64)) + seg(0xC0, frame) + seg(0xC4, b"\x00" + mj.huffman_segment(dc_bits) + b"\x10" + mj.huffman_segment(ac_bits))
    if interval:
        out += seg(0xDD, interval.to_bytes(2, "big"))
    sos = bytes([len(components)]) + b"".join(bytes([i + 1, 0]) for i in range(len(components))) + b"\x00\x3f\x00"
    return out + seg(0xDA, sos) + scan + w.done() + b"\xff\xd9", np.array(blocks)


def test_reader_takes_other_baseline_files():
    rng = random.Random(9)
    cases = [(40, 24, [(2, 2), (1, 1), (1, 1)], 6, 6, 0), (33, 17, [(1, 1)], 15, 1, 4), (20, 20, [(2, 1), (1, 1), (1, 1)], 6, 4, 5), (8, 8, [(1, 1)], 1, 1, 0)]
    made = [slow_file(*c, rng) for c in cases]
    for (file, blocks), image in zip(made, mj.decode([f for f, _ in made]), strict=True):
        assert np.array_equal(image.blocks.reshape(-1, 64), blocks)
    first = mj.decode([made[0][0]])[0]
    assert mj.thumbnail(first).shape == (4, 6)


def test_columns(spark):
    rows = [(1, "plain"), (2, None), (3, ""), (4, "plain"), (None, "x" * 300_000), (1, "plain")]
    got = mj.media_columns(spark.createDataFrame([(k, t, "m") for k, t in rows], "doc_id long, text string, media string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((k is None, k or 0) for k, _ in rows)
    by = {r.doc_id: r for r in got}
    for key, text in rows:
        raw = padded((text or "").encode())
        r = by[key]
        assert (r.n_bytes, r.payload_bytes) == (len((text or "").encode()), len(raw))
        assert (r.payload_sha256, r.tail_crc32) == (hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-16:]))
    assert by[1][1:] == by[4][1:] and by[2][1:] == by[3][1:]
    assert mj.media_columns(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        mj.parse(b"\x89PNG")
