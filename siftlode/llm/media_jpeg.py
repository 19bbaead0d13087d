"""Media columns: baseline JPEG files that carry a payload without loss, and their features.

The format's unit is the quantised coefficient: 192 payload bytes, each less 128, are the three 8x8 blocks (in
zigzag order) of a 4:4:4 unit, all quantisers are 1, and every unit is a restart interval. The unpadded
length stands in a comment. The reader takes any baseline file: it parses the markers and decodes the Huffman codes
of all restart intervals of a batch in step, one code of each interval at a time, in numpy.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm import textvec as tv

_U = np.uint64
UNIT = 192
#: Code lengths by category, made for letters: few bits for the coefficients of a to z.
_DC_BITS = {5: 1, 4: 2, 7: 3, 6: 4, 3: 5, 2: 7, 1: 8, 8: 8, 0: 7, 9: 9, 10: 9, 11: 9}
_AC_BITS = {5: 1, 4: 2, 7: 3, 6: 4, 3: 5, 2: 7, 1: 8, 8: 8, 0x00: 9, 0xF0: 10}
_AC_BITS |= {0x10 | s: 12 for s in range(1, 9)}
_AC_BITS |= {r << 4 | s: 16 for r in range(16) for s in range(1, 11) if r << 4 | s not in _AC_BITS}


def huffman_segment(bits: dict[int, int]) -> bytes:
    """Counts of the codes of 1 to 16 bits, and the symbols in the order of their codes."""
    order = sorted(bits, key=lambda s: (bits[s], s))
    return bytes(sum(b == n for b in bits.values()) for n in range(1, 17)) + bytes(order)


def codes(segment: bytes) -> list[tuple[int, int, int]]:
    """(symbol, code, bits) of a table: codes count up and double with each further bit."""
    out, code, at = [], 0, 16
    for n in range(1, 17):
        for symbol in segment[at : at + segment[n - 1]]:
            out.append((symbol, code, n))
            code += 1
        at += segment[n - 1]
        code <<= 1
    return out


def _coder(bits: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    code, size = np.zeros(256, _U), np.zeros(256, np.int64)
    for symbol, c, n in codes(huffman_segment(bits)):
        code[symbol], size[symbol] = c, n
    return code, size


_DC, _AC = _coder(_DC_BITS), _coder(_AC_BITS)
_CATEGORY = np.array([int(v).bit_length() for v in range(2048)])


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _header(units: int, n_bytes: int) -> tuple[bytes, int]:
    """Everything before the scan's data, and the number of units of the grid."""
    wide = min(8191, math.isqrt(max(1, units) - 1) + 1)
    high = -(-units // wide)
    if high > 8191:
        raise ValueError("payload too long for a JPEG file")
    frame = b"\x08" + (high * 8).to_bytes(2, "big") + (wide * 8).to_bytes(2, "big") + b"\x03" + b"".join(bytes([c, 0x11, 0]) for c in (1, 2, 3))
    out = b"\xff\xd8" + _segment(0xFE, b"bytes=%d" % n_bytes) + _segment(0xDB, b"\x00" + b"\x01" * 64) + _segment(0xC0, frame)
    out += _segment(0xC4, b"\x00" + huffman_segment(_DC_BITS)) + _segment(0xC4, b"\x10" + huffman_segment(_AC_BITS)) + _segment(0xDD, b"\x00\x01")
    return out + _segment(0xDA, b"\x03\x01\x00\x02\x00\x03\x00\x00\x3f\x00"), wide * high


def _scans(coefficients: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy-coded bytes of units of 3 blocks, and the number of each unit's: (units, 3, 64) to (bytes, sizes)."""
    units = len(coefficients)
    v = coefficients.reshape(-1, 64).astype(np.int64)
    category = _CATEGORY[np.abs(v)]
    low = (np.where(v < 0, v - 1, v) & ((1 << category) - 1)).astype(_U)
    value, size = np.zeros((len(v), 65), _U), np.zeros((len(v), 65), np.int64)
    dc = category[:, 0]
    value[:, 0], size[:, 0] = _DC[0][dc] << dc.astype(_U) | low[:, 0], _DC[1][dc] + dc
    block, k = np.nonzero(v[:, 1:])
    k = k + 1
    before = np.where(np.diff(block, prepend=-1) != 0, 0, np.concatenate([[0], k[:-1]]) if len(k) else k)
    run = k - before - 1
    cat = category[block, k]
    symbol = (run % 16) << 4 | cat
    code, bits = _AC[0][symbol], _AC[1][symbol]
    if (run > 15).any():
        zrl, zrl_bits = int(_AC[0][0xF0]), int(_AC[1][0xF0])
        for n in (1, 2, 3):
            far = run // 16 >= n
            code[far] |= _U(zrl) << bits[far].astype(_U)
            bits = bits + far * zrl_bits
    value[block, k], size[block, k] = code << cat.astype(_U) | low[block, k], bits + cat
    last = np.zeros(len(v), np.int64)
    last[block] = k  # the last one assigned stays
    value[:, 64], size[:, 64] = _AC[0][0], np.where(last < 63, _AC[1][0], 0)
    # ones fill the last byte of a unit
    sizes = np.concatenate([size.reshape(units, -1), np.zeros((units, 1), np.int64)], axis=1)
    total = sizes.sum(1)
    fill = -total % 8
    sizes[:, -1] = fill
    values = np.concatenate([value.reshape(units, -1), ((1 << fill) - 1).astype(_U)[:, None]], axis=1)
    keep = sizes > 0
    values, bits = values[keep], sizes[keep]
    ends = np.cumsum(bits)
    begin = ends - bits
    word, shift = begin >> 6, (begin & 63).astype(_U)
    left = values << (64 - bits).astype(_U)
    words = np.zeros(int(ends[-1] >> 6) + 2, _U)
    heads = np.flatnonzero(np.diff(word, prepend=-1))
    words[word[heads]] = np.bitwise_or.reduceat(left >> shift, heads)
    over = np.flatnonzero((begin & 63) + bits > 64)
    words[word[over] + 1] |= left[over] << (_U(64) - shift[over])
    return words.astype(">u8").view(np.uint8)[: int(ends[-1] >> 3)], (total + fill) >> 3


def encode(texts: list[bytes]) -> list[bytes]:
    """A JPEG file of each text, padded with blanks to a positive multiple of 192 bytes."""
    heads, parts, grids = [], [], []
    for t in texts:
        units = max(1, -(-len(t) // UNIT))
        head, grid = _header(units, len(t))
        heads.append(head)
        grids.append(grid)
        raw = np.zeros(grid * UNIT, np.int16)
        payload = np.full(units * UNIT, 0x20, np.uint8)
        payload[: len(t)] = np.frombuffer(t, np.uint8)
        raw[: len(payload)] = payload.astype(np.int16) - 128
        parts.append(raw)
    data, sizes = _scans(np.concatenate(parts).reshape(-1, 3, 64))
    grids = np.array(grids)
    unit_end = np.cumsum(grids)
    number = np.arange(len(sizes)) - np.repeat(unit_end - grids, grids)
    marked = number < np.repeat(grids, grids) - 1  # no marker after an image's last interval
    stuffed = np.cumsum(data == 0xFF)
    markers = np.concatenate([[0], np.cumsum(marked * 2)])
    ends = np.cumsum(sizes)
    at = np.arange(len(data)) + stuffed - (data == 0xFF) + np.repeat(markers[:-1], sizes)
    out = np.zeros(len(data) + int(stuffed[-1]) + int(markers[-1]), np.uint8)
    out[at] = data
    here = (ends + stuffed[ends - 1] + markers[:-1])[marked]
    out[here], out[here + 1] = 0xFF, (0xD0 + number[marked] % 8)
    bound = np.concatenate([[0], (ends + stuffed[ends - 1] + markers[1:])[unit_end - 1]])
    return [head + out[a:b].tobytes() + b"\xff\xd9" for head, a, b in zip(heads, bound, bound[1:], strict=False)]


@dataclass
class Image:
    width: int = 0
    height: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, across, down, quantiser
    quantisers: dict[int, np.ndarray] = field(default_factory=dict)
    huffman: dict[int, bytes] = field(default_factory=dict)
    chosen: dict[int, tuple[int, int]] = field(default_factory=dict)  # component: DC and AC table
    interval: int = 0
    comment: bytes = b""
    scan: int = 0
    blocks: np.ndarray | None = None  # (units, blocks of a unit, 64), quantised, in zigzag order

    @property
    def unit(self) -> list[int]:
        """The component of each block of a unit."""
        if len(self.components) == 1:
            return [0]
        return [i for i, (_, a, d, _) in enumerate(self.components) for _ in range(a * d)]

    @property
    def grid(self) -> tuple[int, int]:
        """Units across and down."""
        one = len(self.components) == 1
        a = 8 * (1 if one else max(c[1] for c in self.components))
        d = 8 * (1 if one else max(c[2] for c in self.components))
        return -(-self.width // a), -(-self.height // d)


def parse(data: bytes) -> Image:
    """The markers of a baseline file with one scan of all components."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    image, at = Image(), 2
    while True:
        if data[at] != 0xFF:
            raise ValueError("no marker where one must be")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            image.comment = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                image.quantisers[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                image.huffman[body[0]] = body[1:n]
                body = body[n:]
        elif marker == 0xC0:
            image.height, image.width = (int.from_bytes(body[i : i + 2], "big") for i in (1, 3))
            image.components = [(c, x >> 4, x & 15, q) for c, x, q in zip(body[6::3], body[7::3], body[8::3], strict=True)]
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("not a baseline file")
        elif marker == 0xDD:
            image.interval = int.from_bytes(body, "big")
        elif marker == 0xDA:
            image.chosen = {c: (t >> 4, t & 15) for c, t in zip(body[1 : 1 + 2 * body[0] : 2], body[2 : 2 + 2 * body[0] : 2], strict=True)}
            image.scan = at
            return image


def _lookup(segment: bytes) -> np.ndarray:
    """By the next 16 bits: bits of the code << 8 | symbol; 0 where there is no code."""
    out = np.zeros(1 << 16, np.int32)
    for symbol, code, n in codes(segment):
        out[code << 16 - n : code + 1 << 16 - n] = n << 8 | symbol
    return out


def decode(files: list[bytes]) -> list[Image]:
    """All files with their coefficients. Files of equal tables and layout are decoded together."""
    images = [parse(f) for f in files]
    alike: dict[tuple, list[int]] = {}
    for i, image in enumerate(images):
        tables = tuple((image.huffman[a], image.huffman[16 | b]) for a, b in (image.chosen[c[0]] for c in image.components))
        alike.setdefault((tables, tuple(image.unit)), []).append(i)
    for (tables, unit), members in alike.items():
        _decode_alike([images[i] for i in members], [files[i] for i in members], tables, unit)
    return images


def _decode_alike(images: list[Image], files: list[bytes], tables: tuple, unit: tuple[int, ...]) -> None:
    raw = np.frombuffer(b"".join(f[i.scan :] for i, f in zip(images, files, strict=True)), np.uint8)
    lengths = np.array([len(f) - i.scan for i, f in zip(images, files, strict=True)])
    follows = np.concatenate([raw[1:], [0]])
    escape = raw == 0xFF
    restart = np.flatnonzero(escape & (follows >= 0xD0) & (follows <= 0xD7))
    ends = np.flatnonzero(escape & (follows == 0xD9))
    file_ends = np.cumsum(lengths)
    ends = ends[np.searchsorted(ends, file_ends) - 1]  # the last one of each file
    drop = np.zeros(len(raw), bool)
    drop[1:] = escape[:-1] & (raw[1:] == 0)
    for marker in (restart, ends):
        drop[marker] = drop[marker + 1] = True
    clean = np.concatenate([raw[~drop], np.full(8, 0xFF, np.uint8)])
    kept = np.concatenate([[0], np.cumsum(~drop)])
    begin = np.sort(np.concatenate([file_ends - lengths, restart + 2]))
    lane_file = np.searchsorted(file_ends, begin, side="right")
    # units of each interval
    grids = np.array([i.grid[0] * i.grid[1] for i in images])
    every = np.array([i.interval or g for i, g in zip(images, grids, strict=True)])
    nth = np.arange(len(begin)) - np.searchsorted(lane_file, lane_file)
    units = np.minimum(every[lane_file], grids[lane_file] - nth * every[lane_file])
    lane_block = (np.concatenate([[0], np.cumsum(grids)])[lane_file] + nth * every[lane_file]) * len(unit)
    out = _decode_lanes(clean, kept[begin] * 8, units * len(unit), lane_block, int(grids.sum()) * len(unit), tables, np.array(unit))
    at = 0
    for image, grid in zip(images, grids, strict=True):
        image.blocks = out[at : at + grid * len(unit)].reshape(grid, len(unit), 64)
        at += grid * len(unit)


def _decode_lanes(clean, position, blocks, first_block, total, tables, unit) -> np.ndarray:
    """Blocks (total, 64) of lanes that start at bit positions and have so many blocks each."""
    b = clean.astype(np.int64)
    window = np.zeros(len(b), np.int64)
    for i in range(5):
        window[: len(b) - 4] |= b[i : len(b) - 4 + i] << 8 * (4 - i)
    look = np.concatenate([t for pair in tables for t in map(_lookup, pair)])  # DC and AC by component
    out = np.zeros(total * 64, np.int16)
    order = np.argsort(-blocks, kind="stable")  # lanes that end first come last
    pos, left, block = position[order], blocks[order], first_block[order]
    k, place = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    base = unit[place] * 2
    last = np.zeros((len(tables), len(pos)), np.int64)
    lanes, n = np.arange(len(pos)), len(pos)
    while n:
        w = window[np.minimum(pos >> 3, len(b) - 5)] << (pos & 7)
        found = look[((base + (k > 0)) << 16) + (w >> 24 & 0xFFFF)]
        bits, run, s = found >> 8, found >> 4 & 15, found & 15
        if not bits.all():
            raise ValueError("no code fits the data")
        v = w >> (40 - bits - s) & ((1 << s) - 1)
        v -= (v < (1 << s >> 1)) * ((1 << s) - 1)
        pos += bits + s
        dc = k == 0
        if dc.any():
            at = np.flatnonzero(dc)
            component = unit[place[at]]
            last[component, lanes[at]] += v[at]
            v[at] = last[component, lanes[at]]
        stop = (s == 0) & ~dc & (run == 0)
        k = np.where(dc, 0, k + run)
        write = np.flatnonzero((s > 0) & (k < 64) | dc)
        out[block[write] * 64 + k[write]] = v[write]
        k += 1
        ended = np.flatnonzero(stop | (k >= 64))
        if len(ended):
            k[ended] = 0
            block[ended] += 1
            left[ended] -= 1
            place[ended] = (place[ended] + 1) % len(unit)
            base[ended] = unit[place[ended]] * 2
            if not left[ended].all():
                going = left > 0
                pos, left, block, k, place, base, lanes = (x[going] for x in (pos, left, block, k, place, base, lanes))
                n = len(pos)
    return out.reshape(total, 64)


def thumbnail(image: Image) -> np.ndarray:
    """Luminance with a pixel for each block of the first component, from the DC coefficients alone."""
    across, down = image.grid
    if len(image.components) == 1:
        a = d = 1
    else:
        a, d = image.components[0][1:3]
    dc = image.blocks[:, : a * d, 0].reshape(down, across, d, a).transpose(0, 2, 1, 3).reshape(down * d, across * a)
    return np.clip(128 + dc.astype(np.int64) * int(image.quantisers[image.components[0][3]][0]) // 8, 0, 255).astype(np.uint8)


def thumbnail_hash(pixels: np.ndarray, side: int = 8) -> int:
    """Average hash: which of 8x8 cells of the thumbnail are above their mean."""
    rows, cols = (np.arange(side) * n // side for n in pixels.shape)
    cells = np.add.reduceat(np.add.reduceat(pixels.astype(np.int64), rows, axis=0), cols, axis=1)
    tall, wide = (np.maximum(1, np.diff(x, append=n)) for x, n in zip((rows, cols), pixels.shape, strict=True))
    small = cells / np.outer(tall, wide)
    return int("".join("1" if x else "0" for x in (small * small.size > small.sum()).ravel()), 2)


def payload(image: Image) -> tuple[bytes, int]:
    """(padded payload, unpadded length) of a file made by ``encode``."""
    n = int(image.comment.removeprefix(b"bytes="))
    units = max(1, -(-n // UNIT))
    return (image.blocks[:units].reshape(-1) + np.int16(128)).astype(np.uint8).tobytes(), n


def _groups(column: pa.Array, most: int = tv.CHUNK):
    """(first row, values as bytes) of consecutive rows of about so many bytes."""
    lo, size, group = 0, 0, []
    for i, x in enumerate(column):
        value = x.as_py()
        value = b"" if value is None else value.encode() if isinstance(value, str) else value
        if group and size + len(value) > most:
            yield lo, group
            lo, size, group = i, 0, []
        group.append(value)
        size += len(value)
    if group:
        yield lo, group


def encode_media(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``media``, the JPEG file of each text; a null text is an empty one."""

    def run(batches):
        for b in batches:
            for lo, texts in _groups(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(texts)), pa.array(encode(texts), pa.binary())], ["doc_id", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """What the stored files say, per row of ``(doc_id, media)``: see ``media_columns``."""
    kinds = {
        "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(),
        "feature": pa.string(), "width": pa.int64(), "height": pa.int64(), "thumbnail_sha256": pa.string(),
    }

    def run(batches):
        for b in batches:
            for lo, files in _groups(b.column(1)):
                rows = []
                for file, image in zip(files, decode(files), strict=True):
                    kept, n = payload(image)
                    pixels = thumbnail(image)
                    feature = f"{image.width}x{image.height}:{thumbnail_hash(pixels):016x}"
                    rows.append((
                        n, len(kept), hashlib.sha256(kept).hexdigest(), zlib.crc32(kept[-16:]), len(file), hashlib.sha256(file).hexdigest(),
                        feature, image.width, image.height, hashlib.sha256(pixels.tobytes()).hexdigest(),
                    ))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, len(files)), *columns], ["doc_id", *kinds])

    schema = "doc_id long, " + ", ".join(f"{k} {'string' if t == pa.string() else 'long'}" for k, t in kinds.items())
    return media.select("doc_id", "media").mapInArrow(run, schema)


def media_columns(docs: DataFrame) -> DataFrame:
    """Each text stored as a JPEG file and read back: ``doc_id``, ``n_bytes``, ``payload_bytes``, ``payload_sha256``, ``tail_crc32``,
    ``media_bytes``, ``media_sha256``, ``feature`` (dimensions and average hash of the thumbnail), ``width``, ``height``, ``thumbnail_sha256``.

    A null, empty or blank text is stored like any, a null one as an empty one; repeated rows are each returned, equal texts with equal values; an
    empty table gives an empty result; other columns are ignored. Texts beyond 12 GB do not fit in a file and raise.
    """
    return media_features(encode_media(docs))
