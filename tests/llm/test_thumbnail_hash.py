import numpy as np

from siftlode.llm import media_jpeg as mj


def test_every_pixel_has_a_part():
    rng = np.random.default_rng(1)
    for shape in [(8, 8), (16, 24), (33, 19), (3, 5), (1, 1)]:
        pixels = rng.integers(0, 256, shape).astype(np.uint8)
        rows, cols = ([i * n // 8 for i in range(9)] for n in shape)
        cells = [pixels[a : max(a + 1, b), c : max(c + 1, d)].mean() for a, b in zip(rows, rows[1:]) for c, d in zip(cols, cols[1:])]
        assert mj.thumbnail_hash(pixels) == int("".join("1" if x * 64 > sum(cells) + 1e-9 else "0" for x in cells), 2)
