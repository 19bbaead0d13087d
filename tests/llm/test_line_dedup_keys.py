"""Keys of lines: every similar pair shares one, and a line has far fewer than it has runs."""

import random

import numpy as np

from siftlode.llm import line_dedup as ld
from test_line_dedup import edited, similar


def keys_of(lines):
    numbers = np.array([len(x) for x in lines])
    words = np.array([w for x in lines for w in x], np.uint32)
    guess = ld.Guess.of(words, numbers, 1)
    line, key = ld.line_keys(words, numbers, guess)
    return [set(key[line == i].tolist()) for i in range(len(lines))]


def test_similar_lines_share_a_key():
    rng = random.Random(41)
    passage = [rng.randrange(10**9) for _ in range(12)]
    for vocabulary in (range(1, 12), range(1, 300), range(1, 10**9)):
        words = lambda n: [rng.choice(vocabulary) for _ in range(n)]  # noqa: E731, B023
        lines = []
        for n in [*range(4, 30), 40, 57, 100, 200] * 6:
            line = words(n) if rng.random() < 0.7 else words(n - n // 2) + passage[: n // 2]
            room = max(1, len(line) // 5)
            lines += [line, edited(rng, line, rng.randint(1, room), vocabulary), [*line, *words(len(line) // 4)]]
        keys, pairs = keys_of(lines), 0
        for i in range(0, len(lines), 3):
            for a, b in ((i, i + 1), (i, i + 2), (i + 1, i + 2)):
                if lines[a] != lines[b] and similar(lines[a], lines[b]):
                    pairs += 1
                    assert keys[a] & keys[b], (lines[a], lines[b])
        assert pairs > 150


def test_few_keys_for_long_lines():
    rng = random.Random(43)
    vocabulary = [rng.randrange(1, 1 << 32) for _ in range(2000)]
    lines = [[rng.choice(vocabulary) for _ in range(57)] for _ in range(2000)]
    # all runs of four words were 54
    assert sum(map(len, keys_of(lines))) < 36 * len(lines)
