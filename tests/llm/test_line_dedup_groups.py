"""Keys with many members: like lines are held against one another once, and very large groups block by block."""

import random

import numpy as np
import pytest

from siftlode.llm import line_dedup as ld
from test_line_dedup import edited, similar


def test_members_of_many_shared_keys_are_one_group():
    """Each of the 30 keys that 40 lines share was a group of its own."""
    node = np.tile(np.arange(40), 30)
    key, got, size = ld._grouped(np.zeros(1200, np.int64), np.full(1200, 40), node, node + 5)
    assert len(set(key.tolist())) == 1 and got.tolist() == list(range(40)) and size.tolist() == list(range(5, 45))


@pytest.mark.parametrize("many", [8, 1024])
def test_blocks_find_what_whole_groups_do(spark, monkeypatch, many):
    monkeypatch.setattr(ld, "MANY", many)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(24)]
    lines = [base[:8] + edited(rng, base[8:], rng.randint(0, 9), vocabulary) for _ in range(120)]
    root = list(range(len(lines)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(lines)):
        for b in range(a):
            if lines[a] == lines[b] or similar(tuple(lines[a]), tuple(lines[b])):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    got = ld.dedup_lines(docs).filter("n_dropped > 0").collect()
    assert sorted(r.doc_id for r in got) == [i for i in range(len(lines)) if top(i) != i]
