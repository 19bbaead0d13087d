"""Longer lines whose every fifth word differs are all found: the edits leave a run of four words whole."""

import random

from siftlode.llm import line_dedup as ld


def test_long_lines_with_edits_at_the_worst_places(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**9)}"
    rows = []
    for i, n in enumerate((16, 20, 24, 35, 60, 100, 150, 200) * 6):
        line = [word() for _ in range(n)]
        other = [word() if j % 5 == 4 and j // 5 < n // 5 else w for j, w in enumerate(line)]
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(other))]
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got if r.n_dropped) == list(range(1, len(rows), 2))


def test_lines_of_one_key_that_no_first_member_reaches(spark):
    rng = random.Random(8)
    common = [f"c{j}" for j in range(4)]
    word = lambda: f"w{rng.randrange(10**9)}"
    rows, at = [], 0
    for i in range(60):
        line = [*common, *(word() for _ in range(12))]
        # three edits leave the run that all lines share, and no other
        other = [word() if j in (4, 8, 12) else w for j, w in enumerate(line)]
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(other[:13] + [line[13], line[14], line[15]]))]
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got if r.n_dropped) == list(range(1, len(rows), 2))
