import random
import re
from itertools import combinations

import pytest

from siftlode.llm import line_dedup as ld

ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u9fff\uff00-\uffef\U00020000-\U00033fff"
WORD = re.compile(rf"[{ALONE}]|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F{ALONE}]+")


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in range(2))
        assert ld.edit_distance(a, b) == slow_distance(a, b)
    long = [str(i) for i in range(3000)]
    assert ld.edit_distance(long, [*long[:70], "x", *long[71:2000], *long[2003:]]) == 4


def form(line):
    return tuple(WORD.findall("".join(c.lower() if c < "\x80" else c for c in line)))


def similar(a, b):
    room = max(len(a), len(b)) // 5
    return abs(len(a) - len(b)) <= room and len(set(a) - set(b)) <= room and len(set(b) - set(a)) <= room and slow_distance(a, b) <= room


def brute(rows, least=1):
    """Kept lines by row, for rows with different ids, by edit similarity alone; lines of fewer than ``least`` words stay."""
    forms = sorted({f for _, t in rows for line in (t or "").split("\n") if len(f := form(line)) >= least})
    parent = {f: f for f in forms}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in combinations(forms, 2):
        if similar(a, b):
            parent[root(a)] = root(b)
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[key] = None
            continue
        kept = []
        for line in text.split("\n"):
            f = form(line)
            if len(f) < least or root(f) not in seen:
                kept.append(line)
            if len(f) >= least:
                seen.add(root(f))
        out[key] = "\n".join(kept)
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(k, t, 7) for k, t in rows], "doc_id long, text string, n_lines int").repartition(3)
    return ld.dedup_lines(df, **options).collect()


def edited(rng, base, edits, vocabulary):
    """The line with so many edits at different places."""
    line = list(base)
    for at in sorted(rng.sample(range(len(line)), edits), reverse=True):
        line[at : at + rng.choice([0, 1, 1, 1])] = rng.choice([[], [rng.choice(vocabulary)], [rng.choice(vocabulary)]])
    return line


def test_lines_that_one_edit_tells_apart_all_go(spark):
    """Lines of up to nine words: the result is that of brute force."""
    rng = random.Random(12)
    vocabulary = [f"word{i}" for i in range(500)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9]))] for _ in range(60)]
    rows = []
    for key in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(bases)
            if rng.random() < 0.7:
                line = edited(rng, line, 1, vocabulary)
            lines.append(rng.choice([" ", ", "]).join(line[:9]).capitalize() if rng.random() < 0.8 else rng.choice(["", "one", "--"]))
        rows.append((key, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, " ".join(vocabulary * 40)), (204, " ".join(["new", *vocabulary * 40]))]
    assert {r.doc_id: r.text for r in run(spark, rows)} == brute(rows)


@pytest.mark.parametrize("share, least", [(0.05, 0.99), (0.1, 0.98), (0.15, 0.95), (0.2, 0.9)])
def test_recall_against_edit_similarity(spark, share, least):
    """Of pairs of lines of 10 to 200 words with so many edits, at least the documented share is linked."""
    rng = random.Random(int(share * 100))
    vocabulary = [f"word{i}" for i in range(3000)]
    rows, pairs = [], 0
    for n in (10, 12, 15, 20, 25, 30, 40, 60, 100, 200):
        for _ in range(30):
            base = [rng.choice(vocabulary) for _ in range(n)]
            other = edited(rng, base, max(1, int(share * n)), vocabulary)
            if base != other and similar(tuple(base), tuple(other)):
                pairs += 1
                rows += [(2 * pairs, " ".join(base)), (2 * pairs + 1, " ".join(other))]
    gone = sum(r.n_dropped for r in run(spark, rows))
    assert pairs > 200 and least * pairs <= gone <= pairs


def changed_at(rng, base, places, vocabulary):
    return [rng.choice(vocabulary) if i in places else w for i, w in enumerate(base)]


@pytest.mark.parametrize("least, lengths", [(1.0, (10, 11, 12, 13, 14, 15)), (0.9, (16, 18, 20, 25, 30, 40)), (0.75, (60, 100, 200))])
def test_recall_of_edits_at_regular_places(spark, least, lengths):
    """Every fifth word changed: as many edits as the bound allows, and as few words between them as can be."""
    rng = random.Random(31)
    vocabulary = [f"word{i}" for i in range(3000)]
    rows, pairs = [], 0
    for n in lengths:
        for start in (2, 3, 4):
            for _ in range(12):
                base = [rng.choice(vocabulary) for _ in range(n)]
                other = changed_at(rng, base, set(range(start, n, 5)[: n // 5] if len(range(start, n, 5)) > n // 5 else range(start, n, 5)), vocabulary)
                if similar(tuple(base), tuple(other)):
                    pairs += 1
                    rows += [(2 * pairs, " ".join(base)), (2 * pairs + 1, " ".join(other))]
    gone = sum(r.n_dropped for r in run(spark, rows))
    assert pairs > 80 and least * pairs <= gone <= pairs


def test_lines_of_eight_to_fifteen_words_equal_brute_force(spark):
    rng = random.Random(17)
    vocabulary = [f"word{i}" for i in range(900)]
    rows = []
    for k in range(150):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(10, 15))]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(changed_at(rng, base, set(rng.sample(range(len(base)), rng.randint(1, len(base) // 5))), vocabulary)))]
    assert {r.doc_id: r.text for r in run(spark, rows)} == brute(rows)


def test_forms_filled_in(spark):
    """Lines of 24 words of which 18 are those of all: copies with one word changed are found among them."""
    rng = random.Random(23)
    vocabulary = [f"word{i}" for i in range(4000)]
    form_words = [f"form{i}" for i in range(18)]
    rows, pairs = [], 200
    for k in range(pairs):
        own = [rng.choice(vocabulary) for _ in range(6)]
        base = [*form_words[:9], *own, *form_words[9:]]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(changed_at(rng, base, {rng.randrange(24)}, vocabulary)))]
    # a changed word leaves 23 of 24; other forms share 18, which is too few but for chance
    want = sum(not t for t in brute(rows).values())
    gone = sum(r.n_dropped for r in run(spark, rows))
    assert pairs <= want < 1.03 * pairs and 0.97 * want <= gone <= want


def test_scripts_without_blanks(spark):
    rng = random.Random(3)
    han = "".join(rng.sample([chr(c) for c in range(0x4E00, 0x5000)], 60))
    thai = "".join(rng.choice([chr(c) for c in range(0x0E01, 0x0E2F)]) for _ in range(40))
    rows = [(0, "one\n" + han + "。"), (1, "One,\ntwo\n--\n"), (2, han[:20] + "一" + han[21:] + "\n--\ntwo"), (3, thai), (4, thai + "\n\U00020001\U00020002 né"), (5, thai[:30] + "né\n\U00020001\U00020002né")]
    assert form("né漢字\U00020001x") == ("né", "漢", "字", "\U00020001", "x")
    assert {r.doc_id: r.text for r in run(spark, rows)} == brute(rows)


def test_a_passage_that_many_lines_share(spark):
    """Lines that share a passage and nothing else stay; those among them that are alike go."""
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(12)]
    bases = [[*passage, *(rng.choice(vocabulary) for _ in range(30))] for _ in range(150)]
    lines = bases + [[*b[:20], "other", *b[21:]] for b in bases[:60]]
    rows = [(i, " ".join(x)) for i, x in enumerate(lines)]
    got = {r.doc_id: r.text for r in run(spark, rows)}
    want = brute(rows)
    assert sum(got[k] != want[k] for k in want) <= 1 and all(got[i] for i in range(150))


def test_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b\na b", "mine", "x", 5), (2, "a b", "yours", "y", 6)], "doc_id long, text string, __key string, __ROW string, __n int")
    got = sorted(map(tuple, ld.dedup_lines(df).select("doc_id", "text", "__key", "__ROW", "__n", "n_left").collect()))
    assert got == [(1, "a b", "mine", "x", 5, 1), (2, "", "yours", "y", 6, 0)]


def test_repeats_and_nulls(spark):
    rows = [(1, "a b c\nx y z"), (1, "a b c\nx y z"), (2, "q r s\na b c"), (None, "only here now"), (3, "only here now\nkept line")]
    got = run(spark, rows)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped, r.n_left) for r in got), key=str) == sorted(
        [(1, "a b c\nx y z", 2, 0, 2), (1, "a b c\nx y z", 2, 0, 2), (2, "q r s", 2, 1, 1), (None, "only here now", 1, 0, 1), (3, "kept line", 2, 1, 1)], key=str
    )
    assert run(spark, []) == []
