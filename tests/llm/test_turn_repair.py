import hashlib
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from siftlode.llm import registry
from siftlode.llm import turn_repair as tr

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\v\f\r"


def cheapest(turns):
    """By trying all edits with at most four insertions: (cost, letters, roles)."""
    found = []

    def go(i, roles, cost, letters, more):
        if i == len(turns) and GRAMMAR.match(roles):
            found.append((cost, letters, roles))
        if more:
            for r in "ua":
                go(i, roles + r, cost + 3, letters + "I", more - 1)
        if i < len(turns):
            must, initial, cut = turns[i]
            go(i + 1, roles, cost + 4, letters + "D", more)
            if not must:
                go(i + 1, roles + (initial or "?"), cost + 3 * cut, letters + "K", more)
                for r in "ua":
                    go(i + 1, roles + r, cost + 3 + 3 * cut, letters + "R", more)

    go(0, "", 0, "", 4)
    return min(found)


def letters_of(turns):
    return bytes(tr.MUST_GO if must else tr.code(initial, cut) for must, initial, cut in turns)


def test_plans_are_the_cheapest_and_first():
    rng = random.Random(5)
    for _ in range(150):
        turns = [(rng.random() < 0.2, rng.choice(["s", "u", "a", "u", "a", "x", ""]), rng.random() < 0.3) for _ in range(rng.randint(0, 5))]
        cost, walk = tr.plan(letters_of(turns))
        assert (cost, "".join(x for x, _ in walk)) == cheapest(turns)[:2]


def dense(turns):
    """Costs and first letters by a full table, without checkpoints, for long conversations."""
    nxt, end = (2, 2, 3, 2), [0, 6, 3, 0]
    table = [end]
    for must, initial, cut in reversed(turns):
        after = table[-1]
        row = []
        for s in range(4):
            ways = [4 + after[s]]
            if not must:
                kept = {"s": 1, "u": 2, "a": 3}.get(initial)
                if kept == nxt[s] or kept == 1 and s == 0:
                    ways.append(3 * cut + after[kept])
                ways.append(3 + 3 * cut + after[nxt[s]])
            row.append(min(ways))
        for _ in range(3):
            row = [min(row[s], 3 + row[nxt[s]]) for s in range(4)]
        table.append(row)
    return table[-1][0]


def test_long_conversations():
    rng = random.Random(2)
    for n in (1, 2, 99, 100, 101, 5000):
        turns = [(rng.random() < 0.1, rng.choice("suauax"), rng.random() < 0.2) for _ in range(n)]
        cost, walk = tr.plan(letters_of(turns))
        letters = "".join(x for x, _ in walk)
        assert cost == dense(turns)
        # the letters say edits of that cost that give the grammar's roles
        at, paid, roles = 0, 0, ""
        for x in letters:
            legal = "a" if roles[-1:] == "u" else "u"
            if x == "I":
                roles, paid = roles + legal, paid + 3
                continue
            must, initial, cut = turns[at]
            at += 1
            paid += {"D": 4, "K": 3 * cut, "R": 3 + 3 * cut}[x]
            assert not must or x == "D"
            roles += {"D": "", "K": initial, "R": legal}[x]
        assert at == n and paid == cost and GRAMMAR.match(roles)


def by_hand(rows):
    """Query 11 in plain Python, for conversations small enough for ``cheapest``."""
    got = {}
    for conv, turn, role, text in rows:
        got.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            got[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    out = []
    for conv, turns in got.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in turns:
            full = text.rstrip(BLANK)
            faults.append("blank" if not full else "duplicate" if (role, text) in seen else "truncated" if full[-1] not in ".!?" else "")
            seen.add((role, text))
        if len(turns) > 6:
            continue
        cost, audit, roles = cheapest([(f in ("blank", "duplicate"), r[1][:1], f == "truncated") for f, r in zip(faults, turns, strict=True)])
        said, left = [], iter(turns)
        for x in audit:
            # one role of the sequence for each letter but D
            turn = None if x == "I" else next(left)
            if x != "D":
                role = "assistant" if roles[len(said)] == "a" else "user"
                said.append(f"{turn[1]}:{turn[2]}" if x == "K" else f"{role}:{turn[2] if turn else ''}")
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out.append((conv, gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv_id", *tr.NAMES)


def test_query_by_hand(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r.values()) for r in pq.read_table(f"{folder}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    want = by_hand(rows)
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in registry.queries()["op11_turn_repair"](spark, folder).collect()}
    assert len(got) == len({r[0] for r in rows}) and len(want) > 10
    assert sorted((got[r[0]] for r in want), key=str) == want


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rng = random.Random(7)
    some = lambda xs: rng.choice(xs)
    rows = [(some([None, *range(60)]), some([None, 0, 1, 2, 5]), some([None, "", "system", "user", "assistant", "User", "tool"]), some([None, "", " \t", "Done.", "Why?", "and then", "a. b", "Hi!\n", "x ."]), "k", "d") for _ in range(160)]
    rows += [(77, 1, "user", "again.", "k", "d")] * 3 + [(78, 0, "user", "long " * 50_000 + ".", "k", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, kind string, Digest string")
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in tr.repair(tr.damaged(df)).collect()}
    want = by_hand([r[:4] for r in rows])
    assert set(got) == {r[0] for r in rows} and len(want) > 40
    assert sorted((got[r[0]] for r in want), key=str) == want


def test_all_turns_dropped_and_no_rows(spark):
    gone = next(t for t in range(10_000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, gone, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in tr.repair(tr.damaged(df)).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert tr.repair(tr.damaged(df.limit(0))).collect() == []


@pytest.mark.parametrize("n", [3000])
def test_one_hot_conversation(spark, n):
    df = spark.range(n).selectExpr("1L as conv_id", "id % 700 as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('Line ', id % 50, if(id % 3 = 0, '', '.')) as text")
    row = tr.repair(df.withColumn("copy", tr.F.lit(1))).first()
    assert row.duplicate == n - len({(i % 2, i % 50, i % 3 == 0) for i in range(n)}) and row.audit.count("D") >= row.duplicate
