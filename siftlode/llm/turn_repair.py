"""Repair of the structure of conversations by the cheapest edits.

Roles are to read as an optional system turn and then pairs of user and assistant. A turn is kept, given the
other role, or deleted, and turns without text are inserted. The least cost from a turn to the end is a vector
over four states, reckoned backwards. Vectors are stored for every square root of all turns only; walking
forward, those between two stored ones are reckoned again, and of the edits that keep to the least cost the
one with the first letter is taken.

Faults are column expressions; the first of equal turns is found by an aggregation. A task then reads each
conversation of its own twice in a row, as sorted rows: a letter for each turn first, then the texts, which
are hashed as they pass. So what it holds of a conversation is two letters a turn and the stored vectors.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Costs of the edits, and of a truncated turn that stays.
DELETE, REROLE, INSERT, CUT_OFF = 4, 3, 3, 3

# States: nothing yet, after system, after user, after assistant. For each, the state that the next turn of a pair leads to.
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_END = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 60

# What is known of a turn: whether it must go, else the state that its role leads to and whether it is truncated.
MUST_GO = 0
_INITIALS = "sua"


def code(initial: str, truncated: bool) -> int:
    """The letter of a turn that may stay: 1 to 8, by its role's initial."""
    return 1 + 2 * (1 + _INITIALS.find(initial) if initial else 0) + truncated


def _edits(turn: int, state: int, after: tuple) -> Iterator[tuple[str, int, int]]:
    """(letter, cost to the end, next state) of what may be done with a turn, in the order of letters."""
    yield "D", DELETE + after[state], state
    if turn != MUST_GO:
        more, way = CUT_OFF * ((turn - 1) & 1), _NEXT[state]
        kept = (turn - 1) >> 1
        if kept == way or kept == 1 and state == 0:
            yield "K", more + after[kept], kept
        yield "R", REROLE + more + after[way], way


class Costs:
    """Vectors of least costs, each less its own minimum; there are few different ones, so that each step is reckoned once."""

    def __init__(self):
        self.steps: dict = {}
        self.walks: dict = {}

    def back(self, turn: int, after: tuple) -> tuple:
        """The vector before a turn."""
        if (turn, after) not in self.steps:
            used = [min(c for _, c, _ in _edits(turn, s, after)) for s in range(4)]
            # an inserted turn leads to another state, of which no more than two are of use
            for _ in range(2):
                used = [min(used[s], INSERT + used[_NEXT[s]]) for s in range(4)]
            self.steps[turn, after] = tuple(c - min(used) for c in used), min(used)
        return self.steps[turn, after]

    def forward(self, turn: int, after: tuple, state: int) -> tuple[str, int]:
        """(letters, next state) of the first cheapest edits for a turn: insertions, then what becomes of it."""
        if (turn, after, state) not in self.walks:
            vector, least = self.back(turn, after)
            letters, now = "", state
            while True:
                left = vector[now] + least
                fits = [(x, to) for x, c, to in _edits(turn, now, after) if c == left]
                if INSERT + vector[_NEXT[now]] == vector[now]:
                    fits.append(("I", _NEXT[now]))
                letter, now = min(fits)
                letters += letter
                if letter != "I":
                    break
            self.walks[turn, after, state] = letters, now
        return self.walks[turn, after, state]


def plan(turns: bytes | bytearray, costs: Costs | None = None) -> tuple[int, Iterator[tuple[str, int]]]:
    """(least cost, (letters, state after them) for each turn, and for the end), for the letters of a conversation's turns."""
    costs, n = costs or Costs(), len(turns)
    size = max(1, math.isqrt(n))
    vector, total = _END, 0
    stored = {n: vector}
    for i in range(n - 1, -1, -1):
        vector, more = costs.back(turns[i], vector)
        total += more
        if i % size == 0:
            stored[i] = vector

    def walk():
        state = 0
        for lo in range(0, n, size):
            hi = min(lo + size, n)
            block = [stored[hi]]
            for i in range(hi - 1, lo, -1):
                block.append(costs.back(turns[i], block[-1])[0])
            for i in range(lo, hi):
                letters, state = costs.forward(turns[i], block.pop(), state)
                yield letters, state
        letters = ""
        while _END[state]:
            letters, state = letters + "I", _NEXT[state]
        yield letters, state

    return total + vector[0], walk()


# Kinds of rows, in the order in which a task reads them.
_FIRST, _DROPPED, _BLANK, _TRUNCATED, _SOUND, _TEXT = range(6)


class _Conversation:
    """What a task holds of one conversation while its rows pass."""

    def __init__(self, conv_id, costs: Costs):
        self.id, self.costs = conv_id, costs
        self.turns = bytearray()
        self.low = self.high = self.turn = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.before = self.walk = None
        self.cost, self.audit, self.sha, self.said = 0, [], hashlib.sha256(), False

    def see(self, kind: int, turn, role: str, digest: bytes) -> None:
        if kind == _FIRST:
            self.first = turn, role, digest
        if kind in (_FIRST, _DROPPED):
            return
        initial = role[:1]
        fresh, self.first = self.first == (turn, role, digest), None
        if kind == _BLANK:
            self.blank += 1
        elif not fresh:
            self.duplicate += 1
        elif kind == _TRUNCATED:
            self.truncated += 1
        self.turns.append(MUST_GO if kind == _BLANK or not fresh else code(initial, kind == _TRUNCATED))
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
            self.distinct += 1

    def _say(self, role: str, text: str = "") -> None:
        if self.said:
            self.sha.update(b"\n")
        self.said = True
        self.sha.update(f"{role}:{text}".encode())

    def _insert(self, letters: str, state: int) -> int:
        """Say the turns inserted from a state on; the state after them."""
        for _ in range(letters.count("I")):
            state = _NEXT[state]
            self._say(_ROLE[state])
        return state

    def tell(self, role: str, text: str) -> None:
        """The next turn's text, in the order of ``see``."""
        if self.walk is None:
            self.cost, self.walk = plan(self.turns, self.costs)
            self.state = 0
        letters, state = next(self.walk)
        self._insert(letters, self.state)
        if letters[-1] == "K":
            self._say(role, text)
        elif letters[-1] == "R":
            self._say(_ROLE[state], text)
        self.audit.append(letters)
        self.state = state

    def row(self) -> tuple:
        if self.walk is not None:
            letters, _ = next(self.walk)
            self._insert(letters, self.state)
            self.audit.append(letters)
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return self.id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest()


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _repaired(rows: Iterable[tuple], costs: Costs) -> Iterator[tuple]:
    """One row for each conversation of sorted (conv_id, kind, turn, role, digest, text)."""
    now = None
    for conv_id, kind, turn, role, digest, text in rows:
        if now is None or now.id != conv_id:
            if now is not None:
                yield now.row()
            now = _Conversation(conv_id, costs)
        if kind == _TEXT:
            now.tell(role, text)
        else:
            now.see(kind, turn, role, digest)
    if now is not None:
        yield now.row()


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) with faults by crc32 of ``conv_id:turn``: of twenty remainders 0 drops a turn (``copy`` 0, all else null), 1 empties
    its text, 2 takes its ``.!?`` away, 3 repeats it and 4 makes its role user. Null roles and texts are a blank, and so are null parts of the key."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), h.alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    kept = lambda c: F.when(F.col("h") != 0, c)
    rows = rows.select("conv_id", kept(F.col("turn")).alias("turn"), kept(F.when(F.col("h") == 4, "user").otherwise(F.col("role"))).alias("role"), kept(text).alias("text"), "h")
    copies = F.when(F.col("h") == 0, F.array(F.lit(0))).when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).drop("h")


def repair(turns: DataFrame) -> DataFrame:
    """Per ``conv_id`` of (conv_id, turn, role, text, copy): ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    Turns are taken by ``turn``, nulls first; turns with equal numbers by role, then by the SHA-256 of their text. A turn's first fault counts. A conversation
    of which nothing but ``copy`` 0 is left has zeros, an empty ``audit`` and the hash of the empty string; a null ``conv_id`` is a conversation of its own.
    Null roles and texts count as a blank. Other columns are ignored; an empty table gives an empty result. One task reads a conversation, as its text
    has one hash, but holds no texts: two bytes a turn, besides the texts of an Arrow batch.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copy")
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    there = rows.filter("copy > 0")
    first = there.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("told"), "turn")).alias("least"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    kind = F.when(F.col("copy") == 0, _DROPPED).when(blank, _BLANK).when(ended, _SOUND).otherwise(_TRUNCATED)
    none = F.lit(None).cast("string")
    columns = ["conv_id", "kind", "turn", "role", "digest", "text"]
    passing = (
        first.select("conv_id", F.lit(_FIRST).alias("kind"), F.col("least.turn").alias("turn"), "role", "digest", none.alias("text"))
        .unionByName(rows.withColumn("kind", kind).withColumn("text", none).select(*columns))
        .unionByName(there.withColumn("kind", F.lit(_TEXT)).select(*columns))
    )
    dealt = passing.repartition("conv_id").sortWithinPartitions("conv_id", F.col("kind") == _TEXT, F.asc_nulls_first("turn"), "role", "digest", "kind")
    conv = turns.schema["conv_id"].dataType

    def run(batches):
        costs, out, size = Costs(), [], 0
        got = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True))

        def batch():
            cols = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays([pa.array(cols[0], from_spark), *(pa.array(c, k) for c, k in zip(cols[1:], kinds, strict=True))], ["conv_id", *NAMES])

        for row in _repaired(got, costs):
            out.append(row)
            size += len(row[7]) + 200
            if size > 1 << 20:
                yield batch()
                out, size = [], 0
        if out:
            yield batch()

    from pyspark.sql.pandas.types import to_arrow_type

    from_spark = to_arrow_type(conv)
    fields = ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'long'}" for n in NAMES)
    return dealt.mapInArrow(run, f"conv_id {conv.simpleString()}, {fields}")
