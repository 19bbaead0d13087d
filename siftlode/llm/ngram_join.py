"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct word shingles as 64-bit hashes. Two sets with Jaccard similarity of at
least ``num/den`` differ in at most D = s(den - num) // (den + num) shingles, s being the sum of their sizes.
The sketch of a set is a row of 64-bit parity words: every shingle is XORed into the word its hash selects, so
the number of words in which two sketches differ never exceeds the symmetric difference. Of K non-empty words
of a sketch, a linked one has at least K - D (pigeonhole), so that each needs only the D + 1 of its words that
are rarest in the corpus: the K - D - 1 most frequent ones, such as those holding nothing but a passage that
many documents share, are spared. Sketches are made per band of D, from a geometric ladder, and joined on
(band, word position, word). A set with D non-empty words or fewer emits, besides, the prefix of its sorted
hashes, which is complete by itself. Candidates are verified on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm import textvec as tv
from siftlode.llm.components import PART_BITS, link_components
from siftlode.llm.workspace import Workspace, checked_join, fresh, small_batches

_U = np.uint64
#: Growth of the ladder of bands.
LADDER = 1.6
_SHORT = _U(0xD6E8FEB86659FD93)
_WEIGH = _U(0x9E3779B97F4A7C15)
#: Bits of a key that hold its band; no band has the number 0.
PART = _U(PART_BITS)


def ladder() -> list[int]:
    """Largest symmetric difference of each band: 0, 1, 2, 4, ... by the rule of growth."""
    out = [0, 1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * LADDER)))
    return out


_CAPS = np.array(ladder())


def shingle_sets(texts, k: int):
    """(row, sorted distinct uint64 shingles) of each text that has words."""
    for lo, hi, data, offsets in tv.chunks(texts):
        data = tv.LOWER[data]
        starts, ends = tv.spans(data, offsets, tv.NOT_WHITE)
        h = tv.hashes(data, starts, ends)
        first, number = tv.counts_by_text(tv.owners(offsets, starts), hi - lo)
        g = np.empty(0, _U)
        if len(h) >= k:
            g = h[: len(h) - k + 1].copy()
            for j in range(1, k):
                g = g * _WEIGH + h[j : len(h) - k + 1 + j]
            g = tv.mix(g)
        for row in np.flatnonzero(number):
            a, n = int(first[row]), int(number[row])
            if n >= k:
                u = np.sort(g[a : a + n - k + 1])
                yield lo + row, u[np.concatenate([[True], u[1:] != u[:-1]])]
            else:
                own = _SHORT
                with np.errstate(over="ignore"):
                    for x in h[a : a + n]:
                        own = own * _WEIGH + x
                yield lo + row, tv.mix(np.array([own], _U))


def digest(u: np.ndarray) -> int:
    return int((tv.mix(u ^ _SHORT).sum(dtype=_U) + _U(len(u))).view(np.int64))


def band_keys(u: np.ndarray, num: int, den: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Join keys of a set: the words of its sketch in each band where a partner could be, the band in the low
    bits; and (band, number of words that can be spared) where there are any."""
    n = len(u)
    bound = lambda m: (n + m) * (den - num) // (den + num)
    bands = np.searchsorted(_CAPS, [bound(-(-n * num // den)), bound(n * den // num)])
    mixed, high, keys, few = tv.mix(u), u >> _U(32), [], False
    spare = []
    for j in range(max(1, bands[0]), bands[1] + 1):  # band 0 holds equal sets alone
        cap = int(_CAPS[j])
        words = _U((cap + 1) * 105 // 100 + 3)
        slot = (high * words) >> _U(32)  # ascends with u
        at = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        parity = np.bitwise_xor.reduceat(mixed, at)
        keys.append((tv.mix(parity + tv.mix(slot[at] + (_U(j) << _U(48)) + _U(1))) & ~PART) | _U(j))
        few |= len(at) <= cap
        if len(at) > cap + 1:
            spare.append((j, len(at) - cap - 1))
    if few:
        keys.append(tv.mix(u[: n - -(-n * num // den) + 1] ^ _WEIGH) & ~PART)
    return (np.concatenate(keys) if keys else np.empty(0, _U)), spare


def sketches(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc_id, row, n_shingles, node, keys, spare) per row ``(doc_id, text, row)``; node, the digest of the set, is null for an empty one."""

    def run(batches):
        for b in tv.pieces(batches, 1):
            rows = b.num_rows
            n, node, some = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, bool)
            keys: list[np.ndarray] = []
            spare: list[list] = [[]] * rows
            sizes = np.zeros(rows, np.int64)
            for row, u in shingle_sets(b.column(1), k):
                n[row], node[row], some[row] = len(u), digest(u), True
                got, spare[row] = band_keys(u, num, den)
                keys.append(got)
                sizes[row] = len(got)
            flat = tv.signed(np.concatenate(keys)) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n), pa.array(node, mask=~some), tv.list_array(flat, sizes, pa.int64()), pa.array([[{"part": j, "spare": x} for j, x in row] for row in spare], kind)],
                ["doc_id", "row", "n_shingles", "node", "keys", "spare"],
            )

    kind = pa.list_(pa.struct([("part", pa.int64()), ("spare", pa.int64())]))
    return docs.mapInArrow(run, "doc_id long, row long, n_shingles long, node long, keys array<long>, spare array<struct<part: long, spare: long>>")


def sets_of(docs: DataFrame, k: int) -> DataFrame:
    """(node, grams) of each row."""

    def run(batches):
        for b in tv.pieces(batches, 1):
            nodes, sets = [], []
            for _, u in shingle_sets(b.column(1), k):
                nodes.append(digest(u))
                sets.append(u)
            flat = tv.signed(np.concatenate(sets)) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), tv.list_array(flat, [len(u) for u in sets], pa.int64())], ["node", "grams"])

    return docs.mapInArrow(run, "node long, grams array<long>")


def overlapping(rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` among rows with ``left_grams`` and ``right_grams`` that link."""

    def run(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            cols = []
            for name in ("left_grams", "right_grams"):
                col = b.column(name)
                cols.append((np.asarray(col.flatten()), np.asarray(col.offsets) - col.offsets[0].as_py()))
            for i in range(b.num_rows):
                x, y = (v[o[i] : o[i + 1]] for v, o in cols)
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = den * common >= num * (len(x) + len(y) - common)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return rows.mapInArrow(run, "a long, b long")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, row, n_shingles, node)`` per row, and ``(node, comp)`` of the nodes that link with any other.

    node stands for the set, and is null for an empty one; row hashes id and text.
    """
    ws = Workspace(docs.sparkSession, "ngram-join")
    small_batches(ws.spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # equal texts have equal sets, and a text's hash tells its row apart where ids are null or repeated
    base = base.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    rows = ws.write(sketches(base, k, num, den), "sketches")
    heads = ws.write(rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row")), "heads")
    chosen = rows.join(heads.select("node", "row"), ["node", "row"], "left_semi").select("node", "n_shingles", "keys", "spare")
    keyed = chosen.select(F.explode("keys").alias("key"), "node", F.col("n_shingles").alias("size"))
    spare = chosen.select("node", F.inline("spare")).distinct()

    def sets(nodes: DataFrame, step: str) -> DataFrame:
        wanted = ws.write(heads.join(nodes, "node", "left_semi").select("node", "row"), f"wanted-{step}")
        found = checked_join(base, wanted.select("row").distinct(), "row", "left_semi", 16 * wanted.count())
        return sets_of(found.select("doc_id", "text"), k).join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])

    def verify(pairs: DataFrame, step: str) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        grams = ws.write(sets(nodes, step), f"sets-{step}")
        left = grams.select(F.col("node").alias("a"), F.col("grams").alias("left_grams"))
        right = grams.select(F.col("node").alias("b"), F.col("grams").alias("right_grams"))
        return overlapping(pairs.join(left, "a").join(right, "b").select("a", "b", "left_grams", "right_grams"), num, den)

    def tokens(nodes: DataFrame, step: str) -> DataFrame:
        # a linked set has num/den of this one's shingles at least
        n = F.size("grams")
        return sets(nodes, step).select("node", F.explode("grams").alias("token"), (n - F.ceil(n * F.lit(num) / F.lit(den)) + 1).alias("prefix"), n.alias("size"))

    def overlap(n, m):
        return F.ceil((n + m) * F.lit(num) / F.lit(num + den))

    def fits(n, m):
        return F.least(n, m) * den >= F.greatest(n, m) * num

    labels = link_components(ws, keyed, verify, fits, tokens, overlap, spare)
    rows = ws.write(rows.select("doc_id", "row", "n_shingles", "node"), "rows")
    labels = ws.write(labels, "labels")
    ws.keep("rows", "labels")
    return rows, labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Row by row: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable over links.

    Texts lower-case A-Z and split at space and 09-0D. A set holds the distinct k-word shingles; a text of fewer words
    is one shingle; a null, empty or blank text has an empty set, links with nothing and is its own component. Sets
    link when den * |intersection| >= num * |union|, equal sets always. A row with a null id takes part, but its
    component is named by the other rows; where all ids are null, so is the component. Rows that repeat an id are each
    returned, with the component of their own text. Texts of any length are read whole. Other columns are ignored, whatever their names;
    an empty table gives an empty result. Sets are compared by 64-bit hashes of shingles.
    """
    rows, labels = components(docs, id_col, text_col, **options)
    known = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    named = known.join(labels, "node", "left").select("node", "doc_id", F.coalesce("comp", "node").alias("comp"))
    lowest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    names = named.join(lowest, "comp").select("node", "component_id")
    whole = rows.select("doc_id", "n_shingles", "node").join(names, "node", "left")
    return whole.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)``, of each component only one: the smallest id's, null last, of these the smallest hash of id and text.

    Rows with empty sets all stay. Of rows that repeat id and text the first by their other columns stays. Columns keep their names and order.
    """
    rows, labels = components(docs, **options)
    ws = Workspace(docs.sparkSession, "ngram-kept")
    place = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row")
    whole = rows.filter("node is not null").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    kept = whole.groupBy("comp").agg(F.min(place).alias("kept"))
    kept = whole.join(kept, "comp").filter(F.col("row") == F.col("kept.row")).groupBy("row").agg(F.count("*").alias("n"))
    kept = ws.write(kept.union(rows.filter("node is null").select("row", F.lit(1).cast("long")).distinct()), "kept")
    (row,) = fresh(docs.columns, "row")
    keyed = docs.withColumn(row, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    chosen = lambda some: checked_join(keyed, some.select(F.col("row").alias(row)), row, "left_semi", 16 * some.count())
    single, several = chosen(kept.filter("n = 1")).select(*docs.columns), kept.filter("n > 1")
    if not several.limit(1).count():
        return single
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = chosen(several).groupBy("doc_id", "text").agg(*([F.min(F.struct(*others)).alias(row)] if others else []))
    return single.union(first.select(*(F.col(c) if c in ("doc_id", "text") else F.col(f"{row}.`{c}`") for c in docs.columns)))
