"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone.

Sources share the total size by weight, no target above ``most`` times its source (water filling). Within a
source, documents stand in a fixed order of size; the prefix sum of their expected copies, moved by one random
offset, crosses integers, and a document is emitted once for each crossed within it. The few documents that are large
for their source are expected a whole number of times, each rounded with what the larger ones owe, so that they are
emitted just so often wherever the offset lies; the others share what is left of the target equally. Blocks of a
source, by size class and hash, are summed first, so that no window holds more than a block or one row per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlode.llm.workspace import Workspace, fresh

#: Weights of the sources in the order of their names, again and again.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Rows of a block, about.
BLOCK = 20_000
#: A document is large that has more than one in so many words of its source; there are fewer of them than that.
LARGE = 256


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size)`` to these and ``target``; null is the last source.

    A source is full if its limit, divided by its weight, lies below the level to which the others rise.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("rank", rank).withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(most))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    before, everything = rising.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", level).withColumn("own", F.col("limit") / F.col("weight"))
    # the level of the first source that is not full holds for all later ones
    holds = F.min(F.when(F.col("own") >= F.col("level"), F.struct("own", "rank", "level"))).over(everything)
    rows = rows.withColumn("level", F.coalesce(holds["level"], F.lit(float("inf"))))
    return rows.select("source", "source_size", F.least("limit", F.col("level") * F.col("weight")).alias("target"))


def plan(docs: DataFrame, seed: int = 11, weights=WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """One row per distinct source, id and text: ``source``, ``doc_id``, ``text_key``, ``rows``, ``size``,
    ``source_size``, ``target`` and ``copies``, which holds for each of its ``rows`` equal rows.

    size: words, separated by space and 09-0D (null text: 0). A source without any word has target 0 and copies
    0; a null source is one of its own, the last. The order within a source is by size, id and text, so reruns agree
    whatever the partitions. An empty table gives an empty result.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    light = docs.select("source", "doc_id", words.alias("size"), F.xxhash64("text").alias("text_key"))
    light = ws.write(light.groupBy("source", "doc_id", "text_key", "size").agg(F.count("*").alias("rows")), "sizes")
    sizes = light.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    shares = targets(sizes, weights, most)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    shares = ws.write(shares.withColumn("rate", rate), "shares")
    sized = same_keys(light, shares, "source").select("l.*", "source_size", "target", "rate")
    is_large = F.col("size") * F.col("rows") * LARGE > F.col("source_size")
    large = ws.write(rounded(sized.filter(is_large), most), "large")
    # the others' rate makes up for the rounding
    done = large.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("large_size"), F.sum(F.col("size") * F.col("rows") * F.col("copies")).alias("large_taken"))
    left = shares.alias("l").join(done.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")), "left").select("l.*", F.coalesce("large_size", F.lit(0)).alias("large_size"), F.coalesce("large_taken", F.lit(0)).alias("large_taken"))
    rest = F.col("source_size") - F.col("large_size")
    shares = left.withColumn("rate", F.when(rest > 0, F.least(F.greatest((F.col("target") - F.col("large_taken")) / rest, F.lit(0.0)), F.lit(float(most)))).otherwise(0.0))

    band = F.floor(F.log2(F.col("size") + 1) * 4).cast("long").alias("band")
    small = sized.filter(~is_large).select(*light.columns, band)
    bands = small.groupBy("source", "band").agg(F.count("*").alias("units"))
    blocks = bands.select("source", "band", F.ceil(F.col("units") / block).cast("long").alias("blocks"))
    own = F.pmod(F.xxhash64("doc_id", "text_key"), F.col("blocks")).alias("block")
    placed = same_keys(small, blocks, "source", "band").select("l.*", own)
    starts = placed.groupBy("source", "band", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("band", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("source", "band", "block").orderBy("size", "doc_id", "text_key")
    numbered = placed.withColumn("number", F.row_number().over(inside))
    numbered = same_keys(numbered, starts, "source", "band", "block").select(*(F.col(f"l.{c}") for c in light.columns), (F.col("start") + F.col("number")).alias("number"))
    rows = same_keys(numbered, shares, "source").select("l.*", "source_size", "target", "rate")
    offset = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    reached = lambda n: F.floor(n * F.col("rate") + offset)
    copies = F.least(reached(F.col("number")) - reached(F.col("number") - 1), F.lit(most)).cast("long")
    columns = ["source", "doc_id", "text_key", "rows", "size", "source_size", "target"]
    return rows.select(*columns, copies.alias("copies")).union(large.select(*columns, "copies"))


def rounded(large: DataFrame, most: int) -> DataFrame:
    """The large documents with whole ``copies``, from the largest on, each with what the ones before it were rounded off.

    A source has fewer than LARGE of them, which bounds its array.
    """
    names = ["doc_id", "text_key", "rows", "size", "source_size", "target", "rate"]
    weight = (F.col("size") * F.col("rows")).alias("weight")
    by_source = large.groupBy("source").agg(F.sort_array(F.collect_list(F.struct(weight, *names)), asc=False).alias("units"))
    unit = f"struct<weight: bigint, {', '.join(f'{n}: {t}' for n, t in large.select(*names).dtypes)}, copies: bigint>"
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast(f"array<{unit}>").alias("done"))

    def place(state, x):
        copies = F.least(F.greatest(F.floor(x["rate"] + state["owed"] / x["weight"] + 0.5), F.lit(0)), F.lit(most)).cast("long")
        owed = state["owed"] + (x["rate"] - copies) * x["weight"]
        done = F.struct(x["weight"].alias("weight"), *(x[n].alias(n) for n in names), copies.alias("copies")).cast(unit)
        return F.struct(owed.alias("owed"), F.concat(state["done"], F.array(done)).alias("done"))

    placed = by_source.select("source", F.aggregate("units", start, place)["done"].alias("done"))
    return placed.select("source", F.inline("done")).drop("weight")


def same_keys(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join as ``l`` and ``r`` in which null keys are equal."""
    on = F.lit(True)
    for k in keys:
        on &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.alias("l").join(right.alias("r"), on)


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words) per row of ``docs``."""
    units = plan(docs, **options)
    each = units.select("*", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("nth"))
    return each.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, whatever their names, each as often as the mix takes it.

    Rows that repeat source, id and text are taken equally often; null texts, ids and sources are values of their own.
    """
    key, copies, nth = fresh(docs.columns, "key", "copies", "nth")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    units = plan(docs, **options).filter("copies > 0").select("doc_id", "source", F.col("text_key").alias(key), F.col("copies").cast("int").alias(copies))
    both = same_keys(keyed, units, "doc_id", "source", key)
    return both.select(*(F.col(f"l.`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col(f"r.{copies}"))).alias(nth)).drop(nth)
