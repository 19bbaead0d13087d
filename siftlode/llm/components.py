"""Candidate pairs from shared keys, and connected components of verified links.

Keys may be shared by a third of all rows, so a key group is never turned into all of its pairs: its members
are first compared with one hub, which settles groups of copies, and those it does not reach with a few others.
Where a caller asks for it, the nodes of groups that are still of several components then meet on the rarest of their tokens only, as many as similarity demands (prefix filter), so that
what the members of a group have in common makes no pairs. All steps are joins and map-side combined aggregates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlode.llm.workspace import Workspace, checked_join

#: The low bits of a key that number its part.
PART_BITS = 63
#: Further members of a key group, at most, that those the hub does not reach are compared with; fewer where a complete search follows.
DELEGATES, FEW = 8, 2


def connected_components(ws: Workspace, links: DataFrame, name: str) -> DataFrame:
    """``links(a, b)`` to ``(node, comp)``, comp being the smallest node reachable; only linked nodes.

    Each round hooks the trees' roots and shortens all paths, so that rounds grow with the logarithm of the
    longest chain. Every round is written to the shared folder.
    """
    both = ws.write(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-both")
    labels = ws.write(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("comp")), f"{name}-0"
    )
    step = 0
    while True:
        step += 1
        # the smallest label among the neighbours, offered to the node and to the node's present root
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        offered = labels.join(seen, labels.node == seen.a).select("node", "comp", F.least("comp", "near").alias("low"))
        offers = offered.select("node", "low").union(offered.select(F.col("comp").alias("node"), "low"))
        lowered = offers.groupBy("node").agg(F.min("low").alias("comp"))
        parents = lowered.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        jumped = lowered.join(parents, "comp", "left").select("node", F.least("comp", F.coalesce("up", "comp")).alias("comp"))
        new = ws.write(jumped, f"{name}-{step}")
        moved = new.join(labels.select("node", F.col("comp").alias("was")), "node").filter("comp < was").limit(1).count()
        ws.drop(f"{name}-{step - 1}")
        labels = new
        if not moved:
            ws.drop(f"{name}-both")
            return labels


def link_components(
    ws: Workspace,
    members: DataFrame,
    verify: Callable[[DataFrame, str], DataFrame],
    fits: Callable[[Column, Column], Column],
    tokens: Callable[[DataFrame, str], DataFrame] | None = None,
    overlap: Callable[[Column, Column], Column] | None = None,
    spare: DataFrame | None = None,
) -> DataFrame:
    """Components of the nodes whose keys meet and whose pairs ``verify`` confirms.

    members: ``(key, node, size)``, longs, possibly repeated. verify: from distinct ``(a, b)`` and a name to the linked ones among them.
    fits: whether nodes of two sizes can link. tokens: from ``(node)`` and a name to ``(node, token, prefix, size)``, such that two linked
    nodes share one of the first ``prefix`` of their ``size`` tokens in any common order; overlap: how many they share at least, from their
    sizes; without tokens the nodes that neither the hubs nor the others of their keys reach stay apart. spare: ``(node, part, spare)`` for
    keys with their part in the low bits: of a node's keys of a part, so many can be left out, and the most frequent ones are.
    Returns ``(node, comp)`` for the nodes that link with any other.
    """
    # the high half of a node tells nodes apart in what is shuffled for each key
    half = F.shiftright("node", 32)
    groups = members.select("key", half.alias("half")).groupBy("key").agg(F.min("half").alias("lo"), F.max("half").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    groups = ws.write(groups.select("key", "n"), "groups")
    shared = ws.write(checked_join(members, groups, "key", "inner", 32 * groups.count()).select("key", "node", "size", "n").distinct(), "met")
    ws.settle()
    # the node that meets the most others is the likeliest centre of a group of copies
    weights = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    if spare is not None:
        frequent_first = Window.partitionBy("node", "part").orderBy(F.desc("n"), "key")
        ranked = shared.withColumn("part", F.col("key").bitwiseAND(PART_BITS)).withColumn("rank", F.row_number().over(frequent_first))
        shared = ranked.join(spare, ["node", "part"], "left").filter(F.col("rank") > F.coalesce("spare", F.lit(0)))
    shared = ws.write(shared.join(weights, "node").select("key", "node", "size", "weight"), "shared")
    ws.drop("met")
    ws.drop("groups")
    ws.settle()
    hubs = shared.groupBy("key").agg(F.max(F.struct("weight", "node", "size")).alias("hub")).select("key", F.col("hub.node").alias("hub"), F.col("hub.size").alias("hub_size"))
    near = fits(F.col("size"), F.col("hub_size"))
    pair = (F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    tried = ws.write(shared.join(hubs, "key").filter((F.col("node") != F.col("hub")) & near).select(*pair).distinct(), "pairs-0")
    ws.settle()
    links = ws.write(verify(tried, "0"), "links-0")
    ws.settle()
    labels = connected_components(ws, links, "comps-0")

    rest = _unsettled(ws, shared, labels, "rest-0")
    ws.drop("shared")
    if not rest.limit(1).count():
        return labels
    # members beyond the hub's reach meet a few others, of the largest component for the most part
    met = rest.groupBy("key", F.pmod("node", F.lit(DELEGATES if tokens is None else FEW)).alias("slot")).agg(F.min(F.struct("node", "size", "comp")).alias("hub"))
    met = met.select("key", F.col("hub.node").alias("hub"), F.col("hub.size").alias("hub_size"), F.col("hub.comp").alias("hub_comp"))
    pairs = rest.join(met, "key").filter((F.col("comp") != F.col("hub_comp")) & near).select(*pair).distinct()
    more = ws.write(pairs.join(tried, ["a", "b"], "left_anti"), "pairs-1")
    tried = tried.union(more)
    labels = _merged(ws, labels, ws.write(verify(more, "1"), "links-1"), "comps-1")
    if tokens is None:
        return labels
    rest = _unsettled(ws, rest.select("key", "node", "size"), labels, "rest-1")
    open_ = ws.write(rest.select("node", "comp").distinct(), "open")
    if not open_.limit(1).count():
        return labels
    own = ws.write(tokens(open_.select("node"), "open"), "tokens")
    often = own.groupBy("token").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("node").orderBy("n", "token")
    first = own.join(often, "token").withColumn("rank", F.row_number().over(rarest)).filter("rank <= prefix and n > 1")
    first = ws.write(first.join(open_, "node").select("token", "node", "comp", F.col("size") - F.col("rank") + 1, "size"), "prefixes")
    ws.drop("tokens")
    # behind the first token that two nodes share, so many of each are left
    room = F.least("ra", "rb") >= overlap(F.col("na"), F.col("nb"))
    both = first.toDF("token", "a", "ca", "ra", "na").join(first.toDF("token", "b", "cb", "rb", "nb"), "token")
    pairs = both.filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & room).select("a", "b").distinct()
    pairs = ws.write(pairs.join(tried, ["a", "b"], "left_anti"), "pairs-2")
    return _merged(ws, labels, ws.write(verify(pairs, "2"), "links-2"), "comps-2")


def link_all(
    ws: Workspace,
    large: DataFrame,
    few: DataFrame,
    others: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame, str], DataFrame],
    fits: Callable[[Column, Column], Column],
) -> DataFrame:
    """Components of the nodes of which any two that link share a key: ``(node, comp)`` for the nodes that link with any other.

    large: ``(key, node, size)`` of the keys with many members. few: ``(a, b, turn)``, the pairs of all other keys, of turn 0 those with a
    key's first member. The members of a key meet its hub, the first, then two others, and those still apart all others: ``others`` has, from
    ``(key, node, size, comp)``, the pairs of different components.
    """
    pair = (F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    near = fits(F.col("size"), F.col("hub_size"))
    hubs = large.groupBy("key").agg(F.min(F.struct("node", "size")).alias("hub")).select("key", F.col("hub.node").alias("hub"), F.col("hub.size").alias("hub_size"))
    first = large.join(hubs, "key").filter((F.col("node") != F.col("hub")) & near).select(*pair)
    tried = ws.write(few.filter("turn = 0").select("a", "b").union(first).distinct(), "pairs-0")
    ws.settle()
    labels = connected_components(ws, ws.write(verify(tried, "0"), "links-0"), "comps-0")
    of = lambda end: labels.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
    apart = few.filter("turn > 0").join(of("a"), "a", "left").join(of("b"), "b", "left").filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    for step in (1, 2):
        ws.settle()
        large = _unsettled(ws, large, labels, f"rest-{step}")
        if step == 1:
            met = large.groupBy("key", F.pmod("node", F.lit(FEW)).alias("slot")).agg(F.min(F.struct("node", "size", "comp")).alias("hub"))
            met = met.select("key", F.col("hub.node").alias("hub"), F.col("hub.size").alias("hub_size"), F.col("hub.comp").alias("hub_comp"))
            found = apart.union(large.join(met, "key").filter((F.col("comp") != F.col("hub_comp")) & near).select(*pair))
        else:
            found = others(large)
        large = large.drop("comp")
        new = ws.write(found.distinct().join(tried, ["a", "b"], "left_anti"), f"pairs-{step}")
        labels = _merged(ws, labels, ws.write(verify(new, str(step)), f"links-{step}"), f"comps-{step}")
        tried = tried.union(new)
    return labels


def _unsettled(ws: Workspace, shared: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """The rows ``(key, node, ...)`` of the keys of more than two nodes, not all of one component, with their component."""
    marked = shared.join(labels, "node", "left").select(*shared.columns, F.coalesce("comp", "node").alias("comp"))
    keys = marked.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).filter("lo < hi and n > 2").select("key")
    return ws.write(marked.join(keys, "key"), name)


def _merged(ws: Workspace, labels: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """The labels with more links; only the components that these touch are worked on."""
    if not links.limit(1).count():
        return labels
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    known = ws.write(labels.union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("comp"))), f"{name}-known")
    of = lambda end: known.select(F.col("node").alias(end), F.col("comp").alias(f"c{end}"))
    between = links.join(of("a"), "a").join(of("b"), "b").filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    joined = connected_components(ws, ws.write(between, f"{name}-between"), name).select(F.col("node").alias("comp"), F.col("comp").alias("whole"))
    return ws.write(known.join(joined, "comp", "left").select("node", F.coalesce("whole", "comp").alias("comp")), f"{name}-merged")
