"""Who blocks whom: heads of blocking chains and deadlocks in a graph of waits.

A waiter may wait for several holders, and a session may have several requests. Paths are
followed by doubling: after round k a row tells where 2^k waits lead, so a chain of a
million waiters takes twenty joins. Only sessions that somebody waits for take part in
the rounds; the crowd that blocks nobody is looked up once, at the end. Each round is
written to the shared folder, which cuts the lineage and lets a lost executor cost one
round only. In every lookup the pointed-to side has few rows per key; a holder with very
many waiters is hot on the probing side alone, where AQE splits it.

Deadlocks are the strongly connected components of the graph. Sessions with one holder
are contracted to where their chain ends; what is left are the sessions with several
holders, and those are coloured: forward by the first session, by hash, that reaches them, then
backward from the session of each colour. These rounds grow with the longest path among
sessions of several holders only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktide.workspace import materialise


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written. Joins with it shuffle: broadcasts of many rounds would all pass the driver."""
    return materialise(df, label).hint("merge")


def _waits(edges: DataFrame, scope: Sequence[str], node: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """Distinct waits, written, and those of sessions that somebody waits for."""
    pairs = _written(edges.where(F.col(parent).isNotNull() & F.col(node).isNotNull()).select(*scope, node, parent).distinct(), "waits")
    asked = pairs.select(*scope, F.col(parent).alias(node)).distinct()
    return pairs, _written(pairs.join(asked, [*scope, node], "left_semi"), "inner_waits")


def chain_roots(edges: DataFrame, scope: str, node: str, parent: str) -> DataFrame:
    """The heads above each waiter: distinct (scope, node, root).

    A head is waited for and waits for nobody. A waiter has a row for every head that one
    of its paths leads to; one whose paths all end in cycles has none.
    """
    pairs, inner = _waits(edges, [scope], node, parent)
    waiting = inner.select(scope, F.col(node).alias("_node")).distinct()
    ends = [scope, "_node"]
    state = inner.select(scope, F.col(node).alias("_node"), F.col(parent).alias("at"))
    holds = waiting.select(scope, F.col("_node").alias("at"), F.lit(False).alias("head"))
    state = materialise(state.join(holds, [scope, "at"], "left").select(*ends, "at", F.coalesce("head", F.lit(True)).alias("head")), "paths")
    most, steps = waiting.count(), 1
    # Walks of more waits than there are sessions only go round.
    while steps <= most and not (open_ := state.where("NOT head")).isEmpty():
        ahead = state.select(scope, F.col("_node").alias("at"), F.col("at").alias("further"), "head")
        moved = open_.drop("head").join(ahead, [scope, "at"]).select(*ends, F.col("further").alias("at"), "head")
        state = materialise(state.where("head").union(moved).distinct(), "paths")
        steps *= 2
    found = state.where("head").select(scope, F.col("_node").alias(parent), F.col("at").alias("root"))
    known = waiting.select(scope, F.col("_node").alias(parent), F.lit(True).alias("waits"))
    direct = pairs.join(known, [scope, parent], "left_anti").select(scope, node, F.col(parent).alias("root"))
    through = pairs.join(found, [scope, parent]).select(scope, node, "root")
    return direct.union(through).distinct()


def block_leaders(snap: DataFrame, details: Sequence[str] = ("login_name", "wait_info")) -> DataFrame:
    """Sessions at the head of blocking chains, most blocked sessions first.

    ``blocked_direct`` sessions wait for the leader itself, ``blocked_session_count``
    also counts those behind them; each session counts once for a leader, however many
    requests, holders or paths it has. Details come from the leader's own rows: a leader
    with several requests has a row for each, one that isn't in the snapshot has none.
    """
    scope, node, parent = "collection_time", "session_id", "blocking_session_id"
    roots = chain_roots(snap, scope, node, parent)
    direct = snap.where(F.col(parent).isNotNull()).select(scope, node, F.col(parent).alias("root"), F.lit(1).alias("direct")).distinct()
    counted = (
        roots.join(direct, [scope, node, "root"], "left")
        .groupBy(scope, F.col("root").alias(node))
        .agg(F.count("*").alias("blocked_session_count"), F.count("direct").alias("blocked_direct"))
    )
    own = snap.select(scope, node, *details)
    return counted.join(own, [scope, node], "left").orderBy(F.desc("blocked_session_count"), scope, node)


# --- deadlocks --------------------------------------------------------------------


def _ends_of_chains(single: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where the chains of sessions with one holder end: (node, end), and the nodes of rings among them.

    ``single`` has (node, next), one row a node. A chain ends at the first session that
    isn't in it; one that goes round has no end, and its ring is what any number of waits
    can still arrive at.
    """
    state = single.select("node", F.col("next").alias("at"), F.lit(False).alias("ended"))
    inside = single.select(F.col("node").alias("at"), F.lit(True).alias("inside"))
    state = _written(state.drop("ended").join(inside, "at", "left").select("node", "at", F.col("inside").isNull().alias("ended")), "chains")
    seen = None
    while True:
        open_ = state.where("NOT ended")
        arrived = open_.select(F.col("at").alias("node")).distinct()
        size = (open_.count(), arrived.count())
        if size == seen or 0 in size:
            break
        seen = size
        ahead = state.select(F.col("node").alias("at"), F.col("at").alias("further"), "ended")
        moved = open_.drop("ended").join(ahead, "at").select("node", F.col("further").alias("at"), "ended")
        state = _written(state.where("ended").union(moved), "chains")
    ring = state.where("NOT ended").select(F.col("at").alias("node")).distinct()
    return state.where("ended").select("node", F.col("at").alias("end")), _written(ring, "rings")


def _ring_names(ring: DataFrame) -> DataFrame:
    """(node, name) of ``ring`` (node, next): the smallest session of each ring."""
    state = ring.select("node", F.col("next").alias("at"), F.least("node", "next").alias("name"), F.lit(True).alias("changed"))
    while True:
        # On a ring every session is pointed to once: both sides are unique.
        ahead = state.select(F.col("node").alias("at"), F.col("at").alias("further"), F.col("name").alias("theirs"))
        moved = state.join(ahead, "at")
        state = _written(
            moved.select("node", F.col("further").alias("at"), F.least("name", "theirs").alias("name"), (F.col("theirs") < F.col("name")).alias("changed")),
            "ring_names",
        )
        if state.where("changed").isEmpty():
            return state.select("node", "name")


def _spread(marks: DataFrame, edges: DataFrame, better) -> DataFrame:
    """``marks`` (node, colour) carried along ``edges`` (source, target) until no node gets a better one."""
    while True:
        sent = edges.join(marks.select(F.col("node").alias("source"), "colour"), "source")
        best = sent.groupBy(F.col("target").alias("node")).agg(better("colour").alias("sent"))
        both = marks.join(best, "node", "left")
        gains = F.coalesce(F.col("sent") < F.col("colour"), F.lit(False))
        marks = _written(both.select("node", F.least("colour", "sent").alias("colour"), gains.alias("changed")), "colours")
        if marks.where("changed").isEmpty():
            return marks.select("node", "colour")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the strongly connected components of ``edges`` (source, target) that hold a cycle.

    Sessions are coloured by the first one that reaches them, in the order of a hash: by
    number, a long line of components would lose one of them at a time. Those of a colour
    that reach its session back are a component; the edges that leave it go, and so on.
    What has no way in or out is trimmed before each colouring. A component is named by its
    smallest session.
    """
    loops = edges.where("source = target").select(F.col("source").alias("node"), F.col("source").alias("component"))
    edges = _written(edges.where("source <> target").select("source", "target").distinct(), "junction_waits")
    found = [_written(loops.distinct(), "loops")]
    while True:
        trimmed = edges.join(edges.select(F.col("target").alias("source")).distinct(), "source", "left_semi")
        trimmed = trimmed.join(edges.select(F.col("source").alias("target")).distinct(), "target", "left_semi")
        edges = _written(trimmed.select("source", "target"), "junction_waits")
        if edges.isEmpty():
            break
        nodes = edges.select(F.col("source").alias("node")).union(edges.select("target")).distinct()
        colours = _spread(_written(nodes.withColumn("colour", F.struct(F.xxhash64("node").alias("place"), "node")), "colours"), edges, F.min)
        # A cycle has one colour, so edges between colours can go.
        ends = edges.join(colours.select(F.col("node").alias("source"), F.col("colour").alias("one")), "source")
        ends = ends.join(colours.select(F.col("node").alias("target"), F.col("colour").alias("other")), "target")
        edges = _written(ends.where("one = other").select("source", "target"), "junction_waits")
        # Backward: 0 reaches the session of its colour, 1 not yet.
        back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"))
        start = colours.select("node", F.when(F.col("node") == F.col("colour.node"), 0).otherwise(1).alias("colour"))
        reach = _spread(_written(start, "colours"), back, F.min).where("colour = 0").select("node")
        done = _written(colours.join(reach, "node").select("node", F.col("colour.node").alias("component")), "components")
        sizes = done.groupBy("component").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
        found.append(done.join(_written(sizes.select("component", "least"), "sizes"), "component").select("node", F.col("least").alias("component")))
        gone = done.select(F.col("node").alias("source"))
        left = edges.join(gone, "source", "left_anti").join(gone.withColumnRenamed("source", "target"), "target", "left_anti")
        edges = _written(left.select("source", "target"), "junction_waits")
    every = reduce(DataFrame.union, found)
    # A session with itself as a holder may be in a larger component too.
    return every.groupBy("node").agg(F.min("component").alias("component"))


def _crossed(single: DataFrame, starts: DataFrame) -> DataFrame:
    """The nodes of chains that a path from one of ``starts`` (node) crosses.

    Chains are followed by doubling; a node adds up the starts of all that point to it.
    """
    counts = single.join(starts.withColumn("n", F.lit(1).cast("long")), "node", "left")
    state = counts.select("node", F.col("next").alias("at"), F.coalesce("n", F.lit(0)).alias("n"))
    state = _written(state, "crossings")
    while True:
        inside = state.select(F.col("node").alias("at"), F.col("at").alias("further"))
        moved = state.join(inside, "at", "left")
        if moved.where("further IS NOT NULL").isEmpty():
            return state.where("n > 0").select("node")
        gained = state.groupBy(F.col("at").alias("node")).agg(F.max("n").alias("gained"))
        moved = moved.select("node", F.col("further").alias("at"), "n").join(gained, "node", "left")
        state = _written(moved.select("node", "at", F.greatest("n", F.coalesce("gained", F.lit(0))).alias("n")), "crossings")


def deadlock_cycles(edges: DataFrame) -> DataFrame:
    """The waits inside every deadlock: (deadlock_id, participants, waiter, holder).

    A deadlock is a set of sessions that all wait for each other, over any number of
    waits; it is named by its smallest session. Sessions that merely wait for one are not
    part of it. A session that waits for itself is a deadlock of one. Repeated waits count
    once, null ends are no waits.
    """
    pairs, inner = _waits(edges, [], "waiter", "holder")
    # Only waits for a session that waits itself can close a cycle.
    waiting = inner.select(F.col("waiter").alias("holder")).distinct()
    closing = _written(inner.join(waiting, "holder", "left_semi").select("waiter", "holder"), "closing_waits")
    degree = closing.groupBy(F.col("waiter").alias("node")).agg(F.count("*").alias("n"), F.max("holder").alias("next"))
    degree = _written(degree, "holders")
    single = degree.where("n = 1").select("node", "next")
    chains, ring = _ends_of_chains(single)
    chains = _written(chains, "chain_ends")
    members = [_ring_names(_written(single.join(ring, "node"), "ring")).select("node", "name")]
    forks = degree.where("n > 1").select("node")
    if not forks.isEmpty():
        between = closing.join(forks.withColumnRenamed("node", "waiter"), "waiter", "left_semi")
        ends = between.join(chains.select(F.col("node").alias("holder"), "end"), "holder", "left")
        ends = ends.select("waiter", "holder", F.coalesce("end", "holder").alias("end"))
        ends = _written(ends.join(forks.withColumnRenamed("node", "end"), "end", "left_semi").select("waiter", "holder", "end"), "fork_waits")
        parts = _written(components(ends.select(F.col("waiter").alias("source"), F.col("end").alias("target"))), "fork_components")
        # Chains from one fork of a component to another of it belong to it as well.
        own = ends.join(parts.select(F.col("node").alias("waiter"), F.col("component").alias("one")), "waiter")
        own = own.join(parts.select(F.col("node").alias("end"), F.col("component").alias("other")), "end").where("one = other")
        to_parts = chains.join(parts.select(F.col("node").alias("end"), "component"), "end").select("node", "component")
        to_parts = _written(to_parts, "chains_to_components")
        crossed = _crossed(single.join(to_parts, "node", "left_semi"), own.select(F.col("holder").alias("node")).distinct())
        every = _written(parts.union(to_parts.join(crossed, "node")), "component_members")
        names = every.groupBy("component").agg(F.min("node").alias("name"))
        members.append(every.join(names, "component").select("node", "name"))
    members = _written(reduce(DataFrame.union, members), "deadlock_members")
    # Written, so that AQE can split the participants of a very large deadlock.
    sizes = _written(members.groupBy("name").agg(F.count("*").alias("participants")), "sizes")
    held = members.select(F.col("node").alias("holder"), F.col("name").alias("theirs"))
    waits = pairs.join(members.select(F.col("node").alias("waiter"), "name"), "waiter").join(held, "holder").where("name = theirs")
    return waits.join(sizes, "name").select(F.col("name").alias("deadlock_id"), "participants", "waiter", "holder")
