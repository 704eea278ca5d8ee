"""Trie of conversation prefixes: balanced parentheses per shard, shared spines merged.

A node is a distinct sequence of first turns. Its key is its depth and the sum, modulo
2^52 and in two lanes, of hashes of (place, role, text) of its turns: sums can be taken in
slices, so a conversation of any length is keyed by many tasks. Equal conversations
become one sequence with a count before the trie is built.

The weight of a node is the number of turns from it down, over all sequences. Nodes
heavier than ``SHARD_TURNS`` are the spine, a connected part around the root; what hangs
below the spine fits a shard. Shards hold whole subtrees, several small ones together.
Within a shard the sequences are sorted, and the places where neighbours part give the
parentheses of the forest. Their running excess is kept in blocks with minima and maxima
over ever larger ranges. ``find_close`` goes through them to delimit a subtree, a rank
counts the leaf pairs "()" inside it, and cumulative arrays over the nodes give its
members and savings.

The spine is shared by shards: the totals of the subtrees below are carried up along
the path of one member each and added where paths meet. All of that are grouped sums and
sums over slices of a path, so neither a heavy node nor a long path lands in one task.

A node's list of conversations that end there is hashed in one stream, as SHA-256 asks
for: tasks join sorted runs of ids to texts, and one task a node digests these, a text
at a time.

Defined results: null roles and texts are empty. Turns of equal number stand in the
order of a digest of role and text, a null number first. Rows without a conversation id
are one conversation with the id null, smaller than all others, that shares no head
and is the empty text in a list of ids. Repeated rows are turns of their own. Other
columns aren't read. An empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktide.llm.common import LEAST, ordered, parts_for, text_of, unordered
from sparktide.operators.ordering import number_rows
from sparktide.workspace import materialise

#: Turns below a node up to which its subtree stays in one shard, and turns of a shard.
SHARD_TURNS = 2_048
#: Turns of a conversation that are summed in one window.
SLICE_TURNS = 1_024
#: Ids joined to one text before they are digested.
JOINED_IDS = 4_096
#: Positions in a block of the excess.
BLOCK = 64

_LANE = 2**52
_HIGHEST = 2**63 - 1
KEY = ["depth", "a", "b"]


# --- sequences --------------------------------------------------------------------


def turns_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, digest, chars) of every row."""
    role, text = text_of(role_col), text_of(text_col)
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    return df.select(
        ordered(F.col(conv_col).cast("long")).alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.char_length(text).cast("long").alias("chars")
    )


def sequences(turns: DataFrame, shared: int = 0, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """Turns by place: (conv, depth, digest, chars, length), and (conv, length) of all conversations.

    With ``shared``, a conversation c starts with the first h turns of conversation
    c - c % ``family`` in place of its own first h; h is crc32(c as text) % ``shared``.
    """
    numbered = number_rows(turns, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")], "row")
    numbered = materialise(numbered.select("conv", "row", "digest", "chars"), "numbered_turns")
    known = F.col("conv") != LEAST
    head = F.when(known, F.crc32(F.col("conv").cast("string").cast("binary")) % shared).otherwise(0) if shared else F.lit(0)
    base = F.when(known, F.col("conv") - F.col("conv") % family).otherwise(F.col("conv"))
    convs = numbered.groupBy("conv").agg(F.min("row").alias("first"), F.count("*").alias("own"))
    convs = materialise(convs.select("conv", "first", "own", base.alias("base"), head.cast("long").alias("h")), "conversations")
    there = convs.where("conv = base").select("base", F.col("own").alias("base_own"))
    taken = F.least("h", F.coalesce("base_own", F.lit(0)))
    facts = convs.join(there, "base", "left").select("conv", "first", "base", "h", taken.alias("taken"), "own")
    facts = facts.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    facts = materialise(facts, "conversation_facts")
    placed = numbered.join(facts, "conv").withColumn("place", F.col("row") - F.col("first") + 1)
    tails = placed.where("place > h").select("conv", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "chars", "length")
    if not shared:
        return tails, facts.select("conv", "length")
    # At most ``shared`` - 1 turns of a base, for at most ``family`` conversations.
    heads = placed.where((F.col("conv") == F.col("base")) & (F.col("place") < shared)).select("base", F.col("place").alias("depth"), "digest", "chars")
    asking = facts.where("taken > 0").select("conv", "base", "taken", "length")
    heads = asking.join(heads, "base").where("depth <= taken").select("conv", "depth", "digest", "chars", "length")
    return tails.union(heads), facts.select("conv", "length")


def running(rows: DataFrame, names: list[str], modulus: int | None = None) -> DataFrame:
    """``rows`` (conv, depth, ...) with the sums of ``names`` over the conversation up to each depth, in place of them.

    A window holds a slice of a conversation; what lies before a slice is added from
    the slices' sums.
    """

    def cut(x: F.Column) -> F.Column:
        return F.pmod(x, F.lit(modulus)) if modulus else x

    sliced = rows.withColumn("slice", F.floor(F.col("depth") / SLICE_TURNS).cast("long"))
    up_to = Window.partitionBy("conv", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = sliced.groupBy("conv", "slice").agg(*[F.sum(n).alias(n) for n in names])
    several = Window.partitionBy("conv")
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ahead = [cut(F.sum(F.col(n).cast("decimal(38,0)")).over(before)).cast("long").alias(f"{n}_ahead") for n in names]
    sums = sums.withColumn("last", F.max("slice").over(several)).where("last > 0").select("conv", "slice", *ahead)
    inside = sliced.withColumns({n: F.sum(n).over(up_to) for n in names})
    whole = inside.join(materialise(sums, "slice_sums"), ["conv", "slice"], "left")
    return whole.withColumns({n: cut(F.col(n) + F.coalesce(f"{n}_ahead", F.lit(0))) for n in names}).drop("slice", *[f"{n}_ahead" for n in names])


def _paths(rows: DataFrame) -> DataFrame:
    """(conv, depth, a, b, up_a, up_b, chars, length) of every turn, written; up_a and up_b are its parent's lanes."""
    mixed = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "digest"), 256)

    def lane(at: int) -> F.Column:
        return F.conv(F.substring("mixed", at, 13), 16, 10).cast("long")

    hashed = rows.withColumn("mixed", mixed).select("conv", "depth", lane(1).alias("a"), lane(14).alias("b"), "chars", "length")
    hashed = materialise(hashed.withColumns({"own_a": F.col("a"), "own_b": F.col("b")}), "turn_hashes")
    summed = running(hashed, ["a", "b"], _LANE)
    up = {f"up_{n}": F.pmod(F.col(n) - F.col(f"own_{n}"), F.lit(_LANE)) for n in ("a", "b")}
    return materialise(summed.withColumns(up).drop("own_a", "own_b"), "paths")


# --- a shard ----------------------------------------------------------------------


class Parentheses:
    """A balanced sequence with the minima and maxima of its excess over blocks and ranges of blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int64)
        n = -(-max(1, len(opens)) // BLOCK)
        low = np.full(n * BLOCK, _HIGHEST, np.int64)
        high = np.full(n * BLOCK, -_HIGHEST, np.int64)
        low[: len(opens)] = high[: len(opens)] = self.excess
        self.minima, self.maxima = [low.reshape(n, BLOCK).min(axis=1)], [high.reshape(n, BLOCK).max(axis=1)]
        while len(self.minima[-1]) > 1:
            for levels, fill, best in ((self.minima, _HIGHEST, np.minimum), (self.maxima, -_HIGHEST, np.maximum)):
                last = np.append(levels[-1], fill) if len(levels[-1]) % 2 else levels[-1]
                levels.append(best(last[0::2], last[1::2]))
        pairs = opens & np.append(~opens[1:], False)
        self._leaves = np.concatenate(([0], np.cumsum(pairs)))

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at ``at`` close: the first place behind with an excess one lower."""
        wanted, found = self.excess[at] - 1, np.full(len(at), -1, np.int64)
        left = self._scan(at + 1, (at // BLOCK + 1) * BLOCK, wanted, found, np.arange(len(at)))
        node, level_of = at // BLOCK, np.full(len(at), -1)
        climbing = left
        for level, minima in enumerate(self.minima):
            side = node[climbing] + 1
            near = (node[climbing] % 2 == 0) & (side < len(minima))
            hit = near & (minima[np.minimum(side, len(minima) - 1)] <= wanted[climbing])
            level_of[climbing[hit]], node[climbing[hit]] = level, side[hit]
            climbing = climbing[~hit]
            node[climbing] //= 2
        for level in range(len(self.minima) - 1, 0, -1):
            down = left[level_of[left] >= level]
            first = 2 * node[down]
            node[down] = np.where(self.minima[level - 1][first] <= wanted[down], first, first + 1)
        self._scan(node * BLOCK, (node + 1) * BLOCK, wanted, found, left)
        return found

    def _scan(self, start: np.ndarray, end: np.ndarray, wanted: np.ndarray, found: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Look for the wanted excess from ``start`` to below ``end``; returns those that didn't find it."""
        end = np.minimum(end, len(self.excess))
        missed = []
        for step in range(BLOCK):
            place = start[which] + step
            inside = place < end[which]
            missed.append(which[~inside])
            which, place = which[inside], place[inside]
            if not len(which):
                break
            hit = self.excess[place] == wanted[which]
            found[which[hit]] = place[hit]
            which = which[~hit]
        return np.concatenate([*missed, which])

    def leaf_pairs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of pairs "()" that start from ``start`` to below ``end``."""
        return self._leaves[end] - self._leaves[start]


def _least_of_ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minima of values[start:end], from minima over powers of two."""
    levels = [values]
    while 2 ** len(levels) <= len(values):
        half = 2 ** (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    out, length = np.empty(len(start), values.dtype), end - start
    power = np.frexp(length.astype(np.float64))[1] - 1
    for k in np.unique(power):
        some = power == k
        out[some] = np.minimum(levels[k][start[some]], levels[k][end[some] - 2**k])
    return out


NODES = (
    "depth long, a long, b long, up_a long, up_b long, top boolean, conv long, parent_conv long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long"
)


def encode_forest(table: pa.Table) -> pa.Table:
    """The nodes of a shard from its sequences' turns (conv, depth, a, b, up_a, up_b, chars, n), each from its top down."""
    column = {c: table[c].to_numpy() for c in ("conv", "depth", "a", "b", "up_a", "up_b", "chars", "n")}
    order = np.lexsort((column["depth"], column["conv"]))
    column = {c: v[order] for c, v in column.items()}
    starts = np.flatnonzero(np.diff(column["conv"], prepend=column["conv"][0] - 1))
    ends = np.append(starts[1:], len(order))
    keys = np.stack([column["a"], column["b"]], axis=1).astype(">i8")
    # Paths as bytes sort like the sequence of their keys, a prefix first.
    walk = sorted(zip(starts.tolist(), ends.tolist(), strict=True), key=lambda r: (int(column["depth"][r[0]]), keys[r[0] : r[1]].tobytes()))
    opens, rows, parents = [], [], []
    path = np.zeros(int((ends - starts).max()), np.int64)
    finals, n_nodes, last = [], 0, None
    for start, end in walk:
        common = 0
        if last is not None and column["depth"][start] == column["depth"][last[0]]:
            most = min(end - start, last[1] - last[0])
            same = (keys[start : start + most] == keys[last[0] : last[0] + most]).all(axis=1)
            common = most if same.all() else int(same.argmin())
        if last is not None:
            opens.append(np.zeros(last[1] - last[0] - common, bool))
        new = end - start - common
        opens.append(np.ones(new, bool))
        rows.append(np.arange(start + common, end))
        above = path[common - 1] if common else -1
        made = n_nodes + np.arange(new)
        if new:
            parents.append(np.concatenate(([above], made[:-1])))
        path[common : end - start] = made
        finals.append((int(path[end - start - 1]), start))
        n_nodes += new
        last = (start, end)
    opens.append(np.zeros(last[1] - last[0], bool))
    shape = Parentheses(np.concatenate(opens))
    rows, parents = np.concatenate(rows), np.concatenate(parents)
    at = np.flatnonzero(shape.opens)
    close = shape.find_close(at)
    first, after = np.arange(n_nodes), np.arange(n_nodes) + (close - at + 1) // 2

    def below(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[after] - total[first]

    members, smallest = np.zeros(n_nodes, np.int64), np.full(n_nodes, _HIGHEST, np.int64)
    node, source = np.array(finals).T
    members[node], smallest[node] = column["n"][source], column["conv"][source]
    n_convs, conv = below(members), _least_of_ranges(smallest, first, after)
    inner = parents >= 0
    made = {c: column[c][rows] for c in ("depth", "a", "b", "up_a", "up_b")} | {
        "top": ~inner,
        "conv": conv,
        "parent_conv": pa.array(conv[np.maximum(parents, 0)], pa.int64(), mask=~inner),
        "n_convs": n_convs,
        "n_children": np.bincount(parents[inner], minlength=n_nodes),
        "n_leaves": shape.leaf_pairs(at, close),
        "saved_tokens": below((n_convs - 1) * column["chars"][rows]),
    }
    return pa.table({c: v if isinstance(v, pa.Array) else pa.array(v) for c, v in made.items()})


# --- the trie ---------------------------------------------------------------------


def _ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) from (depth, a, b, conv)."""

    def join_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def text(key: tuple, ids: list[int]) -> dict:
            joined = ",".join("" if i == LEAST else str(i) for i in ids)
            return dict(zip((*KEY, "least", "ids"), (*key, ids[0], joined), strict=True))

        key, ids = None, []
        for batch in batches:
            made = []
            for *at, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv")), strict=True):
                if key != tuple(at) or len(ids) == JOINED_IDS:
                    if ids:
                        made.append(text(key, ids))
                    key, ids = tuple(at), []
                ids.append(conv)
            if made:
                yield pa.RecordBatch.from_pylist(made)
        if ids:
            yield pa.RecordBatch.from_pylist([text(key, ids)])

    ranged = ends.repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    runs = materialise(ranged.mapInArrow(join_runs, "depth long, a long, b long, least long, ids string"), "joined_ids")
    counts = materialise(runs.groupBy(*KEY).agg(F.count("*").alias("runs")).where("runs > 1").select(*KEY), "several_runs")
    whole = runs.join(counts, KEY, "left_anti").select(*KEY, F.sha2("ids", 256).alias("ends_sha256"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip((*KEY, "ends_sha256"), (*key, state.hexdigest()), strict=True))])

        for batch in batches:
            for *at, ids in zip(*(batch.column(c) for c in (*KEY, "ids")), strict=True):
                at = tuple(x.as_py() for x in at)
                if at != key:
                    if state:
                        yield result()
                    key, state = at, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
        if state:
            yield result()

    several = runs.join(counts, KEY, "left_semi").repartition(*KEY).sortWithinPartitions(*KEY, "least")
    return whole.union(several.mapInArrow(digest, "depth long, a long, b long, ends_sha256 string"))


def _spine_totals(on_spine: DataFrame, spine: DataFrame, tops: DataFrame) -> DataFrame:
    """``spine`` with n_leaves and saved_tokens: what its nodes and the subtrees below them give, carried up and added."""
    mine = F.col("conv") == F.col("node_conv")
    own = on_spine.join(spine.select(*KEY, F.col("conv").alias("node_conv"), "chars", "n_convs", "n_children"), KEY).select(
        "conv", *KEY,
        F.when(mine & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaves"),
        F.when(mine, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0).cast("long").alias("saved"),
    )
    own = materialise(own.withColumns({"own_leaves": F.col("leaves"), "own_saved": F.col("saved")}), "spine_parts")
    totals = own.groupBy("conv").agg(F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"))
    hanging = tops.groupBy("conv").agg(F.sum("n_leaves").alias("top_leaves"), F.sum("saved_tokens").alias("top_saved"))
    totals = totals.join(hanging, "conv", "left").select(
        "conv", *[(F.col(f"all_{n}") + F.coalesce(f"top_{n}", F.lit(0))).alias(f"all_{n}") for n in ("leaves", "saved")]
    )
    # From a depth on: all of the conversation without what lies above.
    from_here = running(own, ["leaves", "saved"]).join(materialise(totals, "spine_sums"), "conv")
    parts = [(F.col(f"all_{n}") - F.col(n) + F.col(f"own_{n}")).alias(n) for n in ("leaves", "saved")]
    summed = from_here.select(*KEY, *parts).groupBy(*KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return spine.join(materialise(summed, "spine_totals"), KEY)


def prefix_trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of all conversations of ``sequences``.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    paths = _paths(rows)
    ends = paths.where("depth = length").select("conv", *KEY)
    none = lengths.where("length = 0").select("conv", *[F.lit(0).cast("long").alias(c) for c in KEY])
    ends = materialise(ends.union(none), "ends")
    distinct = materialise(ends.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("conv").alias("conv")), "distinct_sequences")
    zero = F.lit(0).cast("long")
    roots = distinct.select(
        "conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("up_a"), zero.alias("up_b"), zero.alias("chars"),
        F.col("depth").alias("length"), "n",
    )
    steps = paths.join(distinct.select("conv", "n"), "conv").select(roots.columns).union(roots)
    steps = materialise(steps, "steps")
    weight = F.sum(F.col("length") - F.col("depth") + 1)
    nodes = steps.groupBy(*KEY, "up_a", "up_b").agg(
        weight.alias("weight"), F.sum("n").alias("n_convs"), F.min("conv").alias("conv"), F.max("chars").alias("chars")
    )
    spine = materialise(nodes.where((F.col("weight") > SHARD_TURNS) | (F.col("depth") == 0)).drop("weight"), "spine")
    held = spine.select(*KEY, F.lit(True).alias("on_spine"))
    marked = materialise(steps.join(held, KEY, "left").withColumn("on_spine", F.coalesce("on_spine", F.lit(False))), "marked_steps")
    off = marked.where("NOT on_spine")
    top = off.groupBy("conv").agg(F.min(F.struct(*KEY)).alias("top"))
    bins = parts_for(off.count(), SHARD_TURNS)
    shards = off.join(materialise(top, "tops"), "conv").withColumn("shard", F.pmod(F.xxhash64("top"), F.lit(bins)))
    below = materialise(shards.drop("top", "on_spine", "length").groupBy("shard").applyInArrow(encode_forest, NODES), "shard_nodes")
    tops = below.where("top")
    parent = [(F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")]
    children = tops.select(*parent).union(spine.where("depth > 0").select(*parent)).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    spine = materialise(spine.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "spine_children")
    spine = materialise(_spine_totals(marked.where("on_spine").select("conv", *KEY), spine, tops), "spine_nodes")
    over = spine.select(*[F.col(c).alias(f"p_{c}") for c in KEY], F.col("conv").alias("parent_conv"))
    kept = [*KEY, "conv", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    meets = (F.col("depth") - 1 == F.col("p_depth")) & (F.col("up_a") == F.col("p_a")) & (F.col("up_b") == F.col("p_b"))
    attached = tops.drop("parent_conv").select(*[c for c in kept if c != "parent_conv"], "up_a", "up_b")
    attached = attached.unionByName(spine.select(attached.columns)).join(over, meets, "left").select(*kept)
    nodes = below.where("NOT top").select(*kept).union(attached)
    digests = materialise(_ends_digests(ends), "ends_digests")
    nothing = hashlib.sha256().hexdigest()
    return nodes.join(digests, KEY, "left").select(
        unordered("conv").alias("conv_id"),
        "depth",
        unordered("parent_conv").alias("parent_conv_id"),
        "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
