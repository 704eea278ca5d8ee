"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards by space: the top of one ball tree, fitted on a bounded
sample, gives each vector a cell, and cells of more rows than a shard holds (copies of
one vector, say) are dealt on by place. A shard's ball tree is built once and written:
nodes hold a centre and a radius, leaves hold rows. For a query q no row below a node
scores more than q.c + |q| r, so a search visits nodes in falling order of that bound
and stops where it can't beat the k-th score.

Shards share their k-th scores in two rounds: each query first searches the shards with
the highest bounds, and its k-th score there is the floor below which it is sent to no
other shard and looks at no node. The bounds are those of the shards' outer balls, a
narrow table that blocks of queries meet in blocks. A query's results of all shards meet
in one cut.

The queries sent to a shard go in blocks, each (block, shard) pair a task's group;
within a group the queries of a block descend together, so bounds and leaf scores
are matrix products.

Components become floor(scale * x) and scores are whole numbers: exact as doubles
up to 2^53, as 64-bit integers up to 2^63; beyond that a score is cut to the range
of a long. Vectors that are null, hold null or non-finite components, or have no id
take no part. Only vectors of equal length are compared. Rows with a query's own id
are no candidates for it. Repeated rows are candidates of their own; repeated ids
among the queries count as one query, with the smallest vector. An empty table
gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktide.llm.common import parts_for
from sparktide.workspace import materialise

SHARD_ROWS = 8_192
QUERY_ROWS = 4_096
LEAF_ROWS = 64
#: Sampled rows that the cells are fitted on, about; a cell has so many of them at least.
SAMPLE_ROWS = 32_768
CELL_ROWS = 16
#: Shards that a block of queries is held against at once.
DIRECTORY_ROWS = 1_024
#: Shards that a query searches before the others know its k-th score.
FIRST = 2

TREES = (
    "dim int, shard long, ids binary, vectors binary, centres binary, radii binary, "
    "starts binary, ends binary, lefts binary, rights binary, centre array<double>, radius double"
)
CELLS = "dim int, along binary, at binary, lefts binary, rights binary"
PAIRS = "id long, dim int, shard long, bound double"
FOUND = "query_id long, vec_id long, score long"
_LIMIT = 2**63 - 1


def vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, v) with v = floor(scale * x) as doubles, of the rows that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("double"))
    rows = df.where(x.isNotNull() & F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.size(x).alias("dim"), scaled.alias("v"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _direction(rows: np.ndarray, far: np.ndarray) -> np.ndarray:
    """From a row farthest from the centre to one farthest from that."""
    one = rows[int(far.argmax())]
    return rows[int(((rows - one) ** 2).sum(axis=1).argmax())] - one


class Tree:
    """Nodes as arrays; the rows of a node are a range of the reordered vectors."""

    def __init__(self, ids, vectors, centres, radii, starts, ends, lefts, rights):
        self.ids, self.vectors, self.centres, self.radii = ids, vectors, centres, radii
        self.starts, self.ends, self.lefts, self.rights = starts, ends, lefts, rights

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Tree:
        order, nodes = np.argsort(ids, kind="stable"), []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            rows = vectors[order[start:end]]
            centre = rows.mean(axis=0) if rows.size else np.zeros(vectors.shape[1])
            far = np.sqrt(((rows - centre) ** 2).sum(axis=1)) if rows.size else np.zeros(end - start)
            at = len(nodes)
            nodes.append([centre, far.max(initial=0.0), start, end, -1, -1])
            if parent >= 0:
                nodes[parent][4 + side] = at
            if end - start > LEAF_ROWS and far.max(initial=0.0) > 0:
                # The middle row is the place of the cut.
                along = rows @ _direction(rows, far)
                order[start:end] = order[start:end][np.argsort(along, kind="stable")]
                middle = (start + end) // 2
                todo += [(start, middle, at, 0), (middle, end, at, 1)]
        columns = list(zip(*nodes, strict=True))
        ints = [np.array(c, np.int64) for c in columns[2:]]
        return cls(ids[order], vectors[order], np.array(columns[0]).reshape(len(nodes), -1), np.array(columns[1]), *ints)

    def dump(self) -> dict[str, bytes]:
        return {n: getattr(self, n).tobytes() for n in self.__dict__}

    @classmethod
    def load(cls, row: dict) -> Tree:
        ints = {n: np.frombuffer(row[n], np.int64) for n in ("ids", "starts", "ends", "lefts", "rights")}
        wide = {n: np.frombuffer(row[n], np.float64).reshape(len(ints[of]), row["dim"]) for n, of in (("vectors", "ids"), ("centres", "starts"))}
        return cls(radii=np.frombuffer(row["radii"], np.float64), **ints, **wide)


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products as 64-bit integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries @ rows.T).astype(np.int64)
    if most < 2**62:
        return queries.astype(np.int64) @ rows.astype(np.int64).T
    whole = [[[int(x) for x in v] for v in m] for m in (queries, rows)]
    dots = [[max(-_LIMIT - 1, min(_LIMIT, sum(a * b for a, b in zip(q, r, strict=True)))) for r in whole[1]] for q in whole[0]]
    return np.array(dots, np.int64).reshape(len(queries), len(rows))


class _Best:
    """The k best (score, smaller id first) of each query of a block."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.score = np.full((n, k), -_LIMIT - 1, np.int64)
        self.id = np.full((n, k), _LIMIT, np.int64)
        self.floor = floor.copy()
        self.k = k

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        scores = np.concatenate([self.score[which], scores], axis=1)
        ids = np.concatenate([self.id[which], np.broadcast_to(ids, (len(which), len(ids)))], axis=1)
        other = ids != own[which][:, None]
        order = np.lexsort((ids, np.where(other, -scores.astype(np.float64), np.inf)), axis=1)
        if (np.abs(scores[scores > -_LIMIT - 1]) >= 2**53).any():
            order = np.array([sorted(range(scores.shape[1]), key=lambda j: (not o[j], -int(s[j]), i[j])) for s, i, o in zip(scores, ids, other, strict=True)])
        order = order[:, : self.k]
        kept = np.take_along_axis(other, order, axis=1)
        self.score[which] = np.where(kept, np.take_along_axis(scores, order, axis=1), -_LIMIT - 1)
        self.id[which] = np.where(kept, np.take_along_axis(ids, order, axis=1), _LIMIT)
        self.floor[which] = np.maximum(self.floor[which], self.score[which, -1])


def _slack(bounds: np.ndarray) -> np.ndarray:
    """Bounds are rounded sums; a little more never loses a row."""
    return bounds + 1e-9 * np.abs(bounds) + 1e-6


def search(tree: Tree, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> _Best:
    """The block's k best rows that reach ``floor``."""
    best, norms = _Best(len(queries), k, floor), np.sqrt((queries**2).sum(axis=1))

    def bounds(node: int, which: np.ndarray) -> np.ndarray:
        return _slack(queries[which] @ tree.centres[node] + norms[which] * tree.radii[node])

    everyone = np.arange(len(queries))
    heap = [(-bounds(0, everyone).max(initial=-np.inf), 0, everyone)]
    while heap:
        _, node, which = heapq.heappop(heap)
        which = which[bounds(node, which) >= best.floor[which]]
        if not len(which):
            continue
        if tree.lefts[node] < 0:
            rows = slice(tree.starts[node], tree.ends[node])
            best.add(which, _scores(queries[which], tree.vectors[rows]), tree.ids[rows], own)
            continue
        for child in (int(tree.lefts[node]), int(tree.rights[node])):
            at = bounds(child, which)
            mine = which[at >= best.floor[which]]
            if len(mine):
                heapq.heappush(heap, (-at.max(), child, mine))
    return best


def _gap(place: np.ndarray) -> float:
    """Where sorted numbers are cut: at the widest gap of their middle half, or beside what fills it."""
    a, b = len(place) // 4, 3 * len(place) // 4
    i = a + int(np.diff(place[a : b + 1]).argmax())
    if place[i] == place[i + 1] and place[i] == place[-1]:
        return place[max(0, int(np.searchsorted(place, place[i])) - 1)]
    return place[i]


def _fit(cell_rows: float):
    """The cells of a sample of one dimension: nodes with a direction, a place and two sides, -1 - n for cell n."""

    def run(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        x, nodes, cells = _matrix(table["v"], dim), [], 0
        todo = [(np.arange(len(x)), -1, 0)]
        while todo:
            which, parent, side = todo.pop()
            rows, cut = x[which], None
            if len(which) > cell_rows and dim:
                far = ((rows - rows.mean(axis=0)) ** 2).sum(axis=1)
                direction = _direction(rows, far)
                place = rows @ direction
                at = _gap(np.sort(place))
                low = place <= at
                cut = None if low.all() else (direction, at)
            me = len(nodes) if cut else -1 - cells
            if parent >= 0:
                nodes[parent][2 + side] = me
            if cut:
                nodes.append([*cut, 0, 0])
                todo += [(which[low], me, 0), (which[~low], me, 1)]
            else:
                cells += 1
        along, at, lefts, rights = ([n[i] for n in nodes] for i in range(4))
        made = {"along": np.array(along, float), "at": np.array(at, float), "lefts": np.array(lefts, np.int64), "rights": np.array(rights, np.int64)}
        return pa.table({"dim": pa.array([dim], pa.int32())} | {n: pa.array([m.tobytes()], pa.binary()) for n, m in made.items()})

    return run


class _Cells:
    """Which cell a vector lies in; everything of a dimension without nodes is one cell."""

    def __init__(self, row):
        self.at, self.lefts, self.rights = (np.frombuffer(row[n], t) for n, t in (("at", np.float64), ("lefts", np.int64), ("rights", np.int64)))
        self.along = np.frombuffer(row["along"], np.float64).reshape(len(self.at), row["dim"] if len(self.at) else 0)

    def of(self, x: np.ndarray) -> np.ndarray:
        cell, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))] if len(self.at) else []
        while todo:
            node, which = todo.pop()
            if node < 0:
                cell[which] = -1 - node
            elif len(which):
                low = x[which] @ self.along[node] <= self.at[node]
                todo += [(int(self.lefts[node]), which[low]), (int(self.rights[node]), which[~low])]
        return cell


def in_cells(rows: DataFrame) -> DataFrame:
    """``rows`` of ``vectors`` with their cell. The cells sent to the tasks are fewer than the sampled rows."""
    n = rows.count()
    shards = parts_for(n, SHARD_ROWS)
    if shards == 1:
        return rows.withColumn("cell", F.lit(0).cast("long"))
    sample = rows.where(F.rand(11) < SAMPLE_ROWS / n)
    fitted = sample.groupBy("dim").applyInArrow(_fit(max(CELL_ROWS, min(n, SAMPLE_ROWS) / shards)), CELLS)
    shared = rows.sparkSession.sparkContext.broadcast({r["dim"]: r.asDict() for r in fitted.collect()})

    def run(batches):
        cells = {dim: _Cells(row) for dim, row in shared.value.items()}
        for batch in batches:
            dims, cell = batch["dim"].to_numpy(), np.zeros(batch.num_rows, np.int64)
            for dim in set(dims.tolist()) & set(cells):
                mine = np.flatnonzero(dims == dim)
                cell[mine] = cells[dim].of(_matrix(pa.chunked_array([batch["v"].take(pa.array(mine))]), dim))
            yield batch.append_column("cell", pa.array(cell))

    return rows.mapInArrow(run, "id long, dim int, v array<double>, cell long")


def _build(table: pa.Table) -> pa.Table:
    dim = table["dim"][0].as_py()
    tree = Tree.build(table["id"].to_numpy(), _matrix(table["v"], dim))
    row = {"dim": [dim], "shard": [table["shard"][0].as_py()]} | {n: [b] for n, b in tree.dump().items()}
    row |= {"centre": [tree.centres[0].tolist()], "radius": [float(tree.radii[0])]}
    types = {"dim": pa.int32(), "shard": pa.int64(), "centre": pa.list_(pa.float64()), "radius": pa.float64()}
    names = [c.split(" ")[0] for c in TREES.split(", ")]
    return pa.table({n: pa.array(row[n], types.get(n, pa.binary())) for n in names})


def build_trees(rows: DataFrame) -> DataFrame:
    """The written trees over rows of ``vectors``, one row per shard."""
    placed = materialise(in_cells(rows).withColumn("place", F.monotonically_increasing_id()), "in_cells")
    parts = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("id", "place"), F.col("parts"))
    dealt = placed.join(materialise(parts, "cell_parts"), ["dim", "cell"])
    dealt = dealt.select("id", "dim", "v", F.shiftleft("cell", 32).bitwiseOR(part).alias("shard"))
    return materialise(dealt.groupBy("dim", "shard").applyInArrow(_build, TREES), "ball_trees")


def _meeting(first: int | None):
    def run(shards: pa.Table, queries: pa.Table) -> pa.Table:
        made = {"id": [], "dim": [], "shard": [], "bound": []}
        if shards.num_rows and queries.num_rows:
            dim, names = shards["dim"][0].as_py(), shards["shard"].to_numpy()
            q = _matrix(queries["v"], dim)
            norms, radii = np.sqrt((q**2).sum(axis=1)), shards["radius"].to_numpy()
            bounds = _slack(q @ _matrix(shards["centre"], dim).T + norms[:, None] * radii)
            if first:
                wanted = np.argsort(-bounds, axis=1, kind="stable")[:, :first]
                row, col = np.repeat(np.arange(len(q)), wanted.shape[1]), wanted.ravel()
            else:
                open_ = bounds >= queries["floor"].to_numpy()[:, None]
                for i, seen in enumerate(queries["seen"].to_pylist()):
                    open_[i, np.isin(names, seen or [])] = False
                row, col = np.nonzero(open_)
            made = {"id": queries["id"].to_numpy()[row], "dim": np.full(len(row), dim), "shard": names[col], "bound": bounds[row, col]}
        types = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("shard", pa.int64()), ("bound", pa.float64())])
        return pa.table({f.name: pa.array(made[f.name], f.type) for f in types})

    return run


def pairs(trees: DataFrame, queries: DataFrame, first: int | None = None) -> DataFrame:
    """(id, dim, shard, bound) of the shards a query is sent to.

    With ``first`` those with its highest bounds, otherwise all that reach its ``floor`` but those it has ``seen``.
    """
    shards = trees.select("dim", "shard", "centre", "radius")
    pages, blocks = parts_for(shards.count(), DIRECTORY_ROWS), parts_for(queries.count(), QUERY_ROWS)

    def each(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    shards = shards.withColumn("page", F.pmod(F.xxhash64("shard"), F.lit(pages))).withColumn("block", each(blocks))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("page", each(pages))
    keys = ["dim", "page", "block"]
    met = shards.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_meeting(first), PAIRS)
    if not first:
        return met
    best = Window.partitionBy("id", "dim").orderBy(F.col("bound").desc(), "shard")
    return met.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= first).drop("_nth")


def _searcher(k: int):
    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        made: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if trees.num_rows and queries.num_rows:
            tree = Tree.load({c: trees[c][0].as_py() for c in trees.column_names})
            own = queries["id"].to_numpy()
            q = _matrix(queries["v"], trees["dim"][0].as_py())
            best = search(tree, q, own, queries["floor"].to_numpy(), k)
            real = best.id < _LIMIT
            made = {"query_id": np.repeat(own, k)[real.ravel()], "vec_id": best.id[real], "score": best.score[real]}
        return pa.table({n: pa.array(v, pa.int64()) for n, v in made.items()})

    return run


def _searched(trees: DataFrame, queries: DataFrame, sent: DataFrame, k: int) -> DataFrame:
    """What the queries find in the shards they are sent to; a tree is loaded once per block of its queries."""
    sent = materialise(sent.select("id", "dim", "shard"), "sent")
    blocks = sent.groupBy("dim", "shard").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("blocks"))
    blocks = materialise(blocks, "query_blocks")
    asked = sent.join(blocks, ["dim", "shard"]).join(queries.select("id", "dim", "v", "floor"), ["id", "dim"])
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).drop("blocks")
    served = trees.drop("centre", "radius").join(blocks, ["dim", "shard"])
    served = served.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    keys = ["dim", "shard", "block"]
    found = served.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_searcher(k), FOUND)
    return materialise(found, "found")


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows, ties to the smaller id.

    Both frames are as from ``vectors``.
    """
    trees = build_trees(rows)
    floor, none = F.lit(-_LIMIT - 1).alias("floor"), F.array().cast("array<long>").alias("seen")
    queries = materialise(queries.groupBy("id", "dim").agg(F.min("v").alias("v")).select("*", floor, none), "queries")
    first = materialise(pairs(trees, queries, FIRST), "first_shards")
    found = _searched(trees, queries, first, k)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    nth = F.row_number().over(order)
    # k rows score as much, so nothing below it is wanted.
    known = found.withColumn("rank", nth).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("known"))
    visited = first.groupBy("id", "dim").agg(F.collect_list("shard").alias("visited"))
    raised = queries.join(materialise(known, "kth_scores"), "id", "left").join(visited, ["id", "dim"], "left")
    raised = raised.select("id", "dim", "v", F.greatest("floor", "known").alias("floor"), F.col("visited").alias("seen"))
    raised = materialise(raised, "raised")
    found = found.union(_searched(trees, raised, pairs(trees, raised), k))
    return found.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
