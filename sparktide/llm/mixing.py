"""Mixing sources to target weights by whole blocks of equal size.

Sizes are words. A source's target is its share, by weight, of what the mix takes
in all; no target goes beyond ``most`` times its source, and what is cut off is
shared again by weight among the others until none is above.

Each source is dealt to shards by a seeded hash and the documents of a shard stand
in a seeded order, so their words form one stream that is cut into blocks. The
blocks of the mix are apportioned to all (source, shard) cells by highest
quotients votes / (2 j - 1), the votes being the cell's part of the target. A quota
takes every block of its cell equally often and a seeded run of blocks once more.
A document gets the words of its blocks, so at most ``most`` times its size.

The highest quotients are not sorted: the divisor is narrowed by sums over the
cells, many candidates a pass, and only the quotients next to it are ranked.

Defined results: a null text has no words. Null sources are one source, last in
order. Documents without words take nothing. Where all targets are zero nothing is
taken. Repeated rows count like any others. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktide.llm.common import WORD, brought_back, ordered, set_aside, text_of, unordered, words_in
from sparktide.operators.ordering import number_rows
from sparktide.workspace import materialise


@dataclass(frozen=True)
class Mix:
    """What to take. The block is ``block`` words, or less so that every source has ``least_blocks``."""

    share: float = 1.5
    weights: tuple[int, ...] = (3, 1, 2)
    most: int = 2
    block: int = 1_024
    least_blocks: int = 256
    shard_words: int = 262_144
    shard_rows: int = 65_536
    seed: int = 42


#: Divisors tried in one pass over the cells.
TRIES = 32


def _hash(*parts) -> F.Column:
    """32 seeded bits, the same in any engine that has MD5."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, F.Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _measured(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    rows = df.select(
        ordered(F.col(id_col).cast("long")).alias("key"), F.col(source_col).alias("source"), words_in(text_col).alias("size"),
        F.xxhash64(text_of(text_col)).alias("digest"),
    )
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")


def targets(rows: DataFrame, mix: Mix) -> DataFrame:
    """(source, place, rows, source_size, target) per source, written."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    placed = number_rows(sums, [F.col("source").asc_nulls_last()], "place", start=0)
    weights = F.array(*[F.lit(w) for w in mix.weights])
    placed = materialise(
        placed.withColumn("weight", F.element_at(weights, (F.col("place") % len(mix.weights) + 1).cast("int"))), "places"
    )
    most = (F.lit(mix.most) * F.col("source_size")).cast("double")
    wanted = (placed.agg(F.sum("source_size")).first()[0] or 0) * mix.share
    left, weight, capped = wanted, None, -1
    above = F.lit(False)
    while True:
        row = placed.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count_if(above).alias("n"),
        ).first()
        if row.n == capped:
            break
        left, weight, capped = wanted - row.full, row.weight, row.n
        if not weight:
            break
        above = F.lit(left) * F.col("weight") / F.lit(weight) > most
    shared = F.lit(left) * F.col("weight") / F.lit(weight) if weight else most
    target = F.when(above, most).otherwise(shared).cast("double")
    return materialise(placed.select("source", "place", "rows", "source_size", target.alias("target")), "targets")


def apportion(cells: DataFrame, seats: int, order: list[str]) -> DataFrame:
    """``cells`` (votes double, most long) with ``quota`` by highest quotients.

    Equal quotients go by ``order``. No cell gets more than ``most``. If the
    cells can't take all seats, each is full.
    """

    def quota(times: float) -> F.Column:
        return F.floor(F.least(F.col("most").cast("double"), F.col("votes") * F.lit(times) + F.lit(0.5))).cast("long")

    votes, room = cells.agg(F.sum("votes"), F.sum(F.when(F.col("votes") > 0, F.col("most")))).first()
    if not votes or seats <= 0:
        return cells.withColumn("quota", F.lit(0).cast("long"))
    if room <= seats:
        return cells.withColumn("quota", F.when(F.col("votes") > 0, F.col("most")).otherwise(F.lit(0)).cast("long"))
    low, high = 0.0, 2.0 * seats / votes
    below, over = 0, None
    # Seats are fewer than there is room for, so some divisor overshoots; between two
    # divisors next to each other nothing is left to narrow.
    while over is None or (over - below > 64 and low < (low + high) / 2 < high):
        tried = [low + (high - low) * k / TRIES for k in range(1, TRIES + 1)]
        sums = cells.agg(*[F.sum(quota(t)).alias(f"s{k}") for k, t in enumerate(tried)]).first()
        for t, n in zip(tried, sums, strict=True):
            if n <= seats:
                low, below = t, n
            else:
                high, over = t, n
                break
        else:
            high *= 1 << 20
    base = F.greatest(F.lit(0), quota(low) - 1)
    top = F.least(F.col("most"), quota(high) + 1)
    started = materialise(cells.withColumns({"_base": base, "_top": top}), "seats")
    held = started.agg(F.sum("_base")).first()[0]
    next_ones = started.where("_top > _base").withColumn("_seat", F.explode(F.sequence(F.col("_base") + 1, F.col("_top"))))
    next_ones = next_ones.select(*order, (F.col("votes") / (2 * F.col("_seat") - 1)).alias("_quotient"))
    won = number_rows(next_ones, [F.col("_quotient").desc(), *order], "_rank").where(F.col("_rank") <= seats - held)
    won = materialise(won.groupBy(*order).agg(F.count("*").alias("_won")), "won_seats")
    return (
        started.join(won, order, "left")
        .withColumn("quota", F.col("_base") + F.coalesce("_won", F.lit(0)))
        .drop("_base", "_top", "_won")
    )


def _overlap(first: F.Column, end: F.Column) -> F.Column:
    return F.greatest(F.lit(0), F.least(F.col("stop"), end) - F.greatest(F.col("start"), first))


def mixed(df: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: key, digest, source, size, source_size, target, and what the mix takes of it.

    ``whole`` counts full copies, (``from1``, ``to1``) and (``from2``, ``to2``) are
    ranges of its words taken once more, ``taken`` is the sum in words.
    """
    rows = _measured(df, id_col, text_col, source_col)
    per_source = targets(rows, mix)
    facts = per_source.agg(
        F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).alias("least"), F.sum("source_size").alias("total")
    ).first()
    block = max(1, min(mix.block, (facts.least or 0) // mix.least_blocks))
    seats = int((facts.total or 0) * mix.share / block + 0.5)
    shards = F.greatest(
        F.lit(1), F.ceil(F.col("source_size") / mix.shard_words), F.ceil(F.col("rows") / mix.shard_rows)
    ).cast("long")
    known = per_source.select(F.col("source").alias("_source"), "place", "source_size", "target", shards.alias("shards"))
    dealt = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).select(
        "row", "key", "digest", "source", "size", "place", "source_size", "target",
        (_hash(mix.seed, F.col("key")) % F.col("shards")).alias("shard"),
    )
    dealt = materialise(dealt, "dealt")
    cells = dealt.groupBy("place", "shard").agg(
        F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("of")
    )
    cells = materialise(
        cells.select(
            "place",
            "shard",
            "words",
            F.ceil(F.col("words") / block).cast("long").alias("blocks"),
            F.when(F.col("of") > 0, F.col("target") * F.col("words") / F.col("of")).otherwise(0.0).alias("votes"),
        ).withColumn("most", F.col("blocks") * mix.most),
        "cells",
    )
    quotas = apportion(cells, seats, ["place", "shard"])
    b = F.greatest(F.col("blocks"), F.lit(1))
    quotas = quotas.select(
        "place", "shard", "words", F.floor(F.col("quota") / b).cast("long").alias("whole"),
        (F.col("quota") % b).alias("more"), b.alias("b"), (_hash(mix.seed, F.col("place"), F.col("shard")) % b).alias("at"),
    )
    last = F.col("at") + F.col("more")
    quotas = quotas.select(
        "place", "shard", "whole",
        F.when(F.col("more") > 0, F.col("at") * block).otherwise(0).alias("first1"),
        F.when(F.col("more") > 0, F.least(last * block, F.col("words"))).otherwise(0).alias("end1"),
        F.when(last > F.col("b"), (last - F.col("b")) * block).otherwise(0).alias("end2"),
    )
    in_order = Window.partitionBy("place", "shard").orderBy(F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("key").cast("string"))), "key", "size", "digest", "row")
    stream = dealt.withColumn("stop", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    stream = stream.withColumn("start", F.col("stop") - F.col("size"))
    chosen = stream.join(materialise(quotas, "quotas"), ["place", "shard"])

    def ends(first: F.Column, end: F.Column) -> tuple[F.Column, F.Column]:
        some = _overlap(first, end) > 0
        a = F.when(some, F.greatest(F.col("start"), first) - F.col("start")).otherwise(0)
        return a, F.when(some, F.least(F.col("stop"), end) - F.col("start")).otherwise(0)

    from1, to1 = ends(F.col("first1"), F.col("end1"))
    from2, to2 = ends(F.lit(0), F.col("end2"))
    cut = chosen.select(
        "key", "digest", "source", "size", "source_size", "target", "whole",
        from1.alias("from1"), to1.alias("to1"), from2.alias("from2"), to2.alias("to2"),
    )
    taken = F.col("whole") * F.col("size") + F.col("to1") - F.col("from1") + F.col("to2") - F.col("from2")
    return cut.withColumn("taken", taken.cast("long"))


def shares(df: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    return mixed(df, mix).select(unordered("key").alias("doc_id"), "size", "source_size", "target", "taken")


def take(df: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``df``, whatever their names: a row per copy, cut texts where a block ends inside a document.

    Rows that repeat an id, a source and a text share their cuts as one array: the only
    thing here that grows with the repeats of one row.
    """
    same = ["key", "source", "none", "digest"]
    cut = F.struct("whole", "from1", "to1", "from2", "to2")
    cuts = mixed(df, mix, id_col, text_col, source_col).select("key", *_named(F.col("source")), "digest", cut.alias("cut"))
    cuts = materialise(cuts.groupBy(*same).agg(F.array_sort(F.collect_list("cut")).alias("cuts")), "cuts")
    plain, names = set_aside(df)
    text = F.col(names[text_col])
    marked = plain.select(
        "*",
        ordered(F.col(names[id_col]).cast("long")).alias("key"),
        *_named(F.col(names[source_col])),
        F.xxhash64(text_of(text)).alias("digest"),
    )
    # The window and the join need the same partitions, so the texts are shuffled once.
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("digest"))
    met = marked.withColumn("nth", nth).join(cuts, same).withColumn("cut", F.element_at("cuts", F.col("nth"))).drop("cuts")
    met = met.withColumn("size", words_in(text)).where("size > 0")
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("z")), F.col("cut.whole").cast("int"))
    parts = F.filter(
        F.array(
            F.struct(F.col("cut.from1").cast("long").alias("a"), F.col("cut.to1").cast("long").alias("z")),
            F.struct(F.col("cut.from2").cast("long").alias("a"), F.col("cut.to2").cast("long").alias("z")),
        ),
        lambda p: p["z"] > p["a"],
    )
    copies = met.withColumn("part", F.explode(F.concat(whole, parts)))
    pieces = F.regexp_extract_all(text_of(text), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    length = (F.col("part.z") - F.col("part.a")).cast("int")
    some = F.array_join(F.slice(pieces, (F.col("part.a") + 1).cast("int"), length), "")
    taken = F.when(length == F.col("size"), text).otherwise(some)
    return copies.withColumn(names[text_col], taken).select(*brought_back(names))


def _named(source: F.Column) -> list[F.Column]:
    """A source for joins, null apart from the empty text."""
    return [F.coalesce(source.cast("string"), F.lit("")).alias("source"), source.isNull().alias("none")]
