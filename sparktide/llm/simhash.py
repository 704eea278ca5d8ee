"""Near duplicates by SimHash: fingerprints that meet in the middle of a Hamming ball.

Two fingerprints differ in at most r bits exactly if some value lies within r/2
bits of both, so every fingerprint emits all variants within r/2 flips and equal
variants meet. Variants that share their leading bits go to the same place, and
only those leading bits have to be flipped before the shuffle: a fingerprint
travels once per leading part with the number of flips it has left, and the flips
of the other bits are unfolded where it arrives. That sends tens of rows per
fingerprint in place of thousands and meets the same variants.

Leading parts that many fingerprints share are given more leading bits, again and
again, until each part fits its task: a place of the shuffle has a proven bound.

All fingerprints that meet in one variant are within r bits of each other, so a
place links each of its fingerprints to the smallest one it is connected with
there and no pair is listed twice. Every emitted link lies inside one component;
nothing that grows with the square of a group is made.

Words are runs of anything but blank, tab, newline, vertical tab, form feed and
return, after A-Z became a-z. Fewer words than a shingle has make one shingle; no
words make fingerprint zero, which is linked like any other. A null text is empty.
A null id is smaller than all others. Rows with equal id and text are linked like
other copies. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.llm.common import brought_back, map_batches, ordered, set_aside, text_of, unordered
from sparktide.llm.components import components
from sparktide.workspace import materialise

BITS = 64
SEED = 42
#: Variants that one place of the shuffle may hold; the bound of a task's memory.
PLACE_VARIANTS = 2_097_152
#: Leading bits added at once where a place would hold more.
MORE_BITS = 6
#: Bytes of a text that are cut into words at once.
CHUNK = 1_048_576

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(raw: bytes, keep: int):
    """Lists of words of a lower-cased text; a list starts with the last ``keep`` words of the one before."""
    at, last = 0, []
    while at < len(raw):
        end = at + CHUNK
        if end < len(raw):
            cut = _BLANK.search(raw, end)
            end = cut.start() if cut else len(raw)
        words = last + raw[at:end].split()
        yield words
        last = words[-keep:] if keep else []
        at = end


def shingle_hashes(raw: bytes, width: int):
    """Arrays of the XXH64 of all shingles of a text in UTF-8, in order; none for no words."""
    from xxhash import xxh64_intdigest

    some, head = False, []
    for words in _word_runs(raw.lower(), width - 1):
        if len(words) < width:
            head = head if some else words
            continue
        some = True
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-1]))
        starts, ends = starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist()
        yield np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)], "<u8")
    if not some and head:
        yield np.array([xxh64_intdigest(b" ".join(head), SEED)], "<u8")


def _majority(hashes) -> int:
    """The bits that are set in over half of all hashes, as a signed long."""
    counts, total = np.zeros(BITS, np.int64), 0
    for part in hashes:
        for k in range(0, len(part), 65_536):
            some = part[k : k + 65_536]
            counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        total += len(part)
    value = int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little") if total else 0
    return _signed(value)


def fingerprint(raw: bytes, width: int) -> int:
    """The SimHash of a text in UTF-8 over its shingles of ``width`` words, as a signed long."""
    return _majority(shingle_hashes(raw, width))


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(key, digest, fp) of every row, written once; fp is a signed long, digest the text's XXH64."""
    rows = df.select(
        ordered(F.col(id_col).cast("long")).alias("key"), F.xxhash64(text_of(text_col)).alias("digest"), text_of(text_col).cast("binary").alias("raw")
    )

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            raws = (x.as_py() for x in batch.column("raw"))
            made = pa.array([fingerprint(x, width) for x in raws], pa.int64())
            return {"key": batch.column("key"), "digest": batch.column("digest"), "fp": made}

        return step

    return materialise(map_batches(rows, make, T.StructType.fromDDL("key long, digest long, fp long")), "fingerprints")


def _masks(low: int, high: int, flips: int) -> list[tuple[int, int]]:
    """All (mask, flips) over the bits from ``low`` up to ``high``."""
    return [(sum(1 << b for b in c), k) for k in range(flips + 1) for c in combinations(range(low, high), k)]


def _ball(bits: int, flips: int) -> int:
    return sum(comb(bits, k) for k in range(flips + 1))


def _spread(rows: DataFrame, low: int, high: int, flips: int) -> DataFrame:
    """Each row once per way to flip bits of [low, high) with the flips it has left.

    ``place`` is the leading part down to bit ``low``, ``used`` the flips so far.
    """
    masks = [F.struct(F.lit(_signed(m)).alias("mask"), F.lit(k).alias("cost")) for m, k in _masks(low, high, flips)]
    flipped = rows.withColumn("flip", F.explode(F.array(*masks))).where(F.col("used") + F.col("flip.cost") <= flips)
    moved = flipped.withColumns(
        {"rest": F.col("rest").bitwiseXOR(F.col("flip.mask")), "used": F.col("used") + F.col("flip.cost")}
    ).drop("flip")
    return moved.withColumn("place", _leading(low))


def _leading(low: int) -> F.Column:
    return F.col("rest").bitwiseAND(F.lit(_signed(((1 << BITS) - 1) ^ ((1 << low) - 1))))


def _arriving(rows: DataFrame, low: int, high: int, flips: int) -> DataFrame:
    """(sketch, place, n): the variants that a place is going to hold, visitors from other leading parts with theirs.

    Counts are spread in place of rows: those of one leading part go to the same places.
    """
    own = rows.groupBy("sketch", _leading(low).alias("rest"), "used").agg(F.count("*").alias("n"))
    each = F.element_at(F.array(*[F.lit(_ball(low, flips - used)) for used in range(flips + 1)]), F.col("used") + 1)
    return _spread(own, low, high, flips).groupBy("sketch", "place").agg(F.sum(F.col("n") * each).alias("n"))


def _variants(rest: np.ndarray, used: np.ndarray, low: int, flips: int) -> tuple[np.ndarray, np.ndarray]:
    """All variants that reach a place, and whose they are."""
    values, owners = [], []
    for spent in range(flips + 1):
        mine = np.flatnonzero(used == spent)
        masks = np.array([m for m, _ in _masks(0, low, flips - spent)], np.uint64)
        values.append((rest[mine][:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(mine.astype(np.int32), len(masks)))
    return np.concatenate(values), np.concatenate(owners)


def _met(values: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners of the values that occur twice, value by value, and where each value's run starts."""
    ordered_values = np.sort(values)
    twice = np.unique(ordered_values[1:][ordered_values[1:] == ordered_values[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(1 << 20, bool)
    seen[(twice & np.uint64(0xFFFFF)).astype(np.int64)] = True
    maybe = seen[(values & np.uint64(0xFFFFF)).astype(np.int64)]
    values, owners = values[maybe], owners[maybe]
    run = np.searchsorted(twice, values)
    run[run == len(twice)] = 0
    hit = twice[run] == values
    run, owners = run[hit], owners[hit].astype(np.int64)
    order = np.lexsort((owners, run))
    run, owners = run[order], owners[order]
    return owners, np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))


def _roots(owners: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """For n owners: the smallest owner each is connected with through runs of ``_met``."""
    roots = np.arange(n, dtype=np.int64)
    lengths = np.diff(np.append(starts, len(owners)))
    while len(owners):
        least = np.repeat(np.minimum.reduceat(roots[owners], starts), lengths)
        new = roots.copy()
        np.minimum.at(new, roots[owners], least)
        np.minimum.at(new, owners, least)
        new = new[new]
        if (new == roots).all():
            break
        roots = new
    return roots


def _links_of(low: int, flips: int):
    def links(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        rest = table["rest"].to_numpy()[order].view(np.uint64)
        used = table["used"].to_numpy()[order]
        owners, starts = _met(*_variants(rest, used, low, flips))
        if not len(owners):
            a = b = ids[:0]
        else:
            roots = _roots(owners, starts, len(ids))
            linked = roots != np.arange(len(ids))
            a, b = ids[roots[linked]], ids[linked]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return links


def near_links(prints: DataFrame, radius: int = 4, bits: int = BITS) -> DataFrame:
    """Links (a, b) of ids that connect all distinct fingerprints within ``radius`` bits.

    ``prints`` has id, sketch and fp; only fingerprints of one sketch meet. Every
    link joins members of one component; fingerprints within the radius are
    connected, if not always by a link of their own.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even, so that its half is whole")
    flips, keys = radius // 2, ["sketch", "place"]
    n = prints.groupBy("sketch").count().agg(F.max("count")).first()[0] or 0
    # Evenly spread variants fill a place by half at most.
    first = max(0, min(bits, int(log2(max(1, n * _ball(bits, flips) / PLACE_VARIANTS)) + 2)))
    rows, high = prints.select("id", "sketch", F.col("fp").alias("rest"), F.lit(0).alias("used")), bits
    found = None
    while True:
        low = high - first if high == bits else max(0, high - MORE_BITS)
        placed = _spread(rows, low, high, flips)
        heavy = materialise(_arriving(rows, low, high, flips).where(F.col("n") > PLACE_VARIANTS).select(*keys), "heavy_places")
        last = low == 0 or heavy.isEmpty()
        fitting = placed if last else placed.join(heavy, keys, "left_anti")
        links = fitting.groupBy(*keys).applyInArrow(_links_of(low, flips), "a long, b long")
        found = links if found is None else found.union(links)
        if last:
            return found
        rows = materialise(placed.join(heavy, keys, "left_semi").drop("place"), "heavy_rows")
        high = low


def near_groups(rows: DataFrame, radius: int = 4) -> DataFrame:
    """(fp, component) of every distinct fingerprint: the smallest key that can be reached."""
    prints = materialise(rows.groupBy("fp").agg(F.min("key").alias("id")), "prints")
    roots = components(near_links(prints.withColumn("sketch", F.lit(0)), radius))
    roots = roots.select(F.col("node").alias("id"), "root")
    return materialise(
        prints.join(roots, "id", "left").select("fp", F.coalesce("root", "id").alias("component")), "near_groups"
    )


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """One row per row of ``df``: doc_id, fingerprint, component_id."""
    rows = fingerprints(df, id_col, text_col, width)
    groups = near_groups(rows, radius)
    return rows.join(groups, "fp").select(
        unordered("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        unordered("component").alias("component_id"),
    )


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``df``, of each group of near duplicates only the document with the smallest id.

    Rows with equal id and text are one document: they stay or go together. All columns
    of ``df`` stay, whatever their names.
    """
    rows = fingerprints(df, id_col, text_col, width)
    gone = rows.join(near_groups(rows, radius), "fp").where("key <> component").select("key", "digest").distinct()
    gone = materialise(gone, "near_dropped")
    plain, names = set_aside(df)
    text = F.col(names[text_col])
    marked = plain.withColumns({"key": ordered(F.col(names[id_col]).cast("long")), "digest": F.xxhash64(text_of(text))})
    return marked.join(gone, ["key", "digest"], "left_anti").select(*brought_back(names))
