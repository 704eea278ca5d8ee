"""Exact duplicates against a history that is kept as a minimal perfect hash.

The history's distinct digests are dealt to shards by hash. Each shard is a
minimal perfect hash in levels of bit arrays: a digest that meets no other in a
level takes its bit there, the rest go on to the next. The rank of the bit is the
slot, and a slot holds the full digest, the locator of the row that stays and
the size of its group, so a lookup compares all 32 bytes before it believes the
hash. Digests that are no members are grouped among themselves.

A group of copies of any size is cut to one row per task by the partial
aggregation before anything is shuffled by digest, and digests spread evenly
over the shards, so no shard depends on the size of a group.

Defined results: a null text equals the empty text. A null id is smaller than
all others. Of rows with equal text and equal id exactly one stays. An empty
table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktide.llm.common import brought_back, ordered, parts_for, set_aside, text_of, unordered
from sparktide.workspace import materialise

#: Digests a shard of the index is meant for; it is the memory bound of a task.
SHARD_DIGESTS = 16_384

INDEX = "shard long, n long, level_sizes array<long>, levels array<binary>, digests binary, keys binary, rows binary, sizes binary"
GROUPS = "digest binary, key long, row long, size long"

_SPREAD, _MAX_LEVELS = 2, 64


def digest_of(text) -> F.Column:
    """SHA-256 of the text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(text_of(text), 256))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows as (row, key, digest), written once: ``row`` tells repeated rows apart."""
    rows = df.select(ordered(F.col(id_col).cast("long")).alias("key"), digest_of(text_col).alias("digest"))
    return materialise(rows.select(F.monotonically_increasing_id().alias("row"), "key", "digest"), "digests")


def group_digests(rows: DataFrame) -> DataFrame:
    """One row per distinct digest: the row with the largest key, and the size."""
    return rows.groupBy("digest").agg(
        F.max("key").alias("key"), F.max_by("row", "key").alias("row"), F.count("*").alias("size")
    )


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """64 bits of a digest for one level; the digest's own bits are already random."""
    x = words[:, level % 4] ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _build(words: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Sizes and packed bits of the levels for distinct digests."""
    sizes, levels, left = [], [], words
    while len(left):
        if len(levels) == _MAX_LEVELS:
            raise ValueError("digests of an index must be distinct")
        size = _SPREAD * len(left) + 1
        at = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(np.packbits(alone).tobytes())
        left = left[~alone[at]]
    return sizes, levels


def _slots(words: np.ndarray, sizes: list[int], levels: list[bytes]) -> np.ndarray:
    """The slot of each digest; -1 where every level's bit is unset."""
    slots = np.full(len(words), -1, np.int64)
    open_, before = np.arange(len(words)), 0
    for level, (size, packed) in enumerate(zip(sizes, levels, strict=True)):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8), count=size)
        rank = np.cumsum(bits) - 1
        at = (_mixed(words[open_], level) % np.uint64(size)).astype(np.int64)
        found = bits[at] == 1
        slots[open_[found]] = before + rank[at[found]]
        open_, before = open_[~found], before + int(bits.sum())
    return slots


def _words(digests: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)


def _build_shard(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    words = _words(table["digest"])
    sizes, levels = _build(words)
    slots = _slots(words, sizes, levels)
    order = np.argsort(slots)
    held = {c: table[c].to_numpy()[order].astype("<i8").tobytes() for c in ("key", "row", "size")}
    return pa.table(
        {
            "shard": pa.array([table["shard"][0].as_py()], pa.int64()),
            "n": pa.array([len(words)], pa.int64()),
            "level_sizes": pa.array([sizes], pa.list_(pa.int64())),
            "levels": pa.array([levels], pa.list_(pa.binary())),
            "digests": pa.array([words[order].tobytes()], pa.binary()),
            "keys": pa.array([held["key"]], pa.binary()),
            "rows": pa.array([held["row"]], pa.binary()),
            "sizes": pa.array([held["size"]], pa.binary()),
        }
    )


def _shard(n_shards: int) -> F.Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_shards)).alias("shard")


def build_index(groups: DataFrame, n_shards: int) -> DataFrame:
    """The written index over distinct digests: one row per shard."""
    shards = groups.select(_shard(n_shards), "digest", "key", "row", "size")
    return materialise(shards.groupBy("shard").applyInArrow(_build_shard, INDEX), "digest_index")


def _meet(index: pa.Table, groups: pa.Table) -> pa.Table:
    """The groups of a shard after the batch: the slots, changed by their hits, and the nonmembers."""
    parts = []
    hits = np.zeros(groups.num_rows, bool)
    columns = {c: groups[c].to_numpy() for c in ("key", "row", "size")}
    words = _words(groups["digest"])
    if index.num_rows:
        row = {c: index[c][0].as_py() for c in index.column_names}
        held = np.frombuffer(row["digests"], "<u8").reshape(-1, 4)
        key, at, size = (np.frombuffer(row[c], "<i8").copy() for c in ("keys", "rows", "sizes"))
        slots = _slots(words, row["level_sizes"], row["levels"])
        hits = (slots >= 0) & (held[slots] == words).all(axis=1)
        mine = slots[hits]
        later = columns["key"][hits] > key[mine]
        key[mine[later]], at[mine[later]] = columns["key"][hits][later], columns["row"][hits][later]
        size[mine] += columns["size"][hits]
        parts.append((held, key, at, size))
    parts.append((words[~hits], *(columns[c][~hits] for c in ("key", "row", "size"))))
    held, key, at, size = (np.concatenate(x) for x in zip(*parts, strict=True))
    raw = held.tobytes()
    return pa.table(
        {
            "digest": pa.array([raw[i : i + 32] for i in range(0, len(raw), 32)], pa.binary()),
            "key": pa.array(key, pa.int64()),
            "row": pa.array(at, pa.int64()),
            "size": pa.array(size, pa.int64()),
        }
    )


def look_up(groups: DataFrame, index: DataFrame, n_shards: int) -> DataFrame:
    """All groups after a batch met the history, as (digest, key, row, size), written."""
    batch = groups.select(_shard(n_shards), "digest", "key", "row", "size")
    met = index.groupBy("shard").cogroup(batch.groupBy("shard")).applyInArrow(_meet, GROUPS)
    return materialise(met, "digest_groups")


def dedup_groups(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Groups of equal digests over rows of ``digests`` in a history and a batch.

    A row of the batch with a larger key takes the place of the history's.
    """
    groups = materialise(group_digests(history), "history_groups")
    n_shards = parts_for(groups.count(), SHARD_DIGESTS)
    return look_up(group_digests(batch), build_index(groups, n_shards), n_shards)


def _settled(rows: DataFrame) -> DataFrame:
    """The upper half of the keys is the history: its rows win over any later batch."""
    middle = rows.select(F.percentile_approx("key", 0.5)).first()[0]
    upper = F.col("key") >= F.lit(middle)
    return dedup_groups(rows.where(upper), rows.where(~upper))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays.
    """
    rows = digests(df, id_col, text_col)
    groups = _settled(rows).select(
        "digest", F.col("key").alias("keep_key"), F.col("row").alias("keep_row"), F.col("size").alias("group_size")
    )
    return rows.join(groups, "digest").select(
        unordered("key").alias("doc_id"),
        unordered("keep_key").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns, whatever their names."""
    from pyspark.sql import Window

    groups = _settled(digests(df, id_col, text_col))
    winners = groups.select("digest", "key", F.lit(1).alias("stays"))
    plain, names = set_aside(df)
    marked = plain.select("*", digest_of(F.col(names[text_col])).alias("digest"), ordered(F.col(names[id_col]).cast("long")).alias("key"))
    same = Window.partitionBy("digest", "key").orderBy("stays")
    kept = marked.join(winners, ["digest", "key"]).withColumn("nth", F.row_number().over(same))
    return kept.where("nth = 1").select(*brought_back(names))
