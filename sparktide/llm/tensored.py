"""Near duplicates by MinHash with tensored banding, every link confirmed on whole sets.

Two collections of ``halves`` half keys each, a half key made of ``rows`` minima, give
halves^2 table keys: each half key of the first collection with each of the second. A
pair of similarity s shares a table key exactly if it shares a half key in both
collections, which has the chance (1 - (1 - s^rows)^halves)^2, whatever the number of
documents: 0.9999 at 0.8 with 14 half keys of 3. 196 tables of 6 minima each so cost 84
minima in place of 1,176. Half keys that only one document has can't be in a shared
table key and are dropped before keys are combined.

Equal sets are one member, named by their smallest id. Candidates are confirmed in two
steps, so that no bucket is ever written out as pairs. First each member is held against
one bucket head, the one it meets most often: a group of near copies falls into few
components by as many pairs as it has members. Members of buckets that still hold several
components go on to an exact join: shingles are ranked from rare to frequent, and a pair
that is similar enough shares a shingle in the first fifth of the longer set and the
first ninth of the shorter one (at 0.8). Of such a shingle's documents only those outside
its largest component ask, so a component of any size costs no pairs of its own, and
documents written on one template have their common shingles behind those places.

Sets are distinct shingles of ``width`` words as 64-bit hashes; links are confirmed on
all of them. Words are runs of anything but blank, tab, newline, vertical tab, form feed
and return, after A-Z became a-z.

Defined results: a null text is empty. Fewer words than a shingle has make one shingle;
without words the set is empty and linked with nothing. A null id is smaller than all
others. Rows with equal ids are one document: what links to one links to all. Other
columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparktide.llm.common import map_batches, ordered, text_of, unordered
from sparktide.llm.components import components
from sparktide.llm.simhash import shingle_hashes
from sparktide.workspace import materialise

#: Minima of a half key, and half keys of each of the two collections.
ROWS = 3
HALVES = 14
#: Shingles that are hashed for all minima at once.
CHUNK = 1_024
#: Ids (8 bytes each) that may go to every task; with more, texts are shuffled to meet theirs.
BROADCAST_IDS = 262_144

_MIX = np.uint64(0x9E3779B97F4A7C15)


def chance(similarity: float, rows: int = ROWS, halves: int = HALVES) -> float:
    """The chance that a pair of this similarity shares a table key."""
    return (1 - (1 - similarity**rows) ** halves) ** 2


def halves_for(similarity: float, recall: float, rows: int = ROWS) -> int:
    """The least number of half keys a collection with which such a pair meets with this chance."""
    met = similarity**rows
    return 1 if met >= 1 else max(1, int(np.ceil(log(1 - recall**0.5) / log1p(-met))))


def _numbers(n: int, seed: int) -> np.ndarray:
    """n well mixed 64-bit numbers."""
    x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * _MIX
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class HalfKeys:
    """The half keys of both collections for one set of shingle hashes after the other."""

    def __init__(self, rows: int, halves: int):
        self.rows, self.n = rows, 2 * halves
        self.factors = (_numbers(rows * self.n, 1) | np.uint64(1))[:, None]
        self.offsets = _numbers(rows * self.n, 2)[:, None]
        self.salts = _numbers(self.n, 3)
        self._room = np.empty((rows * self.n, CHUNK), np.uint64)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), 2**64 - 1, np.uint64)
        for k in range(0, len(shingles), CHUNK):
            some = shingles[k : k + CHUNK]
            room = self._room[:, : len(some)]
            np.multiply(self.factors, some[None, :], out=room)
            room += self.offsets
            np.minimum(least, room.min(axis=1), out=least)
        keys = self.salts.copy()
        for row in least.reshape(self.n, self.rows).T:
            keys = (keys ^ row) * _MIX
            keys ^= keys >> np.uint64(29)
        return keys.view(np.int64)


def shingle_set(raw: bytes, width: int) -> np.ndarray:
    """The distinct shingle hashes of a text in UTF-8, in order."""
    parts = list(shingle_hashes(raw, width))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, "<u8")


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(ordered(F.col(id_col).cast("long")).alias("id"), text_of(text_col).cast("binary").alias("raw"))


def _sketched(texts: DataFrame, width: int, rows: int, halves: int) -> DataFrame:
    """(id, same, size, halves) of every text, written; ``same`` is equal for equal sets."""

    def make():
        from xxhash import xxh3_128_digest

        keys = HalfKeys(rows, halves)

        def step(batch: pa.RecordBatch) -> dict:
            made = {"id": batch.column("id"), "same": [], "size": [], "halves": []}
            for x in batch.column("raw"):
                shingles = shingle_set(x.as_py(), width)
                made["same"].append(xxh3_128_digest(shingles.tobytes()))
                made["size"].append(len(shingles))
                made["halves"].append(keys.of(shingles) if len(shingles) else None)
            return made

        return step

    return materialise(map_batches(texts, make, StructType.fromDDL("id long, same binary, size long, halves array<long>")), "sketched")


def _sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(id, same, shingles) of the texts of the written ids ``wanted``, written."""
    few = wanted.count() <= BROADCAST_IDS
    chosen = texts.join(F.broadcast(wanted) if few else wanted, "id", "left_semi")

    def make():
        from xxhash import xxh3_128_digest

        def step(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(x.as_py(), width) for x in batch.column("raw")]
            return {"id": batch.column("id"), "same": [xxh3_128_digest(s.tobytes()) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

        return step

    return materialise(map_batches(chosen, make, StructType.fromDDL("id long, same binary, shingles array<long>")), "shingle_sets")


def _ceil(top: F.Column, bottom: int) -> F.Column:
    return F.ceil(top / F.lit(bottom)).cast("long")


def _confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The written pairs (a, b) whose whole sets are similar enough; a set travels once for each pair it is b of."""
    right = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("other")), "b")
    both = right.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("one")), "a")
    common = F.size(F.array_intersect("one", "other"))
    # Texts without words may stand beside others of a repeated id; they link nothing.
    similar = (common > 0) & (common * (100 + least) >= least * (F.size("one") + F.size("other")))
    return materialise(both.where(similar).select("a", "b").distinct(), "confirmed")


def _buckets(nodes: DataFrame, halves: int) -> DataFrame:
    """(key, n, head, id): the members of the table keys that several have, written."""
    half = nodes.select("id", F.posexplode("halves").alias("at", "half"))
    shared = materialise(half.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half"), "shared_halves")
    met = half.join(shared, "half").groupBy("id").agg(
        F.collect_list(F.when(F.col("at") < halves, F.col("half"))).alias("first"),
        F.collect_list(F.when(F.col("at") >= halves, F.col("half"))).alias("second"),
    )
    met = materialise(met.where((F.size("first") > 0) & (F.size("second") > 0)), "met_halves")
    keys = met.select("id", F.explode("first").alias("half"), "second").select("id", "half", F.explode("second").alias("other"))
    keys = keys.select("id", F.xxhash64("half", "other").alias("key"))
    heads = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("head")).where("n > 1")
    return materialise(keys.join(materialise(heads, "heads"), "key"), "members")


def _open(members: DataFrame, roots: DataFrame, tested: DataFrame) -> DataFrame:
    """(id, root) of members of buckets that hold several components, written; buckets of one tested pair are done."""
    named = members.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = materialise(named, "named_members")
    several = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("n").alias("n"), F.max("id").alias("b"), F.min("id").alias("a"))
    several = several.where("low <> high").join(tested.withColumn("done", F.lit(True)), ["a", "b"], "left")
    several = materialise(several.where("n > 2 OR done IS NULL").select("key"), "open_buckets")
    return materialise(named.join(several, "key", "left_semi").select("id", "root").distinct(), "open_members")


def _prefix_pairs(sets: DataFrame, members: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of ``members`` (id, root) of different roots that can be similar enough, written."""
    once = sets.join(members, "id").dropDuplicates(["id", "same"])
    tokens = once.select("id", "same", "root", F.size("shingles").cast("long").alias("size"), F.explode("shingles").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    shared = materialise(tokens.join(materialise(counts, "token_counts"), "token"), "shared_tokens")
    # Shingles of one member only come first and are counted, not listed.
    listed = shared.groupBy("id", "same").agg(F.count("*").alias("listed"))
    rank = F.row_number().over(Window.partitionBy("id", "same").orderBy("f", "token"))
    placed = shared.withColumn("rank", rank).join(materialise(listed, "listed_tokens"), ["id", "same"])
    placed = placed.withColumn("place", F.col("size") - F.col("listed") + F.col("rank"))
    asking = F.col("size") - _ceil(F.col("size") * least, 100) + 1
    answering = F.col("size") - _ceil(F.col("size") * 2 * least, 100 + least) + 1
    rows = placed.where(F.col("place") <= asking).select("token", "id", "root", "size", "place", (F.col("place") <= answering).alias("answers"))
    rows = materialise(rows, "prefixes")
    roots = rows.groupBy("token", "root").agg(F.count("*").alias("own"))
    roots = roots.groupBy("token").agg(F.count("*").alias("n"), F.max_by("root", F.struct("own", "root")).alias("major")).where("n > 1")
    held = materialise(rows.join(materialise(roots.select("token", "major"), "mixed_tokens"), "token"), "met_prefixes")
    minor = held.where("root <> major").drop("major")
    other = held.select("token", *[F.col(c).alias(f"{c}2") for c in ("id", "root", "size", "place", "answers")])
    small, large = F.least("size", "size2"), F.greatest("size", "size2")
    rest = F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2")) + 1
    fits = (small * 100 >= large * least) & (rest * (100 + least) >= least * (F.col("size") + F.col("size2")))
    answered = F.when(F.col("size") < F.col("size2"), F.col("answers")).when(F.col("size") > F.col("size2"), F.col("answers2")).otherwise(True)
    met = minor.join(other, "token").where((F.col("root") != F.col("root2")) & answered & fits)
    return materialise(met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct(), "prefix_pairs")


def similar_documents(
    df: DataFrame, width: int = 5, least: int = 80, rows: int = ROWS, halves: int = HALVES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, size, root) of every row: shingles of its set, and the smallest id it is linked with.

    Linked are sets with 100 * common >= ``least`` * all.
    """
    if not 0 < least <= 100:
        raise ValueError("the least similarity is a percentage above 0")
    texts = _texts(df, id_col, text_col)
    sketched = _sketched(texts, width, rows, halves)
    some = sketched.where("size > 0")
    nodes = some.groupBy("same").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("halves").alias("halves"))
    nodes = materialise(nodes, "distinct_sets")
    copies = some.select("same", F.col("id").alias("b")).join(nodes.where("n > 1").select("same", F.col("id").alias("a")), "same")
    copies = copies.where("a <> b").select("a", "b")
    members = _buckets(nodes, halves)
    sets = _sets(texts, materialise(members.select("id").distinct(), "met_ids"), width)
    hits = members.where("id <> head").groupBy("id", "head").agg(F.count("*").alias("hits"))
    tested = hits.groupBy(F.col("id").alias("b")).agg(F.min_by("head", F.struct(-F.col("hits"), "head")).alias("a")).select("a", "b")
    tested = materialise(tested, "head_pairs")
    roots = components(copies.union(_confirmed(tested, sets, least)))
    pairs = _prefix_pairs(sets, _open(members, roots, tested), least)
    # Only components are linked now, so the second search starts from their roots.
    found = _confirmed(pairs, sets, least)
    for end in ("a", "b"):
        found = found.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
        found = found.withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    later = components(found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    later = later.select(F.col("node").alias("root"), F.col("root").alias("last"))
    named = sketched.select("id", "size").join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    named = named.withColumn("root", F.coalesce("root", "id")).join(later, "root", "left")
    return named.select("id", "size", F.coalesce("last", "root").alias("root"))


def near_duplicates(df: DataFrame, width: int = 5, least: int = 80) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, kept."""
    return similar_documents(df, width, least).select(
        unordered("id").alias("doc_id"), F.col("size").alias("n_shingles"), unordered("root").alias("component_id"), (F.col("id") == F.col("root")).alias("kept")
    )
