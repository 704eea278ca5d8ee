"""Where captured events go: files, or a bounded buffer of the latest ones."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sparktide.functions import temporal
from sparktide.operators import ordering
from sparktide.workspace import new_path

# Up to this many rows per key Spark limits each group before the shuffle.
GROUP_LIMIT = 1_000
# Parts of a key that are joined to one at a time.
FEWER = 32

HELD = "held"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Events are held as text that gives every value back.
AS_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timeZone": "UTC",
}


def event_stream(spark: SparkSession, folder: str, table: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream over a table's files, be the table one file or a folder of them."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A pattern is accepted where the path of a single file is not.
    return reader.parquet(f"{folder}/{table}.parque[t]")


def event_file_sink(
    stream: DataFrame, path: str, checkpoint: str, name: str | None = None, target: str | None = None
) -> StreamingQuery:
    """Write captured events to files, each exactly once, until the source is read; a folder per value of ``target``."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if target:
        writer = writer.partitionBy(target)
    if name:
        writer = writer.queryName(name)
    return writer.outputMode("append").trigger(availableNow=True).start(path)


def captured(stream: DataFrame, label: str, target: str | None = None) -> DataFrame:
    """Run a capture over what the source holds now and return what it wrote."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    event_file_sink(stream, f"{path}/events", f"{path}/checkpoint", target=target).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/events")


def restart_capture(
    spark: SparkSession, name: str, start: Callable[[], StreamingQuery]
) -> StreamingQuery:
    """Stop the running capture of that name, if any, and start it anew."""
    for query in spark.streams.active:
        if query.name == name:
            query.stop()
    return start()


def recent_events(
    df: DataFrame, n: int, by: Sequence[Column], key: str | None = None, spread: int = 1024
) -> DataFrame:
    """The ``n`` latest events of each key, or of all without a key.

    ``by`` is the order, latest first, and must be unique. For small ``n`` the
    groups are cut before the shuffle; for a large one each key is first cut
    in ``spread`` parts and then in ever fewer, so no task sorts a whole hot key
    or more than ``n`` rows of ``FEWER`` parts.
    """
    if key is None:
        return ordering.top_n(df, n, *by)
    parts = spread if n > GROUP_LIMIT else 1
    while parts > 1:
        df = _first_of(df.withColumn("_part", _part(df, parts)), n, by, key, "_part").drop("_part")
        parts //= FEWER
    return _first_of(df, n, by, key)


def _first_of(df: DataFrame, n: int, by: Sequence[Column], *keys: str) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def _part(df: DataFrame, parts: int) -> Column:
    """One of ``parts`` by all columns of a row; maps can't be hashed."""
    return F.pmod(F.xxhash64(*[f.name for f in df.schema if "map<" not in f.dataType.simpleString()]), F.lit(parts))


def _place_in_time(df: DataFrame, col: str) -> Column:
    """A number that orders a column of whole numbers, dates or times; null comes before all."""
    kind, value = df.schema[col].dataType, F.col(col)
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        value = temporal.micros_between(F.lit("1970-01-01").cast("timestamp_ntz"), value)
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif not isinstance(kind, T.IntegralType):
        raise ValueError(f"events can't be ordered by {col}: {kind.simpleString()}")
    return F.coalesce(value.cast("long"), F.lit(-(2**63)))


class _Latest(StatefulProcessor):
    """Holds the ``n`` latest events of a key: a list of (order ..., event)."""

    def __init__(self, n: int, schema: T.StructType):
        self.n, self.schema = n, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState(HELD, self.schema)

    def handleInputRows(self, key, rows, timerValues):
        names = self.schema.names
        order = names[:-1]
        kept = list(self.held.get())
        for chunk in rows:
            fresh = chunk.nlargest(self.n, order)
            kept += zip(*[fresh[c].tolist() for c in names], strict=True)
            kept = heapq.nlargest(self.n, kept, key=lambda row: row[:-1])
        self.held.put(kept)
        return iter(())

    def close(self) -> None:
        pass


def ring_buffer(
    stream: DataFrame, n: int, by: Sequence[str], key: str | None, checkpoint: str, spread: int = 32
) -> StreamingQuery:
    """Keep the ``n`` latest events of each key, to be read with ``read_ring_buffer``.

    The buffer is the state of the stream: a micro-batch writes the keys it brings events of
    and nothing else, a replayed one starts from the state before it, and equal events stay
    several. ``by`` names columns of whole numbers, dates or times, the latest first; together
    they must be unique but for equal events. Each key is dealt to ``spread`` lists of ``n``
    events, so a hot one is held by several tasks.
    """
    spark = stream.sparkSession
    order = {f"order_{i}": _place_in_time(stream, c) for i, c in enumerate(by)}
    event = F.to_json(F.struct(*stream.columns), AS_TEXT).alias("event")
    group = {"part": _part(stream, spread)} | ({} if key is None else {"key": F.col(key)})
    rows = stream.select(*[c.alias(a) for a, c in (group | order).items()], event)
    held = T.StructType([*[T.StructField(a, T.LongType()) for a in order], T.StructField("event", T.StringType())])
    latest = rows.groupBy(*group).transformWithStateInPandas(
        _Latest(n, held), T.StructType([T.StructField("nothing", T.LongType())]), "Update", "None"
    )
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)  # the store that keyed lists need
    try:
        # Nothing is put out: who wants the buffer reads the state.
        return (
            latest.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)


def read_ring_buffer(
    spark: SparkSession, checkpoint: str, schema: T.StructType, n: int, by: Sequence[str], key: str | None
) -> DataFrame:
    """What the buffer of a checkpoint holds; arguments as for ``ring_buffer``, ``schema`` that of its stream."""
    state = spark.read.format("statestore").option("stateVarName", HELD).load(checkpoint)
    events = state.select(F.from_json("list_element.event", schema, AS_TEXT).alias("event")).select("event.*")
    return recent_events(events, n, [F.col(c).desc() for c in by], key)
