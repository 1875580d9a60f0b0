"""Start, watch and stop streaming queries, and read what update mode wrote."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from trackside.functions.parsing import is_sentinel
from trackside.streaming.commits import BATCH, CurrentTable

TRANSIENT_SINKS = ("console", "memory", "noop")

BatchWriter = Callable[[DataFrame, int], None]


def run_stream(
    df: DataFrame,
    sink: str | BatchWriter,
    mode: str,
    checkpoint: str | None = None,
    trigger: Mapping[str, object] | None = None,
    options: Mapping[str, str] | None = None,
    name: str | None = None,
    timeout: float | None = None,
) -> StreamingQuery:
    """Start a query on `df` and return it.

    `sink` is a format name (console, memory, kafka, parquet, ...) or a function
    called with each micro-batch and its number. A sink that outlives the
    process needs a `checkpoint`. Without `trigger` the next batch starts when
    the last is done; ``{"availableNow": True}`` works off what is there and
    ends. With `timeout` (seconds) the call waits that long for the end, then
    stops the query and raises TimeoutError.
    """
    if checkpoint is None and sink not in TRANSIENT_SINKS:
        raise ValueError("a durable sink needs a checkpoint folder")
    writer = df.writeStream.outputMode(mode).options(**(options or {}))
    if callable(sink):
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format(sink)
        if sink == "console":
            writer = writer.option("truncate", False)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    query = writer.start()
    if timeout is not None and not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return query


PARTITIONS = "spark.sql.shuffle.partitions"


def run_through(
    df: DataFrame, sink: str | BatchWriter, mode: str, checkpoint: str, **options
) -> StreamingQuery:
    """Run a query over all that its sources have by now, batch after batch, and stop it.

    For sources that say themselves how much a batch takes, as `ordered.source` does.
    State is in no more parts than tasks run at once: every batch commits each part, and
    the session's number of shuffle partitions, made for whole tables, would cost
    more with each batch. A query that starts again keeps its parts. A failure of
    the query is raised.
    """
    spark = df.sparkSession
    parts = min(int(spark.conf.get(PARTITIONS)), max(spark.sparkContext.defaultParallelism, 2))
    with setting(spark, PARTITIONS, str(parts)):
        query = run_stream(df, sink, mode, checkpoint, {"processingTime": "0 seconds"}, **options)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for the queries that are started inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def versions_writer(path: str) -> BatchWriter:
    """Write each micro-batch under its number as a Parquet partition of `path`.

    A batch that is run again after a failure replaces its own partition, so
    the table holds every batch once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # a path of its own, so that a rerun without rows clears what was there
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def table_writer(path: str) -> BatchWriter:
    """Write each micro-batch in place of the one before, as `CurrentTable` does: for
    complete mode, whose batches hold the whole table. `read_table` reads it."""
    return CurrentTable(path).write


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `table_writer` has put under `path` last."""
    return CurrentTable(path).read(spark, schema)


def read_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `versions_writer` has put under `path`; `schema` is that of the stream.

    Works for a query that has had batches but no rows yet.
    """
    fields = [*schema.fields, T.StructField(BATCH, T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def latest_by_key(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last version of each key: the table that update mode describes."""
    values = [c for c in versions.columns if c not in (*keys, BATCH)]
    last = F.max_by(F.struct(*values), F.col(BATCH)).alias("_last")
    return versions.groupBy(*keys).agg(last).select(*keys, "_last.*")


def last_batch(versions: DataFrame) -> DataFrame:
    """The rows of the last batch: the table that complete mode describes."""
    newest = versions.agg(F.max(BATCH)).scalar()
    return versions.where(F.col(BATCH) == newest).drop(BATCH)


ENDS = "partition string, end bigint"


def run_until_sentinel(
    messages: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    sentinels: int = 1,
    poll: float = 0.5,
    idle: float | None = None,
    value: str = "value",
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery | None:
    """Feed micro-batches of messages to `write` until the sentinels have come.

    A topic with several partitions ends when each has sent its sentinel, so
    `sentinels` is their number. Where the messages have `partition` and
    `offset`, what follows a partition's first sentinel is not passed on, in its
    batch or any later one; without them, in later batches. Sentinels never are.

    The end of each partition is kept beside the checkpoint (a row per
    partition), so a restart knows which have ended; None is returned if all had
    before. There is no limit on time but `idle`: so many seconds without a
    message raise TimeoutError.
    """
    spark = messages.sparkSession
    store = f"{checkpoint.rstrip('/')}-ends"
    placed = {"partition", "offset"} <= set(messages.columns)
    spark.createDataFrame([], ENDS).write.mode("append").parquet(store)
    known = spark.read.schema(ENDS).parquet(store).groupBy("partition").agg(F.min("end"))
    ends: dict[str, int] = dict(known.collect())
    if len(ends) >= sentinels:
        return None

    def found(batch: DataFrame, batch_id: int) -> list[tuple[str, int]]:
        of = batch.where(is_sentinel(value))
        if placed:
            first = of.groupBy(F.col("partition").cast("string")).agg(F.min("offset"))
            return [tuple(r) for r in first.collect()]
        return [("", batch_id)] if of.take(1) else []

    def step(batch: DataFrame, batch_id: int) -> None:
        new = [(p, e) for p, e in found(batch, batch_id) if e < ends.get(p, 2**63 - 1)]
        now = {**ends, **dict(new)}
        kept = batch.where(~is_sentinel(value))
        if placed and now:
            pairs = F.create_map(*(F.lit(x) for pair in now.items() for x in pair))
            end = F.try_element_at(pairs, F.col("partition").cast("string"))
            kept = kept.where(end.isNull() | (F.col("offset") < end))
        elif now:
            kept = kept.where(F.lit(batch_id <= now[""]))
        write(kept, batch_id)
        # only now, since the query is stopped as soon as all ends are known
        if new:
            spark.createDataFrame(new, ENDS).coalesce(1).write.mode("append").parquet(store)
            ends.update(new)

    query = run_stream(messages, step, "append", checkpoint, trigger)
    last, since = None, time.monotonic()
    while not query.awaitTermination(poll):
        if len(ends) >= sentinels:
            query.stop()
            break
        progress = query.lastProgress
        if progress and progress.numInputRows and progress.batchId != last:
            last, since = progress.batchId, time.monotonic()
        if idle is not None and time.monotonic() - since > idle:
            query.stop()
            raise TimeoutError(f"no message for {idle} s")
    return query


def stream_metrics(query: StreamingQuery) -> list[dict]:
    """Progress of the recent batches: rows in, late rows dropped, state size."""
    out = []
    for progress in query.recentProgress:
        state = progress.stateOperators
        out.append(
            {
                "batch_id": progress.batchId,
                "input_rows": progress.numInputRows,
                "rows_per_second": progress.processedRowsPerSecond,
                "late_rows": sum(s.numRowsDroppedByWatermark for s in state),
                "state_rows": sum(s.numRowsTotal for s in state),
                "milliseconds": progress.durationMs.get("triggerExecution"),
            }
        )
    return out
