"""Message files in order: a log of what was sent, and a source that follows it.

A send cuts its messages into slices by time and each slice into topic partitions;
many tasks write the files, in any order. What the order is stands in the log, a row
per file with slice, partition, first offset, count and time range, written once all
files are there. The source takes its offsets from the log, so a micro-batch holds
whole slices in the order sent, and messages have the `partition` and `offset` that a
broker would give them.

One send at a time may go to a folder; readers come and go as they like.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from trackside.sources.topics import SENTINEL

SCHEMA = "topic string, partition int, offset bigint, key string, sent_at timestamp, value string"
LOG = (
    "topic string, slice bigint, partition int, first_offset bigint, n bigint, "
    "first_at timestamp, last_at timestamp, path string"
)
SLICE_ROWS = 1_000_000
FORMAT = "ordered_topic"


# -- writing -----------------------------------------------------------------


def sent_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log: a row per file, `slice` rising in the order of sending."""
    try:
        return spark.read.schema(LOG).parquet(f"{folder}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def send(
    messages: DataFrame,
    folder: str,
    partitions: Mapping[str, int] | int = 1,
    slices: int | Column | None = None,
) -> None:
    """Append messages (`topic`, `value`, `sent_at`, maybe `key`) to message files.

    Messages are cut into `slices` ranges of `sent_at` (about a million each by
    default); those of one time stay together. A column says instead which slice each
    belongs to: a whole number from 0 on that rises with time. Within a topic, messages of a
    key go to one of its `partitions`, by a hash, and those without one to all of them.
    Nothing of a send can be read before all of it can.
    """
    spark = messages.sparkSession
    if "key" not in messages.columns:
        messages = messages.withColumn("key", F.lit(None).cast("string"))
    if isinstance(slices, Column):
        messages, order = messages.withColumn("slice", slices.cast("int")), ["slice"]
    else:
        n = slices or max(1, -(-messages.count() // SLICE_ROWS))
        messages, order = messages.withColumn("slice", F.lit(None).cast("int")), [n, "sent_at"]
    if isinstance(partitions, Mapping):
        pairs = [F.lit(x) for pair in partitions.items() for x in pair]
        of = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("topic")), F.lit(1))
    else:
        of = F.lit(partitions)
    send_id = uuid.uuid4().hex
    data = f"{folder}/data/{send_id}"
    (
        messages.select("topic", "key", F.col("sent_at").cast("timestamp").alias("sent_at"), "value", "slice")
        .repartitionByRange(*order)
        .withColumns(
            {
                "slice": F.coalesce("slice", F.spark_partition_id()),
                "partition": F.pmod(F.nvl2("key", F.xxhash64("key"), F.xxhash64("sent_at", "value")), of).cast("int"),
            }
        )
        .sortWithinPartitions("topic", "slice", "partition", "sent_at")
        .write.partitionBy("topic", "slice", "partition")
        .parquet(data)
    )
    schema = "key string, sent_at timestamp, value string, topic string, slice int, partition int"
    files = (
        spark.read.schema(schema)
        .parquet(data)
        .groupBy("topic", "slice", "partition", F.col("_metadata.file_path").alias("path"))
        .agg(F.count("*").alias("n"), F.min("sent_at").alias("first_at"), F.max("sent_at").alias("last_at"))
    )
    _log(spark, folder, files.collect(), send_id)


def _log(spark: SparkSession, folder: str, files: Sequence, send_id: str) -> None:
    """Enter files (a row each, as Spark lists them too) after what the log holds."""
    log = sent_log(spark, folder)
    last = log.agg(F.max("slice")).first()[0]
    after = -1 if last is None else last
    ends = {
        (r["topic"], r["partition"]): r["end"]
        for r in log.groupBy("topic", "partition").agg(F.sum("n").alias("end")).collect()
    }
    rows = []
    for f in sorted(files, key=lambda f: (f["slice"], f["topic"], f["partition"], f["first_at"], f["path"])):
        at = (f["topic"], f["partition"])
        first = ends.get(at, 0)
        ends[at] = first + f["n"]
        rows.append((*at[:1], after + 1 + f["slice"], at[1], first, f["n"], f["first_at"], f["last_at"], f["path"]))
    if rows:
        entry = spark.createDataFrame(rows, LOG).coalesce(1)
        entry.write.mode("append").parquet(f"{folder}/log")


def end(spark: SparkSession, folder: str, partitions: Mapping[str, int], after: timedelta = timedelta(days=1)) -> None:
    """Send the end-of-stream message to every partition, in a slice of its own.

    Its time is `after` the last message's, so a watermark over `sent_at` passes all
    windows that end before and their results come out.
    """
    log = sent_log(spark, folder)
    last = log.agg(F.max("last_at").alias("at"))
    ends = spark.createDataFrame(
        [(t, p) for t, n in partitions.items() for p in range(n)], "topic string, partition int"
    )
    send_id = uuid.uuid4().hex
    data = f"{folder}/data/{send_id}"
    stamped = ends.select(
        "topic", "partition", F.lit(0).alias("slice"), F.lit(None).cast("string").alias("key"),
        (F.coalesce(last.scalar(), F.timestamp_seconds(F.lit(0))) + F.lit(after)).alias("sent_at"),
        F.lit(SENTINEL).alias("value"),
    )
    stamped.coalesce(1).write.partitionBy("topic", "slice", "partition").parquet(data)
    found = spark.read.schema("key string, sent_at timestamp, value string, topic string, slice int, partition int").parquet(data)
    files = found.groupBy("topic", "slice", "partition", F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("n"), F.min("sent_at").alias("first_at"), F.max("sent_at").alias("last_at")
    )
    _log(spark, folder, files.collect(), send_id)


# -- reading -----------------------------------------------------------------


def source(
    spark: SparkSession, topic: str, folder: str, stream: bool = True, per_batch: int = 1
) -> DataFrame:
    """The messages of a topic: `topic`, `partition`, `offset`, `key`, `sent_at`, `value`.

    As a stream, each micro-batch takes the next `per_batch` slices (0: all there are)
    and a file is a task. Start it by `run.run_through` to work off what is there.
    The folder must be one that Arrow reaches from the executors (a mounted path, HDFS
    or an object store).
    """
    spark.dataSource.register(OrderedTopics)
    reader = spark.readStream if stream else spark.read
    return (
        reader.format(FORMAT)
        .option("path", folder)
        .option("topic", topic)
        .option("per_batch", str(per_batch))
        .load()
    )


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("file:///", "file:/").replace("file:/", "file:///"))


@dataclass
class SentFile(InputPartition):
    topic: str
    slice: int
    partition: int
    first_offset: int
    path: str


def _sent(options: Mapping[str, str]) -> list[SentFile]:
    """The files of the topic, in the order of the log."""
    fs, base = _opened(options["path"])
    chosen = pafs.FileSelector(f"{base}/log", allow_not_found=True)
    rows = []
    for info in fs.get_file_info(chosen):
        if info.base_name.endswith(".parquet") and not info.base_name.startswith((".", "_")):
            rows += pq.ParquetFile(fs.open_input_file(info.path)).read().to_pylist()
    files = [
        SentFile(r["topic"], r["slice"], r["partition"], r["first_offset"], r["path"])
        for r in rows
        if r["topic"] == options["topic"]
    ]
    return sorted(files, key=lambda f: (f.slice, f.partition, f.first_offset))


_KINDS = pa.schema(
    [
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("key", pa.string()),
        ("sent_at", pa.timestamp("us", "UTC")),
        ("value", pa.string()),
    ]
)


BATCH_ROWS, BATCH_BYTES = 10_000, 4 << 20  # of messages at once


def _messages(file: SentFile) -> Iterator[pa.RecordBatch]:
    """A few messages at a time, and of the file what they need: messages may be large."""
    fs, path = _opened(file.path)
    at = file.first_offset
    with fs.open_input_file(path) as opened:
        parquet = pq.ParquetFile(opened, buffer_size=1 << 20, pre_buffer=False)
        groups = [parquet.metadata.row_group(i) for i in range(parquet.num_row_groups)]
        most = max((g.total_byte_size // max(g.num_rows, 1) for g in groups), default=0)
        size = max(1, min(BATCH_ROWS, BATCH_BYTES // max(most, 1)))
        for batch in parquet.iter_batches(size, columns=["key", "sent_at", "value"], use_threads=False):
            n = len(batch)
            sent = batch.column("sent_at")
            sent = pc.cast(sent, pa.timestamp("us", sent.type.tz), safe=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(file.topic, n).cast(pa.string()),
                    pa.repeat(file.partition, n).cast(pa.int32()),
                    pa.array(range(at, at + n), pa.int64()),
                    batch.column("key"),
                    sent.cast(pa.timestamp("us", "UTC")) if sent.type.tz else pc.assume_timezone(sent, "UTC"),
                    batch.column("value"),
                ],
                schema=_KINDS,
            )
            at += n


class OrderedTopics(DataSource):
    """The source behind `source`, as Spark knows it."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Files(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Slices(dict(self.options))


class _Files(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        return _sent(self.options)

    def read(self, partition: SentFile) -> Iterator[pa.RecordBatch]:
        yield from _messages(partition) if partition else ()


class _Slices(DataSourceStreamReader):
    """An offset is the number of the next slice of the log."""

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.at: int | None = None

    def initialOffset(self) -> dict:
        return {"slice": 0}

    def latestOffset(self) -> dict:
        numbers = sorted({f.slice for f in _sent(self.options)})
        per_batch = int(self.options.get("per_batch", "1"))
        ahead = [n for n in numbers if n >= (self.at or 0)]
        taken = ahead[:per_batch] if per_batch else ahead
        self.at = taken[-1] + 1 if taken else self.at or 0
        return {"slice": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # after a restart the last batch is planned before anything else
        self.at = max(self.at or 0, end["slice"])
        return [f for f in _sent(self.options) if start["slice"] <= f.slice < end["slice"]]

    def read(self, partition: SentFile) -> Iterator[pa.RecordBatch]:
        yield from _messages(partition)
