"""Message topics: a broker when there is one, message files otherwise.

Messages are rows with `topic` and JSON text `value`. In a folder of message
files every topic is a sub-folder ``topic=<name>`` of text files, one message
per line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackside.functions.timing import TEXT_FORMAT
from trackside.sources.tables import scratch_folder

# Topic names and the end-of-stream message.
TOPICS = ("car", "lap", "weather", "dbstore")
SENTINEL = '{"end": "end"}'


def topic_source(
    spark: SparkSession,
    topic: str,
    servers: str | None = None,
    folder: str | None = None,
    stream: bool = True,
    starting: str = "earliest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The messages of one topic, as a stream or a batch frame.

    With `servers` the topic is read from a Kafka broker (the connector that
    fits the running Spark must be on the class path): `value` in bytes, with
    `partition` and `offset`. With `folder` message files are replayed: `value`
    as text. `options` go to the reader, e.g. ``maxFilesPerTrigger`` or
    ``maxOffsetsPerTrigger``.
    """
    if (servers is None) == (folder is None):
        raise ValueError("give either servers or folder")
    reader = spark.readStream if stream else spark.read
    if servers is not None:
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
        )
        return reader.options(**(options or {})).load()
    reader = reader.format("text").options(**(options or {}))
    return reader.load(f"{folder}/topic={topic}")


def publish_topic(
    df: DataFrame,
    topic: str,
    fields: Sequence[str] | None = None,
    keep: Sequence[str] = (),
    time_format: str = TEXT_FORMAT,
    key: str | Column | None = None,
    time: str | None = None,
) -> DataFrame:
    """Rows to messages: `topic` and the JSON object of `fields` as `value`.

    `key` adds the message key as text, `time` the event time as `sent_at`;
    `write_topic` sends the messages of a key in the order of this time.

    Times are written in whole seconds unless `time_format` says otherwise; a
    NULL field is left out and reads back as NULL.
    """
    settings = {"timestampFormat": time_format, "timestampNTZFormat": time_format}
    body: list[str | Column] = list(fields or [c for c in df.columns if c not in keep])
    extra = []
    if key is not None:
        column = F.col(key) if isinstance(key, str) else key
        extra.append(column.cast("string").alias("key"))
    if time is not None:
        extra.append(F.col(time).alias("sent_at"))
    return df.select(
        *keep,
        *extra,
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*body), settings).alias("value"),
    )


def append_sentinel(
    messages: DataFrame, topics: Sequence[str], extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add one end-of-stream message per topic.

    `extra` gives values for further columns of `messages` (an offset, say);
    columns it leaves out are NULL there.
    """
    one = messages.sparkSession.range(1, numPartitions=1)
    ends = one.select(
        F.explode(F.array(*map(F.lit, topics))).alias("topic"),
        F.lit(SENTINEL).alias("value"),
    ).withColumns(dict(extra or {}))
    return messages.unionByName(ends, allowMissingColumns=True)


def write_topic(
    messages: DataFrame, servers: str | None = None, folder: str | None = None
) -> None:
    """Send messages to a broker, or append them to message files.

    Messages with a `key` and `sent_at` go out in order: to a broker those of a
    key from one task by time, to files in ranges of time. Sentinels belong in a
    later call, by `end_topics`, since the tasks of one write end in any order.
    Flushing and closing is the writer's business on either way.
    """
    if (servers is None) == (folder is None):
        raise ValueError("give either servers or folder")
    has = [c for c in ("key", "partition") if c in messages.columns]
    if servers is not None:
        if {"key", "sent_at"} <= set(messages.columns):
            messages = messages.repartition("key").sortWithinPartitions("key", "sent_at")
        (
            messages.select("topic", "value", *has)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .save()
        )
        return
    if "sent_at" in messages.columns:
        messages = messages.repartitionByRange("sent_at").sortWithinPartitions("sent_at")
    messages.select("topic", "value").write.mode("append").partitionBy("topic").text(folder)


def end_topics(
    spark: SparkSession,
    partitions: Mapping[str, int],
    servers: str | None = None,
    folder: str | None = None,
) -> None:
    """Send the end-of-stream message, once all data is sent.

    `partitions` says how many each topic has: on a broker every partition gets
    one of its own, in message files, which have no partitions, the topic gets one.
    """
    rows = [
        (topic, SENTINEL, p)
        for topic, n in partitions.items()
        for p in range(n if servers else 1)
    ]
    ends = spark.createDataFrame(rows, "topic string, value string, partition int")
    write_topic(ends.coalesce(1), servers, folder)


def time_slices(messages: DataFrame, n: int) -> list[DataFrame]:
    """`messages` (with `sent_at`) in up to `n` frames, one time range after the
    other. They are written once, range by range, to the shared folder."""
    base = scratch_folder(messages.sparkSession, "slices")
    (
        messages.repartitionByRange(n, "sent_at")
        .withColumn("slice", F.spark_partition_id())
        .write.partitionBy("slice")
        .parquet(base)
    )
    written = messages.sparkSession.read.parquet(base)
    numbers = sorted(r["slice"] for r in written.select("slice").distinct().collect())
    return [written.where(F.col("slice") == k).drop("slice") for k in numbers]
