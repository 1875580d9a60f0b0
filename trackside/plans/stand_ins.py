"""The operators on general tables, one query each.

`events` plays telemetry, laps and messages, `orders` with `lineitem` a lap with
its car points, `customer` weather. Each query reads whole tables and returns a
frame; times come out zone-less, so they do not depend on the reader's zone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from trackside import schemas
from trackside.functions import timing
from trackside.functions.measures import (
    avg_of,
    count_of,
    max_of,
    min_of,
    mode_of,
    sum_of,
)
from trackside.functions.parsing import is_sentinel, json_parse, nested_parse, rejects_by_reason
from trackside.operators import joins, nesting, rows, summary
from trackside.plans import racing
from trackside.sources import ordered, tables, topics
from trackside.sources.bucketed import write_bucketed
from trackside.streaming import live, metrics, run, store
from trackside.streaming.commits import Versions

MICROS = timing.TEXT_FORMAT + ".SSSSSS"
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)
WAIT = 24 * 3600
# Messages of a replayed table, about, in one slice and so in one micro-batch.
SLICE_ROWS = 1_000_000
SLICES = 6


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _dealt(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table whose rows are dealt to many tasks, however few its files and row groups:
    for work on each row that would otherwise lie with the tasks that read it."""
    rows = _read(spark, folder, table)
    return rows.repartition(*rows.columns)


# -- parsing and rows --------------------------------------------------------


def parse_props(spark, folder):
    return json_parse(_read(spark, folder, "events"), "k int", "props", ["event_id"])


def _spoilt(spark, folder):
    """`events` whose messages carry text for a number where k is 69."""
    return json_parse(
        _read(spark, folder, "events").withColumn(
            "value", F.replace("props", F.lit("69"), F.lit('"none"'))
        ),
        "k int",
        keep=["event_id"],
    )


def gate(spark, folder):
    return rows.required_gate(_spoilt(spark, folder), "k")


def rejects(spark, folder):
    return rows.rejected(_spoilt(spark, folder), "k").select("event_id")


def one_entity(spark, folder):
    events = _read(spark, folder, "events")
    return rows.entity_filter(events, "event_type", "error").select(
        "event_id", "user_id", "value"
    )


def quick_per_user(spark, folder):
    events = _read(spark, folder, "events").select("event_id", "user_id", "value")
    return rows.quick_filter(events, "value", 1.07, ["user_id"])


def quick_overall(spark, folder):
    events = _read(spark, folder, "events").select("event_id", "user_id", "value")
    return rows.quick_filter(events, "value", 20.0)


def numbered(spark, folder):
    events = _read(spark, folder, "events").select("event_id", "user_id", "ts")
    out = rows.row_index(events, ["user_id"], ["ts", "event_id"], skip_first=1)
    return out.select("event_id", "user_id", "idx")


def projection(spark, folder):
    events = _read(spark, folder, "events")
    return rows.typed_projection(
        events,
        {
            "id": ("event_id", "bigint"),
            "reading": ("value", "float"),
            "whole": ("value", "int"),
            "flag": (F.col("event_type") == "error", "int"),
            "race": (F.lit("Grand Prix"), "string"),
        },
    )


def seconds_of_day(spark, folder):
    events = _read(spark, folder, "events")
    elapsed = F.col("ts") - F.col("ts").cast("date").cast("timestamp_ntz")
    return events.select("event_id", timing.duration_seconds(elapsed).alias("seconds"))


def clean_text(spark, folder):
    events = _read(spark, folder, "events")
    text = F.concat(F.col("event_id").cast("string"), F.lit(" days 00:01:02"))
    return events.select("event_id", timing.duration_text_clean(text).alias("text"))


def time_text(spark, folder):
    events = _read(spark, folder, "events")
    return events.select("event_id", timing.event_time_text("ts").alias("text"))


# -- summaries ---------------------------------------------------------------

USER_MEASURES = (
    avg_of("value", scale=2),
    max_of("value"),
    avg_of("reading", scale=6),
    max_of("reading"),
    mode_of("event_type"),
)
PRICE_MEASURES = (
    avg_of("l_extendedprice", "avg_price", scale=2),
    min_of("l_extendedprice", "best_price"),
    max_of("l_extendedprice", "max_price"),
)
VALUE_MEASURES = (
    avg_of("value", scale=2),
    min_of("value"),
    max_of("value"),
    sum_of("value", scale=2),
    count_of("value", "n"),
)


def car_by_user(spark, folder):
    events = _read(spark, folder, "events")
    reading = events.withColumn("reading", F.col("value").cast("float"))
    return summary.group_summary(reading, ["user_id"], USER_MEASURES)


def stint_by_supplier(spark, folder):
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    return summary.group_summary(_read(spark, folder, "lineitem"), keys, PRICE_MEASURES)


def weather_by_segment(spark, folder):
    customer = _read(spark, folder, "customer").withColumn(
        "segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    )
    measures = [avg_of("c_acctbal", "avg_balance", scale=2), avg_of("c_nationkey")]
    return summary.group_summary(customer, ["segment"], measures)


def frequent_part(spark, folder):
    lineitem = _read(spark, folder, "lineitem")
    return summary.mode_by_count(lineitem, ["l_suppkey"], "l_partkey")


def _windows(spark, folder, size, slide):
    events = _read(spark, folder, "events")
    return summary.window_summary(
        events, ["event_type"], "ts", size, VALUE_MEASURES, slide
    )


def tumbling(spark, folder):
    return _windows(spark, folder, "65 seconds", None)


def sliding_50(spark, folder):
    return _windows(spark, folder, "50 seconds", "10 seconds")


def sliding_65(spark, folder):
    return _windows(spark, folder, "65 seconds", "10 seconds")


def modes_65(spark, folder):
    """A mode in sliding windows: counted per pane and value, then summed up."""
    events = _read(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return summary.window_summary(
        events.withColumn("gear", k % 8),
        ["event_type"],
        "ts",
        "65 seconds",
        [mode_of("gear"), count_of("gear", "n")],
        "10 seconds",
    )


# -- joins -------------------------------------------------------------------


def _laps(events: DataFrame) -> DataFrame:
    """The time from one view of a user to the next, as laps numbered from 0."""
    views = rows.entity_filter(events, "event_type", "view")
    starts = rows.row_index(
        views.select("user_id", "event_id", F.col("ts").alias("lap_start")),
        ["user_id"],
        ["lap_start", "event_id"],
        "lap",
    ).withColumnRenamed("event_id", "lap_id")
    ends = starts.select(
        "user_id", (F.col("lap") - 1).alias("lap"), F.col("lap_start").alias("lap_end")
    )
    return starts.join(ends, ["user_id", "lap"])


def points_in_laps(spark, folder):
    events = _read(spark, folder, "events")
    points = events.select("event_id", "user_id", "ts", "value")
    laps = tables.written(_laps(events), "laps")
    held = joins.interval_join(points, laps, ["user_id"], "ts", "lap_start", "lap_end")
    measures = [count_of("event_id", "points"), sum_of("value", scale=2)]
    return summary.group_summary(held, ["lap_id", "user_id", "lap"], measures)


def _of_type(events: DataFrame, kind: str, prefix: str) -> DataFrame:
    return rows.entity_filter(events, "event_type", kind).select(
        F.col("user_id"),
        F.col("event_id").alias(f"{prefix}_id"),
        F.col("ts").alias(f"{prefix}_ts"),
        F.col("value").alias(f"{prefix}_value"),
    )


def last_view(spark, folder):
    events = _read(spark, folder, "events")
    errors, views = _of_type(events, "error", "error"), _of_type(events, "view", "view")
    out = joins.asof_join(
        errors, views, ["user_id"], "error_ts", "view_ts", seq="view_id"
    )
    return out.select(
        "error_id", "user_id", F.col("match.view_id"), F.col("match.view_value")
    )


def first_error_in_lap(spark, folder):
    events = _read(spark, folder, "events")
    out = joins.asof_join(
        _laps(events),
        _of_type(events, "error", "error"),
        ["user_id"],
        "lap_start",
        "error_ts",
        seq="error_id",
        until="lap_end",
    )
    return out.select(
        "lap_id", "user_id", F.col("match.error_id"), F.col("match.error_value")
    )


ITEM = (
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
)


def _nested_orders(spark, folder, **options):
    orders = _read(spark, folder, "orders")
    return nesting.nest_records(
        orders.withColumnRenamed("o_orderkey", "orderkey"),
        _read(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "orderkey"),
        ["orderkey"],
        ITEM,
        "items",
        ITEM,
        {"head": ["o_custkey", "o_totalprice"]},
        **options,
    )


def _measured(nested: DataFrame) -> DataFrame:
    quantity = F.aggregate(
        "items", F.lit(0.0), lambda total, item: total + item["l_quantity"]
    )
    return nested.select(
        "orderkey",
        F.col("part").cast("bigint").alias("part"),
        "head.o_custkey",
        F.size("items").cast("bigint").alias("n"),
        quantity.alias("quantity"),
        F.try_element_at("items", F.lit(1))["l_partkey"].alias("first_part"),
    )


def nested(spark, folder):
    return _measured(_nested_orders(spark, folder))


def nested_parts(spark, folder):
    return _measured(_nested_orders(spark, folder, max_items=3))


def exploded(spark, folder):
    return nesting.explode_records(
        _nested_orders(spark, folder, max_items=3), "items", ["orderkey"]
    )


# -- messages ----------------------------------------------------------------


def published(spark, folder):
    events = _read(spark, folder, "events")
    messages = topics.publish_topic(events, "events", time_format=MICROS)
    return json_parse(messages, EVENTS)


def with_sentinels(spark, folder):
    events = _read(spark, folder, "events")
    messages = events.select(F.col("event_type").alias("topic"), F.col("props").alias("value"))
    return topics.append_sentinel(messages, topics.TOPICS)


def before_sentinel(spark, folder):
    """Users as topic partitions; the first error of a user ends its partition."""
    events = _read(spark, folder, "events").select(
        F.col("user_id").alias("partition"),
        F.col("event_id").alias("offset"),
        F.when(F.col("event_type") == "error", F.lit(topics.SENTINEL))
        .otherwise(F.col("props"))
        .alias("value"),
    )
    return rows.sentinel_cut(events, ["partition"])


def message_files(spark, folder):
    """Write `events` to message files, one topic per event type; read one back."""
    out = tables.scratch_folder(spark, "topics")
    events = _read(spark, folder, "events")
    body = [c for c in events.columns if c != "event_type"]
    messages = topics.publish_topic(events, "", body, ["event_type"], MICROS)
    topics.write_topic(messages.withColumn("topic", F.col("event_type")), folder=out)
    back = topics.topic_source(spark, "error", folder=out, stream=False)
    return json_parse(back, EVENTS).drop("event_type")


def session(spark, folder):
    loaded = tables.load_session(
        spark, folder, session="error", tables={"events": EVENTS}, key="event_type"
    )
    return loaded["events"].select("event_id", "ts", "user_id", "value")


# -- a race out of `events` --------------------------------------------------


def _race(events: DataFrame) -> dict[str, DataFrame]:
    """Users as drivers of one session each: views start laps, clicks are car
    points, errors weather samples."""
    who = F.col("user_id").cast("string").alias("session")
    driver = F.col("user_id").cast("string").alias("Driver")
    time = lambda c: F.col(c).cast("timestamp")
    length = time("lap_end") - time("lap_start")
    laps = _laps(events).select(
        who,
        driver,
        F.col("lap").cast("int").alias("LapNumber"),
        time("lap_start").alias("lap_start"),
        time("lap_end").alias("lap_end"),
        length.alias("LapTime"),
        length.alias("Sector1Time"),
        length.alias("Sector2Time"),
        length.alias("Sector3Time"),
        F.floor(F.col("lap") / 5).cast("int").alias("Stint"),
        F.when(F.col("lap") % 2 == 0, "SOFT").otherwise("HARD").alias("Compound"),
        (F.col("lap") % 5).cast("int").alias("TyreLife"),
        F.lit(1).alias("Position"),
    )
    k = F.get_json_object("props", "$.k").cast("int")
    telemetry = rows.entity_filter(events, "event_type", "click").select(
        who,
        driver,
        time("ts").alias("ts"),
        F.col("value").alias("Speed"),
        k.cast("double").alias("Throttle"),
        (k > 50).alias("Brake"),
        (k % 8).alias("nGear"),
        (k * 100).alias("RPM"),
        F.lit(0).alias("DRS"),
    )
    samples = rows.entity_filter(events, "event_type", "error").select(
        who,
        time("ts").alias("ts"),
        F.col("value").alias("AirTemp"),
        k.cast("double").alias("Humidity"),
        F.lit(1000.0).alias("Pressure"),
        F.lit(False).alias("Rainfall"),
        F.col("value").alias("TrackTemp"),
        k.cast("double").alias("WindSpeed"),
        F.lit(0.0).alias("WindDirection"),
    )
    return {
        "laps": tables.written(laps, "race-laps"),
        "car_telemetry": telemetry,
        "weather_samples": samples,
    }


def _race_messages(spark, folder, topic: str) -> DataFrame:
    race = _race(_read(spark, folder, "events"))
    return racing.session_messages(
        *(race[t] for t in schemas.SESSION_TABLES),
        race=F.concat(F.lit("Race "), F.col("session")),
        threshold=100.0,
        topics=[topic],
    )[topic]


def race_laps(spark, folder):
    """Lap messages of the race, parsed again and summed up per stint."""
    lap = racing.lap_records(_race_messages(spark, folder, "lap"))
    return racing.stint_summary(lap)


def race_weather(spark, folder):
    """Weather messages of the race, parsed again, per race."""
    weather = racing.weather_records(_race_messages(spark, folder, "weather"))
    return racing.weather_summary(weather)


def race_nested(spark, folder):
    """Nested messages of the race, parsed again: one row per lap, whose points may
    fill several messages."""
    parsed = nested_parse(_race_messages(spark, folder, "dbstore"))
    first = F.try_element_at("car", F.lit(1))["Speed"]
    return (
        rows.required_gate(parsed, "lap")
        .groupBy("lap.Driver", "lap.LapNumber")
        .agg(
            F.max("weather.AirTemp").alias("air"),
            F.sum(F.size("car")).alias("points"),
            F.min_by(first, "part").alias("first_speed"),
        )
    )


def race_car(spark, folder):
    """Car messages of the race, parsed again and summed up per lap."""
    return racing.car_summary(racing.car_records(_race_messages(spark, folder, "car")))


def _stored(spark, folder) -> store.CommittedTables:
    """The three tables that nested messages in files were streamed into, a few slices
    to a batch."""
    base = tables.scratch_folder(spark, "store")
    sent = {"dbstore": _race_messages(spark, folder, "dbstore")}
    racing.send_messages(sent, folder=f"{base}/topics", partitions=4)
    sent = ordered.source(spark, "dbstore", f"{base}/topics", per_batch=4)
    stored = store.CommittedTables(f"{base}/tables")
    run.run_through(
        racing.nested_records(sent, stored.ids), stored.write, "append", f"{base}/checkpoint"
    )
    return stored


def race_store(spark, folder):
    """The stored car table, summed up per lap."""
    return racing.car_summary(_stored(spark, folder).read(spark, "car"))


def race_store_laps(spark, folder):
    """The stored lap table with the weather of the same message beside it."""
    stored = _stored(spark, folder)
    lap, weather = (stored.read(spark, t) for t in ("lap", "weather"))
    sky = weather.select(*stored.ids, "AirTemp", "Humidity", "Race")
    return lap.join(sky, stored.ids).select(
        "Driver", "LapNumber", "LapTime", "AirTemp", "Humidity", "Race"
    )


# -- live --------------------------------------------------------------------


def _car_messages(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    points = events.select(
        F.col("ts").cast("timestamp").alias("Timestamp"),
        F.col("user_id").cast("int").alias("LapNumber"),
        F.col("value").alias("Speed"),
        k.cast("double").alias("Throttle"),
        (k % 8).alias("Gear"),
        (k * 100).alias("RPM"),
    )
    return topics.publish_topic(points, "car", time="Timestamp")


def _lap_messages(events: DataFrame) -> DataFrame:
    laps = events.select(
        F.col("ts").cast("timestamp").alias("Timestamp"),
        F.col("user_id").cast("int").alias("LapNumber"),
        F.col("event_type").alias("Driver"),
        F.col("value").alias("LapTime"),
        F.lit(1).alias("Stint"),
        F.when(F.col("value") > 20, "SOFT").otherwise("HARD").alias("Compound"),
    )
    return topics.publish_topic(laps, "lap", time="Timestamp")


def _weather_messages(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    samples = events.select(
        F.col("ts").cast("timestamp").alias("Timestamp"),
        F.col("user_id").cast("int").alias("LapNumber"),
        F.col("value").alias("AirTemp"),
        k.alias("Humidity"),
        F.col("value").alias("TrackTemp"),
        k.alias("WindSpeed"),
        F.nullif(F.col("event_type"), F.lit("signup")).alias("Race"),
    )
    return topics.publish_topic(samples, "weather", time="Timestamp")


def _replayed(
    messages: DataFrame,
    topic: str,
    analysis: Callable[[DataFrame], DataFrame],
    mode: str,
    writer: Callable[[str], run.BatchWriter],
    close: bool = False,
) -> tuple[str, DataFrame]:
    """Send messages in order, a slice to a micro-batch, and run `analysis` over them to
    the end: over the older half first, then, restarted, over the rest. A slice is in as
    many files as tasks run at once. The folder that `writer` has put the result in, and
    the stream's frame."""
    spark = messages.sparkSession
    parts = max(4, spark.sparkContext.defaultParallelism)
    base = tables.scratch_folder(spark, topic)
    messages = tables.written(messages, f"{topic}-messages")
    first, last = messages.agg(F.min("sent_at"), F.max("sent_at")).first()
    stream = analysis(ordered.source(spark, topic, f"{base}/topics"))
    write = writer(f"{base}/out")
    if first is not None:
        older = F.col("sent_at") <= F.lit(first + (last - first) / 2)
        halves = {"older": older, "newer": ~older}
        sizes = messages.agg(*(F.count_if(part).alias(name) for name, part in halves.items())).first()
        for name, part in halves.items():
            slices = max(SLICES // 2, -(-sizes[name] // SLICE_ROWS))
            ordered.send(messages.where(part), f"{base}/topics", partitions=parts, slices=slices)
            if close and name == "newer":
                ordered.end(spark, f"{base}/topics", {topic: parts})
            run.run_through(stream, write, mode, f"{base}/checkpoint")
    return f"{base}/out", stream


def live_car(spark, folder):
    path, stream = _replayed(
        _car_messages(_dealt(spark, folder, "events")),
        "car",
        lambda sent: racing.live_car_summary(racing.car_records(sent)),
        "complete",
        run.table_writer,
    )
    return run.read_table(spark, path, stream.schema)


def merged_car(spark, folder):
    """The car summary without state: each batch's partials, merged by key."""
    path, _ = _replayed(
        _car_messages(_dealt(spark, folder, "events")),
        "car",
        racing.car_records,
        "append",
        lambda path: racing.merged_car_summary(path).write,
    )
    return racing.finished_car_summary(spark, racing.merged_car_summary(path))


def _live_windows(messages: DataFrame, topic: str, analysis, keys) -> DataFrame:
    """Windows in update mode; the versions of each are merged as batches go by."""
    path, stream = _replayed(
        messages, topic, analysis, "update", lambda path: Versions(path, [*keys, *BOUNDS]).write
    )
    latest = Versions(path, [*keys, *BOUNDS]).latest(messages.sparkSession, stream.schema)
    return _no_zone(latest)


def live_stint(spark, folder):
    return _live_windows(
        _lap_messages(_dealt(spark, folder, "events")),
        "lap",
        lambda sent: racing.live_stint_windows(racing.lap_records(sent)),
        racing.STINT,
    )


def live_weather(spark, folder):
    return _live_windows(
        _weather_messages(_dealt(spark, folder, "events")),
        "weather",
        lambda sent: racing.live_weather_windows(racing.weather_records(sent)),
        ["Race"],
    )


def live_panes(spark, folder):
    """Sliding windows in append mode: rows enter panes, panes enter windows."""
    path, stream = _replayed(
        _lap_messages(_dealt(spark, folder, "events")),
        "lap",
        racing.live_stint_panes,
        "append",
        run.versions_writer,
        close=True,
    )
    return _no_zone(run.read_versions(spark, path, stream.schema).drop(run.BATCH))


def compacted(spark, folder):
    """The last reading of each user, of versions that come in many batches."""
    events = _dealt(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("sent_at"), "user_id", "event_id", "ts", "value"
    )
    messages = topics.publish_topic(events, "events", EVENT_FIELDS, time_format=MICROS, time="sent_at")

    def latest_of(batch: DataFrame) -> DataFrame:
        parsed = json_parse(batch, EVENTS)
        row = F.max_by(F.struct("event_id", "ts", "value"), F.struct("ts", "event_id"))
        return parsed.groupBy("user_id").agg(row.alias("row")).select("user_id", "row.*")

    def writer(path: str) -> run.BatchWriter:
        versions = Versions(path, ["user_id"], fan=3)
        return lambda batch, batch_id: versions.write(latest_of(batch), batch_id)

    path, _ = _replayed(messages, "events", lambda sent: sent.select("value"), "append", writer)
    schema = T.StructType.fromDDL("user_id bigint, event_id bigint, ts timestamp_ntz, value double")
    return Versions(path, ["user_id"], fan=3).latest(spark, schema)


EVENT_FIELDS = ("user_id", "event_id", "ts", "value")


def in_order(spark, folder):
    """Messages as a stream in the order sent: what a batch held is no later than what
    came after it, and offsets run on without gaps."""
    events = _dealt(spark, folder, "events")
    timed = events.withColumn("sent_at", F.col("ts").cast("timestamp"))
    messages = topics.publish_topic(
        timed, "events", ["event_id", "user_id"], key="user_id", time="sent_at"
    )

    def writer(path: str) -> run.BatchWriter:
        def write(batch: DataFrame, batch_id: int) -> None:
            parsed = json_parse(batch, "event_id bigint, user_id bigint", keep=["partition", "offset", "sent_at"])
            parsed.write.mode("overwrite").parquet(f"{path}/{run.BATCH}={batch_id}")

        return write

    path, _ = _replayed(messages, "events", lambda sent: sent, "append", writer)
    read = spark.read.parquet(path)
    gaps = read.groupBy("partition").agg((F.max("offset") + 1 - F.count("*")).alias("gaps"))
    batches = read.groupBy(run.BATCH).agg(F.min("sent_at").alias("first"), F.max("sent_at").alias("last"))
    # a row per batch, so one task sees them all
    before = F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy(run.BATCH))
    swapped = batches.withColumn("before", before).where("first < before").agg(F.count("*").alias("n"))
    return (
        read.groupBy("user_id")
        .agg(F.count("*").alias("n"), F.countDistinct("partition").alias("partitions"))
        .withColumn("swapped", swapped.scalar())
        .withColumn("gaps", gaps.agg(F.sum("gaps").alias("gaps")).scalar())
    )


def _live_topic(spark, base: str, topic: str, ddl: str, required: str) -> DataFrame:
    """A topic as a stream of records with `sent_at`, its event time; the message that
    ends the topic moves the watermark and is dropped."""
    sent = timing.with_event_time(ordered.source(spark, topic, base), "sent_at")
    return rows.closing_gate(json_parse(sent, ddl, keep=["sent_at"]), "sent_at", required)


def _send_all(spark, name: str, topics_of: dict[str, DataFrame]) -> str:
    """Frames with `sent_at` as topics of one folder, each in many slices, then closed."""
    base = tables.scratch_folder(spark, name)
    for topic, df in topics_of.items():
        body = [c for c in df.columns if c != "sent_at"]
        messages = topics.publish_topic(df, topic, body, time_format=MICROS, time="sent_at")
        ordered.send(messages, f"{base}/topics", partitions=2, slices=SLICES)
    # later than any session or lap lasts
    ordered.end(spark, f"{base}/topics", dict.fromkeys(topics_of, 2), timedelta(days=400))
    return base


def _longest(laps: DataFrame) -> str:
    """The longest lap, rounded up, as an interval."""
    length = F.max(F.unix_micros(F.col("lap_end").cast("timestamp")) - F.unix_micros(F.col("lap_start").cast("timestamp")))
    return f"{(laps.agg(length).first()[0] or 0) // 1_000_000 + 1} seconds"


def live_points_in_laps(spark, folder):
    """Points joined to laps while both stream in, then summed up per lap."""
    events = _read(spark, folder, "events")
    laps = tables.written(_laps(events), "laps")
    time = lambda c: F.col(c).cast("timestamp").alias("sent_at")
    base = _send_all(
        spark,
        "joined",
        {
            "points": events.select(time("ts"), "event_id", "user_id", "value"),
            "laps": laps.select(time("lap_start"), "user_id", "lap_id", "lap", "lap_end"),
        },
    )
    points = _live_topic(spark, f"{base}/topics", "points", "event_id bigint, user_id bigint, value double", "event_id")
    spans = _live_topic(
        spark, f"{base}/topics", "laps", "user_id bigint, lap_id bigint, lap bigint, lap_end timestamp", "lap_id"
    ).withColumnRenamed("sent_at", "lap_start")
    joined = live.live_interval_join(
        points, spans, ["user_id"], "sent_at", "lap_start", "lap_end", _longest(laps)
    )
    run.run_through(joined, run.versions_writer(f"{base}/out"), "append", f"{base}/checkpoint")
    held = run.read_versions(spark, f"{base}/out", joined.schema)
    measures = [count_of("event_id", "points"), sum_of("value", scale=2)]
    return summary.group_summary(held, ["lap_id", "user_id", "lap"], measures)


def live_last_view(spark, folder):
    """The last view before each error while both stream in."""
    events = _read(spark, folder, "events")
    of = lambda kind, name: rows.entity_filter(events, "event_type", kind).select(
        F.col("ts").cast("timestamp").alias("sent_at"), "user_id",
        F.col("event_id").alias(f"{name}_id"), F.col("value").alias(f"{name}_value"),
    )
    base = _send_all(spark, "latest", {"errors": of("error", "error"), "views": of("view", "view")})
    found = live.live_asof_join(
        _unclosed(spark, f"{base}/topics", "errors", "user_id bigint, error_id bigint, error_value double"),
        _unclosed(spark, f"{base}/topics", "views", "user_id bigint, view_id bigint, view_value double"),
        ["user_id"], "sent_at", "sent_at", seq="view_id",
    )
    with run.setting(spark, live.STATE_STORE, live.ROCKSDB):
        run.run_through(found, run.versions_writer(f"{base}/out"), "append", f"{base}/checkpoint")
    out = run.read_versions(spark, f"{base}/out", found.schema).where("error_id is not null")
    return out.select("error_id", "user_id", "match.view_id", "match.view_value")


def _unclosed(spark, base: str, topic: str, ddl: str) -> DataFrame:
    """A topic's records without an event time of their own, the closing one included."""
    return json_parse(ordered.source(spark, topic, base), ddl, keep=["sent_at"])


NEST_PART = 20


def live_nested(spark, folder):
    """Laps with their points nested while they stream in, a few points to a record."""
    events = _read(spark, folder, "events")
    laps = tables.written(_laps(events), "laps")
    points = events.select("event_id", "user_id", "ts", "value")
    held = joins.interval_join(points, laps, ["user_id"], "ts", "lap_start", "lap_end")
    time = lambda c: F.col(c).cast("timestamp").alias("sent_at")
    every = laps.select(time("lap_start"), "user_id", "lap", "lap_id").unionByName(
        held.select(time("ts"), "user_id", "lap", "event_id", "value"), allowMissingColumns=True
    )
    base = _send_all(spark, "nested", {"race": every})
    ddl = "user_id bigint, lap bigint, lap_id bigint, event_id bigint, value double"
    nested = live.live_nest(
        _live_topic(spark, f"{base}/topics", "race", ddl, "lap"),
        ["user_id", "lap"], "sent_at", _longest(laps), ["sent_at", "event_id"], "items",
        ["event_id", "value"], "head", ["lap_id"], F.col("lap_id").isNotNull(), NEST_PART,
    )
    run.run_through(nested, run.versions_writer(f"{base}/out"), "append", f"{base}/checkpoint")
    records = run.read_versions(spark, f"{base}/out", nested.schema)
    cents = lambda i: F.round(i["value"] * 100).cast("bigint")
    return records.groupBy("user_id", "lap", "head.lap_id").agg(
        F.count("*").alias("parts"),
        F.sum(F.size("items")).alias("n"),
        F.sum(F.aggregate("items", F.lit(0).cast("bigint"), lambda t, i: t + cents(i))).alias("cents"),
        F.max(F.when(F.col("part") == 0, F.try_element_at("items", F.lit(1))["event_id"])).alias("first_event"),
    )


def batch_rows(spark, folder):
    """Rows and readings of every batch of a stream, from the table of its progress; a
    day of `events` is a batch."""
    events = _read(spark, folder, "events")
    base = tables.scratch_folder(spark, "progress")
    timed = events.withColumn("sent_at", F.col("ts").cast("timestamp"))
    messages = topics.publish_topic(timed, "events", ["event_id", "value"], time="sent_at")
    ordered.send(messages, base, slices=F.unix_date(F.col("sent_at").cast("date")))
    read = json_parse(ordered.source(spark, "events", base), "event_id bigint, value double")
    watched = live.observed(read, "seen", {"readings": F.count("value"), "top": F.max("value")})
    with metrics.ProgressTable(spark, f"{base}/progress") as table:
        query = run.run_through(watched, "noop", "append", f"{base}/checkpoint")
        table.wait(query)
    told = metrics.progress_of(spark, f"{base}/progress").where("input_rows > 0")
    seen = lambda name: F.col("observed").getItem(f"seen.{name}")
    return told.select(
        "batch_id", "input_rows",
        seen("readings").cast("bigint").alias("readings"), seen("top").cast("double").alias("top"),
    )


def bucketed(spark, folder):
    """Numbering over a table bucketed and sorted by its key: no shuffle."""
    events = _read(spark, folder, "events")
    name = f"session_{uuid.uuid4().hex}"
    table = write_bucketed(events, name, ["user_id"], ["ts", "event_id"], 8)
    numbered = rows.row_index(table, ["user_id"], ["ts", "event_id"], hot_rows=None)
    return numbered.select("event_id", "user_id", "idx")


def rejects_explained(spark, folder):
    """Messages that the gate drops, and why; those of some `k` are spoilt."""
    events = _read(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    value = F.col("props")
    for at, text in SPOILT.items():
        value = F.when(k == at, F.lit(text)).otherwise(value)
    return rejects_by_reason(events.select("event_id", value.alias("value")), "k int", ["k"], keep=["event_id"])


SPOILT = {
    69: '{"k": "none"}', 68: "garbage", 67: topics.SENTINEL, 66: "{}", 65: '{"k": null}',
    64: "[1]", 63: '{"k": 3000000000}',
}


def until_sentinel(spark, folder):
    """`events` as messages in many files, read in many batches up to the sentinel."""
    base = tables.scratch_folder(spark, "until")
    events = _read(spark, folder, "events")
    messages = topics.publish_topic(events, "events", time_format=MICROS)
    topics.write_topic(messages.repartition(24), folder=base)
    topics.end_topics(spark, {"events": 1}, folder=base)
    source = topics.topic_source(
        spark, "events", folder=base, options={"maxFilesPerTrigger": "5"}
    )

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        json_parse(batch, EVENTS).write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    run.run_until_sentinel(source, store_batch, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").drop("batch_id")


def late(spark, folder):
    """The newer half of `events` is sent first, then the older half, which comes
    too late for every window that has ended by then."""
    base = tables.scratch_folder(spark, "late")
    events = _read(spark, folder, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    middle = (first + (last - first) / 2).replace(hour=0, minute=0, second=0, microsecond=0)
    newer = F.col("ts") >= F.lit(str(middle)).cast("timestamp_ntz")
    measures = [count_of("value", "n"), max_of("value")]
    for half in (events.where(newer), events.where(~newer)):
        topics.write_topic(
            topics.publish_topic(half, "events", time_format=MICROS), folder=base
        )
        sent = json_parse(topics.topic_source(spark, "events", folder=base), EVENTS)
        hourly = summary.window_summary(
            timing.with_event_time(sent, "ts"), ["event_type"], "ts", "1 hour", measures
        )
        run.run_stream(
            hourly,
            run.versions_writer(f"{base}/out"),
            "update",
            f"{base}/checkpoint",
            {"availableNow": True},
            timeout=WAIT,
        )
    versions = run.read_versions(spark, f"{base}/out", hourly.schema)
    return _no_zone(run.latest_by_key(versions, ["event_type", *BOUNDS]))


BOUNDS = ("window_start", "window_end")


def _no_zone(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in BOUNDS})


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "json_parse": parse_props,
    "required_gate": gate,
    "rejected": rejects,
    "entity_filter": one_entity,
    "quick_filter": quick_per_user,
    "quick_filter_overall": quick_overall,
    "row_index": numbered,
    "typed_projection": projection,
    "duration_seconds": seconds_of_day,
    "duration_text_clean": clean_text,
    "event_time_text": time_text,
    "batch_car_summary": car_by_user,
    "batch_stint_summary": stint_by_supplier,
    "batch_weather_summary": weather_by_segment,
    "mode_by_count": frequent_part,
    "tumbling_window": tumbling,
    "sliding_window": sliding_50,
    "stint_window": sliding_65,
    "stint_window_mode": modes_65,
    "interval_join": points_in_laps,
    "asof_join": last_view,
    "asof_join_first_inside": first_error_in_lap,
    "nest_records": nested,
    "nest_records_parts": nested_parts,
    "explode_records": exploded,
    "publish_topic": published,
    "append_sentinel": with_sentinels,
    "sentinel_cut": before_sentinel,
    "topic_source": message_files,
    "load_session": session,
    "race_lap_messages": race_laps,
    "race_weather_messages": race_weather,
    "race_car_messages": race_car,
    "nested_parse": race_nested,
    "store_split": race_store,
    "store_split_laps": race_store_laps,
    "until_sentinel": until_sentinel,
    "stream_car_summary": live_car,
    "stream_stint_window": live_stint,
    "stream_weather_window": live_weather,
    "late_rows": late,
    "ordered_topic": in_order,
    "stream_pane_window": live_panes,
    "merged_car_summary": merged_car,
    "compacted_versions": compacted,
    "stream_interval_join": live_points_in_laps,
    "stream_asof_join": live_last_view,
    "stream_nest_records": live_nested,
    "stream_batch_rows": batch_rows,
    "bucketed_session": bucketed,
    "rejects_by_reason": rejects_explained,
}
