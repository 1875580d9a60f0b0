"""The motor-race preset: session to messages, and the six analyses.

Car, stint and weather each have one list of measures, used by the batch job
over stored tables and by the live job over a topic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackside import schemas
from trackside.functions import skew
from trackside.functions.measures import Measure, avg_of, max_of, min_of, mode_of
from trackside.functions.parsing import json_parse, nested_parse
from trackside.functions.timing import duration_seconds, with_event_time
from trackside.operators.joins import asof_join, interval_join
from trackside.operators.nesting import nest_records
from trackside.operators.rows import (
    closing_gate,
    display_names,
    entity_filter,
    quick_filter,
    required_gate,
    row_index,
    typed_projection,
)
from trackside.operators.summary import (
    combined_summary,
    finished_summary,
    group_summary,
    live_pane_summary,
    partial_summary,
    window_summary,
)
from trackside.sources.tables import written
from trackside.sources import ordered
from trackside.sources.topics import TOPICS, end_topics, publish_topic, write_topic
from trackside.streaming.commits import MergedRuns

# Averages add decimals: the same in every run, for stored tables and live.
CAR_MEASURES = (
    avg_of("Throttle", scale=6),
    avg_of("Speed", scale=6),
    avg_of("RPM", scale=0),
    mode_of("Gear"),
    max_of("Speed"),
)
LAP_MEASURES = (
    avg_of("LapTime", "average_lap_time", scale=6),
    min_of("LapTime", "best_lap_time"),
    max_of("LapTime", "max_lap_time"),
)
WEATHER_MEASURES = (
    avg_of("AirTemp", scale=6),
    avg_of("Humidity", scale=6),
    avg_of("TrackTemp", scale=6),
    avg_of("WindSpeed", scale=6),
)
STINT = ("Driver", "Stint", "Compound")
LAP_TITLES = {
    "average_lap_time": "Average Lap Time",
    "best_lap_time": "Best Lap Time",
    "max_lap_time": "Max Lap Time",
}


# -- typed records from messages ---------------------------------------------


def car_records(messages: DataFrame, keep_nan: bool = False) -> DataFrame:
    """Car points of the topic; sentinels and records without a lap are dropped."""
    parsed = json_parse(messages, schemas.CAR, keep_nan=keep_nan)
    return required_gate(parsed, "LapNumber")


def lap_records(messages: DataFrame, keep_nan: bool = False) -> DataFrame:
    """Laps of the topic; records without a lap time are dropped."""
    return required_gate(json_parse(messages, schemas.LAP, keep_nan=keep_nan), "LapTime")


def weather_records(messages: DataFrame, keep_nan: bool = False) -> DataFrame:
    """Weather samples of the topic; records without a lap are dropped."""
    parsed = json_parse(messages, schemas.WEATHER, keep_nan=keep_nan)
    return required_gate(parsed, "LapNumber")


def nested_records(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested lap messages; sentinels and messages with no content are dropped."""
    nested = nested_parse(messages, keep=keep)
    return nested.where(F.col("lap").isNotNull() | F.col("car").isNotNull())


# -- the analyses ------------------------------------------------------------


def car_summary(car: DataFrame, measures: Sequence[Measure] = CAR_MEASURES) -> DataFrame:
    """Throttle, speed, revs and gear per lap."""
    return group_summary(car, ["LapNumber"], measures)


def stint_summary(
    lap: DataFrame, measures: Sequence[Measure] = LAP_MEASURES
) -> DataFrame:
    """Lap times per driver, stint and tyre compound."""
    return group_summary(lap, STINT, measures)


def weather_summary(
    weather: DataFrame, measures: Sequence[Measure] = WEATHER_MEASURES
) -> DataFrame:
    """Weather per race; samples that name no race form one group."""
    return group_summary(weather, ["Race"], measures)


def live_car_summary(
    car: DataFrame, delay: str = "0 seconds", measures: Sequence[Measure] = CAR_MEASURES
) -> DataFrame:
    """`car_summary` on a stream, for complete mode.

    Laps are grouped without their time, so state is kept for every lap seen and
    a late point still counts.
    """
    return car_summary(with_event_time(car, "Timestamp", delay), measures)


def merged_car_summary(
    folder: str, measures: Sequence[Measure] = CAR_MEASURES, fan: int = 4
) -> MergedRuns:
    """A table under `folder` of the car summary per lap, kept up by batches.

    Its `write` takes the micro-batches of a stream of car points without state (append
    mode): each is reduced to sums, counts and counts per gear, and these are merged.
    So a late point still counts, no state grows in the stream, and nothing is
    rewritten whole. `finished_car_summary` reads it.
    """
    return MergedRuns(
        folder,
        ["LapNumber"],
        lambda batch: partial_summary(batch, ["LapNumber"], measures),
        lambda runs: combined_summary(runs, ["LapNumber"], measures),
        fan,
    )


def finished_car_summary(
    spark: SparkSession, merged: MergedRuns, measures: Sequence[Measure] = CAR_MEASURES
) -> DataFrame:
    """`car_summary` of all points that `merged` has been given."""
    empty = spark.createDataFrame([], schemas.CAR)
    partials = merged.read(spark, partial_summary(empty, ["LapNumber"], measures).schema)
    return finished_summary(partials, ["LapNumber"], measures)


def live_car_windows(
    car: DataFrame,
    size: str = "5 minutes",
    delay: str = "0 seconds",
    measures: Sequence[Measure] = CAR_MEASURES,
) -> DataFrame:
    """Car summary per lap and time window: state ends with the window, so it
    stays bounded on an endless stream."""
    timed = with_event_time(car, "Timestamp", delay)
    return window_summary(timed, ["LapNumber"], "Timestamp", size, measures)


def live_stint_windows(
    lap: DataFrame,
    size: str = "65 seconds",
    slide: str | None = "10 seconds",
    delay: str = "0 seconds",
    measures: Sequence[Measure] = LAP_MEASURES,
) -> DataFrame:
    """Lap times per stint in sliding windows (tumbling without `slide`)."""
    timed = with_event_time(lap, "Timestamp", delay)
    return window_summary(timed, STINT, "Timestamp", size, measures, slide)


def live_weather_windows(
    weather: DataFrame,
    size: str = "50 seconds",
    slide: str | None = "10 seconds",
    delay: str = "0 seconds",
    measures: Sequence[Measure] = WEATHER_MEASURES,
) -> DataFrame:
    """Weather per race in sliding windows."""
    timed = with_event_time(weather, "Timestamp", delay)
    return window_summary(timed, ["Race"], "Timestamp", size, measures, slide)


def live_stint_panes(
    messages: DataFrame,
    size: str = "65 seconds",
    slide: str = "10 seconds",
    delay: str = "0 seconds",
    measures: Sequence[Measure] = LAP_MEASURES,
) -> DataFrame:
    """Lap times per stint in sliding windows by panes, for append mode, out of lap
    messages with their `sent_at`. The message that ends the topic closes them all."""
    return _live_panes(messages, schemas.LAP, "LapTime", STINT, size, slide, delay, measures)


def live_weather_panes(
    messages: DataFrame,
    size: str = "50 seconds",
    slide: str = "10 seconds",
    delay: str = "0 seconds",
    measures: Sequence[Measure] = WEATHER_MEASURES,
) -> DataFrame:
    """Weather per race in sliding windows by panes, as `live_stint_panes`."""
    return _live_panes(messages, schemas.WEATHER, "LapNumber", ["Race"], size, slide, delay, measures)


def _live_panes(messages, ddl, field, keys, size, slide, delay, measures) -> DataFrame:
    timed = with_event_time(messages, "sent_at", delay)
    parsed = closing_gate(json_parse(timed, ddl, keep=["sent_at"]), "sent_at", field)
    return live_pane_summary(parsed, keys, "sent_at", size, measures, slide)


def lap_time_titles(df: DataFrame) -> DataFrame:
    """Lap-time columns under the names shown to people."""
    return display_names(df, LAP_TITLES)


# -- session to messages -----------------------------------------------------


def session_laps(
    laps: DataFrame, driver: str | None, threshold: float, skip_first: int = 1
) -> DataFrame:
    """The quick laps of a driver (of all without one), numbered by start.

    A lap is quick within `threshold` times the best lap of its session,
    whoever drove it. The first `skip_first` quick laps are left out.
    """
    timed = laps.withColumn("_seconds", duration_seconds("LapTime"))
    own = timed if driver is None else entity_filter(timed, "Driver", driver)
    quick = quick_filter(own, "_seconds", threshold, ["session"], best_from=timed)
    return row_index(
        quick.drop("_seconds"),
        ["session", "Driver"],
        ["lap_start", "LapNumber"],
        skip_first=skip_first,
    ).drop("idx")


WHO = {"session": ("session", "string"), "_driver": ("Driver", "string")}
LAP_KEY = ("session", "_driver", "LapNumber")


def car_rows(laps: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Car records of the laps: a point belongs to the lap whose half-open
    interval holds it. Session and driver stay in front, here and below."""
    points = interval_join(
        telemetry,
        laps.select("session", "Driver", "LapNumber", "lap_start", "lap_end"),
        ["session", "Driver"],
        "ts",
        "lap_start",
        "lap_end",
    )
    columns = {
        "Timestamp": ("ts", "timestamp"),
        "LapNumber": ("LapNumber", "int"),
        "Speed": ("Speed", "float"),
        "Throttle": ("Throttle", "float"),
        "Brake": ("Brake", "int"),
        "Gear": ("nGear", "int"),
        "RPM": ("RPM", "int"),
        "DRS": ("DRS", "int"),
    }
    return typed_projection(points, {**WHO, **columns})


def lap_rows(laps: DataFrame) -> DataFrame:
    """Lap records, durations in seconds."""
    seconds = lambda name: (duration_seconds(name), "float")
    columns = {
        "Timestamp": ("lap_start", "timestamp"),
        "LapNumber": ("LapNumber", "int"),
        "Driver": ("Driver", "string"),
        "LapTime": seconds("LapTime"),
        "Stint": ("Stint", "int"),
        "Sector1Time": seconds("Sector1Time"),
        "Sector2Time": seconds("Sector2Time"),
        "Sector3Time": seconds("Sector3Time"),
        "Compound": ("Compound", "string"),
        "TyreLife": ("TyreLife", "int"),
        "Position": ("Position", "int"),
    }
    return typed_projection(laps, {**WHO, **columns})


def race_name(race: str | Column | Mapping[str, str]) -> Column:
    """The race of a session as a column: one for all, an expression over column
    `session`, or one from a mapping (NULL for a session it lacks)."""
    if isinstance(race, Mapping):
        pairs = [F.lit(x) for pair in race.items() for x in pair]
        return F.try_element_at(F.create_map(*pairs), F.col("session"))
    return race if isinstance(race, Column) else F.lit(race)


def weather_rows(
    laps: DataFrame, samples: DataFrame, race: str | Column | Mapping[str, str]
) -> DataFrame:
    """Weather records, one per lap: the first sample inside the lap, or else the
    last one before it. `race` as in `race_name`."""
    found = asof_join(
        laps.select("session", "Driver", "LapNumber", "lap_start", "lap_end"),
        samples,
        ["session"],
        "lap_start",
        "ts",
        until="lap_end",
        name="sample",
    )
    reading = lambda name, kind="float": (F.col(f"sample.{name}"), kind)
    columns = {
        "Timestamp": ("lap_start", "timestamp"),
        "LapNumber": ("LapNumber", "int"),
        "AirTemp": reading("AirTemp"),
        "Humidity": reading("Humidity"),
        "Pressure": reading("Pressure"),
        "Rainfall": reading("Rainfall", "int"),
        "TrackTemp": reading("TrackTemp"),
        "WindSpeed": reading("WindSpeed"),
        "WindDirection": reading("WindDirection"),
        "Race": (race_name(race), "string"),
    }
    return typed_projection(found, {**WHO, **columns})


def nested_rows(
    lap: DataFrame, weather: DataFrame, car: DataFrame, hot_rows: int | None
) -> DataFrame:
    """One record per lap: the lap, its weather and its car points in time order."""
    lap, weather = (
        df.select(*LAP_KEY, F.struct(*schemas.names(ddl)).alias(name))
        for df, name, ddl in (
            (lap, "lap", schemas.LAP),
            (weather, "weather", schemas.WEATHER),
        )
    )
    return nest_records(
        lap.join(weather, list(LAP_KEY), "left"),
        car,
        LAP_KEY,
        schemas.names(schemas.CAR),
        "car",
        schemas.names(schemas.CAR),
        {"lap": ["lap.*"], "weather": ["weather.*"]},
        hot_rows=hot_rows,
    )


def session_messages(
    laps: DataFrame,
    telemetry: DataFrame,
    samples: DataFrame,
    race: str | Column | Mapping[str, str],
    threshold: float,
    driver: str | None = None,
    skip_first: int = 1,
    topics: Sequence[str] = TOPICS,
) -> dict[str, DataFrame]:
    """The messages of the topics for a session, without their sentinels.

    Each message has the session and driver as its key, and its time, so that
    `send_messages` sends a driver's messages in order. The chosen laps are
    written to the shared folder, since every topic is made from them.
    """
    chosen = written(session_laps(laps, driver, threshold, skip_first), "laps")
    who = F.concat_ws(":", "session", "_driver")

    def messages(rows: DataFrame, topic: str, fields: Sequence[str]) -> DataFrame:
        return publish_topic(rows, topic, fields, key=who, time="Timestamp")

    out = {}
    if "car" in topics:
        out["car"] = messages(car_rows(chosen, telemetry), "car", schemas.names(schemas.CAR))
    if "lap" in topics:
        out["lap"] = messages(lap_rows(chosen), "lap", schemas.names(schemas.LAP))
    if "weather" in topics:
        weather = weather_rows(chosen, samples, race)
        out["weather"] = messages(weather, "weather", schemas.names(schemas.WEATHER))
    if "dbstore" in topics:
        # where no driver has too many points for a task, no lap has
        hot = skew.hot_keys(telemetry, ["session", "Driver"], skew.HOT_ROWS)
        nested = nested_rows(
            lap_rows(chosen),
            weather_rows(chosen, samples, race),
            car_rows(chosen, telemetry),
            skew.HOT_ROWS if hot else None,
        )
        fields = ["part", "lap", "weather", "car"]
        timed = nested.withColumn("Timestamp", F.col("lap.Timestamp"))
        out["dbstore"] = messages(timed, "dbstore", fields)
    return out


def send_messages(
    sent: Mapping[str, DataFrame],
    servers: str | None = None,
    folder: str | None = None,
    partitions: Mapping[str, int] | int = 1,
) -> None:
    """Send what `session_messages` made, then each topic's sentinels.

    `partitions` is the number of partitions of every topic, or of each. To a broker
    a key's messages go in order of time; in a `folder` all messages of a topic do,
    whichever task wrote them (`ordered.source` reads them).
    """
    count = dict.fromkeys(sent, partitions) if isinstance(partitions, int) else partitions
    some = next(iter(sent.values()), None)
    if some is None:
        return
    for messages in sent.values():
        if folder is not None and servers is None:
            ordered.send(messages, folder, count)
        else:
            write_topic(messages, servers, folder)
    if folder is not None:
        ordered.end(some.sparkSession, folder, {t: count[t] for t in sent})
    else:
        end_topics(some.sparkSession, {t: count[t] for t in sent}, servers)
