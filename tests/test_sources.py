"""Tables, topics and JDBC options (no database is started here)."""

import datetime as dt
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from trackside import schemas
from trackside.functions import parsing, skew
from trackside.plans import racing
from trackside.sources import jdbc, ordered, tables, topics


def test_mysql_options():
    db = jdbc.Database.mysql("db.example", "race", "u", "secret", autoReconnect="true")
    assert db.url == (
        "jdbc:mysql://db.example:3306/race?useSSL=true&useCursorFetch=true"
        "&rewriteBatchedStatements=true&autoReconnect=true"
    )
    assert "secret" not in repr(db) and db.options()["password"] == "secret"
    options = jdbc.scan_options(db, "lap", schemas.names("Driver string, LapTime float"))
    assert options["dbtable"] == "(SELECT Driver, LapTime FROM lap) lap"
    assert options["fetchsize"] == "10000"


def test_parallel_scan_options():
    db = jdbc.Database("jdbc:x:y", "d")
    options = jdbc.scan_options(db, "car", (), 16, "LapNumber")
    assert options["dbtable"] == "(SELECT car.*, MOD(LapNumber, 16) AS scan_slice FROM car) car"
    assert (options["partitionColumn"], options["upperBound"], options["numPartitions"]) == (
        "scan_slice", "16", "16",
    )


def test_range_scan_options():
    db = jdbc.Database("jdbc:x:y", "d")
    options = jdbc.scan_options(
        db, "car", ["LapNumber"], 8, "Timestamp", ("2024-03-02 15:00:00", "2024-03-02 17:00:00")
    )
    assert options["dbtable"] == "(SELECT LapNumber FROM car) car"
    assert (options["partitionColumn"], options["lowerBound"], options["numPartitions"]) == (
        "Timestamp", "2024-03-02 15:00:00", "8",
    )


def test_scanned_table_is_checked(spark):
    df = spark.createDataFrame([(1, 2.0, 3)], "LapNumber int, Speed float, scan_slice int")
    assert jdbc.check(df, None).columns == ["LapNumber", "Speed"]
    assert jdbc.check(df, "Speed float").columns == ["Speed"]
    with pytest.raises(schemas.SchemaMismatch):
        jdbc.check(df, schemas.CAR)


def test_write_options():
    db = jdbc.Database("jdbc:x:y", "d", batch_size=500)
    options = jdbc.write_options(db, "lap", {"Driver": "VARCHAR(255)"})
    assert options["batchsize"] == "500"
    assert options["createTableColumnTypes"] == "Driver VARCHAR(255)"


def test_topic_source_needs_one_place(spark):
    with pytest.raises(ValueError):
        topics.topic_source(spark, "car")
    with pytest.raises(ValueError):
        topics.write_topic(spark.createDataFrame([("a", "b")], "topic string, value string"))


class Recorder:
    """Stands for a reader or writer; notes what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def options(self, **settings):
        self.told.update(settings)
        return self

    def load(self):
        return self.told


def test_broker_options():
    session = SimpleNamespace(readStream=Recorder(), read=Recorder())
    told = topics.topic_source(
        session, "lap", servers="b:9092", options={"maxOffsetsPerTrigger": "5000"}
    )
    assert told == {
        "format": "kafka",
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "lap",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000",
    }
    topics.topic_source(session, "lap", servers="b:9092", stream=False, starting="latest")
    assert session.read.told["startingOffsets"] == "latest"


def test_scratch_folder():
    def session(**settings):
        settings = {k.replace("_", "."): v for k, v in settings.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=settings.get))

    shared = tables.scratch_folder(session(spark_checkpoint_dir="/shared/x/"), "out")
    assert shared.startswith("/shared/x/out-")
    assert "out-" in tables.scratch_folder(session(spark_master="local[2]"), "out")
    for master in ("yarn", "local-cluster[3,2,3000]"):
        with pytest.raises(ValueError, match="shared folder"):
            tables.scratch_folder(session(spark_master=master), "out")


T0 = dt.datetime(2024, 3, 2, 15)


def s(seconds):
    return dt.timedelta(seconds=seconds)


def race(spark):
    """Two drivers, four laps of 100 s; driver B's third lap is slow."""
    laps, points, weather = [], [], []
    for driver in "AB":
        start = T0
        for lap in range(1, 5):
            length = s(150 if (driver, lap) == ("B", 3) else 100)
            laps.append(
                ("gp", driver, lap, start, start + length, length, s(30), s(30),
                 length - s(60), 1 + lap // 3, "SOFT", lap, 1)
            )
            for second in range(0, int(length.total_seconds()), 10):
                points.append(
                    ("gp", driver, start + s(second), 100.0 + lap, 50.0, second > 50,
                     lap, 9000, 0)
                )
            start += length
    for minute in range(0, 8):
        weather.append(
            ("gp", T0 + s(60 * minute + 5), 20.0 + minute, 40.0, 1000.0, False, 30.0, 1.0, 9.0)
        )
    return {
        name: spark.createDataFrame(rows, schemas.SESSION_TABLES[name])
        for name, rows in zip(schemas.SESSION_TABLES, (laps, points, weather))
    }


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_load_session(spark, tmp_path, fmt):
    for name, df in race(spark).items():
        df.write.format(fmt).option("header", True).save(f"{tmp_path}/{name}.{fmt}")
    loaded = tables.load_session(spark, str(tmp_path), "gp", fmt)
    assert {n: df.count() for n, df in loaded.items()} == {
        "laps": 8, "car_telemetry": 85, "weather_samples": 8,
    }
    assert loaded["laps"].where("LapNumber = 3 AND Driver = 'B'").first()["LapTime"] == s(150)
    assert tables.load_session(spark, str(tmp_path), "x", fmt)["laps"].count() == 0


def test_load_session_checks_columns(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/laps.parquet")
    with pytest.raises(schemas.SchemaMismatch):
        tables.load_session(spark, str(tmp_path), tables={"laps": "session string"})


@pytest.mark.parametrize("hot_rows", [5, skew.HOT_ROWS])
def test_session_messages(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    frames = race(spark)
    sent = racing.session_messages(
        frames["laps"], frames["car_telemetry"], frames["weather_samples"], "Grand Prix", 1.07
    )
    assert set(sent) == set(topics.TOPICS)
    lap = racing.lap_records(sent["lap"]).collect()
    # the first quick lap of each driver and B's slow lap are left out
    assert {(r["Driver"], r["LapNumber"]) for r in lap} == {
        ("A", 2), ("A", 3), ("A", 4), ("B", 2), ("B", 4),
    }
    assert {(r["LapTime"], r["Sector3Time"]) for r in lap} == {(100.0, 40.0)}
    assert str(min(r["Timestamp"] for r in lap)) == "2024-03-02 15:01:40"
    car = racing.car_summary(racing.car_records(sent["car"]))
    assert {r["LapNumber"]: (r["avg_speed"], r["mode_gear"]) for r in car.collect()} == {
        2: (102.0, 2), 3: (103.0, 3), 4: (104.0, 4),
    }
    weather = racing.weather_records(sent["weather"]).collect()
    # laps from 100, 200, 300 and 350 s: first samples inside at 125, 245, 305, 365 s
    assert sorted(r["AirTemp"] for r in weather) == [22.0, 22.0, 24.0, 25.0, 26.0]
    assert {r["Race"] for r in weather} == {"Grand Prix"}
    nested = racing.nested_records(sent["dbstore"]).collect()
    assert sorted(len(r["car"]) for r in nested) == [10] * 5
    for r in nested:
        times = [c["Timestamp"] for c in r["car"]]
        assert times == sorted(times)
        assert r["lap"]["LapNumber"] == r["weather"]["LapNumber"] == r["car"][0]["LapNumber"]
        assert r["lap"]["Timestamp"] == times[0] and r["weather"]["Race"] == "Grand Prix"


def test_one_driver_without_skipping(spark):
    frames = race(spark)
    laps = racing.session_laps(frames["laps"], "B", 1.07, skip_first=0)
    assert sorted(r["LapNumber"] for r in laps.collect()) == [1, 2, 4]


def test_race_by_session(spark):
    frames = race(spark)
    two = {n: df.union(df.withColumn("session", F.lit("gp2"))) for n, df in frames.items()}
    ways = [
        {"gp": "First", "gp2": "Second"},
        F.when(F.col("session") == "gp", "First").otherwise("Second"),
    ]
    for names in ways:
        sent = racing.session_messages(*two.values(), names, 1.07, topics=["weather"])
        summed = racing.weather_summary(racing.weather_records(sent["weather"]))
        assert {r["Race"] for r in summed.collect()} == {"First", "Second"}


def test_messages_carry_key_and_time(spark, tmp_path):
    sent = racing.session_messages(*race(spark).values(), "Grand Prix", 1.07)
    for messages in sent.values():
        assert messages.columns == ["key", "sent_at", "topic", "value"]
        assert {r["key"] for r in messages.collect()} == {"gp:A", "gp:B"}
        assert messages.where(parsing.is_sentinel()).count() == 0
    racing.send_messages(sent, folder=str(tmp_path))
    for topic in sent:
        back = ordered.source(spark, topic, str(tmp_path), stream=False)
        assert back.count() == sent[topic].count() + 1
        assert back.where(parsing.is_sentinel()).count() == 1


def test_lap_with_many_points(spark):
    """6,000 points of one lap fill two messages and all come back."""
    frames = race(spark)
    many = frames["car_telemetry"].limit(0).union(
        spark.range(6000).selectExpr(
            "'gp'", "'A'", "timestamp '2024-03-02 15:01:40' + make_dt_interval(0, 0, 0, id / 100.0)",
            "1.0D", "2.0D", "true", "3", "4", "0",
        )
    )
    sent = racing.session_messages(frames["laps"], many, frames["weather_samples"], "GP", 1.07, "A", topics=["dbstore"])
    records = racing.nested_records(sent["dbstore"])
    own = records.where("lap.LapNumber = 2").select("part", "lap.Driver", F.size("car").alias("n"))
    assert sorted(map(tuple, own.collect())) == [(0, "A", 5000), (1, "A", 1000)]
