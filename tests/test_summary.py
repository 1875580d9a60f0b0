"""Aggregates, modes and windows on small hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trackside.functions.measures import avg_of, count_of, max_of, min_of, mode_of, sum_of
from trackside.operators import summary
from trackside.plans import racing


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 3), (1, 4), (2, 8), (2, 2), (2, 5), (3, None), (3, 7), (3, None), (4, None)],
        "lap int, gear int",
    )
    want = {1: 3, 2: 2, 3: 7, 4: None}
    built_in = df.groupBy("lap").agg(mode_of("gear").expr())
    count = summary.mode_by_count(df, ["lap"], "gear")
    assert {r[0]: r[1] for r in built_in.collect()} == want
    assert {r[0]: r[1] for r in count.collect()} == want


def test_mode_next_to_other_measures(spark):
    df = spark.createDataFrame(
        [(None, 3, 1.5), (None, 4, None), (None, 4, 2.0), (1, None, None)],
        "lap int, gear int, v double",
    )
    measures = [avg_of("v", scale=2), mode_of("gear"), max_of("gear"), count_of("v"), avg_of("gear")]
    one_step = df.groupBy("lap").agg(*(m.expr() for m in measures))
    two_steps = summary.group_summary(df, ["lap"], measures)
    assert two_steps.dtypes == one_step.dtypes
    assert sorted(map(tuple, two_steps.collect()), key=repr) == sorted(
        map(tuple, one_step.collect()), key=repr
    )
    both = summary.group_summary(df, [], [mode_of("gear"), mode_of("v")])
    assert tuple(both.first()) == (4, 1.5)


def test_all_null_group_and_null_key(spark):
    df = spark.createDataFrame(
        [("A", None), ("A", None), (None, 1.0), (None, 2.0)], "race string, t float"
    )
    out = summary.group_summary(df, ["race"], [avg_of("t"), max_of("t"), avg_of("t", "e", 3)])
    assert {tuple(r) for r in out.collect()} == {("A", None, None, None), (None, 1.5, 2.0, 1.5)}


def test_float_average_is_widened(spark):
    df = spark.createDataFrame([(1, 97.284)], "lap int, speed float")
    row = summary.group_summary(df, ["lap"], [avg_of("speed"), max_of("speed")]).first()
    assert row["avg_speed"] == 97.28399658203125


def test_stint_summary_names_best_and_max(spark):
    df = spark.createDataFrame(
        [("A", 1, "SOFT", 97.5), ("A", 1, "SOFT", 96.5)],
        "Driver string, Stint int, Compound string, LapTime float",
    )
    row = racing.stint_summary(df).first()
    assert (row["average_lap_time"], row["best_lap_time"], row["max_lap_time"]) == (
        97.0, 96.5, 97.5,
    )
    assert "Best Lap Time" in racing.lap_time_titles(racing.stint_summary(df)).columns


def windows_of(spark, *args):
    df = spark.createDataFrame([("2024-03-02 15:00:03", 1)], "t string, v int")
    df = df.select(F.col("t").cast("timestamp").alias("ts"), "v")
    out = summary.window_summary(df, [], "ts", args[0], [count_of("v", "n")], *args[1:])
    return sorted(str(r["window_start"].time()) for r in out.collect())


def test_window_alignment(spark):
    assert windows_of(spark, "65 seconds") == ["14:59:40"]
    assert windows_of(spark, "50 seconds", "10 seconds") == [
        "14:59:20", "14:59:30", "14:59:40", "14:59:50", "15:00:00",
    ]


@pytest.mark.parametrize("size,slide", [(65, 10), (50, 10), (60, 60), (7, 3)])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("with_mode", [False, True])
def test_panes_equal_windows(spark, size, slide, kind, with_mode):
    start = dt.datetime(1969, 12, 31, 23, 59, 0)
    data = [
        ("ab"[i % 2], start + dt.timedelta(milliseconds=517 * i), i * 0.25 if i % 7 else None)
        for i in range(400)
    ] + [("a", None, 1.0)]
    df = spark.createDataFrame(data, f"k string, ts {kind}, v double")
    df = df.withColumn("gear", F.when(F.col("v") > 9, F.floor("v") % 3))
    measures = [avg_of("v", scale=2), min_of("v"), max_of("v"), sum_of("v"), count_of("v")]
    measures += [mode_of("gear")] * with_mode
    lengths = ("ts", f"{size} seconds", measures, f"{slide} seconds")
    wide = summary.row_window_summary(df, ["k"], *lengths)
    panes = summary.window_summary(df, ["k"], *lengths)
    assert panes.dtypes == wide.dtypes
    assert sorted(map(tuple, panes.collect()), key=repr) == sorted(
        map(tuple, wide.collect()), key=repr
    )


def test_windows_without_panes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 4)], "ts timestamp, gear int")
    for measure, size, slide in (
        (mode_of("gear", "x"), "50 seconds", "10 seconds"),
        (max_of("gear", "x"), "1500 milliseconds", "500 milliseconds"),
    ):
        out = summary.window_summary(df, [], "ts", size, [measure], slide)
        assert out.count() == out.where("x = 4").count() > 1


def test_panes_refuse_gaps_and_modes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1)], "ts timestamp, v int")
    with pytest.raises(ValueError, match="gaps"):
        summary.pane_summary(df, [], "ts", 10, 20, [max_of("v")])
    with pytest.raises(ValueError, match="mode"):
        summary.pane_summary(df, [], "ts", 20, 10, [mode_of("v"), mode_of("v", "w")])
