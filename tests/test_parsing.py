"""Messages to rows: sentinels, garbage, wrong types, NaN, nested records."""

import json
import math

import pytest
from pyspark.sql import functions as F

from trackside import schemas
from trackside.functions.parsing import is_sentinel, json_parse, nested_parse
from trackside.operators import nesting, rows
from trackside.plans import racing
from trackside.sources import topics


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_edge_messages(spark):
    df = messages(
        spark,
        '{"Timestamp": "2024-03-02 15:00:03", "LapNumber": 3, "Speed": 97.284, "Gear": 4}',
        '{"end": "end"}',
        "garbage",
        None,
        '{"LapNumber": "7", "Speed": 1}',
        '{"LapNumber": 3000000000, "Speed": 1}',
        '{"lapnumber": 3}',
        '{"LapNumber": 9, "Speed": NaN}',
    )
    parsed = json_parse(df, schemas.CAR, keep=["value"])
    kept = {r["LapNumber"]: r for r in rows.required_gate(parsed, "LapNumber").collect()}
    assert set(kept) == {3, 9}
    assert kept[3]["Speed"] == pytest.approx(97.28399658203125, abs=0)
    assert str(kept[3]["Timestamp"]) == "2024-03-02 15:00:03"
    assert kept[9]["Speed"] is None
    assert rows.rejected(parsed, "LapNumber").count() == 6
    assert {r["Speed"] for r in rows.rejected(parsed, "LapNumber").collect()} == {None, 1.0}


def test_nan_kept_on_request(spark):
    df = messages(spark, '{"LapNumber": 9, "Speed": NaN}')
    assert math.isnan(racing.car_records(df, keep_nan=True).first()["Speed"])


def test_messages_are_parsed_once(spark, capsys):
    racing.car_summary(racing.car_records(messages(spark, "{}").repartition(2))).explain()
    assert capsys.readouterr().out.count("from_json") == 1


def test_bytes_read_like_text(spark):
    df = messages(spark, '{"LapNumber": 1}').withColumn("value", F.encode("value", "utf-8"))
    assert racing.car_records(df).first()["LapNumber"] == 1


def test_sentinel_is_a_top_level_key(spark):
    df = messages(
        spark,
        '{"end": "end"}',
        '{"end": null}',
        '{"Driver": "end"}',
        '{"lap": {"end": 1}}',
        '"end"',
        "end",
        None,
    )
    assert [r[0] for r in df.select(is_sentinel("value")).collect()] == [
        True, True, False, False, False, False, False,
    ]


def test_nested_nan_and_missing_fields(spark):
    record = {
        "lap": {"LapNumber": 2, "Driver": "A", "LapTime": float("nan")},
        "weather": {"LapNumber": 2, "AirTemp": 20.5},
        "car": [{"LapNumber": 2, "Speed": float("nan")}, {"LapNumber": 2, "Speed": 5}],
    }
    parsed = nested_parse(messages(spark, json.dumps(record))).first()
    assert parsed["lap"]["LapTime"] is None and parsed["lap"]["Timestamp"] is None
    assert parsed["weather"]["Race"] is None
    assert [c["Speed"] for c in parsed["car"]] == [None, 5.0]


def test_nested_without_points(spark):
    df = messages(
        spark, '{"lap": {"LapNumber": 1}, "weather": {"LapNumber": 1}, "car": []}',
        topics.SENTINEL,
    )
    nested = racing.nested_records(df)
    assert nesting.unpack_parents(nested, "lap").count() == 1
    assert nesting.explode_records(nested, "car").count() == 0


def test_publish_and_append_sentinel(spark):
    df = spark.createDataFrame([(1, 2.5, "é"), (2, None, "b")], "id int, x double, t string")
    sent = topics.append_sentinel(topics.publish_topic(df, "car"), ["car", "lap"])
    assert sent.where(is_sentinel("value")).count() == 2
    back = json_parse(sent, "id int, x double, t string")
    assert {tuple(r) for r in rows.required_gate(back, "id").collect()} == {
        (1, 2.5, "é"), (2, None, "b"),
    }


def test_sentinel_cut_without_partitions(spark):
    df = spark.createDataFrame(
        [(0, "{}"), (1, topics.SENTINEL), (2, "{}")], "offset int, value string"
    )
    assert [r["offset"] for r in rows.sentinel_cut(df).collect()] == [0]
    assert rows.sentinel_cut(df.where("offset != 1")).count() == 2


def test_schema_check(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "LapNumber int, Speed float, more string")
    assert schemas.check_schema(df, "Speed float, LapNumber int").columns == [
        "Speed", "LapNumber",
    ]
    with pytest.raises(schemas.SchemaMismatch, match="Gear: declared int, found nothing"):
        schemas.check_schema(df, "LapNumber int, Gear int")
    with pytest.raises(schemas.SchemaMismatch, match="found float"):
        schemas.check_schema(df, "Speed double")


def test_typed_projection_strict_or_not(spark):
    df = spark.createDataFrame([("7",), ("x",)], "t string")
    spec = {"n": ("t", "int"), "race": (F.lit("GP"), "string")}
    loose = rows.typed_projection(df, spec, strict=False).collect()
    assert [tuple(r) for r in loose] == [(7, "GP"), (None, "GP")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows.typed_projection(df, spec).collect()


def test_duration_text(spark):
    from trackside.functions.timing import duration_text_clean

    df = spark.createDataFrame([("0 days 00:01:37",), ("10 days x",)], "t string")
    assert [r[0] for r in df.select(duration_text_clean("t")).collect()] == [
        "00:01:37", "1x",
    ]
