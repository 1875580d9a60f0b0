"""Numbering, joins on time and nesting against brute force, hot keys included."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from trackside.functions import skew
from trackside.operators import joins, nesting, rows

T0 = dt.datetime(2024, 3, 2, 15)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def skewed_events(n, seed, times=600):
    """(key, second, id): one key holds a third, NULL keys some, times repeat."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{rng.randrange(9)}"
        out.append((key, rng.randrange(times), i))
    return out


@pytest.mark.parametrize("hot_rows", [None, 3, 50, 100_000])
def test_row_index(spark, hot_rows):
    data = skewed_events(900, 1)
    df = spark.createDataFrame(
        [(k, at(s), i) for k, s, i in data], "k string, ts timestamp_ntz, id int"
    ).repartition(5)
    out = rows.row_index(df, ["k"], ["ts", "id"], skip_first=1, hot_rows=hot_rows)
    got = {r["id"]: r["idx"] for r in out.collect()}
    want = {}
    for key in {k for k, _, _ in data}:
        for n, (_, i) in enumerate(sorted((s, i) for k, s, i in data if k == key)):
            if n >= 1:
                want[i] = n
    assert got == want
    assert out.columns == ["k", "ts", "id", "idx"]


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_row_index_without_keys(spark, hot_rows):
    df = spark.range(300).select((F.col("id") * 7919 % 300).alias("n"))
    out = rows.row_index(df, [], ["n"], hot_rows=hot_rows)
    assert all(r["n"] == r["idx"] for r in out.collect()) and out.count() == 300


def test_hot_key_is_cut_evenly(spark):
    df = spark.createDataFrame(
        [("hot", 7, i) for i in range(4000)] + [("k", 7, i) for i in range(9)],
        "k string, t int, id int",
    )
    blocks = skew.ordered_blocks(df, ["k"], [F.col("t"), F.col("id")], hot_rows=500)
    sizes = blocks.df.groupBy("k", skew.BLOCK).count().collect()
    assert sum(r["count"] for r in sizes) == 4009
    assert len([r for r in sizes if r["k"] == "hot"]) == 8
    assert max(r["count"] for r in sizes) < 1500
    assert blocks.table.count() == 8


def test_number_of_blocks_is_bounded(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), "id")
    blocks = skew.ordered_blocks(df, ["k"], [F.col("id")], hot_rows=10, max_blocks=20)
    assert blocks.table.count() <= 22


@pytest.mark.parametrize("limit", [0, 100])
def test_lookup_join_either_way(spark, limit):
    big = spark.range(100).select((F.col("id") % 5).alias("k"), "id")
    small = spark.createDataFrame([(k, k * 10) for k in range(4)], "k long, v long")
    out = skew.lookup_join(big, small, ["k"], "left", max_rows=limit)
    assert {r["id"]: r["v"] for r in out.collect()} == {
        i: i % 5 * 10 if i % 5 < 4 else None for i in range(100)
    }


@pytest.mark.parametrize("scope", [["k"], []])
def test_quick_filter(spark, scope):
    data = [("a", 1, 100.0), ("a", 2, 107.0), ("a", 3, 107.5), ("b", 4, 90.0), ("b", 5, None)]
    df = spark.createDataFrame(data, "k string, id int, x double")
    got = {r["id"] for r in rows.quick_filter(df, "x", 1.07, scope).collect()}
    assert got == ({1, 2, 4} if scope else {4})
    best = spark.createDataFrame([("a", 50.0), ("b", 200.0)], "k string, x double")
    got = {r["id"] for r in rows.quick_filter(df, "x", 2.0, scope, best).collect()}
    assert got == ({1, 4} if scope else {1, 4})


def spans_and_points(seed, shape):
    rng = random.Random(seed)
    points = skewed_events(600, seed, 5000)
    spans = []
    for i in range(250):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(9)}"
        start = rng.randrange(5000)
        length = {
            "even": 40,
            "mixed": rng.choice([0, 1, 3, 30, 4000]),
            "far": rng.choice([1, 1, 1, 10**6, 10**9]),
        }[shape]
        spans.append((key, i, start, start + length))
    return points, spans


@pytest.mark.parametrize("shape", ["even", "mixed", "far"])
@pytest.mark.parametrize("per_bin", [1, 256])
@pytest.mark.parametrize("bin_seconds", [None, 2.0])
def test_interval_join(spark, monkeypatch, shape, per_bin, bin_seconds):
    monkeypatch.setattr(joins, "SPANS_PER_BIN", per_bin)
    points, spans = spans_and_points(5, shape)
    left = spark.createDataFrame(
        [(k, at(s), i) for k, s, i in points], "k string, ts timestamp, id int"
    )
    right = spark.createDataFrame(
        [(k, i, at(a), at(b)) for k, i, a, b in spans],
        "k string, span int, a timestamp, b timestamp",
    )
    out = joins.interval_join(left, right, ["k"], "ts", "a", "b", bin_seconds)
    assert out.columns == ["k", "ts", "id", "span", "a", "b"]
    got = sorted((r["id"], r["span"]) for r in out.collect())
    want = sorted(
        (i, j) for k, s, i in points for key, j, a, b in spans if k == key and a <= s < b
    )
    assert got == want


def test_interval_join_edges(spark):
    points = spark.createDataFrame(
        [("a", at(s), s) for s in (0, 9, 10, 20)], "k string, ts timestamp, id int"
    )
    laps = spark.createDataFrame(
        [("a", 1, at(0), at(10)), ("a", 2, at(10), at(20))],
        "k string, lap int, a timestamp, b timestamp",
    )
    out = joins.interval_join(points, laps, ["k"], "ts", "a", "b")
    assert {r["id"]: r["lap"] for r in out.collect()} == {0: 1, 9: 1, 10: 2}
    none = joins.interval_join(points, laps.limit(0), ["k"], "ts", "a", "b")
    assert none.count() == 0
    with pytest.raises(ValueError):
        joins.interval_join(points, laps, [], "ts", "a", "b")


def test_interval_join_plan(spark, capsys):
    points, spans = spans_and_points(5, "even")
    left = spark.createDataFrame(
        [(k, at(s), i) for k, s, i in points], "k string, ts timestamp, id int"
    )
    right = spark.createDataFrame(
        [(k, i, at(a), at(b)) for k, i, a, b in spans],
        "k string, span int, a timestamp, b timestamp",
    ).hint("merge")
    out = joins.interval_join(left, right, ["k"], "ts", "a", "b")
    out.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def asof_frames(spark, seed, times=600):
    laps = skewed_events(500, seed, times)
    samples = skewed_events(240, seed + 1, times)
    left = spark.createDataFrame(
        [(k, at(s), i, at(s + 20)) for k, s, i in laps],
        "k string, ts timestamp_ntz, id int, until timestamp_ntz",
    )
    right = spark.createDataFrame(
        [(k, at(s), i, None if i % 4 == 0 else float(i)) for k, s, i in samples],
        "k string, at timestamp_ntz, seq int, temp float",
    )
    return laps, samples, left, right


@pytest.mark.parametrize("times", [600, 3])
@pytest.mark.parametrize("hot_rows", [None, 20, 100_000])
@pytest.mark.parametrize("inside", [False, True])
def test_asof_join(spark, hot_rows, inside, times):
    laps, samples, left, right = asof_frames(spark, 3, times)
    out = joins.asof_join(
        left, right, ["k"], "ts", "at", "seq", "until" if inside else None, "w", hot_rows
    )
    assert out.columns == ["k", "ts", "id", "until", "w"]
    got = {r["id"]: r["w"] and (r["w"]["seq"], r["w"]["temp"]) for r in out.collect()}
    want = {}
    for k, s, i in laps:
        own = sorted((t, q) for key, t, q in samples if key == k and k is not None)
        before = [p for p in own if p[0] <= s]
        found = before[-1] if before else None
        if inside:
            within = [p for p in own if s <= p[0] < s + 20]
            found = within[0] if within else found
        want[i] = found and (found[1], None if found[1] % 4 == 0 else float(found[1]))
    assert got == want


def test_asof_without_samples(spark):
    _, _, left, right = asof_frames(spark, 3)
    out = joins.asof_join(left, right.limit(0), ["k"], "ts", "at", hot_rows=40)
    assert out.count() == 500 and out.where("match IS NOT NULL").count() == 0


@pytest.mark.parametrize("hot_rows", [None, 60, 100_000])
def test_nest_and_unpack(spark, hot_rows):
    data = [(k or "none", s, i) for k, s, i in skewed_events(700, 8)]
    children = spark.createDataFrame(data, "k string, t int, id int").repartition(4)
    parents = spark.createDataFrame(
        [(k, len(k)) for k in ("hot", "none", "empty", "k1", "k2", "k3")],
        "k string, size int",
    )
    packed = nesting.nest_records(
        parents, children, ["k"], ["t", "id"], "items", ["t", "id"],
        {"head": ["size"]}, max_items=50, hot_rows=hot_rows,
    )
    records = packed.collect()
    assert max(len(r["items"]) for r in records) == 50
    for key in ("hot", "none", "empty", "k1"):
        own = sorted((r["part"], r) for r in records if r["k"] == key)
        assert [p for p, _ in own] == list(range(len(own)))
        assert [r["head"]["size"] for _, r in own] == [len(key)] * len(own)
        items = [(i["t"], i["id"]) for _, r in own for i in r["items"]]
        assert items == sorted((s, i) for k, s, i in data if k == key)
    assert {r["k"] for r in records} == {"hot", "none", "empty", "k1", "k2", "k3"}
    back = nesting.explode_records(packed, "items", ["k"], "pos")
    known = {"hot", "none", "k1", "k2", "k3"}
    assert sorted((r["k"], r["t"], r["id"]) for r in back.collect()) == sorted(
        d for d in data if d[0] in known
    )
    assert nesting.unpack_parents(packed, "head", ["k"]).count() == 6
