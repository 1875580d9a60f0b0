"""Message files in order, tables that batches commit to, and lookups on live streams."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row, functions as F, types as T

from trackside import schemas
from trackside.functions.measures import avg_of, count_of, max_of, min_of
from trackside.functions.parsing import json_parse, rejects_by_reason
from trackside.functions.timing import with_event_time
from trackside.operators import joins, nesting
from trackside.operators.rows import closing_gate, row_index
from trackside.operators.summary import live_pane_summary, row_window_summary
from trackside.plans import racing, stand_ins
from trackside.sources import ordered
from trackside.sources.bucketed import keeps_order, write_bucketed
from trackside.streaming import live, metrics, run, store
from trackside.streaming.commits import BATCH, CommitLog, CurrentTable, MergedRuns, Versions

START = 1_700_000_000


def stamped(spark, n, topic="lap", keys=7):
    """`n` messages, one a second."""
    return spark.range(n).select(
        F.lit(topic).alias("topic"),
        (F.col("id") % keys).cast("string").alias("key"),
        F.timestamp_seconds(F.lit(START) + F.col("id")).alias("sent_at"),
        F.format_string('{"id":%d}', F.col("id")).alias("value"),
    )


class Batches:
    """A sink that notes the ids of each batch."""

    def __init__(self, fail_at=None):
        self.seen, self.fail_at = {}, fail_at

    def __call__(self, batch, batch_id):
        rows = json_parse(batch, "id bigint", keep=["partition", "offset"]).collect()
        if batch_id == self.fail_at:
            self.fail_at = None
            raise RuntimeError("lost")
        self.seen[batch_id] = sorted(r["id"] for r in rows if r["id"] is not None)

    @property
    def rows(self):
        return [x for k in sorted(self.seen) for x in self.seen[k]]


# -- message files -----------------------------------------------------------


def test_slices_come_in_order(spark, tmp_path):
    base = str(tmp_path)
    ordered.send(stamped(spark, 3000).orderBy(F.rand(3)), base, partitions=3, slices=6)
    ordered.send(stamped(spark, 10), base, partitions=3, slices=1)  # older times, but sent later
    ordered.end(spark, base, {"lap": 3})
    sink = Batches()
    run.run_through(ordered.source(spark, "lap", base), sink, "append", f"{base}/checkpoint")
    assert len(sink.seen) == 8 and sink.seen[7] == []
    assert sink.rows == [*range(3000), *range(10)]
    back = ordered.source(spark, "lap", base, stream=False)
    places = back.groupBy("partition").agg(F.min("offset"), F.max("offset"), F.count("*"), F.countDistinct("offset"))
    assert all(r[1] == 0 and r[2] == r[3] - 1 == r[4] - 1 for r in places.collect())
    # a key stays in its partition, in order
    assert back.where("key is not null").groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").isEmpty()
    log = ordered.sent_log(spark, base)
    assert log.agg(F.sum("n")).first()[0] == 3013
    assert log.where("first_at > last_at").isEmpty()


def test_restart_goes_on_where_it_was(spark, tmp_path):
    base = str(tmp_path)
    ordered.send(stamped(spark, 400), base, slices=4)
    sink = Batches(fail_at=2)
    source = ordered.source(spark, "lap", base)
    with pytest.raises(StreamingQueryException):
        run.run_through(source, sink, "append", f"{base}/checkpoint")
    assert sorted(sink.seen) == [0, 1]
    ordered.send(stamped(spark, 400).where(F.col("sent_at") > "2023-11-14 22:15:00"), base, slices=2)
    run.run_through(source, sink, "append", f"{base}/checkpoint")
    assert sorted(sink.seen) == [0, 1, 2, 3, 4, 5]
    assert sink.rows == [*range(400), *range(101, 400)]
    run.run_through(source, sink, "append", f"{base}/checkpoint")
    assert len(sink.seen) == 6


def test_nothing_sent_and_no_keys(spark, tmp_path):
    base = str(tmp_path)
    assert ordered.source(spark, "lap", base, stream=False).count() == 0
    ordered.send(stamped(spark, 0), base)
    ordered.send(stamped(spark, 20).drop("key"), base, partitions={"lap": 2}, slices=2)
    got = ordered.source(spark, "lap", base, stream=False)
    assert got.count() == 20 and ordered.source(spark, "car", base, stream=False).count() == 0


def test_messages_without_a_key_fill_all_partitions(spark, tmp_path):
    base = str(tmp_path)
    ordered.send(stamped(spark, 2000).drop("key"), base, partitions=4, slices=2)
    files = ordered.sent_log(spark, base).collect()
    assert sorted((f.slice, f.partition) for f in files) == [(s, p) for s in range(2) for p in range(4)]
    assert min(f.n for f in files) > 100


def test_large_messages_are_read_a_few_at_a_time(tmp_path):
    """However many there are in a file; offsets run on."""
    path, n = f"{tmp_path}/sent.parquet", 600
    at = pa.array([1_000_000 * i for i in range(n)], pa.timestamp("us", "UTC"))
    value = [f"{i:06d}" * 10_000 for i in range(n)]
    table = pa.table({"key": pa.nulls(n, pa.string()), "sent_at": at, "value": value})
    pq.write_table(table, path, use_dictionary=False, compression="none")
    got = list(ordered._messages(ordered.SentFile("lap", 0, 1, 5, path)))
    assert max(b.nbytes for b in got) < 8 << 20
    read = pa.Table.from_batches(got)
    assert read.column("value").to_pylist() == value
    assert read.column("offset").to_pylist() == list(range(5, 5 + n))


def test_state_has_no_more_parts_than_tasks_run(spark, tmp_path):
    """However many partitions the session's shuffles have; and their number is as before."""
    base = str(tmp_path)
    ordered.send(stamped(spark, 200), base, slices=2)
    sent = ordered.source(spark, "lap", base)
    with run.setting(spark, run.PARTITIONS, "50"):
        query = run.run_through(sent.groupBy("key").count(), run.versions_writer(f"{base}/out"), "update", f"{base}/checkpoint")
        assert spark.conf.get(run.PARTITIONS) == "50"
    parts = {s.numShufflePartitions for p in query.recentProgress for s in p.stateOperators}
    assert parts == {spark.sparkContext.defaultParallelism}


def test_no_window_is_lost(spark, tmp_path):
    """200,000 laps, many writers, one slice to a batch, no delay."""
    base = str(tmp_path)
    sent = stamped(spark, 200_000)
    ordered.send(sent, base, partitions=3, slices=8)
    ordered.end(spark, base, {"lap": 3})
    timed = with_event_time(ordered.source(spark, "lap", base), "sent_at")
    kept = closing_gate(json_parse(timed, "id bigint", keep=["sent_at"]), "sent_at", "id")
    windows = row_window_summary(kept, [], "sent_at", "65 seconds", [count_of("id", "n")])
    query = run.run_through(windows, run.versions_writer(f"{base}/out"), "append", f"{base}/checkpoint")
    got = run.read_versions(spark, f"{base}/out", windows.schema).drop("batch_id")
    want = row_window_summary(json_parse(sent, "id bigint", keep=["sent_at"]), [], "sent_at", "65 seconds", [count_of("id", "n")])
    assert got.count() == 3078 and got.exceptAll(want).isEmpty()
    assert sum(m["late_rows"] for m in run.stream_metrics(query)) == 0


# -- panes -------------------------------------------------------------------


def test_panes_equal_windows_with_less_state(spark, tmp_path):
    base = str(tmp_path)
    sent = spark.range(600).select(
        F.lit("lap").alias("topic"),
        F.timestamp_micros((F.lit(START * 1000) + F.col("id") * 37_370) * 1000).alias("sent_at"),
        F.format_string('{"id":%d,"who":%s}', F.col("id"), F.when(F.col("id") % 3 > 0, (F.col("id") % 3).cast("string")).otherwise("null")).alias("value"),
    )
    ordered.send(sent, base, slices=3)
    ordered.end(spark, base, {"lap": 1})
    ddl, measures = "id int, who int", [avg_of("id", scale=0), min_of("id"), max_of("id"), count_of("id", "n")]
    timed = with_event_time(ordered.source(spark, "lap", base), "sent_at")
    kept = closing_gate(json_parse(timed, ddl, keep=["sent_at"]), "sent_at", "id")
    state = {}
    for name, frame in {
        "panes": live_pane_summary(kept, ["who"], "sent_at", "65 seconds", measures, "10 seconds"),
        "windows": row_window_summary(kept, ["who"], "sent_at", "65 seconds", measures, "10 seconds"),
    }.items():
        query = run.run_through(frame, run.versions_writer(f"{base}/{name}"), "append", f"{base}/{name}-checkpoint")
        told = [p.stateOperators for p in query.recentProgress]
        # how often rows of its state were updated by the aggregation that the input enters
        state[name] = min(sum(s[k].numRowsUpdated for s in told) for k in range(len(told[0])))
        out = run.read_versions(spark, f"{base}/{name}", frame.schema).drop("batch_id")
        want = row_window_summary(json_parse(sent, ddl, keep=["sent_at"]), ["who"], "sent_at", "65 seconds", measures, "10 seconds")
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert state["panes"] == 600 and state["windows"] >= 3900


def test_pane_lengths(spark):
    for size, slide in (("1 week", "10 seconds"), ("10 seconds", "20 seconds")):
        with pytest.raises(ValueError):
            live_pane_summary(spark.range(1), [], "id", size, [], slide)


# -- tables that batches commit to -------------------------------------------

CAR = "LapNumber int, Speed float, Throttle float, RPM int, Gear int"


def car(spark, rows):
    return spark.createDataFrame(rows, CAR)


def test_merged_car_summary(spark, tmp_path):
    """Ten batches, the fourth and the last of them twice, a new process half-way."""
    rows = [(i % 5 or None, i / 4, float(i % 7), i, (i * i) % 6) for i in range(400)]
    rows += [(1, None, None, None, None), (9, None, 1.0, None, None)]
    parts = [rows[i::10] for i in range(10)]
    merged = racing.merged_car_summary(str(tmp_path), fan=3)
    for i, part in enumerate(parts):
        if i == 5:
            merged = racing.merged_car_summary(str(tmp_path), fan=3)
        merged.write(car(spark, part), i)
        if i in (3, 9):
            merged.write(car(spark, part), i)
    got = racing.finished_car_summary(spark, racing.merged_car_summary(str(tmp_path)))
    want = racing.car_summary(car(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_files_and_rows_are_bounded_by_keys(spark, tmp_path):
    versions = Versions(str(tmp_path), ["k"], fan=3, buckets=2)
    for i in range(14):
        rows = [(k, i * 10 + k) for k in range(6) if k % 3 == i % 3 or k == 0]
        versions.write(spark.createDataFrame(rows, "k int, v int"), i)
    runs = versions.store.runs(spark)
    assert len(runs) <= 6 and max(r.level for r in runs) >= 1
    folders = list((tmp_path / "data").iterdir())
    assert len(folders) <= 2 * len(runs) + 3  # those of the entry before may be there
    assert len(list((tmp_path / "log").glob("batch_id=*"))) == 2
    got = versions.latest(spark, T.StructType.fromDDL("k int, v int"))
    last = {k: max(i * 10 + k for i in range(14) if k % 3 == i % 3 or k == 0) for k in range(6)}
    assert dict(map(tuple, got.collect())) == last


def test_versions_are_merged_without_a_sort(spark, tmp_path, capsys):
    versions = Versions(str(tmp_path), ["k"])
    rows = [(1, 0, 1.0, "a"), (1, 1, None, "b"), (2, 0, 2.0, None), (2, 3, 3.0, "d"), (None, 2, 4.0, "e")]
    df = spark.createDataFrame(rows, f"k int, {BATCH} bigint, x double, s string")
    latest = versions._latest(df)
    found = {r["k"]: (r["x"], r["s"], r[BATCH]) for r in latest.collect()}
    # the last row of a key as a whole, NULLs too
    assert found == {1: (None, "b", 1), 2: (3.0, "d", 3), None: (4.0, "e", 2)}
    versions._latest(df.drop("s")).explain()
    assert "SortAggregate" not in capsys.readouterr().out


def test_a_replayed_slice_is_read_by_all_tasks(spark):
    messages = stamped(spark, 2000, topic="many").drop("key")
    path, _ = stand_ins._replayed(
        messages, "many", lambda sent: sent.select("value"), "append", run.versions_writer, close=True
    )
    files = ordered.sent_log(spark, path.removesuffix("out") + "topics").groupBy("slice").count().collect()
    assert {f["count"] for f in files} == {max(4, spark.sparkContext.defaultParallelism)}


def test_replayed_messages_are_made_once_and_by_several_tasks(spark, tmp_path):
    stamped(spark, 500).coalesce(1).write.parquet(f"{tmp_path}/sent.parquet")
    with run.setting(spark, "spark.sql.adaptive.enabled", "false"):
        dealt = stand_ins._dealt(spark, str(tmp_path), "sent")
        assert dealt.select(F.spark_partition_id()).distinct().count() > 1

    def noted(value):
        with open(f"{tmp_path}/made", "a") as file:
            file.write("x")
        return value

    messages = dealt.withColumn("value", F.udf(noted)("value"))
    stand_ins._replayed(messages, "t", lambda sent: sent.select("value"), "append", run.versions_writer)
    assert (tmp_path / "made").stat().st_size == messages.count()


def test_rerun_forgets_later_batches_of_a_lost_run(spark, tmp_path):
    versions = Versions(str(tmp_path), ["k"])
    schema = T.StructType.fromDDL("k int, v int")
    assert versions.latest(spark, schema).collect() == []
    for i, v in ((0, 1), (1, 2), (1, 3)):
        versions.write(spark.createDataFrame([(7, v)], "k int, v int"), i)
    versions.write(spark.createDataFrame([], "k int, v int"), 1)
    assert [tuple(r) for r in versions.latest(spark, schema).collect()] == [(7, 1)]


def test_a_failed_merge_leaves_the_runs(spark, tmp_path):
    calls = []

    def merge(runs):
        calls.append(1)
        return runs.groupBy("k").agg(F.sum("n").alias("n"))

    def store_of():
        return MergedRuns(str(tmp_path), ["k"], lambda b: b, merge, fan=2)

    for i in range(4):
        # a new process for each batch: its merge is never taken up
        store_of().write(spark.createDataFrame([(1, 1)], "k int, n bigint"), i)
    assert len(store_of().runs(spark)) == 4
    got = store_of().read(spark, T.StructType.fromDDL("k int, n bigint"))
    assert [tuple(r) for r in got.collect()] == [(1, 4)]


def test_current_table_is_never_half_written(spark, tmp_path):
    table = CurrentTable(str(tmp_path))
    schema = T.StructType.fromDDL("k int")
    assert table.read(spark, schema).collect() == []
    table.write(spark.createDataFrame([(1,), (2,)], "k int"), 0)
    before = table.read(spark, schema)
    broken = spark.createDataFrame([(1,)], "k int").select(F.raise_error(F.lit("lost")).cast("int").alias("k"))
    with pytest.raises(Exception):
        table.write(broken, 1)
    assert table.read(spark, schema).count() == 2
    table.write(spark.createDataFrame([(3,)], "k int"), 1)
    assert [r[0] for r in table.read(spark, schema).collect()] == [3]
    assert before.count() == 2  # a reader that has begun goes on


# -- one commit for three tables ---------------------------------------------


def nested(spark, laps, first_offset=0):
    """Records of `laps`, with two points each and equal contents."""
    lap = "struct<" + ",".join(f"{n}:{t}" for n, t in schemas.fields(schemas.LAP)) + ">"
    weather = "struct<" + ",".join(f"{n}:{t}" for n, t in schemas.fields(schemas.WEATHER)) + ">"
    point = "struct<" + ",".join(f"{n}:{t}" for n, t in schemas.fields(schemas.CAR)) + ">"
    rows = spark.createDataFrame([(0, first_offset + i, n) for i, n in enumerate(laps)], "partition int, offset bigint, n int")
    return rows.select(
        "partition",
        "offset",
        F.lit(0).alias("part"),
        F.from_json(F.format_string('{"LapNumber":%d,"LapTime":1.5}', "n"), lap).alias("lap"),
        F.from_json(F.format_string('{"LapNumber":%d,"AirTemp":20}', "n"), weather).alias("weather"),
        F.from_json(F.format_string('[{"LapNumber":%d,"Speed":1},{"LapNumber":%d,"Speed":2}]', "n", "n"), f"array<{point}>").alias("car"),
    )


def sizes(spark, stored):
    return tuple(stored.read(spark, t).count() for t in ("lap", "weather", "car"))


def test_three_tables_commit_as_one(spark, tmp_path, monkeypatch):
    stored = store.CommittedTables(str(tmp_path))
    assert sizes(spark, stored) == (0, 0, 0)
    stored.write(nested(spark, [1, 2]), 0)
    assert sizes(spark, stored) == (2, 2, 4)

    done, append = [], store.CommittedTables.append

    def failing(self, rows, path):
        if len(done) == 2:
            raise OSError("lost after the second table")
        done.append(path)
        append(self, rows, path)

    monkeypatch.setattr(store.CommittedTables, "append", failing)
    with pytest.raises(OSError):
        stored.write(nested(spark, [3], 2), 1)
    assert sizes(spark, stored) == (2, 2, 4)  # nothing of the batch, in no table
    monkeypatch.undo()
    stored.write(nested(spark, [3], 2), 1)
    assert sizes(spark, stored) == (3, 3, 6)
    stored.write(nested(spark, [3], 2), 1)
    assert sizes(spark, stored) == (3, 3, 6)  # run again, there once


def test_equal_messages_keep_apart(spark, tmp_path):
    """The same lap sent twice: two laps with a weather row each, not four pairs."""
    stored = store.CommittedTables(str(tmp_path))
    stored.write(nested(spark, [5, 5]), 0)
    lap, weather = (stored.read(spark, t) for t in ("lap", "weather"))
    assert lap.join(weather, stored.ids).count() == 2


def test_log_keeps_two_entries(spark, tmp_path):
    log = CommitLog(str(tmp_path))
    assert log.state(spark) == []
    stored = store.CommittedTables(str(tmp_path))
    for i in range(4):
        stored.write(nested(spark, [i], i), i)
    assert len(list((tmp_path / "log").glob("batch_id=*"))) == 2
    assert sizes(spark, stored) == (4, 4, 8)
    assert [f.first_batch for f in log.state(spark, before=3) if f.name == "lap"] == [0, 1, 2]


# -- lookups on streams ------------------------------------------------------


def at(seconds):
    return dt.datetime.fromtimestamp(START + seconds, dt.timezone.utc).replace(tzinfo=None)


def send(spark, base, topic, rows, ddl, slices):
    df = spark.createDataFrame(rows, ddl)
    body = [c for c in df.columns if c != "sent_at"]
    messages = df.select(F.lit(topic).alias("topic"), "sent_at", F.to_json(F.struct(*body)).alias("value"))
    ordered.send(messages, base, slices=slices)
    return df


def read(spark, base, topic, ddl):
    return json_parse(ordered.source(spark, topic, base), ddl, keep=["sent_at"])


def test_live_interval_join(spark, tmp_path):
    base = str(tmp_path)
    points = send(spark, base, "p", [(at(i), i % 3 or None, i) for i in range(400)], "sent_at timestamp, k int, p int", 5)
    spans = [(at(s), s % 3 or None, s, s + 1 + s % 40) for s in range(0, 400, 4)]
    spans = send(spark, base, "s", spans, "sent_at timestamp, k int, s int, until int", 5)
    ordered.end(spark, base, {"p": 1, "s": 1})
    end = (F.lit(START) + F.col("until")).cast("timestamp").alias("end")
    left = with_event_time(read(spark, base, "p", "k int, p int"), "sent_at")
    right = with_event_time(read(spark, base, "s", "k int, s int, until int"), "sent_at")
    right = right.select("k", "s", F.col("sent_at").alias("start"), end)
    joined = live.live_interval_join(left, right, ["k"], "sent_at", "start", "end", "41 seconds")
    query = run.run_through(joined, run.versions_writer(f"{base}/out"), "append", f"{base}/checkpoint")
    got = run.read_versions(spark, f"{base}/out", joined.schema)
    stored = spans.select("k", "s", F.col("sent_at").alias("start"), end)
    want = joins.interval_join(points, stored, ["k"], "sent_at", "start", "end")
    pairs = lambda df: sorted(map(tuple, df.select("p", "s").collect()))
    assert pairs(got) == pairs(want) and len(pairs(got)) > 100
    held = [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress]
    assert held[-1] < max(held) / 4  # what nothing can meet any more is gone


def asof(spark, base, delay="0 seconds"):
    left = read(spark, base, "l", "k int, l int")
    right = read(spark, base, "r", "k int, r int, v double")
    found = live.live_asof_join(left, right, ["k"], "sent_at", "sent_at", seq="r", delay=delay)
    with run.setting(spark, live.STATE_STORE, live.ROCKSDB):
        run.run_through(found, run.versions_writer(f"{base}/out"), "append", f"{base}/checkpoint")
    out = run.read_versions(spark, f"{base}/out", found.schema).where("l is not null")
    return sorted(map(tuple, out.select("l", "match.r", "match.v").collect()), key=repr)


def test_live_asof_join(spark, tmp_path):
    base = str(tmp_path)
    left = [(at(2 * i + 1), (i * 7 % 4) or None, i) for i in range(150)] + [(at(30), 1, 900), (at(31), 77, 901)]
    right = [(at(i), (i * 5 % 4) or None, i, None if i % 9 == 0 else i / 2) for i in range(0, 300, 3)]
    right += [(at(30), 1, 1000, -1.0), (at(30), 1, 999, -2.0)]
    left = send(spark, base, "l", left, "sent_at timestamp, k int, l int", 4)
    right = send(spark, base, "r", right, "sent_at timestamp, k int, r int, v double", 4)
    ordered.end(spark, base, {"l": 1, "r": 1})
    want = joins.asof_join(left, right.withColumnRenamed("sent_at", "at"), ["k"], "sent_at", "at", seq="r")
    want = sorted(map(tuple, want.select("l", "match.r", "match.v").collect()), key=repr)
    assert asof(spark, base) == want
    by = {r[0]: r[1] for r in want}
    assert by[900] == 1000 and by[901] is None


def test_live_asof_join_calls_state_by_bucket():
    """As few calls for many keys as for one; each key meets its own samples."""
    calls = []

    class Listed:
        def __init__(self):
            self.rows = []

        def __getattr__(self, name):
            calls.append(name)
            return {
                "exists": lambda: bool(self.rows), "get": lambda: iter(self.rows), "clear": lambda: self.rows.clear(),
                "appendList": lambda rows: self.rows.extend(rows), "put": lambda rows: self.__dict__.update(rows=list(rows)),
            }[name]

    class Handle:
        getListState = lambda self, name, schema: Listed()
        registerTimer = lambda self, at: calls.append("timer")

    class Mark:
        getCurrentWatermarkInMs = lambda self: 60

    state = live._Latest()
    state.init(Handle())
    rows = [(f"{k}", at, left) for k in range(500) for at, left in ((1_000 + k, False), (30_000, True), (90_000, True))]
    rows = [Row(_left=left, _at=at, _seq=0, _who=who, _body=f"{who} {at}") for who, at, left in rows]
    assert list(state.handleInputRows((3,), iter(rows), None)) == []
    out = list(state.handleExpiredTimer((3,), Mark(), None))
    assert sorted((r._body, r._match) for r in out) == sorted((f"{k} 30000", f"{k} {1_000 + k}") for k in range(500))
    assert len(calls) < 15


def test_live_asof_join_drops_late_rows(spark, tmp_path):
    """A sample that comes after the watermark has passed it isn't used; a NULL reading
    of the newest sample stays NULL."""
    base = str(tmp_path)
    send(spark, base, "r", [(at(0), 1, 1, 5.0), (at(100), 1, 2, None)], "sent_at timestamp, k int, r int, v double", 2)
    send(spark, base, "l", [(at(1), 1, 1), (at(101), 1, 2), (at(300), 1, 3)], "sent_at timestamp, k int, l int", 3)
    ordered.end(spark, base, {"l": 1, "r": 1})
    for row in ((at(200), 5, 4, 7.0), (at(200), 1, 3, 7.0)):
        send(spark, base, "r", [row], "sent_at timestamp, k int, r int, v double", 1)
    assert asof(spark, base) == [(1, 1, 5.0), (2, 2, None), (3, 2, None)]


def test_live_nesting(spark, tmp_path):
    """Equal to the stored form; 12 points of a lap fill three records."""
    base = str(tmp_path)
    laps = [(at(100 * k), k, 1000 + k, None) for k in range(6)]
    points = [(at(100 * k + 1 + i), k, None, 10 * k + i) for k in (0, 1, 3, 7) for i in range(12 if k == 1 else 3)]
    every = send(spark, base, "x", laps + points, "sent_at timestamp, k int, id int, v int", 3)
    ordered.end(spark, base, {"x": 1})
    timed = with_event_time(read(spark, base, "x", "k int, id int, v int"), "sent_at")
    nested = live.live_nest(
        closing_gate(timed, "sent_at", "k"), ["k"], "sent_at", "60 seconds", ["sent_at", "v"], "items", ["v"],
        "head", ["id"], F.col("id").isNotNull(), 5,
    )
    run.run_through(nested, run.versions_writer(f"{base}/out"), "append", f"{base}/checkpoint")
    got = run.read_versions(spark, f"{base}/out", nested.schema)
    want = nesting.nest_records(
        every.where("id is not null").select("k", "id"), every.where("id is null"), ["k"], ["sent_at", "v"],
        "items", ["v"], {"head": ["id"]}, 5,
    )
    rows = lambda df: sorted((r["k"], r["part"], r["head"]["id"], [i["v"] for i in r["items"]]) for r in df.collect())
    assert rows(got) == rows(want) and len(rows(got)) == 8


# -- progress, buckets, rejects ----------------------------------------------


def test_progress_of_more_than_a_hundred_batches(spark, tmp_path):
    base = str(tmp_path)
    ordered.send(stamped(spark, 1100), base, slices=F.floor((F.unix_seconds("sent_at") - START) / 10).cast("int"))
    source = json_parse(ordered.source(spark, "lap", base), "id bigint")
    watched = live.observed(source, "seen", {"most": F.max("id")})
    with metrics.ProgressTable(spark, f"{base}/progress", every=25) as table:
        query = run.run_through(watched, "noop", "append", f"{base}/checkpoint")
        table.wait(query)
    assert len(query.recentProgress) <= 100
    told = metrics.progress_of(spark, f"{base}/progress").where("input_rows > 0")
    got = {r["batch_id"]: (r["input_rows"], int(r["observed"]["seen.most"])) for r in told.collect()}
    assert got == {i: (10, 10 * i + 9) for i in range(110)}
    assert metrics.progress_of(spark, f"{base}/nothing").collect() == []


def test_bucketed_tables_need_no_shuffle(spark):
    rows = [(i % 5, i % 3, i) for i in range(200)]
    df = spark.createDataFrame(rows, "session int, Driver int, at int")
    try:
        table = write_bucketed(df, "bucketed_points", ["session", "Driver"], ["at"], 4)
        heads = write_bucketed(df.groupBy("session", "Driver").agg(F.min("at").alias("first")), "bucketed_heads", ["session", "Driver"], [], 4)
        keys = ["session", "Driver"]
        numbered = row_index(table, keys, ["at"], hot_rows=None)
        nested = nesting.nest_records(heads, table, keys, ["at"], "items", ["at"], {"head": ["first"]}, hot_rows=None)
        for frame in (numbered, table.groupBy(*keys).agg(F.max("at"))):
            assert keeps_order(frame), frame.explain()
        with run.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
            assert keeps_order(nested), nested.explain()
            assert nested.count() == 15
        assert not keeps_order(row_index(df, keys, ["at"], hot_rows=None))
        want = row_index(df, keys, ["at"], hot_rows=None)
        assert sorted(map(tuple, numbered.collect())) == sorted(map(tuple, want.collect()))
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_points")
        spark.sql("DROP TABLE IF EXISTS bucketed_heads")


def test_rejects_by_reason(spark):
    told = {
        '{"a": 1, "b": 2}': None,
        '{"a": 1, "b": 2, "end": "no"}': None,
        '{"end": "end"}': ("sentinel", None),
        "garbage": ("not JSON", None),
        "": ("not JSON", None),
        None: ("not JSON", None),
        '{"a": 1': ("not JSON", None),
        "[1, 2]": ("not an object", None),
        "7": ("not an object", None),
        '{"a": 1}': ("missing field", "b"),
        '{"a": null, "b": 2}': ("missing field", "a"),
        '{"A": 1, "b": 2}': ("missing field", "a"),
        '{"a": "7", "b": 2}': ("wrong type", "a"),
        '{"a": 3000000000, "b": 2}': ("wrong type", "a"),
        '{"a": 1, "b": {"c": 2}}': ("wrong type", "b"),
        '{"a": "x"}': ("wrong type", "a"),
    }
    df = spark.createDataFrame([(i, v) for i, v in enumerate(told)], "id int, value string")
    got = {r["id"]: (r["reason"], r["field"]) for r in rejects_by_reason(df, "a int, b int", ["a", "b"], keep=["id"]).collect()}
    assert got == {i: v for i, v in enumerate(told.values()) if v}
