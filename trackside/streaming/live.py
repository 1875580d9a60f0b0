"""The producer's lookups on live streams: points to laps, latest reading to a row, a
lap's points in one record. State ends as the watermarks of the inputs go on."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping, Sequence
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor

from trackside.functions.timing import TEXT_FORMAT

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def live_interval_join(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: str,
    end: str,
    longest: str,
) -> DataFrame:
    """`interval_join` of two streams, for append mode: each point with every span of the
    same keys that holds it (``start <= ts < end``).

    Both sides have a watermark, over `ts` and over `start`. No span may be longer than
    the interval `longest`: a row is given up when the other side's watermark says that
    nothing can meet it any more, a span `longest` after its start and a point when all
    spans that start before it are there. A longer span misses points after that.
    """
    renamed = spans.select(*(F.col(c).alias(f"_{c}" if c in keys else c) for c in spans.columns))
    near = (F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(start) + F.expr(f"INTERVAL {longest}"))
    on = near & (F.col(ts) < F.col(end))
    for key in keys:
        on = on & (F.col(key) == F.col(f"_{key}"))
    return points.join(renamed, on).drop(*(f"_{k}" for k in keys))


# -- the latest reading ------------------------------------------------------

_MICROS = {"timestampFormat": f"{TEXT_FORMAT}.SSSSSS", "timestampNTZFormat": f"{TEXT_FORMAT}.SSSSSS"}
_STATE = "at bigint, seq bigint, who string, body string"


class _Latest(StatefulProcessor):
    """Left rows wait until the watermark has passed them; then all samples up to them
    are there. Of the samples those after the watermark stay, and of each key the one
    before. All keys of a bucket share their state, as a call costs far more than a row."""

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _STATE)
        self.samples = handle.getListState("samples", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        left, right = [], []
        for row in rows:
            (left if row["_left"] else right).append((row["_at"], row["_seq"], row["_who"], row["_body"]))
        if right:
            self.samples.appendList(right)
        if left:
            self.waiting.appendList(left)
            self._wake(min(left)[0])
        return iter(())

    def _wake(self, at: int) -> None:
        # timers go by milliseconds; a sample of the same time must have come
        self.handle.registerTimer(at // 1000 + 2)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get()) if self.waiting.exists() else []
        ready = [w for w in waiting if w[0] + 1000 < mark]
        if not ready:
            return iter(())
        samples: dict[str, list[tuple]] = {}
        for sample in sorted(self.samples.get()) if self.samples.exists() else []:
            samples.setdefault(sample[2], []).append(sample)
        out = []
        for at, _, who, body in ready:
            of = samples.get(who, ())
            k = bisect_right(of, at, key=itemgetter(0))
            out.append(Row(**{BUCKET: key[0]}, _body=body, _match=of[k - 1][3] if k else None))
        rest = waiting[len(ready) :]
        if rest:
            self.waiting.put(rest)
            self._wake(rest[0][0])
        else:
            self.waiting.clear()
        if samples:
            before = {who: bisect_left(of, mark - 1000, key=itemgetter(0)) for who, of in samples.items()}
            self.samples.put([s for who, of in samples.items() for s in of[max(before[who] - 1, 0) :]])
        return iter(out)

    def close(self) -> None:
        pass


BUCKET = "_bucket"


def live_asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    seq: str | None = None,
    name: str = "match",
    delay: str = "0 seconds",
    buckets: int = 256,
) -> DataFrame:
    """`asof_join` of two streams, for append mode: each left row with the latest right
    row of its keys that is not after it, as the struct `name`; of several at one time
    the one with the greatest `seq` (an integer).

    A left row comes out once the watermark, `delay` behind the stream that is less far
    on, has passed it; left rows without a match come out with NULL, those
    without a time or with a NULL key at once. Rows that come later than the watermark
    are dropped, as everywhere. State holds the rows since the watermark and one sample per
    key before it. Keys are dealt to `buckets` by a hash; a task handles a bucket at a time,
    all of whose rows it holds. Needs the RocksDB state store (`STATE_STORE`, `ROCKSDB`).
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    who = F.to_json(F.struct(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))), _MICROS).alias("_who")

    def side(df: DataFrame, ts: str, order: Column, is_left: bool) -> DataFrame:
        at = F.col(ts).cast("timestamp")
        whole = F.lit(True)
        for key in keys:
            whole = whole & F.col(key).isNotNull()
        marked = df.select(
            bucket,
            who,
            at.alias("_time"),
            F.unix_micros(at).alias("_at"),
            order.cast("bigint").alias("_seq"),
            F.to_json(F.struct(*df.columns), _MICROS).alias("_body"),
            F.lit(is_left).alias("_left"),
            whole.alias("_whole"),
        ).withWatermark("_time", delay)
        # one condition with the time in it, which is not moved ahead of the watermark:
        # rows without a key, such as closing messages, are to move it on
        kept = F.when(F.col("_time").isNotNull(), F.col("_whole")).otherwise(False)
        return marked.where(kept).drop("_whole")

    sound = F.lit(True)
    for c in (*keys, left_ts):
        sound = sound & F.col(c).isNotNull()
    rank = F.col(seq) if seq else F.xxhash64(*right.columns)
    both = side(left, left_ts, F.lit(0), True).unionByName(side(right, right_ts, rank, False))
    out = both.groupBy(BUCKET).transformWithState(
        _Latest(), f"{BUCKET} int, _body string, _match string", "Append", "EventTime"
    )
    match = F.from_json("_match", right.schema, _MICROS).alias(name)
    found = out.select(F.from_json("_body", left.schema, _MICROS).alias("_l"), match).select("_l.*", name)
    none = F.lit(None).cast(right.schema).alias(name)
    return found.unionByName(left.where(~sound).select("*", none))


# -- a lap in one record -----------------------------------------------------


def live_nest(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap: str,
    order: Sequence[str],
    items: str,
    item_fields: Sequence[str],
    parent: str,
    parent_fields: Sequence[str],
    is_parent: Column,
    max_items: int = 5_000,
) -> DataFrame:
    """`nest_records` on a stream, for append mode: one record per key and part, with the
    struct `parent` and the array `items` in `order`.

    `rows` holds parents (`is_parent`) and children alike, with a watermark over `ts`.
    A key's rows make a session, which closes when none has come for `gap`; then its
    records come out. A session without a parent gives none; further children follow in
    parts of `max_items`, each with the parent. A session is in one task's
    memory, so it is for laps, not for a whole race.
    """
    child = F.struct(F.struct(*order).alias("at"), F.struct(*item_fields).alias("item"))
    sessions = rows.groupBy(*keys, F.session_window(ts, gap)).agg(
        F.max(F.when(is_parent, F.struct(*parent_fields))).alias(parent),
        F.sort_array(F.collect_list(F.when(~is_parent, child))).alias("_items"),
    )
    n = F.greatest(F.ceil(F.size("_items") / max_items), F.lit(1)).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda p: F.struct(
            p.cast("bigint").alias("part"),
            F.transform(
                F.slice("_items", p * max_items + 1, F.lit(max_items)), lambda i: i["item"]
            ).alias(items),
        ),
    )
    return sessions.where(F.col(parent).isNotNull()).select(*keys, parent, F.inline(parts))


def observed(df: DataFrame, name: str, measures: Mapping[str, Column]) -> DataFrame:
    """`df` with aggregates of each batch in the progress under `name`."""
    return df.observe(name, *(c.alias(n) for n, c in measures.items()))
