"""Joins on time: readings to intervals, latest reading to a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackside.functions import skew
from trackside.functions.timing import epoch_micros
from trackside.sources.tables import written

BIN_STEP = 4096
SPANS_PER_BIN = 256


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    ts: str,
    start: str,
    end: str,
    bin_seconds: float | None = None,
) -> DataFrame:
    """Pair each point with every span of the same keys that holds it.

    A span is half-open: ``start <= ts < end``. Spans are listed under the time
    bins they touch and points under the one bin they fall in, so the join is an
    equi-join on (keys, bin) that compares a point only with spans near it, and
    a key with most of the rows is spread over its bins. Should most points fall
    into one bin, adaptive execution splits it: no step follows the join that
    needs its partitioning.

    Bins are as wide as the mean span is long (or `bin_seconds`). Longer spans
    go under bins 4096, 4096^2, ... times as wide, so that none is listed more
    than 65 times; shorter ones too go under narrower bins if one bin would hold
    more than 256 spans. Points are copied once per width in use, mostly one.

    The keys may not be empty; other columns of the two sides need distinct
    names. `spans` is read three times, so it should be a stored table. Batch
    only.
    """
    if not keys:
        raise ValueError("interval_join needs at least one equality key")
    spans = spans.where(F.col(start) < F.col(end))
    length = epoch_micros(end) - epoch_micros(start)
    if bin_seconds is None:
        usual = int(spans.agg(F.avg(length)).first()[0] or 1)
    else:
        usual = max(1, int(bin_seconds * 1_000_000))
    on = [*keys, "_width", "_bin"]

    def listed(widths: Sequence[int]) -> tuple[DataFrame, dict[int, int]]:
        out = spans.withColumn("_width", _width_of(length, widths)).withColumn(
            "_bin",
            F.explode(F.sequence(_bin(start, 0), _bin(end, 1), F.col("_width"))),
        )
        held = out.groupBy(*on).count().groupBy("_width").agg(F.max("count"))
        return out, dict(held.collect())

    wider = [usual * BIN_STEP**n for n in range(6) if usual * BIN_STEP**n < 2**56]
    by_bin, fullest = listed(wider or [usual])
    if fullest.get(usual, 0) > SPANS_PER_BIN:
        narrower = [usual // BIN_STEP**n for n in range(1, 6)]
        by_bin, fullest = listed([w for w in reversed(narrower) if w] + wider)

    widths = [F.lit(w).cast("bigint") for w in sorted(fullest)] or [F.lit(usual)]
    width = widths[0] if len(widths) == 1 else F.explode(F.array(*widths))
    binned = points.withColumn("_width", width).withColumn("_bin", _bin(ts, 0))
    joined = binned.join(by_bin, on)
    held = joined.where((F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end)))
    return held.select(*points.columns, *(c for c in spans.columns if c not in keys))


def _width_of(length: Column, widths: Sequence[int]) -> Column:
    """The least of the rising `widths` under which a span is listed at most 65
    times."""
    out = F.lit(widths[-1])
    for w in reversed(widths[:-1]):
        out = F.when(length <= w * 64, F.lit(w)).otherwise(out)
    return out.cast("bigint")


def _bin(ts: str, before: int) -> Column:
    """Start of the `_width` bin that holds the time `before` µs ahead of `ts`."""
    micros = epoch_micros(ts) - before
    return micros - F.pmod(micros, "_width")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    seq: str | None = None,
    until: str | None = None,
    name: str = "match",
    hot_rows: int | None = skew.HOT_ROWS,
) -> DataFrame:
    """Add to each left row the struct `name` with one right row of its keys.

    That is the latest right row with ``right_ts <= left_ts``; of several at
    one time the one with the greatest `seq`. With `until`, a left column, the
    earliest right row in ``[left_ts, until)`` goes first (of several at one
    time the least `seq`) and the latest before is the fallback. Left rows
    without any are kept with NULL; a NULL key matches nothing. The right row
    travels as one struct, so a NULL field in it is not filled from an older row.

    Both sides are shuffled once, sorted and scanned; nothing is paired up. Keys
    with more than `hot_rows` rows are scanned in blocks. Batch only.
    """
    return _AsOf(left, right, list(keys), left_ts, right_ts, seq, until).run(
        name, hot_rows
    )


class _AsOf:
    def __init__(self, left, right, keys, left_ts, right_ts, seq, until):
        self.left, self.keys, self.until = left, keys, until
        self.left_ts, self.right_ts = left_ts, right_ts
        self.fields = right.columns
        right = right.dropna(subset=[*keys, right_ts])
        row = F.struct(*right.columns)
        rank = F.col(seq) if seq else F.xxhash64(*right.columns)
        at = right.select(
            *keys, F.col(right_ts).alias("_t"), rank.alias("_seq"), row.alias("_row")
        )
        if until is None:
            self.right = at.withColumn("_found", F.struct(F.col("_row").alias("last")))
        else:
            # one row per time, so that both directions have a fixed first and last
            self.right = (
                at.groupBy(*keys, "_t")
                .agg(
                    F.struct(
                        F.max_by("_row", "_seq").alias("last"),
                        F.min_by("_row", "_seq").alias("first"),
                    ).alias("_found")
                )
                .withColumn("_seq", F.lit(0))
            )

    def run(self, name: str, hot_rows: int | None) -> DataFrame:
        found = self.right.schema["_found"].dataType
        seq = self.right.schema["_seq"].dataType
        left = self.left.select(
            *self.keys,
            F.col(self.left_ts).alias("_t"),
            F.lit(1).alias("_side"),
            F.lit(None).cast(seq).alias("_seq"),
            F.struct(*self.left.columns).alias("_left"),
            F.lit(None).cast(found).alias("_found"),
        )
        right = self.right.select(
            *self.keys,
            "_t",
            F.lit(0).alias("_side"),
            "_seq",
            F.lit(None).cast(left.schema["_left"].dataType).alias("_left"),
            "_found",
        )
        both = left.unionByName(right)
        # left rows at one time may go to any block: spread them by content
        spread = F.when(F.col("_side") == 1, F.xxhash64("_left")).otherwise(0)
        order = [F.col("_t"), F.col("_side"), F.col("_seq"), spread]
        blocks = skew.ordered_blocks(both, self.keys, order, hot_rows)

        back = self._scan(blocks, ascending=True)
        scanned = blocks.df.withColumn("_back", back)
        if self.until is not None:
            ahead = self._scan(blocks, ascending=False)
            scanned = scanned.withColumn("_ahead", ahead)
        rows = scanned.where(F.col("_side") == 1)
        if blocks.table is not None:
            rows = self._carry(blocks, rows)
        return rows.select("_left.*", self._choose().alias(name))

    def _scan(self, blocks: skew.Blocks, ascending: bool) -> Column:
        """Nearest right row before (or after) each row, within its block."""
        by = [F.col(c) for c in ("_t", "_side", "_seq")]
        order = by if ascending else [c.desc() for c in by]
        window = (
            Window.partitionBy(*blocks.group)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return F.last("_found", ignorenulls=True).over(window)

    def _carry(self, blocks: skew.Blocks, rows: DataFrame) -> DataFrame:
        """Fill rows with no right row in their own block from the next one."""
        at = F.struct("_t", "_seq")
        ends = (
            blocks.df.where(F.col(skew.HOT) & (F.col("_side") == 0))
            .groupBy(*blocks.group)
            .agg(
                F.max_by("_found", at).alias("_last"),
                F.min_by("_found", at).alias("_first"),
            )
        )
        in_order = Window.partitionBy(*self.keys).orderBy(skew.BLOCK)
        reverse = Window.partitionBy(*self.keys).orderBy(F.desc(skew.BLOCK))
        earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
        later = reverse.rowsBetween(Window.unboundedPreceding, -1)
        joined = blocks.table.alias("t").join(
            ends.alias("e"), skew.same_key("t", "e", blocks.group), "left"
        )
        carried = joined.select(
            *(f"t.{c}" for c in blocks.group), "_last", "_first"
        ).select(
            *blocks.group,
            F.last("_last", ignorenulls=True).over(earlier).alias("_before"),
            F.last("_first", ignorenulls=True).over(later).alias("_after"),
        )
        # one row per block of a hot key, but as wide as the right side's rows: once
        # it is written, Spark broadcasts it if its bytes allow
        filled = rows.alias("r").join(
            written(carried, "carried").alias("c"),
            skew.same_key("r", "c", blocks.group),
            "left",
        )
        out = filled.select(
            "r.*", F.col("c._before").alias("_before"), F.col("c._after").alias("_after")
        )
        out = out.withColumn("_back", F.coalesce("_back", "_before"))
        if self.until is not None:
            out = out.withColumn("_ahead", F.coalesce("_ahead", "_after"))
        return out

    def _choose(self) -> Column:
        latest = F.col("_back.last")
        if self.until is None:
            return latest
        time = lambda found, end: F.col(f"{found}.{end}").getField(self.right_ts)
        now = F.col(f"_left.{self.left_ts}")
        return (
            F.when(time("_back", "last") == now, F.col("_back.first"))
            .when(
                time("_ahead", "first") < F.col(f"_left.{self.until}"),
                F.col("_ahead.first"),
            )
            .otherwise(latest)
        )
