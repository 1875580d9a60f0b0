"""Grouped and windowed summaries."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trackside.functions.measures import Measure, mode_of
from trackside.functions.timing import epoch_micros

SECONDS_IN = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def group_summary(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Aggregate per key, batch or stream. Rows with a NULL key form one group.

    On a batch frame a single mode next to mergeable measures is counted in a
    step of its own, as in `mode_by_count`.
    """
    mode = _single_mode(measures)
    if mode and not df.isStreaming:
        return _from_slices(_slices(df, keys, measures, mode), keys, measures, mode)
    return df.groupBy(*keys).agg(*(m.expr() for m in measures))


def mode_by_count(
    df: DataFrame, keys: Sequence[str], column: str, name: str | None = None
) -> DataFrame:
    """Most frequent value per key, the smallest of several. Batch only.

    Counts (key, value) pairs and then picks the largest count, so that no task
    holds all values of a key, as the built-in mode does, and both steps reduce
    the rows before they are shuffled. A group of NULLs only gets NULL.
    """
    return group_summary(df, keys, [mode_of(column, name)])


def _single_mode(measures: Sequence[Measure]) -> Measure | None:
    """The only mode among measures that can otherwise be merged."""
    modes = [m for m in measures if m.fn == "mode"]
    rest = all(m.mergeable for m in measures if m.fn != "mode")
    return modes[0] if len(modes) == 1 and rest else None


def _slices(df: DataFrame, keys: Sequence[str], measures, mode: Measure) -> DataFrame:
    """Rows per key and value of the mode's column: their number `_n`, and what the
    other measures need."""
    return (
        df.withColumn("_value", F.col(mode.column))
        .groupBy(*keys, "_value")
        .agg(
            F.count(mode.column).alias("_n"),
            *(p for m in measures if m is not mode for p in m.partials()),
        )
    )


def _from_slices(slices: DataFrame, keys: Sequence[str], measures, mode: Measure):
    # the least (-n, value) is the highest count with the lowest value
    best = F.when(F.col("_n") > 0, F.struct((-F.col("_n")).alias("n"), "_value"))
    mode_value = F.min(best).getField("_value").alias(mode.name)
    return slices.groupBy(*keys).agg(
        *(mode_value if m is mode else m.merged() for m in measures)
    )


def partial_summary(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """What `finished_summary` needs to know of some rows: per key, and per value where
    a mode is among the measures (its counts), the partial aggregates."""
    mode = _single_mode(measures)
    if mode:
        return _wide(_slices(df, keys, measures, mode), measures)
    return _wide(df.groupBy(*keys).agg(*(p for m in measures for p in m.partials())), measures)


def combined_summary(partials: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Several results of `partial_summary` (a union of them) as one, of the same types."""
    mode = _single_mode(measures)
    parts = [c for m in measures if m is not mode for c in m.combined()]
    if mode:
        return _wide(partials.groupBy(*keys, "_value").agg(F.sum("_n").alias("_n"), *parts), measures)
    return _wide(partials.groupBy(*keys).agg(*parts), measures)


def _wide(partials: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Decimal sums with all digits there are, however often they were added up."""
    sums = {f"{m.name}__sum": m.scale for m in measures if m.scale is not None}
    return partials.withColumns(
        {c: F.col(c).cast(f"decimal(38,{scale})") for c, scale in sums.items() if c in partials.columns}
    )


def finished_summary(partials: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """`group_summary` of all rows, out of `combined_summary`."""
    mode = _single_mode(measures)
    if mode:
        return _from_slices(partials, keys, measures, mode)
    return partials.groupBy(*keys).agg(*(m.merged() for m in measures))


def window_summary(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    measures: Sequence[Measure],
    slide: str | None = None,
) -> DataFrame:
    """Aggregate per key and time window, batch or stream.

    Windows are ``[start, start + size)`` with starts at multiples of `slide`
    (of `size` without one) since 1970-01-01 UTC. Columns: the keys,
    `window_start`, `window_end`, the measures.

    Sliding windows over a batch frame go through panes where the measures and
    the lengths (whole seconds, as in ``"65 seconds"``) allow it.
    """
    merge = all(m.mergeable for m in measures) or _single_mode(measures)
    if slide and not df.isStreaming and merge:
        lengths = _seconds(size), _seconds(slide)
        if all(lengths) and lengths[0] >= lengths[1]:
            return pane_summary(df, keys, ts, *lengths, measures)
    return row_window_summary(df, keys, ts, size, measures, slide)


def live_pane_summary(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    measures: Sequence[Measure],
    slide: str,
) -> DataFrame:
    """`window_summary` with sliding windows on a stream, by panes; append mode.

    Two aggregations with state follow each other: a row enters the one pane that
    holds it, and when the watermark (over `ts`) closes a pane, the pane enters its
    windows by its own time. So state has a row per pane and per window of panes,
    and a row of the input is aggregated once instead of ``size / slide`` times. A
    window comes out once, when it is closed. Measures must be mergeable.
    """
    lengths = _seconds(size), _seconds(slide)
    if not all(lengths) or lengths[0] < lengths[1]:
        raise ValueError("size and slide are whole seconds, minutes, hours or days, size >= slide")
    pane = F.window(ts, f"{math.gcd(*lengths)} seconds").alias("_pane")
    panes = df.groupBy(*keys, pane).agg(*(p for m in measures for p in m.partials()))
    window = F.window(F.window_time("_pane"), size, slide).alias("window")
    return (
        panes.groupBy(*keys, window)
        .agg(*(m.merged() for m in measures))
        .select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *(m.name for m in measures),
        )
    )


def _seconds(length: str) -> int | None:
    match = re.fullmatch(r"(\d+) (second|minute|hour|day)s?", length.strip())
    return match and int(match[1]) * SECONDS_IN[match[2]]


def row_window_summary(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    measures: Sequence[Measure],
    slide: str | None = None,
) -> DataFrame:
    """`window_summary` in one aggregation: each row is copied to its windows."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.groupBy(*keys, window.alias("window"))
        .agg(*(m.expr() for m in measures))
        .select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *(m.name for m in measures),
        )
    )


def pane_summary(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: int,
    slide: int,
    measures: Sequence[Measure],
) -> DataFrame:
    """`window_summary` by panes; lengths in seconds. Batch only.

    Each row is aggregated once, into the pane (greatest common divisor of size
    and slide) that holds it, and only panes are copied to the windows they
    belong to: ``size / slide`` times less work per row on dense data. A single
    mode is counted per pane and value first, and the counts are summed up.
    """
    if size < slide:
        raise ValueError("windows with gaps between them: size < slide")
    second = 1_000_000
    pane, width, step = (
        n * second for n in (math.gcd(size, slide), size, slide)
    )
    kind = dict(df.dtypes)[ts]
    micros = epoch_micros(ts)
    paned = df.where(F.col(ts).isNotNull()).withColumn(
        "_pane", micros - F.pmod(micros, F.lit(pane))
    )
    mode = _single_mode(measures)
    if mode:
        panes = _slices(paned, [*keys, "_pane"], measures, mode)
    else:
        panes = paned.groupBy(*keys, "_pane").agg(
            *(p for m in measures for p in m.partials())
        )
    # window starts w with w <= pane start and pane end <= w + width
    last = F.col("_pane") - F.pmod(F.col("_pane"), F.lit(step))
    lowest = F.col("_pane") + F.lit(pane - width)
    first = lowest + F.pmod(-lowest, F.lit(step))
    windows = panes.withColumn("_start", F.explode(F.sequence(first, last, F.lit(step))))
    if mode:
        slices = windows.groupBy(*keys, "_start", "_value").agg(
            F.sum("_n").alias("_n"),
            *(c for m in measures if m is not mode for c in m.combined()),
        )
        summed = _from_slices(slices, [*keys, "_start"], measures, mode)
    else:
        summed = windows.groupBy(*keys, "_start").agg(*(m.merged() for m in measures))
    return summed.select(
        *keys,
        F.timestamp_micros("_start").cast(kind).alias("window_start"),
        F.timestamp_micros(F.col("_start") + width).cast(kind).alias("window_end"),
        *(m.name for m in measures),
    )
