"""Row-wise operators: gates, filters, numbering, typed projection."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackside.functions import skew
from trackside.functions.parsing import is_sentinel


def required_gate(df: DataFrame, *fields: str) -> DataFrame:
    """Keep the rows in which every named field is present."""
    return df.where(_present(fields))


def closing_gate(df: DataFrame, ts: str, *fields: str) -> DataFrame:
    """`required_gate` for a stream with a watermark over `ts` that is to see the rows
    dropped here, as the closing message of a topic, whose time ends all windows.

    A condition without `ts` would be moved ahead of the watermark. Rows without a
    time pass; windows drop them.
    """
    return df.where(_present(fields) | F.col(ts).isNull())


def rejected(df: DataFrame, *fields: str) -> DataFrame:
    """The rows `required_gate` drops: sentinels, malformed and partial records."""
    return df.where(~_present(fields))


def _present(fields: Sequence[str]) -> Column:
    return reduce(operator.and_, (F.col(f).isNotNull() for f in fields))


def entity_filter(df: DataFrame, column: str, value) -> DataFrame:
    """Keep the rows of one entity (a driver, a car, an event type)."""
    return df.where(F.col(column) == F.lit(value))


def quick_filter(
    df: DataFrame,
    column: str,
    threshold: float,
    scope: Sequence[str] = (),
    best_from: DataFrame | None = None,
) -> DataFrame:
    """Keep rows with ``column <= threshold * best``, best being the minimum.

    The minimum is taken per `scope` over `best_from` (by default over `df`
    itself; all laps of the session when `df` holds one driver's). Rows without
    a value are dropped. The minima are aggregated before the shuffle and then
    looked up, so a hot scope costs no more than any other.
    """
    source = df if best_from is None else best_from
    best = source.groupBy(*scope).agg(F.min(column).alias("_best"))
    if scope:
        joined = skew.lookup_join(df, best, scope)
        kept = joined.where(F.col(column) <= F.col("_best") * F.lit(threshold))
        return kept.select(*df.columns)
    return df.where(F.col(column) <= best.scalar() * F.lit(threshold))


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "idx",
    skip_first: int = 0,
    hot_rows: int | None = skew.HOT_ROWS,
) -> DataFrame:
    """Number the rows of each key from 0 in `order`; drop the first `skip_first`.

    `order` must tell all rows of a key apart. A key with more than `hot_rows`
    rows is numbered in blocks by separate tasks; each block starts at the row
    count of the blocks before it.
    """
    blocks = skew.ordered_blocks(df, keys, [F.col(c) for c in order], hot_rows)
    window = Window.partitionBy(*blocks.group).orderBy(*order)
    numbered = blocks.df.withColumn(name, F.row_number().over(window).cast("bigint") - 1)
    if blocks.table is not None:
        starts = _block_starts(blocks)
        start = F.coalesce(F.col("_start"), F.lit(0))
        numbered = (
            numbered.alias("n")
            .join(F.broadcast(starts).alias("s"), skew.same_key("n", "s", blocks.group), "left")
            .select("n.*", (F.col(f"n.{name}") + start).alias("_shifted"))
            .withColumn(name, F.col("_shifted"))
            .drop("_shifted")
        )
    out = blocks.drop(numbered)
    return out.where(F.col(name) >= skip_first) if skip_first else out


def _block_starts(blocks: skew.Blocks) -> DataFrame:
    """Rows of a hot key before each of its blocks; one row per block."""
    sizes = blocks.df.where(skew.HOT).groupBy(*blocks.group).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    before = (
        Window.partitionBy(*blocks.keys)
        .orderBy(skew.BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return sizes.select(*blocks.group, F.sum("_rows").over(before).alias("_start"))


def typed_projection(
    df: DataFrame,
    columns: Mapping[str, tuple[str | Column, str]],
    strict: bool = True,
) -> DataFrame:
    """Build the output columns ``name: (source, type)``, in order.

    A source is a column name (a rename) or any Column, ``F.lit`` included. With
    `strict` a value that does not fit its type is an error; otherwise NULL.
    """
    out = []
    for name, (source, kind) in columns.items():
        col = F.col(source) if isinstance(source, str) else source
        out.append((col.cast(kind) if strict else col.try_cast(kind)).alias(name))
    return df.select(*out)


def display_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns for showing, spaces allowed."""
    return df.withColumnsRenamed(dict(names))


def sentinel_cut(
    messages: DataFrame,
    partition: Sequence[str] = (),
    offset: str = "offset",
    value: str = "value",
) -> DataFrame:
    """Keep the messages that precede the first sentinel of their topic partition.

    `partition` names the columns of a topic partition; a partition without a
    sentinel is kept whole. Batch only: a live query stops by
    `streaming.run.run_until_sentinel`.
    """
    ends = (
        messages.where(is_sentinel(value))
        .groupBy(*partition)
        .agg(F.min(offset).alias("_end"))
    )
    if partition:
        cut = skew.lookup_join(messages, ends, partition, "left")
        return cut.where(
            F.col("_end").isNull() | (F.col(offset) < F.col("_end"))
        ).select(*messages.columns)
    end = F.coalesce(ends.scalar(), F.lit(2**63 - 1))
    return messages.where(F.col(offset) < end)
