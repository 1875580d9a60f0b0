"""Work on uneven data: checked broadcasts and blocks for hot keys.

Grouped aggregates need nothing from here, since Spark aggregates before the
shuffle. Two shapes do:

* a lookup of one small row per key, where shuffling the large side on few keys
  would put most of it into few tasks: `lookup_join`;
* a scan in order within a key (numbering rows, carrying the last reading
  forward), where one key may hold a third of all rows: `ordered_blocks` cuts
  such keys into runs that separate tasks work on.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_ROWS = 10_000
HOT_ROWS = 2_000_000
MAX_HOT_KEYS = 16_384
MAX_BLOCKS = 16_384
SAMPLE_PER_BLOCK = 32

BLOCK = "_block"
HOT = "_hot"


def local_copy(df: DataFrame) -> DataFrame:
    """Fetch a frame of proven small size and hand it back as literal rows."""
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """`df` marked for broadcast if it has at most `max_rows` rows, else None.

    Runs `df` once; at most ``max_rows + 1`` rows reach the driver.
    """
    spark = df.sparkSession
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return F.broadcast(spark.createDataFrame(rows, schema=df.schema))


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join the one `small` row per key onto `big`.

    Up to `max_rows` small rows are broadcast, so `big` is not moved. Beyond
    that both sides are shuffled and adaptive execution splits hot keys.
    """
    marked = bounded_broadcast(small, max_rows)
    return big.join(small if marked is None else marked, list(on), how)


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int, max_hot: int = MAX_HOT_KEYS
) -> list:
    """The keys with more than `hot_rows` rows, largest first, at most `max_hot`.

    A key outside the `max_hot` largest holds less than ``1 / max_hot`` of the
    rows and is no larger than an ordinary task.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > hot_rows).orderBy(F.desc("_rows")).limit(max_hot).collect()


@dataclass
class Blocks:
    """`df` with the columns `_block` and `_hot`; the blocks of the hot keys."""

    df: DataFrame
    keys: list[str]
    table: DataFrame | None

    @property
    def group(self) -> list[str]:
        """Columns to partition an ordered scan by."""
        return self.keys if self.table is None else [*self.keys, BLOCK]

    def drop(self, df: DataFrame) -> DataFrame:
        return df.drop(BLOCK, HOT)


def ordered_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    hot_rows: int | None = HOT_ROWS,
    max_blocks: int = MAX_BLOCKS,
) -> Blocks:
    """Cut the hot keys of a batch frame into blocks that rise with `order`.

    Rows of block b come before rows of block b + 1 of the same key, so a scan
    over (keys, block) plus one carried value per block equals the scan over
    keys. Split points are quantiles of a sample of the hot keys' `order`
    values; they decide how even the blocks are, never what the result is. They
    are fetched (at most `max_blocks` and one per hot key) and used as literals,
    so that every use and every retried task sees the same blocks.

    Counts the rows per key first; `hot_rows=None` skips that and leaves every
    key whole.
    """
    keys = list(keys)
    found = [] if hot_rows is None else hot_keys(df, keys, hot_rows)
    if not found:
        plain = df.withColumns({BLOCK: F.lit(0), HOT: F.lit(False)})
        return Blocks(plain, keys, None)

    splits = _split_points(df, keys, order, found, hot_rows, max_blocks)
    renamed = [f"_k{i}" for i in range(len(keys))]
    position = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    # first among every `_step`-th split point, then among those that follow it:
    # a row meets two short arrays, however many blocks its key has
    step = F.col("_step")
    coarse = splits.select(
        *renamed, "_step", F.filter("_splits", lambda s, i: i % step == 0).alias("_coarse")
    )
    near = splits.select(
        *renamed,
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size("_splits") - 1) / step).cast("int")),
                lambda c: F.slice("_splits", c * step + 1, step),
            )
        ).alias("_part", "_near"),
    )
    n = max_blocks_of(splits)
    levels = math.isqrt(n - 1).bit_length() + 1 if n > 1 else 1
    at = F.col("_at")
    in_part = F.col("_start") == F.col("_part")
    cut = (
        df.withColumn("_at", position)
        .join(F.broadcast(local_copy(coarse)), _same(keys, renamed), "left")
        .withColumn("_start", F.greatest(_reached("_coarse", at, levels) - 1, F.lit(0)))
        .drop("_coarse", *renamed)
        .join(F.broadcast(local_copy(near)), _same(keys, renamed) & in_part, "left")
        .withColumns(
            {
                HOT: F.col("_near").isNotNull(),
                BLOCK: F.coalesce(
                    F.col("_start") * step + _reached("_near", at, levels), F.lit(0)
                ),
            }
        )
        .drop("_at", "_step", "_start", "_part", "_near", *renamed)
    )
    table = splits.select(
        *(F.col(r).alias(k) for r, k in zip(renamed, keys)),
        F.explode(F.sequence(F.lit(0), F.size("_splits"))).alias(BLOCK),
    )
    return Blocks(cut, keys, table)


def same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    """Join condition for two aliased frames: equal keys, NULL equal to NULL."""
    return _all(F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys)


def _same(keys: Sequence[str], renamed: Sequence[str]) -> Column:
    return _all(F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, renamed))


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions, F.lit(True))


def _split_points(df, keys, order, found, hot_rows, max_blocks) -> DataFrame:
    total = sum(row["_rows"] for row in found)
    per_block = max(hot_rows, math.ceil(total / max_blocks))
    blocks = [math.ceil(row["_rows"] / per_block) for row in found]
    fraction = min(1.0, SAMPLE_PER_BLOCK * sum(blocks) / total)
    renamed = [f"_k{i}" for i in range(len(keys))]

    kinds = dict(df.dtypes)
    ddl = ", ".join(f"{r} {kinds[k]}" for r, k in zip(renamed, keys))
    hot = df.sparkSession.createDataFrame(
        [(*row[:-1], n) for row, n in zip(found, blocks)],
        f"{ddl}, _n int" if ddl else "_n int",
    )
    position = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    rank = lambda i: F.ceil(i * F.size("_seen") / F.col("_n")).cast("int")
    points = (
        df.withColumn("_at", position)
        .join(F.broadcast(hot), _same(keys, renamed))
        .select(*renamed, "_n", "_at")
        .sample(fraction, seed=17)
        .groupBy(*renamed, "_n")
        .agg(F.sort_array(F.collect_list("_at")).alias("_seen"))
        .where("_n > 1")
        .select(
            *renamed,
            F.array_distinct(
                F.transform(
                    F.sequence(F.lit(1), F.col("_n") - 1),
                    lambda i: F.element_at("_seen", F.greatest(rank(i), F.lit(1))),
                )
            ).alias("_splits"),
        )
    )
    step = F.ceil(F.sqrt(F.size("_splits"))).cast("int")
    return local_copy(points.withColumn("_step", step))


def max_blocks_of(splits: DataFrame) -> int:
    """The largest number of split points of a key."""
    return splits.agg(F.max(F.size("_splits"))).first()[0] or 1


def _reached(array: str, at: Column, levels: int) -> Column:
    """How many values of the ordered `array`, which has fewer than 2 ** `levels`,
    are not above `at`: a binary search. NULL for a NULL array."""
    values, found = F.col(array), F.lit(0)
    steps = F.array(*(F.lit(1 << k) for k in range(levels - 1, -1, -1)))
    further = lambda n, k: F.when(F.get(values, n + k - 1) <= at, n + k).otherwise(n)
    return F.when(values.isNotNull(), F.aggregate(steps, found, further))
