"""Connected components of a graph given as links, and groups cut into tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trackside.sources import tables


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One step: the neighbours of each node are linked to the least of them.

    Large: all neighbours, and those above the node move. Small: the node and
    its neighbours below it.
    """
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    every = links.union(back) if large else links
    least = every.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    joined = every.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    return moved.where("a > b").distinct()


def connected(links: DataFrame, name: str = "links") -> DataFrame:
    """`node` and `component`, the least node of its component, for every node of
    `links` (columns a and b, of any type that has an order).

    Large and small star steps in turn, until no link moves; every round is a
    written table, so what is lost with an executor is one round. A node with very
    many links is reduced to a minimum before the shuffle and joined back, which
    adaptive execution splits.
    """
    now = tables.written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        name,
    )
    state = None
    while True:
        now = tables.written(_stars(_stars(now, True), False), name)
        at = now.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(2**31)))
        ).first()
        if at == state:
            break
        state = at
    # links now lead straight to the least node
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def tiled(rows: DataFrame, keys: list[str], identity: str, most: int, name: str) -> DataFrame:
    """`rows` with `part` and `tile`, so that any two rows of a group meet in a tile
    and no tile has many more than twice `most` rows.

    A group with more than `most` rows is dealt into parts by a hash of
    `identity`, and each pair of parts, a part with itself too, is a tile. Other
    groups are one tile, 0. Groups are told by all of `keys`, which aren't NULL.
    """
    large = tables.written(
        rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most), name
    )
    parts = F.coalesce(F.ceil(F.col("_n") / most), F.lit(1)).cast("int")
    dealt = (
        rows.join(large, keys, "left")
        .withColumn("_parts", parts)
        .withColumn("part", F.pmod(F.xxhash64(identity), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    )
    tile = F.least("part", "_other").cast("bigint") * F.col("_parts") + F.greatest("part", "_other")
    return dealt.withColumn("tile", tile).drop("_n", "_parts", "_other")
