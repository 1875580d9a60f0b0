"""One record per lap with its readings inside, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from trackside.functions import skew
from trackside.operators.rows import row_index

MAX_ITEMS = 5_000


def nest_records(
    parents: DataFrame,
    children: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    items: str,
    item_fields: Sequence[str],
    parent_structs: Mapping[str, Sequence[str]],
    max_items: int = MAX_ITEMS,
    hot_rows: int | None = skew.HOT_ROWS,
) -> DataFrame:
    """Pack each parent row with its children into records.

    `parents` holds one row per key. Output: the keys, `part`, one struct per
    entry of `parent_structs` and the array `items` of child structs, in
    `order`, which must tell the children of a key apart. A parent without
    children gets an empty array; children without a parent are left out.

    A record holds at most `max_items` children, which bounds its size whatever
    the key. Further children follow in records with part 1, 2, ..., and every
    part has the parent structs, so that no child is without its parent.
    `unpack_parents` takes part 0 alone and returns each parent once. Batch only.
    """
    keys = list(keys)
    if hot_rows is not None and not skew.hot_keys(children, keys, hot_rows):
        hot_rows = None
    numbered = row_index(children, keys, order, "_idx", hot_rows=hot_rows)
    item = F.struct("_idx", F.struct(*item_fields).alias("item"))
    packed = (
        numbered.withColumn("part", F.floor(F.col("_idx") / max_items))
        .groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(item)).alias("_items"))
        .select(*keys, "part", F.col("_items.item").alias(items))
    )
    heads = parents.select(
        *keys, *(F.struct(*fields).alias(n) for n, fields in parent_structs.items())
    )
    if hot_rows is None:
        # numbering has already put the children of a key together
        joined = heads.join(packed, keys, "left")
    else:
        joined = _by_part(heads, children, keys, max_items).join(
            packed, [*keys, "part"], "left"
        )
    part = F.coalesce("part", F.lit(0))
    empty = F.array().cast(packed.schema[items].dataType)
    return joined.select(
        *keys,
        part.alias("part"),
        *parent_structs,
        F.coalesce(F.col(items), empty).alias(items),
    )


def _by_part(heads: DataFrame, children: DataFrame, keys, max_items) -> DataFrame:
    """Each parent once per part it will have, so the parts of a hot key are
    joined in separate tasks."""
    parts = children.groupBy(*keys).agg(
        F.ceil(F.count(F.lit(1)) / max_items).alias("_parts")
    )
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    return (
        heads.join(parts, keys, "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .drop("_parts")
    )


def explode_records(
    nested: DataFrame, items: str, keep: Sequence[str] = (), position: str | None = None
) -> DataFrame:
    """One row per element of the array of structs `items`, its fields as columns.

    `position` names a column for the index of the element in its record.
    Records with an empty or NULL array give no row. Batch or stream.
    """
    if position is None:
        opened = nested.select(*keep, F.explode(items).alias("_item"))
        return opened.select(*keep, "_item.*")
    opened = nested.select(*keep, F.posexplode(items).alias(position, "_item"))
    return opened.select(*keep, position, "_item.*")


def unpack_parents(
    nested: DataFrame, name: str, keep: Sequence[str] = (), part: str = "part"
) -> DataFrame:
    """The parent struct `name` as columns, one row per parent.

    Where the records have a column `part`, a parent is taken from part 0 (or
    none, as in messages that were never split).
    """
    own = nested.where(F.col(name).isNotNull())
    if part in nested.columns:
        own = own.where(F.coalesce(F.col(part), F.lit(0)) == 0)
    return own.select(*keep, f"{name}.*")
