"""Session tables in the catalogue, bucketed and sorted by their keys, so that work per
key (numbering, nesting, grouping) reads them without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

BUCKETS = 64


def write_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], sort: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """Write `df` as the catalogue table `table`, replacing it, and read it back.

    Rows are dealt by a hash of `keys` into `buckets`, one file each, sorted by the keys
    and then `sort`. Tables that are joined on their keys need as many buckets.
    """
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys, *sort)
        .mode("overwrite")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def keeps_order(df: DataFrame) -> bool:
    """Whether the plan of `df` has no shuffle."""
    return "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
