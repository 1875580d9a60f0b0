"""Columns by exact name, whatever else a table holds; held-out rows; written models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def position(df: DataFrame, name: str) -> int:
    """Where column `name` stands: the exact name first, else without regard to case."""
    names = df.columns
    if name in names:
        return names.index(name)
    return [n.lower() for n in names].index(name.lower())


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """The given columns under new names, found by position, so that further
    columns with clashing names do no harm."""
    flat = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return flat.select(
        *(flat[f"_c{position(df, old)}"].alias(new) for new, old in columns.items())
    )


def packed(df: DataFrame, without: str | None = None, **columns: str) -> DataFrame:
    """As `picked`, with the whole row beside them in the struct `_row`, but for the
    column `without`, which a long text that is changed anyway need not be in."""
    flat = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    left_out = f"_c{position(df, without)}" if without else None
    return flat.select(
        *(flat[f"_c{position(df, old)}"].alias(new) for new, old in columns.items()),
        F.struct(*(c for c in flat.columns if c != left_out), F.lit(0)).alias("_row"),
    )


def unpacked(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The rows of `_row` again, under `names`. A column in `changed` takes the
    place of the one it is named like, or follows the others."""
    lower = {n.lower() for n in changed if n not in names}
    kept = [
        (changed[n] if n in changed else F.col(f"_row._c{i}")).alias(n)
        for i, n in enumerate(names)
        if n in changed or n.lower() not in lower
    ]
    return df.select(*kept, *(c.alias(n) for n, c in changed.items() if n not in names))


def remainder(doc_id: Column | str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; NULL for a NULL id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string")) % of


def held_out(doc_id: Column | str, of: int, rest: int) -> Column:
    """True where the remainder is `rest`; false for a NULL id."""
    return F.coalesce(remainder(doc_id, of) == rest, F.lit(False))


def about(df: DataFrame, most: int) -> DataFrame:
    """About `most` different rows of `df`, or all: those with a `text` whose hash falls
    below the share of the rows that is wanted. The same rows every time, without a
    sort, and each once however often it stands there, so at most a few more than
    `most` come."""
    n = df.count()
    rows = df.where("text is not null")
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64(*df.columns), F.lit(2**31)) < int(most / n * 2**31))
    return rows.distinct()


def labelled_sample(labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """About `most` rows (id, label) of `labels` for fitting, or all if fewer.

    Rows without id or label and those outside `train` (a condition on column
    `id`) don't count. Of several labels for one id the larger counts.
    """
    rows = picked(labels, id="doc_id", label=label)
    one = (
        rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & train)
        .groupBy("id")
        .agg(F.max("label").cast("int").alias("label"))
    )
    n = one.count()
    if n <= most:
        return one
    return one.where(F.pmod(F.xxhash64("id"), F.lit(2**31)) < int(most / n * 2**31))


def texts_of(docs: DataFrame, sample: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Columns `label`, `text` and `id` of the documents in `sample` (id, label), which
    has a bounded number of narrow rows and is broadcast. A row per id: of several
    texts the least counts, and NULL only if there is no other."""
    rows = picked(docs, id=doc_id, text=text)
    found = rows.join(F.broadcast(sample), "id")
    return found.groupBy("id").agg(F.max("label").alias("label"), F.min("text").alias("text")).select("label", "text", "id")
