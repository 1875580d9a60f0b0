"""Sources mixed to target weights by Poisson replication.

A document of source s is wanted r(s) times on average. Its number of copies is
the quantile of a Poisson distribution with that mean at a point drawn from a
hash of its id and text, so a rerun or a lost executor gives the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackside.llm import frames
from trackside.sources import tables

POWER = 0.5
SEED = "mix-1"
STEPS = 2**52


def _point(key: Column, seed: str) -> Column:
    """A number in [0, 1) out of 52 bits of a hash."""
    digest = F.md5(F.concat(F.lit(seed + ":"), key))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(STEPS))


def repetition_rates(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    power: float = POWER,
    epochs: float = 1.0,
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per source: `source`, `mass` and `rate`.

    The mass of a document is its characters and one for its end. `weights` gives
    the wanted share of each source (others get none); without it a source's
    share goes with its mass to the `power`, which lifts small sources. A source's
    rate is its share of `epochs` times the whole mass, over its own mass. NULL is
    a source like any other.
    """
    mass = (
        frames.picked(docs, text=text, source=source)
        .groupBy("source")
        .agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 1).cast("double").alias("mass"))
    )
    if weights is None:
        wanted = F.pow("mass", F.lit(power))
    else:
        wanted = F.lit(0.0)
        for name, weight in weights.items():
            wanted = F.when(F.col("source").eqNullSafe(F.lit(name)), weight).otherwise(wanted)
    shared = mass.withColumn("wanted", wanted)
    all_mass, all_wanted = (shared.agg(F.sum(c)).scalar() for c in ("mass", "wanted"))
    return shared.select(
        "source",
        "mass",
        F.when(
            all_wanted > 0, F.col("wanted") / all_wanted * all_mass * epochs / F.col("mass")
        )
        .otherwise(0.0)
        .alias("rate"),
    )


def poisson_steps(rates: DataFrame) -> DataFrame:
    """Each source with `steps`: the distribution function of its Poisson count at
    0, 1, 2 and so on, as far as doubles tell the values from 1."""
    most = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    terms = rates.select("source", "rate", F.explode(F.sequence(F.lit(0), most)).alias("k"))
    upto = Window.partitionBy("source").orderBy("k")
    logs = terms.withColumn("log_factorial", F.sum(F.ln(F.greatest("k", F.lit(1)))).over(upto))
    mass = F.when(F.col("rate") > 0, F.exp(F.col("k") * F.ln("rate") - F.col("rate") - F.col("log_factorial")))
    summed = logs.withColumn(
        "upto", F.sum(mass.otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0))).over(upto)
    )
    return summed.groupBy("source").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("k", "upto"))), lambda x: x["upto"]
        ).alias("steps")
    )


def mixed(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    power: float = POWER,
    epochs: float = 1.0,
    seed: str = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    numbered: bool = True,
) -> DataFrame:
    """`docs` with each row as often as its source's rate has it, in random order.

    Copies are spread over the partitions by a hash and sorted by it. With
    `numbered`, columns `copy` (from 0) and `place` (the hash, in whose order the
    mix is read) follow; they take the place of columns of that name. Each row draws
    for itself: rows without an id by their texts, and rows that repeat in id and text by
    their number in the input as well, so that none of these counts for
    the others. Empty and NULL texts count by their end; an empty table gives an
    empty one. The table of rates, a row per source, is written first, and Spark
    broadcasts it if the written size allows.
    """
    rates = repetition_rates(docs, weights, power, epochs, text, source)
    steps = tables.written(poisson_steps(rates), "mix-steps")
    own = F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.md5("text"), F.lit("null"))
    )
    # written, so that its size is known: where few rows repeat, the texts stay in place
    repeated = tables.written(
        frames.picked(docs, doc_id=doc_id, text=text)
        .groupBy(own.alias("again"))
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("again"),
        "mix-repeated",
    )
    # where Spark lists a row is the same in every run of its task
    rows = frames.packed(docs, doc_id=doc_id, source=source, text=text).select(
        "_row", "source", own.alias("own"), F.monotonically_increasing_id().alias("nth")
    )
    found = (
        rows.join(repeated, F.col("own") == F.col("again"), "left")
        .withColumn("key", F.when(F.col("again").isNull(), F.col("own")).otherwise(F.concat_ws(":", "own", "nth")))
        .join(
            steps.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left"
        )
        .withColumn("point", _point(F.col("key"), seed))
    )
    count = F.size(F.filter("steps", lambda upto: upto <= F.col("point")))
    copies = (
        found.withColumn("copies", count)
        .where("copies > 0")
        .select("_row", "key", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    )
    place = F.md5(F.concat_ws(":", F.lit(seed), "key", F.col("copy").cast("string")))
    spread = copies.withColumn("place", place).repartition("place").sortWithinPartitions("place")
    if not numbered:
        return frames.unpacked(spread, docs.columns)
    return frames.unpacked(spread, docs.columns, copy=F.col("copy"), place=F.col("place"))
