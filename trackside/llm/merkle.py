"""A Merkle manifest of a dataset: leaves per row, a tree per group, one root.

Where a leaf stands is not found by sorting. The ids of each group make a
compressed bitmap (64 ids to a word, only words that hold any), merged from what
each task saw, with a directory of popcounts: the rank of an id is the count before
its word, and the bits below its own. Ranks are coordinates; sixteen nodes whose
coordinates share a parent meet in one slot array, whose hash is the parent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from trackside.llm import frames
from trackside.operators.rows import row_index
from trackside.sources import tables

FAN = 16
PATH = "array<struct<left:string,right:string>>"
#: Directory levels above the words, in bits: a window never holds more than 65,538 rows.
DIRECTORY = (10, 16, 16)
#: Copies of one row that a task lists at most.
COPIES = 1000
_NULL_WORD = -(1 << 57) - 1  # before the word of any id


def leaf_hash(*fields: Column) -> Column:
    """sha256 of the fields, one after the other: `-` for NULL, else the number of
    UTF-8 bytes, a colon and the value as text."""
    part = lambda c: F.concat(F.octet_length(c), F.lit(":"), c)
    texts = (f.cast("string") for f in fields)
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(part(t)) for t in texts)), 256)


# -- ranks by bitmaps --------------------------------------------------------------


def _starts(nodes: DataFrame, group: list[str], bits: Sequence[int]) -> DataFrame:
    """`nodes` (group, node, n) with the sum of `n` before each, and `total`."""
    upto = lambda *by: Window.partitionBy(*by).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda *by: F.coalesce(F.sum("n").over(upto(*by)), F.lit(0)).alias("before")
    if not bits:
        total = F.sum("n").over(Window.partitionBy(*group)).alias("total")
        return nodes.select("*", before(*group), total)
    lower = nodes.withColumn("above", F.shiftright("node", bits[0]))
    upper = _starts(
        lower.groupBy(*group, F.col("above").alias("node")).agg(F.sum("n").alias("n")), group, bits[1:]
    ).select(*group, F.col("node").alias("above"), F.col("before").alias("first"), "total")
    counted = lower.select("*", before(*group, "above"))
    return (
        counted.join(upper, [*group, "above"])
        .withColumn("before", F.col("before") + F.col("first"))
        .drop("above", "first")
    )


def _word(key: Column) -> Column:
    return F.coalesce(F.shiftright(key, 6), F.lit(_NULL_WORD))


def _bit(key: Column) -> Column:
    return F.coalesce(key.bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def _shift(value: int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("bigint"), by)


def directory(ids: DataFrame, group: list[str], key: str) -> DataFrame:
    """The bitmap words of each group, with the rows before each and in all.

    `ids` has a row per group and key with the number `n` of rows that have it (a
    key may be NULL and comes first; `group` has no NULL). A word has `bits`, the
    rows `before` it in its group, the group's `total`, and of keys with several rows
    how many more each has (`more`).
    """
    k = F.col(key)
    several = F.when(F.col("n") > 1, F.struct(_bit(k).alias("bit"), (F.col("n") - 1).alias("n")))
    words = ids.groupBy(*group, _word(k).alias("node")).agg(
        F.bit_or(_shift(1, _bit(k))).alias("bits"),
        F.sum("n").alias("n"),
        F.collect_list(several).alias("more"),
    )
    return _starts(tables.written(words, "bitmap-words"), group, DIRECTORY)


def ranked(rows: DataFrame, words: DataFrame, group: list[str], key: str) -> DataFrame:
    """`rows` with `rank`, the rows of the group with a smaller key, and `total`."""
    k = F.col(key)
    found = rows.withColumn("node", _word(k)).join(words.drop("n"), [*group, "node"])
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(_shift(-1, _bit(k)))))
    more = F.aggregate(
        "more", F.lit(0).cast("bigint"),
        lambda sum_, m: sum_ + F.when(m["bit"] < _bit(k), m["n"]).otherwise(0),
    )
    rank = (F.col("before") + below + more).alias("rank")
    return found.select(*rows.columns, rank, "total")


def _placed(records: DataFrame) -> DataFrame:
    """Distinct rows (group, id, leaf, n) with the place `at` of the first of their `n`
    copies among the leaves of their group, in order of id, then leaf, and `total`."""
    ids = tables.written(
        records.groupBy("group", "id").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")),
        "manifest-ids",
    )
    placed = ranked(records, directory(ids, ["group"], "id"), ["group"], "id")
    placed = placed.withColumnRenamed("rank", "at")
    several = ids.where("kinds > 1").select("group", F.col("id").alias("_id"))
    if several.isEmpty():
        return placed
    # rows of one id that differ are ranked by their leaves in the same way
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    same = (F.col("s.group") == F.col("p.group")) & F.col("s._id").eqNullSafe(F.col("p.id"))
    tied = placed.alias("p").join(several.alias("s"), same, "left_semi")
    alone = placed.alias("p").join(several.alias("s"), same, "left_anti")
    keyed = tables.written(
        tied.withColumns({"name": name, "head": F.conv(F.substring("leaf", 1, 15), 16, 10).cast("bigint")}),
        "manifest-tied",
    )
    by = ["group", "name"]
    heads = keyed.groupBy(*by, "head").agg(F.sum("n").alias("n"))
    first = ranked(keyed.drop("total"), directory(heads, by, "head"), by, "head")
    alike = Window.partitionBy(*by, "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    shifted = first.withColumn("at", F.col("at") + F.col("rank") + F.coalesce(F.sum("n").over(alike), F.lit(0)))
    totals = keyed.select("group", "id", "leaf", "total")
    whole = shifted.drop("total", "rank", "name", "head").alias("x").join(
        totals.alias("t"),
        (F.col("x.group") == F.col("t.group")) & F.col("x.id").eqNullSafe(F.col("t.id")) & (F.col("x.leaf") == F.col("t.leaf")),
    )
    return alone.unionByName(whole.select("x.*", "t.total"))


def _each_copy(placed: DataFrame) -> DataFrame:
    """A row per copy, at its own place; a row with very many copies is listed by
    many tasks."""
    n = F.col("n")
    part = F.col("part") * COPIES
    many = (
        placed.where(n > COPIES)
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / COPIES))))
        .repartition("group", "at", "part")
        .withColumns({"at": F.col("at") + part, "n": F.least(n - part, F.lit(COPIES))})
        .drop("part")
    )
    every = placed.where(n <= COPIES).unionByName(many)
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    return every.withColumn("copy", copy).withColumn("at", F.col("at") + F.col("copy")).drop("copy", "n")


# -- trees by slot arrays ----------------------------------------------------------


@dataclass
class Tree:
    """Slot arrays of each level, from the leaves up: `group`, the parent's `at`, the
    nodes of its level in the group `total`, `slots` in order and their hash `node`."""

    levels: list[DataFrame]

    def tops(self) -> DataFrame:
        """The `top` of each group."""
        alone = self.levels[0].where("total = 1").select("group", F.col("slots")[0]["node"].alias("top"))
        last = F.col("total").between(2, FAN)
        for level in self.levels:
            alone = alone.unionByName(level.where(last).select("group", F.col("node").alias("top")))
        return alone

    def paths(self, above: DataFrame) -> DataFrame:
        """Each leaf's slot as columns, with the columns of its group in `above`; `path`
        there leads on from the group's top, and the leaf's own goes before it."""
        extra = [c for c in above.columns if c not in ("group", "path")]
        over = None
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            found = level.where(F.col("total") <= FAN).join(above, "group")
            if over is not None:
                found = found.unionByName(level.where(F.col("total") > FAN).join(over, ["group", "at"]))
            nodes = F.transform("slots", lambda s: s["node"])
            every = found.select(
                "group", "at", "total", "path", *extra, nodes.alias("nodes"), F.posexplode("slots").alias("i", "slot")
            )
            i = F.col("i")
            left = F.array_join(F.slice("nodes", F.lit(1), i), "")
            right = F.array_join(F.slice("nodes", i + 2, F.lit(FAN)), "")
            step = F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("path"))
            path = F.when(F.col("total") == 1, F.col("path")).otherwise(step).alias("path")
            at = (F.col("at") * FAN + i).alias("at")
            over = every.select("group", at, path, *extra, *(["slot"] if depth == 0 else []))
        return over.select("group", "at", "path", *extra, "slot.*")


def grown(nodes: DataFrame, name: str) -> Tree:
    """The tree over `nodes`: `group`, place `at` from 0 on, `total`, `node` and further
    columns to keep at the leaves. Each level is written: its arrays make the next."""

    def paired(nodes: DataFrame) -> DataFrame:
        rest = [c for c in nodes.columns if c not in ("group", "at", "total", "node")]
        slot = F.struct((F.col("at") % FAN).cast("int").alias("slot"), "node", *rest)
        slots = F.array_sort(F.collect_list(slot), lambda a, b: a["slot"] - b["slot"])
        arrays = nodes.groupBy("group", F.floor(F.col("at") / FAN).alias("at")).agg(
            F.max("total").alias("total"), slots.alias("slots")
        )
        joined = F.array_join(F.transform("slots", lambda s: s["node"]), "")
        return tables.written(arrays.withColumn("node", F.sha2(joined, 256)), name)

    levels = [paired(nodes)]
    size = levels[0].agg(F.max("total")).first()[0] or 0
    while size > FAN:
        size = -(-size // FAN)
        below = levels[-1].where(F.col("total") > FAN)
        total = F.ceil(F.col("total") / FAN).cast("bigint").alias("total")
        levels.append(paired(below.select("group", "at", total, "node")))
    return Tree(levels)


# -- the manifest ------------------------------------------------------------------


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    group: str = "source",
    doc_id: str = "doc_id",
    carried: Mapping[str, Column] | None = None,
) -> DataFrame:
    """A row per row of `docs`: `group`, `doc_id`, `leaf`, `at` (its place in the group),
    `subroot`, `root` and `path`.

    A leaf hashes `fields`. The leaves of a group ascend by `doc_id`, an integer (NULL
    first); rows with one id by their leaves, so that equal rows, whose leaves
    are equal, lie side by side. While there are several nodes every sixteen become
    the hash of theirs, as does a rest of fewer, even one; what is left is the subroot.
    The subroots, by group (NULL first, then bytewise), make the root likewise.

    `path` lists, from the leaf up, what stands `left` and `right` of the node in its
    array, so the root follows from it and the leaf (`folded`). `carried` columns,
    expressions over `fields`, come along. An empty table gives an empty manifest.

    Equal rows are counted before they are shuffled and listed again at the end. Of the
    whole, one number and the root reach the driver.
    """
    rows = frames.picked(docs, **{f: f for f in fields}, _group=group, _id=doc_id)
    extra = dict(carried or {})
    records = rows.select(
        # a key without NULL that is in the same order
        F.coalesce(F.concat(F.lit("="), F.col("_group")), F.lit("")).alias("group"),
        F.col("_id").cast("bigint").alias("id"),
        leaf_hash(*(F.col(f) for f in fields)).alias("leaf"),
        *(column.alias(name) for name, column in extra.items()),
    )
    records = records.groupBy(*records.columns).agg(F.count("*").alias("n"))
    placed = _placed(tables.written(records, "manifest-leaves"))
    leaves = _each_copy(placed).withColumnRenamed("leaf", "node")
    tree = grown(leaves, "manifest-runs")

    tops = tables.written(tree.tops().withColumn("all", F.lit("")), "manifest-tops")
    m = tops.count()
    upper = grown(
        row_index(tops, ["all"], ["group"], "at").select(
            F.col("all").alias("group"), "at", F.lit(m).cast("bigint").alias("total"),
            F.col("top").alias("node"), F.col("group").alias("of"),
        ),
        "manifest-groups",
    )
    top = upper.tops().first()
    root = F.lit(top["top"] if top else None).cast("string")
    start = upper.levels[0].sparkSession.range(1).select(
        F.lit("").alias("group"), F.array().cast(PATH).alias("path")
    )
    above = tables.written(
        upper.paths(start).select(F.col("of").alias("group"), "path", F.col("node").alias("subroot")),
        "manifest-above",
    )
    named = F.when(F.col("group") != "", F.substr("group", F.lit(2)))
    return tree.paths(above).select(
        named.alias("group"), F.col("id").alias("doc_id"), F.col("node").alias("leaf"), "at",
        "subroot", root.alias("root"), "path", *extra,
    )


def proof(path: Column) -> Column:
    """The siblings of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that `leaf` leads to among the siblings of `path`."""
    return F.aggregate(
        path, leaf, lambda node, p: F.sha2(F.concat(p["left"], node, p["right"]), 256)
    )
