"""Near-equal vectors by cosine, with a first pass over int8 codes.

Vectors of one label meet in tiles. A tile multiplies int8 codes of the unit
vectors; each vector's quantisation error bounds how far the product can be from
the cosine, so that most pairs are decided by it and only those the bound leaves
open are computed in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trackside.llm import components, frames
from trackside.sources import tables

THRESHOLD = 0.98
MOST = 2048  # vectors of a tile's side
SLACK = 1e-9  # for rounding in the bound itself
EXACT = 1 << 24  # whole numbers that float32 holds exactly


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of the unit vectors, their scales, and the length of what the
    codes miss."""
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    scale = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    missed = np.linalg.norm(units - codes * scale[:, None], axis=1)
    return codes, scale, missed


def near_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of `left` and `right` (double, not zero) have a cosine of at
    least `threshold`.

    With units u = q + e and v = r + f: \\|uv - qr\\| <= \\|e\\| + \\|f\\| + \\|e\\| \\|f\\|.
    """
    (a, scale_a, miss_a), (b, scale_b, miss_b) = quantised(left), quantised(right)
    # products of codes are whole numbers, which float32 adds exactly up to EXACT
    kind = np.float32 if left.shape[1] * 127 * 127 < EXACT else np.float64
    product = (a.astype(kind) @ b.astype(kind).T).astype(np.float64)
    product *= scale_a[:, None]
    product *= scale_b[None, :]
    bound = miss_a[:, None] + miss_b[None, :] + miss_a[:, None] * miss_b[None, :] + SLACK
    near = product - bound >= threshold
    at, to = np.nonzero((product + bound >= threshold) & ~near)
    size_a, size_b = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    for s in range(0, len(at), 1 << 16):
        i, j = at[s : s + (1 << 16)], to[s : s + (1 << 16)]
        cosine = np.einsum("ij,ij->i", left[i], right[j]) / (size_a[i] * size_b[j])
        near[i, j] = cosine >= threshold
    return near


def _roots(near: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix of links the first one they lead to."""
    root = np.full(len(near), -1)
    for start in range(len(near)):
        if root[start] >= 0:
            continue
        frontier = np.array([start])
        root[start] = start
        while len(frontier):
            reached = near[frontier].any(0) & (root < 0)
            frontier = np.flatnonzero(reached)
            root[frontier] = start
    return root


def _tile(threshold: float):
    """Of a tile: each linked vector's number of links there, and a vector that
    links lead to."""

    def compare(table: pa.Table) -> pa.Table:
        part = table.column("part").to_numpy()
        order = np.argsort(part, kind="stable")
        part = part[order]
        flat = table.column("embedding").combine_chunks()
        vectors = flat.flatten().to_numpy().astype(np.float64).reshape(len(part), -1)[order]
        copies = table.column("copies").to_numpy()[order].astype(np.float64)
        keys = table.column("key").to_numpy(zero_copy_only=False)[order]
        n = int(np.searchsorted(part, part[-1]))
        near = np.zeros((len(part), len(part)), dtype=bool)
        if n:  # two parts: pairs across them
            across = near_pairs(vectors[:n], vectors[n:], threshold)
            near[:n, n:], near[n:, :n] = across, across.T
        else:
            near = near_pairs(vectors, vectors, threshold)
            np.fill_diagonal(near, False)
        used = np.flatnonzero(near.any(1))
        # a block at a time, since a product makes the booleans eight times as wide
        links = [near[used[i : i + 256]] @ copies for i in range(0, len(used), 256)]
        root = _roots(near[np.ix_(used, used)])
        return pa.table(
            {
                "key": pa.array(keys[used], pa.string()),
                "links": pa.array(np.concatenate([[], *links]).astype(np.int64)),
                "root": pa.array(keys[used[root]] if len(used) else keys[:0], pa.string()),
            }
        )

    return compare


def linked(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    most: int = MOST,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: `vec_id`, `n_links` (other vectors of its label with a
    cosine of at least `threshold`), `component` (the least id that links lead to,
    its own included) and `kept` (its id is that least one).

    Vectors that are NULL, of zero length, or hold NULL, NaN or infinity, those
    with a NULL label, and those of different dimensions link with nothing. Equal
    vectors are compared once and count as often as they are there. A NULL id is
    the last; rows that repeat come out as often, and are each other's links.

    All pairs of a label are compared, in tiles of bounded size: work grows with
    the square of a label's different vectors, the result with their number.
    """
    rows = frames.picked(vectors, vec_id=vec_id, embedding=embedding, label=label).withColumn(
        "vector", F.col("embedding").cast("array<double>")
    )
    sound = (
        F.col("label").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    key = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.array_join(F.col("vector").cast("array<string>"), ",")))
    keyed = tables.written(
        rows.withColumn("key", F.when(sound, key)), "embedding-keys"
    )
    distinct = tables.written(
        keyed.where("key is not null")
        .groupBy("key")
        .agg(
            F.first("label").alias("label"),
            F.first("vector").alias("embedding"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("least"),
        )
        .withColumn("size", F.size("embedding")),
        "embedding-distinct",
    )
    dealt = components.tiled(distinct, ["label", "size"], "key", most, "embedding-labels")
    met = tables.written(
        dealt.select("label", "size", "tile", "part", "key", "copies", "embedding")
        .groupBy("label", "size", "tile")
        .applyInArrow(_tile(threshold), "key string, links bigint, root string"),
        "embedding-links",
    )
    joined = components.connected(
        met.select(F.col("key").alias("a"), F.col("root").alias("b")), "embedding-components"
    ).withColumnRenamed("node", "key")
    ids = (
        distinct.select("key", "least")
        .join(joined, "key")
        .groupBy("component")
        .agg(F.min("least").alias("id"))
    )
    found = (
        distinct.select("key", "least", "copies")
        .join(met.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
        .join(joined.join(ids, "component").select("key", "id"), "key", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("id", "least").alias("id"),
        )
    )
    out = keyed.select("vec_id", "key").join(tables.written(found, "embedding-found"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component")))
