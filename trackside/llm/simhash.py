"""SimHash fingerprints and their groups, by bit-sliced comparison.

Fingerprints that may be near share two blocks of bits and meet in a bucket. There
their bits lie in planes, one bit of 64 fingerprints to a word; distances of all
lanes are counted at once with carry-save adders, and a block of lanes is given up
as soon as all of them are too far.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackside.llm import components, frames
from trackside.sources import tables

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
MOST = 2048  # rows of a bucket's part
SMALL = 32  # buckets up to here are compared in one sweep
BLOCK = 64  # words of lanes that are given up together
STRIDE = 8  # planes between two looks whether to give up


# -- fingerprints ---------------------------------------------------------------


def fingerprint(text: str | bytes | None, shingle: int = SHINGLE) -> int:
    """Bits that are set in more than half of the shingles' hashes; unsigned."""
    if not text:
        return 0
    words = (text.encode() if isinstance(text, str) else text).lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashed = np.fromiter(
        (xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(n)),
        dtype=np.uint64,
        count=n,
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 14):
        part = hashed[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text as a signed 64-bit number.

    A-Z are lower-cased, words are parted by ASCII white space. A text with fewer
    words than a shingle is one shingle; NULL and texts without a word give 0.
    """

    @F.arrow_udf("bigint")
    def hashed(texts: pa.Array) -> pa.Array:
        found = (fingerprint(t.as_py(), shingle) for t in texts.cast(pa.binary()))
        out = np.fromiter(found, dtype=np.uint64, count=len(texts))
        return pa.array(out.view(np.int64))

    return hashed(text)


# -- bit planes -------------------------------------------------------------------


def planes(prints: np.ndarray) -> np.ndarray:
    """Bit b of print i is bit i % 64 of word ``[b, i // 64]``."""
    bits = np.unpackbits(
        prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
    )
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    width = -(-len(prints) // 64) * 8
    padded = np.pad(packed, ((0, 0), (0, width - packed.shape[1])))
    return np.ascontiguousarray(padded).view("<u8")


def _lanes(mask: np.ndarray) -> np.ndarray:
    """Booleans to packed words."""
    return planes(mask.astype(np.uint64))[0]


def _within(differing, shape, live: np.ndarray, radius: int) -> np.ndarray:
    """Lanes of `live` whose distance is at most `radius`.

    ``differing(b, rows)`` gives plane b of the differing bits for the chosen rows
    of `shape` (rows, words). Counters hold a bit each of the distances; a carry out
    of the last, or the pattern radius + 1, takes a lane out for good.
    """
    n_counters = radius.bit_length()
    out = np.zeros(shape, dtype=np.uint64)
    rows = np.flatnonzero(live.any(1))
    live = live[rows].copy()
    counters = [np.zeros(live.shape, dtype=np.uint64) for _ in range(n_counters)]
    for b in range(BITS):
        carry = differing(b, rows)
        for k in range(n_counters):
            held = counters[k]
            counters[k], carry = held ^ carry, held & carry
        live &= ~carry
        if radius + 1 < 1 << n_counters:
            too_far = ~np.zeros_like(live)
            for k in range(n_counters):
                too_far &= counters[k] if (radius + 1) >> k & 1 else ~counters[k]
            live &= ~too_far
        if b % STRIDE == STRIDE - 1 and b + 1 < BITS:
            some = live.any(1)
            if not some.all():
                rows, live = rows[some], live[some]
                counters = [c[some] for c in counters]
                if not len(rows):
                    return out
    out[rows] = live
    return out


def _unpacked(words: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(words.astype("<u8").view(np.uint8), bitorder="little")[:n].astype(bool)


def neighbours(prints: np.ndarray, keys: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of near prints with equal keys; keys are in order and
    few are alike. Lane i is compared with lane i + s for s = 1, 2 and so on."""
    n = len(prints)
    first, second = [], []
    for s in range(1, n):
        same = np.flatnonzero(keys[:-s] == keys[s:])
        if not len(same):
            break
        # only the pairs that share a bucket get a lane
        own = planes(prints[same] ^ prints[same + s])
        wide = -(-own.shape[1] // BLOCK) * BLOCK
        own = np.pad(own, ((0, 0), (0, wide - own.shape[1]))).reshape(BITS, -1, BLOCK)
        live = np.zeros(wide, dtype=np.uint64)
        lanes = _lanes(np.ones(len(same), dtype=bool))
        live[: len(lanes)] = lanes
        near = _within(lambda b, rows: own[b][rows], own.shape[1:], live.reshape(-1, BLOCK), radius)
        at = same[_unpacked(near.ravel(), len(same))]
        first.append(at)
        second.append(at + s)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *second])


def local_roots(prints: np.ndarray, radius: int, width: int = 256) -> np.ndarray:
    """For each print the first one that links lead to, of one large bucket.

    From the first print not yet reached, the reached ones are compared, `width` at
    a time, with the planes of all that are not; what is reached leaves the planes.
    """
    n = len(prints)
    root = np.arange(n)
    left = np.arange(n)
    while len(left) > 1:
        start, left = left[0], left[1:]
        frontier = np.array([start])
        sliced = planes(prints[left])
        live = np.ones(len(left), dtype=bool)
        while len(frontier) and live.any():
            if live.sum() * 2 < len(live):
                left, sliced = left[live], planes(prints[left[live]])
                live = np.ones(len(left), dtype=bool)
            query, frontier = frontier[:width], frontier[width:]
            masks = [
                np.where(prints[query] >> np.uint64(b) & np.uint64(1), ~np.uint64(0), np.uint64(0))
                for b in range(BITS)
            ]
            lanes = _lanes(live)
            near = _within(
                lambda b, rows: sliced[b][None, :] ^ masks[b][rows][:, None],
                (len(query), len(lanes)),
                np.tile(lanes, (len(query), 1)),
                radius,
            )
            new = _unpacked(np.bitwise_or.reduce(near, axis=0), len(left)) & live
            root[left[new]] = start
            frontier = np.concatenate((frontier, left[new]))
            live &= ~new
        left = left[live]
    return root


# -- buckets --------------------------------------------------------------------


def _blocks(radius: int) -> list[tuple[int, int]]:
    """First bit and width of radius + 2 blocks; near prints agree in two of them."""
    n = radius + 2
    edges = [round(BITS * k / n) for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bucket_keys(radius: int) -> Column:
    """A key per pair of blocks: the pair's number and the two blocks' bits."""
    def bits(first: int, width: int) -> Column:
        return F.shiftrightunsigned("print", first).bitwiseAND(F.lit((1 << width) - 1))

    keys = []
    for k, ((a, m), (b, n)) in enumerate(combinations(_blocks(radius), 2)):
        both = F.shiftleft(bits(a, m), n).bitwiseOR(bits(b, n))
        keys.append(F.struct(F.lit(k).alias("pair"), both.alias("bits")))
    return F.array(*keys)


def _edges(prints: np.ndarray, keys: np.ndarray, radius: int):
    """Links that join up the near prints of each bucket; keys are in order."""
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(edge, len(keys)))
    small = np.repeat((size > 1) & (size <= SMALL), size)
    i, j = neighbours(prints[small], keys[small], radius)
    found = [(prints[small][i], prints[small][j])]
    for s, n in zip(edge[size > SMALL], size[size > SMALL]):
        own = prints[s : s + n]
        root = local_roots(own, radius)
        moved = root != np.arange(n)
        found.append((own[moved], own[root[moved]]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _link(radius: int):
    """Links out of batches (bucket, tile, print) in order of bucket and tile."""

    def link(batches):
        held = [np.zeros(0, dtype=np.int64) for _ in range(3)]

        def out(columns, ids):
            a, b = _edges(columns[2].view(np.uint64), ids, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

        for batch in batches:
            columns = [np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held)]
            if not len(columns[0]):
                continue
            bucket, tile, _ = columns
            new = (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])
            ids = np.concatenate(([0], np.cumsum(new)))
            # the last bucket may go on in the next batch
            cut = int(np.searchsorted(ids, ids[-1]))
            if cut:
                yield out([c[:cut].copy() for c in columns], ids[:cut])
            held = [c[cut:].copy() for c in columns]
        if len(held[0]):
            yield out(held, np.zeros(len(held[0]), dtype=np.int64))

    return link


def links(prints: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """Links (a, b) that join up all distinct `print`s at most `radius` bits apart.

    Near prints share a bucket of at least one pair of blocks. Buckets of more than
    `most` prints are cut into tiles in which any two of its prints meet. Small
    buckets give every link, larger ones as many as join up their components.
    """
    rows = prints.select("print", F.inline(_bucket_keys(radius))).select(
        "print",
        F.shiftleft(F.col("pair").cast("bigint"), 32).bitwiseOR(F.col("bits")).alias("bucket"),
    )
    dealt = components.tiled(rows, ["bucket"], "print", most, "simhash-buckets")
    ordered = (
        dealt.select("bucket", "tile", "print")
        .repartition("bucket", "tile")
        .sortWithinPartitions("bucket", "tile", "print")
    )
    return ordered.mapInArrow(_link(radius), "a bigint, b bigint").distinct()


def hexadecimal(column: Column) -> Column:
    """A fingerprint as 16 lowercase digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _components(narrow: DataFrame, radius: int) -> DataFrame:
    """For each `print` of `narrow` (doc_id, print): `root`, the least print of its
    component, and `component`, the least id in it."""
    least = tables.written(
        narrow.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-distinct"
    )
    linked = components.connected(links(least.select("print"), radius), "simhash-links")
    member = least.join(linked.withColumnRenamed("node", "print"), "print")
    of = member.groupBy("component").agg(F.min("least").alias("id"))
    moved = member.join(of, "component").select(
        "print", F.col("id").alias("moved"), F.col("component").alias("root")
    )
    return tables.written(
        least.join(moved, "print", "left").select(
            "print",
            F.coalesce("root", "print").alias("root"),
            F.coalesce("moved", "least").alias("component"),
        ),
        "simhash-components",
    )


def groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: `doc_id`, `print` (signed 64 bits) and `component`, the
    least id that links of at most `radius` bits lead to.

    Texts with one fingerprint are grouped before anything is compared, so copies
    cost one row. Texts without a word have print 0 and are linked by it like any
    others. A component all of whose ids are NULL has none; rows that repeat come
    out as often. An empty table gives an empty one.
    """
    rows = frames.picked(docs, doc_id=doc_id, text=text)
    narrow = tables.written(
        rows.select("doc_id", fingerprints(F.col("text"), shingle).alias("print")), "simhash-prints"
    )
    found = narrow.join(_components(narrow, radius), "print")
    return found.select("doc_id", "print", "component")


def representatives(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row of `docs` for each component, as it is: the one with the least id
    (NULL last), of rows with one id the one with the least hash of its text, of
    rows with one id and text any."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text"))
    rows = frames.packed(docs, doc_id=doc_id, text=text).withColumn("key", key)
    narrow = tables.written(
        rows.select("doc_id", "key", fingerprints(F.col("text"), shingle).alias("print")),
        "simhash-prints",
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    chosen = tables.written(
        narrow.join(_components(narrow, radius), "print")
        .groupBy("root")
        .agg(first)
        .select("first.key"),
        "simhash-chosen",
    )
    # the join deals the rows by key, and repeated rows meet there
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0)))
    kept = rows.join(chosen, "key").withColumn("nth", nth).where("nth = 1")
    return frames.unpacked(kept, docs.columns)
