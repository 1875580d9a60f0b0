"""The manifest against a tree built row by row."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import tables
from trackside.llm import merkle, queries

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))
    return sha("".join(parts))


def tree(nodes):
    """The top and for each node its steps (left, right)."""
    steps, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
            steps[i].append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        nodes = [sha("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
        where = [at // 16 for at in where]
    return nodes[0], steps


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, inner = [], []
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        top, steps = tree([leaf(*r) for r in ordered])
        tops.append(top)
        inner.append((ordered, steps))
    if not tops:
        return []
    root, outer = tree(tops)
    out = []
    for top, (ordered, steps), above in zip(tops, inner, outer):
        for row, path in zip(ordered, steps):
            path = path + above
            node = leaf(*row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = row[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
                node = leaf(row[0], text, *row[2:])
            for left, right in path:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((row[0], leaf(*row), top, root, proof, node, node == root))
    return out


def check(spark, folder, rows, extra=()):
    tables.odd(spark, rows, extra).write.parquet(f"{folder}/documents.parquet")
    got = queries.merkle_manifest(spark, folder)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(rows), key=repr)


def test_odd_tables(spark, tmp_path):
    check(spark, str(tmp_path), tables.ROWS, tables.EXTRA[1:])


def test_empty_table(spark, tmp_path):
    check(spark, str(tmp_path), [])


def test_one_row(spark, tmp_path):
    check(spark, str(tmp_path), [(7, "One", "en", None, 3)])


def test_repeated_tied_and_sparse_ids(spark, tmp_path, monkeypatch):
    """A third under one NULL id, equal and different; ids far apart; a lone source."""
    monkeypatch.setattr(merkle, "COPIES", 7)
    rng = random.Random(5)
    rows = [(None, "Same Copy", "en", "a", 9)] * 120
    rows += [(None, f"Different {i}", "en", "a", i) for i in range(120)]
    rows += [(rng.choice([-(2**63), 2**63 - 1, 64, 63, -1]), "X" * rng.randint(0, 3), "en", "a", 0) for _ in range(60)]
    rows += [(rng.randrange(-(2**63), 2**63), "far", "en", "b", 3) for _ in range(200)]
    rows += [(i * 3, "Near", "en", rng.choice(["é", "z", None]), i) for i in range(300)]
    rows += [(1, "alone", "en", "", 5), (1, "alone", "en", "=", 5)]
    check(spark, str(tmp_path), rows)


@pytest.mark.parametrize("n", [15, 16, 17, 256, 257])
def test_sizes_around_full_arrays(spark, n):
    rows = [(i, f"text {i}", "en", "a", i) for i in range(n)]
    docs = spark.createDataFrame(rows, COLUMNS)
    out = merkle.manifest(docs, queries.FIELDS)
    got = {r["doc_id"]: r for r in out.withColumn("again", merkle.folded(F.col("leaf"), F.col("path"))).collect()}
    top, steps = tree([leaf(*r) for r in rows])
    for i in range(n):
        assert got[i]["at"] == i and got[i]["subroot"] == got[i]["root"] == got[i]["again"] == top
        assert [tuple(p) for p in got[i]["path"]] == steps[i]


def test_directory_counts_what_stands_before(spark):
    rng = random.Random(8)
    keys = sorted({rng.randrange(-(10**k), 10**k) for k in range(1, 18) for _ in range(60)})
    counts = {k: rng.choice([1, 1, 1, 4]) for k in keys}
    ids = spark.createDataFrame([("g", k, n) for k, n in counts.items()], "g string, key bigint, n bigint")
    found = merkle.ranked(ids, merkle.directory(ids, ["g"], "key"), ["g"], "key")
    got = {r["key"]: (r["rank"], r["total"]) for r in found.collect()}
    before = 0
    for k in keys:
        assert got[k] == (before, sum(counts.values()))
        before += counts[k]
