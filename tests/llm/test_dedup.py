"""Near copies, repeated sentences and vectors against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import tables
from compare import connect, duck_rows, spark_rows
from trackside.llm import components, embedding_dedup, frames, line_dedup, simhash, sql


def naive_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashed = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def naive_components(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def unsigned(value):
    return value & (1 << 64) - 1


@pytest.mark.parametrize("extra", [(), tables.EXTRA])
def test_simhash_groups(spark, extra):
    found = simhash.groups(tables.odd(spark, extra=extra)).collect()
    prints = [(r[0], naive_print(r[1])) for r in tables.ROWS]
    assert Counter((r["doc_id"], unsigned(r["print"])) for r in found) == Counter(prints)
    distinct = sorted({p for _, p in prints})
    near = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3]
    root = naive_components(near, distinct)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    for r in found:
        assert r["component"] == least.get(root[unsigned(r["print"])])


def test_simhash_representatives(spark):
    kept = simhash.representatives(tables.odd(spark, extra=tables.EXTRA))
    assert kept.columns == [*tables.COLUMNS, *tables.EXTRA]
    rows = kept.select("doc_id").collect()
    by_group = {}
    for r in simhash.groups(tables.odd(spark)).collect():
        by_group.setdefault((r["component"], r["print"]), r["component"])
    ids = Counter(r["doc_id"] for r in rows)
    assert ids[6] == 1 and ids[7] == 0  # exact copies
    assert ids[None] == 1  # a repeated row without an id stays once
    assert ids[9] == 2  # one id, two texts; the repeated one once
    assert ids[3] == 1 and ids[4] == ids[5] == 0  # texts without a word are a group


def test_near_copies_chain(spark):
    """Fingerprints that lie 3 bits apart in a chain are one component; a bucket
    of thousands is cut into tiles without losing a link."""
    random.seed(3)
    centre = random.getrandbits(64)
    prints = {centre}
    while len(prints) < 1500:
        bits = random.choice(list(prints)) if len(prints) < 40 else centre
        for _ in range(random.randint(1, 3)):
            bits ^= 1 << random.randrange(64)
        prints.add(bits)
    prints |= {random.getrandbits(64) for _ in range(300)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "print bigint")
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3]
    want = naive_components(near, prints)
    for most in (64, 2048):
        links = simhash.links(df, 3, most).collect()
        got = naive_components([(unsigned(r["a"]), unsigned(r["b"])) for r in links], prints)
        assert all((unsigned(r["a"]) ^ unsigned(r["b"])).bit_count() <= 64 for r in links)
        assert got == want


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_planes(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints = base[rng.integers(0, 12, 200)]
    for _ in range(6):
        flip = np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)
        prints = np.where(rng.random(200) < 0.5, prints ^ flip, prints)
    prints = np.unique(prints)
    keys = np.sort(rng.integers(0, 3, len(prints)))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    i, j = simhash.neighbours(prints, keys, radius)
    same = keys[:, None] == keys[None, :]
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*np.nonzero(np.triu(near & same, 1))))
    root = simhash.local_roots(prints, radius, width=16)
    links = list(zip(*map(list, np.nonzero(near))))
    assert dict(enumerate(root.tolist())) == naive_components(links, range(len(prints)))


def test_components(spark):
    random.seed(1)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(200)]
    links += [(i, i + 1) for i in range(1000, 1400)] + [(5000, i) for i in range(6000, 6200)]
    found = components.connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    links = [(a, b) for a, b in links if a != b]
    want = naive_components(links, {n for link in links for n in link})
    assert {r["node"]: r["component"] for r in found} == want
    assert len(found) == len(want)
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components.connected(none).count() == 0


def test_empty_tables(spark):
    none = tables.odd(spark, [])
    assert simhash.groups(none).count() == 0
    assert simhash.representatives(none).count() == 0
    assert line_dedup.deduplicated(none).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embedding_dedup.linked(vectors).count() == 0


def duck_on(tmp_path, df, name, query):
    df.coalesce(1).write.parquet(str(tmp_path / "t"))
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/t/*.parquet'")
    return duck_rows(con, query)


def test_sentences_odd(spark, tmp_path):
    """Rows whose text has no control sign, which the SQL uses as its marker."""
    rows = [r for r in tables.ROWS if r[0] != 14]
    df = tables.odd(spark, rows)
    out = line_dedup.deduplicated(tables.odd(spark, rows, tables.EXTRA))
    assert out.columns == [*tables.COLUMNS, *tables.EXTRA, "cut"]
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    out = frames.picked(out, doc_id="doc_id", text="text", cut="cut", kept="kept")
    out = out.select("doc_id", "text", F.size("cut").cast("bigint").alias("n_cut"), spans("cut").alias("cut"), spans("kept").alias("kept"))
    assert spark_rows(out) == duck_on(tmp_path, df, "documents", sql.LINE_DEDUP)


def test_sentences_kept_offsets(spark):
    out = line_dedup.deduplicated(tables.odd(spark), min_words=5).collect()
    by_id = {}
    for r in tables.ROWS:
        by_id.setdefault((r[0], len(r[1] or "")), r[1])
    originals = Counter()
    for r in out:
        length = max([s["end"] for s in [*r["kept"], *r["cut"]]], default=0)
        original = by_id.get((r["doc_id"], length))
        if r["text"]:
            assert "".join(original[s["start"] : s["end"]] for s in r["kept"]) == r["text"]
        originals[r["doc_id"]] += 1
    assert originals == Counter(r[0] for r in tables.ROWS)
    text = {r["doc_id"]: r["text"] for r in out if r["doc_id"] in (1, 2, 7)}
    assert text[1] == tables.ROWS[0][1]
    assert text[2] == "And another one that only this has."
    assert text[7] == ""


def test_passage_inside_documents(spark):
    """A passage of over 50 words inside other text is cut from all but the first."""
    random.seed(5)
    word = lambda: "".join(random.choices("abcdefghijkl", k=6))
    sentence = lambda: " ".join(word() for _ in range(12)) + ". "
    passage = "".join(sentence() for _ in range(6))
    rows = [(i, sentence() + passage + sentence(), "en", "a", 1) for i in range(5)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(tables.odd(spark, rows)).collect()}
    assert out[0] == rows[0][1]
    for i in range(1, 5):
        assert passage[:40] not in out[i] and len(out[i]) == len(rows[i][1]) - len(passage)


def test_passage_within_a_sentence(spark):
    """One long sentence inside another: its inner clauses go, offsets stay true."""
    random.seed(8)
    clause = lambda n: " ".join("".join(random.choices("abcdefgh", k=5)) for _ in range(n))
    passage = ", ".join(clause(9) for _ in range(7))
    rows = [(i, f"{clause(6)} {passage} {clause(6)}.", "en", "a", 1) for i in range(3)]
    out = line_dedup.deduplicated(tables.odd(spark, rows)).collect()
    for r in out:
        original = rows[r["doc_id"]][1]
        assert "".join(original[s["start"] : s["end"]] for s in r["kept"]) == r["text"]
        assert (r["text"] == original) == (r["doc_id"] == 0)
        if r["doc_id"]:
            assert len(original.split()) - len(r["text"].split()) == 45


def test_short_lines_and_paragraphs(spark):
    """Repeated lines, and with them paragraphs, go whole, also those of less than five
    words; clauses do in what is left. Offsets stay true, and copies lose all their
    words (a line without any stays)."""
    again = "this one comes back in the middle of a sentence"
    copied = "Short, very short. Yes.\nNo; maybe.\n\nLast one here"
    rows = [
        (1, f"own text of one.\nAll rights reserved\nfoo, {again}, bar\n日本語の文章です。一つだけ", "en", "a", 1),
        (2, f"own text of two.\nALL rights reserved.\n \nbaz, {again}, qux\n日本語の文章です。二つ目も", "en", "a", 1),
        (3, copied, "en", "a", 1),
        (4, copied, "en", "a", 1),
        (5, "  \nonly line\n\n", "en", "a", 1),
        (None, "tiny", "en", "a", 1),
        (None, "tiny", "en", "a", 1),
        (6, None, "en", "a", 1),
        (7, "one two\none two\n", "en", "a", 1),
    ]
    out = line_dedup.deduplicated(tables.odd(spark, rows), min_words=5).collect()
    got = {r["doc_id"]: r["text"] for r in out}
    assert got[1] == rows[0][1]
    assert got[2] == "own text of two.\n \nbaz, qux\n二つ目も"
    assert got[3] == copied and got[4] == "\n" and got[5] == rows[4][1]
    assert sorted(r["text"] for r in out if r["doc_id"] is None) == ["", "tiny"]
    assert got[6] is None and got[7] == "one two\n"
    original = dict((r[0], r[1]) for r in rows)
    for r in out:
        text = original[r["doc_id"]] or ""
        assert "".join(text[s["start"] : s["end"]] for s in r["kept"]) == (r["text"] or "")
        spans = sorted((s["start"], s["end"]) for s in [*r["kept"], *r["cut"]])
        assert [a for a, _ in spans] == [0, *(b for _, b in spans)][: len(spans)]


NAN, INF = float("nan"), float("inf")
VECTORS = [
    (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.1, 0.0], 1), (4, [1.0, 0.3, 0.0], 1),
    (5, [1.0, 0.0, 0.0], 2), (6, [1.0, 0.0, 0.0], None), (7, None, 1), (8, [0.0, 0.0, 0.0], 1),
    (9, [NAN, 1.0, 0.0], 1), (10, [INF, 1.0, 0.0], 1), (11, [None, 1.0, 0.0], 1), (12, [1.0, 0.0], 1),
    (13, [], 1), (14, [1.0, 0.0, 0.0], 1), (14, [1.0, 0.0, 0.0], 1), (None, [0.0, 1.0, 0.0], 1),
    (15, [0.0, 1.0, 0.05], 1), (16, [-0.0, 1.0, 0.0], 1), (17, [1e-30, 0.0, 0.0], 1),
]


def test_vectors_odd(spark, tmp_path):
    df = spark.createDataFrame(VECTORS, "vec_id bigint, embedding array<float>, label int")
    found = embedding_dedup.linked(df.withColumn("key", F.lit(1)), most=2)
    found = found.withColumnRenamed("component", "component_id")
    assert spark_rows(found) == duck_on(tmp_path, df, "embeddings", sql.EMBEDDING_DEDUP)


def test_quantised_bound():
    """Pairs at and around the threshold come out as in double precision."""
    rng = np.random.default_rng(0)
    base = rng.normal(size=(40, 64))
    left = np.concatenate([base + rng.normal(size=base.shape) * s for s in (0, 0.1, 0.14, 0.2)])
    right = np.concatenate([base, base * 3, base + 0.14 * rng.normal(size=base.shape)])
    cosine = (left @ right.T) / np.linalg.norm(left, axis=1)[:, None] / np.linalg.norm(right, axis=1)
    for threshold in (0.5, 0.98, 0.99):
        near = embedding_dedup.near_pairs(left, right, threshold)
        sure = np.abs(cosine - threshold) > 1e-12
        assert (near == (cosine >= threshold))[sure].all()
    codes, scale, missed = embedding_dedup.quantised(left)
    units = left / np.linalg.norm(left, axis=1)[:, None]
    assert np.allclose(np.linalg.norm(units - codes * scale[:, None], axis=1), missed)
