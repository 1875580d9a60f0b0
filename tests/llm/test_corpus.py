"""SentencePiece against the library, mixing against SQL, and the whole pipeline."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
import tables
from compare import connect, duck_rows, spark_rows
from trackside.llm import chars, frames, mixing, pieces, queries, sql
from trackside.streaming import run

FOLDER = os.environ.get("QUERY_DIR", "/root/testdata/sf0.01")
ODD = [
    "", " ", "  a  b ", "\n\t x", "日本語 テキスト 😀 naïve", "▁▁ a▁b", "a" * 50, "        indented",
    "x\x00y", "<0x0A> <s> </s> <unk>", "İstanbul ﬁ", "́́", "ab" * 300,
]


@pytest.mark.parametrize("name", sql.SQL)
def test_query_against_sql(spark, name):
    got = spark_rows(entry.queries()[name](spark, FOLDER))
    want = duck_rows(connect(FOLDER), entry.oracle_sql()[name])
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    assert not wrong, (len(wrong), wrong[:3])


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14))
    assert queries.QUERIES["pipeline"] is corpus_pipeline.run


# -- pieces -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def words():
    return pieces.vocabulary(pieces.tokenizer())


def library(model):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model)


def split(ids, sizes):
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_merges_like_the_library(spark, words):
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    texts += ODD + [r[1] for r in tables.ROWS if r[1]]
    random.seed(6)
    texts += ["".join(random.choices("etaoin shrdlu ▁é\n.", k=40)) for _ in range(500)]
    own = pieces.Encoder(words)
    assert split(*own.encode(texts)) == library(words.model).encode(texts)
    own.forget()
    assert split(*own.encode(texts[:50])) == library(words.model).encode(texts[:50])


def test_words_walk_side_by_side(words):
    random.seed(8)
    signs = "etaoinshrdlu" * 4 + "ÉéßñЖж日本😀0123456789.,"
    texts = [" ".join("".join(random.choices(signs, k=random.choice([1, 3, 9, 70]))) for _ in range(60)) for _ in range(80)]
    want = library(words.model).encode(texts)
    own = pieces.Encoder(words)
    steps, step = [], own._step
    own._step = lambda node, c: steps.append(c) or step(node, c)
    assert split(*own.encode(texts)) == want
    first = len(steps)
    own.index.clear(), own.forget()
    # unknown words, but no prefix goes a way that was not gone before
    assert split(*own.encode(texts)) == want
    assert len(steps) == first < sum(map(len, texts))
    small = pieces.Encoder(words)
    small.nodes_kept, small.chunk = 40, 500  # the nodes are forgotten time and again
    assert split(*small.encode(texts)) == want


def test_each_word_is_looked_up_once(words):
    own, asked = pieces.Encoder(words), []
    look_up = own._known
    own._known = lambda some: asked.extend(some) or look_up(some)
    texts = ["all of it, all of it ñ 日本 😀 ñ 日本"] * 50 + ODD
    assert split(*own.encode(texts)) == library(words.model).encode(texts)
    assert len(own.index) <= len(asked) <= 2 * len(own.index)  # before and after they are learnt
    # the places give the texts again, whatever their characters
    odd = ["", "▁a▁b▁a", "▁\ud800x▁\ud800x", "▁é▁日本▁😀😀", ""]
    for some in (odd, odd[:2] + odd[3:], [""], []):
        found, of, sizes = own.words(some)
        at = iter(of.tolist())
        assert ["".join(found[next(at)] for _ in range(n)) for n in sizes] == some
        assert len(set(found)) == len(found)


def as_unigram(model):
    """The same pieces with the scores read as log probabilities."""
    # the trainer's settings are field 2, the kind of model field 3 within them
    settings = next(v for n, v in pieces._fields(model) if n == 2)
    old = bytes([3 << 3, pieces.BPE])
    for at in range(len(settings)):
        changed = settings[:at] + bytes([3 << 3, pieces.UNIGRAM]) + settings[at + 2 :]
        if settings[at : at + 2] == old and dict(pieces._fields(changed)).get(3) == pieces.UNIGRAM:
            return model.replace(settings, changed)
    raise AssertionError("no kind of model found")


def test_scores_like_the_library(spark, words, tmp_path):
    path = tmp_path / "unigram.model"
    path.write_bytes(as_unigram(words.model))
    unigram = pieces.vocabulary(str(path))
    assert unigram.kind == pieces.UNIGRAM
    texts = [r["text"][:3000] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
    own, other = pieces.Encoder(unigram), library(unigram.model)
    score = lambda ids: sum(unigram.scores[i] for i in ids)
    for text, got in zip(texts, split(*own.encode(texts))):
        want = other.encode(text)
        assert other.decode(got) == other.decode(want) == text
        # equal scores may have two cuts
        assert got == want or abs(score(got) - score(want)) < 1e-3 * abs(score(want))


@pytest.mark.parametrize("extra", [(), [*tables.EXTRA, "IDS"]])
def test_pieces_odd(spark, words, extra):
    rows = [*tables.ROWS, *((100 + i, t, "en", "a", 1) for i, t in enumerate(ODD))]
    docs = tables.odd(spark, rows, extra)
    out = pieces.with_ids(docs, words)
    assert out.columns == [*(c for c in docs.columns if c != "IDS"), "ids"]
    out = frames.picked(out, doc_id="doc_id", text="text", ids="ids")
    found = out.withColumn("again", pieces.decoded(F.col("ids"), words)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in found) == Counter(r[:2] for r in rows)
    other = library(words.model)
    for r in found:
        if r["text"] is None:
            assert r["ids"] is None and r["again"] is None
        else:
            assert r["ids"] == other.encode(r["text"])
            assert r["again"] == r["text"].replace("▁", " ")
    assert pieces.with_ids(tables.odd(spark, []), words).count() == 0


def test_query_encodes_each_text_once(spark, words):
    got = queries.QUERIES["op8_sentencepiece"](spark, FOLDER)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("encode") == 1  # was two: of the ids, and again of what they decode to
    ids = pieces.encoded(F.col("text"), words)
    # in a step of its own, as Spark then doesn't run it twice
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(100).union(tables.odd(spark)).select("doc_id", "text", ids.alias("ids"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    same = F.col("text").eqNullSafe(pieces.decoded(F.col("ids"), words))
    want = docs.select("doc_id", "ids", same.alias("same_again")).collect()
    both = docs.select("doc_id", pieces.round_trip(F.col("text"), words).alias("f")).select("doc_id", "f.*").collect()
    assert both == want and {r["same_again"] for r in both} == {True, False}


def test_few_texts_are_held_at_once(words):
    texts = pa.array([None, "", "a few words of one text. " * 400, "é" * 9000] * 300 + ["long " * 50_000])
    runs = list(chars.slices(texts, 1 << 18))
    assert pa.concat_arrays(runs).equals(texts) and len(runs) > 20
    assert all(r.nbytes < 1 << 20 or len(r) == 1 for r in runs)
    each = texts.to_pylist()
    assert [r.to_pylist() for r in runs] == [each[i:j] for i, j in chars.chunks(each, 1 << 18)]
    assert list(chars.slices(texts[:0], 9)) == []
    assert [len(r) for r in chars.slices(texts[:2], 9)] == [2]


def test_decoding_odd_ids(spark, words):
    lists = [([],), (None,), ([0, 1, 2],), ([-5, 10**6],), ([words.byte_ids[0xE9]],)]
    df = spark.createDataFrame(lists, "ids array<int>")
    got = [r[0] for r in df.select(pieces.decoded(F.col("ids"), words)).collect()]
    assert got == ["", None, " ⁇ "[1:], "", "�"]


# -- mixing ------------------------------------------------------------------------


def test_mix_odd(spark, tmp_path):
    """Against SQL on rows of which none repeats; repeated rows draw each for itself."""
    rows = [r for r in tables.ROWS if tables.ROWS.count(r) == 1]
    df = tables.odd(spark, rows)
    df.coalesce(1).write.parquet(str(tmp_path / "t"))
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/t/*.parquet'")
    out = mixing.mixed(tables.odd(spark, rows, ["rate", "PLACE", "copies"]))
    assert out.columns == [*tables.COLUMNS, "rate", "copies", "copy", "place"]
    out = out.select(*tables.COLUMNS, F.col("copy").cast("bigint").alias("copy"), "place")
    assert spark_rows(out) == duck_rows(con, sql.MIX_SOURCES)
    assert mixing.mixed(tables.odd(spark, [])).count() == 0
    assert mixing.mixed(tables.odd(spark)).columns == [*tables.COLUMNS, "copy", "place"]


@pytest.mark.parametrize("same", [True, False])
def test_mix_rows_without_ids(spark, same):
    """A source without ids, of equal or different texts, gets its share under any seed,
    and its copies are spread over the partitions."""
    rows = [(None, "a text" if same else f"a text {i:04}", "en", "none", 1) for i in range(3000)]
    rows += [(i, f"text {i:05}", "en", "ids", 1) for i in range(1000)]
    docs = tables.odd(spark, rows)
    rates = {r["source"]: r["rate"] for r in mixing.repetition_rates(docs).collect()}
    for seed in ("mix-1", "s2", "s3", "s4", "s5"):
        out = mixing.mixed(docs, seed=seed).where("source = 'none'")
        with run.setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
            parts = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        want = 3000 * rates["none"]
        assert abs(sum(parts) - want) < 4 * want**0.5
        assert max(parts) < sum(parts) / 3


def test_mix_weights(spark):
    rows = [(i, "x" * 99, "en", "large" if i % 10 else "small", 99) for i in range(20000)]
    docs = tables.odd(spark, rows)
    out = mixing.mixed(docs, weights={"large": 1.0, "small": 1.0})
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["small"] - 10000) < 400 and abs(n["large"] - 10000) < 400
    # Poisson: the variance of the copies is their mean
    small = out.where("source = 'small'").groupBy("doc_id").count()
    wide = docs.where("source = 'small'").join(small, "doc_id", "left").na.fill(0)
    mean, variance = wide.agg(F.avg("count"), F.var_samp("count")).first()
    assert abs(mean - 5) < 0.25 and abs(variance - 5) < 0.8
    again = mixing.mixed(docs.repartition(7), weights={"large": 1.0, "small": 1.0})
    assert again.exceptAll(out).count() == 0 and again.count() == out.count()
    only = mixing.mixed(docs, weights={"small": 2.0})
    assert {r["source"] for r in only.select("source").distinct().collect()} == {"small"}
    assert mixing.mixed(docs, weights={"none": 1.0}).count() == 0


def test_large_rates(spark):
    """Thousands of copies: the tail of the distribution does not run out."""
    rates = spark.createDataFrame([("a", 1.0, 3000.0), ("b", 1.0, 0.0)], "source string, mass double, rate double")
    steps = {r["source"]: r["steps"] for r in mixing.poisson_steps(rates).collect()}
    assert steps["a"][-1] > 1 - 1e-9 and steps["b"][0] == 1.0
    middle = sum(s <= 0.5 for s in steps["a"])
    assert abs(middle - 3000) < 2


# -- pipeline -----------------------------------------------------------------------


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER).cache()
        sizes.append(out.count())
        last = name == corpus_pipeline.STAGES[-1][0]
        assert out.columns == docs.columns + (["ids"] if last else [])
        docs = out
    total = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0.7 * total < sizes[0] < total  # low quality goes
    assert 0.7 * sizes[0] < sizes[1] < sizes[0]  # near copies go
    assert sizes[2] == sizes[1]
    assert 0.7 * sizes[2] < sizes[3] < 1.3 * sizes[2]
    assert sizes[4] == sizes[3]
    text = docs.where("text rlike '[0-9]@mail[0-9].example.com'").count()
    assert text == 0
    whole = corpus_pipeline.run(spark, FOLDER)
    assert whole.exceptAll(docs).count() == 0 and whole.count() == sizes[4]


def test_stages_odd(spark, tmp_path):
    """Every stage takes odd rows, further columns and an empty table."""
    tables.labels(spark, [(1, 1, 0), (None, 1, 0), (6, None, None)]).write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    for docs in (tables.odd(spark, extra=tables.EXTRA), tables.odd(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns[: len(docs.columns)] == docs.columns
            # a mix repeats small sources as often as their weight wants it
            assert name == "mix_sources" or out.count() <= docs.count()
