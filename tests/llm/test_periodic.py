"""Runs of words against a search over all periods."""

import hashlib
import random
import time
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import tables
from trackside.llm import periodic, queries


def slow_runs(words, least, times):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length, stretch = j - i + q, words[i : j + q]
            if length >= max(least, times * q) and not any(
                all(stretch[k] == stretch[k + d] for k in range(length - d)) for d in range(1, q)
            ):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_lyndon(values):
    out = []
    for i in range(len(values)):
        j = i + 1
        while j < len(values) and values[j:] > values[i:]:
            j += 1
        out.append(j - i)
    return out


VALUES = st.lists(st.integers(0, 3), max_size=60)


@settings(max_examples=300, deadline=None)
@given(VALUES)
def test_lyndon_lengths(values):
    assert periodic.lyndon_lengths(values, 4) == slow_lyndon(values)


@settings(max_examples=300, deadline=None)
@given(VALUES, VALUES, st.integers(1, 9), VALUES, st.sampled_from([(24, 3), (3, 3), (8, 4), (12, 3), (10, 5)]))
def test_runs(front, root, times, back, limits):
    words = [str(v) for v in front[:6] + root[:9] * times + back]
    assert periodic.runs_of(words, *limits) == slow_runs(words, *limits)


def test_two_runs_side_by_side_and_one_inside_another():
    words = ("a " * 30 + "b c d " * 9 + ("x " * 26 + "y ") * 3).split()
    got = periodic.runs_of(words)
    assert got == slow_runs(words, 24, 3) and len(got) == 6


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.runs_of(["a"] * 30, 4, 2)


def test_time_grows_with_the_words():
    """A third of a million words each: all alike, of two kinds at random, of one long period."""
    rng = random.Random(3)
    for words in (["a"] * 300_000, rng.choices("ab", k=300_000), [str(i) for i in range(1000)] * 300):
        start = time.perf_counter()
        periodic.runs_of(words)
        assert time.perf_counter() - start < 40


def altered(words, doc_id):
    import zlib

    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def expected(doc_id, text):
    words = altered((text or "").encode().split(), doc_id)
    runs = slow_runs(words, 24, 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    most = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id,
        len(runs),
        *most,
        1000 * most[1] // most[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_on_odd_tables(spark, tmp_path):
    """NULL, empty and repeated rows, long texts, further columns; ids whose words change."""
    rows = [r for r in tables.ROWS if r[0] != 8]
    rows = [(r[0], r[1][:9000] if r[1] else r[1], *r[2:]) for r in rows]
    rows += [(i, " ".join(f"w{k * k % 17}" for k in range(i)), "en", "a", 1) for i in range(100, 180)]
    tables.odd(spark, rows, tables.EXTRA[1:]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(*r[:2]) for r in rows), key=repr)
    assert sum(r["n_runs"] > 0 for r in got) > 5


def test_empty_table(spark, tmp_path):
    tables.odd(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.periodic_runs(spark, str(tmp_path)).collect() == []


def test_text_and_runs(spark):
    df = spark.createDataFrame([("a b " * 12 + "c",), (None,)], "text string")
    got = [r[0] for r in df.select(periodic.found(F.col("text"))).collect()]
    assert [tuple(r) for r in got[0]["runs"]] == [(0, 24, 2)] and got[0]["collapsed"] == "a b c"
    assert got[1]["runs"] == [] and got[1]["strongest"] is None and got[1]["collapsed"] == ""
