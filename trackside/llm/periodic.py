"""Stretches of words that repeat with a period (runs), found and collapsed.

A run is a maximal stretch of words with a smallest period that goes into it often
enough. Every run has a Lyndon root under the order of the words or under its
reverse: the longest Lyndon word that begins at some place of the run is one
period long. So the runs are read off the two Lyndon arrays. These come from the
first phase of Baier's suffix sorting, which groups the suffixes by the Lyndon word
they begin with and never has to sort them; each root is then extended both ways
by longest common extensions.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

LEAST = 24
TIMES = 3
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_lengths(values: list[int], kinds: int) -> list[int]:
    """How long the longest Lyndon word at each place is; `values` lie in 0 to
    `kinds` - 1, and the end is less than all.

    Suffixes start out grouped by their first value and groups are closed from the
    highest down. All suffixes of a group begin with the same Lyndon word u. A place
    whose nearest follower outside closed groups were k suffixes of this group goes
    on with k times u: its word grows by them, and it moves up within its group,
    past those with fewer. Closed places leave a linked list, so the nearest open
    place before one is its neighbour.
    """
    n = len(values)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    after.append(n)  # what stands before the first place points nowhere
    before.append(n - 1)
    length = [1] * n
    group = list(values)
    members: list[list[int]] = [[] for _ in range(kinds)]
    for place, value in enumerate(values):
        members[value].append(place)
    lower, upper = list(range(-1, kinds - 1)), list(range(1, kinds + 1))
    now = kinds - 1
    while now >= 0:
        moved: dict[tuple[int, int], list[int]] = {}
        last, times, size = -1, 0, 0
        for place in members[now]:
            if group[place] != now:
                continue
            size = length[place]
            left, right = before[place], after[place]
            before[right] = left
            after[left] = right
            if left == last:
                times += 1
                continue
            if last >= 0:
                length[last] += times * size
                moved.setdefault((group[last], times), []).append(last)
            last, times = left, 1
        if last >= 0:
            length[last] += times * size
            moved.setdefault((group[last], times), []).append(last)
        members[now] = ()
        # fewer times first, each group right above the one before
        at = -1
        for old, times in sorted(moved) if len(moved) > 1 else moved:
            if old != at:
                at = under = old
            places = moved[old, times]
            new = len(members)
            members.append(places)
            for place in places:
                group[place] = new
            over = upper[under]
            lower.append(under)
            upper.append(over)
            upper[under] = lower[over] = new
            under = new
        now = lower[now]
    return length


class Extensions:
    """Longest common extensions of two places: stretches of 1, 2, 4 and so on values
    have names, equal ones the same, so a length is found bit by bit."""

    def __init__(self, values: np.ndarray):
        self.names = [values.astype(np.int64)]
        span = 1
        while 2 * span <= len(values):
            names = self.names[-1]
            pairs = names[:-span] * (len(values) + 1) + names[span:]
            found, named = np.unique(pairs, return_inverse=True)
            if len(found) == len(pairs):
                break
            self.names.append(named)
            span *= 2

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values from `i` and `j` on (i < j) are equal."""
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            to = j + got
            inside = to < len(names)
            same = names[(i + got)[inside]] == names[to[inside]]
            got[inside] += same.astype(np.int64) << k
        return got

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values up to and without `i` and `j` (i < j) are equal."""
        got = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            at = i - got - (1 << k)
            inside = at >= 0
            same = names[at[inside]] == names[(j - got - (1 << k))[inside]]
            got[inside] += same.astype(np.int64) << k
        return got


def _runs(values: np.ndarray, least: int, times: int) -> np.ndarray:
    """Start, length and period of the runs of whole numbers, in order."""
    kinds, dense = np.unique(values, return_inverse=True)
    n, found, common = len(values), [], None
    for order in (dense, len(kinds) - 1 - dense):
        period = np.array(lyndon_lengths(order.tolist(), len(kinds)), np.int64)
        place = np.arange(n)
        # a run of three periods or more has two whole roots side by side
        twice = place + period < n
        twice[twice] &= period[(place + period)[twice]] == period[twice]
        place, period = place[twice], period[twice]
        if not len(place):
            continue
        common = common or Extensions(dense)
        start = place - common.backward(place, place + period)
        end = place + period + common.forward(place, place + period)
        long = end - start >= np.maximum(least, times * period)
        found.append(np.stack([start, end - start, period], axis=1)[long])
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _stretches(values: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Where runs can lie. In a run of length L >= 2 * period + window - 1, each
    window of that many values stands again one period further or earlier inside
    the run; so a stretch ends where a window stands nowhere else."""
    if len(values) < window:
        return []
    hashed = np.zeros(len(values) - window + 1, np.uint64)
    for k in range(window):  # equal windows hash alike, which is all that is needed
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + values[k : k + len(hashed)].astype(np.uint64)
        hashed ^= hashed >> np.uint64(29)
    order = np.argsort(hashed, kind="stable")
    ordered = hashed[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(hashed) + 2, np.int8)
    again[order[1:][same] + 1] = 1
    again[order[:-1][same] + 1] = 1
    edges = np.flatnonzero(np.diff(again))
    return [(s, e + window - 1) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())]


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of each run of `words`, by start and period:
    at least `least` words and `times` (3 or more) periods long."""
    if times < 3:
        raise ValueError("a run holds its period three times at least")
    if len(words) < least:
        return []
    names = dict(zip(dict.fromkeys(words), count()))
    values = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    found = []
    for start, end in _stretches(values, 1 + least * (times - 2) // times):
        if end - start >= least:
            for s, length, period in _runs(values[start:end], least, times).tolist():
                found.append((s + start, length, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """`words` without those that any run holds after its first period."""
    if not runs:
        return words
    over = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        over[start + period] += 1
        over[start + length] -= 1
    keep = np.cumsum(over)[:-1] == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run that holds its period most often; of several the first, then the one
    with the shorter period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def found(text: Column, least: int = LEAST, times: int = TIMES) -> Column:
    """The runs in the words of a text, and the text without their repetitions.

    Words are what blanks (space, tab, line and page ends) separate, numbered from
    0. A struct of `runs` (start, length, period in words), the `strongest` of them
    (NULL without a run) and `collapsed`, the kept words joined by one space. A NULL
    or empty text has no word, no run and an empty `collapsed`; repeated rows get
    the same result each, an empty table an empty one. Texts are whole, of any
    length: time grows as n log n with the words, and with them alone.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def listed(all_runs: list) -> pa.StructArray:
        columns = np.array(all_runs, np.int64).reshape(-1, 3).T
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(run))

    @F.arrow_udf(f"struct<runs:{RUNS},strongest:struct<start:bigint,length:bigint,period:bigint>,collapsed:string>")
    def search(texts: pa.Array) -> pa.Array:
        sizes, every, best, kept = [0], [], [], []
        for text in texts:
            words = (text.as_py() or "").encode().split()  # at ASCII blanks
            runs = runs_of(words, least, times)
            every += runs
            sizes.append(len(every))
            most = strongest(runs)
            best.append(dict(zip(("start", "length", "period"), most)) if most else None)
            kept.append(b" ".join(collapsed(words, runs)))
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), listed(every)),
                pa.array(best, run),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["runs", "strongest", "collapsed"],
        )

    return search(text)


def digest(runs: Column) -> Column:
    """sha256 of the runs, a line `start,length,period` each."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return F.sha2(F.array_join(F.transform(runs, line), ""), 256)


def made_periodic(text: Column, doc_id: Column) -> Column:
    """The words of a text; where ten divides the id's crc32 h, periodic from some word
    on. With n words and g = h div 10, word i >= a = g mod n becomes word
    a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8)."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), changed).otherwise(text)
