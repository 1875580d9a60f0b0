"""Toxicity of restored text: a noisy channel undone by Viterbi, then scored.

Words with signs for letters, letters drawn out or spaced apart become a lattice
of the characters they may stand for; a character trigram model learnt from all
documents picks the likeliest reading. A logistic model over the words and word
beginnings of the restored text gives the score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackside.llm import chars, frames
from trackside.sources import tables

SAMPLE = 20_000  # labelled documents to fit on
FEATURES = 1 << 20  # hashed words and beginnings of words
PREFIXES = range(3, 9)
SELECTED = 4096
REMEMBERED = 1 << 18  # trigrams and tokens that a worker remembers
SURE_G2 = 30.0  # weaker features are penalised more

#: Letters that a sign may stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
BETWEEN = " .-_*,"
SIGN_COST, DROP_COST, DOUBLE_COST, RUN_COST, JOIN_COST, BREAK_COST = 1.0, 10.0, 3.0, 0.5, 0.5, 2.0
KEEP_COST = {"!": 2.0}  # of a sign that ends a word and is no letter; others:
KEEP_OTHER = 5.0


# -- the character model ------------------------------------------------------


def _count(batches):
    grams = np.zeros(2 * chars.BUCKETS, dtype=np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for i, j in chars.chunks(texts):
            hashed, context = chars.Scan(texts[i:j]).trigrams(contexts=True)
            grams[: chars.BUCKETS] += np.bincount(hashed, minlength=chars.BUCKETS)
            grams[chars.BUCKETS :] += np.bincount(context, minlength=chars.BUCKETS)
    at = np.flatnonzero(grams)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), pa.array(grams[at], pa.int64())], ["bucket", "n"]
    )


@dataclass
class CharModel:
    """Counts of trigrams and of their first two characters, by hash bucket."""

    grams: np.ndarray
    contexts: np.ndarray
    logs: dict[int, float] = field(default_factory=dict, repr=False, compare=False)
    counts: dict[int, bool] = field(default_factory=dict, repr=False, compare=False)

    def logp(self, two: int, one: int, now: int) -> float:
        key = (two << 42) | (one << 21) | now
        found = self.logs.get(key)
        if found is None:
            if len(self.logs) >= REMEMBERED:
                self.logs.clear()
            n = self.grams[chars.trigram_hash(two, one, now)]
            of = self.contexts[chars.trigram_hash(two, one, chars.CONTEXT)]
            found = self.logs[key] = log((n + 0.05) / (of + 2.0))
        return found

    def counted(self, two: int, one: int, now: int) -> bool:
        """Whether the trigram stands in any document."""
        key = (two << 42) | (one << 21) | now
        found = self.counts.get(key)
        if found is None:
            if len(self.counts) >= REMEMBERED:
                self.counts.clear()
            found = self.counts[key] = bool(self.grams[chars.trigram_hash(two, one, now)])
        return found


def character_model(docs: DataFrame, text: str = "text") -> CharModel:
    """Trigram counts over the words of all documents, in lower case. The driver
    gets at most a number per bucket, whatever the input."""
    counted = (
        frames.picked(docs, text=text)
        .where("text is not null")
        .mapInArrow(_count, "bucket int, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    table = np.zeros(2 * chars.BUCKETS)
    table[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    return CharModel(table[: chars.BUCKETS], table[chars.BUCKETS :])


# -- restoring ------------------------------------------------------------------

_RUNS = re.compile(r"(.)\1*", re.DOTALL)


def _readings(sign: str, n: int) -> list[tuple[str, float]]:
    """What a run of n equal characters may stand for, and at what cost."""
    if sign.isalpha():
        if n == 1:
            return [(sign, 0.0)]
        if n == 2:
            return [(sign * 2, 0.0), (sign, DOUBLE_COST)]
        return [(sign, RUN_COST), (sign * 2, RUN_COST)]
    if sign in SIGNS:
        letters = [(x * k, SIGN_COST + RUN_COST * (n > k)) for x in SIGNS[sign] for k in (1, 2) if k <= n]
        return [*letters, ("", DROP_COST)]
    if sign in BETWEEN:
        return [("", JOIN_COST), (" ", BREAK_COST)]
    return [(" ", 0.0)]


def _best(token: str, model: CharModel) -> tuple[float, str]:
    """Score and text of the likeliest reading of `token`: Viterbi over its lattice,
    the state being the last two characters. Of equal readings the first in order
    of the lattice."""
    space = chars.SPACE
    best = {(space, space): (0.0, None)}
    steps = []
    for run in [*(m.group() for m in _RUNS.finditer(token.lower())), None]:
        options = [(" ", 0.0)] if run is None else _readings(run[0], len(run))
        after: dict = {}
        for (two, one), (score, _) in best.items():
            for out, cost in options:
                state, total = (two, one), score - cost
                for c in out:
                    code = ord(c)
                    if code == space and state[1] == space:
                        continue
                    total += model.logp(*state, code)
                    state = (space, space) if code == space else (state[1], code)
                if state not in after or total > after[state][0]:
                    after[state] = (total, ((two, one), out))
        steps.append(after)
        best = after
    state = max(best, key=lambda s: best[s][0])
    total, parts = best[state][0], []
    for after in reversed(steps):
        state, out = after[state][1]
        parts.append(out)
    return total, "".join(reversed(parts)).strip()


def restored(token: str, model: CharModel) -> str:
    """The likeliest reading of `token`."""
    return _best(token, model)[1]


_TAIL = re.compile(r"[@$!|+€]+$")
_LETTERS = re.compile(r"[^\W\d_]+")


def _known(text: str, model: CharModel) -> bool:
    """Whether all trigrams of the text's words were counted."""
    for word in _LETTERS.findall(text):
        two = one = chars.SPACE
        for code in [*map(ord, word), chars.SPACE]:
            if not model.counted(two, one, code):
                return False
            two, one = one, code
    return True


def checked(token: str, model: CharModel) -> str:
    """As `restored`, for tokens that may as well be plain: one whose reading has the
    same words, or trigrams that were never counted, stays as written. Signs at the
    end are letters only if that reading beats the one that ends before them."""
    i, j = 0, len(token)
    while i < j and not (token[i].isalpha() or token[i] in SIGNS):
        i += 1
    while i < j and not (token[j - 1].isalpha() or token[j - 1] in SIGNS):
        j -= 1
    inner, tail = token[i:j], _TAIL.search(token[i:j])
    total, reading = _best(inner, model)
    if tail:
        cost = sum(KEEP_COST.get(m.group()[0], KEEP_OTHER) for m in _RUNS.finditer(tail.group()))
        plain, without = _best(inner[: tail.start()], model)
        if plain - cost >= total or not _known(reading, model):
            inner, reading, j = inner[: tail.start()], without, i + tail.start()
    if not _known(reading, model) or _LETTERS.findall(reading) == _LETTERS.findall(inner.lower()):
        return token
    return token[:i] + reading + token[j:]


def _signs(codes: np.ndarray) -> np.ndarray:
    sign = np.zeros(128, dtype=bool)
    sign[[ord(c) for c in SIGNS if ord(c) < 128]] = True
    return sign[np.minimum(codes, 127)] & (codes < 127) | (codes == ord("€"))


def _marks(scan: chars.Scan) -> np.ndarray:
    """Places in texts that look disguised."""
    letter, codes = scan.letter, scan.codes
    after = np.append(letter[1:], False)
    before = np.concatenate(([False], letter[:-1]))
    signs = _signs(codes)
    digit = (codes >= 48) & (codes <= 57)
    odd = signs & after | digit & before
    low = scan.low
    odd[2:] |= letter[2:] & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
    return np.flatnonzero(odd)


def _maybe(scan: chars.Scan) -> tuple[np.ndarray, np.ndarray]:
    """Places in tokens that may be disguised or plain: signs after a letter, and
    what is not a blank between letters or signs; and the first of two equal letters."""
    letter, signs = scan.letter, _signs(scan.codes)
    either = letter | signs
    between = np.isin(scan.codes, [ord(c) for c in BETWEEN if c != " "])
    odd = signs.copy()
    odd[0], odd[1:] = False, signs[1:] & letter[:-1]
    odd[1:-1] |= between[1:-1] & either[:-2] & either[2:] & (letter[:-2] | letter[2:])
    double = letter[:-1] & letter[1:] & (scan.low[:-1] == scan.low[1:])
    return np.flatnonzero(odd), np.flatnonzero(double)


def _spaced(scan: chars.Scan) -> list[tuple[int, int, bool]]:
    """Runs of three or more single letters or signs with separators between them,
    one letter at least, not all equal; and whether they can only be a disguise:
    letters alone, each one sign apart."""
    either = scan.letter | _signs(scan.codes)
    beside = np.zeros(len(either), dtype=bool)
    beside[1:] |= either[:-1]
    beside[:-1] |= either[1:]
    at = np.flatnonzero(either & ~beside)
    if len(at) < 3:
        return []
    gap = np.cumsum(np.isin(scan.codes, [ord(c) for c in BETWEEN]))
    linked = gap[at[1:] - 1] - gap[at[:-1]] == np.diff(at) - 1
    edge = np.diff(linked.astype(np.int8), prepend=0, append=0)
    out = []
    for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        run = at[i : j + 1]
        low, letters = scan.low[run], scan.letter[run]
        if j - i >= 2 and letters.any() and (low != low[0]).any():
            sure = letters.all() and run[-1] - run[0] == 2 * (j - i)
            out.append((int(run[0]), int(run[-1]) + 1, bool(sure)))
    return out


def _token_bounds(text: str, at: int) -> tuple[int, int]:
    i, j = at, at
    while i > 0 and not text[i - 1].isspace():
        i -= 1
    while j < len(text) and not text[j].isspace():
        j += 1
    return i, j


def restore_batch(texts: list, model: CharModel, read) -> list[str]:
    """The texts with their disguised tokens read; `read` maps a token, and whether
    it can only be a disguise, to its reading."""
    scan = chars.Scan(texts)
    found: dict[int, list] = {}
    for s, e, sure in _spaced(scan):
        d = int(np.searchsorted(scan.starts, s, side="right") - 1)
        found.setdefault(d, []).append((s - int(scan.starts[d]), e - int(scan.starts[d]), sure))
    maybe, double = _maybe(scan)
    marked = set()
    for places, sure in ((_marks(scan), True), (maybe, False)):
        end = -1
        for d, at in zip(scan.doc_of(places).tolist(), places.tolist()):
            if at < end:
                continue
            origin = int(scan.starts[d])
            s, e = _token_bounds(texts[d], at - origin)
            end = origin + e
            if end not in marked:
                marked.add(end)
                found.setdefault(d, []).append((s, e, sure))
    words = np.unique(np.searchsorted(scan.word_start, double, side="right") - 1)
    for d, s, e in zip(*(x[words].tolist() for x in (scan.word_doc, scan.word_start, scan.word_end))):
        origin = int(scan.starts[d])
        found.setdefault(d, []).append((s - origin, e - origin, False))
    out = [t or "" for t in texts]
    for d, own in found.items():
        parts, at = [], 0
        # of two at one place the longer, of two equal ones the sure one
        for s, e, sure in sorted(own, key=lambda x: (x[0], -x[1], not x[2])):
            if s >= at:
                parts += [out[d][at:s], read(out[d][s:e], sure)]
                at = e
        out[d] = "".join([*parts, out[d][at:]])
    return out


_READERS: dict = {}


def _reader(model: CharModel):
    """`restored`, or `checked` if not sure, with a memory of short tokens. A worker keeps
    that of the last model from task to task."""
    key = hash((model.grams.tobytes(), model.contexts.tobytes()))
    if key not in _READERS:
        every = lambda token, sure=True: (restored if sure else checked)(token, model)
        short = lru_cache(REMEMBERED)(every)
        _READERS.clear()
        _READERS[key] = lambda token, sure=True: (short if len(token) <= 64 else every)(token, sure)
    return _READERS[key]


# -- the score ------------------------------------------------------------------


def _features(scan: chars.Scan) -> tuple[np.ndarray, np.ndarray]:
    """Text and hashed feature of every word and of its beginnings."""
    start, size = scan.word_start, scan.word_end - scan.word_start
    prime = np.uint32(16777619)
    hashed = np.full(len(start), 2166136261, dtype=np.uint32)
    docs, out = [], []

    def add(mask, value, kind):
        mixed = (value ^ np.uint32(kind * 2654435761 & 0xFFFFFFFF)) * np.uint32(2246822519)
        docs.append(scan.word_doc[mask])
        out.append((mixed ^ (mixed >> np.uint32(15)))[mask] % np.uint32(FEATURES))

    long = np.arange(len(start))
    for k in range(int(size.max(initial=0))):
        long = long[size[long] > k]
        hashed[long] = (hashed[long] ^ scan.low[start[long] + k]) * prime
        if k + 1 in PREFIXES:
            add(long, hashed, k + 1)
    add(slice(None), hashed, 0)
    return np.concatenate(docs), np.concatenate(out).astype(np.int64)


def _restoring(model):
    """Batches of (label, text) with the texts restored."""

    def restore(batches):
        read = _reader(model)
        for batch in batches:
            texts, clear = batch.column(1).to_pylist(), []
            for i, j in chars.chunks(texts):
                clear += restore_batch(texts[i:j], model, read)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(clear, pa.string())], ["label", "text"])

    return restore


def _pairs(batches):
    """Per batch of (label, restored text): label, text number and feature, counted."""
    for batch in batches:
        labels, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
        for i, j in chars.chunks(texts):
            doc, feature = _features(chars.Scan(texts[i:j]))
            key, n = np.unique(doc * FEATURES + feature, return_counts=True)
            yield labels[i:j], key // FEATURES, key % FEATURES, n


@dataclass
class Scorer:
    """`slot`: feature to its place among the weights, or -1."""

    slot: np.ndarray
    weights: np.ndarray
    bias: float


def _frequencies(batches):
    held = np.zeros(2 * FEATURES, dtype=np.int64)
    for labels, doc, feature, _ in _pairs(batches):
        held += np.bincount(feature + FEATURES * labels[doc], minlength=2 * FEATURES)
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(at % FEATURES, pa.int32()),
            pa.array(np.where(at < FEATURES, held[at], 0), pa.int64()),
            pa.array(np.where(at < FEATURES, 0, held[at]), pa.int64()),
        ],
        ["feature", "clean", "toxic"],
    )


def _hits(slot):
    """Per text: label, and the selected features with their counts."""

    def hit(batches):
        for labels, doc, feature, n in _pairs(batches):
            used = slot[feature] >= 0
            at = np.searchsorted(doc[used], np.arange(len(labels) + 1))
            lists = [
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))
                for values in (slot[feature][used], n[used])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.int32()), *lists], ["label", "slots", "counts"]
            )

    return hit


def _g2(clean: Column, toxic: Column, n_clean: int, n_toxic: int) -> Column:
    """Log-likelihood ratio of a feature that is in more of the toxic texts."""
    every = clean + toxic
    share = every / (n_clean + n_toxic)
    part = lambda k, of: F.when(k > 0, k * F.ln(k / (share * of))).otherwise(0.0)
    value = 2 * (part(clean, n_clean) + part(toxic, n_toxic))
    return F.when(toxic / n_toxic > clean / n_clean, value).otherwise(0.0)


def fit(
    docs: DataFrame,
    sample: DataFrame,
    model: CharModel,
    doc_id: str = "doc_id",
    text: str = "text",
    selected: int = SELECTED,
) -> Scorer:
    """A logistic model out of `sample` (id, label 0 or 1; bounded).

    Words and beginnings of words that are in more of the toxic texts are ranked by
    their log-likelihood ratio and the first `selected` taken, however few texts
    they are in; those of weak evidence are scaled down, so that the penalty keeps
    them small beside stronger ones. The model weighs log(1 + count). Without labels of both kinds every score is the toxic share.
    """
    texts = (
        frames.texts_of(docs, sample, doc_id, text)
        .select("label", "text")
        .where("label in (0, 1)")
        .withColumn("text", F.coalesce("text", F.lit("")))
    )
    # restored once for both steps that follow
    rows = tables.written(texts.mapInArrow(_restoring(model), texts.schema), "toxic-sample")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_clean, n_toxic = n.get(0, 0), n.get(1, 0)
    slot = np.full(FEATURES, -1, dtype=np.int32)
    if not n_clean or not n_toxic:
        share = min(max(n_toxic / max(1, n_clean + n_toxic), 1e-3), 1 - 1e-3)
        return Scorer(slot, np.zeros(0), log(share / (1 - share)))
    few = rows.coalesce(8)  # a bounded sample: fewer tasks send fewer partial counts
    best = (
        few.mapInArrow(_frequencies, "feature int, clean bigint, toxic bigint")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("g2", _g2(F.col("clean"), F.col("toxic"), n_clean, n_toxic))
        .where(F.col("g2") > 0)
        .orderBy(F.desc("g2"), "feature")
        .limit(selected)
        .select("feature", "g2")
        .toArrow()
    )
    best, g2 = (best.column(c).to_numpy() for c in ("feature", "g2"))
    scale = np.minimum(1.0, g2 / min(SURE_G2, g2.max(initial=SURE_G2 if not len(g2) else 0.0)))
    slot[best] = np.arange(len(best))
    table = few.mapInArrow(
        _hits(slot), "label int, slots array<int>, counts array<int>"
    ).toArrow()
    return _logistic(table, slot, len(best), scale)


def _scores(slots, counts, sizes, weights, bias) -> np.ndarray:
    """The logit of each text: slots and counts are those of all texts in a row."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    return bias + np.bincount(doc, weights[slots] * np.log1p(counts), minlength=len(sizes))


def _logistic(
    table: pa.Table,
    slot: np.ndarray,
    n_slots: int,
    scale: np.ndarray,
    penalty: float = 1.0,
    steps: int = 500,
) -> Scorer:
    """Logistic regression with a squared penalty, by accelerated gradient steps."""
    label = table.column("label").to_numpy()
    slots, counts = (table.column(c).combine_chunks() for c in ("slots", "counts"))
    sizes = slots.value_lengths().to_numpy()
    slots, counts = slots.flatten().to_numpy(), counts.flatten().to_numpy()
    doc, value = np.repeat(np.arange(len(sizes)), sizes), np.log1p(counts) * scale[slots]
    share = label.mean()
    weights = np.zeros(n_slots)
    bias = ahead_bias = log(share / (1 - share))
    ahead = weights.copy()
    # the loss bends by at most a quarter of the largest squared row, summed up
    column = np.bincount(slots, value, minlength=n_slots)
    row = np.bincount(doc, value, minlength=len(sizes)) + 1
    size = 4.0 / (max((column.max(initial=0), len(sizes))) * row.max() + 4 * penalty)
    size = max(size, 4.0 / (len(sizes) * 50 + 4 * penalty))
    for step in range(steps):
        logit = ahead_bias + np.bincount(doc, ahead[slots] * value, minlength=len(sizes))
        wrong = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - label
        slope = np.bincount(slots, wrong[doc] * value, minlength=n_slots) + penalty * ahead
        moved, moved_bias = ahead - size * slope, ahead_bias - size * wrong.sum()
        pace = step / (step + 3)
        ahead = moved + pace * (moved - weights)
        ahead_bias = moved_bias + pace * (moved_bias - bias)
        weights, bias = moved, moved_bias
    return Scorer(slot, weights * scale, float(bias))


OUT = "struct<score:double,restored:string>"


def score(text: Column, model: CharModel, scorer: Scorer, with_text: bool = True) -> Column:
    """A struct per text: `score` from 0 to 1 and the `restored` text (NULL for a
    NULL text, or without `with_text`). NULL and empty texts get a score as well:
    that of a text without any selected word."""

    @F.arrow_udf(OUT)
    def scored(column: pa.Array) -> pa.Array:
        texts, read = column.to_pylist(), _reader(model)
        out, words = [], []
        for i, j in chars.chunks(texts):
            clear = restore_batch(texts[i:j], model, read)
            if with_text:
                words += [c if t is not None else None for c, t in zip(clear, texts[i:j])]
            doc, feature = _features(chars.Scan(clear))
            place = scorer.slot[feature]
            used = place >= 0
            n_slots = max(1, len(scorer.weights))
            key, n = np.unique(doc[used] * n_slots + place[used], return_counts=True)
            sizes = np.bincount(key // n_slots, minlength=j - i)
            logit = _scores(key % n_slots, n, sizes, scorer.weights, scorer.bias)
            out.append(1 / (1 + np.exp(-np.clip(logit, -40, 40))))
        scores = pa.array(np.concatenate(out) if out else [], pa.float64())
        clear = pa.array(words if with_text else [None] * len(texts), pa.string())
        return pa.StructArray.from_arrays([scores, clear], ["score", "restored"])

    return scored(text)
