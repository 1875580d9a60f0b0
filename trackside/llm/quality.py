"""A quality classifier from trusted positives and unlabelled text.

Non-negative positive-unlabelled learning: the risk is written with positives,
unlabelled texts and the class prior alone; where the part that stands for the
negatives goes below zero, the step goes against it. The prior is estimated from
how seldom unlabelled texts score where positives do.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackside.llm import chars, frames

SAMPLE = 20_000  # positives and as many unlabelled texts to fit on
BINS = 16
NAMES = (
    "words", "token_length", "symbols", "marks", "digits", "capitals", "stops",
    "distinct_tokens", "distinct_pairs", "distinct_runs", "top_token", "lines", "distinct_lines",
    "letters", "short_tokens",
)


def _mask(signs: str) -> np.ndarray:
    table = np.zeros(128, dtype=bool)
    table[[ord(c) for c in signs]] = True
    return table


_SYMBOLS, _MARKS, _STOPS = _mask("#*$%&|<>"), _mask("!?"), _mask(".,;:")
_DIGITS, _SPACES = _mask("0123456789"), _mask(" \t\n\x0b\f\r")


def _distinct(doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """How many different values each text has, over how many it has."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    all_of = np.bincount(doc, minlength=n_docs)
    return np.bincount(doc[new], minlength=n_docs) / np.maximum(1, all_of)


def _top(doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """The share of each text's most frequent value."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    edge = np.ones(len(doc), dtype=bool)
    edge[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(edge)
    size = np.diff(np.append(at, len(doc)))
    most = np.zeros(n_docs)
    np.maximum.at(most, doc[at], size)
    return most / np.maximum(1, np.bincount(doc, minlength=n_docs))


def _runs(values: np.ndarray, docs: np.ndarray, n: int):
    """Hashes of n values in a row, within a text."""
    if len(values) < n:
        return values[:0], docs[:0]
    hashed = np.zeros(len(values) - n + 1, dtype=np.uint64)
    for k in range(n):
        hashed = (hashed ^ values[k : len(values) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    inside = docs[: len(hashed)] == docs[n - 1 :]
    return hashed[inside], docs[: len(hashed)][inside]


def _pieces(scan: chars.Scan, space: np.ndarray):
    """Start, size, hash and text of the runs where `space` is false."""
    edge = np.diff((~space).astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64), none
    inside = np.flatnonzero(~space)
    first = np.cumsum(end - start) - (end - start)
    place = np.arange(len(inside)) - np.repeat(first, end - start)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, dtype=np.uint64))
        mixed = scan.codes[inside].astype(np.uint64) * power[place % 256] * (place // 256 + 1).astype(np.uint64)
        hashed = np.add.reduceat(mixed, first)
    hashed ^= hashed >> np.uint64(31)
    return start, end - start, hashed, scan.doc_of(start)


def features(texts: list) -> np.ndarray:
    """A row of statistics per text; NULL counts as empty, which is all zeros."""
    scan = chars.Scan(texts)
    n = len(texts)
    small = np.minimum(scan.codes, 127)
    ascii_ = scan.codes < 127
    doc = np.repeat(np.arange(n), scan.sizes + 1)
    total = lambda mask: np.bincount(doc[mask], minlength=n).astype(float)
    space = _SPACES[small] & ascii_
    start, size, hashed, token_doc = _pieces(scan, space)
    tokens = np.bincount(token_doc, minlength=n).astype(float)
    body = np.bincount(token_doc, weights=size, minlength=n)
    letters = total(scan.letter)
    _, _, line_hash, line_doc = _pieces(scan, scan.codes == 10)
    lines = np.bincount(line_doc, minlength=n)
    some, solid = np.maximum(1, tokens), np.maximum(1, body)
    pair_hash, pair_doc = _runs(hashed, token_doc, 2)
    run_hash, run_doc = _runs(hashed, token_doc, 5)
    columns = [
        np.log1p(tokens),
        body / some,
        total(_SYMBOLS[small] & ascii_) / some,
        total(_MARKS[small] & ascii_) / some,
        total(_DIGITS[small] & ascii_) / solid,
        total(scan.letter & (scan.low != scan.codes)) / np.maximum(1, letters),
        total(_STOPS[small] & ascii_) / some,
        _distinct(token_doc, hashed, n),
        _distinct(pair_doc, pair_hash, n),
        _distinct(run_doc, run_hash, n),
        _top(token_doc, hashed, n),
        tokens / np.maximum(1, lines),
        _distinct(line_doc, line_hash, n),
        letters / solid,
        np.bincount(token_doc[size == 1], minlength=n) / some,
    ]
    return np.stack(columns, axis=1)


def _features_of(texts: list) -> np.ndarray:
    parts = [features(texts[i:j]) for i, j in chars.chunks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))


@dataclass
class Model:
    """A weight per bin of each statistic: `edges` part the bins, `weights` has a
    row per statistic. `prior`: the estimated share of positives."""

    edges: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack(
            [np.searchsorted(e, rows[:, k], side="right") for k, e in enumerate(self.edges)], axis=1
        )

    def logits(self, rows: np.ndarray) -> np.ndarray:
        bins = self.bins(rows)
        return self.bias + self.weights[np.arange(bins.shape[1]), bins].sum(1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _risk_steps(pos, unl, prior: float, shape, steps: int, penalty: float, correct: bool):
    """Weights that minimise the positive-unlabelled logistic risk, by Adam over
    all rows. `pos`, `unl`: bins. With `correct`, a step goes against the
    negatives' part while that is below zero."""
    weights, bias = np.zeros(shape), 0.0
    first, second = np.zeros(weights.size + 1), np.zeros(weights.size + 1)
    columns = np.arange(shape[0])

    def slope(bins, pull):
        out = np.zeros(weights.size + 1)
        flat = bins + columns * shape[1]
        out[:-1] = np.bincount(
            flat.ravel(), np.repeat(pull, shape[0]), minlength=weights.size
        )
        out[-1] = pull.sum()
        return out

    for step in range(1, steps + 1):
        at_pos = bias + weights[columns, pos].sum(1)
        at_unl = bias + weights[columns, unl].sum(1)
        negative = np.logaddexp(0, at_unl).mean() - prior * np.logaddexp(0, at_pos).mean()
        as_negative = slope(unl, _sigmoid(at_unl) / len(unl)) - slope(
            pos, prior * _sigmoid(at_pos) / len(pos)
        )
        if correct and negative < 0:
            pull = -as_negative
        else:
            pull = as_negative + slope(pos, -prior * _sigmoid(-at_pos) / len(pos))
            pull[:-1] += penalty * weights.ravel()
        first = 0.9 * first + 0.1 * pull
        second = 0.999 * second + 0.001 * pull**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1].reshape(shape)
        bias -= move[-1]
    return weights, bias


def estimated_prior(at_pos: np.ndarray, at_unl: np.ndarray, sure: float = 0.1) -> float:
    """The share of positives among unlabelled scores: the least ratio of the two
    tails above a threshold, with a bound for chance (best bin estimate)."""
    cuts = np.unique(np.concatenate((at_pos, at_unl)))
    q_pos = 1 - np.searchsorted(np.sort(at_pos), cuts, side="left") / len(at_pos)
    q_unl = 1 - np.searchsorted(np.sort(at_unl), cuts, side="left") / len(at_unl)
    slack = np.sqrt(np.log(4 / sure) / 2)
    some = q_pos > 0
    bound = (q_unl + slack / np.sqrt(len(at_unl)) + q_pos * slack / np.sqrt(len(at_pos))) / np.where(
        some, q_pos, 1
    )
    best = np.flatnonzero(some)[bound[some].argmin()]
    return float(np.clip(q_unl[best] / q_pos[best], 0.01, 0.99))


def fit_rows(pos: np.ndarray, unl: np.ndarray, bins: int = BINS, steps: int = 400) -> Model:
    """The model out of statistics of positives and of unlabelled texts."""
    n = pos.shape[1]
    shares = np.arange(1, bins) / bins
    both = np.concatenate((np.quantile(pos, shares, axis=0), np.quantile(unl, shares, axis=0)))
    edges = np.sort(both, axis=0).T
    model = Model(edges, np.zeros((n, edges.shape[1] + 1)), 0.0, 0.5)
    bin_pos, bin_unl = model.bins(pos), model.bins(unl)
    shape, half = model.weights.shape, (len(pos) // 2, len(unl) // 2)
    # positives told from unlabelled on one half, the tails compared on the other
    plain, bias = _risk_steps(bin_pos[: half[0]], bin_unl[: half[1]], 0.5, shape, 150, 1e-4, True)
    columns = np.arange(n)
    model.prior = estimated_prior(
        bias + plain[columns, bin_pos[half[0] :]].sum(1),
        bias + plain[columns, bin_unl[half[1] :]].sum(1),
    )
    model.weights, model.bias = _risk_steps(
        bin_pos, bin_unl, model.prior, shape, steps, 1e-4, True
    )
    return model


def _rows(texts: DataFrame) -> np.ndarray:
    """The statistics of a bounded number of texts (columns `id` and `text`), on the
    driver, by id and then a hash of the text: the same order in every run."""

    def count(batches):
        for batch in batches:
            rows = _features_of(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(rows[:, k]) for k in range(len(NAMES)))], ["id", "place", *NAMES]
            )

    placed = texts.select("id", F.xxhash64("text").alias("place"), "text")
    kind = dict(placed.dtypes)["id"]
    schema = ", ".join([f"id {kind}", "place bigint", *(f"{name} double" for name in NAMES)])
    table = placed.mapInArrow(count, schema).toArrow().sort_by([("id", "ascending"), ("place", "ascending")])
    return np.stack([table.column(name).to_numpy() for name in NAMES], axis=1)


def fit(
    docs: DataFrame,
    positives: DataFrame,
    most: int = SAMPLE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model | None:
    """The model for `positives` (id; bounded) against about `most` different rows
    (id and text) of all `docs`, taken without their labels. None with fewer than ten of either, when every
    text is as likely good as not."""
    pos = _rows(frames.texts_of(docs, positives.select("id", F.lit(1).alias("label")), doc_id, text))
    unl = _rows(frames.about(frames.picked(docs, id=doc_id, text=text), most))
    if len(pos) < 10 or len(unl) < 10:
        return None
    return fit_rows(pos, unl)


def score(text: Column, model: Model | None) -> Column:
    """The probability that a text is good, 0 to 1; NULL and empty texts get one as
    well, and 0.5 is it for all without a model."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        if model is None:
            return pa.array([0.5] * len(texts))
        return pa.array(_sigmoid(model.logits(_features_of(texts.to_pylist()))))

    return scored(text)


def kept(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    least: float = 0.7,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of `docs` that score `least` or more, as they are; all rows if there
    are too few good ones to learn from. `train`: which ids may lend their label."""
    model = fit(docs, trusted(labels, train), doc_id=doc_id, text=text)
    if model is None:
        return docs
    rows = frames.packed(docs, text=text).withColumn("score", score(F.col("text"), model))
    return frames.unpacked(rows.where(F.col("score") >= least), docs.columns)


def trusted(labels: DataFrame, train: Column, most: int = SAMPLE) -> DataFrame:
    """About `most` ids labelled as good, or all."""
    good = frames.picked(labels, doc_id="doc_id", quality="quality").where("quality = 1")
    return frames.labelled_sample(good, "quality", train, most).select("id")
