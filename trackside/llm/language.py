"""Language spans: scripts narrow the candidates, Viterbi labels the words.

`learn` counts character trigrams per language over all rows it is given.
`label` scores each word under each language that uses the word's script and
finds, per text, the best sequence of languages under a penalty for each switch.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackside.llm import chars, frames

BUCKETS = chars.BUCKETS
SWITCH = 12.0  # nats
NONE = "und"
OUT = "struct<lang:string,score:double,spans:array<struct<start:int,end:int,lang:string>>>"

# First code point, last code point, name of the script.
SCRIPTS = [
    (0x0041, 0x024F, "latin"),
    (0x0370, 0x03FF, "greek"),
    (0x0400, 0x052F, "cyrillic"),
    (0x0530, 0x058F, "armenian"),
    (0x0590, 0x05FF, "hebrew"),
    (0x0600, 0x077F, "arabic"),
    (0x0900, 0x097F, "devanagari"),
    (0x0980, 0x09FF, "bengali"),
    (0x0A00, 0x0A7F, "gurmukhi"),
    (0x0A80, 0x0AFF, "gujarati"),
    (0x0B80, 0x0BFF, "tamil"),
    (0x0C00, 0x0C7F, "telugu"),
    (0x0C80, 0x0CFF, "kannada"),
    (0x0D00, 0x0D7F, "malayalam"),
    (0x0E00, 0x0E7F, "thai"),
    (0x10A0, 0x10FF, "georgian"),
    (0x1100, 0x11FF, "hangul"),
    (0x1E00, 0x1EFF, "latin"),
    (0x1F00, 0x1FFF, "greek"),
    (0x3040, 0x30FF, "kana"),
    (0x3400, 0x9FFF, "han"),
    (0xAC00, 0xD7AF, "hangul"),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for _, _, name in SCRIPTS)]


@cache
def script_table() -> np.ndarray:
    table = np.zeros(chars.TOP, dtype=np.uint8)
    for first, last, name in SCRIPTS:
        table[first : last + 1] = SCRIPT_NAMES.index(name)
    return table


def _scripts(codes: np.ndarray) -> np.ndarray:
    return np.where(
        codes < chars.TOP, script_table()[np.minimum(codes, chars.TOP - 1)], 0
    )


@dataclass
class Model:
    """`logp`: log probability of a trigram bucket by language; `uses`: whether a
    language uses a script; `prior`: log share of the words."""

    langs: list[str]
    logp: np.ndarray
    uses: np.ndarray
    prior: np.ndarray


def _count(batches):
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        by_lang: dict[str, list] = {}
        for text, lang in zip(texts, langs):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, own in by_lang.items():
            total = held.setdefault(
                lang, np.zeros(BUCKETS + len(SCRIPT_NAMES) + 1, dtype=np.int64)
            )
            for i, j in chars.chunks(own):
                scan = chars.Scan(own[i:j])
                hashed, _ = scan.trigrams()
                total[:BUCKETS] += np.bincount(hashed, minlength=BUCKETS)
                total[BUCKETS:-1] += np.bincount(
                    _scripts(scan.codes[scan.letter]), minlength=len(SCRIPT_NAMES)
                )
                total[-1] += len(scan.word_start)
    for lang, total in held.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(at), pa.string()),
                pa.array(at, pa.int32()),
                pa.array(total[at], pa.int64()),
            ],
            ["lang", "bucket", "n"],
        )


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", smooth: float = 0.1) -> Model:
    """Trigram counts per language over all rows with a text and a language.

    What comes to the driver is at most BUCKETS numbers per language, whatever
    the input. A language uses a script that holds at least 1 % of its letters.
    An empty table gives a model without languages.
    """
    rows = frames.picked(docs, text=text, lang=lang).where("text is not null and lang is not null")
    counted = (
        rows.mapInArrow(_count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = counted.column("lang").to_numpy(zero_copy_only=False)
    langs = sorted(set(names))
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES) + 1, len(langs)))
    of = np.searchsorted(np.array(langs, dtype=object), names) if langs else names
    if langs:
        table[counted.column("bucket").to_numpy(), of.astype(int)] = counted.column("n").to_numpy()
    grams, script, words = table[:BUCKETS], table[BUCKETS:-1], table[-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        logp = np.log((grams + smooth) / (grams.sum(0) + smooth * BUCKETS))
        uses = script >= np.maximum(1, 0.01 * script.sum(0))
        prior = np.log((words + 1) / (words.sum() + len(langs)))
    return Model(langs, logp.astype(np.float32), uses, prior.astype(np.float32))


def best_path(
    scores: np.ndarray, first: np.ndarray, sizes: np.ndarray, prior: np.ndarray, switch: float
) -> np.ndarray:
    """The best state of each row of `scores`, for many sequences at once.

    Sequence i has ``sizes[i]`` rows from ``first[i]``. A change of state costs
    `switch`; of equal paths the one that stays wins, then the smaller state.
    """
    kind = np.uint8 if scores.shape[1] < 256 else np.uint16
    back = np.zeros(scores.shape, dtype=kind)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    steps = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(steps), side="left")
    now = np.zeros((len(sizes), scores.shape[1]), dtype=np.float32)
    states = np.arange(scores.shape[1], dtype=kind)
    for t in range(steps):
        n = live[t]
        at = first[:n] + t
        if t == 0:
            now[:n] = scores[at] + prior
            continue
        held = now[:n]
        top = held.argmax(1)
        moved = held[np.arange(n), top][:, None] - np.float32(switch)
        stay = held >= moved
        back[at] = np.where(stay, states, top[:, None])
        now[:n] = np.where(stay, held, moved) + scores[at]
    path = np.zeros(len(scores), dtype=kind)
    state = now.argmax(1)
    for t in range(steps - 1, -1, -1):
        at = first[: live[t]] + t
        path[at] = state[: live[t]]
        if t:
            state[: live[t]] = back[at, state[: live[t]]]
    return path


def _emissions(scan: chars.Scan, model: Model) -> np.ndarray:
    hashed, first = scan.trigrams()
    if not len(first):
        return np.zeros((0, len(model.langs)), dtype=np.float32)
    scores = np.add.reduceat(np.take(model.logp, hashed, axis=0), first, axis=0)
    allowed = model.uses[_scripts(scan.codes[scan.word_start])]
    known = allowed.any(1)
    # a script that no language uses says nothing
    scores[~known] = 0
    scores[known] = np.where(allowed[known], scores[known], -1e4)
    return scores.astype(np.float32)


def _label_batch(texts: list, model: Model, switch: float):
    """Per text: language, score and spans (start, end, language) in order."""
    if not model.langs:
        return [(NONE, 0.0, []) for _ in texts]
    n_langs, out = len(model.langs), []
    most = max(1 << 18, (1 << 26) // n_langs)
    for i, j in chars.chunks(texts, most):
        parts, starts, ends, docs = [], [], [], []
        for k, m in chars.chunks(texts[i:j], max(1 << 14, (1 << 22) // n_langs)):
            scan = chars.Scan(texts[i + k : i + m])
            parts.append(_emissions(scan, model))
            origin = scan.starts[scan.word_doc]
            starts.append((scan.word_start - origin).astype(np.int32))
            ends.append((scan.word_end - origin).astype(np.int32))
            docs.append((scan.word_doc + k).astype(np.int32))
        scores, start, end, doc = (np.concatenate(x) for x in (parts, starts, ends, docs))
        sizes = np.bincount(doc, minlength=j - i)
        del parts, starts, ends, docs
        first = np.cumsum(sizes) - sizes
        path = best_path(scores, first, sizes, model.prior, switch)
        letters = np.bincount(
            doc.astype(np.int64) * n_langs + path, weights=end - start, minlength=(j - i) * n_langs
        ).reshape(j - i, n_langs)
        best, total = letters.argmax(1), letters.sum(1)
        changed = np.ones(len(path), dtype=bool)
        changed[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(changed)
        last = np.append(at[1:], len(path))[: len(at)] - 1
        spans: list[list] = [[] for _ in range(j - i)]
        for d, s, e, p in zip(
            doc[at].tolist(), start[at].tolist(), end[last].tolist(), path[at].tolist()
        ):
            spans[d].append((s, e, model.langs[p]))
        for d in range(j - i):
            if total[d]:
                share = float(letters[d, best[d]] / total[d])
                out.append((model.langs[best[d]], share, spans[d]))
            else:
                out.append((NONE, 0.0, []))
    return out


def label(text: Column, model: Model, switch: float = SWITCH) -> Column:
    """A struct per text: `lang` with the most letters, `score` its share of the
    letters, `spans` of equal language in code points, end exclusive.

    Text that is NULL, empty or without a letter gives `und`, 0.0 and no span, as
    does a model without languages. Of languages with equally many letters the
    first by name wins.
    """
    kind = pa.struct(
        [
            ("lang", pa.string()),
            ("score", pa.float64()),
            (
                "spans",
                pa.list_(
                    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
                ),
            ),
        ]
    )

    @F.arrow_udf(OUT)
    def labelled(texts: pa.Array) -> pa.Array:
        rows = _label_batch(texts.to_pylist(), model, switch)
        return pa.array(
            [
                {
                    "lang": lang,
                    "score": score,
                    "spans": [{"start": s, "end": e, "lang": name} for s, e, name in spans],
                }
                for lang, score, spans in rows
            ],
            kind,
        )

    return labelled(text)
