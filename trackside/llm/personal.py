"""Personal data: fixed patterns, and a semi-Markov conditional random field.

The patterns find what is written in the usual way. The random field scores whole
candidate spans, by what they hold and what stands beside them, and picks the best
sequence of spans and types in each stretch of text that may hold some; it is
learnt from what the patterns find in a sample, partly rewritten in other ways.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trackside.llm import frames

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000  # documents to find examples in
EXAMPLES = 1_500  # stretches to learn from
MAX_ATOMS = 40  # of a span
MAX_DIGITS = 19

# -- the fixed patterns ---------------------------------------------------------

# Possessive forms of the fixed patterns; a match can't be shortened in another
# way, so they find the same and take time in proportion to the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SIGN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_SIGN:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the fixed patterns find, by start, then kind."""
    if not text:
        return []
    found = [(s, 0, e) for s, e in _emails(text)]
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m.group()) if m.end() - m.start() < 40 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


# -- stretches, atoms and span features -------------------------------------------

_NUMBERS = re.compile(r"[+(]{0,2}[0-9](?:[\x20().\-/]{0,3}+[0-9])*+")
_SPELT = re.compile(
    r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?:\x20?[\[(](?:at|@)[\])]\x20?|\x20at\x20|\x20?@\x20?)"
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}){1,8}",
    re.IGNORECASE,
)
_MAYBE_SPELT = re.compile(r"@|[\[(]at[\])]|\bdot\b", re.IGNORECASE)
_ATOMS = re.compile(r"[0-9]+|[A-Za-z]+|\s+|.", re.DOTALL)
_SPELT_AT = re.compile(r"\x20?[\[(](?:at|@)[\])]\x20?|\x20at\x20|\x20?@\x20?", re.IGNORECASE)
_SPELT_DOT = re.compile(r"\x20?[\[(]dot[\])]\x20?|\x20dot\x20", re.IGNORECASE)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_QUAD = re.compile(r"(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})")
_NATIONAL = re.compile(r"\(?\d{3}\)?[\x20.\-/]?\x20?\d{3}[\x20.\-]\d{4}")
_DATE = re.compile(r"(?:19|20)\d\d[-/.]\d\d?[-/.]\d\d?")
_DIALLED = re.compile(r"\+\d{1,3}[\x20.\-/]?[\x20().0-9\-/]+\d")


def stretches(text: str) -> list[tuple[int, int]]:
    """Where spans may lie: runs of digits and what may part them, and what looks
    like an address, merged where they meet."""
    found = []
    if _DIGITS.search(text):
        found += [m.span() for m in _NUMBERS.finditer(text)]
    if _MAYBE_SPELT.search(text):
        found += [m.span() for m in _SPELT.finditer(text)]
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return [(s, e) for s, e in out if e - s >= 6]


SPAN_FEATURES = (
    "any", "digits<7", "digits 7-9", "digits 10-13", "digits 14-15", "digits 16-19", "check digit right",
    "check digit wrong", "quad", "quad shape", "address", "spelt address", "plus", "dialled", "national",
    "letters", "one group", "fours", "mixed parts", "digit close before", "digit close after",
    "letter before", "letter after", "sign before", "ends in a sign", "long", "date",
)


def span_features(text: str, start: int, end: int) -> np.ndarray:
    """What the span holds and what stands beside it, as zeros and ones."""
    span = text[start:end]
    digits = _digits(span)
    n, letters = len(digits), any(c.isalpha() for c in span)
    before, after = text[max(0, start - 2) : start], text[end : end + 2]
    quad = _QUAD.fullmatch(span)
    spelt = _SPELT_DOT.sub(".", _SPELT_AT.sub("@", span)) if letters else ""
    address = bool(letters and _ADDRESS.fullmatch(span))
    groups = re.findall(r"[0-9]+", span)
    parts = {c for c in span if not c.isalnum()}
    plain = not letters
    values = (
        1,
        plain and n < 7,
        plain and 7 <= n <= 9,
        plain and 10 <= n <= 13,
        plain and 14 <= n <= 15,
        plain and 16 <= n <= 19,
        plain and 14 <= n <= 19 and luhn(digits),
        plain and 14 <= n <= 19 and not luhn(digits),
        bool(quad) and all(int(g) <= 255 for g in quad.groups()),
        bool(quad),
        address,
        letters and not address and bool(_ADDRESS.fullmatch(spelt)),
        span[:1] == "+",
        plain and 10 <= n <= 15 and bool(_DIALLED.fullmatch(span)),
        plain and n == 10 and bool(_NATIONAL.fullmatch(span)),
        letters,
        len(groups) == 1,
        len(groups) == 4 and all(len(g) == 4 for g in groups),
        len(parts) > 1,
        before[-1:].isdigit() or (before[-1:] in ("-", ".") and before[:1].isdigit()),
        after[:1].isdigit() or (after[:1] in ("-", ".") and after[1:2].isdigit()),
        before[-1:].isalpha(),
        after[:1].isalpha(),
        before[-1:] in ("+", "@", "_", "%") and before != "",
        not span[-1:].isalnum(),
        end - start > 40,
        bool(_DATE.match(span)),
    )
    return np.array(values, dtype=np.float64)


def _lattice(text: str, start: int, end: int):
    """The atoms' bounds in a stretch, and the candidates: first atom, last atom
    (exclusive) and features. A candidate begins and ends with a letter, a digit or
    an opening sign, and holds at most MAX_ATOMS atoms."""
    bounds = [m.span() for m in _ATOMS.finditer(text, start, end)]
    at, rows = [], []
    for pair, row in _candidates(text, start, end, bounds):
        at.append(pair)
        rows.append(row)
    features = np.array(rows) if rows else np.zeros((0, len(SPAN_FEATURES)))
    return bounds, at, features


def _candidates(text: str, start: int, end: int, bounds: list[tuple[int, int]]):
    """The candidates of a stretch one by one, by where they start."""
    last_sign = max(text.rfind(c, start, end) for c in "@[(")
    for i, (s, _) in enumerate(bounds):
        if not (text[s].isalnum() or text[s] in "+("):
            continue
        digits, letters = 0, False
        for j in range(i, min(len(bounds), i + MAX_ATOMS)):
            a, e = bounds[j]
            if text[a].isdigit():
                digits += e - a
            letters |= text[a].isalpha()
            if not letters and digits > MAX_DIGITS and last_sign < e:
                break
            if text[a].isalnum() and (letters or digits >= 4):
                yield (i, j + 1), span_features(text, s, e)


# -- the random field --------------------------------------------------------------

# labels: 0 is outside, an atom at a time; 1 to 4 are KINDS


@dataclass
class Model:
    """`weights`: span features by kind; `moves`: from one label to the next."""

    weights: np.ndarray
    moves: np.ndarray

    @staticmethod
    def blank() -> Model:
        n = len(KINDS)
        return Model(np.zeros((n, len(SPAN_FEATURES))), np.zeros((n + 1, n + 1)))


def _ending(at, n):
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (_, j) in enumerate(at):
        by_end[j].append(c)
    return by_end


def decoded(text: str, start: int, end: int, model: Model) -> list[tuple[str, int, int]]:
    """The best spans of a stretch. Of equal paths fewer and earlier spans win."""
    bounds = [m.span() for m in _ATOMS.finditer(text, start, end)]
    n, kinds = len(bounds), len(KINDS)
    best = np.full((n + 1, kinds + 1), -np.inf)
    best[0, 0] = 0.0
    from_atom = np.zeros((n + 1, kinds + 1), np.int32)
    from_label = np.zeros((n + 1, kinds + 1), np.int8)
    # candidates that end further on wait; none is longer than MAX_ATOMS
    coming = _candidates(text, start, end, bounds)
    ahead, some = next(coming, None), False
    waiting: dict[int, list] = {}
    for j in range(1, n + 1):
        while ahead is not None and ahead[0][0] < j:
            (i, stop), row = ahead
            waiting.setdefault(stop, []).append((i, model.weights @ row))
            ahead, some = next(coming, None), True
        arrive = best[j - 1] + model.moves[:, 0]
        best[j, 0], from_atom[j, 0], from_label[j, 0] = arrive.max(), j - 1, arrive.argmax()
        for i, scores in waiting.pop(j, ()):
            arrive = best[i][:, None] + model.moves[:, 1:]
            labels = arrive.argmax(axis=0)
            total = arrive[labels, range(kinds)] + scores
            better = np.flatnonzero(total > best[j, 1:])
            best[j, 1 + better] = total[better]
            from_atom[j, 1 + better], from_label[j, 1 + better] = i, labels[better]
    if not some:
        return []
    j, k, out = n, int(best[n].argmax()), []
    while j:
        i, label = int(from_atom[j, k]), int(from_label[j, k])
        if k:
            out.append((KINDS[k - 1], bounds[i][0], bounds[j - 1][1]))
        j, k = i, label
    return out[::-1]


def _slopes(model: Model, lattice, gold: set) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the gold spans of a stretch, and its slopes, by the
    forward and backward sums over all segmentations."""
    bounds, at, features = lattice
    n, labels = len(bounds), len(KINDS) + 1
    scores = features @ model.weights.T
    by_end = _ending(at, n)
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for c, (i, _) in enumerate(at):
        by_start[i].append(c)
    ahead = np.full((n + 1, labels), -np.inf)
    ahead[0, 0] = 0.0
    logsum = lambda x, axis=None: np.logaddexp.reduce(x, axis=axis)
    for j in range(1, n + 1):
        ahead[j, 0] = logsum(ahead[j - 1] + model.moves[:, 0])
        if by_end[j]:
            arrive = np.array([logsum(ahead[at[c][0]][:, None] + model.moves, 0)[1:] for c in by_end[j]])
            ahead[j, 1:] = logsum(arrive + scores[by_end[j]], 0)
    behind = np.full((n + 1, labels), -np.inf)
    behind[n] = 0.0
    for i in range(n - 1, -1, -1):
        parts = [model.moves[:, 0] + behind[i + 1, 0]]
        for c in by_start[i]:
            parts.append(logsum(model.moves[:, 1:] + scores[c] + behind[at[c][1], 1:], 1))
        behind[i] = logsum(np.array(parts), 0)
    total = logsum(ahead[n])
    slope, move_slope, value = np.zeros_like(model.weights), np.zeros_like(model.moves), -total
    for i in range(n):
        chance = np.exp(ahead[i] + model.moves[:, 0] + behind[i + 1, 0] - total)
        move_slope[:, 0] -= chance
    for c, (i, j) in enumerate(at):
        chance = np.exp(ahead[i][:, None] + model.moves[:, 1:] + scores[c] + behind[j, 1:] - total)
        move_slope[:, 1:] -= chance
        slope -= chance.sum(0)[:, None] * features[c]
    place, label, j = {s: i for i, (s, _) in enumerate(bounds)}, 0, 0
    ends = {e: i + 1 for i, (_, e) in enumerate(bounds)}
    index = {pair: c for c, pair in enumerate(at)}
    for kind, s, e in [*sorted(gold, key=lambda g: g[1]), (None, None, None)]:
        stop = place[s] if kind else n
        while j < stop:
            move_slope[label, 0] += 1
            value += model.moves[label, 0]
            label, j = 0, j + 1
        if kind:
            k, c = KINDS.index(kind) + 1, index[place[s], ends[e]]
            move_slope[label, k] += 1
            slope[k - 1] += features[c]
            value += model.moves[label, k] + scores[c, k - 1]
            label, j = k, ends[e]
    return value, slope, move_slope


def _other_ways(kind: str, span: str, turn: int) -> list[str]:
    """Other ways of writing a span, to learn from."""
    if kind == "email":
        name, _, domain = span.partition("@")
        spelt = [
            f"{name} at {domain.replace('.', ' dot ')}",
            f"{name}(at){domain}",
            f"{name} [at] {domain.replace('.', ' [dot] ')}",
        ]
        return [spelt[turn % 3]]
    if kind == "card":
        digits = _digits(span)
        if len(digits) != 16:
            return []
        return [["-", " ", "."][turn % 3].join(digits[i : i + 4] for i in range(0, 16, 4))]
    if kind == "phone":
        digits = _digits(span)[-10:]
        a, b, c = digits[:3], digits[3:6], digits[6:]
        return [[f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"][turn % 4]]
    return []


def _decoys(span: str) -> list[str]:
    """Numbers made of the span's digits that are no personal data, to learn from."""
    d = (_digits(span) + "1234567890")[:13]
    day = f"{1900 + int(d[:2])}-{1 + int(d[2:4]) % 12:02}-{1 + int(d[4:6]) % 28:02}"
    return [
        f"{day} {int(d[6:8]) % 24:02}:{int(d[8:10]) % 60:02}",
        d[: 9 + int(d[0]) % 5],
        f"{d[:3]} {d[3:6]} {d[6:9]}",
        f"{d[0]}.{d[1:3]}.{d[3]}.{300 + int(d[4:6])}",
        f"{d[0]}.{d[1:3]}",
        f"{d[:4]}-{d[4:8]} {d[8:12]}",
    ]


def examples(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Stretches with some text beside them, and the spans in them, as the patterns
    find them; then once more with the spans written another way."""
    out, base = [], base_spans(text)
    for s, e in stretches(text):
        own = [x for x in base if x[1] < e and s < x[2]]
        crossing = any(a[1] < b[2] and b[1] < a[2] for i, a in enumerate(own) for b in own[:i])
        partly = any(x[1] < s or e < x[2] for x in own)
        several = sum(len(g) >= 14 for g in re.findall(r"[0-9]+", text[s:e])) and not own and re.search(r"[0-9][ -][0-9]", text[s:e])
        if crossing or partly or several or e - s > 200:
            continue
        head, tail = text[max(0, s - 12) : s], text[e : e + 12]
        off = len(head) - s
        out.append((head + text[s:e] + tail, [(k, a + off, b + off) for k, a, b in own]))
        if len(own) == 1:
            kind, a, b = own[0]
            turn = crc32(text[a:b].encode())
            for other in _other_ways(kind, text[a:b], turn):
                lead = head + text[s:a]
                out.append((lead + other + text[b:e] + tail, [(kind, len(lead), len(lead) + len(other))]))
            if kind in ("card", "phone"):
                out.append((head + _decoys(text[a:b])[turn % 6] + tail, []))
    return out


def fit_examples(rows: list, rounds: int = 60, penalty: float = 0.02) -> Model:
    """Conditional likelihood by gradient steps (RMS-scaled) over all examples."""
    model, lattices = Model.blank(), []
    for text, gold in rows:
        own = [g for g in gold]
        for s, e in stretches(text):
            inside = [g for g in own if s <= g[1] and g[2] <= e]
            lattice = _lattice(text, s, e)
            bounds, at, _ = lattice
            place = {b[0]: i for i, b in enumerate(bounds)}
            ends = {b[1]: i + 1 for i, b in enumerate(bounds)}
            known = all(g[1] in place and g[2] in ends and (place[g[1]], ends[g[2]]) in set(at) for g in inside)
            if at and known and len(at) <= 400:
                lattices.append((lattice, set(inside)))
    if not lattices:
        return model
    squares = [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    for step in range(rounds):
        batch = lattices[step % 4 :: 4]
        slope, moves = -penalty * model.weights, -penalty * model.moves
        for lattice, gold in batch:
            _, a, b = _slopes(model, lattice, gold)
            slope += a / len(batch)
            moves += b / len(batch)
        for held, pull, part in ((squares[0], slope, model.weights), (squares[1], moves, model.moves)):
            held *= 0.9
            held += 0.1 * pull**2
            part += 0.3 / (1 + step / 20) * pull / (np.sqrt(held) + 1e-4)
    return model


def fit(
    docs: DataFrame,
    sample: int = SAMPLE,
    most: int = EXAMPLES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model out of the stretches of about `sample` different texts, of which about
    `most` are taken, by hash. Without any the model finds nothing. Stretches of over
    200 characters or 400 candidates are not learnt from (spans are found in all)."""

    def find(batches):
        for batch in batches:
            found = [
                x
                for t in batch.column(0).to_pylist()
                if t
                for x in examples(t)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([",".join(f"{k}:{a}:{b}" for k, a, b in x[1]) for x in found], pa.string()),
                ],
                ["text", "spans"],
            )

    found = frames.about(frames.picked(docs, text=text), sample).mapInArrow(find, "text string, spans string").distinct()
    picked = found.orderBy(F.xxhash64("text"), "text", "spans").limit(most).collect()
    parse = lambda s: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in s.split(",") if x)]
    return fit_examples([(r["text"], parse(r["spans"])) for r in picked])


def all_spans(text: str | None, model: Model) -> list[tuple[str, int, int]]:
    """The base spans and those that the model adds beside them, by start and kind."""
    base = base_spans(text)
    if not text:
        return base
    added = []
    for s, e in stretches(text):
        if any(b <= s and e <= c for _, b, c in base):
            continue  # wholly inside a base span, nothing to add
        for span in decoded(text, s, e, model):
            if all(span[2] <= b or c <= span[1] for _, b, c in base):
                added.append(span)
    return sorted([*base, *added], key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


OUT = (
    "struct<base:array<struct<kind:string,start:int,end:int>>,"
    "spans:array<struct<kind:string,start:int,end:int>>,text:string>"
)


def _records(spans):
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans]


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """`text` with each span's kind in its place; spans that overlap count as one,
    of the kind of the first."""
    parts, at = [], 0
    for kind, s, e in spans:
        if s >= at:
            parts += [text[at:s], f"<{kind.upper()}>"]
        at = max(at, e)
    return "".join([*parts, text[at:]])


def find(text: Column, model: Model, with_text: bool = True) -> Column:
    """A struct per text: `base` spans, all `spans`, and the masked `text`.

    Offsets are code points, ends exclusive. A NULL text has no spans and stays
    NULL; an empty one stays empty. Without `with_text` the text is NULL.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    kind = pa.struct([("base", pa.list_(span)), ("spans", pa.list_(span)), ("text", pa.string())])

    @F.arrow_udf(OUT)
    def found(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            spans = all_spans(text, model)
            base = base_spans(text) if spans else []
            clear = masked(text, spans) if with_text and text else text if with_text else None
            out.append({"base": _records(base), "spans": _records(spans), "text": clear})
        return pa.array(out, kind)

    return found(text)


def listed(spans: Column) -> Column:
    """`kind:start:end` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def masked_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with every span in column `text` masked; all rows and columns stay."""
    model = fit(docs, doc_id=doc_id, text=text)
    rows = frames.packed(docs, text, text=text)
    name = docs.columns[frames.position(docs, text)]
    return frames.unpacked(
        rows.withColumn("found", find(F.col("text"), model)),
        docs.columns,
        **{name: F.col("found.text")},
    )
