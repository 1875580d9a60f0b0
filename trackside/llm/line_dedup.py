"""Units of text, lines and passages inside them, that stood elsewhere before, removed.

A unit is normalised and hashed; over all documents the occurrence that ranks
first is kept and the others are cut out of their texts. The parts that stay come
with their offsets in the original.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from trackside.llm import frames
from trackside.sources import tables

#: What ends a unit. A unit holds its end, so units make up the text.
ENDS = {
    "line": r"\n",
    "sentence": r"\n|[.!?][ \t]",
    "clause": r"\n|[.!?,;:][ \t]",
    "paragraph": r"\n[ \t\r]*\n",
}
MIN_WORDS = 8
_WORD = re.compile(r"[^\W_]+")
#: Unit "whole": lines, and clauses within them. (A paragraph that stood before is cut
#: line by line, as each of its lines did.)
LEVELS = [re.compile(x) for x in (ENDS["line"], ENDS["clause"] + "|[。！？，；：、]")]
#: Scripts without blanks between words (Thai to Khmer, kana, Han).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_SPANS = "array<struct<start:int,end:int>>"


def _digest(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode()).digest()


def _units(text: str | None, end: re.Pattern, min_words: int):
    """Start, end and digest of each unit with enough words."""
    start = 0
    for stop in [*(m.end() for m in end.finditer(text or "")), len(text or "")]:
        words = _WORD.findall(text[start:stop].lower()) if stop > start else ()
        if words and len(words) >= min_words:
            yield start, stop, _digest(words)
        start = stop


def _nested(text: str | None, min_words: int):
    """Start, end and digest of lines with a word, and of their clauses with enough. A
    clause with the words of its line is not listed again."""
    text = text or ""
    start = 0
    for stop in [*(m.end() for m in LEVELS[0].finditer(text)), len(text)]:
        words = _WORD.findall(text[start:stop].lower())
        if words:
            yield start, stop, _digest(words)
            if len(words) >= min_words or _UNSPACED.search(text, start, stop):
                yield from _clauses(text, start, stop, words, min_words)
        start = stop


def _clauses(text: str, start: int, end: int, around: list[str], min_words: int):
    for stop in [*(m.end() for m in LEVELS[1].finditer(text, start, end)), end]:
        words = _WORD.findall(text[start:stop].lower())
        # a character of an unspaced script counts as a word
        if words != around and (
            len(words) >= min_words or sum(len(_UNSPACED.findall(w)) or 1 for w in words) >= min_words
        ):
            yield start, stop, _digest(words)
        start = stop


def units(text: Column, unit: str = "whole", min_words: int = MIN_WORDS) -> Column:
    """The units of a text with at least `min_words` words: start and end in code
    points and the 128-bit digest of their words in lower case. Those of "whole"
    are lines of any length, with a word, and within them clauses with enough."""
    end = None if unit == "whole" else re.compile(ENDS[unit])
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("digest", pa.binary())])
    )

    @F.arrow_udf("array<struct<start:int,end:int,digest:binary>>")
    def split(texts: pa.Array) -> pa.Array:
        sizes, starts, stops, digests = [0], [], [], []
        for text in texts:
            text = text.as_py()
            for s, e, d in _units(text, end, min_words) if end else _nested(text, min_words):
                starts.append(s)
                stops.append(e)
                digests.append(d)
            sizes.append(len(starts))
        return pa.ListArray.from_arrays(
            pa.array(sizes, pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(starts, pa.int32()), pa.array(stops, pa.int32()), pa.array(digests, pa.binary())],
                ["start", "end", "digest"],
            ),
        ).cast(kind)

    return split(text)


def _kept(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """Each text without its cuts, the stretches that stay, and the outermost cuts."""
    out = []
    for text, cut in zip(texts.to_pylist(), cuts.to_pylist()):
        if text is None:
            out.append({"text": None, "kept": [], "cut": cut})
            continue
        stretches, outer, at = [], [], 0
        for span in sorted(cut or (), key=lambda x: (x["start"], -x["end"])):
            if span["end"] <= at:
                continue
            if span["start"] > at:
                stretches.append({"start": at, "end": span["start"]})
            outer.append(span)
            at = span["end"]
        if at < len(text):
            stretches.append({"start": at, "end": len(text)})
        kept = "".join(text[x["start"] : x["end"]] for x in stretches) if cut else text
        out.append({"text": kept, "kept": stretches, "cut": outer})
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.array(out, pa.struct([("text", pa.string()), ("kept", spans), ("cut", spans)]))


def deduplicated(
    docs: DataFrame,
    unit: str = "whole",
    min_words: int = MIN_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """`docs` with repeated units cut from column `text`; `kept` and `cut` follow.

    Both hold spans (start, end) of the original in code points, in order. With the unit
    "whole" any line that stood before goes entire, however short, and so paragraphs
    do; the lines that stay lose clauses of `min_words` words that stood before, so that
    a passage is found inside a line. Other units have `min_words` words at least
    (give 1 for any line). Of equal units the first by
    id (NULL last), then by hash of id and text, then by offset stays; of rows
    that repeat as a whole one keeps what ranks first and the others lose all
    such units. A NULL text stays NULL, an empty one empty; an empty table gives
    an empty one. Columns `kept` and `cut` of the input are replaced.

    Digests are grouped with a count and a minimum, so a unit that stands in a
    third of all documents is reduced before the shuffle; it comes back to its
    places by a join that adaptive execution splits.
    """
    rows = frames.packed(docs, text, doc_id=doc_id, text=text).withColumn(
        "key",
        F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text"))),
    )
    seen = tables.written(
        rows.select("doc_id", "key", F.inline(units(F.col("text"), unit, min_words))), "line-units"
    )
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "key", "start")
    firsts = (
        seen.groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select("digest", "first")
    )
    # a unit of a repeated row is there as often as the row, at one place
    cuts = (
        seen.join(firsts, "digest")
        .where(place != F.col("first"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cut"))
    )
    again = F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0))) > 1
    joined = rows.join(cuts, "key", "left").withColumn("again", again)
    all_units = F.transform(
        units(F.when(F.col("again"), F.col("text")), unit, min_words),
        lambda u: F.struct(u["start"].alias("start"), u["end"].alias("end")),
    )
    chosen = F.when(F.col("again"), F.col("all_units")).otherwise(
        F.coalesce("cut", F.array().cast(_SPANS))
    )
    cleaned = F.arrow_udf(_kept, f"struct<text:string,kept:{_SPANS},cut:{_SPANS}>")
    out = (
        joined.withColumn("all_units", all_units)
        .withColumn("chosen", chosen)
        .withColumn("clean", cleaned(F.col("text"), F.col("chosen")))
    )
    name = docs.columns[frames.position(docs, text)]
    return frames.unpacked(
        out,
        docs.columns,
        **{name: F.col("clean.text"), "kept": F.col("clean.kept"), "cut": F.col("clean.cut")},
    )
