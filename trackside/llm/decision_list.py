"""Quality rules: a decision list learnt from labelled statistics of texts.

Sequential covering: a rule, a conjunction of thresholds, is grown on two thirds
of the labelled rows, pruned on the rest, and the rows it covers are set aside
for the next one. The list comes out as ordered Spark conditions. All of it are
DataFrame functions; what reaches the driver are counts per threshold.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from trackside.llm import frames

SPACES = " \t\n\x0b\f\r"
WINDOW = 5
#: Statistics that rules may test, as ratios of the counts.
FEATURES = {
    "word_length": "word_chars / n_words",
    "symbol_share": "n_symbols / n_words",
    "mark_share": "n_marks / n_words",
    "capital_share": "n_capitals / word_chars",
    "distinct_share": "n_distinct_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "line_words": "n_words / n_lines",
}


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns that are computed here, once, and not again wherever they are used:
    an explode of one element, which the optimiser doesn't merge with later steps."""
    made = F.struct(*(c.alias(n) for n, c in columns.items()))
    rest = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(made)))


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per text: `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`,
    `n_repeat_words`, `n_lines`, `n_marks`, `n_capitals`, `n_distinct_words`.

    Words are runs of anything but space, tab, line ends and form feeds; NULL and
    empty texts have none, and zero everywhere. Windows of five words are compared
    by a 64-bit hash.
    """
    rows = frames.picked(docs, doc_id=doc_id, text=text)
    body = F.coalesce("text", F.lit(""))
    inner = F.btrim(body, F.lit(SPACES))
    lines = F.filter(
        F.split(body, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0
    )
    rows = _held(
        rows.select("doc_id", body.alias("text"), inner.alias("inner")),
        words=F.when(F.col("inner") == "", F.array().cast("array<string>")).otherwise(
            F.split("inner", r"[\x20\x09-\x0D]+")
        ),
        lines=lines,
        n_symbols=F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")),
        n_marks=F.length(F.regexp_replace("text", r"[^!?]+", "")),
        n_capitals=F.length(F.regexp_replace("text", r"\P{Lu}+", "")),
    ).select(
        "doc_id",
        "n_symbols",
        "n_marks",
        "n_capitals",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    rows = _held(rows, hashes=F.col("hashes"))
    at = F.sequence(F.lit(0), F.col("n_words") - WINDOW)
    window = F.transform(
        at, lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW)))
    )
    none = F.array().cast("array<bigint>")
    rows = _held(
        rows.withColumn("n_distinct_words", F.size(F.array_distinct("hashes"))),
        windows=F.when(F.col("n_words") >= WINDOW, window).otherwise(none),
    ).drop("hashes")
    twice = F.size("windows") > F.size(F.array_distinct("windows"))
    ordered = F.array_sort(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    rows = _held(rows, ordered=F.when(twice, ordered)).drop("windows")
    last = F.size("ordered") - 1
    same = lambda i, j: F.get("ordered", i)["h"].eqNullSafe(F.get("ordered", j)["h"])
    marked = F.filter(
        F.sequence(F.lit(0), last),
        lambda j: ((j > 0) & same(j, j - 1)) | ((j < last) & same(j, j + 1)),
    )
    starts = F.array_sort(F.transform(marked, lambda j: F.get("ordered", j)["i"]))
    rows = _held(rows, starts=F.when(F.col("ordered").isNotNull(), starts)).drop("ordered")
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda held, s: F.struct(
            (held["n"] + s + WINDOW - F.greatest(s, held["end"])).alias("n"),
            (s + WINDOW).alias("end"),
        ),
        lambda held: held["n"],
    )
    counts = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
        "n_marks", "n_capitals", "n_distinct_words",
    ]
    return rows.select(
        "doc_id",
        *(F.col(c).cast("bigint").alias(c) for c in counts),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def with_features(counts: DataFrame) -> DataFrame:
    """The ratios of FEATURES beside the counts; NULL where they divide by zero."""
    return counts.withColumns(
        {name: F.try_divide(*map(F.col, ratio.split(" / "))) for name, ratio in FEATURES.items()}
    )


@dataclass
class Rule:
    """Texts to which all conditions (feature, ">=" or "<=", threshold) apply are
    rejected. `right` and `wrong`: rows of the pruning set it rejects."""

    conditions: list[tuple[str, str, float]]
    right: int = 0
    wrong: int = 0

    def column(self) -> Column:
        tests = [
            F.col(f) >= t if sign == ">=" else F.col(f) <= t for f, sign, t in self.conditions
        ]
        return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def verdict(self) -> Column:
        """The number of the first rule that applies, from 1; 0 for none."""
        out = F.lit(0)
        for i, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(rule.column(), i).otherwise(out)
        return out


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Up to `bins` quantiles of each feature, from all rows and from the bad ones."""
    shares = [(i + 0.5) / bins for i in range(bins)]
    bad = F.col("label") == 0
    found = rows.agg(
        *(F.percentile_approx(f, shares, 10_000).alias(f) for f in FEATURES),
        *(F.percentile_approx(F.when(bad, F.col(f)), shares, 10_000).alias(f"bad_{f}") for f in FEATURES),
    ).first()
    return {f: sorted({*(found[f] or ()), *(found[f"bad_{f}"] or ())}) for f in FEATURES}


def _table(rows: DataFrame, cuts: dict[str, list[float]]) -> dict:
    """For each (feature, sign, threshold): bad and good rows that meet it.

    One job: rows are counted per feature and bin, which gives as many rows as
    there are thresholds, and summed up here.
    """
    def bin_of(feature: str, cut: list[float]) -> Column:
        value, edges = F.col(feature), F.array(*map(F.lit, cut))
        return F.struct(
            F.lit(feature).alias("feature"),
            F.when(value.isNotNull(), F.size(F.filter(edges, lambda t: t < value))).alias("below"),
            F.size(F.filter(edges, lambda t: t <= value)).alias("upto"),
        )

    bins = [bin_of(f, cut) for f, cut in cuts.items() if cut]
    if not bins:
        return {}
    counted = (
        rows.select("label", F.inline(F.array(*bins)))
        .where("below is not null")
        .groupBy("feature", "below", "upto")
        .agg(F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("bad"), F.count("*").alias("n"))
        .collect()
    )
    out = {}
    for f, cut in cuts.items():
        own = [r for r in counted if r["feature"] == f]
        for i, t in enumerate(cut):
            for sign in (">=", "<="):
                met = [r for r in own if (r["upto"] > i if sign == ">=" else r["below"] <= i)]
                bad = sum(r["bad"] for r in met)
                out[f, sign, t] = (bad, sum(r["n"] for r in met) - bad)
    return out


def _gain(met: tuple[int, int], before: tuple[int, int]) -> float:
    """Information that a condition gains over the rows it keeps."""
    (bad, good), (all_bad, all_good) = met, before
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(all_bad / (all_bad + all_good)))


def _grown(rows: DataFrame, cuts: dict, most: int) -> tuple[Rule, bool]:
    """A rule grown condition by condition until it covers no good row, or gains
    no more; whether it has any condition."""
    rule, before = Rule([]), None
    while len(rule.conditions) < most:
        table = _table(rows.where(rule.column()) if rule.conditions else rows, cuts)
        if not table:
            break
        if before is None:
            total = rows.agg(
                F.count(F.when(F.col("label") == 0, 1)), F.count(F.when(F.col("label") != 0, 1))
            ).first()
            before = (total[0], total[1])
        if not before[0] or not before[1]:
            break
        best = max(sorted(table), key=lambda c: _gain(table[c], before))
        if _gain(table[best], before) <= 0 or table[best] == before:
            break
        rule.conditions.append(best)
        before = table[best]
    return rule, bool(rule.conditions)


def _pruned(rule: Rule, rows: DataFrame) -> Rule:
    """The rule cut after the condition where (right - wrong) / covered is best on
    `rows`; the shorter of equal ones."""
    heads = [Rule(rule.conditions[:i]) for i in range(1, len(rule.conditions) + 1)]
    sums = rows.agg(
        *(
            F.count(F.when(head.column() & (F.col("label") == value), 1)).alias(f"{i}_{value}")
            for i, head in enumerate(heads)
            for value in (0, 1)
        )
    ).first()
    for i, head in enumerate(heads):
        head.right, head.wrong = sums[f"{i}_0"], sums[f"{i}_1"]
    return max(heads, key=lambda r: (r.right - r.wrong) / max(1, r.right + r.wrong))


def learn(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    label: str = "label",
    bins: int = 32,
    most_rules: int = 12,
    most_conditions: int = 4,
    precision: float = 0.9,
) -> DecisionList:
    """A decision list for `label` 0 out of the columns FEATURES.

    `labelled` is read some dozen times and should be a written table. All its
    rows count, but for those with a NULL id or label. Learning ends when a rule
    is right for less than `precision` of the rows it covers in the pruning set,
    or covers none there. Without rows of both labels the list is empty.
    """
    rows = frames.picked(labelled, id=doc_id, label=label, **{f: f for f in FEATURES})
    rows = rows.where("id is not null and label in (0, 1)").withColumn(
        "grow", frames.remainder("id", 3) != 0
    )
    cuts, out = _thresholds(rows, bins), DecisionList()
    while len(out.rules) < most_rules:
        rest = rows.where(out.verdict() == 0) if out.rules else rows
        rule, found = _grown(rest.where("grow"), cuts, most_conditions)
        if not found:
            break
        rule = _pruned(rule, rest.where("not grow"))
        if not rule.right or rule.right < precision * (rule.right + rule.wrong):
            break
        out.rules.append(rule)
    return out


#: Fixed rule that stands before the learnt ones: too few words, or too many of
#: them in windows that repeat.
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def judged(features: DataFrame, rules: DecisionList) -> DataFrame:
    """Columns `base_failed`, `rule` (the first learnt rule that applies, 0 for
    none or after a failed base rule) and `kept`."""
    failed = F.expr(BASE_FAILED)
    rule = F.when(failed, 0).otherwise(rules.verdict())
    return features.withColumns(
        {"base_failed": failed, "rule": rule, "kept": ~failed & (rule == 0)}
    )
