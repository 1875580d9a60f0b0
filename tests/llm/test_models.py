"""What is learnt: held-out accuracy, exact decoding and fixed results."""

import itertools
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import tables
from trackside.llm import chars, decision_list, frames, language, personal, quality, toxicity

FOLDER = os.environ.get("QUERY_DIR", "/root/testdata/sf0.01")


def accuracy(spark, name, label, test):
    found = entry.queries()[name](spark, FOLDER)
    known = spark.read.parquet(f"{FOLDER}/labels.parquet")
    if label == "lang":
        known = spark.read.parquet(f"{FOLDER}/documents.parquet")
    joined = found.join(known.select("doc_id", label), "doc_id").where("held_out")
    assert found.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert found.where("score is null or score < 0 or score > 1").count() == 0
    return joined.agg(F.avg(F.expr(test).cast("int"))).first()[0]


def test_toxicity_held_out(spark):
    assert accuracy(spark, "op1_toxicity", "toxic", "predicted = toxic") > 0.93


def test_quality_held_out(spark):
    assert accuracy(spark, "op6_quality_classifier", "quality", "predicted = quality") > 0.93


def test_language_held_out(spark):
    assert accuracy(spark, "op10_language_id", "lang", "lang_pred = lang") > 0.98


# -- toxicity -------------------------------------------------------------------

PLAIN = "you are an idiot and a stupid moron said the clown who was a loser in this pathetic game"


@pytest.fixture(scope="module")
def char_model(spark):
    rows = [(i, PLAIN, "en", "a", 1) for i in range(30)]
    return toxicity.character_model(tables.odd(spark, rows))


@pytest.mark.parametrize(
    "disguised, plain",
    [
        ("1d10t", "idiot"), ("idiooooot", "idiot"), ("i d i o t", "idiot"), ("m.o.r.o.n", "moron"),
        ("$tup1d", "stupid"), ("p4th3t1c", "pathetic"), ("l0s3r", "loser"), ("CL0WN", "clown"),
        ("loser", "loser"), ("", ""), ("!!!", ""),
    ],
)
def test_restored(char_model, disguised, plain):
    if disguised == "!!!":
        assert isinstance(toxicity.restored(disguised, char_model), str)
    else:
        assert toxicity.restored(disguised, char_model) == plain


def naive_restored(token, model):
    """Every reading of the lattice, the best first."""
    runs = [m.group() for m in toxicity._RUNS.finditer(token.lower())]
    best = (-np.inf, "")
    for choice in itertools.product(*(toxicity._readings(r[0], len(r)) for r in runs)):
        text, total, state = "", 0.0, (32, 32)
        for out, cost in [*choice, (" ", 0.0)]:
            total -= cost
            for c in out:
                if c == " " and state[1] == 32:
                    continue
                total += model.logp(*state, ord(c))
                state = (32, 32) if c == " " else (state[1], ord(c))
                text += c
        best = max(best, (total, text.strip()), key=lambda x: x[0])
    return best


def test_restored_is_best(char_model):
    """The score is that of the best of all readings; the reading is one with it."""
    random.seed(2)
    for _ in range(60):
        token = "".join(random.choices("idotm013$.", k=6))
        got, text = toxicity._best(token, char_model)
        want, other = naive_restored(token, char_model)
        assert got == pytest.approx(want, rel=1e-12), token
        assert toxicity.restored(token, char_model) == text
        # of readings with one score any may be given
        assert text == other or naive_score(token, text, char_model) == pytest.approx(want, rel=1e-12)


def naive_score(token, text, model):
    """The best score of the readings that give `text`."""
    runs = [m.group() for m in toxicity._RUNS.finditer(token.lower())]
    found = -np.inf
    for choice in itertools.product(*(toxicity._readings(r[0], len(r)) for r in runs)):
        out, total, state = "", 0.0, (32, 32)
        for part, cost in [*choice, (" ", 0.0)]:
            total -= cost
            for c in part:
                if c == " " and state[1] == 32:
                    continue
                total += model.logp(*state, ord(c))
                state = (32, 32) if c == " " else (state[1], ord(c))
                out += c
        if out.strip() == text:
            found = max(found, total)
    return found


def test_clean_text_is_left_alone(char_model):
    texts = ["a clean text, with 3 signs: $5 & more!!", "DE!! LA!! ndreea$$$ a a a a", "", None]
    out = toxicity.restore_batch(texts, char_model, toxicity._reader(char_model))
    assert out[2:] == ["", ""]
    assert out[1] == texts[1]


def test_mixed_disguises(spark):
    """Signs, spacing, doubling and cutting together, next to words that stay."""
    rows = [(i, PLAIN + " ass, what a clean letter we all will see", "en", "a", 1) for i in range(30)]
    model = toxicity.character_model(tables.odd(spark, rows))
    for disguised, plain in [
        ("m 0 r 0 n", "moron"), ("$ t u p 1 d", "stupid"), ("iidiot", "idiot"), ("mooron", "moron"),
        ("a$$", "ass"), ("id-iot", "idiot"), ("i  d  i  o  t", "idiot"), ("m. 0. r. 0. n", "moron"),
        ("mo-0-ron", "moron"), ("st_uupid", "stupid"),
    ]:
        text = f"All {disguised} we will see"
        assert toxicity.restore_batch([text], model, toxicity._reader(model)) == [f"All {plain} we will see"]
    clean = ["All clean letters! A letter, you see: 1 2 3, who-was", "Moron! Idiot!!"]
    assert toxicity.restore_batch(clean, model, toxicity._reader(model)) == clean


@pytest.mark.parametrize("extra", [(), tables.EXTRA])
def test_toxicity_odd(spark, char_model, extra):
    docs = tables.odd(spark, extra=extra)
    sample = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (10, 1)], "id bigint, label int")
    for chosen in (sample, sample.where("label = 1"), sample.limit(0)):
        scorer = toxicity.fit(docs, chosen, char_model)
        out = frames.picked(docs, doc_id="doc_id", text="text").select(
            "text", toxicity.score(F.col("text"), char_model, scorer).alias("s")
        )
        rows = out.collect()
        assert len(rows) == len(tables.ROWS)
        assert all(0 <= r["s"]["score"] <= 1 for r in rows)
        assert all((r["s"]["restored"] is None) == (r["text"] is None) for r in rows)


def test_toxic_words_found_in_disguise(spark):
    random.seed(4)
    words = ["".join(random.choices("abcdefghijklmnoprstu", k=5)) for _ in range(400)]
    text = lambda: " ".join(random.choices(words, k=40))
    rows = [(i, text() + (" idiot moron " if i % 5 == 0 else " "), "en", "a", 1) for i in range(300)]
    docs = tables.odd(spark, rows)
    model = toxicity.character_model(docs)
    sample = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "id bigint, label int")
    scorer = toxicity.fit(docs, sample, model)
    test = [(1, text() + " 1d10t m0r0n", "en", "a", 1), (2, text(), "en", "a", 1), (3, text() + " i d i o t mooooron", "en", "a", 1)]
    out = tables.odd(spark, test).select("doc_id", toxicity.score(F.col("text"), model, scorer)["score"].alias("s"))
    scores = {r["doc_id"]: r["s"] for r in out.collect()}
    assert scores[1] > 0.5 and scores[3] > 0.5 and scores[2] < 0.5


def test_toxic_words_in_few_texts(spark):
    """Insults that five of 68 training texts hold, and no clean one, are learnt."""
    random.seed(6)
    text = lambda: " ".join("".join(random.choices("abcdefghijklmnoprstu", k=5)) for _ in range(30))
    insults = [" idiot moron", " clown loser"]
    rows = [(i, text() + (insults[i % 2] if i < 10 else ""), "en", "a", 1) for i in range(68)]
    docs = tables.odd(spark, rows)
    model = toxicity.character_model(docs)
    sample = spark.createDataFrame([(i, int(i < 10)) for i in range(68)], "id bigint, label int")
    scorer = toxicity.fit(docs, sample, model)
    test = [(i, text() + (insults[i % 2] if i < 4 else ""), "en", "a", 1) for i in range(24)]
    out = tables.odd(spark, test).select("doc_id", toxicity.score(F.col("text"), model, scorer)["score"].alias("s"))
    scores = {r["doc_id"]: r["s"] for r in out.collect()}
    assert all((s > 0.5) == (i < 4) for i, s in scores.items()), scores


# -- language --------------------------------------------------------------------


def test_best_path():
    rng = np.random.default_rng(0)
    sizes = np.array([4, 0, 6, 1])
    scores = rng.normal(size=(11, 3)).astype(np.float32) * 3
    prior = rng.normal(size=3).astype(np.float32)
    first = np.cumsum(sizes) - sizes
    path = language.best_path(scores, first, sizes, prior, 1.5)
    for f, n in zip(first, sizes):
        own = scores[f : f + n]

        def total(p):
            switches = sum(a != b for a, b in zip(p, p[1:]))
            return prior[p[0]] + sum(own[t, s] for t, s in enumerate(p)) - 1.5 * switches

        if n:
            best = max(itertools.product(range(3), repeat=int(n)), key=total)
            assert tuple(path[f : f + n]) == best


def test_language_spans(spark):
    en, de = "the cat and the dog with that thing", "der hund und die katze mit nicht"
    rows = [(i, f"{en} " * 5, "en", "a", 1) for i in range(5)]
    rows += [(i, f"{de} " * 5, "de", "a", 1) for i in range(5, 10)]
    rows += [(20, "кот и собака", "ru", "a", 1)]
    model = language.learn(tables.odd(spark, rows))
    assert model.langs == ["de", "en", "ru"]
    mixed = f"{en} {en}. {de} {de}. кот и"
    test = [(1, mixed, None, None, 1), (2, "漢字", None, None, 1), (3, "123 ?", None, None, 1), (4, None, None, None, 1), (5, "", None, None, 1)]
    out = tables.odd(spark, test).select("doc_id", language.label(F.col("text"), model).alias("x"))
    found = {r["doc_id"]: r["x"] for r in out.collect()}
    assert [s["lang"] for s in found[1]["spans"]] == ["en", "de", "ru"]
    assert mixed[found[1]["spans"][1]["start"] : found[1]["spans"][1]["end"]] == f"{de} {de}"
    assert found[1]["lang"] == "en" and 0.4 < found[1]["score"] < 0.6
    assert found[2]["lang"] in model.langs  # a letter, though of no known script
    assert [found[i]["lang"] for i in (3, 4, 5)] == ["und"] * 3


def test_language_odd(spark):
    docs = tables.odd(spark, extra=tables.EXTRA)
    model = language.learn(docs)
    out = frames.picked(docs, text="text").select(language.label(F.col("text"), model).alias("x"))
    assert out.count() == len(tables.ROWS) and out.where("x is null").count() == 0
    none = language.learn(tables.odd(spark, []))
    assert none.langs == []
    rows = tables.odd(spark).select(language.label(F.col("text"), none)["lang"].alias("l")).collect()
    assert {r["l"] for r in rows} == {"und"}


# -- quality ---------------------------------------------------------------------


def test_prior_and_risk():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1.5, 1, (30000, 3)), rng.normal(-1.5, 1, (10000, 3))
    unlabelled = np.concatenate((good[:14000], bad[:6000]))
    rng.shuffle(unlabelled)
    model = quality.fit_rows(good[14000:], unlabelled)
    assert abs(model.prior - 0.7) < 0.05
    assert (model.logits(good[14000:]) > 0).mean() > 0.95
    assert (model.logits(bad[6000:]) < 0).mean() > 0.9


def plain_features(text):
    """The statistics of one text by plain counting."""
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    lines = [x for x in (text or "").split("\n") if x]
    share = lambda xs: len(set(xs)) / max(1, len(xs))
    runs = lambda n: [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    n, body = max(1, len(words)), "".join(words)
    count = lambda signs: sum(c in signs for c in text or "")
    letters = [c for c in text or "" if c.isalpha()]
    capital = [c for c in letters if len(c.lower()) == 1 and c.lower() != c]
    return [
        np.log1p(len(words)), len(body) / n, count("#*$%&|<>") / n, count("!?") / n,
        count("0123456789") / max(1, len(body)), len(capital) / max(1, len(letters)), count(".,;:") / n,
        share(words), share(runs(2)), share(runs(5)),
        max((words.count(w) for w in set(words)), default=0) / n, len(words) / max(1, len(lines)), share(lines),
        len(letters) / max(1, len(body)), sum(len(w) == 1 for w in words) / n,
    ]


def test_features_are_counted():
    random.seed(9)
    texts = [None, "", "a", "A b! c? #1 $$ a\nA b!\n\nÜber 日本 x", "x " * 40, *(r[1] for r in tables.ROWS)]
    texts += ["".join(random.choices("ab cd. E\n!1#", k=200)) for _ in range(30)]
    got = quality.features(texts)
    for text, row in zip(texts, got):
        assert np.allclose(row, plain_features(text)), text


def test_risk_is_the_least():
    """The steps' weights against small moves in any direction: none lowers the risk."""
    rng = np.random.default_rng(3)
    pos, unl = rng.integers(0, 4, (300, 3)), rng.integers(0, 4, (500, 3))
    pos[:, 0] = np.minimum(pos[:, 0], 2)
    shape, prior, penalty = (3, 4), 0.4, 1e-2
    columns = np.arange(3)

    def risk(weights, bias):
        at_pos, at_unl = (bias + weights[columns, x].sum(1) for x in (pos, unl))
        positive = prior * np.logaddexp(0, -at_pos).mean()
        negative = np.logaddexp(0, at_unl).mean() - prior * np.logaddexp(0, at_pos).mean()
        return positive + negative + penalty / 2 * (weights**2).sum()

    weights, bias = quality._risk_steps(pos, unl, prior, shape, 3000, penalty, False)
    least = risk(weights, bias)
    for _ in range(200):
        way = rng.normal(0, 0.05, (3, 4))
        assert risk(weights + way, bias + rng.normal(0, 0.05)) >= least - 1e-4


def test_features_are_per_text():
    texts = [r[1] for r in tables.ROWS]
    together = quality._features_of(texts)
    alone = np.concatenate([quality.features([t]) for t in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()
    assert not quality.features([None]).any() and not quality.features([""]).any()
    row = dict(zip(quality.NAMES, quality.features(["Aa b## a\na b## a"])[0]))
    assert row["symbols"] == 4 / 6 and row["top_token"] == 0.5 and row["lines"] == 3


@pytest.mark.parametrize("extra", [(), tables.EXTRA])
def test_quality_stage_odd(spark, extra):
    docs = tables.odd(spark, extra=extra)
    few = tables.labels(spark, [(1, 1, 0), (2, 0, 0), (None, 1, 1), (6, None, 0), (1, 0, 1)])
    for known in (few, few.limit(0)):
        out = quality.kept(docs, known, F.lit(True))
        assert out.columns == docs.columns and out.count() == len(tables.ROWS)
    # enough to learn from, with copies and NULLs among them
    rows = [*tables.ROWS, *((100 + i, f"plain text number {i} with words. " * 5, "en", "a", 1) for i in range(40))]
    rows += [(200 + i, "### $$$ " * 30, "en", "a", 1) for i in range(10)]
    good = tables.labels(spark, [(100 + i, 1, 0) for i in range(40)] + [(None, 1, 0), (100, None, 0)])
    docs = tables.odd(spark, rows, extra)
    out = quality.kept(docs, good, F.lit(True))
    assert out.columns == docs.columns
    ids = {r["doc_id"] for r in frames.picked(out, doc_id="doc_id").collect()}
    assert set(range(100, 140)) <= ids and not ids & set(range(200, 210))
    none = tables.odd(spark, [])
    assert quality.kept(none, few, F.lit(True)).count() == 0


# -- rules -----------------------------------------------------------------------


def naive_counts(text):
    import re
    from collections import Counter

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        k
        for i in range(len(words) - 4)
        if windows[tuple(words[i : i + 5])] > 1
        for k in range(i, i + 5)
    }
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "n_marks": len(re.findall(r"[!?]", text or "")),
        "n_distinct_words": len(set(words)),
    }


def check_counts(rows, found):
    from collections import Counter

    names = list(naive_counts(""))
    want = Counter((i, *naive_counts(t).values()) for i, t in rows)
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in found) == want


@pytest.mark.parametrize("extra", [(), tables.EXTRA])
def test_counts_odd(spark, extra):
    more = [(50, "a b c d e a b c d e a b c d e", "en", "a", 1), (51, "w " * 9, "en", "a", 1)]
    more += [(52, "x y\nx y\n \nx y\nz # | <", "en", "a", 1), (53, "a b c d e f a b c d e", "en", "a", 1)]
    rows = [*tables.ROWS, *more]
    found = decision_list.statistics(tables.odd(spark, rows, extra)).collect()
    check_counts([(r[0], r[1]) for r in rows], found)


def test_counts_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check_counts(rows, decision_list.statistics(docs).collect())


def test_rule_search_against_counting(spark):
    """Tables of thresholds, gains and pruning on some rows, counted one by one."""
    rng = random.Random(4)
    names = list(decision_list.FEATURES)
    rows = [[rng.choice([None, *range(6)]) for _ in names] + [rng.randrange(2)] for _ in range(120)]
    df = spark.createDataFrame(
        [tuple(float(v) if isinstance(v, int) and k < len(names) else v for k, v in enumerate(r)) for r in rows],
        ", ".join([*(f"{n} double" for n in names), "label int"]),
    )
    cuts = {names[0]: [1.0, 3.0], names[1]: [0.5], names[2]: []}
    met = lambda r, c: (
        r[names.index(c[0])] is not None
        and (r[names.index(c[0])] >= c[2] if c[1] == ">=" else r[names.index(c[0])] <= c[2])
    )
    table = decision_list._table(df, cuts)
    assert set(table) == {(f, sign, t) for f, cut in cuts.items() for t in cut for sign in (">=", "<=")}
    for condition, counted in table.items():
        own = [r[-1] for r in rows if met(r, condition)]
        assert counted == (own.count(0), own.count(1))
    every = ([r[-1] for r in rows].count(0), [r[-1] for r in rows].count(1))
    for bad, good in table.values():
        purity = lambda b, g: np.log2(b / (b + g)) if b else 0.0
        want = bad * (purity(bad, good) - purity(*every)) if bad else 0.0
        assert decision_list._gain((bad, good), every) == pytest.approx(want)
    conditions = [(names[0], ">=", 1.0), (names[1], "<=", 3.0), (names[2], ">=", 2.0)]
    pruned = decision_list._pruned(decision_list.Rule(conditions), df)
    worth = []
    for n in (1, 2, 3):
        own = [r[-1] for r in rows if all(met(r, c) for c in conditions[:n])]
        worth.append(((own.count(0) - own.count(1)) / max(1, len(own)), own.count(0), own.count(1)))
    best = max(range(3), key=lambda n: worth[n][0])
    assert pruned.conditions == conditions[: best + 1]
    assert (pruned.right, pruned.wrong) == worth[best][1:]


def test_capitals_are_counted(spark):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(["ABC d É 日 Ǆ ǅ 1", "", None, "none"])]
    got = {r["doc_id"]: r["n_capitals"] for r in decision_list.statistics(tables.odd(spark, rows)).collect()}
    assert got == {0: 5, 1: 0, 2: 0, 3: 0}


def test_rules_are_learnt(spark):
    random.seed(7)
    rows = []
    for i in range(900):
        bad = i % 5 == 0
        share = random.uniform(0.5, 0.9) if bad and i % 10 else random.uniform(0, 0.2)
        length = random.uniform(9, 14) if bad and not i % 10 else random.uniform(3, 7)
        rows.append((i, 100, int(100 * length), int(100 * share), 0, 0, 10, 0, 0, 90, int(not bad)))
    counts = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_marks bigint, n_capitals bigint, n_distinct_words bigint, label int"
    df = decision_list.with_features(spark.createDataFrame(rows, counts)).cache()
    rules = decision_list.learn(df)
    out = decision_list.judged(df, rules)
    assert 1 <= len(rules.rules) <= 4
    assert {c[0] for r in rules.rules for c in r.conditions} <= {"symbol_share", "word_length"}
    assert out.where("kept != (label = 1)").count() <= 10
    one = decision_list.learn(df.where("label = 1"))
    assert one.rules == [] and decision_list.learn(df.limit(0)).rules == []
    # the rule a text fails by is the first that applies
    again = out.where("not kept").select("rule").distinct().collect()
    assert {r["rule"] for r in again} == set(range(1, len(rules.rules) + 1))


def test_rules_plan_has_no_python(spark):
    df = decision_list.statistics(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_rules_query(spark):
    out = entry.queries()["op5_quality_rules"](spark, FOLDER)
    known = spark.read.parquet(f"{FOLDER}/labels.parquet")
    failed = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"
    assert out.where(f"base_failed != ({failed}) or (base_failed and kept)").count() == 0
    judged = out.where("not base_failed").join(known, "doc_id")
    assert judged.where("kept and quality = 0").count() < 0.1 * judged.where("quality = 0").count() + 3
    assert judged.where("not kept and quality = 1").count() < 0.02 * judged.where("quality = 1").count() + 1


# -- personal data ----------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def naive_spans(text):
    import re

    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and personal.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), k, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(found)]


def test_base_spans_random():
    random.seed(9)
    for _ in range(3000):
        text = "".join(random.choices("a1 23.4-5@+(b)._%0\n", k=random.randint(0, 60)))
        assert personal.base_spans(text) == naive_spans(text), text
    assert personal.base_spans(None) == personal.base_spans("") == []


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "1 " * 30_000])
def test_base_spans_take_linear_time(text):
    import time

    start = time.perf_counter()
    personal.base_spans(text)
    assert time.perf_counter() - start < 5


def card(prefix):
    return next(prefix + str(d) for d in range(10) if personal.luhn(prefix + str(d)))


def pii_rows(n=400):
    random.seed(11)
    rows = []
    for i in range(n):
        digits = "".join(random.choices("123456789", k=30))
        what = [
            f"write to name{i}.x@mail{i % 9}.example.com now",
            f"call +1 ({digits[:3]}) 555-{digits[3:7]} now",
            f"host {i % 256}.{i % 199}.7.{i % 99} is up",
            f"paid by {card('4' + digits[:14])} today",
            f"order {digits[:16]} came in {digits[:2]} boxes, version {digits[0]}.{digits[1]}",
        ][i % 5]
        rows.append((i, f"some words and {what} and more words", "en", "a", 1))
    return rows


def test_field_adds_spans(spark):
    model = personal.fit(tables.odd(spark, pii_rows()))
    one, two = card("453957876362148"), card("471340395352456")
    cases = {
        f"numbers 23904 {one} on": [("card", 14, 30)],
        f"both {one} {two} here": [("card", 5, 21), ("card", 22, 38)],
        "john.doe at mail dot example dot com": [("email", 0, 36)],
        "call 811-555-3281 now": [("phone", 5, 17)],
        "on 2001-02-03 12:30 we met": [],
        "nothing here at all": [],
    }
    for text, want in cases.items():
        assert personal.all_spans(text, model) == want, text
    # base spans stay, whatever the model says
    for _, text, *_ in pii_rows(50):
        assert set(naive_spans(text)) <= set(personal.all_spans(text, model))


def all_paths(n, at):
    """Every way of cutting n atoms into single ones outside and candidates."""
    def rest(i):
        if i == n:
            yield ()
            return
        for tail in rest(i + 1):
            yield ((0, i, None), *tail)
        for c, (a, b) in enumerate(at):
            if a == i:
                for tail in rest(b):
                    for k in range(1, 5):
                        yield ((k, i, c), *tail)

    yield from rest(0)


def test_field_is_exact():
    """Viterbi and the sums against all segmentations, slopes against differences."""
    rng = np.random.default_rng(3)
    model = personal.Model.blank()
    model.weights[:] = rng.normal(size=model.weights.shape)
    model.moves[:] = rng.normal(size=model.moves.shape)
    text = "1234 5678.90 1"
    lattice = personal._lattice(text, 0, len(text))
    bounds, at, features = lattice

    def score(path, m):
        total, label = 0.0, 0
        for k, _, c in path:
            total += m.moves[label, k] + (features[c] @ m.weights[k - 1] if k else 0)
            label = k
        return total

    paths = list(all_paths(len(bounds), at))
    best = max(paths, key=lambda p: score(p, model))
    want = [(personal.KINDS[k - 1], bounds[i][0], bounds[at[c][1] - 1][1]) for k, i, c in best if k]
    assert personal.decoded(text, 0, len(text), model) == want
    gold = {("card", bounds[at[-1][0]][0], bounds[at[-1][1] - 1][1])}

    def value(m):
        log_all = np.logaddexp.reduce([score(p, m) for p in paths])
        own = [p for p in paths if {(personal.KINDS[k - 1], bounds[i][0], bounds[at[c][1] - 1][1]) for k, i, c in p if k} == gold]
        return score(own[0], m) - log_all

    got, slope, moves = personal._slopes(model, lattice, gold)
    assert np.isclose(got, value(model))
    for part, own in ((model.weights, slope), (model.moves, moves)):
        for _ in range(12):
            at_ = tuple(int(rng.integers(0, s)) for s in part.shape)
            part[at_] += 1e-5
            up = value(model)
            part[at_] -= 2e-5
            down = value(model)
            part[at_] += 1e-5
            assert np.isclose((up - down) / 2e-5, own[at_], atol=1e-4)


@pytest.mark.parametrize("extra", [(), tables.EXTRA])
def test_masked_odd(spark, extra):
    rows = [*tables.ROWS, *((100 + r[0], *r[1:]) for r in pii_rows(60))]
    docs = tables.odd(spark, rows, extra)
    out = personal.masked_rows(docs)
    assert out.columns == docs.columns
    found = frames.picked(out, doc_id="doc_id", text="text").collect()
    text = {r["doc_id"]: r["text"] for r in found}
    assert out.count() == len(rows)
    assert text[3] is None and text[4] == "" and text[1] == tables.ROWS[0][1]
    assert text[100] == "some words and write to <EMAIL> now and more words"
    none = tables.odd(spark, [])
    assert personal.masked_rows(none).count() == 0


def test_personal_query(spark):
    import hashlib

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in entry.queries()["op7_personal_data"](spark, FOLDER).collect():
        want = naive_spans(docs[r["doc_id"]])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        for kind in PATTERNS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in want)
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_trigram_hash():
    codes = np.array([97, 0x1F600, 0x10FFFF, 1], dtype=np.uint32)
    hashed = chars.trigram_hash(codes, codes[::-1].copy(), codes)
    assert hashed.tolist() == [chars.trigram_hash(*map(int, x)) for x in zip(codes, codes[::-1], codes)]
    assert hashed.max() < chars.BUCKETS


# -- bounded samples ---------------------------------------------------------------


def test_samples_are_bounded(spark):
    """A third of the rows under one id, a third with one text, NULLs among both."""
    rows = [(7, f"text number {i} of the one id", "en", "a", 1) for i in range(3000)]
    rows += [(10_000 + i, "the one text", "en", "a", 1) for i in range(2000)]
    rows += [(None, "the one text", "en", "a", 1)] * 500 + [(None, None, "en", "a", 1)] * 500
    rows += [(20_000 + i, f"own text {i}", "en", "a", 1) for i in range(3000)]
    docs = tables.odd(spark, rows)
    rows_of = frames.picked(docs, id="doc_id", text="text")
    assert frames.about(rows_of, 300).count() <= 600
    labelled = tables.labels(spark, [(r[0], 1, 0) for r in rows if r[0] is not None])
    sample = frames.labelled_sample(labelled, "quality", F.lit(True), 300)
    assert sample.count() <= 600
    picked = frames.texts_of(docs, sample, "doc_id", "text")
    assert picked.count() == sample.count()
    every = frames.texts_of(docs, frames.labelled_sample(labelled, "quality", F.lit(True), 10**6), "doc_id", "text")
    assert every.where("text like 'text number%'").collect() == [(1, "text number 0 of the one id", 7)]
    assert frames.about(rows_of, 10**6).count() == 8001
    assert frames.about(rows_of.select("text"), 10**6).count() == 6001
    assert frames.about(rows_of.limit(0), 5).count() == 0


def test_spans_of_long_number_runs_take_linear_time():
    """Eight times the numbers, about eight times the time; the same spans as piece by piece."""
    model = personal.fit_examples(personal.examples("call +1 202 555 0142 or 4111 1111 1111 1111 today, see a at b dot org"))
    seconds = []
    for n in (1000, 8000):
        text = " ".join(str(i * 37 % 100) for i in range(n))
        start = time.perf_counter()
        personal.all_spans(text, model)
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 16 * seconds[0] + 0.5
