"""One query per corpus operator, with its production parameters, over whole tables."""

from __future__ import annotations

import os
import string
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from trackside.llm import (
    attention,
    decision_list,
    embedding_dedup,
    frames,
    language,
    line_dedup,
    merkle,
    mixing,
    periodic,
    personal,
    pieces,
    quality,
    simhash,
    toxicity,
)
from trackside.llm.sql import SQL  # noqa: F401
from trackside.sources import tables


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def language_id(spark, folder):
    """Language of each document, learnt from three quarters of them."""
    docs = frames.picked(_read(spark, folder, "documents"), doc_id="doc_id", text="text", lang="lang")
    out = frames.held_out("doc_id", 4, 2)
    model = language.learn(docs.where(~out))
    return (
        docs.select("doc_id", out.alias("held_out"), language.label(F.col("text"), model).alias("found"))
        .select(
            "doc_id",
            "held_out",
            F.col("found.lang").alias("lang_pred"),
            "found.score",
            F.size("found.spans").alias("n_spans"),
        )
    )


def toxicity_score(spark, folder):
    """Toxicity of each document's restored text, learnt from four fifths of the labels."""
    docs, labels = _read(spark, folder, "documents"), _read(spark, folder, "labels")
    model = toxicity.character_model(docs)
    train = ~frames.held_out("id", 5, 0)
    sample = frames.labelled_sample(labels, "toxic", train, toxicity.SAMPLE)
    scorer = toxicity.fit(docs, sample, model)
    found = toxicity.score(F.col("text"), model, scorer, with_text=False)
    out = frames.picked(docs, doc_id="doc_id", text="text").withColumn("score", found["score"])
    return out.select(
        "doc_id",
        frames.held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def simhash_dedup(spark, folder):
    """Fingerprint and near-copy group of each document."""
    found = simhash.groups(_read(spark, folder, "documents"))
    return found.select(
        "doc_id",
        simhash.hexadecimal(F.col("print")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def embedding_dedup_query(spark, folder):
    """Links and group of each vector, within its label."""
    found = embedding_dedup.linked(_read(spark, folder, "embeddings"))
    return found.withColumnRenamed("component", "component_id")


def line_dedup_query(spark, folder):
    """Documents without the clauses that an earlier one holds."""
    docs = _read(spark, folder, "documents")
    out = line_dedup.deduplicated(docs)
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ","
    )
    return out.select(
        "doc_id",
        "text",
        F.size("cut").cast("bigint").alias("n_cut"),
        text(F.col("cut")).alias("cut"),
        text(F.col("kept")).alias("kept"),
    )


def quality_rules(spark, folder):
    """Counts of each document and the verdict of rules learnt from the labels."""
    docs, labels = _read(spark, folder, "documents"), _read(spark, folder, "labels")
    counted = tables.written(decision_list.statistics(docs), "rule-counts")
    features = decision_list.with_features(counted)
    labels = frames.picked(labels, doc_id="doc_id", label="quality")
    labelled = tables.written(features.join(labels, "doc_id"), "rule-labelled")
    rules = decision_list.learn(labelled)
    out = decision_list.judged(features, rules)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


def quality_classifier(spark, folder):
    """Quality of each document, learnt from good ones and unlabelled ones."""
    docs, labels = _read(spark, folder, "documents"), _read(spark, folder, "labels")
    train = ~frames.held_out("id", 4, 2)
    model = quality.fit(docs, quality.trusted(labels, train))
    out = frames.picked(docs, doc_id="doc_id", text="text")
    return out.select(
        "doc_id",
        frames.held_out("doc_id", 4, 2).alias("held_out"),
        quality.score(F.col("text"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def personal_data(spark, folder):
    """Personal data in each document: counts, and places as text."""
    docs = _read(spark, folder, "documents")
    model = personal.fit(docs)
    found = frames.picked(docs, doc_id="doc_id", text="text").withColumn(
        "found", personal.find(F.col("text"), model, with_text=False)
    )
    of_kind = lambda kind: F.size(F.filter("found.base", lambda s: s["kind"] == kind))
    return found.select(
        "doc_id",
        *(of_kind(kind).cast("bigint").alias(f"n_{kind}") for kind in personal.KINDS),
        F.sha2(personal.listed(F.col("found.base")), 256).alias("base_sha256"),
        personal.listed(F.col("found.spans")).alias("spans"),
    )


def sentencepiece(spark, folder, path: str | None = None):
    """Ids of each document, and whether they decode to the text again."""
    words = pieces.vocabulary(path or pieces.tokenizer())
    docs = frames.picked(_read(spark, folder, "documents"), doc_id="doc_id", text="text")
    found = docs.select("doc_id", pieces.round_trip(F.col("text"), words).alias("found"))
    return found.select(
        "doc_id", F.size("found.ids").cast("bigint").alias("n_ids"), "found.ids", "found.same_again"
    )


def mix_sources(spark, folder):
    """Each document as often as its source's share wants it, in random order."""
    return mixing.mixed(_read(spark, folder, "documents")).withColumn(
        "copy", F.col("copy").cast("bigint")
    )


def lm_scores(spark, folder, path: str | None = None):
    """Each document's log probability under the attention model and under word counts."""
    out = frames.held_out("doc_id", 7, 2)
    found = attention.scores(_read(spark, folder, "documents"), ~out, path or byte_tokenizer())
    return found.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def byte_tokenizer() -> str:
    """The file of ranks: BYTE_BPE_RANKS, or that of the public tokenizers."""
    import public_tokenizers

    return os.environ.get("BYTE_BPE_RANKS") or public_tokenizers.path("byte_bpe_50k.tiktoken")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def merkle_manifest(spark, folder):
    """Leaf, subroot, root and proof of each document, and whether the root still
    follows where one in five has its text changed."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = merkle.leaf_hash(*(F.col(c) for c in FIELDS[:-1]), lower)
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    out = merkle.manifest(
        _read(spark, folder, "documents"), FIELDS, carried={"changed": F.when(touched, changed)}
    )
    return out.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        merkle.folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def periodic_runs(spark, folder):
    """Runs of repeated words in each document, one in ten of which is made periodic."""
    docs = frames.picked(_read(spark, folder, "documents"), doc_id="doc_id", text="text")
    text = periodic.made_periodic(F.col("text"), F.col("doc_id"))
    most = F.col("found.strongest")
    return docs.select("doc_id", periodic.found(text).alias("found")).select(
        "doc_id",
        F.size("found.runs").cast("bigint").alias("n_runs"),
        most["start"].alias("start"),
        most["length"].alias("length"),
        most["period"].alias("period"),
        F.floor(1000 * most["length"] / most["period"]).alias("exponent_milli"),
        periodic.digest(F.col("found.runs")).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity_score,
    "op2_simhash_dedup": simhash_dedup,
    "op3_line_dedup": line_dedup_query,
    "op4_embedding_dedup": embedding_dedup_query,
    "op5_quality_rules": quality_rules,
    "op6_quality_classifier": quality_classifier,
    "op7_personal_data": personal_data,
    "op8_sentencepiece": sentencepiece,
    "op9_mix_sources": mix_sources,
    "op10_language_id": language_id,
    "op11_lm_scores": lm_scores,
    "op12_merkle_manifest": merkle_manifest,
    "op13_periodic_runs": periodic_runs,
    "pipeline": corpus_pipeline.run,
}
