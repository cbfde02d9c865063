"""Registered queries of the training-data operators and their checking SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    decontamination,
    discriminant,
    embeddings,
    html,
    jaccard,
    language,
    middle,
    mixing,
    oracles,
    packing,
    substrings,
    suffixes,
    supervision,
    whitening,
)
from .common import crc_mod, staged, table
from .targets import DOMAIN, MIX_EPOCHS, MIX_LEVELS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, vocabulary

LLM_QUERIES = {}
LLM_SQL = {}


def registered(fn):
    LLM_QUERIES[fn.__name__] = fn
    return fn


@registered
def op1_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@registered
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_main_text(table(spark, sf_dir, "pages"), columns=["page_id", "url"])


@registered
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeated_passages(docs, columns=["doc_id"])


@registered
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = supervision.judge_quality(staged(supervision.text_statistics(docs), "statistics"))
    return judged.select("doc_id", *supervision.BASE, "base_failed", "kept", "quality_probability")


@registered
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(staged(packing.tokenized_pieces(docs, vocabulary()), "pieces"))


@registered
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per chosen document and epoch."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.expr(DOMAIN).alias("domain"), mixing.word_count("text").alias("n_tokens")
    )
    slim = staged(docs, "documents-to-mix")
    mixed = mixing.mix_to_weights(slim, "n_tokens", MIX_LEVELS, MIX_WEIGHTS, None, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def mixing_sql(docs: str, share: float, epochs: int) -> str:
    """The chosen (doc_id, epoch) of ``docs(doc_id, domain, lang, source, n_tokens)`` in DuckDB's dialect."""
    names = [f"l{i}" for i in range(len(MIX_LEVELS))]
    keys = ", ".join(names)
    levels = ", ".join(f"coalesce({c}, '') AS {n}" for c, n in zip(MIX_LEVELS, names, strict=True))
    ctes = [
        f"slim AS (SELECT doc_id, {levels}, n_tokens FROM ({docs}))",
        f"given AS (SELECT CAST(trunc(coalesce(sum(n_tokens), 0) * {share}) AS HUGEINT) AS b FROM slim)",
        f"t0 AS (SELECT {keys}, CAST(sum(n_tokens) AS HUGEINT) AS tokens, CAST(sum(n_tokens) AS HUGEINT) * {epochs} AS cap, "
        f"(SELECT b FROM given) AS budget FROM slim GROUP BY {keys})",
    ]
    for depth in range(1, len(names) + 1):
        own, parent, name = ", ".join(names[:depth]), ", ".join(names[: depth - 1]) or "'root'", names[depth - 1]
        known = " ".join(f"WHEN {name} = '{path[0]}' THEN {w}" for path, w in MIX_WEIGHTS.items())
        ctes += [
            f"n{depth} AS (SELECT {own}, sum(cap)::HUGEINT AS cap, any_value(budget) AS given, (CASE {known} ELSE 1 END)::HUGEINT AS w "
            f"FROM t{depth - 1} GROUP BY {own})",
            f"s{depth} AS (SELECT *, sum(cap) OVER up AS cap_sum, sum(w) OVER (PARTITION BY {parent}) - sum(w) OVER up AS above FROM n{depth} "
            f"WINDOW up AS (PARTITION BY {parent} ORDER BY cap::DOUBLE / w::DOUBLE, {name} ROWS UNBOUNDED PRECEDING))",
            f"f{depth} AS (SELECT *, cap_sum::HUGEINT * w + cap * above::HUGEINT <= given * w AS filled FROM s{depth})",
            f"u{depth} AS (SELECT *, coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY {parent}), 0)::HUGEINT AS used, "
            f"coalesce(sum(w) FILTER (NOT filled) OVER (PARTITION BY {parent}), 0)::HUGEINT AS w_open FROM f{depth})",
            f"t{depth} AS (SELECT {', '.join('t.' + n for n in names)}, t.tokens, t.cap, CASE WHEN u.filled THEN u.cap "
            f"WHEN u.w_open > 0 THEN ((u.given - u.used) * u.w) // u.w_open ELSE 0 END AS budget "
            f"FROM t{depth - 1} t JOIN u{depth} u USING ({own}))",
        ]
    ctes += [
        f"plan AS (SELECT {keys}, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole, tokens, budget FROM t{len(names)})",
        f"ep AS (SELECT doc_id, n_tokens, {keys}, whole, budget - whole * tokens AS rest, unnest(range(0, (whole + 1)::BIGINT)) AS epoch "
        f"FROM slim JOIN plan USING ({keys}))",
        f"pos AS (SELECT *, sum(n_tokens) OVER (PARTITION BY {keys}, epoch ORDER BY md5('{MIX_SEED}:' || epoch || ':' || doc_id), doc_id) AS reach FROM ep)",
        "chosen AS (SELECT doc_id, epoch::INT AS epoch FROM pos WHERE epoch < whole OR (rest > 0 AND reach <= rest))",
    ]
    return "WITH " + ", ".join(ctes) + " SELECT doc_id, epoch FROM chosen"


DOCS_TO_MIX = (
    "SELECT doc_id, lang, source, coalesce('domain' || (TRY_CAST(regexp_extract(source, '[0-9]+') AS INT) % 3)::VARCHAR, 'other') AS domain, "
    r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents"
)
LLM_SQL["op6_source_mixing"] = lambda: (
    f"SELECT c.doc_id, d.domain, d.lang, d.source, d.n_tokens, c.epoch FROM ({mixing_sql(DOCS_TO_MIX, MIX_SHARE, MIX_EPOCHS)}) c "
    f"JOIN ({DOCS_TO_MIX}) d USING (doc_id)"
)


def held_out(mod: int, remainder: int) -> Column:
    """Whether the id's checksum leaves the remainder; a null id has none, so its row is not held out."""
    return F.coalesce(crc_mod("doc_id", mod) == remainder, F.lit(False))


@registered
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = staged(discriminant.text_features(docs), "features").withColumn("held_out", held_out(5, 0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = discriminant.fit_discriminant(rows.filter(~F.col("held_out")).join(labels, "doc_id"))
    return discriminant.score_quality(rows, model)


@registered
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


@registered
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(4, 2))
    model = language.fit_language_model(docs.filter(~F.col("held_out")))
    return language.identify_language(docs.drop("lang"), model, columns=["doc_id", "held_out"])


@registered
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeated_bytes(docs, columns=["doc_id"])


@registered
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = middle.fill_in_middle(docs, columns=["doc_id"])
    output, form = F.col("output"), F.col("form")
    digests = [F.sha2(output, 256).alias("output_sha256"), F.sha2(middle.restored(output, form), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@registered
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component."""
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    spread = rows.select("vec_id", "n", "deviation", "identity_error", parts)
    component = (F.col("at") + 1).alias("component")
    return spread.select("vec_id", component, "n", "deviation", "part.whitened", "part.explained", "identity_error")


@registered
def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_benchmark_passages(docs, table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    n_items = F.size("items").cast("long").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, digest, (F.col("n_hit") > 0).alias("contaminated"))


LLM_SQL["op1_embedding_near_duplicates"] = lambda: oracles.NEAR_VECTORS
LLM_SQL["op3_substring_dedup"] = lambda: oracles.REPEATED_PASSAGES
LLM_SQL["op8_jaccard_join"] = lambda: oracles.JACCARD_GROUPS
LLM_SQL["op10_suffix_dedup"] = lambda: oracles.REPEATED_BYTES
LLM_SQL["op11_fill_in_middle"] = lambda: oracles.FILL_IN_MIDDLE
LLM_SQL["op13_benchmark_decontamination"] = lambda: oracles.BENCHMARK_PASSAGES
LLM_QUERIES["pipeline"] = corpus_pipeline.run
