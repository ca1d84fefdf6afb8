"""Queries over the given tables, one per operator."""

from pyspark.sql import functions as F

from pressmill.llm import (
    alignment,
    decontaminate,
    linededup,
    lm,
    mixing,
    pii,
    quality,
    simhash,
    suffixdedup,
    tokencount,
    toxicity,
    urlfilter,
    whitening,
)
from pressmill.llm.oracles import OP3, OP6, OP10
from pressmill.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401


@query()
def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op2_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query(OP3)
def op3_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query()
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=lambda c: ~toxicity.held_out(c))
    return toxicity.scored(docs, index).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence", "cosines")


@query()
def op5_tokens(spark, sf_dir):
    return tokencount.counted(table(spark, sf_dir, "documents"))


@query(OP6)
def op6_lines(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"))


@query(OP10)
def op10_quality(spark, sf_dir):
    return quality.verdict(quality.ledger(table(spark, sf_dir, "documents")))


@query()
def op7_suffixes(spark, sf_dir):
    rows = suffixdedup.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op8_lm(spark, sf_dir):
    return lm.scores(table(spark, sf_dir, "documents"), lm.held_out)


@query()
def op9_pii(spark, sf_dir):
    return pii.pseudonymised(table(spark, sf_dir, "documents"), b"a key of the caller's")


@query()
def op11_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"), most=16)


@query()
def op12_urls(spark, sf_dir):
    return urlfilter.judged(table(spark, sf_dir, "pages"))


@query()
def op13_alignment(spark, sf_dir):
    return alignment.aligned(table(spark, sf_dir, "documents"))
