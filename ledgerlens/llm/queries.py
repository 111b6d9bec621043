"""The registered queries of this subpackage, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import contamination as contaminated
from ledgerlens.llm import (
    alignment, domain_scores, fingerprints, line_dedup, manifest, mixing, quality, rules, secrets, toxicity, warc_audit,
)
from ledgerlens.llm.near_duplicates import near_duplicates
from ledgerlens.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def register(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query

    return add


@register()
def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets(table(spark, folder, "documents"))


@register(line_dedup.SQL)
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    made = line_dedup.deduplicated(table(spark, folder, "documents"))
    text = F.coalesce(F.col("line_dedup.text"), F.lit(""))
    return made.select(
        "doc_id", "line_dedup.n_lines", "line_dedup.n_deleted", F.sha2(text.cast("binary"), 256).alias("text_sha256")
    )


@register(contaminated.SQL)
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contaminated.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("matches")


@register()
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register(mixing.sql())
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


@register()
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    made = quality.classified(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return made.select("doc_id", "lang", "quality.*")


@register()
def op7_domain_scores(spark: SparkSession, folder: str) -> DataFrame:
    return domain_scores.cross_entropy_difference(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register()
def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


@register()
def op9_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register(warc_audit.SQL)
def op10_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    return warc_audit.audited_pages(table(spark, folder, "pages"))


@register()
def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared(table(spark, folder, "documents"))


@register()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.scored(table(spark, folder, "documents"))


@register(manifest.SQL)
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return manifest.manifest(docs, manifest.without_line_ends(docs))
