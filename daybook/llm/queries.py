"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    compression_quality,
    decontaminate,
    divergence,
    jaccard_groups,
    labelled,
    lm_tables,
    mixing,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    suffix_dedup,
    token_links,
    url_rules,
)
from daybook.llm.rows import table

#: Where the public vocabulary files are on the driver, which sends them to the tasks.
TOKENIZERS = "/opt/tokenizers"
SHARDS = [f"shard-{n:03d}" for n in range(64)]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = compression_quality.train(docs, table(spark, sf_dir, "labels"))
    good = F.col("score") >= compression_quality.THRESHOLD
    return compression_quality.score(docs, model).select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", good.cast("int").alias("predicted")
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "slot", "shard")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.rules_table(spark, url_rules.RULES)
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_tables.score(table(spark, sf_dir, "documents"))


def op6_lm_scoring_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_tables.score(table(spark, sf_dir, "documents"), order=3)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        written = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(written, ",")

    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_links.Tokenizers.read(TOKENIZERS)
    return token_links.link_strength(table(spark, sf_dir, "documents"), files)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.groups(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup,
        op2_quality_classifier,
        op3_benchmark_decontamination,
        op4_sharding,
        op5_url_filters,
        op6_lm_scoring,
        op6_lm_scoring_trigrams,
        op7_quality_rules,
        op8_simhash_near_dedup,
        op9_mixing,
        op10_secret_scans,
        op11_token_alignment,
        op12_source_divergence,
        op13_ngram_jaccard_join,
    )
}
