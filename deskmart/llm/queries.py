"""The operators applied to the driver tables with production parameters, and SQL for their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmart.llm import (
    bag_minhash, disclosure, expected, feistel_shards, fim_frames, fuzzy_lines, line_quality, mixing, qda, redirects,
    secret_ledger, sparse_suffixes, string_tiling, whitening)
from deskmart.session import new_folder

# Fixed rules of the contract
URL_RULES = [
    redirects.Rule("allow", "org", "/"),
    redirects.Rule("block", "example.org", "/es/"),
    redirects.Rule("block", "example.org", "/en/1"),
    redirects.Rule("allow", "com", "/fr/"),
    redirects.Rule("block", "com", "/de/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.judge_documents(table(spark, sf_dir, "documents"))


def op3_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sparse_suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    spans = F.transform("passages", lambda p: F.concat_ws(
        ":", *(p[c].cast("string") for c in ("start", "end", "first_doc"))))
    return found.withColumn("passages", F.concat_ws(",", spans))


def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_schedule(table(spark, sf_dir, "documents"))


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.classify_lines(table(spark, sf_dir, "documents"))


def op6_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.classify_near_duplicates(table(spark, sf_dir, "documents"))


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secret_ledger.Ledger(spark, new_folder(spark, "ledger"))
    return secret_ledger.scan_documents(table(spark, sf_dir, "documents"), ledger)


def secret_ledger_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op7 with a ledger that grows: the base rules are scanned first, then all rules, of which the
    ledger lacks the further ones only."""
    ledger = secret_ledger.Ledger(spark, new_folder(spark, "ledger"))
    docs = table(spark, sf_dir, "documents")
    ledger.update(docs.select(F.col("doc_id").alias("path"), "text"), secret_ledger.BASE)
    return secret_ledger.scan_documents(docs, ledger)


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = feistel_shards.assign_shards(table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_redirect_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = redirects.judge_pages(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def url_mirror_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op9 with redirects: every address leads to the first one of the same path, on any host, so that
    decisions spread from addresses with a rule to addresses without."""
    pages = table(spark, sf_dir, "pages")
    known = pages.where("url like '%://%'").select("url", redirects.path_of(F.col("url")).alias("path"))
    first = known.groupBy("path").agg(F.min("url").alias("dst"))
    judged = redirects.judge_pages(pages, URL_RULES, known.join(first, "path").select(F.col("url").alias("src"), "dst"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_quadratic_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qda.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_fim_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_frames.transform_documents(table(spark, sf_dir, "documents"))


def op13_term_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.find_disclosures(table(spark, sf_dir, "documents"))


def common_value_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator of op13 with values of any frequency protected, those in more than a hundredth of all documents too."""
    return disclosure.find_disclosures(table(spark, sf_dir, "documents"), public=1.0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_string_tiling, op2_line_frequency, op3_sparse_suffixes, op4_temperature_mix, op5_fuzzy_lines, op6_bag_minhash,
        op7_secret_ledger, op8_feistel_shards, op9_redirect_groups, op10_quadratic_discriminant,
        op11_embedding_whitening, op12_fim_frames, op13_term_disclosure, url_mirror_groups, secret_ledger_updates,
        common_value_disclosure)
}
ORACLE_SQL: dict[str, str] = {
    "op2_line_frequency": expected.LINE_FREQUENCY,
    "op3_sparse_suffixes": expected.PASSAGES,
    "op6_bag_minhash": expected.NEAR_DUPLICATES,
    "op7_secret_ledger": expected.SECRETS,
    "op9_redirect_groups": expected.URL_VERDICTS,
    "url_mirror_groups": expected.MIRROR_VERDICTS,
    "secret_ledger_updates": expected.SECRETS,
    "op12_fim_frames": expected.FILL_IN_MIDDLE,
    "op13_term_disclosure": expected.PERSONAL_DATA,
    "common_value_disclosure": expected.COMMON_VALUES,
}
