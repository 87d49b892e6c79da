"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, language_model, main_text, mixing, packing, quality_model, repetition, secrets, simhash, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark, sf_dir):
    return simhash.classify(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark, sf_dir):
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark, sf_dir):
    return language_model.score(table(spark, sf_dir, "documents"))


def op5_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark, sf_dir):
    return repetition.assess(table(spark, sf_dir, "documents"))


def op7_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))


def op8_quality_classifier(spark, sf_dir):
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.classify(table(spark, sf_dir, "documents"))


def op10_mixing(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))


def queries():
    found = [v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()]
    return {f.__name__: f for f in found}


OP9_SQL = r"""
with d as (select doc_id, length(coalesce(text, '')) as n,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as h from documents),
g as (select h, arg_min(doc_id, (-n, doc_id)) as keep_id, count(*) as group_size from d group by h)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, h as text_sha256 from d join g using (h)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_secret_scan": secrets.report_sql(),
        "op5_url_filter": url_filter.judge_sql(),
        "op9_exact_dedup": OP9_SQL,
        "op10_mixing": mixing.report_sql(),
    }
