"""A corpus pipeline of the operators in quadmill.llm: quality, exact copies, near
copies, mixture, packing. Each stage's result is stored and read again by the next."""

from __future__ import annotations

from quadmill.llm import exact_dedup, mixing, packing, quality_model, simhash
from quadmill.llm.common import stored


def keep_good(spark, docs, sf_dir):
    """Documents that the classifier, learnt from ``labels``, scores good. Null text is empty and
    scored like any; a repeated row is judged alike each time; an empty table stays empty."""
    return quality_model.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark, docs, sf_dir):
    """One document of each set of equal texts, by the choice of op9: the longest original, then
    the smallest doc_id. Null text is empty; of repeated rows one stays."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each class of similar texts: the smallest doc_id. Empty texts are alike; of
    rows that repeat doc_id and text one stays."""
    return simhash.similar_dedup(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as drawn for their source; rows of one doc_id share a draw, a null source
    is mixed with the unlisted ones, texts without length leave their group's rate at one."""
    return mixing.mix(docs)


def pack_sequences(spark, docs, sf_dir):
    """Sequences of at most 1024 tokens; each copy of a replicated document is packed, null text is empty."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: No SQL: the classifier, fingerprints and tokens have none. tests/llm/test_pipeline.py
#: compares each stage with a plain version on what its predecessor kept.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
