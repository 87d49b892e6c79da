"""Exact dedup through a log-structured merge index of text digests.

All steps are DataFrame operations. An input split is a memtable: its task flushes one
digest-sorted run of level 0, a Parquet file with a Bloom filter on the digest, without a
shuffle. A compaction merges up to ``FAN_IN`` runs of a level into one of the next, and
keeps for each digest the best row and the smallest identifier, until one run is left. Its
digests with two or more rows are hits; only their texts are read again, and their bytes
compared. Which texts these are is told by the hits' own filter, ``SLOTS`` bits at most, so
that it can be sent to all tasks: texts of other digests stay where they are. Texts that
share a digest but differ are split.

Edge cases: null text is empty; empty texts are equal to each other and to texts of
white space only; rows that repeat a doc_id are rows like others, and of rows equal
in length and doc_id one stays; an empty table gives an empty result; other columns
are never read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, keep_listed, stored, table_path, text_or_empty

#: Parquet writes a Bloom filter for each run's digests; lookups of single digests skip runs by it.
RUN_FILTER = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": "100000"}
#: Runs of a level that one compaction merges; slots of the filter of hits.
FAN_IN, SLOTS = 16, 1 << 20


def normalised():
    return F.regexp_replace(text_or_empty(), f"{SPACE_CLASS}+", "")


def digested(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """doc_id, length (code points of the text) and the digest of its normalised text.

    digest_bytes below 32 shortens digests, which only a test of colliding digests wants.
    """
    return docs.select(
        "doc_id",
        F.length(text_or_empty()).alias("length"),
        F.substring(F.unhex(F.sha2(normalised(), 256)), 1, digest_bytes).alias("digest"),
        F.sha2(normalised(), 256).alias("text_sha256"),
    )


def slot(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(SLOTS))


class DigestIndex:
    """A log-structured merge index in ``path``: level 0 has the flushed runs, each
    higher level the runs that compactions of the level below left."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.levels = spark, path or table_path(spark, "digest-index"), 0
        self.tables: list[DataFrame] = []
        self.runs = 0

    def flush(self, entries: DataFrame) -> DataFrame:
        """Each task's rows become one sorted run; returns the rows as stored."""
        path = f"{self.path}/level=0/flush={len(self.tables)}"
        rows = entries.withColumn("row_id", F.monotonically_increasing_id()).withColumn("run", F.spark_partition_id() + F.lit(self.runs))
        rows.sortWithinPartitions("digest", "doc_id").write.options(**RUN_FILTER).parquet(path)
        self.tables.append(self.spark.read.schema(rows.schema).parquet(path))
        self.runs = (self.tables[-1].agg(F.max("run").alias("n")).first()["n"] or 0) + 1
        return self.tables[-1]

    def entries(self) -> DataFrame:
        out = self.tables[0]
        for t in self.tables[1:]:
            out = out.union(t)
        return out

    def compact(self) -> DataFrame:
        """Merge level by level into one run: for each digest the row that stays and the
        number of rows.

        Map-side partial aggregation leaves one row a digest and task, so that a group
        with a third of all rows costs its reducer no more than the number of tasks.
        """
        kept = F.struct((-F.col("length")).alias("short"), "doc_id", "row_id")
        now, runs = self.entries().select("digest", "run", kept.alias("best"), F.lit(1).cast("bigint").alias("n")), self.runs
        while True:
            merged = now.groupBy("digest", F.floor(F.col("run") / FAN_IN).cast("int").alias("run")).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
            self.levels, runs = self.levels + 1, -(-runs // FAN_IN)
            path = f"{self.path}/level={self.levels}"
            merged.sortWithinPartitions("run", "digest").write.options(**RUN_FILTER).parquet(path)
            now = self.spark.read.schema(merged.schema).parquet(path)
            if runs <= 1:
                return now.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"), F.col("n").alias("group_size"))

    def lookup(self, compacted: DataFrame, digests: list[bytes]) -> DataFrame:
        """Point lookups; pushed to the files, whose filters skip runs without them."""
        return compacted.where(F.col("digest").isin(*[F.lit(bytearray(d)) for d in digests]))


def hit_filter(compacted: DataFrame) -> DataFrame:
    """The slots of the digests with two or more rows; SLOTS rows at most."""
    return stored(compacted.where("group_size > 1").select(slot(F.col("digest")).alias("slot")).distinct(), "digest-filter")


def colliding(docs: DataFrame, hits: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """Digests of hits whose texts are not the same bytes.

    The smallest and the largest text of a digest are equal exactly if all are. Both
    are partial aggregates: each task sends a text once, however many copies it has.
    """
    texts = docs.select(
        F.substring(F.unhex(F.sha2(normalised(), 256)), 1, digest_bytes).alias("digest"),
        normalised().alias("body"),
    )
    texts = texts.join(F.broadcast(hits), slot(F.col("digest")) == hits["slot"], "left_semi")
    span = texts.groupBy("digest").agg(F.count("*").alias("n"), F.min("body").alias("low"), F.max("body").alias("high"))
    return span.where("n > 1 and low <> high").select("digest")


def classify(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    spark, entries = docs.sparkSession, digested(docs, digest_bytes)
    index = DigestIndex(spark)
    rows = index.flush(entries)
    kept = index.compact()
    clash = stored(colliding(docs, hit_filter(kept), digest_bytes), "digest-clash")
    if not clash.isEmpty():
        # The whole digest tells such texts apart; equal bytes keep equal keys.
        told = rows.join(clash.withColumn("clash", F.lit(True)), "digest", "left")
        index = DigestIndex(spark)
        rows = index.flush(told.select("doc_id", "length", F.when(F.col("clash"), F.unhex("text_sha256")).otherwise(F.col("digest")).alias("digest"), "text_sha256"))
        kept = index.compact()
    return rows.join(kept, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each class of equal texts."""
    keepers = classify(docs).where("kept").select("doc_id", F.col("text_sha256").alias("_qm_sha")).distinct()
    keyed = docs.withColumn("_qm_sha", F.sha2(normalised(), 256))
    return keep_listed(keyed, keepers, ["doc_id", "_qm_sha"], (-F.length(text_or_empty()))).drop("_qm_sha").select(*docs.columns)
