"""Helpers shared by the corpus operators: shared tables, hashing, components."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from atexit import register
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of every contract: space and \t \n \v \f \r.
SPACE_CLASS = r"[\x20\x09-\x0D]"

#: Characters of a piece of a text, and rows of a batch that a Python worker gets: it and
#: its executor hold one batch of pieces and the longest text, whatever the others' lengths.
PIECE, BATCH_ROWS = 1 << 16, 256
#: Edges that one task contracts at once.
CHUNK_EDGES = 1 << 19

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors see.

    It is the one in ``spark.checkpoint.dir``. Only where that is unset (a local
    session, as in tests) a temporary folder is made and removed at exit.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    app = spark.sparkContext.applicationId
    if base:
        return f"{base.rstrip('/')}/quadmill-{app}"
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="quadmill-")
        register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return f"file://{_own_dirs[app]}"


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once, and
    a lost executor costs a read of the files instead of the work before them."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_pieces(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, which is in _qm_part: a long text takes several rows, one
    after the other, and _qm_end tells its last. Null is empty.

    Arrow batches are cut by rows alone, so the session's batch size is lowered to BATCH_ROWS
    and a row's text to PIECE characters: that bounds a batch in bytes.
    """
    spark, setting = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)
    body = text_or_empty(text)
    parts = F.when(F.length(body) <= PIECE, F.array(body)).otherwise(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    own = [c for c in df.columns if c != text]
    cut = df.select(*own, parts.alias("_qm_parts")).select(*own, F.size("_qm_parts").alias("_qm_n"), F.posexplode("_qm_parts").alias("_qm_at", "_qm_part"))
    return cut.select(*own, "_qm_part", (F.col("_qm_at") == F.col("_qm_n") - 1).alias("_qm_end"))


def whole_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of ``text_pieces`` with whole texts, in _qm_text."""
    held: list[str] = []
    for batch in batches:
        ends, texts = batch["_qm_end"].to_numpy(bool), []
        for part, end in zip(batch["_qm_part"], ends):
            held.append(part)
            if end:
                texts.append(part if len(held) == 1 else "".join(held))
                held = []
        if texts:
            yield batch[ends].drop(columns=["_qm_part", "_qm_end"]).assign(_qm_text=texts).reset_index(drop=True)


def keep_listed(docs: DataFrame, keepers: DataFrame, keys: list[str], tie: Column) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` are in ``keepers`` (distinct), one row a key.

    ``keys`` hold doc_id, so no key is hot. ``tie`` orders rows that repeat a key.
    """
    from pyspark.sql import Window

    row = F.row_number().over(Window.partitionBy(*keys).orderBy(tie))
    return docs.join(keepers, keys, "left_semi").withColumn("_qm_row", row).where("_qm_row = 1").drop("_qm_row")


def forest(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for each node of the edges that isn't the smallest of its component."""
    ids, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b, parent = at[: len(src)], at[len(src) :], np.arange(len(ids))
    while True:
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            break
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (parent[parent] != parent).any():
            parent = parent[parent]
        a, b = a[apart], b[apart]
    below = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[below], ids[parent[below]]


def contracted(edges: DataFrame, chunks: int) -> DataFrame:
    """A spanning forest (src, dst) of each of ``chunks`` even parts of the edges."""

    def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        src, dst, held = [], [], 0
        for batch in batches:
            src.append(batch["src"].to_numpy(np.int64))
            dst.append(batch["dst"].to_numpy(np.int64))
            held += len(batch)
            if held >= 2 * CHUNK_EDGES:  # no part is that large, unless a retry dealt unevenly
                node, root = forest(np.concatenate(src), np.concatenate(dst))
                src, dst, held = [node], [root], len(node)
                if held >= CHUNK_EDGES:
                    yield pd.DataFrame({"src": node, "dst": root})
                    src, dst, held = [], [], 0
        if held:
            node, root = forest(np.concatenate(src), np.concatenate(dst))
            yield pd.DataFrame({"src": node, "dst": root})

    return edges.repartition(chunks).mapInPandas(contract, "src bigint, dst bigint")


def connected_components(edges: DataFrame, name: str = "components", native: bool = False) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst), null ends left out;
    component is the smallest node that can be reached.

    Unless ``native``, tasks first contract parts of CHUNK_EDGES edges to spanning forests;
    where that is one part, it is the result. Then large-star and small-star steps alternate.
    A step's smallest neighbours are stored, so that its join has nothing but scans below its
    exchanges and the rows of a node with very many neighbours are split at run time. Each
    round is written to the shared folder; rounds grow with the logarithm of the longest path.
    """

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.union(pairs.select("dst", "src")) if large else pairs
        lowest = both.groupBy(F.col("src").alias("n")).agg(F.min("dst").alias("low"))
        lowest = stored(lowest.select("n", F.least("n", "low").alias("low")), f"{name}-lowest")
        joined = both.join(lowest, both["src"] == lowest["n"])
        if large:
            out = joined.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        else:
            out = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).union(
                lowest.select(F.col("n").alias("src"), F.col("low").alias("dst"))
            )
        return out.where("src <> dst").distinct()

    def sign(pairs: DataFrame) -> tuple:
        row = pairs.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h"),
        ).first()
        return row["n"], row["h"]

    high, low = F.greatest("src", "dst"), F.least("src", "dst")
    now = stored(edges.where("src <> dst").select(high.alias("src"), low.alias("dst")).distinct(), name)
    chunks = 0 if native else -(-now.count() // CHUNK_EDGES)
    if chunks:
        now = stored(contracted(now, chunks), name)
    if chunks != 1:
        before, seen = None, sign(now)
        while seen[0] and seen != before:
            now = stored(star(star(now, True), False), name)
            before, seen = seen, sign(now)
    roots = now.select(F.col("dst").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
