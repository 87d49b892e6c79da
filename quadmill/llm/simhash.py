"""SimHash near-dedup with pivot distance tables.

The 64 bits are dealt out to bands, and a table is kept for each choice of all bands but
LINK_BITS: two fingerprints that differ in at most LINK_BITS bits agree on all bits of one
of these choices. A table has its own reference fingerprints, which differ from each other
on its bits alone, so that a fingerprint's distances to them are distances within its bits.
A fingerprint's row holds these distances, precomputed, for all tables. Pairs whose
coordinates are all equal in one table are the candidates; that is an equality join, which
random references could not give, as their distances are alike for most fingerprints. Of
the candidates, a difference of more than LINK_BITS in any coordinate of any table discards
the pair (triangle inequality); survivors are verified on all bits. Tables of more bands
pin more bits: their number follows the number of fingerprints, so that what meets in a
cell by chance stays a constant (3 tables of 21 bits, 6 of 32, 10 of 38).

Where near copies crowd a cell, with more than ``CELL_ROWS`` fingerprints, pairs would be
the square of the crowd. Each of its members is filed under the 65 fingerprints at distance
0 or 1 instead; two members within two bits share one of these (a midpoint), and everything
filed under one midpoint is within two bits, so that links come without pairs, exactly. At
most 65 members can be filed under a midpoint.

Edge cases: null text is empty; a text without words has fingerprint zero and links
like others; repeated rows share a class; an empty table gives an empty result; other
columns are carried or ignored, never renamed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, stored, text_or_empty, text_pieces, whole_texts

SEED = 42
SHINGLE_WORDS = 3
LINK_BITS = 2
PIVOTS = 10
CELL_ROWS = 32
#: Fingerprints up to which so many bands do.
BANDS = ((1 << 21, 3), (1 << 31, 4), (1 << 62, 5))
CHUNK = 1 << 15
#: Of the filter: words of a shingle, similarity that links, hashes of a sketch.
NEAR_WORDS, SIMILARITY = 5, 0.8
SKETCH = 64
#: How far below the similarity a sketch's estimate discards a pair (six standard errors); of the
#: order of shingles: one in so many texts is counted, and so many shingles are kept.
SLACK, SAMPLE, COMMON = 0.3, 64, 1 << 17

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash; shingles are hashed in chunks, so memory is bounded."""
    words = WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        part = words[at : min(at + CHUNK, n) + shingle_words - 1]
        if n == 1:
            hashes = [digest(b" ".join(part), SEED)]
        else:
            hashes = [digest(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(shingle_words)))]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of each row; whole texts, of which a task holds one batch."""

    def simhash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in whole_texts(batches):
            found = np.array([fingerprint(t, shingle_words) for t in batch["_qm_text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": found.astype(np.int64)})

    texts = text_pieces(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"))
    return texts.mapInPandas(simhash, "doc_id string, fp bigint").select(F.col("doc_id").cast("bigint").alias("doc_id"), "fp")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def bands_for(n: int) -> int:
    return next(bands for most, bands in BANDS if n <= most)


def table_masks(bands: int) -> list[int]:
    """Bits of each table, as unsigned masks: all choices of ``bands`` - LINK_BITS bands."""
    own = [sum(1 << i for i in range(64) if i * bands // 64 == b) for b in range(bands)]
    return [sum(chosen) for chosen in combinations(own, bands - LINK_BITS)]


def pivots(bands: int) -> list[list[int]]:
    """Reference fingerprints of each table, drawn once from a fixed seed."""
    rng = np.random.default_rng(20_240_607)
    draw = lambda: int(rng.integers(0, 1 << 63, dtype=np.uint64)) << 1 ^ int(rng.integers(0, 1 << 63, dtype=np.uint64)) >> 7
    return [[draw() & mask for _ in range(PIVOTS)] for mask in table_masks(bands)]


def pivot_table(fps: DataFrame, bands: int) -> DataFrame:
    """fp and its distances to each table's references, six bits each, packed in p0, p1, ..."""
    out = []
    for k, (mask, row) in enumerate(zip(table_masks(bands), pivots(bands))):
        inside = F.col("fp").bitwiseAND(F.lit(signed(mask)))
        distances = [F.bit_count(inside.bitwiseXOR(F.lit(signed(p)))).cast("bigint") for p in row]
        out.append(reduce(lambda a, b: F.shiftleft(a, 6).bitwiseOR(b), distances).alias(f"p{k}"))
    return fps.select("fp", *out)


def coordinate_gap(a: Column, b: Column) -> Column:
    """Largest difference of two packed rows of coordinates."""
    six = lambda x, i: F.shiftrightunsigned(x, 6 * i).bitwiseAND(F.lit(63))
    return F.greatest(*[F.abs(six(a, i) - six(b, i)) for i in range(PIVOTS)])


def links(fps: DataFrame, bands: int | None = None) -> DataFrame:
    """Links (src, dst) that join all fingerprints within LINK_BITS bits; fps: distinct, stored."""
    bands = bands or bands_for(fps.count())
    columns = [f"p{k}" for k in range(len(table_masks(bands)))]
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("table"), F.col(p).alias("cell")) for k, p in enumerate(columns)]))
    filed = stored(pivot_table(fps, bands).select("fp", *columns, at.alias("at")).select("fp", *columns, "at.*"), "pivot-table")
    # Stored, like all sides of joins here that were aggregated: so a hot cell can be split.
    shared = stored(filed.groupBy("table", "cell").agg(F.count("*").alias("n")).where("n > 1"), "pivot-cells")
    crowd = stored(filed.join(shared, ["table", "cell"]), "pivot-crowd")

    few = crowd.where(F.col("n") <= CELL_ROWS).groupBy("table", "cell").agg(F.array_sort(F.collect_list(F.struct("fp", *columns))).alias("rows"))
    pairs = few.select("rows", F.posexplode("rows").alias("i", "a")).select("a", F.explode(F.slice("rows", F.col("i") + 2, F.lit(CELL_ROWS))).alias("b"))
    a, b = F.col("a"), F.col("b")
    near = reduce(lambda x, y: x & y, [coordinate_gap(a[p], b[p]) <= LINK_BITS for p in columns])
    pairs = pairs.where(near).where(F.bit_count(a["fp"].bitwiseXOR(b["fp"])) <= LINK_BITS).select(a["fp"].alias("src"), b["fp"].alias("dst"))

    dense = crowd.where(F.col("n") > CELL_ROWS).select("fp").distinct()
    ball = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)])
    met = dense.select("fp", F.explode(ball).alias("mid")).groupBy("mid").agg(F.collect_list("fp").alias("fps"))
    met = met.where(F.size("fps") > 1).select(F.array_min("fps").alias("src"), F.explode("fps").alias("dst"))
    return pairs.union(met.where("src <> dst"))


def fingerprint_classes(rows: DataFrame) -> DataFrame:
    """(fp, component_id) of ``rows`` (doc_id, fp), stored."""
    first = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    linked = connected_components(links(first.select("fp")), "simhash-links").withColumnRenamed("node", "fp")
    named = stored(first.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "fingerprint-named")
    least = stored(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "fingerprint-least")
    return stored(named.join(least, "component").select("fp", "component_id"), "fingerprint-classes")


def classify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id."""
    rows = stored(fingerprints(docs), "simhash")
    return rows.join(fingerprint_classes(rows), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


# The filter: classes of similar texts ---------------------------------------------------


def similar_dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each class of near copies the row
    with the smallest doc_id.

    Two texts are linked if the SimHashes of their five-word shingles are within
    LINK_BITS (found by the pivot tables), or if their similarity, the resemblance of
    their sets of 64-bit shingle hashes, is ``similarity`` or more.

    Links of the second kind are between texts that share a shingle of their prefixes and
    whose sizes allow the similarity. A prefix is the first n - ceil(similarity * n) + 1 of a
    text's n shingles in one order of all shingles, so that each similar pair shares one: no
    pair is lost. The order puts shingles that are frequent in a sample last; exactness
    doesn't depend on the sample. By the same order, all that two texts have in common beyond
    their prefixes' common shingles is in what follows the prefix of one of them, so that
    pairs with too few common ones are discarded. Each text is compared with two leaders of each shingle
    first, one drawn by a hash and one with most shingles that are frequent in the sample (in a
    crowd of edited copies, the one edited least); that joins most of a large class at small
    cost and decides nothing else. Then all texts of a shingle that are of different classes yet
    are compared. Sketches discard pairs
    that are below by SLACK or more; all others are verified on the whole sets.

    Edge cases: null text is empty; empty texts are copies of each other; of rows that repeat
    doc_id and text one stays; an empty table gives an empty result; all columns are kept.
    """
    key = F.xxhash64("doc_id", text_or_empty())
    texts = docs.select(key.alias("node"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("body"))
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(texts))

    def measured(batches):
        for batch in whole_texts(batches):
            found = [measure(t, similarity, shared.value) for t in batch["_qm_text"]]
            out = pd.DataFrame(found, columns=["fp", "sketch", "prefix", "n", "central"])
            yield out.assign(node=batch["node"].to_numpy(), doc_id=batch["doc_id"].to_numpy(dtype=object))

    pieces = text_pieces(texts.withColumn("doc_id", F.col("doc_id").cast("string")), "body")
    rows = pieces.mapInPandas(measured, "node bigint, doc_id string, fp bigint, sketch array<int>, prefix array<bigint>, n bigint, central float")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # One row a key, so that the joins below have no aggregation beside them and their
    # skewed partitions can be split.
    rows = stored(rows.dropDuplicates(["node"]), "near-rows")
    each = stored(rows.select("node", "n", "central", F.explode("prefix").alias("shingle")), "near-prefixes")
    # Fingerprints are nodes of the graph too, so that no text is joined with its own.
    mark = lambda fp: F.xxhash64(F.lit("fp"), fp)
    close = links(stored(rows.select("fp").distinct(), "near-fingerprints"))
    edges = rows.select(F.col("node").alias("src"), mark(F.col("fp")).alias("dst")).union(close.select(mark(F.col("src")), mark(F.col("dst"))))
    edges = edges.union(leader_links(rows, each, texts, similarity))
    before = stored(connected_components(edges, "near-links"), "near-before")
    more = prefix_links(each, texts, before, similarity)
    edges = before.select(F.col("node").alias("src"), F.col("component").alias("dst")).union(more).where("src <> dst")
    classes = stored(connected_components(edges, "near-links"), "near-classes")

    own = rows.select("node", "doc_id").join(classes, "node")
    own = stored(own, "near-own")
    least = stored(own.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("least")), "near-least")
    dropped = own.join(least, "component").where(F.col("node") != F.col("least.node")).select(F.col("node").alias("_qm_node"))
    keyed = docs.withColumn("_qm_node", key)
    kept = keyed.join(dropped, "_qm_node", "left_anti")
    row = F.row_number().over(Window.partitionBy("_qm_node").orderBy("doc_id"))
    return kept.withColumn("_qm_row", row).where("_qm_row = 1").select(*docs.columns)


def shingle_set(text: str) -> np.ndarray:
    """Different hashes of a text's five-word shingles, in order."""
    words = WORDS.findall(text.encode("utf-8", "surrogatepass").lower())
    if not words:
        return np.zeros(0, np.uint64)
    digest, n = xxhash.xxh64_intdigest, len(words) - NEAR_WORDS + 1
    shingles = zip(*(words[i:] for i in range(NEAR_WORDS))) if n > 1 else [words]
    return np.unique(np.array([digest(b" ".join(s), SEED) for s in shingles], np.uint64))


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles most frequent in a sample, sorted, and their frequencies there."""

    def sets(batches):
        for batch in whole_texts(batches):
            for body in batch["_qm_text"]:
                yield pd.DataFrame({"shingle": shingle_set(body).view(np.int64)})

    sample = text_pieces(texts.where(F.pmod("node", F.lit(SAMPLE)) == 0).select("node", "body"), "body").mapInPandas(sets, "shingle bigint")
    top = sample.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").orderBy(F.desc("n"), "shingle").limit(COMMON).toPandas()
    shingles = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], top["n"].to_numpy(np.int64)[order]


def prefix_of(shingles: np.ndarray, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, float]:
    """A set's prefix, and the share of its shingles that are common."""
    n, (known, times) = len(shingles), common
    rank = np.zeros(n, np.int64)
    if len(known) and n:
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        rank = np.where(known[at] == shingles, times[at], 0)
    most = n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0
    return shingles[np.lexsort((shingles, rank))[:most]].view(np.int64), float((rank > 0).mean()) if n else 0.0


def measure(text: str, similarity: float, common: tuple[np.ndarray, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray, int, float]:
    """SimHash of five-word shingles, their sketch, prefix, number, and how common they are."""
    words = WORDS.findall(text.encode("utf-8", "surrogatepass").lower())
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - NEAR_WORDS + 1)
    if not words:
        return 0, np.zeros(0, np.int32), np.zeros(0, np.int64), 0, 0.0
    ones, sketch, every = np.zeros(64, np.int64), np.zeros(0, np.uint32), []
    for at in range(0, n, CHUNK):
        part = words[at : min(at + CHUNK, n) + NEAR_WORDS - 1]
        shingles = zip(*(part[i:] for i in range(NEAR_WORDS))) if n > 1 else [part]
        hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        every.append(np.unique(hashes.astype(np.uint64)))
        sketch = np.unique(np.concatenate([sketch, (hashes & 0xFFFFFFFF).astype(np.uint32)]))[:SKETCH]
    value = int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")
    whole = np.unique(np.concatenate(every))
    prefix, central = prefix_of(whole, similarity, common)
    return signed(value), sketch.view(np.int32), prefix, len(whole), central


def fitting(n: Column, other: Column, similarity: float) -> Column:
    return (other >= n * similarity - 1e-9) & (n >= other * similarity - 1e-9)


def leader_links(rows: DataFrame, each: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Verified links (src, dst) of texts with the leaders of their shingles; ``each``: node, n, central, shingle."""
    own, draw = F.struct(F.col("node").alias("to"), F.col("n").alias("m")), F.xxhash64("node")
    leaders = F.array_distinct(F.array(F.min_by(own, draw), F.max_by(own, F.struct("central", draw))))
    shared = stored(each.groupBy("shingle").agg(F.count("*").alias("times"), leaders.alias("lead")).where("times > 1"), "near-leaders")
    pairs = each.join(shared, "shingle").select("node", "n", F.inline("lead")).where(fitting(F.col("n"), F.col("m"), similarity) & (F.col("node") != F.col("to")))
    pairs = pairs.select(F.least("node", "to").alias("src"), F.greatest("node", "to").alias("dst")).distinct()
    return verified(stored(pairs, "near-pairs"), rows, texts, similarity)


def prefix_links(each: DataFrame, texts: DataFrame, before: DataFrame, similarity: float) -> DataFrame:
    """Verified links (src, dst) of all texts that are in different classes of ``before`` and share a shingle of ``each``."""
    own = stored(each.drop("central").join(before, "node", "left").withColumn("component", F.coalesce("component", "node")), "near-own-prefixes")
    shared = own.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("shingle")
    met = stored(own.join(stored(shared, "near-apart"), "shingle"), "near-shared")
    other = met.select("shingle", F.col("node").alias("node2"), F.col("component").alias("component2"), F.col("n").alias("n2"))
    pairs = met.join(other, "shingle").where((F.col("component") < F.col("component2")) & fitting(F.col("n"), F.col("n2"), similarity))
    pairs = pairs.groupBy(F.col("node").alias("src"), F.col("node2").alias("dst"), "n", "n2").agg(F.count("*").alias("common"))
    after = lambda n: F.ceil(n * similarity - 1e-9) - 1  # noqa: E731  shingles behind the prefix of n
    most = F.col("common") + F.greatest(after(F.col("n")), after(F.col("n2")))
    pairs = pairs.where(most * (1 + similarity) >= (F.col("n") + F.col("n2")) * similarity - 1e-6)
    return verified(stored(pairs.select("src", "dst"), "near-prefix-pairs"), None, texts, similarity)


def beside(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs with both sides' column as a and b. A node can be the partner of many: the first
    join is stored, so that each join stands alone and its hot keys are dealt out."""
    half = stored(pairs.join(table.select(F.col("node").alias("src"), F.col(column).alias("a")), "src"), "near-halves")
    return half.join(table.select(F.col("node").alias("dst"), F.col(column).alias("b")), "dst")


def verified(pairs: DataFrame, rows: DataFrame | None, texts: DataFrame, similarity: float) -> DataFrame:
    """The stored pairs (src, dst) of ``similarity`` or more: sketches of ``rows``, if given,
    discard clear others, whole sets decide."""

    # What the sketches have in common is at least the union's smallest hashes that both texts have.
    likely = F.size(F.array_intersect("a", "b")) >= F.greatest(F.size("a"), F.size("b")) * (similarity - SLACK)

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        sets = {}  # of this batch: a leader is in many of its pairs

        def similar(x, y):
            x, y = (sets[t] if t in sets else sets.setdefault(t, shingle_set(t)) for t in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            return both >= similarity * (len(x) + len(y) - both) - 1e-9

        return pd.Series([similar(x, y) for x, y in zip(a, b)], dtype="bool")

    left = stored(beside(pairs, rows, "sketch").where(likely).select("src", "dst"), "near-likely") if rows else pairs
    need = stored(left.select(F.col("src").alias("node")).union(left.select("dst")).distinct(), "near-needed")
    bodies = stored(texts.select("node", "body").join(need, "node", "left_semi").dropDuplicates(["node"]), "near-bodies")
    return stored(beside(left, bodies, "body").where(alike("a", "b")).select("src", "dst"), "near-alike")
