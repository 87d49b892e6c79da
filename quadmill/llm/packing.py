"""Best-fit packing of token pieces into sequences under several capacities.

A document's tokens are cut into pieces (only if it is too long). A sequence has three
capacities: tokens, documents and attention cost (the sum of squared piece lengths).
By default the token capacity alone can bind: a sequence of 1024 tokens has at most 1024
pieces, and their squares add up to 1024 * 1024 at most. The other two bind where a caller
sets them lower, at the cost of more sequences. A piece's demand depends on its length alone, so the corpus is summed up exactly by
the number of pieces of each length. The driver packs these classes, longest first:
each goes to the open sequences that have room under every capacity and the smallest
weighted norm of what would be left (or the largest weighted dot product of demand
and room). Sequences in the same state are handled as one, so planning costs the
square of the token capacity at most, whatever the number of documents, and it loses
nothing at partition borders. Pieces then take their places by their rank within
their length, which counts by length and rank bucket make global. The number of buckets follows
that of the pieces, so that pieces of one length are ranked in tasks of bounded size.

Edge cases: null text is empty and has one piece, the end id alone; very long texts
have many pieces; repeated rows are packed as often as they come; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_pieces, whole_texts

END_ID = 2
#: Least number of rank buckets, and pieces to which there is one more.
RANK_BUCKETS, BUCKET_PIECES = 256, 1 << 18
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Capacities:
    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    select: str = "norm"

    @property
    def piece_tokens(self) -> int:
        """The longest piece that fits an empty sequence."""
        return min(self.tokens, math.isqrt(self.attention))


@dataclass(frozen=True)
class TokenizerFiles:
    """A byte-level BPE for ``tokenizers``; ``ranks``: the same vocabulary for tiktoken,
    which gives the same ids in a quarter of the time, and its pattern."""

    json: str
    ranks: str | None = None
    pattern: str | None = None


def public_files() -> TokenizerFiles:
    import public_tokenizers as public

    return TokenizerFiles(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


_encoders: dict[TokenizerFiles, object] = {}


def encoder(files: TokenizerFiles):
    """text -> ids. Texts that contain an added token's string go to ``tokenizers``."""
    if files not in _encoders:
        import base64

        from tokenizers import Tokenizer

        slow = Tokenizer.from_file(files.json)
        added = [t.content for t in slow.get_added_tokens_decoder().values()]

        def by_tokenizers(text: str) -> list[int]:
            return slow.encode(text, add_special_tokens=False).ids

        encode = by_tokenizers
        if files.ranks:
            import tiktoken

            with open(files.ranks, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
            probe = "It's 12,345 cafés — 你好\n\n  x\t\U0001f600 don't"
            if fast.encode_ordinary(probe) != by_tokenizers(probe):
                raise ValueError(f"{files.ranks} and {files.json} differ")

            def encode(text: str) -> list[int]:
                if any(a in text for a in added):
                    return by_tokenizers(text)
                return fast.encode_ordinary(text)

        _encoders[files] = encode
    return _encoders[files]


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; the first takes what is over."""
    if n <= most:
        return [(0, n)]
    first = n % most
    return ([(0, first)] if first else []) + [(at, most) for at in range(first, n, most)]


def pieces(docs: DataFrame, files: TokenizerFiles, most: int, with_ids: bool = False) -> DataFrame:
    """Tokenise: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(files)
        for batch in whole_texts(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["_qm_text"]):
                ids = np.array([*encode(text), END_ID], dtype="<u4")
                for k, (at, n) in enumerate(cuts(len(ids), most)):
                    part = ids[at : at + n]
                    row = (doc_id, k, at, n, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pd.DataFrame(rows, columns=names)

    texts = text_pieces(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"))
    cut = texts.mapInPandas(tokenise, PIECES.replace("doc_id bigint", "doc_id string") + ", ids array<int>" * with_ids)
    return cut.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def plan(counts: dict[int, int], cap: Capacities) -> tuple[np.ndarray, int]:
    """Places for counts[length] pieces of each length, and the number of sequences.

    A row of the places: length, first rank, pieces a sequence, first sequence, offset.
    The piece of rank r there is in sequence first + (r - first rank) // pieces.
    """
    full = np.array([cap.tokens, cap.documents, cap.attention], dtype=np.float64)
    weights = np.array(cap.weights)
    room = np.empty((0, 3), np.int64)  # of each state: what is left of each capacity
    number = np.empty(0, np.int64)  # sequences in that state
    first = np.empty(0, np.int64)  # the first of them; they are consecutive
    places: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        need = np.array([length, 1, length * length], dtype=np.int64)
        left, rank = counts[length], 0
        fits = np.flatnonzero((room >= need).all(axis=1))
        if cap.select == "dot":
            score = -((room[fits] / full) * (need / full) * weights).sum(axis=1)
            each = np.ones(len(fits), np.int64)
        else:
            score = (weights * ((room[fits] - need) / full) ** 2).sum(axis=1)
            each = (room[fits] // need).min(axis=1)
        drop, add_room, add_number, add_first = [], [], [], []

        def put(state: int, sequences: int, start: int, k: int) -> None:
            nonlocal rank, left
            places.append((length, rank, k, start, int(cap.tokens - room[state, 0])))
            add_room.append(room[state] - k * need)
            add_number.append(sequences)
            add_first.append(start)
            rank += sequences * k
            left -= sequences * k

        for i in np.argsort(score, kind="stable"):
            if not left:
                break
            state, k = int(fits[i]), int(each[i])
            have, start = int(number[state]), int(first[state])
            whole = min(have, left // k)
            used = whole
            if whole:
                put(state, whole, start, k)
            if left and whole < have:
                put(state, 1, start + whole, left)
                used += 1
            if used == have:
                drop.append(state)
            else:
                number[state], first[state] = have - used, start + used
        if left:
            k = int((full.astype(np.int64) // need).min())
            for sequences, n in ((left // k, k), (1 if left % k else 0, left % k)):
                if sequences:
                    places.append((length, rank, n, opened, 0))
                    add_room.append(full.astype(np.int64) - n * need)
                    add_number.append(sequences)
                    add_first.append(opened)
                    rank, opened = rank + sequences * n, opened + sequences
        keep = np.ones(len(number), bool)
        keep[drop] = False
        if add_room:
            room = np.vstack([room[keep], np.array(add_room, dtype=np.int64)])
            number = np.concatenate([number[keep], np.array(add_number, dtype=np.int64)])
            first = np.concatenate([first[keep], np.array(add_first, dtype=np.int64)])
    return np.array(places, dtype=np.int64).reshape(-1, 5), opened


def placed(cut: DataFrame, cap: Capacities) -> DataFrame:
    """``cut`` (stored pieces) with sequence_id and offset."""
    whole = (F.col("length") == cap.tokens) & F.lit(cap.attention >= cap.tokens**2)
    buckets = max(RANK_BUCKETS, cut.count() // BUCKET_PIECES)
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    part = cut.where(~whole).withColumn("_qm_bucket", bucket)
    sums = stored(part.groupBy("length", "_qm_bucket").agg(F.count("*").alias("_qm_n")), "rank-buckets")
    # At most a row for each length, whatever the input.
    totals = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("_qm_n").alias("n")).collect()}
    places, opened = plan(totals, cap)
    order = np.argsort(places[:, 0] << 40 | places[:, 1], kind="stable")
    places, order_key = places[order], (places[:, 0] << 40 | places[:, 1])[order]
    columns = [f.name for f in cut.schema.fields]

    def seat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            rank = (batch["_qm_base"] + batch["_qm_rank"]).to_numpy(np.int64) - 1
            row = places[np.searchsorted(order_key, length << 40 | rank, side="right") - 1] if len(places) else places
            place, inside = np.divmod(rank - row[:, 1], row[:, 2])
            yield batch[columns].assign(sequence_id=row[:, 3] + place, offset=row[:, 4] + inside * length)

    before = Window.partitionBy("length").orderBy("_qm_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("length", "_qm_bucket", F.coalesce(F.sum("_qm_n").over(before), F.lit(0)).alias("_qm_base"))
    ranked = part.withColumn(
        "_qm_rank", F.row_number().over(Window.partitionBy("length", "_qm_bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ).join(base, ["length", "_qm_bucket"]).select(*columns, "_qm_rank", "_qm_base")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    seated = ranked.mapInPandas(seat, f"{kinds}, sequence_id bigint, offset bigint")
    alone = cut.where(whole).select(
        *columns, (F.monotonically_increasing_id() + F.lit(opened)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return seated.union(alone)


def pack(docs: DataFrame, files: TokenizerFiles | None = None, cap: Capacities | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    cap = cap or Capacities()
    cut = stored(pieces(docs, files or public_files(), cap.piece_tokens, with_ids), "pieces")
    return placed(cut, cap)
