"""Scores of a smoothed n-gram model of all words, by a weighted backoff automaton.

The lowest order is the contract's base: all words of all training documents, each
with half a count more, and one share for words never seen. Above it stand all bigrams
and all trigrams of the training documents, with absolute discounting: after a context h
a word w weighs (c(hw) - D) / c(h), if it was seen there, plus D * t(h) / c(h) times the
lower order's probability, t(h) being the different words seen after h; an unseen context
leaves all to the lower order. A text's first word has no context, its second has one
word. Every word but the end is followed by another, so c(h) is h's own count.

As an automaton: states are the contexts seen (none, a word, two words); an arc reads a
word seen after its state, weighs the logarithm of its probability there and leads to the
longest state that the words read end in; a failure arc weighs log D * t(h) / c(h) and
leads to the state without the first word. A text is read once from left to right: from
the state carried, failure arcs are followed up to a state that has an arc for the word.

No model is broadcast. Documents are stored as chunks of about ``CHUNK`` tokens, and each
chunk gets the part of the automaton that its own words can reach. It sends its different
trigrams, grouped by their first two words, to buckets of hashes, whose number grows with
the input; a bucket adds up, and answers each chunk with the counts of what it sent. One
chunk is told that it owns a bigram, so that the chunks can add up t of single words;
these go to buckets in a second round. An n-gram is sent once a chunk, so frequent ones
are no burden. A task holds the arrays of one chunk (or of its longest document).

Words are told apart by 64-bit hashes, contexts of two by 56 bits, and the words after
one such context by 32. Edge cases: null text is empty, and has the end alone; repeated
rows give repeated results and are learned from as often; a null doc_id is learned from;
with no training documents every word is unseen; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_pieces, whole_texts

DISCOUNT = 0.75
HELD_OUT, OUT_OF = 1, 5
#: Tokens of a chunk and of a bucket, about; and the least number of buckets.
CHUNK, BUCKET, BUCKETS = 1 << 18, 1 << 19, 32
#: The root, words, and pairs of words.
ORDERS = (0, 1, 2)


def signed_hash(word: bytes) -> int:
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


#: No word has a space, so the end can't be taken for one.
END = signed_hash(b" end")


def token_hashes(text: str | None) -> list[int]:
    """Hashes of a text's lower-cased words, then the end."""
    digest = xxhash.xxh64_intdigest
    return [*map(digest, (text or "").encode("utf-8", "surrogatepass").lower().split()), END & (1 << 64) - 1]


def parts(batch: pd.DataFrame, most: int = 1 << 22) -> Iterator[pd.DataFrame]:
    """A batch in slices of about ``most`` characters, so that hashing them takes bounded memory."""
    size = batch["_qm_text"].str.len().cumsum() // most
    for _, rows in batch.groupby(size.to_numpy(), sort=False):
        yield rows


def hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some texts as signed hashes, and where each text ends."""
    each = [token_hashes(t) for t in texts]
    flat = np.fromiter((h for row in each for h in row), np.uint64).astype(np.int64)
    return flat, np.cumsum([len(row) for row in each])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % OUT_OF == HELD_OUT, F.lit(False))


def packed(values: np.ndarray, small: bool = True) -> bytes:
    """Whole numbers from 0 as planes of bytes, as many as the largest needs; deflated if ``small``."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return bytes([width]) + (zlib.compress(planes, 1) if small else planes)


def unpacked(blob: bytes, small: bool = True) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob[1:]) if small else blob[1:], np.uint8).reshape(blob[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : blob[0]] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """56-bit hashes of pairs of words."""
    h = (a ^ a >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ h >> np.uint64(32)) >> np.uint64(8)


def make_chunks(docs: DataFrame) -> DataFrame:
    """The documents' tokens: different words of a chunk, frequent ones first, and their places."""

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, number = TaskContext.get().partitionId() << 32, 0
        ids, held, flats, sizes, size = [], [], [], [], 0

        def chunk() -> pd.DataFrame:
            words, codes, counts = np.unique(np.concatenate(flats).view(np.uint64), return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            row = {"chunk": first + number, "doc_id": ids, "held_out": held, "size": sizes, "words": words[order].tobytes(), "codes": packed(rank[codes])}
            return pd.DataFrame({**{k: [v] for k, v in row.items()}, "tokens": [size]})

        for batch in (p for b in whole_texts(batches) for p in parts(b)):
            flat, ends = hashes(batch["_qm_text"])
            ids += [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            held += batch["held_out"].tolist()
            sizes += np.diff(ends, prepend=0).tolist()
            flats.append(flat)
            size += len(flat)
            if size >= CHUNK:
                yield chunk()
                number += 1
                ids, held, flats, sizes, size = [], [], [], [], 0
        if flats:
            yield chunk()

    rows = text_pieces(docs.select(F.col("doc_id").cast("string").alias("doc_id"), held_out().alias("held_out"), "text"))
    kinds = "chunk bigint, doc_id array<bigint>, held_out array<boolean>, size array<bigint>, words binary, codes binary, tokens bigint"
    return stored(rows.mapInPandas(chunks, kinds), "lm-chunks")


def bucket_cuts(keys: np.ndarray, bits: int, buckets: int) -> tuple[list[int], list[int]]:
    """Where the keys of each bucket that has any begin among sorted keys (and their end), and
    the buckets; they divide the keys' range evenly."""
    of = ((keys >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cut = np.flatnonzero(np.diff(of, prepend=-1))
    return [*cut.tolist(), len(keys)], of[cut].tolist()


class Chunk:
    """A chunk's words, its pairs of words, and what follows the pairs (0 after the end)."""

    def __init__(self, row):
        self.size = np.array(row["size"], np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.codes = unpacked(row["codes"]).astype(np.int64)
        learned = np.repeat(~np.array(row["held_out"], bool), self.size)
        self.learned = learned
        starts = np.zeros(len(self.codes), bool)
        starts[np.cumsum(self.size) - self.size] = True
        #: Where the second word of each pair stands, and where a third follows.
        self.second = np.flatnonzero(~starts)
        flat = self.words[self.codes]
        self.pairs, self.pair = np.unique(mixed(flat[self.second - 1], flat[self.second]), return_inverse=True)
        follow = np.append(flat[1:], np.uint64(0))[self.second] & np.uint64(0xFFFFFFFF)
        self.last = np.append(starts[1:], True)[self.second]
        follow[self.last] = 0
        keys, self.triple = np.unique(self.pair.astype(np.uint64) << np.uint64(32) | follow, return_inverse=True)
        self.follow, self.of = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)).astype(np.int64)
        self.triple_count = np.bincount(self.triple, learned[self.second], len(keys)).astype(np.int64)

    def send_triples(self, chunk: int, buckets: int) -> pd.DataFrame:
        cut, names = bucket_cuts(self.pairs, 56, buckets)
        inner = np.searchsorted(self.of, cut).tolist()
        each = np.bincount(self.of, minlength=len(self.pairs))
        rows = []
        for k, b in enumerate(names):
            p, t = slice(cut[k], cut[k + 1]), slice(inner[k], inner[k + 1])
            step = np.diff(self.pairs[p], prepend=np.uint64(0))
            rows.append((chunk, b, packed(step, False), packed(each[p]), packed(self.follow[t], False), packed(self.triple_count[t])))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "keys", "each", "follow", "count"])

    def read_triples(self, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("bucket")
        whole = lambda name: np.concatenate([unpacked(x) for x in rows[name]] or [np.zeros(0, np.uint64)]).astype(np.int64)
        self.c3, self.c2, self.t3 = map(whole, ("count", "total", "types"))

    def sorted_words(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(self.words)
        return order, self.words[order]

    def send_words(self, chunk: int, buckets: int) -> pd.DataFrame:
        """Words, their counts, and the bigrams that begin with them and that this chunk owns."""
        count = np.bincount(self.codes, self.learned, len(self.words)).astype(np.int64)
        where = np.empty(len(self.pairs), np.int64)
        where[self.pair] = self.codes[self.second - 1]
        types = np.bincount(where, self.owned, len(self.words)).astype(np.int64)
        order, words = self.sorted_words()
        (cut, names), rows = bucket_cuts(words, 64, buckets), []
        for k, b in enumerate(names):
            p = slice(cut[k], cut[k + 1])
            step = np.diff(words[p], prepend=np.uint64(0))
            rows.append((chunk, b, packed(step, False), packed(count[order[p]]), packed(types[order[p]])))
        return pd.DataFrame(rows, columns=["chunk", "bucket", "keys", "count", "types"])

    def scores(self, rows: pd.DataFrame, n: int, v: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each document: known words, base score, score."""
        rows = rows.sort_values("bucket")
        order, _ = self.sorted_words()
        c1, t2 = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for into, name in ((c1, "count"), (t2, "types")):
            into[order] = np.concatenate([unpacked(x) for x in rows[name]]).astype(np.int64)
        machine = Automaton(self, c1, t2, n, v)
        starts = np.cumsum(self.size) - self.size
        add = lambda x: np.add.reduceat(x, starts)
        return add((c1[self.codes] > 0).astype(np.int64)), add(machine.arcs[0]), add(machine.traverse())


class Automaton:
    """What a chunk's documents reach of the automaton, laid out along their tokens.

    Before a token stand up to three states that its text could be in: the root, the word
    before it, the two words before it. ``arcs[k]`` is the weight of the token's arc from the
    state of order k (NaN: it has none), ``fail[k]`` that of this state's failure arc, and
    ``target`` the order of the state that an arc of the token leads to.
    """

    def __init__(self, chunk: Chunk, c1: np.ndarray, t2: np.ndarray, n: int, v: int):
        size, second = len(chunk.codes), chunk.second
        base = ((c1 + 0.5) / (n + 0.5 * (v + 1)))[chunk.codes]
        none = lambda: np.full(size, np.nan)
        self.arcs, self.fail, p = [np.log10(base), none(), none()], [np.zeros(size), none(), none()], base.copy()
        # From a word; the state is there if the word was learned.
        before = chunk.codes[second - 1]
        c, whole, more = chunk.c2[chunk.pair], c1[before], DISCOUNT * t2[before]
        self._state(1, second[whole > 0], c[whole > 0], whole[whole > 0], more[whole > 0], p)
        # From two words; a pair with a word after it is that word's context.
        at = np.flatnonzero(~chunk.last)
        third, pair = second[at] + 1, chunk.pair[at]
        c, whole, more = chunk.c3[chunk.triple[at]], chunk.c2[pair], DISCOUNT * chunk.t3[pair]
        self._state(2, third[whole > 0], c[whole > 0], whole[whole > 0], more[whole > 0], p)
        self.target = (c1[chunk.codes] > 0).astype(np.int8)
        self.target[second[chunk.c2[chunk.pair] > 0]] = 2
        self.starts = np.cumsum(chunk.size) - chunk.size

    def _state(self, k: int, at: np.ndarray, count: np.ndarray, whole: np.ndarray, more: np.ndarray, p: np.ndarray) -> None:
        """Arcs and failure arcs of the states of order k at tokens ``at``; p: the tokens'
        probabilities from the states below, which become those from these states."""
        share = more / whole
        p[at] = np.maximum(count - DISCOUNT, 0) / whole + share * p[at]
        self.fail[k][at] = np.log10(share)
        self.arcs[k][at] = np.where(count > 0, np.log10(p[at]), np.nan)

    def traverse(self) -> np.ndarray:
        """Each token's weight. The state carried to a token is the target of the arc that the
        token before it took, and a target doesn't depend on which of a token's arcs that was;
        so the texts are read side by side, and only failure arcs are followed in turn."""
        state = np.empty(len(self.target), np.int8)
        state[1:] = self.target[:-1]
        state[self.starts] = 0
        total = np.zeros(len(state))
        for k in reversed(ORDERS):
            here = state == k
            arc = here & ~np.isnan(self.arcs[k])
            total[arc] += self.arcs[k][arc]
            fails = here & ~arc
            total[fails] += self.fail[k][fails]
            state[fails] = k - 1
        return total


def keys_of(blobs) -> list[np.ndarray]:
    return [np.cumsum(unpacked(x, False), dtype=np.uint64) for x in blobs]


def bucket_triples(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's answers: counts of triples; counts of pairs, the different words after them, and who owns them."""
    keys = keys_of(rows["keys"])
    each = [unpacked(x).astype(np.int64) for x in rows["each"]]
    pairs, pair = np.unique(np.concatenate(keys), return_inverse=True)
    of = np.repeat(pair, np.concatenate(each))
    follow = np.concatenate([unpacked(x, False) for x in rows["follow"]])
    count = np.concatenate([unpacked(x) for x in rows["count"]]).astype(np.int64)
    triples, triple = np.unique(of.astype(np.uint64) << np.uint64(32) | follow, return_inverse=True)
    c3 = np.bincount(triple, count, len(triples)).astype(np.int64)
    total = np.bincount(of, count, len(pairs)).astype(np.int64)
    types = np.bincount((triples >> np.uint64(32)).astype(np.int64)[c3 > 0], minlength=len(pairs))
    owner = np.zeros(len(pairs), np.int64)
    owner[pair[::-1]] = np.arange(len(pair))[::-1]
    owned = ((owner[pair] == np.arange(len(pair))) & (total[pair] > 0)).astype(np.int64)
    out, p, t = [], 0, 0
    for chunk, bucket, k, e in zip(rows["chunk"], rows["bucket"], keys, each):
        q, u = p + len(k), t + int(e.sum())
        out.append((chunk, bucket, packed(c3[triple[t:u]]), packed(total[pair[p:q]]), packed(types[pair[p:q]]), packed(owned[p:q])))
        p, t = q, u
    return pd.DataFrame(out, columns=["chunk", "bucket", "count", "total", "types", "owned"])


def bucket_words(rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's answers, with its own tokens and different words of the training documents."""
    keys = keys_of(rows["keys"])
    words, word = np.unique(np.concatenate(keys), return_inverse=True)
    add = lambda name: np.bincount(word, np.concatenate([unpacked(x) for x in rows[name]]).astype(float), len(words)).astype(np.int64)
    count, types = add("count"), add("types")
    out, p = [], 0
    for chunk, bucket, k in zip(rows["chunk"], rows["bucket"], keys):
        q = p + len(k)
        mine = (int(count.sum()), int((count > 0).sum())) if not p else (0, 0)
        out.append((chunk, bucket, packed(count[word[p:q]]), packed(types[word[p:q]]), *mine))
        p = q
    return pd.DataFrame(out, columns=["chunk", "bucket", "count", "types", "n", "v"])


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    chunks = make_chunks(docs)
    tokens = chunks.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    buckets = max(BUCKETS, tokens // BUCKET)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                yield Chunk(row).send_triples(row["chunk"], buckets)

    sent = chunks.mapInPandas(send, "chunk bigint, bucket int, keys binary, each binary, follow binary, count binary")
    triples = stored(sent.groupBy("bucket").applyInPandas(bucket_triples, "chunk bigint, bucket int, count binary, total binary, types binary, owned binary"), "lm-triples")

    def send_words(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own = Chunk(rows.iloc[0])
        own.owned = np.concatenate([unpacked(x) for x in answers.sort_values("bucket")["owned"]] or [np.zeros(0, np.uint64)]).astype(np.int64)
        return own.send_words(int(rows["chunk"].iloc[0]), buckets)

    sent = chunks.groupBy("chunk").cogroup(triples.select("chunk", "bucket", "owned").groupBy("chunk")).applyInPandas(send_words, "chunk bigint, bucket int, keys binary, count binary, types binary")
    words = stored(sent.groupBy("bucket").applyInPandas(bucket_words, "chunk bigint, bucket int, count binary, types binary, n bigint, v bigint"), "lm-words")
    total = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = int(total["n"] or 0), int(total["v"] or 0)

    def finish(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        own = Chunk(row)
        third = answers["total"].notna()
        own.read_triples(answers[third])
        n_known, base, full = own.scores(answers[~third], n, v)
        return pd.DataFrame({
            "doc_id": pd.array(list(row["doc_id"]), dtype="Int64"), "held_out": np.array(row["held_out"], bool), "n_tokens": own.size,
            "n_known": n_known, "train_tokens": n, "base_score": base, "score": full,
        })

    answers = triples.drop("owned").unionByName(words.drop("n", "v"), allowMissingColumns=True)
    kinds = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(finish, kinds)
