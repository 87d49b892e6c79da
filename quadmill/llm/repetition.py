"""Quality rules on repetition: what share of a text lies in duplicated n-grams and lines.

Words are hashed to 64 bits, and windows of several lengths get rolling hashes by
prefix sums, all in numpy over a text's bytes. A window whose hash occurs twice marks
its words; marked characters over all characters of words is the coverage of that
length. For short lengths it is the most frequent window alone that counts.

Edge cases: null text is empty, has no words and fails the base rule; a text shorter
than a window has coverage zero; repeated rows give repeated results; an empty table
gives an empty result; other columns are not read. Very long texts take a few arrays of
eight bytes a character.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_pieces, whole_texts

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 0.30
#: Most coverage allowed, by window length: the most frequent window, all duplicated windows.
#: A short clean text with its title line twice reaches 0.26, and no limit is below that.
TOP_COVERAGE = {2: 0.25, 3: 0.25, 4: 0.25}
ALL_COVERAGE = {5: 0.30, 6: 0.30, 7: 0.30, 8: 0.30, 9: 0.30, 10: 0.30}
LINE_SHARE = 0.50
LINE_CHARS = 0.30

_rng = np.random.default_rng(11)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
P, Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of values[start:end], equal for equal contents wherever they stand."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:], dtype=np.uint64)
    return (total[ends] - total[starts]) * powers(inverse(base), len(values) + 1)[starts]


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.concatenate([[True], SPACE[data], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[0::2], edge[1::2]


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    starts = np.arange(len(words) - n + 1)
    return spans_hash(words, starts, starts + n, Q)


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in windows of n words at ``starts``."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(text: str | None) -> dict:
    """All counts and coverages of a text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    begins = (data & 0xC0) != 0x80  # bytes that begin a code point
    starts, ends = words_of(data)
    chars_to = np.concatenate([[0], np.cumsum(begins)])
    word_chars = chars_to[ends] - chars_to[starts]
    n, total = len(starts), int(word_chars.sum())
    words = mixed(spans_hash(BYTE[data], starts, ends, P))
    out = {"n_words": n, "word_chars": total, "n_symbols": int(SYMBOL[data].sum()), "n_repeat_words": 0}
    for size in (*TOP_COVERAGE, *ALL_COVERAGE):
        share = 0.0
        if n >= size:
            found, back, count = np.unique(window_hashes(words, size), return_inverse=True, return_counts=True)
            if size in TOP_COVERAGE:
                hits = np.flatnonzero(back == count.argmax()) if count.max() > 1 else np.empty(0, np.int64)
            else:
                hits = np.flatnonzero(count[back] > 1)
            if len(hits):
                marked = covered(hits, size, n)
                share = float(word_chars[marked].sum()) / total
                if size == WINDOW:
                    out["n_repeat_words"] = int(marked.sum())
        out[f"cover_{size}"] = share
    lines = Counter(line for line in (text or "").split("\n") if line.strip("\x20\t\n\v\f\r"))
    n_lines = sum(lines.values())
    out["n_dup_lines"] = n_lines - len(lines)
    size = sum(len(line) * k for line, k in lines.items())
    out["dup_line_share"] = out["n_dup_lines"] / n_lines if n_lines else 0.0
    out["dup_line_chars"] = sum(len(line) * (k - 1) for line, k in lines.items()) / size if size else 0.0
    return out


def fails_base(m: dict) -> bool:
    return m["n_words"] < LEAST_WORDS or 100 * m["n_repeat_words"] > 100 * MOST_REPEATED * m["n_words"]


def passes(m: dict) -> bool:
    """The verdict on coverage."""
    limits = {**TOP_COVERAGE, **ALL_COVERAGE}
    return all(m[f"cover_{k}"] <= most for k, most in limits.items()) and m["dup_line_share"] <= LINE_SHARE and m["dup_line_chars"] <= LINE_CHARS


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = tuple(f"cover_{k}" for k in (*TOP_COVERAGE, *ALL_COVERAGE)) + ("dup_line_share", "dup_line_chars")


def assess(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, base_failed, kept, coverages."""
    names = ["doc_id", *COUNTS, "base_failed", "kept", *SHARES]
    kinds = ["string"] + ["bigint"] * len(COUNTS) + ["boolean"] * 2 + ["double"] * len(SHARES)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in whole_texts(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["_qm_text"]):
                m = measure(text)
                bad = fails_base(m)
                rows.append((doc_id, *[m[k] for k in COUNTS], bad, not bad and passes(m), *[m[k] for k in SHARES]))
            yield pd.DataFrame(rows, columns=names)

    texts = text_pieces(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text"))
    return texts.mapInPandas(judged, ", ".join(f"{n} {k}" for n, k in zip(names, kinds))).withColumn("doc_id", F.col("doc_id").cast("bigint"))
