"""Baseline JPEG in numpy: full color resolution, Huffman codes fitted to each picture."""

from __future__ import annotations

import heapq
import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The format's example quantisation, by rows.
LUMA = np.array(
    """16 11 10 16 24 40 51 61 12 12 14 19 26 58 60 55 14 13 16 24 40 57 69 56 14 17 22 29 51 87 80 62
    18 22 37 56 68 109 103 77 24 35 55 64 81 104 113 92 49 64 78 87 103 121 120 101 72 92 95 98 112 100 103 99""".split(), int
)
CHROMA = np.array([17, 18, 24, 47] + [99] * 4 + [18, 21, 26, 66] + [99] * 4 + [24, 26, 56] + [99] * 5 + [47, 66] + [99] * 38)

#: Diagonals of a block, in turns upwards and downwards.
ZIGZAG = np.array(sorted(range(64), key=lambda k: (k // 8 + k % 8, k // 8 if (k // 8 + k % 8) % 2 else k % 8)))
COSINES = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])
NO_SYMBOL, LONGEST = 256, 16


def quantisation(base: np.ndarray, quality: int) -> np.ndarray:
    quality = min(max(quality, 1), 100)
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((base * scale + 50) // 100, 1, 255)


def code_lengths(counts: np.ndarray) -> dict[int, int]:
    """Huffman code lengths of the symbols that occur, none above LONGEST. A symbol that
    never occurs takes the code of all ones, which the format forbids."""
    used = {int(s): int(counts[s]) for s in np.flatnonzero(counts)}
    while True:
        heap = [(n, s, (s,)) for s, n in used.items()] + [(0, NO_SYMBOL, (NO_SYMBOL,))]
        heapq.heapify(heap)
        depth = dict.fromkeys([*used, NO_SYMBOL], 0)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], max(a[1], b[1]), a[2] + b[2]))
        if max(depth.values()) <= LONGEST:
            return depth
        used = {s: n // 2 + 1 for s, n in used.items()}


def code_table(counts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The table as the file states it, and code and length of each symbol."""
    depth = code_lengths(counts)
    order = sorted(depth, key=lambda s: (depth[s], s))
    if order[-1] != NO_SYMBOL:  # the longest codes end with the forbidden one
        order.remove(NO_SYMBOL)
        depth[NO_SYMBOL] = depth[order[-1]]
        order.append(NO_SYMBOL)
    codes, sizes, code, size = np.zeros(257, np.int64), np.zeros(257, np.int64), 0, 0
    for s in order:
        code <<= depth[s] - size
        size = depth[s]
        codes[s], sizes[s] = code, size
        code += 1
    real = order[:-1]
    number = [sum(depth[s] == n for s in real) for n in range(1, LONGEST + 1)]
    return bytes(number) + bytes(real), codes, sizes


def categories(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size in bits of each value, and the bits that tell it from others of that size."""
    size = np.ceil(np.log2(np.abs(values) + 1)).astype(np.int64)
    return size, np.where(values >= 0, values, values + (1 << size) - 1)


def jpeg(rgba: bytes, width: int, height: int, quality: int = 85) -> bytes:
    rgb = np.frombuffer(rgba, np.uint8).reshape(height, width, 4)[:, :, :3].astype(float)
    rgb = np.pad(rgb, ((0, -height % 8), (0, -width % 8), (0, 0)), mode="edge")
    r, g, b = np.moveaxis(rgb, 2, 0)
    luma = 0.299 * r + 0.587 * g + 0.114 * b
    planes = [luma - 128, (b - luma) / 1.772, (r - luma) / 1.402]
    tables = [quantisation(LUMA, quality), quantisation(CHROMA, quality)]
    rows, columns = rgb.shape[0] // 8, rgb.shape[1] // 8
    levels = []
    for k, plane in enumerate(planes):
        cells = plane.reshape(rows, 8, columns, 8).swapaxes(1, 2).reshape(-1, 8, 8)
        spectrum = (COSINES @ cells @ COSINES.T).reshape(-1, 64)
        levels.append(np.rint(spectrum / tables[min(k, 1)]).astype(np.int64)[:, ZIGZAG])
    blocks = np.stack(levels, axis=1)  # units of three blocks, each of 64 levels in file order
    blocks[:, :, 1:] = np.clip(blocks[:, :, 1:], -1023, 1023)
    units = len(blocks)

    # Symbols: place in the file, table (luma or chroma, first or other levels), symbol, bits.
    steps = np.diff(blocks[:, :, 0], axis=0, prepend=0).reshape(-1)
    kind = np.tile([0, 1, 1], units)
    flat = blocks.reshape(-1, 64)
    size, bits = categories(steps)
    at = np.arange(units * 3)
    parts = [(at * 1024, kind * 2, size, bits, size)]
    block, level = np.nonzero(flat[:, 1:])
    level += 1
    before = np.where(np.diff(block, prepend=-1) > 0, 0, np.concatenate([[0], level[:-1]]))
    run = level - before - 1
    size, bits = categories(flat[block, level])
    parts.append((block * 1024 + level * 8 + 4, kind[block] * 2 + 1, run % 16 << 4 | size, bits, size))
    for k in range(3):  # a run of sixteen zeros has its own symbol
        long = run >= 16 * (k + 1)
        zero = np.zeros(long.sum(), np.int64)
        parts.append((block[long] * 1024 + level[long] * 8 + k, kind[block[long]] * 2 + 1, zero + 0xF0, zero, zero))
    short = flat[:, 63] == 0
    zero = np.zeros(short.sum(), np.int64)
    parts.append((at[short] * 1024 + 1023, kind[short] * 2 + 1, zero, zero, zero))
    place, table, symbol, bits, size = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(place, kind="stable")
    table, symbol, bits, size = table[order], symbol[order], bits[order], size[order]

    made = [code_table(np.bincount(symbol[table == t], minlength=256)) for t in range(4)]
    codes, sizes = np.stack([m[1] for m in made]), np.stack([m[2] for m in made])
    value, length = codes[table, symbol] << size | bits, sizes[table, symbol] + size
    ends = np.cumsum(length)
    which = np.repeat(np.arange(len(length)), length)
    stream = value[which] >> ends[which] - 1 - np.arange(ends[-1]) & 1
    stream = np.concatenate([stream, np.ones(-len(stream) % 8, np.int64)])
    body = np.packbits(stream.astype(np.uint8)).tobytes().replace(b"\xff", b"\xff\x00")

    def segment(mark: int, data: bytes) -> bytes:
        return struct.pack(">BBH", 0xFF, mark, len(data) + 2) + data

    out = b"\xff\xd8" + segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")
    for k, t in enumerate(tables):
        out += segment(0xDB, bytes([k]) + bytes(t[ZIGZAG].tolist()))
    out += segment(0xC0, struct.pack(">BHHB", 8, height, width, 3) + bytes([1, 0x11, 0, 2, 0x11, 1, 3, 0x11, 1]))
    for t, (stated, _, _) in enumerate(made):
        out += segment(0xC4, bytes([t % 2 << 4 | t // 2]) + stated)
    return out + segment(0xDA, bytes([3, 1, 0x00, 2, 0x11, 3, 0x11, 0, 63, 0])) + body + b"\xff\xd9"


def jpeg_column(rgba: str, size: int = 256, quality: int = 85) -> Column:
    @F.pandas_udf("binary")
    def encode(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: jpeg(b, size, size, quality))

    return encode(F.col(rgba))
