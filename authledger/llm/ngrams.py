"""Hashed n-grams of words and characters as sparse rows."""

from __future__ import annotations

from zlib import crc32

import numpy as np

WORD_BITS, CHAR_BITS = 17, 16
WIDTH = (1 << WORD_BITS) + (1 << CHAR_BITS)
# Relative frequencies are small; this keeps weights near 1.
SCALE = 64.0


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint64, len(words))


def columns(text: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all word 1- and 2-grams, and of all byte 3-grams, of one text."""
    h = word_hashes(words)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = np.concatenate([h * np.uint64(0x165667B19E3779F9), pairs])
    by_word = (mixed >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    triple = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) if len(b) > 2 else np.zeros(0, np.uint32)
    by_char = (triple * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)
    return by_word, by_char.astype(np.int64) + (1 << WORD_BITS)


def row(text: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers, scaled relative frequencies); both kinds have the same total."""
    out_c, out_v = [], []
    for part in columns(text, words):
        if len(part):
            buckets, counts = np.unique(part, return_counts=True)
            out_c.append(buckets)
            out_v.append(counts * (SCALE / len(part)))
    if not out_c:
        return np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(out_c), np.concatenate(out_v)


def score(text: bytes, words: list[bytes], weights: np.ndarray) -> float:
    """The product of ``row`` and the weights, without building the row."""
    return sum(float(weights[part].mean()) * SCALE for part in columns(text, words) if len(part))
