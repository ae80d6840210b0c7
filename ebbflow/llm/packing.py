"""Packed columns for blocks of documents: word lists, number arrays, and the order in which words meet by bucket."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import zstandard

_PACK = zstandard.ZstdCompressor(level=3)
_OPEN = zstandard.ZstdDecompressor()


def pack_words(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    return _PACK.compress(np.concatenate([np.array([len(words)], "<u4"), lengths]).tobytes() + b"".join(words))


def open_words(data: bytes) -> list[bytes]:
    raw = _OPEN.decompress(data)
    n = int(np.frombuffer(raw[:4], "<u4")[0])
    start = 4 + 4 * n
    ends = (np.cumsum(np.frombuffer(raw[4:start], "<u4"), dtype=np.int64) + start).tolist()
    return [raw[a:b] for a, b in zip([start, *ends], ends, strict=False)]


def pack_numbers(numbers: np.ndarray, delta: bool = False) -> bytes:
    """Unsigned 64-bit numbers below 2**32 take four byte planes, others eight; ``delta`` for ascending ones."""
    kind = "<u8" if len(numbers) and int(numbers.max()) >> 32 else "<u4"
    values = np.ascontiguousarray(numbers, kind)
    if delta and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return kind[2].encode() + _PACK.compress(planes)


def open_numbers(data: bytes, delta: bool = False) -> np.ndarray:
    size = int(data[:1])
    raw = np.frombuffer(_OPEN.decompress(data[1:]), np.uint8)
    values = np.ascontiguousarray(raw.reshape(size, -1).T).view(f"<u{size}").reshape(-1)
    return np.cumsum(values, dtype=values.dtype) if delta else values


def bucket_of(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def arrange(words: list[bytes], numbers: list[np.ndarray], buckets: int) -> tuple[list[tuple[int, list[int]]], np.ndarray, np.ndarray]:
    """Order the distinct words of a block (word i is ``words[i]``; ``numbers`` holds each document's words).

    Returns the words of each bucket, sorted (bucket, numbers); all documents' words by frequency rank (frequent words
    get small numbers, which compress well); and for each rank the word's place among all bucket rows in bucket order."""
    sequence = np.concatenate(numbers) if numbers else np.zeros(0, np.uint32)
    by_count = np.argsort(-np.bincount(sequence, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[by_count] = np.arange(len(words), dtype=np.uint32)
    by_bucket: defaultdict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        by_bucket[bucket_of(w, buckets)].append(i)
    groups = [(b, sorted(group, key=words.__getitem__)) for b, group in sorted(by_bucket.items())]
    places = np.empty(len(words), np.uint32)
    at = 0
    for _, group in groups:
        places[rank[group]] = np.arange(at, at + len(group), dtype=np.uint32)
        at += len(group)
    return groups, rank[sequence] if len(words) else sequence, places
