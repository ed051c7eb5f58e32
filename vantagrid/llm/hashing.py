"""Vectorised hashing of words, shingles and byte windows over batches of texts."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

U = np.uint64
_rng = np.random.default_rng(20240229)
#: Random values of the bytes, and the odd base of the polynomial with its inverse modulo 2**64.
BYTE_VALUES = _rng.integers(0, 2**64, 256, dtype=U)
BASE = int(_rng.integers(0, 2**63)) * 2 + 1
_INVERSE = pow(BASE, -1, 2**64)

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes of a text that are cut into words at a time; words that are remembered, and the longest of them.
CHUNK, REMEMBERED, SHORT = 1 << 20, 400_000, 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(1, U)
    while len(out) < n:
        out = np.concatenate([out, out * U(pow(base, len(out), 2**64))])
    return out[:n]


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def need(self, n: int) -> None:
        if n > len(self.up):
            n = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(BASE, n), _powers(_INVERSE, n)


def prefix_sums(data: np.ndarray, powers: Powers, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Sums of value times power up to each place; a window's hash is a difference, shifted back."""
    powers.need(len(data) + 1)
    out = np.zeros(len(data) + 1, U)
    np.cumsum(values[data] * powers.up[: len(data)], out=out[1:])
    return out


def window_hashes(sums: np.ndarray, powers: Powers, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * powers.down[start] + (end - start).astype(U))


def slice_digests(data: bytes, start: list[int], end: list[int]) -> np.ndarray:
    """64 bits of a digest of each range of bytes."""
    digest = hashlib.blake2b
    return np.frombuffer(b"".join([digest(data[a:z], digest_size=8).digest() for a, z in zip(start, end, strict=True)]), np.int64)


def word_lists(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, about CHUNK bytes of it at a time."""
    at = 0
    while at < len(data):
        end = at + CHUNK
        if end < len(data):
            gap = _GAP.search(data, end)
            end = gap.start() if gap else len(data)
        # without an argument, split cuts at exactly the bytes of white space
        yield data[at:end].translate(_LOWER).split()
        at = end


class Digests(dict):
    """64 bits of a digest of each word's bytes, remembered for short words."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= SHORT:
            self[word] = value
        return value

    def of(self, data: bytes) -> np.ndarray:
        """The digests of a text's words, in order."""
        if len(self) > REMEMBERED:
            self.clear()
        parts = [np.fromiter(map(self.__getitem__, words), U, len(words)) for words in word_lists(data)]
        return np.concatenate([np.zeros(0, U), *parts])


def sequence_digest(data: bytes) -> bytes:
    """128 bits of a digest of a text's words in order."""
    out = hashlib.blake2b(digest_size=16)
    for words in word_lists(data):
        out.update(b"".join([w + b" " for w in words]))
    return out.digest()


def shingle_sets(texts: list[bytes], size: int, digests: Digests) -> list[np.ndarray]:
    """Each text's distinct shingles of ``size`` words as sorted 64-bit hashes; all its words where there are fewer."""
    return [_shingle_set(digests.of(t), size) for t in texts]


def _shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    odd = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93), U(0x85EBCA77C2B2AE63)]
    n = len(words)
    if not n:
        return words
    if n < size:
        few = np.full(1, n, U)
        for k in range(n):
            few = mix(few * odd[0] + words[k : k + 1])
        return few
    run = np.zeros(n - size + 1, U)
    for k in range(size):
        run = mix(run * odd[k % 5] + words[k : k + len(run)])
    return np.unique(run)


def exact_shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted numbers that are equal, among these texts, exactly where the words are.

    Words are numbered by their bytes, runs of words by the numbers of their halves.
    """
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    few: dict[tuple[int, ...], int] = defaultdict(itertools.count(1).__next__)
    parts = []
    for t in texts:
        lists = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in word_lists(t)]
        parts.append(np.concatenate([np.zeros(0, np.int64), *lists]))
    # what is behind the last word belongs to no text
    run, have = np.concatenate([np.zeros(0, np.int64), *parts, np.zeros(size, np.int64)]), 1
    while have < size:
        if have > 1:
            run = np.unique(run, return_inverse=True)[1].ravel()
        step = min(have, size - have)
        run = run[: len(run) - step] << 32 | run[step:]
        have += step
    out, at = [], 0
    for own in parts:
        n = len(own)
        if 0 < n < size:
            out.append(np.full(1, -few[tuple(own.tolist())], np.int64))
        else:
            out.append(np.unique(run[at : at + n - size + 1]) if n else own)
        at += n
    return out
