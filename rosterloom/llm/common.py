"""What several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.sources.shared import shared_dir, written

__all__ = ["WORD", "chunks", "col", "content_key", "grams_of", "lower_ascii", "mix", "shared_dir", "text_of", "words_of", "written"]

#: A word byte of UTF-8: a digit, a lower-case letter or any byte of a character outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def col(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def content_key(text: Column) -> Column:
    """128 bits that stand for a text: equal texts get equal results, whatever their ids."""
    return F.unhex(F.md5(text.cast("binary")))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else untouched. lower() is exact, and much faster, on pure ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


# Word and n-gram hashing on the UTF-8 bytes of a batch of texts ---------------------------------

_M1, _M2, _BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
#: A random 64-bit value for each byte.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_POWERS = {0: (np.ones(1, np.uint64), np.ones(1, np.uint64))}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    have = _POWERS[0]
    if len(have[0]) < n:
        n = max(n, 1 << 20)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        out = []
        for b in (_BASE, inverse):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[0] = have = (out[0], out[1])
    return have


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text: their 64-bit hashes, byte starts and ends (in the joined texts), and the text each is of.

    Texts are joined by a newline, which is no word byte, so no word crosses texts.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    low = _LOWER[joined]
    inside = _IS_WORD[low]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * up[: len(low)], out=sums[1:])
    h = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    owner = np.searchsorted(np.cumsum(sizes), start, side="right")
    return h, start, end, owner


def grams_of(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of n consecutive words of one text, and the position of the first."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:m] == owner[n - 1 :])
    g = np.zeros(len(at), np.uint64)
    for i in range(n):
        g = mix(g * _BASE + h[at + i])
    return g, at


def chunks(texts: list[bytes], most: int = 1_000_000):
    """Runs (first, last) of texts that hold about `most` bytes together, so that arrays stay small."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)
