"""Words of whole Arrow text columns as numpy arrays.

A word is a run of bytes outside a separator class. Its fingerprint is a 64-bit polynomial over
per-byte random values, so that all words of a batch are hashed by a few array operations.
Texts are UTF-8; NULL is the empty text. Work proceeds in slices of about
SLICE_BYTES that end at a separator, so memory stays a small multiple of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15 | 2)  # = 3 modulo 4, so that swapped bytes never cancel


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Alphabet:
    """Separator class and random value of each byte; `fold` gives A-Z the values of a-z."""

    def __init__(self, separators: bytes, seed: int, fold: bool = True):
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(seed * 2 + 1))
        if fold:
            values[65:91] = values[97:123]
        self.values = values
        self.inside = np.ones(256, bool)
        self.inside[np.frombuffer(separators, np.uint8)] = False


#: Words are `[^\x20\x09-\x0D]+`.
SPACED = Alphabet(b" \t\n\x0b\x0c\r", 11)
#: The same words, case kept.
SPACED_CASED = Alphabet(b" \t\n\x0b\x0c\r", 17, fold=False)
#: Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z.
ALNUM = Alphabet(
    bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)), 13
)


class _Powers:
    size = 0
    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > cls.size:
            cls.size = max(n, 2 * SLICE_BYTES)
            inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
            cls.up, cls.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(cls.size, f)]))
                for f in (_ODD, inverse)
            )
        return cls.up, cls.down


class Texts(NamedTuple):
    """Some texts: all their bytes, and where each begins; `offsets` has one more entry."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Words of some texts; `first[i]:first[i + 1]` are those of text i."""

    start: np.ndarray
    end: np.ndarray
    value: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return Texts(whole[at[0] : at[-1]], (at - at[0]).astype(np.int64))


def slices(texts: Texts, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Runs of whole texts (from, to, texts) of at most `size` bytes, or one longer text."""
    i, n = 0, len(texts)
    while i < n:
        limit = texts.offsets[i] + size
        j = max(i + 1, int(np.searchsorted(texts.offsets, limit, "right")) - 1)
        at = texts.offsets[i : j + 1]
        yield i, j, Texts(texts.data[at[0] : at[-1]], at - at[0])
        i = j


def subset(texts: Texts, chosen: np.ndarray) -> Texts:
    """The texts with the given numbers."""
    spans = [texts.data[texts.offsets[k] : texts.offsets[k + 1]] for k in chosen]
    ends = np.cumsum([0, *(len(s) for s in spans)])
    return Texts(np.concatenate(spans) if spans else texts.data[:0], ends.astype(np.int64))


def prefix_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values[i] * ODD**i, and the inverse powers: (sum[b] - sum[a]) * inverse[a]
    is a fingerprint of values[a:b] that depends on nothing else."""
    up, down = _Powers.upto(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return total, down


def _bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(inside)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] |= inside[edge]
    last[edge - 1] |= inside[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words_of(texts: Texts, alphabet: Alphabet) -> Words:
    """All words of some texts; a long text is hashed in pieces that end at a separator."""
    inside = alphabet.inside[texts.data]
    start, end = _bounds(inside, texts.offsets)
    value = np.empty(len(start), np.uint64)
    done = 0
    while done < len(start):
        low = start[done]
        stop = max(done + 1, int(np.searchsorted(end, low + SLICE_BYTES, "right")))
        high = end[stop - 1]
        total, down = prefix_values(alphabet.values[texts.data[low:high]])
        s, e = start[done:stop] - low, end[done:stop] - low
        value[done:stop] = (total[e] - total[s]) * down[s]
        done = stop
    value = mix(value + (end - start).astype(np.uint64))
    return Words(start, end, value, np.searchsorted(start, texts.offsets))


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of the `size` words from each word on, and the text of each of them.

    A text with fewer words, but one at least, has a single shingle of all its words.
    """
    counts = np.diff(words.first)
    text = np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, counts > 0))
    offset = np.concatenate([[0], np.cumsum(np.maximum(counts - size + 1, counts > 0))])
    begin = words.first[:-1][text] + np.arange(len(text)) - offset[text]
    length = np.minimum(counts, size)[text]
    out = length.astype(np.uint64)
    for k in range(size):
        here = begin + k
        value = words.value[np.minimum(here, max(len(words.value) - 1, 0))]
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + np.where(k < length, value, np.uint64(0)))
    return out, text
