"""Token ids of whole Arrow text columns under a byte-level BPE vocabulary.

The ids are those of the `tokenizers` library for the same vocabulary without special tokens added: a
text is split at the added tokens of the vocabulary's JSON file, which stand for themselves, and what
lies between is encoded part by part. Such a vocabulary never joins bytes across its pre-split pieces, so
the ids of a text are those of its pieces one after another. For texts of plain Latin letters the
pieces are found by array operations and looked up in a table of pieces met before; each new piece
goes to the encoder once. All other texts go to the encoder whole.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa

from skyledger.llm.words import mix, prefix_values

TOP = 0x250  # texts with code points from here on take the general way
SLOTS = 1 << 20  # of the table of known pieces
MAX_IDS = 1 << 23  # the table starts anew beyond
_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3
# Fixed values of the pre-split: the classes of code points below TOP, and what may follow an
# apostrophe as a piece of its own.
_LETTERS = "AZ az ªª µµ ºº ÀÖ Øö øɏ"
_NUMBERS = "09 ²³ ¹¹ ¼¾"
_SPACES = "\t\r \x85\x85 \xa0\xa0"
_AFTER_APOSTROPHE = "stmdrvl"


def _classes() -> np.ndarray:
    kinds = np.full(TOP, _OTHER, np.uint8)
    for ranges, kind in ((_LETTERS, _LETTER), (_NUMBERS, _NUMBER), (_SPACES, _SPACE)):
        for low, high in ranges.split(" "):
            kinds[ord(low) : ord(high) + 1] = kind
    kinds[ord(" ")] = _SPACE
    return kinds


class Encoder:
    """Token ids for a vocabulary file of ranks (base64 bytes and rank per line).

    A JSON file of the same name beside it, if there is one, names the added tokens.
    """

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.added = _added_tokens(Path(ranks_path).with_suffix(".json"))
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.added else None
        self.kinds = _classes()
        self.values = mix(np.arange(1, TOP + 1, dtype=np.uint64) * np.uint64(77))
        self.curly = np.array([ord(c) for c in _AFTER_APOSTROPHE], np.uint16)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.begin = np.zeros(SLOTS, np.int64)
        self.length = np.zeros(SLOTS, np.int32)
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the offsets of each text in them."""
        joined = "".join(texts)
        if self.cut is None or not self.cut.search(joined):
            return self._plain(texts, joined)
        parts = [self.cut.split(text) for text in texts]  # texts and added tokens by turns
        between = [part for split in parts for part in split[::2]]
        ids, at = self._plain(between, "".join(between))
        count = np.array([len(split) // 2 for split in parts])
        last = np.cumsum(count + 1)  # of the parts between, past the end of each text
        inner = np.setdiff1d(np.arange(1, len(between) + 1), last)
        marks = [self.added[mark] for split in parts for mark in split[1::2]]
        ids = np.insert(ids, at[inner], np.array(marks, np.uint32))
        return ids, np.concatenate([[0], at[last] + np.cumsum(count)])

    def _plain(self, texts: list[str], joined: str) -> tuple[np.ndarray, np.ndarray]:
        try:
            units = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
        except UnicodeEncodeError:  # lone surrogates
            return self._whole(texts)
        ends = np.cumsum([len(t) for t in texts])
        if len(units) != len(joined) or (len(units) and units.max() >= TOP):
            return self._whole(texts) if len(texts) == 1 else self._halves(texts)
        tick = np.flatnonzero(units[:-1] == ord("'"))
        if len(tick) and np.isin(units[tick + 1], self.curly).any():
            return self._whole(texts) if len(texts) == 1 else self._halves(texts)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        start = self._pieces(units, offsets)
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        stop = np.append(start[1:], len(units))
        total, down = prefix_values(self.values[units])
        key = mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))
        begin, length = self._find(key, start, stop, joined)
        cut = np.cumsum(length)
        out = self.ids[np.repeat(begin - cut + length, length) + np.arange(cut[-1])]
        first = np.searchsorted(start, offsets)
        return out, np.concatenate([[0], cut])[first]

    def _halves(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        middle = len(texts) // 2
        (a, i), (b, j) = (
            self._plain(half, "".join(half)) for half in (texts[:middle], texts[middle:])
        )
        return np.concatenate([a, b]), np.concatenate([i, j[1:] + i[-1]])

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [np.array(self.encode(t), np.uint32) for t in texts]
        ends = np.cumsum([0, *(len(x) for x in each)])
        return np.concatenate(each) if each else np.empty(0, np.uint32), ends

    def _pieces(self, units: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces start: runs of letters, numbers, other signs, each with a blank before it
        if there is one, and runs of white space without the last one before a non-space."""
        n = len(units)
        if not n:
            return np.empty(0, np.int64)
        kind = self.kinds[units]
        space = kind == _SPACE
        text_start = np.zeros(n + 1, bool)
        text_start[offsets] = True
        follows = np.ones(n, bool)  # a piece begins here unless it goes on from before
        follows[1:] = (kind[1:] != kind[:-1]) | text_start[1:n]
        last_space = np.zeros(n, bool)  # white space right before a non-space of the same text
        last_space[:-1] = space[:-1] & ~space[1:] & ~text_start[1:n]
        blank = last_space & (units == ord(" "))
        follows[1:] &= ~(blank[:-1] & ~space[1:])
        return np.flatnonzero(follows | last_space)

    def _find(self, key, start, stop, joined: str) -> tuple[np.ndarray, np.ndarray]:
        slot = (key & np.uint64(SLOTS - 1)).astype(np.int64)
        known = (self.keys[slot] == key) & (self.length[slot] > 0)
        if self.used > MAX_IDS and not known.all():
            self._forget()
            known = np.zeros(len(key), bool)
        begin, length = self.begin[slot], self.length[slot].astype(np.int64)
        new = np.flatnonzero(~known)
        if len(new):
            fresh, at, back = np.unique(key[new], return_index=True, return_inverse=True)
            pieces = [
                self.encode(joined[i:j])
                for i, j in zip(start[new][at].tolist(), stop[new][at].tolist())
            ]
            sizes = np.array([len(p) for p in pieces])
            ends = np.cumsum(sizes) + self.used
            while ends[-1] > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used : ends[-1]] = [i for p in pieces for i in p]
            self.used = int(ends[-1])
            begin[new], length[new] = (ends - sizes)[back], sizes[back]
            slot = (fresh & np.uint64(SLOTS - 1)).astype(np.int64)
            self.keys[slot], self.begin[slot], self.length[slot] = fresh, ends - sizes, sizes
        return begin, length


def _added_tokens(path: Path) -> dict[str, int]:
    if not path.exists():
        return {}
    text = path.read_text(encoding="utf-8")
    # Only this list: the whole file as objects would stay in the worker's memory.
    at = re.search(r'"added_tokens"\s*:\s*', text)
    tokens = json.JSONDecoder().raw_decode(text, at.end())[0] if at else []
    for token in tokens:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"{path}: {token['content']} takes in its surroundings")
    return {token["content"]: token["id"] for token in tokens}


@cache
def encoder(ranks_path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(ranks_path)


def default_ranks() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def encoded(
    column: pa.Array, ranks_path: str, size: int = 1 << 18
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs (from, to, ids, offsets) over a text column; NULL is the empty text."""
    encode = encoder(ranks_path)
    i, n = 0, len(column)
    while i < n:
        texts, length, j = [], 0, i
        while j < n and (not texts or length < size):
            text = column[j].as_py() or ""
            texts.append(text)
            length += len(text)
            j += 1
        ids, offsets = encode(texts)
        yield i, j, ids, offsets
        i = j
