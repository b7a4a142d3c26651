"""SuperMinHash signatures (Ertl 2017) for whole batches of sets.

Each element visits the SIZE registers in an order of its own, one register per step, and offers
`step + r` with a fresh random `r` in [0, 1). A register keeps its least offer. All offers of a
step lie below those of the next, so a set is finished as soon as all its registers are filled:
after one or two steps for large sets, after SIZE steps at most. An element meets every register
exactly once, which correlates the ranks and gives a lower variance than independent hashes.

The order is a keyed bijection of the step number rather than a stored shuffle, so a step is a few
array operations over all elements of the batch. The value is held as one integer: the step in the
top bits, 57 random bits below.
"""

from __future__ import annotations

import numpy as np

from skyledger.llm.words import mix

SIZE = 128
_STEP_BITS = np.uint64(57)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _register(key: np.ndarray, step: int) -> np.ndarray:
    """Register that each element visits at `step`: a keyed bijection of 0..127."""
    mask = np.uint64(SIZE - 1)
    x = np.full(len(key), step, np.uint64)
    for shift in (0, 20, 40):
        odd = (key >> np.uint64(shift)) | np.uint64(1)
        x = (x * odd + (key >> np.uint64(shift + 8))) & mask
        x ^= x >> np.uint64(4)
    return x & mask


def signatures(elements: np.ndarray, owner: np.ndarray, n_sets: int) -> np.ndarray:
    """Signature of each set; `owner[i]` is the set of element i. Empty sets keep the top value."""
    registers = np.full(n_sets * SIZE, _EMPTY)
    order_key, owner = mix(elements ^ np.uint64(0xA0761D6478BD642F)), owner.astype(np.int64)
    step = 0
    while len(elements) and step < SIZE:
        offer = mix(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        offer = (np.uint64(step) << _STEP_BITS) | (offer >> np.uint64(7))
        slot = owner * SIZE + _register(order_key, step).astype(np.int64)
        np.minimum.at(registers, slot, offer)
        open_sets = (registers.reshape(n_sets, SIZE) == _EMPTY).any(axis=1)
        going = open_sets[owner]
        if not going.all():
            elements, order_key, owner = elements[going], order_key[going], owner[going]
        step += 1
    return registers.reshape(n_sets, SIZE)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One key per band of `rows` registers; equal bands have equal keys."""
    n, size = signature.shape
    bands = size // rows
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (n, 1))
    for k in range(rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + signature[:, k : bands * rows : rows])
    return key
