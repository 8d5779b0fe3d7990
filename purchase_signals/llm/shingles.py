"""Word shingles of whole texts as sorted arrays of 48-bit hashes, in numpy.

Words are runs of bytes other than the six blanks, with A-Z in lower case; a
shingle is five words in a row.  A text of fewer words has its whole sequence as
one shingle, a text without words none.  Two different shingles share a hash
with a chance of 2**-48: of two texts of 500 shingles each, some pair does with
one of 10**-9, and 10**13 shingles still find 96 of 100 hashes free.
"""

from __future__ import annotations

import numpy as np

SIZE = 5
#: Bits of a shingle's hash.
BITS = 48
#: Bytes hashed at a time; a longer text is hashed alone.
SLICE = 1 << 20

_RNG = np.random.default_rng(23)
BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
NONE = np.empty(0, np.uint64)
STEP = 0xD1342543DE82EF95
_POWERS = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate([_POWERS, _POWERS * np.uint64(pow(STEP, len(_POWERS), 1 << 64))])
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(29))


def chain(words: list[np.ndarray]) -> np.ndarray:
    """Hash of word hashes in a row, position by position, of ``BITS`` bits."""
    h = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        h = mix((h ^ w) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    return h >> np.uint64(64 - BITS)


def word_hashes(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word of texts laid end to end, beginning at ``begins``."""
    n = len(flat)
    word = ~BLANK[flat]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins_in = begins[begins < n]
    first[begins_in] = word[begins_in]
    starts = np.flatnonzero(first)
    if not len(starts):
        return NONE, np.empty(0, np.int64)
    at = np.arange(starts[0], n) - np.repeat(starts, np.diff(starts, append=n))
    tail = word[starts[0]:]
    at[~tail] = 0
    value = BYTE[LOWER[flat[starts[0]:]]] * powers(int(at.max()) + 1)[at]
    value[~tail] = 0
    return mix(np.add.reduceat(value, starts - starts[0])), np.searchsorted(begins, starts, side="right") - 1


def sets(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text (arrays of bytes)."""
    out, group, size = [], [], 0
    for t in texts:
        if group and size + len(t) > SLICE:
            out += _sets(group)
            group, size = [], 0
        group.append(t)
        size += len(t)
    return out + (_sets(group) if group else [])


def _sets(texts: list[np.ndarray]) -> list[np.ndarray]:
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])[:-1]
    words, owner = word_hashes(np.concatenate(texts), begins)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    m = len(words) - SIZE + 1
    whole = chain([words[k:k + m] for k in range(SIZE)]) if m > 0 else NONE
    out = []
    for i, j in zip(bounds[:-1], bounds[1:], strict=True):
        if j - i >= SIZE:
            out.append(np.unique(whole[i:j - SIZE + 1]))
        else:
            out.append(chain([words[k:k + 1] for k in range(i, j)]) if j > i else NONE)
    return out
