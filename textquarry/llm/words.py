"""Words of a text as 64-bit numbers, for shingles and n-grams."""

from __future__ import annotations

import numpy as np

from textquarry.functions.portions import portions, release, rows_of  # noqa: F401

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
S29, S32 = np.uint64(29), np.uint64(32)
#: Bytes that are hashed at once.
CHUNK = 1 << 18


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> S32)) * M2
    h = (h ^ (h >> S29)) * M3
    return h ^ (h >> S32)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A number for each byte, the same for A-Z and a-z, none for white space.
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * M1) | np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_VALUE[_SPACE] = 0


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


BASE = 0x2545F4914F6CDD1D
UP, DOWN = _powers(BASE, CHUNK), _powers(pow(BASE, -1, 1 << 64), CHUNK)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each word of UTF-8 text: runs of anything but ASCII white space, A-Z in lower case.

    A word's hash is a polynomial in its bytes' numbers modulo 2 ** 64, taken
    from running sums over a chunk, so the cost does not depend on which words
    there are and nothing is kept from text to text.
    """
    data, at, hashes, places = np.frombuffer(raw, dtype=np.uint8), 0, [], []
    step = CHUNK
    while at < len(data):
        part = data[at : at + step]
        space = _SPACE[part]
        if at + len(part) < len(data):
            # a chunk ends behind white space; a longer word makes a longer chunk
            last = len(part) - 1 - int(space[::-1].argmax())
            if not space[last]:
                step *= 2
                continue
            part, space = part[: last + 1], space[: last + 1]
        up, down = (UP, DOWN) if len(part) <= CHUNK else (_powers(BASE, len(part)), _powers(pow(BASE, -1, 1 << 64), len(part)))
        sums = np.cumsum(_VALUE[part] * up[: len(part)], dtype=np.uint64)
        word = np.flatnonzero(np.diff(space, prepend=True, append=True))
        starts, ends = word[::2], word[1::2]
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        hashes.append(mixed((sums[ends - 1] - before) * down[starts] + (ends - starts).astype(np.uint64) * M1))
        places.append(starts + at)
        at += len(part)
        step = CHUNK
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    """The word hashes of each text, in order."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    hashes, places = word_hashes(b"\n".join(raw))
    cuts = np.searchsorted(places, begins).tolist()
    return [hashes[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words, in order."""
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out = mixed(out) + words[i : len(words) - n + 1 + i] * M1
    return mixed(out)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct ``n``-word shingles; a shorter text is one shingle, an empty one has none."""
    if len(words) == 0:
        return words
    if len(words) < n:
        return grams(words, len(words)) + np.uint64(len(words))
    h = grams(words, n)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]
