"""64-bit hashes of word runs and of text windows, for joins on what texts share.

Equal runs have equal hashes everywhere; different ones collide as rarely as 64
random bits do.  Arrow-batched: built-in functions would make a string of every
run, and walk a UTF-8 text from its start to every window.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
S29, S32 = np.uint64(29), np.uint64(32)
_TOKEN = re.compile(r"\w+")


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> S32)) * M2
    h = (h ^ (h >> S29)) * M3
    return h ^ (h >> S32)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words, in order."""
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out = mixed(out) + words[i : len(words) - n + 1 + i] * M1
    return mixed(out)


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little")


class _Words(dict):
    """Hashes of a batch's words."""

    def __missing__(self, word: str) -> int:
        out = self[word] = hash_of(word)
        return out


def shingles_of(words: list[str], width: int, known: dict[str, int] | None = None) -> np.ndarray:
    """The distinct shingles' hashes, in no order; none where there are fewer words than a shingle has."""
    if len(words) < width:
        return np.empty(0, dtype=np.int64)
    known = _Words() if known is None else known
    return np.unique(grams(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)), width)).view(np.int64)


def _each(make: Callable[[], Callable[[str], np.ndarray]]):
    def run(texts: pd.Series) -> pd.Series:
        one = make()
        return texts.map(one, na_action="ignore")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<long>")


def shingle_hashes(text: Column, width: int, among: np.ndarray | None = None) -> Column:
    """Hashes of the distinct runs of ``width`` words (letters, digits and underscores) of a normalised text; with ``among`` (sorted) only those in it."""

    def make() -> Callable[[str], np.ndarray]:
        known = _Words()

        def one(t: str) -> np.ndarray:
            found = shingles_of(_TOKEN.findall(t), width, known)
            if among is None or not len(found):
                return found
            at = np.searchsorted(among, found)
            at[at == len(among)] = 0
            return found[among[at] == found]

        return one

    return _each(make)(text)


def shingle_sets(width: int) -> Callable[[list[str], list[int]], tuple[np.ndarray, list[np.ndarray]]]:
    """For ``prefixes.able``: the given keys, and the hashes of :func:`shingle_hashes` of each text."""

    def run(texts: list[str], keys: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
        known = _Words()
        return np.array(keys, dtype=np.int64), [shingles_of(_TOKEN.findall(t), width, known).view(np.uint64) for t in texts]

    return run


BASE = 0x2545F4914F6CDD1D


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_minima(text: str, width: int) -> np.ndarray:
    """Of each run of ``width`` consecutive windows of ``width`` characters the least hash of a window, in order of the runs.

    A window's hash is a polynomial in its characters modulo 2 ** 64, from running sums.
    """
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(x) < 2 * width - 1:
        return np.empty(0, dtype=np.uint64)
    sums = np.cumsum(mixed((x.astype(np.uint64) + np.uint64(1)) * M1) * _powers(BASE, len(x)), dtype=np.uint64)
    before = np.concatenate((np.zeros(1, dtype=np.uint64), sums[: len(x) - width]))
    out = mixed((sums[width - 1 :] - before) * _powers(pow(BASE, -1, 1 << 64), len(x) - width + 1))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:])
        reach += step
    return out


def anchor_hashes(text: Column, width: int, *, places: int | None = None, among: Callable[[np.ndarray], np.ndarray] | None = None) -> Column:
    """The distinct values of :func:`window_minima`: all, those at some places from the first to the last, or those that ``among`` picks."""

    def one(t: str) -> np.ndarray:
        found = window_minima(t, width)
        if places is not None and len(found):
            found = found[[(len(found) - 1) * k // max(1, places - 1) for k in range(places)]]
        found = np.unique(found).view(np.int64)
        return found if among is None else found[among(found)]

    return _each(lambda: one)(text)


#: The prime of the MinHash permutations.
PRIME = (1 << 61) - 1


def permutations(n: int, seed: int) -> list[tuple[int, int]]:
    """``a, b`` of ``(a * x + b) mod PRIME``, drawn in turn from Python's generator."""
    import random

    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(n)]


def _times(a: int, x: np.ndarray) -> np.ndarray:
    """``a * x mod PRIME`` for numbers below it, in halves of 31 and 30 bits."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    ah, al, xh, xl = np.uint64(a >> 31), np.uint64(a & ((1 << 31) - 1)), x >> half, x & low
    middle = al * xh + ah * xl
    total = ah * xh * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half) + al * xl
    total = (total & np.uint64(PRIME)) + (total >> np.uint64(61))
    return np.where(total >= np.uint64(PRIME), total - np.uint64(PRIME), total)


def signature(hashes: np.ndarray, perms: list[tuple[int, int]]) -> list[int]:
    """The least value of each permutation over a set of unsigned 64-bit hashes."""
    x = hashes % np.uint64(PRIME)
    out = []
    for a, b in perms:
        v = _times(a, x) + np.uint64(b)
        out.append(int(np.where(v >= np.uint64(PRIME), v - np.uint64(PRIME), v).min()))
    return out


def fixed_shingles(words: list[str], width: int) -> np.ndarray:
    """Big-endian BLAKE2b hashes of the runs' texts: what MinHash signatures are made of."""
    runs = {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}
    return np.array([int.from_bytes(hashlib.blake2b(r.encode(), digest_size=8).digest(), "big") for r in runs], dtype=np.uint64)


def band_keys(text: Column, *, width: int = 5, perms: int = 64, bands: int = 8, seed: int = 1729) -> Column:
    """One key a band of the MinHash signature of a normalised text; none without a shingle."""
    drawn, rows = permutations(perms, seed), perms // bands

    def run(texts: pd.Series) -> pd.Series:
        def one(t: str) -> list[str]:
            words = _TOKEN.findall(t)
            if len(words) < width:
                return []
            s = signature(fixed_shingles(words, width), drawn)
            return [f"{b}:" + "".join(f"{x:016x}" for x in s[b * rows : (b + 1) * rows]) for b in range(bands)]

        return texts.map(one, na_action="ignore")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<string>")(text)
