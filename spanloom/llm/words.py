"""64-bit hashes of words and of word windows, for whole texts at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

from spanloom.llm.tokens import Chunks

#: Odd multipliers for the places of a window; any fixed random odd numbers do.
PLACES = np.random.default_rng(20240501).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply), so that sums of hashes spread again."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def split(text: str | None) -> list[bytes]:
    """Words between ASCII white space (0x20, 0x09-0x0D), A-Z lower-cased, as UTF-8."""
    return (text or "").encode().lower().split()


def bare(word: bytes) -> bytes:
    """The word without ASCII punctuation at its ends, unless nothing else is left."""
    return word.strip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") or word


@lru_cache(maxsize=2)
def hashes(stripped: bool) -> Chunks:
    return Chunks(lambda new: [xxhash.xxh64_digest(bare(w) if stripped else w) for w in new])


def word_hashes(texts: list, stripped: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts (null: none) and each text's first place,
    with the end of the last one."""
    words = [split(t) for t in texts]
    cache = hashes(stripped)
    cache.learn(set().union(*words))
    get = cache.__getitem__
    data = b"".join(b"".join(map(get, ws)) for ws in words)
    return np.frombuffer(data, np.uint64), np.cumsum([0, *map(len, words)])


def windows(h: np.ndarray, places: list[int]) -> np.ndarray:
    """For each start, a hash of the words at these places after it."""
    n = max(0, len(h) - places[-1])
    out = np.zeros(n, np.uint64)
    for k, p in enumerate(places):
        out += h[p : p + n] * PLACES[k]
    return mixed(out)


def shingles(texts: list, size: int = 5) -> list[np.ndarray]:
    """Each text's distinct windows of ``size`` words, sorted; shorter texts give
    their whole sequence as one, texts without words none."""
    h, ends = word_hashes(texts)
    all_windows = windows(h, list(range(size)))
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= size:
            out.append(np.unique(all_windows[a : b - size + 1]))
        elif b > a:
            out.append(windows(h[a:b], list(range(b - a))) + np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def free(df, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column's name as Spark reads it whatever its signs."""
    return "`" + name.replace("`", "``") + "`"
