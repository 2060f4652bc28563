"""64-bit hashes in numpy, and the words and shingles of texts as such hashes."""

from __future__ import annotations

import numpy as np
import xxhash

U64 = np.uint64
# The odd multipliers of a well-known 64-bit finaliser and of the golden ratio.
_M1, _M2, GOLDEN = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit."""
    x = x + U64(int(GOLDEN) * (2 * seed + 1) & _MASK)
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


def lower_words(text: str) -> list[bytes]:
    """The words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode().lower().split()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts in a row, and the texts' offsets, from 0."""
    place: dict[bytes, int] = {}
    flat: list[int] = []
    offsets = [0]
    for text in texts:
        flat += [place.setdefault(w, len(place)) for w in lower_words(text)]
        offsets.append(len(flat))
    of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, place), U64, len(place))
    return of_word[np.array(flat, np.int64)] if flat else np.zeros(0, U64), np.array(offsets, np.int64)


def shingle_sets(texts: list[str], width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, as hashes in a row, and the texts' offsets.

    A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    words, offsets = word_hashes(texts)
    counts = np.diff(offsets)
    n = np.where(counts == 0, 0, np.maximum(1, counts - width + 1))
    doc = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + offsets[:-1][doc]
    length = np.minimum(counts, width)[doc]
    hashes = length.astype(U64)
    padded = np.concatenate([words, np.zeros(width, U64)])
    for k in range(width):
        hashes = np.where(length > k, mix(hashes * GOLDEN + padded[start + k], k + 1), hashes)
    # 44 bits of the hash order the shingles of a text well enough to bring equal ones together
    order = np.argsort((doc.astype(U64) << U64(44)) | (hashes >> U64(20)), kind="stable")
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    sizes = np.bincount(doc[fresh], minlength=len(n))
    return hashes[fresh], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def sums_by_run(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each run, modulo 2**64; an empty run gives 0."""
    total = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    return total[offsets[1:]] - total[offsets[:-1]]
