"""Sets of word shingles as sorted 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

from waitline.llm.linking import mixed

KEPT_WORDS = 400_000
_FACTORS = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class WordHashes(dict):
    """Hashes of words, kept for words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit number per word."""
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """One number for each run of ``length`` words, in order; at least that many words."""
    count = len(hashes) - length + 1
    total = np.zeros(count, np.uint64)
    for n in range(length):
        total += hashes[n : n + count] * _FACTORS[n]
    return mixed(total)


def runs_at(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The same for the runs that begin at ``starts``; at most 64 words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mixed((hashes[starts[:, None] + np.arange(length)] * _FACTORS[:length]).sum(axis=1))


def shingle_set(words: list[bytes], length: int) -> np.ndarray:
    """Distinct runs of ``length`` words as sorted numbers; fewer words are one run, none is none.

    Numbers are 64-bit hashes: two different runs of one document pair meet with a probability
    of about 1e-19 per pair of runs.
    """
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < length:
        return mixed(np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64))
    return np.unique(runs(word_hashes(words), length))


def set_number(tokens: np.ndarray) -> int:
    """A 64-bit number of a set, as a signed long."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))
