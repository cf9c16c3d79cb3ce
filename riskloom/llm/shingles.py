"""64-bit hashes of words and word shingles, whole batches at a time in numpy."""

from __future__ import annotations

import numpy as np

SPACE_BYTES = np.zeros(256, dtype=bool)
SPACE_BYTES[[32, 9, 10, 11, 12, 13]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, STEP, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_spans(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, where their words start and end, and the number of words of each text.

    Words are the runs of characters other than blank and tab to carriage return; ``lower`` lowers A to Z first.
    """
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", dtype=np.uint8)
    if lower:
        data = LOWERED[data]
    edge = np.diff((~SPACE_BYTES[data]).astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    limits = np.cumsum([len(c) + 1 for c in coded]) if coded else np.zeros(0, dtype=np.int64)
    return data, starts, ends, np.diff(np.searchsorted(starts, limits), prepend=0)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans without gaps other than white space between them."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
    cells = (data[~SPACE_BYTES[data]].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(cells, begin) + lengths.astype(np.uint64) * STEP)


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words of each text."""
    data, starts, ends, counts = word_spans(texts, lower)
    return span_hashes(data, starts, ends), counts


def shingle_sets(words: np.ndarray, counts: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words than ``size`` the whole sequence is one, and
    without words there is none."""
    scale = powers(size + 1)
    sets, end = [], 0
    n = len(words) - size + 1
    full = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(size if n > 0 else 0):
        full += words[j : j + n] * scale[j + 1]
    full = mix(full)
    for count in counts.tolist():
        if count >= size:
            sets.append(np.unique(full[end : end + count - size + 1]))
        elif count:
            short = (words[end : end + count] * scale[1 : count + 1]).sum(dtype=np.uint64)
            sets.append(mix(np.array([short + np.uint64(size - count)], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        end += count
    return sets
