"""Hashes of words and shingles over whole arrays of bytes, and how many shingles pairs of texts share."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest

#: Bytes that are hashed at once; longer words, in bytes, are hashed one by one.
STEP_BYTES, LONG_WORD = 1 << 20, 1 << 12


def odd_numbers(count: int) -> np.ndarray:
    """The same random odd numbers at every call."""
    return np.random.default_rng(5).integers(0, 1 << 64, count, dtype=np.uint64) | np.uint64(1)


#: Factors of the words of a shingle or passage, in order; of the bytes of a word; of each byte value.
FACTORS, _IN_WORD, _BYTE = np.split(odd_numbers(53 + LONG_WORD + 256)[24:], [29, 29 + LONG_WORD])
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_BYTES = np.where(_BLANK, np.uint64(0), _BYTE)
_BYTES[65:91] = _BYTES[97:123]  # A-Z as a-z


def scramble(values: np.ndarray) -> np.ndarray:
    out = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a text (its UTF-8 bytes) starts, and a 64-bit hash of the word, A-Z lower-cased."""
    at, starts, hashes = 0, [], []
    while at < len(data):
        stop = at + STEP_BYTES
        while stop < len(data) and not _BLANK[data[stop]]:
            stop += 1
        part = data[at:stop]
        held = ~_BLANK[part]
        first = held.copy()
        first[1:] &= ~held[:-1]
        begins = np.flatnonzero(first)
        if len(begins):
            place = np.arange(len(part))
            place[begins[0] :] -= np.repeat(begins, np.diff(begins, append=len(part)))
            sums = np.add.reduceat(_BYTES[part] * _IN_WORD[place & (LONG_WORD - 1)], begins)
            lengths = np.add.reduceat(held, begins, dtype=np.int64)
            for n in np.flatnonzero(lengths > LONG_WORD).tolist():
                sums[n] = xxh3_64_intdigest(part[begins[n] : begins[n] + lengths[n]].tobytes().lower())
            starts.append(begins + at)
            hashes.append(scramble(sums))
        at = stop
    return np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(hashes or [np.zeros(0, np.uint64)])


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words; of all words if there are fewer."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    return scramble(sum((words[k : count + k] * factor for k, factor in enumerate(FACTORS[:width])), np.uint64(0)))


def different_shingles(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The different shingles of each text, as sorted hashes; the words of all texts are hashed at once."""
    coded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
    begins, words = word_hashes(np.frombuffer(b"\n".join(coded), dtype=np.uint8))
    ends = np.searchsorted(begins, np.cumsum([0, *(len(x) + 1 for x in coded)])).tolist()
    every = shingles(words, width)
    return [np.unique(every[a : b - width + 1] if b - a >= width else shingles(words[a:b], width)) for a, b in zip(ends, ends[1:])]


def shared(own: list[np.ndarray], one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many shingles the texts ``one`` and ``other`` (numbers in ``own``, the different shingles of each text) have in common."""
    size = np.array([len(x) for x in own])
    ends = np.cumsum([0, *size])
    kinds, which = np.unique(np.concatenate(own), return_inverse=True)
    held = np.repeat(np.arange(len(own)), size) * len(kinds) + which  # sorted, as each text's shingles are
    out = np.zeros(len(one), dtype=np.int64)
    for at in range(0, len(one), 1 << 12):
        a, b = one[at : at + (1 << 12)], other[at : at + (1 << 12)]
        of = np.repeat(np.arange(len(a)), size[a])
        place = np.arange(len(of)) + np.repeat(ends[a] - np.cumsum(size[a]) + size[a], size[a])
        sought = b[of] * len(kinds) + which[place]
        found = np.searchsorted(held, sought)
        out[at : at + (1 << 12)] = np.bincount(of[(held[np.minimum(found, len(held) - 1)] == sought)] if len(held) else of, minlength=len(a))
    return out
