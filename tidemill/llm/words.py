"""Words and shingles of many texts at once, as 64-bit fingerprints on numpy arrays."""

from __future__ import annotations

import hashlib

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240607)
#: A random value per byte, and one odd factor per place in a shingle or mask.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**j and base**-j modulo 2**64 for j < n; kept and grown by doubling."""
    if len(_power[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(size, np.uint64(base & _MASK))
            factors[0] = 1
            _power[k] = np.multiply.accumulate(factors)
    return _power[0][:n], _power[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z; the other bytes of UTF-8 stay."""
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Running sums whose differences fingerprint any byte string of ``raw``."""
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE[raw] * powers(len(raw) + 1)[0][:-1], out=sums[1:])
    return sums


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the byte strings [start, end), equal for equal strings wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


#: A sum of powers modulo 2**64 is the same for some long strings of two letters, so longer words get a digest.
LONG = 64


def word_prints(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the words [start, end) of ``raw``."""
    prints = spans(prefix_sums(raw), start, end)
    for i in np.flatnonzero(end - start >= LONG):
        prints[i] = int.from_bytes(hashlib.blake2b(raw[start[i]: end[i]].tobytes(), digest_size=8).digest(), "little")
    return prints


def space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def word_spans(separator: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run without separators, in order; runs also end at ``cuts``."""
    n = len(separator)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    if cuts is not None:
        edge[cuts] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, separator[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, separator[1:]
    start = np.flatnonzero(~separator & (before | edge[:-1]))
    end = np.flatnonzero(~separator & (after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of every word (lower-cased A-Z, split at ASCII white space) and the first word of each text."""
    raw = lower_ascii(raw)
    start, end, text = word_spans(space(raw), offsets)
    hashes = word_prints(raw, start, end)
    return hashes, np.searchsorted(text, np.arange(len(offsets)))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct fingerprints of its word shingles; fewer words make one shingle of all."""
    hashes, first = word_hashes(raw, offsets)
    return [shingle_set(hashes[a:b], size) for a, b in zip(first[:-1], first[1:])]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    n = min(size, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total += words[k: len(words) - n + 1 + k] * PLACE[k]
    return np.unique(mix(total + np.uint64(n)))


#: Code points of scripts written without spaces (Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han), and of their signs.
UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x20000, 0x3FFFF))
SIGNS = ((0x3000, 0x3004), (0x3008, 0x303F), (0x30FB, 0x30FB), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))


def unspaced(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the characters of ``UNSPACED``, and the bytes of the ``SIGNS``."""
    at = np.flatnonzero(raw >= 0xE0)
    last = len(raw) - 1
    b = [raw[np.minimum(at + k, last)].astype(np.int64) & 63 for k in range(4)]
    four = raw[at] >= 0xF0
    point = np.where(four, ((b[0] & 7) << 18) | (b[1] << 12) | (b[2] << 6) | b[3], ((b[0] & 15) << 12) | (b[1] << 6) | b[2])
    among = lambda ranges: np.any([(point >= lo) & (point <= hi) for lo, hi in ranges], 0)
    char, sign = among(UNSPACED), among(SIGNS)
    char &= ~sign
    signs = at[sign & ~four]
    return at[char], np.minimum(at + 3 + four, last + 1)[char], np.minimum((signs[:, None] + np.arange(3)).ravel(), last)


def plain_spans(raw: np.ndarray, offsets: np.ndarray, characters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, start, end and text of words without signs, whatever their case.

    Words are runs of ASCII letters, digits and bytes of other scripts; A-Z and the Latin-1 capitals are lower-cased.
    With ``characters``, each character of a script without spaces is a word, and the signs of these scripts are none.
    """
    cuts = None
    raw = raw.copy()
    raw[(raw >= 65) & (raw <= 90)] += 32
    capital = (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)
    raw[1:][capital] += 32
    letter = ((raw >= 97) & (raw <= 122)) | ((raw >= 48) & (raw <= 57)) | (raw >= 128)
    if characters and len(raw):
        first, stop, signs = unspaced(raw)
        letter[signs] = False
        cuts = np.concatenate([first, stop])
    start, end, text = word_spans(~letter, offsets, cuts)
    return word_prints(raw, start, end), start, end, text


def plain_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the plain words of all texts, characters where there are no spaces, and where each text's begin."""
    hashes, _, _, text = plain_spans(raw, offsets, characters=True)
    return hashes, np.searchsorted(text, np.arange(len(offsets)))
