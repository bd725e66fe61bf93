"""Words of many texts at once as 64-bit hashes, in numpy over the bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed odd multiplier of the polynomial hash, its inverse modulo 2**64, and mixing constants.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

IS_WORD = np.zeros(256, bool)
IS_WORD[128:] = True
for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
    IS_WORD[ord(a) : ord(b) + 1] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Code points (first, last) of white space and punctuation beyond ASCII, and of scripts that put no
#: spaces between words: Thai to Tibetan without digits, Kana, ideographs, Yi.
GAPS = [(0x80, 0xA9), (0xAB, 0xB1), (0xB4, 0xB4), (0xB6, 0xB8), (0xBB, 0xBB), (0xBF, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x2000, 0x206F), (0x20A0, 0x20C0), (0x3000, 0x3004), (0x3008, 0x3020), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20)]
ALONE = [(0x0E01, 0x0E4E), (0x0E81, 0x0ECD), (0x1000, 0x103F), (0x1780, 0x17D3), (0x3041, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA48C)]

_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * MIX1
        h = (h ^ (h >> np.uint64(27))) * MIX2
        return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1) modulo 2**64; kept for the largest n so far."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0], k = 1, 1
        with np.errstate(over="ignore"):
            while k < size:
                have[k : 2 * k] = have[:k] * np.uint64(pow(base, k, 1 << 64))
                k *= 2
        if size <= 1 << 23:
            _powers[base] = have
    return have[:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text starts (one more: the end). Nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(data: np.ndarray, starts: np.ndarray, lut: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes in lut, cut at text boundaries and at cuts: first byte, end, first run of
    each text."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = lut[data]
    step = np.diff(inside)
    first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cut = starts[1:-1] if cuts is None else np.concatenate([starts[1:-1], cuts])
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]  # a run goes on over this boundary
    if len(cut):
        first, end = np.sort(np.concatenate([first, cut])), np.sort(np.concatenate([end, cut]))
    return first, end, np.searchsorted(first, starts)


def run_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=total[1:])
        return mix((total[end] - total[first]) * powers(INVERSE, len(data) + 1)[first])


def _wide(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of non-ASCII white space and punctuation, and bytes where a word of one character begins
    or ends, in scripts that put no spaces between words."""
    gaps, cuts = [], []
    lead = np.flatnonzero(data >= 0xC2)
    lead = lead[lead + 2 < len(data) + (data[lead] < 0xE0)]
    x = data[lead].astype(np.int64)
    code = (x & 0x1F) << 6 | data[lead + 1] & 0x3F
    three = np.flatnonzero((x >= 0xE0) & (x < 0xF0))
    code[three] = (x[three] & 0xF) << 12 | (data[lead[three] + 1].astype(np.int64) & 0x3F) << 6 | data[lead[three] + 2] & 0x3F
    size = np.where(x < 0xE0, 2, 3)
    known = x < 0xF0
    for lo, hi in GAPS:
        at = known & (code >= lo) & (code <= hi)
        gaps += [lead[at] + d for d in range(2)] + [lead[at & (size == 3)] + 2]
    for lo, hi in ALONE:
        at = known & (code >= lo) & (code <= hi)
        cuts += [lead[at], lead[at] + 3]
    return np.concatenate(gaps), np.concatenate(cuts)


def lowered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (lower-cased runs of letters and digits; each character of a script without
    spaces is one) and the place of each text's first word, with the end as one more."""
    data, starts = buffers(pc.utf8_lower(pc.fill_null(texts, "")))
    cuts = None
    if len(data) and data.max() >= 0xC2:
        gaps, cuts = _wide(data)
        if len(gaps):
            data = data.copy()
            data[gaps] = 32
    first, end, of_text = spans(data, starts, IS_WORD, cuts)
    return run_hashes(data, first, end), of_text


def windows(words: np.ndarray, of_text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows that lie in one text, and each text's first window."""
    n = np.diff(of_text)
    count = np.maximum(n - k + 1, 0)
    if len(words) < k:
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    with np.errstate(over="ignore"):
        h = words[: len(words) - k + 1].copy()
        for i in range(1, k):
            h *= np.uint64(BASE)
            h += words[i : len(words) - k + 1 + i]
    keep = np.zeros(len(words) + 1, np.int64)
    np.add.at(keep, of_text[:-1][count > 0], 1)
    np.add.at(keep, (of_text[:-1] + count)[count > 0], -1)
    h = h[np.cumsum(keep)[: len(h)] > 0]
    return mix(h), np.concatenate([[0], np.cumsum(count)])
