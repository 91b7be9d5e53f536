"""Splitting texts into pre-tokens with array operations, and packing what tasks exchange.

The split is that of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
found on a whole batch of texts at once: a pre-token is a run of letters, of digits or of other
characters, with one blank before it where there is one; white space in front of a word keeps its last
character apart; an apostrophe that stands alone takes the ending of a contraction with it.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import zstandard

SPACE, LETTER, NUMBER, OTHER, END = range(5)
END_POINT = 0x110000
# The code points of Unicode's White_Space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(END_POINT)] + [END], np.uint8)
    table[WHITE] = SPACE
    return table


def code_points(texts: list[str]) -> np.ndarray:
    """All texts one after the other, each followed by END_POINT."""
    mark = END_POINT.to_bytes(4, "little")
    return np.frombuffer(mark.join(t.encode("utf-32-le", "surrogatepass") for t in texts) + mark, "<u4")


def pretoken_starts(points: np.ndarray) -> np.ndarray:
    """Where pre-tokens start; END_POINTs are starts of their own."""
    kind = classes()[points]
    n = len(points)
    start = np.ones(n + 3, bool)
    start[1:n] = (kind[1:] != kind[:-1]) | (kind[1:] == END)
    # The last white space before a word: apart from what is before it, and with the word if it is a blank.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # Contractions.
    word = np.append(points, [END_POINT, END_POINT])
    quote = np.flatnonzero(points == 0x27)
    quote = quote[start[quote] & (kind[np.minimum(quote + 1, n - 1)] == LETTER)]
    if len(quote):
        first, second = word[quote + 1], word[quote + 2]
        one = np.isin(first, [ord(c) for c in "stmd"])
        two = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (first == ord(a)) & (second == ord(b))
        start[quote[one | two] + 1] = False
        start[quote[one] + 2] = True
        start[quote[two & ~one] + 3] = True
    return np.flatnonzero(start[:n])


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def distinct_slices(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first place (among the slices) of each distinct slice, and for each slice which it is.

    Slices are told apart by a polynomial hash, and then compared with the slice they count as.
    """
    size = 1 << max(16, int(len(points)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint64(7)) * up[: len(points)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    lengths, model = ends - starts, starts[first][which]
    same = (lengths == (ends - starts)[first][which]).all()
    if same:
        begin = np.cumsum(lengths) - lengths
        inside = np.arange(lengths.sum()) - np.repeat(begin, lengths)
        same = (points[np.repeat(starts, lengths) + inside] == points[np.repeat(model, lengths) + inside]).all()
    if not same:  # two slices share a hash: tell them apart by content
        seen: dict[bytes, int] = {}
        which = np.array([seen.setdefault(points[a:b].tobytes(), len(seen)) for a, b in zip(starts, ends)], np.int64)
        _, first = np.unique(which, return_index=True)
    return first, which


def packed(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays of whole numbers (as planes of their bytes) and byte strings as one compressed value."""
    parts, sizes = [], []
    for a in arrays:
        if not isinstance(a, bytes):
            a = np.ascontiguousarray(np.asarray(a, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
        parts.append(a)
        sizes.append(len(a))
    return zstandard.compress(np.array(sizes, "<u4").tobytes() + b"".join(parts), 3)


def unpacked(value: bytes, *kinds: type) -> list:
    """What ``packed`` was given; ``kinds`` names each part, ``int`` or ``bytes``."""
    raw = zstandard.decompress(value)
    out, at = [], 4 * len(kinds)
    for size, kind in zip(np.frombuffer(raw, "<u4", len(kinds)), kinds):
        part = raw[at : at + int(size)]
        at += int(size)
        if kind is int:
            part = np.ascontiguousarray(np.frombuffer(part, np.uint8).reshape(4, -1).T).view("<u4").ravel()
        out.append(part)
    return out


def gathered(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches flat[offsets[i]:offsets[i + 1]] for each i of ``which``, one after the other."""
    lengths = offsets[which + 1] - offsets[which]
    begin = np.cumsum(lengths) - lengths
    return flat[np.repeat(offsets[which] - begin, lengths) + np.arange(int(lengths.sum()))]
