"""Whole Arrow batches of text as one flat array of code points.

Every per-document text operator of this package works on the pair ``(cps, starts)``: ``cps`` holds
the code points of all texts of a batch one after another, ``starts[i]:starts[i + 1]`` is text ``i``.
Character classes are table lookups, counts are differences of running sums, so no Python code runs
per character.  Null texts count as empty here; callers drop them or report null themselves.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa

SIZE = 0x110000


def from_arrow(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points and starts of a string column, decoded once for the whole batch."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], kind, len(col) + 1 + col.offset)[col.offset :].astype(np.int64)
    if col.null_count:
        # A null slot may still own bytes; rebuild without them.
        return from_strings([s or "" for s in col.to_pylist()])
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]) if data and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    lead = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=lead[1:])
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return cps, lead[offsets - offsets[0]]


def from_strings(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), starts


def to_strings(cps: np.ndarray, starts: np.ndarray) -> list[str]:
    whole = np.ascontiguousarray(cps, np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    ends = starts.tolist()
    return [whole[a:b] for a, b in zip(ends[:-1], ends[1:])]


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of values per text, 0 for empty texts."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def owner(starts: np.ndarray) -> np.ndarray:
    """Index of the text that each position belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


@functools.cache
def categories() -> np.ndarray:
    """General category per code point as two ASCII letters packed in a uint16."""
    out = np.zeros(SIZE, np.uint16)
    text = "".join(unicodedata.category(chr(c)) for c in range(0x20000))
    pairs = np.frombuffer(text.encode(), np.uint8).reshape(-1, 2).astype(np.uint16)
    out[: len(pairs)] = pairs[:, 0] * 256 + pairs[:, 1]
    out[0x20000:0x323B0] = ord("L") * 256 + ord("o")  # ideographs of the supplementary planes
    out[0xE0000:0xE1000] = ord("C") * 256 + ord("f")
    return out


@functools.cache
def major() -> np.ndarray:
    """First letter of the general category per code point, as uint8."""
    return (categories() >> 8).astype(np.uint8)


def in_category(*names: str) -> np.ndarray:
    """Boolean table of the code points of the named categories ("L" or "Lu")."""
    out = np.zeros(SIZE, bool)
    for name in names:
        out |= major() == ord(name) if len(name) == 1 else categories() == ord(name[0]) * 256 + ord(name[1])
    return out


def table(chars: str) -> np.ndarray:
    """Boolean table of the given characters."""
    out = np.zeros(SIZE, bool)
    out[[ord(c) for c in chars]] = True
    return out


def ranges(*pairs: tuple[int, int]) -> np.ndarray:
    """Boolean table of inclusive code point ranges."""
    out = np.zeros(SIZE, bool)
    for a, b in pairs:
        out[a : b + 1] = True
    return out


# Scripts that are written without spaces between words (Thai, kana, ideographs).
UNSPACED = ((0x0E01, 0x0E3A), (0x0E40, 0x0E4E), (0x3005, 0x3007), (0x3041, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))


@functools.cache
def unspaced() -> np.ndarray:
    return ranges(*UNSPACED)


class Mapping:
    """Maps each code point to none, one or several code points; applied to whole batches."""

    def __init__(self, changes: dict[int, str]):
        self.count = np.ones(SIZE, np.uint8)
        self.first = np.arange(SIZE, dtype=np.uint32)
        longest = max((len(v) for v in changes.values()), default=1)
        many = {c: v for c, v in changes.items() if len(v) > 1}
        self.slot = np.zeros(SIZE, np.int32)
        self.more = np.zeros((longest, len(many) + 1), np.uint32)
        for c, v in changes.items():
            self.count[c] = len(v)
            self.first[c] = ord(v[0]) if v else 0
        for i, (c, v) in enumerate(many.items(), 1):
            self.slot[c] = i
            self.more[: len(v), i] = [ord(x) for x in v]
        self.touched = (self.count != 1) | (self.first != np.arange(SIZE, dtype=np.uint32))

    def apply(self, cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.count[cps]
        out = self.first[cps]
        if (n == 1).all():
            return out, starts
        ends = np.zeros(len(cps) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        out = np.repeat(out, n)
        many = np.flatnonzero(n > 1)
        for k in range(1, len(self.more)):
            many = many[n[many] > k]
            if not len(many):
                break
            out[ends[many] + k] = self.more[k][self.slot[cps[many]]]
        return out, ends[starts]


def keep(mask: np.ndarray, cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the code points of the mask, with the starts moved along."""
    if mask.all():
        return cps, starts
    ends = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(mask, out=ends[1:])
    return cps[mask], ends[starts]


def runs(mask: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one-past-last position of each run of true values; no run crosses a text."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(mask) + 1, bool)
    edge[starts] = True
    before = np.concatenate([[False], mask[:-1]])
    after = np.concatenate([mask[1:], [False]])
    return np.flatnonzero(mask & (~before | edge[:-1])), np.flatnonzero(mask & (~after | edge[1:])) + 1


# Odd 64-bit multipliers for hashing.
MULTIPLIER, FINISH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def scramble(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * FINISH
        x = (x ^ (x >> np.uint64(27))) * MULTIPLIER
    return x ^ (x >> np.uint64(31))


@functools.cache
def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = np.cumprod(np.full(n - 1, MULTIPLIER), dtype=np.uint64)
    return out


def span_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[b:e] for each non-overlapping, ascending, non-empty span."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    longest = int((end - begin).max())
    powers = _powers(1 << max(6, longest.bit_length()))
    with np.errstate(over="ignore"):
        inside = np.repeat(end - begin, end - begin)
        offset = np.arange(len(inside)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin)
        at = np.repeat(begin, end - begin) + offset
        terms = scramble(values[at].astype(np.uint64) + np.uint64(1)) * powers[offset]
        heads = np.cumsum(end - begin) - (end - begin)
        return scramble(np.add.reduceat(terms, heads) + (end - begin).astype(np.uint64))


def window_hashes(items: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each window of width items; shorter by width - 1 than items."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = total * MULTIPLIER + items[k : k + n]
    return scramble(total)
