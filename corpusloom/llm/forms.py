"""One consistent form of text: what looks the same becomes the same characters (problem 5), and the
letters-only form built on it (problems 2, 4 and 6).

Steps of the visual form, in this order: compatibility decomposition of the forms that look like
their base (full and half width, ligatures, presentation forms, radicals), canonical decomposition,
one shape for letters that look alike across scripts, plain spaces and line breaks, and removal of
default-ignorable characters.  Raised, lowered, circled and fraction forms stay, as they look
different.  The readable result is composed again (NFC); keys are taken from the decomposed form.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa

from . import codepoints as cp

# Letters of Cyrillic and Greek with the shape of a Latin letter.
LOOKALIKE_FROM = "аеорсухіѕјһԁԛԝ" "АВЕКМНОРСТХІЅЈҮԌԜ" "ονοι" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
LOOKALIKE_TO = "aeopcyxisjhdqw" "ABEKMHOPCTXISJYGW" "ovoi" "ABEZHIKMNOPTYX"
# Lower-case letters whose capital has the shape of a Latin capital; with case set
# aside they must meet the Latin letter of that capital.
CAPITAL_FROM = "вкмнтүԍ" "αβεζηικμρτυχ"
CAPITAL_TO = "bkmhtyg" "abezhikmptyx"
# Default-ignorable code points (Unicode property), as inclusive ranges.
IGNORABLE = ((0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF))
# Compatibility tags whose forms look like their base characters.
SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
# Characters with a <compat> decomposition that are drawn differently from it.
OWN_LOOK = "…‥™℠℡№℻"


def _expand(c: str) -> str:
    """Full decomposition through canonical mappings and the compatibility tags of SAME_LOOK."""
    parts = unicodedata.decomposition(c).split()
    if not parts or c in OWN_LOOK:
        return unicodedata.normalize("NFD", c) if parts else c
    if parts[0][0] == "<":
        if parts[0] not in SAME_LOOK or parts[1] == "0020":
            return c
        parts = parts[1:]
    elif 0xAC00 <= ord(c) <= 0xD7A3:
        return unicodedata.normalize("NFD", c)
    return "".join(_expand(chr(int(p, 16))) for p in parts)


@functools.cache
def _visual_changes() -> dict[int, str]:
    looks = dict(zip(LOOKALIKE_FROM, LOOKALIKE_TO, strict=True))
    out: dict[int, str] = {}
    for n in (*range(0x20000), *range(0x2F800, 0x2FA20)):
        if 0xD800 <= n < 0xE000:
            continue
        c = chr(n)
        full = unicodedata.normalize("NFD", c) if 0xAC00 <= n <= 0xD7A3 else _expand(c)
        full = "".join(looks.get(x, x) for x in full)
        if unicodedata.category(c) == "Zs":
            full = " "
        elif n in (0x0B, 0x0C, 0x0D, 0x85, 0x2028, 0x2029):
            full = "\n"
        if full != c:
            out[n] = full
    for a, b in IGNORABLE:
        for n in range(a, b + 1):
            out[n] = ""
    return out


@functools.cache
def visual_map() -> cp.Mapping:
    return cp.Mapping(_visual_changes())


@functools.cache
def folded_map() -> cp.Mapping:
    """The visual form with full case folding, capitals meeting their look-alikes."""
    capitals = dict(zip(CAPITAL_FROM, CAPITAL_TO, strict=True))
    changes = _visual_changes()
    out = dict(changes)
    for n in (*range(0x20000), *range(0x2F800, 0x2FA20)):
        if 0xD800 <= n < 0xE000:
            continue
        full = changes.get(n, chr(n))
        fold = "".join("".join(capitals.get(x, x) for x in changes.get(ord(y), y)) for c in full for y in unicodedata.normalize("NFD", c.casefold()) for x in changes.get(ord(y), y)[:1] or "") if full else ""
        if fold != chr(n):
            out[n] = fold
        else:
            out.pop(n, None)
    return cp.Mapping(out)


@functools.cache
def _combining() -> np.ndarray:
    out = np.zeros(cp.SIZE, np.uint8)
    for n in range(0x20000):
        out[n] = unicodedata.combining(chr(n))
    return out


def _ordered(cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combining marks in canonical order; only texts that have them out of order are touched."""
    rank = _combining()[cps]
    if not rank.any():
        return cps, starts
    wrong = np.flatnonzero((rank[1:] > 0) & (rank[:-1] > rank[1:]))
    if not len(wrong):
        return cps, starts
    texts = cp.to_strings(cps, starts)
    for i in np.unique(np.searchsorted(starts, wrong, "right") - 1):
        texts[i] = unicodedata.normalize("NFD", texts[i])
    return cp.from_strings(texts)


def _line_ends(cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CR before LF goes."""
    cr = cps == 13
    if not cr.any():
        return cps, starts
    return cp.keep(~(cr & np.concatenate([cps[1:] == 10, [False]])), cps, starts)


def visual(cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The visual form, decomposed."""
    return _ordered(*visual_map().apply(*_line_ends(cps, starts)))


def folded(cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The visual form with case set aside, decomposed."""
    return _ordered(*folded_map().apply(*_line_ends(cps, starts)))


def visual_strings(texts: list[str], fold: bool = False) -> list[str]:
    """The readable consistent form of each text (NFC), computed once per distinct value."""
    kinds = pa.array(texts, pa.large_string()).dictionary_encode()
    forms = cp.to_strings(*(folded if fold else visual)(*cp.from_arrow(kinds.dictionary)))
    forms = [unicodedata.normalize("NFC", f) for f in forms]
    return [forms[i] for i in kinds.indices.to_pylist()]


@functools.cache
def letter_table() -> np.ndarray:
    """Letters, marks and numbers: what the letters-only form keeps."""
    return cp.in_category("L", "M", "N")


@functools.cache
def digit_table() -> np.ndarray:
    return cp.in_category("Nd")


def letter_mask(cps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """What the letters-only form keeps of a folded batch: letters, marks, numbers and points between digits."""
    mask = letter_table()[cps]
    point = np.flatnonzero(cps == 46)
    if len(point):
        digit = digit_table()
        inner = point[(point > 0) & (point < len(cps) - 1)]
        inner = inner[digit[cps[inner - 1]] & digit[cps[inner + 1]]]
        # Both neighbours must be of the same text.
        text = np.searchsorted(starts, inner, "right") - 1
        inner = inner[(inner > starts[text]) & (inner + 1 < starts[text + 1])]
        mask[inner] = True
    return mask


def letters(texts: list[str]) -> list[str]:
    """The letters-only form of each text."""
    cps, starts = folded(*cp.from_strings(texts))
    return cp.to_strings(*cp.keep(letter_mask(cps, starts), cps, starts))


def words(cps: np.ndarray, starts: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a folded batch: begin and end position of each, and where each text's words start.

    A word is a run of kept characters; each character of an unspaced script is a word of its own.
    """
    alone = cp.unspaced()[cps] & mask
    edge = np.ones(len(cps) + 1, bool)  # where no word goes on
    edge[1:-1] = ~(mask[1:] & mask[:-1]) | alone[1:] | alone[:-1]
    edge[starts] = True
    first = mask & edge[:-1]
    at = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(first, out=at[1:])
    return np.flatnonzero(first), np.flatnonzero(mask & edge[1:]) + 1, at[starts]
