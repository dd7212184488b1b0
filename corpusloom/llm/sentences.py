"""Problem 9: sentence boundaries across languages and scripts.

A pushdown automaton reads each block of text (blocks end at blank lines): its stack holds the open
quotations and brackets, and a second one the indentations of the open list levels, which tell the
lines of an entry from running text behind the list.  A terminator inside an
open pair ends nothing unless the pair closes right behind it; behind the closing signs, the next
character, and in scripts without letter case the words of attribution, decide.  Full stops are
checked backwards in a trie of abbreviations.

Defined results: null and empty texts, and rows without an id, give no row; ids are taken to be
unique, a repeated row gives repeated rows (nothing is shuffled); a text of white space only has no sentence; every other
character belongs to at most one sentence and every visible one to exactly one.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices, texts_of
from .language import COMMON

# Abbreviations (without the last point) after which no sentence ends.
NEVER = """e.g; i.e; cf; vs; approx; mr; mrs; ms; dr; prof; st; lt; capt; col; gen; sgt; rev; hon; messrs; mt; ft; ca; viz; resp
z.b; z. b; d.h; d. h; u.a; u. a; bzw; vgl; ggf; evtl; inkl; hr; fr; frl; z. t; i. d. r; o. ä; sog
mme; mlle; m; mm; p. ex; p.ex; ex; c.-à-d; c.à.d; env; av; bd
sr; sra; srta; dra; d; dña; p. ej; p.ej; ej; ud; uds; núms; avda; gral
т. е; т.е; т. к; т.к; ул; им; пр; проф; акад; напр; т. н; т.н; тов; г-н; г-жа; см; ср
डॉ; श्री; सु; प्रो
د; أ; م; ص
พ.ศ; ค.ศ; น; ด.ร; ดร; นาย"""
# Abbreviations that go with a number behind them.
BEFORE_NUMBER = "no; nos; p; pp; vol; vols; fig; figs; sec; secs; ch; eq; art; op; nr; abb; s; bd; kap; núm; núms; pág; cap; n; д; кв; стр; гл; рис; табл; № ; п; ст; jan; feb; mar; apr; jun; jul; aug; sep; sept; oct; nov; dec"
# Abbreviations that may end a sentence.
MAYBE = "etc; usw; u.s.w; co; corp; inc; ltd; jr; bros; a.m; p.m; a. m; p. m; т. д; т.д; т. п; т.п; др; г; гг; в; вв; u.s; u.k"
# Months behind a German day number.
MONTHS = ("Januar", "Jänner", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")

_THAI = "ก-ฺเ-๎"
_EVENT = re.compile(rf"(?P<term>[.!?…。！？।؟．]+)|(?P<pair>[\"“”„«»「」『』《》()\[\]{{}}])|(?P<dollar>(?<=\s)\$(?=\s|\Z))|(?P<thai>(?<=[{_THAI}])\s+(?=[{_THAI}]))")
_PAIR = re.compile(r"[\"“”„«»「」『』《》()\[\]{}]")
_BLANK = re.compile(r"(?:\r\n|\n|\r)[^\S\r\n]*(?:\r\n|\n|\r)\s*")
_LINE = re.compile(r"[^\r\n]+")
_MARK = re.compile(r"\s*(?:[-*•+·□■●▪◦‣–]|\(?\d{1,3}[.)]|\[\d{1,3}\]|\(?[a-z]\))[^\S\r\n]+(?=\S)")
_OVER = re.compile(r"[.!?…。！？।؟．:：][\"”“»」』》)\]}’]*\s*\Z")
_LONE = re.compile(r"[A-Z](?=\s+[^\sa-z,;:.)])")
_LETTER_POINT = re.compile(r"\s?[^\W\d_]\.")
_SPACE = re.compile(r"\s*")
_CLOSING = re.compile(r"[^\S\r\n]?[\"”“»」』》)\]}’]")
_OPENS = "\"“„«「『《([{¿¡‘'*"
_DASH = "-–—"
_PARTNER = {"”": "“„", "“": "„", "»": "«„", "」": "「", "』": "『", "》": "《", ")": "(", "]": "[", "}": "{"}
_ZH_SAID = re.compile(r"[^。！？…\n“”「」：]{1,40}(?:问道|说道|喊道|叫道|答道|回答|问|说|道|喊|叫|答)(?=[。！，…])")
_HI_SAID = re.compile(r"[^।?!\n“”]{1,90}(?:पूछा|कहा|बोला|बोली|बोले|चिल्लाया|चिल्लाई|पुकारा)\s*(?=[।!,])")
_AR_SAID = re.compile(r"(?:و|ف)?(?:سأل|قال|صاح|همس|هتف|أجاب|رد|نادى|صرخ)(?:ت|وا)?\b")


@functools.cache
def _trie() -> dict:
    """Abbreviations read backwards; the key None holds the kind at an abbreviation's first character."""
    root: dict = {}
    for kind, listed in (("x", NEVER.replace("\n", ";")), ("d", BEFORE_NUMBER), ("m", MAYBE)):
        for word in listed.split(";"):
            node = root
            for c in reversed(word.strip()):
                node = node.setdefault(c, {})
            if word.strip():
                node[None] = node.get(None, "") + kind
    return root


def _abbreviation(text: str, stop: int, start: int) -> str:
    """Kinds (x never, d before a number, m maybe at an end) of the longest abbreviation before text[stop]; "" if none."""
    node, i, kinds = _trie(), stop - 1, ""
    while i >= start:
        c = text[i].lower()
        if c == "\n" or c == "\xa0":
            c = " "
        if c not in node:
            break
        node = node[c]
        if None in node and (i == start or not (text[i - 1].isalnum() or text[i - 1] in "$\\")):
            kinds = node[None]
        i -= 1
    return kinds


def _pairs(text: str, start: int, end: int) -> dict[int, int]:
    """Place of the closing sign for each opening one that has it, found with a stack."""
    stack: list[tuple[str, int]] = []
    held: dict[str, int] = {}  # open signs by kind, so that no search of the stack is in vain
    out: dict[int, int] = {}
    for m in _PAIR.finditer(text, start, end):
        c, i = m[0], m.start()
        partners = '"' if c == '"' else _PARTNER.get(c, "")
        if any(held.get(p) for p in partners):
            while stack:
                sign, place = stack.pop()
                held[sign] -= 1
                if sign in partners:
                    out[place] = i
                    break
        elif not partners or c in '"“':
            stack.append((c, i))
            held[c] = held.get(c, 0) + 1
    return out


def _goes_on(text: str, k: int, end: int) -> bool:
    """Whether what begins at text[k] can only carry a sentence on."""
    c = text[k]
    if c in ",;:،，、；：%":
        return True
    if c.islower():
        return not text[k + 1 : k + 2].isupper()  # as in "pH"
    if c in _DASH or c in _OPENS:
        j = k + 1
        while j < end and (text[j].isspace() or text[j] in _OPENS):
            j += 1
        return j < end and text[j].islower()
    return False


def _ends(text: str, begin: int, a: int, b: int, close: int, end: int) -> bool:
    """Whether the sentence from `begin` ends behind the terminator text[a:b] and its closing signs, at `close`."""
    k = _SPACE.match(text, close).end()
    if k >= end:
        return True
    sign, nxt, gap = text[a:b], text[k], k > close
    if sign == "." or sign == "．":
        before = text[a - 1] if a > begin else " "
        after = text[b] if b < end else " "
        if before.isdigit() and after.isdigit():
            return False
        if "฀" <= before <= "๿":
            return False  # points only mark abbreviations in Thai
        if before.islower() and (a - 1 == begin or not text[a - 2].isalnum()) and _LETTER_POINT.match(text, b, end):
            return False  # the first letter of "z. B."
        kinds = _abbreviation(text, a, begin) if close == b else ""
        if "x" in kinds or "d" in kinds and nxt.isdigit():
            return False
        if "m" in kinds and before.islower():
            return gap and not _goes_on(text, k, end)
        if not gap and close == b:
            # No space behind: a new sentence only where a small letter, number or sign meets a capital or an opening sign.
            if nxt.isalpha():
                if nxt.islower():
                    return False
                if nxt.isupper():
                    return not before.isupper() or a - begin > 1 and text[a - 2].isalpha()
                return before.isalpha() and len(text[max(begin, a - 3) : a].split()[-1:] or [""]) > 0 and not before.isascii()
            return nxt in _OPENS or nxt in "$="
        if before.isalpha() and before.isupper() and close == b and (a - 1 == begin or not (text[a - 2].isalnum() or text[a - 2] in "$\\_'’")):
            return False  # an initial
        if before.isdigit() and gap:
            i = a
            while i > begin and text[i - 1].isdigit():
                i -= 1
            if a - i <= 2 and text.startswith(MONTHS, k):
                return False
    if _goes_on(text, k, end):
        return False
    if close > b:
        # A quotation that opens the sentence may be followed by who says it.
        if nxt in "とっ" and text[close - 1] in "」』":
            return False
        if text[begin] in "“„«「『\"《":
            if "一" <= nxt <= "鿿" and _ZH_SAID.match(text, k):
                return False
            if "؀" <= nxt <= "ۿ" and _AR_SAID.match(text, k):
                return False
            if "ऀ" <= nxt <= "ॿ" and _HI_SAID.match(text, k):
                return False
    return True


@functools.cache
def _openers() -> frozenset[str]:
    """Common English words, which don't follow an article or pronoun with a capital but open a sentence."""
    return frozenset(COMMON["en"].split())


def _lone(text: str, begin: int, end: int) -> int:
    """End of a capital that stands alone before the start of a sentence, else begin.

    "A" and "I" are words of their own: they count only before a word that opens a sentence.
    """
    m = _LONE.match(text, begin, end)
    if not m:
        return begin
    if m[0] in "AI":
        k = _SPACE.match(text, m.end()).end()
        word = re.match(r"[^\W\d_]*", text[k : k + 24])[0]
        if len(word) > 1 and word.lower() not in _openers():
            return begin
    return m.end()


def _prose(text: str, start: int, end: int, out: list[tuple[int, int]]) -> None:
    """Sentences of running text."""
    pairs = _pairs(text, start, end)
    begin = _SPACE.match(text, start).end()
    inside = -1  # place where the outermost open pair closes
    skip = start

    def cut(at: int) -> None:
        nonlocal begin
        stop = at
        while stop > begin and text[stop - 1].isspace():
            stop -= 1
        if stop > begin:
            out.append((begin, stop))
        begin = _SPACE.match(text, at).end()
        while begin < end and (at := _lone(text, begin, end)) > begin:
            # A fragment of its own.
            out.append((begin, at))
            begin = _SPACE.match(text, at).end()

    if begin < end and begin == start and (at := _lone(text, begin, end)) > begin:
        cut(at)
    for m in _EVENT.finditer(text, start, end):
        a, b = m.span()
        if a < skip:
            continue
        kind = m.lastgroup
        if kind == "pair":
            if inside < a:
                inside = pairs.get(a, inside)
            continue
        if kind == "dollar":
            k = _SPACE.match(text, b).end()
            if inside < a and (k >= end or text[k].isupper() or text[k].isdigit() or text[k] in "=(“\"$"):
                cut(b)
            continue
        if kind == "thai":
            if inside < a:
                cut(a)
            continue
        close = b
        while close < end and (c := _CLOSING.match(text, close, end)):
            at = c.end() - 1
            sign = text[at]
            if sign == '"' and not (inside >= at):
                break  # opens the next quotation
            if sign == "“" and at in pairs:
                break
            if at > close and inside < at:
                break  # a space before it, and nothing to close
            close = c.end()
        if inside >= close:
            continue
        if _ends(text, begin, a, b, close, end):
            cut(close)
            skip = close
            inside = -1
    cut(end)


def spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence of a text, in code points."""
    out: list[tuple[int, int]] = []
    start = 0
    edges = [(m.start(), m.end()) for m in _BLANK.finditer(text)]
    for stop, following in [*edges, (len(text), len(text))]:
        _block(text, start, stop, out)
        start = following
    return out


def _block(text: str, start: int, end: int, out: list[tuple[int, int]]) -> None:
    """A block without blank lines: running text and list entries."""
    entry = prose = None  # start of the open list entry or of the open running text
    last = start
    levels: list[int] = []  # stack of the list levels: indentations of their marks
    for m in _LINE.finditer(text, start, end):
        a, b = m.span()
        if not text[a:b].strip():
            continue
        indent = _SPACE.match(text, a).end() - a
        over = last == start or entry is not None or bool(_OVER.search(text, max(start, last - 12), last))
        if over and _MARK.match(text, a, b):
            if entry is not None:
                _entry(text, entry, last, out)
            elif prose is not None:
                _prose(text, prose, last, out)
            while levels and levels[-1] >= indent:
                levels.pop()
            levels.append(indent)
            entry, prose = a, None
        elif entry is not None:
            # A line set deeper than a mark goes on with its entry; one that isn't leaves its level, and the list once the entry is over.
            while levels and levels[-1] >= indent:
                levels.pop()
            if not levels and _OVER.search(text, max(start, last - 12), last):
                _entry(text, entry, last, out)
                entry, prose = None, a
        elif prose is None:
            prose = a
        last = b
    if entry is not None:
        _entry(text, entry, last, out)
    elif prose is not None:
        _prose(text, prose, last, out)


def _entry(text: str, a: int, b: int, out: list[tuple[int, int]]) -> None:
    while a < b and text[a].isspace():
        a += 1
    while b > a and text[b - 1].isspace():
        b -= 1
    if b > a:
        out.append((a, b))


def sentence_spans(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, start_char, end_char: one row for each sentence."""
    kind = dict(df.dtypes)[id_col]

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [spans(t) for t in part.column(1).to_pylist()]
        at = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
        return pa.RecordBatch.from_arrays([part.column(0).take(at), pa.array([a for f in found for a, _ in f], pa.int64()), pa.array([b for f in found for _, b in f], pa.int64())], ["id", "start_char", "end_char"])

    picked = texts_of(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull()), "id")
    return map_slices(picked, "text", make, f"id {kind}, start_char bigint, end_char bigint").withColumnRenamed("id", id_col)
