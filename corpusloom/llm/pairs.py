"""Problem 3: broken prompt and response pairs.

Each pair is checked, in this order, for a response that is empty, a refusal, a copy of its prompt,
in another language, or cut off; a pair gets the first defect that holds.

* copy: the response is traversed on the suffix automaton of the prompt; the share of its letters
  inside long matches is the copied coverage.
* refusal: one Aho-Corasick automaton over refusal phrases of all languages, on letters only.
* truncated: a stack of open brackets, quotes and code fences, and how the last line ends.
* other_language: votes of common words, scripts first (language.py).

Defined results: a null or empty response is `empty`, whatever the prompt; a null or empty prompt
can make no copy and no other_language; rows without an id are left out; an id that comes more than
once gives one row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import codepoints as cp
from . import forms, language
from .common import map_slices, spread

#: Letters of a prompt up to which its automaton is built; beyond, windows give the same coverage and verdict in less memory.
LONG = 20_000
#: Share of a prompt that a single match must have to count as its copy.
WHOLE = 0.8
DEFECTS = ("empty", "refusal", "copy", "other_language", "truncated")
# Special tokens and section marks that are no content.
NO_CONTENT = re.compile(r"<\|[^|>]{1,40}\|>|</?s>|<(?:pad|eos|bos|unk)>|\[/?INST\]|^\s*#{1,6}\s*(?:response|output|answer|assistant|antwort|réponse|respuesta|ответ)\s*:?\s*$|^\s*(?:response|output|answer|assistant)\s*:\s*$", re.I | re.M)
# What a refusal says, by language.
REFUSALS = """
i am unable to answer; i'm unable to; i cannot provide an answer; i can't provide; i cannot provide; i can't help with; i cannot help with; i can't assist; i cannot assist; i do not feel comfortable; i don't feel comfortable; not something i can assist; not something i can help; beyond what i am allowed; i must decline to; i have to decline; i'd rather not respond; i would rather not; i won't be writing about; i will not be writing; against my guidelines; because of my policies; as a language model; as an ai; i am not able to answer; i can't answer; i cannot answer; i refuse to answer; i'm not allowed to; i am not allowed to
kann ich nicht helfen; darf ich nicht antworten; muss ich ablehnen; gebe ich keine auskunft; gegen meine richtlinien; kann ich nicht beantworten; ich kann dabei nicht helfen; als sprachmodell; ich darf darauf nicht; ich kann ihnen nicht helfen
je dois refuser; je ne peux pas vous aider; pas en mesure de répondre; va contre mes règles; je ne peux pas répondre; en tant que modèle de langage; je refuse de répondre
debo rechazar esta; no puedo ayudarte; no estoy autorizado a responder; va contra mis normas; no puedo responder; como modelo de lenguaje; no puedo ayudarle
не могу с этим помочь; мне нельзя отвечать; вынужден отказаться; не могу ответить на; я не имею права отвечать; против моих правил; противоречит моим правилам; как языковая модель
这个请求我必须拒绝; 我必须拒绝; 我不能提供; 我无法回答; 我不能回答; 无法提供帮助; 作为语言模型; 违反我的准则; 作为一个语言模型
お答えできません; お手伝いできません; お断りします; 言語モデルとして; 回答できません
لا أستطيع الإجابة; لا يمكنني المساعدة; لا يمكنني الإجابة; يجب أن أرفض; كنموذج لغوي
मैं इसका उत्तर नहीं दे सकता; मैं मदद नहीं कर सकता; मुझे मना करना होगा
ไม่สามารถตอบ; ไม่สามารถช่วย; ขอปฏิเสธ
"""
# Prompts that ask for a copy, a translation or a refusal.
ASKS_COPY = re.compile(r"\b(repeat|copy|fix|correct|quote|proofread|echo|retype|wiederhole|kopiere|korrigiere|répète|répétez|copie[zr]?|corrige[zr]?|repite|copia|corrige|повтори|скопируй|исправь)\b|重复|复述|抄写|改正|繰り返|コピー|直して|كرر|انسخ|दोहरा|ทวน|คัดลอก", re.I)
ASKS_OTHER = re.compile(r"\b(translat\w*|render in|put th\w+ in(?:to)?|(?:in|into|to) (?:english|german|french|spanish|russian|chinese|japanese|hindi|arabic|thai)|übersetz\w*|auf (?:deutsch|englisch|französisch|spanisch|russisch)|traduis\w*|traduir\w*|traduce\w*|tradu[cz]\w*|en (?:anglais|allemand|espagnol|russe|français|inglés|alemán|francés|ruso|español)|перевед\w*|по-(?:английски|немецки|французски|испански))\b|翻译|译成|译为|翻訳|訳して|英語で|ترجم|अनुवाद|แปล", re.I)
ASKS_REFUSAL = re.compile(r"\b(turns? down|declin\w*|refus\w*|reject\w*|say(?:s|ing)? no|ablehn\w*|absag\w*|lehnt\b.*\bab|rechaz\w*|declin\w*|отказ\w*|отклон\w*)\b|拒绝|婉拒|谢绝|断る|断り|رفض|मना|ปฏิเสธ", re.I)
ASKS_SHORT = re.compile(r"\b(title|name the|list|headline|caption|titel|nenne|titre|nomme|título|nombra|название|назови|list[ae]|compute|work out|what is \d|code|python|sql|regex)\b|标题|列出|题目", re.I)
#: Ends of a Thai text that something must follow: a vowel written before its consonant, or a word that opens a clause.
_THAI_OPEN = re.compile(r"(?:[เแโใไ]|และ|แต่|เพราะ|ซึ่ง|เพื่อ|ได้แก่|เมื่อ|หาก|ถ้า|จะ|(?<!ก)ว่า|คือ)$")
#: What turns from a refusal to an answer.
_ANSWERS = re.compile(r"(?:^|(?<=[.!?]\s))instead\b|\b(?:however|that said|nevertheless|here (?:is|are)|but (?:i can(?!['’]t|not|\s+not)|here)|stattdessen|dennoch|jedoch|hier (?:ist|sind)|cependant|toutefois|voici|sin embargo|aquí (?:está|tienes)|однако|но вот|вместо этого)\b|但是|不过|以下是|しかし|ただし|以下は|ولكن|ومع ذلك|लेकिन|हालाँकि|แต่|อย่างไรก็ตาม|```", re.I)
# What a polite opening says, by language.
_COURTEOUS = re.compile(r"\b(?:thank\w*|sorry|apolog\w*|appreciat\w*|understand\w*|regret\w*|unfortunately|question\w*|request\w*|glad|happy|kind|dank\w*|leider|entschuldig\w*|frage\w*|bedau\w*|merci|désolé\w*|malheureusement|demande\w*|gracias|siento|lament\w*|pregunta\w*|petición|спасибо|извин\w*|сожалени\w*|прости\w*|вопрос\w*|просьб\w*)\b|谢|抱歉|遗憾|对不起|请求|问题|ありがとう|申し訳|すみません|残念|ご質問|شكر|عذر|آسف|للأسف|سؤال|धन्यवाद|क्षमा|माफ|खेद|प्रश्न|ขอบคุณ|ขออภัย|เสียใจ|คำถาม", re.I)
_SENTENCE_END = re.compile(r"[.!?…。！？।؟．]")
_OPEN, _CLOSE = "([{“«「『《„", ")]}”»」』》"
_PAIR = {")": "(", "]": "[", "}": "{", "”": "“„", "»": "«", "」": "「", "』": "『", "》": "《", "“": "„"}
_MARK = re.compile(r"^\s*(?:[-*+•–—]|\(?\d{1,3}[.)]|[a-z][.)])\s*", re.I)


@functools.cache
def _refusal_automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for phrase in REFUSALS.replace("\n", ";").split(";"):
        if phrase.strip():
            a.add_word(forms.letters([phrase])[0], len(phrase))
    a.make_automaton()
    return a


class SuffixAutomaton:
    """All substrings of a text, as a minimal automaton."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p != -1 and c not in self.next[p]:
                self.next[p][c] = cur
                p = self.link[p]
            if p != -1:
                q = self.next[p][c]
                if self.length[p] + 1 == self.length[q]:
                    self.link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p != -1 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = self.link[p]
                    self.link[q] = self.link[cur] = clone
            last = cur

    def covered(self, text: str, least: int) -> tuple[int, int]:
        """Characters of text inside matches of at least that length, and the longest match."""
        state = length = best = total = covered_to = 0
        nxt, link, lens = self.next, self.link, self.length
        for i, c in enumerate(text, 1):
            while state and c not in nxt[state]:
                state = link[state]
                length = lens[state]
            if c in nxt[state]:
                state = nxt[state][c]
                length += 1
            if length >= least:
                total += i - max(covered_to, i - length)
                covered_to = i
                if length > best:
                    best = length
        return total, best


class _Windows:
    """For prompts whose automaton would be too large: their windows of one length.

    The coverage is the same.  The longest match is exact where it is WHOLE of the prompt or more:
    such a match holds the prompt's middle part.  Else it is given as 0.
    """

    def __init__(self, text: str, width: int):
        self.text = text
        self.held = {text[i : i + width] for i in range(len(text) - width + 1)}

    def covered(self, text: str, least: int) -> tuple[int, int]:
        total = covered_to = 0
        for i in range(len(text) - least + 1):
            if text[i : i + least] in self.held:
                total += i + least - max(i, covered_to)
                covered_to = i + least
        return total, self._longest(text)

    def _longest(self, text: str) -> int:
        own, n = self.text, len(self.text)
        need = math.ceil(WHOLE * n)
        a, b = n - need, need  # every match of that length holds own[a:b]
        best = 0
        at = text.find(own[a:b])
        while at >= 0 and best < n:
            left = _common(min(a, at), lambda k, p=at: own[a - k : a] == text[p - k : p])
            end = at + b - a
            right = _common(min(n - b, len(text) - end), lambda k, p=end: own[b : b + k] == text[p : p + k])
            best = max(best, left + b - a + right)
            at = text.find(own[a:b], at + 1)
        return best if best >= need else 0


def _common(most: int, same) -> int:
    """The greatest k up to most for which same(k) holds; same holds for 0 and all below it."""
    low = 0
    while low < most:
        mid = (low + most + 1) // 2
        low, most = (mid, most) if same(mid) else (low, mid - 1)
    return low


def copied(prompt: str, response: str) -> tuple[float, float]:
    """Share of the response's letters copied from the prompt, and the longest match as a share of the prompt.

    Both are letters-only texts (forms.py).
    """
    if not prompt or not response:
        return 0.0, 0.0
    least = max(3, min(12, len(prompt) // 2))
    total, best = (SuffixAutomaton(prompt).covered if len(prompt) <= LONG else _Windows(prompt, least).covered)(response, least)
    return total / len(response), best / len(prompt)


def open_delimiters(text: str) -> list[str]:
    """The stack of brackets, quotes and code fences left open at the end."""
    stack: list[str] = []
    fence = False
    for m in re.finditer(r"```|[()\[\]{}“”«»「」『』《》„]", text):
        c = m[0]
        if c == "```":
            fence = not fence
        elif stack and c in _PAIR and stack[-1] in _PAIR[c]:
            stack.pop()
        elif c in _OPEN:
            stack.append(c)
    return (["```"] if fence else []) + stack


def _stripped(text: str) -> str:
    return text.rstrip().rstrip("*_`").rstrip()


def cut_off(prompt: str, response: str) -> bool:
    """Whether the response breaks off before its end."""
    text = NO_CONTENT.sub(" ", response).strip("​‌‍﻿⁠ \t\r\n　\xa0")
    if not text:
        return False
    stack = open_delimiters(text)
    if "```" in stack:
        return True
    if text.endswith("```"):
        return False
    lines = [x for x in text.split("\n") if x.strip()]
    last = lines[-1].strip()
    if len(lines) > 1 and re.fullmatch(r"(?:[-*+•–]|\(?\d{1,3}[.)])", last):
        return True  # a list mark without its entry
    body = _stripped(last).rstrip("\"'”’»」』）)]}›")
    end = body[-1:] if body else last[-1:]
    if _SENTENCE_END.fullmatch(end or " "):
        return any(c in "{[" for c in stack)  # open code or data; open quotes and round brackets don't tell
    if end in ",;:，、；：(（[{«“„「『-–—=/\\&" and len(text) > 1 and any(c.isalnum() for c in text):
        return True
    if stack and stack[-1] in "([{“«「『《„":
        return True
    if re.fullmatch(r"\W*[\d\s.,:%+\-*/=]+\W*", text):
        return False  # a number
    marked = [bool(_MARK.match(x)) for x in lines]
    if all(marked) and not any(_SENTENCE_END.search(_MARK.sub("", x)) for x in lines):
        return False  # a list of entries without full stops
    if marked[-1] and len(lines) > 2:
        items = [x for x, m in zip(lines, marked) if m]
        if len(items) > 1 and not any(_SENTENCE_END.search(_stripped(x)[-1:]) for x in items[:-1]):
            return False
    earlier = _SENTENCE_END.search(text[: max(0, len(text) - 1)])
    words = text.split()
    wide = sum(0x3040 <= ord(c) <= 0x9FFF or 0xE00 <= ord(c) <= 0xE7F for c in text) * 2 > len(text)
    thai = sum(0xE00 <= ord(c) <= 0xE7F for c in text) * 2 > len(text)
    if thai:
        return bool(_THAI_OPEN.search(body))  # Thai sentences need no sign at their end
    if earlier and not re.search(r"[{};=]|->|\bdef\b|\breturn\b", lines[-1]):
        return True
    if wide:
        return len(text) > 12 and not ASKS_SHORT.search(prompt)
    if ASKS_SHORT.search(prompt) or len(words) < 4:
        return False
    capital = sum(w[:1].isupper() or w[:1].isdigit() for w in words)
    if capital * 5 >= len(words) * 3:
        return False  # a title
    return not re.search(r"[{};=<>]|\(\)", text)


def _asks(pattern: re.Pattern, prompt: str) -> bool:
    """Whether the part of the prompt before its first colon asks for it; all of it, where there is none."""
    head = re.split(r"[:：\n]", prompt.strip(), maxsplit=1)[0]
    if len(head) < 8 and len(prompt) > len(head):  # a label such as "Task:"
        head = " ".join(re.split(r"[:：]", prompt.strip(), maxsplit=2)[:2])
    return bool(pattern.search(head))


def _refuses(response: str, refusal) -> bool:
    """Whether the response declines, in its own words, and goes on without turning to an answer.

    It may open with any number of courteous parts (sentences or lines) and one of another kind;
    how long it or the parts are makes no difference.
    """
    parts = [p for p in re.split(r"(?<=[.!?।؟])\s+|(?<=[。！？])|\n+", response.strip()) if p.strip()]
    other = 0
    for k, part in enumerate(parts):
        if any(True for _ in refusal.iter(forms.letters([part])[0])):
            return not re.search("[\"“”«»„「『]", part) and not _ANSWERS.search(" ".join(parts[k:]))
        other += not _COURTEOUS.search(part)
        if other > 1:
            break
    return False


def batch_defects(prompts: list[str | None], responses: list[str | None]) -> list[str | None]:
    """The defect of each pair, or None."""
    n = len(prompts)
    ps, rs = [p or "" for p in prompts], [r or "" for r in responses]
    bare = [NO_CONTENT.sub(" ", r) if r else "" for r in rs]
    sides = []
    for texts in (ps, [re.sub(r"```.*?(?:```|$)", " ", b, flags=re.S) if "```" in b else b for b in bare]):
        cps, starts = forms.folded(*cp.from_strings(texts))
        mask = forms.letter_mask(cps, starts)
        begin, end, at = forms.words(cps, starts, mask)
        bits = language.common_bits(cp.span_hashes(cps, begin, end))
        sides.append((cp.to_strings(*cp.keep(mask, cps, starts)), *language.detect(cps, starts, begin, at, bits), np.diff(at)))
    (pl, p_lang, _, _, _), (rl, r_lang, r_own, r_votes, r_words) = sides
    content = forms.letters(bare)
    refusal = _refusal_automaton()
    latin = {language.LANGS.index(x) for x in ("en", "de", "fr", "es")}
    out: list[str | None] = []
    for i in range(n):
        prompt, response, letters = ps[i], rs[i], content[i]
        if not letters:
            out.append("empty")
            continue
        if next(refusal.iter(letters), None) and _refuses(response, refusal) and not _asks(ASKS_REFUSAL, prompt):
            out.append("refusal")
            continue
        if pl[i] and not _asks(ASKS_COPY, prompt):
            share, whole = copied(pl[i], letters)
            extra = len(letters) * (1 - share)
            if share >= 0.75 and whole >= WHOLE or whole >= 0.9 and extra <= 24:
                out.append("copy")
                continue
        a, b = int(p_lang[i]), int(r_lang[i])
        if a and b and a != b and not ASKS_OTHER.search(prompt) and r_words[i] >= 4:
            sure = b not in latin or r_own[i] >= 2
            against = int(r_votes[i][a]) if a in latin else 0
            if sure and (b not in latin or 2 * against < r_own[i]):
                out.append("other_language")
                continue
        out.append("truncated" if cut_off(prompt, response) else None)
    return out


def pair_defects(df: DataFrame, id_col: str = "example_id", prompt: str = "instruction", response: str = "output") -> DataFrame:
    """id, defect: one row for each pair with a defect."""
    kind = dict(df.dtypes)[id_col]

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array(batch_defects(part.column(1).to_pylist(), part.column(2).to_pylist()), pa.string())
        keep = found.is_valid()
        return pa.RecordBatch.from_arrays([part.column(0).filter(keep), found.filter(keep)], ["id", "defect"])

    picked = df.select(F.col(id_col).alias("id"), F.col(prompt).alias("prompt"), F.col(response).alias("response")).where(F.col("id").isNotNull())
    return map_slices(spread(picked), ("prompt", "response"), make, f"id {kind}, defect string").groupBy("id").agg(F.min("defect").alias("defect")).withColumnRenamed("id", id_col)
