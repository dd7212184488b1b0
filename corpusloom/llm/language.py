"""Language votes: script of the letters, and common words of each language.

Works on folded batches (forms.py), so look-alike letters and letter case don't matter.
"""

from __future__ import annotations

import functools

import numpy as np

from . import codepoints as cp
from . import forms

# Common words of each language written with spaces.
COMMON = {
    "en": "the a an and or of to in on at by for from with without was were is are be been it its that this these those one not no but so if when while once because than as all them they he she his her who whoever which what where why how had has have will must every some any nobody there here since until upon behind below beyond between under over near into out after before during through though however then each you your we our i my do did does can could would should may more most also only very let within inside outside across along around among beside past next too often rarely once again",
    "de": "der die das den dem des ein eine einen einem einer eines und oder aber doch in im an am auf aus bei mit nach von vor zu zum zur für über unter zwischen hinter neben durch um bis seit weil wenn als dass ist war sind waren hat hatte er sie es wir ihr ich sich nicht kein keine auch so wie wo wer was warum dann bald heute gestern später mein meine unser unsere jeden jeder dort hier nur noch schon sehr",
    "fr": "le la les un une des du de d l et ou mais donc puis car à au aux en dans sur sous chez par pour avec sans entre vers devant derrière après avant pendant que qui quoi où pourquoi comment ce cet cette ces son sa ses leur il elle ils elles on nous vous je ne pas plus est était sont a avait ont comme quand si très tout tous hier chaque jours",
    "es": "el la los las un una unos unas de del y o e pero en a al con sin por para entre hacia sobre bajo tras desde hasta ante detrás junto que quien quién dónde por qué cómo como cuando si no es era son está había su sus se lo le mi nuestra nuestro este esta aquella aquel cada muy más también luego ayer hoy hace días después antes",
    "ru": "и в во на с со к ко у о об от до из за по под над при про без для между перед через после возле не но а или что как где когда почему кто пока если чтобы он она оно они мы вы я его её их мой моя наш наша наше этот эта это тот та ту каждое весь вся так тоже уже ещё был была было были вчера сегодня позже вскоре",
    "hi": "ने में और पर के की का से को था थी थे है हैं हो कि जो यह वह इस उस एक नहीं भी तक लिए साथ बाद पहले मेरा मेरी हर गया किया क्या क्यों कहाँ पास नीचे ऊपर बीच पीछे",
    "ar": "في من على إلى عن مع تحت فوق قرب بين عند وراء خلف أمام بعد قبل ثم لكن و أو أن إن كان كانت هو هي هذا هذه ذلك تلك الذي التي ما لماذا أين كيف كل لم لا قد يوم ذات بينما حين عندما لأن",
}
# Characters that carry grammar in scripts written without spaces.
PARTICLES = {"zh": "的了在着把又也可是因为所以和与那这不就都有我他她们说后前上下里面去来被给", "ja": "をはがのにでともたしっかったいるれなくてだよへや、。", "th": ""}
# Thai words that carry grammar.
THAI = ("และ", "กับ", "แต่", "ที่", "ใน", "บน", "ใต้", "หลัง", "ริม", "ระหว่าง", "ต่อมา", "เมื่อ", "ก่อน", "ของ", "ได้", "แล้ว", "นั้น", "นี้", "ไม่", "ทุก", "เพราะ", "จึง", "ขณะ", "ส่วน", "ให้", "มี", "เป็น", "ว่า", "นาน", "หน้า", "ข้าง", "กลาง", "ท่ามกลาง", "ใกล้", "นอก", "ตอน", "วัน", "คืน")
LANGS = ("und", "en", "de", "fr", "es", "ru", "hi", "ar", "zh", "ja", "th")
SPACED = ("en", "de", "fr", "es", "ru", "hi", "ar")


@functools.cache
def _common_table() -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes, and for each the set of its languages as bits by place in LANGS."""
    bits: dict[int, int] = {}
    for lang in SPACED:
        listed = list(dict.fromkeys(COMMON[lang].split()))
        cps, starts = forms.folded(*cp.from_strings(listed))
        mask = forms.letter_mask(cps, starts)
        begin, end, at = forms.words(cps, starts, mask)
        for h in cp.span_hashes(cps, begin, end)[at[:-1]].tolist():
            bits[h] = bits.get(h, 0) | 1 << LANGS.index(lang)
    keys = np.array(sorted(bits), np.uint64)
    return keys, np.array([bits[k] for k in keys.tolist()], np.int64)


def common_bits(hashes: np.ndarray) -> np.ndarray:
    """For each word hash the languages in which the word is common, as bits by place in LANGS."""
    keys, bits = _common_table()
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, bits[at], 0)


@functools.cache
def script_table() -> np.ndarray:
    """1 Latin, 2 Cyrillic, 3 Arabic, 4 Devanagari, 5 Thai, 6 kana, 7 Han, else 0."""
    out = np.zeros(cp.SIZE, np.uint8)
    for kind, pairs in {1: ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)), 2: ((0x400, 0x52F),), 3: ((0x600, 0x6FF), (0x750, 0x77F)), 4: ((0x900, 0x97F),), 5: ((0xE00, 0xE7F),), 6: ((0x3041, 0x30FF),), 7: ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x323AF))}.items():
        for a, b in pairs:
            out[a : b + 1] = kind
    return out


def detect(cps: np.ndarray, starts: np.ndarray, begin: np.ndarray, at: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in LANGS of each text's language, the number of its common words, and the votes.

    begin, at: the words of the folded batch and where each text's words start; bits: common_bits of
    each word.  Scripts decide first; among Latin languages the one with most common words.  Texts
    with no vote at all are "und".
    """
    n = len(starts) - 1
    kinds = script_table()[cps]
    share = np.stack([cp.sums(kinds == k, starts) for k in range(8)], 1)
    votes = np.zeros((n, len(LANGS)), np.int64)
    for i in range(1, len(LANGS)):
        if LANGS[i] in SPACED:
            votes[:, i] = cp.sums((bits >> i) & 1, at)
    lang = np.zeros(n, np.int64)
    latin = votes[:, 1:5]
    best = latin.argmax(1)
    lang = np.where(latin.max(1) > 0, best + 1, 0)
    letters = np.maximum(1, share[:, 1:].sum(1))
    # Look-alikes are folded to Latin shapes, so a Russian text keeps about half of its Cyrillic letters.
    lang = np.where(share[:, 2] > 0.25 * letters, LANGS.index("ru"), lang)
    lang = np.where(share[:, 3] > 0.4 * letters, LANGS.index("ar"), lang)
    lang = np.where(share[:, 4] > 0.4 * letters, LANGS.index("hi"), lang)
    lang = np.where(share[:, 5] > 0.4 * letters, LANGS.index("th"), lang)
    asian = share[:, 6] + share[:, 7]
    lang = np.where(asian > 0.4 * letters, np.where(share[:, 6] > 0.12 * asian, LANGS.index("ja"), LANGS.index("zh")), lang)
    return lang, votes[np.arange(n), lang], votes
