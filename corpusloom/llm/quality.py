"""Problem 1: per-document text quality statistics, and how far a document is from running prose.

`statistics` computes the numbers of every document by table lookups over whole Arrow batches.
`prose_models` estimates, for each language, a robust mean and covariance of the statistics: two
concentration steps start at the medians, with wide scales (START), and end at the documents near
the centre; their means and covariances are the model.  A language's covariance is drawn towards
the one all languages have around their own means (OWN), as many languages show little junk and
little variety; RESOLUTION is what their shares can't tell apart.  The cut is
twice the 99th percentile of the distances of those near documents.  All come from aggregates over all documents; only the sums
per language, a fixed number of rows, reach the driver.  `outlierness` gives each document its
squared Mahalanobis distance from its language's prose and each statistic's share of it.

Statistics whose lack says nothing against prose count in one direction only (ONE_SIDED): prose in
capitals, without punctuation or broken into lines stays near the centre.

Defined results: null and empty texts, and rows without an id, are left out; an id that comes more
than once counts once; texts without words have share 0 everywhere and symbol share as measured;
texts of no known language are measured against the language with most documents; where there is
no text of a known language at all, nothing is farther than the cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import codepoints as cp
from . import forms, language
from .common import map_slices, texts_of, written
from .ledger import fields_of

STATS = ("log_words", "word_length", "symbol_ratio", "line_end_share", "common_share", "digit_share", "item_share", "short_line_share", "field_share", "odd_share")
# Parameters: scale of each statistic in the concentration steps only; wide, so that all of prose is kept.
START = {"log_words": 3.0, "word_length": 1.5, "symbol_ratio": 0.04, "line_end_share": 0.6, "common_share": 0.035, "digit_share": 0.12, "item_share": 0.1, "short_line_share": 0.15, "field_share": 0.15, "odd_share": 0.06}
# Parameters: -1 counts only below the centre, +1 only above it.
ONE_SIDED = {"symbol_ratio": 1, "line_end_share": -1, "common_share": -1, "digit_share": 1, "item_share": 1, "short_line_share": 1, "field_share": 1, "odd_share": 1}
#: Squared distance below which the concentration steps keep a document.
NEAR = 20.0
#: Standard deviation that a share over a few dozen words, and one over the lines of a text, often a single one, can't tell apart.
RESOLUTION, LINE_RESOLUTION = 0.032, 0.5
#: Share of a language's own covariance; the rest is that of all languages.
OWN = 0.25
#: The cut, as a multiple of a quantile of the distances of prose.
BEYOND, QUANTILE = 2.0, 0.99
ENDS = ".!?…。！？।؟。．"
QUOTES = "\"'“”„‟‘’‚«»‹›「」『』《》〈〉()[]"


class _Tables:
    """Character classes, made once in each worker."""

    def __init__(self) -> None:
        self.word = cp.in_category("L", "M", "N")
        self.letter = cp.in_category("L", "M")
        self.digit = cp.in_category("N")
        self.end = cp.table(ENDS)
        self.quote = cp.table(QUOTES)
        self.plain = cp.table(ENDS + QUOTES + ",;:、，；：·-–—،؛ \n") | cp.in_category("L", "M", "N")
        self.space = cp.in_category("Z") | cp.table("\n\t")
        self.hard = cp.table("\n;|\t·•□■●▪◦‣—–/؛")
        self.comma = cp.table(",،、")
        self.mojibake = cp.in_category("Cc", "Cn", "Co", "Cs") | cp.ranges((0xA1, 0xA9), (0xAC, 0xAC), (0xAE, 0xB8), (0xBC, 0xBE), (0xFFFC, 0xFFFD), (0x2500, 0x257F))
        self.mojibake[[9, 10, 13, 0xA7, 0xB0, 0xB7]] = False
        self.bullet = cp.table("-*+•□■●▪◦‣–—#>·")


_tables: _Tables | None = None


def _without_math(cps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """False in the parts between spaces that hold $ or a backslash, in texts that are mostly letters and have a $."""
    dollar = cps == ord("$")
    if not dollar.any():
        return np.ones(len(cps), bool)
    texts = (cp.sums(dollar, starts) > 0) & (2 * cp.sums(_tables.letter[cps], starts) > np.diff(starts))
    mark = (dollar | (cps == ord("\\"))) & np.repeat(texts, np.diff(starts))
    begin, end = cp.runs(~_tables.space[cps], starts)
    count = np.concatenate([[0], np.cumsum(mark)])
    hidden = count[end] > count[begin]
    # The blank behind a hidden part goes with it, else a gap would be left.
    tail = np.minimum(end + 1, np.append(begin[1:], len(cps)))
    tail = np.where((end < len(cps)) & (cps[np.minimum(end, len(cps) - 1)] == 32), tail, end)
    edge = np.zeros(len(cps) + 1, np.int64)
    edge[begin[hidden]] += 1
    edge[tail[hidden]] -= 1
    return np.cumsum(edge[:-1]) == 0


def _first_time(hashes: np.ndarray, at: np.ndarray, spaced: np.ndarray) -> np.ndarray:
    """False for the words of stretches of three (unspaced: six) that already occurred in the same text."""
    total = np.diff(at)
    text = np.repeat(np.arange(len(total)), total)
    covered = np.zeros(len(hashes) + 1, np.int64)
    for size, texts in ((3, spaced), (6, ~spaced)):
        windows = cp.window_hashes(hashes, size)
        if not len(windows) or not texts.any():
            continue
        place = np.flatnonzero(texts[text[: len(windows)]] & (text[: len(windows)] == text[size - 1 :]))
        if not len(place):
            continue
        _, first, inverse = np.unique(windows[place] ^ cp.scramble(text[place].astype(np.uint64) + np.uint64(1)), return_index=True, return_inverse=True)
        again = place[first[inverse] != np.arange(len(place))]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + size, -1)
    return np.cumsum(covered[:-1]) == 0


def batch_statistics(cps: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The statistics of each text, a column each, and the place of its language in LANGS."""
    global _tables
    t = _tables = _tables or _Tables()
    raw_odd = cp.sums(t.mojibake[cps], starts)
    cps, starts = forms.folded(cps, starts)
    cps, starts = cp.keep(_without_math(cps, starts), cps, starts)
    n = len(starts) - 1
    size = np.diff(starts)
    visible = np.maximum(1, size - cp.sums(t.space[cps], starts))
    mask = t.word[cps]
    begin, end, at = forms.words(cps, starts, mask)
    hashes = cp.span_hashes(cps, begin, end)
    bits = language.common_bits(hashes)
    lang, common, _ = language.detect(cps, starts, begin, at, bits)
    spaced = ~np.isin(lang, [language.LANGS.index(x) for x in language.PARTICLES])
    words = np.diff(at)
    some = np.maximum(1, words)
    new = _first_time(hashes, at, spaced)
    out = np.zeros((n, len(STATS)))
    put = {name: out[:, i] for i, name in enumerate(STATS)}
    put["log_words"][:] = np.log1p(words)
    put["word_length"][:] = np.where(spaced & (words > 0), cp.sums(t.letter[cps], starts) / some, 4.0).clip(0, 40)
    put["symbol_ratio"][:] = cp.sums(~t.plain[cps] & ~t.space[cps], starts) / visible

    # Words with digits, and words of a shape no language has: letters with digits or underscores, very long ones.
    dig = np.concatenate([[0], np.cumsum(t.digit[cps])])
    let = np.concatenate([[0], np.cumsum(t.letter[cps])])
    digits, letters = dig[end] - dig[begin], let[end] - let[begin]
    put["digit_share"][:] = cp.sums(digits > 0, at) / some
    glue = np.concatenate([cps == ord("_"), [False, False]])
    odd = ((digits > 0) & (letters > 1)) | (letters > 24) | glue[end] | (glue[np.maximum(begin, 1) - 1] & (begin > 0))
    put["odd_share"][:] = np.minimum(1, cp.sums(odd, at) / some + 3 * raw_odd / np.maximum(1, size))

    # Lines.
    newline = cps == 10
    line_begin, line_end = cp.runs(~newline, starts)
    text_of_line = np.searchsorted(starts, line_begin, "right") - 1
    # The last visible character of each line.
    vis = np.flatnonzero(~t.space[cps])
    last = np.searchsorted(vis, line_end, "left") - 1
    ok = (last >= 0) & (vis[np.maximum(last, 0)] >= line_begin) if len(vis) else np.zeros(len(line_begin), bool)
    tail = cps[vis[np.maximum(last, 0)]] if len(vis) else np.zeros(len(line_begin), np.uint32)
    closing = ok & (t.end[tail] | t.quote[tail])
    lines = np.bincount(text_of_line[ok], minlength=n) if len(ok) else np.zeros(n)
    put["line_end_share"][:] = np.bincount(text_of_line[closing], minlength=n) / np.maximum(1, lines)

    # A full stop ends a sentence unless a digit comes before it; after "1" at a line's start it marks a list.
    final = t.end[cps]
    stop = np.flatnonzero(cps == 46)
    stop = stop[stop > 0]
    final[stop[t.digit[cps[stop - 1]]]] = False
    ends = cp.sums(final, starts)

    # Segments between separators, in words; a segment's kind is what stands at its two ends.
    wide = np.flatnonzero((cps[1:] == 32) & (cps[:-1] == 32)) if len(cps) else np.zeros(0, np.int64)
    cut = final | t.hard[cps] | t.comma[cps]
    cut[wide] = True
    leader = np.flatnonzero(cps == 46)
    leader = leader[(leader > 0) & (leader < len(cps) - 1)]
    leader = leader[(cps[leader - 1] == 46) & (cps[leader + 1] == 46)]
    cuts = np.unique(np.concatenate([np.flatnonzero(cut), starts[1:] - 1]))
    cuts = cuts[(cuts >= 0)] if len(cps) else np.zeros(0, np.int64)
    if len(cuts) and len(begin):
        seg_of_word = np.searchsorted(cuts, begin, "left")
        seg_words = np.bincount(seg_of_word, minlength=len(cuts) + 1)
        at_end = cps[np.minimum(cuts, len(cps) - 1)]
        kind = np.zeros(len(cuts) + 1, np.int8)  # 0 sentence end or text end, 1 comma, 2 line break, 3 other separator
        kind[:-1] = np.where(t.comma[at_end], 1, np.where(at_end == 10, 2, np.where(t.hard[at_end] | (at_end == 32), 3, 0)))
        opened = np.concatenate([[0], kind[:-1]])
        first_of_text = np.isin(np.concatenate([[-1], cuts]) + 1, starts)
        opened[first_of_text] = 2
        last_of_text = np.zeros(len(kind), bool)
        last_of_text[:-1] = np.isin(cuts + 1, starts)
        final_at_end = np.zeros(len(kind), bool)
        final_at_end[:-1] = final[np.minimum(cuts, len(cps) - 1)]
        kind[last_of_text & ~final_at_end] = 2
        # A bullet or number at the start of a line marks an item.
        line_of_seg = opened == 2
        head = np.minimum(np.concatenate([[0], cuts + 1]), len(cps) - 1)
        head_vis = vis[np.minimum(np.searchsorted(vis, head, "left"), len(vis) - 1)]
        sign = t.bullet[cps[head_vis]] | (cps[head_vis] == ord("(")) | (cps[head_vis] == ord("["))
        marked = line_of_seg & (sign | t.digit[cps[head_vis]])
        # A separator other than a comma between parts of a line also makes items of them.
        limit = np.where(np.repeat(spaced, np.diff(at)), 6, 11)[np.minimum(np.searchsorted(seg_of_word, np.arange(len(kind)), "left"), len(begin) - 1)]
        short = (seg_words > 0) & (seg_words <= limit) & ~final_at_end
        comma_short = short & (seg_words <= limit - 2) & ((kind == 1) | (opened == 1))
        item = short & ((marked & (kind != 0)) | (kind == 3) | (opened == 3)) | comma_short
        short_line = short & ~item & line_of_seg & (kind == 2)
        # Words of repeated stretches count once.  Line breaks, tabs, wide gaps and commas part items only where sentences don't end as often as
        # in prose: about once in 12 words, or 30 characters of an unspaced script.  Semicolons count as
        # ends where they stand as far apart as sentences' ends.
        semi = ends + cp.sums(cps == ord(";"), starts)
        closed = np.where(words >= 6 * semi, semi, ends)
        flow = np.clip(1.5 - 1.5 * closed / some * np.where(spaced, 12, 30), 0, 1)
        gap = (at_end == 9) | (at_end == 32)
        soft_end = np.concatenate([t.comma[at_end] | gap, [False]])
        soft_open = np.concatenate([[False], soft_end[:-1]])
        hard = short & ((marked & (kind >= 2)) | ((kind == 3) & ~soft_end) | ((opened == 3) & ~soft_open))
        soft = item & ~hard
        # Gaps and tabs part cells only in texts that also lack common words or are full of numbers.
        numbers = (put["digit_share"] - 0.06) / 0.08
        latin = (lang >= 1) & (lang <= 4)
        few = np.where(latin | (lang == 0), (0.27 - common / some) / 0.07, 0.0)
        gapped = np.clip(np.maximum(few, numbers), 0, 1)
        by_gap = soft & (np.concatenate([gap, [False]]) | np.concatenate([[False], gap]))
        fresh = np.maximum(1, cp.sums(new, at))
        soft_weight = cp.sums((soft & ~by_gap)[seg_of_word] & new, at) + gapped * cp.sums(by_gap[seg_of_word] & new, at)
        put["short_line_share"][:] = cp.sums(short_line[seg_of_word] & new, at) / fresh * flow
        put["item_share"][:] = cp.sums(hard[seg_of_word] & new, at) / fresh + soft_weight / fresh * flow
    put["item_share"][:] = np.clip(put["item_share"] + np.minimum(1, 6 * np.bincount(np.searchsorted(starts, leader, "right") - 1, minlength=n)[:n] / np.maximum(1, size)), 0, 1)

    # Common words; in scripts without spaces, characters or words that carry grammar.
    # Repeated stretches count once, else a repeated phrase would stand for the whole text.
    fresh = np.maximum(1, cp.sums(new, at))
    lang_bit = np.repeat(lang, words)
    share = cp.sums(((bits >> lang_bit) & 1) * new, at) / fresh
    texts = None
    for name, chars in language.PARTICLES.items():
        here = lang == language.LANGS.index(name)
        if not here.any():
            continue
        if chars:
            hit = cp.sums(cp.table(chars)[cps[begin]] & new, at) * some / fresh if len(begin) else np.zeros(n)
        else:
            texts = texts or cp.to_strings(cps, starts)
            hit = np.array([sum(texts[i].count(w) * len(w) for w in language.THAI) if here[i] else 0 for i in range(n)])
        share = np.where(here, hit / some, share)
    put["common_share"][:] = share

    # Named fields.
    signs = cp.sums((cps == ord(":")) | (cps == ord("=")), starts)
    for i in np.flatnonzero(signs >= 3).tolist():
        found = fields_of(cps[starts[i] : starts[i + 1]].tobytes().decode("utf-32-le", "surrogatepass"))
        if found and not all(v.rstrip("\"'”»」)] ")[-1:] in ENDS for _, v in found if v.strip()):
            put["field_share"][i] = 1.0
    return out, lang


def statistics(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang and the statistics of every document, each id once."""
    kind = dict(df.dtypes)[id_col]

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        stats, lang = batch_statistics(*cp.from_arrow(part.column(1)))
        columns = [part.column(0), pa.array([language.LANGS[i] for i in lang.tolist()])] + [pa.array(np.ascontiguousarray(stats[:, i], np.float32)) for i in range(len(STATS))]
        return pa.RecordBatch.from_arrays(columns, ["id", "lang", *STATS])

    picked = texts_of(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull()), "id")
    rows = map_slices(picked, "text", make, f"id {kind}, lang string, " + ", ".join(f"{s} float" for s in STATS))
    return rows.dropDuplicates(["id"]).withColumnRenamed("id", id_col)


Models = dict[str, tuple[np.ndarray, np.ndarray]]
_SIDES = np.array([ONE_SIDED.get(x, 0) for x in STATS])


def _contributions(batch: pa.RecordBatch, models: Models, inverses: dict[str, np.ndarray], default: str) -> np.ndarray:
    """Each statistic's contribution to the squared distance of each row."""
    x = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in STATS], 1).astype(float) if batch.num_rows else np.zeros((0, len(STATS)))
    langs = np.array(batch.column("lang").to_pylist(), dtype=object)
    parts = np.zeros_like(x)
    for k in set(langs.tolist()):
        name = k if k in models else default
        rows = langs == k
        z = x[rows] - models[name][0]
        z = np.where(_SIDES > 0, np.maximum(z, 0), np.where(_SIDES < 0, np.minimum(z, 0), z))
        parts[rows] = z * (z @ inverses[name])
    return parts


def _measured(rows: DataFrame, models: Models, default: str) -> DataFrame:
    """The rows with their squared distance as _d."""
    inverses = {k: np.linalg.inv(m[1]) for k, m in models.items()}
    names = rows.columns

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_contributions(batch, models, inverses, default).sum(1))], [*names, "_d"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("_d", DoubleType())]))


def _moments(rows: DataFrame) -> dict[str, tuple[int, np.ndarray, np.ndarray]]:
    """Count, mean and covariance per language; one row per language comes to the driver."""
    sums = [F.sum(F.col(a).cast("double")).alias(f"s{i}") for i, a in enumerate(STATS)]
    products = [F.sum(F.col(a).cast("double") * F.col(b)).alias(f"p{i}_{j}") for i, a in enumerate(STATS) for j, b in enumerate(STATS) if j >= i]
    out = {}
    for r in rows.groupBy("lang").agg(F.count("*").alias("n"), *sums, *products).collect():
        n, k = r["n"], len(STATS)
        mean = np.array([r[f"s{i}"] for i in range(k)]) / n
        cov = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] / n for j in range(k)] for i in range(k)]) - np.outer(mean, mean)
        out[r["lang"]] = (n, mean, cov)
    return out


def _broad(cov: np.ndarray) -> np.ndarray:
    """The covariance of a concentration step: the start's scales on its diagonal, correlations shrunk by half."""
    return 0.5 * cov + 0.5 * np.diag(np.diag(cov)) + np.diag([START[s] ** 2 for s in STATS])


def prose_models(stats: DataFrame, steps: int = 2) -> tuple[Models, str, float]:
    """Robust mean and covariance of prose per language, the language with most documents, and the cut."""
    known = stats.select("lang", *STATS).where(F.col("lang") != "und")
    quartiles = known.groupBy("lang").agg(F.count("*").alias("n"), *[F.percentile_approx(s, [0.25, 0.5, 0.75], 1000).alias(s) for s in STATS]).collect()
    models: Models = {}
    for r in quartiles:
        low, mid, high = (np.array([r[s][k] for s in STATS], float) for k in range(3))
        models[r["lang"]] = (mid, _broad(np.diag(((high - low) / 1.349) ** 2)))
    if not models:
        return {"en": (np.zeros(len(STATS)), np.eye(len(STATS)))}, "en", float("inf")
    default = max(quartiles, key=lambda r: (r["n"], r["lang"]))["lang"]
    found: dict[str, tuple[int, np.ndarray, np.ndarray]] = {}
    for step in range(steps):
        kept = _measured(known, models, default).where(F.col("_d") < NEAR).drop("_d")
        if step == steps - 1:
            kept = written(kept, "prose")
        found = _moments(kept)
        models = {k: (found[k][1], _broad(found[k][2])) if k in found else m for k, m in models.items()}
    if not found:
        return models, default, float("inf")
    shared = sum(n * cov for n, _, cov in found.values()) / sum(n for n, _, _ in found.values())
    fixed = {}
    for k, (_, mean, cov) in found.items():
        mixed = OWN * cov + (1 - OWN) * shared
        least = np.array([LINE_RESOLUTION if x == "line_end_share" else RESOLUTION for x in STATS]) ** 2
        fixed[k] = (mean, mixed + np.diag(0.1 * np.diag(mixed) + least))
    default = default if default in fixed else max(found, key=lambda k: (found[k][0], k))
    edge = _measured(kept, fixed, default).agg(F.percentile_approx("_d", QUANTILE, 10_000)).first()[0]
    return fixed, default, BEYOND * edge


def outlierness(stats: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The statistics with distance (squared), the contribution of each statistic to it, and the cut."""
    models, default, cut = prose_models(stats)

    inverses = {k: np.linalg.inv(m[1]) for k, m in models.items()}

    def run(batches):
        for batch in batches:
            parts = _contributions(batch, models, inverses, default)
            extra = [pa.array(parts.sum(1))] + [pa.array(parts[:, i]) for i in range(len(STATS))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names)

    names = [id_col, "lang", *STATS, "distance", *[f"by_{s}" for s in STATS]]
    kind = dict(stats.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, lang string, " + ", ".join(f"{s} float" for s in STATS) + ", distance double, " + ", ".join(f"by_{s} double" for s in STATS)
    return stats.select(id_col, "lang", *STATS).mapInArrow(run, schema).withColumn("cut", F.lit(cut))


def not_prose(stats: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents farther from their language's prose than the cut."""
    return outlierness(stats, id_col).where(F.col("distance") > F.col("cut"))
