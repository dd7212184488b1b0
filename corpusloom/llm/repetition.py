"""Problem 6: repetition inside a single document.

`repeated_shares` measures, for every document, the share of words that lie in a stretch which
already occurred earlier in the same text.  `repetitive` filters by thresholds that adapt to each
language and source, in place of one fixed cutoff: quantile sketches (KLL) of the shares are made per
language and source and merged per language and over all.  A group's threshold is the upper fence of
its quartiles; groups of few documents take that of the level above, and no group's threshold lies
above that of the level above, so that a source full of repetition doesn't excuse its own documents.

Defined results: null and empty texts, and rows without an id, are left out; an id that comes more
than once counts once; a text without words has share 0; null sources form a group of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import codepoints as cp
from . import forms, language
from .common import map_slices, texts_of


def repeated_words(cps: np.ndarray, starts: np.ndarray, width: int, unspaced_width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, repeated words, and place of the language in LANGS, for each text of a batch."""
    cps, starts = forms.folded(cps, starts)
    table = cp.in_category("L", "M")
    cps, starts = cp.keep(~cp.in_category("N")[cps], cps, starts)  # digits aside
    begin, end, at = forms.words(cps, starts, table[cps])
    hashes = cp.span_hashes(cps, begin, end)
    lang, _, _ = language.detect(cps, starts, begin, at, language.common_bits(hashes))
    total = np.diff(at)
    covered = np.zeros(len(hashes) + 1, np.int64)
    wide = np.isin(lang, [language.LANGS.index(x) for x in ("zh", "ja", "th")])
    for size, texts in ((width, ~wide), (unspaced_width, wide)):
        windows = cp.window_hashes(hashes, size)
        if not len(windows) or not texts.any():
            continue
        text = np.repeat(np.arange(len(total)), total)
        whole = texts[text[: len(windows)]] & (text[: len(windows)] == text[size - 1 :])
        place = np.flatnonzero(whole)
        if not len(place):
            continue
        key = windows[place] ^ cp.scramble(text[place].astype(np.uint64) + np.uint64(1))
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        again = place[first[inverse] != np.arange(len(place))]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + size, -1)
    return total, cp.sums(np.cumsum(covered[:-1]) > 0, at), lang


def repeated_shares(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", width: int = 6, unspaced_width: int = 12) -> DataFrame:
    """id, lang, source, words, repeated, share for every document, each id once."""
    kinds = dict(df.dtypes)

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        total, again, lang = repeated_words(*cp.from_arrow(part.column(2)), width, unspaced_width)
        share = again / np.maximum(total, 1)
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([language.LANGS[i] for i in lang.tolist()]), pa.array(total), pa.array(again), pa.array(share)], ["id", "source", "lang", "words", "repeated", "share"])

    picked = texts_of(df.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.col(text).alias("text")).where(F.col("id").isNotNull()), "id", "source")
    rows = map_slices(picked, "text", make, f"id {kinds[id_col]}, source {kinds[source]}, lang string, words bigint, repeated bigint, share double")
    return rows.dropDuplicates(["id"]).withColumnRenamed("id", id_col)


def named_sources(shares: DataFrame, files: DataFrame) -> DataFrame:
    """The shares with the corpus of their file as source: groups large enough to have quartiles."""
    corpora = files.where("path is not null").groupBy(F.col("path").alias("_path")).agg(F.min("corpus").alias("_corpus"))
    return shares.join(corpora, F.col("source") == F.col("_path"), "left").withColumn("source", F.col("_corpus")).drop("_path", "_corpus")


def adaptive_thresholds(shares: DataFrame, fence: float = 1.5, least: int = 100) -> DataFrame:
    """lang, source, threshold: upper quartile plus fence times the quartiles' distance, from merged sketches.

    least: documents from which on a group has a threshold of its own.
    """
    fine = shares.groupBy("lang", "source").agg(F.kll_sketch_agg_double("share").alias("own"))
    per_lang = fine.groupBy(F.col("lang").alias("_l")).agg(F.kll_merge_agg_double("own").alias("middle"))
    whole = per_lang.groupBy(F.lit(1).alias("_one")).agg(F.kll_merge_agg_double("middle").alias("whole"))
    # A row a group: their number is that of languages times sources, not of documents.
    leveled = fine.join(per_lang, F.col("lang") == F.col("_l")).withColumn("_k", F.lit(1)).join(whole, F.col("_k") == F.col("_one"))

    def limit(sketch: str):
        low, high = F.kll_sketch_get_quantile_double(sketch, F.lit(0.25)), F.kll_sketch_get_quantile_double(sketch, F.lit(0.75))
        return high + fence * (high - low)

    top = limit("whole")
    middle = F.when(F.kll_sketch_get_n_double("middle") >= least, F.least(limit("middle"), top)).otherwise(top)
    return leveled.select("lang", "source", F.when(F.kll_sketch_get_n_double("own") >= least, F.least(limit("own"), middle)).otherwise(middle).alias("threshold"))


def with_thresholds(shares: DataFrame, fence: float = 1.5, least: int = 100) -> DataFrame:
    """The shares with the threshold of their language and source."""
    limits = adaptive_thresholds(shares, fence, least).select(F.col("lang").alias("_l"), F.col("source").alias("_s"), "threshold")
    return shares.join(limits, (F.col("lang") == F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))).drop("_l", "_s")


def repetitive(shares: DataFrame, fence: float = 1.5, least: int = 100) -> DataFrame:
    """Documents with repeated words whose share lies on or above the threshold of their group."""
    return with_thresholds(shares, fence, least).where((F.col("repeated") > 0) & (F.col("share") >= F.col("threshold")))
