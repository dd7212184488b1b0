"""Pre-token counts and the word inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..storage import written
from .prefix import ordinal, running_sum


def capped_lines(lines: DataFrame, order: list[str], max_lines: int | None = None, max_bytes: int | None = None, text: str = "text") -> DataFrame:
    """Lines up to and with the one that reaches a cap, in order."""
    if max_lines is not None:
        lines = ordinal(lines, order, name="_n").where(F.col("_n") < max_lines).drop("_n")
    if max_bytes is not None:
        lines = running_sum(lines, F.octet_length(text), order, name="_n").where(F.col("_n") < max_bytes).drop("_n")
    return lines


def piece_rows(df: DataFrame, pattern: str, text: str = "text", specials: list[str] | None = None, max_piece_bytes: int | None = None) -> DataFrame:
    """piece: every pre-token of every text, special tokens removed first."""
    segments = df.select(F.explode(T.plain_segments(F.col(text), specials or [])).alias("segment"))
    rows = segments.select(F.explode(T.pieces(F.col("segment"), pattern)).alias("piece"))
    return rows if max_piece_bytes is None else rows.where(F.octet_length("piece") <= max_piece_bytes)


def piece_counts(df: DataFrame, pattern: str, **options) -> DataFrame:
    """piece, freq.  Counted partially in each task, so frequent pieces cost one row a task."""
    return piece_rows(df, pattern, **options).groupBy("piece").agg(F.count("*").alias("freq"))


def most_frequent(counts: DataFrame, k: int, least: int = 1) -> DataFrame:
    """The k most frequent pieces, ties by bytes, in no order.

    A table of how many pieces have each frequency gives the frequency at the cap.  Pieces above it stay, those below go; only the ones
    of just that frequency are ranked, in ranges of their order, so no task meets k rows.
    """
    kept = written(counts.where(F.col("freq") >= least), "pieces")
    per = kept.groupBy("freq").agg(F.count("*").alias("n"))
    # Different frequencies: at most about the square root of twice the number of all pieces counted.
    above = ordered_sum(per, F.col("n"))
    edge = above.where((F.col("before") < k) & (F.col("before") + F.col("n") >= k)).select("freq", "before").collect()  # one row or none
    if not edge:
        return kept if k > 0 else kept.limit(0)
    freq, before = edge[0]["freq"], edge[0]["before"]
    border = ordinal(kept.where(F.col("freq") == freq), ["piece"], name="_n").where(F.col("_n") < k - before).drop("_n")
    return kept.where(F.col("freq") > freq).unionByName(border)


def ordered_sum(per: DataFrame, value) -> DataFrame:
    return running_sum(per.withColumn("_neg", -F.col("freq")), value, ["_neg"], name="before").drop("_neg")


def top_pieces(counts: DataFrame, k: int | None = None, least: int = 1) -> DataFrame:
    """Most frequent first, ties by bytes."""
    kept = counts.where(F.col("freq") >= least) if k is None else most_frequent(counts, k, least)
    return kept.orderBy(F.desc("freq"), "piece")


def word_inventory(counts: DataFrame, least: int = 1, most_words: int | None = None) -> DataFrame:
    """word_idx, symbols, freq of the pieces that training works on; word_idx is the rank."""
    kept = counts.where(F.col("freq") >= least) if most_words is None else most_frequent(counts, most_words, least)
    ranked = ordinal(kept.withColumn("_neg", -F.col("freq")), ["_neg", "piece"], name="word_idx")
    return ranked.select("word_idx", T.text_bytes(F.col("piece")).alias("symbols"), "freq")
