"""Corpus building and exact deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .prefix import ordinal


def normalised(df: DataFrame, text: str = "text", form: str = "none", collapse: bool = True) -> DataFrame:
    """Text with white space collapsed and normalised; null texts become empty."""
    return df.withColumn(text, F.coalesce(T.corpus_text(F.col(text), form, collapse), F.lit("")))


def long_enough(df: DataFrame, min_chars: int = 20, text: str = "text") -> DataFrame:
    return df.where(F.length(text) >= min_chars)


def records(lines: DataFrame) -> DataFrame:
    """Document records of (source, line_no, text) rows: identity, fixed and empty fields."""
    meta = F.struct(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("license"), F.expr("cast(array() as array<string>)").alias("tags"))
    return lines.select(T.document_id(F.col("source"), F.col("line_no"), F.col("text")).alias("doc_id"), "text", "source", F.lit(None).cast("string").alias("timestamp"), meta.alias("meta"))


def kept_prefix(df: DataFrame, max_docs: int, order: list[str], min_chars: int = 20, text: str = "text") -> DataFrame:
    """The rows up to the one that fills the cap, each with kept or not: what a reader that stops there has seen.

    The cap counts kept rows, in the given order.
    """
    marked = df.withColumn("kept", F.coalesce(F.length(text) >= min_chars, F.lit(False)))
    placed = running_kept(marked, order)
    return placed.where(F.col("before") < max_docs).drop("before")


def running_kept(marked: DataFrame, order: list[str]) -> DataFrame:
    from .prefix import running_sum

    return running_sum(marked, F.col("kept").cast("int"), order)


def stats(df: DataFrame, min_chars: int = 20, text: str = "text", source: str = "source") -> DataFrame:
    """Documents kept and dropped as short, bytes kept, sources read."""
    keep = F.coalesce(F.length(text) >= min_chars, F.lit(False))
    return df.agg(
        F.count_if(keep).alias("docs_kept"),
        F.count_if(~keep).alias("dropped_short"),
        F.coalesce(F.sum(F.when(keep, F.octet_length(text))), F.lit(0)).cast("bigint").alias("total_bytes"),
        F.countDistinct(source).alias("n_sources"),
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: the one with the smallest id, whole, with the number of its copies.

    Only hashes and ids are aggregated, partially in each task, so a hot text costs one row a task;
    the kept rows come back by a join on both, which no hot text can skew.  A row that comes more
    than once with its id is kept once; null ids come after all others, null texts are one text.
    """
    keyed = df.withColumn("_h", F.sha2(F.col(text), 256))
    picked = keyed.groupBy(F.col("_h").alias("_h2")).agg(F.min(id_col).alias("_id"), F.count("*").alias("copies"))
    kept = keyed.join(picked, F.col("_h").eqNullSafe(F.col("_h2")) & F.col(id_col).eqNullSafe(F.col("_id")))
    return kept.dropDuplicates([id_col, "_h"]).select(*df.columns, "copies")


def dedup_stats(df: DataFrame, text: str = "text") -> DataFrame:
    counts = df.groupBy(F.sha2(F.col(text), 256).alias("h")).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"), F.count("*").alias("kept"), (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).cast("bigint").alias("dropped"))


def numbered(df: DataFrame, order: list[str], name: str = "line_no") -> DataFrame:
    """1-based numbers in a total order."""
    return ordinal(df, order, name=name).withColumn(name, F.col(name) + 1)


def from_ordinal(df: DataFrame, first: int, order: list[str]) -> DataFrame:
    """The rows from a place in the order on: what a resumed reader still has to see."""
    return ordinal(df, order, name="_ord").where(F.col("_ord") >= first).drop("_ord")
