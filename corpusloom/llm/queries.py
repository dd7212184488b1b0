"""Queries of this package, for the driver's contract: name -> f(spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITE, WHITE_RE2
from ..session import ship
from . import containers, ledger, lookalikes, mixing, overlap, pairs, quality, repetition, sentences, tokens
from .common import written


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    stats = written(quality.statistics(_table(spark, folder, "docs_dedup")), "stats")
    return quality.not_prose(stats).select("doc_id")


def p1_scores(spark: SparkSession, folder: str) -> DataFrame:
    stats = written(quality.statistics(_table(spark, folder, "docs_dedup")), "stats")
    return quality.outlierness(stats)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.hidden_copies(_table(spark, folder, "docs_dedup"))


def p2_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.copy_counts(_table(spark, folder, "docs_dedup"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.pair_defects(_table(spark, folder, "instructions"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    found = overlap.split_overlaps(_table(spark, folder, "docs_dedup"), _table(spark, folder, "raw_files"))
    return found.select(F.least("train_id", "eval_id").alias("doc_id_a"), F.greatest("train_id", "eval_id").alias("doc_id_b")).distinct()


def p4_links(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.overlap_links(*overlap.overlaps(_table(spark, folder, "docs_dedup"), _table(spark, folder, "raw_files")))


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    docs, files = _table(spark, folder, "docs_dedup"), _table(spark, folder, "raw_files")
    return overlap.overlap_report(overlap.overlap_links(*overlap.overlaps(docs, files)), docs, files)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.lookalike_pairs(_table(spark, folder, "docs_dedup"))


def p5_forms(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.consistent_forms(_table(spark, folder, "docs_dedup").where("text <> ''")).distinct()


def _shares(spark: SparkSession, folder: str) -> DataFrame:
    shares = repetition.repeated_shares(_table(spark, folder, "docs_dedup"))
    return written(repetition.named_sources(shares, _table(spark, folder, "raw_files")), "shares")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    # The adaptive thresholds propose, the statement's two fifths are checked behind them.
    return repetition.repetitive(_shares(spark, folder)).where(F.col("repeated") * 5 >= F.col("words") * 2).select("doc_id")


def p6_shares(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.with_thresholds(_shares(spark, folder)).select("doc_id", "lang", "source", "words", "repeated", "share", "threshold")


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    counts = written(tokens.token_counts(_table(spark, folder, "documents")), "tokens")
    return containers.contain(counts, _table(spark, folder, "pack_plans"))


def p7_usage(spark: SparkSession, folder: str) -> DataFrame:
    return containers.usage(p7_containers(spark, folder), _table(spark, folder, "pack_plans"))


def p8_chosen(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"), _table(spark, folder, "mixture"))[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"), _table(spark, folder, "mixture"))[1]


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.sentence_spans(_table(spark, folder, "documents"))


# ---- results checked by SQL: what must hold over whole tables


def p2_total(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of all groups together: the documents with a letter or digit."""
    return ledger.copy_counts(_table(spark, folder, "docs_dedup")).agg(F.sum("copies").alias("documents"))


def p5_links(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.lookalike_links(_table(spark, folder, "docs_dedup"))


def p7_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Per plan: documents placed, tokens of each document that aren't placed once, containers too full, and documents split that fit."""
    plans = _table(spark, folder, "pack_plans").select("plan_id", "seq_len", F.col("append_eos").cast("int").alias("eos"))
    counts = written(tokens.token_counts(_table(spark, folder, "documents")), "tokens")
    placed = written(containers.contain(counts, _table(spark, folder, "pack_plans")), "placed")
    full = placed.groupBy("plan_id", "container").agg(F.sum("length").alias("n")).join(plans, "plan_id").groupBy("plan_id").agg(F.count_if(F.col("n") > F.col("seq_len")).alias("overfull"))
    per = placed.groupBy("plan_id", "doc_id").agg(F.sum("length").alias("n"), F.count("*").alias("pieces")).join(plans, "plan_id").join(counts, "doc_id")
    docs = per.groupBy("plan_id").agg(F.count("*").alias("documents"), F.count_if(F.col("n") != F.col("tokens") + F.col("eos")).alias("wrong"), F.count_if((F.col("n") <= F.col("seq_len")) & (F.col("pieces") > 1)).alias("split"))
    return docs.join(full, "plan_id").select("plan_id", "documents", "wrong", "overfull", "split")


def p8_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Per listed source: its target, and whether a document came more often than max_epochs."""
    report = mixing.mix(_table(spark, folder, "documents"), _table(spark, folder, "mixture"))[1]
    return report.select("source", "target", (F.col("most_repeats") > F.col("max_epochs")).alias("too_often"))


def p9_cover(spark: SparkSession, folder: str) -> DataFrame:
    """Visible characters of each document's sentences: all there are, each once."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    spans = sentences.sentence_spans(docs)
    part = F.substring("text", F.col("start_char").cast("int") + 1, (F.col("end_char") - F.col("start_char")).cast("int"))
    visible = F.length(F.regexp_replace(part, WHITE, ""))
    return spans.join(docs, "doc_id").groupBy("doc_id").agg(F.sum(visible).alias("visible"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_scores, p2_found, p2_counts, p3_found, p4_found, p4_links, p4_report, p5_found, p5_forms, p6_found, p6_shares, p7_containers, p7_usage, p8_chosen, p8_shares, p9_found, p2_total, p5_links, p7_checks, p8_checks, p9_cover)}

ORACLES: dict[str, str] = {
    "p2_total": r"SELECT count(DISTINCT doc_id) AS documents FROM docs_dedup WHERE regexp_matches(text, '[\p{L}\p{N}]')",
    "p7_checks": "SELECT plan_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE text <> '') AS documents, 0 AS wrong, 0 AS overfull, 0 AS split FROM pack_plans WHERE seq_len > 0",
    "p8_checks": "SELECT source, max(target_weight) AS target, false AS too_often FROM mixture WHERE source IS NOT NULL GROUP BY source",
    "p9_cover": f"SELECT doc_id, CAST(length(regexp_replace(text, '{WHITE_RE2}', '', 'g')) AS BIGINT) AS visible FROM documents WHERE length(regexp_replace(text, '{WHITE_RE2}', '', 'g')) > 0",
}
