"""Loss, perplexity, sampling and metric series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def perplexity(losses: DataFrame, loss: str = "loss", by: list[str] | None = None) -> DataFrame:
    """Mean loss, its exponential and the number of losses; null where there is none."""
    rows = losses.groupBy(*by) if by else losses
    return rows.agg(F.avg(loss).alias("eval_loss"), F.exp(F.avg(loss)).alias("perplexity"), F.count(loss).alias("num_samples"))


def holdout(df: DataFrame, key: str, percent: int = 10) -> DataFrame:
    """A stable train/test column from a hash of the key."""
    return df.withColumn("split", F.when(T.hash_bucket(F.col(key), 100) < percent, "test").otherwise("train"))


def sample_lines(df: DataFrame, most: int = 1000, seed: int = 0, text: str = "text") -> DataFrame:
    """At most so many rows without replacement, the same for the same seed."""
    return df.withColumn("_r", F.xxhash64(F.lit(seed), F.col(text))).orderBy("_r", text).limit(most).drop("_r")


def batches(blocks: DataFrame, n_blocks: int, steps: int, batch_size: int, seed: int = 0, block: str = "block_id") -> DataFrame:
    """step, slot and block of training batches drawn with replacement, as a join of draws and blocks."""
    spark = blocks.sparkSession
    draws = spark.range(steps * batch_size).select(F.expr(f"id div {batch_size}").alias("step"), (F.col("id") % batch_size).alias("slot"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n_blocks)).alias(block))
    return draws.join(blocks, block)


def every(step: Column, n: int) -> Column:
    return step % n == 0


def keep_last(snapshots: DataFrame, n: int, rank: str = "merge_index") -> DataFrame:
    """The newest n snapshots."""
    return snapshots.orderBy(F.desc(rank)).limit(n)


def newest_valid(snapshots: DataFrame, config_hash: str, pattern_hash: str, rank: str = "merge_index") -> DataFrame:
    """The newest snapshot that is intact and of this configuration."""
    ok = snapshots.where(F.col("valid") & (F.col("config_hash") == config_hash) & (F.col("pattern_hash") == pattern_hash))
    return ok.orderBy(F.desc(rank)).limit(1)


def scheduled(metrics: DataFrame, warmup: int) -> DataFrame:
    return metrics.withColumn("factor", T.warm_up(F.col("step"), warmup))


def smoothed(metrics: DataFrame, width: int, by: str, order: str, value: str) -> DataFrame:
    """Running mean of the last width values of each group."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-(width - 1), 0)
    return metrics.withColumn("mean", F.avg(value).over(w))
