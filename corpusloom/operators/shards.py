"""Token shards and packed blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .prefix import ordinal, running_sum


def with_end(df: DataFrame, eos: int | None, append: bool = True, tokens: str = "tokens") -> DataFrame:
    """tokens with the end token where it is wanted and the vocabulary has one; eos_appended tells."""
    on = append and eos is not None
    out = F.concat(F.col(tokens), F.array(F.lit(eos))) if on else F.col(tokens)
    return df.withColumn(tokens, out).withColumn("eos_appended", F.lit(on))


def sharded(df: DataFrame, docs_per_shard: int, order: list[str], length: str = "length") -> DataFrame:
    """shard and start: a fixed number of documents a shard, offsets from 0 in each."""
    placed = ordinal(df, order, name="_ord").withColumn("shard", F.expr(f"cast(_ord div {int(docs_per_shard)} as int)"))
    from pyspark.sql import Window

    # A shard holds a fixed number of rows, so this window is bounded.
    w = Window.partitionBy("shard").orderBy("_ord").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("start", F.coalesce(F.sum(length).over(w), F.lit(0)).cast("bigint")).drop("_ord")


def shard_index(index: DataFrame) -> DataFrame:
    """Documents and tokens per shard, each document once."""
    once = index.dropDuplicates(["shard", "doc_id"])
    return once.groupBy("shard").agg(F.count("*").alias("num_docs"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("num_tokens"))


def document_slices(index: DataFrame, shards: DataFrame) -> DataFrame:
    """Each document's tokens, and where they start, cut out of its shard's token array.

    The documents of a shard, a fixed number, are gathered to one row first, so a shard's array is met once.
    """
    docs = index.groupBy(F.col("shard").alias("_shard")).agg(F.collect_list(F.struct("doc_id", "start", "length")).alias("_docs"))
    cut = F.expr("transform(_docs, d -> struct(d.doc_id as doc_id, d.start as start, slice(tokens, cast(d.start + 1 as int), d.length) as tokens))")
    return shards.join(docs, F.col("shard") == F.col("_shard")).select("shard", F.explode(cut).alias("d")).select("shard", "d.*")


def split_name(doc_id, mod: int = 1000, val_remainder: int = 0):
    return F.when(T.hash_bucket(doc_id, mod) == val_remainder, F.lit("val")).otherwise(F.lit("train"))


def packed_counts(lengths: DataFrame, seq_len: int, length: str = "length") -> DataFrame:
    """Per split: tokens, whole blocks and tokens in them; both splits always have a row."""
    sums = lengths.groupBy("split").agg(F.sum(length).alias("n"))
    both = lengths.sparkSession.createDataFrame([("train",), ("val",)], "split string")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return both.join(sums, "split", "left").select("split", n.alias("raw_tokens"), F.expr(f"coalesce(n, 0) div {int(seq_len)}").alias("num_blocks"), (F.expr(f"coalesce(n, 0) div {int(seq_len)}") * seq_len).alias("packed_tokens"))


def packed_blocks(docs: DataFrame, seq_len: int, order: list[str], tokens: str = "tokens") -> DataFrame:
    """split, block_id, tokens: documents of a split joined in order and cut; the incomplete last block goes.

    A document is cut into the parts that fall into each block before the shuffle, so rows are
    documents and blocks, never single tokens.
    """
    sized = docs.withColumn("_n", F.size(tokens).cast("bigint"))
    placed = running_sum(sized, F.col("_n"), order, ["split"], name="_at").where("_n > 0")
    n = int(seq_len)
    parts = placed.select("split", F.col(tokens).alias("t"), "_at", "_n", F.explode(F.expr(f"sequence(_at div {n}, (_at + _n - 1) div {n})")).alias("block_id"))
    cut = parts.select("split", "block_id", F.expr(f"greatest(_at, block_id * {n})").alias("pos"), F.expr(f"slice(t, cast(greatest(block_id * {n} - _at, 0) + 1 as int), cast(least(_at + _n, (block_id + 1) * {n}) - greatest(_at, block_id * {n}) as int))").alias("part"))
    blocks = cut.groupBy("split", "block_id").agg(F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("ps"))
    return blocks.select("split", "block_id", F.flatten(F.transform("ps", lambda p: p["part"])).alias("tokens")).where(F.size("tokens") == n)


def block_boundaries(docs: DataFrame, seq_len: int, order: list[str], length: str = "length") -> DataFrame:
    """split, block_id, starts: where documents begin inside each whole block, for masks that keep documents apart.

    Only lengths are needed.  A block in which no document begins has no row; empty documents have no start.
    """
    n = int(seq_len)
    sized = docs.select("split", *order, F.col(length).cast("bigint").alias("_n")).where("_n > 0")
    placed = running_sum(sized, F.col("_n"), order, ["split"], name="_at")
    whole = placed.groupBy(F.col("split").alias("_split")).agg(F.max(F.expr(f"(_at + _n) div {n}")).alias("_blocks"))
    starts = placed.groupBy("split", F.expr(f"_at div {n}").alias("block_id")).agg(F.array_sort(F.collect_list(F.expr(f"cast(_at % {n} as int)"))).alias("starts"))
    return starts.join(whole, (F.col("split") == F.col("_split")) & (F.col("block_id") < F.col("_blocks"))).select("split", "block_id", "starts")


def require_blocks(blocks: DataFrame, seq_len: int) -> DataFrame:
    """The blocks, each checked for its size."""
    bad = F.raise_error(F.concat(F.lit("block of "), F.size("tokens").cast("string"), F.lit(f" tokens, expected {seq_len}"))).cast("array<int>")
    return blocks.withColumn("tokens", F.when(F.size("tokens") == seq_len, F.col("tokens")).otherwise(bad))


def truncated(df: DataFrame, most: int, tokens: str = "tokens") -> DataFrame:
    return df.withColumn(tokens, F.slice(tokens, 1, most))


def labelled(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    return df.withColumn("labels", F.col(tokens))
